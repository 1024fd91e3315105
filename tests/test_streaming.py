from collections import Counter

import pytest

from labelloom.plans import catalogue, models
from labelloom.streaming import scoring
from labelloom.streaming.quota import QuotaSink, StreamSource, balanced_quota, collect_quota
from test_models import length_model

LITERALS = {"source_dataset": "d", "source_split": "train"}


def write_files(spark, folder, rows, files, schema="text string, label int"):
    spark.createDataFrame(rows, schema).repartition(files).write.parquet(folder)


def test_stops_early_with_exact_quotas(spark, folder):
    write_files(spark, f"{folder}/in", [(f"t{i}", i % 2) for i in range(1000)], 10)
    out = f"{folder}/out"
    got = collect_quota(
        spark, StreamSource(f"{folder}/in", 1), balanced_quota(201), 42, LITERALS, output=out
    )
    assert Counter(r.label for r in got.collect()) == {0: 100, 1: 101}
    assert got.columns == ["text", "label", "source_dataset", "source_split"]
    assert spark.read.parquet(f"{out}/rows").select("batch").distinct().count() < 10


def test_copies_count_and_leave_afterwards(spark, folder):
    write_files(spark, f"{folder}/in", [("same", 0)] * 300 + [(f"t{i}", 1) for i in range(300)], 3)
    got = collect_quota(spark, StreamSource(f"{folder}/in"), {0: 250, 1: 250}, 42, LITERALS)
    assert Counter(r.label for r in got.collect()) == {0: 250, 1: 250}
    assert Counter(r.label for r in scoring.dedup_collected(got).collect()) == {0: 1, 1: 250}


def test_without_a_quota_every_row_is_collected(spark, folder):
    write_files(spark, f"{folder}/in", [("same", 0)] * 30 + [(f"t{i}", 1) for i in range(30)], 5)
    source = StreamSource(f"{folder}/in", 1)
    got = collect_quota(spark, source, balanced_quota(None), 42, LITERALS)
    assert Counter(r.label for r in got.collect()) == {0: 30, 1: 30}
    write_files(spark, f"{folder}/blank", [(" ", 0)], 1)
    assert collect_quota(spark, StreamSource(f"{folder}/blank"), None, 42, LITERALS).count() == 0
    write_files(spark, f"{folder}/bad", [("x", "maybe")], 1, "text string, label string")
    with pytest.raises(ValueError, match="not binary"):
        collect_quota(spark, StreamSource(f"{folder}/bad"), None, 42, LITERALS)


def test_a_second_run_goes_on_where_the_first_ended(spark, folder):
    source, output = StreamSource(f"{folder}/in/*", 1), f"{folder}/out"
    for batch in range(5):
        write_files(spark, f"{folder}/in/{batch}", [(f"t{batch} {i}", i % 2) for i in range(40)], 1)
        if batch == 1:
            with pytest.raises(RuntimeError, match="ended with"):
                collect_quota(spark, source, {0: 50, 1: 70}, 42, LITERALS, output=output)
    got = collect_quota(spark, source, {0: 50, 1: 70}, 42, LITERALS, output=output).collect()
    assert Counter((r.text.split()[0], r.label) for r in got) == {
        ("t0", 0): 20, ("t0", 1): 20, ("t1", 0): 20, ("t1", 1): 20, ("t2", 0): 10, ("t2", 1): 20, ("t3", 1): 10,
    }


def test_blank_texts_are_not_waited_for(spark, folder):
    schema = "doc_id long, text string, source string, lang string"
    texts = ["a", "b", "a", None, " \t", "", "c", "\u00a0"]
    write_files(spark, f"{folder}/documents.parquet", [(i, t, "s", "en") for i, t in enumerate(texts)], 2, schema)
    got = catalogue.stream_dedup(spark, folder).collect()
    assert sorted(map(tuple, got)) == [("a", 0, "train"), ("b", 1, "train"), ("c", 0, "train")]
    write_files(spark, f"{folder}/blank/documents.parquet", [(1, None, "s", "en"), (2, " ", "s", "en")], 1, schema)
    assert catalogue.stream_dedup(spark, f"{folder}/blank").count() == 0


def test_short_stream_raises_with_counts(spark, folder):
    write_files(spark, f"{folder}/in", [("a", 0), ("b", 1), ("c", 1)], 1)
    with pytest.raises(RuntimeError, match="0: 1"):
        collect_quota(spark, StreamSource(f"{folder}/in"), {0: 2, 1: 2}, 42, LITERALS)


def test_quotas_may_differ_or_be_zero(spark, folder):
    write_files(spark, f"{folder}/in", [(f"t{i}", i % 2) for i in range(100)], 2)
    source = StreamSource(f"{folder}/in")
    got = collect_quota(spark, source, {0: 30, 1: 0}, 42, LITERALS, label_first=True)
    assert Counter(r.label for r in got.collect()) == {0: 30}
    assert collect_quota(spark, source, {0: 0, 1: 0}, 42, LITERALS).count() == 0


def test_invalid_labels(spark, folder):
    rows = [("a", "0"), ("b", "1"), (" ", "maybe")]
    write_files(spark, f"{folder}/in", rows, 1, "text string, label string")
    source = StreamSource(f"{folder}/in")
    # A blank row is skipped before its label is read, or after.
    assert collect_quota(spark, source, {0: 1, 1: 1}, 42, LITERALS).count() == 2
    with pytest.raises(ValueError, match="not binary"):
        collect_quota(spark, source, {0: 1, 1: 1}, 42, LITERALS, label_first=True)


def test_a_batch_that_runs_again_replaces_itself(spark, folder):
    first = spark.createDataFrame([(f"a{i}", i % 2) for i in range(40)], "text string, label int")
    second = spark.createDataFrame([(f"b{i}", i % 2) for i in range(40)], "text string, label int")
    sink = QuotaSink(spark, f"{folder}/rows", {0: 25, 1: 25}, 42)
    sink.write(first, 0)
    sink.write(second, 1)
    rows = {r.text for r in spark.read.parquet(f"{folder}/rows").collect()}
    again = QuotaSink(spark, f"{folder}/rows", {0: 25, 1: 25}, 42)
    again.write(second, 1)
    assert again.full and {r.text for r in spark.read.parquet(f"{folder}/rows").collect()} == rows
    assert again.taken() == {0: 25, 1: 25}


def test_requests_are_answered_or_rejected_once(spark, folder):
    rows = [(1, "hello"), (2, "  "), (3, None), (4, "world")]
    write_files(spark, f"{folder}/in", rows, 2, "n int, text string")

    def run():
        requests = StreamSource(f"{folder}/in", 1).open(spark)
        query = scoring.start_scoring(
            requests,
            lambda df: models.score_with_python(df, length_model(), "v"),
            f"{folder}/out",
            f"{folder}/progress",
            available_now=True,
        )
        query.awaitTermination()
        return {(r.n, r.status, r.prob_ai, r.model_version) for r in spark.read.parquet(f"{folder}/out").collect()}

    expected = {(1, "valid", 0.5, "v"), (4, "valid", 0.5, "v"), (2, "rejected", None, None), (3, "rejected", None, None)}
    assert run() == expected
    assert run() == expected  # a restart from the checkpoint adds nothing
    assert spark.read.parquet(f"{folder}/out").count() == 4


def test_a_batch_may_be_several_files(spark, monkeypatch):
    folder = "/root/testdata/sf0.001"

    def rows():
        return Counter(map(tuple, catalogue.stream_quota_batches(spark, folder).collect()))

    one_file = rows()
    opened, source = [], catalogue.StreamSource
    monkeypatch.setattr(catalogue, "StreamSource", lambda *a, **b: opened.append(source(*a, **b)) or opened[-1])
    monkeypatch.setattr(catalogue, "ROWS_PER_FILE", 10)
    assert rows() == one_file
    files = opened[0].max_files_per_batch
    assert files > 1 and spark.read.parquet(opened[0].path).select("_metadata.file_path").distinct().count() == catalogue.BATCHES * files
