import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from labelloom.sources import sinks, tabular

NASTY = ['quote " inside', "line\nbreak", "comma, here", "  padded  ", "null", "NA", "tab\t", "cr\r\nlf", "\\back\\", 'é"ü']


def nasty(spark):
    return spark.createDataFrame([(t, i % 2) for i, t in enumerate(NASTY)], "text string, label int")


def test_csv_round_trip_keeps_texts(spark, folder):
    nasty(spark).write.options(**sinks.CSV_WRITE).csv(f"{folder}/out")
    back = tabular.read_source(spark, f"{folder}/out")
    assert sorted(r.text for r in back.collect()) == sorted(NASTY)


def test_csv_written_by_pandas(spark, folder):
    pd.DataFrame({"text": [*NASTY, None], "label": 1}).to_csv(f"{folder}/a.csv", index=False)
    back = tabular.read_csv(spark, f"{folder}/a.csv").collect()
    assert [r.text for r in back] == [*NASTY, None]


def test_directories_are_read_whole(spark, folder):
    os.makedirs(f"{folder}/data/deep.er")
    for i, name in enumerate(("x.csv", "deep.er/y.csv")):
        pd.DataFrame({"text": [f"t{i}"], "label": [i]}).to_csv(f"{folder}/data/{name}", index=False)
    pd.DataFrame({"text": ["p"], "license": ["mit"]}).to_parquet(f"{folder}/data/z.parquet")
    assert tabular.source_formats(spark, f"{folder}/data") == ["csv", "parquet"]
    rows = tabular.read_source(spark, f"{folder}/data").collect()
    assert sorted((r.text, r.label, r.license) for r in rows) == [("p", None, "mit"), ("t0", "0", None), ("t1", "1", None)]
    assert tabular.csv_source(spark, f"{folder}/data") == f"{folder}/data"
    pd.DataFrame({"text": ["best"], "label": [1]}).to_csv(f"{folder}/data/train.csv", index=False)
    assert tabular.csv_source(spark, f"{folder}/data") == f"{folder}/data"
    assert tabular.csv_source(spark, f"{folder}/data", tabular.PREFERRED_CSV).endswith("/train.csv")
    assert [r.text for r in tabular.read_source(spark, f"{folder}/data/z.parquet").collect()] == ["p"]


def test_csv_columns_are_bound_by_name(spark, folder):
    os.makedirs(f"{folder}/two")
    pd.DataFrame({"text": ["a"], "label": [0], "source": ["s"]}).to_csv(f"{folder}/two/a.csv", index=False)
    pd.DataFrame({"label": [1], "source": ["r"], "text": ["b"]}).to_csv(f"{folder}/two/b.csv", index=False)
    rows = tabular.read_source(spark, f"{folder}/two").collect()
    assert sorted((r.text, r.label, r.source) for r in rows) == [("a", "0", "s"), ("b", "1", "r")]
    pd.DataFrame({"label": [1], "words": ["c"]}).to_csv(f"{folder}/two/c.csv", index=False)
    with pytest.raises(ValueError, match="c.csv"):
        tabular.read_source(spark, f"{folder}/two")


def test_parquet_columns_of_all_files(spark, folder):
    spark.sql("select 'a' text").write.parquet(f"{folder}/m/x")
    spark.sql("select 'b' text, 'mit' source_license").write.parquet(f"{folder}/m/y")
    rows = tabular.read_parquet(spark, f"{folder}/m").collect()
    assert sorted((r.text, r.source_license) for r in rows) == [("a", None), ("b", "mit")]


def test_missing_sources_name_the_path(spark, folder):
    with pytest.raises(FileNotFoundError, match="nowhere"):
        tabular.read_source(spark, f"{folder}/nowhere")
    os.makedirs(f"{folder}/empty")
    with pytest.raises(FileNotFoundError, match="no CSV or Parquet"):
        tabular.read_source(spark, f"{folder}/empty")
    with pytest.raises(FileNotFoundError, match="no CSV"):
        tabular.csv_source(spark, f"{folder}/empty")


def test_projected_scan_prunes_columns(spark, folder):
    nasty(spark).withColumn("extra", F.lit(1)).write.parquet(f"{folder}/t")
    df = tabular.read_columns(spark, f"{folder}/t", ["label"])
    assert "ReadSchema: struct<label:int>" in df._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError, match="missing required"):
        tabular.read_columns(spark, f"{folder}/t", ["nothing"])


def test_training_and_evaluation_scans(spark):
    df = spark.createDataFrame(
        [(" a ", "1"), ("b", "0"), ("  ", "1"), (None, "0"), ("a", "1")], "text string, label string"
    )
    assert sorted(r.text for r in tabular.read_split(df).collect()) == ["a", "a", "b"]
    assert tabular.read_split(df, limit_rows=2).count() == 2
    assert sorted(r.text for r in tabular.read_evaluation(df).collect()) == ["", "  ", " a ", "a", "b"]
    with pytest.raises(ValueError, match="missing required"):
        tabular.read_split(df.drop("label"))
    with pytest.raises(ValueError, match="both labels"):
        tabular.read_split(df.where("label = '1'"))


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_corpus_round_trip(spark, folder, fmt):
    df = nasty(spark).withColumn("split", F.when(F.col("label") == 0, "train").otherwise("test"))
    sinks.write_corpus(df, folder, fmt)
    back = sinks.read_corpus(spark, folder, fmt=fmt)
    assert back.columns == [*tabular.STANDARD_SCHEMA.names, "split"]
    assert sorted(r.text for r in back.collect()) == sorted(NASTY)
    test = sinks.read_corpus(spark, folder, "test", fmt)
    assert {(r.label, r.upstream_url) for r in test.collect()} == {(1, "")}
    assert "PartitionFilters: [isnotnull(split" in test._jdf.queryExecution().executedPlan().toString()


def test_build_runs_once_unless_asked_again(spark, folder):
    calls = []

    def build():
        calls.append(1)
        sinks.write_corpus(nasty(spark).withColumn("split", F.lit("train")), folder)
        sinks.write_json(spark, {"b": {"n": 1}, "a": None}, f"{folder}/{sinks.METADATA}")
        return {"built": True}

    assert not sinks.corpus_ready(spark, folder)
    assert sinks.ensure_corpus(spark, folder, build) == {"built": True}
    assert sinks.ensure_corpus(spark, folder, build) == {"b": {"n": 1}, "a": None}
    sinks.ensure_corpus(spark, folder, build, rebuild=True)
    assert len(calls) == 2
    lines = [r.value for r in spark.read.text(f"{folder}/{sinks.METADATA}").collect()]
    assert lines[1] == '  "a": null,'


def test_reports_keep_null_fields(spark, folder):
    sinks.write_report(spark.sql("select cast(null as double) roc_auc, 1 n"), f"{folder}/r")
    assert spark.read.text(f"{folder}/r").first()[0] == '{"roc_auc":null,"n":1}'
    table = sinks.ensure_table(spark, f"{folder}/t", lambda: spark.range(3))
    assert sinks.ensure_table(spark, f"{folder}/t", lambda: 1 / 0).count() == table.count() == 3


def test_columns_whose_types_differ_are_text(spark, folder):
    def put(rows, schema):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")

    put([("a", 1, 7)], "text string, label int, source int")
    put([("b", "human", "007")], "text string, label string, source string")
    put([("c", True, 2.5)], "text string, label boolean, source double")
    back = tabular.read_source(spark, f"{folder}/in")
    assert sorted(tuple(r) for r in back.select("text", "label", "source").collect()) == [
        ("a", "1", "7"), ("b", "human", "007"), ("c", "true", "2.5"),
    ]
    with pytest.raises(Exception, match="NOT_FOUND|does not exist"):
        tabular.read_parquet(spark, f"{folder}/absent")
