import random
import re

import pytest
from pyspark.sql import functions as F

from labelloom.operators.columns import label_column, text_column
from labelloom.operators.dedup import (
    dedup_counters,
    drop_conflicts,
    drop_duplicate_texts,
    group_texts,
    keep_first,
    split_leakage,
)
from labelloom.operators.licenses import (
    DEFAULT_LICENSES,
    filter_permitted,
    filter_totals,
    license_counts,
    source_counts,
)
from labelloom.operators.normalize import (
    default_provenance,
    normalize,
    normalize_splits,
    profile,
    project_map_rows,
    quarantine,
    standard_columns,
    validate,
)
from labelloom.plans.builds import ORDINAL, dedupe_sources, union_sources


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_columns_are_found_by_priority(spark):
    df = spark.createDataFrame([("t", 0, 1)], "abstract string, label int, generated int")
    assert (text_column(df), label_column(df)) == ("abstract", "generated")
    with pytest.raises(ValueError, match="no text column"):
        text_column(df.withColumnRenamed("abstract", "Text"))


def test_normalize_maps_columns_and_keeps_metadata(spark):
    df = spark.createDataFrame(
        [("human text", 0, "a", 5), ("ai text", 1, None, 6)],
        "essay string, generated int, source string, other int",
    )
    out = normalize(df)
    assert out.columns == ["text", "label", "source"]
    assert rows(out, "text", "label", "source") == [("ai text", 1, ""), ("human text", 0, "a")]


def test_normalize_drops_blank_and_repeated_rows(spark):
    df = spark.createDataFrame(
        [(3, " a ", "human", "z"), (1, "a", "0", "y"), (2, "a", "1", "x"), (4, " ", "1", "x"), (5, None, "0", "")],
        "n int, text string, label string, source string",
    )
    out = normalize(df, ["n"])
    assert rows(out, "text", "label", "source") == [("a", 0, "y"), ("a", 1, "x")]


def test_invalid_labels_are_reported_even_on_blank_rows(spark):
    df = spark.createDataFrame([("a", "0"), ("b", "1"), (" ", "maybe")], "text string, label string")
    out = normalize(df)
    with pytest.raises(ValueError, match="1 rows"):
        validate(profile(out))
    good, bad = quarantine(out)
    validate(profile(good))
    assert bad.count() == 1


def test_validation_of_empty_and_one_sided_tables(spark):
    df = spark.createDataFrame([("a", "0"), ("b", "0")], "text string, label string")
    validate(profile(normalize(df)), require_binary=False)
    with pytest.raises(ValueError, match="both labels"):
        validate(profile(normalize(df)))
    with pytest.raises(ValueError, match="no usable rows"):
        validate(profile(normalize(df.where("false"))))


def test_map_rows_decide_by_key_presence(spark):
    df = spark.createDataFrame(
        [({"text": " a ", "label": "0"},), ({"essay": "b", "label": "0", "generated": "ai"},)],
        "row map<string,string>",
    )
    assert rows(project_map_rows(df, "row"), "text", "label") == [("a", 0), ("b", 1)]


def test_provenance_defaults_only_fill_blank_columns(spark):
    df = spark.createDataFrame(
        [("a", 0, "", "x"), ("b", 1, "", "")],
        "text string, label int, source_dataset string, source_detail string",
    )
    defaults = {"source_dataset": "d", "source_detail": "d", "source_license": "mit"}
    out = default_provenance(df, profile(df), defaults, url=True)
    assert rows(out, "source_dataset", "source_detail", "source_license", "upstream_url") == [
        ("d", "", "mit", ""),
        ("d", "x", "mit", ""),
    ]
    assert standard_columns(out.drop("upstream_url")).columns[-1] == "upstream_url"


def licensed(spark):
    return spark.createDataFrame(
        [
            ("allowed one", 1, "chat_gpt_moth"),
            ("blocked one", 0, "persuade_corpus"),
            ("blocked two", 1, "llama_70b_v1"),
            ("allowed two", 1, "radek_500"),
            ("unknown", 1, "something"),
            ("none", 1, None),
        ],
        "text string, label int, source string",
    )


def test_license_filter_keeps_permitted_sources_only(spark):
    out, enabled = filter_permitted(licensed(spark))
    assert enabled
    assert rows(out, "text", "source_detail", "source_license") == [
        ("allowed one", "chat_gpt_moth", "mit"),
        ("allowed two", "radek_500", "cc0-1.0"),
    ]
    assert filter_totals(source_counts(licensed(spark))).first().asDict() == {
        "rows_before": 6,
        "rows_after": 2,
        "rows_removed": 4,
    }
    removed = source_counts(licensed(spark)).where("not permitted")
    assert rows(removed, "source", "rows") == [
        ("", 1), ("llama_70b_v1", 1), ("persuade_corpus", 1), ("something", 1),
    ]
    assert rows(license_counts(out), "source_detail", "source_license", "rows") == [
        ("chat_gpt_moth", "mit", 1),
        ("radek_500", "cc0-1.0", 1),
    ]


def test_license_filter_is_off_without_known_sources(spark):
    df = licensed(spark).where("source = 'something'")
    assert filter_permitted(df) == (df, False)
    bare = df.drop("source")
    assert filter_permitted(bare) == (bare, False)
    assert len(DEFAULT_LICENSES.mapped_names) == 17


def copies(spark):
    return spark.createDataFrame(
        [("a", 0, "x"), ("a", 0, "y"), ("a", 1, "z"), ("b", 1, "x"), ("b", 1, "w"), ("c", 0, "x")],
        "text string, label int, source string",
    )


def test_conflicts_go_with_all_their_copies(spark):
    df = copies(spark)
    assert rows(drop_conflicts(df), "text", "source") == [("b", "w"), ("b", "x"), ("c", "x")]
    assert rows(drop_duplicate_texts(df), "text", "source") == [("b", "w"), ("c", "x")]
    assert dedup_counters(group_texts(df)).first().asDict() == {
        "rows_before_cross_source_deduplication": 6,
        "rows_with_conflicting_labels_removed": 3,
        "duplicate_text_rows_removed": 1,
    }
    once = drop_duplicate_texts(df)
    assert rows(drop_duplicate_texts(once), "text") == rows(once, "text")


def test_copies_of_frequent_texts_need_no_common_task(spark, monkeypatch):
    import labelloom.operators.dedup as dedup

    monkeypatch.setattr(dedup, "BROADCAST_GROUPS", 0)
    monkeypatch.setattr(dedup, "HOT_COPIES", 1)
    monkeypatch.setattr(dedup, "HOT_TEXTS", 4)
    data = [("hot ok", 0)] * 30 + [("hot bad", i % 2) for i in range(30)] + [("x", 0), ("x", 1), ("y", 1)]
    df = spark.createDataFrame(data, "text string, label int")
    kept = [r.text for r in drop_conflicts(df).collect()]
    assert sorted(kept) == ["hot ok"] * 30 + ["y"]


def test_sources_win_by_order_and_missing_columns_are_null(spark):
    first = spark.createDataFrame([("b", 1, "late")], "text string, label int, source string")
    second = spark.createDataFrame([("b", 1, "aaa"), ("d", 0, "q")], "text string, label int, url string")
    union = union_sources([first, second])
    assert rows(union.where("text = 'd'"), "source", "url", ORDINAL) == [(None, "q", 1)]
    kept, counters = dedupe_sources([first, second])
    assert rows(kept, "text", "source") == [("b", "late"), ("d", None)]
    assert counters["duplicate_text_rows_removed"] == 1


def test_keep_first_does_not_depend_on_partitioning(spark):
    df = spark.range(2000).select(
        F.concat(F.lit("t"), F.col("id") % 40).alias("text"),
        (F.col("id") % 2).cast("int").alias("label"),
        F.md5(F.col("id").cast("string")).alias("source"),
    )
    one = rows(keep_first(df.coalesce(1), ["text", "label"]), "text", "label", "source")
    many = rows(keep_first(df.repartition(16), ["text", "label"]), "text", "label", "source")
    assert one == many and len(one) == 40


def plain_first(data, keys, order):
    """data: dicts. The least row per key by ``order``, then by the other values, null first."""
    names = [*order, *(c for c in data[0] if c not in (*keys, *order))]
    least = {}
    for row in data:
        key = tuple(row[k] for k in keys)
        rank = [(row[c] is not None, row[c] if row[c] is not None else 0) for c in names]
        if key not in least or rank < least[key][0]:
            least[key] = rank, row
    return sorted((tuple(row.values()) for _, row in least.values()), key=repr)


@pytest.mark.parametrize("bound", [0, 1_000_000])
def test_first_rows_equal_a_plain_search_on_both_sides_of_the_bound(spark, monkeypatch, bound):
    import labelloom.operators.dedup as dedup

    monkeypatch.setattr(dedup, "BROADCAST_GROUPS", bound)
    rng = random.Random(11)
    data = [
        {
            "text": rng.choice([None, "", "a", "é", f"t{k % 50}", "hot", "hot", "hot"]),
            "label": rng.choice([0, 1, None]),
            "n": rng.choice([None, 1, 2, 3]),
            "source": rng.choice([None, "x", "y", ""]),
        }
        for k in range(600)
    ]
    df = spark.createDataFrame([tuple(d.values()) for d in data], "text string, label int, n int, source string").repartition(5)
    for order in ([], ["n"], ["source", "n"]):
        got = sorted((tuple(r) for r in keep_first(df, ["text", "label"], order).collect()), key=repr)
        assert got == plain_first(data, ["text", "label"], order)
    labelled = [d for d in data if d["label"] is not None]
    kinds = {}
    for d in labelled:
        kinds.setdefault(d["text"], set()).add(d["label"])
    clean = [d for d in labelled if len(kinds[d["text"]]) == 1]
    got = drop_duplicate_texts(df.where("label is not null"), ["n"])
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_first(clean, ["text"], ["n"])
    kept = drop_conflicts(df.where("label is not null"))
    assert sorted((tuple(r) for r in kept.collect()), key=repr) == sorted((tuple(d.values()) for d in clean), key=repr)
    assert keep_first(df.where("false"), ["text", "label"]).collect() == []


@pytest.mark.parametrize("bound", [0, 1_000_000])
def test_texts_are_neither_sorted_nor_an_exchange_key(spark, monkeypatch, bound):
    """Of all plans that run for a normalisation, no aggregation sorts, and no exchange or sort has the text as a key."""
    import labelloom.operators.dedup as dedup

    monkeypatch.setattr(dedup, "BROADCAST_GROUPS", bound)
    plans = []
    staged = dedup.stage

    def seen(df, name="stage", path=None):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return staged(df, name, path)

    monkeypatch.setattr(dedup, "stage", seen)
    df = spark.createDataFrame([("a", 0, "x"), ("a", 0, "y"), ("b", 1, "x"), ("b", 0, "x")], "text string, label int, source string")
    for result in (normalize(df, ["source"]), normalize_splits({"train": df, "test": df}), drop_duplicate_texts(df), drop_conflicts(df)):
        result.collect()
        plans.append(result._jdf.queryExecution().executedPlan().toString())
    lines = [line for plan in plans for line in plan.splitlines()]
    assert any("HashAggregate" in line for line in lines)
    assert not any("SortAggregate" in line for line in lines)
    moved = [line for line in lines if re.search(r"Exchange hashpartitioning|Exchange rangepartitioning|Sort \[|Window", line)]
    assert moved and not any(re.search(r"\btext#", line) for line in moved)


def test_leakage_counts_texts_in_several_splits(spark):
    df = spark.createDataFrame(
        [("a", "train"), ("a", "test"), ("b", "train"), ("b", "train")], "text string, split string"
    )
    assert tuple(split_leakage(df).first()) == (1, 2)
