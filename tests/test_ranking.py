import hashlib
import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from labelloom.operators.ranking import find_cuts, order_key, rank_rows, shuffle_rows
from labelloom.operators.sampling import (
    allocate_rows,
    balanced_sample,
    balanced_targets,
    presplit_sample,
)
from labelloom.operators.splits import (
    label_count_map,
    split_label_counts,
    split_three_way,
    split_two_way,
    three_way_sizes,
    two_way_size,
)


def key(text, seed=42, purpose="sample"):
    digest = hashlib.md5(text.encode()).hexdigest()
    return hashlib.md5(f"{seed}:{purpose}:{digest}".encode()).hexdigest()


def corpus(spark, human, generated):
    data = [(f"human {i}", 0) for i in range(human)] + [(f"ai {i}", 1) for i in range(generated)]
    return spark.createDataFrame(data, "text string, label int")


def by_label(df):
    return {r["label"]: r["count"] for r in df.groupBy("label").count().collect()}


def test_ranks_equal_a_full_sort(spark):
    df = corpus(spark, 5000, 700)
    wanted = {(0,): [1, 777, 4999, 5000, 9999], (1,): [0, 350]}
    ranked = rank_rows(df, ["label"], order_key(df, 42, "sample"), lambda _: wanted)
    assert ranked.counts == {(0,): 5000, (1,): 700}
    ordered = {
        0: sorted((f"human {i}" for i in range(5000)), key=key),
        1: sorted((f"ai {i}" for i in range(700)), key=key),
    }
    for (label,), ranks in wanted.items():
        for rank in ranks:
            got = ranked.df.where(ranked.within((label,), rank)).select("text").collect()
            assert {r.text for r in got} == set(ordered[label][:rank])


def test_cut_inside_a_huge_group_of_copies_is_exact(spark):
    df = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, "copy").otherwise(F.concat(F.lit("t"), F.col("id"))).alias("text"),
        (F.col("id") % 2).cast("int").alias("label"),
    )
    for cap in (2, 999, 4501, 8999):
        sampled = balanced_sample(df, cap, 42)
        assert sampled.columns == ["text", "label"]
        assert by_label(sampled) == {0: cap // 2, 1: cap - cap // 2}


def test_copies_with_other_metadata_are_cut_exactly(spark):
    df = spark.range(4000).select(
        F.lit("same").alias("text"),
        (F.col("id") % 2).cast("int").alias("label"),
        F.col("id").alias("n"),
    )
    sampled = balanced_sample(df, 1001, 42)
    assert by_label(sampled) == {0: 500, 1: 501}
    assert sampled.select("n").distinct().count() == 1001


def test_sample_is_independent_of_partitioning(spark):
    df = corpus(spark, 600, 400)
    texts = [
        {r.text for r in balanced_sample(df.repartition(n), 101, 7).collect()} for n in (1, 16)
    ]
    assert texts[0] == texts[1]
    assert texts[0] != {r.text for r in balanced_sample(df, 101, 8).collect()}


def test_sampling_and_splitting_orders_are_independent(spark):
    sampled = balanced_sample(corpus(spark, 4000, 4000), 2000, 42)
    rows = split_three_way(sampled, 0.1, 0.1, 42)[0].where("split = 'test'").collect()
    low_half = sum(key(r.text) < "10" for r in rows)
    assert 50 < low_half < 150  # the sample's lowest keys would all be in the test split


def test_ten_thousand_keys(spark):
    df = spark.range(60_000).select(
        F.when(F.col("id") % 10_000 == 0, None).otherwise(F.col("id") % 10_000).alias("k"), F.concat(F.lit("t"), F.col("id")).alias("text")
    )
    ranked = rank_rows(df, ["k"], order_key(df, 42, "sample"), lambda counts: {k: [2 + (k[0] or 0) % 7] for k in counts})
    assert len(ranked.counts) == 10_000 and set(ranked.counts.values()) == {6}
    got = defaultdict(set)
    for r in ranked.take().select("k", "text").collect():
        got[r.k].add(r.text)
    for k in range(10_000):
        texts = sorted((f"t{i}" for i in range(k, 60_000, 10_000)), key=key)
        assert got[k or None] == set(texts[: 2 + k % 7])


def test_many_keys_with_cuts_among_copies(spark):
    df = spark.range(3000).select((F.col("id") % 100).alias("k"), F.when(F.col("id") % 3 == 0, F.lit("copy")).otherwise(F.lit("other")).alias("text"), "id")
    ranked = rank_rows(df, ["k"], order_key(df, 1, "x"), lambda counts: {k: [k[0] % 31] for k in counts})
    assert {r.k: r["count"] for r in ranked.take().groupBy("k").count().collect()} == {k: k % 31 for k in range(100) if k % 31}


def test_histograms_stay_on_the_executors(spark, monkeypatch):
    import labelloom.operators.ranking as ranking

    df = corpus(spark, 5000, 700)
    rows, taken = [], type(df).collect
    monkeypatch.setattr(type(df), "collect", lambda self: rows.append(taken(self)) or rows[-1])
    monkeypatch.setattr(ranking, "FEW_ROWS", 0)  # level by level
    _, cuts = find_cuts(df, ["label"], order_key(df, 42, "sample"), lambda _: {(0,): [1, 777], (1,): [350]})
    assert {c: cut.ties for c, cut in cuts.items()} == {((0,), 1): 1, ((0,), 777): 1, ((1,), 350): 1}
    assert len(rows) >= 3 and max(map(len, rows)) == 3


def test_balanced_cap(spark):
    df = corpus(spark, 10, 10)
    assert by_label(balanced_sample(df, 6, 42)) == {0: 3, 1: 3}
    assert by_label(balanced_sample(df, 7, 42)) == {0: 3, 1: 4}
    assert by_label(balanced_sample(df, None, 42)) == {0: 10, 1: 10}
    assert by_label(balanced_sample(df, 20, 42)) == {0: 10, 1: 10}


def test_short_label_is_backfilled(spark):
    assert by_label(balanced_sample(corpus(spark, 50, 5), 30, 42)) == {0: 25, 1: 5}
    assert balanced_targets({0: 3, 1: 100}, 40) == {0: 3, 1: 37}
    # A loose cap changes nothing, not even the balance.
    assert by_label(balanced_sample(corpus(spark, 50, 5), 55, 42)) == {0: 50, 1: 5}


def test_balanced_sample_errors(spark):
    with pytest.raises(ValueError, match="at least 2"):
        balanced_sample(corpus(spark, 5, 5), 1, 42)
    with pytest.raises(ValueError, match="both labels"):
        balanced_sample(corpus(spark, 5, 0), 3, 42)


def assert_fair(sizes, wanted, rows):
    """Bounds, the exact sum, and: no row settled elsewhere would have served better."""
    assert sum(rows.values()) == wanted
    assert all(2 <= rows[s] <= sizes[s] for s in sizes)
    exact = {s: wanted * n / sum(sizes.values()) for s, n in sizes.items()}
    start = {s: max(2, math.floor(exact[s])) for s in sizes}
    sign = 1 if wanted >= sum(start.values()) else -1
    moved = {s: sign * (rows[s] - start[s]) for s in sizes}
    assert min(moved.values()) >= 0

    def merit(order, s, step):
        level = start[s] + sign * step
        return (sign * (exact[s] - level), sizes[s] if sign > 0 else level, -order)

    def possible(s, step):
        return start[s] + step < sizes[s] if sign > 0 else start[s] - step > 2

    named = list(enumerate(sizes))
    done = [merit(o, s, step) for o, s in named for step in range(moved[s])]
    next_ = [merit(o, s, moved[s]) for o, s in named if possible(s, moved[s])]
    assert not done or not next_ or min(done) > max(next_)


def test_allocation_is_fair_and_exact():
    rng = random.Random(5)
    for _ in range(3000):
        sizes = {s: rng.choice([2, 3, 5, 40, 1000]) + rng.randrange(6) for s in ("train", "val", "test")}
        wanted = rng.randint(6, sum(sizes.values()))
        assert_fair(sizes, wanted, allocate_rows(sizes, wanted))
    assert allocate_rows({"train": 8, "val": 4, "test": 4}, 8) == {"train": 4, "val": 2, "test": 2}
    with pytest.raises(ValueError, match="at least 2 rows each"):
        allocate_rows({"train": 8, "val": 4, "test": 4}, 5)
    with pytest.raises(ValueError, match="fewer than 2"):
        allocate_rows({"train": 8, "val": 1, "test": 4}, 6)


def test_presplit_sample_balances_inside_each_split(spark):
    data = [
        (f"{split} {i}", i % 2, split)
        for split, n in (("train", 80), ("val", 40), ("test", 40))
        for i in range(n)
    ]
    df = spark.createDataFrame(data, "text string, label int, split string")
    sampled, allocation, taken = presplit_sample(df, 80, 42)
    assert allocation == {"train": 40, "val": 20, "test": 20}
    counts = Counter((r.split, r.label) for r in sampled.collect())
    assert counts == {(s, y): n // 2 for s, n in allocation.items() for y in (0, 1)}
    assert taken == {s: {0: n // 2, 1: n // 2} for s, n in allocation.items()}
    assert presplit_sample(df, 160, 42)[:2] == (df, None)


def test_split_sizes():
    assert [two_way_size(n, 0.25) for n in (1, 2, 4, 6, 10)] == [1, 1, 1, 2, 2]
    assert two_way_size(2, 0.9) == 1
    assert three_way_sizes(10, 0.2, 0.2) == (2, 2)
    assert three_way_sizes(1, 0.1, 0.1) == (1, 1)
    assert three_way_sizes(2, 0.1, 0.1) == (1, 1)
    assert three_way_sizes(4, 0.45, 0.5) == (2, 1)


def test_splits_are_exact_disjoint_and_complete(spark):
    df, counts = split_two_way(corpus(spark, 4, 4), 0.25, 42)
    assert Counter(r.split for r in df.collect()) == {"train": 6, "val": 2}
    df, counts = split_three_way(corpus(spark, 10, 10), 0.2, 0.2, 42)
    seen = defaultdict(Counter)
    for r in df.collect():
        seen[r.split][r.label] += 1
    assert seen == {"train": {0: 6, 1: 6}, "val": {0: 2, 1: 2}, "test": {0: 2, 1: 2}}
    assert counts == {s: dict(c) for s, c in seen.items()}
    totals = {(r.split, r.label): r.rows for r in split_label_counts(df).collect()}
    assert totals[None, None] == 20 and totals["val", None] == 4
    assert label_count_map(df).first()["label_counts"] == {"0": 10, "1": 10}


def test_tiny_labels_go_to_test_then_val(spark):
    df, _ = split_three_way(corpus(spark, 30, 2), 0.1, 0.1, 42)
    assert Counter(r.split for r in df.where("label = 1").collect()) == {"test": 1, "val": 1}
    with pytest.raises(ValueError, match="no rows"):
        split_three_way(corpus(spark, 1, 1), 0.1, 0.1, 42)
    with pytest.raises(ValueError, match="less than 1"):
        split_three_way(corpus(spark, 9, 9), 0.5, 0.5, 42)
    with pytest.raises(ValueError, match="between 0 and 1"):
        split_two_way(corpus(spark, 9, 9), 1.0, 42)


def test_choosing_rows_needs_no_shuffle(spark):
    df, _ = split_three_way(corpus(spark, 100, 100), 0.1, 0.1, 42)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan and "Join" not in plan


def test_shuffle_keeps_all_rows(spark):
    df = corpus(spark, 20, 20)
    texts = [r.text for r in shuffle_rows(df, 1).collect()]
    assert texts == sorted(texts, key=lambda t: key(t, 1, "shuffle")) and len(texts) == 40
