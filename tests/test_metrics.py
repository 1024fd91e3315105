import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from labelloom.operators import cumulative, metrics, percentiles


def frame(spark, pairs):
    return spark.createDataFrame([(y, float(s)) for y, s in pairs], "label int, score double")


def brute_auc(pairs):
    pos = [s for y, s in pairs if y]
    neg = [s for y, s in pairs if not y]
    return sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))


def brute_at(pairs, threshold):
    tp = sum(1 for y, s in pairs if s >= threshold and y)
    fp = sum(1 for y, s in pairs if s >= threshold and not y)
    fn = sum(1 for y, s in pairs if s < threshold and y)
    p = tp / (tp + fp) if tp + fp else 0.0
    r = tp / (tp + fn) if tp + fn else 0.0
    return (2 * p * r / (p + r) if p + r else 0.0, p, r)


def brute_threshold(pairs):
    candidates = sorted({s for _, s in pairs})
    candidates += [] if 0.5 in candidates else [0.5]
    best, best_key = 0.5, (-1.0,)
    for t in candidates:
        if brute_at(pairs, t) > best_key:
            best, best_key = t, brute_at(pairs, t)
    return best


def brute_ap(pairs):
    positives = sum(y for y, _ in pairs)
    total = 0.0
    for s in {s for _, s in pairs}:
        p = sum(1 for y, x in pairs if x == s and y)
        above = [y for y, x in pairs if x >= s]
        total += p * sum(above) / len(above)
    return total / positives


def random_pairs(seed, n, ties):
    rng = random.Random(seed)
    hot = [0.25] if ties else []
    return [
        (int(rng.random() < 0.4), rng.choice(hot + [rng.random()]) if ties else rng.random())
        for _ in range(n)
    ]


@pytest.mark.parametrize(("seed", "ties"), [(1, True), (2, False)])
def test_report_equals_brute_force(spark, seed, ties):
    pairs = random_pairs(seed, 600, ties)
    row = metrics.classification_report(frame(spark, pairs)).first()
    assert row.roc_auc == pytest.approx(brute_auc(pairs), abs=1e-12)
    assert row.pr_auc == pytest.approx(brute_ap(pairs), abs=1e-12)
    assert row.brier_score == pytest.approx(statistics.fmean((s - y) ** 2 for y, s in pairs))
    assert row.threshold == brute_threshold(pairs)
    assert (row.f1, row.precision, row.recall) == brute_at(pairs, row.threshold)
    assert row.true_positive + row.false_negative == sum(y for y, _ in pairs)
    assert sum(row[c] for c in row.asDict() if "_positive" in c or "_negative" in c) == 600


def test_perfect_ranking(spark):
    df = frame(spark, [(0, 0.1), (0, 0.2), (1, 0.8), (1, 0.9)])
    assert metrics.roc_auc(df).first()[0] == 1.0
    assert metrics.pr_auc(df).first()[0] == 1.0


def test_report_at_a_given_threshold(spark):
    row = metrics.classification_report(frame(spark, [(0, 0.1), (1, 0.7), (1, 0.8)]), 0.5).first()
    assert (row.precision, row.recall, row.f1, row.threshold) == (1.0, 1.0, 1.0, 0.5)
    assert tuple(metrics.threshold_metrics(frame(spark, [(0, 0.9)]), 0.5).first()) == (0.0, 0.0, 0.0)


def test_threshold_ties_go_to_the_lowest_score_and_the_default_comes_last(spark):
    # Scores 0.2 and 0.6 give the same metrics only if nothing lies between: lowest wins.
    cases = [
        [(1, 0.6), (1, 0.6), (0, 0.1)],
        [(0, 0.9), (0, 0.8)],  # every F1 is 0: the lowest score stays, 0.5 is no better
        [(1, 0.2), (0, 0.4), (1, 0.6)],
        [(0, 0.2), (0, 0.3)],
        [(1, 0.5)],
    ]
    for pairs in cases:
        assert metrics.best_threshold(frame(spark, pairs)).first().threshold == brute_threshold(pairs)


def test_undefined_metrics_are_null(spark):
    one_class = metrics.classification_report(frame(spark, [(0, 0.3), (0, 0.6)])).first()
    assert one_class.roc_auc is None and one_class.pr_auc is None
    empty = metrics.classification_report(frame(spark, [(0, 0.3)]).where("false")).first()
    assert (empty.threshold, empty.f1, empty.true_positive, empty.brier_score) == (0.5, 0.0, 0, None)


def test_groups_are_reported_apart_and_null_groups_stay(spark):
    pairs = {g: random_pairs(i, 150, True) for i, g in enumerate(["a", "b", None])}
    data = [(g, y, s) for g, ps in pairs.items() for y, s in ps]
    df = spark.createDataFrame(data, "g string, label int, score double")
    rows = {r.g: r for r in metrics.classification_report(df, by=["g"]).collect()}
    for g, ps in pairs.items():
        assert rows[g].roc_auc == pytest.approx(brute_auc(ps), abs=1e-12)
        assert rows[g].threshold == brute_threshold(ps)


def test_results_do_not_depend_on_cuts_or_partitions(spark, monkeypatch):
    df = frame(spark, random_pairs(9, 500, True))
    reports = []
    for buckets, partitions in ((1, 1), (3, 7), (256, 16)):
        monkeypatch.setattr(
            metrics, "quantile_cuts", lambda d, v, b=buckets: cumulative.quantile_cuts(d, v, b)
        )
        row = metrics.classification_report(df.repartition(partitions)).first()
        reports.append([round(v, 12) for v in row])
    assert reports[0] == reports[1] == reports[2]


def test_the_scores_are_read_once_for_cuts_and_totals(spark):
    df = metrics.running_confusion(spark.range(100).selectExpr("cast(id % 2 as int) label", "id / 100 score"))
    df.collect()
    assert all("score-counts" in file for file in df.inputFiles()) and df.inputFiles()  # the grouped table is staged
    assert "Range (" not in df._jdf.queryExecution().executedPlan().toString()


def test_mid_ranks_and_curve(spark):
    df = frame(spark, [(0, 0.1), (1, 0.4), (0, 0.4), (1, 0.4), (1, 0.9)])
    ranks = {r.score: (r.n, r.mid_rank) for r in metrics.mid_ranks(df).collect()}
    assert ranks == {0.1: (1, 1.0), 0.4: (3, 3.0), 0.9: (1, 5.0)}
    curve = {r.score: r for r in metrics.precision_recall_curve(df).collect()}
    assert (curve[0.4].true_positive, curve[0.4].false_positive) == (3, 1)
    assert curve[0.4].recall_delta == pytest.approx(2 / 3)


def test_scored_rows_are_checked(spark):
    metrics.check_scored(frame(spark, [(0, 0.1)]))
    bad = spark.createDataFrame([(0, None), (2, 0.5)], "label int, score double")
    with pytest.raises(ValueError, match="1 rows lack"):
        metrics.check_scored(bad)


def test_losses(spark):
    df = spark.createDataFrame([(1, 800.0), (0, -800.0), (1, 0.0)], "label int, logit double")
    assert metrics.bce_loss(df).first()[0] == pytest.approx(0.6931471805599453 / 3)
    for bad in [(7, 0.5), (None, 0.5), (1, None)]:
        with pytest.raises(Exception, match="not 0 or 1"):
            metrics.bce_loss(spark.createDataFrame([(1, 0.0), bad], "label int, logit double")).first()
    parts = spark.createDataFrame([(1.0, 3), (2.0, 1)], "v double, w int")
    assert metrics.weighted_average(parts, "v", "w").first()[0] == 1.25
    assert metrics.weighted_average(parts.where("false"), "v", "w").first()[0] is None
    assert metrics.weighted_average(parts.withColumn("w", F.lit(0)), "v", "w").first()[0] is None


@pytest.mark.parametrize("n", [1, 2, 5, 11, 40])
def test_percentiles_equal_sorting(spark, n):
    rng = random.Random(n)
    values = [round(rng.random() * 9, 1) for _ in range(n)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    assert percentiles.median(df, "v").first()[0] == statistics.median(values)
    for q in (0.0, 0.25, 0.5, 0.95, 1.0):
        index = min(n - 1, max(0, round((n - 1) * q)))
        assert percentiles.nearest_rank_percentile(df, "v", q).first()[0] == sorted(values)[index]
        up = min(n - 1, int((n - 1) * q + 0.5))
        got = percentiles.nearest_rank_percentile(df, "v", q, rounding="half_up").first()[0]
        assert got == sorted(values)[up]


def test_percentiles_of_any_spread_and_many_groups(spark, monkeypatch):
    rng = random.Random(4)
    spread = [rng.choice([-1, 1]) * 2.0 ** rng.uniform(-1074, 1023) for _ in range(300)]
    special = [0.0, -0.0, 5e-324, -5e-324, math.inf, -math.inf, math.nan, 1.0, math.nextafter(1.0, 2.0), math.nextafter(1.0, 0.0)]
    close = [1e9 + k * 2.0**-20 for k in rng.sample(range(10**6), 200)]
    groups = {"spread": spread + special, "close": close, None: [3.0], "ties": [7.0] * 50 + [8.0]}
    groups |= {f"g{k}": [rng.gauss(0, 10) for _ in range(rng.randrange(1, 9))] for k in range(200)}
    rows = [(g, v) for g, values in groups.items() for v in values] + [("ties", None), ("empty", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(3)
    order = lambda v: (math.isnan(v), v)
    for bound, divisions in ((1_000_000, 4096), (0, 7)):
        monkeypatch.setattr(percentiles, "BROADCAST_SEARCHES", bound)
        monkeypatch.setattr(percentiles, "DIVISIONS", divisions)
        for q in (0.0, 0.37, 0.95, 1.0) if bound else (0.37,):
            got = {r.g: r.percentile for r in percentiles.nearest_rank_percentile(df, "v", q, by=["g"]).collect()}
            assert got.keys() == groups.keys()
            for g, values in groups.items():
                want = sorted(values, key=order)[round((len(values) - 1) * q)]
                assert got[g] == want or math.isnan(got[g]) and math.isnan(want)


def test_percentiles_neither_sort_nor_use_windows(spark, monkeypatch):
    plans, staged = [], percentiles.stage

    def seen(df, name="stage", path=None):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return staged(df, name, path)

    monkeypatch.setattr(percentiles, "stage", seen)
    df = spark.range(5000).selectExpr("id % 3 g", "cast(id * 0.37 as double) v")
    result = percentiles.median(df, "v", by=["g"])
    result.collect()
    plans.append(result._jdf.queryExecution().executedPlan().toString())
    assert len(plans) > 2 and not any("Sort" in p or "Window" in p for p in plans)
    assert percentiles.median(df.where("false"), "v").first()[0] is None
