"""Ranking, threshold and calibration metrics over ``(label, score)`` rows.

Every metric takes optional ``by`` columns and returns one row per group. The ranking
metrics share one table, the running confusion counts per distinct score; a whole
report is a single aggregation over it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelloom.functions.text import ratio_or_zero
from labelloom.operators.cumulative import quantile_cuts, running_totals
from labelloom.session import stage

DEFAULT_THRESHOLD = 0.5


def check_scored(df: DataFrame) -> None:
    """Raise if a row lacks its label or score, or the label is not binary."""
    bad = df.agg(
        F.count_if(F.col("label").isNull() | F.col("score").isNull()).alias("missing"),
        F.count_if(~F.col("label").isin(0, 1)).alias("not_binary"),
    ).first()
    if bad["missing"] or bad["not_binary"]:
        raise ValueError(
            f"{bad['missing']} rows lack a label or score, {bad['not_binary']} labels are not 0 or 1"
        )


def checked(df: DataFrame, score: str = "score") -> DataFrame:
    """``df`` with the checks of ``check_scored`` in its label column: they run in whatever pass reads it."""
    fine = F.coalesce(F.col("label").isin(0, 1), F.lit(False)) & F.col(score).isNotNull()
    wrong = F.raise_error(F.lit("a row lacks its label or score, or its label is not 0 or 1"))
    label = F.when(fine, F.col("label")).otherwise(wrong.cast(df.schema["label"].dataType))
    return df.withColumn("label", label)


def score_counts(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Positives and negatives per distinct score."""
    return checked(df).groupBy(*by, F.col("score").cast("double").alias("score")).agg(
        F.count_if(F.col("label") == 1).alias("pos"),
        F.count_if(F.col("label") == 0).alias("neg"),
    )


def running_confusion(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per distinct score: its own and the running positives / negatives at or above it."""
    counts = stage(score_counts(df, by), "score-counts")
    return running_totals(counts, "score", ["pos", "neg"], quantile_cuts(counts, "score"), by, descending=True)


def _precision(tp: Column, fp: Column) -> Column:
    return ratio_or_zero(tp, tp + fp)


def _f1(precision: Column, recall: Column) -> Column:
    return ratio_or_zero(2 * precision * recall, precision + recall)


def _roc_auc() -> Column:
    """Pairs ranked right, ties half, over all pairs; doubled so that the sum stays whole.

    The sum is at most twice the number of pairs. Where that fits, 64-bit integers are
    used, beyond it decimals: exact in both cases.
    """
    pairs = F.col("pos_total").cast("double") * F.col("neg_total")
    fits = pairs < 4e18
    pos, neg, above = F.col("pos"), F.col("neg"), F.col("pos_running") - F.col("pos")
    narrow = F.sum(F.when(fits, neg * (2 * above + pos)))
    wide = F.sum(
        F.when(~fits, neg.cast("decimal(19,0)") * (2 * above + pos).cast("decimal(19,0)"))
    )
    doubled = F.coalesce(narrow.cast("double"), wide.cast("double"))
    return F.when(F.max(pairs) > 0, doubled / (2 * F.max(pairs)))


def _pr_auc() -> Column:
    step = F.col("pos") * _precision(F.col("pos_running"), F.col("neg_running"))
    return F.when(F.max("pos_total") > 0, F.sum(step) / F.max("pos_total"))


def _brier() -> Column:
    error = F.col("pos") * F.pow(F.col("score") - 1, F.lit(2)) + F.col("neg") * F.pow("score", F.lit(2))
    return F.sum(error) / F.sum(F.col("pos") + F.col("neg"))


def _best_candidate() -> Column:
    """The best (F1, precision, recall) over the distinct scores, lowest score on ties."""
    tp, fp, positives = F.col("pos_running"), F.col("neg_running"), F.col("pos_total")
    precision, recall = _precision(tp, fp), ratio_or_zero(tp, positives)
    return F.max(
        F.struct(
            _f1(precision, recall).alias("f1"),
            precision.alias("precision"),
            recall.alias("recall"),
            (-F.col("score")).alias("negated"),
            tp.alias("tp"),
            fp.alias("fp"),
        )
    )


def _fixed_candidate(threshold: Column) -> list[Column]:
    at = F.col("score") >= threshold
    return [
        F.coalesce(F.sum(F.when(at, F.col("pos"))), F.lit(0)).alias("_tp"),
        F.coalesce(F.sum(F.when(at, F.col("neg"))), F.lit(0)).alias("_fp"),
        F.coalesce(F.max("pos_total"), F.lit(0)).alias("_positives"),
        F.coalesce(F.max("neg_total"), F.lit(0)).alias("_negatives"),
    ]


def classification_report(
    df: DataFrame, threshold: float | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """ROC-AUC, average precision, Brier score, threshold, its metrics and its counts.

    Without ``threshold`` the one with the best F1 is used. Undefined values are NULL.
    """
    totals = running_confusion(df, by)
    fixed = F.lit(float(DEFAULT_THRESHOLD if threshold is None else threshold))
    summed = totals.groupBy(*by).agg(
        _roc_auc().alias("roc_auc"),
        _pr_auc().alias("pr_auc"),
        _brier().alias("brier_score"),
        _best_candidate().alias("_best"),
        *_fixed_candidate(fixed),
    )
    precision = _precision(F.col("_tp"), F.col("_fp"))
    recall = ratio_or_zero(F.col("_tp"), F.col("_positives"))
    own = F.struct(
        _f1(precision, recall).alias("f1"), precision.alias("precision"), recall.alias("recall")
    )
    summed = summed.withColumn("_own", own)
    if threshold is None:
        # The fixed candidate comes last: it wins only by being strictly better.
        best = F.struct("_best.f1", "_best.precision", "_best.recall")
        swept = F.col("_best").isNotNull() & ~(F.col("_own") > best)
    else:
        swept = F.lit(False)

    def pick(from_sweep: Column, from_fixed: Column) -> Column:
        return F.when(swept, from_sweep).otherwise(from_fixed)

    tp = pick(F.col("_best.tp"), F.col("_tp"))
    fp = pick(F.col("_best.fp"), F.col("_fp"))
    return summed.select(
        *by,
        "roc_auc",
        "pr_auc",
        "brier_score",
        pick(-F.col("_best.negated"), fixed).alias("threshold"),
        pick(F.col("_best.precision"), F.col("_own.precision")).alias("precision"),
        pick(F.col("_best.recall"), F.col("_own.recall")).alias("recall"),
        pick(F.col("_best.f1"), F.col("_own.f1")).alias("f1"),
        tp.alias("true_positive"),
        fp.alias("false_positive"),
        (F.col("_negatives") - fp).alias("true_negative"),
        (F.col("_positives") - tp).alias("false_negative"),
    )


def roc_auc(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return running_confusion(df, by).groupBy(*by).agg(_roc_auc().alias("roc_auc"))


def pr_auc(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Average precision by step; rows of one score enter together."""
    return running_confusion(df, by).groupBy(*by).agg(_pr_auc().alias("pr_auc"))


def precision_recall_curve(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Running counts, precision, recall and the recall gained at every distinct score."""
    tp, fp, positives = F.col("pos_running"), F.col("neg_running"), F.col("pos_total")
    return running_confusion(df, by).select(
        *by,
        "score",
        tp.alias("true_positive"),
        fp.alias("false_positive"),
        _precision(tp, fp).alias("precision"),
        ratio_or_zero(tp, positives).alias("recall"),
        ratio_or_zero(F.col("pos"), positives).alias("recall_delta"),
    )


def mid_ranks(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The average ascending rank shared by the rows of each distinct score, and their number."""
    counts = score_counts(df, by).select(*by, "score", (F.col("pos") + F.col("neg")).alias("n"))
    counts = stage(counts, "score-counts")
    totals = running_totals(counts, "score", ["n"], quantile_cuts(counts, "score"), by)
    first = F.col("n_running") - F.col("n") + 1
    return totals.select(*by, "score", "n", ((first + F.col("n_running")) / 2).alias("mid_rank"))


def best_threshold(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return classification_report(df, by=by).select(*by, "threshold", "f1", "precision", "recall")


def confusion_counts(df: DataFrame, threshold: float, by: Sequence[str] = ()) -> DataFrame:
    """The four counts at ``score >= threshold``, in one aggregation."""
    above, positive = F.col("score") >= threshold, F.col("label") == 1
    return checked(df).groupBy(*by).agg(
        F.count_if(above & positive).alias("true_positive"),
        F.count_if(above & ~positive).alias("false_positive"),
        F.count_if(~above & ~positive).alias("true_negative"),
        F.count_if(~above & positive).alias("false_negative"),
    )


def threshold_metrics(df: DataFrame, threshold: float, by: Sequence[str] = ()) -> DataFrame:
    tp, fp, fn = F.col("true_positive"), F.col("false_positive"), F.col("false_negative")
    precision, recall = _precision(tp, fp), ratio_or_zero(tp, tp + fn)
    return confusion_counts(df, threshold, by).select(
        *by,
        precision.alias("precision"),
        recall.alias("recall"),
        _f1(precision, recall).alias("f1"),
    )


def brier_score(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    error = F.col("score") - F.col("label")
    return checked(df).groupBy(*by).agg(F.avg(error * error).alias("brier_score"))


def bce_loss(df: DataFrame, logit: str = "logit", by: Sequence[str] = ()) -> DataFrame:
    """Mean binary cross-entropy from logits, in the form that cannot overflow."""
    x, y = F.col(logit), F.col("label")
    loss = F.greatest(x, F.lit(0.0)) - x * y + F.log1p(F.exp(-F.abs(x)))
    return checked(df, logit).groupBy(*by).agg(F.avg(loss).alias("bce_loss"))


def weighted_average(
    df: DataFrame, value: str, weight: str, by: Sequence[str] = (), name: str = "weighted_average"
) -> DataFrame:
    """NULL for no rows or no weight."""
    total = F.sum(weight)
    return df.groupBy(*by).agg(
        F.when(total != 0, F.sum(F.col(value) * F.col(weight)) / total).alias(name)
    )
