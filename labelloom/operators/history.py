"""Operators over training histories and run results: one row per epoch or run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelloom.operators.metrics import weighted_average

# Which metrics share a training curve.
SERIES = {
    "loss": ("train_loss", "val_loss"),
    "ranking": ("roc_auc", "pr_auc"),
    "threshold": ("precision", "recall", "f1"),
}
# The metrics of the results table; True where smaller is better.
LEADERBOARD = {
    "roc_auc": False,
    "pr_auc": False,
    "f1": False,
    "precision": False,
    "recall": False,
    "brier_score": True,
}


def history_column(monitor: str) -> str:
    """The history column behind a monitor name such as ``val_roc_auc``."""
    if monitor in ("val_loss", "val_loss_epoch"):
        return "val_loss"
    return monitor.removeprefix("val_")


def epoch_loss(batches: DataFrame, by: Sequence[str] = ("epoch",), name: str = "loss") -> DataFrame:
    """Batch losses to one loss per epoch, weighted by batch size."""
    return weighted_average(batches, "loss", "batch_size", by, name)


def best_epoch(
    history: DataFrame, monitor: str, mode: str = "max", by: Sequence[str] = ()
) -> DataFrame:
    """The epoch with the best monitored value, the earliest on ties.

    Without any usable value the last epoch is returned, without history no row. One
    aggregation with partial results; nothing is sorted.
    """
    column = history_column(monitor)
    record, epoch = F.struct(*history.columns), F.col("epoch")
    best = F.max_by(record, epoch)
    if column in history.columns and isinstance(history.schema[column].dataType, T.NumericType):
        value = F.col(column).cast("double")
        signed = -value if mode == "min" else value
        key = F.when(value.isNotNull(), F.struct(signed.alias("v"), (-epoch).alias("e")))
        best = F.coalesce(F.max_by(record, key), best)
    chosen = history.groupBy(*by).agg(best.alias("_best"))
    return chosen.where(F.col("_best").isNotNull()).select("_best.*")


def _long(df: DataFrame, ids: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    numeric = [
        m for m in metrics if m in df.columns and isinstance(df.schema[m].dataType, T.NumericType)
    ]
    values = [F.col(m).cast("double").alias(m) for m in numeric]
    return df.select(*ids, *values).unpivot(list(ids), numeric, "metric", "value")


def training_series(history: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The points of the three training curves; missing values have no point."""
    group = F.create_map(*[F.lit(x) for g, ms in SERIES.items() for m in ms for x in (m, g)])
    metrics = [m for ms in SERIES.values() for m in ms]
    points = _long(history, [*by, "epoch"], metrics).where(F.col("value").isNotNull())
    return points.select(*by, group[F.col("metric")].alias("series"), "epoch", "metric", "value")


def loggable_metrics(report: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Numeric, present metrics as (name, value) rows, named as validation metrics."""
    metrics = [c for c in report.columns if c not in by]
    present = _long(report, by, metrics).where(F.col("value").isNotNull())
    return present.select(*by, F.concat(F.lit("val_"), "metric").alias("metric"), "value")


def leaderboard(
    runs: DataFrame,
    run: str = "run",
    family: str = "family",
    metrics: dict[str, bool] | None = None,
) -> DataFrame:
    """The best value of every metric per model family, and the first run that reached it."""
    metrics = LEADERBOARD if metrics is None else metrics
    entries = _long(runs, [family, run], list(metrics)).where(F.col("value").isNotNull())
    lower = [m for m, smaller in metrics.items() if smaller]
    cost = F.when(F.col("metric").isin(lower), F.col("value")).otherwise(-F.col("value"))
    best = F.min(F.struct(cost.alias("cost"), F.col(run), F.col("value")))
    return (
        entries.groupBy(family, "metric")
        .agg(best.alias("_best"))
        .select(family, "metric", f"_best.{run}", "_best.value")
    )
