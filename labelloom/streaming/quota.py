"""Quota sampling of a stream: read files until every label has its rows, then stop."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelloom.functions.text import not_blank
from labelloom.operators.normalize import project
from labelloom.operators.ranking import order_key, rank_rows, with_digest
from labelloom.session import drop, new_path, path_exists, stage

POLL_SECONDS = 0.2


@dataclass(frozen=True)
class StreamSource:
    """Parquet files read as a stream, a bounded number of files per batch.

    ``path`` is a folder or a pattern. ``prepare`` may shape the raw rows, for instance
    to derive the label column.
    """

    path: str
    max_files_per_batch: int = 64
    schema: T.StructType | None = None
    prepare: Callable[[DataFrame], DataFrame] | None = None

    def open(self, spark: SparkSession) -> DataFrame:
        schema = self.schema or spark.read.option("mergeSchema", "true").parquet(self.path).schema
        reader = spark.readStream.schema(schema)
        rows = reader.option("maxFilesPerTrigger", self.max_files_per_batch).parquet(self.path)
        return self.prepare(rows) if self.prepare else rows


def balanced_quota(sample_rows: int | None) -> dict[int, int] | None:
    """Half of the rows for each label; None, for no cap, stays None: every row is wanted."""
    if sample_rows is None:
        return None
    if sample_rows < 2:
        raise ValueError("a balanced stream sample needs at least 2 rows")
    return {0: sample_rows // 2, 1: sample_rows - sample_rows // 2}


def stream_rows(
    df: DataFrame, literals: Mapping[str, str], *, label_first: bool = False
) -> DataFrame:
    """Text, label and literal provenance; the stream's own metadata is not carried over.

    Blank texts are skipped before their label counts as invalid, or after it with
    ``label_first``. Rows with an invalid label keep it as NULL, for the caller to reject.
    """
    rows = project(df).select("text", "label")
    present = not_blank(F.col("text"))
    kept = rows.where(present | F.col("label").isNull() if label_first else present)
    return kept.select("*", *[F.lit(v).alias(k) for k, v in literals.items()])


class QuotaSink:
    """Accepts micro-batches until the quota is met.

    A batch is written under its own id, and what earlier batches took is known from
    their directories. Running a batch again therefore takes the same rows and replaces
    them, so a restart from the checkpoint loses and doubles nothing. The directories
    are read at the first batch of a run, and again only if a batch repeats.
    """

    def __init__(self, spark: SparkSession, path: str, quota: Mapping[int, int] | None, seed: int):
        self.spark, self.path, self.seed = spark, path, seed
        self.quota = None if quota is None else dict(quota)
        self.full = quota is not None and not any(quota.values())
        self.error: str | None = None
        self._last_batch: int | None = None
        self._counts: dict[int, int] = {}

    def _batch_path(self, batch_id: int) -> str:
        return f"{self.path}/batch={batch_id}"

    def taken(self, before: int | None = None) -> dict[int, int]:
        """Rows per label in the sink, of the batches before ``before`` if given."""
        counts = dict.fromkeys(self.quota or (), 0)
        if not path_exists(self.spark, self.path):
            return counts
        rows = self.spark.read.parquet(self.path)
        if before is not None:
            rows = rows.where(F.col("batch") < before)
        for row in rows.groupBy("label").count().collect():
            counts[row["label"]] = row["count"]
        return counts

    def write(self, batch: DataFrame, batch_id: int) -> None:
        if self.full or self.error:
            return
        staged = new_path(self.spark, "batch")
        try:
            self._take(stage(with_digest(batch), "batch", staged), batch.columns, batch_id)
        finally:
            drop(self.spark, staged)

    def _take(self, rows: DataFrame, columns: list[str], batch_id: int) -> None:
        if not rows.where(F.col("label").isNull()).isEmpty():
            self.error = "the stream holds a label that is not binary"
            return
        if self.quota is None:
            rows.select(*columns).write.mode("overwrite").parquet(self._batch_path(batch_id))
            return
        if self._last_batch is None or batch_id <= self._last_batch:
            self._counts = self.taken(before=batch_id)
        already = self._counts
        open_quota = {label: self.quota[label] - already[label] for label in self.quota}

        def targets(counts):
            return {(label,): [n] for label, n in open_quota.items() if (label,) in counts}

        ranked = rank_rows(rows, ["label"], order_key(rows, self.seed, "stream"), targets)
        ranked.take().select(*columns).write.mode("overwrite").parquet(
            self._batch_path(batch_id)
        )
        got = {label: min(n, ranked.counts.get((label,), 0)) for label, n in open_quota.items()}
        self._counts = {label: already[label] + got[label] for label in got}
        self._last_batch = batch_id
        self.full = self._counts == self.quota


def collect_quota(
    spark: SparkSession,
    source: StreamSource,
    quota: Mapping[int, int] | None,
    seed: int,
    literals: Mapping[str, str],
    *,
    label_first: bool = False,
    output: str | None = None,
) -> DataFrame:
    """Exactly ``quota[label]`` rows per label from the stream, in arrival order of batches.

    Inside a batch a seeded order decides. Copies count against the quota, as they arrive.
    Raises if the stream ends first. Without a quota (None) all rows of the stream are collected. A run that ended early goes
    on from its last batch if it is given the same ``output``.
    """
    output = output or new_path(spark, "quota")
    rows = stream_rows(source.open(spark), literals, label_first=label_first)
    sink = QuotaSink(spark, f"{output}/rows", quota, seed)
    if not sink.full:
        query = (
            rows.writeStream.foreachBatch(sink.write)
            .option("checkpointLocation", f"{output}/progress")
            .trigger(availableNow=True)
            .start()
        )
        while not query.awaitTermination(POLL_SECONDS):
            if sink.full or sink.error:
                query.stop()
                break
    if sink.error:
        raise ValueError(sink.error)
    if quota is None:
        if not path_exists(spark, f"{output}/rows"):
            return spark.createDataFrame([], rows.schema)
        return spark.read.schema(rows.schema).parquet(f"{output}/rows")
    taken = sink.taken()
    if taken != dict(quota):
        raise RuntimeError(f"the stream ended with {taken} rows, wanted {dict(quota)}")
    if sink.full and not any(quota.values()):
        return spark.createDataFrame([], rows.schema)
    return spark.read.parquet(f"{output}/rows").drop("batch")
