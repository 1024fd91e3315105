"""Writing corpora, reports and metadata."""

from __future__ import annotations

import json
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloom.operators.normalize import standard_columns
from labelloom.session import path_exists
from labelloom.sources.tabular import CSV_OPTIONS, STANDARD_SCHEMA

# The writer trims white space unless told not to, which would change texts.
CSV_WRITE = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
DATA, METADATA = "splits", "metadata"


def write_split_table(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """All columns, one directory per split."""
    writer = df.write.mode("overwrite").partitionBy("split")
    writer = writer.options(**CSV_WRITE) if fmt == "csv" else writer
    writer.format(fmt).save(f"{path}/{DATA}")


def write_corpus(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """The standard columns, one directory per split; reading the table whole gives "all"."""
    write_split_table(standard_columns(df, keep=["split"]), path, fmt)


def read_corpus(
    spark: SparkSession, path: str, split: str | None = None, fmt: str = "csv"
) -> DataFrame:
    """A written corpus: one split (only its directory is read), or all with ``split``."""
    reader = spark.read.schema(STANDARD_SCHEMA)
    reader = reader.options(**CSV_OPTIONS) if fmt == "csv" else reader
    stored = reader.format(fmt).load(f"{path}/{DATA}")
    df = standard_columns(stored, keep=["split"])  # CSV has no empty string, only NULL
    return df if split is None else df.where(F.col("split") == split).drop("split")


def write_json(spark: SparkSession, payload: dict[str, Any], path: str) -> None:
    """A small driver-side record (counts, settings) as indented JSON with sorted keys."""
    text = json.dumps(payload, indent=2, sort_keys=True)
    spark.range(1, numPartitions=1).select(F.lit(text)).write.mode("overwrite").text(path)


def read_json(spark: SparkSession, path: str) -> dict[str, Any]:
    lines = spark.read.text(path, wholetext=True).collect()
    return json.loads(lines[0]["value"])


def write_report(report: DataFrame, path: str) -> None:
    """A one-row report as JSON; NULL fields stay in the record."""
    writer = report.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false")
    writer.json(path)


def corpus_ready(spark: SparkSession, path: str) -> bool:
    """Data first, metadata last: both markers mean the build ran to its end."""
    return all(path_exists(spark, f"{path}/{part}/_SUCCESS") for part in (DATA, METADATA))


def ensure_corpus(
    spark: SparkSession,
    path: str,
    build: Callable[[], dict[str, Any]],
    rebuild: bool = False,
) -> dict[str, Any]:
    """Metadata of the corpus at ``path``; builds it if absent or if asked to."""
    if not rebuild and corpus_ready(spark, path):
        return read_json(spark, f"{path}/{METADATA}")
    return build()


def ensure_table(
    spark: SparkSession, path: str, build: Callable[[], DataFrame], rebuild: bool = False
) -> DataFrame:
    """The Parquet table at ``path``; written from ``build`` if absent or if asked to."""
    if rebuild or not path_exists(spark, f"{path}/_SUCCESS"):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
