"""Source rows to the common shape: clean text, 0/1 label, string metadata."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelloom.functions.text import clean_metadata, clean_text, not_blank, parse_label
from labelloom.operators.columns import (
    LABEL_COLUMNS,
    METADATA_COLUMNS,
    STANDARD_COLUMNS,
    TEXT_COLUMNS,
    exact,
    label_column,
    pick_from_map,
    text_column,
)
from labelloom.operators.dedup import keep_first


def project(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Resolve text and label, clean both, carry the known metadata columns as strings.

    ``keep`` names further columns to pass through untouched, such as a row id.
    Labels that cannot be read become NULL; nothing is filtered here.
    """
    text, label = text_column(df), label_column(df)
    return df.select(
        clean_text(exact(text)).alias("text"),
        parse_label(exact(label), df.schema[label].dataType).alias("label"),
        *[clean_metadata(exact(c)).alias(c) for c in METADATA_COLUMNS if c in df.columns],
        *[exact(c) for c in keep],
    )


def project_map_rows(df: DataFrame, row: str, *literals: Column) -> DataFrame:
    """``project`` for a ``MAP<STRING, STRING>`` column whose keys differ between rows."""
    return df.select(
        clean_text(pick_from_map(F.col(row), TEXT_COLUMNS)).alias("text"),
        parse_label(pick_from_map(F.col(row), LABEL_COLUMNS), T.StringType()).alias("label"),
        *literals,
    )


def usable_rows(df: DataFrame, order_by: Sequence[str] = ()) -> DataFrame:
    """Projected rows with a text. Unreadable labels stay, as NULL, whatever the text."""
    rows = project(df, keep=[c for c in order_by if c not in METADATA_COLUMNS])
    return rows.where(not_blank(F.col("text")) | F.col("label").isNull())


def normalize(df: DataFrame, order_by: Sequence[str] = (), *, digest: bool = False) -> DataFrame:
    """Project, drop blank texts, keep the first row of every (text, label).

    ``order_by`` defines "first"; remaining ties go to the smallest metadata values, so
    the result does not depend on partitioning. Rows with an unreadable label stay, with
    a NULL label, until ``validate`` or ``quarantine`` has seen them. The result scans a staged table;
    ``digest`` keeps the digest of the texts it was staged with.
    """
    extra = [c for c in order_by if c not in METADATA_COLUMNS]
    return keep_first(usable_rows(df, order_by), ["text", "label"], order_by, digest=digest).drop(*extra)


def normalize_splits(
    frames: Mapping[str, DataFrame], order_by: Sequence[str] = (), *, digest: bool = False
) -> DataFrame:
    """``normalize`` within each of several splits, as one table with a ``split`` column."""
    extra = [c for c in order_by if c not in METADATA_COLUMNS]
    tagged = [
        usable_rows(df, order_by).withColumn("split", F.lit(split)) for split, df in frames.items()
    ]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    return keep_first(rows, ["split", "text", "label"], order_by, digest=digest).drop(*extra)


@dataclass(frozen=True)
class Profile:
    """What one aggregation pass learned about a normalised table."""

    rows: int
    invalid_labels: int
    label_counts: dict[int, int]
    has_value: dict[str, bool]

    @property
    def both_labels(self) -> bool:
        return sum(1 for n in self.label_counts.values() if n > 0) == 2


PROVENANCE = ("source_dataset", "source_detail", "source_license")


def _facts(df: DataFrame) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("label").isNull()).alias("invalid"),
        F.count_if(F.col("label") == 0).alias("human"),
        F.count_if(F.col("label") == 1).alias("generated"),
        *[
            F.coalesce(F.bool_or(F.col(c) != ""), F.lit(False)).alias(f"has_{c}")
            for c in PROVENANCE
            if c in df.columns
        ],
    ]


def _as_profile(row) -> Profile:
    return Profile(
        rows=row["rows"],
        invalid_labels=row["invalid"],
        label_counts={0: row["human"], 1: row["generated"]},
        has_value={c: row[f"has_{c}"] for c in PROVENANCE if f"has_{c}" in row},
    )


def profile(df: DataFrame) -> Profile:
    """Row, label and provenance facts in a single pass over narrow columns."""
    return _as_profile(df.agg(*_facts(df)).first())


def profile_splits(df: DataFrame) -> dict[str, Profile]:
    """``profile`` of every split in the same single pass."""
    rows = df.groupBy("split").agg(*_facts(df)).collect()
    return {row["split"]: _as_profile(row) for row in rows}


def validate(facts: Profile, *, require_binary: bool = True) -> None:
    if facts.invalid_labels:
        raise ValueError(f"{facts.invalid_labels} rows have a label that is not binary")
    if facts.rows == 0:
        raise ValueError("no usable rows after normalisation")
    if require_binary and not facts.both_labels:
        raise ValueError("both labels, human and generated, must occur")


def quarantine(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split into usable rows and rows whose label could not be read."""
    return df.where(F.col("label").isNotNull()), df.where(F.col("label").isNull())


def default_provenance(
    df: DataFrame, facts: Profile, defaults: dict[str, str], *, url: bool = False
) -> DataFrame:
    """Fill a provenance column only where it is missing or blank on every row."""
    filled = df
    for name, value in defaults.items():
        if not facts.has_value.get(name, False):
            filled = filled.withColumn(name, F.lit(value))
    if url and "upstream_url" not in df.columns:
        filled = filled.withColumn("upstream_url", F.lit(""))
    return filled


def default_split_provenance(
    df: DataFrame, facts: Mapping[str, Profile], defaults: Mapping[str, str]
) -> DataFrame:
    """``default_provenance`` decided for each split on its own."""
    filled = df
    for name, value in defaults.items():
        current = F.coalesce(F.col(name), F.lit("")) if name in df.columns else F.lit("")
        blank = [split for split, f in facts.items() if not f.has_value.get(name, False)]
        filled = filled.withColumn(
            name, F.when(F.col("split").isin(blank), F.lit(value)).otherwise(current)
        )
    return filled


def tag_split(df: DataFrame, split: str) -> DataFrame:
    return df.withColumn("source_split", F.lit(split))


def standard_columns(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Exactly the output columns, in order; absent or NULL metadata becomes ''."""

    def column(name: str) -> Column:
        if name in ("text", "label"):
            return F.col(name)
        return (F.coalesce(F.col(name), F.lit("")) if name in df.columns else F.lit("")).alias(name)

    return df.select(*[column(c) for c in STANDARD_COLUMNS], *keep)
