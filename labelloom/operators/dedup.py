"""Exact de-duplication on narrow rows.

Rows are staged once with a digest of their text and a row number. All questions are then answered by a hash aggregation
over (digest, label, row number): how many copies a text has, which labels, and which row is the first. Texts are neither
sorted nor an exchange's key. A text copied over a third of the corpus leaves each map task as one narrow row.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from labelloom.operators.ranking import DIGEST, with_digest
from labelloom.session import stage

COPIES, MIN_LABEL, MAX_LABEL, FIRST, ROW = "_copies", "_min_label", "_max_label", "_first", "_row"
LOW, HIGH, PLACE, CONFLICT = "_low", "_high", "_place", "_conflict"
SHA = "_sha"
#: Repeated texts (a digest and two numbers each) that are sent to all tasks at most; more are joined by shuffle.
BROADCAST_GROUPS = 200_000
HOT_TEXTS = 10_000
HOT_COPIES = 1_000


@dataclass(frozen=True)
class Grouped:
    """Staged rows, and one narrow row per key: its copies, label range and the number of its first row."""

    rows: DataFrame
    groups: DataFrame
    keys: tuple[str, ...]
    columns: tuple[str, ...]
    repeated: int


def _same(left: str, right: str, keys: Sequence[str]) -> Column:
    """Equality of all keys, null with null."""
    return F.expr(" and ".join(f"{left}.`{k}` <=> {right}.`{k}`" for k in keys))


def _grouped(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> Grouped:
    """Rows of ``df`` by key, texts by their digest. The first row is the least by ``order_by``, then by the other columns.

    Most keys have one row, or rows that are alike, and the least row number settles them in the aggregation. Only rows
    of the other keys are put in order, without their texts; each task hands on one row per key.
    """
    rest = [c for c in df.columns if c not in keys]
    ranked = [c for c in order_by if c in rest]
    ordered = ranked + [c for c in rest if c not in ranked and c != DIGEST]
    narrow = [DIGEST if k == "text" else k for k in keys]
    rows = stage(with_digest(df).withColumn(ROW, F.monotonically_increasing_id()), "rows")
    content = F.xxhash64(*ordered) if ordered else F.lit(0).cast("long")
    labels = [F.min("label").alias(MIN_LABEL), F.max("label").alias(MAX_LABEL)] if "label" in df.columns else []
    counted = stage(
        rows.groupBy(*narrow).agg(
            F.count(F.lit(1)).alias(COPIES),
            F.min(ROW).alias(FIRST),
            F.min(content).alias(LOW),
            F.max(content).alias(HIGH),
            *labels,
        ),
        "groups",
    )
    differ = F.col(LOW) != F.col(HIGH)
    repeated, mixed = counted.agg(F.count_if(F.col(COPIES) > 1), F.count_if(differ)).first()
    if mixed:
        open_keys = counted.where(differ).select(*narrow)
        open_keys = F.broadcast(open_keys) if mixed <= BROADCAST_GROUPS else open_keys
        slim = rows.select(*narrow, *[c for c in ordered if c not in narrow and c != "text"], ROW)
        tried = slim.alias("r").join(open_keys.alias("k"), _same("r", "k", narrow), "left_semi")
        order = [c for c in ordered if c != "text"]
        best = F.row_number().over(Window.partitionBy(*narrow).orderBy(*order, ROW))
        chosen = tried.withColumn(PLACE, best).where(F.col(PLACE) == 1).select(*narrow, F.col(ROW).alias("_chosen"))
        joined = counted.alias("g").join(chosen.alias("c"), _same("g", "c", narrow), "left")
        rest_of = [F.col(f"g.{c}") for c in counted.columns if c != FIRST]
        counted = stage(joined.select(*rest_of, F.coalesce("_chosen", f"g.{FIRST}").alias(FIRST)), "groups")
    return Grouped(rows, counted, tuple(narrow), tuple(df.columns), repeated)


def _first_rows(grouped: Grouped, keep: Column, extra: Sequence[str] = ()) -> DataFrame:
    """The first row of each key of which ``keep`` holds; keys with one row always stay.

    Few repeated keys settle rows where they lie. Many are met by row number, which is unique, in one shuffle that
    hashes the narrow side and leaves the texts unsorted; that result is staged, so reading it again is a scan either way.
    """
    rows, columns = grouped.rows, [*grouped.columns, *extra]
    if not grouped.repeated:
        return rows.select(*columns)
    if grouped.repeated <= BROADCAST_GROUPS:
        first = F.when(keep, F.col(FIRST)).otherwise(-1).alias(FIRST)
        repeated = stage(grouped.groups.where(F.col(COPIES) > 1).select(*grouped.keys, first), "repeated")
        marked = rows.alias("r").join(F.broadcast(repeated).alias("g"), _same("r", "g", grouped.keys), "left")
        stays = F.col(FIRST).isNull() | (F.col(FIRST) == F.col(ROW))
        return marked.where(stays).select(*[F.col(f"r.`{c}`") for c in columns])
    kept = grouped.groups.where((F.col(COPIES) == 1) | keep).select(F.col(FIRST).alias(ROW))
    return stage(rows.join(kept.hint("shuffle_hash"), ROW, "left_semi").select(*columns), "first-rows")


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = (), *, digest: bool = False) -> DataFrame:
    """One row per key: the least by ``order_by``, then by the remaining columns. ``digest`` keeps the texts' digest."""
    grouped = _grouped(df, keys, order_by)
    return _first_rows(grouped, F.lit(True), [DIGEST] if digest and DIGEST not in df.columns else [])


def group_texts(df: DataFrame, order_by: Sequence[str] = ()) -> Grouped:
    """The texts of ``df`` with their copy count, label range and first row.

    Everything cross-source de-duplication needs comes from this one table: survivors,
    conflicts and both counters.
    """
    return _grouped(df, ["text"], order_by)


def survivors(grouped: Grouped, *, digest: bool = False) -> DataFrame:
    """Texts seen with one label only, each as its first row."""
    one_label = F.coalesce(F.col(MIN_LABEL) == F.col(MAX_LABEL), F.lit(False))
    rows = _first_rows(grouped, one_label, [DIGEST] if digest and DIGEST not in grouped.columns else [])
    return rows.where(F.col("label").isNotNull())


def dedup_counters(grouped: Grouped) -> DataFrame:
    """Rows removed for conflicting labels and rows removed as copies, in one row."""
    conflict = F.col(MIN_LABEL) != F.col(MAX_LABEL)
    return grouped.groups.agg(
        F.coalesce(F.sum(COPIES), F.lit(0)).alias("rows_before_cross_source_deduplication"),
        F.coalesce(F.sum(F.when(conflict, F.col(COPIES)).otherwise(0)), F.lit(0)).alias(
            "rows_with_conflicting_labels_removed"
        ),
        F.coalesce(F.sum(F.when(conflict, 0).otherwise(F.col(COPIES) - 1)), F.lit(0)).alias(
            "duplicate_text_rows_removed"
        ),
    )


def drop_duplicate_texts(df: DataFrame, order_by: Sequence[str] = (), *, digest: bool = False) -> DataFrame:
    return survivors(group_texts(df, order_by), digest=digest)


def drop_conflicts(df: DataFrame) -> DataFrame:
    """All rows of the texts that carry one label only, copies included.

    Labels are compared per digest, in a narrow staged table; the texts are read once, when the rows are staged. The rows
    then meet the conflicting digests in an anti join: few are sent to all tasks. Of many, those of very frequent texts
    still are (there can be at most ``HOT_TEXTS``), so no join task receives the copies of one text.
    """
    rows = stage(with_digest(df).withColumn(SHA, F.coalesce(DIGEST, F.lit(""))), "rows")  # null texts are one, too
    per_text = stage(
        rows.groupBy(SHA).agg(
            F.count(F.lit(1)).alias(COPIES), (F.min("label") != F.max("label")).alias(CONFLICT)
        ),
        "conflicts",
    )
    total, conflicts = per_text.agg(F.coalesce(F.sum(COPIES), F.lit(0)), F.count_if(CONFLICT)).first()
    if conflicts <= BROADCAST_GROUPS:
        gone = F.broadcast(per_text.where(CONFLICT).select(SHA))
        return rows.join(gone, SHA, "left_anti").select(*df.columns)
    frequent = F.col(COPIES) > total // HOT_TEXTS  # fewer than HOT_TEXTS can exceed this share
    hot = per_text.where(frequent & (F.col(COPIES) > HOT_COPIES)).select(SHA, CONFLICT)
    cold = per_text.where(CONFLICT).join(F.broadcast(hot), SHA, "left_anti").select(SHA)

    tagged = rows.join(F.broadcast(hot), SHA, "left")
    of_hot = tagged.where(~F.col(CONFLICT))
    of_cold = tagged.where(F.col(CONFLICT).isNull()).join(cold, SHA, "left_anti")
    return of_hot.unionByName(of_cold).select(*df.columns)


def split_leakage(df: DataFrame, split: str = "split") -> DataFrame:
    """How many texts, and rows of them, appear in more than one split.

    The staged digest of a text is used where there is one, and splits are compared as numbers, so that the grouping
    stays a hash aggregation over narrow rows.
    """
    text = F.col(DIGEST) if DIGEST in df.columns else F.sha2("text", 256)
    name = F.xxhash64(split)
    per_text = df.groupBy(text.alias(SHA)).agg(
        F.count(F.lit(1)).alias(COPIES), F.min(name).alias("_low"), F.max(name).alias("_high")
    )
    leaked = per_text.where(F.col("_low") != F.col("_high"))
    return leaked.agg(
        F.count(F.lit(1)).alias("leaked_texts"),
        F.coalesce(F.sum(COPIES), F.lit(0)).alias("leaked_rows"),
    )
