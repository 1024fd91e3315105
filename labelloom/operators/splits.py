"""Exact stratified splits: sizes per label are met to the row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.operators.ranking import order_key, rank_rows

PURPOSE = "split"


def _check_fraction(name: str, value: float) -> None:
    if not 0.0 < value < 1.0:
        raise ValueError(f"{name} must lie between 0 and 1")


def two_way_size(rows: int, val_fraction: float) -> int:
    """Validation rows of one label: rounded half to even, and train keeps one if it can."""
    return max(1, min(round(rows * val_fraction), rows - 1))


def three_way_sizes(rows: int, val_fraction: float, test_fraction: float) -> tuple[int, int]:
    """(test, val) rows of one label. If they would use it up, test then val give way."""
    test, val = (max(1, round(rows * f)) for f in (test_fraction, val_fraction))
    if test + val < rows:
        return test, val
    test = max(1, min(test, rows - 2))
    return test, max(1, min(val, rows - 1 - test))


def _assign(
    df: DataFrame, seed: int, sizes: Callable[[int], list[tuple[str, int]]]
) -> tuple[DataFrame, dict[str, dict[int, int]]]:
    """Cut each label's seeded order into named stretches; what is left is 'train'."""
    plan: dict[int, list[tuple[str, int]]] = {}

    def targets(counts):
        wanted = {}
        for (label,), rows in counts.items():
            end, stretches = 0, []
            for name, size in sizes(rows):
                end += size
                stretches.append((name, end))
            plan[label] = stretches
            wanted[label,] = [end for _, end in stretches]
        return wanted

    ranked = rank_rows(df, ["label"], order_key(df, seed, PURPOSE), targets)
    split = F
    for position in range(len(next(iter(plan.values()), []))):
        for label, stretches in sorted(plan.items()):
            name, end = stretches[position]
            split = split.when(ranked.within((label,), end), F.lit(name))
    column = F.lit("train") if split is F else split.otherwise(F.lit("train"))

    by_split: dict[str, dict[int, int]] = {}
    for label, stretches in plan.items():
        rows, start = ranked.counts[label,], 0
        for name, end in stretches:
            by_split.setdefault(name, {})[label] = min(end, rows) - min(start, rows)
            start = end
        by_split.setdefault("train", {})[label] = rows - min(start, rows)
    empty = [s for s, labels in by_split.items() if not sum(labels.values())]
    if empty or not plan:
        raise ValueError(f"the split leaves no rows in {empty or 'any split'}")

    return ranked.df.select(*df.columns, column.alias("split")), by_split


def split_two_way(
    df: DataFrame, val_fraction: float, seed: int
) -> tuple[DataFrame, dict[str, dict[int, int]]]:
    """Add ``split`` (train / val); also return the exact rows per split and label."""
    _check_fraction("val_fraction", val_fraction)
    return _assign(df, seed, lambda rows: [("val", two_way_size(rows, val_fraction))])


def split_three_way(
    df: DataFrame, val_fraction: float, test_fraction: float, seed: int
) -> tuple[DataFrame, dict[str, dict[int, int]]]:
    """Add ``split`` (train / val / test); also return the exact rows per split and label."""
    _check_fraction("val_fraction", val_fraction)
    _check_fraction("test_fraction", test_fraction)
    if val_fraction + test_fraction >= 1.0:
        raise ValueError("val_fraction and test_fraction must sum to less than 1")

    def sizes(rows):
        test, val = three_way_sizes(rows, val_fraction, test_fraction)
        return [("test", test), ("val", val)]

    return _assign(df, seed, sizes)


def label_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("label").agg(F.count(F.lit(1)).alias("rows"))


def label_count_map(df: DataFrame) -> DataFrame:
    """Label counts as one map with string keys, the form they have in metadata."""
    entry = F.struct(F.col("label").cast("string"), F.col("rows"))
    entries = F.array_sort(F.collect_list(entry))  # at most two rows
    return label_counts(df).agg(F.map_from_entries(entries).alias("label_counts"))


def split_label_counts(df: DataFrame) -> DataFrame:
    """Rows per split and label with sub-totals (NULL label) and the total (NULL split)."""
    return df.rollup("split", "label").agg(F.count(F.lit(1)).alias("rows"))
