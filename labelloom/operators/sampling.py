"""Exact balanced samples and their quotas."""

from __future__ import annotations

import heapq
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.operators.ranking import order_key, rank_rows

LABELS = (0, 1)
MIN_ROWS_PER_SPLIT = 2


def balanced_targets(counts: Mapping[int, int], max_rows: int) -> dict[int, int]:
    """Rows to take per label: half each, a short label's share going to the other."""
    if max_rows < 2:
        raise ValueError("a balanced sample needs max_rows of at least 2")
    if {label for label, n in counts.items() if n} != set(LABELS):
        raise ValueError("a balanced sample needs rows of both labels, 0 and 1")
    half = {0: max_rows // 2, 1: max_rows - max_rows // 2}
    spare = {label: max_rows - min(counts[1 - label], half[1 - label]) for label in LABELS}
    return {label: min(counts[label], spare[label]) for label in LABELS}


def balanced_sample(
    df: DataFrame, max_rows: int | None, seed: int, purpose: str = "sample"
) -> DataFrame:
    """At most ``max_rows`` rows, balanced over the labels. No cap, or a loose one: all rows."""
    if max_rows is None:
        return df

    def targets(counts):
        per_label = {key[0]: n for key, n in counts.items()}
        if max_rows >= sum(per_label.values()):
            return {key: [n] for key, n in counts.items()}
        return {(label,): [n] for label, n in balanced_targets(per_label, max_rows).items()}

    ranked = rank_rows(df, ["label"], order_key(df, seed, purpose), targets)
    if max_rows >= sum(ranked.counts.values()):
        return df
    return ranked.take().select(*df.columns)


def allocate_rows(sizes: Mapping[str, int], sample_rows: int) -> dict[str, int]:
    """Share ``sample_rows`` over splits in proportion to size, two rows each at least.

    Every split starts at its rounded-down share. What is over or short is settled one
    row at a time, always on the split furthest from its exact share. The rows that can
    be settled are listed per split with that distance, and the best ones are taken.
    """
    splits = list(sizes)
    if sample_rows < MIN_ROWS_PER_SPLIT * len(splits):
        raise ValueError(f"{len(splits)} splits need at least {MIN_ROWS_PER_SPLIT} rows each")
    small = [s for s in splits if sizes[s] < MIN_ROWS_PER_SPLIT]
    if small:
        raise ValueError(f"splits with fewer than {MIN_ROWS_PER_SPLIT} rows: {small}")

    total = sum(sizes.values())
    share = {s: sample_rows * sizes[s] / total for s in splits}
    rows = {s: min(sizes[s], max(MIN_ROWS_PER_SPLIT, int(share[s]))) for s in splits}
    excess = sum(rows.values()) - sample_rows
    if excess > 0:
        steps = [
            (rows[s] - i - share[s], rows[s] - i, -order, s)
            for order, s in enumerate(splits)
            for i in range(min(excess, rows[s] - MIN_ROWS_PER_SPLIT))
        ]
        change = -1
    else:
        steps = [
            (share[s] - rows[s] - i, sizes[s], -order, s)
            for order, s in enumerate(splits)
            for i in range(min(-excess, sizes[s] - rows[s]))
        ]
        change = 1
    if len(steps) < abs(excess):
        raise ValueError(f"cannot allocate {sample_rows} rows over {dict(sizes)}")
    for *_, s in heapq.nlargest(abs(excess), steps):
        rows[s] += change
    return rows


Counts = dict[str, dict[int, int]]


def presplit_sample(
    df: DataFrame,
    sample_rows: int | None,
    seed: int,
    splits: tuple[str, ...] = ("train", "val", "test"),
) -> tuple[DataFrame, dict[str, int] | None, Counts]:
    """Sample a table that already has a ``split`` column, balanced inside each split.

    All splits are ranked together in one pass; each has its own seed. Returns the
    sample, the allocation, which is None if the cap does not bind, and the rows per
    split and label.
    """
    seeds = F.lit(seed)
    for offset, split in enumerate(splits):
        seeds = F.when(F.col("split") == split, F.lit(seed + offset)).otherwise(seeds)
    allocation: dict[str, int] = {}
    taken: Counts = {}

    def targets(counts):
        per_split = {s: {y: counts.get((s, y), 0) for y in LABELS} for s in splits}
        sizes = {s: sum(per_label.values()) for s, per_label in per_split.items()}
        taken.update(per_split)
        if sample_rows is not None and sample_rows < sum(sizes.values()):
            allocation.update(allocate_rows(sizes, sample_rows))
            for s, rows in allocation.items():
                if rows < sizes[s]:
                    taken[s] = balanced_targets(per_split[s], rows)
        return {(s, y): [n] for s, per_label in taken.items() for y, n in per_label.items()}

    ranked = rank_rows(df, ["split", "label"], order_key(df, seeds, "sample"), targets)
    if not allocation:
        return df, None, taken
    return ranked.take().select(*df.columns), allocation, taken
