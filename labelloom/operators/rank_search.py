"""Which bucket holds a rank: the step that searches for exact ranks have in common.

Rows are counted per bucket of an order-preserving code, and the next count looks only into the bucket that holds the rank.
A key has a bounded number of buckets, so its counts are one sorted array, searched where it lies: no window, no sort
of rows, and nothing but the bucket found leaves the executors.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BUCKET, N, LOW, HIGH, RANK = "_bucket", "_n", "_low", "_high", "_rank"
LIST, HELD = "_list", "_held"


def bucket_list() -> Column:
    """The buckets of a key in order; an aggregate over rows (_bucket, _n, _low, _high)."""
    return F.array_sort(F.collect_list(F.struct(BUCKET, N, LOW, HIGH))).alias(LIST)


def total(buckets: Column) -> Column:
    return F.aggregate(buckets, F.lit(0).cast("long"), lambda upto, b: upto + b[N])


def holding(rank: str = RANK, buckets: str = LIST) -> Column:
    """The bucket that holds a rank (from 1): a struct of _rank, which counts inside it, _bucket, _n, _low and _high."""
    start = F.struct(F.lit(0).cast("long").alias("upto"), F.lit(0).alias("passed"), F.lit(False).alias("found"))

    def step(state: Column, bucket: Column) -> Column:
        further = F.struct(
            (state["upto"] + bucket[N]).alias("upto"), (state["passed"] + 1).alias("passed"), F.lit(False).alias("found")
        )
        here = F.struct(state["upto"].alias("upto"), state["passed"].alias("passed"), F.lit(True).alias("found"))
        inside = state["found"] | (state["upto"] + bucket[N] >= F.col(rank))
        return F.when(inside, here).otherwise(further)

    place = F.aggregate(buckets, start, step)
    held = F.get(F.col(buckets), place["passed"])
    inner = (F.col(rank) - place["upto"]).alias(RANK)
    return F.struct(inner, *[held[c].alias(c) for c in (BUCKET, N, LOW, HIGH)]).alias(HELD)
