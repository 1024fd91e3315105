"""Exact percentiles by counting, digit by digit, as for order keys in ``ranking``.

Values are counted once. The first digit of a value is its sign and power of two; further digits divide the stretch between
the least and the largest value of the bucket that holds the rank. Each step is monotone in the value, so buckets are
in the order of their values however roundings fall. A search ends when its bucket holds one value: after six counts at
the latest for values of any spread, after one or two for most. No rows are sorted and no group is gathered: a group
has a few thousand buckets at most.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelloom.operators.rank_search import BUCKET, HELD, HIGH, LIST, LOW, N, RANK, bucket_list, holding, total
from labelloom.session import stage

#: Buckets into which the stretch of a search is divided.
DIVISIONS = 4096
#: Searches (one per group and rank) that are sent to all tasks at most; more are joined by shuffle.
BROADCAST_SEARCHES = 200_000
ALL, ID, VALUE = "_all", "_id", "_value"
STATE = tuple(f"{HELD}.{c}" for c in (RANK, LOW, HIGH))

Ranks = Callable[[Column], Sequence[Column]]


def power_of_two(value: Column) -> Column:
    """Sign and binary exponent as a number in the order of the values; NaN comes last."""
    size = F.floor(F.least(F.log2(F.abs(value)), F.lit(2000.0))) + 2000
    ordered = F.when(value > 0, size).when(value < 0, -size).otherwise(F.lit(0))
    return F.when(F.isnan(value), F.lit(9999)).otherwise(ordered).cast("long")


def division(value: Column) -> Column:
    """The part between _low and _high in which a value lies; the ends lie in different parts."""
    share = (value - F.col(LOW)) / (F.col(HIGH) - F.col(LOW))
    return F.least(F.floor(share * DIVISIONS), F.lit(DIVISIONS - 1)).cast("long")


def _counted(rows: DataFrame, keys: Sequence[str], bucket: Column, *more: Column) -> DataFrame:
    counts = rows.groupBy(*keys, bucket.alias(BUCKET)).agg(
        F.sum("n").alias(N), F.min(VALUE).alias("_least"), F.max(VALUE).alias("_most"), *more
    )
    return counts.withColumnsRenamed({"_least": LOW, "_most": HIGH})


def values_at(df: DataFrame, value: str, by: Sequence[str], ranks: Ranks) -> DataFrame:
    """(by, _0, _1, ...): for each group the values at the ranks, from 1, that ``ranks`` names for its number of values."""
    present = df.where(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias(VALUE))
    counts = present.groupBy(*by, VALUE).agg(F.count(F.lit(1)).alias("n"))
    counts = stage(counts.withColumn(ALL, F.lit(0)), "value-counts")
    keys = [ALL, *by]
    lists = _counted(counts, keys, power_of_two(F.col(VALUE))).groupBy(*keys).agg(bucket_list())
    wanted = ranks(total(F.col(LIST)))
    asked = F.array(*[F.struct(F.lit(i).alias(ID), r.cast("long").alias(RANK)) for i, r in enumerate(wanted)])
    searches = lists.select(*keys, LIST, F.explode(asked).alias("_asked")).select(*keys, LIST, "_asked.*")
    state = stage(searches.select(*keys, ID, holding()).select(*keys, ID, *STATE), "searches")
    while unsettled := state.where(F.col(LOW) < F.col(HIGH)).count():
        state = stage(_narrowed(state, counts, keys, unsettled), "searches")
    return state.groupBy(*by).agg(*[F.max(F.when(F.col(ID) == i, F.col(LOW))).alias(f"_{i}") for i in range(len(wanted))])


def _narrowed(state: DataFrame, counts: DataFrame, keys: Sequence[str], unsettled: int) -> DataFrame:
    """Each open search with the division of its stretch that holds its rank."""
    searches = state.where(F.col(LOW) < F.col(HIGH))
    searches = F.broadcast(searches) if unsettled <= BROADCAST_SEARCHES else searches
    same = F.expr(" and ".join(f"c.`{k}` <=> s.`{k}`" for k in keys))
    inside = F.col(VALUE).between(F.col(LOW), F.col(HIGH))
    met = counts.alias("c").join(searches.alias("s"), same & inside)
    met = met.select(*[F.col(f"c.`{k}`") for k in keys], ID, RANK, LOW, HIGH, VALUE, "n")
    lists = _counted(met, [*keys, ID, RANK], division(F.col(VALUE))).groupBy(*keys, ID, RANK).agg(bucket_list())
    found = lists.select(*keys, ID, holding()).select(*keys, ID, *STATE)
    return state.where(~(F.col(LOW) < F.col(HIGH))).unionByName(found)


def nearest_rank_percentile(
    df: DataFrame,
    value: str,
    q: float,
    by: Sequence[str] = (),
    rounding: str = "half_even",
    name: str = "percentile",
) -> DataFrame:
    """The sorted value at index round((n - 1) * q); ``rounding`` is half_even or half_up. NaN counts as the largest value."""

    def ranks(n: Column) -> list[Column]:
        position = (n - 1) * F.lit(float(q))
        index = F.bround(position, 0) if rounding == "half_even" else F.floor(position + 0.5)
        return [F.least(F.greatest(index, F.lit(0)), n - 1) + 1]

    return values_at(df, value, by, ranks).select(*by, F.col("_0").alias(name))


def median(df: DataFrame, value: str, by: Sequence[str] = (), name: str = "median") -> DataFrame:
    """The middle value, or the mean of the middle two."""
    middle = values_at(df, value, by, lambda n: [F.floor((n + 1) / 2), F.floor(n / 2) + 1])
    return middle.select(*by, ((F.col("_0") + F.col("_1")) / 2).alias(name))
