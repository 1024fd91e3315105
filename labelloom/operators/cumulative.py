"""Running totals over a value order, without a global window.

Values are first grouped, so equal ones travel as one row. The groups are then cut into
buckets of similar size at approximate quantiles; each bucket is summed on its own and
shifted by the total of the buckets before it. Where a cut lies changes only the balance,
never the result.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

ACCURACY = 1_000
SKETCH_GROUPS = 64


def quantile_cuts(df: DataFrame, value: str, buckets: int | None = None) -> list[float]:
    """At most ``buckets - 1`` strictly increasing values that cut the rows about evenly.

    Take them from the grouped table, with a row per distinct value: that is what the buckets sort. By default there is
    a bucket for each shuffle partition.
    Sketches of the input tasks are merged in 64 groups, whose quantiles are then cut
    again: no single task has to merge the sketches of all input tasks.
    """
    buckets = buckets or max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    shares = [i / buckets for i in range(1, buckets)] or [0.5]
    sketch = F.percentile_approx(F.col(value), shares, max(ACCURACY, 4 * buckets))
    groups = df.groupBy((F.spark_partition_id() % SKETCH_GROUPS).alias("_group"))
    merged = groups.agg(sketch.alias("_cuts")).select(F.explode("_cuts").alias(value))
    quantiles = merged.agg(sketch).first()[0] or []
    return sorted({q for q in quantiles if math.isfinite(q)})


def running_totals(
    grouped: DataFrame,
    value: str,
    measures: Sequence[str],
    cuts: Sequence[float],
    by: Sequence[str] = (),
    descending: bool = False,
) -> DataFrame:
    """Add ``<m>_running`` (through this value) and ``<m>_total`` for each measure.

    ``grouped`` has one row per (by, value); both uses of it share one shuffle. Offsets per bucket are at most
    ``len(cuts) + 2`` rows per group; they are broadcast only when there is one group.
    """
    edges = [float("-inf"), *(cuts or [0.0]), float("inf")]
    bucketed = (
        Bucketizer(splits=edges, inputCol=value, outputCol="_bucket", handleInvalid="keep")
        .transform(grouped.where(F.col(value).isNotNull()))
        .withColumn("_bucket", F.col("_bucket").cast("int"))
    )

    before = F.desc("_bucket") if descending else F.asc("_bucket")
    whole = W.partitionBy(*by)
    preceding = whole.orderBy(before).rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        bucketed.groupBy(*by, "_bucket")
        .agg(*[F.sum(m).alias(m) for m in measures])
        .select(
            *[F.col(c).alias(f"_by_{c}") for c in by],
            F.col("_bucket").alias("_at"),
            *[F.coalesce(F.sum(m).over(preceding), F.lit(0)).alias(f"_{m}_before") for m in measures],
            *[F.sum(m).over(whole).alias(f"{m}_total") for m in measures],
        )
    )
    same = reduce(
        lambda a, b: a & b,
        (F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by),
        F.col("_bucket") == F.col("_at"),
    )
    local = W.partitionBy(*by, "_bucket").orderBy(F.desc(value) if descending else F.asc(value))
    # Every bucket has its offset. A left join keeps the optimizer from adding a filter on
    # one side only, which would stop the two sides from sharing the grouped shuffle.
    return bucketed.join(offsets if by else F.broadcast(offsets), same, "left").select(
        *by,
        value,
        *measures,
        *[
            (F.col(f"_{m}_before") + F.sum(m).over(local.rowsBetween(W.unboundedPreceding, 0))).alias(
                f"{m}_running"
            )
            for m in measures
        ],
        *[f"{m}_total" for m in measures],
    )
