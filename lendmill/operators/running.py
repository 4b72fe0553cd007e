"""Running totals and ranks over a globally ordered key.

A window without a partition key moves the whole table into one task. Here the rows are range
partitioned by the key, each range gets its own window, and a table of range totals (one row per
range) supplies the offsets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendmill.session import materialize


def running_totals(df: DataFrame, key: str, totals: dict[str, str], by: Sequence[str] = (), descending: bool = False) -> DataFrame:
    """Add {output: running sum of column} ordered by `key`, per group of the `by` columns.

    `key` must not be null and be unique within a group. The groups should be few. The number of
    ranges is the session's number of shuffle partitions, so it follows the size of the job.
    """
    order = F.col(key).desc() if descending else F.col(key).asc()
    # written once: the ranges must be the same for the totals and for the rows
    sliced = materialize(df.repartitionByRange(order).withColumn("__slice", F.spark_partition_id()), "running")
    before = Window.partitionBy(*by).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = sliced.groupBy(*by, "__slice").agg(*[F.sum(c).alias(f"__t_{out}") for out, c in totals.items()])
    offsets = sums.select(*by, "__slice", *[F.coalesce(F.sum(f"__t_{out}").over(before), F.lit(0)).alias(f"__o_{out}") for out in totals])
    within = Window.partitionBy(*by, "__slice").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    joined = sliced.join(offsets, [*by, "__slice"])
    return joined.select(
        *df.columns,
        *[(F.sum(c).over(within) + F.col(f"__o_{out}")).alias(out) for out, c in totals.items()],
    )


def rank_within(
    df: DataFrame,
    groups: Sequence[str],
    order_key: Column,
    low: int,
    high: int,
    tie: str,
    name: str = "row_rank",
    slices: int = 1 << 16,
) -> DataFrame:
    """Zero-based row number per group, ordered by (`order_key`, `tie`).

    `order_key` must be spread evenly over [low, high) (a hash). The groups may be few and huge:
    each is cut into `slices` hash ranges, and only the (group, slice) counts are ordered whole.
    """
    width = max((high - low) // slices, 1)
    keyed = df.withColumn("__key", order_key).withColumn(
        "__slice", F.floor((F.col("__key") - F.lit(low)) / F.lit(width)).cast("int")
    )
    counts = keyed.groupBy(*groups, "__slice").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*groups).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*groups, "__slice", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    within = Window.partitionBy(*groups, "__slice").orderBy("__key", tie)
    ranked = keyed.withColumn("__within", F.row_number().over(within) - 1).join(offsets, [*groups, "__slice"])
    return ranked.select(*df.columns, (F.col("__before") + F.col("__within")).alias(name))
