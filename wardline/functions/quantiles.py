"""Exact quantiles of columns with an unbounded domain, without one task seeing all values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.layers import materialize


def exact_quantiles(
    values: DataFrame, group: str, value: str, probabilities: dict, weight: str | None = None
) -> DataFrame:
    """One row per group with a column per named probability: linear interpolation at position
    (n - 1) * p over the non-null values. With `weight`, a row stands for that many equal
    values. Any number of groups, null being one of them.

    Equal values merge to a count first. The counts are dealt by range of (group, value) and
    written once with the number of their range: a large group spreads over many ranges, many small
    ones share one. The totals per group and range say which ranges hold a wanted rank, and only
    rows of those are ordered. Nothing passes through the driver.
    """
    merged = (
        values.where(F.col(value).isNotNull())
        .groupBy(group, value)
        .agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("c"))
    )
    dealt = merged.repartitionByRange(F.col(group), F.col(value)).select(
        F.col(group), F.col(value), "c", F.spark_partition_id().alias("part")
    )
    counts = materialize(dealt, "quantiles")

    upward = Window.partitionBy(group).orderBy("part")
    parts = (
        counts.groupBy(group, "part")
        .agg(F.sum("c").alias("part_c"))
        .withColumn("before", F.sum("part_c").over(upward) - F.col("part_c"))
        .withColumn("n", F.sum("part_c").over(Window.partitionBy(group)))
    )
    ranks = {
        name: ((F.col("n") - 1) * F.lit(float(p)), F.floor((F.col("n") - 1) * F.lit(float(p))))
        for name, p in probabilities.items()
    }
    wanted = F.lit(False)
    for position, low in ranks.values():
        for rank in (low, F.ceil(position)):
            wanted = wanted | _holds(rank, F.col("before"), F.col("part_c"))
    needed = parts.where(wanted).select(F.col(group).alias("_group"), F.col("part").alias("_part"), "before", "n")

    same = F.col(group).eqNullSafe(F.col("_group")) & (F.col("part") == F.col("_part"))
    within = Window.partitionBy(group, "part").orderBy(value)
    placed = counts.join(needed, same).withColumn(
        "start", F.col("before") + F.sum("c").over(within) - F.col("c")
    )
    picks = [F.max("n").alias("n")]
    for name, (position, low) in ranks.items():
        for side, rank in (("low", low), ("high", F.ceil(position))):
            hit = _holds(rank, F.col("start"), F.col("c"))
            picks.append(F.max(F.when(hit, F.col(value))).alias(f"{name}_{side}"))
    picked = placed.groupBy(group).agg(*picks)
    out = []
    for name, (position, low) in ranks.items():
        bottom, top = F.col(f"{name}_low"), F.col(f"{name}_high")
        out.append((bottom + (top - bottom) * (position - low)).alias(name))
    return picked.select(group, *out)


def row_numbers(rows: DataFrame, group: str, name: str, *order: Column) -> DataFrame:
    """The rows with their number (from 1) within their group in the given order, which must leave
    no ties. Rows are dealt by range of (group, order) and written once, so a group of any size is
    ordered by many tasks; a row's number is its place in its range plus the rows of earlier
    ranges."""
    dealt = rows.repartitionByRange(F.col(group), *order).withColumn("_part", F.spark_partition_id())
    written = materialize(dealt, "ranked")
    upward = Window.partitionBy(group).orderBy("_part")
    before = (
        written.groupBy(group, "_part")
        .agg(F.count(F.lit(1)).alias("_c"))
        .select(group, "_part", (F.sum("_c").over(upward) - F.col("_c")).alias("_before"))
    )
    place = F.row_number().over(Window.partitionBy(group, "_part").orderBy(*order))
    return (
        written.withColumn("_place", place)
        .join(before, [group, "_part"])
        .withColumn(name, F.col("_before") + F.col("_place"))
        .drop("_part", "_place", "_before")
    )


def _holds(rank: Column, start: Column, size: Column) -> Column:
    return (rank >= start) & (rank < start + size)
