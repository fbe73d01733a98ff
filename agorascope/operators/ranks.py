"""Ranks and running sums without a group, or everything, in one task.

Two ways. Where only the first k rows of each group are asked for, tasks drop what is beyond k before rows move, as Spark plans
a rank under a literal limit (spark.sql.optimizer.windowGroupLimitThreshold, 1000), so a hot group costs k rows a task. Where
every row needs its place, rows are sorted by ranges: a place is that in its range and what the ranges before it hold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agorascope.sources import store


def first_rows(rows: DataFrame, group: list[str], k: int, *order: Column | str, rank: str = "n_") -> DataFrame:
    """At most the first k rows of each group, with their rank from 1."""
    n = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return rows.withColumn(rank, n).where(F.col(rank) <= k)


def placed(rows: DataFrame, group: list[str], order: list[str], value: str | None = None) -> DataFrame:
    """Adds before_, the sum of `value` (or the number) of the group's rows before each, and all_, that of the whole group.

    order: columns, ascending, that end in a unique one. Null groups are groups. The ranges are a table in the shared folder, as
    every read of them must cut them alike; of a range and group the sums are one row, so what is windowed over is small."""
    keys = [F.struct(F.coalesce(F.col(g).cast("string"), F.lit("")), F.col(g).isNull()).alias(f"g{i}_") for i, g in enumerate(group)]
    names = [f"g{i}_" for i in range(len(group))]
    own = rows.select("*", *keys, (F.col(value) if value else F.lit(1)).alias("v_"))
    ranges = store.kept(own.repartitionByRange(*names, *order).withColumn("part_", F.spark_partition_id()), "placed")
    sums = ranges.groupBy(*names, "part_").agg(F.sum("v_").alias("own_"))
    whole = Window.partitionBy(*names)
    sums = sums.select(*names, "part_", (F.sum("own_").over(whole.orderBy("part_")) - F.col("own_")).alias("past_"), F.sum("own_").over(whole).alias("all_"))
    within = F.sum("v_").over(Window.partitionBy(*names, "part_").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)) - F.col("v_")
    found = ranges.withColumn("within_", within).join(sums, [*names, "part_"])
    return found.select(*rows.columns, (F.col("past_") + F.col("within_")).alias("before_"), "all_")
