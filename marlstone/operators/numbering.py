"""Consecutive numbers for rows, without one task that sees them all."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .checkpoints import cut


def numbered(rows: DataFrame, order: list[str], name: str = "ord") -> DataFrame:
    """Adds the row's number from 0 in the given order.  Range partitions are sorted and
    counted, and their few counts are added up; ties are numbered in any order."""
    placed = rows.repartitionByRange(*[F.col(c) for c in order]).sortWithinPartitions(*order).withColumn("marl_part", F.spark_partition_id())
    placed = cut(placed.withColumn("marl_at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))
    sums = placed.groupBy("marl_part").agg(F.count(F.lit(1)).alias("n"))
    before = sums.select("marl_part", (F.sum("n").over(Window.orderBy("marl_part")) - F.col("n")).alias("marl_before"))  # a row for each partition
    return placed.join(before, "marl_part").select(*rows.columns, (F.col("marl_before") + F.col("marl_at")).alias(name))
