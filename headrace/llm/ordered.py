"""Rows in one order over all tasks, and gapless positions in it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from headrace.llm.tables import Workspace

# `monotonically_increasing_id` numbers a partition's rows in its low bits.
PARTITION_BITS = 33


def in_order(df: DataFrame, *keys: str) -> DataFrame:
    """Ranges of the keys' order, one to a partition and sorted within it; nulls come first.

    Rows with equal keys may be in one partition: end the keys with a column that tells rows apart.
    """
    return df.repartitionByRange(*keys).sortWithinPartitions(*keys)


def with_order(work: Workspace, df: DataFrame, *keys: str) -> DataFrame:
    """The rows written in order, and `_at`, which grows with the order and has gaps."""
    return work.save(in_order(df, *keys).withColumn("_at", F.monotonically_increasing_id()))


def with_positions(work: Workspace, df: DataFrame, group: str, *keys: str) -> DataFrame:
    """The rows with `_pos`, gapless from 0 within each group by the keys, and `_count`, the group's size.

    The rows are sorted by ranges. A group's rows in a partition follow each other, so that their
    positions are known from the first of them and from the counts in the partitions before: one
    small row for a group and a partition.
    """
    rows = with_order(work, df, group, *keys).withColumn("_part", F.shiftright("_at", PARTITION_BITS))
    counts = rows.groupBy(group, "_part").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    everything = Window.partitionBy(group)
    before = everything.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = work.save(counts.select(group, "_part", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
                                      F.sum("_n").over(everything).alias("_count")))
    return (rows.join(offsets, [group, "_part"]).withColumn("_pos", F.col("_offset") + F.col("_at") - F.col("_first"))
            .drop("_part", "_at", "_first", "_offset"))
