"""Partition counts of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def repartition_to(df: DataFrame, n: int) -> DataFrame:
    """Exactly ``n`` partitions, by a round-robin shuffle of all rows."""
    return df.repartition(n)


def coalesce_to(df: DataFrame, n: int) -> DataFrame:
    """At most ``n`` partitions, merged without a shuffle; never more than there are."""
    return df.coalesce(n)


def partition_count(df: DataFrame) -> int:
    """How many partitions ``df`` is planned with. Cheap for a scan; a plan with a
    shuffle may run it first to find out."""
    return df.rdd.getNumPartitions()


def partition_sizes(df: DataFrame) -> DataFrame:
    """``partition, rows`` of each partition that holds rows."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count("*").alias("rows"))


def skip_cells(cells: DataFrame, skipped: Column) -> DataFrame:
    """The cells of a (scale, partitions) grid for which ``skipped`` does not hold."""
    return cells.filter(~F.coalesce(skipped, F.lit(False)))
