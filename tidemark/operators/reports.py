"""Timing tables as complete grids, series and lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_scales(timings: DataFrame, scale: str = "scale") -> DataFrame:
    return timings.select(scale).distinct()


def complete_grid(
    timings: DataFrame, row_key: str = "scale", col_key: str = "partitions"
) -> DataFrame:
    """Every row key with every column key from 1 to the largest; absent cells are null.

    The largest key is a scalar subquery, so the cells unroll from the distinct row keys
    without joining the two key sets.
    """
    largest = timings.agg(F.max(col_key)).scalar()
    first = F.lit(1).cast(timings.schema[col_key].dataType)
    cells = distinct_scales(timings, row_key).select(
        row_key, F.explode(F.sequence(first, largest)).alias(col_key)
    )
    return cells.join(timings, [row_key, col_key], "left").select(*timings.columns)


def pivot_series(
    timings: DataFrame,
    value: str,
    counts: Sequence[int] | None = None,
    row_key: str = "scale",
    col_key: str = "partitions",
) -> DataFrame:
    """One row per row key, one column ``VALUE_k`` per column key k.

    ``timings`` has one row per cell. Without ``counts`` the keys go from 1 to the largest.
    """
    if counts is None:
        counts = range(1, (timings.agg(F.max(col_key)).first()[0] or 0) + 1)
    counts = list(counts)
    if not counts:
        return distinct_scales(timings, row_key)
    wide = timings.groupBy(row_key).pivot(col_key, counts).agg(F.first(value))
    return wide.select(row_key, *[F.col(f"`{k}`").alias(f"{value}_{k}") for k in counts])


def report_lines(timings: DataFrame) -> DataFrame:
    """One readable line per timing record; a missing time reads ``none``."""

    def seconds(name: str) -> Column:
        return F.when(F.col(name).isNull(), "none").otherwise(F.format_string("%.9f", name))

    return timings.select(
        F.format_string(
            "scale %s, partitions %s: created in %s s, averaged in %s s",
            F.col("scale").cast("string"),
            F.col("partitions").cast("string"),
            seconds("create_s"),
            seconds("avg_s"),
        ).alias("line")
    )
