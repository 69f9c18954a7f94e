"""Whole-table aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import as_measure

# The measures of the shore-station tables.
MEASURES = ("temperature", "conductivity", "salinity", "chlorophyll")


def avg_measures(
    df: DataFrame,
    measures: Sequence[str] = MEASURES,
    *,
    nan_as_null: bool = False,
    with_rows: bool = False,
) -> DataFrame:
    """One row with ``avg_NAME`` per measure; cells that are no number are skipped.

    ``with_rows`` puts the row count in front. The last digits depend on the order in which the
    rows are added; ``exact_averages`` over ``measure_state`` gives the same ones always.
    """
    rows = [F.count("*").alias("rows")] if with_rows else []
    return df.agg(*rows, *[F.avg(as_measure(m, nan_as_null)).alias(f"avg_{m}") for m in measures])


def row_count(df: DataFrame, name: str = "rows") -> DataFrame:
    return df.agg(F.count("*").alias(name))


def max_partitions(timings: DataFrame, column: str = "partitions") -> DataFrame:
    """The largest partition count of a timing table."""
    return timings.agg(F.max(column).alias("max_partitions"))
