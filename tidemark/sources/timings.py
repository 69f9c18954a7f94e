"""Timing tables as CSV."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

# Fixed value: file names end in the time of writing.
STAMP_FORMAT = "%Y%m%d-%H%M%S"


def write_timings(df: DataFrame, folder: str, mode: str) -> str:
    """Write ``df`` with a header below ``folder`` and give back the path.

    The name holds the second of writing. A table already there is not replaced.
    """
    path = f"{folder.rstrip('/')}/{mode}_raw{datetime.now().strftime(STAMP_FORMAT)}.csv"
    df.write.mode("errorifexists").option("header", True).csv(path)
    return path


def read_timings(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)
