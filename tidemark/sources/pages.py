"""Stored catalog pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Pages saved as Parquet: ``page_id, url, html``."""
    return spark.read.parquet(path).select("page_id", "url", "html")
