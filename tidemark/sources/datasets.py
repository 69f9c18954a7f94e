"""Link lists and ordered dataset lists, kept as text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import dataset_name, with_suffix
from tidemark.operators.ordering import running_before, with_row_index, with_scan_position
from tidemark.sources.file_catalog import pinned


def append_links(links: DataFrame, path: str, column: str = "link") -> None:
    """Add the links to a text table, one per line."""
    links.select(column).write.mode("append").text(path)


def read_links(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a text table, as they stand."""
    return spark.read.text(path)


def write_sorted_links(links: DataFrame, path: str, column: str = "link") -> None:
    """Replace the text table by the links in ascending order.

    The sort is a range partitioning, so the part files follow each other in order.
    """
    links.select(column).orderBy(column).write.mode("overwrite").text(path)


def read_dataset_list(spark: SparkSession, path: str) -> DataFrame:
    """``file_ord, url, dataset, file``: one row per line, numbered from 0 in file order."""
    lines = with_scan_position(pinned(spark).read.text(path))
    return with_row_index(lines, name="file_ord").select(
        "file_ord",
        F.col("value").alias("url"),
        dataset_name(F.col("value")).alias("dataset"),
        with_suffix(dataset_name(F.col("value"))).alias("file"),
    )


def list_datasets(df: DataFrame, column: str = "dataset") -> DataFrame:
    """``file_ord`` and the distinct values of ``column``, ascending."""
    distinct = df.select(column).distinct()
    return running_before(distinct, [column], F.lit(1), "file_ord").select("file_ord", column)
