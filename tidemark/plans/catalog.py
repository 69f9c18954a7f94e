"""From stored catalog pages to the sorted dataset list."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.links import extract_links, filter_links, sorted_distinct, tokens
from tidemark.session import scratch_dir
from tidemark.sources.datasets import (
    append_links,
    read_dataset_list,
    read_links,
    write_sorted_links,
)


def build_dataset_list(
    spark: SparkSession,
    pages: DataFrame,
    path: str,
    *,
    prefix: str = "^https://",
    suffix: str = r"\.nc$",
    links_path: str | None = None,
) -> DataFrame:
    """Write the sorted distinct dataset links of ``pages`` to ``path`` and read them back.

    The raw links are appended to the text table ``links_path``, which may hold links
    of earlier runs; without it a new one in the shared scratch folder is used.
    """
    raw = links_path or scratch_dir(spark, "links")
    append_links(filter_links(extract_links(pages), prefix, suffix), raw)
    write_sorted_links(sorted_distinct(tokens(read_links(spark, raw))), path)
    return read_dataset_list(spark, path)
