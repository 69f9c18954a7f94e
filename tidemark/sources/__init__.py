"""Readers and writers."""

from tidemark.sources.datasets import (
    append_links,
    list_datasets,
    read_dataset_list,
    read_links,
    write_sorted_links,
)
from tidemark.sources.file_catalog import (
    catalog_headers,
    catalog_rows,
    describe_files,
    list_files,
    pinned,
    refresh_catalog,
    row_ranks,
)
from tidemark.sources.link_ranges import merge_links, read_manifest, read_merged_links
from tidemark.sources.measurements import (
    block_ranks,
    dataset_paths,
    file_headers,
    header_groups,
    known_row_counts,
    part_count,
    read_measurements,
    read_row_budget,
    read_row_prefix,
    row_budget_paths,
    row_counts,
    rows_to_table,
    write_columnar,
    write_measurements,
)
from tidemark.sources.pages import read_pages
from tidemark.sources.states import read_measure_states, refresh_measure_states
from tidemark.sources.timings import read_timings, write_timings

__all__ = [
    "append_links",
    "block_ranks",
    "catalog_headers",
    "catalog_rows",
    "dataset_paths",
    "describe_files",
    "file_headers",
    "header_groups",
    "known_row_counts",
    "list_datasets",
    "list_files",
    "merge_links",
    "part_count",
    "pinned",
    "read_dataset_list",
    "read_links",
    "read_manifest",
    "read_measure_states",
    "read_measurements",
    "read_merged_links",
    "read_pages",
    "read_row_budget",
    "read_row_prefix",
    "read_timings",
    "refresh_catalog",
    "refresh_measure_states",
    "row_budget_paths",
    "row_counts",
    "row_ranks",
    "rows_to_table",
    "write_columnar",
    "write_measurements",
    "write_sorted_links",
    "write_timings",
]
