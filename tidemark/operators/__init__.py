"""DataFrame to DataFrame operators."""

from tidemark.operators.blocks import cut_into_blocks, flatten_blocks
from tidemark.operators.exact import (
    exact_averages,
    measure_state,
    merged_state,
    prefix_state_averages,
)
from tidemark.operators.grids import flatten_grid, project_variable
from tidemark.operators.links import (
    distinct_tokens,
    extract_links,
    filter_links,
    sorted_distinct,
    tokens,
)
from tidemark.operators.measures import MEASURES, avg_measures, max_partitions, row_count
from tidemark.operators.ordering import (
    assign_file_ord,
    file_order,
    first_rows,
    order_cutoffs,
    running_before,
    with_row_index,
    with_scan_position,
)
from tidemark.operators.partitions import (
    coalesce_to,
    partition_count,
    partition_sizes,
    repartition_to,
    skip_cells,
)
from tidemark.operators.prefix import (
    FRACTIONS,
    Prefix,
    file_prefixes,
    first_n_files,
    fraction_ladder,
    prefix_averages,
    prefix_files,
    prefix_rows,
    prefix_size,
    prefix_sizes,
    row_budget_files,
    row_prefixes,
)
from tidemark.operators.ranks import prefix_rows_by, prefixes_by, rank_bounds, with_row_address
from tidemark.operators.reports import complete_grid, distinct_scales, pivot_series, report_lines

__all__ = [
    "FRACTIONS",
    "MEASURES",
    "Prefix",
    "assign_file_ord",
    "avg_measures",
    "coalesce_to",
    "complete_grid",
    "cut_into_blocks",
    "distinct_scales",
    "distinct_tokens",
    "exact_averages",
    "extract_links",
    "file_order",
    "file_prefixes",
    "filter_links",
    "first_n_files",
    "first_rows",
    "flatten_blocks",
    "flatten_grid",
    "fraction_ladder",
    "max_partitions",
    "measure_state",
    "merged_state",
    "order_cutoffs",
    "partition_count",
    "partition_sizes",
    "pivot_series",
    "prefix_averages",
    "prefix_files",
    "prefix_rows",
    "prefix_rows_by",
    "prefix_size",
    "prefix_sizes",
    "prefix_state_averages",
    "prefixes_by",
    "project_variable",
    "rank_bounds",
    "repartition_to",
    "report_lines",
    "row_budget_files",
    "row_count",
    "row_prefixes",
    "running_before",
    "skip_cells",
    "sorted_distinct",
    "tokens",
    "with_row_address",
    "with_row_index",
    "with_scan_position",
]
