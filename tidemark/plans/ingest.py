"""From nested gridded datasets to measurement CSVs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from tidemark.operators.blocks import flatten_blocks
from tidemark.operators.grids import flatten_grid
from tidemark.sources.measurements import write_measurements


def ingest_grids(
    grids: DataFrame,
    dims: Mapping[str, str | None],
    variables: Mapping[str, Sequence[str]],
    path: str,
    *,
    dataset: str = "dataset",
    order_by: Sequence[str] = (),
    rebalance: bool = True,
    parts: int | None = None,
) -> None:
    """Flatten every dataset of ``grids`` and write its rows, in grid order, as CSV.

    Grid order is that of the arrays, whatever their coordinates are. A dataset given as
    several rows of ``grids`` takes them in the order of the columns ``order_by``, which are
    not written. With one row per dataset, its points are together already, and
    ``rebalance=False`` spares the shuffle. ``parts`` is for ``write_measurements``.
    """
    flat = flatten_grid(grids, dims, variables, keep=[dataset, *order_by], positions=True)
    order = [*order_by, *[f"pos_{dim}" for dim in dims]]
    write_measurements(
        flat, path, dataset=dataset, sort_by=order, drop=order, rebalance=rebalance, parts=parts
    )


def ingest_blocks(
    blocks: DataFrame,
    dims: Mapping[str, str | None],
    variables: Mapping[str, Sequence[str]],
    path: str,
    *,
    dataset: str = "dataset",
) -> None:
    """Flatten datasets that are kept as blocks and write their rows, in grid order, as CSV."""
    flat = flatten_blocks(blocks, dims, variables, dataset=dataset, positions=True)
    order = [f"pos_{dim}" for dim in dims]
    write_measurements(flat, path, dataset=dataset, sort_by=order, drop=order)
