"""Whole jobs: catalog, ingest and partition study."""

from tidemark.plans.catalog import build_dataset_list
from tidemark.plans.ingest import ingest_blocks, ingest_grids
from tidemark.plans.study import partition_study
from tidemark.plans.sweep import partition_sweep

__all__ = ["build_dataset_list", "ingest_blocks", "ingest_grids", "partition_study", "partition_sweep"]
