"""The whole partition study: list, prefixes, sweep, timing table, grid and series.

    python -m tidemark.plans.study LIST DATA OUT --mode repartition
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from functools import partial
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.measures import MEASURES
from tidemark.operators.prefix import FRACTIONS, first_n_files, prefix_size, row_budget_files
from tidemark.operators.reports import complete_grid, pivot_series, report_lines
from tidemark.plans.sweep import MODES, Case, partition_sweep
from tidemark.session import get_session
from tidemark.sources.datasets import read_dataset_list
from tidemark.sources.file_catalog import Headers, catalog_headers, refresh_catalog
from tidemark.sources.measurements import (
    LAYOUTS,
    dataset_paths,
    file_headers,
    known_row_counts,
    read_measurements,
    read_row_prefix,
)
from tidemark.sources.timings import write_timings


class Study(NamedTuple):
    timings: DataFrame
    path: str
    grid: DataFrame
    create_series: DataFrame
    avg_series: DataFrame


def file_cases(
    spark: SparkSession,
    paths: Sequence[str],
    fractions: Sequence[tuple[int, int]],
    base_path: str | None = None,
    headers: Headers | None = None,
    multi_line: bool = False,
) -> list[Case]:
    """Prefixes of the file list, each read by itself; the headers are read once for all."""
    sizes = [prefix_size(len(paths), num, den) for num, den in fractions]
    headers = file_headers(spark, paths) if headers is None else headers
    options = {"headers": headers, "base_path": base_path, "multi_line": multi_line}
    return [
        Case(size, partial(read_measurements, spark, paths[:size], **options))
        for size in sizes
        if size
    ]


def row_cases(
    spark: SparkSession,
    counted: Sequence[tuple[str, int]],
    fractions: Sequence[tuple[int, int]],
    base_path: str | None = None,
    headers: Headers | None = None,
) -> list[Case]:
    """Prefixes of the rows of the files (path, rows), in list order.

    Each reads only the files it needs; the index of the last one is made when it is built.
    """
    headers = file_headers(spark, [path for path, _ in counted]) if headers is None else headers
    entries = sum(rows for _, rows in counted)
    sizes = [prefix_size(entries, num, den) for num, den in fractions]
    options = {"headers": headers, "base_path": base_path}
    return [
        Case(size, partial(read_row_prefix, spark, counted, size, **options))
        for size in sizes
        if size
    ]


def partition_study(
    spark: SparkSession,
    list_path: str,
    data_folder: str,
    out_folder: str,
    *,
    mode: str,
    files: int | None = None,
    row_budget: int | None = None,
    fractions: Sequence[tuple[int, int]] = FRACTIONS,
    measures: Sequence[str] = MEASURES,
    counts: Sequence[int] | None = None,
    layout: str = "files",
    repeats: int = 1,
    multi_line: bool = False,
) -> Study:
    """Average the measures over growing prefixes and partition counts.

    The prefixes count files, of the whole dataset list or of its first ``files``.
    With ``row_budget`` they count rows, of the first files that exceed that many rows.
    ``counts`` are the partition counts to try, by default 1 up to those of each scan.
    ``layout`` tells how the data lie in their folder (see ``dataset_paths``).
    ``repeats`` measures each cell so many times (see ``partition_sweep``).
    Empty prefixes (of a very short list) have nothing to scan and are left out.
    ``multi_line`` reads whole files as streams: quoted cells may go over line breaks, and a row
    takes about half the time to parse than line by line, but files are not cut, so they should be several
    for each core (see ``part_count``). Prefixes of rows are found by lines and refuse it.

    What the files hold is kept in a catalog below ``out_folder``, so a later study opens only
    files that are new or have changed to learn it.
    """
    if multi_line and row_budget is not None:
        raise ValueError("prefixes of rows are read by lines, not with multi_line")
    datasets = read_dataset_list(spark, list_path)
    if files is not None:
        datasets = first_n_files(datasets, files)
    paths = dataset_paths(datasets, data_folder, layout)
    base = data_folder if layout == "folders" else None
    catalog = refresh_catalog(spark, paths, f"{out_folder.rstrip('/')}/catalog")
    if row_budget is None:
        headers = catalog_headers(catalog, paths, multi_line=multi_line)
        cases = file_cases(spark, paths, fractions, base, headers, multi_line)
    else:
        rows = row_budget_files(known_row_counts(catalog, datasets, layout), row_budget)
        counted = [(paths[row.file_ord], row.rows) for row in rows.orderBy("file_ord").toLocalIterator()]
        headers = catalog_headers(catalog, [path for path, _ in counted])
        cases = row_cases(spark, counted, fractions, base, headers)
    cases = [case._replace(counts=counts) for case in cases]
    timings = partition_sweep(spark, cases, mode, measures, repeats=repeats)
    record = ["scale", "partitions", "create_s", "avg_s"]
    path = write_timings(timings.select(record), out_folder, mode)
    # Prefixes of equal size are separate measurements, so their position is the row key.
    grid = complete_grid(timings, row_key="fraction_ord")
    return Study(
        timings,
        path,
        grid,
        pivot_series(grid, "create_s", row_key="fraction_ord"),
        pivot_series(grid, "avg_s", row_key="fraction_ord"),
    )


def main() -> None:
    parser = argparse.ArgumentParser(description="Time averages over prefixes and partitions.")
    parser.add_argument("list", help="dataset list, one address per line")
    parser.add_argument("data", help="folder with NAME.csv or dataset=NAME for each dataset")
    parser.add_argument("out", help="folder for the timing table")
    parser.add_argument("--mode", choices=sorted(MODES), default="repartition")
    parser.add_argument("--files", type=int, help="only the first so many of the list")
    parser.add_argument("--row-budget", type=int, help="prefixes of rows, of about this many")
    parser.add_argument("--layout", choices=LAYOUTS, default="files", help="how the data lie")
    parser.add_argument("--counts", type=int, nargs="+", help="partition counts to try")
    parser.add_argument("--repeats", type=int, default=1, help="measure each cell so many times")
    parser.add_argument("--multi-line", action="store_true", help="read whole files, never cut")
    args = parser.parse_args()
    spark = get_session()
    study = partition_study(
        spark,
        args.list,
        args.data,
        args.out,
        mode=args.mode,
        files=args.files,
        layout=args.layout,
        row_budget=args.row_budget,
        counts=args.counts,
        repeats=args.repeats,
        multi_line=args.multi_line,
    )
    for row in report_lines(study.timings).toLocalIterator():
        print(row.line)
    print(study.path)


if __name__ == "__main__":
    main()
