"""Time one query over growing prefixes and partition counts."""

from __future__ import annotations

import random
import statistics
import time
from collections import defaultdict
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession

from tidemark.functions import as_measure
from tidemark.operators.exact import exact_averages, measure_state
from tidemark.operators.measures import MEASURES, avg_measures
from tidemark.operators.partitions import (
    coalesce_to,
    partition_count,
    repartition_to,
    skip_cells,
)
from tidemark.sources.measurements import rows_to_table

MODES: dict[str, Callable[[DataFrame, int], DataFrame]] = {
    "repartition": repartition_to,
    "coalesce": coalesce_to,
}


class Case(NamedTuple):
    """One prefix of the data: its size, how to build it, and the partition counts to
    try; without counts, 1 up to the partitions of its scan."""

    scale: int
    build: Callable[[], DataFrame]
    counts: Sequence[int] | None = None


CELL = "fraction_ord int, scale bigint, partitions int"


def timed(step: Callable):
    """Result of ``step()`` and the seconds it took."""
    start = time.perf_counter()
    result = step()
    return result, time.perf_counter() - start


@contextmanager
def unsorted_repartition(spark: SparkSession) -> Iterator[None]:
    """Within it ``repartition(n)`` deals the rows out as they come.

    By default Spark sorts each partition before, so that a task that runs again deals its rows the same
    way. A scan gives them in the same order anyway; where the order may differ, Spark then runs
    the whole stage again instead of the task.
    """
    key = "spark.sql.execution.sortBeforeRepartition"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def partition_sweep(
    spark: SparkSession,
    cases: Sequence[Case],
    mode: str,
    measures: Sequence[str] = MEASURES,
    *,
    skipped: Column | None = None,
    repeats: int = 1,
    exact: bool = False,
    seed: int = 0,
) -> DataFrame:
    """``avg_measures`` of each case at each partition count, with the times it took.

    ``skipped`` is a condition on ``fraction_ord, scale, partitions`` of cells to leave
    out. Nothing is cached and cells run one by one, so each pays for its own scan and
    has the cluster to itself.

    ``repeats`` measures every cell so many times, in blocks that each take all cells in a new
    random order, so that a slow spell of the cluster does not fall on one cell alone. ``avg_s`` is
    then the median, and ``avg_s_low`` and ``avg_s_high`` tell the spread. ``exact`` takes sums that
    are equal to the last bit for all partition counts, at a higher cost.

    ``coalesce`` cannot give more partitions than there are, so a larger count is refused.
    ``repartition`` deals the rows in the order they come, without Spark's sort before it
    (see ``unsorted_repartition``).

    One row per cell: ``mode, fraction_ord, scale, partitions, actual_partitions, rows,
    avg_*, create_s, avg_s``, times in seconds; with repeats also ``repeats, avg_s_median,
    avg_s_low, avg_s_high``.
    """
    if repeats < 1:
        raise ValueError("repeats must be 1 or more")
    change = MODES[mode]
    built = [timed(case.build) for case in cases]
    # The partitions of a case are those of its scan; asking a plan that shuffles would run it.
    scanned = [
        partition_count(df) if mode == "coalesce" or not case.counts else None
        for case, (df, _) in zip(cases, built)
    ]
    cells = [
        (i, case.scale, n)
        for i, case in enumerate(cases)
        for n in case.counts or range(1, scanned[i] + 1)
    ]
    if skipped is not None:
        kept = skip_cells(rows_to_table(spark, cells, CELL), skipped)
        cells = sorted(tuple(row) for row in kept.collect())
    if mode == "coalesce":
        for i, _, n in cells:
            if n > scanned[i]:
                raise ValueError(f"a scan of {scanned[i]} partitions cannot be coalesced to {n}")

    def measure(i: int, n: int):
        # As doubles before the shuffle: a number is smaller there than its text.
        numbers = built[i][0].select(*[as_measure(m).alias(m) for m in measures])
        changed = change(numbers, n)
        if exact:
            averages = exact_averages(measure_state(changed, measures), measures)
        else:
            averages = avg_measures(changed, measures, with_rows=True)
        with unsorted_repartition(averages.sparkSession):
            (row,), seconds = timed(averages.collect)
        return tuple(row), seconds

    order = random.Random(seed)
    found, times = {}, defaultdict(list)
    for _ in range(repeats):
        block = list(cells)
        if repeats > 1:
            order.shuffle(block)
        for cell in block:
            i, _, n = cell
            found[cell], seconds = measure(i, n)
            times[cell].append(seconds)
    records = []
    for cell in cells:
        i, scale, n = cell
        median = statistics.median(times[cell])
        spread = (repeats, median, min(times[cell]), max(times[cell])) if repeats > 1 else ()
        records.append((mode, i, scale, n, n, *found[cell], built[i][1], median, *spread))
    schema = ", ".join(
        [
            "mode string, fraction_ord int, scale bigint, partitions int",
            "actual_partitions int, rows bigint",
            *[f"`avg_{m}` double" for m in measures],
            "create_s double, avg_s double",
            *(["repeats int, avg_s_median double, avg_s_low double, avg_s_high double"] if repeats > 1 else []),
        ]
    )
    return rows_to_table(spark, records, schema)
