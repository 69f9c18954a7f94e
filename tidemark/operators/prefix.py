"""Growing prefixes of a table: by files, by rows, by row budget."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import as_measure
from tidemark.operators.ordering import order_cutoffs, running_before

# The fractions of the data that are measured, ascending.
FRACTIONS = (
    (1, 5), (1, 4), (1, 3), (2, 5), (1, 2), (3, 5), (2, 3), (3, 4), (4, 5), (1, 1),
)


def fraction_array(target: int = 5) -> Column:
    """All fractions with a denominator up to ``target`` as ``num, den``, ascending.

    A fraction below one is left out if its numerator, other than 1, divides its
    denominator, since a smaller denominator gives it as well.
    """

    def proper(num: Column, den: Column) -> Column:
        return (num < den) & ((num == 1) | (den % num != 0))

    up_to_target = F.sequence(F.lit(1), F.lit(target))
    pairs = F.flatten(
        F.transform(
            up_to_target,
            lambda den: F.transform(
                F.filter(up_to_target, lambda num: proper(num, den) | ((num == 1) & (den == 1))),
                lambda num: F.struct(
                    (num / den).alias("part"), num.alias("num"), den.alias("den")
                ),
            ),
        )
    )
    return F.transform(
        F.array_sort(pairs), lambda p, i: F.struct(i.alias("fraction_ord"), p["num"], p["den"])
    )


def fraction_ladder(spark: SparkSession, target: int = 5) -> DataFrame:
    """``fraction_ord, num, den``, ascending."""
    return spark.range(1).select(F.inline(fraction_array(target)))


def prefix_size(entries: int, num: int, den: int) -> int:
    """Entries in a prefix: the floating product, halves to even."""
    return round(entries * (num / den))


def prefix_sizes(entries: DataFrame, target: int = 5) -> DataFrame:
    """``fraction_ord, num, den, size`` of each prefix of the given rows (files or records)."""
    size = F.bround(F.col("entries") * (F.col("num") / F.col("den"))).cast("bigint")
    return (
        entries.agg(F.count("*").alias("entries"))
        .select("entries", F.inline(fraction_array(target)))
        .select("fraction_ord", "num", "den", size.alias("size"))
    )


def first_n_files(datasets: DataFrame, n: int) -> DataFrame:
    """The first ``n`` of the dataset list."""
    return datasets.filter(F.col("file_ord") < n)


def prefix_files(datasets: DataFrame, num: int, den: int) -> DataFrame:
    """The first ``num/den`` of the dataset list."""
    return first_n_files(datasets, prefix_size(datasets.count(), num, den))


def prefix_rows(df: DataFrame, num: int, den: int, order_by: str) -> DataFrame:
    """The first ``num/den`` of the rows by the unique integer column ``order_by``."""
    (prefix,) = row_prefixes(df, order_by, [(num, den)])
    return df.filter(_within(F.col(order_by), prefix.last))


def row_budget_files(counts: DataFrame, budget: int) -> DataFrame:
    """Files in order until more than ``budget`` rows are in; the crossing file counts.

    ``counts`` has one row ``file_ord, rows`` per file, so the running sum is over files.
    """
    placed = running_before(counts, ["file_ord"], F.col("rows"), "rows_before")
    return placed.filter(F.col("rows_before") <= budget)


@dataclass(frozen=True)
class Prefix:
    """A fraction of the data: its size, and the last key in it (None if it is empty)."""

    num: int
    den: int
    size: int
    last: int | None


def file_prefixes(
    files: int, fractions: Sequence[tuple[int, int]] = FRACTIONS
) -> list[Prefix]:
    """Prefixes of a list of ``files`` files, keyed by ``file_ord``."""
    sizes = [prefix_size(files, num, den) for num, den in fractions]
    return [
        Prefix(num, den, size, size - 1 if size else None)
        for (num, den), size in zip(fractions, sizes)
    ]


def row_prefixes(
    df: DataFrame, order_by: str, fractions: Sequence[tuple[int, int]] = FRACTIONS
) -> list[Prefix]:
    """Prefixes of the rows, keyed by the unique integer column ``order_by``."""
    rows = df.count()
    sizes = [prefix_size(rows, num, den) for num, den in fractions]
    cutoffs = order_cutoffs(df, order_by, sizes)
    return [
        Prefix(num, den, size, last)
        for (num, den), size, last in zip(fractions, sizes, cutoffs)
    ]


def _within(key: Column, last: int | None) -> Column:
    return F.lit(False) if last is None else key <= last


def prefix_averages(
    df: DataFrame, key: str, prefixes: Sequence[Prefix], measures: Sequence[str]
) -> DataFrame:
    """Row count and measure averages of *every* prefix, from one scan.

    ``prefixes`` ascend in size. Each row goes into the smallest prefix that holds it,
    which gives one group per prefix and sums that combine before the shuffle; a
    prefix is then the sum of its own and all smaller groups. The usual way scans
    the data once per prefix.
    """
    if not prefixes:
        raise ValueError("no prefixes")
    if any(a.size > b.size for a, b in zip(prefixes, prefixes[1:])):
        raise ValueError("prefixes must ascend in size")
    spark = df.sparkSession
    last = len(prefixes) - 1
    inside = df.filter(_within(F.col(key), prefixes[-1].last))
    smallest = sum(((~_within(F.col(key), p.last)).cast("int") for p in prefixes), F.lit(0))
    # Cast once, for the sum and the count of the filled cells.
    numbers = inside.select(
        smallest.alias("fraction_ord"), *[as_measure(m).alias(m) for m in measures]
    )
    groups = numbers.groupBy("fraction_ord").agg(
        F.count("*").alias("rows"),
        *[F.sum(m).alias(f"sum_{m}") for m in measures],
        *[F.count(m).alias(f"n_{m}") for m in measures],
    )
    spread = groups.withColumn(
        "fraction_ord", F.explode(F.sequence("fraction_ord", F.lit(last)))
    )
    # A prefix without rows has no group; this row keeps it in the result.
    every = spark.range(len(prefixes)).select(F.col("id").cast("int").alias("fraction_ord"))
    totals = (
        spread.unionByName(every, allowMissingColumns=True)
        .groupBy("fraction_ord")
        .agg(
            F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
            *[F.sum(f"sum_{m}").alias(f"sum_{m}") for m in measures],
            *[F.sum(f"n_{m}").alias(f"n_{m}") for m in measures],
        )
    )
    info = F.array(
        *[
            F.struct(F.lit(p.num).alias("num"), F.lit(p.den).alias("den"),
                     F.lit(p.size).cast("bigint").alias("size"))
            for p in prefixes
        ]
    )
    return totals.withColumn("prefix", F.get(info, F.col("fraction_ord"))).select(
        "fraction_ord",
        "prefix.num",
        "prefix.den",
        "prefix.size",
        "rows",
        *[F.try_divide(f"sum_{m}", f"n_{m}").alias(f"avg_{m}") for m in measures],
    )
