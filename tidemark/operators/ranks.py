"""Rows by rank in any order: strings, times, several columns.

A rank is found without sorting the table. Splitters from a sample of the keys cut the order into
intervals, the rows of each interval are counted, and only the intervals in which a rank falls
are cut further, until so few rows are left that they can be numbered. What is shuffled are
counts. The sample decides how fast this goes and never what comes out.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.ordering import FILE, plain_file
from tidemark.operators.prefix import FRACTIONS, prefix_size
from tidemark.session import written_side

#: Intervals that a round cuts the order into.
SPLITTERS = 1023
#: So few rows are numbered instead of being cut further.
NUMBERED = 20_000
PLACE = "scan_place"


def with_row_address(scan: DataFrame) -> DataFrame:
    """Add the file and the place in it of each row of a Parquet scan: a unique last key."""
    return scan.select(
        "*",
        plain_file(F.col("_metadata.file_path")).alias(FILE),
        F.col("_metadata.row_index").alias(PLACE),
    )


def _interval(key: Column, edges: Column, steps: Sequence[int]) -> Column:
    """How many of the sorted ``edges`` are not above ``key``, by bisection."""
    halves = F.array(*[F.lit(step) for step in steps])
    return F.aggregate(
        halves,
        F.lit(0),
        lambda at, step: F.when(
            (at + step <= F.size(edges)) & (F.get(edges, at + step - 1) <= key), at + step
        ).otherwise(at),
    )


def interval_of(keyed: DataFrame, edges: DataFrame, size: int) -> DataFrame:
    """Adds ``b``, how many of the ``size`` sorted edges, the one row of ``edges``, are not above ``k``."""
    steps = [1 << i for i in reversed(range(max(1, size.bit_length())))]
    with_edges = keyed.withColumn("__edges", edges.scalar())
    return with_edges.withColumn("b", _interval(F.col("k"), F.col("__edges"), steps)).drop("__edges")


class _Cut:
    """One round: sorted edges, as a stored row, and the interval of a key among them."""

    def __init__(self, sample: DataFrame, kept: DataFrame | None, splitters: int) -> None:
        every = sample if kept is None else sample.unionByName(kept)
        listed = F.array_sort(F.collect_set("k"))
        # Every so many of a sample that came out too large.
        apart = F.greatest(F.lit(1), F.ceil(F.size("all") / splitters)).cast("int")
        thin = F.filter("all", lambda _, i: i % F.col("apart") == 0)
        made = every.agg(listed.alias("all")).withColumn("apart", apart)
        thinned = made.select(thin.alias("edges"))
        if kept is not None:
            bounds = kept.agg(F.collect_set("k").alias("bounds"))
            edges = F.array_sort(F.array_union("edges", "bounds"))
            thinned = thinned.withColumn("bounds", bounds.scalar()).select(edges.alias("edges"))
        self.row = written_side(thinned, "edges")
        self.size = self.row.select(F.size("edges")).first()[0]

    def placed(self, keyed: DataFrame) -> DataFrame:
        return interval_of(keyed, self.row, self.size)

    def bounds(self, intervals: Sequence[int]) -> DataFrame:
        """The edges on both sides of the intervals."""
        around = sorted({i - 1 for i in intervals} | set(intervals))
        listed = F.array(*[F.get("edges", F.lit(i)) for i in around if i >= 0])
        return self.row.select(F.explode(listed).alias("k")).filter("k is not null")


def rank_bounds(
    df: DataFrame,
    order_by: Sequence[str],
    ranks: Sequence[int],
    *,
    splitters: int = SPLITTERS,
    numbered: int = NUMBERED,
) -> DataFrame:
    """``rank, bound``: for each rank k, the key of the k-th row by ``order_by``, as a struct.

    Ranks count from 1. The columns together must tell rows apart where a rank falls between
    equal ones; a row address (``with_row_address``) as the last column always does. Nulls
    come first, as in an ascending sort.
    """
    spark = df.sparkSession
    keyed = df.select(F.struct(*order_by).alias("k"))
    rows = df.count()
    if any(not 1 <= rank <= rows for rank in ranks):
        raise ValueError(f"ranks must lie between 1 and {rows}")
    # rank -> (interval, rank within it)
    left = {rank: (0, rank) for rank in ranks}
    count, cut = rows, None
    while count > numbered:
        inside = keyed if cut is None else _within(cut, keyed, left)
        sample = inside.sample(fraction=min(1.0, 4.0 * splitters / count), seed=17).select("k")
        kept = cut.bounds([interval for interval, _ in left.values()]) if cut is not None else None
        parent, cut = cut, _Cut(sample, kept, splitters)
        held = keyed if parent is None else _within(parent, keyed, left).drop("b").withColumnRenamed("p", "parent")
        if parent is None:
            held = held.withColumn("parent", F.lit(0))
        counts = sorted(tuple(r) for r in cut.placed(held).groupBy("parent", "b").count().collect())
        found, now = {}, {}
        for rank, (interval, within) in left.items():
            own = [(b, n) for p, b, n in counts if p == interval]
            for (b, n), through in zip(own, accumulate(n for _, n in own)):
                if within <= through:
                    found[rank] = (b, within - (through - n))
                    now[b] = n
                    break
        if sum(now.values()) >= count:
            raise ValueError(f"{list(order_by)} do not tell rows apart")
        left, count = found, sum(now.values())
    few = keyed.withColumn("p", F.lit(0)) if cut is None else _within(cut, keyed, left)
    order = Window.partitionBy("p").orderBy("k")
    numbers = few.select("p", "k", F.row_number().over(order).alias("n"), F.lead("k").over(order).alias("next"))
    wanted = spark.createDataFrame([(rank, p, n) for rank, (p, n) in left.items()], "rank bigint, p int, n int")
    bounds = written_side(numbers.join(F.broadcast(wanted), ["p", "n"]).select("rank", "k", "next"), "bounds")
    if bounds.filter("k = next").take(1):
        raise ValueError(f"{list(order_by)} do not tell rows apart")
    return bounds.select("rank", F.col("k").alias("bound"))


def _within(cut: _Cut, keyed: DataFrame, left: dict[int, tuple[int, int]]) -> DataFrame:
    """The keys of the open intervals, with the interval as ``p``."""
    some = sorted({interval for interval, _ in left.values()})
    return cut.placed(keyed).filter(F.col("b").isin(some)).withColumn("p", F.col("b"))


def prefixes_by(
    df: DataFrame, order_by: Sequence[str], fractions: Sequence[tuple[int, int]] = FRACTIONS
) -> list[DataFrame]:
    """The first ``num/den`` of the rows by the columns, for each fraction, as filters of ``df``.

    All bounds come from one search. The bound on the first column alone reaches the scan.
    """
    rows = df.count()
    sizes = [prefix_size(rows, num, den) for num, den in fractions]
    inner = sorted({size for size in sizes if 0 < size < rows})
    bounds = written_side(rank_bounds(df, order_by, inner), "prefix-bounds") if inner else None

    def prefix(size: int) -> DataFrame:
        if size == 0:
            return df.limit(0)
        if size == rows:
            return df
        bound = bounds.filter(F.col("rank") == size).select("bound").scalar()
        first = bounds.filter(F.col("rank") == size).select(F.col(f"bound.{order_by[0]}")).scalar()
        rough = F.col(order_by[0]).isNull() | (F.col(order_by[0]) <= first)
        # A null bound lies before all values: then only nulls pass the first filter.
        return df.filter(rough & (F.struct(*order_by) <= bound))

    return [prefix(size) for size in sizes]


def prefix_rows_by(df: DataFrame, num: int, den: int, order_by: Sequence[str]) -> DataFrame:
    """The first ``num/den`` of the rows by any columns that tell rows apart."""
    (prefix,) = prefixes_by(df, order_by, [(num, den)])
    return prefix
