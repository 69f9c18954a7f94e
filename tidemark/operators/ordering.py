"""Positions of files and rows.

A DataFrame has no order, so order is a column: ``file_ord`` of the dataset list, the
position of a row in its scan, or a key of the table itself.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import written_side

FILE, BLOCK, URI = "scan_file", "scan_block", "scan_uri"


def plain_file(file_path: Column) -> Column:
    """A path from ``_metadata``, which is URL-encoded, as it is written, without the local scheme."""
    # url_decode reads "+" as a space, but in a path it stands for itself.
    decoded = F.url_decode(F.replace(file_path, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(decoded, "^file:/+", "/")


def with_scan_position(scan: DataFrame) -> DataFrame:
    """Add the file and the split each row of a file scan comes from."""
    return scan.select(
        "*",
        plain_file(F.col("_metadata.file_path")).alias(FILE),
        F.col("_metadata.file_block_start").alias(BLOCK),
    )


def running_before(
    df: DataFrame, order: Sequence[Column | str], value: Column, name: str
) -> DataFrame:
    """Add ``name``: the sum of ``value`` over the rows before each row in ``order``.

    The rows are range partitioned and written, each partition adds up its own rows, and
    starts at the sum of the partitions before it, of which the driver sees one number
    each. So no task sees more than a partition, however many rows there are.
    """
    ranged = df.repartitionByRange(*order).withColumns(
        {"__part": F.spark_partition_id(), "__value": value}
    )
    held = written_side(ranged, name)
    sums = held.groupBy("__part").agg(F.sum("__value").alias("total")).orderBy("__part").collect()
    starts, total = [], 0
    for row in sums:
        starts.append((row["__part"], total))
        total += row.total or 0
    spark = df.sparkSession
    first = F.broadcast(spark.createDataFrame(starts, "__part int, __start bigint"))
    within = (
        Window.partitionBy("__part")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        held.withColumn(name, F.coalesce(F.sum("__value").over(within), F.lit(0)))
        .join(first, "__part")
        .withColumn(name, (F.col(name) + F.col("__start")).cast("bigint"))
        .drop("__part", "__value", "__start")
    )


def part_number(path: Column) -> Column:
    """The number of a part file; part files follow each other by it, not by their text."""
    return F.coalesce(F.regexp_extract(path, r"/part-(\d+)[^/]*$", 1).try_cast("bigint"), F.lit(0))


def file_order(path: Column) -> list[Column]:
    """What files are sorted by: folder, number of the part file, path."""
    return [F.regexp_extract(path, r"^(.*)/[^/]*$", 1), part_number(path), path]


def with_row_index(
    scan: DataFrame, datasets: DataFrame | None = None, name: str = "row_index"
) -> DataFrame:
    """Number the rows of a scan from 0, in file order and line order.

    ``scan`` comes from ``with_scan_position`` and has not been shuffled since. Files go
    by path (part files by their number), or in the order of a dataset list (``dataset,
    file_ord``) if the scan has a ``dataset`` column to find them by; rows of datasets not
    listed are left out then.

    A row's number is the sum of the rows in the splits before its own, and its place in that
    split, where the rows follow each other in one task. Rows are grouped by split for it, which
    is as evenly as the scan was cut. Read the scan in a ``pinned`` session, so that it is cut the
    same way whatever happens between the pass that counts and the one that numbers.
    """
    rows = scan.withColumn("__id", F.monotonically_increasing_id())
    count = F.count("*").alias("__rows")
    if datasets is None:
        splits = rows.groupBy(FILE, BLOCK).agg(count).withColumn("file_ord", F.lit(0))
    else:
        named = rows.groupBy(FILE, BLOCK, "dataset").agg(count)
        splits = assign_file_ord(named, datasets, how="left")
    listed = F.col("file_ord").isNotNull()
    order = [F.col("file_ord").asc_nulls_last(), *file_order(F.col(FILE)), BLOCK]
    placed = running_before(splits, order, F.when(listed, F.col("__rows")).otherwise(0), "__before")
    offsets = placed.filter(listed).select(FILE, BLOCK, "__rows", "__before")
    place = F.row_number().over(Window.partitionBy(FILE, BLOCK).orderBy("__id")) - 1
    known = rows.withColumn("__place", place).join(offsets, [FILE, BLOCK])
    # More rows than were counted: the file is another one by now.
    index = F.when(F.col("__place") < F.col("__rows"), F.col("__before") + F.col("__place")).otherwise(
        F.raise_error(F.lit("a file has changed since its rows were counted"))
    )
    return known.withColumn(name, index.cast("bigint")).drop("__id", "__place", "__rows", "__before", FILE, BLOCK)


def first_rows(scan: DataFrame, counts: DataFrame, size: int) -> DataFrame:
    """The first ``size`` rows of a scan from ``with_scan_position``, in file and line order.

    ``counts`` has ``file, start, rows, rows_before`` of its splits (``row_ranks``). Splits that
    end before the last row pass as they are; only the rows of the one in which it lies are
    numbered, and these are no more than a split holds.
    """
    inside = counts.filter((F.col("rows_before") < size) & (F.col("rows") > 0))
    edge = inside.filter(F.col("rows_before") + F.col("rows") > size).select("file", "start", "rows_before").first()
    whole = inside.filter(F.col("rows_before") + F.col("rows") <= size)
    splits = whole.select(F.col("file").alias(FILE), F.col("start").alias(BLOCK))
    passed = scan.join(splits, [FILE, BLOCK], "left_semi").drop(FILE, BLOCK)
    if edge is None:
        return passed
    last = scan.filter((F.col(FILE) == edge.file) & (F.col(BLOCK) == edge.start))
    order = Window.partitionBy(FILE, BLOCK).orderBy("__id")
    numbered = last.withColumn("__id", F.monotonically_increasing_id()).withColumn("__place", F.row_number().over(order))
    within = numbered.filter(F.col("__place") <= size - edge.rows_before)
    return passed.unionByName(within.drop("__id", "__place", FILE, BLOCK))


def assign_file_ord(
    df: DataFrame, datasets: DataFrame, column: str = "dataset", how: str = "inner"
) -> DataFrame:
    """Add ``file_ord`` of the dataset list to the rows of its datasets.

    Names must be unique in the list, as a name listed twice would repeat its rows.
    """
    twice = datasets.groupBy(column).count().filter("count > 1").take(3)
    if twice:
        raise ValueError(f"listed more than once: {[row[column] for row in twice]}")
    return df.join(datasets.select("file_ord", column), column, how)


INTEGER_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
BUCKET_BITS = 16


def order_cutoffs(df: DataFrame, key: str, ranks: Sequence[int]) -> list[int | None]:
    """For each rank k, the value of the unique integer ``key`` in the k-th row by ``key``.

    ``key <= cutoff`` then selects exactly the first k rows, by a filter that reaches
    the scan, where sorting and numbering the table would shuffle all of it. None
    stands for an empty prefix.

    The search counts rows per leading bits of the key, keeps the buckets in which a
    rank falls, and splits only those by the next bits: at most five passes over the
    key column, each shuffling bucket counts instead of rows.
    """
    if not isinstance(df.schema[key].dataType, INTEGER_TYPES):
        raise TypeError(f"{key} must be an integer column")
    keys = df.select(F.col(key).cast("bigint").alias("k"))
    low, high, rows, filled = keys.agg(
        F.min("k"), F.max("k"), F.count("*"), F.count("k")
    ).first()
    if rows != filled:
        raise ValueError(f"{key} has nulls")
    if any(not 0 <= rank <= rows for rank in ranks):
        raise ValueError(f"ranks must lie between 0 and {rows}")

    cutoffs: dict[int, int | None] = {0: None, rows: high}
    shift = 0
    while (high or 0) >> shift > ((low or 0) >> shift) + (1 << BUCKET_BITS) - 1:
        shift += 1
    # rank -> (bucket it falls in at the last pass, rank within that bucket)
    open_ranks: dict[int, tuple[int | None, int]] = {
        rank: (None, rank) for rank in ranks if rank not in cutoffs
    }
    parent, parent_shift = F.lit(None).cast("bigint"), None
    while open_ranks:
        candidates = keys
        if parent_shift is not None:
            parent = F.shiftright("k", parent_shift)
            candidates = keys.filter(parent.isin(sorted({b for b, _ in open_ranks.values()})))
        counts = candidates.groupBy(
            parent.alias("parent"), F.shiftright("k", shift).alias("bucket")
        ).count()
        through = F.sum("count").over(Window.partitionBy("parent").orderBy("bucket"))
        counts = counts.withColumn("through", through).withColumn(
            "before", F.col("through") - F.col("count")
        )
        hit = reduce(
            or_,
            [
                F.col("parent").eqNullSafe(F.lit(b))
                & (F.col("before") < r)
                & (F.col("through") >= r)
                for b, r in open_ranks.values()
            ],
        )
        found = counts.filter(hit).collect()
        step: dict[int, tuple[int | None, int]] = {}
        for rank, (bucket, within) in open_ranks.items():
            row = next(
                x for x in found if x.parent == bucket and x.before < within <= x.through
            )
            if shift > 0:
                step[rank] = (row.bucket, within - row.before)
            elif row.through == within:
                cutoffs[rank] = row.bucket
            else:
                raise ValueError(f"{key} is not unique: {row['count']} rows hold {row.bucket}")
        open_ranks, parent_shift, shift = step, shift, max(0, shift - BUCKET_BITS)
    return [cutoffs[rank] for rank in ranks]
