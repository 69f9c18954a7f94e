"""A stored table of measurement files: what each one holds, found out once.

A file is known by its path, size and time of change. The first time it is seen, one scan over
all such files finds its header line and how many rows lie in each block of it; after that it is
not opened again to learn this. Blocks are cut at multiples of a fixed number of bytes, whatever
the session or the number of cores is, so the counts of a block are an index from row numbers to
places in files that any later scan can use.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.ordering import file_order, plain_file, running_before
from tidemark.session import written_side

#: Files are cut at multiples of so many bytes.
BLOCK_BYTES = 8 << 20
ENTRY = (
    "file string, size bigint, modified bigint, uri string, header string, rows bigint, open_quotes bigint, "
    "blocks array<struct<start:bigint,rows:bigint>>"
)
KEY = ["file", "size", "modified"]


class FileHeader(NamedTuple):
    """A file, the column names in its first line, and what it was like when they were read."""

    file: str
    header: tuple[str, ...]
    size: int | None = None
    modified: int | None = None
    uri: str | None = None


Headers = Mapping[str, Sequence[FileHeader]]


def pinned(spark: SparkSession, block_bytes: int = BLOCK_BYTES) -> SparkSession:
    """A session like this one whose scans cut files at multiples of ``block_bytes``.

    Spark lets the number of cores decide otherwise, so two sessions would number blocks apart.
    """
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and own.conf.isModifiable(key):
            own.conf.set(key, value)
    own.conf.set("spark.sql.files.maxPartitionBytes", str(block_bytes))
    own.conf.set("spark.sql.files.openCostInBytes", str(min(block_bytes, 1 << 20)))
    # As if there were one core: then the block is never made smaller to keep many busy.
    own.conf.set("spark.sql.files.minPartitionNum", "1")
    return own


def plain_path(path: str) -> str:
    """A path without the local scheme and a slash at its end, as listings differ in both."""
    return re.sub(r"^file:/+", "/", path).rstrip("/")


def literal_path(path: str) -> str:
    """The path with the signs of path patterns escaped."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def parsed_header(line: str) -> tuple[str, ...]:
    return tuple(next(csv.reader([line.removeprefix("﻿")])))


def list_files(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``file, size, modified, uri`` of every file of the paths that has a byte; none is opened.

    ``uri`` is the path as ``_metadata.file_path`` of a scan has it.
    """
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(paths))
    return listing.select(
        plain_file(F.col("_metadata.file_path")).alias("file"),
        F.col("_metadata.file_size").alias("size"),
        F.unix_micros("_metadata.file_modification_time").alias("modified"),
        F.col("_metadata.file_path").alias("uri"),
    ).distinct()


def _open_quote(line: Column) -> Column:
    """Whether a quoted cell of the line does not end in it."""
    quotes = F.regexp_count(line, F.lit(r'(?<!\\)"'))
    return F.contains(line, F.lit('"')) & (quotes % 2 == 1)


def describe_files(spark: SparkSession, files: Sequence[str], block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """An entry for each of the files that has a line, from one scan.

    A row is a line that is not blank, but for the first one of the file, which is its header.
    ``open_quotes`` counts the lines that end inside a quoted cell.
    """
    reader = pinned(spark, block_bytes).read.option("recursiveFileLookup", True)
    lines = reader.text([literal_path(f) for f in files]).select(
        "value",
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_size").alias("size"),
        F.unix_micros("_metadata.file_modification_time").alias("modified"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("id"),
    )
    filled = lines.filter(F.trim("value") != "")
    # Combined before the shuffle: a row for each block.
    blocks = filled.groupBy("path", "size", "modified", "start").agg(
        F.count("*").alias("lines"),
        F.min_by("value", "id").alias("first"),
        F.count_if(_open_quote(F.col("value"))).alias("open_quotes"),
    )
    at_start = F.col("start") == 0
    rows = F.col("lines") - F.when(at_start, 1).otherwise(0)
    return (
        blocks.groupBy("path", "size", "modified")
        .agg(
            F.max(F.when(at_start, F.col("first"))).alias("header"),
            F.sum(rows).alias("rows"),
            F.sum("open_quotes").alias("open_quotes"),
            F.sort_array(F.collect_list(F.struct("start", rows.alias("rows")))).alias("blocks"),
        )
        .select(plain_file(F.col("path")).alias("file"), "size", "modified", "header", "rows", "open_quotes", "blocks")
    )


def read_catalog(spark: SparkSession, folder: str) -> DataFrame:
    """Every entry ever stored in the folder; none if there is no such folder."""
    try:
        stored = spark.read.schema(ENTRY).parquet(folder)
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return spark.createDataFrame([], ENTRY)
    # Two jobs that bring it up to date at once may both have entered a file.
    return stored.dropDuplicates(KEY)


def refresh_catalog(
    spark: SparkSession, paths: Sequence[str], folder: str, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """The entries of the files that the paths hold now, in the catalog at ``folder``.

    Only files that are new or have changed are opened, all in one scan, and their entries are
    added. Entries of files that are gone or were other then stay and match nothing. The number
    of jobs does not depend on the number of files; the driver takes the names of the new ones,
    which it needs to plan their scan.
    """
    if not paths:
        return spark.createDataFrame([], ENTRY)
    listed = written_side(list_files(spark, paths), "listing")
    new = listed.join(read_catalog(spark, folder), KEY, "left_anti")
    files = sorted(row.file for row in new.select("file").toLocalIterator())
    if files:
        found = describe_files(spark, files, block_bytes).drop("size", "modified")
        # Files without a line give no row to the scan; files that changed under way are
        # entered as they were listed, and so are read anew next time.
        entries = new.join(found, "file", "left").withColumns(
            {"rows": F.coalesce("rows", F.lit(0)), "open_quotes": F.coalesce("open_quotes", F.lit(0))}
        )
        names = [field.split(" ")[0] for field in ENTRY.split(", ")]
        entries.select(*names).write.mode("append").parquet(folder)
    return listed.drop("uri").join(read_catalog(spark, folder), KEY)


def catalog_headers(catalog: DataFrame, paths: Sequence[str], *, multi_line: bool = False) -> Headers:
    """For each path its files with their column names; files without a line are left out.

    Files with quoted cells that go over a line break are refused, unless they are to be read with
    ``multi_line``, as a scan by lines would take them apart.
    """
    broken = [row.file for row in catalog.filter("open_quotes > 0").select("file").take(3)]
    if broken and not multi_line:
        raise ValueError(f"quoted cells go over line breaks; read with multi_line: {broken}")
    rows = catalog.filter("header is not null").select(*KEY, "uri", "header").toLocalIterator()
    names: dict[str, tuple[str, ...]] = {}
    found: dict[str, list[FileHeader]] = {path: [] for path in paths}
    plain = {plain_path(path): path for path in paths}
    for row in sorted(rows):
        header = names.setdefault(row.header, parsed_header(row.header))
        owner = owner_of(row.file, plain)
        if owner is not None:
            found[owner].append(FileHeader(row.file, header, row.size, row.modified, row.uri))
    return found


def owner_of(file: str, plain: Mapping[str, str]) -> str | None:
    """The path that a file lies in."""
    at = plain_path(file)
    while at not in plain and "/" in at:
        at = at.rpartition("/")[0]
    return plain.get(at)


def catalog_rows(catalog: DataFrame, paths: Sequence[str]) -> list[int]:
    """Rows of each path."""
    plain = {plain_path(path): path for path in paths}
    totals = dict.fromkeys(paths, 0)
    for row in catalog.select("file", "rows").toLocalIterator():
        owner = owner_of(row.file, plain)
        if owner is not None:
            totals[owner] += row.rows
    return [totals[path] for path in paths]


def row_ranks(catalog: DataFrame) -> DataFrame:
    """``file, start, rows, rows_before``: how many rows lie before each block, over all files.

    Files go by path, part files by their number. The index has a row for each block, so it is
    sparse, and it is the same however the files were cut when they were read.
    """
    blocks = catalog.select("file", F.inline("blocks"))
    return running_before(blocks, [*file_order(F.col("file")), "start"], F.col("rows"), "rows_before")
