"""Measurement tables kept as many CSV files, each with a header line."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import as_measure, dataset_of_file
from tidemark.operators.ordering import URI, first_rows, with_scan_position
from tidemark.sources.file_catalog import (
    FileHeader,
    Headers,
    catalog_rows,
    describe_files,
    list_files,
    literal_path,
    owner_of,
    parsed_header,
    pinned,
    plain_path,
    row_ranks,
)

#: Up to so many files, only their first lines are read.
HEADER_BATCH = 128
COUNT_BATCH = 64
#: A scan by name has so many files at most; their places are sent to every executor.
ROUTED_FILES = 1 << 20
#: Parts of a table that is scanned over and over as whole files: up to so many for each core, of
#: so many bytes at least.
PARTS_PER_CORE = 12
FEWEST_BYTES = 2 << 20
UNITS = {"": 0, "b": 0, "k": 10, "kb": 10, "m": 20, "mb": 20, "g": 30, "gb": 30}


def file_headers(spark: SparkSession, paths: Sequence[str]) -> Headers:
    """For each path the files in it, each with the column names in its first line.

    One job lists the files. Another one reads the first lines of up to ``HEADER_BATCH`` files, and
    stops in each file after that line; more files are read in one scan, which a catalog
    (``refresh_catalog``) spares the next time. Files without any line are left out.
    """
    if not paths:
        return {}
    files = sorted(tuple(row) for row in list_files(spark, paths).toLocalIterator())
    plain = {plain_path(path): path for path in paths}
    found: dict[str, list[FileHeader]] = {path: [] for path in paths}
    if not files:
        return found
    if len(files) <= HEADER_BATCH:
        # In one partition the limit needs no shuffle, and so no job of its own.
        firsts = [
            spark.read.text(literal_path(file))
            .filter(F.trim("value") != "")
            .coalesce(1)
            .limit(1)
            .select(F.lit(file).alias("file"), F.col("value").alias("header"))
            for file, *_ in files
        ]
        lines = reduce(DataFrame.union, firsts)
    else:
        lines = describe_files(spark, [file for file, *_ in files]).select("file", "header")
    headers = {row.file: row.header for row in lines.toLocalIterator()}
    for file, size, modified, uri in files:
        if headers.get(file) is not None:
            entry = FileHeader(file, parsed_header(headers[file]), size, modified, uri)
            found[owner_of(file, plain)].append(entry)
    return found


def header_groups(
    spark: SparkSession, paths: Sequence[str], headers: Headers | None = None
) -> dict[tuple[str, ...], list[str]]:
    """The files of the paths, grouped by the column names in their first line."""
    known = file_headers(spark, paths) if headers is None else headers
    groups: dict[tuple[str, ...], list[str]] = {}
    for path in paths:
        for entry in known[path]:
            groups.setdefault(entry[1], []).append(entry[0])
    return groups


def read_measurements(
    spark: SparkSession,
    paths: Sequence[str],
    *,
    base_path: str | None = None,
    with_dataset: bool = False,
    with_position: bool = False,
    with_uri: bool = False,
    one_header: bool = False,
    check_headers: bool = True,
    headers: Headers | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """All files as one table, matched by column *name*; every column is text.

    A CSV scan takes its names from one file and applies them to the others by position, which
    mixes up columns when the files differ. Files that agree are read by one scan with their
    names. Files that differ are read by one scan too, whose cells are numbered, and each
    name takes the cell that the header of the row's file gives it, so the plan does not
    grow with the number of headers. Columns a file lacks are null.

    With ``check_headers`` a file that has changed since its header was read is an error.
    ``one_header`` reads only the headers of the first path and takes them for all files; the
    scan then compares every file's header with it, unless ``check_headers`` is off. ``headers``
    are those of ``file_headers`` or ``catalog_headers``, of these paths or more, for many
    reads that need them once.

    ``base_path`` is the root that ``write_measurements`` wrote to, if the paths lie
    below one; its folders then give a ``dataset`` column that prunes files.
    ``with_dataset`` takes that column from the file names instead (``NAME.csv``).
    ``with_position`` adds the scan position that ``with_row_index`` needs. ``with_uri`` adds ``scan_uri``,
    the path as the scan has it, which is the ``uri`` of a catalog.
    ``multi_line`` allows quoted cells that go over line breaks; files are then not cut.
    """
    own = pinned(spark) if with_position or with_uri else spark
    reader = own.read.option("header", True).option("multiLine", multi_line)
    if base_path is not None:
        reader = reader.option("basePath", base_path)
    else:
        reader = reader.option("recursiveFileLookup", True)

    def scan(columns: Sequence[str], files: Sequence[str], by_place: bool) -> DataFrame:
        names = [*columns, "dataset"] if base_path is not None else columns
        schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
        df = reader.option("enforceSchema", by_place or not check_headers).schema(schema).csv(files)
        if with_uri:
            df = df.select("*", F.col("_metadata.file_path").alias(URI))
        return with_scan_position(df) if with_position else df

    def file_dataset(df: DataFrame) -> DataFrame:
        if not with_dataset or base_path is not None:
            return df
        return df.withColumn("dataset", dataset_of_file(F.col("_metadata.file_name")))

    paths = list(paths)
    if not paths:
        raise ValueError("no paths to read")
    first = paths[:1] if one_header else paths
    known = file_headers(spark, first) if headers is None else headers
    groups = header_groups(spark, first, known)
    if not groups:
        raise ValueError("no header line found")
    if len(groups) == 1 or one_header:
        (columns, files), *_ = groups.items()
        return file_dataset(scan(columns, paths if one_header else [literal_path(f) for f in files], False))
    entries = [FileHeader(*entry) for path in paths for entry in known[path]]
    parts = []
    for at in range(0, len(entries), ROUTED_FILES):
        routed = entries[at : at + ROUTED_FILES]
        cells = [f"__cell{i}" for i in range(max(len(entry.header) for entry in routed))]
        cut = file_dataset(scan(cells, [literal_path(entry.file) for entry in routed], True))
        parts.append(_by_name(cut, cells, routed, check_headers))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _by_name(
    cut: DataFrame, cells: Sequence[str], entries: Sequence[FileHeader], check: bool
) -> DataFrame:
    """The numbered cells of a scan of several headers, under their names.

    Two small tables say which header a file has and where that header has each name. Files are
    found by a hash of their path, so a file takes a few bytes, less than the scan's own list of
    files holds of it.
    """
    if any(entry.uri is None for entry in entries):
        raise ValueError("headers must come from file_headers or catalog_headers")
    spark = cut.sparkSession
    exact = spark.conf.get("spark.sql.caseSensitive") == "true"
    same = (lambda name: name) if exact else str.lower
    names: dict[str, str] = {}
    for header in dict.fromkeys(entry.header for entry in entries):
        for name in header:
            names.setdefault(same(name), name)
    numbers: dict[tuple[str, ...], int] = {}
    for entry in entries:
        numbers.setdefault(entry.header, len(numbers))
    folded = {header: [same(name) for name in header] for header in numbers}
    # For each name the cells that hold it in some file; a header tells which of these it is.
    held = {key: sorted({h.index(key) for h in folded.values() if key in h}) for key in names}
    place_rows = [
        (number, [held[key].index(folded[h].index(key)) if key in folded[h] else None for key in names])
        for h, number in numbers.items()
    ]
    places = spark.createDataFrame(place_rows, "__header int, __places array<int>")
    # A path is known by two hashes of it, 128 bits together.
    keys = lambda uri: {"__k1": F.xxhash64(uri), "__k2": F.xxhash64(F.lit(1), uri)}
    route_rows = {e.uri: (e.uri, numbers[e.header], e.size, e.modified) for e in entries}
    routes = spark.createDataFrame(list(route_rows.values()), "uri string, __header int, __size bigint, __modified bigint")
    routes = routes.withColumns(keys("uri")).drop("uri")
    scanned = cut.withColumns(
        keys(F.col("_metadata.file_path"))
        | {"__now": F.struct(F.col("_metadata.file_size"), F.unix_micros("_metadata.file_modification_time"))}
    )
    refuse = lambda why: F.raise_error(F.lit(why)).cast("boolean")
    sound = F.when(F.col("__header").isNull(), refuse("a file is not among those whose headers are known"))
    if check:
        same_file = F.col("__now") == F.struct("__size", "__modified")
        sound = sound.when(~same_file, refuse("a file has changed since its header was read"))
    # No row is lost for a file that is not found: that is an error.
    routed = scanned.join(F.broadcast(routes), ["__k1", "__k2"], "left").filter(sound.otherwise(True))
    joined = routed.join(F.broadcast(places), "__header")
    columns = [
        F.get(F.array(*[F.col(cells[i]) for i in held[key]]), F.get("__places", F.lit(j))).alias(name)
        for j, (key, name) in enumerate(names.items())
    ]
    extra = [c for c in cut.columns if c not in cells]
    return joined.select(*columns, *extra)


#: Fixed value: what Spark writes as %XX in the name of a partition folder.
ESCAPED = re.compile("[\x00-\x1f\"#%'*/:=?\\\\\x7f{}\\[\\]^]")
LAYOUTS = ("files", "folders")


def dataset_paths(datasets: DataFrame, folder: str, layout: str = "files") -> list[str]:
    """CSV paths of a dataset list, in list order.

    ``files`` are ``FOLDER/NAME.csv``, ``folders`` the ones that ``write_measurements``
    makes. The list names the files of a scan, and the driver plans a scan from its paths.
    """
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {LAYOUTS}")
    root = folder.rstrip("/")
    rows = datasets.select("file_ord", "dataset", "file").orderBy("file_ord").toLocalIterator()
    if layout == "files":
        return [f"{root}/{row.file}" for row in rows]
    escape = lambda name: ESCAPED.sub(lambda c: f"%{ord(c[0]):02X}", name)
    return [f"{root}/dataset={escape(row.dataset)}" for row in rows]


def write_measurements(
    df: DataFrame,
    path: str,
    *,
    dataset: str = "dataset",
    sort_by: Sequence[str] = (),
    drop: Sequence[str] = (),
    rebalance: bool = True,
    parts: int | None = None,
    mode: str = "overwrite",
) -> None:
    """CSV with header lines, one folder ``dataset=NAME`` per dataset.

    The rebalance brings the rows of a dataset together, so that small datasets do not
    end in one file per task, and lets Spark cut a dataset that holds much of the
    table into several tasks. Leave it out for rows that already lie by dataset.
    With ``sort_by`` the rows of a dataset are in that order, through all its part files:
    they are range partitioned by it, into ``parts`` ranges of about as many rows (see ``part_count``)
    or as many as Spark finds fit. ``drop`` leaves out columns that only order.
    """
    if parts is not None and not (sort_by and rebalance):
        raise ValueError("parts are ranges, so they need sort_by and rebalance")
    out = df.withColumnRenamed(dataset, "dataset")
    if sort_by:
        if rebalance:
            ranges = ["dataset", *sort_by] if parts is None else [parts, "dataset", *sort_by]
            out = out.repartitionByRange(*ranges)
        out = out.sortWithinPartitions("dataset", *sort_by)
    elif rebalance:
        out = out.hint("rebalance", F.col("dataset"))
    out.drop(*drop).write.partitionBy("dataset").option("header", True).mode(mode).csv(path)


def _bytes(spark: SparkSession, key: str) -> int:
    """A size among the settings of the session, such as ``16m``."""
    number, unit = re.fullmatch(r"(\d+)([a-z]*)", spark.conf.get(key).strip().lower()).groups()
    return int(number) << UNITS[unit]


def part_count(spark: SparkSession, rows: int, row_bytes: int) -> int | None:
    """Into how many parts to write rows of about so many bytes, for scans that do not cut files.

    Such a scan puts whole files together into one partition for each core. They come out even
    if there are several files for each. As Spark adds the cost of opening to each file, there are no more
    than fit before a scan would have more partitions for it; None, as many as Spark finds fit, where
    the bytes alone give more than one for each core.
    """
    cores, size = spark.sparkContext.defaultParallelism, rows * row_bytes
    room = cores * _bytes(spark, "spark.sql.files.maxPartitionBytes") - size
    fitting = room // max(_bytes(spark, "spark.sql.files.openCostInBytes"), 1)
    if fitting < cores:
        return None
    return max(min(PARTS_PER_CORE * cores, fitting, -(-size // FEWEST_BYTES)), 1)


def write_columnar(df: DataFrame, path: str, measures: Sequence[str]) -> None:
    """The table as Parquet with the measures as doubles.

    Text is parsed on every scan; a study that scans the same data for every partition
    count parses it once this way.
    """
    numbers = {m: as_measure(m) for m in measures}
    df.withColumns(numbers).write.mode("overwrite").parquet(path)


def rows_to_table(
    spark: SparkSession, rows: Iterable[Sequence], columns: Sequence[str] | T.StructType | str
) -> DataFrame:
    """Rows the driver already holds (such as timing records) as a table."""
    return spark.createDataFrame(list(rows), columns)


def known_row_counts(catalog: DataFrame, datasets: DataFrame, layout: str = "files") -> DataFrame:
    """``file_ord, dataset, rows`` of a dataset list, out of a catalog of its files.

    ``layout`` tells how the data lie (see ``dataset_paths``). A dataset without a file has 0 rows.
    """
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {LAYOUTS}")
    # The name of the file, or of the folder around it with the signs that Spark escapes.
    own = F.regexp_extract("file", r"/([^/]*)$", 1)
    if layout == "folders":
        folder = F.regexp_extract("file", r"/dataset=([^/]*)/[^/]*$", 1)
        own = F.url_decode(F.replace(folder, F.lit("+"), F.lit("%2B")))
    rows = catalog.select(own.alias("__own"), "rows").groupBy("__own").agg(F.sum("rows").alias("rows"))
    key = "dataset" if layout == "folders" else "file"
    return datasets.join(rows, F.col(key) == F.col("__own"), "left").select(
        "file_ord", "dataset", F.coalesce("rows", F.lit(0)).alias("rows")
    )


def row_budget_paths(spark: SparkSession, paths: Sequence[str], budget: int) -> list[tuple[str, int]]:
    """(path, rows) in list order until more than ``budget`` rows are in.

    Files are counted in growing batches, all files of a batch in one scan, and no batch is opened
    once the budget is exceeded. For files of a catalog, ``row_budget_files`` over
    ``known_row_counts`` answers without opening any.
    """
    total, chosen, size = 0, [], 1
    while len(chosen) < len(paths) and total <= budget:
        batch = list(paths[len(chosen) : len(chosen) + size])
        for path, rows in zip(batch, row_counts(spark, batch)):
            total += rows
            chosen.append((path, rows))
            if total > budget:
                break
        size = min(2 * size, COUNT_BATCH)
    return chosen


def read_row_budget(spark: SparkSession, paths: Sequence[str], budget: int, **options) -> DataFrame:
    """Whole files in list order until more than ``budget`` rows are in.

    ``options`` go to ``read_measurements``.
    """
    chosen = row_budget_paths(spark, list(paths), budget)
    return read_measurements(spark, [path for path, _ in chosen], **options)


def read_row_prefix(
    spark: SparkSession, counted: Sequence[tuple[str, int]], size: int, **options
) -> DataFrame:
    """The first ``size`` rows of the files (path, rows), in list order and line order.

    Files that end before the last row are read as they are, the one it lies in up to the block of
    that row, and no other is opened. ``options`` go to ``read_measurements``.
    """
    whole, left, parts = [], size, []
    for path, rows in counted:
        if rows > left:
            if left:
                edge = read_measurements(spark, [path], with_position=True, **options)
                parts.append(first_rows(edge, block_ranks(spark, [path]), left))
            break
        whole.append(path)
        left -= rows
    if whole or not parts:
        first = read_measurements(spark, whole or [counted[0][0]], **options)
        parts.insert(0, first if whole else first.limit(0))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def block_ranks(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``file, start, rows, rows_before`` of the blocks of the paths, from a scan of them."""
    files = [row.file for row in list_files(spark, paths).toLocalIterator()]
    return row_ranks(describe_files(spark, files))


def row_counts(spark: SparkSession, paths: Sequence[str]) -> list[int]:
    """Rows of each path, from one scan of them all."""
    paths = list(paths)
    if not paths:
        return []
    # Lines are counted and no cell is parsed.
    return catalog_rows(describe_files(spark, paths), paths)
