"""A sorted list of distinct links that is brought up to date range by range.

The list is kept as ranges of links that follow each other, each one sorted and in files of its own,
and a table that tells the first link a range may hold, where its files are and how many
links it has. New links are compared with the ranges that they fall in, and only the ranges that
get some are written anew, into a new folder; the table of the ranges is then written as a whole
under the next number. A reader always sees one table, so a merge that fails changes nothing.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.ordering import running_before
from tidemark.operators.ranks import interval_of
from tidemark.session import written_side

#: Links in a range, about.
RANGE_LINKS = 1_000_000
MANIFEST = "version bigint, low string, folder string, range int, part int, links bigint"


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """``version, low, folder, range, part, links`` of the ranges of the list as it is now."""
    try:
        every = spark.read.schema(MANIFEST).parquet(f"{path.rstrip('/')}/manifest")
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return spark.createDataFrame([], MANIFEST)
    last = every.agg(F.max("version")).first()[0]
    return every.filter(F.col("version") == F.lit(last))


def _read(spark: SparkSession, path: str, ranges: DataFrame) -> DataFrame:
    """``link, folder, range, part`` of the given ranges; no other file is opened."""
    root = path.rstrip("/")
    rows = ranges.select("folder", "range", "part").toLocalIterator()
    paths = [f"{root}/{row.folder}/range={row.range}/part={row.part}" for row in rows]
    if not paths:
        return spark.createDataFrame([], "link string, folder string, range int, part int")
    where = r"/([^/]+)/range=(\d+)/part=(\d+)/[^/]*$"
    file = F.col("_metadata.file_path")
    return spark.read.text(paths).select(
        F.col("value").alias("link"),
        F.regexp_extract(file, where, 1).alias("folder"),
        F.regexp_extract(file, where, 2).cast("int").alias("range"),
        F.regexp_extract(file, where, 3).cast("int").alias("part"),
    )


def merge_links(links: DataFrame, path: str, column: str = "link", range_links: int = RANGE_LINKS) -> int:
    """Adds the links to the sorted list at ``path``; the number of ranges that were written.

    Links that the list has already change nothing. A link must not have a line break.
    """
    spark = links.sparkSession
    old = written_side(read_manifest(spark, path), "manifest")
    version = (old.agg(F.max("version")).first()[0] or 0) + 1
    given = links.select(F.col(column).alias("link")).filter("link is not null").distinct()
    held = old.agg(F.array_sort(F.collect_list(F.struct("low", "folder", "range", "part"))).alias("ranges"))
    held = written_side(held.withColumn("lows", F.transform("ranges", lambda r: r["low"])), "lows")
    known = held.select(F.size("lows")).first()[0]
    if known:
        # The range of a link is the last one that begins at or before it.
        placed = interval_of(given.withColumnRenamed("link", "k"), held.select("lows"), known)
        owner = F.get("ranges", F.col("b") - 1)
        placed = placed.withColumn("ranges", held.select("ranges").scalar()).select(F.col("k").alias("link"), owner.alias("own"))
        placed = placed.select("link", "own.low", "own.folder", "own.range", "own.part")
    else:
        placed = given.select("link", F.lit("").alias("low"), *[F.lit(None).cast(t).alias(c) for c, t in (("folder", "string"), ("range", "int"), ("part", "int"))])
    placed = written_side(placed, "placed-links")
    touched = placed.select("folder", "range", "part").distinct().filter("folder is not null")
    there = _read(spark, path, touched)
    new = written_side(placed.join(there.select("link"), "link", "left_anti"), "new-links")
    if not new.take(1):
        return 0
    changed = written_side(new.select("low", "folder", "range", "part").distinct(), "changed-ranges")
    kept = there.join(changed, ["folder", "range", "part"]).select("link", "low")
    merged = written_side(kept.unionByName(new.select("link", "low")), "merged-links")

    # Ranges that have grown are cut into several; a new range lies in one old range.
    count = merged.count()
    parts = count // range_links + 1
    folder = f"run-{uuid.uuid4().hex}"
    lows = changed.select("low", F.dense_rank().over(Window.orderBy("low")).alias("range"))
    ranged = merged.join(lows, "low").repartitionByRange(parts, "range", "link").withColumn("part", F.spark_partition_id())
    ranged = written_side(ranged, "ranged-links")
    out = ranged.repartitionByRange(parts, "range", "part").sortWithinPartitions("range", "part", "link")
    out.select("link", "range", "part").write.partitionBy("range", "part").text(f"{path.rstrip('/')}/{folder}")
    sizes = ranged.groupBy("low", "range", "part").agg(F.min("link").alias("first"), F.count("*").alias("links"))
    # The first part of an old range begins where that range began, so that no link lies between.
    leads = F.row_number().over(Window.partitionBy("range").orderBy("part")) == 1
    made = sizes.withColumn("lead", leads).select(
        F.lit(version).cast("bigint").alias("version"),
        F.when(F.col("lead"), F.col("low")).otherwise(F.col("first")).alias("low"),
        F.lit(folder).alias("folder"), "range", "part", "links",
    )
    stay = old.join(changed, ["folder", "range", "part"], "left_anti").withColumn("version", F.lit(version).cast("bigint"))
    whole = made.unionByName(stay.select(*made.columns))
    whole.coalesce(1).write.mode("append").parquet(f"{path.rstrip('/')}/manifest")
    return made.count()


def read_merged_links(spark: SparkSession, path: str) -> DataFrame:
    """``file_ord, link``: the sorted list, numbered from 0.

    Ranges are numbered by the sums of their counts; a link's place in its range needs the
    links of that range only.
    """
    manifest = read_manifest(spark, path)
    starts = running_before(manifest, ["low"], F.col("links"), "before").select("folder", "range", "part", "before")
    links = _read(spark, path, manifest)
    place = F.row_number().over(Window.partitionBy("folder", "range", "part").orderBy("link")) - 1
    return links.withColumn("place", place).join(starts, ["folder", "range", "part"]).select((F.col("before") + F.col("place")).alias("file_ord"), "link")
