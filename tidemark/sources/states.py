"""Sums per file that are kept, so that a new file costs only itself."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.exact import STATE, STATE_SCHEMA, measure_state
from tidemark.operators.ordering import URI
from tidemark.session import written_side
from tidemark.sources.file_catalog import KEY, catalog_headers, refresh_catalog
from tidemark.sources.measurements import read_measurements

SCHEMA = f"file string, size bigint, modified bigint, {STATE_SCHEMA}"


def read_measure_states(spark: SparkSession, folder: str) -> DataFrame:
    """Every state ever stored in the folder; none if there is no such folder."""
    try:
        stored = spark.read.schema(SCHEMA).parquet(folder)
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return spark.createDataFrame([], SCHEMA)
    # Two jobs that bring it up to date at once may both have entered a file.
    return stored.dropDuplicates([*KEY, "measure", "place"])


def refresh_measure_states(
    spark: SparkSession,
    paths: Sequence[str],
    folder: str,
    measures: Sequence[str],
    *,
    base_path: str | None = None,
) -> DataFrame:
    """``file, size, modified`` and the ``measure_state`` of every file the paths hold now.

    The states lie in ``folder`` beside a catalog of the files. Only files that are new or have
    changed are read, and their states added. Always give the same measures for a folder.
    """
    root = folder.rstrip("/")
    catalog = refresh_catalog(spark, paths, f"{root}/catalog")
    states = f"{root}/states"
    new = written_side(catalog.join(read_measure_states(spark, states), KEY, "left_anti"), "new-files")
    files = sorted(row.file for row in new.filter("rows > 0").select("file").toLocalIterator())
    columns = [*KEY, "measure", "place", *STATE]
    if files:
        headers = catalog_headers(new, files)
        rows = read_measurements(spark, files, headers=headers, base_path=base_path, with_uri=True)
        lacking = [m for m in measures if m not in rows.columns]
        rows = rows.withColumns({m: F.lit(None).cast("string") for m in lacking})
        # Summed under two hashes of the path, 128 bits together: the name of a file would be made anew,
        # and compared as text, for every cell.
        keys = lambda uri: {"__k1": F.xxhash64(uri), "__k2": F.xxhash64(F.lit(1), uri)}
        made = measure_state(rows.withColumns(keys(URI)), measures, ["__k1", "__k2"])
        known = new.select(*KEY, "uri").withColumns(keys("uri")).drop("uri")
        made.join(known, ["__k1", "__k2"]).select(*columns).write.mode("append").parquet(states)
    # Files without rows have a state of nothing, so that they are not looked at again.
    none = new.filter("rows = 0").select(*KEY, F.lit(measures[0]).alias("measure"), F.lit(None).cast("int").alias("place"))
    if none.take(1):
        zeros = none.select("*", *[F.lit(None if c == "odd" else 0).cast("double" if c == "odd" else "bigint").alias(c) for c in STATE])
        zeros.select(*columns).write.mode("append").parquet(states)
    return catalog.select(*KEY).join(read_measure_states(spark, states), KEY)
