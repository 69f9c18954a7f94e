"""Session start-up and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_session(app_name: str = "tidemark", **conf: str) -> SparkSession:
    """The running session, or a new one named ``app_name``.

    Keyword settings use ``__`` for the dots: ``spark__sql__shuffle__partitions``.
    """
    builder = SparkSession.builder.appName(app_name)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder named by ``spark.checkpoint.dir``.

    Executors on other machines read what is written here, so a machine-local
    folder is used only for a local master that names no shared one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="tidemark-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written_side(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back.

    For tables with a row per dataset, file or split, which cost a scan to make: they are
    made once, and Spark knows their size in bytes when it plans a join with them.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
