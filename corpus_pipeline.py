"""From raw documents to a training mix, one stage after the other.

Every stage but the last returns the columns of ``documents``. Null texts count as empty. Rows
without a doc_id, and rows that share one, are judged by their own texts; of rows with equal
doc_id and text one stays. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored, table
from tidemark.llm.decontaminate import clean_documents
from tidemark.llm.language import fit_language, with_language
from tidemark.llm.mixing import mix_sources
from tidemark.llm.neardup import near_duplicates
from tidemark.llm.suffix import without_repeats
from tidemark.session import scratch_dir


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language, which becomes their ``lang``; those without a letter, in another script
    or of random characters go. With no labelled rows only the letters count and ``lang`` stays as given."""
    return with_language(docs, fit_language(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: the one with the smallest doc_id.

    A row without a doc_id, or that shares one, goes by a hash of doc_id and text, so rows with
    different texts are different documents and equal rows are one. Ties go by that hash.
    """
    shared = docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 or doc_id is null")
    shared = stored(shared.select(F.col("doc_id").alias("__id"), F.lit(True).alias("__shared")), "pipeline-shared")
    hashed = F.xxhash64("doc_id", "text")
    keyed = docs.withColumn("__key", F.col("doc_id")) if not shared.take(1) else (
        docs.join(shared, F.col("doc_id").eqNullSafe(F.col("__id")), "left")
        .withColumn("__key", F.when(F.col("__shared"), hashed).otherwise(F.col("doc_id")))
        .drop("__id", "__shared")
    )
    classes = near_duplicates(keyed.select(F.col("__key").alias("doc_id"), "text")).distinct()
    named = classes.join(keyed.select(F.col("__key").alias("key"), F.col("doc_id").alias("own")).distinct(), F.col("doc_id") == F.col("key"))
    order = F.struct(F.col("own").isNull(), "own", "key")
    first = named.groupBy("class_id").agg(F.min_by("key", order).alias("__key")).select("__key")
    kept = keyed.join(stored(first, "pipeline-kept"), "__key")
    # Rows that are equal in id and text: any one of them.
    place = F.row_number().over(Window.partitionBy("__key").orderBy("text"))
    return kept.withColumn("__place", place).where("__place = 1").select(*docs.columns)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings of 100 bytes that stand in an earlier one; no row goes.

    Rows without a doc_id come first; of rows that share one, the smaller text.
    """
    return without_repeats(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark; an empty benchmark takes none out."""
    return clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes of each document, and its language; every row has one.

    Empty texts have size 0 and a null source is a source. Ties go by the text's digest.
    """
    names = ["doc_id", "source", "size", "source_size", "target", "copies", "taken"]
    return mix_sources(docs, keep=("lang",)).select(*names, "lang")


STAGES = [
    ("language", language),
    ("near_dedup", near_dedup),
    ("suffix_dedup", suffix_dedup),
    ("decontaminate", decontaminate),
    ("mix", mix),
]
#: Language ID and the near-duplicate stage can't be written in SQL; tests compare the stages
#: with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
