"""Document fingerprints: a threshold-scaled sketch of word shingles. DataFrame only.

Every five-word shingle is hashed, and every hash below a fixed fraction of the hash range
stays (``ONE_IN``). The sketch of a text grows with the text, sketches of parts can be merged
by union, and the share of a small text's hashes found in a large one's is an unbiased
estimate of containment, however unequal the two are. A text that has shingles but none below
the threshold keeps its smallest hash, so only a text without words has an empty sketch.

Words are runs without white space, in lower case. A text of one to four words has one
shingle, all its words.

Cases. Null or empty text: no shingle, empty fingerprint, like only to another empty one.
Very long texts: the sketch is a fixed fraction of the shingles, whole. Repeated shingles
count once. Repeated rows and equal ids: every row is fingerprinted; among equal ids the order
is that of the text. Empty table: no rows. Extra columns: ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import table

K = 5
ONE_IN = 8
#: Rows in a range of ids, about; and the most ranges.
RANGE_ROWS = 250
MOST_RANGES = 20_000


def _limit(one_in: int) -> int:
    return -(1 << 63) + (1 << 64) // one_in


def sketch_of(text: Column, one_in: int = ONE_IN, k: int = K) -> Column:
    """Sorted array<long>: the distinct shingle hashes below 2**64 / one_in, as signed longs."""
    spaced = F.trim(F.translate(F.lower(F.coalesce(text, F.lit(""))), "\t\n\x0b\x0c\r", " " * 5))
    words = F.filter(F.split(spaced, " ", -1), lambda w: w != "")
    limit = _limit(one_in)

    def shingles(w: Column) -> Column:
        # slice() past the end gives what is left, so a short text is one shingle.
        places = F.sequence(F.lit(1), F.greatest(F.size(w) - (k - 1), F.lit(1)))
        return F.transform(places, lambda i: F.xxhash64(F.slice(w, i, k)))

    def scaled(h: Column) -> Column:
        kept = F.filter(h, lambda x: x < limit)
        return F.when(F.size(kept) > 0, F.sort_array(F.array_distinct(kept))).otherwise(F.array(F.array_min(h)))

    # transform() over one element names a value that is used more than once.
    hashed = F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, shingles(w)).otherwise(F.array().cast("array<bigint>")))
    return F.transform(hashed, lambda h: F.when(F.size(h) > 0, scaled(h)).otherwise(h))[0]


def fingerprint(sketch: Column) -> Column:
    """The sketch as text: 16 hex digits for each hash, in order."""
    return F.array_join(F.transform(sketch, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of the hashes in either sketch that are in both; two empty sketches are alike."""
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).otherwise(both / (F.size(a) + F.size(b) - both)).cast("double")


def containment(small: Column, large: Column) -> Column:
    """Share of ``small``'s hashes that are in ``large``; null for an empty ``small``."""
    return (F.size(F.array_intersect(small, large)) / F.nullif(F.size(small), F.lit(0))).cast("double")


def merged(a: Column, b: Column, one_in: int = ONE_IN) -> Column:
    """The sketch of two texts together, but for the shingles across their border.

    A text without a hash below the threshold is kept by its smallest one; that one goes when the
    other text has hashes below, as it would in a sketch of both.
    """
    every = F.array_union(a, b)
    below = F.filter(every, lambda x: x < _limit(one_in))
    return F.when(F.size(below) > 0, F.sort_array(below)).when(F.size(every) > 0, F.array(F.array_min(every))).otherwise(every)


def id_ranges(df: DataFrame, rows: int = RANGE_ROWS, most: int = MOST_RANGES) -> list[int]:
    """Ids that cut the table into ranges of about equal size; their number is bounded."""
    n = min(most, df.count() // rows + 1)
    if n == 1:
        return []
    cuts = df.select(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 10 * most)).first()[0]
    return sorted(set(cuts or []))


def range_of(doc_id: Column, cuts: list[int]) -> Column:
    """The number of cuts that are not above the id, by bisection; -1 for null."""
    if not cuts:
        return F.when(doc_id.isNull(), -1).otherwise(0)
    edges = F.lit(cuts).cast("array<bigint>")
    jumps = F.array(*[F.lit(1 << i) for i in reversed(range(len(cuts).bit_length()))])
    found = F.aggregate(jumps, F.lit(0), lambda at, jump: F.when(F.get(edges, at + jump - 1) <= doc_id, at + jump).otherwise(at))
    return F.when(doc_id.isNull(), -1).otherwise(found)


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, sketch, and the text and sketch of the next document as nx_text, nx_sketch.

    The next one is that with the next smaller id, and after the last the first. Ids are cut
    into ranges, and one shuffle puts the rows of a range together. The last row of a range
    needs the first one of the next range: that row is added to the range before the shuffle.
    """
    spark = docs.sparkSession
    base = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    cuts = id_ranges(base)
    ranged = base.withColumn("range", range_of(F.col("doc_id"), cuts))
    # A row for each range, of which there are at most MOST_RANGES + 1.
    heads = ranged.groupBy("range").agg(F.max("doc_id").alias("doc_id")).collect()
    heads = sorted(((r["range"], r["doc_id"]) for r in heads), reverse=True)
    after = [(heads[i][0], *heads[(i + 1) % len(heads)]) for i in range(len(heads))]
    wanted = F.broadcast(spark.createDataFrame(after, "to int, range int, head bigint"))
    borders = (
        ranged.join(wanted, ["range"])
        .where(F.col("doc_id").eqNullSafe(F.col("head")))
        .select("doc_id", "text", F.col("to").alias("range"), F.lit(True).alias("border"))
    )
    rows = ranged.withColumn("border", F.lit(False)).unionByName(borders).withColumn("sketch", sketch_of(F.col("text")))
    order = Window.partitionBy("range").orderBy("border", F.desc_nulls_last("doc_id"), F.xxhash64("text"))
    return (
        rows.withColumns({"nx_text": F.lead("text").over(order), "nx_sketch": F.lead("sketch").over(order)})
        .where(~F.col("border"))
        .drop("border", "range")
    )


def op1_threshold_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and of its edit, their likeness, and what the edit keeps."""
    pairs = with_next(table(spark, sf_dir, "documents")).withColumn("n_chars", F.char_length("text").cast("long"))
    third = F.floor(F.col("n_chars") / 3).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), (F.col("n_chars") - third).cast("int")), F.substring("nx_text", F.lit(1), third)
    )
    pairs = pairs.withColumn("edited", edited)
    pairs = pairs.select("doc_id", "n_chars", "sketch", "nx_sketch", F.sha2("edited", 256).alias("edited_sha256"), sketch_of(F.col("edited")).alias("ed_sketch"))
    return pairs.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        fingerprint(F.col("sketch")).alias("fingerprint"),
        fingerprint(F.col("ed_sketch")).alias("edited_fingerprint"),
        likeness(F.col("sketch"), F.col("ed_sketch")).alias("near_edited"),
        likeness(F.col("sketch"), F.col("nx_sketch")).alias("near_next"),
        containment(F.col("sketch"), F.col("ed_sketch")).alias("in_edited"),
    )
