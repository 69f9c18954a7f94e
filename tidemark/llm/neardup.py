"""Near-duplicate detection by Order MinHash, verified by banded alignment.

A text is a sequence of five-word k-mers, each labelled with how often it has occurred
before, so that labelled k-mers are distinct. One sketch takes the ``MINIMA`` labelled k-mers
with the smallest hashes, in the order they have in the text: texts share it with a chance
that falls with their edit distance, not only with their sets. ``ROWS`` sketches make the key
of a band, and texts that share the key of one of ``BANDS`` bands are candidates. At the
threshold a pair shares no band with a chance of about 6e-5.

Texts with equal words are one node from the start. In a band, small groups give all pairs;
a larger group gives a link of each member to its first member. Where that leaves several
classes in a group, as a passage in very many texts or many edits of one text do, its texts go
through an exact prefix filter between classes (``prefix_pairs``), so no large group is
expanded into its pairs. Candidates are verified by alignment: the longest chain of equal
labelled k-mers in the same order, inside a band about the diagonal as wide as the threshold
allows. Similarity is the chain's length over all k-mers of the two texts together; 0.8 and
more is a link. Classes are connected components.

Cases. Null or empty text, or no words: alike only to byte-equal texts. Under five words: one
k-mer. Null doc_id: class_id null, class_size 1. Rows with equal ids are one document. Repeated
texts: one class. Empty table: no rows. Very long texts: whole; positions take 24 bits, so a text of
more than 16 million words is an error. Ties: the smallest doc_id names the class. Extra columns: ignored.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import BASE, lists_of, lower_bytes, mix, powers, prefix_hash, shingles_of, span_hash, stored, table, text_slices, words_of
from tidemark.llm.components import components

K = 5
SIMILARITY = 0.8
MINIMA, ROWS, BANDS = 2, 3, 32
SMALL_GROUP = 8
#: K-mers whose counts are sent to all tasks, at most.
HEAVY = 100_000
#: K-mers before the one that two texts meet at, by which a second meeting is told.
EARLIER = 64
_PLACE = np.uint64((1 << 24) - 1)


def kmers(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, k-mers per text) of the words of each text, in lower case."""
    low = lower_bytes(data)
    start, stop, counts = words_of(low, offsets)
    return shingles_of(span_hash(prefix_hash(low), start, stop), counts, K)


def labelled(h: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Hashes changed by the number of equal ones before them in the same text."""
    owner = np.repeat(np.arange(len(counts)), counts)
    order = np.lexsort((h, owner))
    sh, so = h[order], owner[order]
    new = np.ones(len(h), bool)
    new[1:] = (sh[1:] != sh[:-1]) | (so[1:] != so[:-1])
    first = np.maximum.accumulate(np.where(new, np.arange(len(h)), 0))
    seen = np.zeros(len(h), np.uint64)
    seen[order] = (np.arange(len(h)) - first).astype(np.uint64)
    return mix(h + seen * np.uint64(0x9E3779B97F4A7C15))


def order_minhash(h: np.ndarray, counts: np.ndarray, bands: int = BANDS, rows: int = ROWS, minima: int = MINIMA) -> np.ndarray:
    """texts x bands keys; 0 for texts without k-mers."""
    full = np.flatnonzero(counts)
    keys = np.zeros((len(counts), bands), np.uint64)
    if not len(full):
        return keys
    if int(counts.max()) > int(_PLACE):
        raise ValueError(f"a text of {counts.max()} words; places are kept up to {_PLACE}")
    start = np.concatenate([[0], np.cumsum(counts)])[:-1][full]
    last = counts[full] - 1
    place = (np.arange(len(h)) - np.repeat(start, counts[full])).astype(np.uint64)
    seeds = mix(np.arange(1, bands * rows + 1, dtype=np.uint64))
    for band in range(bands):
        key = np.full(len(full), band + 1, np.uint64)
        for row in range(rows):
            v = h * (seeds[band * rows + row] | np.uint64(1))
            v ^= v >> np.uint64(32)
            v &= ~_PLACE
            v |= place
            found = []
            for _ in range(minima):
                least = np.minimum.reduceat(v, start)
                found.append(least)
                v[start + np.minimum((least & _PLACE).astype(np.int64), last)] = ~np.uint64(0)
            mins = np.stack(found)
            ordered = np.take_along_axis(mins, np.argsort(mins & _PLACE, axis=0, kind="stable"), axis=0) & ~_PLACE
            for one in ordered:
                key = mix(key * np.uint64(0x2545F4914F6CDD1D) + one)
        keys[full, band] = key
    return keys


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, t1 and t2 (hash of the words of the text), keys (one for each band)."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in text_slices(batch.column(1)):
                low = lower_bytes(data)
                start, stop, words = words_of(low, offsets)
                hashes = span_hash(prefix_hash(low), start, stop)
                whole = []
                edge = np.concatenate([[0], np.cumsum(words)])
                raw = span_hash(prefix_hash(data), offsets[:-1], offsets[1:])
                for seed in (3, 5):
                    w = prefix_hash_of(mix(hashes + np.uint64(seed)))
                    whole.append(np.where(words > 0, span_hash(w, edge[:-1], edge[1:]), mix(raw + np.uint64(seed))))
                h, counts = shingles_of(hashes, words, K)
                keys = order_minhash(labelled(h, counts), counts)
                sizes = np.where(counts > 0, BANDS, 0)
                lists = lists_of(keys[counts > 0].reshape(-1).view(np.int64), sizes, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[first:last], pa.array(whole[0].view(np.int64)), pa.array(whole[1].view(np.int64)), lists], ["doc_id", "t1", "t2", "keys"]
                )

    return docs.select("doc_id", "text").mapInArrow(sign, "doc_id bigint, t1 bigint, t2 bigint, keys array<bigint>")


def prefix_hash_of(values: np.ndarray) -> np.ndarray:
    """As ``prefix_hash``, of 64-bit values."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(BASE, len(values)), out=out[1:])
    return out


def aligned_similarity(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> float:
    """Chain of equal labelled k-mers over all k-mers; 0.0 as soon as it must be below ``least``."""
    n, m = len(a), len(b)
    need = least * (n + m) / (1 + least)
    if min(n, m) < need - 1e-9:
        return 0.0
    la, lb = labelled(a, np.array([n])), labelled(b, np.array([m]))
    _, i, j = np.intersect1d(la, lb, assume_unique=True, return_indices=True)
    band = n + m - 2 * need + 1e-9
    near = np.abs(i - j) <= band
    i, j = i[near], j[near]
    if len(i) < need - 1e-9:
        return 0.0
    j = j[np.argsort(i)]
    chain = len(j)
    if chain > 1 and (np.diff(j) < 0).any():
        tails: list[int] = []
        for x in j.tolist():
            at = bisect_left(tails, x)
            if at == len(tails):
                tails.append(x)
            else:
                tails[at] = x
        chain = len(tails)
    got = chain / (n + m - chain)
    return got if got >= least - 1e-12 else 0.0


def _kmer_table(docs: DataFrame) -> DataFrame:
    """id and its k-mers, for verification; 32 bits of each hash are enough to compare two texts."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in text_slices(batch.column(1)):
                h, counts = kmers(data, offsets)
                lists = lists_of((h >> np.uint64(32)).astype(np.uint32).view(np.int32), counts, pa.int32())
                yield pa.RecordBatch.from_arrays([batch.column(0)[first:last], lists], ["id", "kmers"])

    return docs.mapInArrow(cut, "id bigint, kmers array<int>")


def verified(pairs: DataFrame, texts: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """The pairs (a, b) whose aligned similarity is at least ``least``."""

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = batch.column(2), batch.column(3)
            keep = [aligned_similarity(x[i].values.to_numpy().astype(np.uint64), y[i].values.to_numpy().astype(np.uint64), least) > 0 for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(keep, pa.bool_())) for c in batch.columns[:2]], ["a", "b"])

    left = texts.select(F.col("id").alias("a"), F.col("kmers").alias("ka"))
    right = texts.select(F.col("id").alias("b"), F.col("kmers").alias("kb"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "ka", "kb").mapInArrow(align, "a bigint, b bigint")


def _all_pairs(members: DataFrame) -> DataFrame:
    """Pairs (a > b) of the ids of each key; for groups known to be small."""
    other = members.select("key", F.col("id").alias("b"))
    return members.select("key", F.col("id").alias("a")).join(other, "key").where("a > b").select("a", "b").distinct()


def with_counts(texts: DataFrame, most: int = HEAVY) -> DataFrame:
    """Adds ``often``: for each k-mer of a text, how many there are of it in all of them.

    Counted over all texts by partial sums. No more than ``most`` k-mers can make up more than one in
    ``most`` of all: the counts of those are sent to every task. The others are joined, and none
    of them has more rows than that, so no task gets a frequent k-mer.
    """
    each = texts.select("id", F.posexplode("kmers").alias("p", "kmer"))
    counts = stored(each.groupBy("kmer").agg(F.count("*").alias("n")), "neardup-counts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    heavy = counts.where(F.col("n") > total / most).select("kmer", F.col("n").alias("heavy"))
    marked = each.join(F.broadcast(heavy), "kmer", "left")
    light = marked.where("heavy is null").join(counts.where(F.col("n") <= total / most), "kmer").select("id", "p", "n")
    known = marked.where("heavy is not null").select("id", "p", F.col("heavy").alias("n")).unionByName(light)
    counted = known.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("p", "n"))).alias("s"))
    often = F.coalesce(F.col("s.n"), F.array().cast("array<bigint>"))
    return texts.join(counted, "id", "left").select(*texts.columns, often.alias("often"))


def _unsettled(members: DataFrame, roots: DataFrame) -> DataFrame:
    """(key, id, class) of the groups whose members are in several classes."""
    classed = members.join(roots, members["id"] == roots["node"], "left").select("key", "id", F.coalesce("root", "id").alias("class"))
    classed = stored(classed, "neardup-classed")
    several = classed.groupBy("key").agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low < high")
    return stored(classed.join(several, "key", "left_semi"), "neardup-unsettled")


def prefix_pairs(texts: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """Every pair (a, b) of the texts (id, class, kmers) of different classes that can be as similar as ``least``.

    An exact filter. All texts sort their labelled k-mers in one order. Let x be the smaller text
    of a pair, with n k-mers, and y the larger one, with m. If their similarity is t or more, they
    share s = t / (1 + t) (n + m) k-mers at least; so the first one that they share stands where
    both have s left, which is among the first n - ceil(2t / (1 + t) n) + 1 of x and the first
    m - ceil(t m) + 1 of y. Any order is right; that by ``with_counts`` puts frequent ones
    last, so that texts which differ in their own ways from a common one make no pair.
    """

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, earlier, sizes = [], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for i in range(batch.num_rows):
                raw = batch.column(2)[i].values.to_numpy()
                n = len(raw)
                if not n:
                    continue
                h = labelled(raw.astype(np.uint64), np.array([n]))
                often = batch.column(3)[i].values.to_numpy()
                long = n - int(np.ceil(least * n - 1e-9)) + 1
                first = h[np.lexsort((h, often))[:long]].view(np.int64)
                found.append(np.column_stack([first, np.arange(long), np.tile([batch.column(0)[i].as_py(), batch.column(1)[i].as_py(), n], (long, 1))]))
                some = np.minimum(np.arange(long), EARLIER)
                within = np.arange(some.sum()) - np.repeat(np.cumsum(some) - some, some)
                earlier.append(first[np.repeat(np.arange(long) - some, some) + within])
                sizes.append(some)
            rows = np.concatenate(found) if found else np.zeros((0, 5), np.int64)
            lists = lists_of(np.concatenate(earlier), np.concatenate(sizes), pa.int64())
            yield pa.RecordBatch.from_arrays([*[pa.array(np.ascontiguousarray(c)) for c in rows.T], lists], ["key", "p", "id", "class", "n", "earlier"])

    schema = "key bigint, p bigint, id bigint, class bigint, n bigint, earlier array<bigint>"
    counted = with_counts(texts.select("id", "class", "kmers"))
    firsts = stored(counted.mapInArrow(prefixes, schema), "neardup-prefixes")
    kept = ("p", "id", "class", "n", "earlier")
    smaller = firsts.where(F.col("p") <= F.col("n") - F.ceil(2 * least / (1 + least) * F.col("n") - 1e-6)).select("key", *[F.col(c).alias(f"{c}_i") for c in kept])
    larger = firsts.select("key", *[F.col(c).alias(f"{c}_j") for c in kept])
    ordered = (F.col("n_i") < F.col("n_j")) | ((F.col("n_i") == F.col("n_j")) & (F.col("id_i") < F.col("id_j")))
    enough = F.least(F.col("n_i") - F.col("p_i"), F.col("n_j") - F.col("p_j")) >= least / (1 + least) * (F.col("n_i") + F.col("n_j")) - 1e-6
    # A pair is met at the first k-mer it shares; further ones, if any, go with distinct().
    first = ~F.arrays_overlap("earlier_i", "earlier_j")
    met = smaller.join(larger, (smaller["key"] == larger["key"]) & (F.col("class_i") != F.col("class_j")) & ordered & enough & first)
    return met.select(F.greatest("id_i", "id_j").alias("a"), F.least("id_i", "id_j").alias("b")).distinct()


def near_duplicates(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """doc_id, class_id (the smallest doc_id of the class), class_size; a row for each row of ``docs``."""
    signed = stored(signatures(docs), "neardup-signed")
    texts = stored(signed.where("doc_id is not null").groupBy("t1", "t2").agg(F.min("doc_id").alias("rep")), "neardup-texts")
    reps = signed.join(texts, (signed["t1"] == texts["t1"]) & (signed["t2"] == texts["t2"]) & (signed["doc_id"] == texts["rep"]), "left_semi")
    banded = reps.select(F.col("doc_id").alias("id"), F.explode("keys").alias("key"))
    groups = stored(banded.groupBy("key").agg(F.count("*").alias("n"), F.min("id").alias("star")).where("n > 1"), "neardup-groups")
    members = stored(banded.join(groups, "key").select("key", "id", "n", "star"), "neardup-members")

    wanted = members.select("id").distinct()
    held = docs.select(F.col("doc_id").alias("id"), "text").join(wanted, "id")
    cut = stored(_kmer_table(held), "neardup-kmers")
    stars = members.where((F.col("n") > SMALL_GROUP) & (F.col("id") != F.col("star"))).select(F.col("id").alias("a"), F.col("star").alias("b"))
    pairs = stars.unionByName(_all_pairs(members.where(F.col("n") <= SMALL_GROUP).select("key", "id"))).distinct()
    links = stored(verified(pairs, cut, least), "neardup-links")
    roots = components(links)

    # Larger groups whose members are in several classes: an exact search between the classes.
    left = _unsettled(members.where(F.col("n") > SMALL_GROUP).select("key", "id"), roots)
    if left.take(1):
        held = stored(cut.join(left.select("id", "class").distinct(), "id"), "neardup-held")
        more = stored(verified(prefix_pairs(held, least), held, least), "neardup-more")
        if more.take(1):
            roots = components(links.unionByName(more))

    by_text = stored(
        texts.join(roots, texts["rep"] == roots["node"], "left").select("t1", "t2", F.coalesce("root", "rep").alias("class_id")), "neardup-classes"
    )
    known = stored(signed.where("doc_id is not null").select("doc_id", "t1", "t2").join(by_text, ["t1", "t2"]).select("doc_id", "class_id"), "neardup-known")
    sizes = stored(known.groupBy("class_id").agg(F.count("*").alias("class_size")), "neardup-sizes")
    nameless = signed.where("doc_id is null").select("doc_id", F.lit(None).cast("bigint").alias("class_id"), F.lit(1).cast("bigint").alias("class_size"))
    return known.join(sizes, "class_id").select("doc_id", "class_id", "class_size").unionByName(nameless)


def op5_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate class of every document."""
    return near_duplicates(table(spark, sf_dir, "documents"))
