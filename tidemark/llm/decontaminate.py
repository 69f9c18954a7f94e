"""Benchmark decontamination: SimHash windows of item size, multi-index Hamming, exact check.

The items of the benchmark give their weighted shingles and a 64-bit SimHash of their words. In a
document, all windows as long as an item are looked at that hold a shingle of an item of that
length: a window without any has no shingle in common with such an item, and its similarity is
zero. The SimHash of each is found by running bit counts. Fingerprints are looked up in ``BLOCKS``
blocks: two that lie within ``RADIUS`` differ by at most a fourth of it, rounded down, in some
block, so every item within the radius shares a block with the window, up to that many bits. Items
found so are verified by the weighted Jaccard similarity of the shingles. A shingle of the
item weighs 1 + ln(items / items that have it), one that it lacks as much as the rarest could.

Tasks make the items' shingles and fingerprints, and count in how many items a shingle is, over the
whole benchmark. Benchmarks larger than ``ITEM_BYTES`` are taken in parts of that size, each
against all documents; a part gets the weights of its own items' shingles, and nothing else
of the others.

Shingles are five words; an item of fewer words has one shingle, all its words.

Cases. Null or empty text, or no words: no hit, on either side. Very long texts: whole; a text shorter
than an item is one window. Repeated items: each is reported. Repeated documents: each is reported.
Ties between windows: the first. Null doc_id or item_id: carried along. Empty tables: no rows. Extra
columns: kept by ``clean_documents``, ignored by ``contaminated``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import lower_bytes, mix, prefix_hash, shingles_of, span_hash, stored, table, text_slices, words_of

K = 5
SIMILARITY = 0.8
RADIUS = 15
BLOCKS, BLOCK_BITS = 4, 16
ITEM_BYTES = 32 << 20
#: Windows that are worked on at a time, and fingerprints that are looked up at a time.
WINDOWS, MARKS = 1 << 14, 256
_FILTER_BITS = 23


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, words per text), in lower case."""
    low = lower_bytes(data)
    start, stop, counts = words_of(low, offsets)
    return span_hash(prefix_hash(low), start, stop), counts


def simhashes(words: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """64 majority bits over the words of each window of ``size`` words."""
    out = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        # Sorted windows of a stretch share the running counts of its words.
        last = int(np.searchsorted(starts, starts[first] + WINDOWS))
        low = int(starts[first])
        high = int(starts[last - 1]) + size
        bits = np.unpackbits(mix(words[low:high]).view(np.uint8).reshape(-1, 8), axis=1)
        sums = np.zeros((len(bits) + 1, 64), np.int32)
        np.cumsum(bits, axis=0, dtype=np.int32, out=sums[1:])
        at = starts[first:last] - low
        most = 2 * (sums[at + size] - sums[at]) >= size
        out[first:last] = np.packbits(most, axis=1).view(">u8").ravel()
        first = last
    return out


def block_masks(bits: int) -> np.ndarray:
    """All values of a block with up to ``bits`` bits set."""
    return np.array([sum(1 << b for b in some) for n in range(bits + 1) for some in combinations(range(BLOCK_BITS), n)], np.int64)


@dataclass
class ItemIndex:
    """The items, ready to be searched. The shingles of item i stand from ``starts[i]`` on, sorted.

    ``sought`` has what to look for in a text: the shingle, or all words of an item of fewer.
    """

    ids: list
    lengths: np.ndarray
    marks: np.ndarray
    starts: np.ndarray
    shingles: np.ndarray
    sought: np.ndarray
    counts: np.ndarray
    weights: np.ndarray
    heaviest: float
    radius: int
    #: For each block the items by its value, and where each value starts.
    tables: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)
    #: k -> (bit filter, sorted shingle hashes, words of the item of each)
    probes: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.masks = block_masks(self.radius // BLOCKS)
        self.totals = np.add.reduceat(np.append(self.counts * self.weights, 0.0), self.starts[:-1]) if len(self.ids) else np.zeros(0)
        for block in range(BLOCKS):
            values = (self.marks >> np.uint64(block * BLOCK_BITS) & np.uint64((1 << BLOCK_BITS) - 1)).astype(np.int64)
            order = np.argsort(values, kind="stable")
            self.tables.append((order, np.searchsorted(values[order], np.arange((1 << BLOCK_BITS) + 1))))
        sizes = np.diff(self.starts)
        for k in np.unique(np.minimum(K, self.lengths)).tolist():
            own = np.repeat(np.minimum(K, self.lengths) == k, sizes)
            flat, words = self.sought[own], np.repeat(self.lengths, sizes)[own]
            order = np.lexsort((words, flat))
            pairs = np.ones(len(order), bool)
            pairs[1:] = (flat[order][1:] != flat[order][:-1]) | (words[order][1:] != words[order][:-1])
            order = order[pairs]
            bits = np.zeros(1 << _FILTER_BITS, bool)
            bits[(flat >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True
            self.probes[k] = (bits, flat[order], words[order])

    def near_pairs(self, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(place in ``marks``, item) of the pairs within the radius, and how many were compared."""
        found, compared = [], 0
        for first in range(0, len(marks), MARKS):
            some = marks[first : first + MARKS]
            pairs = []
            for block, (order, edges) in enumerate(self.tables):
                value = (some >> np.uint64(block * BLOCK_BITS) & np.uint64((1 << BLOCK_BITS) - 1)).astype(np.int64)
                keys = value[:, None] ^ self.masks
                low, n = edges[keys], edges[keys + 1] - edges[keys]
                row, probe = np.nonzero(n)
                n, low = n[row, probe], low[row, probe]
                at = np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                pairs.append(np.repeat(row, n) * len(self.ids) + order[at])
            pairs = np.unique(np.concatenate(pairs))
            compared += len(pairs)
            row, item = pairs // max(1, len(self.ids)), pairs % max(1, len(self.ids))
            close = np.bitwise_count(some[row] ^ self.marks[item]) <= self.radius
            found.append(np.stack([row[close] + first, item[close]]))
        row, item = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
        return row, item, compared

    def near(self, mark: int) -> list[int]:
        """Items whose SimHash is within the radius."""
        return self.near_pairs(np.array([mark], np.uint64))[1].tolist()

    def similarity(self, item: int, shingles: np.ndarray, counts: np.ndarray) -> float:
        """Weighted Jaccard similarity of an item and the distinct shingles of a window."""
        own = slice(self.starts[item], self.starts[item + 1])
        at = np.minimum(np.searchsorted(self.shingles[own], shingles), own.stop - own.start - 1)
        known = self.shingles[own][at] == shingles
        weights = np.where(known, self.weights[own][at], self.heaviest)
        both = float((np.minimum(counts, self.counts[own][at]) * weights)[known].sum())
        every = float((counts * weights).sum()) + float(self.totals[item]) - both
        return both / every if every else 0.0


def item_parts(text: str | None) -> tuple[int, int, np.ndarray, np.ndarray, np.ndarray] | None:
    """(words, SimHash, distinct shingles, ``sought``, how often each) of an item; None without words."""
    raw = np.frombuffer((text or "").encode(), np.uint8)
    h, _ = word_hashes(raw, np.array([0, len(raw)]))
    if not len(h):
        return None
    shingles, counts = np.unique(shingles_of(h, np.array([len(h)]), K)[0], return_counts=True)
    sought = shingles if len(h) >= K else shingles_of(h, np.array([len(h)]), len(h))[0]
    return len(h), int(simhashes(h, np.array([0]), len(h))[0]), shingles, sought, counts


def assembled(rows: Sequence[tuple], items: int, radius: int) -> ItemIndex:
    """The index of (id, words, SimHash, shingles, sought, counts, items that have each) of the items."""
    ids, lengths, marks, shingles, sought, counts, spread = zip(*rows, strict=True) if rows else [()] * 7
    flat = lambda parts, kind: np.concatenate(parts).astype(kind) if parts else np.zeros(0, kind)
    starts = np.concatenate([[0], np.cumsum([len(x) for x in shingles])]).astype(np.int64)
    weights = 1 + np.log(items / flat(spread, float)) if rows else np.zeros(0)
    heaviest = 1 + float(np.log(max(1, items)))
    return ItemIndex(
        list(ids), np.array(lengths, np.int64), np.array(marks, np.uint64), starts, flat(shingles, np.uint64), flat(sought, np.uint64), flat(counts, np.int64), weights, heaviest, radius
    )


def build_index(ids: list, texts: list[str | None], radius: int = RADIUS) -> ItemIndex:
    """The index of these items alone."""
    parts = [(i, *p) for i, p in ((i, item_parts(t)) for i, t in zip(ids, texts, strict=True)) if p]
    every, spread = np.unique(np.concatenate([p[3] for p in parts]), return_counts=True) if parts else (np.zeros(0), np.zeros(0))
    return assembled([(*p, spread[np.searchsorted(every, p[3])]) for p in parts], len(parts), radius)


def windows(index: ItemIndex, h: np.ndarray, counts: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """(text, words of the window, first words) of the item-sized windows with a shared shingle."""
    hits = []
    for k, (bits, flat, words) in index.probes.items():
        s, n = shingles_of(h, counts, k)
        n = np.where(counts >= k, n, 0)
        # A text of fewer than k words has one shingle too, which is not a match of k words.
        s = s[np.repeat(counts[counts > 0] >= k, np.maximum(counts[counts > 0] - k + 1, 1))]
        at = np.flatnonzero(bits[(s >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
        left, right = np.searchsorted(flat, s[at], "left"), np.searchsorted(flat, s[at], "right")
        at, left, times = at[right > left], left[right > left], (right - left)[right > left]
        if not len(at):
            continue
        row = np.repeat(np.arange(len(counts)), n)[at]
        word = at - np.concatenate([[0], np.cumsum(n)])[row]
        hit = np.repeat(left, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        row, word, size = np.repeat(row, times), np.repeat(word, times), words[hit]
        # Every window that holds the shingle; a text that is shorter is one window.
        size = np.minimum(size, counts[row])
        first, last = np.maximum(0, word + k - size), np.minimum(word, counts[row] - size)
        hits.append(np.stack([row, size, first, last]))
    if not hits:
        return
    row, size, first, last = np.concatenate(hits, axis=1)
    order = np.lexsort((first, size, row))
    row, size, first, last = row[order], size[order], first[order], last[order]
    edges = np.flatnonzero((np.diff(row) != 0) | (np.diff(size) != 0)) + 1
    for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(row)]):
        # Both ends grow from hit to hit, so what earlier hits have covered ends at their maximum.
        seen = np.maximum.accumulate(last[a:b])
        low = first[a:b].copy()
        low[1:] = np.maximum(low[1:], seen[:-1] + 1)
        n = np.maximum(last[a:b] - low + 1, 0)
        yield int(row[a]), int(size[a]), np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


def search(index: ItemIndex, data: np.ndarray, offsets: np.ndarray, least: float = SIMILARITY) -> list[tuple[int, int, float, int, int]]:
    """(text, item, similarity, first word, Hamming distance): the best window of each text and item."""
    h, counts = word_hashes(data, offsets)
    begin = np.concatenate([[0], np.cumsum(counts)])
    best: dict[tuple[int, int], tuple[float, int, int]] = {}
    for row, size, starts in windows(index, h, counts):
        words = h[begin[row] : begin[row + 1]]
        for at in range(0, len(starts), WINDOWS):
            some = starts[at : at + WINDOWS]
            marks = simhashes(words, some, size)
            # Windows side by side often have the same fingerprint: it is looked up once.
            distinct, which = np.unique(marks, return_inverse=True)
            place, item, _ = index.near_pairs(distinct)
            if not len(place):
                continue
            by_mark = np.argsort(place, kind="stable")
            edges = np.searchsorted(place[by_mark], np.arange(len(distinct) + 1))
            for window in np.flatnonzero(np.diff(edges)[which] > 0).tolist():
                start = int(some[window])
                part = words[start : start + size]
                shingles, often = np.unique(shingles_of(part, np.array([size]), K)[0], return_counts=True)
                mark = which[window]
                for i in item[by_mark[edges[mark] : edges[mark + 1]]].tolist():
                    # A window of another item's size is another window.
                    if min(int(index.lengths[i]), len(words)) != size:
                        continue
                    got = index.similarity(i, shingles, often)
                    old = best.get((row, i))
                    if got >= least - 1e-12 and (old is None or got > old[0]):
                        best[row, i] = (got, start, int(np.bitwise_count(index.marks[i] ^ distinct[mark])))
    return [(row, item, *b) for (row, item), b in sorted(best.items())]


def item_rows(benchmark: DataFrame) -> DataFrame:
    """``item_id, words, mark, shingles, sought, counts, spread`` of each item with words.

    ``spread`` tells for each shingle how many items of the whole benchmark have it.
    """
    schema = "item_id bigint, words int, mark bigint, shingles array<bigint>, sought array<bigint>, counts array<bigint>"

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                parts = item_parts(batch.column(1)[i].as_py())
                if parts:
                    words, mark, shingles, sought, counts = parts
                    signed = np.array([mark], np.uint64).view(np.int64)
                    lists = [pa.array([x], pa.list_(pa.int64())) for x in (shingles.view(np.int64), sought.view(np.int64), counts)]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(i, 1).cast(pa.int64()), pa.array([words], pa.int32()), pa.array(signed), *lists],
                        ["item_id", "words", "mark", "shingles", "sought", "counts"],
                    )

    made = benchmark.select("item_id", "text").mapInArrow(each, schema)
    made = stored(made.withColumn("row", F.monotonically_increasing_id()), "items")
    single = made.select("row", F.posexplode("shingles").alias("place", "shingle"))
    spread = single.groupBy("shingle").agg(F.count("*").alias("spread"))
    listed = single.join(spread, "shingle").groupBy("row").agg(F.sort_array(F.collect_list(F.struct("place", "spread"))).alias("s"))
    return made.join(listed, "row").select(*made.columns, F.col("s.spread").alias("spread"))


def item_indexes(benchmark: DataFrame, radius: int = RADIUS, part_bytes: int = ITEM_BYTES) -> Iterator[ItemIndex]:
    """Indexes over parts of the benchmark, each of about ``part_bytes`` of text.

    The driver puts the rows of one part after the other together; tasks have made them.
    """
    size = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = int(size // part_bytes) + 1
    rows = stored(item_rows(benchmark).withColumn("part", F.pmod(F.xxhash64("item_id", "mark", "row"), F.lit(parts))), "item-rows")
    items = rows.count()
    for part in range(parts):
        held = rows.where(F.col("part") == part).orderBy("item_id", "mark", "row").toArrow()
        lists = [[x.values.to_numpy() for x in held.column(c)] for c in ("shingles", "sought", "counts", "spread")]
        marks = held.column("mark").to_numpy().view(np.uint64).tolist()
        columns = [held.column("item_id").to_pylist(), held.column("words").to_pylist(), marks, *[[x.view(np.uint64) for x in some] for some in lists[:2]], *lists[2:]]
        yield assembled(list(zip(*columns, strict=True)), items, radius)


def contaminated(docs: DataFrame, benchmark: DataFrame, least: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """doc_id, item_id, similarity, first_word, distance of every document that holds an item."""
    spark = docs.sparkSession
    schema = "doc_id bigint, item_id bigint, similarity double, first_word bigint, distance int"
    out = spark.createDataFrame([], schema)
    for index in item_indexes(benchmark, radius):
        shared = spark.sparkContext.broadcast(index)

        def scan(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                ids = batch.column(0)
                for first, _, data, offsets in text_slices(batch.column(1)):
                    hits = search(index, data, offsets, least)
                    if hits:
                        row, item, got, start, distance = zip(*hits, strict=True)
                        yield pa.RecordBatch.from_arrays(
                            [
                                ids.take(pa.array([first + r for r in row])),
                                pa.array([index.ids[i] for i in item], pa.int64()),
                                pa.array(got),
                                pa.array(start, pa.int64()),
                                pa.array(distance, pa.int32()),
                            ],
                            ["doc_id", "item_id", "similarity", "first_word", "distance"],
                        )

        out = out.unionByName(docs.select("doc_id", "text").mapInArrow(scan, schema))
    return out


def clean_documents(docs: DataFrame, benchmark: DataFrame, least: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns."""
    place = docs.columns.index("text")
    for index in item_indexes(benchmark, radius):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def keep(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                clean = np.ones(batch.num_rows, bool)
                for first, _, data, offsets in text_slices(batch.column(place)):
                    clean[[first + hit[0] for hit in search(shared.value, data, offsets, least)]] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs


def op3_simhash_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
