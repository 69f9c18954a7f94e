"""Removal of long byte strings that occurred before, by blockwise suffix sorting.

A byte goes if a string of ``WINDOW`` bytes that covers it starts earlier too: in a document
with a smaller id, or in the same one at an earlier place. Strings are judged on the input and
never cross documents. A document is all rows of the same id and text; those of one id are in the
order of a hash of their text.

1. Suffix buckets. Each window belongs to the smallest hash of the ``GRAM``-byte strings in it.
   Equal windows have that string at the same place, so a bucket is the hash of that string,
   and neighbouring windows with the same one are a segment. Only segments move between
   machines, about one for each 35 bytes, as two hashes and a place. Equal segments consist of
   equal windows: all but the first are covered, and one task keeps only its first of each, so
   that a bucket never gets more than a row for each task and different segment. Buckets that a
   sample shows to be frequent are dealt out by segment.
2. Segments that differ and share a bucket are parts at the border of a repeated passage. Their
   text is fetched and each bucket is sorted on its own: windows by their first ``PERIOD`` bytes,
   longer ties by the ranks of a difference-cover sample. For two windows there is a shift under
   ``PERIOD`` that takes both to sampled places; equal ranks there and equal ends make them equal.
   So memory is bounded by a bucket. A bucket of over ``LARGE`` segments, say of a passage in very
   many documents, is not sorted in one task: it is halved by the place of its string, and equal
   pieces of segments are settled by hash, until buckets are small.
3. Covered ranges are merged for each document, and the text without them is made.

Cases. Null or empty text, or under ``WINDOW`` bytes: nothing removed. Very long texts: whole;
a text is held by one task, and one of ``LONGEST`` bytes is an error. Null doc_id: before all ids, as if all such rows had one id. Rows with
equal ids (or none) and equal texts: one document given twice, which does not cover itself; both
lose what the document loses. Rows with equal ids and different texts: different documents.
Repeated texts: the first stays. Empty table: no rows. Extra columns: ignored, or kept by
``without_repeats``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import INVERSE, mix, powers, prefix_hash, span_hash, stored, table, text_slices

WINDOW = 100
GRAM = 32
PERIOD = 32
LARGE = 1_000
#: The longest text, in bytes, whose places fit into the hashes that they are kept with.
LONGEST = 1 << 28
#: One in so many documents is looked at to find buckets that must not go to one task: those with
#: so many of its segments at least, the most frequent first.
SAMPLED, FREQUENT, MOST_HOT = 64, 16, 4096
#: Segments that a task holds before it gives them on.
HELD = 2_000_000
#: Segments or pieces of large buckets that a task holds before it gives their halves on.
HELD_PARTS = 50_000
#: Bytes of small buckets that are sorted together; sorting takes some hundred times as many.
CHUNK = 1 << 18
FIRST_ID = -(1 << 63)
_PLACE = np.uint64((1 << 28) - 1)
_FOUND = "kind int, key bigint, id bigint, digest bigint, a bigint, b bigint, large boolean"


def difference_cover(period: int = PERIOD) -> np.ndarray:
    """Residues such that any two places have a common shift to sampled places."""
    step = int(np.ceil(np.sqrt(period)))
    return np.unique(np.concatenate([np.arange(step), np.arange(0, period, step)]) % period)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours, from running minima inside blocks."""
    n = len(x)
    blocks = -(-n // width)
    padded = np.full(blocks * width, ~np.uint64(0))
    padded[:n] = x
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).reshape(-1)
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


def segments(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(bucket, segment hash, row, first window, last window), windows counted in their row."""
    none = np.zeros(0, np.int64)
    n = len(data)
    if n < WINDOW:
        return none.view(np.uint64), none.view(np.uint64), none, none, none
    if n >= LONGEST:
        raise ValueError(f"a text of {n} bytes; places are kept up to {LONGEST}")
    h = prefix_hash(data)
    gram = mix((h[GRAM:] - h[:-GRAM]) * powers(INVERSE, n - GRAM + 1))
    least = sliding_min((gram & ~_PLACE) | np.arange(len(gram), dtype=np.uint64), WINDOW - GRAM + 1)
    anchor = (least & _PLACE).astype(np.int64)
    sizes = np.diff(offsets)
    inside = (np.repeat(offsets[1:], sizes)[: len(anchor)] - np.arange(len(anchor))) >= WINDOW
    first, last = inside.copy(), inside.copy()
    change = anchor[1:] != anchor[:-1]
    first[1:] &= change | ~inside[:-1]
    last[:-1] &= change | ~inside[1:]
    a, b = np.flatnonzero(first), np.flatnonzero(last)
    row = np.searchsorted(offsets, a, "right") - 1
    return gram[anchor[a]], span_hash(h, a, b + WINDOW), row, a - offsets[row], b - offsets[row]


def merge_ranges(ids: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The union of ranges for each id, as sorted ranges that do not touch."""
    if not len(ids):
        return ids, start, stop
    order = np.lexsort((start, ids))
    ids, start, stop = ids[order], start[order], stop[order]
    same = np.zeros(len(ids), bool)
    same[1:] = ids[1:] == ids[:-1]
    group = np.cumsum(~same)
    # Running maximum of stops inside each id: groups are lifted above one another.
    lift = int(stop.max()) + 1
    reach = np.maximum.accumulate(stop + group * lift) - group * lift
    new = ~same
    new[1:] |= start[1:] > reach[:-1]
    at = np.flatnonzero(new)
    return ids[at], start[at], reach[np.append(at[1:], len(ids)) - 1]


def _rows(kind: int, key: np.ndarray, ids: np.ndarray, digest: np.ndarray, a: np.ndarray, b: np.ndarray, large: np.ndarray | bool = False) -> pa.RecordBatch:
    n = len(ids)
    flags = pa.array(np.broadcast_to(np.array(large), n))
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(n, kind, np.int32)), pa.array(key.view(np.int64)), pa.array(ids), pa.array(digest), pa.array(a), pa.array(b), flags],
        ["kind", "key", "id", "digest", "a", "b", "large"],
    )


def _covered(ids: np.ndarray, digest: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    """Rows of kind 1: bytes a to b of a document are covered."""
    doc = _group_ids([ids, digest])
    example = np.empty(int(doc.max()) + 1, np.int64)
    example[doc] = np.arange(len(doc))
    doc, a, b = merge_ranges(doc, a, b)
    ids, digest = ids[example[doc]], digest[example[doc]]
    return _rows(1, mix(ids.view(np.uint64) ^ mix(digest.view(np.uint64))), ids, digest, a, b)


def _cut(docs: DataFrame) -> DataFrame:
    """Kind 0: the first of each different segment in a task. Kind 1: ranges covered in it."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def give() -> Iterator[pa.RecordBatch]:
            key, seg, ids, digest, a, b = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.lexsort((a, digest, ids, seg, key))
            key, seg, ids, digest, a, b = key[order], seg[order], ids[order], digest[order], a[order], b[order]
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (seg[1:] != seg[:-1])
            lead = np.flatnonzero(new)[np.cumsum(new) - 1]
            later = (ids != ids[lead]) | (digest != digest[lead]) | (a != a[lead])
            if later.any():
                covered = _covered(ids[later], digest[later], a[later], b[later] + WINDOW)
                yield covered.append_column("seg", pa.array(np.zeros(covered.num_rows, np.int64)))
            out = _rows(0, key[new], ids[new], digest[new], a[new], b[new])
            yield out.append_column("seg", pa.array(seg[new].view(np.int64)))

        for batch in batches:
            ids, digest = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for first, _, data, offsets in text_slices(batch.column(2)):
                key, seg, row, a, b = segments(data, offsets)
                held.append((key, seg, ids[first + row], digest[first + row], a, b))
                if sum(len(x[0]) for x in held) >= HELD:
                    yield from give()
                    held.clear()
        if held:
            yield from give()

    return docs.select("id", "digest", "text").mapInArrow(cut, f"{_FOUND}, seg bigint")


def by_key(batches: Iterator[pa.RecordBatch], limit: Callable[[pa.RecordBatch], int] | None = None) -> Iterator[pa.RecordBatch]:
    """Batches sorted by ``key``, cut anew so that no key is in two of them."""
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(batch.schema.get_field_index("key")).to_numpy()
        if kept and kept[0].column(kept[0].schema.get_field_index("key"))[0].as_py() != keys[0]:
            yield from _joined(kept)
            kept = []
        at = int(np.searchsorted(keys, keys[-1], "left"))
        if at:
            yield from _joined([*kept, batch.slice(0, at)])
            kept = []
        kept.append(batch.slice(at))
    if kept:
        yield from _joined(kept)


def _joined(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    whole = pa.Table.from_batches(batches).combine_chunks()
    yield from whole.to_batches()


def _hot(docs: DataFrame) -> DataFrame:
    """``key`` of buckets that many documents have, out of a sample of them; bounded.

    Any bucket may be in it without a change of the result: it only tells which ones are dealt
    out by their segments.
    """
    some = docs.where(F.pmod(F.xxhash64("id", "digest", F.lit(3)), F.lit(SAMPLED)) == 0)
    counts = _cut(some).where("kind = 0").groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") >= FREQUENT)
    return stored(counts.orderBy(F.desc("n"), "key").limit(MOST_HOT).select("key", F.lit(True).alias("hot")), "suffix-hot")


def _compare(cut: DataFrame, hot: DataFrame) -> DataFrame:
    """Kind 1: covered ranges. Kind 2: the first of each segment of a bucket with different ones.

    Rows stream by in order, and a task holds a batch of them. The segments of a hot bucket are
    dealt over the tasks, equal ones to the same; such a task does not know whether there are
    others, and gives all of them on.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The last first segment, as (key, seg, id, digest, a, b, hot), and whether it was given on.
        held, told = None, False
        for batch in batches:
            kind = batch.column(0).to_numpy()
            given = kind == 1
            columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 7, 2, 3, 4, 5, 8)]
            if given.any():
                key, seg, ids, digest, a, b, _ = (c[given] for c in columns)
                yield _covered(ids, digest, a, b)
            columns = [c[~given] for c in columns]
            if not len(columns[0]):
                continue
            if held is not None:
                columns = [np.concatenate([[x], c]).astype(c.dtype) for x, c in zip(held, columns)]
            key, seg, ids, digest, a, b, is_hot = columns
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (seg[1:] != seg[:-1])
            first = np.flatnonzero(new)
            lead = first[np.cumsum(new) - 1]
            later = (ids != ids[lead]) | (digest != digest[lead]) | (a != a[lead])
            if later.any():
                yield _covered(ids[later], digest[later], a[later], b[later] + WINDOW)
            keys = key[first]
            before, after = np.zeros(len(first), bool), np.zeros(len(first), bool)
            before[1:] = after[:-1] = keys[1:] == keys[:-1]
            give = before | after | is_hot[first]
            if held is not None:
                before[0] |= told
                give[0] = give[0] and not told
            # What comes after the last one is not known yet.
            last = len(first) - 1
            held = tuple(c[first[last]] for c in columns)
            was_told = told and held is not None and last == 0
            told = bool(give[last]) or was_told or (last > 0 and bool(before[last]))
            if give.any():
                at = first[give]
                yield _rows(2, key[at], ids[at], digest[at], a[at], b[at])

    deal = F.when(F.col("hot"), F.xxhash64("key", "seg")).otherwise(F.col("key"))
    marked = cut.join(F.broadcast(hot), "key", "left").select(*cut.columns, F.coalesce("hot", F.lit(False)).alias("hot"))
    dealt = marked.repartition(deal).sortWithinPartitions("key", "seg", "id", "digest", "a")
    return dealt.mapInArrow(compare, _FOUND)


def _eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as one big-endian number."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    n = len(data)
    out = np.zeros(n, np.uint64)
    for i in range(8):
        out = (out << np.uint64(8)) | padded[i : i + n]
    return out


def _group_ids(keys: list[np.ndarray]) -> np.ndarray:
    """Equal tuples get equal numbers, in sorted order (the first key is the most significant)."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    for k in keys:
        s = k[order]
        new[1:] |= s[1:] != s[:-1]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new)
    return out


def first_equal(data: np.ndarray, start: np.ndarray, bucket: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """For each window of ``data``, the least rank of the windows of its bucket equal to it.

    Windows are sorted by their first PERIOD bytes; ties are resolved by their last bytes and
    by cover-sample ranks.
    """
    eights = _eights(data)
    out = rank.copy()
    tie = _group_ids([bucket, *(eights[start + i] for i in range(0, PERIOD, 8))])
    many = np.flatnonzero(np.bincount(tie)[tie] > 1)
    if not len(many):
        return out
    middle = WINDOW - PERIOD
    ends = [eights[start[many] + i] for i in (*range(middle, WINDOW - 8, 8), WINDOW - 8)]
    tie = _group_ids([tie[many], *ends])
    some = np.bincount(tie)[tie] > 1
    many, tie = many[some], tie[some]
    if not len(many):
        return out
    # Ranks of the sampled places, by the ``middle`` bytes from each.
    cover = difference_cover()
    sampled = np.zeros(PERIOD, bool)
    sampled[cover] = True
    place = np.flatnonzero(sampled[np.arange(len(data)) % PERIOD])
    place = place[place + middle <= len(data)]
    sample_rank = np.zeros(len(data), np.int64)
    sample_rank[place] = _group_ids([eights[place + i] for i in (*range(0, middle - 8, 8), middle - 8)])
    at, width = start[many], int(sample_rank.max()) + 1
    least = rank[many].copy()
    for shift in range(PERIOD):
        on = np.flatnonzero(sampled[(at + shift) % PERIOD])
        if not len(on):
            continue
        key = tie[on] * width + sample_rank[at[on] + shift]
        order = np.argsort(key, kind="stable")
        edge = np.flatnonzero(np.concatenate([[True], key[order][1:] != key[order][:-1]]))
        lows = np.minimum.reduceat(rank[many][on][order], edge)
        low = np.empty(len(on), np.int64)
        low[order] = np.repeat(lows, np.diff(np.append(edge, len(on))))
        least[on] = np.minimum(least[on], low)
    out[many] = least
    return out


def _sort_buckets(parts: DataFrame) -> DataFrame:
    """Covered ranges from the text of segments (key, id, digest, a, part), bucket by bucket."""

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []
        for batch in by_key(batches):
            keys, at = batch.column(0).to_numpy(), 0
            edges = np.append(np.flatnonzero(keys[1:] != keys[:-1]) + 1, len(keys))
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in batch.column(4).to_pylist()])])
            for edge in edges.tolist():
                if offsets[edge] - offsets[at] >= CHUNK or edge == len(keys):
                    kept.append(batch.slice(at, edge - at))
                    at = edge
                    if sum(k.nbytes for k in kept) >= CHUNK:
                        yield from _joined(kept)
                        kept = []
        if kept:
            yield from _joined(kept)

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            key, ids, digest, a = (batch.column(i).to_numpy() for i in range(4))
            raw = [x.as_py() for x in batch.column(4)]
            size = np.array([len(x) for x in raw])
            data = np.frombuffer(b"".join(raw), np.uint8)
            base = np.concatenate([[0], np.cumsum(size)])[:-1]
            count = size - WINDOW + 1
            owner = np.repeat(np.arange(len(raw)), count)
            within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            who, which, place = ids[owner], digest[owner], a[owner] + within
            # Places in the order of the documents; equal places of equal documents are one.
            rank = _group_ids([who, which, place])
            least = first_equal(data, base[owner] + within, key[owner], rank)
            later = least < rank
            if later.any():
                yield _covered(who[later], which[later], place[later], place[later] + WINDOW)

    dealt = parts.repartition("key").sortWithinPartitions("key", "id", "digest", "a")
    return dealt.mapInArrow(sort, _FOUND)


def _fetch(docs: DataFrame, asked: DataFrame) -> DataFrame:
    """(key, id, digest, a, part, large): the bytes of the segments asked for."""
    wanted = asked.groupBy("id", "digest").agg(F.collect_list(F.struct("key", "a", "b", "large")).alias("asked"))

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                text = (batch.column(2)[i].as_py() or "").encode()
                rows = batch.column(3)[i].as_py()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([r["key"] for r in rows], pa.int64()),
                        pa.array([batch.column(0)[i].as_py()] * len(rows), pa.int64()),
                        pa.array([batch.column(1)[i].as_py()] * len(rows), pa.int64()),
                        pa.array([r["a"] for r in rows], pa.int64()),
                        pa.array([text[r["a"] : r["b"] + WINDOW] for r in rows], pa.binary()),
                        pa.array([r["large"] for r in rows], pa.bool_()),
                    ],
                    ["key", "id", "digest", "a", "part", "large"],
                )

    found = docs.join(wanted, ["id", "digest"]).select("id", "digest", "text", "asked")
    return found.mapInArrow(fetch, "key bigint, id bigint, digest bigint, a bigint, part binary, large boolean")


def anchors(data: np.ndarray, offsets: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Where the string of its bucket, of hash ``key``, first stands in each segment."""
    h = prefix_hash(data)
    gram = mix((h[GRAM:] - h[:-GRAM]) * powers(INVERSE, len(data) - GRAM + 1))
    owner = np.repeat(np.arange(len(key)), np.diff(offsets))[: len(gram)]
    # One over the border of two segments comes after that of the first.
    hit = np.flatnonzero(gram == key[owner])
    _, first = np.unique(owner[hit], return_index=True)
    return hit[first] - offsets[:-1]


def _group_windows(parts: DataFrame, sizes: DataFrame) -> DataFrame:
    """Covered ranges of large buckets, which are halved by the place of their string in a window.

    It stands ``lo`` to ``hi`` bytes from the start of a segment's windows, 0 to 68 at first. Each
    segment is cut into a piece for each half of that range. All windows of a piece have the
    ``lo`` bytes before the string and the 68 - ``hi`` after it, and so have windows equal to them:
    these bytes tell the next, smaller bucket. A piece equal to an earlier one is covered, and goes;
    buckets of up to ``LARGE`` pieces that are left are sorted, and larger ones halved again. After seven
    times a piece is a window. Pieces inside a passage are equal and those beyond it alone in their
    bucket, so of a segment only the two at the ends of the passage are left as a rule; each gives two rows.

    A bucket is dealt out in portions of about ``LARGE`` pieces. A task gives on its first of each
    different piece; equal ones after it go as merged ranges.
    """

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        raw: list[bytes] = []

        def more(rows: pa.RecordBatch, *columns: pa.Array) -> pa.RecordBatch:
            for name, column in zip(("w1", "w2", "at", "lo", "hi", "part"), columns, strict=True):
                rows = rows.append_column(name, column)
            return rows

        def give() -> Iterator[pa.RecordBatch]:
            columns = [np.concatenate(x) for x in zip(*held, strict=True)]
            key, one, two, ids, digest, a = columns[:6]
            order = np.lexsort((a, digest, ids, two, one, key))
            key, one, two, ids, digest, a, b, at, lo, hi, row, skip = (x[order] for x in columns)
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (one[1:] != one[:-1]) | (two[1:] != two[:-1])
            lead = np.flatnonzero(new)[np.cumsum(new) - 1]
            later = (ids != ids[lead]) | (digest != digest[lead]) | (a != a[lead])
            if later.any():
                covered = _covered(ids[later], digest[later], a[later], b[later] + WINDOW)
                none = np.zeros(covered.num_rows, np.int64)
                yield more(covered, *[pa.array(none)] * 5, pa.nulls(covered.num_rows, pa.binary()))
            some = zip(row[new].tolist(), skip[new].tolist(), (b - a)[new].tolist(), strict=True)
            piece = pa.array([raw[r][s : s + n + WINDOW] for r, s, n in some], pa.binary())
            first = _rows(0, key[new], ids[new], digest[new], a[new], b[new])
            yield more(first, *(pa.array(x[new].astype(np.int64)) for x in (one.view(np.int64), two.view(np.int64), at, lo, hi)), piece)

        for batch in batches:
            columns = [batch.column(i).to_numpy() for i in (0, 1, 2, 3, 5, 6, 7)]
            for first, last, data, offsets in text_slices(batch.column(4), rows=HELD_PARTS):
                key, ids, digest, a, at, lo, hi = (c[first:last] for c in columns)
                key = key.view(np.uint64)
                at = np.where(at < 0, anchors(data, offsets, key), at) if (at < 0).any() else at
                start, size, end = offsets[:-1], np.diff(offsets), len(data)
                ahead, back = prefix_hash(data), prefix_hash(data[::-1])
                middle = (lo + hi) // 2
                for x, y in ((lo, middle), (middle + 1, hi)):
                    # First and last window of the piece in its segment.
                    s, e = np.maximum(at - y, 0), np.minimum(at - x, size - WINDOW)
                    on = np.flatnonzero((x <= y) & (s <= e))
                    begin, stop = (start + s)[on], (start + e + WINDOW)[on]
                    inner = span_hash(ahead, (start + at - x)[on], (start + at + WINDOW - y)[on])
                    held.append(
                        (
                            mix(mix(inner ^ key[on]) + x[on].astype(np.uint64)),
                            span_hash(ahead, begin, stop),
                            span_hash(back, end - stop, end - begin),
                            *(c[on] for c in (ids, digest, a + s, a + e, at - s, x, y)),
                            len(raw) + on,
                            s[on],
                        )
                    )
                raw += batch.column(4).slice(first, last - first).to_pylist()
                if len(raw) >= HELD_PARTS:
                    yield from give()
                    held.clear()
                    raw.clear()
        if held:
            yield from give()

    names = ["key", "id", "digest", "a", "part", "at", "lo", "hi"]
    kinds = f"{_FOUND}, w1 bigint, w2 bigint, at bigint, lo bigint, hi bigint, part binary"
    portion = F.pmod(F.xxhash64("id", "digest", "a"), F.ceil(F.col("n") / LARGE))
    place = F.struct("id", "digest", "a")
    # Rows of a piece: one for each portion at most, but for portions that are held in turns.
    in_order = Window.partitionBy("key", "w1", "w2").orderBy("id", "digest", "a")
    columns = ["kind", "key", "id", "digest", "a", "b", "large"]
    parts = parts.withColumns({"at": F.lit(-1).cast("bigint"), "lo": F.lit(0).cast("bigint"), "hi": F.lit(WINDOW - GRAM).cast("bigint")})
    many = sizes.where(F.col("n") > LARGE)
    ranges, small = [], []
    for _ in range((WINDOW - GRAM).bit_length()):
        # There is one large bucket for each LARGE rows at most.
        dealt = parts.join(F.broadcast(many), "key").withColumn("portion", portion)
        dealt = dealt.repartition("key", "portion").sortWithinPartitions("key", "portion").select(*names)
        found = stored(dealt.mapInArrow(spread, kinds), "suffix-windows")
        ranked = found.where("kind = 0").withColumns({"nth": F.row_number().over(in_order), "f": F.first(place).over(in_order)})
        ranked = stored(ranked, "suffix-pieces")
        later = ranked.where(place != F.col("f")).withColumns({"kind": F.lit(1), "b": F.col("b") + WINDOW})
        ranges += [found.where("kind = 1").select(*columns), later.select(*columns)]
        parts = ranked.where("nth = 1").select(*names)
        counts = stored(parts.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "suffix-piece-sizes")
        many = counts.where(F.col("n") > LARGE)
        rest = parts.join(F.broadcast(many.select("key")), "key", "left_anti")
        small.append(rest.join(counts, "key", "left_semi").select("key", "id", "digest", "a", "part"))
        if not many.take(1):
            break
    ranges.append(_sort_buckets(reduce(DataFrame.unionByName, small)))
    return reduce(DataFrame.unionByName, ranges)


def covered_ranges(docs: DataFrame) -> DataFrame:
    """(id, digest, ranges): covered byte ranges of each document that has any, not merged."""
    found = stored(_compare(_cut(docs), _hot(docs)), "suffix-found")
    # Counted before the shuffle and after it, whatever the size of a bucket.
    sizes = stored(found.where("kind = 2").groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "suffix-sizes")
    asked = found.where("kind = 2").drop("large").join(sizes, "key").select("id", "digest", "key", "a", "b", (F.col("n") > LARGE).alias("large"))
    parts = stored(_fetch(docs, asked), "suffix-parts")
    ranges = found.where("kind = 1").unionByName(_sort_buckets(parts.where("not large").drop("large")))
    if parts.where("large").take(1):
        ranges = ranges.unionByName(_group_windows(parts.where("large").drop("large"), sizes))
    return ranges.groupBy("id", "digest").agg(F.collect_list(F.struct("a", "b")).alias("ranges"))


def with_ranges(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` and their covered ranges in ``__ranges``, null for none."""
    keyed = docs.withColumns({"__id": F.coalesce("doc_id", F.lit(FIRST_ID)), "__digest": F.xxhash64("text")})
    ranges = covered_ranges(keyed.select(F.col("__id").alias("id"), F.col("__digest").alias("digest"), "text"))
    ranges = ranges.select(F.col("id").alias("__id"), F.col("digest").alias("__digest"), F.col("ranges").alias("__ranges"))
    return keyed.join(ranges, ["__id", "__digest"], "left").drop("__id", "__digest")


def kept_bytes(text: str | None, ranges: pa.Scalar) -> tuple[bytes, int, int, int]:
    """(what is left, bytes, bytes removed, runs removed)."""
    data = (text or "").encode()
    if not ranges.is_valid or not len(ranges.values):
        return data, len(data), 0, 0
    flat = ranges.values
    a, b = flat.field("a").to_numpy(), flat.field("b").to_numpy()
    _, a, b = merge_ranges(np.zeros(len(a), np.int64), a, b)
    b = np.minimum(b, len(data))
    # Runs that touch are one run.
    pieces, at = [], 0
    for s, e in zip(a.tolist(), b.tolist(), strict=True):
        pieces.append(data[at:s])
        at = e
    pieces.append(data[at:])
    left = b"".join(pieces)
    return left, len(data), len(data) - len(left), len(a)


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with covered bytes taken out of text; cut characters go, n_chars follows."""
    schema = docs.schema
    names = docs.columns
    text_at, chars_at = names.index("text"), names.index("n_chars") if "n_chars" in names else None

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                x.as_py() if not r.is_valid else kept_bytes(x.as_py(), r)[0].decode("utf-8", "ignore")
                for x, r in zip(batch.column(text_at), batch.column(len(names)), strict=True)
            ]
            columns = list(batch.columns[: len(names)])
            columns[text_at] = pa.array(texts, columns[text_at].type)
            if chars_at is not None:
                columns[chars_at] = pa.array([len(t) if t is not None else None for t in texts], columns[chars_at].type)
            yield pa.RecordBatch.from_arrays(columns, names)

    return with_ranges(docs).select(*names, "__ranges").mapInArrow(rewrite, schema)


def op9_difference_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [kept_bytes(x.as_py(), r) for x, r in zip(batch.column(1), batch.column(2), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)]
                + [pa.array([r[i] for r in rows], pa.int64()) for i in (1, 2, 3)]
                + [pa.array([hashlib.sha256(r[0]).hexdigest() for r in rows], pa.string())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return with_ranges(docs).select("doc_id", "text", "__ranges").mapInArrow(
        digest, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    )


#: Every window of every document, in hexadecimal, so that bytes can be cut.
SQL = """
WITH d AS (
  SELECT doc_id, hex(coalesce(text, '')) AS h, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n_bytes FROM documents
), blocks AS (
  -- Short pieces that overlap by a window, as cutting from a long text reads all of it.
  SELECT doc_id, n_bytes, k, substr(h, 2000 * k + 1, 2200) AS block
  FROM (SELECT doc_id, h, n_bytes, unnest(range(0, (n_bytes + 900) // 1000)) AS k FROM d)
), w AS (
  SELECT doc_id, 1000 * k + j AS i, md5(substr(block, 2 * j + 1, 200)) AS s
  FROM (SELECT doc_id, k, block, unnest(range(0, least(1000, n_bytes - 99 - 1000 * k))) AS j FROM blocks)
), later AS (
  SELECT doc_id, i FROM w QUALIFY row_number() OVER (PARTITION BY s ORDER BY doc_id, i) > 1
), edges AS (
  SELECT doc_id, i, coalesce(i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100, true) AS new FROM later
), runs AS (
  SELECT doc_id, min(i) AS a, max(i) + 100 AS b FROM (
    SELECT doc_id, i, sum(new::INT) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM edges) GROUP BY doc_id, run
), pieces AS (
  SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM runs
), kept AS (
  SELECT p.doc_id, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS last,
         string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS head
  FROM pieces p JOIN d ON d.doc_id = p.doc_id GROUP BY p.doc_id
)
SELECT d.doc_id, n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(CASE WHEN last IS NULL THEN h ELSE head || substr(h, 2 * last + 1) END)) AS kept_sha256
FROM d LEFT JOIN kept ON kept.doc_id = d.doc_id
"""
