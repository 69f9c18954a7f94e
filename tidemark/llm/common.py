"""Helpers shared by the operators: table reading, folds, scratch tables, byte arrays.

The numpy helpers work on slices: the UTF-8 bytes of some rows, one after the other, with
the offset of each row. A slice holds about ``SLICE_BYTES`` (or one longer text), which
bounds the memory of a task whatever the size of an Arrow batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_dir

SLICE_BYTES = 1 << 20
FOLDS = 5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, mod 5; rows in fold 0 (or without an id) are held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS, F.lit(0)).cast("int")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts the lineage, survives executors."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def label_sample(df: DataFrame, label: str, per_label: int) -> DataFrame:
    """Rows of ``df`` by the hash of doc_id: about ``per_label`` for each label, or all of them.

    The hash decides alone, so the sample does not depend on partitions or on other columns,
    and its size is bounded by ``per_label`` times the number of labels, but for chance.
    """
    counts = df.groupBy(label).count().collect()
    part = (F.xxhash64("doc_id", F.lit(17)) / F.lit(2.0**64) + 0.5).cast("double")
    keep = F.lit(False)
    for row in counts:
        if row[label] is not None:
            keep = keep | ((F.col(label) == F.lit(row[label])) & (part < per_label / row["count"]))
    return df.where(keep)


# --- byte slices ---------------------------------------------------------------------------

BASE = np.uint64(0x9E3779B97F4A7C55)  # odd, so it has an inverse modulo 2**64
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
_powers: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    got = _powers.get(int(base))
    if got is None or len(got) < n:
        steps = np.full(max(n, SLICE_BYTES + 4096), base, np.uint64)
        steps[0] = 1
        got = _powers[int(base)] = np.multiply.accumulate(steps)
    return got[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A well mixed 64-bit value of each 64-bit value (one to one)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """H with H[j] - H[i] = sum of data[t] * BASE**t for i <= t < j."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(BASE, len(data)), out=out[1:])
    return out


def span_hash(h: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Hash of data[start:stop], the same wherever the bytes stand."""
    raw = (h[stop] - h[start]) * powers(INVERSE, len(h) + 1)[start]
    return mix(raw + (stop - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def lists_of(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """An Arrow list column of consecutive runs of ``values``."""
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def text_slices(column: pa.Array, limit: int = SLICE_BYTES, rows: int | None = None) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets) of a string column; null counts as empty.

    A slice has ``limit`` bytes or one text, and ``rows`` texts at most.
    """
    n = len(column)
    if n == 0:
        return
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        last = min(last, n, n if rows is None else first + rows)
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def lowered_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """As ``text_slices``, with every text in lower case."""
    texts, first, size = [], 0, 0
    for i, value in enumerate(column):
        texts.append((value.as_py() or "").lower().encode())
        size += len(texts[-1])
        if size >= limit or i + 1 == len(column):
            offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
            yield first, i + 1, np.frombuffer(b"".join(texts), np.uint8), offsets
            texts, first, size = [], i + 1, 0


WORD_BYTE = np.zeros(256, bool)
for _c in range(256):
    WORD_BYTE[_c] = _c >= 128 or chr(_c).isalnum()


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, stop, words per row): runs of ASCII letters, digits and non-ASCII bytes."""
    inside = WORD_BYTE[data]
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    edges = offsets[1:-1][offsets[1:-1] < len(data)]
    before[edges] = False
    start = np.flatnonzero(inside & ~before)
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    after[edges[edges > 0] - 1] = False
    stop = np.flatnonzero(inside & ~after) + 1
    counts = np.diff(np.searchsorted(start, offsets))
    return start, stop, counts


def shingles_of(words: np.ndarray, counts: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hash, shingles per row) of k words in a row; a shorter text gives one of all its words."""
    owner = np.repeat(np.arange(len(counts)), counts)
    n = len(words)
    h = np.zeros(n, np.uint64)
    for j in range(k):
        h *= np.uint64(0xC2B2AE3D27D4EB4F)
        part = np.zeros(n, np.uint64)
        here = max(0, n - j)
        # Nothing adds nothing, which no word does but by chance.
        part[:here] = np.where(owner[:here] == owner[j:], mix(words[j:] + np.uint64(0x632BE59BD9B4E019)), 0)
        h += part
    first = np.concatenate([[0], np.cumsum(counts)])[:-1]
    place = np.arange(n) - np.repeat(first, counts)
    keep = (place == 0) | (place + k <= np.repeat(counts, counts))
    return mix(h[keep]), np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def lower_bytes(data: np.ndarray) -> np.ndarray:
    """ASCII and Latin-1 capitals of UTF-8 bytes in lower case; the length stays."""
    out = LOWER[data]
    second = np.zeros(len(data), bool)
    second[1:] = data[:-1] == 0xC3
    out[second & (data >= 0x80) & (data <= 0x9E) & (data != 0x97)] += 0x20
    return out


def sums_by_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The sum of ``flags`` between each two offsets."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return np.diff(total[offsets])
