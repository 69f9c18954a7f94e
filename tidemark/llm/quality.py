"""Quality scores: random Fourier features of document statistics, ridge, isotonic.

Each text becomes ``STATS`` numbers (lengths, character classes, repetition). Random Fourier
features of the standardised numbers approximate a Gaussian kernel. Ridge regression on them
needs only the sums of x x' and x y, which each partition takes over its labelled rows and
Spark adds up; all labelled rows count. The raw scores, counted in bins, are calibrated by
isotonic regression.

Cases. Null or empty text: all statistics 0, scored like any other. No labelled row: score
0.5. Labels without a document or without quality: ignored; several labels of a document all
count. Very long texts: statistics of the whole text, in slices of whole rows. Repeated rows:
each is scored. Ties: equal texts have equal scores. Extra columns: ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import WORD_BYTE, fold, lists_of, span_hash, prefix_hash, stored, sums_by_row, table, text_slices

FEATURES = 160
RIDGE = 1e-3
BINS = 1024
THRESHOLD = 0.3
STATS = (
    "chars", "words", "mean_word", "upper", "digit", "symbol", "odd_symbol", "space", "shout",
    "bare_token", "symbol_end", "distinct_words", "top_word", "word_again", "distinct_lines", "line_length", "non_ascii", "ends_sentence",
)


def _class(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[ord(c) for c in chars]] = True
    return out


_UPPER = _class("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_DIGIT = _class("0123456789")
_SPACE = _class(" \t\n\x0b\x0c\r")
_SYMBOL = ~WORD_BYTE & ~_SPACE
_PLAIN = _class(".,;:'\"?()-")
_SHOUT = _class("!?")


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, stop, runs per row) of the runs of True, none across rows."""
    flips = np.zeros(len(inside) + 1, bool)
    flips[0] = flips[-1] = True
    flips[1:-1] = inside[1:] != inside[:-1]
    flips[offsets] = True
    edges = np.flatnonzero(flips)
    start, stop = edges[:-1], edges[1:]
    keep = inside[start] if len(inside) else np.zeros(0, bool)
    start, stop = start[keep], stop[keep]
    return start, stop, np.diff(np.searchsorted(start, offsets))


def _repetition(h: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct values, times of the most frequent one) for each row of values."""
    rows = len(counts)
    owner = np.repeat(np.arange(rows, dtype=np.uint64), counts)
    bits = np.uint64(max(1, int(rows).bit_length()))
    key = np.sort((owner << (np.uint64(64) - bits)) | (h >> bits))
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    first = np.flatnonzero(new)
    times = np.diff(np.append(first, len(key)))
    who = (key[first] >> (np.uint64(64) - bits)).astype(np.int64)
    distinct, top = np.bincount(who, minlength=rows), np.zeros(rows, np.int64)
    np.maximum.at(top, who, times)
    return distinct, top


def text_stats(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of ``STATS`` for each text."""
    size = np.diff(offsets)
    n = np.maximum(size, 1)
    part = lambda flags: sums_by_row(flags, offsets) / n
    symbol = _SYMBOL[data]
    start, stop, words = runs(~_SPACE[data], offsets)
    w = np.maximum(words, 1)
    h = prefix_hash(data)
    hashes = span_hash(h, start, stop)
    token_sum = np.concatenate([[0], np.cumsum(WORD_BYTE[data])])
    bare = (token_sum[stop] - token_sum[start]) == 0
    again = np.zeros(len(start), bool)
    if len(start) > 1:
        again[1:] = hashes[1:] == hashes[:-1]
    first = np.concatenate([[0], np.cumsum(words)])
    again[first[:-1][words > 0]] = False
    last = data[stop - 1] if len(stop) else np.zeros(0, np.uint8)
    odd_end = _SYMBOL[last] & ~_PLAIN[last]
    per_word = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags)])[first]) / w
    distinct, top = _repetition(hashes, words)
    l_start, l_stop, lines = runs(data != 10, offsets)
    l_distinct, _ = _repetition(span_hash(h, l_start, l_stop), lines)
    ends = np.zeros(len(size))
    full = size > 0
    ends[full] = np.isin(data[offsets[1:][full] - 1], [33, 46, 63])
    return np.column_stack(
        [
            np.log1p(size), np.log1p(words), np.log1p(sums_by_row(~_SPACE[data], offsets) / w),
            part(_UPPER[data]), part(_DIGIT[data]), part(symbol), part(symbol & ~_PLAIN[data]), part(_SPACE[data]), part(_SHOUT[data]),
            per_word(bare), per_word(odd_end), distinct / w, top / w, per_word(again), l_distinct / np.maximum(lines, 1), np.log1p(size / np.maximum(lines, 1)),
            part(data >= 128), ends,
        ]
    )


def document_stats(docs: DataFrame) -> DataFrame:
    """doc_id, held_out and x, the statistics of each text."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [text_stats(data, offsets) for _, _, data, offsets in text_slices(batch.column(2))]
            x = np.concatenate(found) if found else np.zeros((0, len(STATS)))
            lists = lists_of(x.reshape(-1), np.full(len(x), len(STATS)), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], ["doc_id", "held_out", "x"])

    given = docs.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "text")
    return given.mapInArrow(measure, "doc_id bigint, held_out boolean, x array<double>")


def matrix_of(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


@dataclass(frozen=True)
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    waves: np.ndarray
    phase: np.ndarray
    weights: np.ndarray
    bins: np.ndarray
    values: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        """Random Fourier features, with a column of ones."""
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.column_stack([np.sqrt(2 / len(self.phase)) * np.cos(z @ self.waves + self.phase), np.ones(len(x))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(x), self.bins, self.values), 0, 1)


def isotonic(at: np.ndarray, total: np.ndarray, positive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: (place, rate) of each block, rates not decreasing."""
    blocks: list[list[float]] = []
    for x, n, p in zip(at, total, positive, strict=True):
        blocks.append([x * n, n, p])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][1] >= blocks[-1][2] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    return np.array([b[0] / b[1] for b in blocks]), np.array([b[2] / b[1] for b in blocks])


def fit_quality(stats: DataFrame, labels: DataFrame, features: int = FEATURES, ridge: float = RIDGE) -> QualityModel | None:
    """Learns quality of the labelled rows that are not held out; None without any."""
    known = labels.where(F.col("quality").isNotNull()).select("doc_id", F.col("quality").cast("double").alias("y"))
    train = stored(stats.where(~F.col("held_out")).join(known, "doc_id").select("x", "y"), "quality-train")
    width = len(STATS)
    terms = [F.sum(F.col("x")[i]) for i in range(width)] + [F.sum(F.col("x")[i] * F.col("x")[i]) for i in range(width)]
    n, *sums = train.agg(F.count("*"), *terms).first()
    if not n:
        return None
    mean, square = np.array(sums[:width]) / n, np.array(sums[width:]) / n
    scale = np.sqrt(np.maximum(square - mean**2, 0))
    scale[scale < 1e-6] = 1.0
    rng = np.random.default_rng(20)
    waves = rng.normal(size=(width, features)) / np.sqrt(width)
    start = QualityModel(mean, scale, waves, rng.uniform(0, 2 * np.pi, features), np.zeros(features + 1), np.zeros(1), np.zeros(1))
    size = features + 1

    def normal_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size + 1))
        for batch in batches:
            z = start.features(matrix_of(batch.column(0), width))
            y = batch.column(1).to_numpy(zero_copy_only=False)
            total += z.T @ np.column_stack([z, y])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.reshape(-1))], ["i", "v"])

    # size * (size + 1) sums, whatever the number of rows and partitions.
    added = train.mapInArrow(normal_sums, "i bigint, v double").groupBy("i").agg(F.sum("v").alias("v")).toArrow()
    flat = np.zeros(size * (size + 1))
    flat[added.column("i").to_numpy()] = added.column("v").to_numpy()
    a, b = flat.reshape(size, size + 1)[:, :size], flat.reshape(size, size + 1)[:, size]
    penalty = ridge * n * np.eye(size)
    penalty[-1, -1] = 0
    ridge_fit = QualityModel(mean, scale, waves, start.phase, np.linalg.solve(a + penalty, b), np.zeros(1), np.zeros(1))

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = np.clip(ridge_fit.raw(matrix_of(batch.column(0), width)), -0.5, 1.5)
            place = np.minimum(((raw + 0.5) / 2 * BINS).astype(np.int64), BINS - 1)
            yield pa.RecordBatch.from_arrays([pa.array(place), batch.column(1)], ["bin", "y"])

    counted = train.mapInArrow(binned, "bin bigint, y double").groupBy("bin").agg(F.count("*").alias("n"), F.sum("y").alias("p")).orderBy("bin").collect()
    at = (np.array([r["bin"] for r in counted]) + 0.5) / BINS * 2 - 0.5
    bins, values = isotonic(at, np.array([r["n"] for r in counted], float), np.array([r["p"] for r in counted], float))
    return QualityModel(mean, scale, waves, start.phase, ridge_fit.weights, bins, values)


def score_quality(stats: DataFrame, model: QualityModel | None, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of statistics."""
    shared = stats.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            x = matrix_of(batch.column(2), len(STATS))
            got = model.score(x) if model else np.full(len(x), 0.5)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(got), pa.array((got >= threshold).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"]
            )

    return stats.mapInArrow(score, "doc_id bigint, held_out boolean, score double, predicted int")


def op6_fourier_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every document."""
    stats = stored(document_stats(table(spark, sf_dir, "documents")), "quality-stats")
    return score_quality(stats, fit_quality(stats, table(spark, sf_dir, "labels")))
