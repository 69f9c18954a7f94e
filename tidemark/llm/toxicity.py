"""Toxicity behind disguises: a noisy-channel decoder, then a score of the restored text.

1. Trigram counts of characters over all documents give a character language model.
2. In each text, spans that may be disguised are found by vector tests: tokens that mix
   letters with digits or symbols used as letters, letters repeated three times or more, and
   single letters set apart. Each span is a lattice: a character stands for itself, for the
   letters it looks like, or for nothing (a separator, a repeated letter). The Viterbi path
   under the language model is put in its place.
3. Words of the restored text, with doubled letters made single, and their first letters are
   features. Those seen clearly more often in toxic than in other labelled texts keep their
   log odds, and a logistic regression on the strongest of a text gives the score.

The labels used are a sample of at most about ``SAMPLE_PER_LABEL`` of either label, outside
fold 0. The language model counts every document.

Cases. Null or empty text: scored like a text without evidence. No labelled row: score 0.
Very long texts and spans: decoded whole, in time linear in their length. Labels without a
document or without toxic: ignored. Repeated rows: each is scored. Ties: equal texts have
equal scores; of equal paths the first candidate wins. Extra columns: ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import fold, label_sample, lists_of, lower_bytes, mix, prefix_hash, span_hash, stored, table, text_slices
from tidemark.llm.quality import runs

SAMPLE_PER_LABEL = 6_000
PLACES = 1 << 20
PREFIXES = (4, 5, 6, 7, 8)
THRESHOLD = 0.5
#: A feature must stand in this many toxic texts of the sample, and be this much more frequent.
LEAST_SHARE, LEAST_TEXTS, LEAST_RATIO = 0.01, 3, 6.0

# What a character may stand for.
LOOKS_LIKE = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c",
}
SEPARATORS = " .-_*"
LOOK_COST, NOISE_COST, REPEAT_COST, SEPARATOR_COST = 1.0, 9.0, 0.5, 0.0

_LETTER = np.zeros(256, bool)
_LETTER[97:123] = True
_LETTER[128:] = True
_LOOK = np.zeros(256, bool)
_LOOK[[ord(c) for c in LOOKS_LIKE]] = True
_MARK = np.zeros(256, bool)
_MARK[[ord(c) for c in "!|+("]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[ord(c) for c in SEPARATORS]] = True
_CLASS = np.zeros(256, np.uint16)
_CLASS[97:123] = np.arange(1, 27)
_CLASS[0xC0:] = 27
#: 0: between words, 1-26: a-z, 27: any other letter.
CLASSES = 28


def char_counts(docs: DataFrame) -> np.ndarray:
    """Trigram counts of character classes over every text: CLASSES**3 sums."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES**3, np.int64)
        for batch in batches:
            for _, _, data, offsets in text_slices(batch.column(0)):
                low = lower_bytes(data)
                lead = (low < 0x80) | (low >= 0xC0)  # one byte for each character
                edges = np.concatenate([[0], np.cumsum(lead)])[offsets]
                c = np.insert(_CLASS[low[lead]].astype(np.int64), np.repeat(edges, 2), 0)
                total += np.bincount((c[:-2] * CLASSES + c[1:-1]) * CLASSES + c[2:], minlength=CLASSES**3)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["gram", "n"])

    sums = docs.select("text").mapInArrow(count, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(CLASSES**3)
    out[sums.column("gram").to_numpy()] = sums.column("n").to_numpy()
    return out.reshape(CLASSES, CLASSES, CLASSES)


def char_costs(counts: np.ndarray) -> np.ndarray:
    """-log P(c | a, b), smoothed with the bigram and the uniform distribution."""
    pair = counts.sum(axis=0)
    p2 = (pair + 1) / (pair.sum(axis=1, keepdims=True) + CLASSES)
    p3 = (counts + 8 * p2[None]) / (counts.sum(axis=2, keepdims=True) + 8)
    return -np.log(np.maximum(p3, 1e-9))


def _place(c: str) -> int:
    return ord(c) - 96 if "a" <= c <= "z" else 27 if c.isalpha() else 0


def restore(span: str, costs: np.ndarray) -> str:
    """The Viterbi path through the lattice of one span.

    A state is the last two characters kept. What has been written so far hangs on it as a chain of
    characters, each with the one before it, so a step costs the same however long the span is.
    """
    states: dict[tuple[str, str], tuple[float, tuple | None]] = {("", ""): (0.0, None)}
    before = ""
    for c in span:
        options: list[tuple[str, float]] = []
        if c in LOOKS_LIKE:
            options = [(x, LOOK_COST) for x in LOOKS_LIKE[c]] + [("", REPEAT_COST if c == before else NOISE_COST)]
        elif c.isalpha():
            options = [(c, 0.0)] + ([("", REPEAT_COST)] if c == before else [])
        else:
            options = [("", SEPARATOR_COST if c in SEPARATORS else NOISE_COST)]
        if c.isalpha() or c in LOOKS_LIKE:
            before = c
        found: dict[tuple[str, str], tuple[float, tuple | None]] = {}
        for (a, b), (cost, chain) in states.items():
            for x, more in options:
                if x:
                    state = (b, x)
                    new = cost + more + costs[_place(a) if a else 0, _place(b) if b else 0, _place(x)]
                    out = (chain, x)
                else:
                    state, new, out = (a, b), cost + more, chain
                if state not in found or new < found[state][0]:
                    found[state] = (new, out)
        states = found
    ends = ((cost + costs[_place(a) if a else 0, _place(b) if b else 0, 0], chain) for (a, b), (cost, chain) in states.items())
    chain = min(ends, key=lambda e: e[0])[1]
    out = []
    while chain is not None:
        chain, x = chain
        out.append(x)
    return "".join(reversed(out))


def suspects(low: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, stop) of the spans of lower-case bytes that may be disguised, in order."""
    letter = _LETTER[low]
    part = letter | _DIGIT[low] | _LOOK[low]
    start, stop, _ = runs(part, offsets)
    if not len(start):
        return start, stop
    # At the end of a token, marks like ! and any symbol three times or more are decoration.
    solid = letter | _DIGIT[low]
    at = np.arange(len(low))
    last = np.maximum.accumulate(np.where(solid, at, -1))[stop - 1]
    tail = stop - 1 - last
    mark = (tail >= 3) | ((tail > 0) & _MARK[low[stop - 1]])
    stop = np.where(mark & (last >= start), last + 1, stop)
    count = lambda flags: np.concatenate([[0], np.cumsum(flags)])
    n_letter, n_look = count(letter), count(_LOOK[low])
    letters = n_letter[stop] - n_letter[start]
    mixed = (letters >= 1) & (n_look[stop] - n_look[start] >= 1) & (stop - start >= 3)
    again = np.zeros(len(low), bool)
    if len(low) > 2:
        again[:-2] = letter[:-2] & (low[:-2] < 128) & (low[:-2] == low[1:-1]) & (low[1:-1] == low[2:])
    repeated = (count(again)[np.maximum(stop - 2, start)] - count(again)[start]) > 0
    # Three single characters in a row, each one separator from the next, are one span.
    single = (stop - start == 1) & (letter[start] | _LOOK[low[start]])
    owner = np.searchsorted(offsets, start, "right")
    linked = np.zeros(len(start), bool)
    linked[1:] = single[1:] & single[:-1] & (start[1:] - stop[:-1] == 1) & (owner[1:] == owner[:-1]) & _SEPARATOR[low[np.maximum(start[1:] - 1, 0)]]
    chain = np.cumsum(~linked) - 1
    head = np.flatnonzero(~linked)
    length = np.bincount(chain)
    has_letter = np.bincount(chain, weights=letters) > 0
    spaced = (length >= 3) & has_letter
    c_start, c_stop = start[head][spaced], stop[np.append(head[1:], len(start)) - 1][spaced]
    alone = (mixed | repeated) & ~spaced[chain]
    s, e = np.concatenate([start[alone], c_start]), np.concatenate([stop[alone], c_stop])
    order = np.argsort(s, kind="stable")
    return s[order], e[order]


@dataclass
class Decoder:
    """Restores texts; spans seen before are looked up."""

    costs: np.ndarray
    seen: dict[bytes, bytes] = field(default_factory=dict)

    def span(self, raw: bytes) -> bytes:
        got = self.seen.get(raw)
        if got is None:
            if len(self.seen) > 50_000:
                self.seen.clear()
            got = self.seen[raw] = restore(raw.decode("utf-8", "ignore"), self.costs).encode()
        return got

    def texts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The lower-case texts with every suspect span restored, as bytes and offsets."""
        low = lower_bytes(data)
        start, stop = suspects(low, offsets)
        if not len(start):
            return low, offsets
        whole = low.tobytes()
        pieces, at, grown = [], 0, np.zeros(len(start), np.int64)
        for i, (s, e) in enumerate(zip(start.tolist(), stop.tolist(), strict=True)):
            new = self.span(whole[s:e])
            pieces += [whole[at:s], new]
            at, grown[i] = e, len(new) - (e - s)
        pieces.append(whole[at:])
        total = np.concatenate([[0], np.cumsum(grown)])
        moved = offsets + total[np.searchsorted(stop, offsets, "right")]
        return np.frombuffer(b"".join(pieces), np.uint8), moved


def features_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, place, words per row): distinct places of words and word beginnings of each row."""
    keep = np.ones(len(data), bool)
    letter = _LETTER[data]
    if len(data) > 1:
        keep[1:] = ~((data[1:] == data[:-1]) & letter[1:] & (data[1:] < 128))
        borders = offsets[1:-1]
        keep[borders[borders < len(data)]] = True
    total = np.concatenate([[0], np.cumsum(keep)])
    data, offsets, letter = data[keep], total[offsets], letter[keep]
    start, stop, words = runs(letter, offsets)
    owner = np.repeat(np.arange(len(words), dtype=np.int64), words)
    h = prefix_hash(data)
    rows, places = [owner], [span_hash(h, start, stop) % np.uint64(PLACES)]
    for k in PREFIXES:
        longer = stop - start > k
        s = start[longer]
        rows.append(owner[longer])
        places.append(mix(span_hash(h, s, s + k) + np.uint64(k)) % np.uint64(PLACES))
    key = np.unique((np.concatenate(rows) << 20) | np.concatenate(places).astype(np.int64))
    return key >> 20, key & (PLACES - 1), words


def evidence(row: np.ndarray, place: np.ndarray, words: np.ndarray, odds: np.ndarray) -> np.ndarray:
    """For each text: its largest, three largest and eight largest log odds, and log words."""
    n = len(words)
    got = odds[place]
    row, got = row[got > 0], got[got > 0]
    order = np.lexsort((-got, row))
    row, got = row[order], got[order]
    first = np.searchsorted(row, np.arange(n))
    rank = np.arange(len(row)) - first[row] if len(row) else np.zeros(0, np.int64)
    sums = [np.bincount(row[rank < k], got[rank < k], n) for k in (1, 3, 8)]
    every = np.bincount(row, got, n)
    return np.column_stack([*sums, every / np.sqrt(words + 20.0), np.log1p(words)])


#: Parts of the sample, and numbers that ``evidence`` gives for a text.
PARTS, EVIDENCE = 4, 5


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 40) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(mean, scale, weights) of a logistic regression by Newton steps; the last weight is free."""
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale[scale < 1e-9] = 1
    z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    penalty = ridge * np.eye(len(w))
    penalty[-1, -1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + penalty, z.T @ (p - y) + penalty @ w)
        w -= step * min(1.0, 5.0 / max(1e-9, np.abs(step).max()))
    return mean, scale, w


@dataclass(frozen=True)
class ToxicityModel:
    costs: np.ndarray
    odds: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.mean) / self.scale @ self.weights[:-1] + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def log_odds(docs_by_place: np.ndarray, toxic_by_place: np.ndarray, texts: int, toxic: int) -> np.ndarray:
    """Log odds of the features that clearly mark toxic texts, 0 for all others."""
    clean = docs_by_place - toxic_by_place
    p, q = (toxic_by_place + 0.5) / (toxic + 1), (clean + 0.5) / (texts - toxic + 1)
    found = (toxic_by_place >= max(LEAST_TEXTS, LEAST_SHARE * toxic)) & (p > LEAST_RATIO * q)
    return np.where(found, np.log(p / q), 0.0)


def fit_toxicity(docs: DataFrame, labels: DataFrame, per_label: int = SAMPLE_PER_LABEL) -> ToxicityModel | None:
    """Learns toxic of a sample of the labelled rows that are not held out; None without any."""
    spark = docs.sparkSession
    costs = char_costs(char_counts(docs))
    known = labels.where(F.col("toxic").isNotNull() & (fold(F.col("doc_id")) != 0)).select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    # At most about 2 * per_label rows, so both the broadcast and the arrays are bounded.
    sample = spark.createDataFrame(label_sample(known, "toxic", per_label).toArrow()) if labels.take(1) else known.limit(0)
    shared = spark.sparkContext.broadcast(costs)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(shared.value)
        for batch in batches:
            for first, last, data, offsets in text_slices(batch.column(1)):
                row, place, words = features_of(*decoder.texts(data, offsets))
                lists = lists_of(place.astype(np.int32), np.bincount(row, minlength=last - first), pa.int32())
                yield pa.RecordBatch.from_arrays([batch.column(0)[first:last], batch.column(2)[first:last], lists, pa.array(words)], ["toxic", "part", "places", "words"])

    # A part for each row, by its id and text: odds that a row is judged by come from the others.
    part = F.pmod(F.xxhash64("doc_id", "text", F.lit(7)), F.lit(PARTS)).cast("int").alias("part")
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select(F.least("toxic", F.lit(1)).alias("toxic"), "text", part)
    found = stored(texts.mapInArrow(features, "toxic int, part int, places array<int>, words bigint"), "toxicity-features")

    # Texts and toxic texts of each part, and of each place and part; only places that may count
    # come to the driver, which has a fixed number of them.
    totals = np.zeros((PARTS, 2), np.int64)
    for row in found.groupBy("part").agg(F.count("*").alias("n"), F.sum("toxic").alias("t")).collect():
        totals[row.part] = row.n, row.t
    if not totals[:, 0].sum() or totals[:, 1].sum() in (0, totals[:, 0].sum()):
        return None
    each = [c for p in range(PARTS) for c in (F.count_if(F.col("part") == p), F.count_if((F.col("part") == p) & (F.col("toxic") > 0)))]
    sums = found.select("part", "toxic", F.explode("places").alias("place")).groupBy("place")
    enough = max(LEAST_TEXTS, LEAST_SHARE * int(min(totals[:, 1].sum() - totals[:, 1])))
    sums = sums.agg(F.sum("toxic").alias("all"), *[c.alias(f"c{i}") for i, c in enumerate(each)]).where(F.col("all") >= enough).toArrow()
    by_place = np.zeros((PLACES, PARTS, 2), np.int32)
    by_place[sums.column("place").to_numpy()] = np.stack([sums.column(f"c{i}").to_numpy() for i in range(2 * PARTS)], axis=1).reshape(-1, PARTS, 2)

    def odds(use: np.ndarray) -> np.ndarray:
        n, t = totals[use].sum(axis=0).tolist()
        return log_odds(by_place[:, use, 0].sum(axis=1), by_place[:, use, 1].sum(axis=1), n, t)

    apart = spark.sparkContext.broadcast([odds(np.arange(PARTS) != p) for p in range(PARTS)])

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, own = batch.column(2), batch.column(1).to_numpy()
            n = np.diff(lists.offsets.to_numpy())
            row, place, words = np.repeat(np.arange(batch.num_rows), n), lists.flatten().to_numpy(), batch.column(3).to_numpy()
            x = np.zeros((batch.num_rows, EVIDENCE))
            for p in range(PARTS):
                mine = own[row] == p
                x[own == p] = evidence(row[mine], place[mine], words, apart.value[p])[own == p]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c) for c in x.T.copy()]], ["toxic", *[f"x{i}" for i in range(EVIDENCE)]])

    schema = ", ".join(["toxic int", *[f"x{i} double" for i in range(EVIDENCE)]])
    seen = found.mapInArrow(judged, schema).toArrow()
    x = np.column_stack([seen.column(f"x{i}").to_numpy() for i in range(EVIDENCE)])
    # In one order, whatever tasks ended first, so that reruns agree.
    y = seen.column("toxic").to_numpy()
    order = np.lexsort((*x.T, y))
    return ToxicityModel(costs, odds(np.ones(PARTS, bool)), *logistic(x[order], y[order]))


def score_toxicity(docs: DataFrame, model: ToxicityModel | None, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        decoder = Decoder(model.costs) if model else None
        for batch in batches:
            got = np.zeros(batch.num_rows)
            for first, last, data, offsets in text_slices(batch.column(2)) if model else ():
                row, place, words = features_of(*decoder.texts(data, offsets))
                got[first:last] = model.score(evidence(row, place, words, model.odds))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(got), pa.array((got >= threshold).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"]
            )

    given = docs.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "text")
    return given.mapInArrow(score, "doc_id bigint, held_out boolean, score double, predicted int")


def op7_noisy_channel_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document."""
    docs = table(spark, sf_dir, "documents")
    return score_toxicity(docs, fit_toxicity(docs, table(spark, sf_dir, "labels")))
