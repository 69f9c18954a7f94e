"""Language identification with a blended-spectrum string kernel.

A text is the set of its byte n-grams of length 1, 2 and 3, over lower-case letters with
everything else turned into a blank; longer n-grams are hashed into a fixed number of places.
The kernel of two texts is the number of n-grams in both over the root of the product of
their numbers. Landmarks, a sample of the training texts, give the Nystroem map of that
kernel; kernel ridge regression, one language against the rest, is solved on it. Scoring is
a product of presence matrix and landmarks, and another with the weights, batch by batch.

The classifier learns from at most about ``SAMPLE_PER_LANG`` texts of each language outside
fold 0. Every text is predicted from all of its bytes.

Cases. Null text or no letter: ``und`` with score 0. No labelled row: all ``und``. Very long
texts: sliced by bytes and number of whole rows, so memory grows only with the longest text. Ties go to
the language first in order. Repeated rows: each is predicted. Extra columns: ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import fold, label_sample, lower_bytes, mix, sums_by_row, table, text_slices

SAMPLE_PER_LANG = 600
LANDMARKS = 192
RIDGE = 1e-3
PLACES = (256, 2048, 8192)
#: Texts that are worked on at a time, at most: each takes a row of ``sum(PLACES)`` numbers.
SLICE_ROWS = 256
#: A text with a smaller part of its n-grams in the landmarks is in no known language. On the given
#: documents no text has less than 0.85; other scripts, random letters, hex and base64 stay below 0.68.
LEAST_FAMILIAR = 0.7
#: Of so many landmarks one must have an n-gram, so that a few odd ones make nothing familiar.
KNOWN_IN = 64
LETTER = re.compile(r"[^\W\d_]")

_FOLD = np.full(256, 32, np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def presence(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row for each text: which n-grams it has, scaled to length 1."""
    rows, n = len(offsets) - 1, len(data)
    letters = _FOLD[lower_bytes(data)].astype(np.uint32)
    owner = np.repeat(np.arange(rows, dtype=np.int64), np.diff(offsets))
    out = np.zeros((rows, sum(PLACES)), np.float32)
    flat, width, shift = out.reshape(-1), sum(PLACES), 0
    code = np.zeros(n, np.uint64)
    for k, places in enumerate(PLACES, 1):
        code[: n - k + 1] = (code[: n - k + 1] << np.uint64(8)) | letters[k - 1 :]
        if n >= k:
            inside = owner[: n - k + 1] == owner[k - 1 :]
            gram = code[: n - k + 1]
            place = gram if k == 1 else mix(gram + np.uint64(k << 40)) % np.uint64(places)
            flat[(owner[: n - k + 1] * width + shift + place.astype(np.int64))[inside]] = 1
        shift += places
    norm = np.sqrt(out.sum(axis=1, keepdims=True))
    return out / np.maximum(norm, 1)


def has_letter(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether each text has a letter; texts with an ASCII letter are not searched further."""
    low = lower_bytes(data)
    has = sums_by_row((low >= 97) & (low <= 122), offsets) > 0
    for i in np.flatnonzero(~has):
        has[i] = bool(LETTER.search(bytes(data[offsets[i] : offsets[i + 1]]).decode("utf-8", "ignore")))
    return has


@dataclass(frozen=True)
class LanguageModel:
    langs: tuple[str, ...]
    landmarks: np.ndarray
    weights: np.ndarray

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """-1 to 1, about, for each text and language."""
        return (presence(data, offsets) @ self.landmarks.T) @ self.weights

    def familiar(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The part of each text's n-grams that stand in one of ``KNOWN_IN`` landmarks.

        The kernel of the text with itself but for what the landmarks lack: it falls for texts
        unlike all of them, which the scores do not, and does not depend on length.
        """
        known = (self.landmarks > 0).sum(axis=0) >= max(1, len(self.landmarks) // KNOWN_IN)
        return presence(data, offsets) ** 2 @ known.astype(np.float32)


def fit_language(docs: DataFrame, per_lang: int = SAMPLE_PER_LANG, landmarks: int = LANDMARKS, ridge: float = RIDGE) -> LanguageModel | None:
    """Learns from text and lang of the rows outside fold 0; None without such rows."""
    labelled = docs.select("doc_id", "text", "lang").where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold(F.col("doc_id")) != 0))
    sample = label_sample(labelled, "lang", per_lang).orderBy(F.xxhash64("doc_id"), "doc_id").toArrow()
    if sample.num_rows == 0:
        return None
    column = sample.column("text").combine_chunks()
    column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    names = sample.column("lang").to_pylist()
    langs = tuple(sorted(set(names)))
    y = np.where(np.array(names)[:, None] == np.array(langs)[None, :], 1.0, -1.0)
    # Landmarks take turns through the languages, so that a rare one has its share.
    place = {name: 0 for name in langs}
    turn = []
    for name in names:
        turn.append(place[name])
        place[name] += 1
    chosen = column.take(pa.array(np.argsort(turn, kind="stable")[:landmarks]))
    marks = np.concatenate([presence(data, offsets) for _, _, data, offsets in text_slices(chosen, rows=SLICE_ROWS)])
    values, vectors = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    good = values > 1e-6 * values[-1]
    root = vectors[:, good] / np.sqrt(values[good])
    # Slice by slice: the driver holds the landmarks, never the presence of the whole sample.
    kernel = np.concatenate([presence(data, offsets) @ marks.T for _, _, data, offsets in text_slices(column, rows=SLICE_ROWS)])
    phi = kernel.astype(np.float64) @ root
    solved = np.linalg.solve(phi.T @ phi + ridge * len(y) * np.eye(phi.shape[1]), phi.T @ y)
    return LanguageModel(langs, marks.astype(np.float32), (root @ solved).astype(np.float32))


def predict_language(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score; one row for each row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            column = batch.column(batch.schema.get_field_index("text"))
            names = np.full(len(column), "und", object)
            score = np.zeros(len(column))
            for first, last, data, offsets in text_slices(column, rows=SLICE_ROWS) if model else ():
                out = model.scores(data, offsets)
                has = has_letter(data, offsets)
                best = out.argmax(axis=1)
                names[first:last] = np.where(has, np.array(model.langs, object)[best], "und")
                score[first:last] = np.where(has, np.clip((out.max(axis=1) + 1) / 2, 0, 1), 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(score)], ["doc_id", "held_out", "lang_pred", "score"]
            )

    given = docs.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "text")
    return given.mapInArrow(predict, "doc_id bigint, held_out boolean, lang_pred string, score double")


def with_language(docs: DataFrame, model: LanguageModel | None, least: float = LEAST_FAMILIAR) -> DataFrame:
    """The rows of ``docs``, with all their columns, that are in a known language; ``lang`` is the predicted one.

    Texts without a letter go, and those of which less than ``least`` is ``familiar``: texts in
    another script, random letters, encoded bytes. Without a model only the letters count, and
    ``lang`` stays as given.
    """
    place = docs.columns.index("text")
    lang_at = docs.columns.index("lang") if "lang" in docs.columns else None
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            good = np.zeros(batch.num_rows, bool)
            names = np.full(batch.num_rows, "und", object)
            for first, last, data, offsets in text_slices(batch.column(place), rows=SLICE_ROWS):
                known = has_letter(data, offsets)
                if model:
                    known &= model.familiar(data, offsets) >= least
                    names[first:last] = np.array(model.langs, object)[model.scores(data, offsets).argmax(axis=1)]
                good[first:last] = known
            if model and lang_at is not None:
                batch = batch.set_column(lang_at, "lang", pa.array(names, batch.column(lang_at).type))
            yield batch.filter(pa.array(good))

    return docs.mapInArrow(keep, docs.schema)


def op2_string_kernel_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document."""
    docs = table(spark, sf_dir, "documents")
    return predict_language(docs, fit_language(docs))
