"""Kernels, fits, decoders and sketches against versions that are written out plainly."""

import itertools
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import fingerprints, language, quality, toxicity
from tidemark.llm.common import mix, text_slices

LETTERS = "abcdeé 1."


def one_slice(texts):
    ((_, _, data, offsets),) = text_slices(pa.array(texts))
    return data, offsets


def grams_of(text):
    """The places of the 1- to 3-grams of a text's bytes."""
    folded = [c if 97 <= c <= 122 else c if c >= 128 else 32 for c in text.lower().encode()]
    out = set()
    for k, places in enumerate(language.PLACES, 1):
        for i in range(len(folded) - k + 1):
            code = 0
            for c in folded[i : i + k]:
                code = code << 8 | c
            place = code if k == 1 else int(mix(np.array([code + (k << 40)], np.uint64))[0] % np.uint64(places))
            out.add((k, place))
    return out


def test_kernel_is_that_of_the_sets():
    rng = random.Random(1)
    texts = ["".join(rng.choices(LETTERS, k=rng.randint(1, 30))) for _ in range(25)]
    got = language.presence(*one_slice(texts))
    kernel = got @ got.T
    sets = [grams_of(t) for t in texts]
    for i, j in itertools.product(range(len(texts)), repeat=2):
        assert kernel[i, j] == pytest.approx(len(sets[i] & sets[j]) / math.sqrt(len(sets[i]) * len(sets[j])), abs=1e-5)


def test_ridge_on_landmarks_is_plain_kernel_ridge(make_docs):
    # With every text a landmark, the Nystroem map loses nothing.
    rng = random.Random(4)
    words = {"aa": ["abra", "cada", "bra"], "bb": ["eded", "cede", "dece"]}
    rows = [(i, " ".join(rng.choices(words[x], k=4)) + f" {chr(97 + i % 7)}", x) for i, x in enumerate(["aa", "bb"] * 30)]
    model = language.fit_language(make_docs(rows))
    train = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5]
    assert len(model.landmarks) == len(train)
    p = language.presence(*one_slice([r[1] for r in train])).astype(float)
    y = np.array([[1.0 if r[2] == x else -1.0 for x in model.langs] for r in train])
    alpha = np.linalg.solve(p @ p.T + language.RIDGE * len(train) * np.eye(len(train)), y)
    every = one_slice([r[1] for r in rows])
    plain = language.presence(*every).astype(float) @ p.T @ alpha
    assert model.scores(*every) == pytest.approx(plain, abs=2e-2)
    assert (model.scores(*every).argmax(1) == plain.argmax(1)).all()


def test_fourier_features_approximate_the_gaussian_kernel():
    rng = np.random.default_rng(3)
    width, many = len(quality.STATS), 20_000
    waves = rng.normal(size=(width, many)) / np.sqrt(width)
    model = quality.QualityModel(np.zeros(width), np.ones(width), waves, rng.uniform(0, 2 * np.pi, many), np.zeros(many + 1), np.zeros(1), np.zeros(1))
    x = rng.normal(size=(12, width))
    z = model.features(x)[:, :-1]
    for i, j in itertools.product(range(12), repeat=2):
        assert z[i] @ z[j] == pytest.approx(np.exp(-((x[i] - x[j]) ** 2).sum() / (2 * width)), abs=0.04)


def test_normal_equations_are_those_of_one_matrix(spark, make_docs):
    rng = random.Random(2)
    good = lambda: " ".join(rng.choices(["the", "river", "ran", "slowly", "home"], k=rng.randint(20, 60))) + "."
    bad = lambda: "BUY!!! " * rng.randint(5, 30) + "$$$ 999"
    rows = [(i, good() if i % 2 else bad()) for i in range(200)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(200)], "doc_id long, quality int, toxic int")
    stats = quality.document_stats(make_docs(rows).repartition(7))
    model = quality.fit_quality(stats, labels)
    held = {r.doc_id: (r.held_out, r.x) for r in stats.collect()}
    x = np.array([held[i][1] for i, _ in rows if not held[i][0]])
    y = np.array([float(i % 2) for i, _ in rows if not held[i][0]])
    assert model.mean == pytest.approx(x.mean(0)) and model.scale == pytest.approx(np.where(x.std(0) < 1e-6, 1, x.std(0)), abs=1e-6)
    z = model.features(x)
    # The fit solves its own normal equations over all rows: the ridge gradient is zero but for the penalty.
    gradient = z.T @ (z @ model.weights - y)
    assert np.abs(gradient).max() <= 2 * quality.RIDGE * len(y) * max(1.0, np.abs(model.weights).max())


def test_isotonic_is_the_best_rising_fit():
    rng = np.random.default_rng(5)
    total, positive = rng.integers(1, 9, 12), np.zeros(12)
    positive = np.array([rng.integers(0, n + 1) for n in total], float)
    at, rate = quality.isotonic(np.arange(12.0), total.astype(float), positive)
    assert (np.diff(rate) >= 0).all()
    # Max-min formula of isotonic regression.
    share = lambda a, b: positive[a : b + 1].sum() / total[a : b + 1].sum()
    plain = [max(min(share(a, b) for b in range(i, 12)) for a in range(i + 1)) for i in range(12)]
    assert sorted(set(np.round(plain, 9))) == sorted(set(np.round(rate, 9)))


def plain_restore(span, costs):
    """All ways through the lattice: the cheapest restored text."""
    place = toxicity._place
    best = (math.inf, "")

    def options(i, before):
        c = span[i]
        if c in toxicity.LOOKS_LIKE:
            return [(x, toxicity.LOOK_COST) for x in toxicity.LOOKS_LIKE[c]] + [("", toxicity.REPEAT_COST if c == before else toxicity.NOISE_COST)]
        if c.isalpha():
            return [(c, 0.0)] + ([("", toxicity.REPEAT_COST)] if c == before else [])
        return [("", toxicity.SEPARATOR_COST if c in toxicity.SEPARATORS else toxicity.NOISE_COST)]

    befores, before = [], ""
    for c in span:
        befores.append(before)
        if c.isalpha() or c in toxicity.LOOKS_LIKE:
            before = c
    for path in itertools.product(*[options(i, befores[i]) for i in range(len(span))]):
        cost, a, b, text = 0.0, "", "", ""
        for x, more in path:
            cost += more
            if x:
                cost += costs[place(a) if a else 0, place(b) if b else 0, place(x)]
                a, b, text = b, x, text + x
        cost += costs[place(a) if a else 0, place(b) if b else 0, 0]
        if cost < best[0] - 1e-12:
            best = (cost, text)
    return best[1]


def test_viterbi_finds_the_cheapest_path():
    rng = random.Random(6)
    counts = np.random.default_rng(1).integers(0, 30, (toxicity.CLASSES,) * 3).astype(float)
    costs = toxicity.char_costs(counts)
    alphabet = "abcde" + "".join(toxicity.LOOKS_LIKE)[:6] + ".- é"
    for _ in range(150):
        span = "".join(rng.choices(alphabet, k=rng.randint(1, 7)))
        assert toxicity.restore(span, costs) == plain_restore(span, costs)


def test_likeness_is_that_of_the_kept_hashes(spark):
    rng = random.Random(7)
    words = ["".join(rng.choices("abcdef", k=4)) for _ in range(60)]
    texts = [" ".join(rng.choices(words, k=n)) for n in (0, 3, 5, 9, 200, 200, 900)]
    texts += [" ".join(texts[4].split()[:150] + texts[5].split()[:60])]
    df = spark.createDataFrame([(a, b) for a in texts for b in texts], "a string, b string")
    shingle = lambda c: F.when(F.size(F.split(c, " ")) > 0, F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(F.split(c, " ")) - 4, F.lit(1))), lambda i: F.xxhash64(F.slice(F.split(c, " "), i, 5))))
    sketches = [fingerprints.sketch_of(df[c]) for c in "ab"]
    rows = df.select("a", "b", fingerprints.likeness(*sketches).alias("l"), fingerprints.containment(*sketches).alias("c"), *[shingle(df[c]).alias(f"h{c}") for c in "ab"]).collect()
    limit = -(1 << 63) + (1 << 64) // fingerprints.ONE_IN

    def kept(text, hashes):
        if not text:
            return set()
        return {h for h in hashes if h < limit} or {min(hashes)}

    for r in rows:
        a, b = kept(r.a, r.ha), kept(r.b, r.hb)
        assert r.l == pytest.approx(len(a & b) / len(a | b) if a | b else 1.0)
        assert r.c == (pytest.approx(len(a & b) / len(a)) if a else None)
