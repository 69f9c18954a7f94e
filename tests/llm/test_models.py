"""Classifiers by held-out accuracy; extraction, archives and the mix against plain versions."""

import gzip
import hashlib
import random
import re
import time
import tracemalloc
from collections import defaultdict

import duckdb
import numpy as np
import pyarrow.fs as fs
import pytest
from pyspark.sql import functions as F
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from tests.conftest import DATA
from tests.llm.test_texts import brute_classes, brute_removal
from tidemark.llm import extract, language, mixing, quality, toxicity, warc
from tidemark.llm.queries import QUERIES, SQL

FOLDER = str(DATA / "sf0.01")


def auc(truth, score):
    order = np.argsort(np.argsort(score)) + 1
    n = truth.sum()
    return (order[truth == 1].sum() - n * (n + 1) / 2) / (n * (len(truth) - n))


def held_out(spark, df, label):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").select("doc_id", label)
    rows = df.where("held_out").join(labels, "doc_id").collect()
    return np.array([r[label] for r in rows]), np.array([r.score for r in rows]), np.array([r.predicted for r in rows])


# --- language ---


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    got = QUERIES["op2_string_kernel_language"](spark, FOLDER)
    rows = got.join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert got.count() == docs.count() and len(rows) > 100
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_without_letters_or_labels(spark, make_docs):
    rng = random.Random(1)
    syllables = {"aa": ["ba", "lo", "mi"], "bb": ["xü", "ßt", "krö"]}
    rows = [(i, " ".join("".join(rng.choices(syllables[x], k=3)) for _ in range(30)), x) for i, x in enumerate(["aa", "bb"] * 30)]
    model = language.fit_language(make_docs(rows))
    odd = make_docs([(1, None), (2, ""), (3, "12 .. !!"), (4, "balomi lomiba"), (5, "ßtxü krökrö"), (None, "balomi"), (5, "ßtxü krökrö"), (6, "ba " * 50_000)])
    got = [(r.doc_id, r.lang_pred) for r in language.predict_language(odd, model).collect()]
    assert got == [(1, "und"), (2, "und"), (3, "und"), (4, "aa"), (5, "bb"), (None, "aa"), (5, "bb"), (6, "aa")]
    assert [r.doc_id for r in language.with_language(odd, model).collect()] == [4, 5, None, 5, 6]
    assert language.fit_language(make_docs([(1, "x")])) is None
    assert {r.lang_pred for r in language.predict_language(odd, None).collect()} == {"und"}


def test_the_predicted_language_goes_on(make_docs):
    rng = random.Random(1)
    syllables = {"aa": ["ba", "lo", "mi"], "bb": ["xü", "ßt", "krö"]}
    rows = [(i, " ".join("".join(rng.choices(syllables[x], k=3)) for _ in range(30)), x) for i, x in enumerate(["aa", "bb"] * 30)]
    model = language.fit_language(make_docs(rows))
    # The prediction goes on in ``lang``, whatever stood there, and without a model it stays.
    labelled = make_docs([(4, "balomi lomiba", None), (5, "ßtxü krökrö", "aa"), (6, None, "bb")])
    assert {r.doc_id: r.lang for r in language.with_language(labelled, model).collect()} == {4: "aa", 5: "bb"}
    assert {r.doc_id: r.lang for r in language.with_language(labelled, None).collect()} == {4: None, 5: "aa"}
    assert language.predict_language(make_docs([]), model).collect() == []


# --- quality ---


def test_quality_of_held_out_documents(spark):
    truth, score, predicted = held_out(spark, QUERIES["op6_fourier_quality"](spark, FOLDER), "quality")
    assert auc(truth, score) > 0.95 and (truth == predicted).mean() > 0.93
    assert ((score >= 0.3) == (predicted == 1)).all()


def test_quality_of_odd_tables(spark, make_docs):
    docs = make_docs([(1, None), (2, ""), (3, "x y z. " * 20_000), (3, "x"), (None, "a b")])
    stats = quality.document_stats(docs)
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (77, 1), (4, None), (None, 1)], "doc_id long, quality int")
    model = quality.fit_quality(stats, labels)
    got = quality.score_quality(stats, model).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
    assert quality.fit_quality(stats, labels.limit(0)) is None
    assert {r.score for r in quality.score_quality(stats, None).collect()} == {0.5}
    assert quality.score_quality(quality.document_stats(make_docs([])), model).collect() == []


@given(st.lists(st.tuples(st.integers(1, 9), st.integers(0, 9)), min_size=1, max_size=12))
@settings(max_examples=60, deadline=None)
def test_isotonic_rises_and_keeps_the_total(bins):
    n = np.array([b[0] for b in bins], float)
    p = np.minimum(np.array([b[1] for b in bins], float), n)
    at, rate = quality.isotonic(np.arange(len(bins), dtype=float), n, p)
    assert (np.diff(rate) > 0).all() and (np.diff(at) > 0).all()
    assert rate.min() >= 0 and rate.max() <= 1


# --- toxicity ---


@pytest.fixture(scope="module")
def toxic_model(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    return toxicity.fit_toxicity(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))


def test_toxicity_of_held_out_documents(spark, toxic_model):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    truth, score, predicted = held_out(spark, toxicity.score_toxicity(docs, toxic_model), "toxic")
    assert auc(truth, score) > 0.85 and (truth == predicted).mean() > 0.95


@pytest.mark.parametrize(
    "hidden, plain",
    [("1d10t", "idiot"), ("i d i o t", "idiot"), ("i.d.i.o.t", "idiot"), ("idiiiiot", "idiot"), ("$tupid", "stupid"), ("l0ser", "loser"), ("cl0wn", "clown"), ("p@thetic", "pathetic")],
)
def test_disguises_are_restored(toxic_model, hidden, plain):
    data = f"the {hidden} was".encode()
    got, _ = toxicity.Decoder(toxic_model.costs).texts(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
    assert bytes(got).decode() == f"the {plain} was"


def test_disguised_documents_score_like_plain_ones(make_docs, toxic_model):
    plain = "the in that idiot of was loser thon her moron ed pathetic and on the stupid with clown"
    hidden = "the in that 1d10t of was l0ser thon her m o r o n ed p@thetic and on the stuuuupid with cl0wn"
    clean = "the in that of was thon her ed and on the with"
    rows = [(1, plain), (2, hidden), (3, clean), (4, None), (5, ""), (6, clean * 5000), (None, plain), (1, plain), (7, "a " * 20_000)]
    got = [(r.doc_id, r.predicted) for r in toxicity.score_toxicity(make_docs(rows), toxic_model).collect()]
    assert got == [(1, 1), (2, 1), (3, 0), (4, 0), (5, 0), (6, 0), (None, 1), (1, 1), (7, 0)]


def test_toxicity_without_labels(spark, make_docs):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    docs = make_docs([(1, "a b"), (2, None)])
    assert toxicity.fit_toxicity(docs, labels) is None
    assert [r.score for r in toxicity.score_toxicity(docs, None).collect()] == [0.0, 0.0]
    assert toxicity.score_toxicity(make_docs([]), None).collect() == []


def test_character_counts_cover_every_text(make_docs):
    counts = toxicity.char_counts(make_docs([(i, "abc") for i in range(50)] + [(None, None)]))
    assert counts[1, 2, 3] == 50 and counts[0, 0, 1] == 50


@given(st.lists(st.text(alphabet="ab1$ .é!", max_size=14), min_size=1, max_size=5))
@settings(max_examples=60, deadline=None)
def test_restoring_keeps_rows_apart(texts):
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    decoder = toxicity.Decoder(toxicity.char_costs(np.zeros((28, 28, 28))))
    whole, moved = decoder.texts(np.frombuffer(b"".join(raw), np.uint8), offsets)
    for i, r in enumerate(raw):
        alone, _ = decoder.texts(np.frombuffer(r, np.uint8), np.array([0, len(r)]))
        assert bytes(whole[moved[i] : moved[i + 1]]) == bytes(alone)


# --- extraction ---


def page(body):
    return f"<!DOCTYPE html><html><head><title>T, t.</title><style>p{{}}</style></head><body>{body}</body></html>"


LONG = "A sentence with words, and more of them, to read. " * 4


@pytest.mark.parametrize(
    "html, text",
    [
        (None, ""),
        ("", ""),
        ("<p></p><script>x</script>", ""),
        ("bare text", "bare text"),
        (page(f"<nav><ul><li><a href=/>One</a></ul></nav><article><h1>Head</h1><p>{LONG}<p>Short.</article><footer>f</footer>"), f"Head {LONG}Short."),
        (page(f"<div class='cookie-notice'>We use cookies.</div><main><p>{LONG}</p><div class=ad>Buy</div><p>b &amp; c&#233;</p></main>"), f"{LONG}b & cé"),
        (page(f"<article><p>{LONG}</p></article><section id=comments><p>{LONG}</p></section><aside>side</aside>"), LONG.strip()),
        (page(f"<article><p>{LONG}<b>bo</b>ld\n\n x</p><form>Name <input></form></article>"), f"{LONG}bold x"),
        (page(f"<header><h1>Site</h1></header><article><header><h1>Title</h1></header><p>{LONG}</p></article>"), f"Title {LONG}".strip()),
        (page(f'<article><p title="a > b">{LONG}</p><!-- no --><script>var a="</p>";</script></article>'), LONG.strip()),
        (page(f"<article><p>{LONG}</p><ul><li>one<li>two</ul><table><tr><td>x<td>y</table></article>"), f"{LONG}one two x y"),
    ],
)
def test_main_text(html, text):
    assert extract.main_text(html) == text


MUCH = "".join(f"{LONG}{i}. " for i in range(12)).strip()
PARTS = MUCH.replace(". A ", ".|A ").split("|")
INTRO = "An introduction, with a few words, before the rest of it."


@pytest.mark.parametrize("outer", ["article", "main", "div"])
@pytest.mark.parametrize(
    "most",
    [
        "<ul>" + "".join(f"<li>{x}</li>" for x in PARTS) + "</ul>",
        "<table>" + "".join(f"<tr><td>{x}</td></tr>" for x in PARTS) + "</table>",
        "<section>" + "".join(f"<p>{x}</p>" for x in PARTS) + "</section>",
        "<div>" + "".join(f"<p>{x}</p>" for x in PARTS) + "</div>",
        "<blockquote>" + "".join(f"<p>{x}</p>" for x in PARTS) + "</blockquote>",
        f"<pre>{MUCH}</pre>",
    ],
)
def test_one_part_with_most_of_the_text(outer, most):
    html = page(f"<nav><a href=/>One</a></nav><{outer}><h1>T</h1><p>{INTRO}</p>{most}<p>{INTRO}</p></{outer}><footer>f</footer>")
    assert extract.main_text(html) == f"T {INTRO} {MUCH} {INTRO}"


def test_small_article_beside_a_large_one():
    html = page(f"<main><article><h2>One</h2><p>{LONG}</p></article><article><h2>Two</h2><p>{MUCH}</p></article></main>")
    assert extract.main_text(html) == f"One {LONG}Two {MUCH}"


MENU = "<nav><a href=/>Home</a></nav>"
BODY = f"<h1>Head</h1><p>{LONG}</p><p>{LONG}</p>"
READ = f"Head {LONG}{LONG}".strip()


@pytest.mark.parametrize("inner", [f"<article>{BODY}</article>", BODY])
@pytest.mark.parametrize("wrapper", ['class="overflow-hidden"', 'class="content has-sidebar"', 'id="page" class="no-sidebar"', 'class="comments-off ad-free"'])
def test_a_name_around_the_article_loses_nothing(wrapper, inner):
    assert extract.main_text(page(f"{MENU}<div {wrapper}>{inner}</div><footer>f</footer>")) == READ


@pytest.mark.parametrize("wrapper", ['id="search"', 'class="widget"', 'class="modal content"'])
@pytest.mark.parametrize("inner", [f"<main>{BODY}</main>", f"<article>{BODY}</article>", BODY])
def test_a_misleading_name_around_the_article_loses_nothing(wrapper, inner):
    assert extract.main_text(page(f"{MENU}<div {wrapper}>{inner}</div><p>Small print.</p>")).startswith(READ)


@pytest.mark.parametrize(
    "part, text",
    [
        ('<h2><a href="/s">A linked title</a></h2>', "A linked title"),
        ('<h2>Sources</h2><ul><li><a href="/1">One, a book</a></li><li><a href="/2">Two, a paper</a></li></ul>', "Sources One, a book Two, a paper"),
        (f'<section id="related-work"><h2>Related work</h2><p>{LONG}</p></section>', f"Related work {LONG}".strip()),
        (f'<div class="search-and-rescue"><p>{LONG}</p></div>', LONG.strip()),
        ('<div class="ad-slot"><p>Buy a thing, now.</p></div>', ""),
        ('<div class="cookie-banner">We use cookies.</div>', ""),
        ('<div class="post-comments"><p>A reader says so.</p></div>', ""),
        ('<ul class="share-buttons"><li>Share</li></ul>', ""),
    ],
)
def test_parts_inside_an_article(part, text):
    got = extract.main_text(page(f"{MENU}<article>{BODY}{part}<p>{LONG}</p></article>"))
    assert got == " ".join(x for x in (READ, text, LONG.strip()) if x)


def test_linked_title_of_a_page_without_an_article_element():
    html = page(f'{MENU}<div class="post"><h1><a href="/x">Head</a></h1><p>{LONG}</p><p>{LONG}</p></div>')
    assert extract.main_text(html) == READ


@pytest.mark.parametrize("remarks", [f"<p>{LONG}</p>" * 3, f"<article><p>{LONG}</p></article>" * 3])
def test_comments_longer_than_the_article_go(remarks):
    html = page(f'{MENU}<article>{BODY}</article><section class="comments">{remarks}</section>')
    assert extract.main_text(html) == READ
    html = page(f'{MENU}<div class="story">{BODY}</div><div id="comments">{remarks}</div>')
    assert extract.main_text(html) == READ


def test_every_page_gives_its_article(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    got = QUERIES["op4_tag_path_ratio"](spark, FOLDER).collect()
    assert len(got) == len(pages)
    import html as entities

    for r in got:
        inner = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.DOTALL)[1]
        assert r.text == " ".join(entities.unescape(re.sub(r"</?b>", "", re.sub(r"<(?!/?b>)[^>]*>", " ", inner))).split())
        assert r.n_chars == len(r.text)


@given(st.text(alphabet="<>/abp \"'=!-&;divsclas", max_size=80))
@settings(max_examples=150, deadline=None)
def test_any_markup_is_read(html):
    assert isinstance(extract.main_text(html), str)


# --- archives ---


def test_archives(spark, folder, tmp_path):
    big, other = "<p>é" * 400, "x" * 1000
    rows = [(1, "u", big), (2, "u\r\nv", big), (3, None, None), (4, "", ""), (5, "u", "s" * 999), (6, "u", "s" * 999), (7, "u", other), (9, "u", big), (7, "u", other), (None, "u", other)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as payload_bytes")
    whole, single = f"{tmp_path}/whole", f"{tmp_path}/single"
    warc.write_archives(pages, whole)
    index = warc.normalise(spark, whole, single)
    got = sorted((r.page_id or 0, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.read_records(index, single).collect())
    first = {big: 9, other: 7}
    expected = []
    for i, _, html in rows:
        raw = (html or "").encode()
        to = first.get(html) if first.get(html) != i else None
        expected.append((i or 0, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if to else "response", to))
    assert got == sorted(expected)
    # Each archive is still one gzip file, and its records are those of the stream.
    originals = sorted(gzip.decompress(p.read_bytes()) for p in (tmp_path / "whole").glob("*.gz"))
    assert sorted(gzip.decompress(p.read_bytes()) for p in (tmp_path / "single/archives").glob("*.gz")) == originals
    assert not [p for p in (tmp_path / "single/archives").iterdir() if p.name.startswith(".")]
    empty = f"{tmp_path}/none"
    warc.write_archives(pages.limit(0), f"{empty}/whole")
    assert warc.read_records(warc.normalise(spark, f"{empty}/whole", empty), empty).collect() == []


def test_split_records_in_any_pieces():
    records = [b"WARC/1.1\r\nContent-Length: %d\r\n\r\n" % n + b"\r\n\r\n"[: n % 5] + b"x" * (n - min(n, n % 5)) + b"\r\n\r\n" for n in (0, 3, 4, 700)]
    data = b"".join(records)
    for size in (1, 7, 64, 5000):
        assert list(warc.split_records(data[i : i + size] for i in range(0, len(data), size))) == records
    with pytest.raises(ValueError):
        list(warc.split_records(iter([data[:-1]])))


# --- mix ---


def brute_targets(sizes):
    """Water filling, round by round."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, target, open_ = float(sum(sizes.values())), {}, [s for s in names if sizes[s]]
    target = {s: 0.0 for s in names}
    while open_:
        left = total - sum(target.values())
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        full = [s for s in open_ if share[s] > 3 * sizes[s]]
        if not full:
            target.update(share)
            break
        for s in full:
            target[s] = 3.0 * sizes[s]
            open_.remove(s)
    return target


def check_mix(rows, got):
    assert len(got) == len(rows)
    sizes, taken = defaultdict(int), defaultdict(int)
    for _, text, _, source in rows:
        sizes[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    target = brute_targets(sizes)
    largest = defaultdict(int)
    for r in got:
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source])
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.copies * r.size
    for s in sizes:
        assert abs(taken[s] - target[s]) <= max(largest[s], 0.01 * target[s])
    return sizes, taken, target


def test_mix(make_docs):
    rng = random.Random(3)
    rows = [(i, "w " * rng.choice([1, 2, 5, 30, 31, 300]), None, rng.choice(["a", "a", "a", "B", "é", None, "c", ""])) for i in range(900)]
    rows += [(1000, None, None, "a"), (1001, " \t\n", None, "empty"), (1002, "x y z\x1cq", None, "c"), (1, "again it", None, "a"), (None, "no id", None, "B")]
    df = mixing.mix_sources(make_docs(rows))
    got = df.collect()
    sizes, taken, target = check_mix(rows, got)
    for s in sizes:
        assert abs(taken[s] - target[s]) <= 0.02 * target[s] + 3
    assert sorted(map(str, mixing.mix_sources(make_docs(rows[::-1])).collect())) == sorted(map(str, got))
    assert not re.search("Python|Arrow|Pandas", df._jdf.queryExecution().toString())
    assert mixing.mix_sources(make_docs([])).collect() == []


def solved_by_numpy(sizes, target):
    """Rates min(3, exp(lam * size)) that add up to the target, by bisection."""
    low, high = -50.0, 50.0
    for _ in range(300):
        lam = (low + high) / 2
        rates = np.minimum(3.0, np.exp(np.minimum(lam * sizes, 5.0)))
        low, high = (lam, high) if (rates * sizes).sum() < target else (low, lam)
    return rates


def test_rates_solve_the_dual(spark, make_docs):
    rng = random.Random(11)
    rows = [(i, "w " * int(rng.lognormvariate(3, 1.2) + 1), None, rng.choice("aaaaabbcd")) for i in range(700)]
    got = defaultdict(list)
    for r in mixing.mix_sources(make_docs(rows)).collect():
        got[r.source].append((r.size, r.rate, r.target))
    tilted = 0
    for source, held in got.items():
        sizes, rates, target = (np.array(x, float) for x in zip(*held))
        if target[0] >= 3 * sizes.sum():
            assert (rates == 3).all()
            continue
        assert (rates * sizes).sum() == pytest.approx(target[0], rel=1e-6)
        assert rates == pytest.approx(solved_by_numpy(sizes, target[0]), rel=1e-6)
        # The tilt differs by document, always the same way.
        order = np.argsort(sizes)
        steps = np.diff(rates[order])
        assert (steps >= 0).all() or (steps <= 0).all()
        tilted += rates.max() - rates.min() > 0.01
    assert tilted >= 2


def test_reruns_of_repeated_and_missing_ids_agree(spark, make_docs):
    rng = random.Random(6)
    texts = ["w " * rng.randint(1, 40) + str(i % 9) for i in range(600)]
    rows = [(rng.choice([None, 1, 2, 3, i // 40]), t, None, rng.choice(["a", "a", "b"])) for i, t in enumerate(texts)]
    runs = []
    for n in (1, 3, 7):
        docs = make_docs(rows).repartition(n, "n_chars") if n > 1 else make_docs(rows).coalesce(1)
        got = mixing.mix_sources(docs.orderBy(F.rand(n)) if n > 1 else docs)
        runs.append(sorted(map(str, got.collect())))
    assert runs[0] == runs[1] == runs[2]


# --- pipeline and registration ---


def test_pipeline_stages(spark, make_docs, folder):
    """Each stage against its plain version, on documents with planted cases."""
    given_docs = duckdb.sql(f"SELECT doc_id, text, lang, source FROM '{FOLDER}/documents.parquet' WHERE doc_id % 9 = 0 ORDER BY 1").fetchall()
    rng = random.Random(1)
    items = [(i, " ".join(rng.choices(given_docs[i][1].split(), k=40))) for i in range(3)]
    odd = [(100_000, None, None, "x"), (100_001, "?? 12", None, "x"), (100_002, given_docs[0][1], None, "x"), (100_003, given_docs[5][1] + " " + items[0][1], "en", "x")]
    odd += [(100_004, "привет мир это другой язык " * 9, None, "x"), (100_005, "".join(rng.choices("ABCDefgh0123+/xyzQWRTP", k=600)), None, "x")]
    path = folder(documents=make_docs(given_docs + odd, extra=False), benchmark=spark.createDataFrame(items, "item_id long, text string"))
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language", "near_dedup", "suffix_dedup", "decontaminate", "mix"]
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns, before = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, path).cache()
        rows = docs.collect()
        if name == "mix":
            check_mix([(None, t, None, s) for t, s in last], rows)
            assert {r.doc_id for r in rows} == set(before)
            continue
        assert docs.columns == columns
        after = {r.doc_id: r.text for r in rows}
        if name == "language":
            assert set(before) - set(after) == {100_000, 100_001, 100_004, 100_005}
        elif name == "near_dedup":
            classes = brute_classes(list(before.items()))
            assert set(after) == set(classes.values())
        elif name == "suffix_dedup":
            kept = brute_removal(list(before.items()))
            assert set(after) == set(before)
            assert all(len(after[i].encode()) == kept[i][0] - kept[i][1] for i in after if kept[i][1] == 0)
            assert all(len(after[i].encode()) <= kept[i][0] - kept[i][1] for i in after)
        else:
            assert set(before) - set(after) == {100_003}
        before, last = after, [(r.text, r.source) for r in rows]


def test_near_dedup_of_missing_and_shared_ids(spark, make_docs):
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefg", k=5)) for _ in range(300)]
    a, b, c, d = (" ".join(rng.choices(words, k=60)) for _ in range(4))
    near_a = a + " tail"
    rows = [(None, a), (None, near_a), (None, b), (7, b), (5, c), (5, d), (5, d), (9, a), (None, None), (11, "")]
    docs = make_docs(rows, extra=False)
    got = corpus_pipeline.near_dedup(spark, docs, "")
    assert got.columns == docs.columns
    # a stays under 9 and b under 7, though others have no id; c and d share an id and both stay.
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=repr) == sorted([(9, a), (7, b), (5, c), (5, d), (11, "")], key=repr)


def test_pipeline_runs_on_empty_tables(spark, make_docs, folder):
    path = folder(documents=make_docs([], extra=False), benchmark=spark.createDataFrame([], "item_id long, text string"))
    assert corpus_pipeline.run(spark, path).collect() == []
    some = folder(documents=make_docs([(1, "a text in no language that is known"), (2, None)], extra=False), benchmark=spark.createDataFrame([], "item_id long, text string"))
    assert [r.doc_id for r in corpus_pipeline.run(spark, some).collect()] == [1]


def test_many_short_texts_take_little_memory():
    import pyarrow as pa

    model = language.LanguageModel(("a", "b"), np.ones((4, sum(language.PLACES)), np.float32), np.ones((4, 2), np.float32))
    column = pa.array(["ab"] * 10_000)
    tracemalloc.start()
    for _, _, data, offsets in language.text_slices(column, rows=language.SLICE_ROWS):
        model.scores(data, offsets)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 150e6


def test_long_spans_are_restored_in_linear_time():
    costs = toxicity.char_costs(np.ones((toxicity.CLASSES,) * 3))

    def seconds(n):
        start = time.perf_counter()
        assert len(toxicity.restore("a1b2c3d4" * (n // 8), costs)) > n // 4
        return time.perf_counter() - start

    short, long = min(seconds(10_000) for _ in range(3)), min(seconds(80_000) for _ in range(2))
    assert long < 16 * short + 0.2


def test_registered_queries():
    assert sorted(QUERIES, key=lambda n: int(re.match(r"op(\d+)_", n)[1])) == list(QUERIES)
    assert len(QUERIES) == 13


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    df = QUERIES[name](spark, FOLDER)
    result = con.execute(SQL[name])
    assert df.columns == [d[0] for d in result.description]
    assert sorted(map(tuple, df.collect()), key=repr) == sorted(result.fetchall(), key=repr)


def test_file_system_takes_both_kinds_of_path(tmp_path):
    for path in (str(tmp_path), f"file://{tmp_path}"):
        assert fs.FileSystem.from_uri(path)[1] == str(tmp_path)
