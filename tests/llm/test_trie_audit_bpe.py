"""The prefix trie, the source audit and BPE against brute force and the tokenizers library."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import bpe, divergence, trie

# --- trie ---

TURNS = "conv_id bigint, turn bigint, role string, text string, depth int, key string, part int, own string"


def trie_brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]
            own[c].append((turn is not None, turn or 0, digest, role, text))
    own = {c: [(r, x) for *_, r, x in sorted(turns)] for c, turns in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = int(np.fix(c / 5)) * 5
        whole[c] = own.get(base, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children, out = defaultdict(int), []
    for node in members:
        if node:
            children[node[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, held in members.items():
        own_saved = (len(held) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += own_saved
            leaves[node[:d]] += not children[node]
    for node, held in members.items():
        ends = ",".join(str(c) for c in sorted(held) if len(whole[c]) == len(node))
        up = min(members[node[:-1]]) if node else None
        out.append((min(held), len(node), up, len(held), children[node], leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def trie_rows(df):
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted([tuple(r) for r in df.select(*names).collect()], key=repr)


def conversations(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2, "y") for r in rows], TURNS)


@pytest.mark.parametrize("seed", range(3))
def test_trie_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-40, 400), 150):
        common = rng.random() < 0.4
        for turn in range(rng.randint(1, 12)):
            text = f"turn {turn}" if common else rng.choice(["é", "a b", "c", "", None])
            rows.append((c, rng.choice([turn, turn, None]), rng.choice(["user", "user", None]), text))
    rows += rows[:30] + [(None, 0, "user", "lost")]
    for c in range(1000, 1060):
        rows += [(c, t, "user", f"same {t}") for t in range(4)]
    rng.shuffle(rows)
    assert trie_rows(trie.prefix_trie(trie.rebuilt(conversations(spark, rows)))) == trie_brute(rows)


def test_trie_in_many_parts(spark):
    # Parts of a few bytes: nearly every prefix goes over a border.
    rng = random.Random(9)
    rows = [(c, t, "u", rng.choice("ab")) for c in range(300) for t in range(rng.randint(9, 14))]
    got = trie.prefix_trie(trie.rebuilt(conversations(spark, rows)), part_bytes=500)
    assert trie_rows(got) == trie_brute(rows)


def test_trie_of_turnless_and_no_conversations(spark):
    none = conversations(spark, [])
    assert trie.prefix_trie(trie.rebuilt(none)).collect() == []
    # Conversation 1 takes its first turns from 0, which is not there.
    c = next(i for i in range(1, 100) if i % 5 and zlib.crc32(str(i).encode()) % 9 >= 3)
    rows = [(c, t, "u", "x") for t in range(2)]
    got = trie_rows(trie.prefix_trie(trie.rebuilt(conversations(spark, rows))))
    assert got == trie_brute(rows) and len(got) == 1 and got[0][1:6] == (0, None, 1, 0, 1)


def test_forest_of_every_cut(spark):
    # Partial sums of open nodes add up to the nodes of the whole, wherever the rows are cut.
    rng = random.Random(3)
    keys = sorted({b"".join(rng.choice([b"a" * 16, b"b" * 16]) for _ in range(rng.randint(0, 6))) for _ in range(40)})
    rows = [{"key": k, "sizes": [k[16 * i] for i in range(len(k) // 16)], "n": i % 3 + 1, "least": 100 - i, "ends": str(i)} for i, k in enumerate(keys)]

    def nodes(cuts):
        sums = defaultdict(lambda: [10**9, 0, 0, 0, 0, None])
        edges = [0, *cuts, len(rows)]
        for a, b in zip(edges, edges[1:]):
            before, after = keys[a - 1] if a else None, keys[b] if b < len(keys) else None
            for batch in trie.forest(rows[a:b], before, after):
                for r in batch.to_pylist():
                    name = r["node"] or (r["conv_id"], r["depth"])
                    s = sums[name, r["depth"]]
                    s[0] = min(s[0], r["conv_id"])
                    for i, c in enumerate(("n_convs", "n_children", "n_leaves", "saved_tokens"), 1):
                        s[i] += r[c]
                    s[5] = s[5] or r["ends"]
        return sorted(((d, *s) for (_, d), s in sums.items()), key=repr)

    whole = nodes([])
    for cut in range(1, len(rows)):
        assert nodes([cut]) == whole
    assert nodes(range(1, len(rows))) == whole


# --- audit ---

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def audit_brute(rows, least=3, top=200):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    groups, docs = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source in rows:
        found = TERM.findall((text or "").translate(lower))
        groups[lang or "", source or ""].update(found)
        docs[lang or ""].update(set(found))
    out = []
    for lang in {g for g, _ in groups}:
        kept = sorted(t for t, n in docs[lang].items() if n >= least)
        sources = [s for g, s in groups if g == lang]

        def shares(counts):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 1) // (total + len(kept)) for t in kept}

        own = {s: shares(groups[lang, s]) for s in sources}
        whole = shares(sum((groups[lang, s] for s in sources), Counter()))
        far = lambda p, q: (p - q) ** 2 // q
        for s in sources:
            pairs = [(sum(far(own[s][t], own[o][t]) for t in kept), o) for o in sources if o != s]
            marks = [(far(own[s][t], whole[t]), t) for t in kept if groups[lang, s][t] and own[s][t] > whole[t]]
            for part, items, most in (("pair", pairs, len(pairs)), ("term", marks, top)):
                ordered = sorted(items, key=lambda x: (-x[0], x[1].encode()))[:most]
                out += [(lang, s, part, item, value, rank) for rank, (value, item) in enumerate(ordered, 1)]
    return sorted(out)


AUDIT = ["lang", "source", "part", "item", "value", "rank"]


@pytest.mark.parametrize("blocks", [(128, 2048), (2, 7)])
def test_audit_equals_brute_force(spark, make_docs, blocks):
    rng = random.Random(2)
    words = ["".join(rng.choices("abÉé日xyZ", k=rng.randint(1, 4))) for _ in range(80)]
    rows = [
        (i, " ".join(rng.choices(words[: rng.choice([5, 80])], k=rng.randint(0, 60))) + rng.choice([" 12_a-b", ""]), rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "é", None, "s5"]))
        for i in range(120)
    ]
    rows += [(500, None, "fr", "a"), (501, "one two", "fr", "b"), (502, "", "en", "only"), (None, "a b " * 50, "en", "s1"), (503, "a b", "xx", "alone")]
    got = divergence.source_audit(make_docs(rows), source_block=blocks[0], term_block=blocks[1], top=5)
    assert sorted(tuple(r) for r in got.select(*AUDIT).collect()) == audit_brute(rows, top=5)


def test_audit_of_no_documents(spark, make_docs):
    assert divergence.source_audit(make_docs([])).collect() == []


def test_counts_are_handed_out_in_parts(spark, make_docs, monkeypatch):
    rows = [(i, f"w{i} common x y" + "Z" * i, "en", "s") for i in range(50)]
    whole = sorted(divergence.term_counts(make_docs(rows)).collect(), key=repr)
    batches = [r for b in divergence._count(iter([])) for r in b.to_pylist()]
    assert batches == [] and len(whole) == 1 + 3 + 50  # the group; w, common, x; y with each number of Z
    monkeypatch.setattr(divergence, "SLICE", 3)
    assert divergence.terms_of("ab cd ab abcdefgh, AB9ab") == Counter({b"ab": 4, b"cd": 1, b"abcdefgh": 1})


def test_shares_of_very_large_counts(spark):
    n = 10**15
    row = spark.sql(f"select {n}L as n, {3 * n}L as total, 7L as terms").select(divergence._share(F.col("n"), F.col("total"), F.col("terms")).alias("p")).first()
    assert row.p == 1 + 10**9 * (n + 1) // (3 * n + 7)


# --- bpe ---

FILE = "/opt/tokenizers/word_bpe_49k.json"
needs_file = pytest.mark.skipif(not Path(FILE).exists(), reason="the public tokenizer files are not here")


@pytest.fixture(scope="module")
def library():
    tokenizers = pytest.importorskip("tokenizers")
    return tokenizers.Tokenizer.from_file(FILE)


@pytest.fixture(scope="module")
def own():
    return bpe.Tokenizer(Path(FILE).read_text(encoding="utf-8"))


@needs_file
def test_words_of_every_kind_of_character(own, library):
    codes = [*range(0x600), *range(0x1E00, 0x2200), *range(0x3000, 0x3100), *range(0xFE00, 0xFFFE), *range(0x1F300, 0x1F400)]
    for code in codes:
        text = f"A{chr(code)}b 1{chr(code)}{chr(code)}.C"
        assert [i for p in own.pieces(text) for i in own.merge(p)] == library.encode(text, add_special_tokens=False).ids, hex(code)


@needs_file
def test_random_texts(own, library):
    rng = random.Random(1)
    signs = [chr(c) for c in range(32, 127)] + list("éßÉ’<|>\n\t\x1c\x85Σσ日本́İ​😀") + ["<|endoftext|>", "<|startoftext|>", "'ll", "'RE"]
    for k in range(3000):
        text = "".join(rng.choice(signs[: 95 if k % 2 else None]) for _ in range(rng.randint(0, 60)))
        ids = [i for p in own.pieces(text) for i in own.merge(p)]
        assert ids == library.encode(text, add_special_tokens=False).ids
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)


@needs_file
def test_long_words_merge_in_good_time(own, library):
    word = "abcdefghij" * 5000
    assert own.merge(word) == library.encode(word, add_special_tokens=False).ids


def test_transducer_is_minimal_and_numbers_words(tmp_path):
    rng = random.Random(5)
    words = sorted({"".join(rng.choices("abé", k=rng.randint(1, 8))).encode() for _ in range(800)})
    (tmp_path / "l").write_bytes(bpe.compile_lexicon([(w, [i, i + 1]) for i, w in enumerate(words)]))
    lexicon = bpe.Lexicon(str(tmp_path / "l"))
    assert lexicon.places(words).tolist() == list(range(len(words)))
    strange = [w + b"x" for w in words] + [w[:-1] for w in words] + [b"", b"q"]
    known = {w: i for i, w in enumerate(words)}
    assert lexicon.places(strange).tolist() == [known.get(w, -1) for w in strange]
    # As few states as there are distinct sets of endings.
    endings = defaultdict(set)
    for w in words:
        for i in range(len(w) + 1):
            endings[w[:i]].add(w[i:])
    assert len(lexicon.finals) == len({frozenset(e) for e in endings.values()})
    (tmp_path / "none").write_bytes(bpe.compile_lexicon([]))
    assert bpe.Lexicon(str(tmp_path / "none")).places([b"a", b""]).tolist() == [-1, -1]


@needs_file
@pytest.mark.parametrize("words", [0, 3, 50_000])
def test_bpe_equals_the_library(spark, make_docs, library, words, monkeypatch):
    monkeypatch.setattr(bpe, "SLICE_CHARS", 200)
    texts = ["Hello, world's 12 éÉ", None, "", "   ", "a<|endoftext|>b", "the the the " * 100, "x" * 900, "日本語 " * 80, "naïve café—“quoted” 3.14 don't " * 9]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "null id"), (3, "again"), (3, "again")]
    docs = make_docs(rows)
    encoder = bpe.fit_encoder(docs, FILE, words=words)
    done = bpe.decode(bpe.encode(docs, encoder), encoder).collect()
    expected = []
    for i, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        expected.append((i, ids, library.decode(ids, skip_special_tokens=False)))
    assert sorted([tuple(r) for r in done], key=repr) == sorted(expected, key=repr)


@needs_file
def test_bpe_of_no_documents(spark, make_docs, folder):
    assert bpe.op13_transducer_bpe(spark, folder(documents=make_docs([])), FILE).collect() == []


@needs_file
def test_merging_side_by_side_equals_merging_one_by_one(own):
    rng = random.Random(3)
    words = ["".join(rng.choice("etaoinshrdlé日x'") for _ in range(rng.randint(1, 50))) for _ in range(6000)]
    words += ["<|endoftext|>", "a"]
    assert own.merge_many(words) == [own.merge(w) for w in words] and own.merge_many([]) == []
