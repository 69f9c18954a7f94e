"""BPE encoding and decoding with a lexicon in a minimal acyclic transducer.

A text is cut into words as the tokenizer file says. The most frequent words of the documents,
counted over all of them, are merged once and compiled into an automaton that shares prefixes and
suffixes: each state stands for a set of endings and is kept once. A transition carries a number,
the numbers on a word's path add up to the word's place, and at that place stand its ids. The
automaton is a file that Spark hands to each executor, where the tasks map it into memory. Words
that it does not hold are merged exactly, pair by pair in rank order, so the lexicon changes the
time that encoding takes and never its result.

Cases. Null text: empty, no ids. Texts of any length are cut at spaces and worked on piece by
piece, since no word and no special token has one inside. Texts in letters beyond Latin go through
the normaliser and the word splitter of the tokenizers library, and then the same way. Special
tokens in a text become their ids. Ties in frequency: by the word's bytes. Repeated rows and ids:
each row has its ids. Empty table: no rows. Extra columns: ignored.
"""

from __future__ import annotations

import heapq
import json
import re
import struct
import unicodedata
import uuid
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import stored, table
from tidemark.session import scratch_dir

#: So many of the most frequent words are compiled ...
LEXICON_WORDS = 200_000
#: ... of those with so many bytes at most.
WORD_BYTES = 48
#: Characters worked on at a time, and distinct words that a task holds before it hands out counts.
SLICE_CHARS = 1 << 20
HELD = 300_000
#: Words of up to so many bytes are merged side by side, in matrices of these widths.
WIDTHS = (4, 6, 8, 10, 12, 16, 24, 32, 64)
#: Larger than any rank of a merge.
NO_MERGE = np.int32(1 << 30)


class Tokenizer:
    """A BPE with word ends from a tokenizer file: words, merges, and the text of an id."""

    def __init__(self, content: str) -> None:
        self.content = content
        spec = json.loads(content)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        end = model["end_of_word_suffix"]
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in (vocab | self.specials).items()}
        shown = byte_letters()
        self.byte_of = {c: b for b, c in enumerate(shown)}
        self.inner = [vocab[c] for c in shown]
        self.last = [vocab[c + end] for c in shown]
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.merges = {(vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in enumerate(pairs)}
        # The merges again, sorted by pair, for many lookups at once.
        keys = np.array([a << 32 | b for a, b in self.merges], np.int64)
        order = np.argsort(keys)
        self.pair_keys, self.pair_ranks = keys[order], order.astype(np.int32)
        self.made = np.array([new for _, new in self.merges.values()], np.int32)
        self.inner_ids, self.last_ids = np.array(self.inner, np.int32), np.array(self.last, np.int32)
        self.token_texts = pa.array([self.tokens.get(i) for i in range(max(self.tokens) + 1)], pa.string())
        self.special = re.compile("(" + "|".join(re.escape(t) for t in sorted(self.specials, key=len, reverse=True)) + ")") if self.specials else None
        self._library = None

    def pieces(self, text: str) -> list[str]:
        """The words of a text; a special token is a piece of its own."""
        if self.special is None or "<" not in text and not any(t in text for t in self.specials):
            return self._words(text)
        out: list[str] = []
        for i, part in enumerate(self.special.split(text)):
            out.extend([part] if i % 2 else self._words(part))
        return out

    def _words(self, text: str) -> list[str]:
        if text.isascii() or not ODD.search(text):
            return WORD.findall(text.lower())
        if self._library is None:
            from tokenizers import Tokenizer as Library

            self._library = Library.from_str(self.content)
        normal = self._library.normalizer.normalize_str(text)
        shown = (piece for piece, _ in self._library.pre_tokenizer.pre_tokenize_str(normal))
        return [bytes(map(self.byte_of.__getitem__, piece)).decode() for piece in shown]

    def merge(self, word: str) -> list[int]:
        """The ids of a word: pairs are merged in rank order, the leftmost first."""
        if word in self.specials:
            return [self.specials[word]]
        data = word.encode()
        ids = [self.inner[b] for b in data[:-1]] + [self.last[data[-1]]]
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        heap: list[tuple[int, int, int]] = []

        def offer(at: int) -> None:
            if at >= 0 and after[at] < len(ids):
                got = self.merges.get((ids[at], ids[after[at]]))
                if got:
                    heapq.heappush(heap, (got[0], at, got[1]))

        for at in range(len(ids)):
            offer(at)
        while heap:
            _, at, new = heapq.heappop(heap)
            if ids[at] < 0 or after[at] >= len(ids):
                continue
            got = self.merges.get((ids[at], ids[after[at]]))
            if not got or got[1] != new:
                continue
            gone = after[at]
            ids[at], ids[gone] = new, -1
            after[at] = after[gone]
            if after[at] < len(ids):
                before[after[at]] = at
            offer(before[at])
            offer(at)
        return [i for i in ids if i >= 0]

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair of ids, ``NO_MERGE`` for pairs that do not merge."""
        keys = left.astype(np.int64) << 32 | right.astype(np.int64)
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where((self.pair_keys[at] == keys) & (left >= 0) & (right >= 0), self.pair_ranks[at], NO_MERGE)

    def merge_many(self, words: Sequence[str]) -> list[list[int]]:
        """``merge`` of each word. Words of like length take their next merge together."""
        out: list[list[int]] = [[]] * len(words)
        encoded = [w.encode() for w in words]
        groups: dict[int, list[int]] = {}
        for i, data in enumerate(encoded):
            width = next((w for w in WIDTHS if len(data) <= w), 0)
            if not width or words[i] in self.specials:
                out[i] = self.merge(words[i])
            else:
                groups.setdefault(width, []).append(i)
        for width, members in groups.items():
            for first in range(0, len(members), 4096):
                self._merge_group(encoded, members[first : first + 4096], width, out)
        return out

    def _merge_group(self, encoded: list[bytes], members: list[int], width: int, out: list[list[int]]) -> None:
        lengths = np.array([len(encoded[i]) for i in members])
        data = np.frombuffer(b"".join(encoded[i].ljust(width, b"\0") for i in members), np.uint8).reshape(-1, width)
        place = np.arange(width)
        ids = np.where(place < lengths[:, None] - 1, self.inner_ids[data], np.where(place == lengths[:, None] - 1, self.last_ids[data], -1))
        # A column more, which stays empty, so that a row can move up by one.
        ids = np.pad(ids, ((0, 0), (0, 1)), constant_values=-1)
        ranks = np.pad(self._ranks(ids[:, :-1], ids[:, 1:]), ((0, 0), (0, 1)), constant_values=NO_MERGE)
        own = np.array(members)
        place = np.arange(width + 1)
        while len(own):
            at = ranks.argmin(axis=1)
            best = ranks[np.arange(len(own)), at]
            live = best < NO_MERGE
            if not live.all():
                for i, row in zip(own[~live].tolist(), ids[~live].tolist()):
                    out[i] = [t for t in row if t >= 0]
                own, ids, ranks, at, best = own[live], ids[live], ranks[live], at[live], best[live]
                if not len(own):
                    break
            rows = np.arange(len(own))
            moved = np.minimum(place + (place > at[:, None]), width)
            ids, ranks = np.take_along_axis(ids, moved, 1), np.take_along_axis(ranks, moved, 1)
            ids[rows, at] = self.made[best]
            ids[:, width] = -1
            ranks[:, width] = NO_MERGE
            ranks[rows, at] = self._ranks(ids[rows, at], ids[rows, np.minimum(at + 1, width)])
            inner = at > 0
            ranks[rows[inner], at[inner] - 1] = self._ranks(ids[rows[inner], at[inner] - 1], ids[rows[inner], at[inner]])

    def decode(self, ids: Iterable[int]) -> str:
        """The tokens with a space between them, as a file without a decoder is read."""
        return " ".join(map(self.tokens.__getitem__, ids))

    def decode_lists(self, lists: pa.ListArray) -> pa.Array:
        """``decode`` of each list of ids; null is empty."""
        texts = self.token_texts.take(lists.flatten())
        if texts.null_count:
            raise ValueError("an id without a token")
        ends = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy())])
        held = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), texts)
        return pc.binary_join(held, " ")


def byte_letters() -> list[str]:
    """The letter that byte-level tokenizers show for each byte: itself where it prints."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in prints else chr(next(rest)) for b in range(256)]


def _plain_classes() -> tuple[re.Pattern, re.Pattern]:
    """The words of texts in Western Latin letters and common signs, and what is beyond those.

    None of these characters changes under composition, and each has a lower case of its own.
    """
    plain = [chr(c) for c in [*range(0x180), *range(0x2010, 0x2028), *range(0x2030, 0x205F), *range(0x20A0, 0x20C0)] if c != 0x130]
    kind = {c: unicodedata.category(c)[0] for c in plain}
    chars = lambda held: "".join(re.escape(c) for c in plain if held(c))
    letters, numbers = chars(lambda c: kind[c] == "L"), chars(lambda c: kind[c] == "N")
    # The white space of Unicode among them.
    space = "\\t\\n\\x0b\\x0c\\r\\x20\\x85\\xa0"
    word = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^{space}{letters}{numbers}]+")
    return word, re.compile(f"[^{chars(lambda c: True)}]")


WORD, ODD = _plain_classes()


@lru_cache(maxsize=4)
def tokenizer(content: str) -> Tokenizer:
    """The tokenizer of a file's content, made once in each Python process."""
    return Tokenizer(content)


# --- the transducer -------------------------------------------------------------------------

HEADER = struct.Struct("<4q")


def compile_lexicon(entries: Sequence[tuple[bytes, Sequence[int]]]) -> bytes:
    """The automaton of distinct words, in byte order, with their ids.

    States are made minimal as soon as no later word can change them: a state whose endings
    are those of a known one is replaced by it.
    """
    known: dict[tuple, int] = {}
    finals: list[bool] = []
    edges: list[tuple[tuple[int, int], ...]] = []
    # The path of the last word: for each of its states the edges so far, and whether it ends a word.
    path: list[list] = [[[], False]]
    last = b""

    def settle(depth: int) -> None:
        while len(path) > depth + 1:
            own, final = path.pop()
            key = (final, tuple(own))
            state = known.get(key)
            if state is None:
                state = known[key] = len(finals)
                finals.append(final)
                edges.append(tuple(own))
            path[-1][0][-1] = (path[-1][0][-1][0], state)

    for word, _ in entries:
        if word <= last and last:
            raise ValueError("words must be distinct and in order")
        same = 0
        while same < min(len(word), len(last)) and word[same] == last[same]:
            same += 1
        settle(same)
        for byte in word[same:]:
            path[-1][0].append((byte, -1))
            path.append([[], False])
        path[-1][1] = True
        last = word
    settle(0)
    root = len(finals)
    finals.append(path[0][1])
    edges.append(tuple(path[0][0]))

    # A state comes after those it leads to, so its words are counted last.
    words = [0] * len(finals)
    keys, targets, numbers = [], [], []
    for state, own in enumerate(edges):
        count = int(finals[state])
        for byte, to in own:
            keys.append(state << 8 | byte)
            targets.append(to)
            numbers.append(count)
            count += words[to]
        words[state] = count
    order = np.argsort(np.array(keys, np.int64), kind="stable")
    starts = np.concatenate([[0], np.cumsum([len(ids) for _, ids in entries])]).astype(np.int64)
    arrays = [
        np.array(keys, np.int64)[order],
        np.array(targets, np.int64)[order],
        np.array(numbers, np.int64)[order],
        np.array(finals, np.int64),
        starts,
        np.array([i for _, ids in entries for i in ids], np.int64),
    ]
    head = HEADER.pack(len(keys), len(finals), len(entries), root)
    return head + b"".join(a.tobytes() for a in arrays)


class Lexicon:
    """A compiled lexicon, mapped from its file."""

    def __init__(self, file: str) -> None:
        data = np.memmap(file, np.int64, "r")
        n_keys, n_states, n_words, self.root = (int(x) for x in data[:4])
        ends = np.cumsum([4, n_keys, n_keys, n_keys, n_states, n_words + 1])
        self.keys, self.targets, self.numbers, self.finals, self.starts = (data[a:b] for a, b in zip(ends, ends[1:]))
        self.ids = data[ends[-1] :]

    def places(self, words: Sequence[bytes]) -> np.ndarray:
        """The place of each word, -1 for unknown ones. All words take a step at a time."""
        lengths = np.array([len(w) for w in words], np.int64)
        starts = np.concatenate([[0], np.cumsum(lengths)])[:-1]
        data = np.frombuffer(b"".join(words), np.uint8)
        state, place = np.full(len(words), self.root, np.int64), np.zeros(len(words), np.int64)
        out = np.full(len(words), -1, np.int64)
        if not len(self.keys):
            return out
        live = np.flatnonzero(lengths > 0)
        step = 0
        while len(live):
            key = state[live] << 8 | data[starts[live] + step]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            found = self.keys[at] == key
            live, at = live[found], at[found]
            place[live] += self.numbers[at]
            state[live] = self.targets[at]
            step += 1
            ended = lengths[live] == step
            done = live[ended]
            out[done] = np.where(self.finals[state[done]] == 1, place[done], -1)
            live = live[~ended]
        return out


@lru_cache(maxsize=4)
def _lexicon(name: str) -> Lexicon:
    return Lexicon(SparkFiles.get(name))


class Encoder(NamedTuple):
    """What encoding needs: the content of the tokenizer file and the name of the lexicon's."""

    content: str
    lexicon: str


def _cuts(text: str) -> Iterator[str]:
    """A text in pieces of about ``SLICE_CHARS``, cut at spaces."""
    at = 0
    while at < len(text):
        end = text.find(" ", at + SLICE_CHARS)
        end = len(text) if end < 0 else end
        yield text[at:end]
        at = end


def count_words(docs: DataFrame, content: str, text: str = "text", word_bytes: int = WORD_BYTES) -> DataFrame:
    """``word, n`` over all texts, of the words with ``word_bytes`` at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, counts = tokenizer(content), Counter()

        def out() -> pa.RecordBatch:
            words = [w for w in counts if w not in own.specials and len(w.encode()) <= word_bytes]
            return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([counts[w] for w in words], pa.int64())], ["word", "n"])

        for batch in batches:
            for value in batch.column(0):
                for part in _cuts(value.as_py() or ""):
                    counts.update(own.pieces(part))
                if len(counts) >= HELD:
                    yield out()
                    counts = Counter()
        yield out()

    return docs.select(text).mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def fit_encoder(docs: DataFrame, path: str, text: str = "text", words: int = LEXICON_WORDS) -> Encoder:
    """Compiles the ``words`` most frequent words of all texts and gives the file to executors.

    The driver holds the words of the lexicon, ``words`` times ``WORD_BYTES`` at most.
    """
    with open(path, encoding="utf-8") as file:
        content = file.read()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer(content)
        for batch in batches:
            ids = own.merge_many(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["word", "ids"])

    top = count_words(docs, content, text).orderBy(F.col("n").desc(), "word").limit(words).select("word")
    merged = stored(top, "bpe-words").repartition("word").mapInArrow(merge, "word string, ids array<int>")
    entries = sorted((row.word.encode(), row.ids) for row in merged.collect())

    spark = docs.sparkSession
    name = f"lexicon-{uuid.uuid4().hex}"
    shared = f"{scratch_dir(spark, 'bpe-lexicon')}/{name}"
    system, place = fs.FileSystem.from_uri(shared) if "://" in shared or shared.startswith("file:") else (fs.LocalFileSystem(), shared)
    system.create_dir(place.rpartition("/")[0], recursive=True)
    with system.open_output_stream(place) as out:
        out.write(compile_lexicon(entries))
    spark.sparkContext.addFile(shared)
    return Encoder(content, name)


def _encode_slice(own: Tokenizer, lexicon: Lexicon, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(ids, ids of each piece) of pieces in a row; each distinct word is looked up once."""
    distinct = list(dict.fromkeys(pieces))
    index = {w: i for i, w in enumerate(distinct)}
    places = lexicon.places([w.encode() for w in distinct])
    unseen = np.flatnonzero(places < 0).tolist()
    merged = own.merge_many([distinct[i] for i in unseen])
    seen = np.maximum(places, 0)
    start = np.array(lexicon.starts[seen]) if len(lexicon.starts) > 1 else np.zeros(len(distinct), np.int64)
    count = np.array(lexicon.starts[seen + 1]) - start if len(lexicon.starts) > 1 else np.zeros(len(distinct), np.int64)
    # The ids of unseen words stand behind those of the lexicon.
    count[unseen] = [len(ids) for ids in merged]
    start[unseen] = len(lexicon.ids) + np.concatenate([[0], np.cumsum(count[unseen])])[:-1].astype(np.int64)
    extra = np.array([i for ids in merged for i in ids], np.int64)
    which = np.fromiter(map(index.__getitem__, pieces), np.int64, len(pieces))
    counts = count[which]
    total = int(counts.sum())
    place = np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(start[which], counts)
    behind = place >= len(lexicon.ids)
    ids = np.empty(total, np.int32)
    ids[~behind] = lexicon.ids[place[~behind]]
    ids[behind] = extra[place[behind] - len(lexicon.ids)]
    return ids, counts


def encode(docs: DataFrame, encoder: Encoder, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key, ids`` of each text, as the tokenizers library gives them without special tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, lexicon = tokenizer(encoder.content), _lexicon(encoder.lexicon)
        for batch in batches:
            first, pieces, sizes, chars = 0, [], [], 0
            held: list[np.ndarray] = []
            for i, value in enumerate(batch.column(1)):
                value = value.as_py() or ""
                if len(value) > SLICE_CHARS:
                    # A long text by itself, cut by cut.
                    if sizes:
                        yield _rows(batch, first, i, *_encode_slice(own, lexicon, pieces), sizes)
                    held = [_encode_slice(own, lexicon, own.pieces(part))[0] for part in _cuts(value)]
                    whole = np.concatenate(held)
                    yield _rows(batch, i, i + 1, whole, np.array([len(whole)]), [1])
                    first, pieces, sizes, chars = i + 1, [], [], 0
                    continue
                found = own.pieces(value)
                pieces += found
                sizes.append(len(found))
                chars += len(value)
                if chars >= SLICE_CHARS:
                    yield _rows(batch, first, i + 1, *_encode_slice(own, lexicon, pieces), sizes)
                    first, pieces, sizes, chars = i + 1, [], [], 0
            if sizes:
                yield _rows(batch, first, batch.num_rows, *_encode_slice(own, lexicon, pieces), sizes)

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, ids array<int>")


def _rows(batch: pa.RecordBatch, first: int, last: int, ids: np.ndarray, counts: np.ndarray, sizes: list[int]) -> pa.RecordBatch:
    """Rows ``first`` to ``last`` with their ids; a row has ``sizes`` pieces of ``counts`` ids."""
    ends = np.concatenate([[0], np.cumsum(counts)])[np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)]
    lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32), pa.int32()), pa.array(ids, pa.int32()))
    return pa.RecordBatch.from_arrays([batch.column(0).slice(first, last - first), lists], [batch.schema.names[0], "ids"])


def decode(encoded: DataFrame, encoder: Encoder, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """Adds the text of the ids; unknown ids are an error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer(encoder.content)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(ids))
            lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy()
            first = 0
            while first < batch.num_rows:
                many = np.searchsorted(np.cumsum(lengths[first:]), SLICE_CHARS, "right")
                last = min(first + max(1, int(many)), batch.num_rows)
                part = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays([*part.columns, own.decode_lists(column.slice(first, last - first))], [*part.schema.names, name])
                first = last

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return encoded.mapInArrow(run, f"{schema}, `{name}` string")


def op13_transducer_bpe(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    """Digests of the ids and of the decoded text of every document."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoder = fit_encoder(docs, path)
    done = decode(encode(docs, encoder), encoder)
    return done.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
