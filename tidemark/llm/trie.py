"""The prefix trie of conversations: union-find over the LCP edges of sorted neighbours.

Equal conversations become one row, and the distinct ones are sorted by their turns, each turn
being a digest of role and text. Two neighbours share as many turns as their longest common
prefix (LCP) says, and that is an edge between them. Taken in descending depth, an edge joins
two runs of neighbours, and every join makes a node that branches; the nodes between it and the
runs it joined have one child each. All that is told of a node is a sum over its run of rows, so
it needs no second walk.

The sorted rows are cut into parts, each with its own forest. A prefix that a part shares with
the row before or after it is an open node: it is handed out as partial sums under the digest
of the prefix, and those are added up over the parts. Every other node is final in its part.
A part gives no more open nodes than its first and last rows have turns.

Cases. Null role or text: empty. Null turn: before all others. Turns with equal numbers: by the
digest of role and text; repeated rows are turns of their own. Rows without a conv_id belong to
no conversation and are left out. Empty table: no nodes, not even a root. Extra columns:
ignored. Large groups of equal conversations meet as one row a chunk of ids. A conversation is
one row of about 20 bytes a turn, however long its texts are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored, table

#: Bytes of the digest of a turn.
TURN = 16
#: A part of the sorted conversations holds about so many bytes of digests.
PART_BYTES = 32 << 20
#: A conversation starts with turns of the last one whose id is a multiple of this ...
EVERY = 5
#: ... fewer than this many.
HEADS = 9
NO_ENDS = hashlib.sha256(b"").hexdigest()


def turn_digest(role: Column, text: Column) -> Column:
    """TURN bytes, as hex, that tell turns apart by role and text."""
    role, text = F.coalesce(role.cast("string"), F.lit("")), F.coalesce(text, F.lit(""))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return F.substring(F.sha2(whole, 256), 1, 2 * TURN)


def rebuilt(conversations: DataFrame, every: int = EVERY, heads: int = HEADS) -> DataFrame:
    """``conv_id, key, sizes``: the digests of a conversation's turns in a row, and text bytes.

    Conversation c takes its first crc32(c) mod ``heads`` turns from conversation
    c - c mod ``every``. Both lie in one task, so the turns are shuffled once.
    """
    own = F.struct(
        "turn",
        turn_digest(F.col("role"), F.col("text")).alias("digest"),
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("size"),
    )
    base = F.col("conv_id") - F.col("conv_id") % every
    turns = conversations.where("conv_id is not null").select("conv_id", base.alias("base"), own.alias("own"))
    listed = turns.repartition("base").groupBy("base", "conv_id").agg(F.sort_array(F.collect_list("own")).alias("own"))
    first = F.max(F.when(F.col("conv_id") == F.col("base"), F.slice("own", 1, heads))).over(Window.partitionBy("base"))
    taken = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int")
    head = F.coalesce(F.slice(F.col("first"), F.lit(1), F.col("taken")), F.slice("own", 1, 0))
    rest = F.slice(F.col("own"), F.col("taken") + 1, F.size("own"))
    return (
        listed.withColumn("first", first)
        .withColumn("taken", taken)
        .select("conv_id", F.concat(head, rest).alias("all"))
        .select(
            "conv_id",
            F.unhex(F.array_join(F.transform("all", lambda t: t["digest"]), "")).alias("key"),
            F.transform("all", lambda t: t["size"]).alias("sizes"),
        )
    )


# --- equal conversations --------------------------------------------------------------------

SEQUENCE = pa.schema(
    [("key", pa.binary()), ("sizes", pa.list_(pa.int64())), ("n", pa.int64()), ("least", pa.int64()), ("ends", pa.string())]
)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a distinct conversation, from its chunks of ids in order."""
    out: list[tuple] = []
    now = digest = row = None

    def done() -> None:
        if row is not None:
            out.append((row["key"], row["sizes"], row["n"], row["least"], digest.hexdigest()))

    for batch in batches:
        for r in batch.to_pylist():
            if r["id"] == now:
                digest.update(b"," + r["ids"].encode())
                row["n"] += r["n"]
                row["least"] = min(row["least"], r["least"])
                continue
            done()
            now, row, digest = r["id"], r, hashlib.sha256(r["ids"].encode())
        if len(out) >= 2000:
            yield _batch(SEQUENCE, zip(*out))
            out = []
    done()
    if out:
        yield _batch(SEQUENCE, zip(*out))


def _batch(schema: pa.Schema, columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)


def sequences(conversations: DataFrame) -> DataFrame:
    """``key, sizes, n, least, ends`` of each distinct conversation of ``rebuilt``.

    The ids of equal conversations are put in order by ranges, and joined in each range
    before the shuffle; the digest ``ends`` then runs over one row a range.
    """
    held = stored(conversations, "trie-rebuilt").withColumn("id", F.sha2("key", 256))
    ranged = held.repartitionByRange("conv_id").withColumn("chunk", F.spark_partition_id())
    ids = F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda i: i.cast("string")), ",")
    chunks = ranged.groupBy("id", "chunk").agg(
        F.first("key").alias("key"), F.first("sizes").alias("sizes"), F.count("*").alias("n"), F.min("conv_id").alias("least"), ids.alias("ids")
    )
    return chunks.repartition("id").sortWithinPartitions("id", "chunk").mapInArrow(_joined, "key binary, sizes array<bigint>, n bigint, least bigint, ends string")


# --- the forest of a part -------------------------------------------------------------------

NODE = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("depth", pa.int64()),
        ("parent_conv_id", pa.int64()),
        ("n_convs", pa.int64()),
        ("n_children", pa.int64()),
        ("n_leaves", pa.int64()),
        ("saved_tokens", pa.int64()),
        ("ends", pa.string()),
        ("node", pa.string()),
        ("parent", pa.string()),
    ]
)
NODE_SQL = (
    "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
    "saved_tokens bigint, ends string, node string, parent string"
)


def common_turns(keys: list[bytes]) -> np.ndarray:
    """The number of turns that each key shares with the one after it."""
    words = np.frombuffer(b"".join(keys), np.uint64).reshape(-1, TURN // 8)
    lengths = np.array([len(k) // TURN for k in keys], np.int64)
    start = np.concatenate([[0], np.cumsum(lengths)])[:-1]
    least = np.minimum(lengths[:-1], lengths[1:])
    first = np.concatenate([[0], np.cumsum(least)])
    place = np.arange(first[-1]) - np.repeat(first[:-1], least)
    differs = (words[np.repeat(start[:-1], least) + place] != words[np.repeat(start[1:], least) + place]).any(axis=1)
    at = np.append(np.flatnonzero(differs), first[-1])
    return np.minimum(at[np.searchsorted(at, first[:-1])], first[1:]) - first[:-1]


def merge_runs(lengths: list[int], lcp: np.ndarray, least: list[int]) -> tuple[np.ndarray, ...]:
    """Union-find over the edges in descending depth.

    ``lcp[i]`` is the edge between rows i and i + 1. Returns depth, first and last row,
    edges at that depth, parent (-1 for none) and least id of the nodes: one for each row, and
    one for each branching made by a join.
    """
    depth, low, high = list(lengths), list(range(len(lengths))), list(range(len(lengths)))
    edges, parent, least = [0] * len(lengths), [-1] * len(lengths), list(least)
    link = list(range(len(lengths)))

    def find(x: int) -> int:
        root = x
        while link[root] != root:
            root = link[root]
        while link[x] != root:
            link[x], x = root, link[x]
        return root

    # Ties go from left to right, so the right run never stands at the depth of the edge.
    for i in np.argsort(-lcp, kind="stable").tolist():
        at, a, b = int(lcp[i]), find(i), find(i + 1)
        if depth[a] == at:
            node = a
        else:
            node = len(depth)
            depth.append(at)
            low.append(low[a])
            high.append(high[a])
            edges.append(0)
            parent.append(-1)
            least.append(least[a])
            link.append(node)
            link[a] = parent[a] = node
        link[b] = parent[b] = node
        high[node] = high[b]
        edges[node] += 1
        least[node] = min(least[node], least[b])
    return tuple(np.array(x, np.int64) for x in (depth, low, high, edges, parent, least))


def _prefix_digests(key: bytes, depth: int) -> list[str]:
    """The digest of each prefix of ``key`` with up to ``depth`` turns."""
    running, out = hashlib.sha256(), []
    for at in range(depth + 1):
        out.append(running.copy().hexdigest())
        running.update(key[at * TURN : (at + 1) * TURN])
    return out


def forest(rows: list[dict], before: bytes | None, after: bytes | None) -> Iterator[pa.RecordBatch]:
    """The nodes of sorted, distinct rows between the keys ``before`` and ``after``."""
    keys = [r["key"] for r in rows]
    m = len(keys)
    lcp = common_turns([before or b"", *keys, after or b""])
    if before is None:
        lcp[0] = -1
    if after is None:
        lcp[m] = -1
    left, right = int(lcp[0]), int(lcp[m])
    length = np.array([len(k) // TURN for k in keys], np.int64)
    n = np.array([r["n"] for r in rows], np.int64)

    # Text bytes of the first k turns of row i: text[offset[i] + k].
    offset = np.concatenate([[0], np.cumsum(length + 1)])[:-1]
    flat = np.zeros(int((length + 1).sum()), np.int64)
    inner = np.ones(len(flat), bool)
    inner[offset] = False
    flat[inner] = np.concatenate([np.asarray(r["sizes"], np.int64) for r in rows])
    text = np.cumsum(flat)
    text -= np.repeat(text[offset], length + 1)
    total = text[offset + length]
    fresh = total - text[offset + np.maximum(lcp[:-1], 0)]
    sums = lambda x: np.concatenate([[0], np.cumsum(x)])
    sum_n, sum_bytes, sum_fresh, sum_leaves = sums(n), sums(n * total), sums(fresh), sums(lcp[1:] < length)

    depth, low, high, edges, parent, least = merge_runs(length.tolist(), lcp[1:m], [r["least"] for r in rows])
    above = np.where(parent >= 0, depth[parent], -1)
    digests = _prefix_digests(keys[0], left), _prefix_digests(keys[-1], right)
    ends = [r["ends"] for r in rows]

    def opened(lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> list[str | None]:
        at_left, at_right = (lo == 0) & (x <= left) & (x >= 0), (hi == m - 1) & (x <= right) & (x >= 0)
        return [digests[0][d] if a else digests[1][d] if b else None for a, b, d in zip(at_left.tolist(), at_right.tolist(), x.tolist())]

    # A node stands for a chain: its own depth, and those above it up to its parent's.
    chain = depth - above
    step = 4096
    first = 0
    while first < len(depth):
        last = first + 1
        rows_in = int(chain[first])
        while last < len(depth) and rows_in + chain[last] <= step:
            rows_in += int(chain[last])
            last += 1
        which = np.repeat(np.arange(first, last), chain[first:last])
        ordinal = np.arange(len(which)) - np.repeat(sums(chain[first:last])[:-1], chain[first:last])
        x = above[which] + 1 + ordinal
        lo, hi = low[which], high[which]
        held = text[offset[lo] + np.maximum(x - 1, 0)]
        goes_on = (lo == 0) & (x <= left)
        count = sum_n[hi + 1] - sum_n[lo]
        new = sum_fresh[hi + 1] - sum_fresh[lo + 1] + np.where(goes_on, fresh[0], total[lo] - held)
        saved = sum_bytes[hi + 1] - sum_bytes[lo] - count * held - new
        children = np.where(x == depth[which], edges[which], 0) + (length[lo] > x) * np.where(goes_on, x == left, True)
        leaves = sum_leaves[hi + 1] - sum_leaves[lo]
        # The parent has the same run, but for the top of a chain.
        top = (x == above[which] + 1) & (x > 0)
        up = np.where(top, parent[which], which)
        node = opened(lo, hi, x)
        over = opened(low[up], high[up], x - 1)
        known = [None if o is not None or d == 0 else i for o, d, i in zip(over, x.tolist(), least[up].tolist())]
        ended = [ends[i] if d == e else None for i, d, e in zip(lo.tolist(), x.tolist(), length[lo].tolist())]
        yield _batch(NODE, [least[which], x, known, count, children, leaves, saved, ended, node, over])
        first = last


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The forest of each part; rows come by part, each with its neighbours around it."""
    part, rows, before, after = None, [], None, None
    for batch in batches:
        for r in batch.to_pylist():
            if r["part"] != part:
                if rows:
                    yield from forest(rows, before, after)
                part, rows, before, after = r["part"], [], None, None
            if r["kind"] == 0:
                before = r["key"]
            elif r["kind"] == 2:
                after = r["key"]
            else:
                rows.append(r)
    if rows:
        yield from forest(rows, before, after)


def prefix_trie(conversations: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """The nodes of the trie of ``conversations`` (conv_id, key, sizes), as in ``rebuilt``.

    ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256``: a node is named by its smallest member and its depth.
    """
    spark = conversations.sparkSession
    distinct = stored(sequences(conversations), "trie-sequences")
    size = distinct.agg(F.sum(F.octet_length("key"))).first()[0] or 0
    n_parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // part_bytes + 1)
    parts = stored(distinct.repartitionByRange(n_parts, "key").withColumn("part", F.spark_partition_id()), "trie-parts")

    # The rows on both sides of each part. Only the numbers of the parts reach the driver.
    borders = stored(parts.groupBy("part").agg(F.min("key").alias("low"), F.max("key").alias("high")), "trie-borders")
    filled = sorted(r.part for r in borders.select("part").collect())
    beside = [(a, b, 0) for a, b in zip(filled, filled[1:])] + [(b, a, 2) for a, b in zip(filled, filled[1:])]
    pairs = spark.createDataFrame(beside, "part int, to int, kind int")
    key = F.when(F.col("kind") == 0, F.col("high")).otherwise(F.col("low"))
    around = borders.join(pairs, "part").select(F.col("to").alias("part"), "kind", key.alias("key"))
    rows = parts.withColumn("kind", F.lit(1)).unionByName(around, allowMissingColumns=True)
    grown = rows.repartitionByRange(n_parts, "part").sortWithinPartitions("part", "kind", "key")
    nodes = stored(grown.mapInArrow(_forests, NODE_SQL), "trie-nodes")

    # Open nodes: the partial sums of a prefix, and then their parents, which are open too.
    totals = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    merged = stored(
        nodes.where("node is not null")
        .groupBy("node", "depth")
        .agg(F.min("conv_id").alias("conv_id"), *totals, F.max("ends").alias("ends"), F.max("parent").alias("parent")),
        "trie-open",
    )
    named = merged.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    closed = nodes.where("node is null")
    below = closed.where("parent is not null").unionByName(merged, allowMissingColumns=True).drop("parent_conv_id")
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends"]
    out = closed.where("parent is null").select(*columns).unionByName(below.join(named, "parent", "left").select(*columns))
    return out.withColumn("ends_sha256", F.coalesce("ends", F.lit(NO_ENDS))).drop("ends")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nodes of the trie of all rebuilt conversations."""
    return prefix_trie(rebuilt(table(spark, sf_dir, "conversations")))


# DuckDB has no crc32, so its bits are worked out: the polynomial is the one of zlib.
SQL = f"""
WITH turns AS (
  SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} ORDER BY turn NULLS FIRST,
         substr(sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 1, {2 * TURN})) AS own
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), taken AS (
  SELECT conv_id, own, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
         lambda a, b: list_reduce(list_prepend(xor(a, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
         lambda x, y: xor(x >> 1, (x & 1) * 3988292384))), 4294967295) % {HEADS} AS h
  FROM turns
), whole AS (
  SELECT t.conv_id, CASE WHEN b.own IS NULL THEN t.own[t.h + 1:] ELSE b.own[1:t.h] || t.own[t.h + 1:] END AS seq
  FROM taken t LEFT JOIN turns b ON b.conv_id = t.conv_id - t.conv_id % {EVERY}
), prefixes AS (
  SELECT conv_id, len(seq) AS turns, d AS depth, seq[1:d] AS prefix FROM whole, unnest(range(len(seq) + 1)) AS u(d)
), nodes AS (
  SELECT depth, prefix, min(conv_id) AS conv_id, count(*) AS n_convs,
         coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (turns = depth), '') AS ends
  FROM prefixes GROUP BY depth, prefix
), children AS (
  SELECT prefix[1:depth - 1] AS prefix, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1
), counted AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children, CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * strlen(prefix[depth].text) END AS saved
  FROM nodes n LEFT JOIN children c USING (prefix)
), below AS (
  SELECT prefix[1:d] AS prefix, sum(saved) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
  FROM counted, unnest(range(depth + 1)) AS u(d) GROUP BY 1
)
SELECT n.conv_id, n.depth, up.conv_id AS parent_conv_id, n.n_convs, n.n_children, n_leaves,
       CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM counted n JOIN below USING (prefix) LEFT JOIN nodes up ON n.depth > 0 AND up.prefix = n.prefix[1:n.depth - 1]
"""
