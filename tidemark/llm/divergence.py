"""How far the word use of the sources of a language lies apart, cell by cell of a cube.

Terms are counted in the tasks that read the texts; the counts of a term are then added up. A
language keeps the terms of enough documents. Each source, and the language, gives each kept term
a share p in whole billionths, never zero, and p differs from q by floor((p - q)^2 / q).

The pairs of sources span a cube: source by source by term. Sources are dealt into blocks, terms
into blocks, and a task owns cells (source block, source block, term block): it gets the slice of
counts of either source block in its term block, works out both directions of every pair in the
cell, and hands out partial sums, which are added up along the term axis. A slice is replicated
once for each source block of its language, and that is all that is: no pair is made of rows.
A term that neither of two sources has adds the same amount for each such term, so a cell says
how many terms it saw and the rest is one product. All numbers are integers.

Cases. Null text, lang or source: ''. Empty texts and texts without terms: their group occurs and
has no counts. A term of any length is one term; long texts are cut between terms. Repeated rows:
each is a document. Ties in value: by the bytes of the item. Empty table: no rows. Extra columns:
ignored. A source that holds much of the table is counted in all tasks that read it.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored, table

#: A language keeps terms of so many documents.
LEAST_DOCS = 3
SCALE = 1_000_000_000
TOP = 200
#: A cell has about so many sources on each side, and about so many terms.
SOURCE_BLOCK = 128
TERM_BLOCK = 2048
#: A task holds about so many counts before it hands them out.
HELD = 400_000
SLICE = 1 << 20

# Every byte that is no part of a term becomes a space; capitals become small.
TERM_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256)
)
COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])


def terms_of(text: str) -> Counter:
    """The count of each term, as UTF-8 bytes."""
    data = text.encode().translate(TERM_BYTES)
    counts: Counter = Counter()
    at = 0
    while at < len(data):
        end = data.find(b" ", at + SLICE)
        end = len(data) if end < 0 else end
        counts.update(data[at:end].split())
        at = end
    return counts


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of (lang, source, term), added up until ``HELD`` are there; term null for a group."""
    groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    size = 0

    def out() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in groups.items():
            terms = [None, *n]
            for first in range(0, len(terms), 50_000):
                part = terms[first : first + 50_000]
                columns = [
                    pa.array([lang] * len(part)),
                    pa.array([source] * len(part)),
                    pa.array(part, pa.binary()).cast(pa.string()),
                    pa.array([n[t] if t is not None else 0 for t in part], pa.int64()),
                    pa.array([docs[t] if t is not None else 0 for t in part], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=COUNTS)

    for batch in batches:
        for lang, source, text in zip(batch["lang"], batch["source"], batch["text"]):
            n, docs = groups.setdefault((lang.as_py(), source.as_py()), (Counter(), Counter()))
            counts = terms_of(text.as_py())
            before = len(n)
            n.update(counts)
            docs.update(counts.keys())
            size += len(n) - before
            if size >= HELD:
                yield from out()
                groups, size = {}, 0
    yield from out()


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs``, with a row without a term for each group."""
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    read = docs.select(empty("lang"), empty("source"), empty("text"))
    partial = read.mapInArrow(_count, "lang string, source string, term string, n bigint, docs bigint")
    # Dealt by term, so that a term's documents are added up over sources without a shuffle.
    dealt = partial.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    return dealt


def _share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (n + 1) / (total + terms)), whole numbers throughout."""
    wide = ((n + 1).cast("decimal(28,0)") * F.lit(SCALE).cast("decimal(10,0)")).cast("decimal(38,0)")
    by = (total + terms).cast("decimal(20,0)")
    # Without kept terms there is nothing to divide by, and no term to share.
    return F.when(total + terms > 0, F.call_function("div", wide, by) + 1).otherwise(1).cast("bigint")


def _far(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q), whole numbers throughout."""
    return F.call_function("div", (p - q) * (p - q), q)


# --- a cell of the cube ---------------------------------------------------------------------

PARTS = pa.schema(
    [
        ("lang", pa.string()),
        ("source", pa.string()),
        ("item", pa.string()),
        ("value", pa.int64()),
        ("seen", pa.int64()),
        ("p", pa.int64()),
        ("q", pa.int64()),
    ]
)
PARTS_SQL = "lang string, source string, item string, value bigint, seen bigint, p bigint, q bigint"


def cell_sums(cell: pa.Table) -> pa.Table:
    """Partial sums of all pairs of sources of a cell, in both directions.

    Rows (lang, low, high, side, source, term, p): one without a term for each source, with the
    share of a term it lacks, and one for each term it has.
    """
    lang, low, high = cell["lang"][0].as_py(), cell["low"][0].as_py(), cell["high"][0].as_py()
    heads = cell.filter(pc.is_null(cell["term"]))
    names, sides = heads["source"].to_pylist(), heads["side"].to_pylist()
    absent = heads["p"].to_numpy().astype(np.int64)
    counts = cell.filter(pc.is_valid(cell["term"]))
    terms = counts["term"].combine_chunks().dictionary_encode() if counts.num_rows else None
    n_terms = len(terms.dictionary) if terms is not None else 0
    shares = np.repeat(absent[:, None], n_terms, axis=1)
    if n_terms:
        place = pc.index_in(counts["source"], value_set=pa.array(names, pa.string()))
        shares[place.to_numpy(), terms.indices.to_numpy()] = counts["p"].to_numpy()
    sides = np.array(sides)
    lefts, rights = np.flatnonzero(sides == low), np.flatnonzero(sides == high)
    out: list[tuple] = []

    def add(a: int, others: np.ndarray) -> None:
        gap = shares[others] - shares[a]
        gap *= gap
        for q, value in zip(others.tolist(), (gap // shares[others]).sum(axis=1).tolist()):
            out.append((lang, names[a], names[q], value, n_terms, int(absent[a]), int(absent[q])))

    for a in lefts.tolist():
        add(a, rights[rights != a])
    if low != high:
        for a in rights.tolist():
            add(a, lefts)
    columns = zip(*out) if out else [[] for _ in PARTS]
    return pa.Table.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, PARTS)], schema=PARTS)


def _blocks(name: str, count: Column, of: int) -> Column:
    """The block of a value of the column, of as many as ``count`` values need."""
    return F.pmod(F.xxhash64(name), F.ceil(F.greatest(count, F.lit(1)) / of)).cast("int")


def source_audit(
    docs: DataFrame,
    least_docs: int = LEAST_DOCS,
    top: int = TOP,
    source_block: int = SOURCE_BLOCK,
    term_block: int = TERM_BLOCK,
) -> DataFrame:
    """``lang, source, part, item, value, rank``: the sources of a language by divergence from
    each source, and the terms that mark a source against its language."""
    counts = stored(term_counts(docs), "audit-counts")
    spread = Window.partitionBy("lang", "term")
    kept = (
        counts.where("term is not null")
        .withColumns({"all_docs": F.sum("docs").over(spread), "all_n": F.sum("n").over(spread)})
        .where(F.col("all_docs") >= least_docs)
        .select("lang", "source", "term", "n", "all_n")
    )
    kept = stored(kept, "audit-kept")
    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    occurring = counts.where("term is null").select("lang", "source")
    groups = occurring.join(sums, ["lang", "source"], "left").na.fill(0, ["total"])
    # V is the number of kept terms of a language; each is counted where its row has the least source.
    lead = kept.groupBy("lang", "term").agg(F.lit(1).alias("one")).groupBy("lang").agg(F.count("*").alias("terms"))
    langs = groups.groupBy("lang").agg(F.count("*").alias("sources"), F.sum("total").alias("lang_total"))
    langs = stored(langs.join(lead, "lang", "left").na.fill(0, ["terms"]), "audit-langs")
    absent = _share(F.lit(0), F.col("total"), F.col("terms"))
    groups = groups.join(langs, "lang").withColumns(
        {"p0": absent, "block": _blocks("source", F.col("sources"), source_block), "blocks": F.ceil(F.greatest("sources", F.lit(1)) / source_block)}
    )
    groups = stored(groups, "audit-groups")
    own = groups.select("lang", "source", "total", "terms", "lang_total", "block", "blocks")
    shared = kept.join(own, ["lang", "source"]).withColumn("p", _share(F.col("n"), F.col("total"), F.col("terms")))

    # Terms that mark a source.
    q = _share(F.col("all_n"), F.col("lang_total"), F.col("terms"))
    marks = shared.withColumn("q", q).where("p > q")
    best = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item"))
    marks = marks.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _far(F.col("p"), F.col("q")).alias("value"))
    marks = marks.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)

    # Each slice goes to the cells of its source block with every other one.
    other = F.explode(F.sequence(F.lit(0), F.col("blocks").cast("int") - 1))
    cut = lambda df: df.withColumn("other", other).select(
        "lang",
        F.least("block", "other").alias("low"),
        F.greatest("block", "other").alias("high"),
        "slab",
        F.col("block").alias("side"),
        "source",
        "term",
        "p",
    )
    slabs = F.ceil(F.greatest("terms", F.lit(1)) / term_block).cast("int")
    heads = groups.select("lang", "source", F.lit(None).cast("string").alias("term"), F.col("p0").alias("p"), "block", "blocks", F.explode(F.sequence(F.lit(0), slabs - 1)).alias("slab"))
    slices = shared.withColumn("slab", _blocks("term", F.col("terms"), term_block))
    cells = cut(slices).unionByName(cut(heads)).groupBy("lang", "low", "high", "slab")
    partial = cells.applyInArrow(cell_sums, PARTS_SQL)

    # Along the term axis; what no cell saw is the same for every such term.
    rest = (F.col("terms") - F.col("seen")) * _far(F.col("p"), F.col("q"))
    value = F.when(F.col("terms") > 0, F.col("value") + rest).otherwise(0).cast("bigint")
    pairs = (
        partial.groupBy("lang", "source", "item", "p", "q")
        .agg(F.sum("value").alias("value"), F.sum("seen").alias("seen"))
        .join(langs.select("lang", "terms"), "lang")
        .select("lang", "source", F.lit("pair").alias("part"), "item", value.alias("value"))
    )
    pairs = pairs.withColumn("rank", F.row_number().over(best))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.select(*columns).unionByName(marks.select(*columns))


def op12_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of sources from each other, and the terms that mark them."""
    return source_audit(table(spark, sf_dir, "documents"))


SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(coalesce(text, ''), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS found FROM documents
), w AS (
  SELECT row, lang, source, translate(unnest(found), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d
), kept AS (
  SELECT lang, term, count(*)::HUGEINT AS n FROM w GROUP BY ALL HAVING count(DISTINCT row) >= {LEAST_DOCS}
), counted AS (
  SELECT lang, source, term, count(*)::HUGEINT AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL
), v AS (
  SELECT lang, count(*)::HUGEINT AS terms, sum(n)::HUGEINT AS total FROM kept GROUP BY ALL
), g AS (
  SELECT DISTINCT lang, source FROM d
), t AS (
  SELECT lang, source, coalesce(sum(n), 0)::HUGEINT AS total FROM g LEFT JOIN counted USING (lang, source) GROUP BY ALL
), p AS (
  SELECT t.lang, t.source, k.term, coalesce(c.n, 0) AS n, 1 + {SCALE}::HUGEINT * (coalesce(c.n, 0) + 1) // (t.total + v.terms) AS p,
         1 + {SCALE}::HUGEINT * (k.n + 1) // (v.total + v.terms) AS q
  FROM t JOIN kept k USING (lang) JOIN v USING (lang) LEFT JOIN counted c ON c.lang = t.lang AND c.source = t.source AND c.term = k.term
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), rows AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL
  SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // q)::BIGINT AS value FROM p WHERE n > 0 AND p > q
)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item))::INT AS rank FROM rows)
WHERE part = 'pair' OR rank <= {TOP}
"""
