"""Mixing sources to target weights by entropy balancing. DataFrame expressions only.

Document d is taken at a rate r_d between 0 and a ceiling. Of all rates that give each source its
target number of words, those are wanted that stay nearest to taking every document once, by
the sum of r log r - r + 1 over the documents. The dual of this problem is convex; it has one
multiplier for each constraint, and the rates are r_d = min(ceiling, exp(lambda_s * size_d)): where a
source must give more words than it has, longer documents are taken more often than short ones.
``entropy_multipliers`` finds the multipliers by Newton steps. The gradient and the Hessian of a step
are sums over all documents, by way of the counts of each size, so a step is one aggregation.
All sums are of decimals, and so are the same in any order.

Rates become whole copies without a random draw. The documents of a source are put into
narrow tiers of size, largest first. Each tier is given the number of copies that brings the
words taken so far nearest to what the rates ask for, so that smaller documents make up for
what larger ones could not meet. Inside a tier copies are spread evenly.

Cases. Null or empty text: size 0, nothing taken. Null source: a source of its own, last in
order. Null ids come first. Ties and repeated rows: each row counts; rows with equal ids are told
apart by size and a digest of the text, and rows with equal ids and texts are interchangeable. Empty
table: no rows. Extra columns: ignored. A source that cannot reach its target is taken at
the ceiling.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored, table

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
CEILING = 3
#: Tiers of size: so many for each doubling.
TIERS = 16
NEWTON_STEPS = 80
#: Steps end when every source has its words but for this part.
TOLERANCE = 1e-12
#: Decimals of a multiplier, in units of one over the mean size of the source.
DECIMALS = 9
OFFSET = 0.381966
TIER_POWER = "length(bin(size)) - 1"


def word_count(text: Column) -> Column:
    """The number of runs without ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, ceiling: int = CEILING) -> DataFrame:
    """(source, source_size, target): weights in code point order, repeated, with a ceiling.

    A source stops at ``ceiling`` times its size and the excess goes to the others by weight.
    That has a closed form: with sources sorted by ceiling over weight, the first ones are
    full and all others share what is left, so one pass over the sorted sources finds it.
    """
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    # One row for each source; these windows see no documents.
    order = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    listed = F.array(*[F.lit(float(w)) for w in weights])
    weighted = sums.withColumn("__i", F.row_number().over(order) - 1).withColumn(
        "__w", F.element_at(listed, (F.col("__i") % len(weights) + 1).cast("int"))
    )
    full = F.col("source_size") * ceiling
    rising = Window.orderBy(full / F.col("__w"), "__i")
    every = Window.partitionBy()
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    filled = (
        weighted.withColumn("__total", F.sum("source_size").over(every))
        .withColumn("__used", F.coalesce(F.sum(full).over(before), F.lit(0)))
        .withColumn("__weights", F.sum("__w").over(every) - F.coalesce(F.sum("__w").over(before), F.lit(0.0)))
        .withColumn("__level", (F.col("__total") - F.col("__used")) / F.col("__weights"))
        .withColumn("__fits", full >= F.col("__w") * F.col("__level"))
        # The first source that does not fill up sets the level for all after it.
        .withColumn("__share", F.min(F.when(F.col("__fits"), F.struct(full / F.col("__w"), F.col("__i"), F.col("__level")))).over(every)["__level"])
    )
    target = F.when(F.col("source_size") == 0, 0.0).otherwise(
        F.least(full.cast("double"), F.coalesce(F.col("__w") * F.col("__share"), full.cast("double")))
    )
    return filled.select("source", "source_size", target.alias("target"))


def _rate(scaled: Column, ceiling: int) -> Column:
    """The rate of a document whose size times the multiplier is ``scaled``."""
    # Beyond the ceiling the exponent does not matter, and must not overflow.
    return F.least(F.lit(float(ceiling)), F.exp(F.least(scaled, F.lit(math.log(ceiling) + 1))))


def _exact(value: Column) -> Column:
    """A number whose sums do not depend on the order."""
    return F.round(value, 6).cast("decimal(38,6)")


def entropy_multipliers(sizes: DataFrame, targets: DataFrame, ceiling: int = CEILING, steps: int = NEWTON_STEPS) -> DataFrame:
    """``has, key, unit, theta`` of each source with words: its multiplier times its mean size.

    ``sizes`` counts the documents of each source and size. A step sums, over all of them, what the
    rates give (the gradient of the dual) and how that changes (its Hessian). The dual splits by
    source, and a source's gradient grows with its multiplier, so a Newton step that leaves the
    interval in which the sign changes is replaced by its middle. ``theta`` is null where
    the target cannot be reached below the ceiling. The driver sees how many sources are left.
    """
    keys = ["has", "key"]
    documents = sizes.groupBy(*keys).agg(F.sum("n").alias("docs"))
    state = documents.join(targets, keys).where("source_size > 0 and target > 0")
    none = F.lit(None).cast("double")
    state = state.select(
        *keys, (F.col("source_size") / F.col("docs")).alias("unit"), "target",
        (F.col("target") >= F.col("source_size") * ceiling).alias("full"),
        F.lit(0.0).alias("theta"), none.alias("low"), none.alias("high"), F.lit(False).alias("done"),
    )
    state = stored(state, "mix-state")
    for step in range(steps):
        left = state.where("not full and not done")
        if not left.take(1):
            break
        scaled = F.col("size") / F.col("unit")
        rate = _rate(F.col("theta") * scaled, ceiling)
        given = F.col("n") * F.col("size") * rate
        changes = F.when(rate < ceiling, given * scaled).otherwise(0.0)
        sums = sizes.join(left, keys).groupBy(*keys).agg(F.sum(_exact(given)).alias("given"), F.sum(_exact(changes)).alias("changes"))
        off = F.col("given").cast("double") - F.col("target")
        low = F.when(off < 0, F.col("theta")).otherwise(F.col("low"))
        high = F.when(off > 0, F.col("theta")).otherwise(F.col("high"))
        newton = F.col("theta") - F.try_divide(off, F.col("changes").cast("double"))
        # Without a bound on one side the step may be long, but not longer than this.
        reach = F.lit(2.0**step)
        from_low, to_high = F.coalesce("lo", F.col("theta") - reach), F.coalesce("hi", F.col("theta") + reach)
        inside = (newton > from_low) & (newton < to_high)
        moved = F.when(F.coalesce(inside, F.lit(False)), newton).otherwise((from_low + to_high) / 2)
        settled = (F.abs(off) <= TOLERANCE * F.col("target")) | (F.abs(moved - F.col("theta")) <= 10.0 ** -(DECIMALS + 4))
        stepped = left.join(sums, keys).withColumns({"lo": low, "hi": high, "off": off}).select(
            *keys, "unit", "target", "full",
            F.when(off == 0, F.col("theta")).otherwise(moved).alias("theta"),
            F.col("lo").alias("low"), F.col("hi").alias("high"), settled.alias("done"),
        )
        state = stored(stepped.unionByName(state.where("full or done")), "mix-state")
    return state.select(*keys, "unit", F.when(~F.col("full"), F.round("theta", DECIMALS)).alias("theta"))


def mix_sources(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, ceiling: int = CEILING, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, source, size, source_size, target, rate, copies, taken and the columns ``keep`` for every document."""
    digest = F.md5(F.coalesce("text", F.lit("")).cast("binary"))
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), digest.alias("digest"), *keep)
    sized = sized.withColumns({"has": F.col("source").isNull(), "key": F.coalesce("source", F.lit(""))})
    sized = stored(sized, "mix-sizes")
    keyed = {"has": F.col("source").isNull(), "key": F.coalesce("source", F.lit(""))}
    targets = stored(source_targets(sized, weights, ceiling).withColumns(keyed).drop("source"), "mix-targets")
    sizes = stored(sized.where("size > 0").groupBy("has", "key", "size").agg(F.count("*").alias("n")), "mix-counts")
    solved = stored(entropy_multipliers(sizes, targets, ceiling), "mix-solved")
    rate = F.when(F.col("theta").isNull(), float(ceiling)).otherwise(_rate(F.col("theta") * (F.col("size") / F.col("unit")), ceiling))

    # The power of two below the size, and which of TIERS equal parts of the way to the next.
    power = F.length(F.bin("size")) - 1
    part = F.floor((F.col("size") - F.expr(f"shiftleft(1L, {TIER_POWER})")) * TIERS / F.expr(f"shiftleft(1L, {TIER_POWER})"))
    tier = (power * TIERS + part).cast("int")
    # Documents of a tier are numbered inside chunks: as many chunks as a chunk of all has rows.
    chunks_n = math.isqrt(sized.count()) + 1
    name = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("digest"))
    number = F.conv(F.substring(F.md5(name.cast("binary")), 1, 12), 16, 10)
    chunk = F.pmod(number.cast("bigint"), F.lit(chunks_n)).cast("int")
    placed = sized.where("size > 0").withColumns({"tier": tier, "chunk": chunk})

    # Copies for each tier, largest first, with the error so far carried along.
    keys = ["has", "key", "tier"]
    asked = sizes.join(solved, ["has", "key"]).withColumns({"tier": tier, "due": _exact(F.col("n") * F.col("size") * rate)})
    tiers = asked.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("size")).alias("words"), F.sum("due").cast("double").alias("due"))
    tiers = stored(tiers, "mix-tiers")
    listed = tiers.groupBy("has", "key").agg(F.sort_array(F.collect_list(F.struct("tier", "n", "words", "due")), asc=False).alias("tiers"))
    start = F.struct(F.lit(0.0).alias("due"), F.lit(0.0).alias("got"), F.array().cast("array<struct<tier:int,copies:bigint>>").alias("out"))

    def plan(state: Column, t: Column) -> Column:
        mean = t["words"] / t["n"]
        due = state["due"] + t["due"]
        copies = F.floor((due - state["got"]) / mean + 0.5)
        copies = F.greatest(F.lit(0), F.least(copies, t["n"] * ceiling)).cast("bigint")
        return F.struct(
            due.alias("due"),
            (state["got"] + copies * mean).alias("got"),
            F.concat(state["out"], F.array(F.struct(t["tier"].alias("tier"), copies.alias("copies")))).alias("out"),
        )

    planned = listed.select("has", "key", F.explode(F.aggregate("tiers", start, plan)["out"]).alias("p")).select("has", "key", "p.tier", "p.copies")
    # Where each chunk starts in its tier.
    chunks = stored(placed.groupBy(*keys, "chunk").agg(F.count("*").alias("n")), "mix-chunks")
    earlier = Window.partitionBy(*keys).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        chunks.withColumn("first", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
        .join(tiers.select(*keys, F.col("n").alias("tier_n")), keys)
        .join(planned, keys)
        .select(*keys, "chunk", "first", (F.col("copies") / F.col("tier_n")).alias("per"))
    )
    place = F.row_number().over(Window.partitionBy(*keys, "chunk").orderBy("doc_id", "size", "digest"))
    cum = lambda k: F.floor(k * F.col("per") + OFFSET)
    nth = F.col("first") + F.col("__k")
    columns = ["doc_id", "source", "has", "key", "size", "copies", *keep]
    counted = (
        placed.withColumn("__k", place)
        .join(starts, [*keys, "chunk"])
        .withColumn("copies", F.least(F.lit(ceiling), (cum(nth) - cum(nth - 1)).cast("int")))
        .select(*columns)
    )
    empty = sized.where("size = 0").withColumn("copies", F.lit(0)).select(*columns)
    # A row a source, written, so Spark knows its bytes when it decides how to join it.
    info = stored(targets.join(solved, ["has", "key"], "left"), "mix-info")
    own_rate = F.when(F.col("size") == 0, 0.0).otherwise(rate)
    return (
        counted.unionByName(empty)
        .join(info, ["has", "key"])
        .select("doc_id", "source", "size", "source_size", "target", own_rate.alias("rate"), "copies", (F.col("copies") * F.col("size")).cast("long").alias("taken"), *keep)
    )


def op10_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of each document."""
    mixed = mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


BISECTIONS = 90
SQL = rf"""
WITH d AS (
  SELECT doc_id, source, md5(coalesce(text, '')) AS digest, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [{", ".join(f"{w}::DOUBLE" for w in WEIGHTS)}][((row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % {len(WEIGHTS)} + 1)::INT] AS w
  FROM d GROUP BY source
), l AS (
  SELECT *, source_size * {CEILING} AS most, row_number() OVER (ORDER BY source_size * {CEILING} / w, source IS NULL, encode(source)) AS i FROM s
), f AS (
  SELECT a.*, ((SELECT sum(source_size) FROM l) - coalesce((SELECT sum(most) FROM l b WHERE b.i < a.i), 0))
              / ((SELECT sum(w) FROM l) - coalesce((SELECT sum(w) FROM l b WHERE b.i < a.i), 0)) AS level
  FROM l a
), t AS (
  SELECT source, source_size, CASE WHEN source_size = 0 THEN 0 ELSE least(most::DOUBLE,
    coalesce(w * (SELECT level FROM f g WHERE g.most >= g.w * g.level ORDER BY i LIMIT 1), most::DOUBLE)) END AS target
  FROM f
), h AS (
  SELECT source, size, count(*) AS n FROM d WHERE size > 0 GROUP BY ALL
), b AS (
  SELECT h.source, any_value(target) AS target, any_value(source_size) AS source_size, any_value(source_size) / sum(n) AS unit,
         list({{'z': size / (source_size / docs), 'w': (n * size)::DOUBLE}}) AS sizes
  FROM (SELECT *, sum(n) OVER (PARTITION BY source) AS docs FROM h) h JOIN t ON h.source IS NOT DISTINCT FROM t.source GROUP BY h.source
), m AS (
  SELECT source, unit, CASE WHEN target < source_size * {CEILING} THEN round((list_reduce(
    list_prepend({{'lo': -4000::DOUBLE, 'hi': 4000::DOUBLE}}, list_transform(range({BISECTIONS}), lambda i: {{'lo': 0::DOUBLE, 'hi': 0::DOUBLE}})),
    lambda a, x: CASE WHEN list_sum(list_transform(sizes, lambda e: e.w * least({CEILING}, exp(least((a.lo + a.hi) / 2 * e.z, {math.log(CEILING) + 1}))))) < target
      THEN {{'lo': (a.lo + a.hi) / 2, 'hi': a.hi}} ELSE {{'lo': a.lo, 'hi': (a.lo + a.hi) / 2}} END)).lo, {DECIMALS}) END AS theta
  FROM b
), r AS (
  SELECT h.*, CAST((length(bin(size)) - 1) * {TIERS} + ((size - (1::BIGINT << (length(bin(size)) - 1)::INT)) * {TIERS} // (1::BIGINT << (length(bin(size)) - 1)::INT)) AS INT) AS tier,
         n * size * CASE WHEN theta IS NULL THEN {CEILING} ELSE least({CEILING}, exp(least(theta * (size / unit), {math.log(CEILING) + 1}))) END AS due
  FROM h JOIN m ON h.source IS NOT DISTINCT FROM m.source
), n AS (
  SELECT source, tier, sum(n)::BIGINT AS n, sum(n * size)::BIGINT AS words, sum(CAST(round(due, 6) AS DECIMAL(38, 6)))::DOUBLE AS due FROM r GROUP BY ALL
), p AS (
  SELECT *, CAST((length(bin(size)) - 1) * {TIERS} + ((size - (1::BIGINT << (length(bin(size)) - 1)::INT)) * {TIERS} // (1::BIGINT << (length(bin(size)) - 1)::INT)) AS INT) AS tier,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || digest), 1, 12))::BIGINT % (floor(sqrt((SELECT count(*) FROM d)))::BIGINT + 1) AS chunk
  FROM d WHERE size > 0
), u AS (
  SELECT n.source, {{'tier': 0, 'n': 0::BIGINT, 'words': 0::BIGINT, 'add': 0::DOUBLE, 'due': 0::DOUBLE, 'got': 0::DOUBLE, 'out': [{{'tier': -1, 'copies': 0::BIGINT}}]}} AS start,
         list({{'tier': tier, 'n': n, 'words': words, 'add': due, 'due': 0::DOUBLE, 'got': 0::DOUBLE,
               'out': [{{'tier': -1, 'copies': 0::BIGINT}}]}} ORDER BY tier DESC) AS tiers
  FROM n GROUP BY ALL
), v AS (
  SELECT source, unnest(list_reduce(list_prepend(start, tiers), lambda a, x: {{
    'tier': x.tier, 'n': x.n, 'words': x.words, 'add': x.add, 'due': a.due + x.add,
    'got': a.got + greatest(0, least(floor((a.due + x.add - a.got) / (x.words / x.n) + 0.5), x.n * {CEILING})) * (x.words / x.n),
    'out': a.out || [{{'tier': x.tier, 'copies': greatest(0, least(floor((a.due + x.add - a.got) / (x.words / x.n) + 0.5), x.n * {CEILING}))::BIGINT}}]
  }}).out) AS o FROM u
), q AS (
  SELECT p.doc_id, p.source, p.size, v.o.copies / n.n AS per,
         row_number() OVER (PARTITION BY p.source, p.tier ORDER BY chunk, doc_id NULLS FIRST, size, digest) AS k
  FROM p JOIN n ON p.source IS NOT DISTINCT FROM n.source AND p.tier = n.tier
  JOIN v ON v.source IS NOT DISTINCT FROM p.source AND v.o.tier = p.tier
)
SELECT doc_id, size, source_size, target,
       CAST(least({CEILING}, floor(k * per + {OFFSET}) - floor((k - 1) * per + {OFFSET})) * size AS BIGINT) AS taken
FROM q JOIN t ON q.source IS NOT DISTINCT FROM t.source
UNION ALL
SELECT doc_id, size, source_size, target, 0::BIGINT AS taken FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source WHERE size = 0
"""
