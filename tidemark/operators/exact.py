"""Sums of doubles that do not depend on the order of the rows, and states that add up.

A double is a whole number of up to 53 bits times a power of two. It is taken apart into limbs of
16 bits that stand at fixed places, and each limb is summed as a whole number; such sums are exact,
so any partitioning gives the same, down to the last bit, once they are put together again.
The limb sums are a state: states of parts of the data add up to that of the whole.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import as_measure
from tidemark.operators.prefix import Prefix

BITS = 16
BASE = float(1 << BITS)
#: A double covers so many limbs, the highest of which gives its group.
LIMBS = [f"limb{j}" for j in range(5)]
TOP = len(LIMBS) - 1
#: Measures that are summed side by side.
WIDTH = 4
#: Numbers are summed in parts of 26 bits, which leaves room for 2 ** 37 rows, in a frame of four parts:
#: from 2 ** 32 down to 2 ** -72. Its limbs stand at two places.
PART_BITS = 26
PARTS = 4
FRAME = 1
BELOW = -1
TOO_LARGE = 2.0**32
#: The last bit of a number that is no smaller lies in the frame.
TOO_SMALL = 2.0**-20
#: The lowest limb of the frame, and the bit of it at which the frame begins.
LOWEST, BEGIN = -5, 8
#: Limbs of a total that are put together; the others are far below its last bit.
LEADING = 8
STATE = ["rows", "n", "odd", *LIMBS]
STATE_SCHEMA = "measure string, place int, rows bigint, n bigint, odd double, " + ", ".join(f"{x} bigint" for x in LIMBS)


def _power(places: Column) -> Column:
    """The square root of the limb base to the power of ``places``; exact."""
    return F.pow(F.lit(2.0), places * (BITS // 2))


def _scaled(x: Column, places: Column) -> Column:
    """``x`` moved by so many limbs. Half of the way at a time, which neither over- nor underflows."""
    return x * _power(places) * _power(places)


def _outside(x: str) -> str:
    """Whether the number ``x`` does not fit the frame; also what is no finite number."""
    return f"(abs({x}) >= {TOO_LARGE!r}D OR abs({x}) < {TOO_SMALL!r}D AND {x} <> 0)"


def _limbs(parts: Sequence[str]) -> list[str]:
    """The limbs of the frame, lowest first, from the sums of its parts."""
    limbs: list[list[str]] = [[] for _ in range(FRAME - LOWEST + 1)]
    for i, part in enumerate(parts):
        j, bits = divmod(BEGIN + i * PART_BITS, BITS)
        limbs[j].append(f"shiftleft({part} & {(1 << BITS - bits) - 1}, {bits})")
        limbs[j + 1].append(f"shiftright({part}, {BITS - bits})")
    return [" + ".join(limb) or "0L" for limb in limbs]


def _state_struct(measure: int | str, place: str, rows: str, n: str, odd: str, limbs: Sequence[str]) -> str:
    values = zip(["__measure", "place", *STATE], [str(measure), place, rows, n, odd, *limbs])
    return f"named_struct({', '.join(f"'{name}', {value}" for name, value in values)})"


def measure_state(df: DataFrame, measures: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """``keys, measure, place, rows, n, odd, limb0..limb4``: the exact sums of each measure.

    ``rows`` counts rows and ``n`` those with a number; both are split over the places. ``odd`` is
    the sum of what is no finite number. Combined before the shuffle, to a few rows for each
    measure and key.

    A row is summed as it is, once for each ``WIDTH`` measures, for numbers that lie in the frame. Each other
    number in it gets a row of its own, a cell, and is moved into the frame by whole places.
    """
    xs = [f"__x{i}" for i in range(len(measures))]
    groups = [range(i, min(i + WIDTH, len(xs))) for i in range(0, len(xs), WIDTH)]
    first = len(groups)  # The cell of the first measure; those before are the groups.
    ys = [f"__y{j}" for j in range(min(WIDTH, len(xs)))]

    def select(df: DataFrame, *columns: str) -> DataFrame:
        return df.select(*keys, *[F.expr(c) for c in columns])

    # Each step is a projection of its own: as one expression the earlier ones would be written out
    # again for every use, and the code of a row would be too long for the JVM to compile.
    numbers = df.select(*keys, *[as_measure(m).alias(x) for m, x in zip(measures, xs)])
    flags = [f"__outside{i}" for i in range(len(xs))]
    numbers = select(numbers, *xs, *[f"coalesce({_outside(x)}, false) AS {flag}" for x, flag in zip(xs, flags)])
    usual = ", ".join(str(i) for i in range(first))
    others = ", ".join(f"CASE WHEN {flag} THEN {first + i} ELSE -1 END" for i, flag in enumerate(flags))
    chosen = f"CASE WHEN {' OR '.join(flags)} THEN array_remove(array({usual}, {others}), -1) ELSE array({usual}) END"
    cells = select(numbers, *xs, *flags, f"explode({chosen}) AS __cell")
    own = " ".join(f"WHEN {first + i} THEN {x}" for i, x in enumerate(xs))
    members = [
        [f"{'' if first == 1 else f'__cell = {i} AND '}NOT {flags[g[j]]} THEN {xs[g[j]]}" for i, g in enumerate(groups) if j < len(g)]
        for j in range(len(ys))
    ]
    cells = select(cells, "__cell", f"CASE __cell {own} END AS __x", *[f"CASE WHEN {' WHEN '.join(m)} END AS {y}" for m, y in zip(members, ys)])
    place = f"CAST(floor(log2(abs(__x)) / {BITS}) AS INT)"
    cells = select(
        cells, "__cell", "__x", *ys,
        # Any place near the highest bit will do, but for those of the frame.
        f"""CASE WHEN __cell < {first} THEN {FRAME} WHEN NOT abs(__x) < DOUBLE('Infinity') THEN NULL
            WHEN abs(__x) < 1 THEN least({place}, {BELOW - 1}) ELSE greatest({place}, {FRAME + 1}) END AS place""",
    )
    # Half of the way at a time, which neither over- nor underflows.
    half = f"pow(2D, ({FRAME} - place) * {BITS // 2})"
    cells = select(
        cells, "__cell", "place", f"CASE WHEN __cell >= {first} AND place IS NULL THEN __x END AS __odd",
        f"CASE WHEN __cell < {first} THEN {ys[0]} WHEN place IS NOT NULL THEN __x * {half} * {half} END AS {ys[0]}", *ys[1:],
    )
    # Two whole numbers of two parts each, the lower one of what is left of the other, so that no step rounds.
    kept, unit, scale = ["__cell", "place", "__odd", *ys], f"{2.0 ** (2 * PART_BITS) / TOO_LARGE!r}D", f"{2.0 ** (2 * PART_BITS)!r}D"
    cells = select(cells, *kept, *[f"coalesce({y}, 0D) * {unit} AS {y}_all" for y in ys])
    cells = select(cells, *kept, *[f"{y}_all" for y in ys], *[f"rint({y}_all) AS {y}_top" for y in ys])
    wholes = [f"floor({x}) AS {y}_{i}" for y in ys for i, x in enumerate([f"({y}_all - {y}_top) * {scale}", f"{y}_top"])]
    cells = select(cells, *kept, *wholes)
    whole_parts = lambda x: [f"{x} & {(1 << PART_BITS) - 1}", f"shiftright({x}, {PART_BITS})"]
    parts = [f"sum({part}) AS {y}_part{i}" for y in ys for i, part in enumerate([*whole_parts(f"{y}_0"), *whole_parts(f"{y}_1")])]
    counts = ["count(*) AS __rows", "count(__odd) AS __odds", "sum(__odd) AS odd", *[f"count({y}) AS {y}_n" for y in ys]]
    sums = cells.groupBy(*keys, "__cell", "place").agg(*[F.expr(c) for c in (*counts, *parts)])

    # The limbs of the frame that do not stand at its place, the lowest ones, stand at another.
    limbs = {y: _limbs([f"{y}_part{i}" for i in range(PARTS)]) for y in ys}
    top, none, states = slice(-len(LIMBS), None), "CAST(NULL AS DOUBLE)", []
    for group in groups:
        of_group = []
        for i, y in zip(group, ys):
            of_group.append(_state_struct(i, str(FRAME), "__rows", f"{y}_n", none, limbs[y][top]))
            lower = [*limbs[y][: -len(LIMBS)], *["0L"] * len(LIMBS)][: len(LIMBS)]
            of_group.append(_state_struct(i, str(BELOW), "0L", "0L", none, lower))
        states.append(of_group)
    branches = " ".join(f"WHEN __cell = {i} THEN array({', '.join(of_group)})" for i, of_group in enumerate(states))
    moved = _state_struct(f"__cell - {first}", "place", "0L", f"{ys[0]}_n + __odds", "odd", limbs[ys[0]][top])
    names = F.array(*[F.lit(m) for m in measures])
    made = select(sums, f"inline(CASE {branches} ELSE array({moved}) END)")
    return made.select(*keys, F.get(names, F.col("__measure")).alias("measure"), "place", *STATE)


def merged_state(state: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """States added up by ``keys``."""
    return state.groupBy(*keys, "measure", "place").agg(*[F.sum(c).alias(c) for c in STATE])


def _normal(values: Column) -> Column:
    """Limb sums, lowest first, as limbs from 0 to the base, and what is above them."""

    def step(state: Column, value: Column) -> Column:
        whole = value + state["above"]
        low = F.pmod(whole, F.lit(1 << BITS))
        return F.struct(
            F.call_function("div", whole - low, F.lit(1 << BITS)).alias("above"),
            F.concat(F.array(low), state["limbs"]).alias("limbs"),
        )

    start = F.struct(F.lit(0).cast("bigint").alias("above"), F.array().cast("array<bigint>").alias("limbs"))
    return F.aggregate(values, start, step)


def _with_total(df: DataFrame) -> DataFrame:
    """``df`` with ``total``: the double next to the sum of its ``entries`` (place and limbs), 0 for none.

    Always found the same way. What is used more than once is a column of its own, as in ``measure_state``.
    """
    entries, high = F.col("entries"), F.col("__high")
    places = F.transform(entries, lambda e: e["place"])

    def at(i: Column) -> Column:
        def add(total: Column, e: Column) -> Column:
            j = i - e["place"] + TOP
            return total + F.coalesce(F.get(e["limbs"], j), F.lit(0))

        return F.aggregate(entries, F.lit(0).cast("bigint"), add)

    out = df.withColumns({"__low": F.array_min(places) - TOP, "__high": F.array_max(places)})
    out = out.withColumn("__values", F.transform(F.sequence("__low", "__high"), at))
    up, down = _normal(F.col("__values")), _normal(F.transform("__values", lambda v: -v))
    out = out.withColumns({"__up": up, "__down": down})
    negative = F.col("__up")["above"] < 0
    out = out.withColumn("__found", F.when(negative, F.col("__down")).otherwise(F.col("__up")))
    # Highest first; leading zeros go.
    out = out.withColumn("__digits", F.concat(F.array(F.col("__found")["above"]), F.col("__found")["limbs"]))
    out = out.withColumn("__first", F.array_position(F.transform("__digits", lambda d: d != 0), True))
    leading = F.slice("__digits", F.greatest("__first", F.lit(1)).cast("int"), LEADING)
    out = out.withColumn("__leading", leading)
    size = F.aggregate("__leading", F.lit(0.0), lambda total, d: total * BASE + d)
    lowest = high + 1 - (F.greatest("__first", F.lit(1)) - 1) - (F.size("__leading") - 1)
    out = out.withColumns({"__size": size, "__lowest": lowest.cast("double")})
    out = out.withColumn("__value", _scaled(F.col("__size"), F.col("__lowest")))
    value = F.when(F.col("__first") == 0, 0.0).when(negative, -F.col("__value")).otherwise(F.col("__value"))
    return out.select(*df.columns, F.when(F.size("entries") > 0, value).otherwise(0.0).alias("total"))


def exact_averages(state: DataFrame, measures: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """``keys, rows, avg_*`` out of a state: one row a key, or one row in all."""
    merged = merged_state(state, keys)
    limbs = F.struct("place", F.array(*LIMBS).alias("limbs"))
    one = merged.groupBy(*keys, "measure").agg(
        F.sum("rows").alias("rows"),
        F.sum("n").alias("n"),
        F.sum("odd").alias("odd"),
        F.collect_list(F.when(F.col("place").isNotNull(), limbs)).alias("entries"),
    )
    average = F.try_divide(F.coalesce("odd", "total"), F.col("n"))
    averaged = _with_total(one).select(*keys, "measure", "rows", average.alias("average"))
    columns = [F.max(F.when(F.col("measure") == m, F.col("average"))).alias(f"avg_{m}") for m in measures]
    return averaged.groupBy(*keys).agg(F.coalesce(F.max("rows"), F.lit(0)).alias("rows"), *columns)


def prefix_state_averages(
    state: DataFrame, prefixes: Sequence[Prefix], measures: Sequence[str], key: str = "file_ord"
) -> DataFrame:
    """Row count and exact averages of every prefix, from a state per ``key``; no data is read.

    A state goes to the smallest prefix that holds it, and the few sums of a prefix are then
    added to those of all larger ones.
    """
    if not prefixes:
        raise ValueError("no prefixes")
    if any(a.size > b.size for a, b in zip(prefixes, prefixes[1:])):
        raise ValueError("prefixes must ascend in size")
    spark = state.sparkSession
    beyond = [F.col(key) > p.last if p.last is not None else F.lit(True) for p in prefixes]
    smallest = reduce(lambda a, b: a + b, [b.cast("int") for b in beyond])
    own = merged_state(state.withColumn("fraction_ord", smallest).filter(F.col("fraction_ord") < len(prefixes)), ["fraction_ord"])
    spread = own.withColumn("fraction_ord", F.explode(F.sequence("fraction_ord", F.lit(len(prefixes) - 1))))
    averaged = exact_averages(spread, measures, ["fraction_ord"])
    info = [(i, p.num, p.den, p.size) for i, p in enumerate(prefixes)]
    every = spark.createDataFrame(info, "fraction_ord int, num int, den int, size bigint")
    return every.join(averaged, "fraction_ord", "left").na.fill(0, ["rows"])
