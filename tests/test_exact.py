"""Exact sums against rational arithmetic, and states that are kept."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tidemark.operators import (
    exact_averages,
    file_prefixes,
    measure_state,
    merged_state,
    prefix_averages,
    prefix_state_averages,
)

SCHEMA = "g int, a double, b double"


def numbers(rng, n):
    kinds = [
        lambda: rng.uniform(-1e6, 1e6),
        lambda: rng.choice([1, -1]) * 2.0 ** rng.randint(-1074, 1000) * rng.random(),
        lambda: float(rng.randint(-5, 5)),
        lambda: 0.1,
        lambda: -0.0,
        lambda: rng.choice([5e-324, -5e-324, 2.0**-1022, 65536.0, 1 / 65536, 2.0**16 - 2.0**-36]),
    ]
    return [rng.choice(kinds)() for _ in range(n)]


def exact(values):
    return sum((Fraction(v) for v in values), Fraction(0)) / len(values)


@pytest.mark.parametrize("seed", range(4))
def test_averages_equal_rational_ones(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.randint(0, 3), x, y) for x, y in zip(numbers(rng, 900), numbers(rng, 900))]
    if seed == 3:
        # All but cancels: the plain sum has no right digit left.
        rows = [(0, x, x) for v in numbers(rng, 200) for x in (v, -v)] + [(0, 1e-3, 1e300), (0, 0.0, -1e300)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.g: r for r in exact_averages(measure_state(df, ["a", "b"], ["g"]), ["a", "b"], ["g"]).collect()}
    for g in {r[0] for r in rows}:
        for i, name in ((1, "avg_a"), (2, "avg_b")):
            values = [r[i] for r in rows if r[0] == g]
            assert got[g].rows == len(values)
            right = exact(values)
            # Within two units in the last place of the rational average.
            assert abs(Fraction(got[g][name]) - right) <= 2 * Fraction(math.ulp(float(right)))


def test_any_partitioning_gives_the_same_bits(spark):
    rng = random.Random(8)
    df = spark.createDataFrame([(i, rng.uniform(-1e9, 1e9), rng.random() * 10.0 ** rng.randint(-9, 9)) for i in range(4000)], SCHEMA)
    plain, kept = set(), set()
    for n in (1, 2, 3, 5, 8, 13):
        cut = df.repartition(n)
        plain.add(tuple(cut.agg(F.avg("a"), F.avg("b")).first()))
        kept.add(tuple(exact_averages(measure_state(cut, ["a", "b"]), ["a", "b"]).first()))
    assert len(kept) == 1 and len(plain) > 1
    # States of parts add up to that of the whole.
    halves = [measure_state(df.filter(f"g % 2 = {i}"), ["a", "b"]) for i in range(2)]
    assert tuple(exact_averages(merged_state(halves[0].unionByName(halves[1])), ["a", "b"]).first()) in kept


def test_cells_that_are_no_number(spark):
    df = spark.createDataFrame([("1.5", "x"), ("", "2"), (None, "NaN"), ("3", "4")], "a string, b string")
    row = exact_averages(measure_state(df, ["a", "b"]), ["a", "b"]).first()
    assert (row.rows, row.avg_a) == (4, 2.25) and math.isnan(row.avg_b)
    odd = spark.createDataFrame([(1, math.inf, math.inf), (1, 2.0, -math.inf)], SCHEMA)
    row = exact_averages(measure_state(odd, ["a", "b"]), ["a", "b"]).first()
    assert row.avg_a == math.inf and math.isnan(row.avg_b)
    for rows in ([], [(1, None, None)]):
        row = exact_averages(measure_state(spark.createDataFrame(rows, SCHEMA), ["a", "b"]), ["a", "b"]).collect()
        assert [tuple(r) for r in row] == [(len(rows), None, None)]


def test_prefixes_from_a_state_equal_one_scan(spark):
    rng = random.Random(5)
    rows = [(rng.randint(0, 11), rng.choice([None, float(rng.randint(0, 99))]), rng.random()) for _ in range(700)]
    df = spark.createDataFrame(rows, SCHEMA)
    for files in (12, 3):
        prefixes = file_prefixes(files)
        state = measure_state(df, ["a", "b"], ["g"])
        got = prefix_state_averages(state, prefixes, ["a", "b"], "g").orderBy("fraction_ord").collect()
        right = prefix_averages(df, "g", prefixes, ["a", "b"]).orderBy("fraction_ord").collect()
        assert [tuple(r)[:5] for r in got] == [tuple(r)[:5] for r in right]
        for x, y in zip(got, right):
            assert x.avg_a == pytest.approx(y.avg_a) and x.avg_b == pytest.approx(y.avg_b)
    with pytest.raises(ValueError):
        prefix_state_averages(state, [], ["a"], "g")
    with pytest.raises(ValueError):
        prefix_state_averages(state, file_prefixes(12)[::-1], ["a"], "g")


def longest_method(spark, df):
    """Bytes of the longest method that Spark generates for the plan of ``df``."""
    debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    made = debug.codegenStringSeq(df._jdf.queryExecution().executedPlan())
    return max(made.apply(i)._3().maxMethodCodeSize() for i in range(made.size()))


def test_the_code_of_a_row_is_short_enough_to_be_compiled(spark):
    # The JVM interprets methods of over 8,000 bytes, which made 600,000 rows take over a minute.
    df = spark.createDataFrame([(1, 1.0, 2.0)], SCHEMA)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        state = measure_state(df, ["a", "b"], ["g"])
        assert longest_method(spark, state) < 8000
        assert longest_method(spark, exact_averages(state, ["a", "b"], ["g"])) < 8000
        text = measure_state(df.select(*[df[c].cast("string").alias(c) for c in df.columns]), ["g", "a", "b"])
        assert longest_method(spark, text) < 8000
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def rows_summed(df):
    """Rows that the lowest generator of the plan gave, once ``df`` has run."""
    found, plans = [], [df._jdf.queryExecution().executedPlan()]
    while plans:
        plan = plans.pop()
        if plan.nodeName() == "Generate":
            found.append(plan.metrics().apply("numOutputRows").value())
        children = plan.children()
        plans += [children.apply(i) for i in range(children.size())]
    return found[-1]


def test_a_row_is_summed_once_for_all_measures(spark):
    # It gave a row for each measure, which made 36 million rows 144 million.
    names = ["a", "b", "c", "d"]
    df = spark.range(1000).select(*[(F.col("id") * x).alias(name) for name, x in zip(names, (1.0, 0.01, -3.5, 0.0))])
    odd = spark.createDataFrame([(1e300, 1.0, -1e-300, math.nan), (None, None, 2.0, None)], "a double, b double, c double, d double")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        state = measure_state(df.unionByName(odd), names)
        assert {r.measure: r.n for r in state.groupBy("measure").agg(F.sum("n").alias("n")).collect()} == {"a": 1001, "b": 1001, "c": 1002, "d": 1001}
        state.collect()
        # Three numbers are out of the ordinary and get a row of their own.
        assert rows_summed(state) == 1002 + 3
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_numbers_at_the_edges_of_the_frame(spark):
    rng = random.Random(11)
    edges = [2.0**e for e in (-1074, -1022, -73, -72, -64, -48, -32, -20, -16, 0, 16, 31, 32, 48, 64, 1000)]
    near = [e * f for e in edges for f in (1.0, 1 - 2.0**-53, 1 + 2.0**-52, 1.5)]
    # More measures than are summed side by side.
    names = [f"m{i}" for i in range(6)]
    cells = [None, *near, *[-x for x in near]]
    rows = [(g, *[rng.choice(cells) for _ in names]) for g in range(3) for _ in range(300)]
    df = spark.createDataFrame(rows, "g int, " + ", ".join(f"{m} double" for m in names))
    state = measure_state(df, names, ["g"])
    assert state.groupBy("g", "measure", "place").count().filter("count > 1").isEmpty()
    got = {r.g: r for r in exact_averages(state, names, ["g"]).collect()}
    for g in range(3):
        assert got[g].rows == 300
        for i, name in enumerate(names, 1):
            right = exact([r[i] for r in rows if r[0] == g and r[i] is not None])
            assert abs(Fraction(got[g][f"avg_{name}"]) - right) <= 2 * Fraction(math.ulp(float(right)))
    # Numbers of one size, without any of another.
    for x in (5e-324, 2.0**-48, 2.0**-20, 2.0**32 - 2.0**-21, 2.0**32, 1.5 * 2.0**1000):
        one = spark.createDataFrame([(1, x, -x)], SCHEMA)
        assert tuple(exact_averages(measure_state(one, ["a", "b"]), ["a", "b"]).first()) == (1, x, -x)
