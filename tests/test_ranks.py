"""Ranks and prefixes in any order against Python's sort."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import prefix_rows_by, prefixes_by, rank_bounds, with_row_address

SCHEMA = "s string, t timestamp, x double, id bigint"


def rows_of(rng, n):
    start = datetime(2024, 3, 1)
    words = [None, "", "a", "b", "é", "日本", "zz", "common"]
    return [
        (rng.choice([*words, *["common"] * 8]), rng.choice([None, start + timedelta(microseconds=rng.randint(0, 50) * 10**9)]), rng.choice([None, 0.5, -1.0, float(rng.randint(0, 9))]), i)
        for i in range(n)
    ]


def key_of(row, order):
    names = ["s", "t", "x", "id"]
    out = []
    for name in order:
        value = row[names.index(name)]
        out.append((value is not None, value.encode() if isinstance(value, str) else value if value is not None else 0))
    return out


@pytest.mark.parametrize("order", [["s", "id"], ["t", "s", "id"], ["x", "t", "id"], ["id"]])
def test_bounds_equal_a_sort(spark, order):
    rng = random.Random(2)
    rows = rows_of(rng, 3000)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    ordered = sorted(rows, key=lambda r: key_of(r, order))
    ranks = [1, 2, 700, 701, 1500, 2999, 3000]
    got = {r.rank: r.bound.id for r in rank_bounds(df, order, ranks, splitters=16, numbered=40).collect()}
    assert got == {rank: ordered[rank - 1][3] for rank in ranks}


def test_prefixes_equal_a_sort(spark):
    rows = rows_of(random.Random(4), 500)
    df = spark.createDataFrame(rows, SCHEMA)
    order = ["s", "t", "x", "id"]
    ordered = [r[3] for r in sorted(rows, key=lambda r: key_of(r, order))]
    fractions = [(0, 1), (1, 7), (1, 2), (99, 100), (1, 1)]
    for (num, den), prefix in zip(fractions, prefixes_by(df, order, fractions)):
        assert sorted(r.id for r in prefix.collect()) == sorted(ordered[: round(500 * num / den)])
    # A bound that is null in its first column.
    nulls = sum(r[0] is None for r in rows)
    assert nulls > 10
    few = prefix_rows_by(df, nulls - 5, 500, order)
    assert sorted(r.id for r in few.collect()) == sorted(ordered[: nulls - 5])


def test_rows_that_are_not_told_apart(spark, tmp_path):
    df = spark.createDataFrame([("a",)] * 30 + [("b",)] * 30, "s string")
    with pytest.raises(ValueError, match="apart"):
        rank_bounds(df, ["s"], [7])
    with pytest.raises(ValueError, match="apart"):
        rank_bounds(df, ["s"], [7], splitters=4, numbered=5)
    # Between a and b nothing is left to chance.
    assert rank_bounds(df, ["s"], [30]).first().bound.s == "a"
    with pytest.raises(ValueError):
        rank_bounds(df, ["s"], [61])
    # The address of a row breaks every tie.
    df.repartition(3).write.parquet(str(tmp_path / "t"))
    addressed = with_row_address(spark.read.parquet(str(tmp_path / "t")))
    for size in (7, 30, 45):
        prefix = prefix_rows_by(addressed, size, 60, ["s", "scan_file", "scan_place"])
        assert prefix.count() == size and prefix.filter("s = 'b'").count() == max(0, size - 30)


def test_rows_are_counted_not_shuffled(spark, tmp_path):
    spark.range(60_000).select(F.concat(F.lit("k"), F.xxhash64("id").cast("string")).alias("k")).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    bound = rank_bounds(df, ["k"], [30_000], splitters=100, numbered=2000).first().bound.k
    assert df.filter(F.col("k") <= bound).count() == 30_000
    # The filter on the first column reaches the scan.
    plan = prefix_rows_by(df, 1, 2, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan.split("Subquery")[0] and "DataFilters: [(isnull(k" in plan
