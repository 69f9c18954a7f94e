"""Grids kept as blocks, and nested grids in any dimension order, against numpy."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import cut_into_blocks, flatten_blocks, flatten_grid
from tidemark.plans import ingest_blocks
from tidemark.sources import read_measurements



def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


SCHEMA = "dataset string, variable string, origin array<bigint>, shape array<bigint>, values array<double>, extra int"


def cuts(rng, n):
    """The edges of a random cut of 0..n."""
    inner = sorted(rng.sample(range(1, n), rng.randint(0, min(3, n - 1)))) if n > 1 else []
    return list(itertools.pairwise([0, *inner, n]))


def blocks_of(rng, dataset, variable, array):
    rows = []
    for box in itertools.product(*[cuts(rng, n) for n in array.shape]):
        part = array[tuple(slice(a, b) for a, b in box)]
        rows.append((dataset, variable, [a for a, _ in box], list(part.shape), part.ravel().tolist(), 7))
    return rows


DIMS = {"time": "times", "depth": None, "site": "sites"}
VARIABLES = {
    "heat": ("site", "time", "depth"),
    "salt": ("time", "depth", "site"),
    "mean": ("depth", "time"),
    "level": ("time",),
    "code": (),
}


def expected(dataset, arrays):
    out = []
    for t, d, s in itertools.product(*[range(n) for n in arrays["salt"].shape]):
        out.append(
            (
                dataset, arrays["times"][t], d, arrays["sites"][s], arrays["heat"][s, t, d], arrays["salt"][t, d, s],
                arrays["mean"][d, t], arrays["level"][t], float(arrays["code"]),
            )
        )
    return out


def make(rng, dataset, t, d, s):
    numbers = np.random.default_rng(rng.randint(0, 10**6))
    arrays = {
        "heat": numbers.random((s, t, d)),
        "salt": numbers.random((t, d, s)),
        "mean": numbers.random((d, t)),
        "level": numbers.random(t),
        "times": numbers.random(t),
        "sites": numbers.random(s),
        "code": np.array(float(t)),
    }
    rows = [row for name, a in arrays.items() for row in blocks_of(rng, dataset, name, a)]
    return rows, expected(dataset, arrays)


@pytest.mark.parametrize("seed", range(2))
def test_blocks_equal_numpy(spark, seed):
    rng = random.Random(seed)
    made = [make(rng, f"d{i}", *shape) for i, shape in enumerate([(5, 4, 3), (1, 1, 1), (7, 2, 6)])]
    rows = [r for rows, _ in made for r in rows] + [("d0", "unused", [0], [1], [9.0], 7)]
    rng.shuffle(rows)
    flat = flatten_blocks(spark.createDataFrame(rows, SCHEMA), DIMS, VARIABLES)
    assert flat.columns == ["dataset", *DIMS, *VARIABLES]
    assert sorted(map(tuple, flat.collect())) == sorted(r for _, out in made for r in out)


def test_points_that_no_block_holds_are_null(spark):
    rng = random.Random(5)
    rows, out = make(rng, "d", 4, 3, 2)
    kept = [r for r in rows if not (r[1] in ("salt", "mean") and r[2][0] == 0)]
    other, whole = make(rng, "e", 2, 2, 2)
    flat = flatten_blocks(spark.createDataFrame(kept + other, SCHEMA), DIMS, VARIABLES)
    got = {tuple(r)[:4]: tuple(r)[4:] for r in flat.collect()}
    assert len(got) == len(out) + len(whole)
    gone = {name: [r for r in rows if r[1] == name and r not in kept] for name in ("salt", "mean")}
    assert gone["salt"]
    nulls = sum(int(np.prod(r[3])) for r in gone["salt"])
    assert sum(v[1] is None for v in got.values()) == nulls
    for row in out:
        found = got[tuple(row[:4])]
        assert all(a in (b, None) for a, b in zip(found, row[4:]))
    # No block at all of the variables with every dimension: the grid is still whole.
    few = [r for r in rows if r[1] not in ("salt", "heat")]
    flat = flatten_blocks(spark.createDataFrame(few, SCHEMA), DIMS, VARIABLES)
    assert flat.count() == len(out) and flat.filter("heat is not null or salt is not null").count() == 0


def test_blocks_that_do_not_fill_their_shape_are_refused(spark):
    df = spark.createDataFrame([("d", "v", [0], [3], [1.0, 2.0], 1)], SCHEMA)
    with pytest.raises(Exception, match="fill its shape"):
        flatten_blocks(df, {"x": None}, {"v": ("x",)}).collect()
    with pytest.raises(ValueError):
        flatten_blocks(df, {"x": None}, {"v": ("x", "x")})
    with pytest.raises(ValueError):
        flatten_blocks(df, {"x": None}, {"v": ("y",)})


def test_no_blocks_give_no_rows(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert flatten_blocks(df, DIMS, VARIABLES).collect() == []


def test_one_dataset_is_flattened_by_many_tasks(spark):
    # 64 blocks of one dataset, in boxes that agree: points are not shuffled.
    rows = [("d", v, [8 * i], [8], [float(i)] * 8, 0) for i in range(64) for v in ("a", "b")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(8)
    single = flatten_blocks(df, {"x": None}, {"a": ("x",)})
    assert plan_text(single).count("Exchange") == plan_text(df).count("Exchange")
    assert single.groupBy(F.spark_partition_id()).count().count() == 8
    both = flatten_blocks(df, {"x": None}, {"a": ("x",), "b": ("x",)})
    assert sorted(r.x for r in both.filter("a = b").collect()) == list(range(512))


def test_cut_into_blocks_and_back(spark):
    array = np.arange(5 * 7 * 3, dtype=float).reshape(5, 7, 3)
    df = spark.createDataFrame([("d", array.ravel().tolist())], "dataset string, v array<double>")
    blocks = cut_into_blocks(df, "v", F.col("v"), [5, 7, 3], [2, 3, 3])
    assert blocks.count() == 3 * 3
    for row in blocks.collect():
        box = tuple(slice(o, o + s) for o, s in zip(row.origin, row.shape))
        assert row["values"] == array[box].ravel().tolist()
    flat = flatten_blocks(blocks, {"a": None, "b": None, "c": None}, {"v": ("a", "b", "c")})
    assert sorted(map(tuple, flat.collect())) == sorted(("d", *i, x) for i, x in np.ndenumerate(array))


def test_blocks_are_written_in_grid_order(spark, tmp_path):
    array = np.arange(24, dtype=float).reshape(4, 6)
    df = spark.createDataFrame([("d", array.T.ravel().tolist())], "dataset string, v array<double>")
    blocks = cut_into_blocks(df, "v", F.col("v"), [6, 4], [4, 3])
    ingest_blocks(blocks, {"row": None, "column": None}, {"v": ("column", "row")}, str(tmp_path))
    files = sorted((tmp_path / "dataset=d").glob("part-*.csv"))
    values = [float(line.split(",")[2]) for f in files for line in f.read_text().splitlines()[1:]]
    assert values == list(range(24))
    assert read_measurements(spark, [str(tmp_path)], base_path=str(tmp_path)).count() == 24


def test_nested_grid_in_another_dimension_order(spark):
    array = np.arange(2 * 3 * 4, dtype=float).reshape(2, 3, 4)
    dims = {"a": None, "b": None, "c": None}
    names = "abc"
    for own in itertools.permutations(range(3)):
        nested = array.transpose(own).tolist()
        df = spark.createDataFrame([(nested, [1.0, 2.0, 3.0])], "v array<array<array<double>>>, w array<double>")
        flat = flatten_grid(df, dims, {"v": tuple(names[i] for i in own), "w": ("b",)})
        assert sorted(map(tuple, flat.collect())) == sorted((*i, x, i[1] + 1.0) for i, x in np.ndenumerate(array))


def test_turned_grids_with_empty_and_null_arrays(spark):
    rows = [([],), (None,), ([[]],), ([[1.0, 2.0], [3.0]],)]
    df = spark.createDataFrame(rows, "v array<array<double>>")
    flat = flatten_grid(df, {"row": None, "column": None}, {"v": ("column", "row")})
    assert sorted(map(tuple, flat.collect()), key=repr) == [(0, 0, 1.0), (0, 1, 3.0), (1, 0, 2.0), (1, 1, None)]
