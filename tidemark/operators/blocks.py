"""Gridded datasets, kept as blocks of array variables, to flat rows.

A variable of a dataset lies in blocks, as array stores keep it: each row holds a box of its
points, ``dataset, variable, origin, shape, values``, where ``origin`` is the first point of the
box along each dimension of the variable, ``shape`` its extent, and ``values`` the points with
the last dimension running fastest. Variables may be cut differently, and may list their
dimensions in any order.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from math import prod
from operator import add, mul

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import written_side

SLAB = 1 << 16


def flatten_blocks(
    blocks: DataFrame,
    dims: Mapping[str, str | None],
    variables: Mapping[str, Sequence[str]],
    *,
    dataset: str = "dataset",
    positions: bool = False,
) -> DataFrame:
    """One row per grid point: the dataset, one column per dimension, then the variables.

    ``dims`` names, outermost first, the variable with the coordinates of each dimension, or
    None to number its points from 0. ``variables`` maps each variable to its dimensions, in the
    order in which its values lie. A variable is repeated along the dimensions it lacks. Points
    that no block holds are null. ``positions`` adds ``pos_DIM``, the place along each dimension.

    The place of a value is worked out from its place in the block, by strides, so a dataset
    is unrolled by as many tasks as its blocks are spread over. Blocks that cover the same box
    for all variables are put side by side as arrays, and their points never meet in a shuffle;
    only points of boxes that differ are grouped. Values of fewer dimensions are joined.

    A block whose values do not fill its shape is an error. Of two blocks that hold the same
    point, the larger value counts.
    """
    order = list(dims)
    for name, own in variables.items():
        if len(set(own)) != len(own) or not set(own) <= set(order):
            raise ValueError(f"dimensions of {name} must be different ones of {order}")
    owners = {name: tuple(own) for name, own in variables.items()}
    owners |= {source: (dim,) for dim, source in dims.items() if source and source not in owners}
    full = [name for name, own in owners.items() if len(own) == len(order)]
    lower = [name for name in owners if name not in full]
    held = blocks.filter(F.col("variable").isin(list(owners))).select(
        F.col(dataset).alias("__dataset"), "variable", "origin", "shape", "values"
    )

    sizes = written_side(_grid_sizes(held, order, owners, full), "grid-sizes")
    gaps = sizes.filter(~F.col("__filled")).select("__dataset")
    has_gaps = bool(gaps.take(1))
    points = _full_points(held, order, owners, full, gaps if has_gaps else None)
    if has_gaps:
        every = _every_point(sizes.filter(~F.col("__filled")), order)
        points = points.unionByName(every, allowMissingColumns=True) if points is not None else every
        points = _met(points, order, full)
    elif points is None:
        raise ValueError("no block of the variables")

    by_dims: dict[tuple[str, ...], list[str]] = {}
    for name in lower:
        by_dims.setdefault(tuple(d for d in order if d in owners[name]), []).append(name)
    for own, names in by_dims.items():
        side = [_points(held, name, owners[name]).withColumnRenamed("__value", _value(name)) for name in names]
        merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), side)
        keys = ["__dataset", *[_place(d) for d in own]]
        merged = merged.groupBy(*keys).agg(*[F.max(_value(n)).alias(_value(n)) for n in names])
        points = points.join(written_side(merged, "grid-side"), keys, "left")

    def dim(name: str) -> Column:
        source = dims[name]
        return (F.col(_value(source)) if source else F.col(_place(name))).alias(name)

    return points.select(
        F.col("__dataset").alias(dataset),
        *[dim(d) for d in order],
        *[F.col(_value(name)).alias(name) for name in variables],
        *([F.col(_place(d)).alias(f"pos_{d}") for d in order] if positions else []),
    )


def _value(name: str) -> str:
    return f"__v_{name}"


def _place(dim: str) -> str:
    return f"__pos_{dim}"


def _product(numbers: Sequence[Column]) -> Column:
    return reduce(mul, numbers, F.lit(1).cast("bigint"))


def _sum(numbers: Sequence[Column]) -> Column:
    return reduce(add, numbers, F.lit(0).cast("bigint"))


def _axis(column: str, i: int) -> Column:
    return F.get(column, F.lit(i)).cast("bigint")


def _grid_sizes(
    held: DataFrame, order: Sequence[str], owners: Mapping[str, Sequence[str]], full: Sequence[str]
) -> DataFrame:
    """``__dataset``, the size of each dimension, and whether all points have all full variables.

    Reads no values.
    """

    def end(dim: str) -> Column:
        ends = [
            F.when(F.col("variable") == name, _axis("origin", own.index(dim)) + _axis("shape", own.index(dim)))
            for name, own in owners.items()
            if dim in own
        ]
        if not ends:
            raise ValueError(f"no coordinates and no variable along dimension {dim}")
        return F.coalesce(F.max(F.coalesce(*ends)), F.lit(0)).alias(f"__size_{dim}")

    points = {
        name: F.sum(F.when(F.col("variable") == name, _product([_axis("shape", i) for i in range(len(order))])))
        for name in full
    }
    counted = held.groupBy("__dataset").agg(
        *[end(dim) for dim in order], *[n.alias(f"__n_{name}") for name, n in points.items()]
    )
    total = _product([F.col(f"__size_{dim}") for dim in order])
    filled = [F.coalesce(F.col(f"__n_{name}"), F.lit(0)) >= total for name in full]
    return counted.select(
        "__dataset",
        *[f"__size_{dim}" for dim in order],
        (reduce(lambda a, b: a & b, filled) if filled else F.lit(False)).alias("__filled"),
    )


def _checked(values: str, n_axes: int) -> Column:
    """The values of a block, which must be as many as its shape says."""
    points = _product([_axis("shape", i) for i in range(n_axes)])
    wrong = F.raise_error(F.concat(F.lit("a block does not fill its shape: variable "), "variable"))
    return F.when(F.size(values) == points, F.col(values)).otherwise(wrong)


def _points(held: DataFrame, name: str, own: Sequence[str]) -> DataFrame:
    """``__dataset``, the place along each dimension, and ``__value`` of one variable."""
    box = held.filter(F.col("variable") == name).select(
        "__dataset",
        *[_axis("origin", i).alias(f"__o{i}") for i in range(len(own))],
        *[_axis("shape", i).alias(f"__s{i}") for i in range(len(own))],
        _checked("values", len(own)).alias("__values"),
    )
    return _unrolled(box, own, F.posexplode("__values").alias("__k", "__value"), ["__value"])


def _unrolled(box: DataFrame, axes: Sequence[str], points: Column, keep: Sequence[str]) -> DataFrame:
    """Explodes boxes (``__o*`` first point, ``__s*`` extent) into points with their places."""
    numbers = [f"__{x}{i}" for x in "os" for i in range(len(axes))]
    flat = box.select("__dataset", *numbers, points)
    places = []
    for i, axis in enumerate(axes):
        stride = _product([F.col(f"__s{j}") for j in range(i + 1, len(axes))])
        along = F.call_function("div", F.col("__k"), stride) % F.col(f"__s{i}")
        places.append((F.col(f"__o{i}") + along).alias(_place(axis)))
    return flat.select("__dataset", *places, *keep)


def _in_grid_order(order: Sequence[str], own: Sequence[str]) -> Column:
    """The values of a block with the grid's last dimension running fastest."""
    values = _checked("values", len(own))
    if list(own) == list(order):
        return values
    axis = {d: own.index(d) for d in order}

    def at(k: Column) -> Column:
        terms = []
        for i, d in enumerate(order):
            stride = _product([_axis("shape", axis[e]) for e in order[i + 1 :]])
            along = F.call_function("div", k, stride) % _axis("shape", axis[d])
            terms.append(along * _product([_axis("shape", j) for j in range(axis[d] + 1, len(own))]))
        return F.get("values", _sum(terms).cast("int"))

    # An empty box has no places: a sequence from 0 down to -1 would have two.
    count = F.size(values)
    moved = F.transform(F.sequence(F.lit(0), count - 1), lambda k: at(k.cast("bigint")))
    return F.when(count > 0, moved).otherwise(values)


def _full_points(
    held: DataFrame,
    order: Sequence[str],
    owners: Mapping[str, Sequence[str]],
    full: Sequence[str],
    gaps: DataFrame | None,
) -> DataFrame | None:
    """The points of the variables that have all dimensions.

    Datasets in ``gaps`` come out point by point, to be met with the points that are missing.
    """
    if not full:
        return None

    def boxes(name: str) -> DataFrame:
        own = owners[name]
        return held.filter(F.col("variable") == name).select(
            "__dataset",
            *[_axis("origin", own.index(d)).alias(f"__o{i}") for i, d in enumerate(order)],
            *[_axis("shape", own.index(d)).alias(f"__s{i}") for i, d in enumerate(order)],
            _in_grid_order(order, own).alias(_value(name)),
        )

    names = [_value(name) for name in full]
    numbers = [f"__{x}{i}" for x in "os" for i in range(len(order))]
    if len(full) == 1:
        return _unrolled(boxes(full[0]), order, F.posexplode(names[0]).alias("__k", names[0]), names)
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [boxes(n) for n in full])
    # One row a box, with an array for each variable that has this very box. It is read
    # twice below, and holds arrays, not points.
    beside = every.groupBy("__dataset", *numbers).agg(*[F.max(n).alias(n) for n in names])
    beside = written_side(beside, "grid-boxes")
    whole = reduce(lambda a, b: a & b, [F.col(n).isNotNull() for n in names])
    alone = beside.filter(~whole)
    together = beside.filter(whole)
    if gaps is not None:
        alone = alone.unionByName(together.join(gaps, "__dataset", "left_semi"))
        together = together.join(gaps, "__dataset", "left_anti")
    zipped = _unrolled(together, order, F.posexplode(F.arrays_zip(*names)).alias("__k", "__point"), ["__point"])
    zipped = zipped.select("*", *[F.col(f"__point.{n}").alias(n) for n in names]).drop("__point")
    single = [
        _unrolled(alone.filter(F.col(n).isNotNull()), order, F.posexplode(n).alias("__k", n), [n])
        for n in names
    ]
    apart = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), single)
    return zipped.unionByName(apart if gaps is not None else _met(apart, order, full))


def _met(points: DataFrame, order: Sequence[str], full: Sequence[str]) -> DataFrame:
    """One row per point, with the value of each variable that has it."""
    keys = ["__dataset", *[_place(d) for d in order]]
    if not full:
        return points.select(*keys)
    return points.groupBy(*keys).agg(*[F.max(_value(n)).alias(_value(n)) for n in full])


def _every_point(sizes: DataFrame, order: Sequence[str]) -> DataFrame:
    """All points of the grids, a slab of them at a time so that a grid is made by many tasks."""
    total = _product([F.col(f"__size_{d}") for d in order])
    slabs = sizes.withColumn("__total", total).filter("__total > 0")
    starts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("__total") - 1, F.lit(SLAB).cast("bigint")))
    slabs = slabs.select("*", starts.alias("__start")).repartition("__dataset", "__start")
    last = F.least(F.col("__start") + SLAB, F.col("__total")) - 1
    points = slabs.select("*", F.explode(F.sequence("__start", last)).alias("__k"))
    places = []
    for i, d in enumerate(order):
        stride = _product([F.col(f"__size_{e}") for e in order[i + 1 :]])
        places.append((F.call_function("div", F.col("__k"), stride) % F.col(f"__size_{d}")).alias(_place(d)))
    return points.select("__dataset", *places)


def cut_into_blocks(
    df: DataFrame,
    variable: str,
    values: Column,
    size: Sequence[int],
    shape: Sequence[int],
    *,
    dataset: str = "dataset",
    origin: Sequence[Column] | None = None,
) -> DataFrame:
    """Blocks of ``shape`` of an array of ``size``, whose ``values`` lie in one flat column.

    Blocks at the far edges are smaller. ``origin`` moves the blocks of a row, for arrays that
    are themselves a part of a larger one.
    """
    counts = [-(-n // s) for n, s in zip(size, shape)]
    start = origin or [F.lit(0)] * len(size)

    def cut(box: Column) -> Column:
        firsts, extents = [], []
        for i, (n, s) in enumerate(zip(size, shape)):
            along = F.call_function("div", box, F.lit(prod(counts[i + 1 :]))) % counts[i]
            firsts.append(along * s)
            extents.append(F.least(F.lit(s), F.lit(n) - along * s).cast("bigint"))

        def at(k: Column) -> Column:
            terms = []
            for i in range(len(size)):
                along = F.call_function("div", k, _product(extents[i + 1 :])) % extents[i]
                terms.append((firsts[i] + along) * prod(size[i + 1 :]))
            return F.get("__values", _sum(terms).cast("int"))

        places = [(F.col(f"__at{i}") + first).cast("bigint") for i, first in enumerate(firsts)]
        return F.struct(
            F.array(*places).alias("origin"),
            F.array(*extents).alias("shape"),
            F.transform(F.sequence(F.lit(0).cast("bigint"), _product(extents) - 1), at).alias("values"),
        )

    rows = df.select(
        dataset, *[o.cast("bigint").alias(f"__at{i}") for i, o in enumerate(start)], values.alias("__values")
    )
    # The blocks are made as one array, so that the row's values are not copied to each of them.
    boxes = F.transform(F.sequence(F.lit(0).cast("bigint"), F.lit(prod(counts) - 1).cast("bigint")), cut)
    return rows.select(dataset, F.lit(variable).alias("variable"), F.inline(boxes))
