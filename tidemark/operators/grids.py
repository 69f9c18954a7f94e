"""Gridded datasets, kept as array columns, to flat rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def flatten_grid(
    df: DataFrame,
    dims: Mapping[str, str | None],
    variables: Mapping[str, Sequence[str]],
    keep: Sequence[str] = (),
    *,
    positions: bool = False,
) -> DataFrame:
    """One row per grid point: ``keep``, one column per dimension, then the variables.

    ``dims`` names, outermost first, the array column with the coordinates of each
    dimension, or None to number its points from 0. ``variables`` maps each variable to
    its dimensions, outermost first: a value for none, an array for one, an array of
    arrays for two. They may stand in another order than in ``dims``; the arrays are then turned
    around first. A variable is repeated along the dimensions it lacks, so the
    output has as many rows as the product of the dimension sizes; choose the
    variables first (``project_variable``) to keep it small. ``positions`` adds ``pos_DIM``,
    the place along each dimension, whose order is that of the grid.

    Dimensions are unrolled one after the other. Each step zips the coordinates with
    all variables led by that dimension and explodes the zip, so the arrays are
    consumed by the step and never copied onto every row.
    """
    order = list(dims)
    for name, own in variables.items():
        if len(set(own)) != len(own) or not set(own) <= set(order):
            raise ValueError(f"dimensions of {name} must be different ones of {order}")

    coordinates = {dim: source for dim, source in dims.items() if source}
    grid = df.select(
        *keep,
        *[F.col(source).alias(f"__at_{dim}") for dim, source in coordinates.items()],
        *[
            _turned(F.col(name), own, [d for d in order if d in own]).alias(f"__v_{name}")
            for name, own in variables.items()
        ],
    )
    left = {name: [d for d in order if d in own] for name, own in variables.items()}
    done: list[str] = []
    for dim in order:
        leading = [name for name, own in left.items() if own and own[0] == dim]
        zipped = [f"__v_{name}" for name in leading]
        if dim in coordinates:
            zipped.append(f"__at_{dim}")
        if not zipped:
            raise ValueError(f"no coordinates and no variable start with dimension {dim}")
        others = [c for c in grid.columns if c not in zipped]
        # A zip with a null is null as a whole; an empty array leaves the others' points.
        grid = grid.withColumns(
            {c: F.coalesce(c, F.array().cast(grid.schema[c].dataType)) for c in zipped}
        ).select(
            *others, F.posexplode(F.arrays_zip(*zipped)).alias(f"__pos_{dim}", "__point")
        )
        where = F.col(f"__point.__at_{dim}") if dim in coordinates else F.col(f"__pos_{dim}")
        grid = grid.select(
            *others,
            where.alias(f"__dim_{dim}"),
            *([F.col(f"__pos_{dim}").alias(f"__place_{dim}")] if positions else []),
            *[F.col(f"__point.__v_{name}").alias(f"__v_{name}") for name in leading],
        )
        for name in leading:
            left[name].pop(0)
        done.append(dim)
    return grid.select(
        *keep,
        *[F.col(f"__dim_{dim}").alias(dim) for dim in done],
        *[F.col(f"__v_{name}").alias(name) for name in variables],
        *([F.col(f"__place_{dim}").alias(f"pos_{dim}") for dim in done] if positions else []),
    )


def _turned(value: Column, own: Sequence[str], order: Sequence[str]) -> Column:
    """Nested arrays over the dimensions ``own``, nested in ``order`` instead.

    The extent of a dimension is that of its first array; points that a ragged array lacks
    are null.
    """
    if list(own) == list(order):
        return value
    extent, first = {}, value
    for dim in own:
        extent[dim] = F.size(first)
        first = F.get(first, F.lit(0))

    def build(left: Sequence[str], places: Mapping[str, Column]) -> Column:
        if not left:
            found = value
            for dim in own:
                found = F.get(found, places[dim])
            return found
        dim, size = left[0], extent[left[0]]
        # A sequence has one place at least, which an empty dimension has not.
        every = F.sequence(F.lit(0), F.greatest(size, F.lit(1)) - 1)
        return F.slice(F.transform(every, lambda i: build(left[1:], {**places, dim: i})), F.lit(1), size)

    return build(list(order), {})


def project_variable(
    df: DataFrame,
    dims: Mapping[str, str | None],
    variables: Mapping[str, Sequence[str]],
    name: str,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One variable with its own dimensions; nothing else is read or unrolled."""
    own = variables[name]
    return flatten_grid(df, {d: dims[d] for d in dims if d in own}, {name: own}, keep)
