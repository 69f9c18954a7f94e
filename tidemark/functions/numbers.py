"""Text cells to numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_measure(name: str, nan_as_null: bool = False) -> Column:
    """Column ``name`` as double; an empty or malformed cell becomes null.

    The text ``NaN`` is a number to Spark and turns every average over it into
    NaN. ``nan_as_null`` leaves such cells out instead.
    """
    value = F.col(name).try_cast("double")
    return F.nanvl(value, F.lit(None).cast("double")) if nan_as_null else value
