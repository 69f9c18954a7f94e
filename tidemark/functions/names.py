"""Dataset names taken from addresses and paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the text between the last slash and the last dot.
NAME_PATTERN = r"([^/]*)\.[^./]*$"


def dataset_name(url: Column) -> Column:
    """Last path segment without its extension; empty if it has no dot."""
    return F.regexp_extract(url, NAME_PATTERN, 1)


def with_suffix(name: Column, suffix: str = ".csv") -> Column:
    return F.concat(name, F.lit(suffix))


def dataset_of_file(file_name: Column) -> Column:
    """Dataset of a scanned row, from ``_metadata.file_name`` (``NAME.csv``, URL-encoded)."""
    # url_decode reads "+" as a space, but in a file name it stands for itself.
    return dataset_name(F.url_decode(F.replace(file_name, F.lit("+"), F.lit("%2B"))))
