"""Whitespace tokens."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: Unicode white space, and the separators U+001C to U+001F.
WHITESPACE = r"(?U)[\s\x1c-\x1f]+"


def word_array(text: Column) -> Column:
    """The words of ``text`` in order; one at either end may be empty."""
    return F.split(text, WHITESPACE)
