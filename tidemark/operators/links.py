"""Links out of pages, tokens out of text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import link_array, word_array


def _unroll(df: DataFrame, values: Column, name: str, *keep: str) -> DataFrame:
    """One row per value that is not null.

    A plain explode makes Spark filter on the size of the array first, which computes
    the array twice; the outer form leaves that out, and the filter behind it drops
    the rows of empty arrays.
    """
    rows = df.select(*keep, F.explode_outer(values).alias(name))
    return rows.filter(F.col(name).isNotNull())


def extract_links(pages: DataFrame, html: str = "html") -> DataFrame:
    """One row ``page_id, link`` per anchor with an ``href``."""
    return _unroll(pages, link_array(F.col(html)), "link", "page_id")


def filter_links(
    links: DataFrame,
    prefix: str = "^https://",
    suffix: str = r"\.nc$",
    column: str = "link",
) -> DataFrame:
    """Links in which both patterns are found."""
    return links.filter(F.col(column).rlike(prefix) & F.col(column).rlike(suffix))


def tokens(text: DataFrame, column: str = "value", name: str = "link") -> DataFrame:
    """One row per whitespace-separated word."""
    return tokens_of(text, word_array(F.col(column)), name)


def tokens_of(text: DataFrame, words: Column, name: str) -> DataFrame:
    return _unroll(text, words, name).filter(F.col(name) != "")


def distinct_tokens(text: DataFrame, column: str = "value", name: str = "link") -> DataFrame:
    """Each whitespace-separated word once; repeats in a text go before it is unrolled."""
    return tokens_of(text, F.array_distinct(word_array(F.col(column))), name).distinct()


def sorted_distinct(df: DataFrame, column: str = "link") -> DataFrame:
    """Each value once, ascending.

    Repeats are removed before the shuffle as well as after it, so that a value which
    makes up much of the table does not weigh on one task; the sort then sees unique
    keys, which a range partitioning can always split.
    """
    return df.select(column).distinct().orderBy(column)
