"""Anchors of stored HTML pages, by regular expressions inside the JVM."""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# A value in quotes may hold ">", and quotes count only where a value starts. Possessive
# repeats keep the matcher from recursing.
VALUE = r"""(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)"""
ATTRIBUTES = rf"(?:[^>=]++|=\s*+{VALUE}?+)*+"
# The tokens of a page; group 2 is the attribute text of an anchor. A comment, script,
# style or tag is one token, so what looks like an anchor inside it is none. One that is
# never closed runs to the end.
TOKENS = "|".join(
    [
        r"(?is)<!--(?:-?>|.*?(?:--!?>|\z))",
        rf"<(script|style)(?=[\s/>]){ATTRIBUTES}(?<!/)>.*?(?:</\1(?=[\s/>])|\z)",
        rf"<a(?=[\s/])({ATTRIBUTES})>",
        rf"<[a-z]{ATTRIBUTES}(?:>|\z)",
        r"<[!?/][^>]*+>",
    ]
)
# One attribute: its name, and its value if it has one.
ATTRIBUTE = rf"(?s)([^\s/=]++)(?:\s*+=\s*+({VALUE}))?+"
ENTITY_PIECES = r"(&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)|[^&]+|&)"

# All named references as one text, which Spark folds into one map literal. Some names also
# stand without a semicolon, and then the longest one that the text starts with counts.
ENTITY_TABLE = "\x01".join(f"&{name}\x02{text}" for name, text in html5.items())
LEGACY = "|".join(sorted((name for name in html5 if name[-1] != ";"), key=len, reverse=True))
MAX_CODE_POINT = 0x10FFFF
# What the numbers 0x80 to 0x9F were meant as: windows-1252, or themselves where it has nothing.
C1 = "".join(bytes([b]).decode("cp1252", "ignore") or chr(b) for b in range(0x80, 0xA0))


def _from_code_point(number: Column) -> Column:
    return F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")


def _code_point(number: Column) -> Column:
    """The character of a numeric reference, as HTML asks for."""
    c1 = number.between(0x80, 0x9F)
    outside = (number == 0) | number.between(0xD800, 0xDFFF) | (number > MAX_CODE_POINT)
    # Control characters and what is no character at all go.
    dropped = (
        number.between(0x1, 0x8) | (number == 0xB) | number.between(0xE, 0x1F) | (number == 0x7F)
        | number.between(0xFDD0, 0xFDEF) | ((number % 0x10000) >= 0xFFFE)
    )
    return (
        F.when(outside, F.lit("�"))
        .when(c1, F.substr(F.lit(C1), (number - 0x80 + 1).cast("int"), F.lit(1)))
        .when(dropped, F.lit(""))
        .otherwise(_from_code_point(F.when(outside, F.lit(0xFFFD)).otherwise(number)))
    )


def _decode_piece(piece: Column) -> Column:
    named = F.str_to_map(F.lit(ENTITY_TABLE), F.lit("\x01"), F.lit("\x02"))
    digits = F.regexp_extract(piece, r"^&#[xX]?0*([0-9a-fA-F]*);?$", 1)
    # Nine digits are beyond every character, and more would not fit a number.
    short = F.when(F.length(digits) > 9, F.lit("999999999")).otherwise(digits)
    decimal = F.coalesce(short.try_cast("bigint"), F.lit(0))
    hexadecimal = F.coalesce(F.conv(short, 16, 10).try_cast("bigint"), F.lit(0))
    legacy = F.regexp_extract(piece, f"^&({LEGACY})", 1)
    rest = F.substr(piece, F.length(legacy) + 2)
    return (
        F.when(~piece.startswith("&") | (F.length(piece) < 2), piece)
        .when(piece.rlike(r"^&#[0-9]"), _code_point(decimal))
        .when(piece.startswith("&#"), _code_point(hexadecimal))
        .when(F.element_at(named, piece).isNotNull(), F.element_at(named, piece))
        .when(legacy != "", F.concat(F.element_at(named, F.concat(F.lit("&"), legacy)), rest))
        .otherwise(piece)
    )


def decode_entities(text: Column) -> Column:
    """Character references replaced by their characters, each exactly once."""
    pieces = F.transform(F.regexp_extract_all(text, F.lit(ENTITY_PIECES), 1), _decode_piece)
    return F.when(F.contains(text, F.lit("&")), F.array_join(pieces, "")).otherwise(text)


def _href(attributes: Column) -> Column:
    names = F.regexp_extract_all(attributes, F.lit(ATTRIBUTE), 1)
    values = F.regexp_extract_all(attributes, F.lit(ATTRIBUTE), 2)
    hrefs = F.zip_with(names, values, lambda name, value: F.when(F.lower(name) == "href", value))
    # A repeated attribute overrides the earlier one.
    last = F.try_element_at(F.filter(hrefs, lambda value: value.isNotNull()), F.lit(-1))
    return F.regexp_replace(last, r"""(?s)^(["'])(.*)\1$""", "$2")


def link_array(html: Column) -> Column:
    """For every anchor of a page, in page order, its ``href`` or null."""
    anchors = F.filter(F.regexp_extract_all(html, F.lit(TOKENS), 2), lambda text: text != "")
    return F.transform(F.transform(anchors, _href), decode_entities)
