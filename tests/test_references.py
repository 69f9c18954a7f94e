"""Character references against the standard library."""

import html
import random
from html.entities import html5

from tidemark.functions.html import decode_entities


def texts():
    rng = random.Random(6)
    names = list(html5)
    numbers = [0, 1, 8, 9, 10, 11, 13, 31, 65, 127, 128, 129, 150, 159, 160, 0xD800, 0xFDD0, 0xFFFD, 0xFFFE, 0x1F600, 0x1FFFF, 0x10FFFF, 0x110000, 10**12]
    pieces = ["&", "&amp", "&notin", "&notit;", "&copy2", "&ltx", ";", "#", "&#", "&#x", "&#x;", " ", "a", "é", "日", "=1", "\n", "&nosuch;", "&nosuch", "&" + "x" * 40, "&amp" + "y" * 40]
    out = ["", "&", "&&", "&;", "a&b", "&lt;&gt&quot;&amp;amp;", "?a=1&copy=2&reg_id=3&lt;=4&para", "&#0000000000000065;", "&#x000041", "&#99999999999999999999"]
    for name in names:
        out.append(f"&{name}")
    for _ in range(3000):
        kinds = [
            lambda: rng.choice(pieces),
            lambda: "&" + rng.choice(names),
            lambda: "&" + rng.choice(names)[: rng.randint(1, 6)],
            lambda: f"&#{rng.choice(numbers)}" + rng.choice([";", ""]),
            lambda: f"&#{rng.choice('xX')}{rng.choice(numbers):x}" + rng.choice([";", "", "g"]),
            lambda: rng.choice("abz;&#x19 "),
        ]
        out.append("".join(rng.choice(kinds)() for _ in range(rng.randint(1, 6))))
    return out


def test_references_equal_the_standard_library(spark):
    given = texts()
    df = spark.createDataFrame([(t,) for t in given], "t string").repartition(8)
    got = {r.t: r.d for r in df.select("t", decode_entities(df["t"]).alias("d")).collect()}
    wrong = [(t, got[t], html.unescape(t)) for t in given if got[t] != html.unescape(t)]
    assert wrong == []
