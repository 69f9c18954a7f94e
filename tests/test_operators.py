import re
from html import unescape

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark import operators as op
from tidemark.functions import dataset_name, decode_entities
from tidemark.operators import FRACTIONS, Prefix

FEW = settings(
    max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def links_of(spark, html):
    pages = spark.createDataFrame([(1, html)], "page_id long, html string")
    return [r.link for r in op.extract_links(pages).collect()]


@pytest.mark.parametrize(
    "html, links",
    [
        ('<!-- <a href="x"> --><a href="y">', ["y"]),
        ('<script>var a = \'<a href="x">\'; // <!-- </script><a href="y">-->', ["y"]),
        ('<!-- <script> --><a href="y">', ["y"]),
        ('<style>a > b { } <a href="x"></style><a href="y">', ["y"]),
        ('<!-- never closed <a href="x">', []),
        ("<a href='x'>", ["x"]),
        ("<a href=x>", ["x"]),
        ("<a href=x/y>", ["x/y"]),
        ("<A\n  HREF = \"x\">", ["x"]),
        ('<a class="b>c" href="x">', ["x"]),
        ('<a title="no href=x here" id=1>', []),
        ('<a data-href="x">', []),
        ('<abbr href="x">', []),
        ('<a href="x" href="y">', ["y"]),
        ("<a href>", [""]),
        ("<a>", []),
        ("", []),
        ('<a href="?a=1&amp;b=2&copy;&#39;&#x263A;&#8364;">', ["?a=1&b=2©'☺€"]),
        ('<a href="?a=1&b=2&unknown;">', ["?a=1&b=2&unknown;"]),
        ('<a href="&amp;lt;">', ["&lt;"]),
        ('<a href="1"><a href="2"><a href="1">', ["1", "2", "1"]),
        ("<a href=\"it's\">", ["it's"]),
        ('<p title="<a href=x>"><a href="y">', ["y"]),
        ('<p title="<!-- "><a href="y">', ["y"]),
        ('<script src="s"/><a href="y">', ["y"]),
        ('<SCRIPT type=x>"<a href=x>"</SCRIPT ><a href="y">', ["y"]),
        ('<scripted><a href="y"></scripted>', ["y"]),
        ('<!--><a href="y">', ["y"]),
        ('<!DOCTYPE html><?xml a="b"?></p><a href="y">', ["y"]),
        ('1 < 2 <b<a href="x"> and <a href="y"', []),
        ("a<b " * 50_000 + '<a href="x"', []),
        ("<a href=it's><a href='y'>", ["it's", "y"]),
        ('<a title=5" href="x"><a href="y">', ["x", "y"]),
        ('<a href="a=b>c" id=x>', ["a=b>c"]),
        ("<a href=x/>", ["x/"]),
        ('<a/href="x">', ["x"]),
        ('<a title="unclosed href=x><a href="y">', []),
        ('<a class = "b" href = "x" >', ["x"]),
        ("<a href=x?a=1&amp;b=2#c>", ["x?a=1&b=2#c"]),
        ("<a " + "= b" * 50_000 + ' ><a href="x">', ["x"]),
        ("<a " + 'x="y" ' * 20_000 + 'href="z">', ["z"]),
        ("<!--" + "- >" * 50_000 + '<a href="x">--><a href="y">', ["y"]),
    ],
)
def test_anchors(spark, html, links):
    assert links_of(spark, html) == links


def test_pages_without_anchors_give_no_rows(spark):
    pages = spark.createDataFrame([(1, None), (2, "<p>")], "page_id long, html string")
    assert op.extract_links(pages).count() == 0


def test_entities_are_decoded_as_by_the_standard_library(spark):
    texts = ["&eacute;&nbsp;&lt;&#65;&#x41;;", "&&amp;&amp;", "a&b;c", "&NotEqualTilde;", "&#0;", "&#xD800;"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(decode_entities(F.col("t"))).collect()]
    assert got == [unescape(t) for t in texts]


def test_link_filter(spark):
    links = ["https://h/a.nc", "https://h/anc", "ftp://h/a.nc", "https://h/a.nc.txt"]
    df = spark.createDataFrame([(x,) for x in links], "link string")
    assert [r.link for r in op.filter_links(df).collect()] == ["https://h/a.nc"]
    loose = op.filter_links(df, "^https://", ".nc$")
    assert [r.link for r in loose.collect()] == ["https://h/a.nc", "https://h/anc"]


def test_tokens_split_on_any_white_space(spark):
    text = "  a\tb c d\x1ce\n\nf  "
    df = spark.createDataFrame([(text,), ("   ",), ("",), (None,)], "value string")
    assert [r.link for r in op.tokens(df).collect()] == text.split()


def test_sorted_distinct_is_in_code_point_order(spark):
    words = ["b", "a", "é", "Z", "\U0001f600", "￮", "b", "a-", "a"]
    df = spark.createDataFrame([(w,) for w in words], "link string")
    assert [r.link for r in op.sorted_distinct(df).collect()] == sorted(set(words))


def test_dataset_names(spark):
    urls = ["https://h/x/pier-d02-2016.nc", "http://h.b/c", "a/b.tar.nc", "x.nc", ""]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    got = [r[0] for r in df.select(dataset_name(F.col("url"))).collect()]
    assert got == ["pier-d02-2016", "", "b.tar", "x", ""]


def test_fraction_ladder(spark):
    rows = [(r.num, r.den) for r in op.fraction_ladder(spark).collect()]
    assert tuple(rows) == FRACTIONS
    assert [(r.num, r.den) for r in op.fraction_ladder(spark, 1).collect()] == [(1, 1)]
    assert [(r.num, r.den) for r in op.fraction_ladder(spark, 3).collect()] == [
        (1, 3),
        (1, 2),
        (2, 3),
        (1, 1),
    ]


@pytest.mark.parametrize(
    "entries, sizes",
    [
        (12, [2, 3, 4, 5, 6, 7, 8, 9, 10, 12]),
        (67, [13, 17, 22, 27, 34, 40, 45, 50, 54, 67]),
        (7, [1, 2, 2, 3, 4, 4, 5, 5, 6, 7]),
        (1, [0, 0, 0, 0, 0, 1, 1, 1, 1, 1]),
        (0, [0] * 10),
    ],
)
def test_prefix_sizes(spark, entries, sizes):
    assert [op.prefix_size(entries, *f) for f in FRACTIONS] == sizes
    files = spark.range(entries).select(F.col("id").cast("int").alias("file_ord"))
    assert [r.size for r in op.prefix_sizes(files).orderBy("fraction_ord").collect()] == sizes
    assert op.prefix_files(files, 2, 5).count() == sizes[3]


@FEW
@given(
    keys=st.sets(
        st.one_of(
            st.integers(-(2**63), 2**63 - 1),
            st.integers(-50, 200),
            st.integers(2**40, 2**40 + 2**20),
        ),
        max_size=60,
    )
)
def test_cutoffs_are_the_kth_keys(spark, keys):
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    ordered = sorted(keys)
    ranks = sorted({0, len(keys), len(keys) // 2, len(keys) // 3, min(1, len(keys))})
    assert op.order_cutoffs(df, "k", ranks) == [ordered[r - 1] if r else None for r in ranks]


def test_cutoffs_refuse_unusable_keys(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (3, "d")], "k long, s string")
    assert op.order_cutoffs(df, "k", [2, 3]) == [1, 2]
    with pytest.raises(ValueError, match="not unique"):
        op.order_cutoffs(df, "k", [1])
    with pytest.raises(TypeError):
        op.order_cutoffs(df, "s", [1])
    with pytest.raises(ValueError, match="ranks"):
        op.order_cutoffs(df, "k", [5])
    with pytest.raises(ValueError, match="nulls"):
        op.order_cutoffs(spark.createDataFrame([(1,), (None,)], "k long"), "k", [1])


@FEW
@given(
    rows=st.lists(
        st.tuples(st.integers(-(10**12), 10**12), st.sampled_from(["1.5", "2", "", "x", "-4"])),
        max_size=40,
        unique_by=lambda r: r[0],
    )
)
def test_prefix_averages_equal_one_scan_per_prefix(spark, rows):
    df = spark.createDataFrame(rows, "k long, v string")
    prefixes = op.row_prefixes(df, "k")
    got = op.prefix_averages(df, "k", prefixes, ["v"]).orderBy("fraction_ord").collect()
    assert len(got) == len(FRACTIONS)
    for row, (num, den) in zip(got, FRACTIONS):
        one = op.avg_measures(op.prefix_rows(df, num, den, "k"), ["v"], with_rows=True).first()
        assert (row.num, row.den, row.size, row.rows) == (num, den, one.rows, one.rows)
        assert row.avg_v == (None if one.avg_v is None else pytest.approx(one.avg_v))


def test_whole_prefix_is_the_table(spark):
    df = spark.range(100, 200).select("id", (F.col("id") * 2).alias("v"))
    assert op.prefix_rows(df, 1, 1, "id").count() == 100
    whole = op.avg_measures(df, ["v"]).first()
    assert op.avg_measures(op.prefix_rows(df, 1, 1, "id"), ["v"]).first() == whole


def test_prefix_averages_check_their_input(spark):
    df = spark.range(10)
    with pytest.raises(ValueError):
        op.prefix_averages(df, "id", [], [])
    with pytest.raises(ValueError):
        op.prefix_averages(df, "id", [Prefix(1, 1, 9, 8), Prefix(1, 2, 4, 3)], [])


@pytest.mark.parametrize(
    "counts, budget, kept",
    [([8840, 8931, 8715], 10_000, 2), ([10_000, 5, 5], 10_000, 2), ([10_001, 5], 10_000, 1), ([1, 2], 10, 2)],
)
def test_row_budget(spark, counts, budget, kept):
    df = spark.createDataFrame(list(enumerate(counts)), "file_ord int, rows long")
    rows = op.row_budget_files(df, budget).orderBy("file_ord").collect()
    assert [r.file_ord for r in rows] == list(range(kept))
    assert sum(counts[: kept - 1]) <= budget


@pytest.mark.parametrize(
    "cells",
    [
        [("A", 1), ("A", 2), ("B", 1), ("B", 2), ("B", 3)],  # short first
        [("A", 1), ("A", 2), ("A", 3), ("B", 1), ("C", 1), ("C", 2), ("C", 3)],  # short middle
        [("A", 1), ("A", 2), ("A", 3), ("B", 1), ("B", 2)],  # short last
        [("A", 2), ("B", 3)],  # gap in front
    ],
)
def test_grid_is_dense_and_pivots_back(spark, cells):
    rows = [(s, p, 0.5 * p, float(p)) for s, p in cells]
    df = spark.createDataFrame(rows, "scale string, partitions int, create_s double, avg_s double")
    grid = op.complete_grid(df)
    assert grid.columns == df.columns
    got = {(r.scale, r.partitions): r.avg_s for r in grid.collect()}
    scales, most = {s for s, _ in cells}, max(p for _, p in cells)
    assert grid.count() == len(got) == len(scales) * most
    assert got == {(s, p): float(p) if (s, p) in cells else None for s in scales for p in range(1, most + 1)}
    wide = op.pivot_series(grid, "avg_s")
    assert wide.columns == ["scale", *[f"avg_s_{k}" for k in range(1, most + 1)]]
    unpivoted = {
        (r.scale, k): r[f"avg_s_{k}"] for r in wide.collect() for k in range(1, most + 1)
    }
    assert unpivoted == got
    assert op.max_partitions(df).first()[0] == most
    assert {r.scale for r in op.distinct_scales(df).collect()} == scales


def test_empty_timing_table(spark):
    df = spark.createDataFrame([], "scale int, partitions int, create_s double, avg_s double")
    assert op.complete_grid(df).count() == 0
    assert op.pivot_series(df, "avg_s").collect() == []


def test_report_lines(spark):
    df = spark.createDataFrame([(2, 1, 0.5, None)], "scale int, partitions int, create_s double, avg_s double")
    assert op.report_lines(df).first().line == (
        "scale 2, partitions 1: created in 0.500000000 s, averaged in none s"
    )


def test_grid_with_two_dimensions(spark):
    df = spark.createDataFrame(
        [("d", [10, 20], [[1.0, 2.0, 3.0], [4.0, 5.0, 6.0]], [7.0, 8.0], 9.0)],
        "name string, t array<int>, v array<array<double>>, w array<double>, u double",
    )
    flat = op.flatten_grid(
        df, {"t": "t", "z": None}, {"v": ("t", "z"), "w": ("t",), "u": ()}, keep=["name"]
    )
    assert flat.columns == ["name", "t", "z", "v", "w", "u"]
    assert sorted(map(tuple, flat.collect())) == [
        ("d", 10 * i + 10, j, 3.0 * i + j + 1, 7.0 + i, 9.0) for i in range(2) for j in range(3)
    ]
    one = op.project_variable(df, {"t": "t", "z": None}, {"v": ("t", "z"), "w": ("t",)}, "w")
    assert sorted(map(tuple, one.collect())) == [(10, 7.0), (20, 8.0)]


def test_grid_keeps_points_that_only_some_variables_have(spark):
    df = spark.createDataFrame(
        [("d", [1, 2], [[1.0, 2.0], None], None), ("e", None, None, [5.0])],
        "name string, t array<int>, v array<array<double>>, w array<double>",
    )
    flat = op.flatten_grid(df, {"t": "t"}, {"w": ("t",)}, keep=["name"])
    assert sorted(map(tuple, flat.collect()), key=repr) == [
        ("d", 1, None), ("d", 2, None), ("e", None, 5.0)
    ]
    nested = op.flatten_grid(df, {"t": "t", "z": None}, {"v": ("t", "z")}, keep=["name"])
    assert sorted(map(tuple, nested.collect())) == [("d", 1, 0, 1.0), ("d", 1, 1, 2.0)]


def test_grid_with_three_dimensions(spark):
    cube = [[[1.0, 2.0]], [[3.0, 4.0]], [[5.0, 6.0]]]
    df = spark.createDataFrame([(cube, [7, 8])], "v array<array<array<double>>>, last array<int>")
    flat = op.flatten_grid(df, {"a": None, "b": None, "c": "last"}, {"v": ("a", "b", "c")})
    assert sorted(map(tuple, flat.collect())) == [
        (a, 0, 7 + c, cube[a][0][c]) for a in range(3) for c in range(2)
    ]


def test_grid_rejects_unknown_or_repeated_dimensions(spark):
    df = spark.createDataFrame([([[1.0]],)], "v array<array<double>>")
    for own in (("t", "t"), ("t", "q")):
        with pytest.raises(ValueError):
            op.flatten_grid(df, {"t": None, "z": None}, {"v": own})
    with pytest.raises(ValueError):
        op.flatten_grid(df, {"q": None, "t": None}, {"v": ("t",)})


def test_grid_does_not_carry_whole_arrays(spark):
    df = spark.range(1).select(F.sequence("id", F.col("id") + 99).alias("v"), (F.col("id") * 2).alias("u"))
    flat = op.flatten_grid(df, {"t": None}, {"v": ("t",), "u": ()})
    (carried,) = re.findall(r"Generate posexplode\(.*\), \[(.*?)\], false", plan_of(flat))
    assert "__v_u" in carried and "__v_v" not in carried
    assert flat.count() == 100


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("n", [1, 2, 3, 7])
def test_partition_counts_do_not_change_the_averages(spark, n):
    df = spark.range(0, 1000, 1, 4).select((F.col("id") / 3).alias("v"))
    expected = op.avg_measures(df, ["v"]).first().avg_v
    spread, merged = op.repartition_to(df, n), op.coalesce_to(df, n)
    assert op.partition_count(spread) == n
    assert op.partition_count(merged) == min(n, 4)
    for x in (spread, merged):
        assert op.avg_measures(x, ["v"]).first().avg_v == pytest.approx(expected, abs=1e-6)
    sizes = [r.rows for r in op.partition_sizes(spread).collect()]
    assert len(sizes) == n and sum(sizes) == 1000


def test_skip_cells(spark):
    cells = spark.createDataFrame([(s, p) for s in (2, 12) for p in (1, 5)], "scale int, partitions int")
    kept = op.skip_cells(cells, (F.col("scale") == 2) & (F.col("partitions") > 4))
    assert sorted(map(tuple, kept.collect())) == [(2, 1), (12, 1), (12, 5)]


def test_plans(spark, tmp_path):
    spark.range(100).select(*[F.col("id").cast("string").alias(c) for c in "abcd"]).write.option(
        "header", True
    ).csv(str(tmp_path / "t"))
    df = spark.read.option("header", True).csv(str(tmp_path / "t"))
    spread = plan_of(op.avg_measures(op.repartition_to(df, 3), ["a", "b"]))
    assert spread.count("Exchange RoundRobinPartitioning(3)") == 1
    merged = plan_of(op.avg_measures(op.coalesce_to(df, 3), ["a", "b"]))
    assert "RoundRobin" not in merged and "Coalesce 3" in merged
    for plan in (spread, merged):
        assert "ReadSchema: struct<a:string,b:string>" in plan
        assert plan.count("Exchange SinglePartition") == 1
    events = spark.range(1000).write.parquet(str(tmp_path / "e")) or spark.read.parquet(
        str(tmp_path / "e")
    )
    prefix = plan_of(op.prefix_rows(events, 1, 3, "id"))
    assert "PushedFilters: [IsNotNull(id), LessThanOrEqual(id,332)]" in prefix
    assert "Exchange" not in prefix


def test_running_sums_pass_no_single_task(spark):
    df = spark.range(500).select((F.col("id") * 7 % 500).alias("k"), F.lit(2).alias("v"))
    got = op.running_before(df, ["k"], F.col("v"), "before")
    assert sorted((r.k, r.before) for r in got.collect()) == [(k, 2 * k) for k in range(500)]
    assert "SinglePartition" not in got._jdf.queryExecution().toString()
    assert op.running_before(df.limit(0), ["k"], F.col("v"), "before").collect() == []
