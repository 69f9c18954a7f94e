"""The file catalog, reading by name in one scan, and row addresses."""

import random
import time

import pytest
from pyspark.sql import functions as F

from tidemark.operators import MEASURES, avg_measures, row_budget_files
from tidemark.sources import (
    catalog_headers,
    catalog_rows,
    describe_files,
    file_headers,
    known_row_counts,
    list_files,
    read_measurements,
    read_row_prefix,
    refresh_catalog,
    row_ranks,
)
from tests.test_sources import HEADER_A, HEADER_B, jobs, write


def entries(catalog):
    return {r.file.rsplit("/", 1)[-1]: (r.header, r.rows, r.open_quotes) for r in catalog.collect()}


def test_only_new_and_changed_files_are_opened(spark, tmp_path, monkeypatch):
    data, folder = tmp_path / "data", str(tmp_path / "catalog")
    data.mkdir()
    write(data / "a.csv", HEADER_A, "t,1,2,3,4", "", "t,1,2,3,4")
    write(data / "b.csv", HEADER_B)
    write(data / "empty.csv")
    write(data / "blank.csv", "", " ")
    opened = []
    real = describe_files
    monkeypatch.setattr("tidemark.sources.file_catalog.describe_files", lambda s, files, b: opened.append([f.rsplit("/", 1)[-1] for f in files]) or real(s, files, b))
    refresh = lambda: entries(refresh_catalog(spark, [str(data)], folder))
    first = {"a.csv": (HEADER_A, 2, 0), "b.csv": (HEADER_B, 0, 0), "blank.csv": (None, 0, 0)}
    assert refresh() == first and refresh() == first
    time.sleep(1.1)
    write(data / "b.csv", HEADER_A, "t,1,2,3,4")
    write(data / "c.csv", HEADER_A, 't,"1', '2",2,3,4')
    (data / "a.csv").unlink()
    assert refresh() == {"b.csv": (HEADER_A, 1, 0), "c.csv": (HEADER_A, 2, 2), "blank.csv": (None, 0, 0)}
    assert opened == [["a.csv", "b.csv", "blank.csv"], ["b.csv", "c.csv"]]
    assert refresh_catalog(spark, [], folder).count() == 0


def test_a_thousand_files_take_as_many_jobs_as_ten(spark, tmp_path):
    for count in (10, 1000):
        (tmp_path / str(count)).mkdir()
        for i in range(count):
            write(tmp_path / str(count) / f"{i:04d}.csv", HEADER_A if i % 2 else HEADER_B, *["t,1,2,3,4"] * (i % 3))

    def build(count):
        catalog = refresh_catalog(spark, [str(tmp_path / str(count))], str(tmp_path / f"catalog{count}"))
        return catalog, catalog_headers(catalog, [str(tmp_path / str(count))])

    few, _ = jobs(spark, lambda: build(10))
    many, (catalog, headers) = jobs(spark, lambda: build(1000))
    assert many <= few + 2
    folder = str(tmp_path / "1000")
    assert len(headers[folder]) == 1000 and catalog_rows(catalog, [folder]) == [999]
    # Known files are not opened again, whichever they are.
    again, known = jobs(spark, lambda: refresh_catalog(spark, [folder], str(tmp_path / "catalog1000")).count())
    assert known == 1000 and again < many
    # Without a catalog, the headers of many files come from one scan, too.
    plain, found = jobs(spark, lambda: file_headers(spark, [folder]))
    assert plain <= few and found == headers


def nodes(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("\n")


def test_five_hundred_headers_in_one_plan(spark, tmp_path):
    rng = random.Random(1)
    names = [f"m{i}" for i in range(8)]
    expected = {}
    for i in range(500):
        header = rng.sample(names, rng.randint(2, 8))
        values = [[str(rng.randint(0, 99)) for _ in header] for _ in range(2)]
        write(tmp_path / f"{i:03d}.csv", ",".join(header), *[",".join(v) for v in values])
        for v in values:
            row = dict(zip(header, v))
            key = (f"{i:03d}", *[row.get(n) for n in names])
            expected[key] = expected.get(key, 0) + 1
    headers = file_headers(spark, [str(tmp_path)])
    assert len({e.header for e in headers[str(tmp_path)]}) > 400
    df = read_measurements(spark, [str(tmp_path)], headers=headers, with_dataset=True)
    got = {}
    for r in df.select("dataset", *names).collect():
        got[tuple(r)] = got.get(tuple(r), 0) + 1
    assert got == expected
    few = [str(tmp_path / f"{i:03d}.csv") for i in range(5)]
    assert nodes(df) == nodes(read_measurements(spark, few, with_dataset=True))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 1 and "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan
    # Only the cells that a wanted name may lie in are parsed.
    rows = avg_measures(df, ["m0"]).first()
    values = [float(k[1]) for k, n in expected.items() for _ in range(n) if k[1] is not None]
    assert rows.avg_m0 == pytest.approx(sum(values) / len(values))


def test_by_name_equals_one_scan_for_each_header(spark, tmp_path):
    lines = ['"a,b",2,3,4,5', ',,,,', '1,2', '1,2,3,4,5,6,7', '"say ""x""",\\"y\\",3,4,5', " 1 ,2,3,4,5", HEADER_A]
    paths = [write(tmp_path / "a.csv", HEADER_A, *lines), write(tmp_path / "b.csv", HEADER_B, *lines, ""), write(tmp_path / "c.csv", "Time,temperature", *lines)]
    df = read_measurements(spark, paths)
    alone = [read_measurements(spark, [p]) for p in paths]
    apart = alone[0].unionByName(alone[1], allowMissingColumns=True).unionByName(alone[2], allowMissingColumns=True)
    assert df.columns == apart.columns
    assert sorted(map(repr, df.collect())) == sorted(map(repr, apart.collect()))


def test_changed_files_are_refused(spark, tmp_path):
    paths = [write(tmp_path / "a.csv", HEADER_A, "t,1,2,3,4"), write(tmp_path / "b.csv", HEADER_B, "t,1,2,3,4")]
    headers = file_headers(spark, paths)
    write(tmp_path / "b.csv", HEADER_A, "t,1,2,3,4", "t,1,2,3,4")
    with pytest.raises(Exception, match="changed since its header"):
        read_measurements(spark, paths, headers=headers).collect()
    assert read_measurements(spark, paths, headers=headers, check_headers=False).count() == 3


def test_cells_over_line_breaks(spark, tmp_path):
    data = tmp_path / "data"
    data.mkdir()
    paths = [write(data / "a.csv", "k,v", '1,"x', 'y"'), write(data / "b.csv", "v,k", 'z,2')]
    catalog = refresh_catalog(spark, paths, str(tmp_path / "catalog"))
    with pytest.raises(ValueError, match="line breaks"):
        catalog_headers(catalog, paths)
    headers = catalog_headers(catalog, paths, multi_line=True)
    df = read_measurements(spark, paths, headers=headers, multi_line=True)
    assert sorted(map(tuple, df.select("k", "v").collect())) == [("1", "x\ny"), ("2", "z")]


def test_block_index_does_not_depend_on_the_session(spark, tmp_path):
    path = write(tmp_path / "a.csv", "key", *[f"{i:06d}" for i in range(9000)])
    write(tmp_path / "part-00010-x.csv", "key", "x")
    write(tmp_path / "part-00009-x.csv", "key", "y", "z")
    found = []
    for setting in ("700", "20000", None):
        if setting:
            spark.conf.set("spark.sql.files.maxPartitionBytes", setting)
        try:
            files = [r.file for r in list_files(spark, [str(tmp_path)]).collect()]
            ranks = row_ranks(describe_files(spark, files, 4096))
            found.append(sorted((r.rows_before, r.file, r.start, r.rows) for r in ranks.collect()))
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found[0] == found[1] == found[2] and len(found[0]) == -(-(4 + 9000 * 7) // 4096) + 2
    assert [r[1].rsplit("/", 1)[-1] for r in found[0][-2:]] == ["part-00009-x.csv", "part-00010-x.csv"]
    assert path in found[0][0][1] and [r[2] for r in found[0][:-2]] == [4096 * i for i in range(len(found[0]) - 2)]


def test_row_prefix_numbers_one_block_only(spark, tmp_path, monkeypatch):
    paths = [write(tmp_path / f"{n}.csv", "key,n" if n != "b" else "n,key", *[f"{n}{i:05d},{i}" if n != "b" else f"{i},{n}{i:05d}" for i in range(2000)]) for n in "cab"]
    every = [f"{n}{i:05d}" for n in "cab" for i in range(2000)]
    for name in ("tidemark.sources.file_catalog.pinned", "tidemark.sources.file_catalog.describe_files"):
        monkeypatch.setattr(f"{name}.__defaults__", (1000,))
    counted = [(p, 2000) for p in paths]
    for size in (1, 83, 84, 1999, 2000, 2001, 4500, 6000):
        got = sorted(r.key for r in read_row_prefix(spark, counted, size).select("key").collect())
        assert got == sorted(every[:size])


def test_a_budget_in_known_files_opens_none(spark, tmp_path):
    data, folder = tmp_path / "data", str(tmp_path / "catalog")
    data.mkdir()
    paths = [write(data / f"d{i}.csv", HEADER_A, *["t,1,2,3,4"] * n) for i, n in enumerate([10, 5, 5, 3])]
    catalog = refresh_catalog(spark, paths, folder)
    listed = spark.createDataFrame([(i, f"d{i}", f"d{i}.csv") for i in range(5)], "file_ord int, dataset string, file string")
    for path in data.iterdir():
        path.write_text("")
    counts = known_row_counts(catalog, listed)
    for budget, files in ((9, 1), (10, 2), (16, 3), (1000, 5)):
        assert row_budget_files(counts, budget).count() == files
    with pytest.raises(ValueError):
        known_row_counts(catalog, listed, "other")


def test_measures_of_catalogued_folders(spark, tmp_path):
    for name, header in (("a b", HEADER_A), ("50%", HEADER_B), ("[z]", "time,temperature")):
        (tmp_path / "data" / f"dataset={name}").mkdir(parents=True)
        write(tmp_path / "data" / f"dataset={name}" / "part-0.csv", header, "t,1,2,3,4")
    root = str(tmp_path / "data")
    catalog = refresh_catalog(spark, [root], str(tmp_path / "catalog"))
    df = read_measurements(spark, [root], headers=catalog_headers(catalog, [root]), base_path=root)
    assert set(df.columns) == {"time", *MEASURES, "dataset"}
    assert df.count() == 3 and df.filter(F.col("temperature").isNotNull()).count() == 3
