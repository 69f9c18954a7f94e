import csv
import math
import re
import uuid
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tidemark.operators import MEASURES, assign_file_ord, avg_measures, with_row_index
from tidemark.session import scratch_dir
from tidemark.sources import (
    append_links,
    dataset_paths,
    file_headers,
    header_groups,
    read_dataset_list,
    read_links,
    read_measurements,
    read_row_budget,
    read_row_prefix,
    row_budget_paths,
    row_counts,
    rows_to_table,
    write_columnar,
    write_measurements,
    write_sorted_links,
    write_timings,
)

HEADER_A = "time,temperature,conductivity,salinity,chlorophyll"
HEADER_B = "time,chlorophyll,temperature,conductivity,salinity"


def write(path, *lines):
    path.write_text("".join(line + "\n" for line in lines))
    return str(path)


@pytest.fixture
def two_orders(tmp_path):
    a = write(tmp_path / "a.csv", HEADER_A, "t1,15.0,3.5,33.1,1.2", "t2,,3.7,33.3,")
    b = write(tmp_path / "b.csv", HEADER_B, "t3,9.0,17.0,3.9,33.5", "t4,NaN,16.0,3.9,33.5")
    return [a, b]


def test_columns_are_matched_by_name(spark, two_orders):
    df = read_measurements(spark, two_orders)
    assert set(dict(df.dtypes).values()) == {"string"}
    row = avg_measures(df, nan_as_null=True).first()
    assert row.avg_temperature == pytest.approx(16.0)
    assert row.avg_conductivity == pytest.approx(3.75)
    assert row.avg_salinity == pytest.approx(33.35)
    assert row.avg_chlorophyll == pytest.approx(5.1)


def test_nan_text_is_kept_by_default(spark, two_orders):
    assert math.isnan(avg_measures(read_measurements(spark, two_orders)).first().avg_chlorophyll)


def test_column_missing_in_one_file(spark, tmp_path, two_orders):
    c = write(tmp_path / "c.csv", "time,temperature,conductivity,salinity", "t5,16.0,3.75,33.35")
    df = read_measurements(spark, [c, *two_orders])
    assert df.count() == 5
    assert df.filter("time = 't5'").first().chlorophyll is None
    row = avg_measures(df, nan_as_null=True).first()
    assert row.avg_chlorophyll == pytest.approx(5.1)
    assert row.avg_temperature == pytest.approx(16.0)


def test_malformed_cells_are_null(spark, tmp_path):
    path = write(tmp_path / "m.csv", HEADER_A, "t1,x1,1,2,3", "t2,5.0,,4,5", "t3, 7 ,3,4,1e1")
    row = avg_measures(read_measurements(spark, [path])).first()
    assert tuple(row) == pytest.approx((6.0, 2.0, 10 / 3, 6.0))


def test_header_only_gives_one_row_of_nulls(spark, tmp_path):
    path = write(tmp_path / "e.csv", HEADER_A)
    rows = avg_measures(read_measurements(spark, [path])).collect()
    assert [tuple(r) for r in rows] == [(None,) * 4]


def test_header_groups_skip_empty_files(spark, tmp_path, two_orders):
    empty = write(tmp_path / "z.csv")
    groups = header_groups(spark, [*two_orders, empty])
    plain = {h: [f.removeprefix("file:") for f in files] for h, files in groups.items()}
    assert plain == {
        tuple(HEADER_A.split(",")): [two_orders[0]],
        tuple(HEADER_B.split(",")): [two_orders[1]],
    }
    with pytest.raises(ValueError):
        read_measurements(spark, [empty, empty])
    with pytest.raises(ValueError):
        read_measurements(spark, [])


def test_a_folder_of_mixed_headers_is_read_by_name(spark, two_orders, tmp_path):
    write(tmp_path / "c.csv", "time,salinity", "t9,40.0")
    folder, files = read_measurements(spark, [str(tmp_path)]), read_measurements(spark, two_orders)
    assert len(header_groups(spark, [str(tmp_path)])) == 3
    row, before = (avg_measures(df, nan_as_null=True).first() for df in (folder, files))
    assert row.avg_temperature == pytest.approx(before.avg_temperature)
    assert folder.count() == files.count() + 1


def jobs(spark, run):
    """How many Spark jobs ``run`` starts, and its result."""
    group = f"jobs-{uuid.uuid4().hex}"
    spark.sparkContext.setJobGroup(group, "count")
    try:
        result = run()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)), result


def test_headers_take_as_many_jobs_for_many_files(spark, tmp_path):
    for i in range(12):
        write(tmp_path / f"h{i:02d}.csv", HEADER_A if i % 2 else HEADER_B, "t,1,2,3,4")
    few, _ = jobs(spark, lambda: file_headers(spark, [str(tmp_path / f"h{i:02d}.csv") for i in range(3)]))
    many, headers = jobs(spark, lambda: file_headers(spark, [str(tmp_path)]))
    assert many <= few + 1 and len(headers[str(tmp_path)]) == 12
    # Known headers are not read again.
    none, df = jobs(spark, lambda: read_measurements(spark, [str(tmp_path)], headers=headers))
    assert none == 0 and df.count() == 12


def test_row_prefix_opens_only_its_files(spark, tmp_path):
    paths = [write(tmp_path / f"{n}.csv", "key", *[f"{n}{j}" for j in range(5)]) for n in "cab"]
    counted = list(zip(paths, row_counts(spark, paths)))
    assert [rows for _, rows in counted] == [5, 5, 5]
    for size, files in ((0, 0), (3, 1), (5, 1), (7, 2), (10, 2), (15, 3)):
        df = read_row_prefix(spark, counted, size)
        assert sum(f.endswith(".csv") for f in df.inputFiles()) == files
        expected = [f"{n}{j}" for n in "cab" for j in range(5)][:size]
        assert sorted(r.key for r in df.collect()) == sorted(expected)


def test_later_files_are_not_opened_for_a_row_budget(spark, tmp_path):
    paths = [write(tmp_path / f"{i}.csv", "key", "a", "b") for i in range(3)]
    chosen = row_budget_paths(spark, [*paths, str(tmp_path / "missing.csv")], 3)
    assert chosen == [(paths[0], 2), (paths[1], 2)]


def test_part_files_go_by_their_number(spark, tmp_path):
    folder = tmp_path / "parts"
    folder.mkdir()
    for n in (99999, 100000, 20000):
        write(folder / f"part-{n:05d}-x.txt", f"https://h/{n}.nc")
    rows = read_dataset_list(spark, str(folder)).orderBy("file_ord").collect()
    assert [r.dataset for r in rows] == ["20000", "99999", "100000"]


def test_names_listed_twice_are_refused(spark):
    df = spark.createDataFrame([("a", 1)], "dataset string, v int")
    listed = spark.createDataFrame([(0, "a"), (1, "a")], "file_ord int, dataset string")
    with pytest.raises(ValueError, match="more than once"):
        assign_file_ord(df, listed)


def test_timings_are_not_replaced(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame([(2, 1, 0.5, 0.5)], "scale int, partitions int, create_s double, avg_s double")
    monkeypatch.setattr("tidemark.sources.timings.STAMP_FORMAT", "%Y")
    write_timings(df, str(tmp_path), "coalesce")
    with pytest.raises(Exception, match="(?i)exists"):
        write_timings(df, str(tmp_path), "coalesce")


def test_folders_of_odd_names_are_found(spark, tmp_path):
    names = ["a b", "x:y", "50%", "p/q", "é=1", "[z]"]
    data = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "dataset string, v int")
    write_measurements(data, str(tmp_path))
    listed = spark.createDataFrame([(i, n, "") for i, n in enumerate(names)], "file_ord int, dataset string, file string")
    paths = dataset_paths(listed, str(tmp_path), "folders")
    assert all(Path(p).is_dir() for p in paths)


def test_a_large_dataset_is_cut_into_files_in_order(spark, tmp_path):
    data = spark.range(40_000).select(F.lit("big").alias("dataset"), (-F.col("id")).alias("at"), "id", F.lit("x" * 50).alias("pad"))
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "200000", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "100000"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        write_measurements(data, str(tmp_path), sort_by=["id"], drop=["id"])
    finally:
        for key in settings:
            spark.conf.unset(key)
    files = sorted((tmp_path / "dataset=big").glob("part-*.csv"))
    assert len(files) > 1
    values = [int(line.split(",")[0]) for f in files for line in f.read_text().splitlines()[1:]]
    assert values == [-i for i in range(40_000)]


def test_one_header_for_all_files(spark, tmp_path, two_orders):
    same = [write(tmp_path / f"s{i}.csv", HEADER_A, f"t,{i}.0,1,2,3") for i in range(3)]
    df = read_measurements(spark, same, one_header=True)
    assert avg_measures(df).first() == pytest.approx((1.0, 1.0, 2.0, 3.0))
    with pytest.raises(Exception, match="(?i)failed_read_file|header"):
        avg_measures(read_measurements(spark, two_orders, one_header=True)).collect()
    loose = read_measurements(spark, two_orders, one_header=True, check_headers=False)
    # The header of the first file for both, by position: the mean of 15, 9 and NaN.
    assert math.isnan(avg_measures(loose).first().avg_temperature)
    assert avg_measures(loose, nan_as_null=True).first().avg_temperature == pytest.approx(12.0)


def test_dataset_from_odd_file_names(spark, tmp_path):
    folder = tmp_path / "x y%20"
    folder.mkdir()
    names = ["pier 1+2", "é-d02.2016", "plain"]
    paths = [write(folder / f"{n}.csv", HEADER_A, "t,1,2,3,4") for n in names]
    df = read_measurements(spark, paths, with_dataset=True)
    assert {r.dataset for r in df.collect()} == set(names)


def test_measurements_roundtrip_by_dataset(spark, tmp_path):
    data = spark.range(3000).select(
        F.concat(F.lit("p/"), F.col("id") % 3).alias("station"),
        "id",
        *[(F.col("id") / 7).alias(m) for m in MEASURES],
    )
    root = str(tmp_path / "out")
    write_measurements(data, root, dataset="station", sort_by=["id"])
    back = read_measurements(spark, [root], base_path=root)
    assert {(r.dataset, r["count"]) for r in back.groupBy("dataset").count().collect()} == {
        ("p/0", 1000),
        ("p/1", 1000),
        ("p/2", 1000),
    }
    assert avg_measures(back).first() == pytest.approx(avg_measures(data).first())
    pruned = back.filter("dataset = 'p/1'")
    assert len(pruned.select("_metadata.file_path").distinct().collect()) < len(back.inputFiles())
    for file in (tmp_path / "out" / "dataset=p%2F1").glob("*.csv"):
        ids = [int(r["id"]) for r in csv.DictReader(file.open())]
        assert ids == sorted(ids)


def test_dataset_folders_with_different_headers(spark, tmp_path):
    for name, header, line in (("a", "t,temperature", "1,2.0"), ("b", "temperature,t", "4.0,3")):
        (tmp_path / f"dataset={name}").mkdir()
        write(tmp_path / f"dataset={name}" / "part-0.csv", header, line)
    folders = [str(tmp_path / f"dataset={name}") for name in "ab"]
    df = read_measurements(spark, folders, base_path=str(tmp_path))
    got = {(r.dataset, r.t, r.temperature) for r in df.collect()}
    assert got == {("a", "1", "2.0"), ("b", "3", "4.0")}


def test_a_dataset_with_most_rows_is_written_by_several_tasks(spark, tmp_path):
    data = spark.range(0, 200_000, 1, 16).select(
        F.when(F.col("id") % 10 == 0, F.col("id") % 7).otherwise(99).alias("dataset"),
        F.sha2(F.col("id").cast("string"), 256).alias("x"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1MB")
    try:
        write_measurements(data, str(tmp_path / "out"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "out" / "dataset=99").glob("*.csv"))) > 2
    assert len(list((tmp_path / "out" / "dataset=3").glob("*.csv"))) == 1


def test_columnar_copy_keeps_the_averages(spark, tmp_path, two_orders):
    df = read_measurements(spark, two_orders)
    write_columnar(df, str(tmp_path / "pq"), MEASURES)
    copy = spark.read.parquet(str(tmp_path / "pq"))
    assert dict(copy.dtypes)["salinity"] == "double"
    a, b = (avg_measures(x, nan_as_null=True).first() for x in (df, copy))
    assert a == pytest.approx(b)


def test_row_index_over_many_splits(spark, tmp_path, monkeypatch):
    names = ["c", "a", "b"]
    paths, expected = [], []
    for i, name in enumerate(names):
        rows = [f"{name}{j:05d},{j}" for j in range(400 * (i + 1))]
        header = "key,n" if name != "b" else "n,key"
        lines = rows if name != "b" else [",".join(r.split(",")[::-1]) for r in rows]
        paths.append(write(tmp_path / f"{name}.csv", header, *lines))
        expected += [r.split(",")[0] for r in rows]
    listed = spark.createDataFrame(list(enumerate(names)), "file_ord int, dataset string")
    monkeypatch.setattr("tidemark.sources.file_catalog.pinned.__defaults__", (1000,))
    scan = read_measurements(spark, paths, with_dataset=True, with_position=True)
    assert scan.rdd.getNumPartitions() > 10
    rows = with_row_index(scan, listed).select("row_index", "key").collect()
    assert sorted(rows) == list(enumerate(expected))


def test_row_index_leaves_out_unlisted_datasets(spark, tmp_path):
    paths = [write(tmp_path / f"{n}.csv", "key", n + "1", n + "2") for n in "abc"]
    listed = spark.createDataFrame([(0, "c"), (1, "a")], "file_ord int, dataset string")
    scan = read_measurements(spark, paths, with_dataset=True, with_position=True)
    rows = with_row_index(scan, listed).select("row_index", "key").collect()
    assert sorted(map(tuple, rows)) == [(0, "c1"), (1, "c2"), (2, "a1"), (3, "a2")]


def test_row_index_does_not_depend_on_how_files_are_cut(spark, tmp_path):
    path = write(tmp_path / "a.csv", "key", *[str(i) for i in range(5000)])
    rows = with_row_index(read_measurements(spark, [path], with_position=True))
    assert rows.agg(F.sum("row_index")).first()[0] == 5000 * 4999 // 2
    # Another cut between the pass that counts and the one that numbers.
    for size in ("5000", "700"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            assert rows.filter("row_index != key").count() == 0
            again = with_row_index(read_measurements(spark, [path], with_position=True))
            assert again.filter("row_index != key").count() == 0 and again.count() == 5000
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_row_budget_reads_whole_files_in_order(spark, tmp_path):
    sizes = [10, 5, 5, 3]
    paths = [
        write(tmp_path / f"{i}.csv", HEADER_A, *["t,1,2,3,4"] * n) for i, n in enumerate(sizes)
    ]
    assert read_row_budget(spark, paths, 9).count() == 10
    assert read_row_budget(spark, paths, 10).count() == 15  # the stop is on more than the budget
    assert read_row_budget(spark, paths, 16).count() == 20
    assert read_row_budget(spark, paths, 1000).count() == 23


def test_rows_to_table_keeps_empty_text(spark):
    rows = [["15.0", ""], ["", "2.0"]]
    df = rows_to_table(spark, rows, ["temperature", "salinity"])
    row = avg_measures(df, ["temperature", "salinity"]).first()
    assert (row.avg_temperature, row.avg_salinity) == (15.0, 2.0)


def test_link_lists(spark, tmp_path):
    raw, listed = str(tmp_path / "raw"), str(tmp_path / "sorted")
    first = spark.createDataFrame([("https://h/x/b-2016.nc",), ("https://h/x/a.nc",)], "link string")
    append_links(first, raw)
    append_links(first.limit(1), raw)
    assert read_links(spark, raw).count() == 3
    write_sorted_links(read_links(spark, raw).select(F.col("value").alias("link")).distinct(), listed)
    write_sorted_links(read_links(spark, raw).select(F.col("value").alias("link")).distinct(), listed)
    datasets = read_dataset_list(spark, listed)
    assert [tuple(r) for r in datasets.orderBy("file_ord").collect()] == [
        (0, "https://h/x/a.nc", "a", "a.csv"),
        (1, "https://h/x/b-2016.nc", "b-2016", "b-2016.csv"),
    ]
    assert dataset_paths(datasets, "/data/") == ["/data/a.csv", "/data/b-2016.csv"]


def test_dataset_list_is_in_line_order(spark, tmp_path):
    lines = [f"https://h/{(i * 7919) % 1000}.nc" for i in range(1000)]
    path = write(tmp_path / "list.txt", *lines)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        rows = read_dataset_list(spark, path).select("file_ord", "url").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(map(tuple, rows)) == list(enumerate(lines))


def test_scratch_folder_is_the_shared_one():
    def session(folder, master):
        conf = SimpleNamespace(get=lambda key, default: folder)
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))

    assert scratch_dir(session("s3a://b/c/", "yarn"), "x").startswith("s3a://b/c/x-")
    assert scratch_dir(session(None, "local[2]"), "x") != scratch_dir(session(None, "local[2]"), "x")
    with pytest.raises(ValueError):
        scratch_dir(session(None, "yarn"), "x")


def test_timing_file_name_and_header(spark, tmp_path):
    schema = "scale int, partitions int, create_s double, avg_s double"
    df = spark.createDataFrame([(2, 1, 0.5, None)], schema)
    path = write_timings(df, str(tmp_path), "coalesce")
    assert re.fullmatch(r".*/coalesce_raw\d{8}-\d{6}\.csv", path)
    back = spark.read.option("header", True).csv(path)
    assert back.columns == df.columns and back.first().avg_s is None
