import pytest
from pyspark.sql import functions as F

from tidemark.operators import MEASURES, avg_measures, partition_count, partition_sizes
from tidemark.plans import build_dataset_list, ingest_grids, partition_study, partition_sweep, queries
from tidemark.plans import study as study_plan
from tidemark.plans.study import file_cases
from tidemark.plans.sweep import Case
from tidemark.sources import measurements, part_count, read_measurements

HOST = "https://h/auto"


def test_catalog_to_dataset_list(spark, tmp_path):
    html = "".join(
        f'<li><a href="{u}">x</a>'
        for u in (f"{HOST}/b-2006.nc", f"{HOST}/a-2005.nc", f"{HOST}/b-2006.nc", "/home", f"{HOST}/a.html")
    )
    pages = spark.createDataFrame([(1, "u", html), (2, "v", html)], "page_id long, url string, html string")
    listed = build_dataset_list(spark, pages, str(tmp_path / "list"))
    assert [(r.file_ord, r.url, r.file) for r in listed.orderBy("file_ord").collect()] == [
        (0, f"{HOST}/a-2005.nc", "a-2005.csv"),
        (1, f"{HOST}/b-2006.nc", "b-2006.csv"),
    ]


@pytest.mark.parametrize("rebalance", [True, False])
def test_ingest_then_read(spark, tmp_path, rebalance):
    grids = spark.createDataFrame(
        [("a", [1, 2], [1.0, None]), ("b", [1, 2, 3], [4.0, 5.0, 6.0])],
        "dataset string, at array<int>, temperature array<double>",
    )
    root = str(tmp_path / "csv")
    ingest_grids(grids, {"time": "at"}, {"temperature": ("time",)}, root, rebalance=rebalance)
    df = read_measurements(spark, [root], base_path=root)
    assert {(r.dataset, r.time, r.temperature) for r in df.collect()} == {
        ("a", "1", "1.0"), ("a", "2", None), ("b", "1", "4.0"), ("b", "2", "5.0"), ("b", "3", "6.0"),
    }


def stage_piers(tmp_path):
    """13 files of 5 rows, the columns of every other file in reverse."""
    names = [f"pier-{2005 + i}" for i in range(13)]
    (tmp_path / "list.txt").write_text("".join(f"{HOST}/{n}.nc\n" for n in names))
    for i, name in enumerate(names):
        order = MEASURES if i % 2 else MEASURES[::-1]
        lines = [",".join(order)] + [
            ",".join(str(MEASURES.index(m) * 100 + i * 10 + j) for m in order) for j in range(5)
        ]
        (tmp_path / f"{name}.csv").write_text("\n".join(lines) + "\n")


@pytest.mark.parametrize("mode", ["repartition", "coalesce"])
def test_study(spark, tmp_path, mode):
    stage_piers(tmp_path)
    study = partition_study(
        spark, str(tmp_path / "list.txt"), str(tmp_path), str(tmp_path / "out"), mode=mode,
        fractions=((1, 5), (1, 2), (1, 1)), counts=(1, 2), files=12,
    )
    rows = study.timings.orderBy("fraction_ord", "partitions").collect()
    assert [(r.mode, r.scale, r.partitions, r.rows) for r in rows] == [
        (mode, n, p, n * 5) for n in (2, 6, 12) for p in (1, 2)
    ]
    for r in rows:
        centre = (r.scale - 1) * 5 + 2
        expected = [MEASURES.index(m) * 100 + centre for m in MEASURES]
        assert [r[f"avg_{m}"] for m in MEASURES] == pytest.approx(expected)
        assert r.create_s > 0 and r.avg_s > 0
    saved = spark.read.option("header", True).csv(study.path)
    assert saved.columns == ["scale", "partitions", "create_s", "avg_s"] and saved.count() == 6
    assert study.grid.count() == 6
    assert study.avg_series.count() == 3 and study.create_series.columns[1:] == ["create_s_1", "create_s_2"]


@pytest.mark.parametrize("mode", ["repartition", "coalesce"])
def test_study_by_rows(spark, tmp_path, mode):
    stage_piers(tmp_path)
    study = partition_study(
        spark, str(tmp_path / "list.txt"), str(tmp_path), str(tmp_path / "out"),
        mode=mode, row_budget=11, fractions=((1, 5), (1, 2), (1, 1)), counts=(1,),
    )
    rows = study.timings.orderBy("fraction_ord").collect()
    # Three files of five rows pass the budget of eleven; 7.5 rounds to 8.
    assert [(r.scale, r.rows) for r in rows] == [(3, 3), (8, 8), (15, 15)]
    values = [i * 10 + j for i in range(3) for j in range(5)]
    for r in rows:
        assert r.avg_temperature == pytest.approx(sum(values[: r.scale]) / r.scale)


def test_study_takes_the_whole_list(spark, tmp_path):
    stage_piers(tmp_path)
    study = partition_study(
        spark, str(tmp_path / "list.txt"), str(tmp_path), str(tmp_path / "out"), mode="repartition",
        fractions=((1, 1),), counts=(1,),
    )
    assert [(r.scale, r.rows) for r in study.timings.collect()] == [(13, 65)]


def test_study_reads_what_ingest_wrote(spark, tmp_path):
    grids = spark.createDataFrame(
        [(f"p-{i}", [30, 10, 20], [float(i), float(i + 1), float(i + 2)]) for i in range(14)],
        "dataset string, at array<int>, temperature array<double>",
    )
    root = str(tmp_path / "csv")
    ingest_grids(grids, {"time": "at"}, {"temperature": ("time",)}, root)
    (tmp_path / "list.txt").write_text("".join(f"{HOST}/p-{i}.nc\n" for i in range(14)))
    options = dict(mode="repartition", measures=["time", "temperature"], counts=(1,), layout="folders")
    study = partition_study(spark, str(tmp_path / "list.txt"), root, str(tmp_path / "out"), **options)
    rows = study.timings.orderBy("fraction_ord").collect()
    assert [r.scale for r in rows] == [3, 4, 5, 6, 7, 8, 9, 10, 11, 14]
    assert [r.rows for r in rows] == [3 * r.scale for r in rows]
    assert rows[-1].avg_temperature == pytest.approx(7.5)
    # Row prefixes follow the grid: the coordinates are 30, 10, 20 in each dataset.
    by_rows = partition_study(
        spark, str(tmp_path / "list.txt"), root, str(tmp_path / "out2"), row_budget=1,
        fractions=((1, 3), (2, 3)), **options,
    )
    assert [r.avg_time for r in by_rows.timings.orderBy("fraction_ord").collect()] == [30.0, 20.0]


def test_creation_reads_no_headers_again(spark, tmp_path):
    stage_piers(tmp_path)
    paths = [str(tmp_path / f"pier-{2005 + i}.csv") for i in range(13)]
    cases = file_cases(spark, paths, ((1, 5), (1, 1)))
    spark.sparkContext.setJobGroup("creation", "creation")
    try:
        built = [case.build() for case in cases]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert spark.sparkContext.statusTracker().getJobIdsForGroup("creation") == []
    assert [len(df.inputFiles()) for df in built] == [3, 13]


def test_coalesce_beyond_the_scan_is_refused(spark):
    narrow = spark.range(0, 10, 1, 2).select((F.col("id") * 1.0).alias("v"))
    with pytest.raises(ValueError, match="cannot be coalesced"):
        partition_sweep(spark, [Case(1, lambda: narrow, [3])], "coalesce", ["v"])
    rows = partition_sweep(spark, [Case(1, lambda: narrow)], "coalesce", ["v"]).collect()
    assert [(r.partitions, r.actual_partitions) for r in rows] == [(1, 1), (2, 2)]


def test_sweep_tries_every_count_up_to_the_scan(spark):
    wide = spark.range(0, 90, 1, 3).select((F.col("id") * 1.0).alias("v"))
    narrow = spark.range(0, 10, 1, 1).select((F.col("id") * 1.0).alias("v"))
    cases = [Case(1, lambda: narrow), Case(3, lambda: wide)]
    rows = partition_sweep(spark, cases, "repartition", ["v"]).collect()
    assert [(r.fraction_ord, r.partitions) for r in rows] == [(0, 1), (1, 1), (1, 2), (1, 3)]
    assert {r.avg_v for r in rows if r.fraction_ord == 1} == {avg_measures(wide, ["v"]).first()[0]}
    skipped = partition_sweep(
        spark, cases, "coalesce", ["v"], skipped=(F.col("scale") == 3) & (F.col("partitions") > 2)
    )
    assert [(r.fraction_ord, r.partitions) for r in skipped.collect()] == [(0, 1), (1, 1), (1, 2)]


def test_a_cell_runs_its_query_once(spark):
    from tests.test_sources import jobs

    df = spark.range(0, 4000, 1, 4).select(F.col("id").cast("double").alias("x"))
    for mode in ("repartition", "coalesce"):
        change = {"repartition": df.repartition, "coalesce": df.coalesce}[mode]
        alone, _ = jobs(spark, lambda: [avg_measures(change(n), ["x"]).collect() for n in (1, 2, 3)])
        swept, _ = jobs(spark, lambda: partition_sweep(spark, [Case(1, lambda: df, [1, 2, 3])], mode, ["x"]))
        assert swept == alone


def test_repeated_cells_have_a_median_and_a_spread(spark):
    df = spark.range(0, 1000, 1, 3).select((F.col("id") / 7).alias("x"))
    cells = partition_sweep(spark, [Case(5, lambda: df)], "repartition", ["x"], repeats=3, exact=True).collect()
    assert [c.partitions for c in cells] == [1, 2, 3] and len({c.avg_x for c in cells}) == 1
    for c in cells:
        assert c.repeats == 3 and 0 < c.avg_s_low <= c.avg_s_median <= c.avg_s_high and c.avg_s == c.avg_s_median
    with pytest.raises(ValueError):
        partition_sweep(spark, [Case(5, lambda: df)], "repartition", ["x"], repeats=0)


def test_states_of_files_are_kept(spark, tmp_path):
    from tests.test_sources import HEADER_A, HEADER_B, jobs, write
    from tidemark.operators import exact_averages
    from tidemark.sources import refresh_measure_states

    data, folder = tmp_path / "data", str(tmp_path / "states")
    data.mkdir()
    write(data / "a.csv", HEADER_A, "t,1.0,2,3,4", "t,,2,x,4")
    write(data / "b.csv", HEADER_B, "t,1,7.0,2,3")
    write(data / "c.csv", HEADER_A)
    refresh = lambda: refresh_measure_states(spark, [str(data)], folder, MEASURES)

    def averages():
        return tuple(exact_averages(refresh(), MEASURES).first())

    assert averages() == (3, 4.0, 2.0, 3.0, 3.0)
    write(data / "d.csv", "time,temperature", "t,10.0")
    assert averages() == (4, 6.0, 2.0, 3.0, 3.0)
    assert {r.file.rsplit("/", 1)[-1] for r in spark.read.parquet(f"{folder}/states").select("file").collect()} == {"a.csv", "b.csv", "c.csv", "d.csv"}
    before = spark.read.parquet(f"{folder}/states").count()
    assert averages() == (4, 6.0, 2.0, 3.0, 3.0) and spark.read.parquet(f"{folder}/states").count() == before
    (data / "a.csv").unlink()
    assert averages() == (2, 8.5, 2.0, 3.0, 1.0)


def test_states_are_summed_without_the_names_of_files(spark, tmp_path, monkeypatch):
    from tests.test_sources import HEADER_A, HEADER_B, write
    from tidemark.operators import exact_averages, measure_state
    from tidemark.sources import refresh_measure_states, states

    data = tmp_path / "da ta+1"
    data.mkdir()
    write(data / "a%20.csv", HEADER_A, "t,1.0,2,3,4", "t,,2,x,4")
    write(data / "b#.csv", HEADER_B, "t,1,7.0,2,3")
    keys = []

    def seen(df, measures, by=()):
        keys.extend(dict(df.dtypes)[key] for key in by)
        return measure_state(df, measures, by)

    monkeypatch.setattr(states, "measure_state", seen)
    found = refresh_measure_states(spark, [str(data)], str(tmp_path / "states"), MEASURES)
    assert keys and "string" not in keys
    by_file = {r.file.rsplit("/", 1)[-1]: tuple(r)[1:] for r in exact_averages(found, MEASURES, ["file"]).collect()}
    assert by_file == {"a%20.csv": (2, 1.0, 2.0, 3.0, 4.0), "b#.csv": (1, 7.0, 2.0, 3.0, 1.0)}


def test_a_cell_deals_its_rows_without_a_sort(spark, monkeypatch):
    from tidemark.plans import sweep

    key, during, plain = "spark.sql.execution.sortBeforeRepartition", [], sweep.timed
    before = spark.conf.get(key)

    def timed(step):
        during.append(spark.conf.get(key))
        return plain(step)

    monkeypatch.setattr(sweep, "timed", timed)
    df = spark.range(0, 1000, 1, 3).select((F.col("id") / 7).alias("x"))
    rows = partition_sweep(spark, [Case(1, lambda: df)], "repartition", ["x"]).collect()
    assert [(r.partitions, r.rows) for r in rows] == [(1, 1000), (2, 1000), (3, 1000)]
    # The first is the creation, and each cell is one more.
    assert during[1:] == ["false"] * 3 and spark.conf.get(key) == before


def test_a_large_year_is_staged_by_several_tasks(spark, tmp_path):
    import glob

    import pyarrow.parquet as pq

    from tidemark.plans.queries import LINE_MEASURES, staged_years

    lines = spark.range(0, 60000, 1, 6).select(
        F.make_date(F.when(F.col("id") % 50 == 0, 1996).otherwise(1995), F.lit(3), F.lit(4)).cast("timestamp_ntz").alias("l_shipdate"),
        *[F.rand(i).alias(m) for i, m in enumerate(LINE_MEASURES)],
    )
    lines.write.parquet(str(tmp_path / "lineitem.parquet"))
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "256k")
    try:
        paths = staged_years(spark, str(tmp_path))
    finally:
        spark.conf.set(key, before)
    assert [spark.read.parquet(path).count() for path in paths] == [58800, 1200]
    files = glob.glob(f"{paths[0].removeprefix('file:')}/*.parquet")
    assert len(files) > 1
    # One task reads them all for a cell of one partition.
    assert {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files} == {"ZSTD"}


def test_parts_are_even_and_in_order(spark, tmp_path):
    points = [("a", i, [float(i)] * 50) for i in range(160)] + [("b", i, [0.0] * 50) for i in range(40)]
    grids = spark.createDataFrame(points, "dataset string, vec_id int, temperature array<double>").repartition(3)
    root = str(tmp_path / "csv")
    ingest_grids(grids, {"time": None}, {"temperature": ("time",)}, root, order_by=["vec_id"], parts=10)
    df = read_measurements(spark, [root], base_path=root).withColumn("file", F.input_file_name())
    part = F.regexp_extract("file", r"part-(\d+)", 1)
    sizes = [r["count"] for r in df.groupBy(part.alias("part")).count().collect()]
    assert len(sizes) == 10 and sum(sizes) == 10_000 and max(sizes) < 2_000
    # A dataset goes on in its next part.
    ends = df.filter("dataset = 'a'").groupBy(part.alias("part")).agg(
        F.min(F.col("temperature").cast("double")).alias("low"), F.max(F.col("temperature").cast("double")).alias("high")
    )
    rows = ends.orderBy("part").collect()
    assert len(rows) > 5 and all(a.high <= b.low for a, b in zip(rows, rows[1:]))
    with pytest.raises(ValueError, match="parts"):
        ingest_grids(grids, {"time": None}, {"temperature": ("time",)}, root, rebalance=False, parts=10)


def test_part_count(spark):
    cores, own = spark.sparkContext.defaultParallelism, spark.newSession()
    own.conf.set("spark.sql.files.maxPartitionBytes", "64m")
    own.conf.set("spark.sql.files.openCostInBytes", "4194304")
    assert [part_count(own, rows, 16) for rows in (0, 1, 1 << 17, (1 << 17) + 1)] == [1, 1, 1, 2]
    assert part_count(own, 24 * cores << 20, 1) == 10 * cores
    assert part_count(own, 16 * cores << 20, 1) == 8 * cores
    # More files would give a scan more partitions.
    assert part_count(own, 52 * cores << 20, 1) == 3 * cores
    assert part_count(own, 62 * cores << 20, 1) is part_count(own, 500 * cores << 20, 1) is None


def test_study_of_whole_files(spark, tmp_path):
    (tmp_path / "list.txt").write_text("".join(f"{HOST}/p{i}.nc\n" for i in range(2)))
    for i in range(2):
        (tmp_path / f"p{i}.csv").write_text(f'note,depth\n"two\nlines",{i}\n,\nplain,4\n')
    options = dict(mode="repartition", measures=["depth"], fractions=((1, 2), (1, 1)))
    args = [spark, str(tmp_path / "list.txt"), str(tmp_path)]
    with pytest.raises(ValueError, match="multi_line"):
        partition_study(*args, str(tmp_path / "lines"), **options)
    with pytest.raises(ValueError, match="rows"):
        partition_study(*args, str(tmp_path / "rows"), row_budget=2, multi_line=True, **options)
    study = partition_study(*args, str(tmp_path / "whole"), multi_line=True, **options)
    cells = {(r.scale, r.rows, r.avg_depth) for r in study.timings.collect()}
    assert cells == {(1, 3, 2.0), (2, 6, 2.25)}


def test_study_chain_scans_even_whole_files(spark, tmp_path, monkeypatch):
    vectors = spark.range(400).selectExpr(
        "id AS vec_id", "transform(sequence(1, 20), i -> cast(id + i / 8 AS float)) AS embedding",
        "cast(greatest(id % 8, 4) AS int) AS label",
    )
    vectors.write.parquet(str(tmp_path / "embeddings.parquet"))
    monkeypatch.setattr(measurements, "FEWEST_BYTES", 1 << 10)
    scans = []

    class Stop(Exception):
        pass

    def capture(spark, cases, *_, **__):
        scans.extend(case.build() for case in cases)
        raise Stop

    monkeypatch.setattr(study_plan, "partition_sweep", capture)
    with pytest.raises(Stop):
        queries.study_chain(spark, str(tmp_path))
    # Several files for each core, as many rows in one partition as in the other.
    whole = scans[-1]
    assert len(whole.inputFiles()) >= 8 * spark.sparkContext.defaultParallelism
    sizes = [r.rows for r in partition_sizes(whole).collect()]
    assert sum(sizes) == 8_000 and max(sizes) < 2 * sum(sizes) / len(sizes)
    # No file is cut, however small the partitions of a scan.
    own = spark.newSession()
    own.conf.set("spark.sql.files.maxPartitionBytes", "512")
    del scans[:]
    with pytest.raises(Stop):
        queries.study_chain(own, str(tmp_path))
    assert partition_count(scans[-1]) <= len(scans[-1].inputFiles())
