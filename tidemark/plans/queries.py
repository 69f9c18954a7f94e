"""The registered queries, each next to the SQL that must give the same rows.

``lineitem`` by ship year stands in for a list of measurement files, its four price
columns for the measures; ``events`` by user and day for timing records.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import operators as op
from tidemark import sources as src
from tidemark.functions import dataset_name, with_suffix
from tidemark.plans.catalog import build_dataset_list
from tidemark.plans.ingest import ingest_grids
from tidemark.plans.study import partition_study
from tidemark.plans.sweep import Case, partition_sweep
from tidemark.session import scratch_dir, written_side

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        QUERIES[build.__name__] = build
        SQL[build.__name__] = sql
        return build

    return register


LINE_MEASURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
# Digits kept of an average. Sums of doubles differ in the last digits with the
# partitioning, and the more so the larger they are.
DIGITS = 9
FEWER_DIGITS = {"l_extendedprice": 3}
REPEATS = 3
SPREAD = 8
ROW_BUDGET = 10_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def lines_by_year(spark: SparkSession, folder: str) -> DataFrame:
    """The measures of ``lineitem``, each ship year a dataset."""
    year = F.year("l_shipdate").cast("string").alias("dataset")
    return table(spark, folder, "lineitem").select(year, *LINE_MEASURES)


def timings(spark: SparkSession, folder: str) -> DataFrame:
    """Timing records with gaps: scale is the user, partitions the day of the month."""
    return (
        table(spark, folder, "events")
        .groupBy(F.col("user_id").alias("scale"), F.dayofmonth("ts").alias("partitions"))
        .agg(
            F.round(F.avg("value"), DIGITS).alias("create_s"),
            F.count("*").cast("double").alias("avg_s"),
        )
    )


def written_timings(spark: SparkSession, folder: str) -> DataFrame:
    """The timing records by way of their CSV file, so that they are made only once."""
    path = src.write_timings(timings(spark, folder), scratch_dir(spark, "timings"), "events")
    schema = "scale bigint, partitions int, create_s double, avg_s double"
    return src.read_timings(spark, path, schema)


def digits(measure: str) -> int:
    return FEWER_DIGITS.get(measure, DIGITS)


def rounded(df: DataFrame) -> DataFrame:
    averages = {
        name: F.round(name, digits(name.removeprefix("avg_")))
        for name in df.columns
        if name.startswith("avg_") and name != "avg_s"
    }
    return df.withColumns(averages)


def avg_sql(names=LINE_MEASURES, source: str = "{}") -> str:
    return ", ".join(
        f"round(avg({source.format(n)}), {digits(n)}) AS avg_{n}" for n in names
    )


def years_of(lines: DataFrame) -> DataFrame:
    """The dataset list of ``lines``: one row per ship year."""
    return src.list_datasets(lines)


YEARS_SQL = f"""
years AS (SELECT CAST(y AS VARCHAR) AS dataset, row_number() OVER (ORDER BY y) - 1 AS file_ord,
                 n AS rows, count(*) OVER () AS files
          FROM (SELECT year(l_shipdate) AS y, count(*) AS n FROM lineitem GROUP BY 1)),
lines AS (SELECT years.file_ord, years.files, {", ".join(LINE_MEASURES)} FROM lineitem
          JOIN years ON years.dataset = CAST(year(l_shipdate) AS VARCHAR))"""
LADDER = ", ".join(f"({i}, {num}, {den})" for i, (num, den) in enumerate(op.FRACTIONS))
LADDER_SQL = f"ladder(fraction_ord, num, den) AS (VALUES {LADDER})"
SIZE_SQL = "CAST(round_even({n} * (CAST(num AS DOUBLE) / den), 0) AS BIGINT)"
LINKS_SQL = r"""
links AS (SELECT page_id, unnest(regexp_extract_all(
            regexp_replace(html, '(?is)<!--.*?-->|<script.*?</script>|<style.*?</style>', '', 'g'),
            '<a[^>]*\shref="([^"]*)"', 1)) AS link FROM pages)"""
TIMINGS_SQL = f"""
timings AS (SELECT user_id AS scale, day(ts) AS partitions, round(avg(value), {DIGITS}) AS create_s,
                   CAST(count(*) AS DOUBLE) AS avg_s FROM events GROUP BY 1, 2)"""


# Averages


@query(f"SELECT {avg_sql()} FROM lineitem")
def avg_measures(spark, folder):
    return rounded(op.avg_measures(table(spark, folder, "lineitem"), LINE_MEASURES))


@query(f"SELECT count(*) AS rows, {avg_sql()} FROM lineitem")
def avg_measures_exact(spark, folder):
    lines = table(spark, folder, "lineitem")
    return rounded(op.exact_averages(op.measure_state(lines, LINE_MEASURES), LINE_MEASURES))


@query("SELECT count(*) AS rows FROM lineitem")
def row_count(spark, folder):
    return op.row_count(table(spark, folder, "lineitem"))


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def whole_rows(spark, folder):
    return table(spark, folder, "customer").select("*")


@query(
    f"SELECT {avg_sql(source='a_{}')} FROM "
    f"(SELECT {', '.join(f'avg({m}) AS a_{m}' for m in LINE_MEASURES)} "
    "FROM lineitem GROUP BY year(l_shipdate))"
)
def rows_to_table_avg(spark, folder):
    # The driver takes one text row per ship year, the averages Spark made of it.
    means = (
        lines_by_year(spark, folder)
        .groupBy("dataset")
        .agg(*[F.avg(m).cast("string").alias(m) for m in LINE_MEASURES])
        .drop("dataset")
    )
    return rounded(
        op.avg_measures(
            src.rows_to_table(spark, means.toLocalIterator(), list(LINE_MEASURES)), LINE_MEASURES
        )
    )


# CSV files


ORDERS = (LINE_MEASURES, LINE_MEASURES[::-1], LINE_MEASURES[2:] + LINE_MEASURES[:2])


def staged_csv(spark: SparkSession, folder: str) -> str:
    """``lineitem`` as CSV by ship year, in one folder; the columns lie in three orders."""
    lines = written_side(lines_by_year(spark, folder), "lines")
    root = scratch_dir(spark, "csv")
    for i, order in enumerate(ORDERS):
        some = lines.filter(F.col("dataset").cast("int") % len(ORDERS) == i)
        src.write_measurements(some.select("dataset", *order), root, mode="append")
    return root


def year_paths(spark: SparkSession, root: str) -> list[str]:
    """The folders of the staged ship years, in order."""
    years = src.list_datasets(spark.read.format("binaryFile").load(root).select("dataset"))
    named = years.select("file_ord", F.col("dataset").cast("string"), F.lit("").alias("file"))
    return src.dataset_paths(named, root, "folders")


@query(f"SELECT {avg_sql()} FROM lineitem")
def avg_measures_csv(spark, folder):
    root = staged_csv(spark, folder)
    return rounded(op.avg_measures(src.read_measurements(spark, [root]), LINE_MEASURES))


ORDER_SQL = " ".join(f"WHEN {i} THEN '{','.join(order)}'" for i, order in enumerate(ORDERS))


@query(
    f"""SELECT CASE year(l_shipdate) % {len(ORDERS)} {ORDER_SQL} END AS header,
    count(DISTINCT year(l_shipdate)) AS datasets, count(*) AS rows FROM lineitem GROUP BY 1"""
)
def header_groups(spark, folder):
    root = staged_csv(spark, folder)
    headers = src.file_headers(spark, [root])
    counted = []
    for header, files in src.header_groups(spark, [root], headers).items():
        own = {root: [(file, header) for file in files]}
        counted.append(
            src.read_measurements(spark, [root], base_path=root, headers=own).agg(
                F.lit(",".join(header)).alias("header"),
                F.count_distinct("dataset").alias("datasets"),
                F.count("*").alias("rows"),
            )
        )
    return reduce(DataFrame.unionByName, counted)


@query(
    f"""SELECT CAST(year(l_shipdate) AS VARCHAR) AS dataset,
    CASE year(l_shipdate) % {len(ORDERS)} {ORDER_SQL} END AS header, count(*) AS rows,
    CAST(0 AS BIGINT) AS opened_again FROM lineitem GROUP BY ALL"""
)
def file_catalog(spark, folder):
    # Some files first, then all of them; what is known by then is not opened again.
    root, catalog = staged_csv(spark, folder), scratch_dir(spark, "catalog")
    src.refresh_catalog(spark, year_paths(spark, root)[:3], catalog)
    now = src.refresh_catalog(spark, [root], catalog)
    entered = spark.read.parquet(catalog).groupBy("file").agg(F.count("*").alias("entries"))
    name = F.regexp_extract("file", "/dataset=([^/]*)/", 1).alias("dataset")
    return now.join(entered, "file").groupBy(name, "header").agg(
        F.sum("rows").alias("rows"), F.sum(F.col("entries") - 1).alias("opened_again")
    )


@query(
    f"""WITH {YEARS_SQL}, sums AS (
      SELECT *, sum(rows) OVER (ORDER BY file_ord) - rows AS before FROM years)
    SELECT file_ord, dataset, rows, CAST(before AS BIGINT) AS rows_before FROM sums
    WHERE before <= {ROW_BUDGET}"""
)
def row_budget_catalog(spark, folder):
    root = staged_csv(spark, folder)
    catalog = src.refresh_catalog(spark, [root], scratch_dir(spark, "catalog"))
    listed = years_of(lines_by_year(spark, folder)).withColumn("file", F.lit(""))
    counts = src.known_row_counts(catalog, listed, "folders")
    return op.row_budget_files(counts, ROW_BUDGET)


@query(
    f"""WITH {YEARS_SQL}, sums AS (
      SELECT dataset, rows, sum(rows) OVER (ORDER BY file_ord) - rows AS before,
             round_even(sum(rows) OVER () * (1.0::DOUBLE / 2), 0) AS k FROM years)
    SELECT dataset, CAST(least(rows, k - before) AS BIGINT) AS rows FROM sums WHERE before < k"""
)
def csv_prefix_rows(spark, folder):
    # Rows in list order over all files: the boundary falls inside a file.
    root = staged_csv(spark, folder)
    paths = year_paths(spark, root)
    counted = list(zip(paths, src.row_counts(spark, paths)))
    size = op.prefix_size(sum(rows for _, rows in counted), 1, 2)
    prefix = src.read_row_prefix(spark, counted, size, base_path=root)
    return prefix.groupBy("dataset").agg(F.count("*").alias("rows"))


@query(
    f"""WITH {YEARS_SQL}, sums AS (
      SELECT *, sum(rows) OVER (ORDER BY file_ord) - rows AS before FROM years)
    SELECT sums.dataset, count(*) AS rows, {avg_sql()} FROM sums
    JOIN lineitem ON CAST(year(l_shipdate) AS VARCHAR) = sums.dataset
    WHERE before <= {ROW_BUDGET} GROUP BY 1"""
)
def row_budget_read(spark, folder):
    root = staged_csv(spark, folder)
    chosen = src.read_row_budget(spark, year_paths(spark, root), ROW_BUDGET, base_path=root)
    averages = [F.avg(F.col(m).try_cast("double")).alias(f"avg_{m}") for m in LINE_MEASURES]
    return rounded(chosen.groupBy("dataset").agg(F.count("*").alias("rows"), *averages))


def dirty_csv(spark: SparkSession, folder: str) -> str:
    """Text cells that are empty, malformed or NaN; files of odd years lack the last column."""
    line = table(spark, folder, "lineitem")
    odd = F.year("l_shipdate") % 2 == 1
    quantity = (
        F.when(F.col("l_linenumber") == 2, "")
        .when(F.col("l_linenumber") == 3, "n/a")
        .otherwise(F.col("l_quantity").cast("string"))
    )
    discount = F.when(F.col("l_linenumber") == 4, "NaN").otherwise(F.col("l_discount").cast("string"))
    cells = line.select(
        F.year("l_shipdate").cast("string").alias("dataset"),
        quantity.alias("l_quantity"),
        discount.alias("l_discount"),
        F.col("l_tax").cast("string").alias("l_tax"),
        odd.alias("odd"),
    )
    root = scratch_dir(spark, "dirty")
    src.write_measurements(cells.filter(~F.col("odd")).drop("odd"), root)
    src.write_measurements(cells.filter("odd").drop("odd", "l_tax"), root, mode="append")
    return root


DIRTY = ("l_quantity", "l_discount", "l_tax")
DIRTY_SQL = """
  avg(CASE WHEN l_linenumber IN (2, 3) THEN NULL ELSE l_quantity END)"""


@query(
    f"""SELECT round({DIRTY_SQL}, {DIGITS}) AS avg_l_quantity, round(avg(l_tax)
    FILTER (WHERE year(l_shipdate) % 2 = 0), {DIGITS}) AS avg_l_tax, count(*) AS rows FROM lineitem"""
)
def avg_measures_dirty(spark, folder):
    cells = src.read_measurements(spark, [dirty_csv(spark, folder)])
    return rounded(op.avg_measures(cells, ("l_quantity", "l_tax"), with_rows=True))


@query(
    f"""SELECT round({DIRTY_SQL}, {DIGITS}) AS avg_l_quantity,
    round(avg(l_discount) FILTER (WHERE l_linenumber <> 4), {DIGITS}) AS avg_l_discount,
    round(avg(l_tax) FILTER (WHERE year(l_shipdate) % 2 = 0), {DIGITS}) AS avg_l_tax FROM lineitem"""
)
def avg_measures_nan_as_null(spark, folder):
    cells = src.read_measurements(spark, [dirty_csv(spark, folder)])
    return rounded(op.avg_measures(cells, DIRTY, nan_as_null=True))


# Links and dataset lists


@query(f"WITH {LINKS_SQL} SELECT page_id, link FROM links")
def extract_links(spark, folder):
    return op.extract_links(src.read_pages(spark, f"{folder}/pages.parquet"))


@query(f"WITH {LINKS_SQL} SELECT page_id, link FROM links WHERE regexp_matches(link, '^/[a-z]') "
       "AND regexp_matches(link, 'n$')")  # fmt: skip
def filter_links(spark, folder):
    return op.filter_links(extract_links(spark, folder), "^/[a-z]", "n$")


@query(r"""SELECT DISTINCT token FROM (SELECT unnest(regexp_split_to_array(text, '\s+')) AS token
           FROM documents) WHERE token <> ''""")
def sorted_tokens(spark, folder):
    words = op.distinct_tokens(table(spark, folder, "documents"), "text", "token")
    return words.orderBy("token")


@query(f"WITH {LINKS_SQL} SELECT DISTINCT link FROM links")
def sorted_link_list(spark, folder):
    return op.sorted_distinct(op.tokens(extract_links(spark, folder), "link"))


@query(
    f"""WITH {LINKS_SQL}, listed AS (SELECT DISTINCT link AS url FROM links
          WHERE regexp_matches(link, '^/') AND regexp_matches(link, '.$'))
    SELECT row_number() OVER (ORDER BY url) - 1 AS file_ord, url,
           regexp_extract(url, '([^/]*)\\.[^./]*$', 1) AS dataset,
           regexp_extract(url, '([^/]*)\\.[^./]*$', 1) || '.csv' AS file FROM listed"""
)
def link_list_roundtrip(spark, folder):
    pages = src.read_pages(spark, f"{folder}/pages.parquet")
    path = scratch_dir(spark, "list")
    return build_dataset_list(spark, pages, path, prefix="^/", suffix=".$")


@query(f"WITH {LINKS_SQL} SELECT row_number() OVER (ORDER BY link) - 1 AS file_ord, link FROM (SELECT DISTINCT link FROM links)")
def merged_link_list(spark, folder):
    # The links of most pages, and then those of the others, merged range by range.
    links = written_side(extract_links(spark, folder), "links")
    path = scratch_dir(spark, "merged")
    late = F.col("page_id") % 10 == 0
    src.merge_links(links.filter(~late), path)
    src.merge_links(links.filter(late), path)
    return src.read_merged_links(spark, path)


@query(r"""SELECT url || '.nc' AS url, regexp_extract(url || '.nc', '([^/]*)\.[^./]*$', 1) AS dataset,
           regexp_extract(url || '.nc', '([^/]*)\.[^./]*$', 1) || '.csv' AS file FROM pages""")
def dataset_names(spark, folder):
    url = F.concat("url", F.lit(".nc"))
    name = dataset_name(url)
    pages = table(spark, folder, "pages")
    return pages.select(url.alias("url"), name.alias("dataset"), with_suffix(name).alias("file"))


# Prefixes


@query(f"""WITH {LADDER_SQL} SELECT fraction_ord, num, den,
           {SIZE_SQL.format(n="(SELECT count(*) FROM lineitem)")} AS size FROM ladder""")
def fraction_ladder(spark, folder):
    return op.prefix_sizes(table(spark, folder, "lineitem"))


@query(f"WITH {YEARS_SQL} SELECT count(*) AS files FROM years")
def file_count(spark, folder):
    return op.row_count(src.list_datasets(lines_by_year(spark, folder)), "files")


@query(f"WITH {YEARS_SQL} SELECT file_ord, dataset FROM years WHERE file_ord < 3")
def first_files(spark, folder):
    return op.first_n_files(src.list_datasets(lines_by_year(spark, folder)), 3)


def year_bound(last: int) -> Column:
    """The rows up to a ship year: years ascend, so a prefix ends at a date, which the scan prunes by."""
    return F.col("l_shipdate") < F.lit(f"{last + 1}-01-01").cast("timestamp_ntz")


@query(
    f"""WITH {YEARS_SQL} SELECT count(*) AS rows, {avg_sql()} FROM lines
    WHERE file_ord < round_even(files * (2.0::DOUBLE / 5), 0)"""
)
def prefix_files(spark, folder):
    years = op.prefix_files(years_of(lines_by_year(spark, folder)), 2, 5)
    last = years.agg(F.max(F.col("dataset").cast("int"))).first()[0]
    lineitem = table(spark, folder, "lineitem")
    prefix = lineitem.filter(F.lit(False) if last is None else year_bound(last))
    return rounded(op.avg_measures(prefix, LINE_MEASURES, with_rows=True))


@query(
    f"""SELECT count(*) AS rows, {avg_sql(["value"])} FROM (
      SELECT value, row_number() OVER (ORDER BY event_id) AS n, count(*) OVER () AS entries
      FROM events) WHERE n <= round_even(entries * (1.0::DOUBLE / 3), 0)"""
)
def prefix_rows_avg(spark, folder):
    prefix = op.prefix_rows(table(spark, folder, "events"), 1, 3, "event_id")
    return rounded(op.avg_measures(prefix, ["value"], with_rows=True))


def prefix_by_sql(order: str) -> str:
    return f"""WITH {LADDER_SQL}, numbered AS (
      SELECT value, event_id, row_number() OVER (ORDER BY {order}) AS n FROM events), sizes AS (
      SELECT *, {SIZE_SQL.format(n="(SELECT count(*) FROM events)")} AS size FROM ladder)
    SELECT fraction_ord, count(n) AS rows, CAST(sum(event_id) AS BIGINT) AS ids, {avg_sql(["value"])}
    FROM sizes LEFT JOIN numbered ON n <= size GROUP BY fraction_ord"""


def prefixes_of_events(spark: SparkSession, folder: str, order: list[str]) -> DataFrame:
    events = table(spark, folder, "events")
    averaged = [
        prefix.agg(
            F.lit(i).alias("fraction_ord"), F.count("*").alias("rows"),
            F.sum("event_id").alias("ids"), F.avg("value").alias("avg_value"),
        )
        for i, prefix in enumerate(op.prefixes_by(events, order))
    ]
    return rounded(reduce(DataFrame.unionByName, averaged))


@query(prefix_by_sql("ts, event_id"))
def prefix_rows_by_time(spark, folder):
    return prefixes_of_events(spark, folder, ["ts", "event_id"])


@query(prefix_by_sql("event_type, user_id, value, event_id"))
def prefix_rows_by_columns(spark, folder):
    return prefixes_of_events(spark, folder, ["event_type", "user_id", "value", "event_id"])


@query(
    f"""WITH {YEARS_SQL}, {LADDER_SQL}, sizes AS (
      SELECT *, {SIZE_SQL.format(n="(SELECT count(*) FROM years)")} AS size FROM ladder)
    SELECT fraction_ord, num, den, size, count(lines.file_ord) AS rows, {avg_sql()}
    FROM sizes LEFT JOIN lines ON lines.file_ord < size GROUP BY fraction_ord, num, den, size"""
)
def prefix_averages(spark, folder):
    lines = lines_by_year(spark, folder)
    years = years_of(lines)
    prefixes = op.file_prefixes(years.count())
    return rounded(
        op.prefix_averages(
            op.assign_file_ord(lines, years), "file_ord", prefixes, LINE_MEASURES
        )
    )


@query(
    f"""WITH {LADDER_SQL}, numbered AS (
      SELECT value, row_number() OVER (ORDER BY event_id) AS n FROM events), sizes AS (
      SELECT *, {SIZE_SQL.format(n="(SELECT count(*) FROM events)")} AS size FROM ladder)
    SELECT fraction_ord, num, den, size, count(n) AS rows, {avg_sql(["value"])}
    FROM sizes LEFT JOIN numbered ON n <= size GROUP BY fraction_ord, num, den, size"""
)
def prefix_averages_rows(spark, folder):
    events = table(spark, folder, "events")
    prefixes = op.row_prefixes(events, "event_id")
    return rounded(op.prefix_averages(events, "event_id", prefixes, ["value"]))


@query(
    f"""WITH {YEARS_SQL}, {LADDER_SQL}, sizes AS (
      SELECT *, {SIZE_SQL.format(n="(SELECT count(*) FROM years)")} AS size FROM ladder)
    SELECT fraction_ord, num, den, size, count(lines.file_ord) AS rows, {avg_sql()}
    FROM sizes LEFT JOIN lines ON lines.file_ord < size GROUP BY fraction_ord, num, den, size"""
)
def prefix_state(spark, folder):
    # The state of some files first, then of all; the ten prefixes are answered from it.
    root, kept = staged_csv(spark, folder), scratch_dir(spark, "states")
    src.refresh_measure_states(spark, year_paths(spark, root)[:4], kept, LINE_MEASURES, base_path=root)
    states = src.refresh_measure_states(spark, [root], kept, LINE_MEASURES, base_path=root)
    years = years_of(lines_by_year(spark, folder))
    named = states.withColumn("dataset", F.regexp_extract("file", "/dataset=([^/]*)/", 1))
    prefixes = op.file_prefixes(years.count())
    return rounded(op.prefix_state_averages(op.assign_file_ord(named, years), prefixes, LINE_MEASURES))


@query(
    f"""WITH {YEARS_SQL}, sums AS (
      SELECT file_ord, dataset, rows, sum(rows) OVER (ORDER BY file_ord) - rows AS before FROM years)
    SELECT file_ord, dataset, rows, CAST(before AS BIGINT) AS rows_before FROM sums
    WHERE before <= {ROW_BUDGET}"""
)
def row_budget_files(spark, folder):
    lines = lines_by_year(spark, folder)
    counts = written_side(lines.groupBy("dataset").agg(F.count("*").alias("rows")), "counts")
    listed = op.assign_file_ord(counts, src.list_datasets(counts))
    return op.row_budget_files(listed.select("file_ord", "dataset", "rows"), ROW_BUDGET)


# Partition counts


def staged_years(spark: SparkSession, folder: str) -> list[str]:
    """``lineitem`` as one Parquet folder per ship year, in order.

    Rebalanced, so that a year, or several that fall together, may be cut into several tasks. A cell of
    one partition reads all files in one task, so they are made small.
    """
    root = scratch_dir(spark, "years")
    lines = lines_by_year(spark, folder).hint("rebalance", F.col("dataset"))
    lines.write.partitionBy("dataset").option("compression", "zstd").parquet(root)
    return year_paths(spark, root)


def sweep(spark: SparkSession, folder: str, mode: str, skipped=None) -> DataFrame:
    """Every prefix of the files of the ship years at every partition count up to its files."""
    paths = staged_years(spark, folder)
    schema = ", ".join(f"{m} double" for m in LINE_MEASURES)

    def build(size: int) -> DataFrame:
        # A scan for each file, so that a file is a partition at least.
        files = [spark.read.schema(schema).parquet(path) for path in paths[:size]]
        return reduce(DataFrame.union, files)

    prefixes = op.file_prefixes(len(paths))
    cases = [Case(p.size, partial(build, p.size), range(1, p.size + 1)) for p in prefixes if p.size]
    return rounded(partition_sweep(spark, cases, mode, LINE_MEASURES, skipped=skipped))


def sweep_sql(mode: str, where: str = "TRUE") -> str:
    return f"""WITH {YEARS_SQL}, {LADDER_SQL}, sizes AS (
      SELECT *, {SIZE_SQL.format(n="(SELECT count(*) FROM years)")} AS scale FROM ladder),
    averaged AS (SELECT fraction_ord, scale, count(lines.file_ord) AS rows, {avg_sql()}
      FROM sizes LEFT JOIN lines ON lines.file_ord < scale GROUP BY fraction_ord, scale),
    cells AS (SELECT *, CAST(unnest(range(1, scale + 1)) AS INT) AS partitions FROM averaged)
    SELECT '{mode}' AS mode, fraction_ord, scale, partitions, partitions AS actual_partitions,
           rows, {", ".join(f"avg_{m}" for m in LINE_MEASURES)} FROM cells WHERE {where}"""


@query(sweep_sql("repartition"))
def sweep_repartition(spark, folder):
    return sweep(spark, folder, "repartition").drop("create_s", "avg_s")


@query(sweep_sql("coalesce"))
def sweep_coalesce(spark, folder):
    return sweep(spark, folder, "coalesce").drop("create_s", "avg_s")


@query(sweep_sql("coalesce", "NOT (fraction_ord = 6 AND partitions > 2)"))
def sweep_skip_cells(spark, folder):
    skipped = (F.col("fraction_ord") == 6) & (F.col("partitions") > 2)
    return sweep(spark, folder, "coalesce", skipped).drop("create_s", "avg_s")


@query(
    f"""WITH {LADDER_SQL}, numbered AS (
      SELECT value, row_number() OVER (ORDER BY event_id) AS n FROM events), sizes AS (
      SELECT *, {SIZE_SQL.format(n="(SELECT count(*) FROM events)")} AS scale FROM ladder),
    averaged AS (SELECT fraction_ord, scale, count(n) AS rows, {avg_sql(["value"])}
      FROM sizes LEFT JOIN numbered ON n <= scale GROUP BY fraction_ord, scale),
    cells AS (SELECT *, CAST(unnest(range(1, (SELECT count(DISTINCT event_type) FROM events) + 1)) AS INT) AS partitions FROM averaged)
    SELECT 'repartition' AS mode, fraction_ord, scale, partitions,
           partitions AS actual_partitions, rows, avg_value FROM cells"""
)
def sweep_rows(spark, folder):
    # The same study with rows instead of files as the unit, over the files of the event
    # types. Every count is tried, up to the partitions of the scan.
    root = scratch_dir(spark, "types")
    events = table(spark, folder, "events").select("event_id", "value", "event_type")
    events.repartition("event_type").write.partitionBy("event_type").parquet(root)
    types = spark.read.parquet(root)
    names = [row[0] for row in types.select("event_type").distinct().collect()]
    # A scan for each file, so that a file is a partition at least.
    files = [types.filter(F.col("event_type") == name) for name in sorted(names)]

    def build(last: int) -> DataFrame:
        return reduce(DataFrame.union, [f.filter(F.col("event_id") <= last) for f in files])

    cases = [Case(p.size, partial(build, p.last)) for p in op.row_prefixes(types, "event_id")]
    timed = partition_sweep(spark, cases, "repartition", ["value"])
    return rounded(timed).drop("create_s", "avg_s")


@query(
    f"""WITH {YEARS_SQL} SELECT CAST(n AS INT) AS partitions, (SELECT count(*) FROM lineitem) AS rows, {REPEATS} AS repeats,
    TRUE AS ordered, TRUE AS same_bits FROM (SELECT unnest(range(1, count(*) + 1)) AS n FROM years)"""
)
def sweep_repeats(spark, folder):
    # Median and spread of repeated cells; exact sums agree to the last bit over all counts.
    paths = staged_years(spark, folder)
    files = [spark.read.parquet(path) for path in paths]
    whole = Case(len(paths), lambda: reduce(DataFrame.union, files))
    cells = partition_sweep(spark, [whole], "repartition", LINE_MEASURES, repeats=REPEATS, exact=True)
    averages = F.struct(*[f"avg_{m}" for m in LINE_MEASURES])
    sets = cells.agg(F.count_distinct(averages).alias("sets"))
    return cells.select(
        "partitions", "rows", "repeats",
        ((F.col("avg_s_low") <= F.col("avg_s_median")) & (F.col("avg_s_median") <= F.col("avg_s_high"))).alias("ordered"),
        (sets.scalar() == 1).alias("same_bits"),
    )


@query(f"SELECT CAST({SPREAD} AS BIGINT) AS partitions, count(*) AS rows FROM events")
def partition_sizes(spark, folder):
    spread = op.repartition_to(table(spark, folder, "events").select("event_id"), SPREAD)
    return op.partition_sizes(spread).agg(
        F.count("*").alias("partitions"), F.sum("rows").alias("rows")
    )


# Timing tables


@query(f"WITH {TIMINGS_SQL} SELECT max(partitions) AS max_partitions FROM timings")
def max_partitions(spark, folder):
    return op.max_partitions(timings(spark, folder)).select(
        F.col("max_partitions").cast("bigint").alias("max_partitions")
    )


@query("SELECT DISTINCT user_id AS scale FROM events")
def distinct_scales(spark, folder):
    return op.distinct_scales(timings(spark, folder))


@query(
    f"""WITH {TIMINGS_SQL}, grid AS (
      SELECT scale, partitions FROM (SELECT DISTINCT scale FROM timings)
      CROSS JOIN (SELECT unnest(range(1, (SELECT max(partitions) FROM timings) + 1)) AS partitions))
    SELECT scale, CAST(grid.partitions AS INT) AS partitions, create_s, avg_s
    FROM grid LEFT JOIN timings USING (scale, partitions)"""
)
def complete_grid(spark, folder):
    return op.complete_grid(written_timings(spark, folder))


DAYS = range(1, 32)


def pivot_sql(value: str) -> str:
    cells = ", ".join(
        f"max({value}) FILTER (WHERE partitions = {d}) AS {value}_{d}" for d in DAYS
    )
    return f"WITH {TIMINGS_SQL} SELECT scale, {cells} FROM timings GROUP BY scale"


@query(pivot_sql("create_s"))
def pivot_create(spark, folder):
    return op.pivot_series(timings(spark, folder), "create_s", DAYS)


@query(pivot_sql("avg_s"))
def pivot_average(spark, folder):
    return op.pivot_series(op.complete_grid(written_timings(spark, folder)), "avg_s", DAYS)


@query(
    f"""WITH {TIMINGS_SQL} SELECT printf('scale %d, partitions %d: created in %.9f s, '
    || 'averaged in %.9f s', scale, partitions, create_s, avg_s) AS line FROM timings"""
)
def timing_report(spark, folder):
    return op.report_lines(timings(spark, folder))


@query(f"WITH {TIMINGS_SQL} SELECT scale, CAST(partitions AS INT) AS partitions, "
       "create_s, avg_s FROM timings")  # fmt: skip
def timings_roundtrip(spark, folder):
    return written_timings(spark, folder)


# Grids

VECTOR_DIMS = {"point": None}
VECTOR_VARIABLES = {"label": (), "embedding": ("point",)}
POINTS_SQL = """
points AS (SELECT vec_id, label, generate_subscripts(embedding, 1) - 1 AS point,
                  CAST(unnest(embedding) AS DOUBLE) AS embedding FROM embeddings)"""


def as_double(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.col(name).cast("double") for name in names})


@query(f"WITH {POINTS_SQL} SELECT vec_id, CAST(point AS INT) AS point, label, embedding FROM points")
def flatten_grid(spark, folder):
    grid = table(spark, folder, "embeddings")
    flat = op.flatten_grid(grid, VECTOR_DIMS, VECTOR_VARIABLES, keep=["vec_id"])
    return as_double(flat, "embedding")


@query(f"WITH {POINTS_SQL} SELECT vec_id, CAST(point AS INT) AS point, embedding FROM points")
def project_variable(spark, folder):
    grid = table(spark, folder, "embeddings")
    flat = op.project_variable(grid, VECTOR_DIMS, VECTOR_VARIABLES, "embedding", ["vec_id"])
    return as_double(flat, "embedding")


PLANE_DIMS = {"depth": "depths", "column": None}
PLANE_VARIABLES = {"value": ("depth", "column"), "surface": ("column",), "label": ()}


def planes(spark: SparkSession, folder: str) -> DataFrame:
    """Each vector folded into rows of eight, with a coordinate per row."""
    rows = F.sequence(F.lit(0), F.floor((F.size("embedding") - 1) / 8).cast("int"))
    return table(spark, folder, "embeddings").select(
        "vec_id",
        "label",
        F.transform(rows, lambda i: i * 10).alias("depths"),
        F.transform(rows, lambda i: F.slice("embedding", i * 8 + 1, 8)).alias("value"),
        F.slice("embedding", 1, 8).alias("surface"),
    )


@query(
    f"""WITH {POINTS_SQL} SELECT p.vec_id, CAST(p.point // 8 * 10 AS INT) AS depth,
    CAST(p.point % 8 AS INT) AS "column", p.embedding AS value, s.embedding AS surface, p.label
    FROM points p JOIN points s ON s.vec_id = p.vec_id AND s.point = p.point % 8"""
)
def flatten_grid_2d(spark, folder):
    grid = planes(spark, folder)
    flat = op.flatten_grid(grid, PLANE_DIMS, PLANE_VARIABLES, keep=["vec_id"])
    return as_double(flat, "value", "surface")


@query(
    f"""WITH {POINTS_SQL} SELECT CAST(label AS VARCHAR) AS dataset, count(*) AS rows,
    {avg_sql(["embedding"])} FROM points GROUP BY 1"""
)
def ingest_grids_avg(spark, folder):
    root = scratch_dir(spark, "grids")
    grids = table(spark, folder, "embeddings").withColumnRenamed("label", "dataset")
    ingest_grids(grids, VECTOR_DIMS, {"embedding": ("point",)}, root)
    flat = src.read_measurements(spark, [root], base_path=root)
    return flat.groupBy("dataset").agg(
        F.count("*").alias("rows"),
        F.round(F.avg(F.col("embedding").try_cast("double")), DIGITS).alias("avg_embedding"),
    )


BLOCK_DIMS = {"depth": "depths", "column": None}
BLOCK_VARIABLES = {"value": ("column", "depth"), "double": ("depth", "column"), "surface": ("column",), "label": ()}
BLOCK_SIDE = 8


def plane_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """The vectors, one below the other, as one array, kept as blocks of several cuts.

    A vector is eight rows of eight. The array has a variable with its dimensions the other way
    round, another one in other blocks, and some of fewer dimensions.
    """
    vectors = table(spark, folder, "embeddings").select("vec_id", F.lit("all").alias("dataset"), "embedding", "label")
    numbers = F.col("embedding").cast("array<double>")
    rows = F.slice(numbers, 1, BLOCK_SIDE * BLOCK_SIDE)
    turned = F.transform(
        F.sequence(F.lit(0), F.lit(BLOCK_SIDE * BLOCK_SIDE - 1)),
        lambda k: F.get(numbers, k % BLOCK_SIDE * BLOCK_SIDE + F.floor(k / BLOCK_SIDE).cast("int")),
    )
    at = F.col("vec_id") * BLOCK_SIDE
    size, zero = [BLOCK_SIDE, BLOCK_SIDE], F.lit(0)
    depths = F.transform(F.sequence(F.lit(0), F.lit(BLOCK_SIDE - 1)), lambda i: (at + i) * 10.0)
    first = vectors.filter("vec_id = 0")
    parts = [
        op.cut_into_blocks(vectors, "value", turned, size, [3, 8], origin=[zero, at]),
        op.cut_into_blocks(vectors, "double", F.transform(rows, lambda x: x * 2), size, [8, 5], origin=[at, zero]),
        op.cut_into_blocks(vectors, "depths", depths, [BLOCK_SIDE], [BLOCK_SIDE], origin=[at]),
        op.cut_into_blocks(first, "surface", F.slice(numbers, 1, BLOCK_SIDE), [BLOCK_SIDE], [4], origin=[zero]),
        op.cut_into_blocks(first, "label", F.array(F.col("label").cast("double")), [], [], origin=[]),
    ]
    return reduce(DataFrame.unionByName, parts)


@query(
    f"""WITH {POINTS_SQL}, first AS (SELECT * FROM points WHERE vec_id = 0)
    SELECT 'all' AS dataset, (p.vec_id * 8 + p.point // 8) * 10.0::DOUBLE AS depth, p.point % 8 AS "column",
    p.embedding AS value, p.embedding * 2 AS double, s.embedding AS surface, CAST(s.label AS DOUBLE) AS label
    FROM points p LEFT JOIN first s ON s.point = p.point % 8"""
)
def flatten_blocks(spark, folder):
    return op.flatten_blocks(plane_blocks(spark, folder), BLOCK_DIMS, BLOCK_VARIABLES)


STUDY_HOST = "https://h.example/auto"
# About the bytes of a point's line of CSV.
POINT_BYTES = 16


def ingested(spark: SparkSession, folder: str, parts: int | None = None) -> str:
    """The vectors as CSV by label, in the order of their ids, with falling coordinates."""
    root = scratch_dir(spark, "grids")
    falling = F.transform("embedding", lambda _, i: F.size("embedding") - i)
    grids = table(spark, folder, "embeddings").withColumn("at", falling)
    grids = grids.withColumnRenamed("label", "dataset")
    variables = {"embedding": ("point",)}
    ingest_grids(grids, {"point": "at"}, variables, root, order_by=["vec_id"], parts=parts)
    return root


@query(
    f"""WITH {POINTS_SQL}, {LADDER_SQL}, listed AS (
      SELECT CAST(label AS VARCHAR) AS dataset, row_number() OVER (ORDER BY CAST(label AS VARCHAR) || '.nc') AS n
      FROM (SELECT DISTINCT label FROM embeddings)),
    sizes AS (SELECT *, {SIZE_SQL.format(n="(SELECT count(*) FROM listed)")} AS scale FROM ladder)
    SELECT fraction_ord - first AS fraction_ord, scale, count(*) AS rows, {avg_sql(["embedding"])}, TRUE AS every_count
    FROM (SELECT *, min(fraction_ord) OVER () AS first FROM sizes WHERE scale > 0)
    JOIN listed ON n <= scale JOIN points ON CAST(points.label AS VARCHAR) = dataset
    GROUP BY ALL"""
)
def study_chain(spark, folder):
    # Grids to CSV, addresses to a list, and the study of what the list names.
    # Each cell parses its CSV again, so it is kept as even files that scans read whole.
    vectors = table(spark, folder, "embeddings")
    (points,) = vectors.agg(F.coalesce(F.sum(F.array_size("embedding")), F.lit(0))).first()
    parts = src.part_count(spark, points, POINT_BYTES)
    root, listed = ingested(spark, folder, parts), scratch_dir(spark, "list")
    labels = vectors.select("label").distinct()
    url = F.concat(F.lit(f"{STUDY_HOST}/"), F.col("label").cast("string"), F.lit(".nc"))
    src.write_sorted_links(labels.select(url.alias("link")), listed)
    study = partition_study(
        spark, listed, root, scratch_dir(spark, "study"), mode="repartition",
        measures=["embedding"], layout="folders", multi_line=True,
    )
    # Every count up to the partitions of the scan gives the same averages.
    cells = rounded(study.timings).groupBy("fraction_ord", "scale", "rows", "avg_embedding")
    tried = cells.agg((F.count("*") == F.max("partitions")).alias("every_count"))
    return tried.select("fraction_ord", "scale", "rows", "avg_embedding", "every_count")


@query(
    f"""WITH {POINTS_SQL}, numbered AS (
      SELECT *, row_number() OVER (ORDER BY CAST(label AS VARCHAR), vec_id, point) AS n,
             max(point) OVER (PARTITION BY vec_id) + 1 - point AS falling, count(*) OVER () AS entries FROM points)
    SELECT CAST(label AS VARCHAR) AS dataset, count(*) AS rows, round(avg(falling), {DIGITS}) AS avg_point,
           round(avg(embedding), {DIGITS}) AS avg_embedding
    FROM numbered WHERE n <= round_even(entries * (1.0::DOUBLE / 3), 0) GROUP BY 1"""
)
def ingest_row_prefix(spark, folder):
    # Row prefixes of ingested grids follow the grids, whatever their coordinates are.
    root = ingested(spark, folder)
    paths = year_paths(spark, root)
    counted = list(zip(paths, src.row_counts(spark, paths)))
    size = op.prefix_size(sum(rows for _, rows in counted), 1, 3)
    prefix = src.read_row_prefix(spark, counted, size, base_path=root)
    averages = [F.avg(F.col(m).try_cast("double")).alias(f"avg_{m}") for m in ("point", "embedding")]
    return rounded(prefix.groupBy("dataset").agg(F.count("*").alias("rows"), *averages))
