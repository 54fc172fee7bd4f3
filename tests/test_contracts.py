"""What callers may rely on: no early jobs, no lost parts, no stale months, sound lists, orders across partitions."""

import os
from itertools import pairwise

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from landfall.catalog import bindings as b
from landfall.catalog.oracle import SQL
from landfall.catalog.queries import QUERIES
from landfall.operators import joins, quality
from landfall.operators.clean import clean_ports
from landfall.plans import months, staging
from landfall.schemas import ISO
from landfall.session import workspace
from landfall.sources import extracts, files, lookups, tables
from landfall.streaming import incremental
from tests.comparing import SF_DIR, TABLES, assert_same
from tests.test_files import extract_row, lists, write_extract  # noqa: F401

READING = [
    "fact_immigrations", "star_join", "join_fact_time", "join_fact_port", "join_fact_port_spread", "dim_countries", "dim_time",
    "dq_report", "nationalities_by_airport", "nationalities_from_extract", "top_airports", "dropped_rows", "order_fact",
]


@pytest.mark.parametrize("name", READING)
def test_building_a_query_runs_no_job(spark, name):
    context = spark.sparkContext
    context.setJobGroup(f"plan {name}", name)
    try:
        QUERIES[name](spark, SF_DIR)
        assert not context.statusTracker().getJobIdsForGroup(f"plan {name}")
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)


def test_all_parts_of_the_last_delivery_are_read(spark):
    root = workspace(spark)
    for folder, part, number in (("a", "_part1", 1), ("b", "_part1", 2), ("b", "_part2", 3)):
        write_extract(spark, f"{root}/{folder}", f"i94_jan16_sub{part}.parquet", [extract_row(number, 2016, 1, 20454.0)])
    assert sorted(r["cicid"] for r in extracts.scan_latest(spark, root).collect()) == [2.0, 3.0]
    left = files.superseded(files.discover_inputs(spark, root)).collect()
    assert [r["path"].rsplit("/", 2)[1] for r in left] == ["a"]


def test_foreign_files_in_an_extract_are_passed_over(spark):
    root = workspace(spark)
    write_extract(spark, f"{root}/i94_jan16_sub", "part-0.parquet", [extract_row(1, 2016, 1, 20454.0)])
    with open(f"{root}/i94_jan16_sub/notes.txt", "w") as notes:
        notes.write("not data")
    assert extracts.scan_latest(spark, root).count() == 1


def test_a_missing_column_stops_the_job(spark):
    root = workspace(spark)
    crossed = b.crossings(spark, SF_DIR).drop("i94mode", "airline").limit(5)
    b.write_extracts(crossed, root)
    with pytest.raises(ValueError, match="i94mode, airline"):
        extracts.scan_latest(spark, root, schema=b.BOUND_EXTRACT)


def test_a_run_with_fewer_months_leaves_none_of_the_last(spark):
    base = workspace(spark)

    def run(crossed, stamp):
        sources = staging.Staged(crossed, b.ports(spark, SF_DIR), b.countries(spark, SF_DIR), b.iso(spark, SF_DIR))
        return months.run_all_months(spark, sources, base, stamp).collect()

    crossed = b.crossings(spark, SF_DIR)
    run(crossed, "2016-01-01")
    report = run(crossed.where("i94yr = 1996"), "2016-02-01")
    assert {r["status"] for r in report} == {"OK"}
    star = months.read_star(spark, base)
    fact = star["immigrations"]
    assert [r[0] for r in fact.select("arrival_year").distinct().collect()] == [1996]
    assert fact.join(star["admissions"], "admission_nbr", "left_anti").count() == 0
    assert months.complete_runs(spark, base) == ["2016-01-01", "2016-02-01"]
    # A run that did not get to its report is not read.
    os.makedirs(f"{base}/run=2016-03-01/immigrations")
    assert months.read_star(spark, base)["immigrations"].count() == fact.count()


@pytest.fixture(scope="module")
def dangling_dir(spark):
    """Every second part, supplier, order and customer is missing."""
    path = workspace(spark)
    keys = {"part": "p_partkey", "supplier": "s_suppkey", "orders": "o_orderkey", "customer": "c_custkey"}
    for name in TABLES:
        df = b.table(spark, SF_DIR, name)
        df = df.where(F.col(keys[name]) % 2 == 0) if name in keys else df
        df.write.parquet(f"{path}/{name}.parquet")
    return path


@pytest.mark.parametrize(
    "name",
    [
        "df_count", "dim_time", "dim_admissions", "fact_immigrations", "nationalities_by_airport", "nationalities_from_extract",
        "star_join", "top_airports", "dropped_rows", "dq_report", "fill_nulls", "join_fact_country", "count_rows",
    ],
)
def test_crossings_do_not_depend_on_the_columns_wanted(spark, dangling_dir, name):
    assert_same(QUERIES[name](spark, dangling_dir), SQL[name], dangling_dir)


def test_a_shuffled_fact_has_few_files(spark):
    base = workspace(spark)
    sources = staging.Staged(
        b.crossings(spark, SF_DIR), b.ports(spark, SF_DIR), b.countries(spark, SF_DIR), b.iso(spark, SF_DIR)
    )
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        months.write_star(months.build_star(sources), base)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    found = [f for _, _, names in os.walk(f"{base}/immigrations") for f in names if f.endswith(".parquet")]
    folders = tables.scan_parquet(spark, f"{base}/immigrations").select("arrival_year", "arrival_month").distinct().count()
    assert len(found) <= 2 * folders


def test_null_keys_and_repeated_codes_of_lists(spark):
    iso = b.raw_iso(spark, SF_DIR)
    with pytest.raises(PySparkException, match="country_code is null"):
        lookups.apply_schema(iso.withColumn("country-code", F.lit(None).cast("string")), ISO, "country_code").collect()
    ports = spark.createDataFrame([("P1",), ("P1",), ("P2",)], "i94_port STRING")
    report = quality.dq_report({}, "r", lists={"ports": (ports, "i94_port")}).collect()
    assert [tuple(r) for r in report] == [("r", "ports", 3, 1, "NOK")]


def test_the_airport_list_is_staged(spark):
    base = workspace(spark)
    rows = b.table(spark, SF_DIR, "nation")
    sources = staging.Staged(rows, rows, rows, rows, b.raw_iata(spark, SF_DIR))
    assert staging.stage_tables(spark, sources, base).iata.columns == b.raw_iata(spark, SF_DIR).columns
    assert os.path.isdir(f"{base}/iata_staging")


def test_updates_keep_the_whole_star(spark, lists):  # noqa: F811
    base = workspace(spark)
    root, out, progress = f"{base}/in", f"{base}/out", f"{base}/progress"

    def update():
        incremental.incremental_months(spark, root, out, progress, *lists).awaitTermination()
        return {name: incremental.read_incremental(spark, out, name) for name in incremental.TABLES}

    write_extract(spark, f"{root}/a", "i94_jan16_sub.parquet", [extract_row(k, 2016, 1, 20454.0 + k) for k in range(3)])
    write_extract(spark, f"{root}/a", "i94_feb16_sub.parquet", [extract_row(9, 2016, 2, 20485.0)])
    update()
    write_extract(spark, f"{root}/b", "i94_jan16_sub.parquet", [extract_row(7, 2016, 1, 20460.0)])
    star = update()
    fact, time, admissions = (star[name] for name in incremental.TABLES)
    assert sorted(r["admission_nbr"] for r in fact.collect()) == sorted(r["admission_nbr"] for r in admissions.collect()) == [7.0, 9.0]
    assert fact.join(time, fact["arrival_time"] == time["arrival_ts"], "left_anti").count() == 0
    assert time.count() == 2
    month = tables.of_month(fact, 2016, 1)
    assert month.count() == 1
    assert "PartitionFilters: [isnotnull(arrival_year" in month._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name, by",
    [
        ("order_admissions", ["country_code"]), ("order_countries", ["country_name"]),
        ("order_airports", ["airport_name"]), ("order_fact", ["arrival_time"]),
    ],
)
def test_partitions_follow_one_another_in_order(spark, name, by):
    ordered = QUERIES[name](spark, SF_DIR)
    rows = ordered.select(*by, F.spark_partition_id().alias("part")).collect()
    none_first = [tuple((r[c] is not None, r[c]) for c in by) for r in rows]
    assert all(x <= y for x, y in pairwise(none_first))
    assert [r["part"] for r in rows] == sorted(r["part"] for r in rows)


def test_shapes_of_the_published_lists(spark):
    """Hand-made lists of the known sizes: 289 countries of which 60 have no ISO number and 27 short ones are padded."""
    numbers = [0] * 60 + list(range(1, 28)) + list(range(100, 302))
    countries = spark.createDataFrame([(str(k), f"C{k}", str(n)) for k, n in enumerate(numbers)], "i94_cit STRING, i94_country_name STRING, iso_country_code STRING")
    padded = [n for n in numbers if n]
    rows = [tuple([f"I{n}", "A", "B", f"{n:03d}"] + [None] * 7) for n in padded]
    iso = spark.createDataFrame(rows, ISO)
    assert joins.join_country_iso(countries, iso).count() == 229
    assert countries.join(iso, countries["iso_country_code"] == iso["country_code"]).count() == 202
    ports = spark.createDataFrame([(f"'P{k} '", f"'TOWN {k}'" if k < 91 else f"'TOWN {k}, AK  '") for k in range(660)], "code STRING, name STRING")
    cleaned = clean_ports(ports)
    assert (cleaned.count(), cleaned.where("i94_airport_state = 'NaN'").count()) == (660, 91)
