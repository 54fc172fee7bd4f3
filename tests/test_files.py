"""Finding, reading, writing and updating on disk."""

import os
from collections import Counter
from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from landfall.catalog import bindings as b
from landfall.operators.quality import dq_report
from landfall.plans import months
from landfall.schemas import EXTRACT, ISO, PORTS
from landfall.session import workspace
from landfall.sinks import snapshots, writers
from landfall.sources import extracts, files, lookups, tables
from landfall.streaming import incremental
from tests.comparing import SF_DIR


def extract_row(number, year, month, day, port="P1", country=1.0, left=None):
    values = dict.fromkeys(EXTRACT.names)
    values |= {"cicid": float(number), "i94yr": float(year), "i94mon": float(month), "i94cit": country, "i94port": port}
    values |= {"arrdate": day, "depdate": left, "admnum": float(number)}
    return tuple(values[name] for name in EXTRACT.names)


def write_extract(spark, root, name, data):
    """A single file with the extract's own name."""
    parts = f"{workspace(spark)}/parts"
    spark.createDataFrame(data, EXTRACT).coalesce(1).write.parquet(parts)
    part = next(f for f in os.listdir(parts) if f.endswith(".parquet"))
    os.makedirs(root, exist_ok=True)
    os.link(f"{parts}/{part}", f"{root}/{name}")


@pytest.fixture
def lists(spark):
    ports = spark.createDataFrame([("P1", "ONE", "AK"), ("P2", "TWO", "NaN")], PORTS)
    countries = spark.createDataFrame([("1", "A", "4"), ("2", "B", "0")], "i94_cit STRING, i94_country_name STRING, iso_country_code STRING")
    return countries, ports


def test_months_from_names(spark):
    paths = ["/in/x/i94_jan16_sub.parquet", "/in/i94_dec15_sub/part-0.parquet", "/in/extract=i94_may99_sub/p.parquet"]
    df = spark.createDataFrame([(p,) for p in paths], "path STRING")
    marked = files.with_file_month(df).collect()
    assert [(r["extract_year"], r["extract_month"]) for r in marked] == [(2016, 1), (2015, 12), (1999, 5)]
    assert marked[1]["extract"] == "/in/i94_dec15_sub"


def test_unknown_month_stops_the_job(spark):
    df = spark.createDataFrame([("/in/i94_xyz16_sub.parquet",)], "path STRING")
    with pytest.raises(PySparkException, match="no month in file name"):
        files.with_file_month(df).collect()


def test_last_extract_of_a_month_wins(spark):
    root = workspace(spark)
    write_extract(spark, f"{root}/a", "i94_feb16_sub.parquet", [extract_row(1, 2016, 2, 20485.0)])
    write_extract(spark, f"{root}/b", "i94_feb16_sub.parquet", [extract_row(2, 2016, 2, 20485.0)])
    write_extract(spark, f"{root}/a", "i94_jan16_sub.parquet", [extract_row(3, 2016, 1, 20454.0)])
    write_extract(spark, f"{root}/a", "i94_feb15_sub.parquet", [extract_row(4, 2015, 2, 20120.0)])
    found = files.order_months(files.discover_inputs(spark, root)).collect()
    assert [(r["extract_year"], r["extract_month"]) for r in found] == [(2015, 2), (2016, 1), (2016, 2)]
    latest = extracts.scan_latest(spark, root)
    assert sorted(r["cicid"] for r in latest.collect()) == [2.0, 3.0, 4.0]


def test_only_matching_names_are_found(spark):
    root = workspace(spark)
    write_extract(spark, root, "i94_jan16_sub.parquet", [extract_row(1, 2016, 1, 20454.0)])
    write_extract(spark, root, "i94_jan16_sub.other", [extract_row(2, 2016, 1, 20454.0)])
    assert files.discover_inputs(spark, root).count() == 1


def test_missing_extracts_are_an_error(spark):
    root = workspace(spark)
    write_extract(spark, root, "i94_jan16_sub.other", [extract_row(1, 2016, 1, 20454.0)])
    with pytest.raises(FileNotFoundError):
        extracts.scan_latest(spark, root)


def test_csv_extract(spark):
    path = workspace(spark)
    data = [extract_row(1, 2016, 1, 20454.0, left=20460.0)]
    writers.write_clean_csv(spark.createDataFrame(data, EXTRACT), path)
    assert [tuple(r) for r in extracts.scan_admissions(spark, path, file_format="csv").collect()] == data
    turned = spark.createDataFrame(data, EXTRACT).select(*reversed(EXTRACT.names))
    writers.write_clean_csv(turned, f"{path}-turned")
    with pytest.raises(Exception, match="CSV header does not conform"):
        extracts.scan_admissions(spark, f"{path}-turned", file_format="csv").collect()


def test_iso_list_keeps_na_and_drops_padding(spark):
    path = workspace(spark)
    os.makedirs(path)
    # Two lines as published, after the columns' names.
    lines = [
        ",".join(ISO.names),
        'Namibia,NA,NAM,516,ISO 3166-2:NA,Africa,Sub-Saharan Africa,"",002,202,""',
        'Antarctica,AQ,ATA,010,ISO 3166-2:AQ,"","","","","",""',
    ]
    with open(f"{path}/iso.csv", "w") as out:
        out.write("\n".join(lines) + "\n")
    rows = {r["name"]: r for r in lookups.scan_iso(spark, path).collect()}
    assert rows["Namibia"]["alpha_2"] == "NA" and rows["Namibia"]["region_code"] == "002"
    assert rows["Antarctica"]["country_code"] == "10" and rows["Antarctica"]["region"] is None


def test_csv_keeps_blanks_commas_and_quotes(spark):
    path = workspace(spark)
    data = [(" A ", 'B, "C"', "NaN")]
    writers.write_clean_csv(spark.createDataFrame(data, PORTS), path)
    assert [tuple(r) for r in lookups.scan_list(spark, path, PORTS).collect()] == data


def test_run_path():
    stamp = writers.run_stamp(datetime(2016, 1, 31, 7, 5, 9, 12))
    assert stamp == "2016-01-31-07-05-09-000012"
    assert writers.run_path("/out/", "time", stamp) == f"/out/run={stamp}/time"


def test_partitioned_write_replaces_only_what_it_holds(spark):
    path = workspace(spark)
    first = spark.createDataFrame([(1, "old", 2016), (2, "old", 2017)], "id INT, v STRING, y INT")
    again = spark.createDataFrame([(3, "new", 2017)], "id INT, v STRING, y INT")
    for df in (first, again, again):
        writers.write_partitioned(df, path, ["y"], ["id"])
    assert Counter(tuple(r) for r in tables.scan_parquet(spark, path).collect()) == Counter([(1, "old", 2016), (3, "new", 2017)])
    writers.write_partitioned(again, path, ["y"], append=True)
    assert tables.scan_parquet(spark, path).count() == 3


def test_partitioned_write_splits_a_folder_that_holds_most_rows(spark):
    path = workspace(spark)
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "16KB")
    try:
        df = spark.range(0, 60_000, 1, 8).select("id", F.when(F.col("id") % 3 > 0, 1).otherwise(F.col("id") % 9).alias("y"))
        writers.write_partitioned(df, path, ["y"], ["id"])
    finally:
        spark.conf.set(name, before)
    parts = {y: [f for f in os.listdir(f"{path}/{y}") if f.endswith(".parquet")] for y in os.listdir(path) if y.startswith("y=")}
    assert len(parts["y=1"]) > 1 and len(parts["y=3"]) < len(parts["y=1"])
    assert tables.scan_parquet(spark, path).count() == 60_000


def test_month_read_prunes_folders(spark):
    path = workspace(spark)
    df = spark.createDataFrame([(1, 2016, 1), (2, 2016, 2), (3, 2017, 1)], "id INT, arrival_year INT, arrival_month INT")
    writers.write_partitioned(df, path, ["arrival_year", "arrival_month"])
    month = tables.read_month(spark, path, 2016, 2)
    assert [r["id"] for r in month.collect()] == [2]
    assert "PartitionFilters: [isnotnull(arrival_year" in month._jdf.queryExecution().executedPlan().toString()


def read(spark, base):
    return sorted((r["immigration_id"], r["departure_date"].year) for r in incremental.read_incremental(spark, base).collect())


def test_changed_months_are_rebuilt_and_others_kept(spark, lists):
    base = workspace(spark)
    root, out, progress = f"{base}/in", f"{base}/out", f"{base}/progress"

    def update():
        incremental.incremental_months(spark, root, out, progress, *lists).awaitTermination()
        return read(spark, out)

    # The second row of January arrived in December: it stays with its extract.
    january = [extract_row(1, 2016, 1, 20454.0), extract_row(2, 2016, 1, 20453.0)]
    write_extract(spark, f"{root}/a", "i94_jan16_sub.parquet", january)
    write_extract(spark, f"{root}/a", "i94_dec15_sub.parquet", [extract_row(3, 2015, 12, 20440.0)])
    assert update() == [("2015-12-3", 1960), ("2016-1-1", 1960), ("2016-1-2", 1960)]
    december = ("immigrations", "extract_year=2015/extract_month=12")
    kept = snapshots.current(spark, out)[december]

    write_extract(spark, f"{root}/b", "i94_jan16_sub.parquet", [extract_row(2, 2016, 1, 20453.0, left=20460.0)])
    assert update() == [("2015-12-3", 1960), ("2016-1-2", 2016)]
    assert snapshots.current(spark, out)[december] == kept

    # Nothing new changes nothing; a month whose rows all drop out leaves none behind.
    assert update() == [("2015-12-3", 1960), ("2016-1-2", 2016)]
    write_extract(spark, f"{root}/c", "i94_jan16_sub.parquet", [extract_row(5, 2016, 1, 20454.0, port="NOWHERE")])
    assert update() == [("2015-12-3", 1960)]


def test_star_is_written_read_and_rebuilt(spark):
    base = workspace(spark)
    staged = months.Staged(b.crossings(spark, SF_DIR), b.ports(spark, SF_DIR), b.countries(spark, SF_DIR), b.iso(spark, SF_DIR))
    reports = [months.run_all_months(spark, staged, base, f"round {n}").collect() for n in (1, 2)]
    strip = lambda report: sorted(tuple(r)[1:] for r in report)
    assert strip(reports[0]) == strip(reports[1])
    assert {r["status"] for r in reports[1]} == {"OK"}
    star = months.read_star(spark, base)
    # What was counted while writing is what reading counts.
    again = dq_report(months.read_run(spark, base, "round 2"), "round 2").unionByName(months.list_checks(staged, "round 2"))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, reports[1]))
    time, fact = star["time"], star["immigrations"]
    assert time.count() == time.select("arrival_ts").distinct().count()
    assert fact.count() == fact.select("immigration_id").distinct().count()
    assert fact.join(time, fact["arrival_time"] == time["arrival_ts"], "left_anti").count() == 0
    assert fact.join(star["airports"], "airport_id", "left_anti").count() == 0
