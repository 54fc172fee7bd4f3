"""Footers, snapshots, followed dimensions, bitmaps, numbers and layouts: what holds when files lack, writes fail, months go."""

import os
import random
from collections import Counter
from glob import glob

import pyarrow.parquet as pq
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from landfall.catalog import bindings as b
from landfall.catalog.queries import lean_star
from landfall.functions import bitmaps
from landfall.operators import clustering, numbering
from landfall.operators.quality import Measured, check_table
from landfall.plans import answers, months
from landfall.schemas import EXTRACT, KEYS
from landfall.session import workspace
from landfall.sinks import writers
from landfall.sinks.snapshots import Layout, Update, current, forget, manifests, read_snapshot
from landfall.sources import extracts, footers, tables
from landfall.sources.files import discover_inputs
from landfall.streaming import incremental
from tests.comparing import SF_DIR
from tests.test_files import extract_row, lists, write_extract  # noqa: F401


@pytest.fixture(autouse=True)
def few_buckets(monkeypatch):
    monkeypatch.setattr(incremental, "BUCKETS", 4)


# Footers


def write_parts(spark, root, without):
    """One extract in two files, the second without a column."""
    rows = spark.createDataFrame([extract_row(1, 2016, 1, 20454.0)], EXTRACT)
    for part, df in (("a", rows), ("b", rows.drop(without))):
        df.coalesce(1).write.parquet(f"{root}/i94_jan16_sub/{part}")


def test_one_part_without_a_column_stops_the_job_and_is_named(spark):
    root = workspace(spark)
    write_parts(spark, root, "airline")
    with pytest.raises(ValueError, match="/b/part-.* lacks airline"):
        extracts.scan_latest(spark, root)
    with pytest.raises(ValueError, match="lacks airline"):
        extracts.scan_admissions(spark, f"{root}/i94_jan16_sub")
    assert extracts.scan_admissions(spark, f"{root}/i94_jan16_sub/a").count() == 1


def test_only_footers_are_read(spark):
    root = workspace(spark)
    write_parts(spark, root, "fltno")
    for path in glob(f"{root}/i94_jan16_sub/*/*.parquet"):
        data = bytearray(open(path, "rb").read())
        footer = int.from_bytes(data[-8:-4], "little") + 8
        data[4:-footer] = bytes(len(data) - footer - 4)
        open(path, "wb").write(data)
    found = footers.lacking(spark, root, EXTRACT.names).collect()
    assert [r["lacks"] for r in found] == [["fltno"]]
    listed = footers.footers(discover_inputs(spark, root)).collect()
    assert sorted(len(r["columns"]) for r in listed) == [27, 28] and all(r["length"] > 0 for r in listed)


def test_files_that_only_spark_can_open_and_names_in_other_case(spark, monkeypatch):
    root = workspace(spark)
    write_parts(spark, root, "gender")
    rows = spark.createDataFrame([extract_row(1, 2016, 1, 20454.0)], EXTRACT)
    rows.toDF(*[c.upper() for c in rows.columns]).coalesce(1).write.parquet(f"{root}/i94_jan16_sub/c")
    seen = footers.footers
    monkeypatch.setattr(footers, "footers", lambda files: seen(files).withColumn("columns", F.when(~F.col("path").contains("/b/"), F.col("columns"))))
    found = footers.lacking(spark, root, EXTRACT.names).collect()
    assert [r["lacks"] for r in found] == [["gender"]] and "/b/" in found[0]["path"]


# Snapshots


def test_parts_are_replaced_dropped_and_forgotten(spark):
    base, layout = workspace(spark), Layout(("y",), order=("id",))
    rows = lambda *values: spark.createDataFrame(list(values), "id INT, v STRING, y INT")
    read = lambda number=None: sorted(map(tuple, read_snapshot(spark, base, "t", number=number).select("id", "v", "y").collect()))
    assert read_snapshot(spark, base, "t") is None and manifests(spark, base) == []

    def update(df, replaced=None):
        change = Update(spark, base)
        written = change.write("t", df, layout, replaced)
        assert written.count() == df.count()
        change.write("u", df.select("id"))
        return change.publish()

    first = update(rows((1, "a", 1), (2, "a", 2), (3, "a", 3)))
    update(rows((2, "b", 2)), ["y=2", "y=3"])
    assert read() == [(1, "a", 1), (2, "b", 2)] and read(first) == [(1, "a", 1), (2, "a", 2), (3, "a", 3)]
    assert [r["id"] for r in read_snapshot(spark, base, "t", ["y=2"]).collect()] == [2]
    assert [r["id"] for r in read_snapshot(spark, base, "u").collect()] == [2]

    broken = Update(spark, base)
    broken.write("t", rows((9, "x", 1)), layout, ["y=1"])
    with pytest.raises(PySparkException):
        broken.write("u", rows((9, "x", 1)).select(F.raise_error(F.lit("broken")).alias("id")))
    assert read() == [(1, "a", 1), (2, "b", 2)]

    update(rows((5, "c", 5)), [])
    forget(spark, base, keep=1)
    assert len(manifests(spark, base)) == 1 and read() == [(1, "a", 1), (2, "b", 2), (5, "c", 5)]
    # Of the first version one part is still needed, of the second one, too.
    assert len(os.listdir(f"{base}/t")) == 4

    gone = Update(spark, base)
    gone.drop("t")
    gone.drop("u")
    gone.publish()
    assert current(spark, base) == {} and read_snapshot(spark, base, "t") is None


def test_an_unfinished_manifest_is_not_read(spark):
    base = workspace(spark)
    change = Update(spark, base)
    change.write("t", spark.range(3))
    number = change.publish()
    os.makedirs(f"{base}/manifests/{number + 1}/_temporary/0")
    assert manifests(spark, base) == [number] and read_snapshot(spark, base, "t").count() == 3
    change = Update(spark, base)
    change.write("t", spark.range(5))
    assert change.publish() == number + 1 and read_snapshot(spark, base, "t").count() == 5


def test_an_update_that_fails_loses_nothing(spark, lists):  # noqa: F811
    countries, ports = lists
    base = workspace(spark)
    root, out, progress = f"{base}/in", f"{base}/out", f"{base}/progress"

    def update(ports):
        incremental.incremental_months(spark, root, out, progress, countries, ports).awaitTermination()

    def read():
        return {name: Counter(map(tuple, incremental.read_incremental(spark, out, name).collect())) for name in incremental.TABLES}

    write_extract(spark, f"{root}/a", "i94_jan16_sub.parquet", [extract_row(1, 2016, 1, 20454.0), extract_row(2, 2016, 1, 20455.0)])
    write_extract(spark, f"{root}/a", "i94_feb16_sub.parquet", [extract_row(3, 2016, 2, 20485.0)])
    update(ports)
    before = read()
    assert [sum(rows.values()) for rows in before.values()] == [3, 3, 3]

    write_extract(spark, f"{root}/b", "i94_jan16_sub.parquet", [extract_row(7, 2016, 1, 20460.0)])
    # The list breaks only when its rows are asked for: the fact is being written by then.
    broken = ports.withColumn("i94_airport_name", F.raise_error(F.lit("broken list")).cast("string")).where(F.col("i94_airport_name") > "")
    with pytest.raises(Exception, match="broken list|FAILED|STREAM"):
        update(broken)
    assert read() == before
    update(ports)
    after = read()
    assert [sum(rows.values()) for rows in after.values()] == [2, 2, 2] and after != before


def test_dimensions_follow_months_that_come_again_and_go(spark, lists):  # noqa: F811
    countries, ports = lists
    base = workspace(spark)
    root, out, progress = f"{base}/in", f"{base}/out", f"{base}/progress"
    pick = random.Random(4)
    now = {}
    for delivery in range(3):
        for month in pick.sample(range(1, 4), 2):
            # Months share days and admissions, and an admission is there more than once.
            rows = [extract_row(pick.randrange(8), 2016, month, 20454.0 + pick.randrange(5), country=pick.choice((1.0, 2.0))) for _ in range(pick.choice((1, 9)))]
            now[month] = rows
            write_extract(spark, f"{root}/{delivery}", f"i94_{['jan', 'feb', 'mar'][month - 1]}16_sub.parquet", rows)
        incremental.incremental_months(spark, root, out, progress, countries, ports, keep=1).awaitTermination()
        assert len(manifests(spark, out)) == 1
        if delivery == 1:
            gone = pick.choice(sorted(now))
            del now[gone]
            incremental.remove_months(spark, out, [(2016, gone)])
        every = incremental.fill_nulls(spark.createDataFrame([r for rows in now.values() for r in rows], EXTRACT))
        whole = {"admissions": months.dim_admissions(every), "time": months.dim_time(every), "immigrations": months.fact_immigrations(every, countries, ports)}
        for name, table in whole.items():
            kept = incremental.read_incremental(spark, out, name)
            assert Counter(map(tuple, kept.select(*table.columns).collect())) == Counter(map(tuple, table.collect())), name
        airports = months.dim_airports(ports)
        want = answers.nationalities_by_airport(whole["immigrations"], airports).collect()
        assert sorted(map(tuple, incremental.read_nationalities(spark, out, airports).collect())) == sorted(map(tuple, want))
    plan = incremental.read_incremental(spark, out, "admissions")._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and "Exchange" not in plan


# Checks of a run


def test_a_code_listed_twice_fails_the_run_and_sound_readers_pass_it_over(spark):
    base = workspace(spark)

    def run(ports, countries, stamp):
        staged = months.Staged(b.crossings(spark, SF_DIR), ports, countries, b.iso(spark, SF_DIR))
        return {r["table_name"]: r for r in months.run_all_months(spark, staged, base, stamp).collect()}

    ports, countries = b.ports(spark, SF_DIR), b.countries(spark, SF_DIR)
    good = run(ports, countries, "2016-01-01")
    assert {r["status"] for r in good.values()} == {"OK"} and len(good) == 8
    doubled = run(ports.unionByName(ports.where("i94_port = 'P1'")), countries, "2016-02-01")
    assert doubled["ports_list"]["status"] == "NOK" and doubled["ports_list"]["bad_key_count"] == 1
    assert doubled["immigrations"]["status"] == "OK" and doubled["immigrations"]["row_count"] > good["immigrations"]["row_count"]
    padded = countries.where("i94_cit = '3'").withColumn("i94_cit", F.lit("003"))
    assert run(ports, countries.unionByName(padded), "2016-03-01")["countries_list"]["status"] == "NOK"
    assert months.complete_runs(spark, base) == ["2016-01-01", "2016-02-01", "2016-03-01"]
    assert months.sound_runs(spark, base) == ["2016-01-01"]
    assert months.read_star(spark, base, sound=True)["immigrations"].count() == good["immigrations"]["row_count"]
    assert {r["status"] for r in months.read_report(spark, base, "2016-02-01").collect()} == {"OK", "NOK"}


def test_counts_while_writing_equal_counts_of_what_was_written(spark):
    base, seen = workspace(spark), Measured()
    rows = spark.range(0, 5000, 1, 7).select(
        F.when(F.col("id") % 11 > 0, F.col("id").cast("string")).otherwise("").alias("airport_id"),
        F.when(F.col("id") % 7 > 0, F.lit("x")).alias("airport_name"),
        (F.col("id") % 13).cast("int").alias("y"),
    )
    writers.write_partitioned(rows, f"{base}/airports", ["y"], ["airport_id"], observe=seen.of("airports"))
    writers.write_overwrite(rows.where("id < 0"), f"{base}/time", seen.of("time", ["airport_id"]))
    report = {r["table_name"]: tuple(r)[2:] for r in seen.report(spark, "r").collect()}
    again = check_table(tables.scan_parquet(spark, f"{base}/airports"), "airports").first()
    assert report == {"airports": tuple(again)[1:], "time": (0, 0, "NOK")}
    assert set(KEYS) >= set(report)


# Bitmaps


def test_merged_bitmaps_count_each_code_once(spark):
    pick = random.Random(2)
    rows = [(f"A{pick.randrange(3)}", pick.randrange(4), str(pick.choice((0, 1, 5, 32767, 32768, 70000, 123456)))) for _ in range(300)]
    frame = spark.createDataFrame(rows, "airport_id string, m int, country_code string")
    airports = spark.createDataFrame([(f"A{k}", "N", "S") for k in range(4)], "airport_id string, airport_name string, airport_state string")
    months_apart = [answers.nationality_bits(frame.where(F.col("m") == m), "m") for m in range(4)]
    merged = months_apart[0]
    for more in months_apart[1:]:
        merged = merged.unionByName(more)
    found = {r["airport_id"]: (r["entries"], r["nationalities"]) for r in answers.nationalities_from_bits(merged, airports).collect()}
    want = {a: (sum(r[0] == a for r in rows), len({r[2] for r in rows if r[0] == a})) for a in {r[0] for r in rows}}
    assert found == want
    for code in ("x", "007", "-1", "1.0"):
        with pytest.raises(PySparkException, match="no plain number"):
            spark.createDataFrame([(code,)], "c string").select(bitmaps.code_number(F.col("c"))).collect()
    assert spark.createDataFrame([(None,)], "c string").select(bitmaps.code_number(F.col("c"))).first()[0] is None


def test_bitmaps_are_a_few_bytes_merged_in_hash_maps(spark):
    rows = [("A", 1, "0"), ("A", 1, "63"), ("A", 1, "64"), ("A", 2, "63"), ("A", 2, None), ("B", 1, None)]
    found = answers.nationality_bits(spark.createDataFrame(rows, "airport_id string, m int, country_code string"), "m")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert dict(found.dtypes)["bits"] == "bigint" and "SortAggregate" not in plan and plan.count("Exchange") == 1
    assert {(r["airport_id"], r["m"], r["place"]): (r["entries"], r["bits"]) for r in found.collect()} == {
        ("A", 1, 0): (2, 1 - 2**63), ("A", 1, 1): (1, 1), ("A", 2, 0): (1 + 1, -(2**63)), ("B", 1, 0): (1, 0),
    }
    airports = spark.createDataFrame([("A", "N", "S"), ("B", "N", "S")], "airport_id string, airport_name string, airport_state string")
    merged = answers.nationalities_from_bits(found, airports)
    assert "SortAggregate" not in merged._jdf.queryExecution().executedPlan().toString()
    assert {r["airport_id"]: (r["entries"], r["nationalities"]) for r in merged.collect()} == {"A": (5, 3), "B": (1, 0)}


# Reads by day, numbers, clustered files


def test_days_prune_the_months_of_a_fact(spark):
    base = workspace(spark)
    star = lean_star(spark, SF_DIR)
    writers.write_partitioned(star["immigrations"], f"{base}/fact", ["arrival_year", "arrival_month"], ["arrival_time"])
    writers.write_overwrite(star["time"], f"{base}/time")
    days = tables.scan_parquet(spark, f"{base}/time").where("week = 10 and year = 1996")
    found = answers.arrivals_on(tables.scan_parquet(spark, f"{base}/fact"), days)
    assert "dynamicpruning#" in found._jdf.queryExecution().optimizedPlan().toString()
    rows = found.select("arrival_year", "arrival_month", F.weekofyear("arrival_time").alias("week")).distinct().collect()
    assert [tuple(r) for r in rows] == [(1996, 3, 10)]


def test_numbers_do_not_depend_on_partitions_and_stay(spark):
    keys = spark.range(0, 1000).select((F.col("id") * 7919 % 1009).alias("k"), (F.col("id") % 3).cast("string").alias("s"))
    keys = keys.unionByName(keys.limit(50)).unionByName(spark.createDataFrame([(None, "x")], "k bigint, s string"))
    want = {tuple(r): n for n, r in enumerate(sorted({tuple(r) for r in keys.collect()}, key=lambda r: (r[0] is not None, r[0] or 0, r[1])))}
    for parts in (1, 5, 40):
        found = numbering.dense_numbers(keys.repartition(parts))
        assert {(r["k"], r["s"]): r["number"] for r in found.collect()} == want
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    base = workspace(spark)
    first = numbering.numbered(spark, base, "map", keys.where("s = '1'"))
    held = {(r["k"], r["s"]): r["number"] for r in first.collect()}
    for _ in range(2):
        later = {(r["k"], r["s"]): r["number"] for r in numbering.numbered(spark, base, "map", keys).collect()}
        assert later.keys() == want.keys() and sorted(later.values()) == list(range(len(want)))
        assert {k: later[k] for k in held} == held
    assert len(manifests(spark, base)) == 2
    assert numbering.dense_numbers(keys.limit(0)).count() == 0


def test_bits_in_turn(spark):
    pick = random.Random(1)
    rows = [(0, 0), (65535, 65535), (65535, 0), *((pick.randrange(65536), pick.randrange(65536)) for _ in range(50))]
    found = spark.createDataFrame(rows, "a int, b int").select("a", "b", clustering.interleaved(F.col("a"), F.col("b")).alias("z")).collect()
    for r in found:
        bits = "".join(x + y for x, y in zip(f"{r['a']:016b}", f"{r['b']:016b}"))
        assert r["z"] == int(bits, 2)


def test_readers_of_an_airport_or_a_day_skip_most_row_groups(spark):
    path = workspace(spark)
    days, airports = 28, 64
    rows = spark.range(0, 64 * 28 * 20).select(
        F.concat(F.lit("i"), F.col("id").cast("string")).alias("immigration_id"),
        F.format_string("P%02d", F.pmod(F.xxhash64("id"), F.lit(airports))).alias("airport_id"),
        F.date_add(F.lit("2016-01-01").cast("date"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(days)).cast("int")).cast("timestamp_ntz").alias("arrival_time"),
        F.lit(2016).alias("arrival_year"),
        F.lit(1).alias("arrival_month"),
    )
    clustering.write_clustered(rows, path, rows_per_group=500)
    groups = []
    for name in glob(f"{path}/*/*/*.parquet"):
        meta = pq.ParquetFile(name).metadata
        for g in range(meta.num_row_groups):
            columns = {meta.row_group(g).column(c).path_in_schema: meta.row_group(g).column(c).statistics for c in range(meta.num_columns)}
            groups.append((columns["airport_id"], columns["arrival_time"]))
    assert len(groups) >= 50
    of_airport = sum(a.min <= "P17" <= a.max for a, _ in groups)
    of_day = sum(str(t.min)[:10] <= "2016-01-09" <= str(t.max)[:10] for _, t in groups)
    assert of_airport <= len(groups) / 3 and of_day <= len(groups) / 3
    assert tables.scan_parquet(spark, path).count() == rows.count()


