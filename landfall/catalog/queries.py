"""One query an operator, each over whole test tables.  Keys match ``oracle.SQL``."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from landfall.catalog import bindings as b
from landfall.functions import dates, keys, labels, text
from landfall.operators import clean as cl
from landfall.operators import clustering
from landfall.operators import distinct as ds
from landfall.operators import joins as jn
from landfall.operators import numbering
from landfall.operators import ordering as od
from landfall.operators import projections as pj
from landfall.operators import quality as q
from landfall.plans import answers, dimensions, fact as facts, losses, months, staging, views
from landfall.schemas import ISO, KEYS, PORTS
from landfall.session import workspace
from landfall.sinks import snapshots, writers
from landfall.sources import extracts, files, footers, lookups, tables
from landfall.streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Columns each build needs, so that a binding joins no table in vain.
FACT_COLUMNS = [
    "cicid", "i94yr", "i94mon", "i94cit", "i94port", "arrdate", "depdate", "i94mode", "admnum", "airline", "fltno",
]
ADMISSION_COLUMNS = ["admnum", "i94res", "i94bir", "i94visa", "visatype", "gender"]
PLACE_COLUMNS = ["i94port", "i94cit", "arrdate"]

DELIVERED = ["cicid", "i94yr", "i94mon", "depdate"]

RUN_START = datetime(2016, 1, 31, 7, 0, 0)
CHANGED_YEAR = 1996
DATE_PARTS = {
    "hour": "hour", "day": "day", "weekofyear": "week", "month": "month", "year": "year", "dayofweek": "weekday",
}


def register(name: str) -> Callable[[Query], Query]:
    def keep(query: Query) -> Query:
        QUERIES[name] = query
        return query

    return keep


def clean_fact_rows(spark, sf):
    return b.clean(spark, sf, *FACT_COLUMNS)


def fact(spark, sf):
    return facts.fact_immigrations(clean_fact_rows(spark, sf), b.countries(spark, sf), b.ports(spark, sf))


def timed(spark, sf, *more):
    return pj.with_arrival_time(b.clean(spark, sf, "cicid", "arrdate", *more))


def seeded_orders(spark, sf):
    """Orders with null and empty keys sown in."""
    key = F.col("o_orderkey")
    return b.table(spark, sf, "orders").select(
        "o_orderkey",
        "o_orderpriority",
        F.when(key % 97 == 0, F.lit(None)).when(key % 89 == 0, "").otherwise(F.col("o_orderpriority")).alias("k1"),
        F.when(key % 101 != 0, F.col("o_totalprice")).alias("k2"),
    )


def written_extracts(spark, sf):
    """Some columns as monthly folders; in one year each month came twice, later without departures."""
    root = workspace(spark)
    crossed = b.crossings(spark, sf, *DELIVERED)
    b.write_extracts(crossed, f"{root}/first")
    again = crossed.where(F.col("i94yr") == CHANGED_YEAR).withColumn("depdate", F.lit(None).cast("double"))
    b.write_extracts(again, f"{root}/second")
    return root


def staged(spark, sf):
    base = workspace(spark)
    b.write_extracts(b.crossings(spark, sf, by_extract=True), f"{base}/extracts")
    lists = {name: b.write_list(spark, sf, name, f"{base}/lists") for name in ("ports", "countries", "iso")}
    return staging.stage(spark, f"{base}/extracts", **lists, schema=b.BOUND_EXTRACT)


# The five tables, each from only the columns it needs.
STAR: dict[str, Query] = {
    "admissions": lambda spark, sf: dimensions.dim_admissions(b.clean(spark, sf, *ADMISSION_COLUMNS)),
    "countries": lambda spark, sf: dimensions.dim_countries(b.countries(spark, sf), b.iso(spark, sf)),
    "airports": lambda spark, sf: dimensions.dim_airports(b.ports(spark, sf)),
    "time": lambda spark, sf: dimensions.dim_time(b.clean(spark, sf, "arrdate")),
    "immigrations": fact,
}


def lean_star(spark, sf):
    return {name: build(spark, sf) for name, build in STAR.items()}


def row_counts(named):
    counts = [q.count_rows(df).withColumn("table_name", F.lit(name)) for name, df in named.items()]
    return reduce(DataFrame.unionByName, counts)


# Sources


@register("scan_admissions")
def _(spark, sf):
    root = workspace(spark)
    b.write_extracts(b.crossings(spark, sf, by_extract=True), root)
    return extracts.scan_admissions(spark, root, b.BOUND_EXTRACT)


@register("discover_inputs")
def _(spark, sf):
    found = files.discover_inputs(spark, written_extracts(spark, sf))
    name = F.regexp_extract(files.extract_path(F.col("path")), "([^/=]+)$", 1)
    return found.groupBy(name.alias("extract")).agg(F.bool_and(F.col("length") > 0).alias("has_bytes"))


@register("file_month")
def _(spark, sf):
    marked = files.with_file_month(files.discover_inputs(spark, written_extracts(spark, sf)))
    return marked.select(
        files.month_mark(F.col("path")).alias("month_mark"),
        files.year_mark(F.col("path")).alias("year_mark"),
        "extract_year",
        "extract_month",
    ).distinct()


@register("order_months")
def _(spark, sf):
    chosen = files.order_months(files.discover_inputs(spark, written_extracts(spark, sf)))
    return chosen.drop("paths").withColumn("extract", F.regexp_extract("extract", "([^/]+/[^/]+)$", 1))


@register("scan_latest")
def _(spark, sf):
    delivered = StructType([b.BOUND_EXTRACT[name] for name in DELIVERED])
    latest = extracts.scan_latest(spark, written_extracts(spark, sf), schema=delivered)
    return latest.groupBy("i94yr", "i94mon").agg(
        F.count(F.lit(1)).alias("row_count"), F.count("depdate").alias("departures")
    )


@register("lacking_columns")
def _(spark, sf):
    # One year's extracts come in two parts, of which the later one has no departures.
    root = workspace(spark)
    crossed = b.crossings(spark, sf, *DELIVERED)
    b.write_extracts(crossed, root)
    b.write_extracts(crossed.where(F.col("i94yr") == CHANGED_YEAR).drop("depdate", "cicid"), root)
    found = footers.lacking(spark, root, DELIVERED)
    name = F.regexp_extract(files.extract_path(F.col("path")), "([^/=]+)$", 1)
    return found.select(name.alias("extract"), F.array_join("lacks", ",").alias("lacks")).distinct()


@register("scan_ports")
def _(spark, sf):
    return lookups.scan_ports(spark, b.write_list(spark, sf, "ports", workspace(spark)))


@register("scan_countries")
def _(spark, sf):
    return lookups.scan_countries(spark, b.write_list(spark, sf, "countries", workspace(spark)))


@register("scan_iso")
def _(spark, sf):
    return lookups.scan_iso(spark, b.write_list(spark, sf, "iso", workspace(spark)))


@register("scan_iata")
def _(spark, sf):
    return lookups.scan_iata(spark, b.write_list(spark, sf, "iata", workspace(spark)))


@register("typed_from_local")
def _(spark, sf):
    return lookups.apply_schema(b.raw_iso(spark, sf), ISO, "name", "country_code")


@register("scan_parquet")
def _(spark, sf):
    path = workspace(spark)
    writers.write_overwrite(dimensions.dim_admissions(b.clean(spark, sf, *ADMISSION_COLUMNS)), path)
    return tables.scan_parquet(spark, path)


# Sinks


@register("write_overwrite")
def _(spark, sf):
    path = workspace(spark)
    writers.write_overwrite(b.raw_ports(spark, sf), path)
    writers.write_overwrite(dimensions.dim_airports(b.ports(spark, sf)), path)
    return tables.scan_parquet(spark, path)


@register("write_partitioned_append")
def _(spark, sf):
    path = workspace(spark)
    time = dimensions.dim_time(b.clean(spark, sf, "arrdate"))
    for part in (F.col("year") < CHANGED_YEAR, F.col("year") >= CHANGED_YEAR):
        writers.write_partitioned(time.where(part), path, ["year", "month"], ["arrival_ts"], append=True)
    return tables.scan_parquet(spark, path)


@register("write_partitioned_replace")
def _(spark, sf):
    path = workspace(spark)
    table = fact(spark, sf)
    changed = table.where(F.col("arrival_year") == CHANGED_YEAR)
    for written in (table.withColumn("airline", F.lit("OLD")), changed):
        writers.write_partitioned(written, path, ["arrival_year", "arrival_month"], ["arrival_time"])
    return tables.scan_parquet(spark, path)


def failing(rows: DataFrame) -> DataFrame:
    """Rows that fail when they are written."""
    return rows.withColumn(rows.columns[0], F.raise_error(F.lit("sown")).cast(rows.dtypes[0][1]))


@register("snapshot_overwrite")
def _(spark, sf):
    base = workspace(spark)
    airports = dimensions.dim_airports(b.ports(spark, sf))
    for name, written in (("airports", [b.raw_ports(spark, sf)]), ("airports", [airports]), ("airports", [b.ports(spark, sf), failing(airports)])):
        update = snapshots.Update(spark, base)
        try:
            for rows in written:
                update.write(name, rows)
            update.publish()
        except PySparkException:
            # The update wrote one table and broke off in the next: readers see neither.
            continue
    return snapshots.read_snapshot(spark, base, "airports")


@register("snapshot_replace")
def _(spark, sf):
    base, layout = workspace(spark), snapshots.Layout(("arrival_year", "arrival_month"), order=("arrival_time",))
    table = fact(spark, sf)
    changed = table.where(F.col("arrival_year") == CHANGED_YEAR)
    parts = [layout.part(CHANGED_YEAR, month) for month in range(1, 13)]
    for written, replaced in ((table.withColumn("airline", F.lit("OLD")), None), (changed, parts), (failing(changed), parts)):
        update = snapshots.Update(spark, base)
        try:
            update.write("immigrations", written, layout, replaced)
            update.publish()
        except PySparkException:
            continue
    return snapshots.read_snapshot(spark, base, "immigrations")


@register("write_clean_csv")
def _(spark, sf):
    path = workspace(spark)
    writers.write_clean_csv(b.ports(spark, sf), path)
    return lookups.scan_list(spark, path, PORTS)


@register("run_stamp")
def _(spark, sf):
    base = workspace(spark)
    path = writers.run_path(base, "airports", writers.run_stamp(RUN_START))
    writers.write_overwrite(dimensions.dim_airports(b.ports(spark, sf)), path)
    return spark.read.option("basePath", base).parquet(path)


@register("partition_pruned_read")
def _(spark, sf):
    path = workspace(spark)
    writers.write_partitioned(fact(spark, sf), path, ["arrival_year", "arrival_month"], ["arrival_time"])
    return tables.read_month(spark, path, CHANGED_YEAR, 3)


@register("time_pruned_read")
def _(spark, sf):
    base = workspace(spark)
    star = lean_star(spark, sf)
    writers.write_partitioned(star["immigrations"], f"{base}/fact", ["arrival_year", "arrival_month"], ["arrival_time"])
    writers.write_overwrite(star["time"], f"{base}/time")
    days = tables.scan_parquet(spark, f"{base}/time").where((F.col("week") == 10) & (F.col("year") == CHANGED_YEAR))
    return answers.arrivals_on(tables.scan_parquet(spark, f"{base}/fact"), days)


@register("clustered_read")
def _(spark, sf):
    path = workspace(spark)
    clustering.write_clustered(fact(spark, sf), path)
    return tables.scan_parquet(spark, path).where(F.col("airport_id") == "P1")


# Projections and predicates


@register("project_admissions")
def _(spark, sf):
    return pj.project_admissions(b.clean(spark, sf, *ADMISSION_COLUMNS))


@register("project_countries")
def _(spark, sf):
    return pj.project_countries(jn.join_country_iso(b.countries(spark, sf), b.iso(spark, sf)))


@register("project_airports")
def _(spark, sf):
    return pj.project_airports(b.ports(spark, sf))


@register("project_time")
def _(spark, sf):
    return pj.project_time(timed(spark, sf))


@register("project_fact")
def _(spark, sf):
    return facts.fact_by_time_join(clean_fact_rows(spark, sf), b.countries(spark, sf), b.ports(spark, sf))


@register("derive_column")
def _(spark, sf):
    rows = b.clean(spark, sf, "cicid", "arrdate", "depdate")
    stay = F.when(F.col("depdate") != 0.0, F.col("depdate") - F.col("arrdate"))
    return pj.derive_column(rows, "days_stayed", stay)


@register("bad_key_predicate")
def _(spark, sf):
    rows = seeded_orders(spark, sf)
    return rows.select("o_orderkey", q.bad_key_predicate(rows, ["k1", "k2"]).alias("bad_key"))


@register("null_equality_trap")
def _(spark, sf):
    depdate = F.col("depdate")
    return b.crossings(spark, sf, "depdate").agg(
        F.count_if(depdate == F.lit(None).cast("double")).alias("equal_to_null"),
        F.count_if(depdate.isNull()).alias("is_null"),
    )


# Joins


@register("join_country_iso")
def _(spark, sf):
    return jn.join_country_iso(b.countries(spark, sf), b.iso(spark, sf))


@register("join_fact_country")
def _(spark, sf):
    return jn.join_fact_country(b.clean(spark, sf, "cicid", "i94cit"), b.countries(spark, sf))


@register("join_fact_port")
def _(spark, sf):
    return jn.join_fact_port(b.clean(spark, sf, "cicid", "i94port"), b.ports(spark, sf))


@register("join_fact_port_spread")
def _(spark, sf):
    return jn.spread_join(b.clean(spark, sf, "cicid", "i94port"), b.ports(spark, sf), "i94port", "i94_port", "cicid", 50)


@register("join_fact_port_filtered")
def _(spark, sf):
    # A list of which two thirds are gone.
    known = b.ports(spark, sf).where(F.substring("i94_port", 2, 20).cast("int") % 3 == 0)
    return jn.join_lookup_filtered(b.clean(spark, sf, "cicid", "i94port"), known, "i94port", "i94_port")


@register("join_fact_time")
def _(spark, sf):
    rows = timed(spark, sf)
    return jn.join_fact_time(rows, dimensions.dim_time(rows))


@register("star_join")
def _(spark, sf):
    rows = b.clean(spark, sf, "cicid", "i94cit", "i94port", "arrdate")
    return facts.star_join(rows, b.countries(spark, sf), b.ports(spark, sf), dimensions.dim_time(rows))


# Distinct rows and counts


@register("distinct_admissions")
def _(spark, sf):
    return ds.distinct_admissions(b.clean(spark, sf, *ADMISSION_COLUMNS))


@register("distinct_countries")
def _(spark, sf):
    return ds.distinct_countries(jn.join_country_iso(b.countries(spark, sf), b.iso(spark, sf)))


@register("distinct_airports")
def _(spark, sf):
    return ds.distinct_airports(b.ports(spark, sf))


@register("distinct_time")
def _(spark, sf):
    return ds.distinct_time(b.clean(spark, sf, "arrdate"))


@register("distinct_fact")
def _(spark, sf):
    return ds.distinct_fact(fact(spark, sf))


@register("count_rows")
def _(spark, sf):
    return row_counts(lean_star(spark, sf))


@register("count_bad_keys")
def _(spark, sf):
    return q.count_bad_keys(seeded_orders(spark, sf), ["k1", "k2"])


@register("df_count")
def _(spark, sf):
    return b.crossings(spark, sf, "cicid").groupBy().count()


# Answers


@register("nationalities_by_airport")
def _(spark, sf):
    return answers.nationalities_by_airport(fact(spark, sf), dimensions.dim_airports(b.ports(spark, sf)))


@register("nationalities_from_extract")
def _(spark, sf):
    counted = b.place_counts(spark, sf)
    return answers.by_airport(answers.known_places(counted, b.countries(spark, sf), b.ports(spark, sf)))


@register("nationality_bits")
def _(spark, sf):
    bits = answers.nationality_bits(fact(spark, sf), "arrival_year", "arrival_month")
    return answers.nationalities_from_bits(bits, dimensions.dim_airports(b.ports(spark, sf)))


@register("star_sql")
def _(spark, sf):
    views.register_views(lean_star(spark, sf), prefix="landfall_")
    return spark.sql("""
        SELECT a.airport_state, f.arrival_year, count(*) AS entries,
               count(DISTINCT f.country_code) AS nationalities
        FROM landfall_immigrations f JOIN landfall_airports a USING (airport_id)
        GROUP BY a.airport_state, f.arrival_year
    """)


@register("top_airports")
def _(spark, sf):
    return answers.top_airports(fact(spark, sf), dimensions.dim_airports(b.ports(spark, sf)), 10)


# Orders and previews


@register("order_admissions")
def _(spark, sf):
    return dimensions.dim_admissions(b.clean(spark, sf, *ADMISSION_COLUMNS), ordered=True)


@register("order_countries")
def _(spark, sf):
    return dimensions.dim_countries(b.countries(spark, sf), b.iso(spark, sf), ordered=True)


@register("order_airports")
def _(spark, sf):
    return dimensions.dim_airports(b.ports(spark, sf), ordered=True)


@register("order_fact")
def _(spark, sf):
    return od.order_fact(fact(spark, sf))


@register("head_n")
def _(spark, sf):
    return od.head_n(od.order_fact(fact(spark, sf)), 20)


# Column functions


@register("strip_quotes")
def _(spark, sf):
    return b.raw_ports(spark, sf).select(
        text.strip_quotes(F.col("code")).alias("code"), text.strip_quotes(F.col("name")).alias("name")
    )


@register("trim_text")
def _(spark, sf):
    bare = [text.strip_quotes(F.col(c)).alias(c) for c in ("code", "name")]
    return b.raw_ports(spark, sf).select(bare).select(
        text.trim_text(F.col("code")).alias("code"), text.trim_text(F.col("name")).alias("name")
    )


@register("split_name_state")
def _(spark, sf):
    bare = text.strip_quotes(F.col("name"))
    return b.raw_ports(spark, sf).select(
        "code", text.place_name(bare).alias("place"), text.place_state(bare).alias("state")
    )


@register("clean_ports")
def _(spark, sf):
    return cl.clean_ports(b.raw_ports(spark, sf))


@register("clean_countries")
def _(spark, sf):
    return cl.clean_countries(b.raw_countries(spark, sf))


@register("fill_nulls")
def _(spark, sf):
    return cl.fill_nulls(b.crossings(spark, sf))


@register("fill_iso_nulls")
def _(spark, sf):
    return cl.fill_iso_nulls(b.iso(spark, sf))


@register("sas_day_to_ts")
def _(spark, sf):
    # The age is added to have fractions and days long before and after the arrival.
    rows = b.crossings(spark, sf, "cicid", "arrdate", "i94bir")
    shifted = F.col("arrdate") - F.col("i94bir") * 400.3
    return rows.select(
        "cicid", dates.day_to_ts(F.col("arrdate")).alias("arrival_time"), dates.day_to_ts(shifted).alias("shifted")
    )


@register("sas_departure_ts")
def _(spark, sf):
    rows = b.crossings(spark, sf, "cicid", "depdate")
    return rows.select(
        "cicid",
        dates.departure_ts(F.col("depdate")).alias("departure_date"),
        dates.departure_ts(F.col("depdate"), null_departure=True).alias("departure_or_null"),
    )


def _date_part(name: str) -> Query:
    def query(spark, sf):
        part: Column = dates.date_parts(F.col("arrival_time"))[DATE_PARTS[name]]
        return timed(spark, sf).select("cicid", part.alias(name))

    return query


for _name in DATE_PARTS:
    register(_name)(_date_part(_name))


@register("surrogate_id")
def _(spark, sf):
    return fact(spark, sf).select("immigration_id", "arrival_time")


@register("surrogate_id_of_run")
def _(spark, sf):
    table = facts.fact_immigrations(
        clean_fact_rows(spark, sf), b.countries(spark, sf), b.ports(spark, sf), stable_ids=False
    )
    # Ids are unique where their highest count is one; counting them needs no set of all ids in one place.
    uses = table.groupBy("immigration_id").agg(F.count(F.lit(1)).alias("uses"))
    return uses.agg(F.sum("uses").alias("row_count"), F.max("uses").alias("uses_of_an_id"))


@register("dense_numbers")
def _(spark, sf):
    # Two deliveries: keys known from the first keep their numbers, the others come after.
    base, ids = workspace(spark), fact(spark, sf).select("immigration_id", "arrival_year")
    for delivered in (ids.where(F.col("arrival_year") <= CHANGED_YEAR), ids):
        found = numbering.numbered(spark, base, "numbers", delivered.select("immigration_id"))
    return found


@register("implicit_number_string_eq")
def _(spark, sf):
    rows = b.crossings(spark, sf, "cicid", "admnum", "fltno")
    return rows.select("cicid", keys.same_number(F.col("admnum"), F.col("fltno")).alias("same"))


@register("code_labels")
def _(spark, sf):
    return b.clean(spark, sf, "cicid", "i94mode", "i94visa").select(
        "cicid",
        labels.code_label(F.col("i94mode"), labels.ARRIVAL_MODES).alias("arrival_mode"),
        labels.code_label(F.col("i94visa"), labels.VISA_CODES).alias("visa"),
    )


# Table builds and checks


@register("stage_tables")
def _(spark, sf):
    stored = staging.stage_tables(spark, staged(spark, sf), workspace(spark))
    return row_counts(stored.tables())


@register("clean_admissions_extract")
def _(spark, sf):
    sources = staging.Staged(b.crossings(spark, sf), b.raw_ports(spark, sf), b.countries(spark, sf), b.iso(spark, sf))
    return staging.clean_admissions_extract(sources)


@register("dim_admissions")
def _(spark, sf):
    return STAR["admissions"](spark, sf)


@register("dim_countries")
def _(spark, sf):
    return STAR["countries"](spark, sf)


@register("dim_airports")
def _(spark, sf):
    return STAR["airports"](spark, sf)


@register("dim_time")
def _(spark, sf):
    return STAR["time"](spark, sf)


@register("fact_immigrations")
def _(spark, sf):
    return fact(spark, sf)


def _check(table: str) -> Query:
    def query(spark, sf):
        return q.check_table(STAR[table](spark, sf), table)

    return query


for _table in KEYS:
    register(f"dq_{_table}")(_check(_table))


@register("dq_verdict")
def _(spark, sf):
    rows = seeded_orders(spark, sf)
    bad = q.bad_key_predicate(rows, ["k1", "k2"])
    # One priority is spared, so that both verdicts occur.
    counted = rows.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(bad & (F.col("o_orderpriority") != "5-LOW")).alias("bad_key_count"),
    )
    rows_seen, bad_seen = F.col("row_count"), F.col("bad_key_count")
    return counted.withColumns({
        "status": q.dq_verdict(bad_seen, rows_seen),
        "status_if_empty": q.dq_verdict(bad_seen, F.lit(0)),
        "status_if_empty_compat": q.dq_verdict(bad_seen, F.lit(0), compat=True),
    })


@register("dq_report")
def _(spark, sf):
    return q.dq_report(lean_star(spark, sf), writers.run_stamp(RUN_START))


@register("checks_while_writing")
def _(spark, sf):
    base, seen = workspace(spark), q.Measured()
    for name, table in lean_star(spark, sf).items():
        writers.write_overwrite(table, f"{base}/{name}", seen.of(name))
    return seen.report(spark, writers.run_stamp(RUN_START))


@register("dq_record")
def _(spark, sf):
    return q.dq_record(q.dq_report(lean_star(spark, sf), writers.run_stamp(RUN_START)))


@register("run_all_months")
def _(spark, sf):
    # The extracts are monthly and the lists short, so the fact's tasks have rows of few months each.
    stamp = writers.run_stamp(RUN_START)
    return months.run_all_months(spark, staged(spark, sf), workspace(spark), stamp, grouped_by_month=True)


# Beyond the star: what the joins drop, and updates


@register("dropped_rows")
def _(spark, sf):
    rows = b.clean(spark, sf, *PLACE_COLUMNS, "i94mode")
    sown = rows.withColumns({
        "arrdate": F.when(F.col("i94mode") != 2.0, F.col("arrdate")),
        "i94port": F.when(F.col("i94mode") == 4.0, F.lit("NOWHERE")).otherwise(F.col("i94port")),
    })
    return losses.dropped_rows(sown, b.countries(spark, sf), b.ports(spark, sf))


@register("orphan_fact_countries")
def _(spark, sf):
    countries = b.countries(spark, sf)
    return losses.orphan_fact_countries(fact(spark, sf), dimensions.dim_countries(countries, b.iso(spark, sf)))


def updated(spark, sf):
    """Two updates: some months come first, then come again; the others only in the second delivery."""
    base = workspace(spark)
    crossed = b.crossings(spark, sf, by_extract=True)
    countries, ports = b.countries(spark, sf), b.ports(spark, sf)
    later = crossed.withColumn("depdate", F.when(F.col("i94yr") != CHANGED_YEAR, F.col("depdate")))
    deliveries = {
        "first": crossed.where(F.col("i94yr") <= CHANGED_YEAR),
        "second": later.where(F.col("i94yr") >= CHANGED_YEAR),
    }
    for name, rows in deliveries.items():
        b.write_extracts(rows, f"{base}/in/{name}")
        incremental.incremental_months(
            spark, f"{base}/in", f"{base}/out", f"{base}/progress", countries, ports, schema=b.BOUND_EXTRACT
        ).awaitTermination()
    return f"{base}/out"


@register("incremental_months")
def _(spark, sf):
    return incremental.read_incremental(spark, updated(spark, sf))


def _kept(table: str) -> Query:
    def query(spark, sf):
        base = updated(spark, sf)
        incremental.remove_months(spark, base, [(CHANGED_YEAR - 1, month) for month in range(1, 13)])
        return incremental.read_incremental(spark, base, table)

    return query


for _table in incremental.DIMENSIONS:
    register(f"kept_{_table}")(_kept(_table))


@register("kept_nationalities")
def _(spark, sf):
    return incremental.read_nationalities(spark, updated(spark, sf), dimensions.dim_airports(b.ports(spark, sf)))
