"""The given test tables, seen as the library's sources.

A crossing is a line item; its order, customer, supplier and part, each of a unique key, are
looked up where they exist.  So a table that gives no wanted column changes
no row, and is left out.  Orders meet customers first, so that line items, the largest
table, are shuffled once for both, or not at all where the files of orders are small enough to
broadcast.  Other sides are left to Spark's own size check, and adaptive execution splits
a partition that one key overfills.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.functions.dates import DAY_ZERO
from landfall.operators.clean import clean_countries, clean_ports, fill_nulls
from landfall.schemas import EXTRACT, TEXT, retyped
from landfall.sinks.writers import write_clean_csv

# The record key is text here: no one column of the test tables is unique.
BOUND_EXTRACT = retyped(EXTRACT, cicid=TEXT)

# Columns of the given tables, stated so that no job is spent on finding them out.
TABLES = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
    "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
    "l_shipdate TIMESTAMP_NTZ",
}

# Fixed value: the column whose values are folders of extracts.
EXTRACT_NAME = "extract"
RECORD = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _null_when(condition: Column, value: Column) -> Column:
    return F.when(~condition, value)


def _record_key() -> Column:
    key = [F.date_format(c, "yyyy-MM-dd") if c == "l_shipdate" else F.col(c).cast("string") for c in RECORD]
    return F.concat_ws("-", *key)


def _day_number() -> Column:
    return F.date_diff(F.col("l_shipdate").cast("date"), F.to_date(F.lit(DAY_ZERO))).cast("double")


# Columns that a line item gives alone, each built only when it is wanted.
LINE_COLUMNS: dict[str, Callable[[], Column]] = {
    "cicid": _record_key,
    "i94yr": lambda: F.year("l_shipdate").cast("double"),
    "i94mon": lambda: F.month("l_shipdate").cast("double"),
    "i94port": lambda: F.concat(F.lit("P"), F.col("l_suppkey").cast("string")),
    "arrdate": _day_number,
    "i94mode": lambda: _null_when(F.col("l_discount") == 0, (F.col("l_linenumber") % 4 + 1).cast("double")),
    "i94addr": lambda: _null_when(F.col("l_linenumber") == 2, F.col("l_returnflag")),
    "depdate": lambda: _null_when(F.col("l_returnflag") == "N", _day_number() + F.floor("l_quantity")),
    "i94bir": lambda: _null_when(F.col("l_linenumber") == 7, F.col("l_quantity") + 18),
    "i94visa": lambda: (F.col("l_linenumber") % 3 + 1).cast("double"),
    "count": lambda: _null_when(F.col("l_linenumber") == 3, F.lit(1.0)),
    "dtadfile": lambda: _null_when(F.col("l_linenumber") == 4, F.date_format("l_shipdate", "yyyyMMdd")),
    "visapost": lambda: _null_when(
        F.col("l_returnflag") == "R", F.concat(F.lit("V"), F.col("l_linenumber").cast("string"))
    ),
    "occup": lambda: _null_when(F.col("l_linestatus") == "F", F.lit("OCC")),
    "entdepa": lambda: _null_when(F.col("l_linenumber") == 5, F.col("l_returnflag")),
    "entdepd": lambda: _null_when(F.col("l_returnflag") == "N", F.lit("D")),
    "entdepu": lambda: _null_when(F.col("l_quantity") > 10, F.lit("U")),
    "matflag": lambda: _null_when(F.col("l_returnflag") == "N", F.lit("M")),
    "biryear": lambda: _null_when(F.col("l_linenumber") == 7, F.year("l_shipdate") - (F.col("l_quantity") + 18)),
    "dtaddto": lambda: _null_when(F.col("l_linenumber") == 1, F.date_format("l_shipdate", "MMddyyyy")),
    "gender": lambda: _null_when(F.col("l_linestatus") == "O", F.col("l_linestatus")),
    "insnum": lambda: _null_when(F.col("l_tax") < 0.04, F.concat(F.lit("I"), F.col("l_partkey").cast("string"))),
    "admnum": lambda: F.col("l_orderkey").cast("double"),
    "fltno": lambda: F.col("l_partkey").cast("string"),
}


def broadcastable(df: DataFrame) -> bool:
    """Whether Spark, from the size of the files, would broadcast a table; no job is run."""
    spark = df.sparkSession
    limit = spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return 0 <= df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() <= limit


def extract_name(year: Column, month: Column) -> Column:
    """Rows of a month are named like a monthly extract."""
    day = F.to_date(F.concat_ws("-", year.cast("int"), month.cast("int"), F.lit("1")), "y-M-d")
    return F.concat(F.lit("i94_"), F.lower(F.date_format(day, "MMMyy")), F.lit("_sub"))


def crossings(spark: SparkSession, sf_dir: str, *wanted: str, by_extract: bool = False) -> DataFrame:
    """The extract, or the wanted columns of it, over all line items.

    With ``by_extract`` rows come as ``write_extracts`` needs them, with their ``extract``: dealt and sorted
    by it while they are still line items, of half the size.
    """
    names = list(wanted) or EXTRACT.names
    rows = table(spark, sf_dir, "lineitem")
    values = {name: LINE_COLUMNS[name]() for name in names if name in LINE_COLUMNS}

    if {"i94cit", "visatype"} & set(names):
        party = table(spark, sf_dir, "orders")
        if "i94cit" in names:
            customers = table(spark, sf_dir, "customer")
            party = party.join(customers, party["o_custkey"] == customers["c_custkey"], "left")
            values["i94cit"] = F.col("c_nationkey").cast("double")
        values["visatype"] = F.col("o_orderpriority")
        party = party.select("o_orderkey", *[c for c in ("c_nationkey", "o_orderpriority") if c in party.columns])
        # Spark takes the joined side for larger than both; it has a row an order, and no more columns than are used.
        party = F.broadcast(party) if broadcastable(table(spark, sf_dir, "orders")) else party
        rows = rows.join(party, rows["l_orderkey"] == party["o_orderkey"], "left")
    if "i94res" in names:
        suppliers = table(spark, sf_dir, "supplier")
        rows = rows.join(suppliers, rows["l_suppkey"] == suppliers["s_suppkey"], "left")
        values["i94res"] = F.col("s_nationkey").cast("double")
    if "airline" in names:
        parts = table(spark, sf_dir, "part")
        rows = rows.join(parts, rows["l_partkey"] == parts["p_partkey"], "left")
        values["airline"] = _null_when(F.col("l_tax") == 0, F.col("p_brand"))
    if by_extract:
        rows = rows.withColumn(EXTRACT_NAME, extract_name(LINE_COLUMNS["i94yr"](), LINE_COLUMNS["i94mon"]()))
        rows = rows.hint("rebalance", F.col(EXTRACT_NAME)).sortWithinPartitions(EXTRACT_NAME)
        values[EXTRACT_NAME] = F.col(EXTRACT_NAME)
        names = [*names, EXTRACT_NAME]
    return rows.select([values[name].alias(name) for name in names])


def place_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crossings counted by port and country of citizenship, as ``entries``.

    Line items carry two keys to their order, once.  Counting them by order first would shuffle nearly
    all of them twice: an order has few line items; one that has many is split by adaptive execution.
    """
    met = crossings(spark, sf_dir, "i94port", "i94cit", "arrdate").where(F.col("arrdate").isNotNull())
    return met.groupBy("i94port", "i94cit").agg(F.count(F.lit(1)).alias("entries"))


def _quoted(text: Column) -> Column:
    return F.concat(F.lit("'"), text, F.lit("'"))


def raw_ports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as a raw port list, with and without a state, and with a part too many."""
    suppliers, nations = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    key, name = F.col("s_suppkey"), F.col("s_name")
    full_name = (
        F.when(key % 7 == 0, name)
        .when(key % 11 == 0, F.concat(name, F.lit(", A, B")))
        .otherwise(F.concat(name, F.lit(", "), F.col("n_name"), F.lit("   ")))
    )
    return suppliers.join(nations, suppliers["s_nationkey"] == nations["n_nationkey"]).select(
        _quoted(F.concat(F.lit("P"), key.cast("string"), F.lit(" "))).alias("code"),
        _quoted(full_name).alias("name"),
    )


def raw_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as a raw country list; those it lacks make some crossings drop out."""
    key = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").where(key % 6 != 5).select(
        key.cast("string").alias("code"),
        _quoted(F.col("n_name")).alias("name"),
        F.when(key % 5 == 0, 0).otherwise(key).cast("string").alias("iso_number"),
    )


def raw_iso(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as an ISO list: padded codes, one blank region, column names as published."""
    nations, regions = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    padded = F.lpad(F.col("n_nationkey").cast("string"), 3, "0")
    region = _null_when(F.col("n_nationkey") == 9, F.col("r_name"))
    region_code = _null_when(F.col("n_nationkey") == 9, F.lpad(F.col("r_regionkey").cast("string"), 3, "0"))
    nothing = F.lit(None).cast("string")
    return (
        nations.where(F.col("n_nationkey") != 0)
        .join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("n_name").alias("name"),
            F.concat(F.lit("N"), F.substring(padded, 2, 2)).alias("alpha-2"),
            F.concat(F.lit("N"), padded).alias("alpha-3"),
            padded.alias("country-code"),
            F.concat(F.lit("ISO 3166-2:N"), padded).alias("iso_3166-2"),
            region.alias("region"),
            F.concat(F.lit("Sub "), region).alias("sub-region"),
            nothing.alias("intermediate-region"),
            region_code.alias("region-code"),
            F.concat(F.lit("1"), region_code).alias("sub-region-code"),
            nothing.alias("intermediate-region-code"),
        )
    )


def raw_iata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as a world airport list of twelve columns."""
    suppliers, nations = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    key = F.col("s_suppkey").cast("string")
    joined = suppliers.join(nations, suppliers["s_nationkey"] == nations["n_nationkey"])
    columns = {
        "ident": F.concat(F.lit("K"), key),
        "type": F.when(F.col("s_suppkey") % 2 == 0, "small_airport").otherwise("heliport"),
        "name": F.col("s_name"),
        "elevation_ft": F.floor("s_acctbal").cast("string"),
        "continent": F.concat(F.lit("R"), F.col("n_regionkey").cast("string")),
        "iso_country": F.col("n_nationkey").cast("string"),
        "iso_region": F.concat_ws("-", F.col("n_nationkey").cast("string"), key),
        "municipality": F.col("n_name"),
        "gps_code": F.concat(F.lit("G"), key),
        "iata_code": F.concat(F.lit("P"), key),
        "local_code": F.concat(F.lit("L"), key),
        "coordinates": F.concat(key, F.lit(", "), F.col("n_nationkey").cast("string")),
    }
    return joined.select([value.alias(name) for name, value in columns.items()])


def ports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_ports(raw_ports(spark, sf_dir))


def countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_countries(raw_countries(spark, sf_dir))


def iso(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ISO list as its scan returns it: names by position, codes without padding."""
    raw = raw_iso(spark, sf_dir)
    named = raw.toDF(*[name.replace("-", "_") for name in raw.columns])
    return named.withColumn("country_code", F.col("country_code").cast("int").cast("string"))


def clean(spark: SparkSession, sf_dir: str, *wanted: str) -> DataFrame:
    return fill_nulls(crossings(spark, sf_dir, *wanted))


def write_extracts(crossed: DataFrame, root: str) -> None:
    """One folder of parts a month below ``root``, named like a monthly extract."""
    if EXTRACT_NAME not in crossed.columns:
        crossed = crossed.withColumn(EXTRACT_NAME, extract_name(F.col("i94yr"), F.col("i94mon")))
        crossed = crossed.hint("rebalance", F.col(EXTRACT_NAME))
    crossed.write.mode("append").partitionBy(EXTRACT_NAME).parquet(root)


RAW_LISTS = {"ports": raw_ports, "countries": raw_countries, "iso": raw_iso, "iata": raw_iata}


def write_list(spark: SparkSession, sf_dir: str, name: str, base: str) -> str:
    """One raw list as CSV below ``base``; returns its path."""
    path = f"{base}/{name}"
    write_clean_csv(RAW_LISTS[name](spark, sf_dir), path)
    return path
