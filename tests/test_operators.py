"""Operators on a few rows, with what the test tables lack."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from landfall.operators import clean, joins, ordering, quality
from landfall.operators.distinct import distinct_time
from landfall.schemas import EXTRACT, ISO, RAW_COUNTRIES, RAW_PORTS
from landfall.sources.lookups import apply_schema


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_clean_ports(spark):
    raw = spark.createDataFrame(
        [("'ALC", "'ALCAN, AK   '"), ("'X'", "'A, B, C'"), ("'Y'", "'NOSTATE'"), ("'Z'", "'TRAIL,'")], RAW_PORTS
    )
    assert rows(clean.clean_ports(raw)) == Counter(
        [("ALC", "ALCAN", "AK"), ("X", "A", "NaN"), ("Y", "NOSTATE", "NaN"), ("Z", "TRAIL", "")]
    )


def test_clean_countries(spark):
    raw = spark.createDataFrame([("582", "  'MEXICO Air Sea' ", "484")], RAW_COUNTRIES)
    assert rows(clean.clean_countries(raw)) == Counter([("582", "MEXICO Air Sea", "484")])


def test_fill_nulls_leaves_keys_and_age(spark):
    filled = clean.fill_nulls(spark.createDataFrame([tuple([None] * len(EXTRACT))], EXTRACT)).first().asDict()
    still_null = {"cicid", "i94yr", "i94mon", "i94cit", "i94res", "i94port", "arrdate", "i94bir"}
    assert {name for name, value in filled.items() if value is None} == still_null
    assert filled["depdate"] == 0.0 and filled["airline"] == "NA"


def test_fill_nulls_takes_some_columns_only(spark):
    df = spark.createDataFrame([(None, None)], "airline STRING, other STRING")
    assert clean.fill_nulls(df).first() == ("NA", None)


def test_fill_iso_nulls(spark):
    filled = clean.fill_iso_nulls(spark.createDataFrame([tuple([None] * len(ISO))], ISO)).first().asDict()
    assert filled.pop("country_code") == "0"
    assert set(filled.values()) == {"NA"}


def test_apply_schema_counts_columns(spark):
    with pytest.raises(ValueError):
        apply_schema(spark.range(1), RAW_PORTS)


def test_iso_join_ignores_padding(spark):
    countries = spark.createDataFrame([("1", "A", "4"), ("2", "B", "0"), ("3", "C", "x")], "i94_cit STRING, i94_country_name STRING, iso_country_code STRING")
    iso = spark.createDataFrame([("Afghanistan", "004"), ("Namibia", "516")], "name STRING, country_code STRING")
    assert rows(joins.join_country_iso(countries, iso)) == Counter([("1", "A", "4", "Afghanistan", "004")])


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows on one key, some without a key, some whose key is unknown."""
    df = spark.range(3000).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, "HOT")
        .when(F.col("id") % 50 == 1, F.lit(None))
        .otherwise(F.concat(F.lit("K"), (F.col("id") % 70).cast("string")))
        .alias("port"),
    )
    codes = [("HOT", "hot"), ("HOT", "hot again")] + [(f"K{i}", f"name {i}") for i in range(60)]
    return df, spark.createDataFrame(codes, "code STRING, name STRING")


@pytest.mark.parametrize("rows_per_task", [1, 40, 700, 10_000])
def test_spread_join_keeps_every_row(skewed, rows_per_task):
    facts, codes = skewed
    expected = rows(facts.join(codes, facts["port"] == codes["code"]))
    spread = joins.spread_join(facts, codes, "port", "code", "id", rows_per_task)
    assert spread.columns == ["id", "port", "code", "name"]
    assert rows(spread) == expected


def test_frequent_keys_are_spread_by_their_count(skewed):
    facts, _ = skewed
    frequent = joins.frequent_keys(facts.withColumn("_key", F.col("port")), rows_per_task=300)
    assert rows(frequent) == Counter([("HOT", 4)])


def test_hot_rows_that_carry_only_an_id_reach_several_tasks(spark, skewed):
    facts, codes = skewed
    forced = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {name: spark.conf.get(name) for name in forced}
    for name, value in forced.items():
        spark.conf.set(name, value)
    try:
        joined = joins.spread_join(facts, codes, "port", "code", "id", 100)
        hot = joined.where("port = 'HOT'").groupBy(F.spark_partition_id()).count().collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert len(hot) > 3


def test_rows_without_an_id_are_not_spread(skewed):
    facts, codes = skewed
    for name in ("missing", "port"):
        with pytest.raises(ValueError, match=name):
            joins.spread_join(facts, codes, "port", "code", name, 100)


def test_time_has_one_row_a_day(spark):
    days = spark.createDataFrame([(1.0,), (1.9,), (2.0,), (2.0,), (None,)], "arrdate DOUBLE")
    assert sorted(r["day"] or 0 for r in distinct_time(days).collect()) == [0, 2, 3]


def test_total_order(spark):
    df = spark.createDataFrame([(2, "b"), (1, "z"), (1, "a")], "n INT, t STRING")
    assert [tuple(r) for r in ordering.total_order(df, "n").collect()] == [(1, "a"), (1, "z"), (2, "b")]
    assert [tuple(r) for r in ordering.head_n(ordering.total_order(df, "t"), 1).collect()] == [(1, "a")]


KEYED = "k1 STRING, k2 DOUBLE"


def checked(spark, data, **options):
    df = spark.createDataFrame(data, KEYED)
    return quality.check_table(df, "t", ["k1", "k2"], **options).first()


def test_check_finds_null_and_empty_but_not_blank_keys(spark):
    data = [("a", 1.0), (None, 1.0), ("", 1.0), ("a", None), (" ", 0.0)]
    assert tuple(checked(spark, data)) == ("t", 5, 3, "NOK")


@pytest.mark.parametrize("data, verdict, compat", [([("a", 1.0)], "OK", "OK"), ([], "NOK", "OK"), ([(None, 1.0)], "NOK", "NOK")])
def test_verdict(spark, data, verdict, compat):
    assert checked(spark, data)["status"] == verdict
    assert checked(spark, data, compat=True)["status"] == compat


@pytest.mark.parametrize("bad, n, verdict", [(0, 5, "OK"), (3, 5, "NOK"), (0, 0, "NOK"), (3, 0, "NOK")])
def test_verdict_on_counts(spark, bad, n, verdict):
    assert spark.range(1).select(quality.dq_verdict(F.lit(bad), F.lit(n))).first()[0] == verdict


def test_empty_table_counts_zero(spark):
    empty = spark.createDataFrame([], KEYED)
    assert quality.count_rows(empty).first()[0] == 0
    assert quality.count_bad_keys(empty, ["k1", "k2"]).first()[0] == 0


def test_report_needs_no_cast_errors_under_ansi(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    df = spark.range(1).select(F.lit(1.5).alias("k2"), F.current_timestamp().alias("ts"), F.lit(1).alias("i"))
    assert quality.check_table(df, "t", ["k2", "ts", "i"]).first()["status"] == "OK"
