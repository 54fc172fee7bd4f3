"""Tables in which one order, supplier, part and customer each hold a third of the rows.

Joins are forced to shuffle and partitions are split from a small size on, so that
the ways around hot keys are taken; results must still equal the SQL.
"""

import pytest
from pyspark.sql import functions as F

from landfall.catalog import bindings as b
from landfall.catalog.oracle import SQL
from landfall.catalog.queries import QUERIES
from landfall.operators.joins import spread_join
from landfall.session import workspace
from tests.comparing import SF_DIR, TABLES, assert_same

HOT = 1
FORCED = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
}


@pytest.fixture(scope="module")
def skewed_dir(spark):
    path = workspace(spark)
    rewritten = {"lineitem": ["l_orderkey", "l_suppkey", "l_partkey"], "orders": ["o_custkey"]}
    for name in TABLES:
        df = b.table(spark, SF_DIR, name)
        columns = df.columns
        # The row's own columns pick the hot third, the same for each rewritten key.
        is_hot = F.pmod(F.xxhash64(*columns), F.lit(3)) == 0
        keys = {c: F.when(is_hot, F.lit(HOT).cast("bigint")).otherwise(F.col(c)) for c in rewritten.get(name, [])}
        df.select([keys.get(c, F.col(c)).alias(c) for c in columns]).repartition(8).write.parquet(f"{path}/{name}.parquet")
    return path


@pytest.fixture
def forced(spark):
    before = {name: spark.conf.get(name, None) for name in FORCED}
    for name, value in FORCED.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.mark.parametrize(
    "name",
    [
        "nationalities_from_extract", "nationalities_by_airport", "top_airports", "fact_immigrations", "dim_admissions",
        "dim_time", "join_fact_port_spread", "order_fact", "write_partitioned_replace", "dropped_rows",
        "orphan_fact_countries", "dq_report",
    ],
)
def test_results_hold_under_skew(spark, skewed_dir, forced, name):
    assert_same(QUERIES[name](spark, skewed_dir), SQL[name], skewed_dir)


def test_hot_order_is_split_at_run_time(spark, skewed_dir, forced):
    df = b.crossings(spark, skewed_dir, "cicid", "i94cit", "fltno")
    df.collect()
    assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()


def test_hot_port_is_spread_before_the_join(spark, skewed_dir):
    rows = b.clean(spark, skewed_dir, "cicid", "i94port")
    joined = spread_join(rows, b.ports(spark, skewed_dir), "i94port", "i94_port", "cicid", 100)
    hot = joined.where(F.col("i94port") == f"P{HOT}")
    assert hot.count() == rows.where(F.col("i94port") == f"P{HOT}").count() > 1500
