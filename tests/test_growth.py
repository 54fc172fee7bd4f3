"""What queries shuffle, sort and take apart row by row, on rows made here: figures that would outgrow a larger table."""

from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from landfall.catalog import bindings as b
from landfall.operators import numbering
from landfall.schemas import EXTRACT
from landfall.session import workspace
from landfall.sinks.snapshots import manifests
from landfall.sources import extracts
from landfall.streaming import incremental
from tests.test_files import extract_row, write_extract


@pytest.fixture
def sf_dir(spark):
    """Tables of a few rows; a line item comes twice, one has no keys, one an order that is not there."""
    path = workspace(spark)
    day = datetime(1996, 3, 4)
    line = (1, 1, 1, 1, 5.0, 1.0, 0.0, 0.02, "N", "O", day)
    rows = {
        "lineitem": [line, line, (9, 1, 1, 2, 5.0, 1.0, 0.1, 0.0, "R", "F", datetime(1995, 12, 31)), (None, None, None, 3, None, 1.0, 0.1, 0.0, None, None, day)],
        "orders": [(1, 1, "O", 1.0, day, "5-LOW")],
        "customer": [(1, "C", 3, 0.0, "S")],
        "supplier": [(1, "S", 3, 0.0)],
        "part": [(1, "P", "B", "T", 1, 1.0)],
        "nation": [(3, "N", 0)],
        "region": [(0, "R")],
    }
    for name, values in rows.items():
        spark.createDataFrame(values, b.TABLES[name]).write.parquet(f"{path}/{name}.parquet")
    return path


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_extracts_are_dealt_as_line_items(spark, sf_dir):
    wide, dealt = b.crossings(spark, sf_dir), b.crossings(spark, sf_dir, by_extract=True)
    before = plan(dealt).split("REBALANCE_PARTITIONS_BY_COL")[1]
    assert "cicid" in plan(dealt) and "cicid" not in before and "date_format(cast(l_shipdate" not in before
    for crossed, name in ((wide, "wide"), (dealt, "dealt")):
        b.write_extracts(crossed, f"{sf_dir}/{name}")
    found = [spark.read.schema(wide.schema).parquet(f"{sf_dir}/{name}") for name in ("wide", "dealt")]
    rows = [Counter(map(tuple, df.select(*wide.columns, "extract").collect())) for df in found]
    assert rows[0] == rows[1] and sum(rows[1].values()) == 4
    assert {r["extract"] for r in found[1].collect()} == {"i94_mar96_sub", "i94_dec95_sub"}


def test_filters_go_below_the_deal(spark, sf_dir):
    dealt = b.crossings(spark, sf_dir, by_extract=True).where(F.col("i94yr") > 1995)
    above, below = plan(dealt).split("REBALANCE_PARTITIONS_BY_COL")
    assert "Filter" not in above and "year(cast(l_shipdate" in below and dealt.count() == 3


def test_months_are_told_once_a_file(spark):
    root = workspace(spark)
    write_extract(spark, f"{root}/a b", "i94_jan16_sub.parquet", [extract_row(n, 2016, 1, 20454.0) for n in (1, 1, 2)])
    write_extract(spark, f"{root}/a b", "i94_feb99_sub.parquet", [extract_row(3, 1999, 2, None)])
    rows = incremental.with_extract_month(extracts.scan_admissions(spark, root))
    assert rows.columns == [*EXTRACT.names, *incremental.MONTH]
    above, below = plan(rows).split("BroadcastExchange", 1)
    assert "regexp" not in above and "HashAggregate" in below
    found = Counter((r["cicid"], r["extract_year"], r["extract_month"]) for r in rows.collect())
    assert found == {(1.0, 2016, 1): 2, (2.0, 2016, 1): 1, (3.0, 1999, 2): 1}
    write_extract(spark, root, "i94_xyz16_sub.parquet", [extract_row(4, 2016, 1, 20454.0)])
    with pytest.raises(Exception, match="no month in file name"):
        incremental.with_extract_month(extracts.scan_admissions(spark, root)).collect()


def test_keys_are_computed_once_a_delivery(spark):
    base, seen = workspace(spark), spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    def delivered(*values):
        return spark.createDataFrame([(v,) for v in values], "k string").repartition(2).mapInArrow(counted, "k string")

    def numbers(*values):
        return {r["k"]: r["number"] for r in numbering.numbered(spark, base, "map", delivered(*values)).collect()}

    assert numbers("b", None, "b", "d") == {None: 0, "b": 1, "d": 2} and seen.value == 4
    assert numbers("c", "a", None, "a", "d") == {None: 0, "b": 1, "d": 2, "a": 3, "c": 4} and seen.value == 9
    assert numbers("a", "c") == {None: 0, "b": 1, "d": 2, "a": 3, "c": 4} and len(manifests(spark, base)) == 2
