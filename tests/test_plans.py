"""What the plans look like, and what must hold between the tables."""

import re
from pathlib import Path

import pytest

import __spark_entry__ as contract
from landfall.catalog import bindings as b
from landfall.catalog.oracle import SQL
from landfall.catalog.queries import QUERIES
from landfall.plans import fact as facts
from landfall.operators import joins
from landfall.operators.quality import check_table
from landfall.plans import losses
from landfall.plans.months import build_star
from landfall.plans.staging import Staged
from landfall.schemas import KEYS
from landfall.session import workspace
from landfall.sinks.writers import write_overwrite
from landfall.sources.tables import scan_parquet
from tests.comparing import SF_DIR, content


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# Queries that only look at a written table show no more than its scan.
@pytest.mark.parametrize("name", ["fact_immigrations", "dim_time", "dim_admissions", "nationalities_from_extract", "dq_immigrations", "top_airports"])
def test_no_python_and_no_product_in_the_plan(spark, name):
    plan = physical(QUERIES[name](spark, SF_DIR))
    assert not re.search("Python|ArrowEval|CartesianProduct|NestedLoop", plan)


def test_time_shuffles_days_and_reads_one_column(spark):
    plan = physical(QUERIES["dim_time"](spark, SF_DIR))
    assert plan.count("Exchange") == 1
    assert "ReadSchema: struct<l_shipdate:timestamp_ntz>" in plan
    assert re.search(r"Project \[.*weekofyear.*\n\s*\+- HashAggregate", plan)


def below(plan: str, text: str) -> str:
    """The lines of the part of a plan whose first line has ``text``."""
    lines = plan.split("\n")
    first = next(k for k, line in enumerate(lines) if text in line)
    depth = [len(line) - len(line.lstrip(" :+-")) for line in lines]
    last = next((k for k in range(first + 1, len(lines)) if depth[k] <= depth[first]), len(lines))
    return "\n".join(lines[first:last])


def test_arrivals_are_counted_before_the_lists_are_joined(spark):
    plan = QUERIES["nationalities_from_extract"](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    counted = below(plan, "Aggregate [i94port")
    assert "Relation [l_orderkey" in counted and "Relation [o_orderkey" in counted
    assert "Relation [s_suppkey" not in counted and "n_name" not in counted
    assert "Relation [s_suppkey" in plan and plan.count("Aggregate") == 2


@pytest.mark.parametrize("limit, shuffled", [("64m", 0), ("-1", 1)])
def test_line_items_are_shuffled_once_at_most(spark, limit, shuffled):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, limit)
    try:
        plan = physical(QUERIES["dropped_rows"](spark, SF_DIR))
    finally:
        spark.conf.set(name, before)
    exchanged = [below(plan, line) for line in plan.split("\n") if "Exchange hashpartitioning(l_orderkey" in line]
    assert len(exchanged) == shuffled


def test_fact_has_no_shuffle_of_its_own(spark):
    plan = physical(QUERIES["fact_immigrations"](spark, SF_DIR))
    assert "HashAggregate" not in plan and "Exchange hashpartitioning" not in plan


def test_no_session_bound_shortcuts_in_the_library():
    package = Path(contract.__file__).parent / "landfall"
    sources = "".join(path.read_text() for path in package.rglob("*.py") if package / "llm" not in path.parents)
    for word in ("localCheckpoint", ".rdd", "crossJoin", "toPandas", "F.udf", "pandas_udf", ".cache()"):
        assert word not in sources


def test_short_fact_build_equals_the_written_out_join(spark):
    short = content(QUERIES["fact_immigrations"](spark, SF_DIR).toArrow())
    assert short == content(QUERIES["project_fact"](spark, SF_DIR).toArrow())


def test_kept_and_dropped_add_up(spark):
    clean = b.clean(spark, SF_DIR, "cicid", "i94yr", "i94mon", "i94port", "i94cit", "arrdate", "depdate", "admnum", "i94mode", "airline", "fltno")
    countries, ports = b.countries(spark, SF_DIR), b.ports(spark, SF_DIR)
    loss = losses.dropped_rows(clean, countries, ports).first()
    assert loss["kept_rows"] == facts.fact_immigrations(clean, countries, ports).count()
    assert loss["source_rows"] == clean.count()
    # Here only countries are missing, so each dropped row is counted once.
    assert loss["source_rows"] - loss["kept_rows"] == loss["unknown_country"]


def test_rows_without_day_port_or_country_drop(spark):
    clean = b.clean(spark, SF_DIR, "cicid", "i94yr", "i94mon", "i94port", "i94cit", "arrdate", "depdate", "admnum", "i94mode", "airline", "fltno").limit(1)
    countries, ports = b.countries(spark, SF_DIR), b.ports(spark, SF_DIR)
    for column in ("arrdate", "i94port", "i94cit"):
        kind = dict(clean.dtypes)[column]
        emptied = clean.selectExpr(*[f"cast(null AS {kind}) AS {c}" if c == column else c for c in clean.columns])
        assert facts.fact_immigrations(emptied, countries, ports).count() == 0


STAR_TYPES = {
    "admissions": "admission_nbr double, country_code double, age double, visa_code double, visa_type string, "
    "person_gender string",
    "countries": "country_code string, country_name string, iso_ccode string, iso_alpha_2 string, iso_alpha_3 string, "
    "iso_3166_2_code string, iso_country_name string, iso_region string, iso_sub_region string, "
    "iso_region_code string, iso_sub_region_code string",
    "airports": "airport_id string, airport_name string, airport_state string",
    "time": "arrival_ts timestamp_ntz, hour int, day int, week int, month int, year int, weekday int",
    "immigrations": "immigration_id string, arrival_time timestamp_ntz, arrival_year int, arrival_month int, "
    "airport_id string, country_code string, admission_nbr double, arrival_mode double, "
    "departure_date timestamp_ntz, airline string, flight_nbr string",
}


def test_star_columns_and_types(spark):
    star = build_star(Staged(b.crossings(spark, SF_DIR), b.ports(spark, SF_DIR), b.countries(spark, SF_DIR), b.iso(spark, SF_DIR)))
    types = {name: ", ".join(f"{column} {kind}" for column, kind in df.dtypes) for name, df in star.items()}
    assert types == STAR_TYPES
    assert set(KEYS) == set(star)


def test_checks_read_key_columns_only(spark):
    path = workspace(spark)
    write_overwrite(QUERIES["fact_immigrations"](spark, SF_DIR), path)
    plan = physical(check_table(scan_parquet(spark, path), "immigrations"))
    read = re.search(r"ReadSchema: struct<(.*)", plan).group(1)
    assert "airline" not in read and "departure_date" not in read


def test_contract(spark):
    assert set(QUERIES) == set(SQL) <= set(contract.oracle_sql()) <= set(contract.queries())
    first = contract.entry(spark)
    assert first.columns == ["airport_id", "airport_name", "airport_state", "entries", "nationalities"]
    assert first.count() > 0


def nodes(plan):
    """All nodes of a plan that has run, those of its finished stages among them."""
    yield plan
    name = plan.nodeName()
    if name.startswith("AdaptiveSparkPlan"):
        below_ = [plan.executedPlan()]
    elif "QueryStage" in name:
        below_ = [plan.plan()]
    else:
        below_ = [plan.children().apply(k) for k in range(plan.children().size())]
    for node in below_:
        yield from nodes(node)


def shuffled_rows(df) -> int:
    """Rows of the largest shuffle of a query."""
    df.collect()
    written = [n.metrics().get("shuffleRecordsWritten") for n in nodes(df._jdf.queryExecution().executedPlan())]
    return max(m.get().value() for m in written if m.isDefined())


def test_rows_without_an_entry_are_dropped_before_the_shuffle(spark):
    names = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
    }
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        path = workspace(spark)
        write_overwrite(b.clean(spark, SF_DIR, "cicid", "i94port"), f"{path}/rows")
        write_overwrite(b.ports(spark, SF_DIR).where("i94_port in ('P1', 'P2')"), f"{path}/ports")
        rows, ports = scan_parquet(spark, f"{path}/rows"), scan_parquet(spark, f"{path}/ports")
        plain = joins.join_lookup(rows, ports, "i94port", "i94_port")
        filtered = joins.join_lookup_filtered(rows, ports, "i94port", "i94_port")
        assert "might_contain" in physical(filtered) and "might_contain" not in physical(plain)
        assert content(filtered.toArrow()) == content(plain.toArrow())
        assert shuffled_rows(filtered) < shuffled_rows(plain) / 2
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
