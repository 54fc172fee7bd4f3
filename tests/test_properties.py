"""Native expressions against plain Python, on generated values."""

from collections import Counter
from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from landfall.functions import dates, text
from landfall.operators.clean import clean_ports
from landfall.operators.joins import spread_join
from landfall.schemas import RAW_PORTS

few = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
letters = st.text(alphabet=" \t\n  \x1cAb',é", max_size=12)


def python_port(code, name):
    parts = name.replace("'", "").split(",")
    state = parts[1].strip() if len(parts) == 2 else "NaN"
    return code.replace("'", "").strip(), parts[0].strip(), state


@few
@given(st.lists(st.tuples(letters, letters), min_size=1, max_size=40))
def test_ports_are_cleaned_as_python_would(spark, raw):
    cleaned = clean_ports(spark.createDataFrame(raw, RAW_PORTS)).collect()
    assert Counter(map(tuple, cleaned)) == Counter(python_port(*row) for row in raw)


@few
@given(st.lists(letters, min_size=1, max_size=60))
def test_trim_equals_strip(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v STRING").select(text.trim_text(F.col("v")))
    assert Counter(r[0] for r in df.collect()) == Counter(v.strip() for v in values)


@few
@given(st.lists(st.floats(min_value=-500_000, max_value=500_000, allow_nan=False), min_size=1, max_size=60))
def test_days_equal_python_dates(spark, days):
    df = spark.createDataFrame([(d,) for d in days], "d DOUBLE").select(dates.day_to_ts(F.col("d")))
    expected = Counter(datetime(1960, 1, 1) + timedelta(days=int(d)) for d in days)
    assert Counter(r[0] for r in df.collect()) == expected


@few
@given(
    st.lists(st.one_of(st.none(), st.integers(0, 6)), max_size=60),
    st.lists(st.integers(0, 8), max_size=12),
    st.integers(1, 20),
)
def test_spread_join_equals_nested_loops(spark, keys, codes, rows_per_task):
    facts = spark.createDataFrame(list(enumerate(keys)), "id INT, k INT")
    lookup = spark.createDataFrame(list(enumerate(codes)), "pos INT, code INT")
    joined = spread_join(facts, lookup, "k", "code", "id", rows_per_task)
    expected = Counter((i, k, p, c) for i, k in enumerate(keys) for p, c in enumerate(codes) if k == c)
    assert Counter(map(tuple, joined.collect())) == expected
