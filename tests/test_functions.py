"""Column functions on hand-made values."""

from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from landfall.functions import dates, keys, labels, text


def one_column(spark, values, kind, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i INT, v {kind}")
    rows = df.select("i", expression(F.col("v")).alias("r")).collect()
    return [row["r"] for row in sorted(rows)]


def test_strip_quotes(spark):
    assert one_column(spark, ["'A'", "O'NEIL'", "", None], "STRING", text.strip_quotes) == ["A", "ONEIL", "", None]


@pytest.mark.parametrize("blank", [" ", "\t", "\n", "\r", "\x0b", "\x0c", " ", " ", "　", "\x1c", "\x1f", "\x85"])
def test_trim_text_strips_what_python_strips(spark, blank):
    padded = f"{blank}{blank}A{blank}B{blank}"
    assert one_column(spark, [padded, blank], "STRING", text.trim_text) == [padded.strip(), ""]


def test_name_and_state(spark):
    names = ["ALCAN, AK   ", "A, B, C", "NOSTATE", "TRAIL,", "", None]
    assert one_column(spark, names, "STRING", text.place_name) == ["ALCAN", "A", "NOSTATE", "TRAIL", "", None]
    states = one_column(spark, names[:-1], "STRING", text.place_state)
    assert states == ["AK", "NaN", "NaN", "", "NaN"]


def test_state_stand_in_can_be_chosen(spark):
    assert one_column(spark, ["X"], "STRING", lambda c: text.place_state(c, missing="?")) == ["?"]


def test_day_numbers(spark):
    days = [0.0, 20454.0, 20545.0, 20819.0, -3.0, 1.9, -1.9, None]
    assert one_column(spark, days, "DOUBLE", dates.day_to_ts) == [
        datetime(1960, 1, 1), datetime(2016, 1, 1), datetime(2016, 4, 1), datetime(2016, 12, 31),
        datetime(1959, 12, 29), datetime(1960, 1, 2), datetime(1959, 12, 31), None,
    ]


def test_day_numbers_do_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert one_column(spark, [20454.0], "DOUBLE", dates.day_to_ts) == [datetime(2016, 1, 1)]
        assert one_column(spark, [20454.0], "DOUBLE", lambda c: F.hour(dates.day_to_ts(c))) == [0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_departure_is_day_zero_or_null(spark):
    values = [20454.0, 0.0, None]
    zero = datetime(1960, 1, 1)
    assert one_column(spark, values, "DOUBLE", dates.departure_ts) == [datetime(2016, 1, 1), zero, zero]
    kept_null = one_column(spark, values, "DOUBLE", lambda c: dates.departure_ts(c, null_departure=True))
    assert kept_null == [datetime(2016, 1, 1), None, None]


@pytest.mark.parametrize(
    "day, parts",
    [
        (20454.0, {"hour": 0, "day": 1, "week": 53, "month": 1, "year": 2016, "weekday": 6}),
        (20456.0, {"hour": 0, "day": 3, "week": 53, "month": 1, "year": 2016, "weekday": 1}),
    ],
)
def test_date_parts(spark, day, parts):
    ts = dates.day_to_ts(F.lit(day))
    row = spark.range(1).select([part.alias(name) for name, part in dates.date_parts(ts).items()]).first()
    assert row.asDict() == parts


def test_numbers_equal_numbers_in_text(spark):
    df = spark.createDataFrame([(582.0, "582"), (582.0, "0582"), (582.5, "582"), (1.0, "x"), (1.0, None)], "n DOUBLE, t STRING")
    same = [r[0] for r in df.select(keys.same_number(F.col("n"), F.col("t"))).collect()]
    assert same == [True, True, False, None, None]


def test_padded_codes(spark):
    assert one_column(spark, ["004", "4", "", "NA", None], "STRING", keys.as_integer) == [4, 4, None, None, None]


def test_natural_id(spark):
    df = spark.createDataFrame([(2016.0, 4.0, 6.0), (2016.0, 4.0, None)], "i94yr DOUBLE, i94mon DOUBLE, cicid DOUBLE")
    assert [r[0] for r in df.select(keys.natural_id(df)).collect()] == ["2016-4-6", None]


def test_labels(spark):
    modes = one_column(spark, [1.0, 2.0, 3.0, 4.0, 0.0, None], "DOUBLE", lambda c: labels.code_label(c, labels.ARRIVAL_MODES))
    assert modes == ["Air", "Sea", "Land", "Not reported", None, None]


def test_day_number_that_is_no_number_stops_the_job(spark):
    with pytest.raises(PySparkException):
        one_column(spark, [float("nan")], "DOUBLE", dates.day_to_ts)
