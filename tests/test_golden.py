"""Numbers known beforehand for the middle-sized test tables."""

import pytest

from landfall.catalog.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


@pytest.mark.parametrize(
    "name, rows",
    [("dim_admissions", 59_918), ("dim_countries", 17), ("dim_airports", 100), ("dim_time", 2_499), ("fact_immigrations", 50_654)],
)
def test_table_sizes(spark, name, rows):
    assert QUERIES[name](spark, SF_DIR).count() == rows


def test_bad_keys(spark):
    assert QUERIES["count_bad_keys"](spark, SF_DIR).first()["bad_key_count"] == 468


def test_ports_without_state(spark):
    assert QUERIES["clean_ports"](spark, SF_DIR).where("i94_airport_state = 'NaN'").count() == 23


@pytest.mark.parametrize("name", ["nationalities_from_extract", "nationalities_by_airport"])
def test_first_port(spark, name):
    found = QUERIES[name](spark, SF_DIR)
    row = found.where("airport_id = 'P0'").first()
    assert (found.count(), row["entries"], row["nationalities"]) == (100, 554, 21)


def test_dropped_rows_are_those_of_missing_countries(spark):
    fact = QUERIES["fact_immigrations"](spark, SF_DIR)
    assert 60_000 - fact.count() == 9_346
    assert fact.select("immigration_id").distinct().count() == 50_654


def test_text_join_of_padded_codes_would_find_nothing(spark):
    countries, iso = QUERIES["scan_countries"](spark, SF_DIR), QUERIES["typed_from_local"](spark, SF_DIR)
    assert countries.join(iso, countries["iso_number"] == iso["country_code"]).where("length(iso_number) < 3").count() == 0
