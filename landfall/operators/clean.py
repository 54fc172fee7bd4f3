"""Cleaning of the extract and the code lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.functions.text import NO_STATE, place_name, place_state, strip_quotes, tidy
from landfall.schemas import ISO

# What stands for an absent text, number or ISO number.
NO_TEXT = "NA"
NO_NUMBER = 0.0
NO_ISO_NUMBER = "0"

# The extract columns that are filled.  Age (i94bir) is a number and stays null.
FILLED_NUMBERS = ["i94mode", "depdate", "i94visa", "count", "biryear", "admnum"]
FILLED_TEXTS = [
    "i94addr", "dtadfile", "visapost", "occup", "entdepa", "entdepd", "entdepu",
    "matflag", "dtaddto", "gender", "insnum", "airline", "fltno", "visatype",
]


def _fill(df: DataFrame, fills: dict[str, object]) -> DataFrame:
    present = {name: value for name, value in fills.items() if name in df.columns}
    return df.na.fill(present) if present else df


def fill_nulls(extract: DataFrame) -> DataFrame:
    """Constants for absent values, in whichever of the columns the extract carries."""
    fills = dict.fromkeys(FILLED_NUMBERS, NO_NUMBER) | dict.fromkeys(FILLED_TEXTS, NO_TEXT)
    return _fill(extract, fills)


def fill_iso_nulls(iso: DataFrame) -> DataFrame:
    """Constants for absent values of the ISO list."""
    return _fill(iso, dict.fromkeys(ISO.names, NO_TEXT) | {"country_code": NO_ISO_NUMBER})


def clean_ports(raw: DataFrame, missing_state: str = NO_STATE) -> DataFrame:
    """Quoted code and ``NAME, STATE`` to three clean columns."""
    full_name = strip_quotes(F.col("name"))
    return raw.select(
        tidy(F.col("code")).alias("i94_port"),
        place_name(full_name).alias("i94_airport_name"),
        place_state(full_name, missing_state).alias("i94_airport_state"),
    )


def clean_countries(raw: DataFrame) -> DataFrame:
    """Name without quotes and outer blanks; both codes as they are."""
    return raw.select(
        F.col("code").alias("i94_cit"),
        tidy(F.col("name")).alias("i94_country_name"),
        F.col("iso_number").alias("iso_country_code"),
    )
