"""One explicit schema per source, the star-table columns, and the key columns."""

from __future__ import annotations

from pyspark.sql import types as T

TEXT, NUMBER = T.StringType(), T.DoubleType()


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# The 28 columns of a monthly extract.
EXTRACT = _schema(
    cicid=NUMBER, i94yr=NUMBER, i94mon=NUMBER, i94cit=NUMBER, i94res=NUMBER,
    i94port=TEXT, arrdate=NUMBER, i94mode=NUMBER, i94addr=TEXT, depdate=NUMBER,
    i94bir=NUMBER, i94visa=NUMBER, count=NUMBER, dtadfile=TEXT, visapost=TEXT,
    occup=TEXT, entdepa=TEXT, entdepd=TEXT, entdepu=TEXT, matflag=TEXT,
    biryear=NUMBER, dtaddto=TEXT, gender=TEXT, insnum=TEXT, airline=TEXT,
    admnum=NUMBER, fltno=TEXT, visatype=TEXT,
)

# The raw code lists, and their cleaned forms.
RAW_PORTS = _schema(code=TEXT, name=TEXT)
RAW_COUNTRIES = _schema(code=TEXT, name=TEXT, iso_number=TEXT)
PORTS = _schema(i94_port=TEXT, i94_airport_name=TEXT, i94_airport_state=TEXT)
COUNTRIES = _schema(i94_cit=TEXT, i94_country_name=TEXT, iso_country_code=TEXT)
ISO = _schema(
    name=TEXT, alpha_2=TEXT, alpha_3=TEXT, country_code=TEXT, iso_3166_2=TEXT,
    region=TEXT, sub_region=TEXT, intermediate_region=TEXT,
    region_code=TEXT, sub_region_code=TEXT, intermediate_region_code=TEXT,
)

# Star-table columns, each with the source column it renames.
ADMISSIONS = {
    "admission_nbr": "admnum",
    "country_code": "i94res",
    "age": "i94bir",
    "visa_code": "i94visa",
    "visa_type": "visatype",
    "person_gender": "gender",
}
COUNTRY_DIM = {
    "country_code": "i94_cit",
    "country_name": "i94_country_name",
    "iso_ccode": "iso_country_code",
    "iso_alpha_2": "alpha_2",
    "iso_alpha_3": "alpha_3",
    "iso_3166_2_code": "iso_3166_2",
    "iso_country_name": "name",
    "iso_region": "region",
    "iso_sub_region": "sub_region",
    "iso_region_code": "region_code",
    "iso_sub_region_code": "sub_region_code",
}
AIRPORTS = {
    "airport_id": "i94_port",
    "airport_name": "i94_airport_name",
    "airport_state": "i94_airport_state",
}
FACT = {
    "immigration_id": "immigration_id",
    "arrival_time": "arrival_time",
    "arrival_year": "arrival_year",
    "arrival_month": "arrival_month",
    "airport_id": "i94_port",
    "country_code": "i94_cit",
    "admission_nbr": "admnum",
    "arrival_mode": "i94mode",
    "departure_date": "departure_date",
    "airline": "airline",
    "flight_nbr": "fltno",
}

# The columns of each star table that must be neither null nor empty.
KEYS = {
    "admissions": ["admission_nbr", "country_code"],
    "countries": [
        "country_code", "country_name", "iso_ccode", "iso_alpha_2",
        "iso_alpha_3", "iso_3166_2_code", "iso_country_name",
    ],
    "airports": ["airport_id", "airport_name"],
    "time": ["arrival_ts"],
    "immigrations": [
        "immigration_id", "arrival_time", "arrival_year", "arrival_month",
        "airport_id", "country_code", "admission_nbr",
    ],
}


def retyped(schema: T.StructType, **kinds: T.DataType) -> T.StructType:
    """The same schema with some columns given another type."""
    return T.StructType([T.StructField(f.name, kinds.get(f.name, f.dataType)) for f in schema])
