"""SQL for each query, over the test tables, written apart from the Spark code.

The bindings are spelled out as common table expressions.  A crossing is a line item;
every other table is joined left on its unique key, whichever columns a query wants.
"""

from __future__ import annotations

from landfall.catalog.queries import CHANGED_YEAR, DATE_PARTS

RECORD_KEY = """concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y-%m-%d'))"""
DAY_NUMBER = "date_diff('day', date '1960-01-01', l_shipdate::date)::double"

CROSSINGS = f"""
crossings AS (
  SELECT {RECORD_KEY} AS cicid,
         year(l_shipdate)::double AS i94yr,
         month(l_shipdate)::double AS i94mon,
         c_nationkey::double AS i94cit,
         s_nationkey::double AS i94res,
         'P' || l_suppkey AS i94port,
         {DAY_NUMBER} AS arrdate,
         CASE WHEN l_discount <> 0 THEN (l_linenumber % 4 + 1)::double END AS i94mode,
         CASE WHEN l_linenumber <> 2 THEN l_returnflag END AS i94addr,
         CASE WHEN l_returnflag <> 'N' THEN {DAY_NUMBER} + floor(l_quantity) END AS depdate,
         CASE WHEN l_linenumber <> 7 THEN 18 + l_quantity END AS i94bir,
         (l_linenumber % 3 + 1)::double AS i94visa,
         CASE WHEN l_linenumber <> 3 THEN 1.0::double END AS count,
         CASE WHEN l_linenumber <> 4 THEN strftime(l_shipdate, '%Y%m%d') END AS dtadfile,
         CASE WHEN l_returnflag <> 'R' THEN 'V' || l_linenumber END AS visapost,
         CASE WHEN l_linestatus <> 'F' THEN 'OCC' END AS occup,
         CASE WHEN l_linenumber <> 5 THEN l_returnflag END AS entdepa,
         CASE WHEN l_returnflag <> 'N' THEN 'D' END AS entdepd,
         CASE WHEN l_quantity <= 10 THEN 'U' END AS entdepu,
         CASE WHEN l_returnflag <> 'N' THEN 'M' END AS matflag,
         CASE WHEN l_linenumber <> 7 THEN year(l_shipdate) - (18 + l_quantity) END AS biryear,
         CASE WHEN l_linenumber <> 1 THEN strftime(l_shipdate, '%m%d%Y') END AS dtaddto,
         CASE WHEN l_linestatus <> 'O' THEN l_linestatus END AS gender,
         CASE WHEN l_tax >= 0.04 THEN 'I' || l_partkey END AS insnum,
         CASE WHEN l_tax <> 0 THEN p_brand END AS airline,
         l_orderkey::double AS admnum,
         l_partkey::varchar AS fltno,
         o_orderpriority AS visatype
  FROM lineitem
  LEFT JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN supplier ON l_suppkey = s_suppkey
  LEFT JOIN part ON l_partkey = p_partkey
)"""

# Columns in which a missing number or text is filled.
_NUMBERS = ["i94mode", "depdate", "i94visa", "count", "biryear", "admnum"]
_TEXTS = [
    "i94addr", "dtadfile", "visapost", "occup", "entdepa", "entdepd", "entdepu",
    "matflag", "dtaddto", "gender", "insnum", "airline", "fltno", "visatype",
]
_FILLS = [f"coalesce({c}, 0.0) AS {c}" for c in _NUMBERS] + [f"coalesce({c}, 'NA') AS {c}" for c in _TEXTS]

CLEAN = f"""
clean AS (
  SELECT *, timestamp '1960-01-01' + to_days(trunc(arrdate)::integer) AS arrival_time
  FROM (SELECT * REPLACE ({", ".join(_FILLS)}) FROM crossings)
)"""

RAW_PORTS = """
raw_ports AS (
  SELECT '''P' || s_suppkey || ' ''' AS code,
         '''' || CASE WHEN s_suppkey % 7 = 0 THEN s_name
                      WHEN s_suppkey % 11 = 0 THEN s_name || ', A, B'
                      ELSE s_name || ', ' || n_name || '   ' END || '''' AS name
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
)"""
BARE_PORTS = """
bare_ports AS (SELECT replace(code, '''', '') AS code, replace(name, '''', '') AS name FROM raw_ports)"""
PORTS = """
ports AS (
  SELECT trim(code) AS i94_port,
         trim(split_part(name, ',', 1)) AS i94_airport_name,
         CASE WHEN length(name) - length(replace(name, ',', '')) = 1
              THEN trim(split_part(name, ',', 2)) ELSE 'NaN' END AS i94_airport_state
  FROM bare_ports
)"""
RAW_COUNTRIES = """
raw_countries AS (
  SELECT n_nationkey::varchar AS code, '''' || n_name || '''' AS name,
         (CASE WHEN n_nationkey % 5 = 0 THEN 0 ELSE n_nationkey END)::varchar AS iso_number
  FROM nation WHERE n_nationkey % 6 <> 5
)"""
COUNTRIES = """
countries AS (
  SELECT code AS i94_cit, trim(replace(name, '''', '')) AS i94_country_name, iso_number AS iso_country_code
  FROM raw_countries
)"""
RAW_ISO = """
raw_iso AS (
  SELECT n_name AS name, 'N' || lpad((n_nationkey % 100)::varchar, 2, '0') AS alpha_2,
         'N' || lpad(n_nationkey::varchar, 3, '0') AS alpha_3,
         lpad(n_nationkey::varchar, 3, '0') AS country_code,
         'ISO 3166-2:N' || lpad(n_nationkey::varchar, 3, '0') AS iso_3166_2,
         CASE WHEN n_nationkey <> 9 THEN r_name END AS region,
         CASE WHEN n_nationkey <> 9 THEN 'Sub ' || r_name END AS sub_region,
         NULL::varchar AS intermediate_region,
         CASE WHEN n_nationkey <> 9 THEN lpad(r_regionkey::varchar, 3, '0') END AS region_code,
         CASE WHEN n_nationkey <> 9 THEN '1' || lpad(r_regionkey::varchar, 3, '0') END AS sub_region_code,
         NULL::varchar AS intermediate_region_code
  FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey <> 0
)"""
ISO = """
iso AS (SELECT * REPLACE (country_code::integer::varchar AS country_code) FROM raw_iso)"""

ADMISSIONS = """
admissions AS (
  SELECT DISTINCT admnum AS admission_nbr, i94res AS country_code, i94bir AS age,
         i94visa AS visa_code, visatype AS visa_type, gender AS person_gender
  FROM clean
)"""
COUNTRY_DIM = """
country_dim AS (
  SELECT DISTINCT i94_cit AS country_code, i94_country_name AS country_name, iso_country_code AS iso_ccode,
         alpha_2 AS iso_alpha_2, alpha_3 AS iso_alpha_3, iso_3166_2 AS iso_3166_2_code,
         name AS iso_country_name, region AS iso_region, sub_region AS iso_sub_region,
         region_code AS iso_region_code, sub_region_code AS iso_sub_region_code
  FROM countries JOIN iso ON iso_country_code::integer = country_code::integer
)"""
AIRPORTS = """
airports AS (
  SELECT DISTINCT i94_port AS airport_id, i94_airport_name AS airport_name, i94_airport_state AS airport_state
  FROM ports
)"""
_PARTS = {
    "hour": "hour(arrival_time)::integer",
    "day": "day(arrival_time)::integer",
    "week": "weekofyear(arrival_time)::integer",
    "month": "month(arrival_time)::integer",
    "year": "year(arrival_time)::integer",
    "weekday": "(dayofweek(arrival_time) + 1)::integer",
}
_PARTS_SQL = ", ".join(f"{value} AS {name}" for name, value in _PARTS.items())
TIME = f"""
time_dim AS (SELECT DISTINCT arrival_time AS arrival_ts, {_PARTS_SQL} FROM clean)"""
_ID = "i94yr::integer || '-' || i94mon::integer || '-' || cicid"
_LEFT = "timestamp '1960-01-01' + to_days(trunc(depdate)::integer)"
FACT = f"""
fact AS (
  SELECT {_ID} AS immigration_id, arrival_time, t.year AS arrival_year, t.month AS arrival_month,
         i94_port AS airport_id, i94_cit AS country_code, admnum AS admission_nbr, i94mode AS arrival_mode,
         {_LEFT} AS departure_date, airline, fltno AS flight_nbr
  FROM clean
  JOIN countries ON i94cit = i94_cit::double
  JOIN ports ON i94port = i94_port
  JOIN time_dim t ON arrival_time = arrival_ts
)"""
SEEDED = """
seeded AS (
  SELECT *, k1 IS NULL OR k1 = '' OR k2 IS NULL AS bad_key
  FROM (SELECT o_orderkey, o_orderpriority,
               CASE WHEN o_orderkey % 97 = 0 THEN NULL WHEN o_orderkey % 89 = 0 THEN '' ELSE o_orderpriority END AS k1,
               CASE WHEN o_orderkey % 101 <> 0 THEN o_totalprice END AS k2
        FROM orders)
)"""
CHECKS = """
checks AS (
  SELECT 'admissions' AS table_name, count(*) AS row_count,
         count(*) FILTER (WHERE admission_nbr IS NULL OR country_code IS NULL) AS bad_key_count FROM admissions
  UNION ALL
  SELECT 'countries', count(*),
         count(*) FILTER (WHERE country_code IS NULL OR country_code = '' OR country_name IS NULL OR country_name = ''
                  OR iso_ccode IS NULL OR iso_ccode = '' OR iso_alpha_2 IS NULL OR iso_alpha_2 = ''
                  OR iso_alpha_3 IS NULL OR iso_alpha_3 = '' OR iso_3166_2_code IS NULL OR iso_3166_2_code = ''
                  OR iso_country_name IS NULL OR iso_country_name = '') FROM country_dim
  UNION ALL
  SELECT 'airports', count(*),
         count(*) FILTER (WHERE airport_id IS NULL OR airport_id = '' OR airport_name IS NULL OR airport_name = '') FROM airports
  UNION ALL
  SELECT 'time', count(*), count(*) FILTER (WHERE arrival_ts IS NULL) FROM time_dim
  UNION ALL
  SELECT 'immigrations', count(*),
         count(*) FILTER (WHERE immigration_id IS NULL OR immigration_id = '' OR arrival_time IS NULL OR arrival_year IS NULL
                  OR arrival_month IS NULL OR airport_id IS NULL OR airport_id = '' OR country_code IS NULL
                  OR country_code = '' OR admission_nbr IS NULL) FROM fact
)"""

_EVERYTHING = [
    CROSSINGS, CLEAN, RAW_PORTS, BARE_PORTS, PORTS, RAW_COUNTRIES, COUNTRIES, RAW_ISO, ISO,
    ADMISSIONS, COUNTRY_DIM, AIRPORTS, TIME, FACT, CHECKS,
]
_LISTS = [RAW_PORTS, BARE_PORTS, PORTS, RAW_COUNTRIES, COUNTRIES, RAW_ISO, ISO, COUNTRY_DIM, AIRPORTS]


def _with(tables: list[str], select: str) -> str:
    return "WITH " + ",".join(tables) + "\n" + select


def _of_all(select: str) -> str:
    return _with(_EVERYTHING, select)


def _of_lists(select: str) -> str:
    return _with(_LISTS, select)


def _of_seeded(select: str) -> str:
    return _with([SEEDED], select)


_STATUS = "CASE WHEN bad_key_count > 0 OR row_count < 1 THEN 'NOK' ELSE 'OK' END AS status"
_RUN = "2016-01-31-07-00-00-000000"
_MONTH_MARK = "lower(strftime(make_date(i94yr::integer, i94mon::integer, 1), '%b'))"
_YEAR_MARK = "strftime(make_date(i94yr::integer, i94mon::integer, 1), '%y')"
_EXTRACT = f"'i94_' || {_MONTH_MARK} || {_YEAR_MARK} || '_sub'"
_SUPERSEDED = f"i94yr = {CHANGED_YEAR}"
_COUNTRY_ISO = "FROM countries JOIN iso ON iso_country_code::integer = country_code::integer"
_NATIONALITIES = """
SELECT airport_id, airport_name, airport_state, count(*) AS entries,
       count(DISTINCT country_code) AS nationalities
FROM fact JOIN airports USING (airport_id) GROUP BY airport_id, airport_name, airport_state"""



def _list_check(name: str, key: str) -> str:
    doubled = f"SELECT count(*) FROM (SELECT {key} FROM {name} GROUP BY 1 HAVING count(*) > 1)"
    return f"SELECT '{name}_list', count(*), ({doubled}) FROM {name}"


SQL: dict[str, str] = {
    "scan_admissions": _of_all("SELECT * FROM crossings"),
    "discover_inputs": _of_all(f"SELECT DISTINCT {_EXTRACT} AS extract, true AS has_bytes FROM crossings"),
    "file_month": _of_all(f"""
        SELECT DISTINCT {_MONTH_MARK} AS month_mark, {_YEAR_MARK} AS year_mark,
               i94yr::integer AS extract_year, i94mon::integer AS extract_month FROM crossings"""),
    "order_months": _of_all(f"""
        SELECT DISTINCT i94yr::integer AS extract_year, i94mon::integer AS extract_month,
               CASE WHEN {_SUPERSEDED} THEN 'second' ELSE 'first' END || '/extract=' || {_EXTRACT} AS extract
        FROM crossings"""),
    "scan_latest": _of_all(f"""
        SELECT i94yr, i94mon, count(*) AS row_count,
               count(CASE WHEN NOT {_SUPERSEDED} THEN depdate END) AS departures
        FROM crossings GROUP BY i94yr, i94mon"""),
    "lacking_columns": _of_all(f"""
        SELECT DISTINCT {_EXTRACT} AS extract, 'cicid,depdate' AS lacks FROM crossings WHERE i94yr = {CHANGED_YEAR}"""),
    "scan_ports": _of_lists("SELECT * FROM raw_ports"),
    "scan_countries": _of_lists("SELECT * FROM raw_countries"),
    "scan_iso": _of_lists("SELECT * FROM iso"),
    "scan_iata": """
        SELECT 'K' || s_suppkey AS ident,
               CASE WHEN s_suppkey % 2 = 0 THEN 'small_airport' ELSE 'heliport' END AS type,
               s_name AS name, floor(s_acctbal)::bigint::varchar AS elevation_ft,
               'R' || n_regionkey AS continent, n_nationkey::varchar AS iso_country,
               n_nationkey || '-' || s_suppkey AS iso_region, n_name AS municipality,
               'G' || s_suppkey AS gps_code, 'P' || s_suppkey AS iata_code, 'L' || s_suppkey AS local_code,
               s_suppkey || ', ' || n_nationkey AS coordinates
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "typed_from_local": _of_lists("SELECT * FROM raw_iso"),
    "scan_parquet": _of_all("SELECT * FROM admissions"),
    "write_overwrite": _of_lists("SELECT * FROM airports"),
    "write_partitioned_append": _of_all("SELECT * FROM time_dim"),
    "write_partitioned_replace": _of_all(f"""
        SELECT * REPLACE (CASE WHEN arrival_year = {CHANGED_YEAR} THEN airline ELSE 'OLD' END AS airline)
        FROM fact"""),
    "snapshot_overwrite": _of_lists("SELECT * FROM airports"),
    "snapshot_replace": _of_all(f"""
        SELECT * REPLACE (CASE WHEN arrival_year = {CHANGED_YEAR} THEN airline ELSE 'OLD' END AS airline)
        FROM fact"""),
    "write_clean_csv": _of_lists("SELECT * FROM ports"),
    "run_stamp": _of_lists(f"SELECT *, '{_RUN}' AS run FROM airports"),
    "partition_pruned_read": _of_all(
        f"SELECT * FROM fact WHERE arrival_year = {CHANGED_YEAR} AND arrival_month = 3"
    ),
    "time_pruned_read": _of_all(f"""
        SELECT fact.* FROM fact JOIN time_dim ON arrival_time = arrival_ts WHERE week = 10 AND year = {CHANGED_YEAR}"""),
    "clustered_read": _of_all("SELECT * FROM fact WHERE airport_id = 'P1'"),
    "project_admissions": _of_all("""
        SELECT admnum AS admission_nbr, i94res AS country_code, i94bir AS age,
               i94visa AS visa_code, visatype AS visa_type, gender AS person_gender FROM clean"""),
    "project_countries": _of_lists("SELECT * FROM country_dim"),
    "project_airports": _of_lists("""
        SELECT i94_port AS airport_id, i94_airport_name AS airport_name, i94_airport_state AS airport_state
        FROM ports"""),
    "project_time": _of_all(f"SELECT arrival_time AS arrival_ts, {_PARTS_SQL} FROM clean"),
    "project_fact": _of_all("SELECT * FROM fact"),
    "derive_column": _of_all("""
        SELECT cicid, arrdate, depdate, CASE WHEN depdate <> 0 THEN depdate - arrdate END AS days_stayed
        FROM clean"""),
    "bad_key_predicate": _of_seeded("SELECT o_orderkey, bad_key FROM seeded"),
    "null_equality_trap": _of_all("""
        SELECT count(*) FILTER (WHERE depdate = NULL) AS equal_to_null, count(*) FILTER (WHERE depdate IS NULL) AS is_null FROM crossings"""),
    "join_country_iso": _of_lists(f"SELECT countries.*, iso.* {_COUNTRY_ISO}"),
    "join_fact_country": _of_all("""
        SELECT cicid, i94cit, countries.* FROM clean JOIN countries ON i94cit = i94_cit::double"""),
    "join_fact_port": _of_all("SELECT cicid, i94port, ports.* FROM clean JOIN ports ON i94port = i94_port"),
    "join_fact_port_spread": _of_all("SELECT cicid, i94port, ports.* FROM clean JOIN ports ON i94port = i94_port"),
    "join_fact_port_filtered": _of_all("""
        SELECT cicid, i94port, ports.* FROM clean JOIN ports ON i94port = i94_port
        WHERE substr(i94_port, 2)::integer % 3 = 0"""),
    "join_fact_time": _of_all("""
        SELECT cicid, arrdate, arrival_time, t.* FROM clean JOIN time_dim t ON arrival_time = arrival_ts"""),
    "star_join": _of_all("""
        SELECT cicid, i94cit, i94port, arrdate, arrival_time, countries.*, ports.*, t.*
        FROM clean JOIN countries ON i94cit = i94_cit::double
        JOIN ports ON i94port = i94_port JOIN time_dim t ON arrival_time = arrival_ts"""),
    "distinct_admissions": _of_all("SELECT * FROM admissions"),
    "distinct_countries": _of_lists("SELECT * FROM country_dim"),
    "distinct_airports": _of_lists("SELECT * FROM airports"),
    "distinct_time": _of_all("SELECT * FROM time_dim"),
    "distinct_fact": _of_all("SELECT DISTINCT * EXCLUDE (immigration_id) FROM fact"),
    "count_rows": _of_all("SELECT table_name, row_count FROM checks"),
    "count_bad_keys": _of_seeded("SELECT count(*) FILTER (WHERE bad_key) AS bad_key_count FROM seeded"),
    "df_count": _of_all("SELECT count(*) AS count FROM crossings"),
    "nationalities_by_airport": _of_all(_NATIONALITIES),
    "nationalities_from_extract": _of_all(_NATIONALITIES),
    "nationality_bits": _of_all(_NATIONALITIES),
    "star_sql": _of_all("""
        SELECT airport_state, arrival_year, count(*) AS entries, count(DISTINCT country_code) AS nationalities
        FROM fact JOIN airports USING (airport_id) GROUP BY airport_state, arrival_year"""),
    "top_airports": _of_all("""
        SELECT airport_id, airport_name, airport_state, count(*) AS entries
        FROM fact JOIN airports USING (airport_id) GROUP BY airport_id, airport_name, airport_state
        ORDER BY entries DESC, airport_id LIMIT 10"""),
    "order_admissions": _of_all("SELECT * FROM admissions ORDER BY ALL"),
    "order_countries": _of_lists("SELECT * FROM country_dim ORDER BY country_name"),
    "order_airports": _of_lists("SELECT * FROM airports ORDER BY airport_name, airport_id"),
    "order_fact": _of_all("SELECT * FROM fact ORDER BY arrival_time, immigration_id"),
    "head_n": _of_all("SELECT * FROM fact ORDER BY arrival_time, immigration_id LIMIT 20"),
    "strip_quotes": _of_lists("SELECT * FROM bare_ports"),
    "trim_text": _of_lists("SELECT trim(code) AS code, trim(name) AS name FROM bare_ports"),
    "split_name_state": _of_lists("""
        SELECT raw.code, i94_airport_name AS place, i94_airport_state AS state
        FROM raw_ports raw JOIN ports ON trim(replace(raw.code, '''', '')) = i94_port"""),
    "clean_ports": _of_lists("SELECT * FROM ports"),
    "clean_countries": _of_lists("SELECT * FROM countries"),
    "fill_nulls": _of_all("SELECT * EXCLUDE (arrival_time) FROM clean"),
    "fill_iso_nulls": _of_lists("""
        SELECT name, alpha_2, alpha_3, country_code, iso_3166_2, coalesce(region, 'NA') AS region,
               coalesce(sub_region, 'NA') AS sub_region, coalesce(intermediate_region, 'NA') AS intermediate_region,
               coalesce(region_code, 'NA') AS region_code, coalesce(sub_region_code, 'NA') AS sub_region_code,
               coalesce(intermediate_region_code, 'NA') AS intermediate_region_code FROM iso"""),
    "sas_day_to_ts": _of_all("""
        SELECT cicid, timestamp '1960-01-01' + to_days(trunc(arrdate)::integer) AS arrival_time,
               timestamp '1960-01-01' + to_days(trunc(arrdate - i94bir * 400.3::double)::integer) AS shifted
        FROM crossings"""),
    "sas_departure_ts": _of_all("""
        SELECT cicid, timestamp '1960-01-01' + to_days(coalesce(trunc(depdate), 0)::integer) AS departure_date,
               timestamp '1960-01-01' + to_days(trunc(depdate)::integer) AS departure_or_null
        FROM crossings"""),
    **{
        name: _of_all(f"SELECT cicid, {_PARTS[part]} AS {name} FROM clean")
        for name, part in DATE_PARTS.items()
    },
    "surrogate_id": _of_all("SELECT immigration_id, arrival_time FROM fact"),
    "surrogate_id_of_run": _of_all("SELECT count(*) AS row_count, 1::bigint AS uses_of_an_id FROM fact"),
    "dense_numbers": _of_all(f"""
        SELECT immigration_id, row_number() OVER (ORDER BY arrival_year > {CHANGED_YEAR}, immigration_id) - 1 AS number
        FROM fact"""),
    "implicit_number_string_eq": _of_all("SELECT cicid, admnum = fltno::double AS same FROM crossings"),
    # The words for arrival modes and visa codes.
    "code_labels": _of_all("""
        SELECT cicid,
               CASE i94mode WHEN 1 THEN 'Air' WHEN 2 THEN 'Sea' WHEN 3 THEN 'Land' WHEN 4 THEN 'Not reported' END
                 AS arrival_mode,
               CASE i94visa WHEN 1 THEN 'Business' WHEN 2 THEN 'Business' WHEN 3 THEN 'Student' END AS visa
        FROM clean"""),
    "stage_tables": _of_all("""
        SELECT 'extract' AS table_name, count(*) AS row_count FROM crossings
        UNION ALL SELECT 'ports', count(*) FROM ports
        UNION ALL SELECT 'countries', count(*) FROM countries
        UNION ALL SELECT 'iso', count(*) FROM iso"""),
    "clean_admissions_extract": _of_all("SELECT * EXCLUDE (arrival_time) FROM clean"),
    "dim_admissions": _of_all("SELECT * FROM admissions"),
    "dim_countries": _of_lists("SELECT * FROM country_dim"),
    "dim_airports": _of_lists("SELECT * FROM airports"),
    "dim_time": _of_all("SELECT * FROM time_dim"),
    "fact_immigrations": _of_all("SELECT * FROM fact"),
    **{
        f"dq_{name}": _of_all(f"SELECT *, {_STATUS} FROM checks WHERE table_name = '{name}'")
        for name in ("admissions", "countries", "airports", "time", "immigrations")
    },
    "dq_verdict": _of_seeded(f"""
        SELECT *, {_STATUS}, 'NOK' AS status_if_empty,
               CASE WHEN bad_key_count > 0 THEN 'NOK' ELSE 'OK' END AS status_if_empty_compat
        FROM (SELECT o_orderpriority, count(*) AS row_count,
                     count(*) FILTER (WHERE bad_key AND o_orderpriority <> '5-LOW') AS bad_key_count
              FROM seeded GROUP BY o_orderpriority)"""),
    "dq_report": _of_all(f"SELECT '{_RUN}' AS round_ts, *, {_STATUS} FROM checks"),
    "checks_while_writing": _of_all(f"SELECT '{_RUN}' AS round_ts, *, {_STATUS} FROM checks"),
    "dq_record": _of_all(f"""
        SELECT '{_RUN}' AS round_ts, {", ".join(
            f"max(CASE WHEN table_name = '{name}' THEN row_count END) AS {name}_count, "
            f"max(CASE WHEN table_name = '{name}' THEN status END) AS {name}"
            for name in ("admissions", "countries", "airports", "time", "immigrations")
        )} FROM (SELECT *, {_STATUS} FROM checks)"""),
    "run_all_months": _of_all(f"""
        SELECT '{_RUN}' AS round_ts, *, {_STATUS} FROM (
            FROM checks
            UNION ALL {_list_check("ports", "i94_port")}
            UNION ALL {_list_check("countries", "i94_cit::double")}
            UNION ALL {_list_check("iso", "country_code::integer")}
        )"""),
    "dropped_rows": _of_all("""
        SELECT count(*) AS source_rows,
               count(*) FILTER (WHERE NOT undated AND i94_cit IS NOT NULL AND i94_port IS NOT NULL) AS kept_rows,
               count(*) FILTER (WHERE undated) AS no_arrival_day,
               count(*) FILTER (WHERE i94_cit IS NULL) AS unknown_country,
               count(*) FILTER (WHERE i94_port IS NULL) AS unknown_port
        FROM (SELECT *, i94mode = 2 AS undated FROM clean)
        LEFT JOIN countries ON i94cit = i94_cit::double
        LEFT JOIN ports ON i94port = i94_port AND i94mode <> 4"""),
    "orphan_fact_countries": _of_all("""
        SELECT country_code, count(*) AS fact_rows FROM fact
        WHERE country_code NOT IN (SELECT country_code FROM country_dim) GROUP BY country_code"""),
    "incremental_months": _of_all(f"""
        SELECT * REPLACE (CASE WHEN arrival_year = {CHANGED_YEAR} THEN timestamp '1960-01-01'
                               ELSE departure_date END AS departure_date) FROM fact"""),
    "kept_admissions": _of_all(f"""
        SELECT DISTINCT admnum AS admission_nbr, i94res AS country_code, i94bir AS age,
               i94visa AS visa_code, visatype AS visa_type, gender AS person_gender
        FROM clean WHERE i94yr <> {CHANGED_YEAR - 1}"""),
    "kept_time": _of_all(f"SELECT DISTINCT arrival_time AS arrival_ts, {_PARTS_SQL} FROM clean WHERE i94yr <> {CHANGED_YEAR - 1}"),
    "kept_nationalities": _of_all(_NATIONALITIES),
}
