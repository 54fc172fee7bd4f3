"""Row-for-row comparison of a Spark result with an SQL result, whatever the order."""

import os
from collections import Counter

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]
SF_DIR = "/root/testdata/sf0.001"


def kind(arrow_type) -> str:
    name = str(arrow_type)
    return {"large_string": "string", "string_view": "string"}.get(name, name.split("[")[0])


def content(table):
    names = sorted(table.column_names)
    rows = zip(*[table.column(name).to_pylist() for name in names], strict=True)
    return [(name, kind(table.schema.field(name).type)) for name in names], Counter(rows)


def from_duckdb(sql: str, sf_dir: str = SF_DIR):
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        files = f"{path}/*.parquet" if os.path.isdir(path) else path
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{files}'")
    return con.sql(sql).to_arrow_table()


def assert_same(spark_df, sql: str, sf_dir: str = SF_DIR):
    got_schema, got = content(spark_df.toArrow())
    want_schema, want = content(from_duckdb(sql, sf_dir))
    assert got_schema == want_schema
    assert sum(got.values()) == sum(want.values())
    extra, missing = got - want, want - got
    assert not extra and not missing, (list(extra)[:3], list(missing)[:3])
