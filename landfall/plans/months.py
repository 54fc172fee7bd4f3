"""All months in one run: stage, build, write, check."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.functions.keys import as_integer, as_number
from landfall.operators.quality import Measured, dq_report
from landfall.plans.dimensions import dim_admissions, dim_airports, dim_countries, dim_time
from landfall.plans.fact import fact_immigrations
from landfall.plans.staging import Staged, clean_admissions_extract
from landfall.sinks.writers import run_path, write_overwrite, write_partitioned
from landfall.sources.tables import scan_parquet

REPORT = "report"
TABLES = ["admissions", "countries", "airports", "time", "immigrations"]
# The code lists, with the column each is looked up by and how it is compared.
LIST_KEYS = {"ports": ("i94_port", None), "countries": ("i94_cit", as_number), "iso": ("country_code", as_integer)}


def build_star(staged: Staged, null_departure: bool = False) -> dict[str, DataFrame]:
    """The five tables, as plans; nothing is read or written yet."""
    clean = clean_admissions_extract(staged)
    return {
        "admissions": dim_admissions(clean),
        "countries": dim_countries(staged.countries, staged.iso),
        "airports": dim_airports(staged.ports),
        "time": dim_time(clean),
        "immigrations": fact_immigrations(clean, staged.countries, staged.ports, null_departure),
    }


def write_star(star: Mapping[str, DataFrame], base: str, grouped_by_month: bool = False) -> Measured:
    """Dimensions whole, time and fact in folders of year and month; returns what was counted on the way.

    A caller who knows that the fact's tasks each have rows of few months, as when monthly
    extracts meet broadcast lists, may spare it the shuffle with ``grouped_by_month``.
    """
    seen = Measured()
    admissions = star["admissions"].sortWithinPartitions("country_code")
    for name, table in (("admissions", admissions), ("countries", star["countries"]), ("airports", star["airports"])):
        write_overwrite(table, f"{base}/{name}", seen.of(name))
    write_partitioned(star["time"], f"{base}/time", ["year", "month"], ["arrival_ts"], observe=seen.of("time"))
    write_partitioned(
        star["immigrations"],
        f"{base}/immigrations",
        ["arrival_year", "arrival_month"],
        ["arrival_time"],
        rebalance=not grouped_by_month,
        observe=seen.of("immigrations"),
    )
    return seen


def list_checks(staged: Staged, round_ts: str) -> DataFrame:
    """Verdicts on the code lists: a code listed twice multiplies what it meets, though no key of it is bad."""
    lists = {
        f"{name}_list": (getattr(staged, name), compared(F.col(key)) if compared else key)
        for name, (key, compared) in LIST_KEYS.items()
    }
    return dq_report({}, round_ts, lists=lists)


def read_run(spark: SparkSession, base: str, stamp: str) -> dict[str, DataFrame]:
    """The tables of one run."""
    return {name: scan_parquet(spark, run_path(base, name, stamp)) for name in TABLES}


def complete_runs(spark: SparkSession, base: str) -> list[str]:
    """Stamps of the runs whose report was written, which is done last; oldest first.

    Only names of report files are listed, a few for each run.
    """
    reports = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .load(run_path(base, REPORT, "*"))
    )
    stamp = F.regexp_extract("path", f"/run=([^/]+)/{REPORT}/", 1)
    return sorted(r["stamp"] for r in reports.select(stamp.alias("stamp")).distinct().collect())


def read_report(spark: SparkSession, base: str, stamp: str) -> DataFrame:
    """The verdicts of one run, on its tables and on the lists it used."""
    return scan_parquet(spark, run_path(base, REPORT, stamp))


def sound_runs(spark: SparkSession, base: str) -> list[str]:
    """Stamps of the complete runs that failed no check, oldest first; the reports are a few rows each."""
    complete = complete_runs(spark, base)
    if not complete:
        return []
    reports = scan_parquet(spark, run_path(base, REPORT, "*"))
    failed = {r["round_ts"] for r in reports.where("status <> 'OK'").select("round_ts").distinct().collect()}
    return [stamp for stamp in complete if stamp not in failed]


def read_star(spark: SparkSession, base: str, sound: bool = False) -> dict[str, DataFrame]:
    """The tables of the newest complete run; with ``sound``, of the newest that failed no check."""
    stamps = sound_runs(spark, base) if sound else complete_runs(spark, base)
    if not stamps:
        raise FileNotFoundError(f"no {'sound' if sound else 'complete'} run below {base}")
    return read_run(spark, base, stamps[-1])


def run_all_months(
    spark: SparkSession, staged: Staged, base: str, round_ts: str, grouped_by_month: bool = False
) -> DataFrame:
    """Builds and writes the star from every month at once; returns the report on it and on the code lists.

    Each run has a folder of its own, named by ``round_ts``: readers of earlier runs are not
    disturbed, a run that fails is never read, and nothing of an older one remains.  Tables are
    checked while they are written; none is read again.
    """
    seen = write_star(build_star(staged), run_path(base, "", round_ts).rstrip("/"), grouped_by_month)
    report = seen.report(spark, round_ts).unionByName(list_checks(staged, round_ts))
    write_overwrite(report.coalesce(1), run_path(base, REPORT, round_ts))
    return read_report(spark, base, round_ts)
