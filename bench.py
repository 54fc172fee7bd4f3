"""Wall time of the headline queries; prints one JSON line.

Each query is run to the end into a sink that keeps nothing, and its best time of
the runs counts.  ``run_all_months`` starts from monthly extracts written before
the clock starts.  ``twins`` compares forms that give the same rows: native date
decoding against a Python function, one-pass checks against separate counts.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from datetime import datetime, timedelta

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from landfall.catalog import bindings as b  # noqa: E402
from landfall.catalog.queries import QUERIES, STAR, staged  # noqa: E402
from landfall.functions.dates import day_to_ts  # noqa: E402
from landfall.operators.quality import bad_key_predicate  # noqa: E402
from landfall.plans.months import run_all_months  # noqa: E402
from landfall.schemas import KEYS  # noqa: E402
from landfall.session import build_session, workspace  # noqa: E402

HEADLINE = [
    "nationalities_from_extract",
    "nationalities_by_airport",
    "top_airports",
    "fact_immigrations",
    "dim_admissions",
    "dim_countries",
    "dim_airports",
    "dim_time",
    "join_fact_port_spread",
    "order_fact",
    "write_partitioned_replace",
    "dq_report",
    "dropped_rows",
]
RUNS = 2


def timed(action) -> float:
    started = time.perf_counter()
    action()
    return time.perf_counter() - started


def shuffled_bytes(spark) -> int:
    """Shuffle bytes written so far, from the status the session keeps of its executors."""
    executors = spark.sparkContext._jsc.sc().statusStore().executorList(False)
    return sum(executors.apply(i).totalShuffleWrite() for i in range(executors.size()))


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


@F.udf(T.TimestampNTZType())
def day_to_ts_in_python(number):
    return None if number is None else datetime(1960, 1, 1) + timedelta(days=int(number))


def twins(spark, sf_dir):
    days = b.crossings(spark, sf_dir, "arrdate")

    def separate_counts():
        for name, keys in KEYS.items():
            table = STAR[name](spark, sf_dir)
            table.count()
            table.where(bad_key_predicate(table, keys)).count()

    return {
        "days_native": lambda: drain(days.select(day_to_ts(F.col("arrdate")).alias("t"))),
        "days_python": lambda: drain(days.select(day_to_ts_in_python("arrdate").alias("t"))),
        "checks_one_pass": lambda: QUERIES["dq_report"](spark, sf_dir).collect(),
        "checks_separate": separate_counts,
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "landfall-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    drain(QUERIES["nationalities_from_extract"](spark, sf_dir))

    shuffled = {}

    def best(name, action) -> float:
        before = shuffled_bytes(spark)
        seconds = round(min(timed(action) for _ in range(RUNS)), 3)
        shuffled[name] = (shuffled_bytes(spark) - before) // RUNS
        return seconds

    queries = {name: best(name, lambda query=QUERIES[name]: drain(query(spark, sf_dir))) for name in HEADLINE}
    months_in = staged(spark, sf_dir)
    queries["run_all_months"] = best(
        "run_all_months", lambda: run_all_months(spark, months_in, workspace(spark), "bench", grouped_by_month=True).collect()
    )
    compared = {name: best(name, action) for name, action in twins(spark, sf_dir).items()}
    scale = re.search(r"sf([\d.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(queries.values()), 3),
        "unit": "sec",
        "queries": queries,
        "twins": compared,
        "shuffled_bytes": shuffled,
        "sf": float(scale.group(1)) if scale else sf_dir,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
