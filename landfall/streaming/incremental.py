"""Only months whose extracts changed are built again; dimensions follow by what that adds to them and takes away.

Each batch is one snapshot: readers see all of it or nothing.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from landfall.functions.dates import whole_day
from landfall.operators.clean import fill_nulls
from landfall.operators.projections import project, project_time, with_arrival_time
from landfall.plans.answers import nationalities_from_bits, nationality_bits
from landfall.plans.fact import fact_immigrations
from landfall.schemas import ADMISSIONS, EXTRACT
from landfall.session import workspace
from landfall.sinks.snapshots import Layout, Update, forget, read_snapshot
from landfall.sinks.writers import remove_folder, write_overwrite, write_partitioned
from landfall.sources.extracts import scan_admissions
from landfall.sources.files import month_number, order_months, with_file_month, year_number

# Fixed value: what Spark's binary file source yields; only the first and third column are used.
FILE_LISTING = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"
# A month of input is a folder of output; below it the fact has its arrival year and month.
MONTH = ["extract_year", "extract_month"]
ARRIVAL = ["arrival_year", "arrival_month"]
TABLES = ["immigrations", "time", "admissions"]
# What a dimension has of each month, and the dimension itself, by a hash of the row; ``months`` counts those a row is in.
DIMENSIONS = {"time": "arrival_ts", "admissions": "country_code"}
BUCKETS = 64
FACT = Layout(tuple(MONTH), tuple(ARRIVAL), ("arrival_time",))
OF_MONTH = Layout(tuple(MONTH))
BITS = "nationalities"


def remember(arrived: DataFrame, base: str) -> DataFrame:
    """Notes the files just arrived; returns all files known of their months.

    The notes are kept in folders of months, so the history of other months is not looked at.
    A batch that is repeated notes its files again, which changes nothing.
    """
    spark, notes = arrived.sparkSession, f"{base}/files"
    marked = with_file_month(arrived).select("path", "length", *MONTH)
    months = marked.select(MONTH).distinct().collect()
    write_partitioned(marked, notes, MONTH, append=True)
    if not months:
        return arrived.limit(0)
    of_batch = [(m["extract_year"], m["extract_month"]) for m in months]
    wanted = F.struct(*MONTH).isin([F.struct(F.lit(y).alias(MONTH[0]), F.lit(m).alias(MONTH[1])) for y, m in of_batch])
    return spark.read.parquet(notes).where(wanted).select("path", "length")


def month_parts(months: Iterable[tuple[int, int]]) -> list[str]:
    return [OF_MONTH.part(*month) for month in months]


def bucket_of(columns: Iterable[str]):
    return F.pmod(F.xxhash64(*columns), F.lit(BUCKETS)).cast("int")


def changes(now: DataFrame | None, before: DataFrame | None) -> DataFrame:
    """Rows whose number of months changes, with the ``months`` to add; each frame has a row once a month.

    Only the months that are replaced are compared.
    """
    signed = [df.drop(*MONTH).withColumn("months", F.lit(sign).cast("bigint")) for df, sign in ((now, 1), (before, -1)) if df is not None]
    rows = signed[0] if len(signed) == 1 else signed[0].unionByName(signed[1])
    columns = [c for c in rows.columns if c != "months"]
    return rows.groupBy(*columns).agg(F.sum("months").alias("months")).where("months <> 0")


def follow(update: Update, table: str, now: DataFrame | None, parts: list[str]) -> None:
    """Brings a dimension up to date with what the parts of its months have now, in those of its buckets that change."""
    spark = update.spark
    before = update.read_former(f"{table}_by_month", parts)
    if now is None and before is None:
        return
    # Written once: which buckets are touched is asked before their rows are.
    path = workspace(spark)
    change = changes(now, before)
    columns = [c for c in change.columns if c != "months"]
    write_overwrite(change.withColumn("bucket", bucket_of(columns)), path)
    change = spark.read.parquet(path)
    layout = Layout(("bucket",), order=(DIMENSIONS[table],))
    touched = [layout.part(r["bucket"]) for r in change.select("bucket").distinct().collect()]
    if not touched:
        return
    kept = update.read_former(table, touched)
    rows = change if kept is None else kept.unionByName(change)
    rows = rows.groupBy(*columns, "bucket").agg(F.sum("months").alias("months")).where("months > 0")
    update.write(table, rows, layout, touched)


def with_extract_month(extract: DataFrame) -> DataFrame:
    """Adds the year and month in the name of the file each row came from.

    Names are taken apart once a file, not once a row: the files are a short list that meets the rows.
    """
    rows = extract.withColumn("_file", F.col("_metadata.file_path"))
    file = F.col("_file")
    files = rows.select("_file").distinct().select("_file", year_number(file).alias(MONTH[0]), month_number(file).alias(MONTH[1]))
    return rows.join(F.broadcast(files), "_file").drop("_file")


def rebuild_months(
    spark: SparkSession,
    months: DataFrame,
    base: str,
    countries: DataFrame,
    ports: DataFrame,
    schema: StructType = EXTRACT,
    pattern: str | None = None,
) -> None:
    """Replaces the given months in all tables, as one snapshot.

    New rows are written beside the old ones, which stay readable until the whole batch is there and
    for good if it fails.  A month or a day that the new extract lacks leaves nothing behind.
    """
    wanted = months.collect()
    if not wanted:
        return
    extract = scan_admissions(spark, [p for m in wanted for p in m["paths"]], schema, pattern=pattern)
    dated = fill_nulls(with_extract_month(extract))
    parts = month_parts((m["extract_year"], m["extract_month"]) for m in wanted)
    kept = {name: name for name in MONTH}
    days = dated.select(whole_day(F.col("arrdate")).alias("arrdate"), *MONTH).distinct()
    of_month = {
        "time": project_time(with_arrival_time(days), MONTH),
        "admissions": project(dated, ADMISSIONS | kept).distinct(),
    }
    update = Update(spark, base)
    fact = update.write("immigrations", fact_immigrations(dated, countries, ports, carry=MONTH), FACT, parts)
    update.write(BITS, nationality_bits(fact, *MONTH), OF_MONTH, parts)
    for table, rows in of_month.items():
        follow(update, table, update.write(f"{table}_by_month", rows, OF_MONTH, parts), parts)
    update.publish()


def remove_months(spark: SparkSession, base: str, months: Iterable[tuple[int, int]]) -> None:
    """Takes months of extracts out of all tables, as one snapshot, and forgets their files."""
    months = list(months)
    parts, update = month_parts(months), Update(spark, base)
    for table in DIMENSIONS:
        follow(update, table, None, parts)
    for table in ("immigrations", BITS, *(f"{table}_by_month" for table in DIMENSIONS)):
        update.drop(table, parts)
    update.publish()
    for part in parts:
        remove_folder(spark, f"{base}/files/{part}")


def incremental_months(
    spark: SparkSession,
    root: str,
    base: str,
    checkpoint: str,
    countries: DataFrame,
    ports: DataFrame,
    pattern: str = "*.parquet",
    schema: StructType = EXTRACT,
    keep: int | None = None,
) -> StreamingQuery:
    """Handles every file not seen before, then stops.  With ``keep`` only so many snapshots stay on disk.

    The stream carries file names only.  Each month named is built from its whole
    current extract, so a batch that is repeated, or a month that comes in several
    batches, leaves the same table.
    """
    arrivals = (
        spark.readStream.format("binaryFile")
        .schema(FILE_LISTING)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(root)
        .select("path", "length")
    )

    def on_arrival(arrived: DataFrame, _batch: int) -> None:
        months = order_months(remember(arrived, base))
        rebuild_months(arrived.sparkSession, months, base, countries, ports, schema, pattern)
        if keep:
            forget(arrived.sparkSession, base, keep)

    return (
        arrivals.writeStream.foreachBatch(on_arrival)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_incremental(spark: SparkSession, base: str, table: str = "immigrations") -> DataFrame:
    """A table over all extracts, without the extract's own year and month; dimension rows that months share are there once."""
    rows = read_snapshot(spark, base, table)
    if rows is None:
        raise FileNotFoundError(f"no rows of {table} below {base}")
    return rows.drop(*MONTH, "bucket", "months")


def read_nationalities(spark: SparkSession, base: str, airports: DataFrame) -> DataFrame:
    """How many nationalities and people came through each airport, from the bitmaps of months; no arrival is read."""
    bits = read_snapshot(spark, base, BITS)
    if bits is None:
        raise FileNotFoundError(f"no arrivals below {base}")
    return nationalities_from_bits(bits, airports)
