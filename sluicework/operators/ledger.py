"""Ledger of arriving files: record, list, mark; and ingest of new files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluicework.operators.codec import encode
from sluicework.operators.columns import rename_columns
from sluicework.operators.skew import lookup_join
from sluicework.session import path_exists

LEDGER_SCHEMA = "guid STRING, extract_date DATE, file_name STRING, received_at TIMESTAMP, pushed_at TIMESTAMP"
SUFFIXES = (".csv", ".csv.done")
# Tasks of a batch for each core, at most: what tasks tell the driver must not grow with the number of splits.
TASKS_PER_CORE = 8


def accepted(files: DataFrame, prefixes: Sequence[str], column: str = "file_name") -> DataFrame:
    """Names with one of the prefixes that end in ``.csv`` or ``.csv.done``."""
    name = F.col(column)
    starts = F.lit(False)
    for prefix in prefixes:
        starts = starts | name.startswith(prefix)
    ends = name.endswith(SUFFIXES[0]) | name.endswith(SUFFIXES[1])
    return files.filter(starts & ends)


def new_files(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files the ledger does not know; the file name is the unique key."""
    return files.dropDuplicates(["file_name"]).join(ledger.select("file_name"), "file_name", "left_anti")


def ledger_entries(files: DataFrame) -> DataFrame:
    """New ledger rows; the guid follows from the name, so a replay repeats it."""
    date_part = F.regexp_extract("file_name", r"(\d{4}-\d{2}-\d{2})", 1)
    return files.select(
        F.md5("file_name").alias("guid"),
        date_part.try_cast("date").alias("extract_date"),
        "file_name",
        F.current_timestamp().alias("received_at"),
        F.lit(None).cast("timestamp").alias("pushed_at"),
    )


def unpushed(ledger: DataFrame) -> DataFrame:
    return ledger.filter(F.col("pushed_at").isNull())


def mark_pushed(ledger: DataFrame, pushed: DataFrame) -> DataFrame:
    """Ledger with ``pushed_at`` set for the files in ``pushed`` (first push stays)."""
    times = pushed.groupBy("file_name").agg(F.min("pushed_at").alias("_pushed"))
    joined = ledger.join(times, "file_name", "left")
    return joined.withColumn("pushed_at", F.coalesce("pushed_at", "_pushed")).select(*ledger.columns)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    if not path_exists(spark, path):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).parquet(path)


def numbered_lines(rows: DataFrame, file: str = "file_name", split: str = "_row_start", nth: str = "_nth",
                   column: str = "line_number") -> DataFrame:
    """Rows with their number in their file, from 0, however many splits a file was read in.

    ``nth`` grows along each split (``monotonically_increasing_id`` at the scan).  Rows are counted per split; the
    counts, a row per split, are summed up along each file.  No file is sorted or gathered.
    """
    splits = rows.groupBy(file, split).agg(F.count(F.lit(1)).alias("_rows"), F.min(nth).alias("_first"))
    before = Window.partitionBy(file).orderBy(split).rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0))).drop("_rows")
    joined = lookup_join(rows, starts, [file, split])
    return joined.withColumn(column, F.col("_before") + F.col(nth) - F.col("_first")).select(*rows.columns, column)


def first_rows(rows: DataFrame, file: str = "file_name", split: str = "_row_start", nth: str = "_nth") -> DataFrame:
    """First data row of every file: the first row of its first split that has any."""
    first = rows.groupBy(file).agg(F.min(F.struct(split, nth)).alias("_at")).select(file, "_at.*")
    return lookup_join(rows, first, [file, split, nth]).select(*rows.columns)


def file_messages(rows: DataFrame, header_map: Mapping[str, str]) -> DataFrame:
    """Renamed rows as JSON messages."""
    return encode(rename_columns(rows, header_map), "json")


def ingest_batch(batch: DataFrame, header_map: Mapping[str, str], prefixes: Sequence[str], ledger_path: str,
                 message_path: str, batch_key: str, first_row_only: bool = False) -> None:
    """One micro-batch of arriving files -> messages and ledger rows.

    Both outputs are keyed by the batch, so a replayed batch overwrites its own
    files.  ``batch`` has the columns of ``with_file_columns`` and its rows as they were scanned.  The ledger goes
    last: files count as known once their messages are written.
    """
    spark = batch.sparkSession
    # Files may be cut into any number of splits; rows are numbered by split, then a task takes many small ones.
    batch = batch.withColumn("_nth", F.monotonically_increasing_id()).coalesce(
        TASKS_PER_CORE * spark.sparkContext.defaultParallelism).persist()
    try:
        names = accepted(batch.select("file_name"), prefixes).distinct()
        if path_exists(spark, ledger_path):
            # Rows this batch wrote before a replay do not make its files known.
            others = F.col("batch_id").cast("string") != batch_key
            known = spark.read.schema(f"{LEDGER_SCHEMA}, batch_id STRING").parquet(ledger_path).filter(others)
            names = new_files(names, known)
        fresh = lookup_join(batch, names, ["file_name"])
        if first_row_only:
            fresh = first_rows(fresh)
        data = fresh.drop("file_name", "_row_start", "_nth")
        file_messages(data, header_map).write.mode("overwrite").parquet(f"{message_path}/batch_id={batch_key}")
        ledger_entries(names).write.mode("overwrite").parquet(f"{ledger_path}/batch_id={batch_key}")
    finally:
        batch.unpersist()
