"""What several operators share: column names, per-batch Python, row numbers."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sluicework.session import ship_package

# Code points that end a word in the contracts: space and the controls 9 to 13.
SPACE_CLASS = r"\x20\x09-\x0D"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Rows a Python worker handles at a time; bounds its memory, not its result.
SLICE_ROWS = 512
SLICE_BYTES = 16 << 20


def fresh(name: str, taken: list[str]) -> str:
    """A column name that no column of a frame has, whatever its case."""
    lowered = {t.lower() for t in taken}
    while name.lower() in lowered:
        name = f"{name}_{uuid.uuid4().hex[:6]}"
    return name


def quoted(name: str) -> Column:
    """A column by its literal name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def ascii_lower(column: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(column, UPPER, LOWER)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` mentions it."""
    return F.transform(F.array(value), use)[0]


def crc32_mod(column: Column, modulus: int) -> Column:
    """crc32 of a column's text, modulo a number; null for a null."""
    return F.crc32(column.cast("string").cast("binary")) % F.lit(modulus)


def small_batches(spark: SparkSession) -> None:
    """Let the session hand texts to Python in small batches: by default 10,000 rows go at once, however long.

    A number of rows that a user has set stays.
    """
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(SLICE_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(SLICE_BYTES))


def regrouped(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at least ``rows``, for work that gains from large ones on narrow rows."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= rows:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held = []
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def map_slices(
    df: DataFrame,
    schema: str | StructType,
    start: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]],
) -> DataFrame:
    """Apply a function to small slices of Arrow batches.

    ``start`` runs once per task and returns the function, so that tables a
    task needs are read there and not shipped from the driver.
    """
    ship_package(df.sparkSession)
    small_batches(df.sparkSession)
    names = (schema if isinstance(schema, StructType) else StructType.fromDDL(schema)).names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                # By place: names a function gives may clash with columns that pass through.
                yield pa.RecordBatch.from_arrays(work(batch.slice(at, SLICE_ROWS)).columns, names)

    return df.mapInArrow(run, schema)


def texts_of(batch: pa.RecordBatch, column: int | str) -> list[str]:
    """The texts of a slice, null as the empty text."""
    return [t or "" for t in batch.column(column).to_pylist()]
