"""Time-range extraction: predicates, bucket planning and bucketed reads."""

from __future__ import annotations

from bisect import bisect_right
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluicework.operators.skew import balanced, lookup_join
from sluicework.session import path_exists, through_storage


def range_predicate(
    df: DataFrame,
    column: str,
    start: datetime | str | None = None,
    end: datetime | str | None = None,
    condition: str | None = None,
) -> Column:
    """Half-open ``[start, end)``, each side optional, plus an ANDed condition.

    Bounds take the column's own type, so the comparison has no cast on the
    column and reaches the scan as a pushed filter.
    """
    kind = df.schema[column].dataType
    result = F.lit(True)
    if start is not None:
        result = result & (F.col(column) >= F.lit(start).cast(kind))
    if end is not None:
        result = result & (F.col(column) < F.lit(end).cast(kind))
    if condition:
        result = result & F.expr(condition)
    return result


def range_query(
    columns: str, table: str, column: str, start: str | None = None, end: str | None = None,
    condition: str | None = None, probe: bool = False,
) -> str:
    """The same predicate as SQL text, for sources that take a query."""
    parts = []
    if start is not None:
        parts.append(f"{column} >= '{start}'")
    if end is not None:
        parts.append(f"{column} < '{end}'")
    if condition:
        parts.append(f"({condition})")
    where = f" WHERE {' AND '.join(parts)}" if parts else ""
    return f"SELECT {columns} FROM {table}{where}" + (" LIMIT 1" if probe else "")


def second_of(df: DataFrame, column: str) -> Column:
    """The column cut to whole seconds, in its own type."""
    return F.date_trunc("second", F.col(column)).cast(df.schema[column].dataType)


def rows_per_second(df: DataFrame, column: str) -> DataFrame:
    return (
        df.select(second_of(df, column).alias("second_ts"))
        .filter(F.col("second_ts").isNotNull())
        .groupBy("second_ts")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


def bucket_plan(df: DataFrame, column: str, buffer_size: int) -> DataFrame:
    """``second_ts, row_count, running_count, bucket`` for every second with rows.

    The running count goes over days first and then inside each day.  A day has
    at most 86,400 seconds and the day table is bounded by the calendar, so no
    task ever sees the whole series.
    """
    seconds = (
        rows_per_second(df, column)
        .withColumn("day", F.to_date("second_ts"))
        .repartition("day")
    )
    before = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    days = (
        seconds.groupBy("day")
        .agg(F.sum("row_count").alias("day_count"))
        .select("day", F.coalesce(F.sum("day_count").over(before), F.lit(0)).alias("rows_before"))
    )
    in_day = Window.partitionBy("day").orderBy("second_ts").rowsBetween(Window.unboundedPreceding, 0)
    running = (F.sum("row_count").over(in_day) + F.col("rows_before")).alias("running_count")
    # A left join infers no filter, so both uses of ``seconds`` stay one plan and
    # Spark reuses its shuffle instead of scanning again.
    return (
        seconds.join(days, "day", "left")
        .select("second_ts", "row_count", running)
        .withColumn("bucket", F.expr(f"running_count div {int(buffer_size)}"))
    )


def bucket_ranges(plan: DataFrame, end: datetime | None = None) -> DataFrame:
    """``bucket, start_ts, end_ts`` tiling the series: each range ends where the
    next begins, the last at ``end`` (null = open).

    A series that fits one bucket and spans several seconds is cut at its last
    second.  The next start is looked up inside the day first, then on the day
    table, for the same reason as in :func:`bucket_plan`.
    """
    bounds = (
        plan.groupBy("bucket")
        .agg(F.min("second_ts").alias("start_ts"), F.max("second_ts").alias("last_ts"))
        .withColumn("day", F.to_date("start_ts"))
        .repartition("day")
    )
    by_day = Window.orderBy("day")
    days = (
        bounds.groupBy("day")
        .agg(F.min("start_ts").alias("first_start"))
        .select(
            "day",
            F.lead("first_start").over(by_day).alias("later_start"),
            F.lag("first_start").over(by_day).alias("earlier_start"),
        )
    )
    in_day = Window.partitionBy("day").orderBy("start_ts")
    following = F.coalesce(F.lead("start_ts").over(in_day), F.col("later_start"))
    preceding = F.coalesce(F.lag("start_ts").over(in_day), F.col("earlier_start"))
    limit = F.lit(end) if end is not None else F.lit(None)
    marked = bounds.join(days, "day", "left").select(
        "bucket", "start_ts", "last_ts",
        following.alias("next_start"),
        (following.isNull() & preceding.isNull() & (F.col("last_ts") > F.col("start_ts"))).alias("alone"),
    )
    stop = F.coalesce(F.col("next_start"), limit.cast(plan.schema["second_ts"].dataType))
    pieces = F.when(
        F.col("alone"),
        F.array(
            F.struct(F.col("start_ts"), F.col("last_ts").alias("end_ts")),
            F.struct(F.col("last_ts").alias("start_ts"), stop.alias("end_ts")),
        ),
    ).otherwise(F.array(F.struct(F.col("start_ts"), stop.alias("end_ts"))))
    return marked.select("bucket", F.explode(pieces).alias("piece")).select("bucket", "piece.*")


def bucket_marks(plan: DataFrame) -> DataFrame:
    """``hour_ts, marks``: where buckets begin inside each hour with rows.

    An hour has at most 3,600 marks, and usually one; the table is as long as
    the calendar has hours, whatever the number of rows.
    """
    starts = plan.groupBy(F.date_trunc("hour", "second_ts").alias("hour_ts"), "bucket").agg(
        F.min("second_ts").alias("start_ts"))
    return starts.groupBy("hour_ts").agg(F.sort_array(F.collect_list(F.struct("start_ts", "bucket"))).alias("marks"))


def with_bucket(df: DataFrame, marks: DataFrame, column: str) -> DataFrame:
    """Every row with its bucket: join on the hour, then the last mark not after it.

    Rows without a time have no bucket and stay.
    """
    keyed = df.withColumn("hour_ts", F.date_trunc("hour", F.col(column)))
    second = second_of(df, column)
    bucket = F.aggregate(
        "marks", F.lit(None).cast("bigint"),
        lambda found, mark: F.when(mark["start_ts"] <= second, mark["bucket"]).otherwise(found))
    joined = lookup_join(keyed, marks, ["hour_ts"], "left")
    return joined.withColumn("bucket", bucket).drop("hour_ts", "marks")


def bucketed_extract(df: DataFrame, column: str, buffer_size: int, stage_path: str) -> DataFrame:
    """Stage rows by bucket and return the staged copy.

    The plan is computed first, from the time column alone, and kept: its few
    rows are then of known size when the rows themselves are read.  One folder
    per bucket; rerunning a bucket overwrites just that folder.
    """
    marks = through_storage(bucket_marks(bucket_plan(df, column, buffer_size)), "bucket-marks")
    rows = balanced(with_bucket(df, marks, column), "bucket")
    # A first run has nothing to keep, and a static write commits with fewer moves.
    mode = "dynamic" if path_exists(df.sparkSession, stage_path) else "static"
    rows.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy("bucket").parquet(stage_path)
    return df.sparkSession.read.schema(rows.schema).parquet(stage_path)


# The sketch tells ranks to about 1/10,000 of the rows, so more ranges than this would not be even.
SKETCH_K = 16384
MAX_RANGES = 4096
MERGED_AT_ONCE = 64


def micros_of(df: DataFrame, column: str) -> Column:
    """A time as microseconds since 1970, by its own clock."""
    kind = df.schema[column].dataType.simpleString()
    if kind == "timestamp":
        return F.unix_micros(F.col(column))
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', CAST(`{column}` AS TIMESTAMP_NTZ))")


def time_cuts(df: DataFrame, column: str, buffer_size: int, max_ranges: int = MAX_RANGES) -> list[int]:
    """Times, in microseconds, that cut the rows into even ranges of about ``buffer_size`` rows, or ``max_ranges`` ranges.

    Every partition is summed up in a quantile sketch of bounded size; sketches are merged 64 at a time and then all, so
    no task sees more than sketches.  A time that many rows share is a cut several times over.
    """
    part = F.spark_partition_id()
    small = df.select(micros_of(df, column).alias("at"), part.alias("part")).where("at IS NOT NULL").groupBy("part").agg(
        F.kll_sketch_agg_bigint("at", F.lit(SKETCH_K)).alias("sketch"))
    few = small.groupBy(F.expr(f"part div {MERGED_AT_ONCE}").alias("part")).agg(F.kll_merge_agg_bigint("sketch").alias("sketch"))
    # One sketch of bounded size comes to the driver, which asks it for as many cuts as the rows need.
    rows, sketch = few.agg(F.kll_merge_agg_bigint("sketch").alias("sketch")).select(
        F.kll_sketch_get_n_bigint("sketch"), "sketch").first()
    ranges = min(-(-(rows or 0) // buffer_size), max_ranges)
    if ranges < 2:
        return []
    shares = F.array(*[F.lit(i / ranges) for i in range(1, ranges)])
    told = df.sparkSession.range(1).select(F.kll_sketch_get_quantile_bigint(F.lit(bytes(sketch)), shares))
    return sorted(told.first()[0])


def range_of(at: Column, cuts: list[int]) -> Column:
    """The range a time falls into: the number of cuts not after it; rows at a repeated cut are dealt over its ranges.

    The different cuts are searched once by halving, in about log2(n) looks.
    """
    different = sorted(set(cuts))
    listed, counts = (F.array(*[F.lit(n) for n in numbers]).cast("array<bigint>") for numbers in (
        different, [0, *(bisect_right(cuts, cut) for cut in different)]))
    halves = F.array(*[F.lit(1 << bit) for bit in reversed(range(len(different).bit_length()))]).cast("array<int>")

    def look(found: Column, step: Column) -> Column:
        # Past the end there is no cut, and null is not below anything.
        return found + F.when(F.get(listed, found + step - 1) <= at, step).otherwise(0)

    def told(found: Column) -> Column:
        last = F.get(counts, found)
        if len(different) == len(cuts):
            return last
        first = F.get(counts, found - 1)
        dealt = first + 1 + F.pmod(F.monotonically_increasing_id(), last - first)
        return F.when((F.get(listed, found - 1) == at) & (last - first > 1), dealt).otherwise(last)

    return F.aggregate(halves, F.lit(0), look, told)


def range_partitioned_extract(df: DataFrame, column: str, buffer_size: int, stage_path: str) -> DataFrame:
    """Stage rows by time range and return the staged copy with its ``bucket``.

    One pass for the cuts, one shuffle by range, no join.  Buckets hold at most ``buffer_size`` rows, their numbers grow
    with time, and rows of one instant may lie in several.  The bucket is a column inside the files, whose number is that
    of the shuffle partitions whatever the number of buckets.  Rows without a time have no bucket and stay.
    """
    cuts = time_cuts(df, column, buffer_size)
    # Rows without a time get ranges of their own below zero, only to be spread.
    place = F.when(F.col(column).isNull(), -1 - F.pmod(F.monotonically_increasing_id(), F.lit(64))).otherwise(
        range_of(micros_of(df, column), cuts))
    nth = F.row_number().over(Window.partitionBy("_range").orderBy(column)) - 1
    bucket = F.when(F.col("_range") >= 0, F.shiftleft(F.col("_range").cast("bigint"), 32) + F.expr(f"_nth div {int(buffer_size)}"))
    rows = df.withColumn("_range", place).withColumn("_nth", nth).withColumn("bucket", bucket).drop("_range", "_nth")
    rows.write.mode("overwrite").parquet(stage_path)
    return df.sparkSession.read.schema(rows.schema).parquet(stage_path)


def moment_text(moment: datetime) -> str:
    return f"TIMESTAMP('{moment:%Y-%m-%d %H:%M:%S.%f}')" if moment.microsecond else f"TIMESTAMP('{moment:%Y-%m-%d %H:%M:%S}')"


def range_predicates(
    ranges: DataFrame, column: str, start: datetime | None = None, end: datetime | None = None,
    condition: str | None = None,
) -> list[str]:
    """One SQL predicate per bucket range, for ``read.jdbc(predicates=...)``.

    Together they ask for what :func:`range_predicate` lets through: the first
    range begins at ``start`` itself, not at its second, every one carries the
    condition, and without bounds the rows without a time have a range of their
    own.  Each predicate is a task of the read, and the caller chooses their
    number with ``buffer_size``.
    """
    result = []
    for row in ranges.orderBy("start_ts").toLocalIterator():
        parts = [f"{column} >= {moment_text(row['start_ts'] if result or start is None else start)}"]
        stop = row["end_ts"] if row["end_ts"] is not None else end
        if stop is not None:
            parts.append(f"{column} < {moment_text(stop)}")
        result.append(" AND ".join(parts))
    if start is None and end is None:
        result.append(f"{column} IS NULL")
    return [f"{text} AND ({condition})" if condition else text for text in result]


def extract(
    df: DataFrame, column: str, buffer_size: int, stage_path: str, bulk: bool = False,
) -> DataFrame:
    """Bucketed when the rows outnumber the buffer or ``bulk`` is set, else direct."""
    if bulk or df.count() > buffer_size:
        return range_partitioned_extract(df, column, buffer_size, stage_path).drop("bucket")
    return df
