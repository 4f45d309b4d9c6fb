"""Profile metrics, row checksums, dataset comparison, constraint hints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicework.session import through_storage

NULL_MARK = "\u0000"
# Ranges a digest comparison tells apart; with rows spread over them, few differing rows mean few rows to compare.
DIGEST_RANGES = 4096
METRIC_COLUMNS = ("entity", "instance", "name", "value")


def _metric(entity: str, instance: str, name: str, value: Column) -> Column:
    return F.struct(
        F.lit(entity).alias("entity"), F.lit(instance).alias("instance"),
        F.lit(name).alias("name"), value.cast("double").alias("value"))


def _simple_metrics(df: DataFrame, complete: Sequence[str], numeric: Sequence[str]) -> DataFrame:
    """Everything that needs no per-value counts, in one pass without a wide shuffle."""
    total = F.count(F.lit(1))
    metrics = [_metric("Dataset", "*", "Size", total)]
    for name in complete:
        metrics.append(_metric("Column", name, "Completeness", F.count(F.col(name)) / F.nullif(total, F.lit(0))))
    for name in numeric:
        metrics.append(_metric("Column", name, "Minimum", F.min(name)))
        metrics.append(_metric("Column", name, "Mean", F.avg(name)))
        metrics.append(_metric("Column", name, "Maximum", F.max(name)))
    return df.agg(F.array(*metrics).alias("m")).select(F.explode("m").alias("m")).select("m.*")


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column_name, value_text, n`` over non-null values of several columns.

    One scan and one shuffle for all columns; equal values are added up in each
    map task first, so a frequent value costs one row per task.
    """
    pairs = F.array(*[
        F.struct(F.lit(name).alias("column_name"), F.col(name).cast("string").alias("value_text"))
        for name in columns
    ])
    return (
        df.select(F.explode(pairs).alias("p")).select("p.*")
        .filter(F.col("value_text").isNotNull())
        .groupBy("column_name", "value_text")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _per_column(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct values, entropy and highest repeat of each column.

    With N = sum(n): -sum(n/N * ln(n/N)) = ln N - sum(n ln n) / N, so one
    aggregate over the counts is enough and N need not be known beforehand.
    """
    total = F.sum("n")
    return value_counts(df, columns).groupBy("column_name").agg(
        F.count(F.lit(1)).alias("values"),
        (F.ln(total) - F.sum(F.col("n") * F.ln("n")) / total).alias("entropy"),
        F.max("n").alias("repeats"),
    )


def _frequency_metrics(df: DataFrame, wanted: dict[str, tuple[str, Sequence[str]]]) -> DataFrame:
    """Metrics read off value counts; ``wanted`` maps metric -> (field, columns)."""
    columns = list(dict.fromkeys(name for _, names in wanted.values() for name in names))
    metrics = F.array(*[
        F.when(
            F.col("column_name").isin(list(names)),
            F.struct(F.lit(metric).alias("name"), F.col(field).cast("double").alias("value")))
        for metric, (field, names) in wanted.items()
    ])
    return (
        _per_column(df, columns)
        .select("column_name", F.explode(metrics).alias("m"))
        .filter(F.col("m").isNotNull())
        .select(F.lit("Column").alias("entity"), F.col("column_name").alias("instance"), "m.name", "m.value")
    )


def profile(
    df: DataFrame,
    complete: Sequence[str] = (),
    distinct: Sequence[str] = (),
    numeric: Sequence[str] = (),
    entropy: Sequence[str] = (),
) -> DataFrame:
    """Tidy metrics ``entity, instance, name, value`` for the named columns."""
    result = _simple_metrics(df, complete, numeric)
    if distinct or entropy:
        wanted = {"CountDistinct": ("values", distinct), "Entropy": ("entropy", entropy)}
        result = result.unionByName(_frequency_metrics(df, {k: v for k, v in wanted.items() if v[1]}))
    return result


def _flat_columns(df: DataFrame) -> tuple[list[str], list[str]]:
    flat = [f for f in df.schema.fields if not isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType))]
    return [f.name for f in flat], [f.name for f in flat if isinstance(f.dataType, T.NumericType)]


def profile_all(df: DataFrame) -> DataFrame:
    """Profile every flat column with the metrics its type allows."""
    names, numeric = _flat_columns(df)
    return profile(df, complete=names, distinct=names, numeric=numeric, entropy=names)


def _escaped(df: DataFrame, name: str) -> Column:
    """A column as text with ``\\`` before each ``\\``, ``~`` and NUL; only types that can hold them are searched."""
    text = F.col(f"`{name}`").cast("string")
    if isinstance(df.schema[name].dataType, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        return text
    for mark in ("\\", "~", NULL_MARK):
        text = F.replace(text, F.lit(mark), F.lit(f"\\{mark}"))
    return text


def row_checksum(df: DataFrame, null_safe: bool = True, column: str = "md5") -> DataFrame:
    """md5 of all columns joined by ``~``.

    A ``~``, ``\\`` or NUL inside a value gets a ``\\`` in front, so values cannot run
    into each other.  By default a null is written as a NUL alone, so ``(a, null)`` and
    ``(null, a)`` differ and no text equals a null; with ``null_safe=False`` nulls are skipped.
    """
    parts = [_escaped(df, name) for name in df.columns]
    if null_safe:
        parts = [F.coalesce(part, F.lit(NULL_MARK)) for part in parts]
    return df.select("*", F.md5(F.concat_ws("~", *parts)).alias(column))


def _surplus(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per key, how many more rows the left side has: one union, one shuffle."""
    tagged = left.select(*keys, F.lit(1).alias("_sign")).unionByName(right.select(*keys, F.lit(-1).alias("_sign")))
    return tagged.groupBy(*keys).agg(F.sum("_sign").alias("surplus")).filter("surplus <> 0")


def dataset_diff(left: DataFrame, right: DataFrame, null_safe: bool = True) -> DataFrame:
    """``md5, side, copies`` of rows one side has more often; empty means equal."""
    surplus = _surplus(
        row_checksum(left, null_safe).select("md5"), row_checksum(right, null_safe).select("md5"), ["md5"])
    return surplus.select(
        "md5", F.when(F.col("surplus") > 0, "left").otherwise("right").alias("side"),
        F.abs("surplus").alias("copies"))


def _hash(df: DataFrame, names: Sequence[str], lane: int) -> Column:
    """A hash of columns in which a null in one place differs from a null in another."""
    return F.xxhash64(F.lit(lane), *[part for n in names for part in (F.col(f"`{n}`"), F.col(f"`{n}`").isNull())])


def differing_ranges(left: DataFrame, right: DataFrame, keys: Sequence[str] | None = None, ranges: int = DIGEST_RANGES) -> DataFrame:
    """``range``: hash ranges of the key in which the two sides do not hold the same rows equally often.

    Each side's rows are summed up per range, in any order: the number of rows and two sums of 64-bit row hashes.  Map
    tasks add up first, so no more than ``ranges`` rows a task are shuffled.  Both sides must have the same columns and types.
    """
    if sorted(left.dtypes) != sorted(right.dtypes):
        raise ValueError("the sides differ in columns or types")
    names = left.columns
    sides = [
        df.select(F.pmod(_hash(df, keys or names, 0), F.lit(ranges)).cast("int").alias("range"), F.lit(sign).alias("sign"),
                  *[(_hash(df, names, lane).cast("decimal(38,0)") * sign).cast("decimal(38,0)").alias(f"lane{lane}") for lane in (1, 2)])
        for df, sign in ((left, 1), (right, -1))]
    sums = [F.sum(name).alias(name) for name in ("sign", "lane1", "lane2")]
    return sides[0].unionByName(sides[1]).groupBy("range").agg(*sums).where("sign <> 0 OR lane1 <> 0 OR lane2 <> 0").select("range")


def digest_diff(
    left: DataFrame, right: DataFrame, keys: Sequence[str] | None = None, null_safe: bool = True, ranges: int = DIGEST_RANGES,
) -> DataFrame:
    """:func:`dataset_diff` of very large frames that are mostly equal: digests first, then the rows of differing ranges.

    ``keys`` (all columns by default) choose a row's range; with the keys that identify a row, a changed row makes one
    range differ and not two.  Two equal frames shuffle digests alone.
    """
    found = through_storage(differing_ranges(left, right, keys, ranges), "differing")
    if found.isEmpty():
        return dataset_diff(left.limit(0), right.limit(0), null_safe)
    # At most ``ranges`` rows.
    few = [
        df.withColumn("_range", F.pmod(_hash(df, keys or left.columns, 0), F.lit(ranges)).cast("int")).join(
            F.broadcast(found.withColumnRenamed("range", "_range")), "_range", "left_semi").select(left.columns)
        for df in (left, right)]
    return dataset_diff(*few, null_safe)


def missing_checksums(left: DataFrame, right: DataFrame, null_safe: bool = True) -> DataFrame:
    """Checksums of the left side that the right side lacks altogether."""
    mine = row_checksum(left, null_safe).select("md5").distinct()
    return mine.join(row_checksum(right, null_safe).select("md5").distinct(), "md5", "left_anti")


def metric_diff(left: DataFrame, right: DataFrame, digits: int | None = None) -> DataFrame:
    """Metric rows without an equal row on the other side, from both sides.

    Values must be equal, or equal to ``digits`` decimals where that is given:
    sums of doubles may differ in the last bits from run to run.
    """
    rounded = [left, right] if digits is None else [
        df.withColumn("value", F.round("value", digits)) for df in (left, right)]
    surplus = _surplus(*rounded, METRIC_COLUMNS)
    return surplus.select(
        *METRIC_COLUMNS, F.when(F.col("surplus") > 0, "left").otherwise("right").alias("side"))


def suggest_constraints(df: DataFrame, small_domain: int = 10) -> DataFrame:
    """``column_name, rule`` hints read off the profile of every flat column."""
    names, numeric = _flat_columns(df)
    wanted = {"CountDistinct": ("values", names), "Repeats": ("repeats", names)}
    metrics = _simple_metrics(df, names, numeric).unionByName(_frequency_metrics(df, wanted))
    profiled = (
        metrics.filter("entity = 'Column'")
        .groupBy(F.col("instance").alias("column_name"))
        .agg(*[
            F.max(F.when(F.col("name") == metric, F.col("value"))).alias(metric)
            for metric in ("Completeness", "CountDistinct", "Repeats", "Minimum")
        ])
    )
    complete = F.col("Completeness") == 1
    rules = F.array(
        F.when(complete, "complete"),
        F.when(complete & (F.col("Repeats") == 1), "unique"),
        F.when(F.col("Minimum") >= 0, "non_negative"),
        F.when(F.col("CountDistinct") <= small_domain, "small_domain"),
    )
    return profiled.select("column_name", F.explode(F.array_compact(rules)).alias("rule"))
