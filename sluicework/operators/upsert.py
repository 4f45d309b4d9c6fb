"""Latest row per key, key buckets and time-based routing; tables that use them are in snapshots.py."""

from __future__ import annotations

from collections.abc import Sequence
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET = "key_bucket"


def latest_per_key(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """One row per key, the first in ``order``.

    Spark limits each map task to one row per key before the shuffle (window
    group limit), so a hot key does not pile up in one task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def key_bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(buckets)).cast("int")


def tie_break(df: DataFrame) -> Column:
    """An order on whole rows that is the same on every run."""
    return F.xxhash64(*[F.col(f"`{name}`") for name, kind in df.dtypes if "map<" not in kind and kind != "variant"]).desc()


def target_name(index: str, ts_col: str | None = None, ts_format: str | None = None) -> Column:
    """``index-<formatted time>``; the plain index when either part is missing."""
    if not (ts_col and ts_format):
        return F.lit(index)
    pattern = ts_format.replace("YYYY", "yyyy")
    return F.concat(F.lit(f"{index}-"), F.date_format(F.col(ts_col).cast("timestamp"), pattern))


def route_by_time(df: DataFrame, index: str, ts_col: str | None, ts_format: str | None, column: str = "target_index") -> DataFrame:
    return df.withColumn(column, target_name(index, ts_col, ts_format))
