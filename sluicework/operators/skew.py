"""Joins and writes that stay balanced when one key holds much of the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def lookup_join(big: DataFrame, lookup: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join a large frame to a lookup that is unique by ``on``; ``how`` is ``inner`` or ``left``.

    One plan for every size: Catalyst broadcasts a lookup that is small by its
    own estimate, and adaptive execution cuts a hot key's partition of the large
    side into pieces and reads the lookup's partition once per piece, as the
    session defaults ask.  Nothing is counted beforehand.
    """
    return big.join(lookup, list(on), how)


def spread(df: DataFrame, parts: int | None = None) -> DataFrame:
    """Deal rows out evenly before costly work on each; by default one part per core of the session."""
    return df.repartition(parts or df.sparkSession.sparkContext.defaultParallelism)


def balanced(df: DataFrame, *columns: str) -> DataFrame:
    """Cluster rows by columns before a partitioned write.

    Adaptive execution cuts a partition that is too big and merges small ones,
    so a hot value becomes several files rather than one long task.
    """
    return df.hint("rebalance", *columns) if columns else df.hint("rebalance")
