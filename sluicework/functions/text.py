"""Packed strings, labels and text helpers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PACK_SEPARATOR = "~~"


def pack(*columns) -> Column:
    """``a~~b~~c``; nulls are skipped."""
    return F.concat_ws(PACK_SEPARATOR, *columns)


def unpack(column, index: int) -> Column:
    """Part ``index`` of a packed string, null when there is no such part."""
    return F.get(F.split(column, PACK_SEPARATOR), F.lit(index))


def join_texts(column) -> Column:
    """Array of strings joined by commas; empty or missing gives null."""
    return F.nullif(F.array_join(column, ","), F.lit(""))


def count_label(count) -> Column:
    """Participant count -> range label.

    Anything outside 1..50, zero and null included, takes the last label.
    """
    n = F.expr(f"try_cast({count} AS INT)") if isinstance(count, str) else count.try_cast("int")
    return (
        F.when(n.between(1, 10), F.concat(n.cast("string"), F.lit(" Participant")))
        .when(n.between(11, 20), "11-20 Participant")
        .when(n.between(21, 50), "20-50 Participant")
        .otherwise("50+ Participant")
    )


def encode_base64(column) -> Column:
    return F.base64(F.encode(column, "UTF-8"))


def decode_base64(column) -> Column:
    return F.decode(F.unbase64(column), "UTF-8")
