"""Timestamp text formats and small date helpers."""

from __future__ import annotations

from datetime import UTC, datetime, time, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two text forms change timestamps travel in.
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
ISO_MILLIS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
SPACE_FORMAT = "yyyy-MM-dd HH:mm:ss"
TEXT_FORMATS = {"soql": "%Y-%m-%dT%H:%M:%SZ", "cdata": "%Y-%m-%d %H:%M:%S"}


def parse_any(column) -> Column:
    """Either text form (with or without milliseconds) -> timestamp, else null."""
    return F.coalesce(
        F.try_to_timestamp(column, F.lit(ISO_FORMAT)),
        F.try_to_timestamp(column, F.lit(ISO_MILLIS_FORMAT)),
        F.try_to_timestamp(column, F.lit(SPACE_FORMAT)),
    )


def iso_to_space(column) -> Column:
    return F.date_format(parse_any(column), SPACE_FORMAT)


def space_to_iso(column) -> Column:
    return F.date_format(parse_any(column), ISO_FORMAT)


def shift_zone(column, zone: str) -> Column:
    """UTC text or timestamp -> wall-clock timestamp in ``zone``."""
    return F.from_utc_timestamp(column, zone)


def plus_one_second(column) -> Column:
    return column + F.expr("INTERVAL 1 SECOND")


def epoch_millis(column) -> Column:
    """Epoch milliseconds -> timestamp; null stays null."""
    return F.timestamp_millis(column)


def whole_unit_cap(start: datetime, now: datetime, cap: int, unit: timedelta) -> datetime:
    """End of the next extraction window.

    The gap is counted in whole units: more than ``cap`` of them and the window
    is cut at ``start + cap``, otherwise it reaches ``now``.  A ``now`` before
    ``start`` gives an empty window, so the end never moves backwards.
    """
    if now <= start:
        return start
    return start + cap * unit if (now - start) // unit > cap else now


def last_days_start(days: int, now: datetime | None = None) -> datetime:
    """UTC midnight ``days`` days ago."""
    today = (now or datetime.now(UTC)).date()
    return datetime.combine(today - timedelta(days=days), time.min)


def parse_text(text: str) -> datetime:
    """Driver-side twin of :func:`parse_any` for option values."""
    cleaned = text.strip().replace("T", " ").removesuffix("Z")
    return datetime.fromisoformat(cleaned)


def format_text(value: datetime, style: str = "soql") -> str:
    return value.strftime(TEXT_FORMATS[style])
