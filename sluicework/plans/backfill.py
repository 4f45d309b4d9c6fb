"""Run a pipeline once per missing day."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import UTC, date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicework.plans.runner import run_batch


def missing_days(target: DataFrame, date_column: str, today: Column | None = None) -> DataFrame:
    """Days after the last loaded one, through yesterday (``load_date``)."""
    yesterday = F.date_sub(today if today is not None else F.current_date(), 1)
    last = target.agg(F.max(F.to_date(date_column)).alias("last"))
    span = last.select((F.date_add("last", 1)).alias("first"), yesterday.alias("final"))
    return span.filter("first <= final").select(
        F.explode(F.sequence("first", "final", F.expr("INTERVAL 1 DAY"))).alias("load_date"))


def requested_day(text: str) -> date:
    """A single ``YYYY-MM-DD`` day, validated."""
    return datetime.strptime(text, "%Y-%m-%d").date()


def days_to_run(target: DataFrame, date_column: str, only: str | None = None, today: date | None = None) -> list[date]:
    """One requested day, or every missing day.

    The list is bounded by the calendar, not by the table.
    """
    if only is not None:
        return [requested_day(only)]
    last = target.agg(F.max(F.to_date(date_column))).first()[0]
    if last is None:
        return []
    end = today or datetime.now(UTC).date()
    return [last + timedelta(days=n) for n in range(1, (end - last).days)]


def backfill(
    run: Callable[[dict[str, str]], object], target: DataFrame, date_column: str,
    only: str | None = None, today: date | None = None,
) -> list[date]:
    """Call ``run({"date": day})`` for each day in order."""
    days = days_to_run(target, date_column, only, today)
    for day in days:
        run({"date": day.isoformat()})
    return days


def backfill_batch(
    spark: SparkSession, config: str | Mapping, enable: str | Mapping, target: DataFrame, date_column: str,
    only: str | None = None, until: str | None = None, variables: Mapping[str, str] | None = None, log_path: str | None = None,
) -> list[date]:
    """Run the enabled pipelines of a specification once per missing day; each run gets the day as ``#date``.

    Days follow the last one of ``target`` up to the day before ``until`` (today).  A failing day ends the backfill.
    """
    end = requested_day(until) if until is not None else None
    return backfill(lambda day: run_batch(spark, config, enable, {**(variables or {}), **day}, log_path), target, date_column, only, end)
