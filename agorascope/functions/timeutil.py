"""Weeks and buckets of time, all in UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def snapshot_week(created_utc: Column) -> Column:
    """ISO year and week of epoch seconds, like 2020-W53."""
    day = F.timestamp_seconds(created_utc).cast("date")
    return F.concat(F.extract(F.lit("YEAROFWEEK"), day).cast("string"), F.lit("-W"), F.lpad(F.extract(F.lit("WEEK"), day).cast("string"), 2, "0"))


def to_epoch_seconds(value: Column, is_timestamp: bool = False) -> Column:
    """Whole seconds since the epoch; what is no time or number gives 0."""
    seconds = F.unix_seconds(value) if is_timestamp else value.cast("string").try_cast("double").try_cast("bigint")
    return F.coalesce(seconds, F.lit(0).cast("long"))


def bucket(created_utc: Column, unit: str) -> Column:
    """The day, or the week from Sunday on, that holds epoch seconds."""
    at = F.timestamp_seconds(created_utc)
    if unit == "day":
        return F.date_trunc("day", at)
    return F.date_trunc("week", at + F.expr("INTERVAL 1 DAY")) - F.expr("INTERVAL 1 DAY")


def bucket_unit(days: int | None) -> str:
    return "week" if not days or days > 120 else "day"
