"""Expressions over dates."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def lossy_date(value: Column) -> Column:
    """ISO date, or NULL when the text is none."""
    return F.try_to_date(value.cast("string"), "yyyy-MM-dd")


def strict_date(value: Column) -> Column:
    """ISO date; text that is none fails the job."""
    return F.to_date(value, "yyyy-MM-dd")


def calendar(day: Column) -> dict[str, Column]:
    """Attributes of a day, weeks starting on Monday as day 1."""
    weekday = F.weekday(day) + 1
    return {
        "year": F.year(day),
        "quarter": F.quarter(day),
        "month": F.month(day),
        "month_name": F.date_format(day, "MMMM"),
        "day_of_month": F.dayofmonth(day),
        "day_of_week": weekday,
        "day_name": F.date_format(day, "EEEE"),
        "is_weekend": weekday >= 6,
    }


def seconds_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("SECOND", start, end)


def decade(day: Column) -> Column:
    return (F.floor(F.year(day) / 10) * 10).cast("int")


def loaded_at(as_of: str | None) -> Column:
    """Load time: the given instant, or the time of the run."""
    return F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
