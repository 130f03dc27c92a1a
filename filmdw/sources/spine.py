"""Generated rows: days and years."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def date_spine(df: DataFrame, column: str) -> DataFrame:
    """(time_id, full_date): each day from the first to the last date of ``column``.

    The key is the distance from the first day, so nothing is sorted. The
    calendar bounds the result: dates end with year 9999.
    """
    ends = df.agg(F.min(column).alias("lo"), F.max(column).alias("hi")).where("lo IS NOT NULL")
    days = F.sequence("lo", "hi", F.expr("interval 1 day"))
    return ends.select(F.posexplode(days).alias("pos", "full_date")).select(
        (F.col("pos") + 1).cast("bigint").alias("time_id"), "full_date"
    )
