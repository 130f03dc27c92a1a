"""Aggregate tables and the short reports read from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from filmdw.functions.dates import loaded_at
from filmdw.functions.numbers import billions, millions


def measures() -> list[Column]:
    """Titles counted once; money once per fact row."""
    return [
        F.countDistinct("movie_id").alias("total_films"),
        F.sum("revenue").alias("total_revenue"),
        F.sum("budget").alias("total_budget"),
        F.avg("revenue").alias("avg_revenue"),
        F.avg("budget").alias("avg_budget"),
        F.avg("roi").alias("avg_roi"),
        F.avg("vote_average").alias("avg_rating"),
    ]


_MEASURED = ["movie_id", "revenue", "budget", "roi", "vote_average"]


def aggregate_by_genre(
    fact: DataFrame, genres: DataFrame, as_of: str | None = None
) -> DataFrame:
    """Genre performance. Rows without a genre are left out.

    The fact is reduced to one row per key before the label is joined.
    """
    by_key = (
        fact.select("genre_id", *_MEASURED)
        .where(F.col("genre_id").isNotNull())
        .groupBy("genre_id")
        .agg(*measures())
    )
    joined = by_key.join(genres.select("genre_id", "genre_name"), "genre_id")
    return joined.select(
        "genre_id",
        "genre_name",
        *[c for c in by_key.columns if c != "genre_id"],
        loaded_at(as_of).alias("last_updated"),
    )


def aggregate_by_year(fact: DataFrame, times: DataFrame, as_of: str | None = None) -> DataFrame:
    """Yearly trends. Rows without a known day are left out.

    The broadcast has one row per calendar day at most.
    """
    years = times.select("time_id", "year")
    rows = fact.select("time_id", *_MEASURED).join(F.broadcast(years), "time_id")
    return rows.groupBy("year").agg(*measures()).withColumn("last_updated", loaded_at(as_of))


def top_genres(agg_genre: DataFrame, n: int = 5) -> DataFrame:
    return (
        agg_genre.orderBy(F.desc("total_revenue"), "genre_name")
        .limit(n)
        .select(
            "genre_name",
            "total_films",
            billions(F.col("total_revenue")).alias("revenue_billions"),
            "avg_roi",
        )
    )


def recent_years(agg_yearly: DataFrame, n: int = 10) -> DataFrame:
    return (
        agg_yearly.orderBy(F.desc("year"))
        .limit(n)
        .select(
            "year",
            "total_films",
            billions(F.col("total_revenue")).alias("revenue_billions"),
            millions(F.col("avg_budget")).alias("avg_budget_millions"),
        )
    )
