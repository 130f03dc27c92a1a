"""The model variant: one fact row per title, left joins only."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from filmdw.fixed_values import UNKNOWN
from filmdw.functions.dates import loaded_at
from filmdw.functions.numbers import both_positive, profit, roi
from filmdw.functions.text import first_token
from filmdw.operators.aggregates import measures
from filmdw.operators.lookup import calendar_lookup, lookup


def stg_movies(staging: DataFrame) -> DataFrame:
    """Staging rows with id, title and money; missing measures are 0."""
    budget, revenue = F.col("budget"), F.col("revenue")
    usable = (
        F.col("movie_id").isNotNull()
        & F.col("title").isNotNull()
        & (F.col("title") != "")
        & both_positive(budget, revenue)
    )
    zero = F.lit(0.0)
    return staging.where(usable).select(
        "movie_id",
        "title",
        "genres",
        "original_language",
        F.coalesce("overview", F.lit("")).alias("overview"),
        F.coalesce("popularity", zero).alias("popularity"),
        "production_companies",
        "release_date",
        "budget",
        "revenue",
        F.coalesce("runtime", zero).alias("runtime"),
        F.coalesce("vote_average", zero).alias("vote_average"),
        F.coalesce("vote_count", zero).alias("vote_count"),
        profit(revenue, budget).alias("profit"),
        roi(revenue, budget).alias("roi"),
        "release_year",
        "release_month",
        "source",
        "load_date",
    )


def dim_genre(genres: DataFrame, as_of: str | None = None) -> DataFrame:
    """Genre names without Unknown."""
    names = genres.where(F.col("genre_name") != UNKNOWN).select("genre_name").distinct()
    return names.withColumn("updated_at", loaded_at(as_of))


def fact_movies(
    stg: DataFrame,
    genres: DataFrame | None = None,
    times: DataFrame | None = None,
    studios: DataFrame | None = None,
    as_of: str | None = None,
) -> DataFrame:
    """Keys of the first genre and studio as written; a miss leaves a NULL key.

    The key of a dimension that is not given is absent.
    """
    rows = stg.withColumns(
        {
            "genre_name": first_token(F.col("genres")),
            "studio_name": first_token(F.col("production_companies")),
            "full_date": F.col("release_date").cast("date"),
            "updated_at": loaded_at(as_of),
        }
    )
    if genres is not None:
        rows = lookup(rows, genres.select("genre_name", "genre_id"), "genre_name")
    if times is not None:
        rows = calendar_lookup(rows, times, "full_date")
    if studios is not None:
        rows = lookup(rows, studios.select("studio_name", "studio_id"), "studio_name")
    columns = [
        "movie_id",
        "title",
        "genre_id",
        "time_id",
        "studio_id",
        "budget",
        "revenue",
        "profit",
        "roi",
        "runtime",
        "vote_average",
        "vote_count",
        "popularity",
        "original_language",
        "updated_at",
    ]
    return rows.select(*[c for c in columns if c in rows.columns])


def agg_by_genre(fact: DataFrame, genres: DataFrame, as_of: str | None = None) -> DataFrame:
    """Measures per genre name; titles without a genre form the NULL group."""
    named = lookup(
        fact.select("genre_id", "movie_id", "revenue", "budget", "roi", "vote_average"),
        genres.select("genre_id", "genre_name"),
        "genre_id",
    )
    return named.groupBy("genre_name").agg(*measures()).withColumn("last_updated", loaded_at(as_of))
