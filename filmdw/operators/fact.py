"""Fact table at title-by-genre grain, and reports read from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from filmdw.fixed_values import UNKNOWN, UNKNOWN_COUNTRY_CODE
from filmdw.functions.dates import loaded_at
from filmdw.functions.numbers import billions, both_positive
from filmdw.functions.text import known_head, shown_title, tokens
from filmdw.operators.lookup import calendar_lookup, first_match, lookup
from filmdw.schemas import FACT
from filmdw.sources.constants import language_countries

_CARRIED = [
    "movie_id",
    "title",
    "budget",
    "revenue",
    "profit",
    "roi",
    "runtime",
    "vote_average",
    "vote_count",
    "popularity",
    "original_language",
]


def with_country_code(rows: DataFrame, mode: str = "code") -> DataFrame:
    """Add the country code a language leads to.

    ``code`` takes the upper-cased language for the code, so ``en`` finds no
    country; ``language`` goes through the language table first.
    """
    language = F.col("original_language")
    if mode == "code":
        return rows.withColumn("country_code", F.upper(language))
    if mode != "language":
        raise ValueError(f"mode must be 'code' or 'language', got {mode!r}")
    constants = language_countries(rows.sparkSession).select("original_language", "country_code")
    joined = rows.join(F.broadcast(constants), "original_language", "left")
    return joined.withColumn("country_code", F.coalesce("country_code", F.upper(language)))


def with_country(
    rows: DataFrame, countries: DataFrame, mode: str = "code", collation: str | None = None
) -> DataFrame:
    """Add ``country_id``; a language without a country takes the Unknown one."""
    coded = with_country_code(rows, mode)
    codes = countries.select("country_code", "country_id")
    joined = lookup(coded, codes, "country_code", collation=collation)
    unknown = countries.where(F.col("country_code") == UNKNOWN_COUNTRY_CODE).agg(
        F.min("country_id").alias("country_id")
    )
    return joined.withColumn("country_id", F.coalesce("country_id", unknown.scalar()))


def retained(staging: DataFrame) -> DataFrame:
    """Rows the fact keeps: dated, with money, and with a known studio.

    Exploding a list of at most one studio finds it and drops titles without
    one in a single evaluation.
    """
    dated = staging.where(
        F.col("release_date").isNotNull() & both_positive(F.col("budget"), F.col("revenue"))
    )
    return dated.withColumn("studio_name", F.explode(known_head(F.col("production_companies"))))


def build_fact(
    staging: DataFrame,
    genres: DataFrame | None = None,
    times: DataFrame | None = None,
    countries: DataFrame | None = None,
    studios: DataFrame | None = None,
    country_mode: str = "code",
    as_of: str | None = None,
    unique_names: bool = True,
    broadcast_rows: int | None = None,
    collation: str | None = None,
) -> DataFrame:
    """One row per retained title and genre token.

    A blank or unmatched token stays with a NULL genre. A dimension that is not
    given is not looked up and its key is absent, for callers that need the
    grain and only some keys. The title-grain keys are looked up before the
    tokens multiply the rows. Dimensions that may repeat a name
    (``unique_names=False``) give the lowest key of the name. Under a ``collation`` names and country
    codes match by its rules; dimensions built under the same one have each name once.
    """

    def named_keys(dim: DataFrame, name: str, key: str) -> DataFrame:
        return dim.select(name, key) if unique_names else first_match(dim, name, key, collation)

    def found(rows: DataFrame, dim: DataFrame, name: str, key: str) -> DataFrame:
        return lookup(rows, named_keys(dim, name, key), name, broadcast_rows, collation=collation)

    rows = retained(staging).select(*_CARRIED, "genres", "release_date", "studio_name")
    if times is not None:
        rows = calendar_lookup(rows, times, "release_date")
    if countries is not None:
        rows = with_country(rows, countries, country_mode, collation)
    if studios is not None:
        rows = found(rows, studios, "studio_name", "studio_id")
    rows = rows.withColumn("genre_name", F.explode(tokens(F.col("genres"))))
    rows = rows.withColumn("genre_name", F.trim("genre_name"))
    if genres is not None:
        rows = found(rows, genres, "genre_name", "genre_id")
    rows = rows.withColumn("created_date", loaded_at(as_of))
    return rows.select(
        *[F.col(f.name).cast(f.dataType) for f in FACT if f.name in rows.columns]
    )


def top_revenue(fact: DataFrame, genres: DataFrame, times: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` fact rows with most revenue; a title shows once per genre."""
    # only n rows need their labels, so the limit comes before the joins
    order: list[Column] = [
        F.desc("revenue"),
        F.asc("movie_id"),
        F.asc_nulls_last("genre_id"),
    ]
    top = fact.orderBy(*order).limit(n)
    labels = genres.select("genre_id", "genre_name")
    years = times.select("time_id", "year")
    rows = top.join(labels, "genre_id", "left").join(years, "time_id", "left")
    return rows.select(
        "movie_id",
        "title",
        shown_title(F.col("title")).alias("shown_title"),
        F.coalesce("genre_name", F.lit(UNKNOWN)).alias("genre_name"),
        F.coalesce("year", F.lit(0)).alias("year"),
        "budget",
        "revenue",
        "profit",
        billions(F.col("revenue")).alias("revenue_billions"),
        F.coalesce("roi", F.lit(0.0)).alias("roi"),
    )


def null_key_counts(fact: DataFrame) -> DataFrame:
    """One row: fact rows and how many lack each key."""
    keys = ("genre_id", "time_id", "studio_id")
    return fact.agg(
        F.count("*").alias("fact_rows"),
        *[F.count_if(F.col(k).isNull()).alias(f"null_{k}") for k in keys],
    )
