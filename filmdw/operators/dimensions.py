"""Dimensions of the warehouse, each rebuilt from staging."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from filmdw.fixed_values import OTHER_REGION, UNKNOWN, UNKNOWN_COUNTRY_CODE
from filmdw.functions.dates import calendar, loaded_at
from filmdw.functions.text import collated, is_known, studio_size, tokens
from filmdw.operators.ranking import surrogate_keys
from filmdw.schemas import DIM_COUNTRY, DIM_GENRE, DIM_STUDIO, DIM_TIME
from filmdw.sources.constants import constant_rows, language_countries
from filmdw.sources.spine import date_spine


def _shaped(df: DataFrame, schema, as_of: str | None) -> DataFrame:
    stamped = df.withColumn("created_date", loaded_at(as_of))
    return stamped.select(*[F.col(f.name).cast(f.dataType) for f in schema])


def _list_names(staging: DataFrame, column: str, name: str, collation: str | None = None) -> DataFrame:
    """Distinct trimmed, non-blank elements of a list column; of the spellings that are equal under a
    collation the first in binary order stands for all."""
    names = (
        staging.select(F.explode(tokens(F.col(column))).alias(name))
        .select(F.trim(name).alias(name))
        .where(F.col(name) != "")
    )
    if collation is None:
        return names.distinct()
    return names.groupBy(collated(name, collation).alias("_folded")).agg(F.min(name).alias(name))


def _keyed(names: DataFrame, order_by: list[str], key: str, collation: str | None) -> DataFrame:
    """Numbered in name order, which under a collation is that of its rules."""
    if collation is None:
        return surrogate_keys(names, order_by, key)
    return surrogate_keys(names, [*order_by[:-1], "_folded"], key).drop("_folded")


def build_dim_genre(
    staging: DataFrame, as_of: str | None = None, collation: str | None = None
) -> DataFrame:
    """Genres in name order; ``Unknown`` is one of them if it occurs."""
    names = _list_names(staging, "genres", "genre_name", collation)
    return _shaped(_keyed(names, ["genre_name"], "genre_id", collation), DIM_GENRE, as_of)


def build_dim_time(staging: DataFrame, as_of: str | None = None) -> DataFrame:
    """Every day from the first to the last release date, keyed by position."""
    days = date_spine(staging, "release_date")
    columns = calendar(F.col("full_date"))
    return _shaped(days.withColumns(columns), DIM_TIME, as_of)


def build_dim_country(staging: DataFrame, as_of: str | None = None) -> DataFrame:
    """Unknown first, then one country per code in language order.

    When two languages lead to one code the first in sort order names it.
    """
    language = F.col("original_language")
    languages = staging.select("original_language").where(language.isNotNull()).distinct()
    constants = language_countries(staging.sparkSession)
    named = languages.join(F.broadcast(constants), "original_language", "left").select(
        language,
        F.coalesce("country_code", F.upper(language)).alias("country_code"),
        F.coalesce("country_name", F.concat(F.lit("Language: "), language)).alias("country_name"),
        F.coalesce("region", F.lit(OTHER_REGION)).alias("region"),
    )
    per_code = (
        named.where(F.col("country_code") != UNKNOWN_COUNTRY_CODE)
        .groupBy("country_code")
        .agg(F.min(F.struct(language, F.col("country_name"), F.col("region"))).alias("first"))
        .select(
            F.lit(1).alias("_group"),
            F.col("first.original_language").alias("_language"),
            "country_code",
            "first.country_name",
            "first.region",
        )
    )
    seed = constant_rows(
        staging.sparkSession,
        ["_group", "_language", "country_code", "country_name", "region"],
        [(0, "", UNKNOWN_COUNTRY_CODE, UNKNOWN, UNKNOWN)],
    )
    rows = seed.unionByName(per_code)
    keyed = surrogate_keys(rows, ["_group", "_language"], "country_id")
    return _shaped(keyed, DIM_COUNTRY, as_of)


def build_dim_studio(
    staging: DataFrame, as_of: str | None = None, collation: str | None = None
) -> DataFrame:
    """Unknown first, then every known studio in name order, with a size class."""
    name = F.col("studio_name")
    studios = _list_names(staging, "production_companies", "studio_name", collation).where(is_known(collated(name, collation)))
    studios = studios.withColumns({"_group": F.lit(1), "studio_size": studio_size(name)})
    seed = constant_rows(
        staging.sparkSession, ["_group", "studio_name", "studio_size"], [(0, UNKNOWN, UNKNOWN)]
    )
    if collation is not None:
        seed = seed.withColumn("_folded", collated("studio_name", collation))
    keyed = _keyed(seed.unionByName(studios), ["_group", "studio_name"], "studio_id", collation)
    return _shaped(keyed, DIM_STUDIO, as_of)
