"""Landed detail documents to staging rows, and the load of unseen ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from filmdw.fixed_values import DETAIL_SOURCE, UNKNOWN
from filmdw.functions.dates import loaded_at, lossy_date
from filmdw.functions.numbers import both_positive, profit, roi
from filmdw.functions.text import joined_names
from filmdw.operators.lookup import keep_unknown
from filmdw.schemas import DETAIL, STAGING


def listed_ids(pages: DataFrame) -> DataFrame:
    """One row per title on the listing pages."""
    items = pages.select(F.explode("results").alias("item"))
    return items.select(F.col("item.id").alias("movie_id"))


def parse_details(
    details: DataFrame, as_of: str | None = None, with_countries: bool = False
) -> DataFrame:
    """Flatten detail documents to staging columns; absent fields take defaults.

    Profit and roi stay NULL unless budget and revenue are both positive.
    """
    budget = F.coalesce("budget", F.lit(0.0))
    revenue = F.coalesce("revenue", F.lit(0.0))
    paid = both_positive(budget, revenue)
    day = lossy_date(F.nullif("release_date", F.lit("")))
    values: dict[str, Column] = {
        "movie_id": F.col("id"),
        "title": F.coalesce("title", F.lit("")),
        "genres": joined_names(F.col("genres"), "name", UNKNOWN),
        "original_language": F.coalesce("original_language", F.lit("en")),
        "overview": F.coalesce("overview", F.lit("")),
        "popularity": F.coalesce("popularity", F.lit(0.0)),
        "production_companies": joined_names(F.col("production_companies"), "name", UNKNOWN),
        "release_date": day,
        "budget": budget,
        "revenue": revenue,
        "runtime": F.col("runtime"),
        "vote_average": F.coalesce("vote_average", F.lit(0.0)),
        "vote_count": F.coalesce("vote_count", F.lit(0.0)),
        "profit": F.when(paid, profit(revenue, budget)),
        "roi": F.when(paid, roi(revenue, budget)),
        "release_year": F.year(day),
        "release_month": F.month(day),
        "load_date": loaded_at(as_of),
        "source": F.lit(DETAIL_SOURCE),
    }
    columns = [values[f.name].cast(f.dataType).alias(f.name) for f in STAGING]
    if with_countries:
        columns.append(
            joined_names(F.col("production_countries"), "iso_3166_1", "US").alias("countries")
        )
    return details.select(*columns)


def parse_detail_text(documents: DataFrame, column: str = "json") -> tuple[DataFrame, DataFrame]:
    """(detail structs, rejected documents) from JSON text.

    A document is rejected when it is malformed, when a money field or a list
    is an explicit null, or when a list item has no name. An absent field is
    no reason: it takes its default.
    """
    parsed = F.struct(
        F.from_json(column, DETAIL).alias("doc"), F.json_object_keys(column).alias("_keys")
    )

    def explicit_null(name: str) -> Column:
        return F.array_contains("_keys", name) & F.col(f"doc.{name}").isNull()

    def nameless(name: str, field: str) -> Column:
        return F.exists(F.col(f"doc.{name}"), lambda item: item[field].isNull())

    lists = {
        "genres": "name",
        "production_companies": "name",
        "production_countries": "iso_3166_1",
    }
    bad = F.col("_keys").isNull()
    for name in ("budget", "revenue", *lists):
        bad = bad | explicit_null(name)
    for name, field in lists.items():
        bad = bad | F.coalesce(nameless(name, field), F.lit(False))
    # a generator of one row keeps the checks above the parse, so that a document
    # is parsed once and not once per check
    marked = documents.select("*", F.inline(F.array(parsed))).withColumn(
        "_bad", F.coalesce(bad, F.lit(True))
    )
    good = marked.where(~F.col("_bad")).select("doc.*")
    return good, marked.where(F.col("_bad")).select(*documents.columns)


def distinct_ids(staging: DataFrame) -> DataFrame:
    return staging.select("movie_id").where(F.col("movie_id").isNotNull()).distinct()


def one_row_per_id(batch: DataFrame, key: str = "movie_id") -> DataFrame:
    """One whole row per id, the smallest in column order; rows without an id stay.

    A plain aggregate, so copies of one id are merged before the shuffle.
    """
    others = [c for c in batch.columns if c != key]
    picked = (
        batch.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.min(F.struct(*others)).alias("_row"))
        .select(key, "_row.*")
    )
    loose = batch.where(F.col(key).isNull())
    return picked.unionByName(loose).select(*batch.columns)


def delta_load(staging: DataFrame, batch: DataFrame, dedupe: bool = False) -> DataFrame:
    """Rows of ``batch`` whose id is not staged yet.

    Repeats inside the batch stay unless ``dedupe`` is set.
    """
    rows = one_row_per_id(batch) if dedupe else batch
    return keep_unknown(rows, staging, "movie_id")
