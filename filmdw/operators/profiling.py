"""Table profiles: nulls, distincts, describe, frequencies, decades, top rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from filmdw.functions.dates import decade
from filmdw.functions.numbers import billions, millions, percent
from filmdw.functions.text import tokens
from filmdw.operators.quantiles import exact_quantiles
from filmdw.sources.constants import constant_rows


def columns_present(df: DataFrame, wanted: list[str]) -> DataFrame:
    """Those of ``wanted`` that exist."""
    return df.select(*[c for c in wanted if c in df.columns])


def first_rows(df: DataFrame, n: int) -> DataFrame:
    """The first ``n`` rows of the scan; not a random sample."""
    return df.limit(n)


def column_types(df: DataFrame) -> list[tuple[int, str, str]]:
    return [(i, name, kind) for i, (name, kind) in enumerate(df.dtypes, 1)]


def _is_null(name: str, kind: str) -> Column:
    missing = F.col(name).isNull()
    return missing | F.isnan(name) if kind in ("float", "double") else missing


def null_profile(df: DataFrame) -> DataFrame:
    """(position, column, type, non_null, missing, missing_pct), one scan."""
    counts = df.agg(
        F.count("*").alias("_rows"),
        *[F.count_if(_is_null(c, kind)).alias(f"m{i}") for i, c, kind in column_types(df)],
    )
    listed = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(c).alias("column"),
            F.lit(kind).alias("type"),
            (F.col("_rows") - F.col(f"m{i}")).alias("non_null"),
            F.col(f"m{i}").alias("missing"),
            percent(F.col(f"m{i}"), F.col("_rows")).alias("missing_pct"),
        )
        for i, c, kind in column_types(df)
    ]
    return counts.select(F.inline(F.array(*listed)))


def top_missing(df: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` columns with most missing values, complete ones left out."""
    return (
        null_profile(df)
        .select("column", "missing", "missing_pct")
        .where(F.col("missing") > 0)
        .orderBy(F.desc("missing"), "column")
        .limit(n)
    )


def distinct_profile(df: DataFrame, approximate: bool = False) -> DataFrame:
    """(column, distinct_values) without NULLs.

    Exact counts come from one row per (column, value), counted in two steps,
    so no value and no column is gathered in one task.
    """
    columns = df.columns
    kinds = dict(df.dtypes)

    def value(c: str) -> Column:
        if kinds[c] not in ("float", "double"):
            return F.col(c)
        # NaN is a missing value; adding zero makes -0.0 and 0.0 one value
        return F.when(~F.isnan(c), F.col(c) + 0.0)

    if approximate:
        counts = df.agg(*[F.approx_count_distinct(value(c)).alias(c) for c in columns])
        pairs = [
            F.struct(F.lit(c).alias("column"), F.col(c).alias("distinct_values")) for c in columns
        ]
        return counts.select(F.inline(F.array(*pairs)))
    pairs = [
        F.struct(F.lit(c).alias("column"), value(c).cast("string").alias("value"))
        for c in columns
    ]
    values = df.select(F.inline(F.array(*pairs))).where(F.col("value").isNotNull()).distinct()
    found = values.groupBy("column").agg(F.count("*").alias("n"))
    every = constant_rows(df.sparkSession, ["column"], [(c,) for c in columns])
    return every.join(found, "column", "left").select(
        "column", F.coalesce("n", F.lit(0)).alias("distinct_values")
    )


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, count, mean, std, min, p25, p50, p75, max) with exact percentiles."""
    parts = []
    for c in columns:
        parts += [
            F.count(c).alias(f"n_{c}"),
            F.avg(c).alias(f"a_{c}"),
            F.stddev_samp(c).alias(f"s_{c}"),
            F.min(c).alias(f"l_{c}"),
            F.max(c).alias(f"h_{c}"),
        ]
    moments = df.agg(*parts).select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("column"),
                        F.col(f"n_{c}").alias("count"),
                        F.col(f"a_{c}").alias("mean"),
                        F.col(f"s_{c}").alias("std"),
                        F.col(f"l_{c}").cast("double").alias("min"),
                        F.col(f"h_{c}").cast("double").alias("max"),
                    )
                    for c in columns
                ]
            )
        )
    )
    probs = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    spread = (
        exact_quantiles(df.select(*columns), columns, list(probs.values()))
        .groupBy("column")
        .agg(
            *[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(n) for n, p in probs.items()]
        )
    )
    return moments.join(spread, "column", "left").select(
        "column", "count", "mean", "std", "min", "p25", "p50", "p75", "max"
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """(value, count), NULL left out."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count("*").alias("count"))
    )


def token_counts(df: DataFrame, column: str, trim: bool = False) -> DataFrame:
    """(value, count) of list elements, untrimmed unless asked."""
    return value_counts(df.select(F.explode(tokens(F.col(column), trim)).alias("token")), "token")


def most_frequent(counts: DataFrame, n: int = 10) -> DataFrame:
    return counts.orderBy(F.desc("count"), "value").limit(n)


def year_counts(df: DataFrame, column: str = "release_date") -> DataFrame:
    years = df.select(F.year(column).alias("year")).where(F.col("year").isNotNull())
    return years.groupBy("year").agg(F.count("*").alias("count")).orderBy("year")


def decade_histogram(df: DataFrame, column: str = "release_date") -> DataFrame:
    """(decade, films) for 1900..2029, empty decades left out."""
    dated = df.where(F.year(column).between(1900, 2029))
    decades = dated.select(decade(F.col(column)).alias("decade"))
    return decades.groupBy("decade").agg(F.count("*").alias("films"))


def date_range(df: DataFrame, column: str = "release_date") -> DataFrame:
    return df.agg(F.min(column).alias("earliest"), F.max(column).alias("latest"))


def top_grossing(df: DataFrame, key: str, n: int = 10) -> DataFrame:
    """The ``n`` titles with most revenue, money scaled for display."""
    top = df.orderBy(F.desc_nulls_last("revenue"), key).limit(n)
    return top.select(
        key,
        "title",
        F.substring("title", 1, 45).alias("shown_title"),
        "release_date",
        billions(F.col("revenue")).alias("revenue_billions"),
        millions(F.col("budget")).alias("budget_millions"),
    )


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """One row: rows that share their key with another row, and how many keys that is."""
    repeated = df.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") > 1)
    return repeated.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("duplicate_rows"),
        F.count("*").alias("duplicate_keys"),
    )
