"""Registered queries over rough rows: text that is no date or number, money above its caps, long names,
and cleaned rows spoiled afterwards. Each rule has something to find there."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from filmdw.operators import cleaning, dimensions, profiling, quality, regression
from filmdw.session import write_stage
from filmdw.sources.bindings import rough_from_orders

AS_OF = "2001-01-01"


def _rounded(df: DataFrame, **digits: int) -> DataFrame:
    return df.withColumns({c: F.round(c, n) for c, n in digits.items()})


def _cleaned(spark: SparkSession, sf_dir: str, lists: tuple[str, ...] = ()) -> DataFrame:
    return cleaning.clean_movies(write_stage(rough_from_orders(spark, sf_dir, lists), "rough"))


def _spoiled(spark: SparkSession, sf_dir: str, lists: tuple[str, ...] = ()) -> DataFrame:
    """Cleaned rows with nulls, wrong signs, ratings out of range and measures that do not fit the money."""

    def changed(column: str, divisor: int, other: Column | float | None) -> Column:
        other = other if isinstance(other, Column) else F.lit(other)
        return F.when(F.pmod("id", F.lit(divisor)) == 0, other).otherwise(F.col(column))

    changes = {
        "profit": changed("profit", 7, F.col("profit") + 5),
        "roi": changed("roi", 6, F.col("roi") + 1),
        "budget": F.when(F.pmod("id", F.lit(43)) == 0, F.lit(None)).otherwise(changed("budget", 9, -1.0)),
        "revenue": F.when(F.pmod("id", F.lit(23)) == 0, F.lit(None)).otherwise(changed("revenue", 8, -2.0)),
        "vote_average": changed("vote_average", 17, 12.0),
        "title": changed("title", 20, None),
        "runtime": changed("runtime", 5, None),
        "release_date": changed("release_date", 31, None),
    }
    if "genres" in lists:
        changes["genres"] = changed("genres", 37, None)
    return _cleaned(spark, sf_dir, lists).withColumns(changes)


def rough_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned titles from rough text."""
    rows = _cleaned(spark, sf_dir, ("genres", "production_companies")).drop("overview")
    return _rounded(rows, profit=2, roi=6)


def rough_step_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each filter removes from rough text: every step has rows."""
    return _rounded(cleaning.step_counts(rough_from_orders(spark, sf_dir, ())), pct=6)


def rough_top_grossing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles with most revenue among the cleaned rows, cut for display."""
    return _rounded(profiling.top_grossing(_cleaned(spark, sf_dir), "id"), revenue_billions=9, budget_millions=9)


def rough_studios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Studios of all three sizes."""
    rows = rough_from_orders(spark, sf_dir, ("production_companies",))
    return dimensions.build_dim_studio(rows, AS_OF).drop("created_date")


def rough_formula_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profit and roi that do not fit the money in some rows."""
    return _rounded(quality.formula_match(_spoiled(spark, sf_dir)), profit_pct=6, roi_pct=6)


def rough_cleaned_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checks of a cleaned table in which critical columns have nulls."""
    return _rounded(quality.cleaned_checks(_spoiled(spark, sf_dir, ("genres",))), value=6)


def rough_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features with gaps to fill, and titles without revenue left out."""
    rows = regression.regression_features(_spoiled(spark, sf_dir, ("genres", "production_companies")))
    return rows.select("id", "revenue", *regression.FEATURES)


ROUGH_QUERIES = {
    query.__name__: query
    for query in (
        rough_clean,
        rough_step_counts,
        rough_top_grossing,
        rough_studios,
        rough_formula_match,
        rough_cleaned_checks,
        rough_features,
    )
}
