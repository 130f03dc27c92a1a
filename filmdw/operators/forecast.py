"""Yearly series and a trend forecast with a prediction interval."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from filmdw.fixed_values import HORIZON_YEARS, SERIES_FIRST_YEAR, SERIES_LAST_YEAR, Z_95
from filmdw.functions.matrices import dot, gram, inverse, times, with_penalty


def yearly_series(agg_yearly: DataFrame, by: list[str] | None = None) -> DataFrame:
    """(ds, year, y): yearly totals in billions, 1980..2024."""
    years = agg_yearly.where(F.col("year").between(SERIES_FIRST_YEAR, SERIES_LAST_YEAR))
    return years.select(
        *(by or []),
        F.make_date("year", F.lit(1), F.lit(1)).alias("ds"),
        "year",
        (F.col("total_revenue") / 1e9).alias("y"),
    )


def trend_forecast(
    series: DataFrame,
    by: list[str] | None = None,
    last_year: int = SERIES_LAST_YEAR,
    years: int = HORIZON_YEARS,
    z: float = Z_95,
) -> DataFrame:
    """Years after ``last_year`` with prediction and 95 % bounds, per group.

    A straight line is fitted by aggregates, so any number of series is fitted
    in one pass. The bounds are yhat -+ z * s * sqrt(1 + 1/n + (x - mean)^2 / Sxx);
    with fewer than three years they are NULL.
    """
    keys = by or []
    x, y = F.col("year").cast("double"), F.col("y")
    lines = series.groupBy(*keys).agg(
        F.regr_count(y, x).alias("n"),
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.regr_avgx(y, x).alias("mean_x"),
        F.regr_sxx(y, x).alias("sxx"),
        F.regr_sxy(y, x).alias("sxy"),
        F.regr_syy(y, x).alias("syy"),
    )
    # rounding can leave a perfect line with a tiny negative residual
    residual = F.greatest(F.col("syy") - F.col("slope") * F.col("sxy"), F.lit(0.0))
    spread = F.when(F.col("n") > 2, F.sqrt(F.try_divide(residual, F.col("n") - 2)))
    horizon = F.sequence(F.lit(last_year + 1), F.lit(last_year + years))
    rows = lines.withColumn("s", spread).withColumn("year", F.explode(horizon))
    away = F.col("year") - F.col("mean_x")
    half = z * F.col("s") * F.sqrt(1 + 1 / F.col("n") + F.try_divide(away * away, F.col("sxx")))
    predicted = F.col("intercept") + F.col("slope") * F.col("year")
    return rows.select(
        *keys,
        "year",
        predicted.alias("predicted_revenue_B"),
        (predicted - half).alias("lower_bound_B"),
        (predicted + half).alias("upper_bound_B"),
    )


def _hinges(t: Column, places: list[float]) -> Column:
    """1, t, and how far t lies beyond each changepoint."""
    one = F.when(t.isNotNull(), 1.0)
    return F.array(one, t, *[F.when(t.isNotNull(), F.greatest(t - place, F.lit(0.0))) for place in places])


def changepoint_forecast(
    series: DataFrame,
    by: list[str] | None = None,
    changepoints: int = 5,
    history_share: float = 0.8,
    prior_scale: float = 0.3,
    noise_scale: float = 0.1,
    last_year: int = SERIES_LAST_YEAR,
    years: int = HORIZON_YEARS,
    z: float = Z_95,
) -> DataFrame:
    """Years after ``last_year`` with prediction and 95 % bounds of a trend whose slope may change.

    The slope may change at ``changepoints`` places, evenly over the first ``history_share`` of a
    group's years. Changes are normal a priori, with ``prior_scale`` to a noise of ``noise_scale``, which
    is a ridge penalty on them; the normal equations are solved in column expressions. The variance is
    that of the noise, of the fitted trend, and of changes to come at the rate and size of those seen.
    Without changepoints this is ``trend_forecast``.

    A group has one value a year, so its array is bounded by the calendar. With one year nothing is
    predicted; without more years than effective parameters the bounds are NULL.
    """
    keys = by or []
    size = changepoints + 2
    places = [history_share * j / changepoints for j in range(1, changepoints + 1)]
    penalty = (noise_scale / prior_scale) ** 2
    point = F.struct(F.col("year").cast("double").alias("year"), F.col("y").cast("double").alias("y"))
    given = series.where(F.col("y").isNotNull() & F.col("year").isNotNull())
    groups = given.groupBy(*keys).agg(F.array_sort(F.collect_list(point)).alias("points")).where(F.size("points") > 0)
    groups = groups.withColumns({"first": F.element_at("points", 1)["year"], "last": F.element_at("points", -1)["year"]})

    def scaled(year: Column) -> Column:
        return F.try_divide(year - F.col("first"), F.col("last") - F.col("first"))

    y = F.transform("points", lambda p: p["y"])
    steps: list[dict[str, Column]] = [
        {"basis": F.transform("points", lambda p: _hinges(scaled(p["year"]), places)), "y": y},
        {"gram": gram(F.col("basis"), size)},
        {"inverse": inverse(with_penalty(F.col("gram"), [0.0, 0.0] + [penalty] * changepoints), size)},
        {
            "xy": F.transform(
                F.sequence(F.lit(0), F.lit(size - 1)),
                lambda i: dot(F.transform("basis", lambda row: row[i]), F.col("y")),
            )
        },
        {"weights": times(F.col("inverse"), F.col("xy"))},
        {
            "parameters": F.aggregate(
                F.zip_with("inverse", "gram", dot), F.lit(0.0), lambda total, x: total + x
            ),
            "unexplained": dot(F.col("y"), F.col("y"))
            - 2 * dot(F.col("weights"), F.col("xy"))
            + dot(F.col("weights"), times(F.col("gram"), F.col("weights"))),
            "changes": F.slice("weights", 3, size),
        },
    ]
    for step in steps:
        groups = groups.withColumns(step)
    # a perfect line leaves rounding only
    free = F.size("points") - F.col("parameters")
    noise = F.when(free > 1e-9, F.greatest("unexplained", F.lit(0.0)) / free)
    groups = groups.withColumns({"noise": noise, "to_come": dot(F.col("changes"), F.col("changes")) / history_share})

    horizon = F.sequence(F.lit(last_year + 1), F.lit(last_year + years))
    rows = groups.withColumn("year", F.explode(horizon)).withColumn("t", scaled(F.col("year")))
    rows = rows.withColumn("at", _hinges(F.col("t"), places))
    ahead = F.greatest(F.col("t") - 1, F.lit(0.0))
    variance = F.col("noise") * (1 + dot(F.col("at"), times(F.col("inverse"), F.col("at"))))
    half = z * F.sqrt(variance + F.col("to_come") * ahead * ahead * ahead / 3)
    predicted = dot(F.col("weights"), F.col("at"))
    return rows.select(
        *keys,
        "year",
        predicted.alias("predicted_revenue_B"),
        (predicted - half).alias("lower_bound_B"),
        (predicted + half).alias("upper_bound_B"),
    )


def recent_history(series: DataFrame, first_year: int = 2015) -> DataFrame:
    return series.where(F.col("year") >= first_year)
