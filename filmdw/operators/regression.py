"""Revenue regression: features, fit, metrics, cross-validation, error reports."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from filmdw.fixed_values import FEATURES, FOLDS, TARGET_R2
from filmdw.functions.status import performance
from filmdw.functions.text import primary_token
from filmdw.operators.lookup import lookup
from filmdw.operators.profiling import most_frequent, value_counts
from filmdw.operators.quantiles import exact_median
from filmdw.operators.ranking import number_rows
from filmdw.session import run_together, write_stage
from filmdw.sources.constants import constant_rows


def with_primary(rows: DataFrame) -> DataFrame:
    """Add the first genre and the first studio of each title."""
    return rows.withColumns(
        {
            "primary_genre": primary_token(F.col("genres")),
            "primary_studio": primary_token(F.col("production_companies")),
        }
    )


def label_codes(rows: DataFrame, column: str, code: str) -> DataFrame:
    """(column, code): codes from 0 in sorted order of the labels."""
    labels = rows.select(column).where(F.col(column).isNotNull()).distinct()
    return number_rows(labels, [column], code, label="labels", start=0, unique=True)


def frequencies(rows: DataFrame, column: str, out: str) -> DataFrame:
    """(column, out): how often each label occurs."""
    return value_counts(rows, column).withColumnsRenamed({"value": column, "count": out})


def first_labels(codes: DataFrame, column: str, code: str, n: int = 5) -> DataFrame:
    return codes.orderBy(code).limit(n).select(code, column)


def top_studios(rows: DataFrame, n: int = 5) -> DataFrame:
    return most_frequent(value_counts(rows, "primary_studio"), n)


def regression_features(cleaned: DataFrame, key: str = "id") -> DataFrame:
    """The nine features and the revenue of each title with revenue.

    Codes, frequencies and the median come from all titles, before those
    without revenue are left out. The frequency is counted per studio and
    looked up, so a studio with most of the titles is never one window.
    """
    used = [key, "title", "revenue", "genres", "production_companies"]
    used += [c for c in FEATURES if c in cleaned.columns]
    rows = write_stage(with_primary(cleaned.select(*used)), "features")
    codes, studios, median = run_together(
        rows.sparkSession,
        lambda: label_codes(rows, "primary_genre", "genre_encoded"),
        lambda: write_stage(frequencies(rows, "primary_studio", "studio_freq"), "studios"),
        lambda: _median_if_missing(rows, "runtime"),
    )
    coded = lookup(lookup(rows, codes, "primary_genre"), studios, "primary_studio")
    filled = coded.withColumn("runtime", F.coalesce("runtime", median))
    filled = filled.na.fill(0.0, ["popularity", "vote_average", "vote_count"])
    filled = filled.na.fill(1, ["studio_freq"])
    return filled.where(F.col("revenue") > 0)


def _median_if_missing(rows: DataFrame, column: str) -> Column:
    """The median, which is looked for only if a value is missing."""
    if rows.where(F.col(column).isNull()).isEmpty():
        return F.lit(None).cast("double")
    return exact_median(rows, column)


def _hash_text(key: str) -> Column:
    return F.md5(F.col(key).cast("string"))


def with_split(rows: DataFrame, key: str = "id") -> DataFrame:
    """Add ``split``: a fixed fifth of the keys is ``test``, whatever the partitioning."""
    held_out = F.substring(_hash_text(key), 1, 8) < "33333333"
    return rows.withColumn("split", F.when(held_out, "test").otherwise("train"))


def with_fold(rows: DataFrame, key: str = "id") -> DataFrame:
    """Add ``fold`` 0..4 from other digits of the same hash."""
    digits = F.substring(_hash_text(key), 9, 8)
    fold = F.lit(0)
    for bound in ("33333333", "66666666", "99999999", "cccccccc"):
        fold = fold + (digits >= bound).cast("int")
    return rows.withColumn("fold", fold)


@dataclass(frozen=True)
class LinearRule:
    """Intercept and coefficients; scoring is a column expression."""

    intercept: float
    coefficients: dict[str, float]

    def predict(self) -> Column:
        value = F.lit(self.intercept)
        for name, weight in self.coefficients.items():
            value = value + F.col(name) * F.lit(weight)
        return value


def fit(rows: DataFrame, features: list[str] = FEATURES, label: str = "revenue") -> LinearRule:
    """Ordinary least squares with an intercept."""
    assembled = VectorAssembler(inputCols=features, outputCol="features").transform(rows)
    data = assembled.select("features", F.col(label).cast("double").alias("label"))
    model = LinearRegression(regParam=0.0, solver="normal").fit(data)
    return LinearRule(float(model.intercept), dict(zip(features, map(float, model.coefficients))))


def score(rows: DataFrame, rule: LinearRule, label: str = "revenue") -> DataFrame:
    """Add prediction, error, absolute error in percent of the label, and a verdict."""
    error = F.col(label) - F.col("predicted_revenue")
    return rows.withColumn("predicted_revenue", rule.predict()).withColumns(
        {
            "prediction_error": error,
            "error_percentage": F.abs(F.try_divide(error, F.col(label)) * 100),
            "performance": performance(error),
        }
    )


def predictions(scored: DataFrame, key: str = "id") -> DataFrame:
    """The scored titles with the columns that are saved."""
    return scored.select(
        key,
        "title",
        "budget",
        "revenue",
        "genres",
        "production_companies",
        "release_year",
        "predicted_revenue",
        "prediction_error",
        "error_percentage",
        "performance",
    )


def split_metrics(scored: DataFrame, label: str = "revenue", by: str = "split") -> DataFrame:
    """R2, mean absolute error and root mean squared error of each split, one pass."""
    error = F.col(label) - F.col("predicted_revenue")
    spread = F.var_pop(label) * F.count(label)
    r2 = 1 - F.try_divide(F.sum(error * error), spread)
    return scored.groupBy(by).agg(
        F.count("*").alias("rows"),
        r2.alias("r2"),
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        (r2 > TARGET_R2).alias("on_target"),
    )


def coefficient_ranking(spark: SparkSession, rule: LinearRule) -> DataFrame:
    """(feature, coefficient), largest absolute coefficient first."""
    rows = list(rule.coefficients.items())
    table = constant_rows(spark, ["feature", "coefficient"], rows)
    return table.orderBy(F.abs("coefficient").desc(), "feature")


def best_and_worst(scored: DataFrame, key: str = "id", n: int = 10) -> DataFrame:
    """The ``n`` titles furthest above and the ``n`` furthest below their prediction."""
    shown = [key, "title", "revenue", "predicted_revenue", "prediction_error"]
    rows = scored.select(*shown)
    above = rows.orderBy(F.desc("prediction_error"), key).limit(n)
    below = rows.orderBy(F.asc("prediction_error"), key).limit(n)
    return above.withColumn("side", F.lit("over")).unionByName(
        below.withColumn("side", F.lit("under"))
    )


def cross_validation(
    rows: DataFrame,
    features: list[str] = FEATURES,
    label: str = "revenue",
    folds: int = FOLDS,
) -> DataFrame:
    """(fold, rows, r2): each fold scored by a fit on the others.

    Sums of products per fold are all a least-squares fit and its error need,
    so the data is read twice in total (scale, then products) however many
    folds there are. Only those sums reach the driver.
    """
    columns = [*features, label]
    stats = rows.agg(
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(columns)],
    ).first()
    scaled = [
        ((F.col(c).cast("double") - stats[f"m{i}"]) / (stats[f"s{i}"] or 1.0)).alias(f"z{i}")
        for i, c in enumerate(columns)
    ]
    width = len(columns) + 1
    terms = [F.lit(1.0)] + [F.col(f"z{i}") for i in range(len(columns))]
    pairs = [(i, j) for i in range(width) for j in range(i, width)]
    sums = (
        rows.select("fold", *scaled)
        .groupBy("fold")
        .agg(*[F.sum(terms[i] * terms[j]).alias(f"p{i}_{j}") for i, j in pairs])
        .collect()  # one row per fold
    )
    products = {}
    for row in sums:
        matrix = np.zeros((width, width))
        for i, j in pairs:
            matrix[i, j] = matrix[j, i] = row[f"p{i}_{j}"]
        products[row["fold"]] = matrix
    total = sum(products.values())
    results = []
    for fold in range(folds):
        held = products.get(fold, np.zeros((width, width)))
        rest = total - held
        weights = np.linalg.lstsq(rest[:-1, :-1], rest[:-1, -1], rcond=None)[0]
        squares = held[-1, -1] - 2 * weights @ held[:-1, -1] + weights @ held[:-1, :-1] @ weights
        n = held[0, 0]
        spread = held[-1, -1] - held[0, -1] ** 2 / n if n else 0.0
        results.append((fold, int(n), float(1 - squares / spread) if spread else None))
    scores = constant_rows(rows.sparkSession, ["fold", "rows", "r2"], results)
    return scores.withColumn("r2", F.col("r2").cast("double"))


def fold_summary(scores: DataFrame) -> DataFrame:
    """One row: mean and population deviation of the fold scores."""
    return scores.agg(F.avg("r2").alias("mean_r2"), F.stddev_pop("r2").alias("std_r2"))
