"""Quantiles by refined histograms against sorted values."""

import math
import random

import pytest
from pyspark.sql import functions as F

from filmdw.operators import quantiles
from filmdw.operators.quantiles import exact_median, exact_quantiles

PROBS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0]


def plain(values, p):
    ordered = sorted(v for v in values if v is not None and not math.isnan(v))
    at = (len(ordered) - 1) * p
    low, high = ordered[math.floor(at)], ordered[math.ceil(at)]
    return low + (high - low) * (at - math.floor(at)) if low != high else low


def columns(seed: int, n: int) -> dict[str, list]:
    rng = random.Random(seed)
    return {
        "spread": [rng.choice([-1, 1]) * 10 ** rng.uniform(-300, 300) for _ in range(n)],
        "hot": [7.0 if rng.random() < 0.4 else rng.random() for _ in range(n)],
        "close": [1.0 + rng.randrange(2000) * 2**-52 for _ in range(n)],
        "gaps": [rng.choice([None, math.nan, 3.0, -2.5]) for _ in range(n)],
        "ends": [rng.choice([math.inf, -math.inf, 1.7e308, -1.7e308, 0.0, -0.0]) for _ in range(n)],
        "same": [4.0] * n,
        "zeros": [0.0] * n,
        "tiny": [rng.choice([0.0, 5e-324]) for _ in range(n)],
    }


@pytest.mark.parametrize("n, few", [(1, 20_000), (2, 0), (3000, 0), (3001, 50)])
def test_every_distribution(spark, monkeypatch, few, n):
    monkeypatch.setattr(quantiles, "FEW", few)
    data = columns(n, n)
    rows = list(zip(*data.values()))
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in data)).repartition(6)
    found = {(r["column"], r["prob"]): r["value"] for r in exact_quantiles(df, list(data), PROBS).collect()}
    for name, values in data.items():
        if all(v is None or math.isnan(v) for v in values):
            assert (name, 0.5) not in found
            continue
        for p in PROBS:
            assert found[name, p] == pytest.approx(plain(values, p), rel=1e-12, nan_ok=True), (name, p)


def test_no_values(spark):
    df = spark.createDataFrame([(None, math.nan)], "a int, b double")
    assert exact_quantiles(df, ["a", "b"], [0.5]).count() == 0
    assert exact_quantiles(df.limit(0), ["a"], [0.5]).count() == 0
    assert spark.range(1).select(exact_median(df, "a").alias("m")).first()["m"] is None


def test_other_types(spark):
    df = spark.range(101).select(F.col("id"), (F.col("id") / 4).cast("decimal(10,2)").alias("d"), F.lit("x").alias("t"))
    found = {r["column"]: r["value"] for r in exact_quantiles(df, ["id", "d"], [0.5]).collect()}
    assert found == {"id": 50.0, "d": 12.5}


def test_values_are_counted_in_place(spark, monkeypatch):
    plans = []
    collect = type(spark.range(1)).collect
    monkeypatch.setattr(
        type(spark.range(1)),
        "collect",
        lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or collect(df),
    )
    exact_quantiles(spark.range(100_000).select((F.col("id") % 70_001).alias("v")), ["v"], [0.5])
    assert plans and not any("rangepartitioning" in p for p in plans) and len(plans) < 6
    # rows are summed before they are shuffled
    assert all(p.count("Exchange hashpartitioning") == 0 or "partial_count" in p for p in plans)
