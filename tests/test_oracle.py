"""Every registered query against its SQL twin, and the shape of key plans."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from filmdw.operators import aggregates, dimensions, quality
from filmdw.operators.fact import build_fact
from filmdw.plans import oracle
from filmdw.plans.queries import QUERIES
from filmdw.session import write_stage
from filmdw.sources.bindings import staging_from_orders
from tests.oracle_check import connect, difference

SF = "/root/testdata/sf0.001"
ORACLE = {name: oracle.sql(name) for name in QUERIES if name in oracle.FINAL}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    plan = plan_of(df)
    for operator in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct"):
        assert operator not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert difference(df, duck, ORACLE[name]) is None


def test_fitted_models(spark):
    metrics = {r["split"]: r for r in QUERIES["linear_regression"](spark, SF).collect()}
    assert set(metrics) == {"train", "test"} and metrics["train"]["r2"] <= 1
    ranking = [abs(r["coefficient"]) for r in QUERIES["coefficient_ranking"](spark, SF).collect()]
    assert len(ranking) == 9 and ranking == sorted(ranking, reverse=True)
    assert QUERIES["cross_validation"](spark, SF).count() == 5


def test_entry(spark):
    assert contract.entry(spark).count() > 0
    assert QUERIES.items() <= contract.queries().items() and ORACLE.items() <= contract.oracle_sql().items()


@pytest.fixture(scope="module")
def staged(spark):
    staging = write_stage(staging_from_orders(spark, SF), "plan")
    return staging, {
        "genres": dimensions.build_dim_genre(staging),
        "times": dimensions.build_dim_time(staging),
        "countries": dimensions.build_dim_country(staging),
        "studios": dimensions.build_dim_studio(staging),
    }


def test_fact_needs_no_shuffle_of_the_titles(staged):
    staging, dims = staged
    plan = plan_of(build_fact(staging, **dims))
    assert plan.count("BroadcastHashJoin") == 4
    assert "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan
    assert "PushedFilters: [IsNotNull(budget), IsNotNull(revenue), IsNotNull(release_date)" in plan
    assert "overview" not in plan


def test_genre_aggregate_spreads_a_hot_genre(staged):
    staging, dims = staged
    fact = build_fact(staging, genres=dims["genres"])
    plan = plan_of(aggregates.aggregate_by_genre(fact, dims["genres"]))
    # distinct titles are counted on (genre, title) before the genre alone
    assert re.search(r"Exchange hashpartitioning\(genre_id#\d+L, movie_id#\d+L", plan)
    assert "Expand" not in plan


def test_rules_read_each_table_once(staged):
    staging, dims = staged
    fact = write_stage(build_fact(staging, **dims), "fact")
    keys = {"genre_id": dims["genres"], "time_id": dims["times"], "studio_id": dims["studios"]}
    rules = quality.fact_rule_counts(fact, keys)
    # the fact once and each dimension once, however long their paths are
    assert plan_of(rules).count("FileScan") + plan_of(rules).count("LocalTableScan") == 1 + len(keys)
    plan = plan_of(quality.staging_rule_counts(staging))
    assert plan.count("FileScan") == 1


def test_every_query_reads_a_given_table(spark):
    for name in ORACLE:
        assert re.search(
            r"\b(orders|lineitem|customer|supplier|part|events|documents|labels|nation)\b", ORACLE[name]
        )


def test_years_of_the_binding(spark):
    row = staging_from_orders(spark, SF, ()).agg(F.min("release_year"), F.max("release_year")).first()
    assert 1980 <= row[0] <= row[1] <= 2024
