"""Operators on small frames, against plain Python or their own definition."""

import datetime as dt
import random
import statistics

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from filmdw.fixed_values import FEATURES
from filmdw.functions import dates, numbers, status, text
from filmdw.operators import cleaning, delta, forecast, profiling, quality, regression, staging
from filmdw.operators.lookup import fits_broadcast, keep_known, keep_unknown, lookup
from filmdw.operators.quantiles import exact_quantiles
from filmdw.operators.ranking import number_rows
from filmdw.schemas import DETAIL
from filmdw.sources.constants import constant_rows


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


# Expressions


@pytest.mark.parametrize(
    "value, expected",
    [("A-B", ["A", "B"]), ("", [""]), (" A - ", [" A ", " "]), (None, None), ("A--B", ["A", "", "B"])],
)
def test_tokens(spark, value, expected):
    assert one(spark, text.tokens(F.lit(value).cast("string"))) == expected


@pytest.mark.parametrize(
    "value, expected",
    [
        ("Acme-Bob", "Acme"),
        ("Unknown- Bob", "Bob"),
        ("Unknown", None),
        (" - ", None),
        ("", None),
        (None, None),
    ],
)
def test_first_known(spark, value, expected):
    assert one(spark, text.first_known(F.lit(value).cast("string"))) == expected


@pytest.mark.parametrize(
    "value, expected", [("\t A -B", "A"), ("", "Unknown"), (None, "Unknown"), (" -B", "")]
)
def test_primary_token(spark, value, expected):
    assert one(spark, text.primary_token(F.lit(value).cast("string"))) == expected


@pytest.mark.parametrize(
    "name, size",
    [
        ("Walt Disney Pictures", "Large"),
        ("disney", "Small"),
        ("x" * 31, "Medium"),
        ("x" * 30, "Small"),
    ],
)
def test_studio_size(spark, name, size):
    assert one(spark, text.studio_size(F.lit(name))) == size


@pytest.mark.parametrize(
    "value, expected", [("1.5", 1.5), ("x", None), ("NaN", None), ("", None), (None, None)]
)
def test_number(spark, value, expected):
    assert one(spark, numbers.number(F.lit(value).cast("string"))) == expected


def test_long_keys_keep_their_digits(spark):
    assert one(spark, numbers.number(F.lit("9007199254740993"), "bigint")) == 9007199254740993
    assert one(spark, numbers.number(F.lit("12.0"), "bigint")) == 12


def test_dates(spark):
    assert one(spark, dates.lossy_date(F.lit("2001-02-30"))) is None
    assert one(spark, dates.lossy_date(F.lit("2001-02-03"))) == dt.date(2001, 2, 3)
    with pytest.raises(Exception):
        one(spark, dates.strict_date(F.lit("soon")))
    start, end = F.lit("2001-01-01 00:00:00"), F.lit("2001-01-01 00:01:05")
    assert one(spark, dates.seconds_between(start.cast("timestamp"), end.cast("timestamp"))) == 65


@pytest.mark.parametrize(
    "ladder, value, label",
    [
        (status.rule_status, 0.49, "PASS"),
        (status.rule_status, 0.5, "WARNING"),
        (status.rule_status, 5.0, "FAIL"),
        (status.overall_grade, 1.99, "GOOD"),
        (status.overall_grade, 2.0, "ACCEPTABLE"),
        (status.overall_grade, 0.1, "EXCELLENT"),
        (status.overall_grade, 5.0, "POOR"),
        (status.job_status, 4.9, "SUCCESS_WITH_WARNINGS"),
        (status.performance, 0.0, "Under-performing"),
        (status.batch_status, 1.0, "PARTIAL_SUCCESS"),
    ],
)
def test_ladders(spark, ladder, value, label):
    assert one(spark, ladder(F.lit(value))) == label


def test_load_status():
    assert status.load_status(0, 0) == "SUCCESS"
    assert status.load_status(1, 2) == "PARTIAL_SUCCESS"
    assert status.load_status(0, 2) == "FAILED"


def test_percent_of_nothing_is_zero(spark):
    assert one(spark, numbers.percent(F.lit(0), F.lit(0))) == 0.0


def test_constant_rows_quote_text(spark):
    rows = [("it's", 1, 0.1), ("a\\b", None, float("1e300"))]
    assert [tuple(r) for r in constant_rows(spark, ["a", "b", "c"], rows).collect()] == rows


# Numbering and quantiles


def test_number_rows_over_many_partitions(spark):
    names = [f"n{i:05d}" for i in range(2000)]
    random.Random(1).shuffle(names)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame([(n,) for n in names], "name string").repartition(7)
        rows = number_rows(df, ["name"], "k", "test").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert [r["name"] for r in sorted(rows, key=lambda r: r["k"])] == sorted(names)
    assert sorted(r["k"] for r in rows) == list(range(1, 2001))


def test_number_rows_with_one_hot_key(spark):
    df = spark.range(900).select(F.when(F.col("id") < 300, F.lit(7)).otherwise(F.col("id")).alias("k"))
    rows = number_rows(df, ["k"], "n", "test", start=0).collect()
    assert sorted(r["n"] for r in rows) == list(range(900))
    assert [r["k"] for r in sorted(rows, key=lambda r: r["n"])] == sorted(r["k"] for r in rows)


@pytest.mark.parametrize("size", [1, 2, 5, 1001])
def test_quantiles_match_numpy(spark, size):
    rng = random.Random(size)
    data = [(float(rng.randint(0, 50)), rng.random()) for _ in range(size)]
    df = spark.createDataFrame(data + [(None, float("nan"))], "a double, b double")
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    found = {(r["column"], r["prob"]): r["value"] for r in exact_quantiles(df, ["a", "b"], probs).collect()}
    for i, name in enumerate("ab"):
        for p in probs:
            expected = np.quantile([row[i] for row in data], p)
            assert found[name, p] == pytest.approx(expected)


def test_describe_matches_statistics(spark):
    data = [1.0, 2.0, 2.0, 9.0]
    df = spark.createDataFrame([(v,) for v in [*data, None]], "v double")
    row = profiling.describe(df, ["v"]).first()
    assert (row["count"], row["mean"], row["min"], row["max"]) == (4, 3.5, 1.0, 9.0)
    assert row["std"] == pytest.approx(statistics.stdev(data))
    assert (row["p25"], row["p50"], row["p75"]) == (1.75, 2.0, 3.75)


# Lookup


@pytest.mark.parametrize("broadcast_rows", [0, 1000])
def test_lookup_with_hot_and_missing_keys(spark, broadcast_rows):
    left = spark.range(3000).select(
        "id",
        F.when(F.col("id") < 1000, F.lit("hot"))
        .when(F.col("id") < 2000, F.lit(None))
        .otherwise(F.concat(F.lit("k"), F.col("id")))
        .alias("name"),
    )
    names = [("hot", 1)] + [(f"k{i}", i) for i in range(2000, 3000, 2)]
    keys = spark.createDataFrame(names, "name string, key int")
    found = {
        r["id"]: r["key"]
        for r in lookup(left, keys, "name", broadcast_rows, hot_share=100).collect()
    }
    assert len(found) == 3000
    assert all(found[i] == 1 for i in range(1000))
    assert all(found[i] is None for i in range(1000, 2000))
    assert all(found[i] == (i if i % 2 == 0 else None) for i in range(2000, 3000))


def test_broadcast_is_refused_by_rows_and_by_text(spark, monkeypatch):
    keys = spark.createDataFrame([("abc", 1), ("defg", 2)], "name string, k int")
    assert fits_broadcast(keys)
    assert not fits_broadcast(keys, broadcast_rows=1)
    monkeypatch.setattr("filmdw.operators.lookup.BROADCAST_CHARACTERS", 6)
    assert not fits_broadcast(keys)


@pytest.mark.parametrize("broadcast_rows", [0, 1000])
def test_keep_unknown_keeps_rows_without_key(spark, broadcast_rows):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k int, v string")
    keys = spark.createDataFrame([(2,), (None,)], "k int")
    kept = keep_unknown(left, keys, "k", broadcast_rows=broadcast_rows)
    assert sorted(r["v"] for r in kept.collect()) == ["a", "b", "d"]
    kept = keep_known(left, keys, "k", broadcast_rows=broadcast_rows)
    assert [r["v"] for r in kept.collect()] == ["c"]


# Cleaning


RAW = "id string, title string, genres string, original_language string, overview string, " \
    "popularity string, production_companies string, release_date string, budget string, " \
    "revenue string, runtime string, vote_average string, vote_count string"


def raw_row(key, day, budget="10", revenue="20", runtime=None):
    return (key, "t", None, "en", None, "1.5", None, day, budget, revenue, runtime, None, "3")


@pytest.fixture(scope="module")
def raw(spark):
    rows = [
        raw_row("1", "2001-01-01", runtime="90"),
        raw_row("2", "2001-01-02", runtime="100"),
        raw_row("3", "2001-01-03"),
        raw_row("4", "1899-12-31"),
        raw_row("5", "bad"),
        raw_row("6", "2026-01-01"),
        raw_row("7", "2001-01-01", budget="0"),
        raw_row("8", "2001-01-01", revenue="x"),
        raw_row("9", "2001-01-01", budget="1000000001"),
        raw_row("10.0", "1900-01-01", runtime="300"),
    ]
    return spark.createDataFrame(rows, RAW)


def test_clean_movies(raw):
    rows = {r["id"]: r for r in cleaning.clean_movies(raw).collect()}
    assert sorted(rows) == [1, 2, 3, 10]
    assert rows[3]["runtime"] == 100.0  # median of 90, 100, 300
    assert (rows[1]["genres"], rows[1]["overview"], rows[1]["vote_average"]) == ("Unknown", "", 0.0)
    assert (rows[1]["profit"], rows[1]["roi"], rows[1]["release_year"]) == (10.0, 1.0, 2001)


def test_step_counts(raw):
    found = {r["step"]: r["rows"] for r in cleaning.step_counts(raw).collect()}
    assert found == {"too_old_or_undated": 2, "future": 1, "no_money": 2, "outlier": 1, "kept": 4}
    row = cleaning.cleaning_summary(raw).first()
    assert (row["raw_rows"], row["invalid_dates"], row["zero_budget"]) == (10, 1, 1)
    assert row["reduction_pct"] == pytest.approx(60.0)


def test_empty_input_is_counted(raw):
    found = {r["step"]: r["rows"] for r in cleaning.step_counts(raw.limit(0)).collect()}
    assert set(found.values()) == {0}


def test_missing_words(spark):
    df = spark.createDataFrame([("None", 1), ("Nobody", 2)], "title string, n int")
    found = [r["title"] for r in cleaning.missing_words_to_null(df).orderBy("n").collect()]
    assert found == [None, "Nobody"]


def test_staging_rejects_only_bad_rows(raw):
    rows = cleaning.with_derived(cleaning.typed(raw))
    good, bad = staging.split_rejects(staging.staging_rows(rows, strict_dates=False))
    reasons = {r["movie_id"]: r["reject_reason"] for r in bad.collect()}
    assert reasons == {
        5: "release_year,release_month",
        7: "roi",
        8: "revenue,profit,roi",
    }
    assert good.count() == 7


def test_full_load_fails_on_a_bad_date(raw):
    rows = cleaning.with_derived(cleaning.typed(raw)).drop("release_date")
    text_dates = rows.join(raw.select(F.col("id").cast("double").alias("k"), "release_date"), F.col("id") == F.col("k"))
    with pytest.raises(Exception):
        staging.staging_rows(text_dates.drop("k")).collect()


@pytest.mark.parametrize("rows, sizes", [(10, [2, 2, 2, 4]), (3, [0, 0, 0, 3]), (8, [2, 2, 2, 2])])
def test_split_puts_the_remainder_last(spark, rows, sizes):
    parts = staging.split_dataset(spark.range(rows), ["id"]).collect()
    assert [sum(r["chunk_id"] == k for r in parts) for k in (1, 2, 3, 4)] == sizes
    assert [r["id"] for r in sorted(parts, key=lambda r: (r["chunk_id"], r["id"]))] == list(range(rows))


def test_part_source():
    assert staging.part_source(4) == "CSV_chunk_4"
    for bad in (0, 5):
        with pytest.raises(ValueError):
            staging.part_source(bad)


def test_purge_keeps_rows_without_source(spark):
    rows = [("CSV_chunk_1",), ("CSVXchunkX2",), ("CSV",), ("TMDB_API",), (None,)]
    df = spark.createDataFrame(rows, "source string")
    kept = {r["source"] for r in staging.purge_staging(df).collect()}
    assert kept == {"CSV_chunk_1", "CSVXchunkX2", None}


# Documents


DOCUMENTS = {
    "plain": '{"id": 1, "title": "A", "genres": [{"name": "Drama"}, {"name": "War"}],'
    ' "budget": 10, "revenue": 30, "release_date": "2001-02-03",'
    ' "production_countries": [{"iso_3166_1": "FR"}]}',
    "sparse": '{"id": 2, "release_date": ""}',
    "null money": '{"id": 3, "budget": null}',
    "null list": '{"id": 4, "genres": null}',
    "nameless": '{"id": 5, "genres": [{"id": 9}]}',
    "broken": '{"id": 6',
}


def test_details(spark):
    df = spark.createDataFrame([(v,) for v in DOCUMENTS.values()], "json string")
    good, bad = delta.parse_detail_text(df)
    assert bad.count() == 4
    rows = {r["movie_id"]: r for r in delta.parse_details(good, with_countries=True).collect()}
    assert sorted(rows) == [1, 2]
    full, sparse = rows[1], rows[2]
    assert (full["genres"], full["production_companies"]) == ("Drama-War", "Unknown")
    assert (full["profit"], full["roi"], full["countries"]) == (20.0, 2.0, "FR")
    assert (full["release_year"], full["release_month"]) == (2001, 2)
    assert (sparse["title"], sparse["original_language"], sparse["budget"]) == ("", "en", 0.0)
    assert sparse["profit"] is None and sparse["release_date"] is None
    assert (sparse["countries"], sparse["runtime"]) == ("US", None)


def test_delta_load_keeps_repeats_unless_told(spark):
    batch = spark.createDataFrame(
        [(1, "x"), (2, "b"), (2, "a"), (None, "n")], "movie_id bigint, title string"
    )
    staged = spark.createDataFrame([(1,)], "movie_id bigint")
    kept = delta.delta_load(staged, batch).collect()
    assert sorted(r["title"] for r in kept) == ["a", "b", "n"]
    once = delta.delta_load(staged, batch, dedupe=True).collect()
    assert sorted(r["title"] for r in once) == ["a", "n"]


def test_listed_ids(spark):
    df = spark.createDataFrame([([(1,), (2,)],), ([(2,)],)], "results array<struct<id:bigint>>")
    assert sorted(r["movie_id"] for r in delta.listed_ids(df).collect()) == [1, 2, 2]


# Profiles


def test_profiles(spark):
    df = spark.createDataFrame(
        [("a-b", 1.0), ("a", float("nan")), (None, 0.0), ("b ", -0.0)], "g string, v double"
    )
    nulls = {r["column"]: r["missing"] for r in profiling.null_profile(df).collect()}
    assert nulls == {"g": 1, "v": 1}
    distinct = {r["column"]: r["distinct_values"] for r in profiling.distinct_profile(df).collect()}
    assert distinct == {"g": 3, "v": 2}
    counts = {r["value"]: r["count"] for r in profiling.token_counts(df, "g").collect()}
    assert counts == {"a": 2, "b": 1, "b ": 1}
    trimmed = {r["value"]: r["count"] for r in profiling.token_counts(df, "g", trim=True).collect()}
    assert trimmed == {"a": 2, "b": 2}
    about = {r["column"]: r["distinct_values"] for r in profiling.distinct_profile(df, approximate=True).collect()}
    assert about["g"] == 3


def test_decades(spark):
    days = [dt.date(1899, 1, 1), dt.date(1900, 1, 1), dt.date(2029, 12, 31), dt.date(2030, 1, 1), None]
    df = spark.createDataFrame([(d,) for d in days], "release_date date")
    found = {r["decade"]: r["films"] for r in profiling.decade_histogram(df).collect()}
    assert found == {1900: 1, 2020: 1}


def test_duplicate_keys(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (3,), (3,), (3,)], "id int")
    assert tuple(profiling.duplicate_keys(df, "id").first()) == (5, 2)


# Quality


@pytest.fixture(scope="module")
def orphan_case(spark):
    fact = spark.createDataFrame(
        [(1, 1, 1), (9, 1, 1), (9, 2, None), (None, 3, 7)],
        "genre_id bigint, time_id bigint, studio_id bigint",
    ).withColumns({c: F.lit(1.0) for c in ("budget", "revenue", "vote_average", "roi")})
    dims = {
        "genre_id": spark.createDataFrame([(1,)], "genre_id bigint"),
        "time_id": spark.createDataFrame([(1,), (2,)], "time_id bigint"),
        "studio_id": spark.createDataFrame([(1,)], "studio_id bigint"),
    }
    return fact, dims


@pytest.mark.parametrize("broadcast_rows", [0, 1, 1000])
def test_orphans_either_way(orphan_case, broadcast_rows):
    fact, dims = orphan_case
    counts = quality.fact_rule_counts(fact, dims, broadcast_rows)
    found = {r["validation_type"]: r["invalid_records"] for r in counts.collect()}
    assert len(found) == 11
    assert (found["Orphaned genre_id"], found["Orphaned time_id"], found["Orphaned studio_id"]) == (2, 1, 1)
    assert found["NULL genre_id"] == 1 and found["NULL studio_id"] == 1


def test_overall_counts_a_row_once_per_rule(spark):
    report = spark.createDataFrame(
        [("Staging_Movies", "a", 100, 1), ("Staging_Movies", "b", 100, 1), ("Fact_Movies", "c", 100, 0)],
        "table string, validation_type string, total_records bigint, invalid_records bigint",
    )
    row = quality.overall_quality(report).first()
    assert (row["total_records"], row["total_issues"], row["grade"]) == (200, 2, "GOOD")
    assert row["error_message"] == "Data quality: 1.00% invalid records"
    assert quality.top_issues(report).count() == 2


def test_empty_fact_is_no_division_by_zero(orphan_case):
    fact, _ = orphan_case
    assert quality.loss_making(fact.limit(0)).first()["pct"] == 0.0


def test_column_tests(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "name string")
    assert quality.failing_not_null(df, "name").count() == 1
    assert [tuple(r) for r in quality.failing_unique(df, "name").collect()] == [("a", 2)]
    assert not quality.unique_result(df, "t", "name").first()["passed"]


def test_schema_problems(spark):
    df = spark.createDataFrame([("1",)], "budget string")
    problems = quality.schema_problems(df)
    assert "missing id" in problems and "not numeric budget" in problems


def test_formula_match(spark):
    df = spark.createDataFrame(
        [(10.0, 20.0, 10.0, 1.0), (10.0, 20.0, 15.0, 1.0), (0.0, 5.0, 5.0, None)],
        "budget double, revenue double, profit double, roi double",
    )
    row = quality.formula_match(df).first()
    assert (row["profit_pct"], row["roi_pct"]) == (50.0, 50.0)


# Regression and forecast


@pytest.fixture(scope="module")
def regression_rows(spark):
    rng = np.random.default_rng(3)
    values = rng.normal(size=(400, len(FEATURES))) * 10 + 50
    weights = np.arange(1, len(FEATURES) + 1, dtype=float)
    target = values @ weights + 7 + rng.normal(size=400) * 30
    rows = [(i, *map(float, values[i]), float(target[i])) for i in range(400)]
    columns = ["id bigint", *[f"{f} double" for f in FEATURES], "revenue double"]
    return spark.createDataFrame(rows, ", ".join(columns)), values, target


def solve(x, y):
    return np.linalg.lstsq(np.column_stack([np.ones(len(x)), x]), y, rcond=None)[0]


def test_fit_equals_normal_equations(regression_rows):
    df, x, y = regression_rows
    rule = regression.fit(df)
    expected = solve(x, y)
    assert rule.intercept == pytest.approx(expected[0], rel=1e-6)
    assert list(rule.coefficients.values()) == pytest.approx(list(expected[1:]), rel=1e-6)


def test_cross_validation_equals_explicit_fits(regression_rows):
    df, x, y = regression_rows
    rows = regression.with_fold(df)
    folds = {r["id"]: r["fold"] for r in rows.select("id", "fold").collect()}
    member = np.array([folds[i] for i in range(len(y))])
    found = {r["fold"]: r["r2"] for r in regression.cross_validation(rows).collect()}
    for fold in range(5):
        weights = solve(x[member != fold], y[member != fold])
        held = y[member == fold]
        error = held - (weights[0] + x[member == fold] @ weights[1:])
        r2 = 1 - (error**2).sum() / ((held - held.mean()) ** 2).sum()
        assert found[fold] == pytest.approx(r2, rel=1e-8)


def test_split_is_a_fifth_and_stable(spark):
    rows = regression.with_split(spark.range(5000))
    again = regression.with_split(spark.range(5000).repartition(13))
    assert rows.exceptAll(again).count() == 0
    assert 900 < rows.where("split = 'test'").count() < 1100


def test_metrics_and_verdict(spark):
    df = spark.createDataFrame([(1, "t", 10.0, 8.0), (2, "t", 20.0, 23.0)], "id int, split string, revenue double, x double")
    scored = regression.score(df, regression.LinearRule(0.0, {"x": 1.0}))
    rows = {r["id"]: r for r in scored.collect()}
    assert rows[1]["performance"] == "Over-performing" and rows[2]["performance"] == "Under-performing"
    assert rows[2]["error_percentage"] == pytest.approx(15.0)
    m = regression.split_metrics(scored).first()
    assert m["r2"] == pytest.approx(1 - 13 / 50) and m["mae"] == 2.5
    assert m["rmse"] == pytest.approx((13 / 2) ** 0.5)


def test_forecast_interval(spark):
    years = list(range(2010, 2020))
    values = [1.0 + 0.5 * (y - 2010) + (0.3 if y % 2 else -0.3) for y in years]
    df = spark.createDataFrame(list(zip(years, values)), "year int, y double")
    rows = forecast.trend_forecast(df).orderBy("year").collect()
    assert [r["year"] for r in rows] == [2025, 2026, 2027, 2028, 2029]
    x, y = np.array(years, float), np.array(values)
    slope, intercept = np.polyfit(x, y, 1)
    s = np.sqrt(((y - intercept - slope * x) ** 2).sum() / (len(x) - 2))
    half = 1.959963984540054 * s * np.sqrt(1 + 1 / len(x) + (2025 - x.mean()) ** 2 / ((x - x.mean()) ** 2).sum())
    assert rows[0]["predicted_revenue_B"] == pytest.approx(intercept + slope * 2025)
    assert rows[0]["upper_bound_B"] - rows[0]["predicted_revenue_B"] == pytest.approx(half)


def test_forecast_of_two_years_has_no_bounds(spark):
    df = spark.createDataFrame([(2010, 1.0), (2011, 2.0)], "year int, y double")
    row = forecast.trend_forecast(df).orderBy("year").first()
    assert row["predicted_revenue_B"] == pytest.approx(16.0) and row["lower_bound_B"] is None


def test_detail_schema_matches_documents(spark):
    df = spark.createDataFrame([(DOCUMENTS["plain"],)], "json string")
    assert delta.parse_detail_text(df)[0].schema.names == DETAIL.names


# Properties


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(lists=st.lists(st.text(alphabet="ab -U", max_size=8), min_size=1, max_size=20))
def test_list_expressions_equal_plain_python(spark, lists):
    df = spark.createDataFrame(list(enumerate(lists)), "i int, v string")
    v = F.col("v")
    rows = df.select(
        "i", text.tokens(v).alias("t"), text.first_token(v).alias("f"), text.first_known(v).alias("k")
    ).collect()
    for row in rows:
        parts = lists[row["i"]].split("-")
        assert row["t"] == parts and row["f"] == parts[0]
        known = [p.strip(" ") for p in parts if p.strip(" ") not in ("", "Unknown")]
        assert row["k"] == (known[0] if known else None)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.integers(-5, 5), min_size=1, max_size=40))
def test_numbering_and_median_equal_plain_python(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v int").repartition(3)
    numbered = number_rows(df, ["v"], "n", "property").collect()
    assert [r["v"] for r in sorted(numbered, key=lambda r: r["n"])] == sorted(values)
    found = exact_quantiles(df, ["v"], [0.5]).first()["value"]
    assert found == statistics.median(values)
