"""The six-title case, through staging, dimensions, fact, aggregates and models."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from filmdw.operators import aggregates, dimensions, models
from filmdw.operators.fact import build_fact, null_key_counts, top_revenue
from filmdw.operators.quality import model_tests, quality_report
from filmdw.schemas import STAGING
from filmdw.session import write_stage

TITLES = [
    (1, "A", "Drama-Action", "en", "Warner Bros-Acme", dt.date(2001, 5, 4), 100.0, 300.0),
    (2, "B", "Drama", "fr", "Unknown", dt.date(2001, 6, 1), 50.0, 20.0),
    (3, "C", " Action - ", "ja", "Acme", dt.date(2002, 1, 1), 10.0, 10.0),
    (4, "D", "Unknown", "zz", "Unknown-Bob", dt.date(2002, 1, 1), 5.0, 50.0),
    (5, "E", "Drama", "en", "Metro-Goldwyn-Mayer", None, 20.0, 40.0),
    (6, "F", "Action", "en", "Acme", dt.date(2001, 5, 4), 0.0, 100.0),
]


@pytest.fixture(scope="module")
def star(spark):
    rows = spark.createDataFrame(
        TITLES,
        "movie_id bigint, title string, genres string, original_language string, "
        "production_companies string, release_date date, budget double, revenue double",
    )
    rows = rows.withColumns(
        {
            "profit": F.col("revenue") - F.col("budget"),
            "roi": F.try_divide(F.col("revenue") - F.col("budget"), F.col("budget")),
        }
    )
    missing = [f for f in STAGING if f.name not in rows.columns]
    rows = rows.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing})
    staging = write_stage(rows.select(*[f.name for f in STAGING]), "golden")
    dims = {
        "genres": dimensions.build_dim_genre(staging),
        "times": dimensions.build_dim_time(staging),
        "countries": dimensions.build_dim_country(staging),
        "studios": dimensions.build_dim_studio(staging),
    }
    return {"staging": staging, **dims, "fact": build_fact(staging, **dims)}


def tuples(df, *columns):
    return [tuple(row) for row in df.select(*columns).collect()]


def test_genres(star):
    found = tuples(star["genres"].orderBy("genre_id"), "genre_id", "genre_name")
    assert found == [(1, "Action"), (2, "Drama"), (3, "Unknown")]


def test_days(star):
    times = star["times"]
    assert times.count() == 243
    first = times.orderBy("time_id").first()
    assert (first["time_id"], first["full_date"]) == (1, dt.date(2001, 5, 4))
    assert (first["month_name"], first["day_name"], first["day_of_week"]) == ("May", "Friday", 5)
    assert not first["is_weekend"] and first["quarter"] == 2
    last = times.orderBy(F.desc("time_id")).first()
    assert (last["time_id"], last["full_date"]) == (243, dt.date(2002, 1, 1))


def test_countries(star):
    found = tuples(
        star["countries"].orderBy("country_id"), "country_id", "country_code", "country_name"
    )
    assert found == [
        (1, "UNK", "Unknown"),
        (2, "US", "United States"),
        (3, "FR", "France"),
        (4, "JP", "Japan"),
        (5, "ZZ", "Language: zz"),
    ]


def test_studios(star):
    found = tuples(star["studios"].orderBy("studio_id"), "studio_name", "studio_size")
    assert found == [
        ("Unknown", "Unknown"),
        ("Acme", "Small"),
        ("Bob", "Small"),
        ("Goldwyn", "Small"),
        ("Mayer", "Small"),
        ("Metro", "Small"),
        ("Warner Bros", "Large"),
    ]


def test_fact(star):
    found = tuples(
        star["fact"].orderBy("movie_id", F.asc_nulls_last("genre_id")),
        *("movie_id", "genre_id", "time_id", "country_id", "studio_id", "profit", "roi"),
    )
    assert found == [
        (1, 1, 1, 1, 7, 200.0, 2.0),
        (1, 2, 1, 1, 7, 200.0, 2.0),
        (3, 1, 243, 1, 2, 0.0, 0.0),
        (3, None, 243, 1, 2, 0.0, 0.0),
        (4, 3, 243, 5, 3, 45.0, 9.0),
    ]


def test_fact_by_language_finds_countries(star):
    dims = {k: star[k] for k in ("genres", "times", "countries", "studios")}
    fact = build_fact(star["staging"], **dims, country_mode="language")
    found = dict(tuples(fact.distinct(), "movie_id", "country_id"))
    assert found == {1: 2, 3: 4, 4: 5}


def test_fact_takes_lowest_key_of_a_repeated_name(star):
    doubled = star["genres"].select("genre_id", "genre_name").unionByName(
        star["genres"].select((F.col("genre_id") + 100).alias("genre_id"), "genre_name")
    )
    fact = build_fact(star["staging"], genres=doubled, unique_names=False)
    assert fact.count() == 5 and fact.agg(F.max("genre_id")).first()[0] == 3


def test_fact_is_the_same_without_broadcasts(star, monkeypatch):
    monkeypatch.setattr("filmdw.operators.lookup.BROADCAST_ROWS", 0)
    dims = {k: star[k] for k in ("genres", "times", "countries", "studios")}
    again = build_fact(star["staging"], **dims)
    columns = [c for c in again.columns if c != "created_date"]
    assert sorted(tuples(again, *columns), key=repr) == sorted(tuples(star["fact"], *columns), key=repr)


def test_unknown_country_mode(star):
    with pytest.raises(ValueError):
        build_fact(star["staging"], countries=star["countries"], country_mode="x")


def test_null_keys(star):
    row = null_key_counts(star["fact"]).first()
    assert (row["fact_rows"], row["null_genre_id"], row["null_time_id"]) == (5, 1, 0)


def test_genre_aggregate(star):
    rows = aggregates.aggregate_by_genre(star["fact"], star["genres"]).orderBy("genre_id")
    found = tuples(
        rows, "genre_name", "total_films", "total_revenue", "total_budget", "avg_revenue", "avg_roi"
    )
    assert found == [
        ("Action", 2, 310.0, 110.0, 155.0, 1.0),
        ("Drama", 1, 300.0, 100.0, 300.0, 2.0),
        ("Unknown", 1, 50.0, 5.0, 50.0, 9.0),
    ]


def test_yearly_aggregate_counts_money_per_genre_row(star):
    rows = aggregates.aggregate_by_year(star["fact"], star["times"]).orderBy("year")
    found = tuples(rows, "year", "total_films", "total_revenue", "total_budget", "avg_roi")
    assert found == [(2001, 1, 600.0, 200.0, 2.0), (2002, 2, 70.0, 25.0, 3.0)]
    assert rows.collect()[1]["avg_revenue"] == pytest.approx(70 / 3)


def test_top_revenue(star):
    rows = top_revenue(star["fact"], star["genres"], star["times"], 3)
    assert tuples(rows.orderBy(F.desc("revenue"), "genre_name"), "title", "genre_name", "year") == [
        ("A", "Action", 2001),
        ("A", "Drama", 2001),
        ("D", "Unknown", 2002),
    ]


def test_models(star):
    stg = models.stg_movies(star["staging"])
    assert sorted(tuples(stg, "movie_id")) == [(1,), (2,), (3,), (4,), (5,)]
    fact = models.fact_movies(stg, star["genres"], star["times"], star["studios"])
    found = {row["movie_id"]: row for row in fact.collect()}
    assert {k: v["studio_id"] for k, v in found.items()} == {1: 7, 2: 1, 3: 2, 4: 1, 5: 6}
    assert found[3]["genre_id"] is None and found[5]["time_id"] is None
    by_genre = models.agg_by_genre(fact, star["genres"])
    groups = {r["genre_name"]: (r["total_films"], r["total_revenue"]) for r in by_genre.collect()}
    assert groups == {"Drama": (3, 360.0), "Unknown": (1, 50.0), None: (1, 10.0)}
    genre_names = models.dim_genre(star["genres"])
    assert sorted(tuples(genre_names, "genre_name")) == [("Action",), ("Drama",)]
    results = model_tests(stg, genre_names, fact, by_genre).collect()
    assert len(results) == 11
    failed = [(r["table"], r["column"], r["test"]) for r in results if not r["passed"]]
    assert failed == [("agg_by_genre", "genre_name", "not_null")]


def test_quality_report(star):
    report = quality_report(
        star["staging"], star["fact"], star["genres"], star["times"], star["studios"], "2001-12-31"
    )
    rows = {(r["table"], r["validation_type"]): r for r in report.collect()}
    assert len(rows) == 19
    assert rows["Staging_Movies", "Future release dates"]["invalid_records"] == 2
    assert rows["Fact_Movies", "NULL genre_id"]["invalid_records"] == 1
    assert rows["Fact_Movies", "NULL genre_id"]["status"] == "FAIL"
    assert rows["Fact_Movies", "Orphaned studio_id"]["status"] == "PASS"
    assert all(r["description"] for r in rows.values())
