"""Names that are equal but for case and trailing blanks."""

import pytest

from filmdw.functions.text import CASELESS
from filmdw.operators.dimensions import build_dim_genre, build_dim_studio
from filmdw.operators.lookup import first_match, lookup
from filmdw.operators.quality import failing_unique, unique_result


@pytest.fixture(scope="module")
def staging(spark):
    lists = ["Drama-comedy", "DRAMA - Comedy", "drama", "Unknown-Ünder", "ÜNDER", None, " -"]
    studios = ["Acme-Bob", "ACME", "bob ", "unknown", "Unknown", None, ""]
    return spark.createDataFrame(list(zip(lists, studios)), "genres string, production_companies string")


def test_each_name_once_with_its_first_spelling(staging):
    found = [tuple(r) for r in build_dim_genre(staging, collation=CASELESS).orderBy("genre_id").collect()]
    assert [r[:2] for r in found] == [(1, "Comedy"), (2, "DRAMA"), (3, "Unknown"), (4, "ÜNDER")]
    assert build_dim_genre(staging).count() == 8
    studios = build_dim_studio(staging, collation=CASELESS).orderBy("studio_id").collect()
    assert [(r["studio_id"], r["studio_name"]) for r in studios] == [(1, "Unknown"), (2, "ACME"), (3, "Bob")]


@pytest.mark.parametrize("broadcast_rows", [0, 1000])
def test_lookup_keeps_the_spelling_of_the_left(spark, broadcast_rows):
    left = spark.createDataFrame([("drama ",), ("DRAMA",), ("Drama  ",), (" drama",), (None,)] * 300, "name string")
    keys = spark.createDataFrame([("Drama", 1), ("Comedy", 2)], "name string, id int")
    found = lookup(left, keys, "name", broadcast_rows, collation=CASELESS)
    assert found.columns == ["name", "id"] and found.count() == 1500
    assert {tuple(r) for r in found.collect()} == {
        ("drama ", 1), ("DRAMA", 1), ("Drama  ", 1), (" drama", None), (None, None)
    }
    assert lookup(left, keys, "name", broadcast_rows).where("id IS NOT NULL").count() == 0


def test_one_failure_for_all_spellings(spark):
    rows = spark.createDataFrame([("a",), ("A ",), ("b",), (None,), (None,), ("B",), ("c",)], "v string")
    found = {tuple(r) for r in failing_unique(rows, "v", CASELESS).collect()}
    assert found == {("A ", 2), ("B", 2)}
    assert unique_result(rows, "t", "v", CASELESS).first()["failures"] == 2
    assert unique_result(rows, "t", "v").first()["passed"]


def test_lowest_key_of_all_spellings(spark):
    keys = spark.createDataFrame([("a", 5), ("A ", 3), ("b", 1)], "name string, id int")
    assert {tuple(r) for r in first_match(keys, "name", "id", CASELESS).collect()} == {("A ", 3), ("b", 1)}
    assert first_match(keys, "name", "id").count() == 3
