"""Dense keys, generations of tables, deletes by predicate, and models in the order of references."""

import os
from graphlib import CycleError

import pytest
from pyspark.sql import functions as F

from filmdw.operators import ranking
from filmdw.operators.ranking import dense_keys, number_rows
from filmdw.plans.model_tables import MODELS, Model, build_order
from filmdw.plans.warehouse import Warehouse
from filmdw.sources.layout import delete_where, write_by


@pytest.mark.parametrize("group", [1, 3, 1000])
def test_keys_have_no_gaps(spark, monkeypatch, group):
    monkeypatch.setattr(ranking, "_GROUP", group)
    rows = spark.range(1000).repartition(11).where("id % 7 < 3").unionByName(spark.range(0))
    found = dense_keys(rows, "k", after=5).collect()
    n = rows.count()
    assert sorted(r["k"] for r in found) == list(range(6, 6 + n)) and len({r["id"] for r in found}) == n
    assert dense_keys(rows.limit(0), "k").count() == 0
    ordered = number_rows(rows, ["id"], "place", "test", unique=True).collect()
    assert [r["id"] for r in sorted(ordered, key=lambda r: r["place"])] == sorted(r["id"] for r in ordered)


def test_numbering_collects_nothing(spark, monkeypatch):
    collect = type(spark.range(1)).collect
    monkeypatch.setattr(type(spark.range(1)), "collect", lambda df: pytest.fail("rows came to the driver"))
    rows = dense_keys(spark.range(100).repartition(4), "k")
    monkeypatch.setattr(type(rows), "collect", collect)
    assert rows.agg(F.sum("k")).first()[0] == 5050


@pytest.fixture
def house(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path / "house"), "film_generations")
    spark.sql("CREATE DATABASE IF NOT EXISTS film_generations")
    yield house
    spark.sql("DROP DATABASE film_generations CASCADE")


def test_a_failed_write_leaves_the_table(spark, house):
    house.replace("T", spark.range(5))
    held = house.read("T")
    house.replace("T", spark.range(8))
    assert house.read("T").count() == 8 and held.count() == 5
    with pytest.raises(Exception, match="broken"):
        house.replace("T", spark.range(3).withColumn("id", F.raise_error(F.lit("broken")).cast("bigint")))
    assert house.read("T").count() == 8
    states = [tuple(r)[1:] for r in house.generations("T").collect()]
    assert states[:2] == [(True, False), (True, True)] and all(s == (False, False) for s in states[2:])
    assert house.drop_generations("T", keep=2) == 0
    assert house.drop_generations("T") == 1 and house.read("T").count() == 8
    house.replace("T", spark.range(9))
    # what a failed write left goes with the generations before the current one
    assert house.drop_generations("T") >= 1 and house.generations("T").count() == 1
    assert house.append("T", spark.range(1)) == 1 and house.read("T").count() == 10
    assert house.drop_generations("T") == 0 and house.drop_generations("none") == 0


def files_of(path) -> dict[str, float]:
    return {str(p): p.stat().st_mtime_ns for p in path.rglob("*.parquet")}


def test_untouched_partitions_keep_their_files(spark, tmp_path):
    path = tmp_path / "rows"
    names = ["a", "b/c %x=1", "d", None]
    rows = spark.range(400).select("id", F.element_at(F.array(*map(F.lit, names)), (F.col("id") % 4 + 1).cast("int")).alias("s"))
    write_by(rows, str(path), "s")
    before = files_of(path)
    gone = (F.col("s") == "b/c %x=1") | ((F.col("s") == "d") & (F.col("id") < 200)) | (F.col("s").isNull() & (F.col("id") < 40))
    done = delete_where(spark, str(path), "s", gone)
    assert (done.rows, done.rewritten, done.dropped) == (100 + 50 + 10, 2, 1)
    left = {s: n for s, n in spark.read.parquet(str(path)).groupBy("s").count().collect()}
    assert left == {"a": 100, "d": 50, None: 90}
    after = files_of(path)
    assert {k: v for k, v in before.items() if "/s=a/" in k} == {k: v for k, v in after.items() if "/s=a/" in k}
    assert delete_where(spark, str(path), "s", gone) == type(done)(0, 0, 0) and files_of(path) == after
    # a condition that is NULL deletes nothing
    assert delete_where(spark, str(path), "s", F.lit(None).cast("boolean")).rows == 0
    assert not any("b%2Fc" in name for name in os.listdir(path))


def test_models_follow_their_references():
    order = [m.name for m in build_order(MODELS)]
    assert order.index("stg_movies") < order.index("model_fact_movies") < order.index("model_agg_by_genre")
    assert order == [m.name for m in build_order(reversed(MODELS))]
    circle = [Model("a", ("b",), None), Model("b", ("a",), None)]
    with pytest.raises(CycleError):
        build_order(circle)
