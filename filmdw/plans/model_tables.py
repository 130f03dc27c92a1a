"""Models by name: each is declared with what it reads, and built in the order of those references."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame

from filmdw.fixed_values import STAGING_TABLE
from filmdw.operators import models
from filmdw.operators.quality import model_tests
from filmdw.plans.warehouse import Warehouse


@dataclass(frozen=True)
class Model:
    """``build`` takes the relations of ``reads``, in that order, and the time of the run."""

    name: str
    reads: tuple[str, ...]
    build: Callable[..., DataFrame]
    materialized: str = "table"


MODELS = (
    Model(
        "model_agg_by_genre",
        ("model_fact_movies", "Dim_Genre"),
        lambda fact, genres, as_of: models.agg_by_genre(fact, genres, as_of),
    ),
    Model(
        "model_fact_movies",
        ("stg_movies", "Dim_Genre", "Dim_Time", "Dim_Studio"),
        lambda stg, genres, times, studios, as_of: models.fact_movies(stg, genres, times, studios, as_of),
    ),
    Model("model_dim_genre", ("Dim_Genre",), lambda genres, as_of: models.dim_genre(genres, as_of)),
    Model("stg_movies", (STAGING_TABLE,), lambda staging, as_of: models.stg_movies(staging), "view"),
)


def build_order(declared: Iterable[Model]) -> list[Model]:
    """The models, each after those it reads; a circle of references is an error."""
    by_name = {model.name: model for model in declared}
    graph = {name: [r for r in model.reads if r in by_name] for name, model in sorted(by_name.items())}
    return [by_name[name] for name in TopologicalSorter(graph).static_order()]


def read_model(warehouse: Warehouse, name: str, declared: Iterable[Model] = MODELS) -> DataFrame:
    """A model or table through the catalog; views belong to the session, tables to the database."""
    views = {model.name for model in declared if model.materialized == "view"}
    return warehouse.spark.table(name) if name in views else warehouse.read(name)


def run_models(warehouse: Warehouse, declared: Iterable[Model] = MODELS, as_of: str | None = None) -> list[str]:
    """Build all models; returns their names in the order they were built."""
    order = build_order(declared)
    for model in order:
        rows = model.build(*[read_model(warehouse, name, order) for name in model.reads], as_of)
        if model.materialized == "view":
            rows.createOrReplaceTempView(model.name)
        else:
            warehouse.replace(model.name, rows)
    return [model.name for model in order]


def build_models(warehouse: Warehouse, as_of: str | None = None) -> DataFrame:
    """Build the model variant and return the results of its column tests."""
    run_models(warehouse, as_of=as_of)
    tested = ("stg_movies", "model_dim_genre", "model_fact_movies", "model_agg_by_genre")
    return model_tests(*[read_model(warehouse, name) for name in tested])
