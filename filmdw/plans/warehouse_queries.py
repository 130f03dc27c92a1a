"""Registered queries over warehouse tables that are built from the order tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

from filmdw.fixed_values import STAGING_TABLE
from filmdw.operators import cleaning, profiling, quality, staging as stages
from filmdw.operators.ranking import dense_keys
from filmdw.plans.model_tables import MODELS, read_model, run_models
from filmdw.plans.warehouse import LOG_TABLE, REJECT_TABLE, Warehouse, run_summary
from filmdw.session import scratch_root, write_stage
from filmdw.sources.bindings import raw_from_orders, staging_from_orders, table
from filmdw.sources.files import read_table
from filmdw.sources.layout import delete_where, write_by
from filmdw.sources.writers import publish

AS_OF = "2001-01-01"


def _folder(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/filmdw/{label}-{uuid.uuid4().hex}"


@contextmanager
def _warehouse(spark: SparkSession) -> Iterator[Warehouse]:
    """An empty warehouse whose tables leave the catalog at the end; its files stay for what was read."""
    house = Warehouse(spark, _folder(spark, "warehouse"), f"film_{uuid.uuid4().hex[:12]}")
    house.create_schema()
    try:
        yield house
    finally:
        spark.sql(f"DROP DATABASE {house.database} CASCADE")


def _full(house: Warehouse, sf_dir: str) -> None:
    house.stage_full(staging_from_orders(house.spark, sf_dir))


def warehouse_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every table of a rebuilt warehouse with its rows and its last key."""
    keys = {
        "staging_movies": "staging_id",
        "dim_genre": "genre_id",
        "dim_time": "time_id",
        "dim_country": "country_id",
        "dim_studio": "studio_id",
        "fact_movies": "fact_id",
        "agg_genre_performance": "agg_id",
        "agg_yearly_trends": "agg_id",
        "etl_log": "log_id",
    }
    with _warehouse(spark) as house:
        _full(house, sf_dir)
        house.rebuild(AS_OF)
        counted = [
            read_table(spark, house.name(name)).select(
                F.lit(name).alias("table_name"), F.col(keys[name]).alias("key") if name in keys else F.lit(None)
            ).toDF("table_name", "key").groupBy("table_name").agg(
                F.count("*").alias("rows"), F.max("key").cast("bigint").alias("last_key")
            )
            for name in [r["table_name"] for r in house.tables().collect()]
        ]
        return write_stage(stages.append_sources(*counted), "tables")


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a rebuild logs, in order."""
    with _warehouse(spark) as house:
        _full(house, sf_dir)
        house.rebuild(AS_OF)
        log = house.read(LOG_TABLE)
        summary = run_summary(log).select("job_name", "start_time", "outcome", (F.col("seconds") >= 0).alias("timed"))
        both = log.join(summary, ["job_name", "start_time"])
        return write_stage(both.select("log_id", "job_name", "rows_processed", "rows_failed", "outcome", "timed"), "log")


def warehouse_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Uncleaned titles loaded in four parts, the first one twice: what was loaded, put aside, skipped."""
    raw = cleaning.with_derived(cleaning.typed(raw_from_orders(spark, sf_dir)))
    raw = write_stage(raw.withColumn("part", 1 + F.pmod("id", F.lit(4))), "raw")
    with _warehouse(spark) as house:
        for part in (1, 2, 3, 4, 1):
            house.load_part(raw.where(F.col("part") == part).drop("part"), part, AS_OF)
        aside = house.read(REJECT_TABLE).groupBy("source").agg(F.count("*").alias("aside"))
        keys = house.read(STAGING_TABLE).groupBy("source").agg(F.count("staging_id").alias("staged"))
        log = house.read(LOG_TABLE).select(
            "log_id", "status", "rows_processed", "rows_failed",
            F.concat(F.lit("CSV_chunk_"), F.regexp_extract("job_name", r"\d", 0)).alias("source"),
        )
        rows = log.join(keys, "source", "left").join(aside, "source", "left")
        return write_stage(rows, "parts")


def staging_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys after a full load and two appends of two parts each: the range of each part and of all."""
    rows = write_stage(staging_from_orders(spark, sf_dir), "staging")
    part = lambda *numbers: rows.where(F.col("source").isin([stages.part_source(n) for n in numbers]))
    with _warehouse(spark) as house:
        house.stage_full(part(1, 2).repartition(7))
        house.stage_batch(part(3).repartition(5))
        house.stage_batch(part(4).repartition(3))
        loads = F.greatest(F.substring("source", -1, 1).cast("int"), F.lit(2)).alias("load")
        keys = house.read(STAGING_TABLE).groupBy(loads).agg(
            F.count("*").alias("rows"),
            F.countDistinct("staging_id").alias("keys"),
            F.min("staging_id").alias("first_key"),
            F.max("staging_id").alias("last_key"),
        )
        return write_stage(keys, "keys")


def dense_fact_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of lines dealt at random over many partitions, one of them empty: no gaps, no repeats."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    spread = lines.repartition(13, "l_orderkey").unionByName(lines.limit(0))
    keys = dense_keys(spread, "line_key", after=100)
    return keys.agg(
        F.count("*").alias("rows"),
        F.countDistinct("line_key").alias("keys"),
        F.min("line_key").alias("first_key"),
        F.max("line_key").alias("last_key"),
    )


def warehouse_generations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Generations of the fact after two rebuilds and a write that fails, before and after old ones go."""
    rows = staging_from_orders(spark, sf_dir, ()).select("movie_id", "revenue")
    with _warehouse(spark) as house:
        name = "Facts"
        for least in (0, 200_000):
            house.replace(name, rows.where(F.col("revenue") >= least))
        try:
            bad = F.when(F.col("revenue") > 0, F.raise_error(F.lit("broken off")).cast("double"))
            house.replace(name, rows.withColumn("revenue", bad))
        except Exception:  # the write is meant to fail
            pass

        def state(when: str) -> DataFrame:
            kept = house.generations(name).agg(
                F.count_if("complete").alias("complete"), F.count_if("current").alias("current")
            )
            now = house.read(name).agg(F.count("*").alias("rows"), F.round(F.sum("revenue"), 2).alias("revenue"))
            return write_stage(kept.join(now).select(F.lit(when).alias("state"), "*"), "state")

        before = state("before")
        house.drop_generations(name)
        return before.unionByName(state("after"))


def model_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four models built in the order of their references and read through the catalog."""
    with _warehouse(spark) as house:
        _full(house, sf_dir)
        house.load_dimensions(AS_OF)
        run_models(house, as_of=AS_OF)
        counted = [
            read_model(house, model.name).agg(F.count("*").alias("rows")).select(F.lit(model.name).alias("model"), "rows")
            for model in MODELS
        ]
        return write_stage(stages.append_sources(*counted), "models")


def purge_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging by source: whole sources of other kinds go, and of part 4 the titles without revenue."""
    parts = staging_from_orders(spark, sf_dir, ()).select("movie_id", "revenue", "source")
    other = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("movie_id"), F.col("c_acctbal").cast("double").alias("revenue"), F.lit("CSV").alias("source")
    )
    untagged = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("bigint").alias("movie_id"), F.lit(0.0).alias("revenue"), F.lit(None).cast("string").alias("source")
    )
    path = _folder(spark, "by-source")
    write_by(stages.append_sources(parts, other, untagged), path, "source")
    stale = ~F.col("source").like("CSV_chunk_%") | ((F.col("source") == "CSV_chunk_4") & (F.col("revenue") <= 0))
    delete_where(spark, path, "source", stale)
    rows = spark.read.parquet(path)
    return rows.groupBy("source").agg(F.count("*").alias("rows"), F.round(F.sum("revenue"), 2).alias("revenue"))


def publish_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dataset published, published again over itself, and read back."""
    rows = staging_from_orders(spark, sf_dir, ()).select("movie_id", "title", "revenue")
    path = _folder(spark, "published")
    publish(rows.where("revenue > 0"), path)
    publish(rows, path)
    return spark.read.parquet(path)


def schema_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Required columns that tables lack, and measures that are not numbers, with the rows concerned."""
    titles = cleaning.clean_movies(write_stage(raw_from_orders(spark, sf_dir), "raw"))
    given = {
        "cleaned": titles,
        "text": titles.withColumns({c: F.col(c).cast("string") for c in ("budget", "roi")}).drop("profit"),
        "customer": table(spark, sf_dir, "customer").withColumnRenamed("c_name", "title"),
    }
    found = []
    for name, rows in given.items():
        problems = F.array(*map(F.lit, quality.schema_problems(rows))).cast("array<string>")
        counted = rows.agg(F.count("*").alias("rows"))
        found.append(counted.select(F.lit(name).alias("table"), F.explode(problems).alias("problem"), "rows"))
    return stages.append_sources(*found)


def profile_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first rows of a table as it lies in its file."""
    return profiling.first_rows(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"), 5)


QUERIES = {
    query.__name__: query
    for query in (
        warehouse_rebuild,
        run_log,
        warehouse_parts,
        staging_keys,
        dense_fact_keys,
        warehouse_generations,
        model_tables,
        purge_partitions,
        publish_round_trip,
        schema_report,
        profile_head,
    )
}
