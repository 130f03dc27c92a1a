"""Batches to the staging table: defaults, rejects, load-once, parts and purge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from filmdw.fixed_values import (
    DATASET_PARTS,
    FULL_LOAD_SOURCE,
    PART_SOURCE_PREFIX,
    STAGING_DEFAULTS,
)
from filmdw.functions.dates import loaded_at, lossy_date, strict_date
from filmdw.operators.lookup import keep_unknown
from filmdw.operators.ranking import number_rows
from filmdw.schemas import STAGING


def part_source(part: int) -> str:
    """Source tag of one numbered part; only 1..4 exist."""
    if part not in range(1, DATASET_PARTS + 1):
        raise ValueError(f"part must be 1..{DATASET_PARTS}, got {part}")
    return f"{PART_SOURCE_PREFIX}{part}"


def fill_defaults(rows: DataFrame) -> DataFrame:
    return rows.na.fill({c: v for c, v in STAGING_DEFAULTS.items() if c in rows.columns})


def staging_rows(
    cleaned: DataFrame,
    source: str | Column = FULL_LOAD_SOURCE,
    as_of: str | None = None,
    strict_dates: bool = True,
) -> DataFrame:
    """Map cleaned titles to the staging columns.

    A full load fails on a bad date (``strict_dates``), a part load makes it NULL.
    """
    parse = strict_date if strict_dates else lossy_date
    tag = F.lit(source) if isinstance(source, str) else source
    rows = fill_defaults(cleaned).withColumnsRenamed({"id": "movie_id"})
    rows = rows.withColumns(
        {"release_date": parse(F.col("release_date")), "source": tag, "load_date": loaded_at(as_of)}
    )
    return rows.select(*[F.col(f.name).cast(f.dataType) for f in STAGING])


def split_rejects(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(loadable, rejected with a reason): a row without a required value is rejected.

    Only the bad rows are kept out, not the batch they arrived in.
    """
    required = ["movie_id", "budget", "revenue", "profit", "roi", "release_year", "release_month"]
    missing = F.array_compact(
        F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in required])
    )
    checked = rows.withColumn("reject_reason", F.array_join(missing, ","))
    good = checked.where(F.col("reject_reason") == "").drop("reject_reason")
    return good, checked.where(F.col("reject_reason") != "")


def load_once(staging: DataFrame, batch: DataFrame) -> DataFrame:
    """Rows of ``batch`` whose source tag is not in ``staging`` yet."""
    return keep_unknown(batch, staging, "source")


def append_sources(*batches: DataFrame) -> DataFrame:
    """All batches in one frame; a column a batch lacks is NULL."""
    rows, *others = batches
    for batch in others:
        rows = rows.unionByName(batch, allowMissingColumns=True)
    return rows


def purge_staging(staging: DataFrame) -> DataFrame:
    """Keep part loads only; rows without a source are not matched and stay."""
    stale = ~F.col("source").like(f"{PART_SOURCE_PREFIX}%")
    return staging.where(~F.coalesce(stale, F.lit(False)))


def rows_per_source(staging: DataFrame) -> DataFrame:
    return staging.groupBy("source").agg(F.count("*").alias("rows"))


def purge_report(staging: DataFrame) -> DataFrame:
    """(source, rows, purged) for every source, in one pass."""
    stale = ~F.col("source").like(f"{PART_SOURCE_PREFIX}%")
    return rows_per_source(staging).withColumn("purged", F.coalesce(stale, F.lit(False)))


def split_dataset(rows: DataFrame, order_by: list[str], parts: int = DATASET_PARTS) -> DataFrame:
    """Add ``chunk_id``: equal positional parts, the remainder in the last one."""
    placed = number_rows(rows, order_by, "_row", label="split", start=0)
    size = F.floor(placed.agg(F.count("*")).scalar() / parts)
    # with fewer rows than parts all rows are in the last part
    chunk = F.when(size == 0, parts - 1).otherwise(
        F.least(F.floor(F.try_divide(F.col("_row"), size)), F.lit(parts - 1))
    )
    return placed.select((chunk + 1).cast("int").alias("chunk_id"), *rows.columns)
