"""Readers of files, documents and tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from filmdw.operators.staging import part_source
from filmdw.schemas import CLEANED_TEXT, DETAIL, LISTING, RAW_TEXT


def read_csv(
    spark: SparkSession, path: str, schema: StructType = RAW_TEXT, multi_line: bool = False
) -> DataFrame:
    """Delimited file with a header, as text columns.

    A large file is split between tasks. Quoted line breaks need ``multi_line``, which reads a
    file in one task.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("multiLine", multi_line)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def read_cleaned_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    return read_csv(spark, path, CLEANED_TEXT, multi_line)


def read_part(spark: SparkSession, path: str, part: int) -> DataFrame:
    """One numbered part of a dataset written by ``chunk_id``; other parts are not read."""
    part_source(part)
    return spark.read.parquet(path).where(F.col("chunk_id") == part).drop("chunk_id")


def read_listing(spark: SparkSession, path: str) -> DataFrame:
    """Landed listing pages, one document per file."""
    return spark.read.schema(LISTING).option("multiLine", True).json(path)


def read_details(spark: SparkSession, path: str) -> DataFrame:
    """Landed detail documents, one per line."""
    return spark.read.schema(DETAIL).json(path)


def read_detail_text(spark: SparkSession, path: str) -> DataFrame:
    """The same documents unparsed, for callers that route bad ones aside."""
    return spark.read.text(path).withColumnRenamed("value", "json")


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    column: str,
    lower: int,
    upper: int,
    partitions: int,
    **options: str,
) -> DataFrame:
    """External table, read in ranges of ``column`` by parallel tasks."""
    return (
        spark.read.format("jdbc")
        .options(**options)
        .option("url", url)
        .option("dbtable", table)
        .option("partitionColumn", column)
        .option("lowerBound", lower)
        .option("upperBound", upper)
        .option("numPartitions", partitions)
        .load()
    )
