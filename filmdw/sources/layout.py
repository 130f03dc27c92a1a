"""Datasets laid out in a folder for each value of a column, and deletes from them by predicate."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from filmdw.session import write_stage


def write_by(df: DataFrame, path: str, column: str) -> None:
    """One folder per value of ``column``; the dataset is replaced."""
    df.write.mode("overwrite").partitionBy(column).parquet(path)


@dataclass(frozen=True)
class Deleted:
    rows: int
    rewritten: int
    dropped: int


def _read(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def delete_where(spark: SparkSession, path: str, column: str, condition: Column) -> Deleted:
    """Delete the rows of a dataset laid out by ``column`` for which the condition holds.

    Only partitions that hold such rows are touched: those with rows left are written anew, each replaced
    as a whole, and those without are removed. Files of all others stay as they are. A row for which the
    condition is NULL stays. If a run fails before a partition is replaced, that partition keeps all its
    rows, and the delete can be run again. One pair of counts per partition reaches the driver.
    """
    schema = spark.read.parquet(path).schema
    rows = _read(spark, path, schema)
    gone = F.coalesce(condition, F.lit(False))
    folder = F.regexp_extract("_metadata.file_path", "^(.*)/[^/]*$", 1)
    counts = (
        rows.select(folder.alias("folder"), F.col(column).alias("value"), gone.alias("gone"))
        .groupBy("folder", "value")
        .agg(F.count_if("gone").alias("gone"), F.count_if(~F.col("gone")).alias("left"))
        .where("gone > 0")
        .collect()
    )
    emptied = [c["folder"] for c in counts if not c["left"]]
    touched = [c["value"] for c in counts if c["left"]]
    if touched:
        given = [v for v in touched if v is not None]
        inside = F.col(column).isin(given) if given else F.lit(False)
        if None in touched:
            inside = inside | F.col(column).isNull()
        # the partitions are read in full before they are written over
        left = write_stage(rows.where(inside & ~gone), "left")
        writer = left.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(column).parquet(path)
    for name in emptied:
        place = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(name))
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    return Deleted(sum(c["gone"] for c in counts), len(touched), len(emptied))
