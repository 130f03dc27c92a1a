"""Writers of files and external tables."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_csv(df: DataFrame, path: str) -> None:
    """A folder of delimited part files with headers; blanks around text are kept."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def publish(df: DataFrame, path: str) -> None:
    """Replace the dataset at ``path``; any file system Spark can reach."""
    df.write.mode("overwrite").parquet(path)


def write_parts(df: DataFrame, path: str) -> None:
    """One folder per ``chunk_id``, so that a part is read without the others."""
    df.write.mode("overwrite").partitionBy("chunk_id").parquet(path)


def append_jdbc(
    df: DataFrame, url: str, table: str, batch_size: int = 1000, **options: str
) -> None:
    """Append to an external table in batches of ``batch_size`` rows per statement."""
    (
        df.write.format("jdbc")
        .mode("append")
        .options(**options)
        .option("url", url)
        .option("dbtable", table)
        .option("batchsize", batch_size)
        .save()
    )
