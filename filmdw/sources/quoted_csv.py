"""Delimited files with line breaks inside quotes, of any size, read by many tasks.

The text reader cuts a file into byte ranges at line breaks, some of which stand inside quotes. Each
range counts its quotes; a running sum of those counts over the ranges of a file says whether a range
begins inside quotes, and a running sum over the lines of a range says it of each line. A line that
begins outside quotes begins a record. Records that lie in one range are put together there; the pieces
of those that cross ranges, at most two a range, are numbered from the same counts and joined apart. Text
is shuffled once, by range; only counts, one row a range, are in one task for a file.

Quotes must be balanced: a quoted value is closed, a quote inside one is doubled, and there is none in a
value without quotes. A quote that is never closed makes the rest of its file one record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from filmdw.schemas import RAW_TEXT

_RANGE = ["file", "range"]


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, range, line, value, quotes): physical lines in their order."""
    rows = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("range"),
        F.monotonically_increasing_id().alias("line"),
        "value",
    )
    return rows.withColumn("quotes", F.length("value") - F.length(F.translate("value", '"', "")))


def _ranges(lines: DataFrame) -> DataFrame:
    """(file, range, open, still_open, begun): whether a range begins and ends inside quotes, and how many
    records that go on in a later range have begun before it."""
    odd = F.pmod("quotes", F.lit(2)) == 1
    counts = lines.groupBy(*_RANGE).agg(
        F.sum("quotes").alias("quotes"),
        # after its first line with an odd number of quotes, a range that begins inside quotes is outside
        (F.min(F.when(odd, F.col("line"))) < F.max("line")).alias("closes"),
    )
    # one row a range
    until = Window.partitionBy("file").orderBy("range")
    quotes = F.sum("quotes").over(until)
    parities = counts.select(
        *_RANGE,
        F.pmod(quotes - F.col("quotes"), F.lit(2)).alias("open"),
        (F.pmod(quotes, F.lit(2)) == 1).alias("still_open"),
        F.coalesce("closes", F.lit(False)).alias("closes"),
    )
    goes_on = (F.col("still_open") & ((F.col("open") == 0) | F.col("closes"))).cast("int")
    return parities.select(*_RANGE, "open", "still_open", (F.sum(goes_on).over(until) - goes_on).alias("begun"))


def _joined(order: list[str]) -> Column:
    pieces = F.array_sort(F.collect_list(F.struct(*order, "value")))
    return F.array_join(F.transform(pieces, lambda piece: piece["value"]), "\n").alias("value")


def quoted_records(spark: SparkSession, path: str) -> DataFrame:
    """(value): the records of delimited files as text, without the header of each file."""
    lines = _lines(spark, path)
    before = Window.partitionBy(*_RANGE).orderBy("line")
    quotes = F.coalesce(F.sum("quotes").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    begins = (F.pmod(F.col("open") + quotes, F.lit(2)) == 0).cast("int")
    numbered = (
        lines.join(_ranges(lines), _RANGE)
        .withColumn("begins", begins)
        .withColumn("record", F.sum("begins").over(before.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("last", F.sum("begins").over(Window.partitionBy(*_RANGE)))
    )
    # record 0 of a range goes on with what an earlier one began
    crosses = (F.col("record") == 0) | ((F.col("record") == F.col("last")) & F.col("still_open"))
    pieces = numbered.groupBy(*_RANGE, "record", crosses.alias("crosses"), "begun").agg(_joined(["line"]))
    header = (F.col("range") == 0) & (F.col("record") == 1)
    whole = pieces.where(~F.col("crosses") & ~header).select("value")

    begun = F.col("begun") + (F.col("record") > 0).cast("int")
    across = (
        pieces.where("crosses")
        .groupBy("file", begun.alias("begun"))
        .agg(_joined(["range", "record"]), F.max(header).alias("header"))
    )
    return whole.unionByName(across.where("NOT header").select("value"))


def read_quoted_csv(spark: SparkSession, path: str, schema: StructType = RAW_TEXT) -> DataFrame:
    """Delimited file with a header whose quoted values may hold line breaks.

    The rows are those of ``read_csv(..., multi_line=True)``, which reads a file in one task. Records may
    end in a line feed, with or without a carriage return before it; empty lines are left out.
    """
    record = F.regexp_replace("value", r"\r\z", "")
    options = {"quote": '"', "escape": '"', "multiLine": "true"}
    options |= {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    rows = quoted_records(spark, path).select(record.alias("value")).where(F.col("value") != "")
    return rows.select(F.from_csv("value", schema.simpleString(), options).alias("row")).select("row.*")
