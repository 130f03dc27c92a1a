"""Global positions and surrogate keys without a single-task sort.

A window without partitions sends every row to one task. Here rows are
range-partitioned, written once, and numbered from their place inside a
partition plus the number of rows in the partitions before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from filmdw.session import write_stage

# monotonically_increasing_id keeps the partition above bit 33 and the place below
_PLACE_BITS = 33
_PLACE_MASK = (1 << _PLACE_BITS) - 1
# partitions whose rows are summed together first
_GROUP = 1000


def _written_in_order(df: DataFrame, order_by: list[str], label: str) -> DataFrame:
    ordered = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    return write_stage(ordered.withColumn("_slot", F.monotonically_increasing_id()), label)


def _part() -> Column:
    return F.shiftright("_slot", _PLACE_BITS)


def _offsets(rows: DataFrame) -> DataFrame:
    """(_part, _before): rows before each partition, a running sum in two steps.

    The sum inside a thousand partitions is theirs alone; over them runs one row for each thousand.
    """
    sizes = rows.groupBy(_part().alias("_part")).agg(F.count("*").alias("_rows"))
    sizes = sizes.withColumn("_group", F.floor(F.col("_part") / _GROUP))
    before = lambda rows, window: F.coalesce(
        F.sum(rows).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    groups = sizes.groupBy("_group").agg(F.sum("_rows").alias("_rows"))
    groups = groups.select("_group", before("_rows", Window.partitionBy(F.lit(0)).orderBy("_group")).alias("_start"))
    inside = before("_rows", Window.partitionBy("_group").orderBy("_part"))
    placed = sizes.withColumn("_inside", inside).join(F.broadcast(groups), "_group")
    return placed.select("_part", (F.col("_start") + F.col("_inside")).alias("_before"))


def _placed(rows: DataFrame) -> tuple[DataFrame, Column]:
    """The written rows joined with what is before their partition, and their position from 0.

    The broadcast has two numbers for each partition.
    """
    joined = rows.withColumn("_part", _part()).join(F.broadcast(_offsets(rows)), "_part")
    return joined, F.col("_slot").bitwiseAND(_PLACE_MASK) + F.col("_before")


def dense_keys(df: DataFrame, key: str, after: Column | int = 0, label: str = "keyed") -> DataFrame:
    """Add ``key``: the whole numbers from ``after`` + 1 on, without gaps, in the order of partitions.

    The rows are written first, so that a task that is run again sees the places it saw before.
    """
    columns = df.columns
    rows, place = _placed(write_stage(df.withColumn("_slot", F.monotonically_increasing_id()), label))
    start = F.lit(after) if isinstance(after, int) else after
    return rows.select((place + start + 1).cast("bigint").alias(key), *columns)


def number_rows(
    df: DataFrame, order_by: list[str], out: str, label: str, start: int = 1, unique: bool = False
) -> DataFrame:
    """Add ``out``: the position of each row in ``order_by`` order.

    Unless the order is ``unique``, ties are broken by input position, so a run
    of equal keys or of exact copies is spread over partitions like any other
    rows. That position is written first: a task that is run again after a lost
    executor must see the one it saw before.
    """
    columns = df.columns
    if not unique:
        df = write_stage(df.withColumn("_input", F.monotonically_increasing_id()), label)
        order_by = [*order_by, "_input"]
    rows, place = _placed(_written_in_order(df, order_by, label))
    return rows.select((place + start).cast("bigint").alias(out), *columns)


def surrogate_keys(names: DataFrame, order_by: list[str], key: str) -> DataFrame:
    """Number a table of distinct names from 1; written, as a dimension is read several times."""
    return write_stage(number_rows(names, order_by, key, label=key, unique=True), f"{key}-keys")
