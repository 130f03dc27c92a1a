"""Joins to key tables that hold up when the table is large or a key is hot."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from filmdw.functions.text import collated
from filmdw.session import write_stage

# A key table is broadcast up to this many rows and characters of text, which
# bounds the broadcast to some tens of megabytes.
BROADCAST_ROWS = 500_000
BROADCAST_CHARACTERS = 50_000_000
# A key with more than 1/HOT_SHARE of the rows is hot; fewer than HOT_SHARE can exist.
HOT_SHARE = 1000


def fits_broadcast(keys: DataFrame, broadcast_rows: int | None = None) -> bool:
    """Whether a table is small enough to broadcast, by its rows and its text."""
    limit = BROADCAST_ROWS if broadcast_rows is None else broadcast_rows
    text = [F.length(name) for name, kind in keys.dtypes if kind.startswith("string")]
    characters = [F.coalesce(F.sum(part), F.lit(0)) for part in text]
    size = keys.agg(F.count("*"), *characters).first()
    return size[0] <= limit and sum(size[1:]) <= BROADCAST_CHARACTERS


def lookup(
    left: DataFrame,
    keys: DataFrame,
    key: str,
    broadcast_rows: int | None = None,
    hot_share: int = HOT_SHARE,
    collation: str | None = None,
) -> DataFrame:
    """Left join of ``left`` to ``keys`` on ``key``; every left row is kept once
    per match.

    A small table is broadcast, which shuffles nothing. A larger one is joined
    in two ways: the rows of hot keys, and those without a key, meet a broadcast
    of the hot entries; the others, none of them hot, are shuffled. Under a ``collation`` keys match that
    are equal by its rules; ``left`` keeps its own spelling.
    """
    if collation is not None:
        others = [c for c in keys.columns if c != key]
        folded = keys.select(collated(key, collation).alias("_folded"), *others)
        rows = left.withColumn("_folded", collated(key, collation))
        return lookup(rows, folded, "_folded", broadcast_rows, hot_share).drop("_folded")
    if fits_broadcast(keys, broadcast_rows):
        return left.join(F.broadcast(keys), key, "left")

    rows = write_stage(left, "lookup")
    limit = rows.count() / hot_share
    hot = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n"))
    hot = write_stage(hot.where(F.col("_n") > limit).select(key, F.lit(True).alias("_hot")), "hot")
    marked = rows.join(F.broadcast(hot), key, "left")
    spread = F.coalesce("_hot", F.col(key).isNull())
    hot_keys = keys.join(F.broadcast(hot.select(key)), key, "left_semi")
    shuffled = marked.where(~spread).drop("_hot").join(keys, key, "left")
    in_place = marked.where(spread).drop("_hot").join(F.broadcast(hot_keys), key, "left")
    return in_place.unionByName(shuffled)


def calendar_lookup(left: DataFrame, times: DataFrame, day: str) -> DataFrame:
    """Left join to the day table on a date column, adding ``time_id``.

    The calendar bounds the broadcast: years 1 to 9999 are 3.7 million days,
    two numbers each, and a day occurs once.
    """
    days = times.select(F.col("full_date").alias(day), "time_id")
    return left.join(F.broadcast(days), day, "left")


def keep_unknown(left: DataFrame, keys: DataFrame, key: str, **limits) -> DataFrame:
    """Rows of ``left`` whose key is not in ``keys``; rows without a key stay.

    Only keys that ``left`` holds are gathered, so the cost follows ``left``, plus one scan of the
    key column of ``keys``.
    """
    wanted = write_stage(left.select(key).where(F.col(key).isNotNull()).distinct(), "wanted")
    few = F.broadcast(wanted) if fits_broadcast(wanted, limits.get("broadcast_rows")) else wanted
    known = keys.select(key).join(few, key, "left_semi").distinct()
    flagged = write_stage(known.withColumn("_known", F.lit(True)), "known")
    joined = lookup(left, flagged, key, **limits)
    return joined.where(F.col("_known").isNull()).drop("_known").select(*left.columns)


def keep_known(left: DataFrame, keys: DataFrame, key: str, **limits) -> DataFrame:
    """Rows of ``left`` whose key is in ``keys``."""
    known = keys.select(key).where(F.col(key).isNotNull()).distinct()
    flagged = write_stage(known.withColumn("_known", F.lit(True)), "known")
    joined = lookup(left, flagged, key, **limits)
    return joined.where(F.col("_known")).drop("_known").select(*left.columns)


def first_match(keys: DataFrame, name: str, key: str, collation: str | None = None) -> DataFrame:
    """One row per name, with its lowest key; of the spellings of a name the first in binary order stays."""
    given = keys.where(F.col(name).isNotNull())
    if collation is None:
        return given.groupBy(name).agg(F.min(key).alias(key))
    groups = given.groupBy(collated(name, collation).alias("_folded"))
    return groups.agg(F.min(name).alias(name), F.min(key).alias(key)).drop("_folded")
