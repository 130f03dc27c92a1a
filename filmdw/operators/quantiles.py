"""Exact quantiles by refined histograms: rows are counted in place and never sorted.

The wanted ranks of all columns are narrowed down together. A pass over the rows counts, for each interval
that holds a wanted rank, how many values fall into each of its bins, with the least and the largest value
of every bin; the bin that holds the rank is the next interval. Counts are summed in the tasks first, so a
pass shuffles one row per task and bin, and only the counts reach the driver: ``BINS`` for each interval, of
which there are at most two for each column and quantile. Bins are equally wide in the first pass, and where the ends of an
interval differ in sign or a thousandfold, equally wide in the logarithm afterwards: ten passes
suffice for any doubles, three for most. A bin with one distinct value is settled; what is
left once few rows are in question is ranked by its distinct values.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from filmdw.sources.constants import constant_rows

BINS = 1024
#: an interval of so many rows is ranked by its values
FEW = 20_000


@dataclass(frozen=True)
class _Interval:
    """Values of a column between two of them, both included, and the number of rows below."""

    column: str
    low: float
    high: float
    below: int
    rows: int


def _magnitude(value: Column) -> Column:
    """Rises with the value, by one for every doubling; logarithms never fall as numbers rise."""
    return F.when(value == 0, 0.0).otherwise(F.signum(value) * (F.log2(F.abs(value)) + 1075))


def _bin(value: Column, low: float, high: float, wide: bool) -> Column:
    """A place in 0..BINS-1 that never falls as the value rises; infinities stand outside."""
    if low >= high:
        share = F.lit(0.0)
    elif wide:
        low, high, own = _magnitude(_literal(low)), _magnitude(_literal(high)), _magnitude(value)
        share = (own - low) / (high - low)
    elif math.isinf(high - low):
        # halves, so that the width of the interval is finite
        share = (value / 2 - low / 2) / (high / 2 - low / 2)
    else:
        share = (value - low) / (high - low)
    inside = F.least(F.floor(share * BINS), F.lit(BINS - 1)).cast("int")
    return F.when(value == float("-inf"), -1).when(value == float("inf"), BINS).otherwise(inside)


def _literal(value: float) -> Column:
    return F.lit(value).cast("double")


def _bounds(df: DataFrame, columns: list[str]) -> dict[str, tuple]:
    """(rows, least, largest finite value) of each column, NULL and NaN left out."""
    parts = []
    for c in columns:
        value = F.col(c).cast("double")
        finite = F.when(~F.isnan(value) & (F.abs(value) < float("inf")), value)
        parts += [F.count_if(value.isNotNull() & ~F.isnan(value)), F.min(finite), F.max(finite)]
    row = df.agg(*[part.alias(f"p{i}") for i, part in enumerate(parts)]).first()
    return {c: tuple(row[3 * i : 3 * i + 3]) for i, c in enumerate(columns)}


def _members(df: DataFrame, intervals: list[_Interval], item) -> DataFrame:
    """(number, item): a row for every value and interval that holds it."""
    listed = []
    for number, i in enumerate(intervals):
        value = F.col(i.column).cast("double")
        held = value.between(_literal(i.low), _literal(i.high)) & ~F.isnan(value)
        listed.append(F.when(held, F.struct(F.lit(number).alias("number"), *item(value, i))))
    return df.select(F.inline(F.array_compact(F.array(*listed))))


def _split(df: DataFrame, intervals: list[_Interval], bounds: dict[str, tuple]) -> list[_Interval]:
    """The bins of the intervals that hold rows, from the lowest up."""
    numbers = {i: number for number, i in enumerate(intervals)}

    def item(value: Column, i: _Interval):
        # a whole column starts between its finite values
        low, high = (i.low, i.high) if math.isfinite(i.low) else bounds[i.column][1:]
        low, high = (0.0, 0.0) if low is None else (low, high)
        # equal bins of a wide interval would hold most of its values in the first one
        least, most = sorted((abs(low), abs(high)))
        wide = math.isfinite(i.low) and (low < 0 < high or most > BINS * least)
        return _bin(value, low, high, wide).alias("bin"), value.alias("value")

    counted = _members(df, intervals, item).groupBy("number", "bin")
    bins = counted.agg(F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
    out, below = [], {number: i.below for i, number in numbers.items()}
    for b in sorted(bins.collect(), key=lambda b: (b["number"], b["bin"])):
        number = b["number"]
        out.append(_Interval(intervals[number].column, b["low"], b["high"], below[number], b["n"]))
        below[number] += b["n"]
    return out


def _ranked(df: DataFrame, intervals: list[_Interval], wanted: list[tuple[int, int]]) -> dict[tuple[int, int], float]:
    """Values at wanted (number of interval, rank in it) of intervals with few rows."""
    values = _members(df, intervals, lambda value, i: (value.alias("value"),))
    counts = values.groupBy("number", "value").agg(F.count("*").alias("n"))
    inside = Window.partitionBy("number").orderBy("value")
    last = F.sum("n").over(inside) - 1
    spans = counts.withColumn("last", last).withColumn("first", F.col("last") - F.col("n") + 1)
    asked = F.broadcast(constant_rows(df.sparkSession, ["number", "rank"], wanted))
    found = spans.join(asked, "number").where(F.col("rank").between(F.col("first"), F.col("last")))
    return {(r["number"], r["rank"]): r["value"] for r in found.select("number", "rank", "value").collect()}


def order_statistics(df: DataFrame, ranks: dict[str, set[int]], bounds: dict[str, tuple]) -> dict[tuple[str, int], float]:
    """(column, rank) -> value, ranks from 0 among values that are neither NULL nor NaN."""
    settled: dict[tuple[str, int], float] = {}
    open_ranks = {(c, r) for c, wanted in ranks.items() for r in wanted}
    intervals = [_Interval(c, -math.inf, math.inf, 0, bounds[c][0]) for c in ranks if bounds[c][0]]
    while open_ranks:
        intervals = _split(df, intervals, bounds)
        held = {}
        for c, rank in open_ranks:
            held[c, rank] = next(i for i in intervals if i.column == c and i.below <= rank < i.below + i.rows)
        settled |= {key: i.low for key, i in held.items() if i.low == i.high}
        open_ranks = {key for key in open_ranks if key not in settled}
        intervals = sorted({held[key] for key in open_ranks}, key=lambda i: (i.column, i.below))
        few = [i for i in intervals if i.rows <= FEW]
        if few:
            asked = {(few.index(held[k]), k[1] - held[k].below): k for k in open_ranks if held[k] in few}
            settled |= {asked[at]: value for at, value in _ranked(df, few, sorted(asked)).items()}
            open_ranks = {key for key in open_ranks if key not in settled}
            intervals = [i for i in intervals if i not in few]
    return settled


def exact_quantiles(df: DataFrame, columns: list[str], probs: list[float]) -> DataFrame:
    """(column, prob, value): linear-interpolated quantiles of numeric columns.

    NULL and NaN are left out; a column without values has no rows. ``df`` is read about four times, once a
    pass, so it should be a table or a written stage; only ``columns`` are read.
    """
    rows = df.select(*columns)
    bounds = _bounds(rows, columns)
    at = {(c, p): (bounds[c][0] - 1) * float(p) for c in columns if bounds[c][0] for p in probs}
    ranks: dict[str, set[int]] = {}
    for (c, _), position in at.items():
        ranks.setdefault(c, set()).update((math.floor(position), math.ceil(position)))
    values = order_statistics(rows, ranks, bounds)
    out = []
    for (c, p), position in at.items():
        low, high = values[c, math.floor(position)], values[c, math.ceil(position)]
        step = position - math.floor(position)
        out.append((c, float(p), low + (high - low) * step if low != high else low))
    if not out:
        return df.sparkSession.createDataFrame([], "column string, prob double, value double")
    return constant_rows(df.sparkSession, ["column", "prob", "value"], out)


def exact_median(df: DataFrame, column: str) -> Column:
    """The median as a literal, NULL if there is no value."""
    found = exact_quantiles(df, [column], [0.5]).collect()
    return F.lit(found[0]["value"] if found else None).cast("double")
