"""Expressions over money, rates and untrusted numbers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def number(value: Column, kind: str = "double") -> Column:
    """Lossy cast: text that is no number gives NULL, and so does NaN."""
    cast = value.try_cast("double")
    clean = F.when(~F.isnan(cast), cast)
    # the direct cast keeps all digits of a long key, the other one reads "12.0"
    return clean if kind == "double" else F.coalesce(value.try_cast(kind), clean.try_cast(kind))


def profit(revenue: Column, budget: Column) -> Column:
    return revenue - budget


def roi(revenue: Column, budget: Column) -> Column:
    return F.try_divide(revenue - budget, budget)


def both_positive(budget: Column, revenue: Column) -> Column:
    return (budget > 0) & (revenue > 0)


def percent(part: Column, total: Column) -> Column:
    """Share in percent, 0 when there is nothing to divide by."""
    return F.coalesce(F.try_divide(part * 100.0, total), F.lit(0.0))


def billions(value: Column) -> Column:
    return F.coalesce(value / 1e9, F.lit(0.0))


def millions(value: Column) -> Column:
    return F.coalesce(value / 1e6, F.lit(0.0))
