"""Ladders that turn a percentage or a count into a label."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from filmdw.fixed_values import (
    GRADE_FLOOR,
    GRADE_LADDER,
    JOB_FLOOR,
    JOB_LADDER,
    RULE_FLOOR,
    RULE_LADDER,
)


def _ladder(value: Column, steps: list[tuple[float, str]], floor: str) -> Column:
    label = F.lit(floor)
    for limit, name in reversed(steps):
        label = F.when(value < limit, name).otherwise(label)
    return label


def rule_status(pct: Column) -> Column:
    return _ladder(pct, RULE_LADDER, RULE_FLOOR)


def overall_grade(pct: Column) -> Column:
    return _ladder(pct, GRADE_LADDER, GRADE_FLOOR)


def job_status(pct: Column) -> Column:
    return _ladder(pct, JOB_LADDER, JOB_FLOOR)


def load_status(inserted: int, failed: int) -> str:
    """Status of a delta load."""
    if failed == 0:
        return "SUCCESS"
    return "PARTIAL_SUCCESS" if inserted > 0 else "FAILED"


def batch_status(failed: Column) -> Column:
    """Status of a full or part load."""
    return F.when(failed == 0, "SUCCESS").otherwise("PARTIAL_SUCCESS")


def performance(error: Column) -> Column:
    return F.when(error > 0, "Over-performing").otherwise("Under-performing")
