"""Constant tables."""

from pyspark.sql import DataFrame, SparkSession

from filmdw.fixed_values import LANGUAGE_COUNTRIES


def _literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    if isinstance(value, float):
        return f"double('{value!r}')"
    return f"{value}L" if abs(value) > 2**31 - 1 else str(value)


def constant_rows(spark: SparkSession, names: list[str], rows: list[tuple]) -> DataFrame:
    """A few literal rows as part of the plan."""
    values = ", ".join(f"({', '.join(map(_literal, row))})" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(names)})")


def language_countries(spark: SparkSession) -> DataFrame:
    """Twelve languages and the country each stands for."""
    names = ["original_language", "country_code", "country_name", "region"]
    return constant_rows(spark, names, LANGUAGE_COUNTRIES)
