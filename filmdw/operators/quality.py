"""Data quality: rules, column tests, thresholds and the overall grade."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from filmdw.fixed_values import FACT_TABLE, QUALITY_RULES, STAGING_TABLE
from filmdw.functions.dates import loaded_at
from filmdw.functions.numbers import both_positive, percent
from filmdw.functions.status import job_status, overall_grade, rule_status
from filmdw.functions.text import collated
from filmdw.operators.lookup import fits_broadcast, keep_known
from filmdw.session import write_stage


def _out_of_range(rating: Column) -> Column:
    return (rating < 0) | (rating > 10)


def staging_predicates(as_of: str | None = None) -> dict[str, Column]:
    now = loaded_at(as_of)
    return {
        "NULL movie_id": F.col("movie_id").isNull(),
        "NULL/Empty title": F.col("title").isNull() | (F.col("title") == ""),
        "Negative budget": F.col("budget") < 0,
        "Negative revenue": F.col("revenue") < 0,
        "Rating out of range": _out_of_range(F.col("vote_average")),
        "Future release dates": F.col("release_date").cast("timestamp") > now,
        "Negative runtime": F.col("runtime") < 0,
        "Extreme runtime (>10h)": F.col("runtime") > 600,
    }


def fact_predicates() -> dict[str, Column]:
    return {
        "NULL genre_id": F.col("genre_id").isNull(),
        "NULL time_id": F.col("time_id").isNull(),
        "NULL studio_id": F.col("studio_id").isNull(),
        "Negative budget": F.col("budget") < 0,
        "Negative revenue": F.col("revenue") < 0,
        "Rating out of range": _out_of_range(F.col("vote_average")),
        "Extreme ROI (>1000x)": F.col("roi") > 1000,
        "Zero budget with revenue": (F.col("budget") == 0) & (F.col("revenue") > 0),
    }


def _count_rules(rows: DataFrame, table: str, rules: dict[str, Column]) -> DataFrame:
    """(table, validation_type, total_records, invalid_records), one scan."""
    counted = rows.agg(
        F.count("*").alias("total_records"),
        *[
            F.count_if(F.coalesce(broken, F.lit(False))).alias(f"r{i}")
            for i, broken in enumerate(rules.values())
        ],
    )
    named = [
        F.struct(F.lit(rule).alias("validation_type"), F.col(f"r{i}").alias("invalid_records"))
        for i, rule in enumerate(rules)
    ]
    return counted.select(
        F.lit(table).alias("table"), "total_records", F.explode(F.array(*named)).alias("rule")
    ).select("table", "rule.validation_type", "total_records", "rule.invalid_records")


def orphan_count(fact: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """One row with the number of fact rows whose key is not among ``keys``.

    The keys in use are counted first, so a hot one is a single row in the join.
    """
    used = fact.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n"))
    lost = used.join(keys.select(key).where(F.col(key).isNotNull()), key, "left_anti")
    return lost.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("invalid_records"))


def fact_rule_counts(
    fact: DataFrame, dims: dict[str, DataFrame], broadcast_rows: int | None = None
) -> DataFrame:
    """Counts of the fact rules, ``dims`` being {key column: dimension}.

    Orphans are flagged against broadcast keys in the scan that counts the
    other rules; a dimension too large for that is checked on its own.
    """
    rules = fact_predicates()
    large = {
        f"Orphaned {key}": key
        for key, dim in dims.items()
        if not fits_broadcast(dim.select(key), broadcast_rows)
    }
    # built once, however many dimensions are checked on their own
    fact = write_stage(fact, "checked-fact") if large else fact
    flagged = fact
    for key, dim in dims.items():
        name = f"Orphaned {key}"
        if name in large:
            continue
        known = dim.select(key).distinct().withColumn(f"_has_{key}", F.lit(True))
        flagged = flagged.join(F.broadcast(known), key, "left")
        rules[name] = F.col(key).isNotNull() & F.col(f"_has_{key}").isNull()
    counts = _count_rules(flagged, FACT_TABLE, rules)
    if large:
        counts = write_stage(counts, "rule-counts")
    for name, key in large.items():
        total = counts.select("total_records").limit(1).scalar()
        lost = orphan_count(fact, dims[key], key).select(
            F.lit(FACT_TABLE).alias("table"),
            F.lit(name).alias("validation_type"),
            total.alias("total_records"),
            "invalid_records",
        )
        counts = counts.unionByName(lost)
    return counts


def staging_rule_counts(staging: DataFrame, as_of: str | None = None) -> DataFrame:
    return _count_rules(staging, STAGING_TABLE, staging_predicates(as_of))


def with_status(counts: DataFrame, as_of: str | None = None) -> DataFrame:
    """Add percentage, status, description and time to rule counts."""
    text = F.lit("")
    for table, rule, description in QUALITY_RULES:
        hit = (F.col("table") == table) & (F.col("validation_type") == rule)
        text = F.when(hit, description).otherwise(text)
    pct = percent(F.col("invalid_records"), F.col("total_records"))
    return counts.select(
        "table",
        "validation_type",
        "total_records",
        "invalid_records",
        pct.alias("invalid_percentage"),
        rule_status(pct).alias("status"),
        text.alias("description"),
        loaded_at(as_of).alias("timestamp"),
    )


def quality_report(
    staging: DataFrame,
    fact: DataFrame,
    genres: DataFrame,
    times: DataFrame,
    studios: DataFrame,
    as_of: str | None = None,
    broadcast_rows: int | None = None,
) -> DataFrame:
    """The 19 rules, from one scan of staging and one of the fact."""
    dims = {"genre_id": genres, "time_id": times, "studio_id": studios}
    of_fact = fact_rule_counts(fact, dims, broadcast_rows)
    counts = staging_rule_counts(staging, as_of).unionByName(of_fact)
    return with_status(counts, as_of)


def overall_quality(report: DataFrame) -> DataFrame:
    """One row: all failures over all rows checked, the grade and the job status.

    A row that fails three rules counts three times.
    """
    per_table = report.groupBy("table").agg(
        F.max("total_records").alias("rows"),
        F.sum("invalid_records").alias("issues"),
        F.count("*").alias("rules"),
    )
    pct = percent(F.col("total_issues"), F.col("total_records"))
    return per_table.agg(
        F.sum("rules").alias("total_validations"),
        F.sum("rows").alias("total_records"),
        F.sum("issues").alias("total_issues"),
    ).select(
        "*",
        pct.alias("invalid_percentage"),
        overall_grade(pct).alias("grade"),
        job_status(pct).alias("job_status"),
        F.when(pct > 0, F.format_string("Data quality: %.2f%% invalid records", pct)).alias(
            "error_message"
        ),
    )


def top_issues(report: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` rules with most failures, those without any left out."""
    order = [F.desc("invalid_records"), F.asc("table"), F.asc("validation_type")]
    listed = report.select("table", "validation_type", "invalid_records").orderBy(*order).limit(n)
    return listed.where(F.col("invalid_records") > 0)


def repeated_titles(fact: DataFrame) -> DataFrame:
    """One row: titles with more than one fact row. Informational."""
    per_title = fact.groupBy("movie_id").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    return per_title.agg(F.count("*").alias("multi_genre_films"))


def loss_making(fact: DataFrame) -> DataFrame:
    """One row: rows that earned less than they cost. Informational."""
    lost = both_positive(F.col("budget"), F.col("revenue")) & (F.col("revenue") < F.col("budget"))
    counts = fact.agg(
        F.count_if(F.coalesce(lost, F.lit(False))).alias("loss_making"),
        F.count("*").alias("fact_rows"),
    )
    return counts.withColumn("pct", percent(F.col("loss_making"), F.col("fact_rows")))


# Column tests


def failing_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def failing_unique(df: DataFrame, column: str, collation: str | None = None) -> DataFrame:
    """Values, NULL aside, that occur more than once; under a collation the first of the spellings that
    are equal by its rules stands for all."""
    given = df.where(F.col(column).isNotNull())
    if collation is None:
        counts = given.groupBy(F.col(column).alias("unique_field")).agg(F.count("*").alias("n_records"))
    else:
        groups = given.groupBy(collated(column, collation).alias("_folded"))
        named = groups.agg(F.min(column).alias("unique_field"), F.count("*").alias("n_records"))
        counts = named.drop("_folded")
    return counts.where(F.col("n_records") > 1)


def not_null_results(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """(table, column, test, failures, passed) of several not-null tests, one scan."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    listed = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).alias("failures")) for c in columns]
    )
    return counts.select(F.explode(listed).alias("t")).select(
        F.lit(table).alias("table"),
        "t.column",
        F.lit("not_null").alias("test"),
        "t.failures",
        (F.col("t.failures") == 0).alias("passed"),
    )


def unique_result(
    df: DataFrame, table: str, column: str, collation: str | None = None
) -> DataFrame:
    """The same columns for one unique test."""
    failures = failing_unique(df, column, collation).agg(F.count("*").alias("failures"))
    return failures.select(
        F.lit(table).alias("table"),
        F.lit(column).alias("column"),
        F.lit("unique").alias("test"),
        "failures",
        (F.col("failures") == 0).alias("passed"),
    )


def model_tests(
    stg: DataFrame, genres: DataFrame, fact: DataFrame, by_genre: DataFrame
) -> DataFrame:
    """The 11 column tests of the model variant."""
    results = not_null_results(stg, "stg_movies", ["movie_id", "title", "budget", "revenue"])
    for more in (
        not_null_results(genres, "dim_genre", ["genre_name"]),
        unique_result(genres, "dim_genre", "genre_name"),
        not_null_results(fact, "fact_movies", ["movie_id", "budget", "revenue"]),
        not_null_results(by_genre, "agg_by_genre", ["genre_name"]),
        unique_result(by_genre, "agg_by_genre", "genre_name"),
    ):
        results = results.unionByName(more)
    return results


# Thresholds. Fixed values:
MIN_ROWS = 1000
MAX_NULL_PCT = {
    "title": 1.0,
    "release_date": 1.0,
    "genres": 10.0,
    "budget": 50.0,
    "revenue": 50.0,
}
MAX_BAD_DATE_PCT = 5.0
MAX_INVALID_PCT = 0.5
MIN_FORMULA_MATCH_PCT = 95.0
LAYER_MINIMUMS = {
    "Staging_Movies": 1001,
    "Dim_Genre": 10,
    "Dim_Time": 100,
    "Dim_Studio": 50,
    "Fact_Movies": 1001,
}
MIN_COVERAGE_PCT = {"Staging_Movies": 80.0, "Fact_Movies": 70.0}
REQUIRED_COLUMNS = [
    "id",
    "title",
    "genres",
    "budget",
    "revenue",
    "vote_average",
    "vote_count",
    "release_date",
    "production_companies",
    "profit",
    "roi",
]
NUMERIC_COLUMNS = ["budget", "revenue", "vote_average", "vote_count", "profit", "roi"]
CRITICAL_COLUMNS = ["id", "title", "release_date", "budget", "revenue", "genres"]


def schema_problems(df: DataFrame) -> list[str]:
    """Required columns that are missing and measures that are not numeric."""
    kinds = dict(df.dtypes)
    missing = [f"missing {c}" for c in REQUIRED_COLUMNS if c not in kinds]
    numeric = ("tinyint", "smallint", "int", "bigint", "float", "double")
    return missing + [
        f"not numeric {c}"
        for c in NUMERIC_COLUMNS
        if c in kinds and kinds[c] not in numeric and not kinds[c].startswith("decimal")
    ]


def formula_match(df: DataFrame) -> DataFrame:
    """One row: share of rows, in percent, whose profit and roi agree with the money."""
    budget, revenue = F.col("budget"), F.col("revenue")
    paid = both_positive(budget, revenue)
    profit_ok = F.abs(revenue - budget - F.col("profit")) < 1
    given = F.col("profit").isNotNull() & F.col("roi").isNotNull() & revenue.isNotNull()
    rated = given & (budget > 0)
    roi_ok = F.abs(F.try_divide(F.col("profit"), budget) - F.col("roi")) < 0.01
    counts = df.agg(
        F.count_if(F.coalesce(paid, F.lit(False))).alias("profit_rows"),
        F.count_if(F.coalesce(paid & profit_ok, F.lit(False))).alias("profit_matches"),
        F.count_if(F.coalesce(rated, F.lit(False))).alias("roi_rows"),
        F.count_if(F.coalesce(rated & roi_ok, F.lit(False))).alias("roi_matches"),
    )
    return counts.select(
        "*",
        percent(F.col("profit_matches"), F.col("profit_rows")).alias("profit_pct"),
        percent(F.col("roi_matches"), F.col("roi_rows")).alias("roi_pct"),
    )


def cleaned_checks(cleaned: DataFrame) -> DataFrame:
    """(check_name, value, limit_value, passed) for the cleaned table, one scan."""
    def share(bad: Column) -> Column:
        return percent(F.count_if(F.coalesce(bad, F.lit(False))), F.count("*"))

    empty = {c: F.col(c).isNull() | (F.col(c) == "") for c in ("genres", "title")}
    upper: list[tuple[str, Column, float]] = [
        (f"empty {c} pct", share(empty.get(c, F.col(c).isNull())), limit)
        for c, limit in MAX_NULL_PCT.items()
    ]
    upper.append(("bad date pct", share(F.col("release_date").isNull()), MAX_BAD_DATE_PCT))
    none_allowed = {
        "negative budget": F.col("budget") < 0,
        "negative revenue": F.col("revenue") < 0,
        "rating out of range": _out_of_range(F.col("vote_average")),
        **{f"null {c}": F.col(c).isNull() for c in CRITICAL_COLUMNS},
    }
    values = [F.count("*").cast("double").alias("v0")]
    checks = [("rows", "v0", float(MIN_ROWS), F.col("v0") >= MIN_ROWS)]
    for name, value, limit in upper:
        column = f"v{len(values)}"
        values.append(value.alias(column))
        checks.append((name, column, limit, F.col(column) < limit))
    for name, bad in none_allowed.items():
        column = f"v{len(values)}"
        values.append(F.count_if(F.coalesce(bad, F.lit(False))).cast("double").alias(column))
        checks.append((name, column, 0.0, F.col(column) == 0))
    listed = [
        F.struct(
            F.lit(name).alias("check_name"),
            F.col(column).alias("value"),
            F.lit(limit).alias("limit_value"),
            passed.alias("passed"),
        )
        for name, column, limit, passed in checks
    ]
    return cleaned.agg(*values).select(F.inline(F.array(*listed)))


def combined_invalid(staging: DataFrame) -> DataFrame:
    """One row: share of staging rows with any invalid measure, each row counted once."""
    bad = (F.col("budget") < 0) | (F.col("revenue") < 0) | _out_of_range(F.col("vote_average"))
    counts = staging.agg(
        F.count("*").alias("total_records"),
        F.count_if(F.coalesce(bad, F.lit(False))).alias("invalid_records"),
    )
    pct = percent(F.col("invalid_records"), F.col("total_records"))
    return counts.select(
        "*", pct.alias("invalid_percentage"), (pct < MAX_INVALID_PCT).alias("passed")
    )


def layer_counts(layers: dict[str, DataFrame]) -> DataFrame:
    """(layer, rows, minimum, passed), one row per layer."""
    result = None
    for name, frame in layers.items():
        minimum = LAYER_MINIMUMS[name]
        row = frame.agg(F.count("*").alias("rows")).select(
            F.lit(name).alias("layer"),
            "rows",
            F.lit(minimum).cast("bigint").alias("minimum"),
            (F.col("rows") >= minimum).alias("passed"),
        )
        result = row if result is None else result.unionByName(row)
    return result


def ordered_sample(df: DataFrame, key: str, n: int = 100) -> DataFrame:
    """The first ``n`` rows in key order."""
    return df.orderBy(key).limit(n)


def sample_coverage(sample: DataFrame, layers: dict[str, DataFrame]) -> DataFrame:
    """(layer, found, pct, passed): share of sampled ids present in each layer."""
    ids = write_stage(sample.select("movie_id").distinct(), "sample")
    size = ids.agg(F.count("*").alias("n")).scalar()
    result = None
    for name, frame in layers.items():
        hits = keep_known(frame.select("movie_id"), ids, "movie_id")
        pct = percent(F.col("found"), size)
        row = hits.agg(F.countDistinct("movie_id").alias("found")).select(
            F.lit(name).alias("layer"),
            "found",
            pct.alias("pct"),
            (pct >= MIN_COVERAGE_PCT[name]).alias("passed"),
        )
        result = row if result is None else result.unionByName(row)
    return result
