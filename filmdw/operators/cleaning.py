"""Raw titles to cleaned titles, with an account of what each filter removed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from filmdw.fixed_values import FIRST_DATE, LAST_DATE, MAX_BUDGET, MAX_REVENUE, UNKNOWN
from filmdw.functions.dates import lossy_date
from filmdw.functions.numbers import both_positive, number, percent, profit, roi
from filmdw.operators.quantiles import exact_median
from filmdw.schemas import CLEANED, RAW_NUMBERS

# Texts the usual reader of delimited files takes for a missing value.
# Fixed values:
MISSING_WORDS = [
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]

STEPS = ["too_old_or_undated", "future", "no_money", "outlier", "kept"]


def missing_words_to_null(raw: DataFrame) -> DataFrame:
    """Optional: read ``NA``, ``None`` and the like as missing in text columns."""
    text = [field.name for field in raw.schema if field.dataType.typeName() == "string"]
    return raw.withColumns({c: F.when(~F.col(c).isin(MISSING_WORDS), F.col(c)) for c in text})


def typed(raw: DataFrame) -> DataFrame:
    """Cast text columns; a bad date or number becomes NULL.

    Ids, dates and money that are typed already stay plain columns, so that filters on them reach
    the scan; money that is not a number fails those filters.
    """
    kinds = dict(raw.dtypes)
    casts: dict[str, Column] = {"id": number(F.col("id"), "bigint")}
    casts["release_date"] = lossy_date(F.col("release_date"))
    casts |= {c: number(F.col(c)) for c in RAW_NUMBERS if c in raw.columns}
    plain = {"id": "bigint", "release_date": "date", "budget": "double", "revenue": "double"}
    return raw.withColumns({c: e for c, e in casts.items() if plain.get(c) != kinds[c]})


def removed_by() -> Column:
    """Name of the first filter a row fails, or ``kept``."""
    day, budget, revenue = F.col("release_date"), F.col("budget"), F.col("revenue")

    def fails(passes: Column) -> Column:
        return ~F.coalesce(passes, F.lit(False))

    return (
        F.when(fails(day >= F.lit(FIRST_DATE).cast("date")), "too_old_or_undated")
        .when(fails(day <= F.lit(LAST_DATE).cast("date")), "future")
        .when(fails(both_positive(budget, revenue)) | F.isnan(budget) | F.isnan(revenue), "no_money")
        .when(fails((budget <= MAX_BUDGET) & (revenue <= MAX_REVENUE)), "outlier")
        .otherwise("kept")
    )


def kept(rows: DataFrame) -> DataFrame:
    """The same filters as plain conjuncts, which reach the scan."""
    day, budget, revenue = F.col("release_date"), F.col("budget"), F.col("revenue")
    return rows.where(
        day.between(F.lit(FIRST_DATE).cast("date"), F.lit(LAST_DATE).cast("date"))
        & both_positive(budget, revenue)
        & (budget <= MAX_BUDGET)
        & (revenue <= MAX_REVENUE)
    )


def fill_missing(rows: DataFrame) -> DataFrame:
    """Defaults for missing text and votes; runtime takes the median of the rows."""
    defaults = {
        "genres": UNKNOWN,
        "production_companies": UNKNOWN,
        "overview": "",
        "vote_average": 0.0,
        "vote_count": 0.0,
    }
    filled = rows.na.fill({c: v for c, v in defaults.items() if c in rows.columns})
    if "runtime" not in rows.columns:
        return filled
    return filled.withColumn("runtime", F.coalesce("runtime", exact_median(rows, "runtime")))


def with_derived(rows: DataFrame) -> DataFrame:
    budget, revenue, day = F.col("budget"), F.col("revenue"), F.col("release_date")
    return rows.withColumns(
        {
            "profit": profit(revenue, budget),
            "roi": roi(revenue, budget),
            "release_year": F.year(day),
            "release_month": F.month(day),
        }
    )


def clean_movies(raw: DataFrame) -> DataFrame:
    """Filter, fill, derive and type raw titles."""
    rows = with_derived(fill_missing(kept(typed(raw))))
    return rows.select(
        *[F.col(f.name).cast(f.dataType) for f in CLEANED if f.name in rows.columns]
    )


def step_counts(raw: DataFrame) -> DataFrame:
    """(step, rows, percent): rows each filter removed and rows kept, in one pass."""
    found = typed(raw).groupBy(removed_by().alias("step")).agg(F.count("*").alias("rows"))

    def total(rows: Column) -> Column:
        return F.coalesce(F.sum(rows), F.lit(0))

    one = found.agg(
        *[total(F.when(F.col("step") == s, F.col("rows"))).alias(s) for s in STEPS],
        total(F.col("rows")).alias("_all"),
    )
    listed = one.select(
        "_all",
        F.explode(
            F.array(*[F.struct(F.lit(s).alias("step"), F.col(s).alias("rows")) for s in STEPS])
        ).alias("s"),
    )
    return listed.select("s.step", "s.rows", percent(F.col("s.rows"), F.col("_all")).alias("pct"))


def cleaning_summary(raw: DataFrame) -> DataFrame:
    """One row: input size, what was missing or zero, what is left, reduction in percent."""
    step = F.col("_step")
    dated = step.isin("no_money", "outlier", "kept")
    counts = typed(raw).withColumn("_step", removed_by()).agg(
        F.count("*").alias("raw_rows"),
        F.count_if(F.col("release_date").isNull()).alias("invalid_dates"),
        F.count_if(step == "too_old_or_undated").alias("removed_old"),
        F.count_if(step == "future").alias("removed_future"),
        F.count_if(dated & (F.col("budget") == 0)).alias("zero_budget"),
        F.count_if(dated & (F.col("revenue") == 0)).alias("zero_revenue"),
        F.count_if(step == "no_money").alias("removed_financial"),
        F.count_if(step == "outlier").alias("removed_outliers"),
        F.count_if(step == "kept").alias("cleaned_rows"),
    )
    dated_rows = F.col("raw_rows") - F.col("removed_old") - F.col("removed_future")
    return counts.select(
        "*",
        percent(F.col("zero_budget"), dated_rows).alias("zero_budget_pct"),
        percent(F.col("zero_revenue"), dated_rows).alias("zero_revenue_pct"),
        percent(F.col("raw_rows") - F.col("cleaned_rows"), F.col("raw_rows")).alias(
            "reduction_pct"
        ),
    )


def cleaned_ranges(cleaned: DataFrame) -> DataFrame:
    """One row: rows, first and last date, and ranges of budget, revenue and roi."""
    return cleaned.agg(
        F.count("*").alias("rows"),
        *[
            fn(c).alias(f"{name}_{c}")
            for c in ("release_date", "budget", "revenue", "roi")
            for name, fn in (("min", F.min), ("max", F.max))
        ],
    )
