"""Registered queries: each operator over the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from filmdw.fixed_values import FACT_TABLE, STAGING_TABLE
from filmdw.functions.dates import strict_date
from filmdw.functions.text import CASELESS, first_known
from filmdw.operators import (
    aggregates,
    cleaning,
    delta,
    dimensions,
    fact as facts,
    forecast,
    models,
    profiling,
    quality,
    regression,
    staging as stages,
)
from filmdw.operators.lookup import first_match, keep_known, keep_unknown, lookup
from filmdw.plans import rough_queries, warehouse_queries
from filmdw.session import conf, run_together, scratch_root, write_stage
from filmdw.sources.bindings import (
    detail_documents,
    raw_from_orders,
    staging_from_orders,
    table,
)
from filmdw.sources.files import read_cleaned_csv, read_part
from filmdw.sources.quoted_csv import read_quoted_csv
from filmdw.sources.writers import write_csv, write_parts
from filmdw.streaming.incremental import load_new_files, load_new_ids, read_loaded, rejects_of

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

AS_OF = "2001-01-01"
GENRES, COMPANIES = ("genres",), ("production_companies",)


def register(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


def rounded(df: DataFrame, **digits: int) -> DataFrame:
    """Cut the last bits, which depend on the order of a sum."""
    return df.withColumns({c: F.round(c, n) for c, n in digits.items()})


def rounded_measures(df: DataFrame) -> DataFrame:
    return rounded(
        df,
        total_revenue=2,
        total_budget=2,
        avg_revenue=4,
        avg_budget=4,
        avg_roi=6,
        avg_rating=6,
    )


BUILDERS = {
    "genres": dimensions.build_dim_genre,
    "times": dimensions.build_dim_time,
    "countries": dimensions.build_dim_country,
    "studios": dimensions.build_dim_studio,
}
CHECKED = ("genres", "times", "studios")


@dataclass(frozen=True)
class Star:
    """Staging, written once because several tables are built from it, and dimensions."""

    staging: DataFrame
    genres: DataFrame | None = None
    times: DataFrame | None = None
    countries: DataFrame | None = None
    studios: DataFrame | None = None

    def fact(self, **options) -> DataFrame:
        dims = (self.genres, self.times, self.countries, self.studios)
        return facts.build_fact(self.staging, *dims, as_of=AS_OF, **options)

    def model_stg(self) -> DataFrame:
        return models.stg_movies(self.staging)

    def model_fact(self) -> DataFrame:
        return models.fact_movies(self.model_stg(), self.genres, self.times, self.studios, AS_OF)


def star(spark: SparkSession, sf_dir: str, *wanted: str) -> Star:
    """Staging and the dimensions a query needs."""
    staging = write_stage(staging_from_orders(spark, sf_dir), "staging")
    builds = [lambda b=BUILDERS[name]: b(staging, AS_OF) for name in wanted]
    return Star(staging, **dict(zip(wanted, run_together(spark, *builds))))


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned titles from raw ones written once: the median is a second use of them."""
    return cleaning.clean_movies(write_stage(raw_from_orders(spark, sf_dir), "raw"))


# Dimensions


@register
def dim_genre(spark: SparkSession, sf_dir: str) -> DataFrame:
    staging = staging_from_orders(spark, sf_dir, GENRES)
    return dimensions.build_dim_genre(staging, AS_OF).drop("created_date")


@register
def dim_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    staging = staging_from_orders(spark, sf_dir, ())
    return dimensions.build_dim_time(staging, AS_OF).drop("created_date")


@register
def dim_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    staging = staging_from_orders(spark, sf_dir, ())
    return dimensions.build_dim_country(staging, AS_OF).drop("created_date")


@register
def dim_studio(spark: SparkSession, sf_dir: str) -> DataFrame:
    staging = staging_from_orders(spark, sf_dir, COMPANIES)
    return dimensions.build_dim_studio(staging, AS_OF).drop("created_date")


# Fact and joins


@register
def fact_genre_grain(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = star(spark, sf_dir, *BUILDERS).fact().drop("created_date")
    return rounded(rows, profit=2, roi=6)


@register
def fact_without_broadcasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same fact with every dimension taken as too large to broadcast."""
    rows = star(spark, sf_dir, *BUILDERS).fact(broadcast_rows=0).drop("created_date")
    return rounded(rows, profit=2, roi=6)


def respelled(staging: DataFrame) -> DataFrame:
    """Names in several cases and languages with trailing blanks."""
    turn, genres, studios = F.col("movie_id"), F.col("genres"), F.col("production_companies")
    third = F.pmod(turn, F.lit(3))
    language = F.col("original_language")
    return staging.withColumns(
        {
            "genres": F.when(third == 0, F.lower(genres)).when(third == 1, F.upper(genres)).otherwise(genres),
            "production_companies": F.when(F.pmod(turn, F.lit(4)) == 0, F.lower(studios)).otherwise(studios),
            "original_language": F.when(
                F.pmod(turn, F.lit(5)) == 0, F.concat(language, F.lit("  "))
            ).otherwise(language),
        }
    )


@register
def fact_caseless(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of titles whose names differ from the dimensions' in case and trailing blanks only."""
    staging = write_stage(staging_from_orders(spark, sf_dir), "staging")
    varied = write_stage(respelled(staging), "respelled")
    genres, countries, studios = run_together(
        spark,
        lambda: dimensions.build_dim_genre(varied, AS_OF, CASELESS),
        lambda: dimensions.build_dim_country(staging, AS_OF),
        lambda: dimensions.build_dim_studio(varied, AS_OF, CASELESS),
    )
    rows = facts.build_fact(varied, genres, None, countries, studios, as_of=AS_OF, collation=CASELESS)
    return rows.select("movie_id", "genre_id", "studio_id", "country_id")


@register
def dim_genre_caseless(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Genres once each, whatever their case; the first spelling in binary order names one."""
    varied = respelled(staging_from_orders(spark, sf_dir))
    return dimensions.build_dim_genre(varied, AS_OF, CASELESS).drop("created_date")


@register
def dq_unique_caseless(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names that occur more than once when case and trailing blanks do not count."""
    parts = table(spark, sf_dir, "part").select(F.col("p_type").alias("name"), F.col("p_partkey").alias("turn"))
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("name"), F.col("c_custkey").alias("turn")
    )

    def lower(rows: DataFrame, every: int, blanks: str) -> DataFrame:
        again = rows.where(F.pmod("turn", F.lit(every)) == 0)
        return again.withColumn("name", F.concat(F.lower("name"), F.lit(blanks)))

    rows = parts.unionByName(lower(parts, 2, " ")).unionByName(customers)
    return quality.failing_unique(rows.unionByName(lower(customers, 10, "  ")), "name", CASELESS)


@register
def fact_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.null_key_counts(star(spark, sf_dir, *CHECKED).fact())


@register
def fact_top_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = star(spark, sf_dir, "genres", "times")
    rows = facts.top_revenue(tables.fact(), tables.genres, tables.times)
    return rounded(rows, profit=2, roi=6, revenue_billions=9)


@register
def fact_model_first_token(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = star(spark, sf_dir, *CHECKED).model_fact().drop("updated_at")
    return rounded(rows, profit=2, roi=6)


@register
def country_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Country key of every title in both modes."""
    staging = write_stage(staging_from_orders(spark, sf_dir, ()), "staging")
    countries = dimensions.build_dim_country(staging, AS_OF)
    rows = staging.select("movie_id", "original_language")
    by_code = facts.with_country(rows, countries).withColumnRenamed("country_id", "by_code")
    both = facts.with_country(by_code.drop("country_code"), countries, "language")
    return both.select(
        "movie_id", "original_language", "by_code", F.col("country_id").alias("by_language")
    )


@register
def studio_first_known(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = staging_from_orders(spark, sf_dir, COMPANIES)
    return rows.select(
        "movie_id", first_known(F.col("production_companies")).alias("studio_name")
    )


@register
def customers_without_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anti join of two large tables, per segment."""
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("custkey"), "c_mktsegment", "c_acctbal"
    )
    buyers = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("custkey"))
    idle = keep_unknown(customers, buyers, "custkey")
    return idle.groupBy("c_mktsegment").agg(
        F.count("*").alias("customers"), F.count_if(F.col("c_acctbal") < 0).alias("negative")
    )


@register
def orders_with_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Semi join, per order status."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("orderkey"), "o_orderstatus"
    )
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("orderkey"))
    kept = keep_known(orders, lines, "orderkey")
    return kept.groupBy("o_orderstatus").agg(F.count("*").alias("orders"))


@register
def line_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines whose order, part or supplier does not exist, as one row per rule."""
    keys = {"l_orderkey": "orders", "l_partkey": "part", "l_suppkey": "supplier"}
    owners = {"orders": "o_orderkey", "part": "p_partkey", "supplier": "s_suppkey"}
    lines = table(spark, sf_dir, "lineitem")
    result = None
    for key, owner in keys.items():
        names = table(spark, sf_dir, owner).select(F.col(owners[owner]).alias(key))
        row = quality.orphan_count(lines, names, key).select(
            F.lit(key).alias("key"), "invalid_records"
        )
        result = row if result is None else result.unionByName(row)
    return result


@register
def documents_without_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Left join with gaps: documents and labelled documents per language."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    labels = table(spark, sf_dir, "labels")
    joined = lookup(documents, labels, "doc_id")
    return joined.groupBy("lang").agg(
        F.count("*").alias("documents"),
        F.count("quality").alias("labelled"),
        F.coalesce(F.sum("quality"), F.lit(0)).alias("good"),
        F.sum("n_chars").alias("chars"),
    )


@register
def sample_coverage_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coverage of a 100-title sample, which is the operator, in whole layers."""
    tables = Star(write_stage(staging_from_orders(spark, sf_dir), "staging"))
    sample = quality.ordered_sample(tables.staging.select("movie_id"), "movie_id")
    layers = {STAGING_TABLE: tables.staging, FACT_TABLE: tables.fact()}
    return rounded(quality.sample_coverage(sample, layers), pct=6)


# Aggregates


@register
def genre_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = star(spark, sf_dir, "genres")
    rows = aggregates.aggregate_by_genre(tables.fact(), tables.genres, AS_OF)
    return rounded_measures(rows.drop("last_updated"))


@register
def yearly_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = star(spark, sf_dir, "times")
    rows = aggregates.aggregate_by_year(tables.fact(), tables.times, AS_OF)
    return rounded_measures(rows.drop("last_updated"))


@register
def agg_by_genre_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = star(spark, sf_dir, "genres")
    rows = models.agg_by_genre(tables.model_fact(), tables.genres, AS_OF)
    return rounded_measures(rows.drop("last_updated"))


@register
def top_genres(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = star(spark, sf_dir, "genres")
    rows = aggregates.aggregate_by_genre(tables.fact(), tables.genres, AS_OF)
    return rounded(aggregates.top_genres(rows), revenue_billions=9, avg_roi=6)


@register
def recent_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = star(spark, sf_dir, "times")
    rows = aggregates.aggregate_by_year(tables.fact(), tables.times, AS_OF)
    return rounded(aggregates.recent_years(rows), revenue_billions=9, avg_budget_millions=9)


@register
def rows_per_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stages.rows_per_source(staging_from_orders(spark, sf_dir, ()))


@register
def segment_yearly_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly order value per customer segment; customers are summed before the join."""
    orders = table(spark, sf_dir, "orders")
    per_customer = orders.groupBy(
        F.col("o_custkey").alias("c_custkey"), F.year("o_orderdate").alias("year")
    ).agg(F.sum("o_totalprice").alias("revenue"), F.count("*").alias("orders"))
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    rows = per_customer.join(customers, "c_custkey").groupBy("c_mktsegment", "year").agg(
        F.sum("revenue").alias("total_revenue"), F.sum("orders").alias("orders")
    )
    return rounded(rows, total_revenue=2)


# Cleaning and staging


@register
def clean_movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(cleaned(spark, sf_dir), profit=2, roi=6).drop("overview")


@register
def clean_step_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(cleaning.step_counts(raw_from_orders(spark, sf_dir, ())), pct=6)


@register
def cleaning_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cleaning.cleaning_summary(raw_from_orders(spark, sf_dir, ()))
    return rounded(rows, zero_budget_pct=6, zero_revenue_pct=6, reduction_pct=6)


@register
def cleaned_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cleaning.cleaned_ranges(cleaned(spark, sf_dir))
    return rounded(rows, min_roi=6, max_roi=6)


@register
def staging_fill_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned titles as a part load stages them."""
    raw = raw_from_orders(spark, sf_dir)
    rows = cleaning.with_derived(cleaning.kept(cleaning.typed(raw)))
    rows = rows.withColumn("overview", F.lit(None).cast("string"))
    staged = stages.staging_rows(rows, F.col("source"), AS_OF, strict_dates=False)
    return rounded(staged.drop("load_date"), profit=2, roi=6)


@register
def staging_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many raw titles could not be staged, per reason."""
    _, rejects = stages.split_rejects(staging_from_orders(spark, sf_dir, ()))
    return rejects.groupBy("reject_reason").agg(F.count("*").alias("rows"))


@register
def load_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts already staged are skipped, others are loaded, per source."""
    rows = write_stage(staging_from_orders(spark, sf_dir, ()), "staging")
    loaded = rows.where(F.col("source").isin(stages.part_source(1), stages.part_source(2)))
    return stages.rows_per_source(stages.load_once(loaded, rows))


@register
def split_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = staging_from_orders(spark, sf_dir, ()).select("movie_id", "revenue")
    return stages.split_dataset(rows, ["movie_id"])


@register
def purge_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per source, and what a purge removes, over part, full and detail loads."""
    parts = staging_from_orders(spark, sf_dir, ()).select("movie_id", "source")
    full = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("movie_id"), F.lit("CSV").alias("source")
    )
    details = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("movie_id"), F.lit("TMDB_API").alias("source")
    )
    untagged = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("bigint").alias("movie_id")
    )
    return stages.purge_report(stages.append_sources(parts, full, details, untagged))


@register
def purge_remaining(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = staging_from_orders(spark, sf_dir, ()).select("movie_id", "source")
    details = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("movie_id"), F.lit("TMDB_API").alias("source")
    )
    return stages.purge_staging(stages.append_sources(parts, details))


@register
def stg_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = models.stg_movies(staging_from_orders(spark, sf_dir)).drop("load_date")
    return rounded(rows, profit=2, roi=6)


@register
def dim_genre_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    genres = dimensions.build_dim_genre(staging_from_orders(spark, sf_dir, GENRES), AS_OF)
    return models.dim_genre(genres, AS_OF).drop("updated_at")


@register
def median_fill_runtime(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and sum of the runtime before and after the fill by the exact median."""
    raw = raw_from_orders(spark, sf_dir, ()).select("id", "runtime")
    filled = cleaning.fill_missing(write_stage(raw, "raw").withColumn("given", F.col("runtime")))
    missing = F.col("given").isNull()
    return filled.agg(
        F.count("*").alias("rows"),
        F.count_if(missing).alias("filled"),
        F.max(F.when(missing, F.col("runtime"))).alias("median"),
        F.round(F.sum("runtime"), 2).alias("total_runtime"),
    )


# Profiles


PROFILED = [
    "movie_id",
    "title",
    "genres",
    "original_language",
    "popularity",
    "production_companies",
    "release_date",
    "budget",
    "revenue",
    "runtime",
    "vote_average",
    "vote_count",
    "source",
]


def _profiled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.columns_present(staging_from_orders(spark, sf_dir), PROFILED)


@register
def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profiling.null_profile(_profiled(spark, sf_dir)), missing_pct=6)


@register
def top_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profiling.top_missing(_profiled(spark, sf_dir)), missing_pct=6)


@register
def distinct_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.distinct_profile(_profiled(spark, sf_dir))


@register
def describe_money(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = write_stage(staging_from_orders(spark, sf_dir, ()).select("budget", "revenue"), "money")
    stats = profiling.describe(rows, ["budget", "revenue"])
    return rounded(stats, mean=4, std=4, p25=4, p50=4, p75=4)


@register
def describe_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    stats = profiling.describe(table(spark, sf_dir, "lineitem"), columns)
    stats = stats.withColumn("min", F.col("min") + 0.0)
    return rounded(stats, mean=6, std=6, p25=4, p50=4, p75=4)


@register
def token_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Untrimmed genre tokens of all titles."""
    return profiling.token_counts(staging_from_orders(spark, sf_dir, GENRES), "genres")


@register
def top_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = staging_from_orders(spark, sf_dir, GENRES)
    return profiling.most_frequent(profiling.token_counts(rows, "genres"))


@register
def decade_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.decade_histogram(staging_from_orders(spark, sf_dir, ()))


@register
def year_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.year_counts(staging_from_orders(spark, sf_dir, ()))


@register
def date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.date_range(staging_from_orders(spark, sf_dir, ()))


@register
def top_grossing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = profiling.top_grossing(staging_from_orders(spark, sf_dir, ()), "movie_id")
    return rounded(rows, revenue_billions=9, budget_millions=9)


@register
def top_staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = staging_from_orders(spark, sf_dir, ())
    top = rows.orderBy(F.desc("revenue"), "movie_id").limit(5)
    return rounded(
        top.select("movie_id", "title", "release_date", "budget", "revenue", "roi"), roi=6
    )


@register
def duplicate_line_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows sharing an order key, over all lines."""
    return profiling.duplicate_keys(table(spark, sf_dir, "lineitem"), "l_orderkey")


@register
def document_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null profile of whole documents."""
    rows = profiling.null_profile(table(spark, sf_dir, "documents"))
    return rounded(rows, missing_pct=6)


# Quality


def _report(tables: Star) -> DataFrame:
    return quality.quality_report(
        tables.staging, tables.fact(), tables.genres, tables.times, tables.studios, AS_OF
    )


@register
def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _report(star(spark, sf_dir, *CHECKED)).drop("timestamp")
    return rounded(rows, invalid_percentage=6)


@register
def dq_report_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rules over staging and fact rows broken by remainders of their key, so that every rule has
    something to find; dimensions are checked without broadcasts."""
    tables = star(spark, sf_dir, *CHECKED)

    def broken(column: str, *cases: tuple[int, Column | float | None]) -> Column:
        value = F.col(column)
        for divisor, other in reversed(cases):
            bad = other if isinstance(other, Column) else F.lit(other)
            value = F.when(F.pmod("movie_id", F.lit(divisor)) == 0, bad).otherwise(value)
        return value.alias(column)

    away = 100_000_000
    in_staging = {
        "movie_id": broken("movie_id", (61, None)),
        "revenue": broken("revenue", (67, -1.0)),
        "runtime": broken("runtime", (71, -5.0)),
    }
    in_fact = {
        "genre_id": broken("genre_id", (59, F.col("genre_id") + away)),
        "time_id": broken("time_id", (61, None), (73, F.col("time_id") + away)),
        "studio_id": broken("studio_id", (67, None), (97, F.col("studio_id") + away)),
        "budget": broken("budget", (79, -1.0), (83, 0.0)),
        "revenue": broken("revenue", (71, -1.0)),
        "vote_average": broken("vote_average", (103, 11.0)),
        "roi": broken("roi", (89, 5000.0)),
    }
    fact = tables.fact()
    report = quality.quality_report(
        tables.staging.select(*[in_staging.get(c, F.col(c)) for c in tables.staging.columns]),
        fact.select(*[in_fact.get(c, F.col(c)) for c in fact.columns]),
        tables.genres, tables.times, tables.studios, AS_OF, broadcast_rows=0,
    )
    return rounded(report.drop("timestamp"), invalid_percentage=6)


@register
def first_match_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lowest part number of each type."""
    return first_match(table(spark, sf_dir, "part"), "p_type", "p_partkey")


@register
def strict_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order days from text that must be a date."""
    text = F.date_format("o_orderdate", "yyyy-MM-dd")
    return table(spark, sf_dir, "orders").select("o_orderkey", strict_date(text).alias("day"))


@register
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned titles written as delimited text and read back."""
    path = _run_folder(spark, "csv")
    write_csv(cleaned(spark, sf_dir), path)
    back = cleaning.typed(read_cleaned_csv(spark, path))
    return back.select("id", "title", "genres", "release_date", "budget", "revenue")


@register
def csv_quoted_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with line breaks and quotes, written to delimited files and read in ranges of them."""
    path = _run_folder(spark, "quoted")
    kinds = "doc_id string, source string, text string"
    write_csv(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), path)
    with conf(spark, **{"spark.sql.files.maxPartitionBytes": "256k", "spark.sql.files.openCostInBytes": "1"}):
        rows = write_stage(read_quoted_csv(spark, path, StructType.fromDDL(kinds)), "quoted")
    return rows.withColumn("doc_id", F.col("doc_id").cast("long"))


@register
def parts_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positional parts written one folder each; the second and third are read back alone."""
    path = _run_folder(spark, "parts")
    rows = staging_from_orders(spark, sf_dir, ()).select("movie_id", "revenue")
    write_parts(stages.split_dataset(rows, ["movie_id"]), path)
    parts = [read_part(spark, path, n).withColumn("part", F.lit(n)) for n in (2, 3)]
    return parts[0].unionByName(parts[1])


@register
def dq_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.overall_quality(_report(star(spark, sf_dir, *CHECKED)))
    return rounded(rows, invalid_percentage=6)


@register
def top_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.top_issues(_report(star(spark, sf_dir, *CHECKED)))


@register
def multi_genre_films(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.repeated_titles(facts.build_fact(staging_from_orders(spark, sf_dir)))


@register
def loss_making_films(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = facts.build_fact(staging_from_orders(spark, sf_dir))
    return rounded(quality.loss_making(fact), pct=6)


@register
def dq_model_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 11 column tests of the models."""
    tables = star(spark, sf_dir, "genres")
    fact = write_stage(tables.model_fact(), "model_fact")
    return quality.model_tests(
        tables.model_stg(),
        models.dim_genre(tables.genres, AS_OF),
        fact,
        models.agg_by_genre(fact, tables.genres, AS_OF),
    )


@register
def dq_unique_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order keys that occur on more than one line."""
    return quality.failing_unique(table(spark, sf_dir, "lineitem"), "l_orderkey")


@register
def dq_not_null_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles without a genre list."""
    rows = staging_from_orders(spark, sf_dir, GENRES).select("movie_id", "genres")
    return quality.failing_not_null(rows, "genres").select("movie_id")


@register
def dq_formula_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.formula_match(staging_from_orders(spark, sf_dir, ()))
    return rounded(rows, profit_pct=6, roi_pct=6)


@register
def dq_cleaned_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(quality.cleaned_checks(cleaned(spark, sf_dir)), value=6)


@register
def dq_combined_invalid(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.combined_invalid(staging_from_orders(spark, sf_dir, ()))
    return rounded(rows, invalid_percentage=6)


@register
def dq_layer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = star(spark, sf_dir, *CHECKED)
    return quality.layer_counts(
        {
            STAGING_TABLE: tables.staging,
            "Dim_Genre": tables.genres,
            "Dim_Time": tables.times,
            "Dim_Studio": tables.studios,
            FACT_TABLE: tables.fact(),
        }
    )


# Documents


@register
def events_props_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A field of a JSON text column, per event type."""
    events = table(spark, sf_dir, "events")
    k = F.coalesce(F.from_json("props", "k bigint")["k"], F.lit(0))
    return events.select("event_type", k.alias("k")).groupBy("event_type").agg(
        F.count("*").alias("events"), F.sum("k").alias("total_k"), F.max("k").alias("max_k")
    )


@register
def listing_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing pages of twenty ids, read back as one row per id."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    # a page holds at most twenty ids: the key is unique
    pages = orders.groupBy(F.floor(F.col("o_orderkey") / 20).alias("page")).agg(
        F.collect_list(F.struct(F.col("o_orderkey").alias("id"))).alias("results")
    )
    text = pages.select(F.to_json(F.struct("results")).alias("json"))
    parsed = text.select(F.from_json("json", "results array<struct<id:bigint>>").alias("d"))
    return delta.listed_ids(parsed.select("d.results"))


@register
def details_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as a detail document, parsed to staging columns."""
    good, _ = delta.parse_detail_text(detail_documents(spark, sf_dir))
    rows = delta.parse_details(good, AS_OF, with_countries=True).drop("load_date")
    return rounded(rows, profit=2, roi=6)


def _first_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of parts 1 to 3; part 4 is what a delta load has still to bring."""
    staged = staging_from_orders(spark, sf_dir, ()).where("source != 'CSV_chunk_4'")
    return staged.select("movie_id")


@register
def delta_new_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose id is not staged in the first three parts."""
    good, _ = delta.parse_detail_text(detail_documents(spark, sf_dir))
    batch = delta.parse_details(good, AS_OF)
    staged = _first_parts(spark, sf_dir)
    new = delta.delta_load(staged, batch)
    return new.select("movie_id", "title", "genres", "release_date", "budget", "revenue", "profit")


# Regression


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return regression.regression_features(cleaned(spark, sf_dir))


# a rule with round weights, so that scores can be checked in any engine
GIVEN_RULE = regression.LinearRule(
    1000.0,
    {
        "budget": 1.0,
        "runtime": 100.0,
        "popularity": 10.0,
        "vote_average": 250.0,
        "vote_count": 50.0,
        "release_year": 2.0,
        "release_month": 4.0,
        "genre_encoded": 8.0,
        "studio_freq": 1.0,
    },
)


@register
def primary_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = regression.with_primary(staging_from_orders(spark, sf_dir))
    return rows.select("movie_id", "primary_genre", "primary_studio")


@register
def genre_label_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = regression.with_primary(staging_from_orders(spark, sf_dir))
    return regression.label_codes(rows, "primary_genre", "genre_encoded")


@register
def first_genre_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = regression.with_primary(staging_from_orders(spark, sf_dir))
    codes = regression.label_codes(rows, "primary_genre", "genre_encoded")
    return regression.first_labels(codes, "primary_genre", "genre_encoded")


@register
def studio_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = regression.with_primary(staging_from_orders(spark, sf_dir))
    return regression.frequencies(rows, "primary_studio", "studio_freq")


@register
def top_studios(spark: SparkSession, sf_dir: str) -> DataFrame:
    return regression.top_studios(regression.with_primary(staging_from_orders(spark, sf_dir)))


@register
def regression_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = regression.with_fold(regression.with_split(_features(spark, sf_dir)))
    return rows.select("id", "revenue", *regression.FEATURES, "split", "fold")


@register
def prediction_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = regression.predictions(regression.score(_features(spark, sf_dir), GIVEN_RULE))
    return rounded(rows, predicted_revenue=2, prediction_error=2, error_percentage=4)


@register
def split_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = regression.score(regression.with_split(_features(spark, sf_dir)), GIVEN_RULE)
    return rounded(regression.split_metrics(rows), r2=6, mae=4, rmse=4)


@register
def best_and_worst(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = regression.best_and_worst(regression.score(_features(spark, sf_dir), GIVEN_RULE))
    return rounded(rows, predicted_revenue=2, prediction_error=2)


def _fitted(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, regression.LinearRule]:
    rows = write_stage(regression.with_split(_features(spark, sf_dir)), "regression")
    return rows, regression.fit(rows.where(F.col("split") == "train"))


@register
def linear_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of the fitted model on both splits."""
    rows, rule = _fitted(spark, sf_dir)
    metrics = regression.split_metrics(regression.score(rows, rule))
    return rounded(metrics, r2=6, mae=2, rmse=2)


@register
def coefficient_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rule = _fitted(spark, sf_dir)
    return rounded(regression.coefficient_ranking(spark, rule), coefficient=4)


@register
def cross_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = write_stage(regression.with_fold(_features(spark, sf_dir)), "folds")
    scores = regression.cross_validation(rows)
    summary = regression.fold_summary(scores)
    rows = scores.select("fold", "rows", "r2").withColumns(
        {
            "mean_r2": summary.select("mean_r2").scalar(),
            "std_r2": summary.select("std_r2").scalar(),
        }
    )
    return rounded(rows, r2=6, mean_r2=6, std_r2=6)


# Forecast


def _rounded_forecast(rows: DataFrame) -> DataFrame:
    return rounded(rows, predicted_revenue_B=6, lower_bound_B=6, upper_bound_B=6)


@register
def yearly_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = star(spark, sf_dir, "times")
    rows = aggregates.aggregate_by_year(tables.fact(), tables.times, AS_OF)
    return rounded(forecast.yearly_series(rows), y=9)


@register
def yearly_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = star(spark, sf_dir, "times")
    rows = aggregates.aggregate_by_year(tables.fact(), tables.times, AS_OF)
    return _rounded_forecast(forecast.trend_forecast(forecast.yearly_series(rows)))


@register
def recent_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = star(spark, sf_dir, "times")
    rows = aggregates.aggregate_by_year(tables.fact(), tables.times, AS_OF)
    series = forecast.recent_history(forecast.yearly_series(rows), first_year=1999)
    return rounded(series, y=9)


@register
def segment_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One forecast per customer segment, all fitted in one pass."""
    yearly = segment_yearly_revenue(spark, sf_dir)
    series = forecast.yearly_series(yearly, ["c_mktsegment"])
    return _rounded_forecast(forecast.trend_forecast(series, ["c_mktsegment"]))


@register
def changepoint_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A trend with three changes of slope in all yearly revenue."""
    tables = star(spark, sf_dir, "times")
    rows = aggregates.aggregate_by_year(tables.fact(), tables.times, AS_OF)
    series = forecast.yearly_series(rows)
    return _rounded_forecast(forecast.changepoint_forecast(series, changepoints=3))


@register
def segment_changepoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for each customer segment, all fitted in one pass."""
    series = forecast.yearly_series(segment_yearly_revenue(spark, sf_dir), ["c_mktsegment"])
    return _rounded_forecast(forecast.changepoint_forecast(series, ["c_mktsegment"], changepoints=2))


# Incremental loads


def _run_folder(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/filmdw/{label}-{uuid.uuid4().hex}"


@register
def incremental_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events file as a stream, run twice: the second run must add nothing."""
    schema = table(spark, sf_dir, "events").schema
    folder = _run_folder(spark, "events")
    target, checkpoint = f"{folder}/target", f"{folder}/checkpoint"
    for _ in range(2):
        load_new_files(
            spark, sf_dir, schema, target, checkpoint, pathGlobFilter="events.parquet"
        )
    loaded = read_loaded(spark, target, schema)
    return loaded.groupBy("event_type").agg(
        F.count("*").alias("events"),
        F.countDistinct("event_id").alias("ids"),
        F.round(F.sum("value"), 2).alias("total_value"),
    )


@register
def incremental_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detail documents as a stream over what is staged: unseen ids, once each."""
    folder = _run_folder(spark, "details")
    landing, target, checkpoint = (f"{folder}/{n}" for n in ("landing", "target", "checkpoint"))
    detail_documents(spark, sf_dir).withColumnRenamed("json", "value").write.text(landing)
    staged = _first_parts(spark, sf_dir)
    for _ in range(2):
        load_new_ids(spark, landing, target, checkpoint, staged, AS_OF)
    loaded = read_loaded(spark, target, stages.STAGING)
    return loaded.select("movie_id", "title", "release_date", "revenue", "source")


@register
def delta_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of which every 53rd is cut short and every 59th has a null budget: what a load keeps
    and what it puts aside."""
    folder = _run_folder(spark, "rejects")
    landing, target, checkpoint = (f"{folder}/{n}" for n in ("landing", "target", "checkpoint"))
    key = F.get_json_object("json", "$.id").cast("bigint")
    no_budget = F.regexp_replace("json", '"budget":[^,]*,', '"budget":null,')
    text = F.when(F.pmod(key, F.lit(53)) == 0, F.substring("json", F.lit(1), F.length("json") - 9)).when(
        F.pmod(key, F.lit(59)) == 0, no_budget
    )
    documents = detail_documents(spark, sf_dir)
    documents.select(F.coalesce(text, F.col("json")).alias("value")).write.text(landing)
    load_new_ids(spark, landing, target, checkpoint, None, AS_OF)
    loaded = read_loaded(spark, target, stages.STAGING).select(F.lit("loaded").alias("outcome"))
    aside = spark.read.schema("json string").parquet(rejects_of(target))
    why = F.when(F.col("json").endswith("}"), "null budget").otherwise("cut short")
    return loaded.unionByName(aside.select(why.alias("outcome"))).groupBy("outcome").agg(
        F.count("*").alias("documents")
    )


QUERIES.update(warehouse_queries.QUERIES)
QUERIES.update(rough_queries.ROUGH_QUERIES)
