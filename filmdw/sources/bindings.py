"""Order tables read as film data.

An order is a title, its part types are the genres and its suppliers the
production companies. Fixed key remainders decide which values of a row are
missing or odd, so that every rule has something to find; no row is left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from filmdw.functions.numbers import profit, roi
from filmdw.schemas import STAGING

LISTS = ("genres", "production_companies")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _every(n: int) -> Column:
    return F.pmod("o_orderkey", F.lit(n)) == 0


def _joined(names: str) -> Column:
    return F.array_join(F.sort_array(names), "-")


def film_rows(spark: SparkSession, sf_dir: str, lists: tuple[str, ...] = LISTS) -> DataFrame:
    """One row per order; without lines, no budget and no lists. Only the tables behind ``lists`` are joined.

    Sums and name sets are merged before the shuffle, so an order with very many
    lines costs one row per task; its set holds each name once.
    """
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_tax"
    )
    sums = [
        F.sum("l_extendedprice").alias("_price"),
        F.sum("l_quantity").alias("_quantity"),
        F.sum("l_tax").alias("_tax"),
        F.count("*").alias("_lines"),
    ]
    if "genres" in lists:
        part = table(spark, sf_dir, "part").select("p_partkey", "p_type")
        lines = lines.join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
        sums.append(F.collect_set("p_type").alias("_types"))
    if "production_companies" in lists:
        supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
        lines = lines.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"), "left")
        sums.append(F.collect_set("s_name").alias("_names"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    per_order = lines.groupBy("l_orderkey").agg(*sums)
    rows = orders.join(per_order, F.col("o_orderkey") == F.col("l_orderkey"), "left")

    columns = {
        "movie_id": F.col("o_orderkey"),
        "title": F.when(_every(97), "").otherwise(
            F.concat(F.lit("T"), F.col("o_orderkey").cast("string"))
        ),
        "original_language": F.element_at(
            F.array(
                *[F.lit(v) for v in ("en", "fr", "ja", "cn", "zh", "xx", "de")],
                F.lit(None).cast("string"),
            ),
            (F.pmod("o_orderkey", F.lit(8)) + 1).cast("int"),
        ),
        "release_date": F.when(~_every(19), F.col("o_orderdate").cast("date")),
        "budget": F.when(_every(13), 0.0).when(_every(101), -1.0).otherwise(
            F.coalesce(F.round("_price", 2), F.lit(0.0))
        ),
        "revenue": F.when(_every(29), 0.0).otherwise(F.col("o_totalprice")),
        "runtime": F.when(_every(11), F.lit(None)).when(_every(31), 700.0).otherwise(
            F.col("_quantity")
        ),
        "vote_average": F.when(_every(89), 11.0).otherwise(
            F.least(F.coalesce("_lines", F.lit(0)).cast("double"), F.lit(10.0))
        ),
        "vote_count": F.when(~_every(7), F.col("_lines").cast("double")),
        "popularity": F.round("_tax", 2),
        "source": F.concat(
            F.lit("CSV_chunk_"), (F.pmod("o_orderkey", F.lit(4)) + 1).cast("string")
        ),
    }
    if "genres" in lists:
        types = _joined("_types")
        columns["genres"] = (
            F.when(_every(17), F.lit(None))
            .when(_every(37), F.concat(F.lit(" "), types, F.lit(" - ")))
            .when(_every(41), "Unknown")
            .otherwise(types)
        )
    if "production_companies" in lists:
        names = _joined("_names")
        columns["production_companies"] = (
            F.when(_every(23), F.lit(None))
            .when(_every(43), "Unknown")
            .when(_every(47), F.concat(F.lit("Unknown- "), names))
            .otherwise(names)
        )
    return rows.select(*[c.alias(n) for n, c in columns.items()])


def staging_from_orders(
    spark: SparkSession, sf_dir: str, lists: tuple[str, ...] = LISTS
) -> DataFrame:
    """The same rows with the staging columns; a list not asked for is absent."""
    budget, revenue, day = F.col("budget"), F.col("revenue"), F.col("release_date")
    rows = film_rows(spark, sf_dir, lists).withColumns(
        {
            "overview": F.lit(None).cast("string"),
            "profit": profit(revenue, budget),
            "roi": roi(revenue, budget),
            "release_year": F.year(day),
            "release_month": F.month(day),
            "load_date": F.lit("2001-01-01").cast("timestamp"),
        }
    )
    return rows.select(*[f.name for f in STAGING if f.name in rows.columns])


def raw_from_orders(
    spark: SparkSession, sf_dir: str, lists: tuple[str, ...] = LISTS
) -> DataFrame:
    """The same rows as they would arrive for cleaning."""
    rows = film_rows(spark, sf_dir, lists).withColumnRenamed("movie_id", "id")
    return rows.withColumn("overview", F.lit(None).cast("string"))


def rough_from_orders(
    spark: SparkSession, sf_dir: str, lists: tuple[str, ...] = LISTS
) -> DataFrame:
    """The raw rows with every value as text: some dates and numbers are none, some days lie outside the
    calendar of films and some money above its caps, titles are long, and some studios are major ones
    or have a long name."""
    rows = film_rows(spark, sf_dir, lists).withColumnRenamed("movie_id", "o_orderkey")
    day = F.date_format("release_date", "yyyy-MM-dd")
    by_rest = lambda n, rest: F.pmod("o_orderkey", F.lit(n)) == rest
    changed = {
        "title": F.concat("title", F.lit(": a title longer than what any narrow display shows")),
        "release_date": F.when(_every(59), "2031-02-03")
        .when(_every(67), "1899-12-31")
        .when(_every(71), "2001-02-30")
        .when(by_rest(5, 1), F.translate(day, "-", "/"))
        .otherwise(day),
        "budget": F.when(_every(53), "n/a").when(_every(61), "2000000000").otherwise(F.col("budget").cast("string")),
        "revenue": F.when(_every(73), "1.5e10").when(_every(79), "NaN").otherwise(F.col("revenue").cast("string")),
        "runtime": F.when(by_rest(3, 1), "two hours").otherwise(F.col("runtime").cast("string")),
    }
    if "production_companies" in lists:
        studios, region = F.col("production_companies"), F.pmod("o_orderkey", F.lit(7)).cast("string")
        changed["production_companies"] = (
            F.when(by_rest(4, 1), F.concat(F.lit("Columbia Pictures-"), studios))
            .when(by_rest(4, 2), F.concat(F.lit("Independent Film Makers of Region "), region, F.lit("-"), studios))
            .otherwise(studios)
        )
    numbers = {c: F.col(c).cast("string") for c in ("vote_average", "vote_count", "popularity")}
    key = F.col("o_orderkey").cast("string")
    rough = rows.withColumns({**changed, **numbers})
    return rough.select(
        F.when(by_rest(16, 1), F.concat(key, F.lit(".0"))).otherwise(key).alias("id"),
        *[c for c in rough.columns if c != "o_orderkey"],
        F.lit(None).cast("string").alias("overview"),
    )


def detail_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as a JSON detail document in a text column ``json``.

    Orders without lines get empty lists and no budget.
    """
    rows = table(spark, sf_dir, "orders").join(
        film_rows(spark, sf_dir), F.col("o_orderkey") == F.col("movie_id"), "left"
    )
    named = lambda column: F.transform(
        F.filter(F.split(column, "-"), lambda t: t != ""), lambda t: F.struct(t.alias("name"))
    )
    document = F.struct(
        F.col("o_orderkey").alias("id"),
        F.concat(F.lit("T"), F.col("o_orderkey").cast("string")).alias("title"),
        "original_language",
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("release_date"),
        "budget",
        F.col("o_totalprice").alias("revenue"),
        "runtime",
        "vote_average",
        "vote_count",
        named(F.col("genres")).alias("genres"),
        named(F.col("production_companies")).alias("production_companies"),
    )
    return rows.select(F.to_json(document).alias("json"))
