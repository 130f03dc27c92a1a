"""Schemas of the warehouse tables and of the raw inputs."""

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "boolean": T.BooleanType(),
}


def _struct(spec: str) -> T.StructType:
    """Schema from ``name type, ...``; needs no running session."""
    pairs = [field.split() for field in spec.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


def _list_of(name: str, spec: str) -> T.StructField:
    return T.StructField(name, T.ArrayType(_struct(spec)))


# Text columns as they arrive in a delimited file; numbers and dates are
# cast afterwards so that one bad value does not fail the read.
RAW_TEXT = _struct(
    "id string, title string, genres string, original_language string, overview string, "
    "popularity string, production_companies string, release_date string, budget string, "
    "revenue string, runtime string, vote_average string, vote_count string"
)
RAW_NUMBERS = ["popularity", "budget", "revenue", "runtime", "vote_average", "vote_count"]
CLEANED_TEXT = T.StructType(
    RAW_TEXT.fields
    + _struct("profit string, roi string, release_year string, release_month string").fields
)

CLEANED = _struct(
    "id bigint, title string, genres string, original_language string, overview string, "
    "popularity double, production_companies string, release_date date, budget double, "
    "revenue double, runtime double, vote_average double, vote_count double, profit double, "
    "roi double, release_year int, release_month int"
)

STAGING = _struct(
    "movie_id bigint, title string, genres string, original_language string, overview string, "
    "popularity double, production_companies string, release_date date, budget double, "
    "revenue double, runtime double, vote_average double, vote_count double, profit double, "
    "roi double, release_year int, release_month int, load_date timestamp, source string"
)

DIM_GENRE = _struct("genre_id bigint, genre_name string, created_date timestamp")
DIM_TIME = _struct(
    "time_id bigint, full_date date, year int, quarter int, month int, month_name string, "
    "day_of_month int, day_of_week int, day_name string, is_weekend boolean, "
    "created_date timestamp"
)
DIM_COUNTRY = _struct(
    "country_id bigint, country_code string, country_name string, region string, "
    "created_date timestamp"
)
DIM_STUDIO = _struct(
    "studio_id bigint, studio_name string, studio_size string, created_date timestamp"
)
FACT = _struct(
    "fact_id bigint, movie_id bigint, title string, genre_id bigint, time_id bigint, "
    "country_id bigint, studio_id bigint, budget double, revenue double, profit double, "
    "roi double, runtime double, vote_average double, vote_count double, popularity double, "
    "original_language string, created_date timestamp"
)
_MEASURES = (
    "total_films bigint, total_revenue double, total_budget double, avg_revenue double, "
    "avg_budget double, avg_roi double, avg_rating double, last_updated timestamp"
)
AGG_GENRE = _struct(f"agg_id bigint, genre_id bigint, genre_name string, {_MEASURES}")
AGG_YEARLY = _struct(f"agg_id bigint, year int, {_MEASURES}")
RUN_LOG = _struct(
    "log_id bigint, job_name string, start_time timestamp, end_time timestamp, rows_processed bigint, "
    "rows_failed bigint, status string, error_message string, created_date timestamp"
)

WAREHOUSE = {
    "Staging_Movies": T.StructType([T.StructField("staging_id", T.LongType())] + STAGING.fields),
    "Dim_Genre": DIM_GENRE,
    "Dim_Time": DIM_TIME,
    "Dim_Country": DIM_COUNTRY,
    "Dim_Studio": DIM_STUDIO,
    "Fact_Movies": FACT,
    "Agg_Genre_Performance": AGG_GENRE,
    "Agg_Yearly_Trends": AGG_YEARLY,
    "ETL_Log": RUN_LOG,
}

# Landed documents of the detail and listing feeds.
DETAIL = T.StructType(
    _struct(
        "id bigint, title string, original_language string, overview string, popularity double, "
        "release_date string, budget double, revenue double, runtime double, "
        "vote_average double, vote_count double"
    ).fields
    + [
        _list_of("genres", "name string"),
        _list_of("production_companies", "name string"),
        _list_of("production_countries", "iso_3166_1 string"),
    ]
)
LISTING = T.StructType([_list_of("results", "id bigint")])
