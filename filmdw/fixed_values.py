"""Data that results depend on, stated once."""

# Language of a title -> (country code, country name, region).
LANGUAGE_COUNTRIES = [
    ("en", "US", "United States", "North America"),
    ("fr", "FR", "France", "Europe"),
    ("es", "ES", "Spain", "Europe"),
    ("de", "DE", "Germany", "Europe"),
    ("it", "IT", "Italy", "Europe"),
    ("ja", "JP", "Japan", "Asia"),
    ("ko", "KR", "South Korea", "Asia"),
    ("zh", "CN", "China", "Asia"),
    ("hi", "IN", "India", "Asia"),
    ("pt", "PT", "Portugal", "Europe"),
    ("ru", "RU", "Russia", "Europe"),
    ("ar", "SA", "Saudi Arabia", "Middle East"),
]
UNKNOWN = "Unknown"
UNKNOWN_COUNTRY_CODE = "UNK"
OTHER_REGION = "Other"

# A studio whose name contains one of these is Large.
MAJOR_STUDIOS = [
    "Warner Bros",
    "Universal",
    "Paramount",
    "Disney",
    "20th Century",
    "Sony",
    "Columbia",
    "Fox",
    "Metro-Goldwyn-Mayer",
    "Lionsgate",
]
MEDIUM_NAME_LENGTH = 30

# List delimiter, source tags and number of dataset parts.
LIST_DELIMITER = "-"
FULL_LOAD_SOURCE = "CSV"
PART_SOURCE_PREFIX = "CSV_chunk_"
DETAIL_SOURCE = "TMDB_API"
DATASET_PARTS = 4

# Limits of the cleaning filters.
FIRST_DATE = "1900-01-01"
LAST_DATE = "2025-12-31"
MAX_BUDGET = 1_000_000_000
MAX_REVENUE = 5_000_000_000

# Defaults used when a batch is staged.
STAGING_DEFAULTS = {
    "genres": "Unknown",
    "original_language": "en",
    "overview": "",
    "production_companies": "Unknown",
    "popularity": 0.0,
    "runtime": 0.0,
    "vote_average": 0.0,
    "vote_count": 0.0,
}

# Table names and the texts of the quality report,
# (table, rule, description).
STAGING_TABLE = "Staging_Movies"
FACT_TABLE = "Fact_Movies"
QUALITY_RULES = [
    ("Staging_Movies", "NULL movie_id", "Movies with NULL movie_id (primary identifier)"),
    ("Staging_Movies", "NULL/Empty title", "Movies with NULL or empty title"),
    ("Staging_Movies", "Negative budget", "Movies with negative budget (invalid)"),
    ("Staging_Movies", "Negative revenue", "Movies with negative revenue (invalid)"),
    ("Staging_Movies", "Rating out of range", "Movies with vote_average not in 0-10 range"),
    ("Staging_Movies", "Future release dates", "Movies with release date in the future"),
    ("Staging_Movies", "Negative runtime", "Movies with negative runtime (invalid)"),
    ("Staging_Movies", "Extreme runtime (>10h)", "Movies with runtime over 10 hours (suspicious)"),
    ("Fact_Movies", "NULL genre_id", "Movies with NULL genre_id (broken FK)"),
    ("Fact_Movies", "NULL time_id", "Movies with NULL time_id (broken FK)"),
    ("Fact_Movies", "NULL studio_id", "Movies with NULL studio_id (broken FK)"),
    ("Fact_Movies", "Negative budget", "Movies with negative budget"),
    ("Fact_Movies", "Negative revenue", "Movies with negative revenue"),
    ("Fact_Movies", "Rating out of range", "Movies with invalid vote_average"),
    ("Fact_Movies", "Orphaned genre_id", "Movies with genre_id not in Dim_Genre"),
    ("Fact_Movies", "Orphaned time_id", "Movies with time_id not in Dim_Time"),
    ("Fact_Movies", "Orphaned studio_id", "Movies with studio_id not in Dim_Studio"),
    ("Fact_Movies", "Extreme ROI (>1000x)", "Movies with ROI over 1000 (suspicious data)"),
    (
        "Fact_Movies",
        "Zero budget with revenue",
        "Movies with $0 budget but positive revenue (missing data)",
    ),
]

# Upper limits, in percent, of the status ladders.
RULE_LADDER = [(0.5, "PASS"), (5.0, "WARNING")]
RULE_FLOOR = "FAIL"
GRADE_LADDER = [(0.5, "EXCELLENT"), (2.0, "GOOD"), (5.0, "ACCEPTABLE")]
GRADE_FLOOR = "POOR"
JOB_LADDER = [(0.5, "SUCCESS"), (5.0, "SUCCESS_WITH_WARNINGS")]
JOB_FLOOR = "FAILED"

# Features of the revenue regression, in coefficient order.
FEATURES = [
    "budget",
    "runtime",
    "popularity",
    "vote_average",
    "vote_count",
    "release_year",
    "release_month",
    "genre_encoded",
    "studio_freq",
]
TARGET_R2 = 0.6
FOLDS = 5

# Window of the yearly series, horizon and interval.
SERIES_FIRST_YEAR = 1980
SERIES_LAST_YEAR = 2024
HORIZON_YEARS = 5
Z_95 = 1.959963984540054
