"""The registered queries as plain SQL, for checking in another engine."""

from __future__ import annotations

# Named building blocks; each query takes those it needs, in this order.
PARTS = {
    "lines": """
        SELECT l_orderkey, SUM(l_extendedprice) AS price, SUM(l_quantity) AS quantity,
               SUM(l_tax) AS tax, COUNT(*) AS n,
               string_agg(DISTINCT p_type, '-' ORDER BY p_type) AS g,
               string_agg(DISTINCT s_name, '-' ORDER BY s_name) AS c
        FROM lineitem
        LEFT JOIN part ON p_partkey = l_partkey
        LEFT JOIN supplier ON s_suppkey = l_suppkey
        GROUP BY l_orderkey""",
    "film": """
        SELECT o_orderkey AS movie_id,
               CASE WHEN o_orderkey % 97 = 0 THEN '' ELSE 'T' || o_orderkey END AS title,
               CASE WHEN o_orderkey % 17 = 0 THEN NULL
                    WHEN o_orderkey % 37 = 0 THEN ' ' || g || ' - '
                    WHEN o_orderkey % 41 = 0 THEN 'Unknown' ELSE g END AS genres,
               CASE o_orderkey % 8 WHEN 0 THEN 'en' WHEN 1 THEN 'fr' WHEN 2 THEN 'ja'
                    WHEN 3 THEN 'cn' WHEN 4 THEN 'zh' WHEN 5 THEN 'xx' WHEN 6 THEN 'de'
               END AS original_language,
               CASE WHEN o_orderkey % 23 = 0 THEN NULL
                    WHEN o_orderkey % 43 = 0 THEN 'Unknown'
                    WHEN o_orderkey % 47 = 0 THEN 'Unknown- ' || c ELSE c
               END AS production_companies,
               CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE)
               END AS release_date,
               CASE WHEN o_orderkey % 13 = 0 THEN 0.0 WHEN o_orderkey % 101 = 0 THEN -1.0
                    ELSE COALESCE(ROUND(price, 2), 0.0) END::DOUBLE AS budget,
               CASE WHEN o_orderkey % 29 = 0 THEN 0.0 ELSE o_totalprice END::DOUBLE AS revenue,
               CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 31 = 0 THEN 700.0
                    ELSE quantity END::DOUBLE AS runtime,
               CASE WHEN o_orderkey % 89 = 0 THEN 11.0 ELSE LEAST(COALESCE(n, 0), 10.0) END::DOUBLE
                    AS vote_average,
               CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE n END::DOUBLE AS vote_count,
               ROUND(tax, 2) AS popularity,
               'CSV_chunk_' || (1 + o_orderkey % 4) AS source
        FROM orders LEFT JOIN lines ON l_orderkey = o_orderkey""",
    "staging": """
        SELECT *, revenue - budget AS profit,
               CASE WHEN budget <> 0 THEN (revenue - budget) / budget END AS roi,
               year(release_date)::INT AS release_year, month(release_date)::INT AS release_month
        FROM film""",
    "cleaned": """
        SELECT movie_id AS id, title, COALESCE(genres, 'Unknown') AS genres, original_language,
               popularity, COALESCE(production_companies, 'Unknown') AS production_companies,
               release_date, budget, revenue,
               COALESCE(runtime, MEDIAN(runtime) OVER ()) AS runtime, vote_average,
               COALESCE(vote_count, 0) AS vote_count, profit, roi, release_year, release_month
        FROM staging
        WHERE release_date >= DATE '1900-01-01' AND release_date <= DATE '2025-12-31'
          AND budget > 0 AND revenue > 0 AND budget <= 1000000000 AND revenue <= 5000000000""",
    "dim_genre": """
        SELECT row_number() OVER (ORDER BY genre_name) AS genre_id, genre_name
        FROM (SELECT DISTINCT trim(t) AS genre_name
              FROM (SELECT unnest(string_split(genres, '-')) AS t FROM staging)
              WHERE trim(t) <> '')""",
    "dim_time": """
        SELECT row_number() OVER (ORDER BY d) AS time_id, d AS full_date, year(d)::INT AS year,
               quarter(d)::INT AS quarter, month(d)::INT AS month,
               strftime(d, '%B') AS month_name, day(d)::INT AS day_of_month,
               isodow(d)::INT AS day_of_week, strftime(d, '%A') AS day_name,
               isodow(d) >= 6 AS is_weekend
        FROM (SELECT unnest(generate_series(MIN(release_date), MAX(release_date),
                                            INTERVAL 1 DAY))::DATE AS d FROM staging)""",
    "languages": """
        SELECT * FROM (VALUES ('en', 'US', 'United States', 'North America'),
            ('fr', 'FR', 'France', 'Europe'), ('es', 'ES', 'Spain', 'Europe'),
            ('de', 'DE', 'Germany', 'Europe'), ('it', 'IT', 'Italy', 'Europe'),
            ('ja', 'JP', 'Japan', 'Asia'), ('ko', 'KR', 'South Korea', 'Asia'),
            ('zh', 'CN', 'China', 'Asia'), ('hi', 'IN', 'India', 'Asia'),
            ('pt', 'PT', 'Portugal', 'Europe'), ('ru', 'RU', 'Russia', 'Europe'),
            ('ar', 'SA', 'Saudi Arabia', 'Middle East')) AS v(lang, code, name, region)""",
    "dim_country": """
        SELECT row_number() OVER (ORDER BY grp, lang) AS country_id, country_code, country_name,
               region
        FROM (SELECT 0 AS grp, '' AS lang, 'UNK' AS country_code, 'Unknown' AS country_name,
                     'Unknown' AS region
              UNION ALL
              SELECT 1, original_language, country_code, country_name, region
              FROM (SELECT s.original_language,
                           COALESCE(l.code, upper(s.original_language)) AS country_code,
                           COALESCE(l.name, 'Language: ' || s.original_language) AS country_name,
                           COALESCE(l.region, 'Other') AS region,
                           row_number() OVER (
                               PARTITION BY COALESCE(l.code, upper(s.original_language))
                               ORDER BY s.original_language) AS rn
                    FROM (SELECT DISTINCT original_language FROM staging
                          WHERE original_language IS NOT NULL) s
                    LEFT JOIN languages l ON l.lang = s.original_language)
              WHERE rn = 1 AND country_code <> 'UNK')""",
    "dim_studio": """
        SELECT row_number() OVER (ORDER BY grp, studio_name) AS studio_id, studio_name,
               studio_size
        FROM (SELECT 0 AS grp, 'Unknown' AS studio_name, 'Unknown' AS studio_size
              UNION ALL
              SELECT DISTINCT 1, trim(t),
                     CASE WHEN regexp_matches(trim(t),
                              'Warner Bros|Universal|Paramount|Disney|20th Century|Sony|' ||
                              'Columbia|Fox|Metro-Goldwyn-Mayer|Lionsgate') THEN 'Large'
                          WHEN length(trim(t)) > 30 THEN 'Medium' ELSE 'Small' END
              FROM (SELECT unnest(string_split(production_companies, '-')) AS t FROM staging)
              WHERE trim(t) <> '' AND trim(t) <> 'Unknown')""",
    "known": """
        SELECT *, list_filter(list_transform(string_split(production_companies, '-'),
                                             lambda x: trim(x)),
                              lambda x: x <> '' AND x <> 'Unknown')[1] AS first_studio
        FROM staging""",
    "fact": """
        SELECT k.movie_id, k.title, g.genre_id, t.time_id,
               COALESCE(c.country_id,
                        (SELECT country_id FROM dim_country WHERE country_code = 'UNK'))
                   AS country_id,
               d.studio_id, k.budget, k.revenue, k.profit, k.roi, k.runtime, k.vote_average,
               k.vote_count, k.popularity, k.original_language
        FROM (SELECT *, unnest(string_split(genres, '-')) AS token FROM known
              WHERE first_studio IS NOT NULL AND release_date IS NOT NULL
                AND budget > 0 AND revenue > 0) k
        LEFT JOIN dim_genre g ON g.genre_name = trim(k.token)
        LEFT JOIN dim_time t ON t.full_date = k.release_date
        LEFT JOIN dim_country c ON c.country_code = upper(k.original_language)
        LEFT JOIN dim_studio d ON d.studio_name = k.first_studio""",
    "respelled": """
        SELECT * REPLACE (
          CASE WHEN movie_id % 3 = 0 THEN lower(genres) WHEN movie_id % 3 = 1 THEN upper(genres)
               ELSE genres END AS genres,
          CASE WHEN movie_id % 4 = 0 THEN lower(production_companies)
               ELSE production_companies END AS production_companies,
          CASE WHEN movie_id % 5 = 0 THEN original_language || '  ' ELSE original_language END
            AS original_language)
        FROM staging""",
    "caseless_genre": """
        SELECT row_number() OVER (ORDER BY folded) AS genre_id, genre_name, folded
        FROM (SELECT lower(trim(t)) AS folded, MIN(trim(t)) AS genre_name
              FROM (SELECT unnest(string_split(genres, '-')) AS t FROM respelled)
              WHERE trim(t) <> '' GROUP BY 1)""",
    "caseless_studio": """
        SELECT row_number() OVER (ORDER BY grp, folded) AS studio_id, folded
        FROM (SELECT 0 AS grp, 'unknown' AS folded UNION ALL
              SELECT DISTINCT 1, lower(trim(t))
              FROM (SELECT unnest(string_split(production_companies, '-')) AS t FROM respelled)
              WHERE trim(t) <> '' AND lower(trim(t)) <> 'unknown')""",
    "stg": """
        SELECT movie_id, title, genres, original_language, '' AS overview, popularity,
               production_companies, release_date, budget, revenue,
               COALESCE(runtime, 0) AS runtime, COALESCE(vote_average, 0) AS vote_average,
               COALESCE(vote_count, 0) AS vote_count, profit, roi, release_year, release_month,
               source
        FROM staging
        WHERE movie_id IS NOT NULL AND title IS NOT NULL AND title <> ''
          AND budget > 0 AND revenue > 0""",
    "model_fact": """
        SELECT s.movie_id, s.title, g.genre_id, t.time_id, d.studio_id, s.budget, s.revenue,
               s.profit, s.roi, s.runtime, s.vote_average, s.vote_count, s.popularity,
               s.original_language
        FROM stg s
        LEFT JOIN dim_genre g ON g.genre_name = split_part(s.genres, '-', 1)
        LEFT JOIN dim_time t ON t.full_date = s.release_date
        LEFT JOIN dim_studio d ON d.studio_name = split_part(s.production_companies, '-', 1)""",
    "rules": """
        SELECT 'Staging_Movies' AS "table", r.* FROM (
            SELECT COUNT(*) AS total_records,
                   unnest([
                     {'rule': 'NULL movie_id', 'bad': COUNT(*) FILTER (movie_id IS NULL),
                      'text': 'Movies with NULL movie_id (primary identifier)'},
                     {'rule': 'NULL/Empty title',
                      'bad': COUNT(*) FILTER (title IS NULL OR title = ''),
                      'text': 'Movies with NULL or empty title'},
                     {'rule': 'Negative budget', 'bad': COUNT(*) FILTER (budget < 0),
                      'text': 'Movies with negative budget (invalid)'},
                     {'rule': 'Negative revenue', 'bad': COUNT(*) FILTER (revenue < 0),
                      'text': 'Movies with negative revenue (invalid)'},
                     {'rule': 'Rating out of range',
                      'bad': COUNT(*) FILTER (vote_average < 0 OR vote_average > 10),
                      'text': 'Movies with vote_average not in 0-10 range'},
                     {'rule': 'Future release dates',
                      'bad': COUNT(*) FILTER (release_date > DATE '2001-01-01'),
                      'text': 'Movies with release date in the future'},
                     {'rule': 'Negative runtime', 'bad': COUNT(*) FILTER (runtime < 0),
                      'text': 'Movies with negative runtime (invalid)'},
                     {'rule': 'Extreme runtime (>10h)', 'bad': COUNT(*) FILTER (runtime > 600),
                      'text': 'Movies with runtime over 10 hours (suspicious)'}]) AS r
            FROM staging) r
        UNION ALL
        SELECT 'Fact_Movies', r.* FROM (
            SELECT COUNT(*) AS total_records,
                   unnest([
                     {'rule': 'NULL genre_id', 'bad': COUNT(*) FILTER (genre_id IS NULL),
                      'text': 'Movies with NULL genre_id (broken FK)'},
                     {'rule': 'NULL time_id', 'bad': COUNT(*) FILTER (time_id IS NULL),
                      'text': 'Movies with NULL time_id (broken FK)'},
                     {'rule': 'NULL studio_id', 'bad': COUNT(*) FILTER (studio_id IS NULL),
                      'text': 'Movies with NULL studio_id (broken FK)'},
                     {'rule': 'Negative budget', 'bad': COUNT(*) FILTER (budget < 0),
                      'text': 'Movies with negative budget'},
                     {'rule': 'Negative revenue', 'bad': COUNT(*) FILTER (revenue < 0),
                      'text': 'Movies with negative revenue'},
                     {'rule': 'Rating out of range',
                      'bad': COUNT(*) FILTER (vote_average < 0 OR vote_average > 10),
                      'text': 'Movies with invalid vote_average'},
                     {'rule': 'Orphaned genre_id',
                      'bad': (SELECT COUNT(*) FROM fact WHERE genre_id IS NOT NULL
                              AND genre_id NOT IN (SELECT genre_id FROM dim_genre)),
                      'text': 'Movies with genre_id not in Dim_Genre'},
                     {'rule': 'Orphaned time_id',
                      'bad': (SELECT COUNT(*) FROM fact WHERE time_id IS NOT NULL
                              AND time_id NOT IN (SELECT time_id FROM dim_time)),
                      'text': 'Movies with time_id not in Dim_Time'},
                     {'rule': 'Orphaned studio_id',
                      'bad': (SELECT COUNT(*) FROM fact WHERE studio_id IS NOT NULL
                              AND studio_id NOT IN (SELECT studio_id FROM dim_studio)),
                      'text': 'Movies with studio_id not in Dim_Studio'},
                     {'rule': 'Extreme ROI (>1000x)', 'bad': COUNT(*) FILTER (roi > 1000),
                      'text': 'Movies with ROI over 1000 (suspicious data)'},
                     {'rule': 'Zero budget with revenue',
                      'bad': COUNT(*) FILTER (budget = 0 AND revenue > 0),
                      'text': 'Movies with $0 budget but positive revenue (missing data)'}]) AS r
            FROM fact) r""",
    "report": """
        SELECT "table", r.rule AS validation_type, total_records, r.bad AS invalid_records,
               r.bad * 100.0 / total_records AS pct, r.text AS description
        FROM rules""",
    "dirty_staging": """
        SELECT * REPLACE (
            CASE WHEN movie_id % 61 = 0 THEN NULL ELSE movie_id END AS movie_id,
            CASE WHEN movie_id % 67 = 0 THEN -1.0 ELSE revenue END AS revenue,
            CASE WHEN movie_id % 71 = 0 THEN -5.0 ELSE runtime END AS runtime)
        FROM staging""",
    "dirty_fact": """
        SELECT * REPLACE (
            CASE WHEN movie_id % 59 = 0 THEN genre_id + 100000000 ELSE genre_id END AS genre_id,
            CASE WHEN movie_id % 61 = 0 THEN NULL WHEN movie_id % 73 = 0 THEN time_id + 100000000
                 ELSE time_id END AS time_id,
            CASE WHEN movie_id % 67 = 0 THEN NULL WHEN movie_id % 97 = 0
                 THEN studio_id + 100000000 ELSE studio_id END AS studio_id,
            CASE WHEN movie_id % 79 = 0 THEN -1.0 WHEN movie_id % 83 = 0 THEN 0.0
                 ELSE budget END AS budget,
            CASE WHEN movie_id % 71 = 0 THEN -1.0 ELSE revenue END AS revenue,
            CASE WHEN movie_id % 103 = 0 THEN 11.0 ELSE vote_average END AS vote_average,
            CASE WHEN movie_id % 89 = 0 THEN 5000.0 ELSE roi END AS roi)
        FROM fact""",
    "first_tokens": """
        SELECT *, CASE WHEN COALESCE(genres, '') = '' THEN 'Unknown'
                       ELSE trim(split_part(genres, '-', 1)) END AS primary_genre,
               CASE WHEN COALESCE(production_companies, '') = '' THEN 'Unknown'
                    ELSE trim(split_part(production_companies, '-', 1)) END AS primary_studio
        FROM staging""",
    "features": """
        SELECT id, title, genres, production_companies, revenue, budget, runtime, popularity,
               vote_average, vote_count, release_year, release_month,
               dense_rank() OVER (ORDER BY primary_genre) - 1 AS genre_encoded,
               COUNT(*) OVER (PARTITION BY primary_studio) AS studio_freq
        FROM (SELECT *, trim(split_part(genres, '-', 1)) AS primary_genre,
                     trim(split_part(production_companies, '-', 1)) AS primary_studio
              FROM cleaned)""",
    "scored": """
        SELECT *, revenue - predicted_revenue AS prediction_error,
               CASE WHEN substr(md5(CAST(id AS VARCHAR)), 1, 8) < '33333333' THEN 'test'
                    ELSE 'train' END AS split
        FROM (SELECT *, 1000.0::DOUBLE + budget * 1.0 + runtime * 100.0 + popularity * 10.0
                        + vote_average * 250.0 + vote_count * 50.0 + release_year * 2.0
                        + release_month * 4.0 + genre_encoded * 8.0 + studio_freq * 1.0
                        AS predicted_revenue
              FROM features)""",
    "yearly": """
        SELECT t.year, COUNT(DISTINCT f.movie_id) AS total_films, SUM(f.revenue) AS total_revenue,
               SUM(f.budget) AS total_budget, AVG(f.revenue) AS avg_revenue,
               AVG(f.budget) AS avg_budget, AVG(f.roi) AS avg_roi,
               AVG(f.vote_average) AS avg_rating
        FROM fact f JOIN dim_time t ON t.time_id = f.time_id GROUP BY t.year""",
    "by_genre": """
        SELECT g.genre_id, g.genre_name, COUNT(DISTINCT f.movie_id) AS total_films,
               SUM(f.revenue) AS total_revenue, SUM(f.budget) AS total_budget,
               AVG(f.revenue) AS avg_revenue, AVG(f.budget) AS avg_budget, AVG(f.roi) AS avg_roi,
               AVG(f.vote_average) AS avg_rating
        FROM fact f JOIN dim_genre g ON g.genre_id = f.genre_id
        GROUP BY g.genre_id, g.genre_name""",
    "model_agg": """
        SELECT g.genre_name, COUNT(DISTINCT f.movie_id) AS total_films,
               SUM(f.revenue) AS total_revenue, SUM(f.budget) AS total_budget,
               AVG(f.revenue) AS avg_revenue, AVG(f.budget) AS avg_budget, AVG(f.roi) AS avg_roi,
               AVG(f.vote_average) AS avg_rating
        FROM model_fact f LEFT JOIN dim_genre g ON g.genre_id = f.genre_id
        GROUP BY g.genre_name""",
    "segment_years": """
        SELECT c_mktsegment, year(o_orderdate)::INT AS year,
               ROUND(SUM(o_totalprice), 2) AS total_revenue, COUNT(*) AS orders
        FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY ALL""",
    "documents_parsed": """
        SELECT o_orderkey AS movie_id, 'T' || o_orderkey AS title,
               CASE WHEN COALESCE(array_to_string(list_filter(string_split(genres, '-'),
                         lambda x: x <> ''), '-'), '') = '' THEN 'Unknown'
                    ELSE array_to_string(list_filter(string_split(genres, '-'),
                         lambda x: x <> ''), '-') END AS genres,
               COALESCE(original_language, 'en') AS original_language, '' AS overview,
               0.0::DOUBLE AS popularity,
               CASE WHEN COALESCE(array_to_string(list_filter(
                         string_split(production_companies, '-'), lambda x: x <> ''), '-'), '')
                         = '' THEN 'Unknown'
                    ELSE array_to_string(list_filter(string_split(production_companies, '-'),
                         lambda x: x <> ''), '-') END AS production_companies,
               CAST(o_orderdate AS DATE) AS release_date, COALESCE(budget, 0) AS budget,
               o_totalprice AS revenue, runtime, COALESCE(vote_average, 0) AS vote_average,
               COALESCE(vote_count, 0) AS vote_count,
               CASE WHEN budget > 0 AND o_totalprice > 0 THEN o_totalprice - budget END AS profit,
               CASE WHEN budget > 0 AND o_totalprice > 0 THEN (o_totalprice - budget) / budget
               END AS roi,
               year(o_orderdate)::INT AS release_year, month(o_orderdate)::INT AS release_month,
               'TMDB_API' AS source, 'US' AS countries
        FROM orders LEFT JOIN film ON movie_id = o_orderkey""",
}

# the same rules over broken rows
PARTS["dirty_rules"] = (
    PARTS["rules"].replace("FROM staging", "FROM dirty_staging").replace("FROM fact", "FROM dirty_fact")
)

NEEDS = {
    "lines": [],
    "film": ["lines"],
    "staging": ["film"],
    "cleaned": ["staging"],
    "dim_genre": ["staging"],
    "dim_time": ["staging"],
    "languages": [],
    "dim_country": ["staging", "languages"],
    "dim_studio": ["staging"],
    "known": ["staging"],
    "fact": ["known", "dim_genre", "dim_time", "dim_country", "dim_studio"],
    "respelled": ["staging"],
    "caseless_genre": ["respelled"],
    "caseless_studio": ["respelled"],
    "stg": ["staging"],
    "model_fact": ["stg", "dim_genre", "dim_time", "dim_studio"],
    "rules": ["staging", "fact"],
    "report": ["rules"],
    "dirty_staging": ["staging"],
    "dirty_fact": ["fact"],
    "dirty_rules": ["dirty_staging", "dirty_fact"],
    "first_tokens": ["staging"],
    "features": ["cleaned"],
    "scored": ["features"],
    "yearly": ["fact", "dim_time"],
    "by_genre": ["fact", "dim_genre"],
    "model_agg": ["model_fact", "dim_genre"],
    "segment_years": [],
    "documents_parsed": ["film"],
}

_MEASURES = """total_films, ROUND(total_revenue, 2) AS total_revenue,
    ROUND(total_budget, 2) AS total_budget, ROUND(avg_revenue, 4) AS avg_revenue,
    ROUND(avg_budget, 4) AS avg_budget, ROUND(avg_roi, 6) AS avg_roi,
    ROUND(avg_rating, 6) AS avg_rating"""

_PROFILED = [
    ("movie_id", "bigint"),
    ("title", "string"),
    ("genres", "string"),
    ("original_language", "string"),
    ("popularity", "double"),
    ("production_companies", "string"),
    ("release_date", "date"),
    ("budget", "double"),
    ("revenue", "double"),
    ("runtime", "double"),
    ("vote_average", "double"),
    ("vote_count", "double"),
    ("source", "string"),
]
_DOCUMENT_COLUMNS = [
    ("doc_id", "bigint"),
    ("text", "string"),
    ("lang", "string"),
    ("source", "string"),
    ("n_chars", "bigint"),
]


def _null_rows(columns: list[tuple[str, str]], source: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT {i} AS "position", '{c}' AS "column", '{kind}' AS "type",
            COUNT({c}) AS non_null, COUNT(*) - COUNT({c}) AS missing,
            ROUND((COUNT(*) - COUNT({c})) * 100.0 / COUNT(*), 6) AS missing_pct FROM {source}"""
        for i, (c, kind) in enumerate(columns, 1)
    )


def _describe_rows(columns: list[str], source: str, digits: int) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", COUNT({c}) AS count, ROUND(AVG({c}), {digits}) AS mean,
            ROUND(STDDEV_SAMP({c}), {digits}) AS std, MIN({c}) + 0.0::DOUBLE AS min,
            ROUND(QUANTILE_CONT({c}, 0.25), 4) AS p25, ROUND(QUANTILE_CONT({c}, 0.5), 4) AS p50,
            ROUND(QUANTILE_CONT({c}, 0.75), 4) AS p75, MAX({c}) AS max FROM {source}"""
        for c in columns
    )


def _forecast(source: str, key: str = "") -> str:
    lead = f"{key}, " if key else ""
    group = f"GROUP BY {key}" if key else ""
    return f"""
        SELECT {lead}year, ROUND(p, 6) AS "predicted_revenue_B",
               ROUND(p - half, 6) AS "lower_bound_B", ROUND(p + half, 6) AS "upper_bound_B"
        FROM (SELECT {lead}h.year::INT AS year, b + a * h.year AS p,
                     1.959963984540054 * sqrt(GREATEST(syy - a * sxy, 0) / (n - 2))
                       * sqrt(1 + 1.0 / n + (h.year - mx) * (h.year - mx) / sxx) AS half
              FROM (SELECT {lead}regr_slope(y, x) AS a, regr_intercept(y, x) AS b,
                           regr_count(y, x) AS n, regr_avgx(y, x) AS mx, regr_sxx(y, x) AS sxx,
                           regr_sxy(y, x) AS sxy, regr_syy(y, x) AS syy
                    FROM (SELECT {lead}year::DOUBLE AS x, total_revenue / 1e9 AS y FROM {source}
                          WHERE year BETWEEN 1980 AND 2024) {group}) m,
                   (SELECT unnest(range(2025, 2030)) AS year) h)"""


def _changepoints(source: str, count: int, key: str = "") -> str:
    """Ridge regression on hinges: elimination spelled out, one subquery a pivot."""
    lead, by = (f"{key}, ", f"PARTITION BY {key}") if key else ("", "")
    size, penalty = count + 2, (0.1 / 0.3) ** 2

    def hinges(t: str) -> list[str]:
        return ["1.0", t, *[f"GREATEST({t} - {0.8 * j / count}, 0)" for j in range(1, count + 1)]]

    cells = [(i, j) for i in range(size) for j in range(size)]
    sums = [f"SUM(x{i} * x{j}) AS g{i}_{j}" for i, j in cells] + [f"SUM(x{i} * y) AS v{i}" for i in range(size)]
    basis = ", ".join(f"{x} AS x{i}" for i, x in enumerate(hinges("t")))
    text = f"""SELECT {lead}first, last, COUNT(*) AS n, SUM(y * y) AS yy, {", ".join(sums)}
        FROM (SELECT *, {basis} FROM (SELECT *, (x - first) / (last - first) AS t FROM (
          SELECT {lead}year::DOUBLE AS x, total_revenue / 1e9 AS y, MIN(year::DOUBLE) OVER w AS first,
                 MAX(year::DOUBLE) OVER w AS last
          FROM {source} WHERE year BETWEEN 1980 AND 2024 WINDOW w AS ({by}))))
        GROUP BY {lead}first, last"""
    wide = [(i, j) for i in range(size) for j in range(2 * size)]

    def opened(i: int, j: int) -> str:
        if j >= size:
            return "1.0" if j - size == i else "0.0"
        return f"g{i}_{j} + {penalty}" if i == j and i >= 2 else f"g{i}_{j}"

    text = f"SELECT *, {', '.join(f'{opened(i, j)} AS m{i}_{j}' for i, j in wide)} FROM ({text})"
    for k in range(size):
        steps = [
            f"m{i}_{j} / m{k}_{k} AS m{i}_{j}" if i == k else f"m{i}_{j} - m{i}_{k} * m{k}_{j} / m{k}_{k} AS m{i}_{j}"
            for i, j in wide
        ]
        text = f"SELECT * REPLACE ({', '.join(steps)}) FROM ({text})"
    weights = [" + ".join(f"m{i}_{j + size} * v{j}" for j in range(size)) + f" AS b{i}" for i in range(size)]
    text = f"SELECT *, {', '.join(weights)} FROM ({text})"
    explained = " + ".join(f"b{i} * v{i}" for i in range(size))
    squares = " + ".join(f"b{i} * b{j} * g{i}_{j}" for i, j in cells)
    parameters = " + ".join(f"m{i}_{j + size} * g{i}_{j}" for i, j in cells)
    changes = " + ".join(f"b{i} * b{i}" for i in range(2, size))
    text = f"""SELECT *, GREATEST(yy - 2 * ({explained}) + {squares}, 0) / (n - ({parameters})) AS noise,
        ({changes}) / 0.8 AS to_come FROM ({text})"""
    text = f"""SELECT *, {", ".join(f"{x} AS x{i}" for i, x in enumerate(hinges("t")))} FROM (
        SELECT *, (year - first) / (last - first) AS t FROM ({text}),
               (SELECT unnest(range(2025, 2030)) AS year))"""
    near = " + ".join(f"x{i} * x{j} * m{i}_{j + size}" for i, j in cells)
    text = f"""SELECT {lead}year, {" + ".join(f"b{i} * x{i}" for i in range(size))} AS p,
        1.959963984540054 * sqrt(noise * (1 + {near}) + to_come * pow(t - 1, 3) / 3) AS half FROM ({text})"""
    return f"""SELECT {lead}year::INT AS year, ROUND(p, 6) AS "predicted_revenue_B",
        ROUND(p - half, 6) AS "lower_bound_B", ROUND(p + half, 6) AS "upper_bound_B" FROM ({text})"""


_FITTED = [
    "budget", "runtime", "popularity", "vote_average", "vote_count", "release_year", "release_month",
    "genre_encoded", "studio_freq",
]


def _least_squares(rows: str) -> str:
    """(grp, c0.., intercept): regression of y on the features for each grp of ``rows``, by elimination of
    the sums of products of standardised features, one subquery a pivot."""
    size = range(len(_FITTED))
    stats = [f"AVG({c}) AS m{i}, STDDEV_POP({c}) AS s{i}" for i, c in enumerate(_FITTED)]
    text = f"SELECT grp, AVG(y) AS my, {', '.join(stats)} FROM ({rows}) GROUP BY grp"
    scaled = ", ".join(f"({c} - m{i}) / s{i} AS z{i}" for i, c in enumerate(_FITTED))
    sums = [f"SUM(z{i} * z{j}) AS a{i}_{j}" for i in size for j in size]
    sums += [f"SUM(z{i} * (y - my)) AS a{i}_{len(_FITTED)}" for i in size]
    kept = ", ".join(f"any_value(m{i}) AS m{i}, any_value(s{i}) AS s{i}" for i in size)
    text = f"""SELECT grp, any_value(my) AS my, {kept}, {", ".join(sums)}
        FROM (SELECT *, {scaled} FROM ({rows}) JOIN ({text}) USING (grp)) GROUP BY grp"""
    for k in size:
        steps = []
        for i in size:
            for j in range(len(_FITTED) + 1):
                new = f"a{i}_{j} / a{k}_{k}" if i == k else f"a{i}_{j} - a{i}_{k} * a{k}_{j} / a{k}_{k}"
                steps.append(f"{new} AS a{i}_{j}")
        text = f"SELECT * REPLACE ({', '.join(steps)}) FROM ({text})"
    slopes = [f"a{i}_{len(_FITTED)} / s{i}" for i in size]
    intercept = " - ".join(["my", *(f"{slope} * m{i}" for i, slope in enumerate(slopes))])
    named = ", ".join(f"{slope} AS c{i}" for i, slope in enumerate(slopes))
    return f"SELECT grp, {named}, {intercept} AS intercept FROM ({text})"


_PREDICTED = " + ".join(["intercept", *(f"c{i} * {c}" for i, c in enumerate(_FITTED))])
_PAID = "SELECT *, revenue AS y FROM features WHERE revenue > 0"
_TRAIN = f"""SELECT *, 0 AS grp FROM ({_PAID})
    WHERE substr(md5(CAST(id AS VARCHAR)), 1, 8) >= '33333333'"""
_DIGITS = "substr(md5(CAST(id AS VARCHAR)), 9, 8)"
_FOLDED = f"""SELECT *, ({" + ".join(f"({_DIGITS} >= '{x * 8}')::INT" for x in "369c")}) AS fold
    FROM ({_PAID})"""

# name -> (building blocks, final SELECT)
FINAL: dict[str, tuple[list[str], str]] = {
    "dim_genre": (["dim_genre"], "SELECT * FROM dim_genre"),
    "dim_time": (["dim_time"], "SELECT * FROM dim_time"),
    "dim_country": (["dim_country"], "SELECT * FROM dim_country"),
    "dim_studio": (["dim_studio"], "SELECT * FROM dim_studio"),
    "fact_genre_grain": (
        ["fact"],
        "SELECT * REPLACE (ROUND(profit, 2) AS profit, ROUND(roi, 6) AS roi) FROM fact",
    ),
    "fact_without_broadcasts": (
        ["fact"],
        "SELECT * REPLACE (ROUND(profit, 2) AS profit, ROUND(roi, 6) AS roi) FROM fact",
    ),
    "fact_null_keys": (
        ["fact"],
        """SELECT COUNT(*) AS fact_rows, COUNT(*) - COUNT(genre_id) AS null_genre_id,
           COUNT(*) - COUNT(time_id) AS null_time_id, COUNT(*) - COUNT(studio_id) AS null_studio_id
           FROM fact""",
    ),
    "fact_top_revenue": (
        ["fact"],
        """SELECT f.movie_id, f.title,
           COALESCE(NULLIF(substr(f.title, 1, 40), ''), 'Unknown') AS shown_title,
           COALESCE(g.genre_name, 'Unknown') AS genre_name, COALESCE(t.year, 0) AS year, f.budget,
           f.revenue, ROUND(f.profit, 2) AS profit,
           ROUND(f.revenue / 1e9, 9) AS revenue_billions, ROUND(f.roi, 6) AS roi
           FROM fact f LEFT JOIN dim_genre g ON g.genre_id = f.genre_id
           LEFT JOIN dim_time t ON t.time_id = f.time_id
           ORDER BY f.revenue DESC, f.movie_id, f.genre_id NULLS LAST LIMIT 10""",
    ),
    "fact_model_first_token": (
        ["model_fact"],
        "SELECT * REPLACE (ROUND(profit, 2) AS profit, ROUND(roi, 6) AS roi) FROM model_fact",
    ),
    "country_lookup": (
        ["dim_country"],
        """SELECT s.movie_id, s.original_language, COALESCE(a.country_id, 1) AS by_code,
           COALESCE(b.country_id, 1) AS by_language
           FROM staging s LEFT JOIN languages l ON l.lang = s.original_language
           LEFT JOIN dim_country a ON a.country_code = upper(s.original_language)
           LEFT JOIN dim_country b
             ON b.country_code = COALESCE(l.code, upper(s.original_language))""",
    ),
    "studio_first_known": (["known"], "SELECT movie_id, first_studio AS studio_name FROM known"),
    "customers_without_orders": (
        [],
        """SELECT c_mktsegment, COUNT(*) AS customers,
           COUNT(*) FILTER (c_acctbal < 0) AS negative FROM customer
           WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL)
           GROUP BY c_mktsegment""",
    ),
    "orders_with_lines": (
        [],
        """SELECT o_orderstatus, COUNT(*) AS orders FROM orders
           WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem) GROUP BY o_orderstatus""",
    ),
    "line_orphans": (
        [],
        """SELECT 'l_orderkey' AS key, COUNT(*) AS invalid_records FROM lineitem
           WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
           UNION ALL SELECT 'l_partkey', COUNT(*) FROM lineitem
           WHERE l_partkey NOT IN (SELECT p_partkey FROM part)
           UNION ALL SELECT 'l_suppkey', COUNT(*) FROM lineitem
           WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier)""",
    ),
    "documents_without_labels": (
        [],
        """SELECT lang, COUNT(*) AS documents, COUNT(quality) AS labelled,
           COALESCE(SUM(quality), 0)::BIGINT AS good, SUM(n_chars)::BIGINT AS chars
           FROM documents LEFT JOIN labels USING (doc_id) GROUP BY lang""",
    ),
    "sample_coverage_semi": (
        ["fact"],
        """SELECT layer, found, ROUND(found * 100.0 / n, 6) AS pct,
           found * 100.0 / n >= minimum AS passed
           FROM (SELECT 'Staging_Movies' AS layer, COUNT(DISTINCT movie_id) AS found,
                        80 AS minimum FROM staging
                 WHERE movie_id IN (SELECT movie_id FROM staging ORDER BY movie_id LIMIT 100)
                 UNION ALL SELECT 'Fact_Movies', COUNT(DISTINCT movie_id), 70 FROM fact
                 WHERE movie_id IN (SELECT movie_id FROM staging ORDER BY movie_id LIMIT 100)),
                (SELECT COUNT(*) AS n FROM
                 (SELECT DISTINCT movie_id FROM
                  (SELECT movie_id FROM staging ORDER BY movie_id LIMIT 100)))""",
    ),
    "genre_performance": (["by_genre"], f"SELECT genre_id, genre_name, {_MEASURES} FROM by_genre"),
    "yearly_trends": (["yearly"], f"SELECT year, {_MEASURES} FROM yearly"),
    "agg_by_genre_model": (["model_agg"], f"SELECT genre_name, {_MEASURES} FROM model_agg"),
    "top_genres": (
        ["by_genre"],
        """SELECT genre_name, total_films, ROUND(total_revenue / 1e9, 9) AS revenue_billions,
           ROUND(avg_roi, 6) AS avg_roi FROM by_genre
           ORDER BY total_revenue DESC, genre_name LIMIT 5""",
    ),
    "recent_years": (
        ["yearly"],
        """SELECT year, total_films, ROUND(total_revenue / 1e9, 9) AS revenue_billions,
           ROUND(avg_budget / 1e6, 9) AS avg_budget_millions FROM yearly
           ORDER BY year DESC LIMIT 10""",
    ),
    "rows_per_source": (["film"], "SELECT source, COUNT(*) AS rows FROM film GROUP BY source"),
    "segment_yearly_revenue": (["segment_years"], "SELECT * FROM segment_years"),
    "clean_movies": (
        ["cleaned"],
        "SELECT * REPLACE (ROUND(profit, 2) AS profit, ROUND(roi, 6) AS roi) FROM cleaned",
    ),
    "clean_step_counts": (
        ["film"],
        """SELECT s.step, COUNT(f.step) AS rows,
           ROUND(COUNT(f.step) * 100.0 / (SELECT COUNT(*) FROM film), 6) AS pct
           FROM (SELECT unnest(['too_old_or_undated', 'future', 'no_money', 'outlier', 'kept'])
                 AS step) s
           LEFT JOIN (SELECT CASE WHEN release_date IS NULL OR release_date < DATE '1900-01-01'
                                  THEN 'too_old_or_undated'
                                  WHEN release_date > DATE '2025-12-31' THEN 'future'
                                  WHEN NOT (budget > 0 AND revenue > 0) THEN 'no_money'
                                  WHEN budget > 1000000000 OR revenue > 5000000000 THEN 'outlier'
                                  ELSE 'kept' END AS step FROM film) f ON f.step = s.step
           GROUP BY s.step""",
    ),
    "cleaning_summary": (
        ["film"],
        """SELECT * EXCLUDE (d), ROUND(zero_budget * 100.0 / d, 6) AS zero_budget_pct,
           ROUND(zero_revenue * 100.0 / d, 6) AS zero_revenue_pct,
           ROUND((raw_rows - cleaned_rows) * 100.0 / raw_rows, 6) AS reduction_pct
           FROM (SELECT * EXCLUDE (dated), dated AS d FROM (
             SELECT COUNT(*) AS raw_rows,
             COUNT(*) FILTER (release_date IS NULL) AS invalid_dates,
             COUNT(*) FILTER (release_date IS NULL OR release_date < DATE '1900-01-01')
               AS removed_old,
             COUNT(*) FILTER (release_date > DATE '2025-12-31') AS removed_future,
             COUNT(*) FILTER (ok AND budget = 0) AS zero_budget,
             COUNT(*) FILTER (ok AND revenue = 0) AS zero_revenue,
             COUNT(*) FILTER (ok AND NOT (budget > 0 AND revenue > 0)) AS removed_financial,
             COUNT(*) FILTER (ok AND budget > 0 AND revenue > 0
                              AND (budget > 1000000000 OR revenue > 5000000000))
               AS removed_outliers,
             COUNT(*) FILTER (ok AND budget > 0 AND revenue > 0 AND budget <= 1000000000
                              AND revenue <= 5000000000) AS cleaned_rows,
             COUNT(*) FILTER (ok) AS dated
             FROM (SELECT *, COALESCE(release_date BETWEEN DATE '1900-01-01'
                   AND DATE '2025-12-31', FALSE) AS ok FROM film)))""",
    ),
    "cleaned_ranges": (
        ["cleaned"],
        """SELECT COUNT(*) AS rows, MIN(release_date) AS min_release_date,
           MAX(release_date) AS max_release_date, MIN(budget) AS min_budget,
           MAX(budget) AS max_budget, MIN(revenue) AS min_revenue, MAX(revenue) AS max_revenue,
           ROUND(MIN(roi), 6) AS min_roi, ROUND(MAX(roi), 6) AS max_roi FROM cleaned""",
    ),
    "staging_fill_defaults": (
        ["staging"],
        """SELECT movie_id, title, COALESCE(genres, 'Unknown') AS genres,
           COALESCE(original_language, 'en') AS original_language, '' AS overview, popularity,
           COALESCE(production_companies, 'Unknown') AS production_companies, release_date, budget,
           revenue, COALESCE(runtime, 0) AS runtime, vote_average,
           COALESCE(vote_count, 0) AS vote_count, ROUND(profit, 2) AS profit,
           ROUND(roi, 6) AS roi, release_year, release_month, source
           FROM staging WHERE release_date BETWEEN DATE '1900-01-01' AND DATE '2025-12-31'
           AND budget > 0 AND revenue > 0 AND budget <= 1000000000 AND revenue <= 5000000000""",
    ),
    "staging_rejects": (
        ["staging"],
        """SELECT reject_reason, COUNT(*) AS rows FROM (
             SELECT concat_ws(',', CASE WHEN roi IS NULL THEN 'roi' END,
                    CASE WHEN release_year IS NULL THEN 'release_year' END,
                    CASE WHEN release_month IS NULL THEN 'release_month' END) AS reject_reason
             FROM staging) WHERE reject_reason <> '' GROUP BY reject_reason""",
    ),
    "load_once": (
        ["film"],
        """SELECT source, COUNT(*) AS rows FROM film
           WHERE source NOT IN ('CSV_chunk_1', 'CSV_chunk_2') GROUP BY source""",
    ),
    "split_chunks": (
        ["film"],
        """SELECT movie_id, revenue, (LEAST((rn - 1) // (n // 4), 3) + 1)::INT AS chunk_id
           FROM (SELECT movie_id, revenue, row_number() OVER (ORDER BY movie_id) AS rn,
                 COUNT(*) OVER () AS n FROM film)""",
    ),
    "purge_sources": (
        ["film"],
        """SELECT source, COUNT(*) AS rows, COALESCE(source NOT LIKE 'CSV_chunk_%', FALSE) AS purged
           FROM (SELECT source FROM film UNION ALL SELECT 'CSV' FROM customer
                 UNION ALL SELECT 'TMDB_API' FROM supplier UNION ALL SELECT NULL FROM nation)
           GROUP BY source""",
    ),
    "purge_remaining": (["film"], "SELECT movie_id, source FROM film"),
    "stg_model": (
        ["stg"],
        "SELECT * REPLACE (ROUND(profit, 2) AS profit, ROUND(roi, 6) AS roi) FROM stg",
    ),
    "dim_genre_model": (
        ["dim_genre"],
        "SELECT DISTINCT genre_name FROM dim_genre WHERE genre_name <> 'Unknown'",
    ),
    "median_fill_runtime": (
        ["film"],
        """SELECT COUNT(*) AS rows, COUNT(*) FILTER (runtime IS NULL) AS filled, MAX(m) AS median,
           ROUND(SUM(COALESCE(runtime, m)), 2) AS total_runtime
           FROM film, (SELECT MEDIAN(runtime) AS m FROM film)""",
    ),
    "null_profile": (["film"], _null_rows(_PROFILED, "film")),
    "top_missing": (
        ["film"],
        f"""SELECT "column", missing, missing_pct FROM ({_null_rows(_PROFILED, "film")})
            WHERE missing > 0 ORDER BY missing DESC, "column" LIMIT 10""",
    ),
    "distinct_profile": (
        ["film"],
        " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", COUNT(DISTINCT {c}) AS distinct_values FROM film"""
            for c, _ in _PROFILED
        ),
    ),
    "describe_money": (["film"], _describe_rows(["budget", "revenue"], "film", 4)),
    "describe_lines": (
        [],
        _describe_rows(["l_quantity", "l_extendedprice", "l_discount", "l_tax"], "lineitem", 6),
    ),
    "token_frequency": (
        ["film"],
        """SELECT value, COUNT(*) AS count
           FROM (SELECT unnest(string_split(genres, '-')) AS value FROM film) GROUP BY value""",
    ),
    "top_tokens": (
        ["film"],
        """SELECT value, COUNT(*) AS count
           FROM (SELECT unnest(string_split(genres, '-')) AS value FROM film) GROUP BY value
           ORDER BY count DESC, value LIMIT 10""",
    ),
    "decade_histogram": (
        ["film"],
        """SELECT (year(release_date) // 10 * 10)::INT AS decade, COUNT(*) AS films FROM film
           WHERE year(release_date) BETWEEN 1900 AND 2029 GROUP BY decade""",
    ),
    "year_counts": (
        ["film"],
        """SELECT year(release_date)::INT AS year, COUNT(*) AS count FROM film
           WHERE release_date IS NOT NULL GROUP BY 1""",
    ),
    "date_range": (
        ["film"],
        "SELECT MIN(release_date) AS earliest, MAX(release_date) AS latest FROM film",
    ),
    "top_grossing": (
        ["film"],
        """SELECT movie_id, title, substr(title, 1, 45) AS shown_title, release_date,
           ROUND(revenue / 1e9, 9) AS revenue_billions,
           ROUND(budget / 1e6, 9) AS budget_millions FROM film
           ORDER BY revenue DESC, movie_id LIMIT 10""",
    ),
    "top_staged": (
        ["staging"],
        """SELECT movie_id, title, release_date, budget, revenue, ROUND(roi, 6) AS roi FROM staging
           ORDER BY revenue DESC, movie_id LIMIT 5""",
    ),
    "duplicate_line_keys": (
        [],
        """SELECT COALESCE(SUM(n), 0)::BIGINT AS duplicate_rows, COUNT(*) AS duplicate_keys
           FROM (SELECT COUNT(*) AS n FROM lineitem GROUP BY l_orderkey HAVING COUNT(*) > 1)""",
    ),
    "document_profile": ([], _null_rows(_DOCUMENT_COLUMNS, "documents")),
    "dq_report": (
        ["report"],
        """SELECT "table", validation_type, total_records, invalid_records,
           ROUND(pct, 6) AS invalid_percentage,
           CASE WHEN pct < 0.5 THEN 'PASS' WHEN pct < 5 THEN 'WARNING' ELSE 'FAIL' END AS status,
           description FROM report""",
    ),
    "dq_report_dirty": (
        ["dirty_rules"],
        """SELECT "table", r.rule AS validation_type, total_records, r.bad AS invalid_records,
           ROUND(r.bad * 100.0 / total_records, 6) AS invalid_percentage,
           CASE WHEN r.bad * 100.0 / total_records < 0.5 THEN 'PASS'
                WHEN r.bad * 100.0 / total_records < 5 THEN 'WARNING' ELSE 'FAIL' END AS status,
           r.text AS description FROM dirty_rules""",
    ),
    "first_match_keys": (
        [], "SELECT p_type, MIN(p_partkey) AS p_partkey FROM part GROUP BY p_type",
    ),
    "strict_dates": ([], "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders"),
    "csv_round_trip": (
        ["cleaned"],
        """SELECT id, NULLIF(title, '') AS title, NULLIF(genres, '') AS genres, release_date, budget,
           revenue FROM cleaned""",
    ),
    "warehouse_rebuild": (
        ["fact", "by_genre", "yearly", "report"],
        """SELECT table_name, n AS rows, CASE WHEN table_name <> 'quality_report' THEN n END AS last_key
           FROM (SELECT 'staging_movies' AS table_name, COUNT(*) AS n FROM staging
                 UNION ALL SELECT 'dim_genre', COUNT(*) FROM dim_genre
                 UNION ALL SELECT 'dim_time', COUNT(*) FROM dim_time
                 UNION ALL SELECT 'dim_country', COUNT(*) FROM dim_country
                 UNION ALL SELECT 'dim_studio', COUNT(*) FROM dim_studio
                 UNION ALL SELECT 'fact_movies', COUNT(*) FROM fact
                 UNION ALL SELECT 'agg_genre_performance', COUNT(*) FROM by_genre
                 UNION ALL SELECT 'agg_yearly_trends', COUNT(*) FROM yearly
                 UNION ALL SELECT 'quality_report', COUNT(*) FROM report
                 UNION ALL SELECT 'etl_log', 4)""",
    ),
    "run_log": (
        ["fact", "by_genre", "yearly", "report"],
        """SELECT log_id::BIGINT AS log_id, job_name, rows_processed::BIGINT AS rows_processed,
             rows_failed::BIGINT AS rows_failed,
             CASE WHEN log_id < 4 THEN 'SUCCESS' WHEN pct < 0.5 THEN
               CASE WHEN rows_failed = 0 THEN 'SUCCESS' ELSE 'PARTIAL_SUCCESS' END
               WHEN pct < 5 THEN 'SUCCESS_WITH_WARNINGS' ELSE 'FAILED' END AS outcome,
             TRUE AS timed
           FROM (SELECT *, rows_failed * 100.0 / rows_processed AS pct FROM (
             SELECT 1 AS log_id, 'Load_Dimensions' AS job_name, (SELECT COUNT(*) FROM dim_genre)
                      + (SELECT COUNT(*) FROM dim_time) + (SELECT COUNT(*) FROM dim_country)
                      + (SELECT COUNT(*) FROM dim_studio) AS rows_processed, 0 AS rows_failed
             UNION ALL SELECT 2, 'Load_Fact', (SELECT COUNT(*) FROM fact), 0
             UNION ALL SELECT 3, 'Load_Aggregations',
                      (SELECT COUNT(*) FROM by_genre) + (SELECT COUNT(*) FROM yearly), 0
             UNION ALL SELECT 4, 'Data_Quality_Validation',
                      (SELECT COUNT(*) FROM staging) + (SELECT COUNT(*) FROM fact),
                      (SELECT SUM(invalid_records)::BIGINT FROM report)))""",
    ),
    "warehouse_parts": (
        ["staging"],
        """SELECT CASE WHEN again THEN 5 ELSE part END::BIGINT AS log_id, 'CSV_chunk_' || part AS source,
             CASE WHEN again THEN 'SKIPPED' ELSE 'PARTIAL_SUCCESS' END AS status,
             CASE WHEN again THEN 0 ELSE good END::BIGINT AS rows_processed,
             CASE WHEN again THEN 0 ELSE bad END::BIGINT AS rows_failed,
             good AS staged, bad AS aside
           FROM (SELECT 1 + movie_id % 4 AS part,
                   COUNT(*) FILTER (roi IS NOT NULL AND release_date IS NOT NULL) AS good,
                   COUNT(*) FILTER (roi IS NULL OR release_date IS NULL) AS bad
                 FROM staging GROUP BY 1), (VALUES (FALSE), (TRUE)) AS turns(again)
           WHERE part = 1 OR NOT again""",
    ),
    "staging_keys": (
        ["film"],
        """SELECT load, n AS rows, n AS keys, (last - n + 1)::BIGINT AS first_key,
             last::BIGINT AS last_key
           FROM (SELECT load, n, SUM(n) OVER (ORDER BY load) AS last FROM (
             SELECT GREATEST(right(source, 1)::INT, 2) AS load, COUNT(*) AS n FROM film GROUP BY 1))""",
    ),
    "dense_fact_keys": (
        [],
        """SELECT COUNT(*) AS rows, COUNT(*) AS keys, 101::BIGINT AS first_key,
             100 + COUNT(*) AS last_key FROM lineitem""",
    ),
    "warehouse_generations": (
        ["film"],
        """SELECT state, complete, 1::BIGINT AS current, COUNT(*) AS rows,
             ROUND(SUM(revenue), 2) AS revenue
           FROM film, (VALUES ('before', 2::BIGINT), ('after', 1::BIGINT)) AS s(state, complete)
           WHERE revenue >= 200000 GROUP BY state, complete""",
    ),
    "model_tables": (
        ["model_agg"],
        """SELECT 'stg_movies' AS model, COUNT(*) AS rows FROM stg
           UNION ALL SELECT 'model_dim_genre', COUNT(*) FROM dim_genre WHERE genre_name <> 'Unknown'
           UNION ALL SELECT 'model_fact_movies', COUNT(*) FROM model_fact
           UNION ALL SELECT 'model_agg_by_genre', COUNT(*) FROM model_agg""",
    ),
    "purge_partitions": (
        ["film"],
        """SELECT source, COUNT(*) AS rows, ROUND(SUM(revenue), 2) AS revenue FROM (
             SELECT source, revenue FROM film WHERE source <> 'CSV_chunk_4' OR revenue > 0
             UNION ALL SELECT NULL, 0.0 FROM nation) GROUP BY source""",
    ),
    "publish_round_trip": (["film"], "SELECT movie_id, title, revenue FROM film"),
    "schema_report": (
        ["cleaned"],
        """SELECT 'text' AS "table", problem, COUNT(*) AS rows FROM cleaned,
             (VALUES ('missing profit'), ('not numeric budget'), ('not numeric roi')) AS p(problem)
           GROUP BY problem
           UNION ALL
           SELECT 'customer', 'missing ' || name, COUNT(*) FROM customer,
             (VALUES ('id'), ('genres'), ('budget'), ('revenue'), ('vote_average'), ('vote_count'),
                     ('release_date'), ('production_companies'), ('profit'), ('roi')) AS p(name)
           GROUP BY name""",
    ),
    "profile_head": ([], "SELECT n_nationkey, n_name FROM nation LIMIT 5"),
    "fact_caseless": (
        ["caseless_genre", "caseless_studio", "dim_country"],
        """SELECT k.movie_id, g.genre_id, d.studio_id, COALESCE(c.country_id,
                    (SELECT country_id FROM dim_country WHERE country_code = 'UNK')) AS country_id
           FROM (SELECT *, unnest(string_split(genres, '-')) AS token FROM (
                   SELECT *, list_filter(list_transform(string_split(production_companies, '-'),
                       lambda x: trim(x)), lambda x: x <> '' AND x <> 'Unknown')[1] AS studio
                   FROM respelled)
                 WHERE studio IS NOT NULL AND release_date IS NOT NULL
                   AND budget > 0 AND revenue > 0) k
           LEFT JOIN caseless_genre g ON g.folded = lower(trim(k.token))
           LEFT JOIN caseless_studio d ON d.folded = lower(k.studio)
           LEFT JOIN dim_country c ON c.country_code = rtrim(upper(k.original_language))""",
    ),
    "dim_genre_caseless": (["caseless_genre"], "SELECT genre_id, genre_name FROM caseless_genre"),
    "dq_unique_caseless": (
        [],
        """SELECT MIN(name) AS unique_field, COUNT(*) AS n_records
           FROM (SELECT p_type AS name FROM part UNION ALL
                 SELECT lower(p_type) || ' ' FROM part WHERE p_partkey % 2 = 0 UNION ALL
                 SELECT c_name FROM customer UNION ALL
                 SELECT lower(c_name) || '  ' FROM customer WHERE c_custkey % 10 = 0)
           GROUP BY lower(rtrim(name)) HAVING COUNT(*) > 1""",
    ),
    "csv_quoted_breaks": ([], "SELECT doc_id, source, NULLIF(text, '') AS text FROM documents"),
    "parts_round_trip": (
        ["film"],
        """SELECT movie_id, revenue, part FROM (
             SELECT movie_id, revenue, (LEAST((rn - 1) // (n // 4), 3) + 1)::INT AS part
             FROM (SELECT movie_id, revenue, row_number() OVER (ORDER BY movie_id) AS rn,
                   COUNT(*) OVER () AS n FROM film)) WHERE part IN (2, 3)""",
    ),
    "dq_overall": (
        ["report"],
        """SELECT total_validations, total_records, total_issues,
           ROUND(pct, 6) AS invalid_percentage,
           CASE WHEN pct < 0.5 THEN 'EXCELLENT' WHEN pct < 2 THEN 'GOOD'
                WHEN pct < 5 THEN 'ACCEPTABLE' ELSE 'POOR' END AS grade,
           CASE WHEN pct < 0.5 THEN 'SUCCESS' WHEN pct < 5 THEN 'SUCCESS_WITH_WARNINGS'
                ELSE 'FAILED' END AS job_status,
           CASE WHEN pct > 0 THEN printf('Data quality: %.2f%% invalid records', pct) END
             AS error_message
           FROM (SELECT *, total_issues * 100.0 / total_records AS pct FROM (
             SELECT (SELECT COUNT(*) FROM report) AS total_validations,
                    (SELECT COUNT(*) FROM staging) + (SELECT COUNT(*) FROM fact) AS total_records,
                    (SELECT SUM(invalid_records)::BIGINT FROM report) AS total_issues))""",
    ),
    "top_issues": (
        ["report"],
        """SELECT * FROM (SELECT "table", validation_type, invalid_records FROM report
           ORDER BY invalid_records DESC, "table", validation_type LIMIT 5)
           WHERE invalid_records > 0""",
    ),
    "multi_genre_films": (
        ["fact"],
        """SELECT COUNT(*) AS multi_genre_films
           FROM (SELECT movie_id FROM fact GROUP BY movie_id HAVING COUNT(*) > 1)""",
    ),
    "loss_making_films": (
        ["fact"],
        """SELECT COUNT(*) FILTER (budget > 0 AND revenue > 0 AND revenue < budget)
             AS loss_making, COUNT(*) AS fact_rows,
           ROUND(COUNT(*) FILTER (budget > 0 AND revenue > 0 AND revenue < budget) * 100.0
                 / COUNT(*), 6) AS pct FROM fact""",
    ),
    "dq_model_tests": (
        ["model_agg"],
        " UNION ALL ".join(
            f"""SELECT '{t}' AS "table", '{c}' AS "column", 'not_null' AS test,
                COUNT(*) - COUNT({c}) AS failures, COUNT(*) = COUNT({c}) AS passed FROM {src}"""
            for t, src, columns in [
                ("stg_movies", "stg", ["movie_id", "title", "budget", "revenue"]),
                ("fact_movies", "model_fact", ["movie_id", "budget", "revenue"]),
                (
                    "dim_genre",
                    "(SELECT genre_name FROM dim_genre WHERE genre_name <> 'Unknown')",
                    ["genre_name"],
                ),
                ("agg_by_genre", "model_agg", ["genre_name"]),
            ]
            for c in columns
        )
        + "".join(
            f""" UNION ALL SELECT '{t}', 'genre_name', 'unique', COUNT(*), COUNT(*) = 0
                FROM (SELECT genre_name FROM {src} WHERE genre_name IS NOT NULL
                      GROUP BY genre_name HAVING COUNT(*) > 1)"""
            for t, src in [("dim_genre", "dim_genre"), ("agg_by_genre", "model_agg")]
        ),
    ),
    "dq_unique_failures": (
        [],
        """SELECT l_orderkey AS unique_field, COUNT(*) AS n_records FROM lineitem
           WHERE l_orderkey IS NOT NULL GROUP BY l_orderkey HAVING COUNT(*) > 1""",
    ),
    "dq_not_null_failures": (["film"], "SELECT movie_id FROM film WHERE genres IS NULL"),
    "dq_formula_match": (
        ["staging"],
        """SELECT *, ROUND(profit_matches * 100.0 / profit_rows, 6) AS profit_pct,
           ROUND(roi_matches * 100.0 / roi_rows, 6) AS roi_pct FROM (
             SELECT COUNT(*) FILTER (budget > 0 AND revenue > 0) AS profit_rows,
             COUNT(*) FILTER (budget > 0 AND revenue > 0 AND abs(revenue - budget - profit) < 1)
               AS profit_matches,
             COUNT(*) FILTER (budget > 0 AND profit IS NOT NULL AND roi IS NOT NULL) AS roi_rows,
             COUNT(*) FILTER (budget > 0 AND abs(profit / budget - roi) < 0.01) AS roi_matches
             FROM staging)""",
    ),
    "dq_cleaned_checks": (
        ["cleaned"],
        "SELECT 'rows' AS check_name, COUNT(*)::DOUBLE AS value, 1000.0::DOUBLE AS limit_value,"
        " COUNT(*) >= 1000 AS passed FROM cleaned"
        + "".join(
            f""" UNION ALL SELECT '{name}', ROUND(COUNT(*) FILTER ({bad}) * 100.0 / COUNT(*), 6),
                {limit}, COUNT(*) FILTER ({bad}) * 100.0 / COUNT(*) < {limit} FROM cleaned"""
            for name, bad, limit in [
                ("empty title pct", "title IS NULL OR title = ''", 1.0),
                ("empty release_date pct", "release_date IS NULL", 1.0),
                ("empty genres pct", "genres IS NULL OR genres = ''", 10.0),
                ("empty budget pct", "budget IS NULL", 50.0),
                ("empty revenue pct", "revenue IS NULL", 50.0),
                ("bad date pct", "release_date IS NULL", 5.0),
            ]
        )
        + "".join(
            f""" UNION ALL SELECT '{name}', COUNT(*) FILTER ({bad})::DOUBLE, 0.0,
                COUNT(*) FILTER ({bad}) = 0 FROM cleaned"""
            for name, bad in [
                ("negative budget", "budget < 0"),
                ("negative revenue", "revenue < 0"),
                ("rating out of range", "vote_average < 0 OR vote_average > 10"),
                *[
                    (f"null {c}", f"{c} IS NULL")
                    for c in ("id", "title", "release_date", "budget", "revenue", "genres")
                ],
            ]
        ),
    ),
    "dq_combined_invalid": (
        ["film"],
        """SELECT total_records, invalid_records,
           ROUND(invalid_records * 100.0 / total_records, 6) AS invalid_percentage,
           invalid_records * 100.0 / total_records < 0.5 AS passed
           FROM (SELECT COUNT(*) AS total_records, COUNT(*) FILTER (budget < 0 OR revenue < 0
                 OR vote_average < 0 OR vote_average > 10) AS invalid_records FROM film)""",
    ),
    "dq_layer_counts": (
        ["fact"],
        " UNION ALL ".join(
            f"""SELECT '{layer}' AS layer, COUNT(*) AS rows, {minimum}::BIGINT AS minimum,
                COUNT(*) >= {minimum} AS passed FROM {src}"""
            for layer, src, minimum in [
                ("Staging_Movies", "staging", 1001),
                ("Dim_Genre", "dim_genre", 10),
                ("Dim_Time", "dim_time", 100),
                ("Dim_Studio", "dim_studio", 50),
                ("Fact_Movies", "fact", 1001),
            ]
        ),
    ),
    "events_props_json": (
        [],
        """SELECT event_type, COUNT(*) AS events, SUM(k)::BIGINT AS total_k, MAX(k) AS max_k
           FROM (SELECT event_type, COALESCE((props->>'$.k')::BIGINT, 0) AS k FROM events)
           GROUP BY event_type""",
    ),
    "listing_flatten": ([], "SELECT o_orderkey AS movie_id FROM orders"),
    "details_flatten": (
        ["documents_parsed"],
        """SELECT * REPLACE (ROUND(profit, 2) AS profit, ROUND(roi, 6) AS roi)
           FROM documents_parsed""",
    ),
    "delta_new_ids": (
        ["documents_parsed"],
        """SELECT movie_id, title, genres, release_date, budget, revenue, profit
           FROM documents_parsed
           WHERE movie_id NOT IN (SELECT movie_id FROM film WHERE source <> 'CSV_chunk_4')""",
    ),
    "primary_tokens": (
        ["first_tokens"],
        "SELECT movie_id, primary_genre, primary_studio FROM first_tokens",
    ),
    "genre_label_encode": (
        ["first_tokens"],
        """SELECT primary_genre, row_number() OVER (ORDER BY primary_genre) - 1 AS genre_encoded
           FROM (SELECT DISTINCT primary_genre FROM first_tokens)""",
    ),
    "first_genre_labels": (
        ["first_tokens"],
        """SELECT row_number() OVER (ORDER BY primary_genre) - 1 AS genre_encoded, primary_genre
           FROM (SELECT DISTINCT primary_genre FROM first_tokens) ORDER BY 1 LIMIT 5""",
    ),
    "studio_frequency": (
        ["first_tokens"],
        """SELECT primary_studio, COUNT(*) AS studio_freq FROM first_tokens
           GROUP BY primary_studio""",
    ),
    "top_studios": (
        ["first_tokens"],
        """SELECT primary_studio AS value, COUNT(*) AS count FROM first_tokens
           GROUP BY primary_studio ORDER BY count DESC, value LIMIT 5""",
    ),
    "regression_features": (
        ["scored"],
        """SELECT id, revenue, budget, runtime, popularity, vote_average, vote_count, release_year,
           release_month, genre_encoded, studio_freq, split,
           (substr(md5(CAST(id AS VARCHAR)), 9, 8) >= '33333333')::INT
           + (substr(md5(CAST(id AS VARCHAR)), 9, 8) >= '66666666')::INT
           + (substr(md5(CAST(id AS VARCHAR)), 9, 8) >= '99999999')::INT
           + (substr(md5(CAST(id AS VARCHAR)), 9, 8) >= 'cccccccc')::INT AS fold FROM scored""",
    ),
    "prediction_errors": (
        ["scored"],
        """SELECT id, title, budget, revenue, genres, production_companies, release_year,
           ROUND(predicted_revenue, 2) AS predicted_revenue,
           ROUND(prediction_error, 2) AS prediction_error,
           ROUND(abs(prediction_error / revenue * 100), 4) AS error_percentage,
           CASE WHEN prediction_error > 0 THEN 'Over-performing' ELSE 'Under-performing' END
             AS performance FROM scored""",
    ),
    "split_metrics": (
        ["scored"],
        """SELECT split, COUNT(*) AS rows,
           ROUND(1 - SUM(prediction_error * prediction_error)
                 / (VAR_POP(revenue) * COUNT(*)), 6) AS r2,
           ROUND(AVG(abs(prediction_error)), 4) AS mae,
           ROUND(sqrt(AVG(prediction_error * prediction_error)), 4) AS rmse,
           1 - SUM(prediction_error * prediction_error) / (VAR_POP(revenue) * COUNT(*)) > 0.6
             AS on_target FROM scored GROUP BY split""",
    ),
    "linear_regression": (
        ["features"],
        f"""SELECT split, COUNT(*) AS rows,
              ROUND(1 - SUM(e * e) / (VAR_POP(y) * COUNT(*)), 6) AS r2, ROUND(AVG(abs(e)), 2) AS mae,
              ROUND(sqrt(AVG(e * e)), 2) AS rmse,
              1 - SUM(e * e) / (VAR_POP(y) * COUNT(*)) > 0.6 AS on_target
            FROM (SELECT y, y - ({_PREDICTED}) AS e,
                    CASE WHEN substr(md5(CAST(id AS VARCHAR)), 1, 8) < '33333333' THEN 'test'
                         ELSE 'train' END AS split
                  FROM ({_PAID}), ({_least_squares(_TRAIN)})) GROUP BY split""",
    ),
    "coefficient_ranking": (
        ["features"],
        " UNION ALL ".join(
            f"SELECT '{c}' AS feature, ROUND(c{i}, 4) AS coefficient FROM fit" for i, c in enumerate(_FITTED)
        ).join([f"SELECT * FROM (WITH fit AS ({_least_squares(_TRAIN)}) ", ")"]),
    ),
    "cross_validation": (
        ["features"],
        f"""SELECT * FROM (WITH folded AS ({_FOLDED}), fits AS ({_least_squares(
              "SELECT f.*, g.grp FROM folded f JOIN (SELECT unnest(range(5)) AS grp) g ON f.fold <> g.grp")}),
            scores AS (
              SELECT fold, COUNT(*) AS rows, 1 - SUM(e * e) / (VAR_POP(y) * COUNT(*)) AS r2
              FROM (SELECT fold, y, y - ({_PREDICTED}) AS e FROM folded JOIN fits ON grp = fold)
              GROUP BY fold)
            SELECT fold, rows, ROUND(r2, 6) AS r2, ROUND(AVG(r2) OVER (), 6) AS mean_r2,
              ROUND(STDDEV_POP(r2) OVER (), 6) AS std_r2 FROM scores)""",
    ),
    "best_and_worst": (
        ["scored"],
        """SELECT id, title, revenue, ROUND(predicted_revenue, 2) AS predicted_revenue,
           ROUND(prediction_error, 2) AS prediction_error, side
           FROM ((SELECT *, 'over' AS side FROM scored ORDER BY prediction_error DESC, id LIMIT 10)
                 UNION ALL
                 (SELECT *, 'under' AS side FROM scored ORDER BY prediction_error, id LIMIT 10))""",
    ),
    "yearly_series": (
        ["yearly"],
        """SELECT make_date(year, 1, 1) AS ds, year, ROUND(total_revenue / 1e9, 9) AS y
           FROM yearly WHERE year BETWEEN 1980 AND 2024""",
    ),
    "recent_history": (
        ["yearly"],
        """SELECT make_date(year, 1, 1) AS ds, year, ROUND(total_revenue / 1e9, 9) AS y
           FROM yearly WHERE year BETWEEN 1999 AND 2024""",
    ),
    "yearly_forecast": (["yearly"], _forecast("yearly")),
    "segment_forecast": (["segment_years"], _forecast("segment_years", "c_mktsegment")),
    "changepoint_forecast": (["yearly"], _changepoints("yearly", 3)),
    "segment_changepoints": (["segment_years"], _changepoints("segment_years", 2, "c_mktsegment")),
    "incremental_events": (
        [],
        """SELECT event_type, COUNT(*) AS events, COUNT(DISTINCT event_id) AS ids,
           ROUND(SUM(value), 2) AS total_value FROM events GROUP BY event_type""",
    ),
    "incremental_details": (
        ["documents_parsed"],
        """SELECT movie_id, title, release_date, revenue, source FROM documents_parsed
           WHERE movie_id NOT IN (SELECT movie_id FROM film WHERE source <> 'CSV_chunk_4')""",
    ),
    "delta_rejects": (
        [],
        """SELECT CASE WHEN o_orderkey % 53 = 0 THEN 'cut short'
                  WHEN o_orderkey % 59 = 0 THEN 'null budget' ELSE 'loaded' END AS outcome,
             COUNT(*) AS documents FROM orders GROUP BY 1""",
    ),
}


# Rough rows: as film, with text that is no date or number read as missing
PARTS |= {
    "rough": """
        SELECT * REPLACE (
          title || ': a title longer than what any narrow display shows' AS title,
          CASE WHEN movie_id % 59 = 0 THEN DATE '2031-02-03' WHEN movie_id % 67 = 0 THEN DATE '1899-12-31'
               WHEN movie_id % 71 = 0 OR movie_id % 5 = 1 THEN NULL ELSE release_date END AS release_date,
          CASE WHEN movie_id % 53 = 0 THEN NULL WHEN movie_id % 61 = 0 THEN 2e9 ELSE budget END AS budget,
          CASE WHEN movie_id % 73 = 0 THEN 1.5e10 WHEN movie_id % 79 = 0 THEN NULL ELSE revenue END AS revenue,
          CASE WHEN movie_id % 3 = 1 THEN NULL ELSE runtime END AS runtime,
          CASE movie_id % 4 WHEN 1 THEN 'Columbia Pictures-' || production_companies
               WHEN 2 THEN 'Independent Film Makers of Region ' || movie_id % 7 || '-' || production_companies
               ELSE production_companies END AS production_companies)
        FROM film""",
    "rough_staging": PARTS["staging"].replace("FROM film", "FROM rough"),
    "rough_cleaned": PARTS["cleaned"].replace("FROM staging", "FROM rough_staging"),
    "spoiled": """
        SELECT * REPLACE (
          CASE WHEN id % 7 = 0 THEN profit + 5 ELSE profit END AS profit,
          CASE WHEN id % 6 = 0 THEN roi + 1 ELSE roi END AS roi,
          CASE WHEN id % 43 = 0 THEN NULL WHEN id % 9 = 0 THEN -1.0 ELSE budget END AS budget,
          CASE WHEN id % 23 = 0 THEN NULL WHEN id % 8 = 0 THEN -2.0 ELSE revenue END AS revenue,
          CASE WHEN id % 17 = 0 THEN 12.0 ELSE vote_average END AS vote_average,
          CASE WHEN id % 20 <> 0 THEN title END AS title,
          CASE WHEN id % 5 <> 0 THEN runtime END AS runtime,
          CASE WHEN id % 31 <> 0 THEN release_date END AS release_date,
          CASE WHEN id % 37 <> 0 THEN genres END AS genres)
        FROM rough_cleaned""",
    "rough_features": """
        SELECT id, revenue, budget, filled AS runtime, popularity, vote_average, vote_count, release_year,
               release_month, genre_encoded, studio_freq
        FROM (SELECT *, COALESCE(runtime, MEDIAN(runtime) OVER ()) AS filled,
                     dense_rank() OVER (ORDER BY primary_genre) - 1 AS genre_encoded,
                     COUNT(*) OVER (PARTITION BY primary_studio) AS studio_freq
              FROM (SELECT *, CASE WHEN COALESCE(genres, '') = '' THEN 'Unknown'
                                   ELSE trim(split_part(genres, '-', 1)) END AS primary_genre,
                           trim(split_part(production_companies, '-', 1)) AS primary_studio
                    FROM spoiled))
        WHERE revenue > 0""",
    "rough_studio": PARTS["dim_studio"].replace("FROM staging", "FROM rough"),
}
NEEDS |= {
    "rough": ["film"],
    "rough_staging": ["rough"],
    "rough_cleaned": ["rough_staging"],
    "spoiled": ["rough_cleaned"],
    "rough_features": ["spoiled"],
    "rough_studio": ["rough"],
}
FINAL |= {
    "rough_clean": (["rough_cleaned"], FINAL["clean_movies"][1].replace("FROM cleaned", "FROM rough_cleaned")),
    "rough_step_counts": (
        ["rough"],
        FINAL["clean_step_counts"][1]
        .replace("FROM film", "FROM rough")
        .replace("NOT (budget > 0 AND revenue > 0)", "NOT COALESCE(budget > 0 AND revenue > 0, FALSE)"),
    ),
    "rough_top_grossing": (
        ["rough_cleaned"],
        """SELECT id, title, substr(title, 1, 45) AS shown_title, release_date,
           ROUND(revenue / 1e9, 9) AS revenue_billions, ROUND(budget / 1e6, 9) AS budget_millions
           FROM rough_cleaned ORDER BY revenue DESC, id LIMIT 10""",
    ),
    "rough_studios": (["rough_studio"], "SELECT * FROM rough_studio"),
    "rough_formula_match": (
        ["spoiled"],
        """SELECT *, ROUND(profit_matches * 100.0 / profit_rows, 6) AS profit_pct,
           ROUND(roi_matches * 100.0 / roi_rows, 6) AS roi_pct FROM (
             SELECT COUNT(*) FILTER (budget > 0 AND revenue > 0) AS profit_rows,
             COUNT(*) FILTER (budget > 0 AND revenue > 0 AND abs(revenue - budget - profit) < 1)
               AS profit_matches,
             COUNT(*) FILTER (budget > 0 AND revenue IS NOT NULL) AS roi_rows,
             COUNT(*) FILTER (budget > 0 AND revenue IS NOT NULL AND abs(profit / budget - roi) < 0.01)
               AS roi_matches FROM spoiled)""",
    ),
    "rough_cleaned_checks": (
        ["spoiled"], FINAL["dq_cleaned_checks"][1].replace("FROM cleaned", "FROM spoiled")
    ),
    "rough_features": (["rough_features"], "SELECT * FROM rough_features"),
}


def _closure(names: list[str]) -> list[str]:
    wanted: set[str] = set()

    def add(name: str) -> None:
        for need in NEEDS[name]:
            add(need)
        wanted.add(name)

    for name in names:
        add(name)
    return [name for name in PARTS if name in wanted]


def sql(name: str) -> str:
    """Full text of one query."""
    blocks, select = FINAL[name]
    parts = [f"{part} AS MATERIALIZED ({PARTS[part]})" for part in _closure(blocks)]
    return (f"WITH {', '.join(parts)} " if parts else "") + select
