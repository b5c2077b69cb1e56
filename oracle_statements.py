"""The expected result of every registered query, as SQL on the given tables.

The statements never touch JSON: they work out the rows from the relational tables, so they check
parsing, cleaning and deduplication independently.
"""

from __future__ import annotations

_CTES = """
WITH base AS (
  SELECT o_orderkey AS id,
    concat('  ', o_orderpriority, ' #', CAST(o_orderkey AS VARCHAR), ' ') AS raw_title,
    CASE WHEN o_orderkey % 41 <> 0 THEN concat(' ', lower(n_name), ' ') END AS raw_language,
    CASE WHEN o_orderkey % 11 = 0 THEN '' WHEN o_orderkey % 23 = 0 THEN 'not-a-date'
         WHEN o_orderkey % 31 = 0 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS raw_date,
    CASE WHEN o_orderkey % 5 = 0 THEN 0 ELSE CAST(floor(o_totalprice) AS BIGINT) END AS raw_budget,
    CAST(floor(o_totalprice * (o_orderkey % 13) / CAST(4 AS DOUBLE)) AS BIGINT) AS raw_revenue,
    CAST(o_orderkey % 200 + CASE WHEN o_orderkey % 53 = 0 THEN 1000 ELSE 0 END AS INTEGER) AS raw_runtime,
    CAST(o_orderkey % 101 AS DOUBLE) / 10 AS raw_average,
    CAST(o_orderkey % 17 AS INTEGER) AS vote_count,
    o_totalprice / 1000 AS popularity,
    CASE WHEN o_orderkey % 89 <> 0 THEN o_orderkey % 97 = 0 END AS is_adult,
    CASE WHEN o_orderkey % 19 = 0 THEN '' WHEN o_orderkey % 29 = 0 THEN '   '
         ELSE concat('about ', CAST(o_orderkey AS VARCHAR)) END AS overview,
    n_name AS home_language,
    NOT (o_orderstatus = 'P' AND o_orderpriority = '5-LOW') AS has_details,
    o_orderpriority = '1-URGENT' OR o_totalprice < 100000 AS is_popular,
    o_orderpriority = '2-HIGH' OR o_totalprice > 400000 AS is_trending,
    o_orderstatus = 'P' AS is_relisted,
    CAST(year(o_orderdate) AS INTEGER) AS listed_year
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
), lines AS (
  SELECT l.*, p_type, s_name, n_name AS s_nation,
    CASE p_type WHEN 'ECONOMY' THEN 1 WHEN 'LARGE' THEN 2 WHEN 'MEDIUM' THEN 3
                WHEN 'PROMO' THEN 4 WHEN 'SMALL' THEN 5 WHEN 'STANDARD' THEN 6 END AS type_id
  FROM lineitem l LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey
    LEFT JOIN nation ON s_nationkey = n_nationkey
), fetched AS (
  SELECT id, CAST(l_shipdate AS TIMESTAMP) AS fetched_at, l_returnflag <> 'N' AS has_runtime,
    l_partkey, l_suppkey, l_linenumber, l_quantity, l_tax, l_returnflag, l_linestatus,
    p_type, type_id, s_name, s_nation, home_language
  FROM base JOIN lines ON id = l_orderkey WHERE has_details
), bare AS (
  SELECT id, TIMESTAMP '2024-01-01 00:00:00' AS fetched_at FROM base
  WHERE has_details AND id NOT IN (SELECT l_orderkey FROM lineitem)
), fetches AS (
  SELECT id, fetched_at, has_runtime, 3 AS genre_entries FROM fetched
  UNION ALL SELECT id, fetched_at, true, 0 FROM bare
), listed AS (
  SELECT id, 'discover' AS source_endpoint, TIMESTAMP '2024-01-02 00:00:00' AS ingested_at FROM base
  UNION ALL SELECT id, 'popular', TIMESTAMP '2024-01-03 00:00:00' FROM base WHERE is_popular
  UNION ALL SELECT id, 'trending', TIMESTAMP '2024-01-04 00:00:00' FROM base WHERE is_trending
), lookups AS (
  SELECT p_type FROM part
), raw_movies AS (
  SELECT id AS movie_id, source_endpoint, ingested_at FROM listed
  UNION ALL SELECT id, 'details', fetched_at FROM fetches
  UNION ALL SELECT id, 'credits', fetched_at FROM fetches
  UNION ALL SELECT NULL, 'genres', TIMESTAMP '2023-01-01 00:00:00' FROM lookups
  UNION ALL SELECT NULL, 'genres', TIMESTAMP '2024-01-01 00:00:00' FROM lookups
  UNION ALL SELECT NULL, 'details', TIMESTAMP '2024-01-05 00:00:00' FROM pages
  UNION ALL SELECT NULL, 'trending', TIMESTAMP '2024-01-06 00:00:00' FROM events
), documents_of_movies AS (
  SELECT id, 'details' AS source_endpoint, fetched_at AS ingested_at, genre_entries, true AS detailed, has_runtime,
    4 AS priority FROM fetches
  UNION ALL SELECT id, source_endpoint, ingested_at, NULL, false, false,
    CASE source_endpoint WHEN 'discover' THEN 3 WHEN 'popular' THEN 2 ELSE 1 END FROM listed
), parsed AS (
  SELECT id AS movie_id, source_endpoint, ingested_at, raw_title, raw_language, raw_date,
    CASE WHEN detailed THEN raw_budget END AS raw_budget, CASE WHEN detailed THEN raw_revenue END AS raw_revenue,
    CASE WHEN has_runtime THEN raw_runtime END AS raw_runtime, raw_average, vote_count, popularity, is_adult,
    overview, genre_entries, priority, detailed
  FROM documents_of_movies JOIN base USING (id)
), staged AS (
  SELECT movie_id, source_endpoint, ingested_at, priority, trim(raw_title) AS title,
    trim(raw_title) AS original_title, upper(trim(raw_language)) AS original_language,
    TRY_CAST(nullif(raw_date, '') AS DATE) AS release_date,
    CAST(year(TRY_CAST(nullif(raw_date, '') AS DATE)) AS INTEGER) AS release_year,
    nullif(raw_budget, 0) AS budget, nullif(raw_revenue, 0) AS revenue, nullif(raw_runtime, 0) AS runtime,
    CASE WHEN vote_count = 0 THEN NULL ELSE raw_average END AS vote_average, vote_count, popularity, is_adult,
    trim(overview) = '' AS overview_is_empty,
    CAST((nullif(raw_budget, 0) IS NOT NULL)::INTEGER + (nullif(raw_revenue, 0) IS NOT NULL)::INTEGER
      + (nullif(raw_runtime, 0) IS NOT NULL)::INTEGER + CASE WHEN detailed THEN 3 ELSE 0 END AS INTEGER) AS completeness_score
  FROM parsed
), movies_by_priority AS (
  SELECT * FROM staged
  QUALIFY row_number() OVER (PARTITION BY movie_id ORDER BY completeness_score DESC, priority DESC, ingested_at DESC) = 1
), movies_by_recency AS (
  SELECT * FROM staged
  QUALIFY row_number() OVER (PARTITION BY movie_id ORDER BY completeness_score DESC, ingested_at DESC) = 1
), movies AS (
  SELECT movie_id, title, original_title, original_language, release_date, release_year, budget, revenue, runtime,
    vote_average, vote_count, popularity, is_adult, overview_is_empty, ingested_at FROM movies_by_priority
), genres AS (
  SELECT DISTINCT CAST(CASE p_type WHEN 'ECONOMY' THEN 1 WHEN 'LARGE' THEN 2 WHEN 'MEDIUM' THEN 3 WHEN 'PROMO' THEN 4
    WHEN 'SMALL' THEN 5 WHEN 'STANDARD' THEN 6 END AS BIGINT) AS genre_id, p_type AS genre_name FROM lookups
), movie_genres AS (
  SELECT DISTINCT id AS movie_id, CAST(type_id AS BIGINT) AS genre_id FROM fetched
  UNION SELECT DISTINCT id, CAST(CASE WHEN l_linenumber = 7 THEN 99 ELSE l_linenumber END AS BIGINT) FROM fetched
), movie_companies AS (
  SELECT id AS movie_id, s_name AS company_name FROM fetched
  UNION SELECT id, concat(s_nation, ' Pictures') FROM fetched
), movie_languages AS (
  SELECT id AS movie_id, s_nation AS language_name FROM fetched
  UNION SELECT id, home_language FROM fetched
), movie_cast AS (
  SELECT id AS movie_id, concat('Person ', CAST(l_partkey AS VARCHAR)) AS person_name, 'Cast' AS role_type,
    concat('Role ', CAST(l_suppkey AS VARCHAR)) AS character_name, CAST(l_linenumber - 1 AS INTEGER) AS cast_order
  FROM fetched WHERE l_tax > 0 AND l_linenumber - 1 <= 4
  UNION SELECT id, concat('Extra ', CAST(l_suppkey AS VARCHAR)), 'Cast', NULL, CAST(floor(l_quantity / 5) AS INTEGER)
  FROM fetched WHERE floor(l_quantity / 5) <= 4
  UNION SELECT id, concat('Person ', CAST(l_suppkey AS VARCHAR)), 'Director', NULL, NULL
  FROM fetched WHERE l_returnflag = 'R'
), days AS (
  SELECT CAST(unnest(generate_series(min(release_date), max(release_date), INTERVAL 1 DAY)) AS DATE) AS full_date FROM movies
), dim_date AS (
  SELECT CAST(year(full_date) * 10000 + month(full_date) * 100 + day(full_date) AS INTEGER) AS date_key, full_date,
    CAST(year(full_date) AS INTEGER) AS calendar_year, CAST(quarter(full_date) AS INTEGER) AS calendar_quarter,
    CAST(month(full_date) AS INTEGER) AS calendar_month, monthname(full_date) AS month_name FROM days
), dim_language AS (
  SELECT row_number() OVER (ORDER BY original_language) AS language_key, original_language AS language_code
  FROM (SELECT DISTINCT original_language FROM movies WHERE original_language IS NOT NULL)
), dim_genre AS (
  SELECT row_number() OVER (ORDER BY genre_name, genre_id) AS genre_key, genre_id, genre_name FROM genres
), keyed AS (
  SELECT row_number() OVER (ORDER BY movie_id) AS movie_key, * FROM movies
), dim_movie AS (
  SELECT movie_key, movie_id, title, original_title, original_language, release_date, release_year, runtime,
    is_adult, overview_is_empty FROM keyed
), fact_movie AS (
  SELECT movie_key, date_key, language_key, budget, revenue, revenue - budget AS profit,
    CAST(revenue - budget AS DOUBLE) / nullif(budget, 0) AS roi, runtime, vote_average, vote_count, popularity
  FROM keyed LEFT JOIN dim_date ON release_date = full_date LEFT JOIN dim_language ON original_language = language_code
), bridge_movie_genre AS (
  SELECT movie_key, genre_key FROM movie_genres JOIN dim_movie USING (movie_id) JOIN dim_genre USING (genre_id)
), studios AS (
  SELECT company_name, count(*) AS movie_count, CAST(sum(revenue) AS BIGINT) AS total_revenue,
    round(avg(vote_average), 6) AS average_rating
  FROM movie_companies JOIN dim_movie USING (movie_id) JOIN fact_movie USING (movie_key) GROUP BY company_name
)
"""

_MEASURES = {
    "revenue": "CAST(sum(revenue) AS BIGINT) AS total_revenue",
    "budget": "CAST(sum(budget) AS BIGINT) AS total_budget",
    "profit": "CAST(coalesce(sum(revenue) - sum(budget), sum(revenue), -sum(budget)) AS BIGINT) AS total_profit",
    "known_profit": "CAST(sum(profit) AS BIGINT) AS known_profit",
    "roi": "round(avg(roi), 6) AS avg_roi",
    "rating": "round(avg(vote_average), 6) AS avg_rating",
    "count": "count(DISTINCT movie_key) AS movie_count",
    "hits": "round(avg(CASE WHEN budget IS NOT NULL AND revenue IS NOT NULL"
            " THEN CASE WHEN revenue > budget THEN 1 ELSE 0 END END), 6) AS hit_rate",
}
_BAND = """CASE WHEN budget IS NULL THEN 'unknown' WHEN budget < 50000 THEN 'under 50k'
  WHEN budget < 150000 THEN '50k to 150k' WHEN budget < 300000 THEN '150k to 300k' ELSE '300k and over' END"""
_WITH_GENRE = "fact_movie JOIN bridge_movie_genre USING (movie_key) JOIN dim_genre USING (genre_key)"


def _measures(*names: str) -> str:
    return ", ".join(_MEASURES[n] for n in names)


_HEADLINE = _measures("revenue", "budget", "profit", "known_profit", "roi", "count", "rating")

_LANDED_ROWS = """
  SELECT id AS movie_id, 'discover' AS source_endpoint, raw_title AS title, CAST(NULL AS BIGINT) AS budget,
    CAST(NULL AS VARCHAR) AS first_job, CAST(NULL AS BIGINT) AS first_genre FROM base
  UNION ALL SELECT id, 'discover', raw_title, NULL, NULL, NULL FROM base WHERE is_relisted
  UNION ALL SELECT id, 'popular', raw_title, NULL, NULL, NULL FROM base WHERE is_popular
  UNION ALL SELECT id, 'popular', raw_title, NULL, NULL, NULL FROM base WHERE is_popular
  UNION ALL SELECT id, 'trending', raw_title, NULL, NULL, NULL FROM base WHERE is_trending
  UNION ALL SELECT id, 'details', raw_title, raw_budget, NULL, type_id FROM fetched JOIN base USING (id)
  UNION ALL SELECT id, 'details', raw_title, raw_budget, NULL, NULL FROM bare JOIN base USING (id)
  UNION ALL SELECT id, 'credits', NULL, NULL, CASE WHEN l_returnflag = 'R' THEN 'Director' ELSE 'Producer' END, NULL
    FROM fetched
  UNION ALL SELECT id, 'credits', NULL, NULL, NULL, NULL FROM bare
  UNION ALL SELECT NULL, 'genres', NULL, NULL, NULL, {genre} FROM lookups, (VALUES (1), (2)) twice
  UNION ALL SELECT NULL, 'details', NULL, NULL, NULL, NULL FROM pages
"""
_GENRE_ID = (
    "CASE p_type WHEN 'ECONOMY' THEN 1 WHEN 'LARGE' THEN 2 WHEN 'MEDIUM' THEN 3"
    " WHEN 'PROMO' THEN 4 WHEN 'SMALL' THEN 5 WHEN 'STANDARD' THEN 6 END"
)
_LANDED = (
    "SELECT movie_id, source_endpoint, TIMESTAMP '2024-06-01 00:00:00' AS ingested_at, title, budget, first_job, first_genre"
    f" FROM ({_LANDED_ROWS.format(genre=_GENRE_ID)})"
)
# Incremental landing has a batch of popular movies appended in between.
_POPULAR = (
    "SELECT id AS movie_id, 'popular' AS source_endpoint, TIMESTAMP '2024-01-03 00:00:00' AS ingested_at,"
    " raw_title AS title, NULL AS budget, NULL AS first_job, NULL AS first_genre FROM base WHERE is_popular"
)

_TABLES = (
    "movies", "genres", "movie_genres", "movie_companies", "movie_languages", "movie_cast", "dim_date",
    "dim_language", "dim_genre", "dim_movie", "fact_movie", "bridge_movie_genre",
)
_SILVER = _TABLES[:6]


def _union(template: str, names: tuple[str, ...]) -> str:
    return " UNION ALL ".join(template.format(t=name) for name in names)


_ISSUES = {
    "zero_budget": "raw_budget = 0",
    "zero_revenue": "raw_revenue = 0",
    "zero_runtime": "raw_runtime = 0",
    "missing_date": "coalesce(raw_date, '') = ''",
    "invalid_date": "raw_date = 'not-a-date'",
    "nested_genres": "genre_entries > 0",
    "number_as_text": "raw_runtime IS NOT NULL",
    "rating_without_votes": "vote_count = 0",
    "untrimmed_title": "raw_title <> trim(raw_title)",
    "unclean_language": "raw_language <> upper(trim(raw_language))",
    "empty_overview": "trim(overview) = ''",
    "revenue_below_budget": "raw_budget > 0 AND raw_revenue > 0 AND raw_revenue < raw_budget",
}
_FIELDS = (
    "title", "original_title", "original_language", "release_date", "release_year", "budget", "revenue",
    "runtime", "vote_average", "vote_count", "popularity", "is_adult", "overview_is_empty", "ingested_at",
)
_TEXT_RULES = (
    "movies_title_too_long", "movies_original_title_too_long", "movies_original_language_too_long",
    "genres_genre_name_too_long", "movie_companies_company_name_too_long", "movie_cast_person_name_too_long",
    "movie_cast_role_type_too_long", "movie_cast_character_name_too_long",
)
_CLEAN_RULES = (
    "movies_zero_budget", "movies_zero_revenue", "movies_zero_runtime", "movies_rating_without_votes",
    "movies_null_id", "fact_null_key", "fact_profit_not_null_safe", "fact_roi_not_null_safe",
    "dim_date_null_key", "bridge_null_key", "movies_duplicate_id", "genres_duplicate_id", "fact_duplicate_key",
    "dim_movie_duplicate_key", "dim_date_duplicate_key", "dim_language_duplicate_code",
    "dim_genre_duplicate_id", "bridge_duplicate_pair", "silver_genre_of_unknown_movie",
    "silver_company_of_unknown_movie", "bridge_movie_unknown", "bridge_genre_unknown",
)


def _dq() -> str:
    counted = {
        "silver_genre_unknown": "SELECT count(*) FROM movie_genres WHERE genre_id NOT IN (SELECT genre_id FROM genres)",
        "movies_original_language_too_long": "SELECT count(*) FROM movies WHERE length(original_language) > 10",
        "movies_zero_budget": "SELECT count(*) FROM movies WHERE budget = 0",
        "movies_duplicate_id":
            "SELECT count(*) FROM (SELECT movie_id FROM movies GROUP BY movie_id HAVING count(*) > 1)",
    }
    null = {
        "movies_null_id": ("movies", "movie_id"), "fact_null_key": ("fact_movie", "movie_key"),
        "genres_null_id": ("genres", "genre_id"), "movie_genres_null_id": ("movie_genres", "genre_id"),
        "movie_companies_null_name": ("movie_companies", "company_name"),
        "movie_languages_null_name": ("movie_languages", "language_name"),
        "movie_cast_null_name": ("movie_cast", "person_name"), "dim_language_null_key": ("dim_language", "language_key"),
        "dim_genre_null_key": ("dim_genre", "genre_key"), "bronze_null_endpoint": ("raw_movies", "source_endpoint"),
        "bronze_null_ingested_at": ("raw_movies", "ingested_at"),
    }
    twice = {
        "genres_duplicate_id": ("genres", "genre_id"), "fact_duplicate_key": ("fact_movie", "movie_key"),
        "dim_movie_duplicate_key": ("dim_movie", "movie_key"), "dim_movie_duplicate_movie": ("dim_movie", "movie_id"),
        "dim_date_duplicate_key": ("dim_date", "date_key"), "dim_date_duplicate_date": ("dim_date", "full_date"),
        "dim_language_duplicate_code": ("dim_language", "language_code"),
        "dim_language_duplicate_key": ("dim_language", "language_key"),
        "dim_genre_duplicate_id": ("dim_genre", "genre_id"), "dim_genre_duplicate_key": ("dim_genre", "genre_key"),
        "bridge_duplicate_pair": ("bridge_movie_genre", "movie_key, genre_key"),
    }
    counted |= {rule: f"SELECT count(*) FROM {t} WHERE {c} IS NULL" for rule, (t, c) in null.items()}
    counted |= {
        rule: f"SELECT count(*) FROM (SELECT {c} FROM {t} GROUP BY {c} HAVING count(*) > 1)" for rule, (t, c) in twice.items()
    }
    counted |= {
        "bronze_null_payload":
            "SELECT (SELECT count(*) FROM pages WHERE html IS NULL) + (SELECT count(*) FROM events WHERE props IS NULL)",
        "dim_date_before_film": "SELECT count(*) FROM dim_date WHERE calendar_year < 1870",
    }
    names = dict.fromkeys([*_CLEAN_RULES, "silver_genre_unknown", *_TEXT_RULES, *counted])
    return " UNION ALL ".join(
        f"SELECT '{name}' AS rule, CAST(({counted.get(name, 'SELECT 0')}) AS BIGINT) AS violations"
        for name in names
    )


def _performers() -> str:
    group = lambda name, order: (
        f"(SELECT '{name}' AS performers, movie_key, language_key, budget FROM fact_movie"
        f" WHERE roi IS NOT NULL ORDER BY roi {order}, movie_key LIMIT 100)"
    )
    return f"""
    , chosen AS ({group('top', 'DESC')} UNION ALL {group('bottom', 'ASC')}), traits AS (
      SELECT performers, 'genre' AS trait, genre_name AS value
        FROM chosen JOIN bridge_movie_genre USING (movie_key) JOIN dim_genre USING (genre_key)
      UNION ALL SELECT performers, 'language', language_code FROM chosen JOIN dim_language USING (language_key)
      UNION ALL SELECT performers, 'budget band', {_BAND} FROM chosen)
    SELECT performers, trait, value, count(*) AS movies,
      round(count(*)::DOUBLE / (SELECT count(*) FROM chosen c WHERE c.performers = traits.performers), 6) AS share
    FROM traits GROUP BY performers, trait, value"""


_CUT = "(id // 64) % 7 = 3"
_PAGES = """(SELECT id, listed_year AS year FROM base UNION ALL
    SELECT id, CAST(listed_year + 1 AS INTEGER) FROM base WHERE is_relisted)"""
_ROUTED = f"""
    , routed AS (
      SELECT 'discover' AS source_endpoint, 'landed' AS reason, count(*) AS n, count(*) AS with_id FROM {_PAGES} WHERE NOT {_CUT}
      UNION ALL SELECT 'discover', 'unreadable', count(DISTINCT (year, id // 64)), NULL FROM {_PAGES} WHERE {_CUT}
      UNION ALL SELECT 'popular', 'landed', 2 * count(*), 2 * count(*) FROM base WHERE is_popular
      UNION ALL SELECT 'trending', 'landed', count(*), count(*) FROM base WHERE is_trending
      UNION ALL SELECT 'trending', CASE WHEN coalesce(trim(props), '') = '' THEN 'empty' ELSE 'no results' END, count(*), NULL
        FROM events GROUP BY ALL
      UNION ALL SELECT 'details', 'landed', count(*), count(*) FROM fetches
      UNION ALL SELECT 'details', CASE WHEN coalesce(trim(html), '') = '' THEN 'empty' ELSE 'unreadable' END, count(*), NULL
        FROM pages GROUP BY ALL
      UNION ALL SELECT 'credits', 'landed', count(*), count(*) FROM fetches
      UNION ALL SELECT 'genres', 'landed', 2 * count(*), 0 FROM lookups
    )
    SELECT * FROM routed WHERE n > 0
    UNION ALL SELECT 'all', 'rows', CAST(sum(n) AS BIGINT), NULL FROM routed WHERE reason = 'landed'
    UNION ALL SELECT 'all', 'rejects', CAST(sum(n) AS BIGINT), NULL FROM routed WHERE reason <> 'landed'
    UNION ALL SELECT 'all', 'documents', (SELECT count(DISTINCT (year, id // 64)) FROM {_PAGES})
      + (SELECT count(*) FROM base WHERE is_popular) + (SELECT count(*) FROM base WHERE is_trending)
      + (SELECT count(*) FROM events) + (SELECT count(*) FROM pages) + 2 * (SELECT count(*) FROM fetches)
      + 2 * (SELECT count(*) FROM lookups), NULL"""

_FIRST_LOADED = """SELECT id, CASE WHEN id IN (
    SELECT id FROM fetches WHERE fetched_at < TIMESTAMP '1996-01-01 00:00:00') THEN 1 ELSE 2 END AS load FROM base"""

_ENFORCED = """
    , judged AS (SELECT movie_id, coalesce(length(original_language) > 10, false) AS long_code FROM staged)
    , kept_out AS (
      SELECT 'movies' AS table_name, 'original_language_length' AS rule, count(*) AS n FROM judged WHERE long_code
      UNION ALL SELECT 'movies', 'movie_id_unique', count(*) - count(DISTINCT movie_id) FROM judged WHERE NOT long_code
      UNION ALL SELECT 'movies', 'accepted', count(DISTINCT movie_id) FROM judged WHERE NOT long_code
      UNION ALL SELECT 'movie_genres', 'genre_id_reference', count(*) FROM movie_genres
        WHERE genre_id NOT IN (SELECT genre_id FROM genres)
      UNION ALL SELECT 'movie_genres', 'accepted', count(*) FROM movie_genres WHERE genre_id IN (SELECT genre_id FROM genres))
    SELECT * FROM kept_out WHERE n > 0"""


def _slicer_totals() -> str:
    headline = _HEADLINE.replace(", 6)", ", 9)")
    slicers = {"calendar_year": "INTEGER", "genre_name": "VARCHAR", "language_code": "VARCHAR"}
    movies = "fact_movie LEFT JOIN dim_date USING (date_key) LEFT JOIN dim_language USING (language_key)"
    parts = []
    for genre in (False, True):
        for year in (False, True):
            for language in (False, True):
                used = [s for s, on in zip(slicers, (year, genre, language)) if on]
                columns = ", ".join(s if s in used else f"CAST(NULL AS {kind}) AS {s}" for s, kind in slicers.items())
                source = f"{movies} JOIN bridge_movie_genre USING (movie_key) JOIN dim_genre USING (genre_key)" if genre else movies
                grouped = f"GROUP BY {', '.join(used)}" if used else ""
                parts.append(
                    f"SELECT {columns}, {headline}, '{'+'.join(used) or 'all'}' AS sliced_by FROM {source} {grouped}")
    return " UNION ALL ".join(parts)


_PEOPLE = """
    , people AS (
      SELECT calendar_year, genre_name, person_name FROM fact_movie LEFT JOIN dim_date USING (date_key)
        JOIN bridge_movie_genre USING (movie_key) JOIN dim_genre USING (genre_key)
        JOIN (SELECT movie_key, movie_id FROM dim_movie) USING (movie_key) JOIN movie_cast USING (movie_id)
      WHERE person_name IS NOT NULL)
    SELECT calendar_year, genre_name, count(DISTINCT person_name) AS people, true AS within_bound
      FROM people GROUP BY calendar_year, genre_name
    UNION ALL SELECT calendar_year, NULL, count(DISTINCT person_name), true FROM people GROUP BY calendar_year
    UNION ALL SELECT NULL, genre_name, count(DISTINCT person_name), true FROM people GROUP BY genre_name"""

_STATEMENTS = {
    "land_routed": _ROUTED,
    "written_counts": _union(
        "SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}", ("raw_movies", *_TABLES)),
    "silver_refresh": "SELECT * FROM movies",
    "refresh_check": _union(
        "SELECT '{t}' AS table_name, CAST(0 AS BIGINT) AS only_a, CAST(0 AS BIGINT) AS only_b,"
        " count(*) AS row_count FROM {t}", _SILVER),
    "stable_keys":
        f"SELECT row_number() OVER (ORDER BY load, id) AS movie_key, id AS movie_id FROM ({_FIRST_LOADED})",
    "refreshed_kpi": """SELECT calendar_year, genre_name, count(*) AS movie_count,
        round(avg(vote_average), 6) AS average_rating, CAST(sum(revenue) AS BIGINT) AS total_revenue
        FROM fact_movie JOIN dim_date USING (date_key) JOIN bridge_movie_genre USING (movie_key)
          JOIN dim_genre USING (genre_key) GROUP BY calendar_year, genre_name""",
    "enforced_write": _ENFORCED,
    "overview_from_mart": f"""SELECT {_HEADLINE} FROM fact_movie
        WHERE date_key // 10000 BETWEEN 1996 AND 1999 AND movie_key IN (
          SELECT movie_key FROM bridge_movie_genre JOIN dim_genre USING (genre_key)
          WHERE genre_name IN ('ECONOMY', 'PROMO'))""",
    "slicer_totals": _slicer_totals(),
    "distinct_people": _PEOPLE,
    "runtime_quantiles": " UNION ALL ".join(
        f"SELECT '{name}' AS quantile, quantile_cont(runtime, {p}) AS exact, count(runtime) AS known,"
        " true AS within_bound FROM movies"
        for name, p in (("q1", 0.25), ("median", 0.5), ("q3", 0.75))),
    "movie_lookup": """SELECT movie_id, title, release_year, f.runtime, f.budget, f.revenue, f.vote_average
        FROM fact_movie f JOIN (SELECT movie_key, movie_id, title, release_year FROM dim_movie) USING (movie_key)
        WHERE roi IS NOT NULL ORDER BY roi DESC, movie_key LIMIT 10""",
    "bronze_land": _LANDED,
    "bronze_incremental": f"{_LANDED} UNION ALL {_POPULAR}",
    "land_json_documents": f"""SELECT 'genres' AS source_endpoint, p_brand AS brand,
        string_agg(concat(g, ':', p_type), ',' ORDER BY g, p_type) AS genres
        FROM (SELECT DISTINCT p_brand, p_type, {_GENRE_ID} AS g FROM part) GROUP BY p_brand""",
    "bronze_by_endpoint":
        "SELECT movie_id, source_endpoint, ingested_at FROM raw_movies WHERE source_endpoint IN ('credits', 'popular')",
    "discover_ids":
        """SELECT movie_id, (min(p)).year AS first_year, (min(p)).page AS first_page, (min(p)).place AS first_position
        FROM (SELECT id AS movie_id, struct_pack(year := year, page := CAST(id // 64 AS INTEGER), place :=
            CAST(row_number() OVER (PARTITION BY year, id // 64 ORDER BY id) - 1 AS INTEGER)) AS p
          FROM (SELECT id, listed_year AS year FROM base UNION ALL
            SELECT id, CAST(listed_year + 1 AS INTEGER) FROM base WHERE is_relisted))
        GROUP BY movie_id""",
    "missing_details": """SELECT id AS movie_id, e AS source_endpoint
        FROM base, (VALUES ('details'), ('credits')) v(e) WHERE NOT has_details""",
    "bronze_roundtrip": "SELECT movie_id, source_endpoint, ingested_at FROM raw_movies",
    "bronze_dedup_append": """
        SELECT source_endpoint, movie_id, count(*) AS documents FROM (
          SELECT id AS movie_id, source_endpoint FROM listed
          UNION ALL SELECT id, 'details' FROM (
            SELECT DISTINCT id, has_runtime, p_type, l_linenumber, l_tax > 0, s_name, s_nation FROM fetched)
          UNION ALL SELECT id, 'credits' FROM (
            SELECT DISTINCT id, l_partkey, l_suppkey, CASE WHEN l_tax > 0 THEN l_linenumber END,
              floor(l_quantity / 5), l_returnflag = 'R', l_linestatus FROM fetched)
          UNION ALL SELECT id, e FROM bare, (VALUES ('details'), ('credits')) v(e)
          UNION ALL SELECT NULL, 'genres' FROM (
            SELECT DISTINCT p_type FROM lookups UNION ALL SELECT DISTINCT lower(p_type) FROM lookups)
          UNION ALL SELECT NULL, 'details' FROM (SELECT DISTINCT html FROM pages)
          UNION ALL SELECT NULL, 'trending' FROM (SELECT DISTINCT props FROM events)
        ) GROUP BY source_endpoint, movie_id""",
    "layer_counts": _union(
        "SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}", ("raw_movies", *_TABLES)),
    "endpoint_counts": "SELECT source_endpoint, count(*) AS record_count FROM raw_movies GROUP BY source_endpoint",
    "dup_profile": """SELECT movie_id, count(*) AS appearances FROM raw_movies WHERE movie_id IS NOT NULL
        GROUP BY movie_id HAVING count(*) > 1""",
    "dedup_profile": """
        SELECT 'before' AS step, count(*) AS row_count, count(DISTINCT movie_id) AS unique_movies FROM staged
        UNION ALL SELECT 'after', count(*), count(DISTINCT movie_id) FROM movies""",
    "quarantine": """
        SELECT 'details' AS source_endpoint, 'unreadable' AS reason, TIMESTAMP '2024-01-05 00:00:00' AS ingested_at,
          html AS payload FROM pages
        UNION ALL SELECT 'trending', 'no movie id', TIMESTAMP '2024-01-06 00:00:00', props FROM events""",
    "dq_issue_log": " UNION ALL ".join([
        *(f"SELECT '{name}' AS issue, count(*) AS occurrences FROM parsed WHERE {condition}"
          for name, condition in _ISSUES.items()),
        "SELECT 'unreadable_payload', count(*) FROM pages",
        "SELECT 'missing_id', count(*) FROM events",
        "SELECT 'repeated_movie', count(*) - count(DISTINCT movie_id) FROM parsed",
    ]),
    "silver_parsed": """SELECT movie_id, source_endpoint, ingested_at, raw_title AS title,
        raw_title AS original_title, raw_language AS original_language, raw_date AS release_date,
        CAST(raw_budget AS VARCHAR) AS budget, CAST(raw_revenue AS VARCHAR) AS revenue,
        CAST(raw_runtime AS VARCHAR) AS runtime, CAST(vote_count AS VARCHAR) AS vote_count, popularity,
        CAST(is_adult AS VARCHAR) AS is_adult, overview, CAST(genre_entries AS INTEGER) AS genre_entries FROM parsed""",
    "clean_sentinels": "SELECT movie_id, source_endpoint, budget, revenue, runtime FROM staged",
    "clean_types": """SELECT movie_id, source_endpoint, vote_count, popularity, is_adult,
        coalesce(is_adult, false) AS is_adult_or_false FROM staged""",
    "clean_dates": "SELECT movie_id, source_endpoint, release_date, release_year FROM staged",
    "clean_ratings": "SELECT movie_id, source_endpoint, vote_average, vote_count FROM staged",
    "clean_text": """SELECT movie_id, source_endpoint, title, original_title, original_language,
        overview_is_empty FROM staged""",
    "completeness_score": "SELECT movie_id, source_endpoint, completeness_score FROM staged",
    "silver_movies": "SELECT * FROM movies",
    "silver_roundtrip": "SELECT * FROM movies",
    "silver_movies_sqlpolicy":
        "SELECT * EXCLUDE (source_endpoint, priority, completeness_score) FROM movies_by_recency",
    "silver_movies_sql":
        "SELECT * EXCLUDE (source_endpoint, priority, completeness_score) FROM movies_by_recency",
    "silver_genres": "SELECT * FROM genres",
    "silver_movie_genres": "SELECT * FROM movie_genres",
    "silver_movie_genres_sql": "SELECT * FROM movie_genres",
    "silver_movie_companies": "SELECT * FROM movie_companies",
    "silver_movie_companies_sql": "SELECT * FROM movie_companies",
    "silver_movie_languages": "SELECT * FROM movie_languages",
    "silver_movie_cast": "SELECT * FROM movie_cast",
    "silver_movie_cast_sql": "SELECT * FROM movie_cast",
    "reconcile_counts": _union(
        "SELECT '{t}' AS table_name, count(*) AS rows_a, count(*) AS rows_b, true AS matches FROM {t}", _SILVER),
    "reconcile_rows": _union(
        "SELECT '{t}' AS table_name, CAST(0 AS BIGINT) AS only_a, CAST(0 AS BIGINT) AS only_b", _SILVER),
    "reconcile_fields": " UNION ALL ".join(
        f"SELECT '{f}' AS field_name, count(*) FILTER (p.{f} IS NOT DISTINCT FROM r.{f}) AS matching,"
        f" count(*) FILTER (p.{f} IS DISTINCT FROM r.{f}) AS differing,"
        " CAST(0 AS BIGINT) AS missing_in_a, CAST(0 AS BIGINT) AS missing_in_b"
        " FROM movies_by_priority p JOIN movies_by_recency r USING (movie_id)"
        for f in _FIELDS),
    "rebuild_check": _union(
        "SELECT '{t}' AS table_name, CAST(0 AS BIGINT) AS only_a, CAST(0 AS BIGINT) AS only_b,"
        " count(*) AS row_count FROM {t}", _TABLES),
    "dim_date": "SELECT * FROM dim_date",
    "dim_language": "SELECT * FROM dim_language",
    "dim_genre": "SELECT * FROM dim_genre",
    "dim_movie": "SELECT * FROM dim_movie",
    "fact_movie": "SELECT * FROM fact_movie",
    "bridge_movie_genre": "SELECT * FROM bridge_movie_genre",
    "kpi_by_genre_year": """SELECT calendar_year, genre_name, count(*) AS movie_count,
        round(avg(vote_average), 6) AS average_rating, CAST(sum(revenue) AS BIGINT) AS total_revenue
        FROM fact_movie JOIN dim_date USING (date_key) JOIN bridge_movie_genre USING (movie_key)
          JOIN dim_genre USING (genre_key) GROUP BY calendar_year, genre_name""",
    "kpi_studio_performance": "SELECT * FROM studios",
    "dq_report": _dq(),
    "outliers": """
        , fences AS (
          SELECT quantile_cont(runtime, 0.25) AS q1, quantile_cont(runtime, 0.75) AS q3 FROM movies
        ), flagged AS (
          SELECT movie_id, runtime, budget, revenue,
            coalesce(runtime < q1 - 1.5 * (q3 - q1) OR runtime > q3 + 1.5 * (q3 - q1), false) AS odd_runtime,
            coalesce(revenue < budget, false) AS below_budget FROM movies, fences)
        SELECT * FROM flagged WHERE odd_runtime OR below_budget""",
    "overview_kpis":
        f"SELECT {_HEADLINE}, (SELECT max(ingested_at) FROM raw_movies) AS data_as_of FROM fact_movie",
    "overview_sliced": f"""SELECT {_HEADLINE} FROM fact_movie
        WHERE date_key // 10000 BETWEEN 1996 AND 1999 AND movie_key IN (
          SELECT movie_key FROM bridge_movie_genre JOIN dim_genre USING (genre_key)
          WHERE genre_name IN ('ECONOMY', 'PROMO'))""",
    "drill_through": """SELECT movie_id, title, budget, revenue, roi, f.vote_average
        FROM fact_movie f JOIN (SELECT movie_key, movie_id, title FROM dim_movie) USING (movie_key)
          JOIN dim_date USING (date_key)
        WHERE calendar_year = 1998 AND movie_key IN (
          SELECT movie_key FROM bridge_movie_genre JOIN dim_genre USING (genre_key) WHERE genre_name = 'MEDIUM')""",
    "trend_by_year": f"""SELECT calendar_year, {_measures('revenue', 'budget', 'count', 'rating', 'roi')}
        FROM fact_movie JOIN dim_date USING (date_key) GROUP BY calendar_year""",
    "revenue_yoy": """
        , yearly AS (SELECT calendar_year, CAST(sum(revenue) AS BIGINT) AS total_revenue
          FROM fact_movie JOIN dim_date USING (date_key) GROUP BY calendar_year)
        SELECT a.calendar_year, a.total_revenue, b.total_revenue AS previous_revenue,
          round(CAST(a.total_revenue - b.total_revenue AS DOUBLE) / nullif(b.total_revenue, 0), 6) AS revenue_yoy
        FROM yearly a LEFT JOIN yearly b ON b.calendar_year = a.calendar_year - 1""",
    "genre_performance": f"""SELECT genre_name,
        {_measures('revenue', 'budget', 'profit', 'roi', 'rating', 'count')} FROM {_WITH_GENRE} GROUP BY genre_name""",
    "genre_hit_rate": f"""SELECT genre_name, {_measures('hits', 'count')} FROM {_WITH_GENRE}
        WHERE budget IS NOT NULL AND revenue IS NOT NULL GROUP BY genre_name""",
    "budget_revenue_corr": """SELECT round(corr(budget, revenue), 6) AS correlation,
        round(regr_slope(revenue, budget), 6) AS slope, round(regr_r2(revenue, budget), 6) AS r2,
        CAST(regr_count(revenue, budget) AS BIGINT) AS movies_with_both FROM fact_movie""",
    "budget_bands": f"""SELECT {_BAND} AS budget_band, {_measures('count', 'revenue', 'roi', 'rating', 'hits')}
        FROM fact_movie GROUP BY 1""",
    "top_roi": """SELECT movie_id, title, budget, revenue, roi FROM fact_movie
        JOIN (SELECT movie_key, movie_id, title FROM dim_movie) USING (movie_key)
        WHERE roi IS NOT NULL ORDER BY roi DESC, movie_key LIMIT 10""",
    "bottom_roi": """SELECT movie_id, title, budget, revenue, roi FROM fact_movie
        JOIN (SELECT movie_key, movie_id, title FROM dim_movie) USING (movie_key)
        WHERE roi IS NOT NULL ORDER BY roi, movie_key LIMIT 10""",
    "top_rated": """SELECT movie_id, title, vote_average, vote_count FROM fact_movie
        JOIN (SELECT movie_key, movie_id, title FROM dim_movie) USING (movie_key)
        WHERE vote_count >= 10 AND vote_average IS NOT NULL ORDER BY vote_average DESC, movie_key LIMIT 10""",
    "top_studios": "SELECT * FROM studios ORDER BY total_revenue DESC NULLS LAST, company_name LIMIT 10",
    "top_movies_per_genre": """
        , ranked AS (SELECT genre_key, movie_key, revenue,
            CAST(row_number() OVER (PARTITION BY genre_key ORDER BY revenue DESC, movie_key) AS INTEGER) AS place
          FROM bridge_movie_genre JOIN fact_movie USING (movie_key) WHERE revenue IS NOT NULL)
        SELECT genre_name, place, movie_id, title, revenue FROM ranked JOIN dim_genre USING (genre_key)
          JOIN dim_movie USING (movie_key) WHERE place <= 3""",
    "movie_explorer": """SELECT movie_id, title, release_year, genres, budget, revenue, roi, vote_average
        FROM fact_movie JOIN (SELECT movie_key, movie_id, title, release_year FROM dim_movie) USING (movie_key)
        LEFT JOIN (SELECT movie_key, string_agg(genre_name, ', ' ORDER BY genre_name) AS genres
          FROM bridge_movie_genre JOIN dim_genre USING (genre_key) GROUP BY movie_key) USING (movie_key)""",
    "performer_profile": _performers(),
}


def statements() -> dict[str, str]:
    found = {name: _CTES + statement for name, statement in _STATEMENTS.items()}
    # Landed in one batch, of two spellings of a genre the one that sorts last is taken.
    chain = found["kpi_by_genre_year"]
    return found | {"chain_kpi_by_genre_year": f"SELECT * REPLACE (lower(genre_name) AS genre_name) FROM ({chain})"}
