"""Silver a second time, as SQL text with other JSON functions, to reconcile against ``silver``.

Scalars come from ``json_tuple``, arrays from VARIANT; nothing is shared with the DataFrame plans but
the contract. The VARIANT is made by a lateral view, so that conditions on it do not parse it again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from ..functions.clean import WHITE_SPACE
from ..schemas import LAST_TOP_BILLED_ORDER

_ORDERS = {
    "recency": "completeness_score DESC, ingested_at DESC, payload_hash",
    "priority": """completeness_score DESC,
        CASE source_endpoint WHEN 'details' THEN 4 WHEN 'discover' THEN 3
                             WHEN 'popular' THEN 2 WHEN 'trending' THEN 1 ELSE 0 END DESC,
        ingested_at DESC, payload_hash""",
}

_MOVIES = """
WITH scalars AS (
  SELECT j.*, source_endpoint, ingested_at, xxhash64(payload) AS payload_hash
  FROM {bronze}
  LATERAL VIEW json_tuple(payload, 'id', 'title', 'original_title', 'original_language', 'release_date',
      'budget', 'revenue', 'runtime', 'vote_average', 'vote_count', 'popularity', 'adult', 'overview',
      'genres', 'production_companies', 'spoken_languages') j
    AS id, title, original_title, original_language, release_date,
      budget, revenue, runtime, vote_average, vote_count, popularity, adult, overview,
      genres, production_companies, spoken_languages
  WHERE source_endpoint IN ('details', 'discover', 'popular', 'trending')
), typed AS (
  SELECT
    try_cast(id AS BIGINT) AS movie_id,
    trim(BOTH :white_space FROM title) AS title,
    trim(BOTH :white_space FROM original_title) AS original_title,
    upper(trim(BOTH :white_space FROM original_language)) AS original_language,
    try_cast(nullif(release_date, '') AS DATE) AS release_date,
    nullif(try_cast(budget AS BIGINT), 0) AS budget,
    nullif(try_cast(revenue AS BIGINT), 0) AS revenue,
    nullif(try_cast(runtime AS INT), 0) AS runtime,
    try_cast(vote_average AS DOUBLE) AS raw_average,
    try_cast(vote_count AS INT) AS vote_count,
    try_cast(popularity AS DOUBLE) AS popularity,
    try_cast(adult AS BOOLEAN) AS is_adult,
    nullif(trim(BOTH :white_space FROM overview), '') IS NULL AS overview_is_empty,
    CASE WHEN genres LIKE '[%' THEN 1 ELSE 0 END + CASE WHEN production_companies LIKE '[%' THEN 1 ELSE 0 END
      + CASE WHEN spoken_languages LIKE '[%' THEN 1 ELSE 0 END AS arrays_present,
    source_endpoint, ingested_at, payload_hash
  FROM scalars
), scored AS (
  SELECT *, CAST(budget IS NOT NULL AS INT) + CAST(revenue IS NOT NULL AS INT)
    + CAST(runtime IS NOT NULL AS INT) + arrays_present AS completeness_score
  FROM typed WHERE movie_id IS NOT NULL
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY movie_id ORDER BY {{order}}) AS place FROM scored
)
SELECT movie_id, title, original_title, original_language, release_date, year(release_date) AS release_year,
  budget, revenue, runtime, CASE WHEN vote_count = 0 THEN NULL ELSE raw_average END AS vote_average,
  vote_count, popularity, is_adult, overview_is_empty, ingested_at
FROM ranked WHERE place = 1
"""

_ITEMS = """
SELECT DISTINCT try_cast(try_variant_get(d.doc, '$.id', 'string') AS BIGINT) AS movie_id, {value} AS {name}
FROM (
    SELECT doc FROM {{bronze}} LATERAL VIEW explode(array(try_parse_json(payload))) parsed AS doc
    WHERE source_endpoint = 'details'
  ) d,
  LATERAL variant_explode(try_variant_get(d.doc, '$.{field}', 'variant')) item
WHERE try_variant_get(d.doc, '$.id', 'string') IS NOT NULL AND NOT is_variant_null(item.value)
"""

_ALL_ITEMS = """
SELECT try_cast(try_variant_get(d.doc, '$.id', 'string') AS BIGINT) AS movie_id, field,
  try_variant_get(item.value, '$.id', 'string') AS item_id, try_variant_get(item.value, '$.name', 'string') AS item_name
FROM (
    SELECT doc, field, items FROM {bronze}
    LATERAL VIEW explode(array(try_parse_json(payload))) parsed AS doc
    LATERAL VIEW stack(3, 'genres', try_variant_get(doc, '$.genres', 'variant'),
      'production_companies', try_variant_get(doc, '$.production_companies', 'variant'),
      'spoken_languages', try_variant_get(doc, '$.spoken_languages', 'variant')) listed AS field, items
    WHERE source_endpoint = 'details'
  ) d,
  LATERAL variant_explode(d.items) item
WHERE try_variant_get(d.doc, '$.id', 'string') IS NOT NULL AND NOT is_variant_null(item.value)
"""

_BRIDGE = "SELECT DISTINCT movie_id, {value} AS {name} FROM {{items}} WHERE field = '{field}'"

_GENRES = """
SELECT genre_id, max_by(genre_name, struct(ingested_at, genre_name)) AS genre_name
FROM (
  SELECT try_cast(try_variant_get(item.value, '$.id', 'string') AS BIGINT) AS genre_id,
    try_variant_get(item.value, '$.name', 'string') AS genre_name, d.ingested_at
  FROM (
      SELECT doc, ingested_at FROM {bronze} LATERAL VIEW explode(array(try_parse_json(payload))) parsed AS doc
      WHERE source_endpoint = 'genres'
    ) d,
    LATERAL variant_explode(try_variant_get(d.doc, '$.genres', 'variant')) item
)
WHERE genre_id IS NOT NULL GROUP BY genre_id
"""

_CAST = """
WITH groups AS (
  SELECT doc, role_type, people FROM {bronze}
  LATERAL VIEW explode(array(try_parse_json(payload))) parsed AS doc
  LATERAL VIEW stack(2, 'Cast', try_variant_get(doc, '$.cast', 'variant'),
    'Director', try_variant_get(doc, '$.crew', 'variant')) listed AS role_type, people
  WHERE source_endpoint = 'credits'
), people AS (
  SELECT try_cast(try_variant_get(g.doc, '$.id', 'string') AS BIGINT) AS movie_id, role_type,
    try_variant_get(p.value, '$.name', 'string') AS person_name,
    try_variant_get(p.value, '$.job', 'string') AS job,
    CASE role_type WHEN 'Cast' THEN try_variant_get(p.value, '$.character', 'string') END AS character_name,
    CASE role_type WHEN 'Cast' THEN try_cast(try_variant_get(p.value, '$.order', 'string') AS INT) END AS cast_order
  FROM groups g, LATERAL variant_explode(g.people) p
)
SELECT DISTINCT movie_id, person_name, role_type, character_name, cast_order FROM people
WHERE movie_id IS NOT NULL AND CASE role_type WHEN 'Cast' THEN cast_order <= :last_order ELSE job = 'Director' END
"""


def all_tables(bronze: DataFrame, store: Callable[[DataFrame], DataFrame]) -> dict[str, DataFrame]:
    """Every table of this path; the three bridges share one written pass over the documents."""
    items = store(_run(_ALL_ITEMS, bronze))

    def bridge(value: str, name: str, field: str) -> DataFrame:
        return bronze.sparkSession.sql(_BRIDGE.format(value=value, name=name, field=field), items=items)

    return {
        "movies": movies(bronze),
        "genres": genres(bronze),
        "movie_genres": bridge("try_cast(item_id AS BIGINT)", "genre_id", "genres"),
        "movie_companies": bridge("item_name", "company_name", "production_companies"),
        "movie_languages": bridge("item_name", "language_name", "spoken_languages"),
        "movie_cast": movie_cast(bronze),
    }


def _run(text: str, bronze: DataFrame, **args) -> DataFrame:
    return bronze.sparkSession.sql(text, args=args, bronze=bronze)


def movies(bronze: DataFrame, policy: str = "recency") -> DataFrame:
    return _run(_MOVIES.replace("{{order}}", _ORDERS[policy]), bronze, white_space=WHITE_SPACE)


def movie_genres(bronze: DataFrame) -> DataFrame:
    value = "try_cast(try_variant_get(item.value, '$.id', 'string') AS BIGINT)"
    return _run(_ITEMS.format(value=value, name="genre_id", field="genres"), bronze)


def movie_companies(bronze: DataFrame) -> DataFrame:
    value = "try_variant_get(item.value, '$.name', 'string')"
    return _run(_ITEMS.format(value=value, name="company_name", field="production_companies"), bronze)


def movie_languages(bronze: DataFrame) -> DataFrame:
    value = "try_variant_get(item.value, '$.name', 'string')"
    return _run(_ITEMS.format(value=value, name="language_name", field="spoken_languages"), bronze)


def genres(bronze: DataFrame) -> DataFrame:
    return _run(_GENRES, bronze)


def movie_cast(bronze: DataFrame) -> DataFrame:
    return _run(_CAST, bronze, last_order=LAST_TOP_BILLED_ORDER)
