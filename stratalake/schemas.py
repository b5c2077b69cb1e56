"""Table schemas and the fixed domain values shared by every layer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Endpoint names, the record-source ranking, and the billing cut-off.
LIST_ENDPOINTS = ("discover", "popular", "trending")
MOVIE_ENDPOINTS = ("details", "discover", "popular", "trending")
ENDPOINT_PRIORITY = {"details": 4, "discover": 3, "popular": 2, "trending": 1}
LAST_TOP_BILLED_ORDER = 4
DIRECTOR_JOB = "Director"


_TYPES = {
    "BIGINT": T.LongType(),
    "INT": T.IntegerType(),
    "DOUBLE": T.DoubleType(),
    "BOOLEAN": T.BooleanType(),
    "STRING": T.StringType(),
    "DATE": T.DateType(),
    "TIMESTAMP_NTZ": T.TimestampNTZType(),
}


def _struct(spec: str) -> T.StructType:
    """Read ``name TYPE, ...`` without a session (``StructType.fromDDL`` needs one)."""
    fields = (field.split() for field in spec.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


# Ids and surrogate keys are BIGINT: INT would overflow at the row counts this is built for.
BRONZE = _struct("movie_id BIGINT, ingested_at TIMESTAMP_NTZ, payload STRING, source_endpoint STRING")

SILVER = {
    "movies": _struct(
        "movie_id BIGINT, title STRING, original_title STRING, original_language STRING,"
        " release_date DATE, release_year INT, budget BIGINT, revenue BIGINT, runtime INT,"
        " vote_average DOUBLE, vote_count INT, popularity DOUBLE, is_adult BOOLEAN,"
        " overview_is_empty BOOLEAN, ingested_at TIMESTAMP_NTZ"
    ),
    "genres": _struct("genre_id BIGINT, genre_name STRING"),
    "movie_genres": _struct("movie_id BIGINT, genre_id BIGINT"),
    "movie_companies": _struct("movie_id BIGINT, company_name STRING"),
    "movie_languages": _struct("movie_id BIGINT, language_name STRING"),
    "movie_cast": _struct(
        "movie_id BIGINT, person_name STRING, role_type STRING, character_name STRING, cast_order INT"
    ),
}

GOLD = {
    "dim_date": _struct(
        "date_key INT, full_date DATE, calendar_year INT, calendar_quarter INT,"
        " calendar_month INT, month_name STRING"
    ),
    "dim_language": _struct("language_key BIGINT, language_code STRING"),
    "dim_genre": _struct("genre_key BIGINT, genre_id BIGINT, genre_name STRING"),
    "dim_movie": _struct(
        "movie_key BIGINT, movie_id BIGINT, title STRING, original_title STRING,"
        " original_language STRING, release_date DATE, release_year INT, runtime INT,"
        " is_adult BOOLEAN, overview_is_empty BOOLEAN"
    ),
    "fact_movie": _struct(
        "movie_key BIGINT, date_key INT, language_key BIGINT, budget BIGINT, revenue BIGINT,"
        " profit BIGINT, roi DOUBLE, runtime INT, vote_average DOUBLE, vote_count INT, popularity DOUBLE"
    ),
    "bridge_movie_genre": _struct("movie_key BIGINT, genre_key BIGINT"),
}

# Declared text lengths (both cleaning paths must fit, so the smaller of the two counts).
TEXT_LIMITS = {
    "movies": {"title": 500, "original_title": 500, "original_language": 10},
    "genres": {"genre_name": 100},
    "movie_companies": {"company_name": 300},
    "movie_cast": {"person_name": 200, "role_type": 20, "character_name": 255},
}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the schema's columns in order; a missing column or another type is an error."""
    have = {f.name: f.dataType for f in df.schema.fields}
    wrong = [
        f"{f.name}: expected {f.dataType.simpleString()}, got "
        f"{have[f.name].simpleString() if f.name in have else 'nothing'}"
        for f in schema.fields
        if have.get(f.name) != f.dataType
    ]
    if wrong:
        raise ValueError("schema mismatch: " + "; ".join(wrong))
    return df.select(*[F.col(name) for name in schema.fieldNames()])
