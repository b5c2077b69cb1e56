"""Catalogue documents derived from the given tables (see FIXTURES.md).

One order plays one movie. The list endpoints carry each movie once; ``details`` and ``credits``
carry one document per line item, as if fetched again at every ship date, so a movie has as many
copies as it has line items and no group is ever collected into one value.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import BRONZE, conform

# Genre ids of the part types.
PAGE = 64
GENRE_IDS = {"ECONOMY": 1, "LARGE": 2, "MEDIUM": 3, "PROMO": 4, "SMALL": 5, "STANDARD": 6}

_LIST_FIELDS = [
    "id", "title", "title AS original_title", "original_language", "release_date",
    "vote_average", "vote_count", "popularity", "adult", "overview",
]


def _read(spark: SparkSession, tables: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{tables}/{name}.parquet")


# What the documents of a movie need of its order. Joins move these columns; texts are made of them afterwards.
_MOVIE = (
    "o_orderkey AS id",
    "concat('  ', o_orderpriority, ' #', o_orderkey, ' ') AS title",
    "CASE WHEN o_orderkey % 41 <> 0 THEN concat(' ', lower(home_nation), ' ') END AS original_language",
    "CASE WHEN o_orderkey % 11 = 0 THEN '' WHEN o_orderkey % 23 = 0 THEN 'not-a-date'"
    " WHEN o_orderkey % 31 = 0 THEN NULL ELSE date_format(o_orderdate, 'yyyy-MM-dd') END AS release_date",
    "CASE WHEN o_orderkey % 5 = 0 THEN 0 ELSE CAST(floor(o_totalprice) AS BIGINT) END AS budget",
    "CAST(floor(o_totalprice * (o_orderkey % 13) / 4.0D) AS BIGINT) AS revenue",
    "CAST(o_orderkey % 200 + CASE WHEN o_orderkey % 53 = 0 THEN 1000 ELSE 0 END AS STRING) AS runtime",
    "CAST(o_orderkey % 101 AS DOUBLE) / 10 AS vote_average",
    "CAST(o_orderkey % 17 AS INT) AS vote_count",
    "o_totalprice / 1000 AS popularity",
    "CASE WHEN o_orderkey % 89 <> 0 THEN o_orderkey % 97 = 0 END AS adult",
    "CASE WHEN o_orderkey % 19 = 0 THEN '' WHEN o_orderkey % 29 = 0 THEN '   '"
    " ELSE concat('about ', o_orderkey) END AS overview",
    "home_nation AS home_language",
    "o_orderpriority = '1-URGENT' OR o_totalprice < 100000 AS is_popular",
    "o_orderpriority = '2-HIGH' OR o_totalprice > 400000 AS is_trending",
    "o_orderstatus = 'P' AS is_relisted",
    "year(o_orderdate) AS listed_year",
)
_HAS_DETAILS = "NOT (o_orderstatus = 'P' AND o_orderpriority = '5-LOW')"


def _orders(spark: SparkSession, tables: str) -> DataFrame:
    """Orders with the nation of their customer."""
    orders, customer, nation = (_read(spark, tables, t) for t in ("orders", "customer", "nation"))
    return (
        orders
        .join(customer, orders.o_custkey == customer.c_custkey, "left")
        .join(nation, customer.c_nationkey == nation.n_nationkey, "left")
        .selectExpr(
            "o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice", "o_orderdate", "n_name AS home_nation"
        )
    )


def movies(spark: SparkSession, tables: str) -> DataFrame:
    """One row per movie, dirty on purpose."""
    return _orders(spark, tables).selectExpr(*_MOVIE, f"{_HAS_DETAILS} AS has_details")


def _lines(spark: SparkSession, tables: str) -> DataFrame:
    """Line items with their part's type. Of the other columns only what documents tell is moved."""
    lineitem, part = (_read(spark, tables, t) for t in ("lineitem", "part"))
    told = lineitem.selectExpr(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "CAST(l_shipdate AS TIMESTAMP_NTZ) AS fetched_at",
        "CAST(floor(l_quantity / 5) AS INT) AS billing", "l_tax > 0 AS is_taxed", "l_returnflag <> 'N' AS is_decided",
        "l_returnflag = 'R' AS is_returned", "l_linestatus = 'O' AS is_open",
    )
    return told.join(part, told.l_partkey == part.p_partkey, "left").select(*told.columns, "p_type")


def _supplied(spark: SparkSession, tables: str, lines: DataFrame) -> DataFrame:
    """Line items with the name and nation of their supplier; joined last, so that no exchange moves the names."""
    supplier, nation = (_read(spark, tables, t) for t in ("supplier", "nation"))
    return (
        lines
        .join(supplier, lines.l_suppkey == supplier.s_suppkey, "left")
        .join(nation, supplier.s_nationkey == nation.n_nationkey, "left")
        .withColumn("s_nation", F.col("n_name"))
    )


def _genre_id(column: str) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in GENRE_IDS.items()) + " END"


def _payload(*fields: str) -> str:
    """JSON text of a struct; NULL fields become absent keys."""
    return f"to_json(named_struct({', '.join(_named(f) for f in fields)}))"


def _named(field: str) -> str:
    value, _, name = field.rpartition(" AS ")
    return f"'{name}', {value}" if value else f"'{field}', {field}"


_FIRST_GENRE = f"named_struct('id', {_genre_id('p_type')}, 'name', p_type)"
_GENRES = (
    f"array({_FIRST_GENRE}, named_struct('id', CASE WHEN l_linenumber = 7 THEN 99 ELSE l_linenumber END,"
    f" 'name', concat('slot ', l_linenumber)), CASE WHEN is_taxed THEN {_FIRST_GENRE} END) AS genres"
)
_COMPANIES = (
    "array(named_struct('name', s_name), named_struct('name', concat(s_nation, ' Pictures')),"
    " named_struct('name', s_name)) AS production_companies"
)
_LANGUAGES = "array(named_struct('name', s_nation), named_struct('name', home_language)) AS spoken_languages"
_CAST = (
    "array(named_struct('name', concat('Person ', l_partkey), 'character', concat('Role ', l_suppkey),"
    " 'order', CASE WHEN is_taxed THEN l_linenumber - 1 END),"
    " named_struct('name', concat('Extra ', l_suppkey), 'character', CAST(NULL AS STRING),"
    " 'order', billing)) AS cast"
)
_CREW = (
    "array(named_struct('name', concat('Person ', l_suppkey),"
    " 'job', CASE WHEN is_returned THEN 'Director' ELSE 'Producer' END),"
    " named_struct('name', concat('Person ', l_partkey),"
    " 'job', CASE WHEN is_open THEN 'Writer' ELSE 'director' END)) AS crew"
)
_NOTHING = "from_json('[]', 'ARRAY<STRING>')"


def _per_movie_documents(spark: SparkSession, tables: str) -> DataFrame:
    """``details`` and ``credits`` documents, both from one pass over the joined line items."""
    orders, lines = _orders(spark, tables).where(_HAS_DETAILS), _lines(spark, tables)
    # Both joins below meet the same orders, whose exchange is used twice. An order without a key has no line items.
    detailed = orders.where("o_orderkey IS NOT NULL")
    # An inner join, so a movie with very many line items can be split by the skew handling; movies
    # without any are those that find none of the distinct keys.
    both = detailed.join(lines, detailed.o_orderkey == lines.l_orderkey)
    fetched = _supplied(spark, tables, both).selectExpr("*", *_MOVIE).selectExpr(
        "id",
        "fetched_at",
        _payload(*_LIST_FIELDS, "budget", "revenue", "CASE WHEN is_decided THEN runtime END AS runtime",
                 _GENRES, _COMPANIES, _LANGUAGES) + " AS details",
        _payload("id", _CAST, _CREW) + " AS credits",
    )
    keys = _read(spark, tables, "lineitem").select("l_orderkey").distinct()
    lone = detailed.join(keys, detailed.o_orderkey == keys.l_orderkey, "left").where("l_orderkey IS NULL").drop("l_orderkey")
    bare = lone.unionByName(orders.where("o_orderkey IS NULL")).selectExpr(*_MOVIE).selectExpr(
        "id",
        "TIMESTAMP_NTZ '2024-01-01 00:00:00' AS fetched_at",
        _payload(*_LIST_FIELDS, "budget", "revenue", "runtime", f"{_NOTHING} AS genres",
                 f"{_NOTHING} AS production_companies", f"{_NOTHING} AS spoken_languages") + " AS details",
        _payload("id", f"{_NOTHING} AS cast", f"{_NOTHING} AS crew") + " AS credits",
    )
    return fetched.unionByName(bare).selectExpr(
        "id AS movie_id",
        "fetched_at AS ingested_at",
        "stack(2, 'details', details, 'credits', credits) AS (source_endpoint, payload)",
    )


def _listed(spark: SparkSession, tables: str) -> DataFrame:
    """One row per movie and list endpoint it appears on."""
    return movies(spark, tables).selectExpr(
        "id AS movie_id",
        _payload(*_LIST_FIELDS) + " AS payload",
        "is_relisted",
        "listed_year",
        "explode(filter(array("
        " named_struct('endpoint', 'discover', 'at', TIMESTAMP_NTZ '2024-01-02 00:00:00', 'shown', true),"
        " named_struct('endpoint', 'popular', 'at', TIMESTAMP_NTZ '2024-01-03 00:00:00', 'shown', is_popular),"
        " named_struct('endpoint', 'trending', 'at', TIMESTAMP_NTZ '2024-01-04 00:00:00', 'shown', is_trending)"
        "), e -> e.shown)) AS e",
    )


def _genre_lookups(spark: SparkSession, tables: str) -> DataFrame:
    """Lookup documents: for every part an older one with the genre in lower case, and a current one."""
    return (
        _read(spark, tables, "part")
        .selectExpr(
            "p_type",
            "explode(array(named_struct('at', TIMESTAMP_NTZ '2023-01-01 00:00:00', 'name', lower(p_type)),"
            " named_struct('at', TIMESTAMP_NTZ '2024-01-01 00:00:00', 'name', p_type))) AS v",
        )
        .selectExpr(
            "CAST(NULL AS BIGINT) AS movie_id",
            "v.at AS ingested_at",
            "'genres' AS source_endpoint",
            f"to_json(named_struct('genres', array(named_struct('id', {_genre_id('p_type')}, 'name', v.name)))) AS payload",
        )
    )


def _strays(spark: SparkSession, tables: str) -> DataFrame:
    """Answers that are no movie: error pages in HTML, and JSON without an id."""
    pages = _read(spark, tables, "pages").selectExpr(
        "CAST(NULL AS BIGINT) AS movie_id", "TIMESTAMP_NTZ '2024-01-05 00:00:00' AS ingested_at",
        "'details' AS source_endpoint", "html AS payload",
    )
    events = _read(spark, tables, "events").selectExpr(
        "CAST(NULL AS BIGINT) AS movie_id", "TIMESTAMP_NTZ '2024-01-06 00:00:00' AS ingested_at",
        "'trending' AS source_endpoint", "props AS payload",
    )
    return pages.unionByName(events)


def bronze(spark: SparkSession, tables: str) -> DataFrame:
    """All bronze rows, as the loader would have left them."""
    listed = _listed(spark, tables).selectExpr(
        "movie_id", "e.at AS ingested_at", "e.endpoint AS source_endpoint", "payload"
    )
    rows = (
        listed.unionByName(_per_movie_documents(spark, tables))
        .unionByName(_genre_lookups(spark, tables))
        .unionByName(_strays(spark, tables))
    )
    return conform(rows, BRONZE)


def responses(spark: SparkSession, tables: str) -> DataFrame:
    """Raw API responses ``source_endpoint, request, value`` before landing.

    List endpoints answer with an envelope of results. Discover is asked for year by year and numbers its pages
    anew each time; a page has the movies of one range of ``PAGE`` ids, and movies listed again also stand on
    the next year's page. Popular pages name their movie twice; some trending answers have no results at all, and
    some answers to details are HTML.
    """
    lists = _listed(spark, tables)
    years = "explode(CASE WHEN is_relisted THEN array(listed_year, listed_year + 1) ELSE array(listed_year) END) AS year"
    discover = (
        lists.where("e.endpoint = 'discover'").selectExpr("movie_id", "payload", f"movie_id div {PAGE} AS page", years)
        .groupBy("year", "page")
        # At most PAGE results, by the ids' range.
        .agg(F.array_join(F.array_sort(F.collect_list(F.struct("movie_id", "payload")))["payload"], ",").alias("results"))
        .selectExpr(
            "'discover' AS source_endpoint", "CAST(year AS STRING) AS request",
            "concat('{\"page\":', page, ',\"results\":[', results, ']}') AS value",
        )
    )
    others = lists.where("e.endpoint <> 'discover'").selectExpr(
        "e.endpoint AS source_endpoint", "'all' AS request",
        "concat('{\"page\":1,\"results\":[', payload, CASE WHEN e.endpoint = 'popular' THEN concat(',', payload) ELSE '' END, ']}')"
        " AS value",
    )
    single = _per_movie_documents(spark, tables).selectExpr("source_endpoint", "'all' AS request", "payload AS value")
    lookups = _genre_lookups(spark, tables).selectExpr("source_endpoint", "'all' AS request", "payload AS value")
    empty = _read(spark, tables, "events").selectExpr("'trending' AS source_endpoint", "'all' AS request", "props AS value")
    strays = _read(spark, tables, "pages").selectExpr(
        "'details' AS source_endpoint", "'errors' AS request", r"translate(html, '\r\n', '  ') AS value"
    )
    return reduce(DataFrame.unionByName, [discover, others, single, lookups, empty, strays])


def genre_lists(spark: SparkSession, tables: str) -> DataFrame:
    """A ``genres`` response per brand: the genres of its parts, of which there are few."""
    return (
        _read(spark, tables, "part").selectExpr("p_brand AS brand", f"{_genre_id('p_type')} AS id", "p_type AS name").distinct()
        .groupBy("brand").agg(F.array_sort(F.collect_list(F.struct("id", "name"))).alias("genres"))
    )
