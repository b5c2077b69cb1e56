from __future__ import annotations

from datetime import datetime

import pytest
from conftest import rows_of

from stratalake.plans import silver, silver_sql

BRIDGES = {
    "movie_genres": ("genres", "id"),
    "movie_companies": ("production_companies", "name"),
    "movie_languages": ("spoken_languages", "name"),
}


def _both(bronze, name):
    frames = rows_of(getattr(silver, name)(silver.staged(bronze)))
    sql = rows_of(getattr(silver_sql, name)(bronze))
    assert frames == sql
    return frames


def test_genre_ids_are_distinct_and_read_from_text(bronze):
    rows = bronze(
        ("details", {"id": 1, "genres": [{"id": 1, "name": "a"}, {"id": "2"}, {"id": 1}]}),
        ("details", {"id": 1, "genres": [{"id": 2}, {"id": 3}]}),
        ("details", {"id": 2, "genres": [{"id": 1}]}),
    )
    assert _both(rows, "movie_genres") == [(1, 1), (1, 2), (1, 3), (2, 1)]


@pytest.mark.parametrize("name", BRIDGES)
@pytest.mark.parametrize("value", [[], None, "oops", 5])
def test_no_items_no_rows(bronze, name, value):
    field, key = BRIDGES[name]
    assert _both(bronze(("details", {"id": 1, field: value}), ("details", {"id": 2})), name) == []


@pytest.mark.parametrize("name", BRIDGES)
def test_null_elements_are_dropped_and_odd_ones_cost_only_themselves(bronze, name):
    field, key = BRIDGES[name]
    item = 7 if key == "id" else "seven"
    got = _both(bronze(("details", {"id": 1, field: [None, {key: item}, {key: None}]})), name)
    assert got == [(1, item), (1, None)] or got == [(1, None), (1, item)]
    assert (1, item) in _both(bronze(("details", {"id": 1, field: ["odd", {key: item}]})), name)


def test_list_endpoints_have_no_bridge(bronze):
    assert _both(bronze(("discover", {"id": 1, "genres": [{"id": 1}]})), "movie_genres") == []


def test_company_names_differ_by_case(bronze):
    rows = bronze(("details", {"id": 1, "production_companies": [{"name": "A"}, {"name": "a"}, {"name": "A"}]}))
    assert _both(rows, "movie_companies") == [(1, "A"), (1, "a")]


def test_bridge_of_the_winner_only(bronze):
    rows = bronze(
        ("details", {"id": 1, "budget": 5, "genres": [{"id": 1}, {"id": 1}]}),
        ("details", {"id": 1, "genres": [{"id": 2}]}),
    )
    stage = silver.staged(rows)
    assert rows_of(silver.movie_genres(silver.winners(stage))) == [(1, 1)]
    assert rows_of(silver.movie_genres(stage)) == [(1, 1), (1, 2)]


def test_latest_lookup_wins(bronze):
    old, new = datetime(2024, 1, 1), datetime(2024, 1, 2)
    rows = bronze(
        ("genres", {"genres": [{"id": 1, "name": "new"}, None]}, new),
        ("genres", {"genres": [{"id": 1, "name": "old"}, {"id": 2, "name": "kept"}, {"id": 2, "name": "kept"}]}, old),
    )
    assert rows_of(silver.genres(rows)) == [(1, "new"), (2, "kept")]
    assert rows_of(silver_sql.genres(rows)) == [(1, "new"), (2, "kept")]


@pytest.mark.parametrize(
    ("order", "kept"), [(0, True), (4, True), ("4", True), (5, False), (None, False), ("x", False), (-1, True)]
)
def test_top_billed(bronze, order, kept):
    rows = bronze(("credits", {"id": 1, "cast": [{"name": "n", "character": "c", "order": order}]}))
    expected = [(1, "n", "Cast", "c", int(order))] if kept else []
    assert rows_of(silver.movie_cast(rows)) == expected == rows_of(silver_sql.movie_cast(rows))


def test_cast_without_order_is_dropped(bronze):
    rows = bronze(("credits", {"id": 1, "cast": [{"name": "n"}, None, "odd"]}))
    assert rows_of(silver.movie_cast(rows)) == [] == rows_of(silver_sql.movie_cast(rows))


def test_directors_and_repeats(bronze):
    crew = [
        {"name": "a", "job": "Director"}, {"name": "b", "job": "Director"}, {"name": "a", "job": "Director"},
        {"name": "c", "job": "director"}, {"name": "d", "job": "Producer"}, None, {"name": "e"},
    ]
    rows = bronze(("credits", {"id": 1, "crew": crew}), ("credits", {"id": 1, "crew": crew}), ("credits", {"id": 2}))
    expected = [(1, "a", "Director", None, None), (1, "b", "Director", None, None)]
    assert rows_of(silver.movie_cast(rows)) == expected == rows_of(silver_sql.movie_cast(rows))
