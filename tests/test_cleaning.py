"""One case per cleaning rule, through both silver paths."""

from __future__ import annotations

from datetime import date

import pytest
from conftest import rows_of

from stratalake.functions import clean
from stratalake.plans import silver, silver_sql

PATHS = {
    "frames": lambda bronze: silver.movies(silver.staged(bronze)),
    "sql": lambda bronze: silver_sql.movies(bronze, "priority"),
}


@pytest.fixture(params=PATHS)
def movies(request):
    return PATHS[request.param]


ABSENT = object()


def _doc(field, value):
    doc = {"id": 1, "vote_count": 5}
    if value is not ABSENT:
        doc[field] = value
    return doc


@pytest.mark.parametrize("field", ["budget", "revenue", "runtime"])
@pytest.mark.parametrize(
    ("value", "expected"),
    [(0, None), ("0", None), ("120", 120), (120, 120), (12.5, None), ("12.5", None), (ABSENT, None),
     (None, None), ("abc", None), ("", None), (-5, -5)],
)
def test_numbers(bronze, movies, field, value, expected):
    assert rows_of(movies(bronze(("details", _doc(field, value)))), field) == [(expected,)]


@pytest.mark.parametrize(
    ("value", "expected"),
    [("", None), (None, None), (ABSENT, None), ("2020", date(2020, 1, 1)), ("2020-02-30", None),
     ("01/02/2020", None), ("2020-01-05T10:00:00", date(2020, 1, 5)), ("2021-03-04", date(2021, 3, 4))],
)
def test_dates(bronze, movies, value, expected):
    got = rows_of(movies(bronze(("details", _doc("release_date", value)))), "release_date", "release_year")
    assert got == [(expected, expected.year if expected else None)]


@pytest.mark.parametrize(
    ("votes", "average", "expected"),
    [(0, 7.5, None), (0, 0, None), ("0", 7.5, None), (None, 7.5, 7.5), (3, 7.5, 7.5), (3, "6.5", 6.5), ("x", 7.5, 7.5)],
)
def test_rating_needs_votes(bronze, movies, votes, average, expected):
    doc = {"id": 1, "vote_count": votes, "vote_average": average}
    assert rows_of(movies(bronze(("details", doc))), "vote_average") == [(expected,)]


@pytest.mark.parametrize(
    ("value", "empty"),
    [("", True), ("   ", True), ("\n \t", True), (None, True), (ABSENT, True), ("x", False), (" x ", False),
     ("y" * 5000, False)],
)
def test_empty_overview(bronze, movies, value, empty):
    assert rows_of(movies(bronze(("details", _doc("overview", value)))), "overview_is_empty") == [(empty,)]


@pytest.mark.parametrize(
    ("value", "title", "code"),
    [("  en ", "en", "EN"), (None, None, None), (ABSENT, None, None), ("", "", ""), (" Fr\n", "Fr", "FR"),
     ("a  b", "a  b", "A  B")],
)
def test_text(bronze, movies, value, title, code):
    doc = {"id": 1}
    if value is not ABSENT:
        doc.update(title=value, original_title=value, original_language=value)
    got = rows_of(movies(bronze(("details", doc))), "title", "original_title", "original_language")
    assert got == [(title, title, code)]


@pytest.mark.parametrize(
    ("value", "expected"), [(True, True), (False, False), (None, None), (ABSENT, None), ("true", True), ("?", None)]
)
def test_adult_stays_unknown(bronze, movies, value, expected):
    assert rows_of(movies(bronze(("details", _doc("adult", value)))), "is_adult") == [(expected,)]


def test_adult_default_is_a_switch(bronze):
    stage = silver.staged(bronze(("details", {"id": 1})), adult_default=False)
    assert rows_of(silver.movies(stage), "is_adult") == [(False,)]


@pytest.mark.parametrize(
    "payload", ["not json", '{"id": 5, "title": "x", "gen', "", "[1, 2]", "{}", {"id": None}, {"id": "abc"}, {"id": 1.5}]
)
def test_documents_without_identity_are_left_out(bronze, movies, payload):
    assert movies(bronze(("details", payload), ("details", {"id": 9}))).count() == 1


def test_other_endpoints_are_no_movies(bronze, movies):
    assert movies(bronze(("credits", {"id": 1}), ("genres", {"id": 2}), ("trending", {"id": 3}))).count() == 1


@pytest.mark.parametrize(
    ("value", "score"), [([], 1), ([{"id": 1}], 1), ([None], 1), (None, 0), (ABSENT, 0), ("oops", 0)]
)
def test_array_presence(bronze, value, score):
    stage = silver.staged(bronze(("details", _doc("genres", value))))
    assert rows_of(stage, "completeness_score") == [(score,)]


def test_white_space_is_what_python_strips(spark):
    every = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
    assert set(every) == set(clean.WHITE_SPACE)
