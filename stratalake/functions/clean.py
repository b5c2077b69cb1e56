"""The cleaning rules, one Column function per rule. All inputs are text columns."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space at the ends of a text.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def integer(text: Column) -> Column:
    return text.try_cast("int")


def long(text: Column) -> Column:
    return text.try_cast("bigint")


def double(text: Column) -> Column:
    return text.try_cast("double")


def boolean(text: Column, default: bool | None = None) -> Column:
    """NULL stays unknown unless a default is asked for."""
    value = text.try_cast("boolean")
    return value if default is None else F.coalesce(value, F.lit(default))


def sentinel_zero(number: Column) -> Column:
    """Zero stands for "unknown"."""
    return F.nullif(number, F.lit(0))


def date(text: Column) -> Column:
    """Empty or unreadable dates are NULL."""
    return F.nullif(text, F.lit("")).try_cast("date")


def rating(average: Column, votes: Column) -> Column:
    """An average without votes is no rating; an unknown vote count keeps the average."""
    return F.when(votes == 0, F.lit(None)).otherwise(average)


def strip(text: Column) -> Column:
    """Trim Unicode white space at both ends; NULL stays NULL."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def code(text: Column) -> Column:
    return F.upper(strip(text))


def is_blank(text: Column) -> Column:
    return F.coalesce(strip(text) == "", F.lit(True))


def presence_score(*columns: Column) -> Column:
    """How many of the columns carry a value."""
    return reduce(lambda a, b: a + b, [c.isNotNull().cast("int") for c in columns])


def ranked(value: Column, ranks: Mapping[str, int], default: int = 0) -> Column:
    """Look a value up in a small fixed ranking."""
    choice = reduce(lambda case, kv: case.when(value == kv[0], F.lit(kv[1])), ranks.items(), F)
    return choice.otherwise(F.lit(default))
