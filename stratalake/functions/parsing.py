"""Reading JSON payloads with one explicit-schema parse per row.

Every scalar is read as text and cast afterwards, so an absent key, a JSON null and an
unreadable value all become NULL, and numbers sent as strings are read like numbers. Text that is
no JSON gives NULL in every field.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The payload fields that are kept, in table order.
SCALAR_FIELDS = (
    "id", "title", "original_title", "original_language", "release_date", "budget", "revenue",
    "runtime", "vote_average", "vote_count", "popularity", "adult", "overview",
)
NESTED_FIELDS = ("genres", "production_companies", "spoken_languages")

# Nested arrays are read element by element as VARIANT: an element of an unexpected shape then costs
# only itself, where a typed element would turn the whole array to NULL.
_ITEMS = T.ArrayType(T.VariantType())


def _payload(scalars: tuple[str, ...], nested: tuple[str, ...]) -> T.StructType:
    return T.StructType(
        [T.StructField(name, T.StringType()) for name in scalars] + [T.StructField(name, _ITEMS) for name in nested]
    )


MOVIE_PAYLOAD = _payload(SCALAR_FIELDS, NESTED_FIELDS)
LOOKUP_PAYLOAD = _payload((), ("genres",))
CREDITS_PAYLOAD = _payload(("id",), ("cast", "crew"))


def read_payload(rows: DataFrame, schema: T.StructType, *keep: Column | str) -> DataFrame:
    """The payload's fields as columns, followed by the columns to keep.

    ``inline`` makes the parse a generator: filters on the fields stay above it, where a plain
    projection would be folded into each filter and parse the text once more per condition.
    """
    return rows.select(F.inline(F.array(F.from_json("payload", schema))), *keep)


def present(items: Column) -> Column:
    """Array without its null elements."""
    return F.filter(items, lambda item: item.isNotNull() & ~F.is_variant_null(item))


def text(item: Column, field: str) -> Column:
    """A field of an array element as text; absent, null or no object gives NULL."""
    return F.try_variant_get(item, f"$.{field}", "string")
