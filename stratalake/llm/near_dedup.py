"""Near-duplicates by an inverted join over MinHash coordinates.

A document's set holds the distinct hashes of its three-word shingles. Documents with equal sets form a class and
go on as one. Each class posts its ``COORDINATES`` MinHash values, one list per coordinate and value. Two sets
with a Jaccard similarity of 0.85 agree in 41 of 48 coordinates on average and in fewer than ``MATCHES`` = 24 with
a probability of 2e-10, so pairs below that are left out unseen:

* a coordinate that no other class shares can't match, so classes with fewer than 24 shared ones drop out;
* of the others, a class posts its rarest only: two classes that agree in 24 of 48 coordinates share at least
  one among any 25 of each, taken in the same order (prefix merging); common values are hardly ever posted;
* full signatures of a candidate pair are compared before their sets are (skip merging).

Links are then confirmed on the full sets. A list of many near copies never turns into all its pairs: rounds pair
every member with one hub per list, join what is linked into components, and go on with lists that still hold
several components, as long as that gets on. From the second round on a list is dealt out by sizes, so that sets
too unlike in size to be similar get hubs of their own and don't hold a list open; a round that links nothing new is
the last of its kind. What is left is paired across components by the same kind of join, now over the shingles
themselves: sets of which 85 in 100 members agree share one of the rarest 15 in 100 of each, which
tells apart the many texts that agree in half of their coordinates. No pair that shares a posting is left untried.

Words are runs of characters other than ASCII white space, A-Z lower-cased. A text of fewer than three words is
one shingle; a null text, or one without words, has an empty set and no links. Rows with the same id are one
document with the links of all its texts. A row without an id has no links: its component is null and it is
kept. An empty table gives no rows. Further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.workspace import store
from .common import LOWER_BYTES, map_rows
from .components import components

SHINGLE, PERCENT = 3, 85
COORDINATES, MATCHES = 48, 24
PREFIX = COORDINATES - MATCHES + 1
#: Words whose hash a task remembers; beyond that it starts anew.
REMEMBERED = 200_000
#: Rounds of hubs go on while trying all pairs of a list would cost more than so many per posting and at least
#: so large a share of the pairs with hubs are links.
PAIRS_PER_POSTING, PRODUCTIVE = 2, 0.5
#: Logarithm of the ratio of sizes in a bucket: similar sets are in the same or in neighbouring ones, also when rounded.
BUCKET = 1.0001 * math.log(100 / PERCENT)

_rng = np.random.default_rng(20240601)
_PLACES = _rng.integers(1, 1 << 63, SHINGLE, dtype=np.uint64) | np.uint64(1)
_FACTORS = _rng.integers(1, 1 << 63, COORDINATES, dtype=np.uint64) | np.uint64(1)
_SHIFTS = _rng.integers(1, 1 << 63, COORDINATES, dtype=np.uint64)
_COORDINATE = np.arange(COORDINATES, dtype=np.uint64) << np.uint64(32)


class WordHashes(dict):
    def __init__(self):
        from xxhash import xxh3_64_intdigest

        self.hash = xxh3_64_intdigest

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = found = self.hash(word)
        return found


def shingles(text: bytes | None, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text."""
    words = (text or b"").translate(LOWER_BYTES).split()
    codes = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    size = min(len(codes), SHINGLE)
    if not size:
        return codes
    mixed = np.full(len(codes) - size + 1, size, np.uint64)
    for i in range(size):
        mixed += codes[i : len(codes) - size + 1 + i] * _PLACES[i]
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed)


def signature(members: np.ndarray) -> np.ndarray:
    """The smallest value per coordinate, with the number of the coordinate above it."""
    least = np.full(COORDINATES, ~np.uint64(0))
    for at in range(0, len(members), 4096):
        values = members[at : at + 4096, None] * _FACTORS + _SHIFTS
        np.minimum(least, values.min(axis=0), out=least)
    return _COORDINATE | least >> np.uint64(32)


def _sketches(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, set_key, coordinates``; the last two are null for empty sets."""

    def make():
        from xxhash import xxh3_128_digest

        hashes = WordHashes()

        def step(doc_ids, texts) -> Iterator[tuple]:
            for doc_id, text in zip(doc_ids, texts, strict=True):
                members = shingles(text, hashes)
                if len(members):
                    yield doc_id, len(members), xxh3_128_digest(members.tobytes()), signature(members).astype(np.int64)
                else:
                    yield doc_id, 0, None, None

        return step

    return map_rows(
        docs.select("doc_id", "text"), make,
        "doc_id bigint, n_shingles bigint, set_key binary, coordinates array<bigint>", binary=("text",),
    )


def _members(docs: DataFrame) -> DataFrame:
    """``set_key, shingles``"""

    def make():
        from xxhash import xxh3_128_digest

        hashes = WordHashes()

        def step(texts) -> Iterator[tuple]:
            for text in texts:
                members = shingles(text, hashes)
                yield xxh3_128_digest(members.tobytes()), members.view(np.int64)

        return step

    return map_rows(docs.select("text"), make, "set_key binary, shingles array<bigint>", binary=("text",))


def _posted(classes: DataFrame) -> DataFrame:
    """``key, class, n, company``: each class under its rarest shared coordinates, and how often all those it shares occur."""
    postings = classes.select("class", "n", F.explode("coordinates").alias("key"))
    shared = postings.groupBy("key").agg(F.count("*").alias("times")).where("times > 1")
    rows = postings.join(shared, "key").groupBy("class", "n").agg(F.collect_list(F.struct("times", "key")).alias("shared"))
    # Coordinates that are not shared are the rarest of all and take the first places.
    places = F.size("shared") - (MATCHES - 1)
    company = F.aggregate("shared", F.lit(0).cast("bigint"), lambda total, s: total + s["times"])
    return rows.where(places > 0).select(
        F.explode(F.slice(F.array_sort("shared"), 1, places)["key"]).alias("key"), "class", "n", company.alias("company")
    )


def _compared(pairs: DataFrame, sets: DataFrame, by_signature: bool) -> DataFrame:
    """Pairs ``u, v`` of classes with what their sets have in ``common``, those with unlike signatures left out if asked to."""

    def both(rows: DataFrame, column: str) -> DataFrame:
        side = sets.select("class", F.col(column).alias("_"))
        for name in ("u", "v"):
            rows = rows.join(side.select(F.col("class").alias(name), F.col("_").alias(f"_{name}")), name)
        return rows

    if by_signature:
        pairs = both(pairs, "coordinates").where(F.size(F.array_intersect("_u", "_v")) >= MATCHES).select("u", "v")
    common = F.size(F.array_intersect("_u", "_v")).alias("common")
    return both(pairs, "shingles").select("u", "v", common, (F.size("_u") + F.size("_v")).alias("both"))


def _similar(compared: DataFrame) -> DataFrame:
    return compared.where(100 * F.col("common") >= PERCENT * (F.col("both") - F.col("common"))).select("u", "v")


def _near(n: Column, other: Column) -> Column:
    """Whether sets of these sizes can be similar."""
    return (n * 100 >= PERCENT * other) & (other * 100 >= PERCENT * n)


def _pairs(rows: DataFrame) -> DataFrame:
    """Distinct pairs ``u, v`` of a class and another one, leaving out sizes that are too unlike."""
    return rows.where(_near(F.col("n"), F.col("other_n"))).select(F.col("class").alias("u"), F.col("other_class").alias("v")).distinct()


def _by_size(now: DataFrame) -> DataFrame:
    """The lists that hold several components, each as lists of two neighbouring buckets of sizes.

    Every two classes of a list whose sizes allow a link meet in at least one of the new ones.
    """
    several = now.groupBy("key").agg(F.min("component").alias("a"), F.max("component").alias("b")).where("a < b")
    bucket = F.floor(F.log("n") / BUCKET)
    parts = F.array(F.xxhash64("key", bucket), F.xxhash64("key", bucket + 1))
    return now.join(several.select("key"), "key").withColumn("key", F.explode(parts))


def _other(lists: DataFrame, *columns: str) -> DataFrame:
    return lists.select("key", *[F.col(c).alias(f"other_{c}") for c in columns])


def _by_coordinates(lists: DataFrame) -> DataFrame:
    """All pairs across components on the lists ``key, class, component, n``."""
    others = _other(lists, "class", "component", "n")
    return _pairs(lists.join(others, "key").where(F.col("component") < F.col("other_component")))


def _enough(common: Column, n: Column, other: Column) -> Column:
    """Whether sets of these sizes can be similar with so many members in common."""
    return common * (100 + PERCENT) >= PERCENT * (n + other)


def _rarest_members(rest: DataFrame, sets: DataFrame, compared: DataFrame) -> DataFrame:
    """Lists of the classes ``class, component, n`` under their rarest members, those that may hold a link.

    A class that meets another on a list has no more in common with it than what it has of shared members from there
    on, in order of rarity, and the other is no smaller than the smallest of the list. A class that can't be similar
    to a set of that size is taken off before any two are paired, which clears the lists of pages that share a
    template and no more.
    """
    # Only a hub that is counted here itself makes all it has in common with others shared members.
    compared = compared.join(rest.select(F.col("class").alias("v")), "v", "left_semi")
    hub = compared.groupBy(F.col("u").alias("class")).agg(F.max(F.struct("common", F.col("v").alias("hub"))).alias("h"))
    hub = hub.union(compared.select(F.col("v").alias("class"), F.struct(F.lit(1 << 30).alias("common"), F.col("v").alias("hub")).alias("h")).distinct())
    hub = hub.groupBy("class").agg(F.max("h").alias("h"))
    members = rest.join(sets.select("class", F.explode("shingles").alias("key")), "class")
    shared = members.groupBy("key").agg(F.count("*").alias("times")).where("times > 1")
    rows = members.join(shared, "key").groupBy("class").agg(
        F.first("component").alias("component"), F.first("n").alias("n"),
        F.array_sort(F.collect_list(F.struct("times", "key"))).alias("shared"),
    )
    places = F.size("shared") - F.ceil(F.col("n") * PERCENT / 100).cast("int") + 1
    rows = rows.where(places > 0).join(hub, "class", "left")
    with_hub = F.least(F.col("h.common"), F.size("shared"))
    rows = rows.select(
        "class", "component", "n", F.size("shared").alias("all"), F.col("h.hub").alias("hub"), with_hub.alias("with_hub"),
        F.posexplode(F.slice("shared", 1, places)).alias("at", "p"),
    )
    lists = store(rows.select(
        F.col("p.key").alias("key"), "class", "component", "n", "hub", "with_hub",
        (F.col("all") - F.col("with_hub")).alias("beyond"), (F.col("all") - F.col("at")).alias("left"),
    ))
    open_lists = lists.groupBy("key").agg(
        F.min("component").alias("a"), F.max("component").alias("b"), F.min("n").alias("least")
    ).where("a < b").select("key", "least")
    smallest = F.greatest("least", F.ceil(F.col("n") * PERCENT / 100))
    return lists.join(open_lists, "key").where(_enough(F.col("left"), F.col("n"), smallest)).drop("least")


def _by_rarest_members(lists: DataFrame) -> DataFrame:
    """Pairs across components among the classes on lists of their rarest members.

    Two bounds on what a pair has in common leave out most of those that aren't similar. Where two sets meet for
    the first time, in order of rarity, what is left of the shorter one must do. And if both were compared
    with the same hub, they share no more than one of them shares with it, plus what both have of shared members
    that the hub lacks.
    """
    columns = ("class", "component", "n", "hub", "with_hub", "beyond", "left")
    at_most = F.least("left", "other_left")
    by_hub = F.least("with_hub", "other_with_hub") + F.least("beyond", "other_beyond")
    at_most = F.when(F.col("hub") == F.col("other_hub"), F.least(at_most, by_hub)).otherwise(at_most)
    enough = _enough(at_most, F.col("n"), F.col("other_n"))
    across = F.col("component") < F.col("other_component")
    return _pairs(lists.join(_other(lists, *columns), "key").where(across & enough))


def _links(lists: DataFrame, sets: DataFrame) -> DataFrame | None:
    """Enough confirmed links ``u, v`` between classes to tell all components."""
    links, compared, turn, productive = None, None, 0, True
    while True:
        if links is None:
            now = lists.withColumn("component", F.col("class"))
        else:
            found = components(links).withColumnRenamed("node", "class")
            now = lists.join(found, "class", "left").withColumn("component", F.coalesce("component", "class"))
        now = store(now)
        if turn:
            now = store(_by_size(now))
        # First the class with most company, which is in the middle of its near copies; then another each time.
        order = F.struct(F.col("company") * (-1 if turn == 0 else 0), F.xxhash64("class", F.lit(turn)))
        parts = now.groupBy("key", "component").agg(
            F.count("*").alias("members"), F.min(F.struct(order.alias("order"), "class", "component", "n")).alias("hub"),
            F.min("n").alias("least"), F.max("n").alias("most"),
        )
        members = F.col("members")
        open_lists = store(parts.groupBy("key").agg(
            F.count("*").alias("components"), F.sum("members").alias("members"), F.min("hub").alias("hub"),
            F.sum(members * members).alias("inside"), F.max("least").alias("least"), F.min("most").alias("most"),
        ).where((F.col("components") > 2) | (F.col("components") == 2) & (F.col("most") * 100 >= PERCENT * F.col("least"))))
        across = F.sum((members * members - F.col("inside")) / 2)
        cost = open_lists.agg(across.alias("pairs"), F.sum("members").alias("postings")).first()
        if not cost["postings"]:
            return links
        few, rest = cost["pairs"] <= PAIRS_PER_POSTING * cost["postings"], now.join(open_lists.select("key"), "key")
        if few:
            pairs = _by_coordinates(rest)
        elif not productive:
            lists = _rarest_members(store(rest.select("class", "component", "n").distinct()), sets, compared)
            pairs = _by_rarest_members(store(lists))
        else:
            hub = [F.col(f"hub.{c}").alias(f"other_{c}") for c in ("class", "component", "n")]
            pairs = now.join(open_lists.select("key", *hub), "key")
            pairs = _pairs(pairs.where(F.col("component") != F.col("other_component")))
        pairs = store(pairs)
        tried = store(_compared(pairs, sets, by_signature=few or productive))
        more = _similar(tried)
        links = more if links is None else links.union(more)
        if few or not productive:
            return links
        compared = tried if compared is None else compared.union(tried)
        n_pairs, n_more = pairs.count(), more.count()
        # Only the first hubs can be too unlike in size for all others, as its lists aren't dealt out by sizes.
        productive = n_more >= PRODUCTIVE * n_pairs if n_pairs else turn == 0
        turn += 1


def _same_documents(linkable: DataFrame, classes: DataFrame) -> DataFrame | None:
    """Links between the classes of an id whose rows have several sets."""
    several = store(
        linkable.groupBy("doc_id").agg(F.min("set_key").alias("first"), F.max("set_key").alias("last")).where("first <> last")
    )
    if several.isEmpty():
        return None
    key = classes.select("set_key", "class")
    rows = linkable.select("doc_id", "set_key").join(several, "doc_id").join(key, "set_key")
    return rows.join(key.select(F.col("set_key").alias("first"), F.col("class").alias("v")), "first").select(
        F.col("class").alias("u"), "v"
    )


def groups(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row."""
    sketches = store(_sketches(docs))
    linkable = sketches.where("doc_id IS NOT NULL AND set_key IS NOT NULL")
    classes = store(
        linkable.groupBy("set_key").agg(
            F.min("doc_id").alias("first_id"), F.first("n_shingles").alias("n"), F.first("coordinates").alias("coordinates")
        ).withColumn("class", F.monotonically_increasing_id())
    )
    lists = store(_posted(classes))
    # One document stands for each class that is posted.
    posted = classes.join(lists.select("class").distinct(), "class", "left_semi")
    posted = store(posted.select("set_key", "class", "first_id", "coordinates"))
    texts = docs.select("doc_id", "text").join(posted.select(F.col("first_id").alias("doc_id")).distinct(), "doc_id", "left_semi")
    # Rows with the same id can have several texts: only the set that belongs to the class counts, once.
    sets = store(
        _members(texts).join(posted.drop("first_id"), "set_key").drop("set_key").dropDuplicates(["class"])
    )
    links = [found for found in (_links(lists, sets), _same_documents(linkable, classes)) if found is not None]
    named = classes.select("set_key", F.col("first_id").alias("component_id"))
    if links:
        found = store(components(reduce(DataFrame.union, links)).withColumnRenamed("node", "class"))
        rooted = classes.select("class", "first_id").join(found, "class")
        smallest = rooted.groupBy("component").agg(F.min("first_id").alias("smallest"))
        found = found.join(smallest, "component").select("class", "smallest")
        named = classes.join(found, "class", "left").select("set_key", F.coalesce("smallest", "first_id").alias("component_id"))
    own = F.coalesce("component_id", "doc_id")
    rows = sketches.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("set_key")).alias("set_key"))
    return rows.join(named, "set_key", "left").select(
        "doc_id", "n_shingles", own.alias("component_id"), F.coalesce(F.col("doc_id") == own, F.lit(True)).alias("kept")
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows, with all their columns, of one document of each group; rows that agree in id and text count once.

    Which rows go is written first, so that its size is known: while it is small, the texts need not be moved. Only rows
    that share id and text with another one meet it.
    """
    others = store(groups(docs).where(~F.col("kept")).select("doc_id").distinct())
    kept = docs.join(others, "doc_id", "left_anti").select(*docs.columns)
    alike = F.xxhash64("doc_id", "text")
    repeated = store(docs.groupBy(alike.alias("_alike")).agg(F.count("*").alias("n")).where("n > 1").select("_alike"))
    if repeated.isEmpty():
        return kept
    marked = kept.withColumn("_alike", alike)
    single = marked.join(repeated, "_alike", "left_anti").drop("_alike")
    return single.union(marked.join(repeated, "_alike", "left_semi").drop("_alike").dropDuplicates(["doc_id", "text"]))
