"""Benchmark decontamination by a distributed positional inverted index.

The index is a stored table of postings ``slot, doc, pos``, one for every word of every text; the slot is a hash of
the word, the term. Texts are dealt out by the bytes there are, about ``SEGMENT`` to a task, and each task writes a
segment of its own, sorted by slot: what a task sorts does not grow with the files that texts come in, no
postings move between tasks, and those of a term lie together. A posting without a slot closes each document and
holds its length. Terms that share a slot share a list, which the comparison with the text sorts out.

A phrase is searched from its two rarest terms: their lists, shifted by the terms' places in the phrase, are
intersected, and what is left is compared word by word with the text. Phrases with a term that no document has
are dropped unseen. Phrases that share their two rarest terms share the intersection.

A word is a run of letters, digits and characters beyond ASCII, A-Z lower-cased. An item's windows are its
``WINDOW`` consecutive words, or all of an item with fewer. A document word inside any occurrence of a window is
hit. Null and empty texts have no words: such documents have no hits, such items no windows. Rows are told
apart by id and text, so rows that share both get equal answers and rows that share one are on their own; a null
document id is an id like any other. A null item id is not listed, but its windows count. Further columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.workspace import fresh_path, store
from .common import ascii_lower, once

WINDOW = 13
#: A document is contaminated when at least one in so many of its words is hit.
SHARE = 20
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
CLOSING = ""  # no word is empty
#: Bytes of text whose postings a task sorts, about 1.3 million of 60 bytes each while they are sorted.
SEGMENT = 8 << 20


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(F.xxhash64("doc_id", "text").alias("doc"), "doc_id", "text")


def _slot(term: Column) -> Column:
    return F.xxhash64(term)


def _spread(docs: DataFrame) -> DataFrame:
    """Documents dealt out evenly, copies as well, into tasks of about ``SEGMENT`` bytes of text."""
    size = docs.agg(F.sum(F.octet_length("text").cast("bigint")).alias("n")).first()["n"] or 0
    rows = _documents(docs).withColumn("row", F.monotonically_increasing_id())
    return rows.repartition(-(-size // SEGMENT) or 1, "row")


def build_index(docs: DataFrame) -> DataFrame:
    """Write the postings ``slot, doc, pos, doc_id`` of all texts; the id is in closing postings only.

    Rows are sorted by numbers and carry no words, as all words of a segment lie in memory at once.
    """
    spark, path = docs.sparkSession, fresh_path(docs.sparkSession, "postings")
    closed = F.concat(words_of(F.col("text")), F.array(F.lit(CLOSING)))
    closing = F.col("term") == CLOSING
    postings = _spread(docs).select("doc", "doc_id", F.posexplode(closed).alias("pos", "term")).select(
        F.when(~closing, _slot(F.col("term"))).alias("slot"), "doc", "pos", F.when(closing, F.col("doc_id")).alias("doc_id")
    )
    postings.sortWithinPartitions("slot").write.option("compression", "zstd").parquet(path)
    return spark.read.schema(postings.schema).parquet(path)


def windows(items: DataFrame, size: int = WINDOW) -> DataFrame:
    """Distinct windows ``words, items`` of ``item_id, text``."""
    whole = once(items.select("item_id", "text"), words=words_of(F.col("text"))).where(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - (size - 1), F.lit(1)))
    each = whole.select("item_id", F.explode(F.transform(starts, lambda s: F.slice("words", s, size))).alias("words"))
    return each.groupBy("words").agg(F.collect_set("item_id").alias("items"))


def _anchored(phrases: DataFrame, index: DataFrame) -> DataFrame:
    """Phrases ``phrase, words, ...`` that can occur, with places and slots of their two rarest words."""
    each = phrases.select("phrase", F.posexplode("words").alias("place", "term"))
    places = each.select("phrase", "place", _slot(F.col("term")).alias("slot"))
    # Written first, so that its size is known: while it is small, the postings need not be moved for the join.
    asked = store(places.select("slot").distinct())
    counts = index.select("slot").join(asked, "slot", "left_semi").groupBy("slot").agg(F.count("*").alias("times"))
    rarest = F.array_sort(F.collect_list(F.struct("times", "place", "slot")))
    ranked = places.join(counts, "slot").groupBy("phrase").agg(rarest.alias("r"))
    second = F.coalesce(F.get("r", F.lit(1)), F.get("r", F.lit(0)))  # a phrase of one word meets itself
    return phrases.join(ranked, "phrase").where(F.size("r") == F.size("words")).select(
        *phrases.columns, F.col("r")[0]["slot"].alias("first"), F.col("r")[0]["place"].alias("place"),
        second["slot"].alias("second"), (second["place"] - F.col("r")[0]["place"]).alias("apart"),
    )


def _lists(index: DataFrame, anchored: DataFrame) -> DataFrame:
    """Postings of the anchor terms."""
    slots = store(anchored.select(F.explode(F.array("first", "second")).alias("slot")).distinct())
    return store(index.select("slot", "doc", "pos").join(slots, "slot", "left_semi"))


def _pairs(anchored: DataFrame) -> DataFrame:
    return anchored.select("first", "second", "apart").distinct()


def phrase_candidates(index: DataFrame, phrases: DataFrame) -> DataFrame:
    """``doc, phrase, start`` wherever the two rarest words of a phrase stand as in the phrase."""
    anchored = store(_anchored(phrases, index))
    lists, pairs = _lists(index, anchored), _pairs(anchored)
    one = lists.join(pairs, F.col("slot") == F.col("first")).select(
        "doc", "first", "second", "apart", (F.col("pos") + F.col("apart")).alias("meet")
    )
    other = lists.join(pairs, F.col("slot") == F.col("second")).select(
        "doc", "first", "second", "apart", F.col("pos").alias("meet")
    )
    met = one.join(other, ["doc", "meet", "first", "second", "apart"], "left_semi")
    found = met.join(anchored.select("phrase", "place", "first", "second", "apart"), ["first", "second", "apart"])
    start = F.col("meet") - F.col("apart") - F.col("place")
    return found.select("doc", "phrase", start.alias("start")).where("start >= 0")


def near_matches(index: DataFrame, phrases: DataFrame, within: int) -> DataFrame:
    """``doc, phrase, first_pos, second_pos``: the two rarest words of a phrase at most ``within`` words apart.

    Positions meet in stretches of ``within + 1`` words and the one after, so each pair is found once. Words are told
    apart by their 64-bit slots alone here, as documents are.
    """
    anchored = store(_anchored(phrases, index))
    lists, pairs = _lists(index, anchored), _pairs(anchored)
    stretch = F.floor(F.col("pos") / (within + 1))
    one = lists.join(pairs, F.col("slot") == F.col("first")).select(
        "doc", "first", "second", "apart", F.col("pos").alias("first_pos"),
        F.explode(F.array(stretch - 1, stretch, stretch + 1)).alias("stretch"),
    )
    other = lists.join(pairs, F.col("slot") == F.col("second")).select(
        "doc", "first", "second", "apart", F.col("pos").alias("second_pos"), stretch.alias("stretch")
    )
    met = one.join(other, ["doc", "stretch", "first", "second", "apart"])
    met = met.where(F.abs(F.col("first_pos") - F.col("second_pos")) <= within)
    found = met.join(anchored.select("phrase", "first", "second", "apart"), ["first", "second", "apart"])
    return found.select("doc", "phrase", "first_pos", "second_pos")


def _hits(docs: DataFrame, index: DataFrame, phrases: DataFrame) -> DataFrame:
    """``doc, doc_id, n_hit, items`` of the documents in which a phrase occurs."""
    found = phrase_candidates(index, phrases).join(phrases, "phrase")
    found = found.groupBy("doc").agg(F.collect_list(F.struct("start", "words", "items")).alias("found"))
    texts = once(_documents(docs).join(found, "doc"), all_words=words_of(F.col("text")))
    same = F.filter("found", lambda c: F.slice("all_words", c["start"] + 1, F.size(c["words"])) == c["words"])
    exact = once(texts, exact=same).where(F.size("exact") > 0)
    covered = F.transform("exact", lambda c: F.sequence(c["start"], c["start"] + F.size(c["words"]) - 1))
    items = F.flatten(F.transform("exact", lambda c: c["items"]))
    return exact.select(
        "doc", "doc_id", F.size(F.array_distinct(F.flatten(covered))).alias("n_hit"),
        F.array_sort(F.array_distinct(F.transform(items, lambda i: i.cast("string")))).alias("items"),
    ).dropDuplicates(["doc", "doc_id"])


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc, doc_id, n_words, n_hit, items, contaminated`` of every document row."""
    index = build_index(docs)
    phrases = store(windows(items, window).withColumn("phrase", F.monotonically_increasing_id()))
    hits = _hits(docs, index, phrases).withColumnRenamed("doc", "_doc").withColumnRenamed("doc_id", "_id")
    lengths = index.where("slot IS NULL").select("doc", "doc_id", F.col("pos").cast("bigint").alias("n_words"))
    rows = lengths.join(hits, (F.col("doc") == F.col("_doc")) & F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("bigint")
    return rows.select(
        "doc", "doc_id", "n_words", n_hit.alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        ((n_hit > 0) & (SHARE * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows, with all their columns, that are not contaminated."""
    # Written first, so that its size is known: while it is small, the texts need not be moved for the join.
    bad = store(contamination(docs, items).where("contaminated").select(F.col("doc").alias("_doc")).distinct())
    return docs.join(bad, F.xxhash64(docs["doc_id"], docs["text"]) == bad["_doc"], "left_anti")


def digest(report: DataFrame) -> DataFrame:
    """A report with its items as a count and a checksum."""
    return report.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"), "contaminated",
    )
