"""Personal data: fixed kinds, and identifiers found by bootstrapping from their contexts.

Base spans come from four patterns and a check of what matched. They are the seeds. A pattern of the
bootstrapping is what stands left of a slot: the word before, or the two words before; white space, quotes, ``:`` and
``=`` end a word, the last two being part of it. Its instances are the seeds and all other words with a digit or an
``@``. Over the graph of patterns and instances two scores are worked
out in turn: a pattern's is the share of all its occurrences in the corpus, whatever follows, that lead up to
instances, each counted by its score; an instance's is the chance that at least one of its patterns is right, and a
seed's is 1, any other's 0 at first. A pattern without a seed counts once ``INDUCED`` of its occurrences lead up to
instances by what other labels say of them, so that identifiers found make labels known in their turn, over any number
of steps. After ``ROUNDS`` turns, and as many more as trust further patterns, words in the slot of a pattern that scores at least ``CONFIDENT`` are
identifiers of the kind ``id``. A common phrase never becomes a pattern, as hardly any of its occurrences
lead up to a seed; a label does. Words that overlap a base span are no instances of their own.

Spans count code points, end exclusive. Null text counts as empty. Rows are told apart by id and text, so rows
that share both get equal answers. An empty table gives no rows. Further columns are ignored.

Everything is built-in functions. Patterns are written with possessive quantifiers and look at where a run of
characters begins, so that a long text without a match costs a single pass and no recursion.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.workspace import store
from .common import once

KINDS = ("email", "ip", "card", "phone")
FOUND = "id"
_EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
_CARD = r"[0-9](?:[\x20-]?[0-9])++"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: A word with a digit or an @, from where a context word ends; what it is compared by leaves out marks around it.
_WORD = r"""(?<![^\s:="'])[^\s0-9@:="']*+[0-9@]\S*+"""
_MARKS = r"""["'.,;:!?()\[\]{}<>*&%$#|=]"""
_BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"

#: Where a context word ends.
_BETWEEN = r"""[\s"']+|(?<=[:=])(?=[^\s:="'])"""

#: Distinct instances a pattern must have; score from which it is trusted; turns of scoring at least.
SUPPORT, CONFIDENT, ROUNDS = 5, 0.6, 4
#: Share of its occurrences by which other labels must vouch for a pattern without a seed.
INDUCED = 0.2
#: Characters left of a slot that are looked at first; where they don't hold two whole words, all there are.
LEFT = 200


def _identity(docs: DataFrame) -> DataFrame:
    return docs.select(F.xxhash64("doc_id", "text").alias("doc"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))


def _passes(kind: Column, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    size = F.length(digits)
    doubled = F.aggregate(
        F.sequence(F.lit(1), size), F.lit(0),
        lambda total, i: total + F.when(i % 2 == 1, _digit(digits, size - i + 1)).otherwise(
            F.get(F.lit([0, 2, 4, 6, 8, 1, 3, 5, 7, 9]), _digit(digits, size - i + 1))
        ),
    )
    return (
        F.when(kind == "ip", value.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$"))
        .when(kind == "card", F.when((size >= 16) & (size <= 19), doubled % 10 == 0).otherwise(F.lit(False)))
        .when(kind == "phone", (size >= 8) & (size <= 15))
        .otherwise(F.lit(True))
    )


def _digit(digits: Column, place: Column) -> Column:
    return F.ascii(F.substr(digits, place, F.lit(1))) - ord("0")


def _matches(docs: DataFrame) -> DataFrame:
    """``doc, doc_id, kind, start, end, value, context`` of everything that matches a pattern, checked or not.

    A match begins where the texts between matches and the matches before it end. ``context`` has the two words before
    it, empty where there is none, or is null if the match does not stand where a context word ends.
    """
    text = F.col("text")
    hints = {"email": text.contains("@"), "phone": text.contains("+")}
    patterns = dict(zip((*KINDS, FOUND), (_EMAIL, _IP, _CARD, _PHONE, _WORD), strict=True))
    sought = [
        F.when(
            hints.get(kind, text.rlike("[0-9@]")),
            F.struct(
                F.lit(kind).alias("kind"), F.regexp_extract_all("text", F.lit(p), F.lit(0)).alias("values"),
                F.split("text", p, -1).alias("gaps"),
            ),
        )
        for kind, p in patterns.items()
    ]
    found = _identity(docs).where(text.rlike("[0-9@]")).select("doc", "doc_id", F.inline(F.array_compact(F.array(*sought))))
    found = found.where(F.size("values") > 0)
    each = found.select(
        "doc", "doc_id", "kind",
        F.posexplode(F.arrays_zip("values", F.slice("gaps", 1, F.size("values")).alias("gaps"))).alias("nth", "m"),
    ).select(
        "doc", "doc_id", "kind", "nth", F.col("m.values").alias("value"), F.length("m.gaps").alias("gap"),
        F.when(F.right(F.col("m.gaps"), F.lit(1)).rlike(r"""[\s:="']$"""), _two_words(F.col("m.gaps"))).alias("context"),
    ).distinct()
    upto = Window.partitionBy("doc", "doc_id", "kind").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.length("value")).over(upto)
    return each.select("doc", "doc_id", "kind", "nth", "value", "context", end.alias("end")).select(
        "doc", "doc_id", "kind", (F.col("end") - F.length("value")).alias("start"), "end", "value", "context", "nth"
    )


def _slots(matches: DataFrame) -> DataFrame:
    """Checked base spans, and words that overlap none, with the patterns they are instances of.

    ``doc, doc_id, kind, start, end, value, patterns``. Where a word begins in the middle of others, as after an
    opening quote, its marks are left out of its span.
    """
    word = F.col("kind") == FOUND
    marks = F.when(word, F.length(F.regexp_extract("value", f"^{_MARKS}*+", 0))).otherwise(0)
    core = F.when(word, F.regexp_replace("value", f"^{_MARKS}++|{_MARKS}++$", "")).otherwise(F.col("value"))
    right = matches.where(_passes(F.col("kind"), F.col("value"))).select(
        "doc", "doc_id", "kind", (F.col("start") + marks).alias("start"), core.alias("value"), "context", "nth"
    ).select("*", (F.col("start") + F.length("value")).alias("end"))
    base = F.col("kind") != FOUND
    # Both frames only grow from row to row; one that shrinks would be read anew for each row.
    row, growing = Window.partitionBy("doc", "doc_id"), (Window.unboundedPreceding, Window.currentRow)
    so_far, from_here = row.orderBy("start").rangeBetween(*growing), row.orderBy(F.desc("start")).rangeBetween(*growing)
    before_end = F.max(F.when(base, F.col("end"))).over(so_far)
    next_start = F.min(F.when(base, F.col("start"))).over(from_here)
    overlaps = (F.coalesce(before_end, F.lit(0)) > F.col("start")) | (F.coalesce(next_start, F.col("end")) < F.col("end"))
    kept = right.select("*", overlaps.alias("overlaps")).where(base | (~F.col("overlaps") & (F.length("value") > 0)))
    patterns = _patterns(_readable(F.col("context")[0]), _readable(F.col("context")[1]))
    return kept.select(
        "doc", "doc_id", "kind", "start", "end", "value",
        F.when(F.col("context").isNotNull(), patterns).otherwise(F.array().cast("array<string>")).alias("patterns"),
    )


def _two_words(gap: Column) -> Column:
    """The last two context words of a text, lower-cased and whole, however far back they begin."""
    near = _context_words(F.right(gap, F.lit(LEFT)))
    # The first of three or more may be cut off at its beginning; the last two are not.
    words = F.when((F.length(gap) <= LEFT) | (F.size(near) > 2), near).otherwise(_context_words(gap))
    return F.slice(F.concat(F.array(F.lit(""), F.lit("")), words), -2, 2)


def _context_words(text: Column | str) -> Column:
    return F.filter(F.split(F.lower(text), _BETWEEN), lambda w: ~w.isin("", ":", "="))


def _readable(word: Column) -> Column:
    """A context word; null for other instances and where there is none."""
    return F.when((word != "") & ~word.rlike("[0-9@]"), word)


def _patterns(second: Column, first: Column) -> Column:
    """The word before, and the two words before, as far as they can be read."""
    both = F.when(first.isNotNull() & second.isNotNull(), F.concat_ws(" ", second, first))
    return F.array_compact(F.array(first, both))


def _occurrences(docs: DataFrame, patterns: DataFrame) -> DataFrame:
    """``pattern, total``: how often each pattern stands anywhere in the texts, whatever follows it."""
    ends = patterns.select(F.substring_index("pattern", " ", -1).alias("first")).distinct()
    texts = once(_identity(docs).select("text"), words=_context_words("text"))
    words = texts.select("words", F.posexplode("words").alias("at", "first"))
    words = words.select("first", F.get("words", F.col("at") - 1).alias("second")).join(ends, "first", "left_semi")
    pairs = words.select(F.explode(F.array("first", F.concat("second", F.lit(" "), "first"))).alias("pattern"))
    return (
        pairs.join(patterns.select("pattern"), "pattern", "left_semi")
        .groupBy("pattern").agg(F.count("*").alias("total"))
    )


def _confident_patterns(docs: DataFrame, slots: DataFrame) -> DataFrame | None:
    """``pattern, score`` of the patterns to be trusted; none where no pattern could ever be."""
    edges = slots.select((F.col("kind") != FOUND).alias("seed"), F.lower("value").alias("value"), F.explode("patterns").alias("pattern"))
    edges = store(edges.groupBy("pattern", "value").agg(F.bool_or("seed").alias("seed"), F.count("*").alias("n")))
    known = edges.groupBy("pattern").agg(
        F.count("*").alias("values"), F.bool_or("seed").alias("seed"), F.sum("n").alias("n")
    ).where(F.col("values") >= SUPPORT)
    known = store(known)
    # Without any seed all scores stay 0.
    if known.where("seed").isEmpty():
        return None
    totals = store(
        _occurrences(docs, known).join(known.select("pattern", "n", F.col("seed").alias("seeded")), "pattern").where(F.col("n") >= CONFIDENT * F.col("total"))
    )
    if totals.isEmpty():
        return None
    label = F.substring_index("pattern", " ", -1).alias("label")
    graph = store(edges.join(totals.select("pattern", "total", "seeded", label), "pattern"))
    patterns, turn, trusted, before = totals.select("pattern", F.lit(0.0).alias("score")), 0, 0, 0
    while turn < ROUNDS or trusted > before:
        wrong = F.sum(F.log(F.lit(1.0) - F.col("score") + 1e-9))
        by_label = graph.join(patterns, "pattern").groupBy("value", "label").agg(wrong.alias("own"), F.bool_or("seed").alias("sure"))
        by_label = store(by_label)
        by_value = by_label.groupBy("value").agg(F.sum("own").alias("all"), F.bool_or("sure").alias("sure"))
        # What all labels of an instance say of it, and what the others do.
        scored = by_label.drop("sure").join(by_value, "value").select(
            "value", "label", *[
                F.when(F.col("sure"), F.lit(1.0)).otherwise(F.greatest(1 - F.exp(said), F.lit(0.0))).alias(name)
                for name, said in (("score", F.col("all")), ("others", F.col("all") - F.col("own")))
            ],
        )
        led, vouched = (F.sum(F.col("n") * F.col(c)) / F.first("total") for c in ("score", "others"))
        score = F.when(F.first("seeded") | (vouched >= INDUCED), F.least(led, F.lit(1.0))).otherwise(0.0)
        patterns = store(graph.join(scored, ["value", "label"]).groupBy("pattern").agg(score.alias("score")))
        turn, before, trusted = turn + 1, trusted, patterns.where(F.col("score") >= CONFIDENT).count()
    return patterns.where(F.col("score") >= CONFIDENT)


def spans(docs: DataFrame) -> DataFrame:
    """``doc, doc_id, kind, start, end, value`` of all base spans and of the identifiers found."""
    slots = store(_slots(_matches(docs)))
    base = slots.where(F.col("kind") != FOUND)
    trusted = _confident_patterns(docs, slots)
    if trusted is not None:
        led = slots.where(F.col("kind") == FOUND).select("*", F.explode("patterns").alias("pattern"))
        found = led.join(trusted.select("pattern"), "pattern", "left_semi").drop("pattern").distinct()
        base = base.union(found)
    return base.drop("patterns")


def report(docs: DataFrame) -> DataFrame:
    """Per row the counts of base kinds, a checksum of the base spans, and all spans as text."""
    order = F.array_position(F.lit([*KINDS, FOUND]), F.col("kind"))
    each = spans(docs).select("doc", "doc_id", F.struct(
        order.alias("order"), F.col("start"), F.concat_ws(":", "kind", "start", "end").alias("text")
    ).alias("span"))
    counts = [F.count_if(F.col("span.order") == i + 1).alias(f"n_{kind}") for i, kind in enumerate(KINDS)]
    found = each.groupBy("doc", "doc_id").agg(*counts, F.array_sort(F.collect_list("span")).alias("list"))
    found = found.withColumnRenamed("doc", "_doc").withColumnRenamed("doc_id", "_id")
    rows = _identity(docs).drop("text").join(found, (F.col("doc") == F.col("_doc")) & F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    empty = F.array().cast("array<string>")
    base = F.coalesce(F.transform(F.filter("list", lambda s: s["order"] <= len(KINDS)), lambda s: s["text"]), empty)
    every = F.coalesce(F.transform("list", lambda s: s["text"]), empty)
    return rows.select(
        "doc_id", *[F.coalesce(f"n_{kind}", F.lit(0)).cast("bigint").alias(f"n_{kind}") for kind in KINDS],
        F.sha2(F.concat_ws(",", base).cast("binary"), 256).alias("base_sha256"), F.concat_ws(",", every).alias("spans"),
    )


def redact(docs: DataFrame) -> DataFrame:
    """All rows and columns, with every span replaced by its kind in brackets; ``n_chars`` follows if there is one.

    Where spans overlap, the one that begins first covers them.
    """
    row = Window.partitionBy("doc", "doc_id").orderBy("start", F.desc("end"), "kind").rowsBetween(Window.unboundedPreceding, -1)
    covered = spans(docs).select("*", F.coalesce(F.max("end").over(row), F.lit(0)).alias("after")).groupBy("doc", "doc_id").agg(
        F.array_sort(F.collect_list(F.struct("start", "end", "kind", "after"))).alias("_spans")
    ).select(F.col("doc").alias("_doc"), F.col("doc_id").alias("_id"), "_spans")
    doc = F.xxhash64(docs["doc_id"], docs["text"])
    rows = docs.join(covered, (doc == covered["_doc"]) & docs["doc_id"].eqNullSafe(covered["_id"]), "left")
    text = docs["text"]

    def piece(span: Column) -> Column:
        # Text since the spans before, then the kind; a span that begins inside an earlier one adds nothing of its own.
        kept = F.substr(text, (span["after"] + 1).cast("int"), F.greatest(span["start"] - span["after"], F.lit(0)).cast("int"))
        tag = F.when(span["start"] >= span["after"], F.concat(F.lit("["), F.upper(span["kind"]), F.lit("]"))).otherwise("")
        return F.concat(kept, tag)

    found = covered["_spans"]
    last = F.array_max(F.transform(found, lambda s: s["end"]))
    rest = F.substr(text, (last + 1).cast("int"))
    new = F.when(found.isNull(), text).otherwise(F.concat(F.array_join(F.transform(found, piece), ""), rest))
    columns = [new.alias(c) if c == "text" else docs[c] for c in docs.columns]
    redacted = rows.select(*columns)
    if "n_chars" in docs.columns:
        redacted = redacted.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return redacted
