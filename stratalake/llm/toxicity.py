"""Toxic spans by a linear-chain conditional random field.

A text is read as words (runs of letters); line ends and full stops end a sequence. Every word is clean or toxic. The
score of a word adds weights of its own features (the lower-cased word, its first three to seven and last two and
three letters) and of its left and right neighbour; transitions are weighted too. Weights are trained in numpy by
gradient descent on the exact likelihood of labelled sequences, whose gradient forward-backward gives. All sequences of
a batch are one chain in which a sequence start forgets what was before, and the recursions, which are fractions of
linear functions, are composed over blocks: long texts take no longer than short ones of the same total length.

Labels are given per document, so the labelled words are found first. In a bounded sample of labelled documents, a word
or word beginning is a marker if its places in toxic documents are more than chance could explain (binomial bound, over
all candidates). Places count by their neighbouring words, so copies of a text count once. Words with a marker in toxic
documents are labelled toxic, all others clean. Beginnings let the field find words it has never seen.

The marginals of a text give its score: the largest one and their sum go into a logistic function fitted on a part of
the sample the field has not seen, weighted back to the shares of all labelled documents. Offending spans are the runs
of words with a marginal of one half or more.

A null text counts as empty; a text without a word has no marginal and gets the score that goes with that. Without
a toxic and a clean labelled document there is no model, and every score is 0. Rows without a label teach nothing.
Copies get equal scores. Further columns are ignored.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from typing import NamedTuple
from zlib import crc32

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.workspace import store
from .common import map_rows

#: Labelled documents to learn from, those with the smallest hashes of either label; the only bound there is.
TOXIC_ROWS, CLEAN_ROWS = 1_500, 2_500
#: Sequences of a document that the field is trained on: with a marker, and without.
MARKED_SEQUENCES, OTHER_SEQUENCES = 8, 2
#: Words of a sequence around a marker that training looks at.
AROUND = 12
#: Letters of the beginnings and endings that are features.
BEGINNINGS, ENDINGS = (3, 4, 5, 6, 7), (2, 3)
BUCKETS = 1 << 16
_MASK, _BEGINS, _ENDED = BUCKETS - 1, 0x51ED, 0xA3D7
STEPS, RATE, PENALTY = 60, 0.5, 1e-4
#: A candidate is a marker if chance explains its places with less than this, divided by the number of candidates.
CHANCE = 0.01
#: Places in toxic documents below which a key is no candidate; so few are never beyond chance at usual shares.
LEAST_PLACES = 4
SPAN_MARGINAL, THRESHOLD = 0.5, 0.3
#: Words whose scores a task remembers, and positions of a block of the recursions.
REMEMBERED, BLOCK = 400_000, 64

#: Words, and the ends of sequences.
_PARTS = re.compile(r"[^\W\d_]+|[.!?\n]+")
_ENDS = ".!?\n"
_WORDS = re.compile(r"[^\W\d_]+")


class Field(NamedTuple):
    own: np.ndarray  # weight per bucket
    left: np.ndarray  # of the word to the left
    right: np.ndarray
    bias: float
    start: float  # of a sequence that starts toxic
    steps: np.ndarray  # 2 x 2 transition scores


class Model(NamedTuple):
    field: Field
    scorer: np.ndarray  # logistic weights: constant, largest marginal, sum of marginals


# --- features


def _buckets(word: str) -> list[int]:
    """Hashed features of a word, the whole word first."""
    letters, n = word.encode("utf-32-le"), len(word)
    found = [crc32(letters) & _MASK]
    found += [crc32(letters[: 4 * k], _BEGINS + k) & _MASK for k in BEGINNINGS if k <= n]
    found += [crc32(letters[-4 * k :], _ENDED + k) & _MASK for k in ENDINGS if k <= n]
    return found


def _keys(word: str) -> list[str]:
    """What may be a marker: the word, or its beginning."""
    return [f"={word}", *[f"^{word[:n]}" for n in BEGINNINGS if len(word) > n]]


def sequences(text: str | None) -> Iterator[list[str]]:
    """Lower-cased words of each sequence."""
    words: list[str] = []
    for part in _PARTS.findall(text or ""):
        if part[0] not in _ENDS:
            words.append(part.lower())
        elif words:
            yield words
            words = []
    if words:
        yield words


# --- recursions


def _chain(d: np.ndarray, c: np.ndarray, b: np.ndarray, a: np.ndarray, first: float) -> np.ndarray:
    """All of ``r[i] = (c[i] + d[i] * r[i-1]) / (a[i] + b[i] * r[i-1])``, composed over blocks."""
    n = len(d)
    blocks = -(-n // BLOCK)
    padded = []
    for part, fill in ((d, 1.0), (c, 0.0), (b, 0.0), (a, 1.0)):
        whole = np.full(blocks * BLOCK, fill)
        whole[:n] = part
        padded.append(np.ascontiguousarray(whole.reshape(blocks, BLOCK).T))
    d, c, b, a = padded
    m11, m12, m21, m22 = np.ones(blocks), np.zeros(blocks), np.zeros(blocks), np.ones(blocks)
    for t in range(BLOCK):
        m11, m21 = d[t] * m11 + c[t] * m21, b[t] * m11 + a[t] * m21
        m12, m22 = d[t] * m12 + c[t] * m22, b[t] * m12 + a[t] * m22
        size = np.maximum(np.maximum(m11, m12), np.maximum(m21, m22))
        m11, m12, m21, m22 = m11 / size, m12 / size, m21 / size, m22 / size
    starts, r = np.empty(blocks), first
    for k, (x, y, z, w) in enumerate(zip(m11.tolist(), m12.tolist(), m21.tolist(), m22.tolist(), strict=True)):
        starts[k] = r
        r = (x * r + y) / max(z * r + w, 1e-300)
    out, r = np.empty((BLOCK, blocks)), starts
    for t in range(BLOCK):
        r = (c[t] + d[t] * r) / (a[t] + b[t] * r)
        out[t] = r
    return out.T.ravel()[:n]


def forward_backward(emission: np.ndarray, begins: np.ndarray, start: float, steps: np.ndarray) -> tuple[np.ndarray, ...]:
    """Marginal of toxic at every place, and the forward and backward ratios toxic to clean.

    ``begins`` marks the places where a sequence starts.
    """
    n = len(emission)
    if not n:
        return np.zeros(0), np.zeros(0), np.zeros(0)
    e, s = np.exp(np.clip(emission, -30, 30)), np.exp(np.clip(start, -30, 30))
    t = np.exp(np.clip(steps - steps[0, 0], -30, 30))
    inner = ~begins
    forward = _chain(
        np.where(inner, e * t[1, 1], 0), np.where(inner, e * t[0, 1], e * s), np.where(inner, t[1, 0], 0), np.ones(n), 0.0
    )
    # From the right: the ratio at a place follows from the place after it, and is 1 where a sequence ends.
    ends = np.append(begins[1:], True)
    after = np.append(e[1:], 1.0)
    backward = _chain(*[
        x[::-1] for x in (
            np.where(ends, 0, t[1, 1] * after), np.where(ends, 1.0, t[1, 0]), np.where(ends, 0, t[0, 1] * after), np.ones(n)
        )
    ], 1.0)[::-1]
    odds = forward * backward
    return odds / (1 + odds), forward, backward


def _expected_steps(emission, begins, steps, forward, backward) -> np.ndarray:
    """Expected number of each transition."""
    after = np.flatnonzero(~begins)
    if not len(after):
        return np.zeros((2, 2))
    f, g = forward[after - 1], backward[after] * np.exp(np.clip(emission[after], -30, 30))
    t = np.exp(np.clip(steps - steps[0, 0], -30, 30))
    joint = np.stack([t[0, 0] * np.ones(len(f)), t[0, 1] * g, t[1, 0] * f, t[1, 1] * f * g])
    return (joint / joint.sum(axis=0)).sum(axis=1).reshape(2, 2)


# --- training


def fit_field(labelled: list[tuple[list[str], list[int]]]) -> Field:
    """Weights from sequences of words and their labels (1: toxic)."""
    words = sorted({w for sequence, _ in labelled for w in sequence})
    number = {w: i for i, w in enumerate(words)}
    ids = np.array([number[w] for sequence, _ in labelled for w in sequence])
    y = np.array([label for _, labels in labelled for label in labels], np.float64)
    begins = np.zeros(len(ids), bool)
    begins[np.cumsum([0, *[len(s) for s, _ in labelled[:-1]]])] = True
    buckets = [_buckets(w) for w in words]
    of_word = np.repeat(np.arange(len(words)), [len(b) for b in buckets])
    flat = np.array([x for b in buckets for x in b])
    own_word = np.array([b[0] for b in buckets])
    inner = np.flatnonzero(~begins)
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[inner - 1].astype(int), y[inner].astype(int)), 1)
    own, left, right = np.zeros(BUCKETS), np.zeros(BUCKETS), np.zeros(BUCKETS)
    rest = np.zeros(6)  # bias, start, the four transitions
    squares = [np.full(BUCKETS, 1e-8) for _ in range(3)] + [np.full(6, 1e-8)]
    for _ in range(STEPS):
        per_word = np.bincount(of_word, weights=own[flat], minlength=len(words))
        emission = per_word[ids] + rest[0]
        emission[inner] += left[own_word][ids[inner - 1]]
        emission[inner - 1] += right[own_word][ids[inner]]
        steps = rest[2:].reshape(2, 2)
        p, forward, backward = forward_backward(emission, begins, rest[1], steps)
        error = p - y
        g_own = np.bincount(flat, weights=np.bincount(ids, weights=error, minlength=len(words))[of_word], minlength=BUCKETS)
        g_left = np.bincount(own_word[ids[inner - 1]], weights=error[inner], minlength=BUCKETS)
        g_right = np.bincount(own_word[ids[inner]], weights=error[inner - 1], minlength=BUCKETS)
        expected = _expected_steps(emission, begins, steps, forward, backward)
        g_rest = np.concatenate([[error.sum(), error[begins].sum()], (expected - seen).ravel()])
        for weights, gradient, square in zip((own, left, right, rest), (g_own, g_left, g_right, g_rest), squares, strict=True):
            gradient = gradient / len(y) + PENALTY / 100 * weights
            square += gradient**2
            weights -= RATE * gradient / np.sqrt(square)
    return Field(own, left, right, float(rest[0]), float(rest[1]), rest[2:].reshape(2, 2).copy())


def _places(sample: DataFrame) -> DataFrame:
    """``toxic, key, place`` of the words and beginnings of all texts; a place is known by its left and right word."""

    def make():
        def step(texts, labels) -> Iterator[tuple]:
            for text, label in zip(texts, labels, strict=True):
                for words in sequences(text):
                    for left, word, right in zip(["", *words], words, [*words[1:], ""]):
                        yield label, word, f"{left} {right}"

        return step

    words = map_rows(sample.select("text", "toxic"), make, "toxic int, word string, near string")
    beginnings = [F.when(F.length("word") > n, F.concat(F.lit("^"), F.left("word", F.lit(n)))) for n in BEGINNINGS]
    keys = F.explode(F.array_compact(F.array(F.concat(F.lit("="), F.col("word")), *beginnings)))
    return words.select("toxic", keys.alias("key"), F.xxhash64("near").alias("place"))


def find_markers(sample: DataFrame) -> set[str]:
    """Keys with more places in toxic documents than chance explains, and most of their places there.

    The chance of ``k`` or more of ``n`` places in toxic documents is below ``exp(-n * divergence)``.
    """
    toxic = _places(sample.where("toxic = 1")).select("key", "place").distinct().groupBy("key").agg(F.count("*").alias("k"))
    toxic = store(toxic)
    wanted = toxic.where(F.col("k") >= LEAST_PLACES)
    clean = _places(sample.where("toxic = 0")).join(wanted.select("key"), "key", "left_semi")
    clean = clean.select("key", "place").distinct().groupBy("key").agg(F.count("*").alias("c"))
    totals = dict(map_rows(
        sample.select("text", "toxic"),
        lambda: lambda texts, labels: [(y, sum(map(len, sequences(t)))) for t, y in zip(texts, labels, strict=True)],
        "toxic int, n bigint",
    ).groupBy("toxic").agg(F.sum("n")).collect())
    if not totals.get(0) or not totals.get(1):
        return set()
    candidates, share = toxic.count(), totals[1] / (totals[0] + totals[1])
    n = F.col("k") + F.coalesce("c", F.lit(0))
    p = F.col("k") / n
    gain = n * (p * F.log(p / share) + F.when(p < 1, (1 - p) * F.log((1 - p) / (1 - share))).otherwise(0.0))
    sure = (p > max(share, 0.5)) & (gain > float(np.log(candidates / CHANCE)))
    return {r["key"] for r in wanted.join(clean, "key", "left").where(sure).select("key").collect()}


def _sample(docs: DataFrame, labels: DataFrame, toxic_rows: int, clean_rows: int) -> tuple[DataFrame, int, int]:
    """Sampled rows ``text, toxic, held`` and how many labels of either kind there are.

    The sample is drawn from the labels alone, so that no text but its own is moved; its bound is that of the
    broadcast. Copies in it are one row.
    """
    label = F.col("toxic").cast("int")
    usable = labels.where(F.col("toxic").isin(0, 1)).select("doc_id", label.alias("toxic"))
    totals = dict(usable.groupBy("toxic").agg(F.count("*")).collect())
    order = (F.xxhash64("doc_id", "toxic"), "doc_id")
    chosen = [
        usable.where(F.col("toxic") == which).orderBy(*order).limit(rows) for which, rows in ((1, toxic_rows), (0, clean_rows))
    ]
    ids = store(chosen[0].unionByName(chosen[1]))
    held = (F.pmod(F.xxhash64("text", F.lit("held")), F.lit(4)) == 0).alias("held")
    rows = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").where(F.col("text").isNotNull())
    return store(rows.select("text", "toxic", held).distinct()), totals.get(1, 0), totals.get(0, 0)


def train(
    docs: DataFrame, labels: DataFrame, toxic_rows: int = TOXIC_ROWS, clean_rows: int = CLEAN_ROWS
) -> Model | None:
    """A model from ``doc_id, text`` and the labels ``doc_id, toxic`` (0 or 1)."""
    sample, n_toxic, n_clean = _sample(docs, labels, toxic_rows, clean_rows)
    if not n_toxic or not n_clean:
        return None
    shown = sample.where("NOT held")
    markers = find_markers(shown)

    def make():
        def step(texts, labels) -> Iterator[tuple]:
            for text, label in zip(texts, labels, strict=True):
                yield from _training_sequences(text, label, markers)

        return step

    rows = map_rows(shown.select("text", "toxic"), make, "words array<string>, labels array<int>").collect()
    field = fit_field([(r["words"], r["labels"]) for r in rows]) if rows and markers else None
    if field is None:
        field = Field(*[np.zeros(BUCKETS)] * 3, -30.0, -30.0, np.array([[0.0, -30.0], [0.0, -30.0]]))
    measured = map_rows(
        sample.where("held").select("text", "toxic"), lambda: _measure(field, with_label=True), "toxic int, top double, total double"
    ).collect()
    weights = {1: n_toxic / max(sum(r["toxic"] for r in measured), 1), 0: n_clean / max(sum(1 - r["toxic"] for r in measured), 1)}
    return Model(field, fit_scorer([tuple(r) for r in measured], weights))


def _training_sequences(text: str, label: int, markers: set[str]) -> Iterator[tuple[list[str], list[int]]]:
    """Sequences with marked words, cut to their surroundings, and some without."""
    marked = others = 0
    for words in sequences(text):
        hits = [i for i, w in enumerate(words) if any(k in markers for k in _keys(w))]
        if hits and marked < MARKED_SEQUENCES:
            marked += 1
            low, high = max(hits[0] - AROUND, 0), hits[0] + AROUND + 1
            yield words[low:high], [int(label == 1 and i in hits) for i in range(low, min(high, len(words)))]
        elif not hits and others < OTHER_SEQUENCES:
            others += 1
            yield words[: 2 * AROUND], [0] * len(words[: 2 * AROUND])


def _features(top: np.ndarray, total: np.ndarray) -> np.ndarray:
    top = np.clip(top, 1e-4, 1 - 1e-4)
    return np.stack([np.ones(len(top)), np.log(top / (1 - top)), np.log1p(total)], axis=1)


def fit_scorer(rows: list[tuple[int, float, float]], weights: dict[int, float]) -> np.ndarray:
    """Logistic weights by Newton's method, with a slight penalty that keeps them finite."""
    if not any(y for y, _, _ in rows) or all(y for y, _, _ in rows):
        share = weights[1] / (weights[0] + weights[1])
        return np.array([np.log(share / (1 - share)), 0.0, 0.0])
    y, top, total = (np.array(c, np.float64) for c in zip(*rows, strict=True))
    x, w = _features(top, total), np.where(y == 1, weights[1], weights[0])
    w = w * len(w) / w.sum()
    beta, ridge = np.zeros(3), np.diag([1e-3, 1e-2, 1e-2])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (w * (p - y)) + ridge @ beta
        step = np.linalg.solve((x * (w * p * (1 - p))[:, None]).T @ x + ridge, gradient)
        beta = beta - np.clip(step, -2, 2)
    return beta


# --- scoring


def _measure(field: Field, with_label: bool = False, model: Model | None = None):
    """A function of texts that yields the largest marginal and the sum of marginals, or scores and spans."""
    own, left, right = (w.tolist() for w in (field.own, field.left, field.right))
    scores = array("d")  # own, as a left and as a right neighbour, of every word remembered

    class Numbers(dict):
        """Words as they are written, with their place in ``scores``; -1 for ends of sequences."""

        def __missing__(self, word: str) -> int:
            if word[0] in _ENDS:
                found = -1
            else:
                low = word.lower()
                at = _buckets(low)
                found = len(scores) // 3
                scores.extend((sum([own[x] for x in at]), left[at[0]], right[at[0]]))
            self[word] = found
            return found

    numbers = Numbers()

    def marginals(texts) -> list[np.ndarray]:
        """Per text the marginals of its words."""
        if len(numbers) > REMEMBERED:
            numbers.clear()
            del scores[:]
        ids: list[int] = []
        counts = []
        for text in texts:
            before = len(ids)
            ids += map(numbers.__getitem__, _PARTS.findall(text or ""))
            ids.append(-1)  # the end of a text ends a sequence as well
            counts.append(len(ids) - before)
        parts = np.array(ids)
        is_word = parts >= 0
        if not is_word.any():
            return [np.zeros(0) for _ in texts]
        at = np.flatnonzero(is_word)
        begins = np.ones(len(at), bool)
        begins[1:] = np.diff(at) > 1
        word = np.array(scores).reshape(-1, 3)[parts[at]]
        emission = word[:, 0] + field.bias
        inner = np.flatnonzero(~begins)
        emission[inner] += word[inner - 1, 1]
        emission[inner - 1] += word[inner, 2]
        p, _, _ = forward_backward(emission, begins, field.start, field.steps)
        of_text = np.repeat(np.arange(len(counts)), counts)[at]
        return np.split(p, np.searchsorted(of_text, np.arange(1, len(counts))))

    def measures(texts, labels) -> Iterator[tuple]:
        for p, label in zip(marginals(texts), labels, strict=True):
            yield label, float(p.max(initial=0.0)), float(p.sum())

    def step(doc_ids, texts) -> Iterator[tuple]:
        found = marginals(texts)
        top, total = np.array([p.max(initial=0.0) for p in found]), np.array([p.sum() for p in found])
        values = 1 / (1 + np.exp(-np.clip(_features(top, total) @ model.scorer, -30, 30)))
        for doc_id, text, p, value in zip(doc_ids, texts, found, values.tolist(), strict=True):
            yield doc_id, value, spans(text, p)

    return measures if with_label else step


def spans(text: str | None, marginal: np.ndarray) -> list[tuple[int, int, float]]:
    """Runs of toxic words as start, end (code points, exclusive) and largest marginal."""
    toxic = np.flatnonzero(marginal >= SPAN_MARGINAL)
    if not len(toxic):
        return []
    wanted, runs, last = set(toxic.tolist()), [], -2
    for i, found in enumerate(_WORDS.finditer(text)):
        if i in wanted:
            p = float(marginal[i])
            if last == i - 1 and not _PARTS.search(text[runs[-1][1] : found.start()]):
                runs[-1] = (runs[-1][0], found.end(), max(runs[-1][2], p))
            else:
                runs.append((*found.span(), p))
            last = i
    return runs


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id``, ``score``, and the offending ``spans`` (start, end, marginal) of every row."""
    schema = "doc_id bigint, score double, spans array<struct<start: int, end: int, marginal: double>>"
    if model is None:
        empty = F.array().cast("array<struct<start: int, end: int, marginal: double>>")
        return docs.select("doc_id", F.lit(0.0).alias("score"), empty.alias("spans"))

    def make():
        step = _measure(model.field, model=model)

        def rows(doc_ids, texts) -> Iterator[tuple]:
            for doc_id, value, found in step(doc_ids, texts):
                yield doc_id, value, [{"start": a, "end": b, "marginal": p} for a, b, p in found]

        return rows

    return map_rows(docs.select("doc_id", "text"), make, schema)
