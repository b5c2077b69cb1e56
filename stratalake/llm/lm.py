"""Scoring texts with a log-bilinear neural model trained by noise-contrastive estimation.

The model's symbols are the ``WORDS`` commonest training words, the end of a text, and ``BUCKETS`` endings that
stand for all other words. There is one log-bilinear model over the ``LAGS`` words before a token: the vectors of the
context words, each times the matrix of its place, add up to what is predicted, and that times the vector of a word,
plus the word's bias, is the word's score. A softmax over all symbols makes the scores log-probabilities. As the
places add up in the exponent, the sum under the softmax is a product of two matrices, worked out once for every
pair of context words.

The model learns from the whole training corpus, as counts of two context words and the word after them, which Spark
sums; they grow with the corpus up to symbols cubed. They are dealt out by their contexts into ``PARTS``,
or fewer where a part would have less than ``STEPS`` blocks of ``BLOCK`` contexts, and move as sorted arrays. In each of
``ROUNDS`` every part takes steps from the common parameters over all its contexts, in numpy, and a task averages
what the parts return, weighted by what each has seen. The noise term of the estimation objective is worked out for
every noise word rather than sampled.

A word behind a bucket has the bucket's probability times its share of the bucket (one is added to each count
and to one unseen word), so every text has a probability. The counts of the ``FREQUENT`` commonest words travel
with the tasks; rarer ones, which no few words dominate, are joined.

Words are runs of characters other than ASCII white space, A-Z lower-cased, then one end per text. Null text
counts as empty: one token. Each row of the table is a text of its own, also with a repeated or null id.
Without training rows all probabilities are 1 / number of symbols, and base scores are 0. Further columns are
ignored.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.workspace import store
from .common import LOWER_BYTES, in_small_batches, map_rows

WORDS, BUCKETS = 767, 256
END = b""  # no word is empty
LAGS = 2
FREQUENT = 1 << 16
DIMENSIONS, ROUNDS, RATE, NOISE = 32, 4, 0.03, 10
#: Parts of the contexts, contexts per step, and the least number of steps a part takes in a round.
PARTS, BLOCK, STEPS = 32, 512, 40
ENDING = 3  # bytes of a word that name its bucket
#: Entries a task gathers before it hands them on, and codes in a row of packed counts.
GATHERED = 300_000
#: Words whose symbol a task remembers; beyond that it starts anew.
REMEMBERED = 200_000
#: Tokens whose contexts, eight bytes each, a task gathers before it counts them.
CONTEXTS_GATHERED = 4_000_000


class Vocabulary(NamedTuple):
    words: dict[bytes, int]  # symbols 0 is the end, then words; buckets follow
    size: int

    def symbol(self, word: bytes) -> int:
        known = self.words.get(word)
        return len(self.words) + zlib.crc32(word[-ENDING:]) % BUCKETS if known is None else known


class Symbols(dict):
    """Symbols by word, worked out once for each word that is remembered."""

    def __init__(self, vocabulary: Vocabulary):
        self.symbol = vocabulary.symbol

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = found = self.symbol(word)
        return found


class Model(NamedTuple):
    vectors: np.ndarray  # symbol x dimension, as context
    targets: np.ndarray  # symbol x dimension, as word predicted
    lags: np.ndarray  # lag x dimension x dimension
    bias: np.ndarray

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per place what each context word adds to each word's score (the bias with the last), and log sums.

        The log-probability of ``w`` after ``a``, before which stands ``b``, is ``near[a, w] + far[b, w] - log_sum[a, b]``.
        """
        near, far = ((self.vectors @ lag) @ self.targets.T.astype(np.float64) for lag in self.lags)
        far = far + self.bias
        tops = near.max(axis=1, keepdims=True), far.max(axis=1, keepdims=True)
        log_sum = np.log(np.exp(near - tops[0]) @ np.exp(far - tops[1]).T) + tops[0] + tops[1].T
        return near, far, log_sum


def tokens(text: bytes | None) -> list[bytes]:
    return [*(text or b"").translate(LOWER_BYTES).split(), END]


def bucket_of(word: Column) -> Column:
    return F.crc32(F.substring(word.cast("binary"), -ENDING, ENDING)) % BUCKETS


def _gathered(texts: DataFrame, schema: str, count, emit) -> DataFrame:
    """Counts over a task's texts, handed on whenever there are many: ``count(text)`` gives keys."""
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).cast(pa.binary()):
                held.update(count(text.as_py()))
                if len(held) > GATHERED:
                    yield pa.RecordBatch.from_arrays(emit(held), names=names)
                    held.clear()
        if held:
            yield pa.RecordBatch.from_arrays(emit(held), names=names)

    return in_small_batches(texts.select("text")).mapInArrow(run, schema)


def word_counts(texts: DataFrame) -> DataFrame:
    """``word, n`` over all tokens; the end of a text is the empty word."""

    def emit(held: Counter) -> list[pa.Array]:
        return [pa.array(list(held), pa.binary()).cast(pa.string()), pa.array(list(held.values()), pa.int64())]

    return _gathered(texts, "word string, n bigint", tokens, emit).groupBy("word").agg(F.sum("n").alias("n"))


def _packed(part: int, codes: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows ``part, gaps, n`` of ascending codes, each with some of them: arrays move and compress better than rows."""
    for at in range(0, len(codes), GATHERED):
        gaps = np.diff(codes[at : at + GATHERED], prepend=np.int32(0))
        held = [gaps.tobytes()], [n[at : at + GATHERED].astype(np.int64).tobytes()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), *[pa.array(h, pa.binary()) for h in held]], names=["part", "gaps", "n"]
        )


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Part, codes and counts of each row that ``_packed`` has made."""
    for batch in batches:
        for part, gaps, n in zip(*(batch.column(c).to_pylist() for c in ("part", "gaps", "n")), strict=True):
            yield part, np.cumsum(np.frombuffer(gaps, np.int32), dtype=np.int32), np.frombuffer(n, np.int64)


def _added(pieces: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Pieces of codes and counts as one, every code once."""
    codes, n = map(np.concatenate, zip(*pieces, strict=True))
    order = np.argsort(codes, kind="stable")
    codes, n = codes[order], n[order]
    first = np.flatnonzero(np.diff(codes, prepend=np.int32(-1)))
    return codes[first], np.add.reduceat(n, first)


def packed_counts(texts: DataFrame, vocabulary: Vocabulary, parts: int = 1) -> DataFrame:
    """``part, gaps, n``: how often a word follows two others, as arrays in ascending order of their codes.

    A code is context * size + word, a context the word just before * size + the other; as there are at most 1,024
    symbols, it has 30 bits. Before the first word of a text stands the end of another. A part's contexts are its
    own, and one task has and writes all of it.
    """
    size = vocabulary.size

    def counted(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        codes, n = np.unique(np.concatenate(held), return_counts=True)
        part = ((codes // size).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) % np.uint64(parts)
        part = part.astype(np.uint16)
        order = np.argsort(part, kind="stable")
        ends = np.cumsum(np.bincount(part, minlength=parts))
        for number, rows in enumerate(np.split(order, ends[:-1])):
            yield from _packed(number, codes[rows], n[rows])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, filled, known = [], 0, Symbols(vocabulary)
        for batch in batches:
            for text in batch.column(0).cast(pa.binary()):
                words = tokens(text.as_py())
                symbols = np.zeros(LAGS + len(words), np.int32)
                symbols[LAGS:] = np.fromiter(map(known.__getitem__, words), np.int32, len(words))
                held.append((symbols[1:-1] * size + symbols[:-2]) * size + symbols[2:])
                filled += len(symbols)
                if filled > CONTEXTS_GATHERED:
                    yield from counted(held)
                    held, filled = [], 0
        if held:
            yield from counted(held)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for part, codes, n in _unpacked(batches):
            pieces = held.setdefault(part, [])
            pieces.append((codes, n))
            # Added up whenever what is new outgrows what is there, so that a task holds little more than the sum.
            if sum(len(c) for c, _ in pieces[1:]) > max(CONTEXTS_GATHERED, len(pieces[0][0])):
                held[part] = [_added(pieces)]
        for part in sorted(held):
            yield from _packed(part, *_added(held.pop(part)))

    schema = "part int, gaps binary, n binary"
    found = in_small_batches(texts.select("text")).mapInArrow(run, schema)
    return found.repartitionById(parts, F.col("part")).mapInArrow(add, schema)


def context_counts(texts: DataFrame, vocabulary: Vocabulary, parts: int = 1) -> DataFrame:
    """The rows ``context, word, n, part`` of ``packed_counts``."""
    size = vocabulary.size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, codes, n in _unpacked(batches):
            columns = codes // size, codes % size, n, np.full(len(codes), part, np.int32)
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns)], names=["context", "word", "n", "part"])

    return packed_counts(texts, vocabulary, parts).mapInArrow(run, "context int, word int, n bigint, part int")


class Part:
    """The counts of a part's contexts, held without their zeros."""

    def __init__(self, context: np.ndarray, word: np.ndarray, n: np.ndarray, size: int):
        self.names, self.row = np.unique(context, return_inverse=True)
        order = np.argsort(self.row, kind="stable")
        self.row, self.word, self.n, self.size = self.row[order], word[order], n[order].astype(np.float32), size
        self.starts = np.searchsorted(self.row, np.arange(len(self.names) + 1))

    def weights(self) -> np.ndarray:
        """How much each symbol counts as a context, by the root of how often each of its contexts occurs."""
        root = np.sqrt(np.bincount(self.row, self.n))
        places = [self.names // self.size, self.names % self.size]
        return sum(np.bincount(at, root, self.size) for at in places)

    def block(self, rows: np.ndarray) -> np.ndarray:
        out = np.zeros((len(rows), self.size), np.float32)
        length = self.starts[rows + 1] - self.starts[rows]
        at = np.repeat(self.starts[rows] - np.cumsum(length) + length, length) + np.arange(length.sum())
        out[np.repeat(np.arange(len(rows)), length), self.word[at]] = self.n[at]
        return out


def gradients(model: Model, context: np.ndarray, counts: np.ndarray, share: np.ndarray) -> list[np.ndarray]:
    """Of the noise-contrastive objective: a word that was seen is told from ``NOISE`` draws from the words' shares.

    Contexts count by the square root of how often they occur, so that common ones don't drown the others.
    """
    vectors, targets, lags, bias = model
    places = [context // len(targets), context % len(targets)]
    predicted = sum(vectors[at] @ lag for at, lag in zip(places, lags, strict=True))
    # The arrays of contexts by words are worked on in place: there are many steps, and making new ones costs most.
    odds = predicted @ targets.T
    odds += bias - np.log(NOISE * share)
    np.clip(odds, -30, 30, out=odds)
    np.exp(np.negative(odds, out=odds), out=odds)
    odds += 1
    np.reciprocal(odds, out=odds)
    weight = np.sqrt(counts.sum(axis=1, keepdims=True))
    push = counts / weight
    odds *= push + weight * (NOISE * share)
    push -= odds
    push /= weight.sum()
    back = push @ targets
    by_vector = np.zeros_like(vectors)
    for at, lag in zip(places, lags, strict=True):
        np.add.at(by_vector, at, back @ lag.T)
    return [by_vector, push.T @ predicted, np.stack([vectors[at].T @ back for at in places]), push.sum(axis=0)]


def improved(model: Model, part: Part, share: np.ndarray, rate: float, seed: int) -> Model:
    """The model after steps over all contexts of the part, each seen about equally often; steps follow Adam."""
    rng = np.random.default_rng(seed)
    parameters = [p.copy() for p in model]
    first, second = [np.zeros_like(p) for p in parameters], [np.zeros_like(p) for p in parameters]
    order, step = np.empty(0, np.int64), 0
    while step < STEPS or len(order):
        if not len(order):
            order = rng.permutation(len(part.names))
        rows, order, step = order[:BLOCK], order[BLOCK:], step + 1
        found = gradients(Model(*parameters), part.names[rows], part.block(rows), share)
        for p, g, m, v in zip(parameters, found, first, second, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Model(*parameters)


def _learner(model: Model, share: np.ndarray, seed: int, turn: int):
    """A round over the rows of a task; a part is in one task unless its file is larger than a split."""
    size = len(share)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for number, codes, n in _unpacked(batches):
            held.setdefault(number, []).append((codes // size, codes % size, n))
        for number in sorted(held):
            part = Part(*map(np.concatenate, zip(*held.pop(number), strict=True)), size)
            better = improved(model, part, share, RATE * (1 - turn / ROUNDS), seed * 1_000_003 + turn * PARTS + number)
            packed = [p.astype(np.float32).tobytes() for p in (*better, part.weights())]
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), *[pa.array([p], pa.binary()) for p in packed]],
                                             names=["part", *Model._fields, "weights"])

    return run


def _averaged(model: Model, found: list) -> Model:
    """The parts' parameters by weight; a context word's vector counts only where the word is a context."""
    weights = np.stack([np.frombuffer(r["weights"], np.float32) for r in found])
    whole = weights.sum(axis=1) / weights.sum()
    each = weights / np.maximum(weights.sum(axis=0), 1e-9)
    mixed = {}
    for name, old in zip(Model._fields, model, strict=True):
        parts = np.stack([np.frombuffer(r[name], np.float32).reshape(old.shape) for r in found])
        mixed[name] = np.einsum("p,p...->...", whole, parts).astype(np.float32)
        if name == "vectors":
            mixed[name] = np.where(each.any(axis=0)[:, None], np.einsum("ps,psd->sd", each, parts), old).astype(np.float32)
    return Model(**mixed)


def _averager(model: Model):
    """The parts' parameters, of which there are few, as one row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [row for batch in batches for row in batch.to_pylist()]
        if found:
            mixed = _averaged(model, sorted(found, key=lambda r: r["part"]))
            yield pa.RecordBatch.from_arrays([pa.array([p.tobytes()], pa.binary()) for p in mixed], names=list(Model._fields))

    return run


def estimate(counts: DataFrame, seen: np.ndarray, seed: int = 1) -> Model:
    """Noise-contrastive estimation from ``packed_counts``, by averaging what parts of the contexts learn.

    ``seen`` is how often each symbol occurs. The counts are dealt and written once; rounds read them where they are.
    A part has about a ``PARTS``-th of at most size squared contexts, each with at most size words.
    One task averages the parts' parameters, and the driver takes one set of them a round.
    """
    size = len(seen)
    share = ((seen + 1) / (seen + 1).sum()).astype(np.float32)
    rng = np.random.default_rng(seed)
    model = Model(
        rng.normal(0, 0.1, (size, DIMENSIONS)).astype(np.float32), rng.normal(0, 0.1, (size, DIMENSIONS)).astype(np.float32),
        np.stack([np.eye(DIMENSIONS, dtype=np.float32)] * LAGS), np.log(share),
    )
    mixed = ", ".join(f"{name} binary" for name in Model._fields)
    for turn in range(ROUNDS):
        learned = counts.mapInArrow(_learner(model, share, seed, turn), f"part int, {mixed}, weights binary")
        found = learned.repartition(1).mapInArrow(_averager(model), mixed).first()
        if found is None:
            break
        model = Model(*[np.frombuffer(p, np.float32).reshape(old.shape) for p, old in zip(found, model, strict=True)])
    return model


class Scorer(NamedTuple):
    """What a task needs, bounded by the parameters above."""

    vocabulary: Vocabulary
    model: Model
    frequent: dict[bytes, int]
    total: int  # training tokens
    distinct: int
    bucket_tokens: list[int]
    bucket_words: list[int]


def train(texts: DataFrame) -> tuple[Scorer, DataFrame]:
    """A scorer from all texts, and the table of word counts."""
    counts = store(word_counts(texts))
    ends = F.coalesce(F.sum(F.when(F.col("word") == "", F.col("n"))), F.lit(0))
    totals = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v"), ends.alias("ends")).first()
    commonest = counts.orderBy(F.desc("n"), "word").limit(FREQUENT).collect()
    frequent = {r["word"].encode(): r["n"] for r in commonest}
    words = [END, *[w for w in frequent if w != END][:WORDS]]
    vocabulary = Vocabulary({w: i for i, w in enumerate(words)}, len(words) + BUCKETS)
    # Where the words of the vocabulary end in the order of counts.
    last, least = (words[-1].decode(), frequent.get(words[-1], 0))
    inside = (F.col("word") == "") | (F.col("n") > least) | ((F.col("n") == least) & (F.col("word") <= last))
    rest = counts.where(~inside).groupBy(bucket_of(F.col("word")).alias("b"))
    bucket_tokens, bucket_words = [0] * BUCKETS, [0] * BUCKETS
    for r in rest.agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect():
        bucket_tokens[r["b"]], bucket_words[r["b"]] = r["n"], r["v"]
    # There are no more contexts than tokens or pairs of words; a part gets enough of them for a round of steps.
    contexts = min(totals["n"], (totals["v"] + 1) ** 2)
    parts = max(1, min(PARTS, math.ceil(contexts / (BLOCK * STEPS))))
    seen = np.array([totals["ends"], *[frequent[w] for w in words[1:]], *bucket_tokens], np.float64)
    model = estimate(store(packed_counts(texts, vocabulary, parts)), seen)
    return Scorer(vocabulary, model, frequent, totals["n"], totals["v"], bucket_tokens, bucket_words), counts


def _partly_scored(docs: DataFrame, scorer: Scorer) -> DataFrame:
    """Scores of the tokens whose counts a task has, and the words that are still to be looked up."""

    def make():
        vocabulary = scorer.vocabulary
        near, far, log_sum = scorer.model.tables()
        names = list(scorer.frequent)
        number = {w: i for i, w in enumerate(names)}
        counts = np.array([*scorer.frequent.values(), 0], np.float64)
        base = np.log10((counts + 1) / (scorer.total + scorer.distinct + 1))
        symbols = np.array([*map(vocabulary.symbol, names), 0], np.int64)
        n, v = np.array(scorer.bucket_tokens, np.float64), np.array(scorer.bucket_words, np.float64)
        outside = symbols >= len(vocabulary.words)
        within = np.where(outside, np.log10((counts + 1) / (n + v + 1)[(symbols - len(vocabulary.words)) % BUCKETS]), 0)
        base[-1] = within[-1] = 0
        place, key = TaskContext.get().partitionId() << 33, 0

        def step(doc_ids, texts) -> Iterator[tuple]:
            nonlocal key
            for doc_id, text in zip(doc_ids, texts, strict=True):
                words = tokens(text)
                ids = np.array([number.get(w, -1) for w in words])
                line = np.concatenate([np.zeros(LAGS, np.int64), symbols[ids]])
                unknown = np.flatnonzero(ids < 0)
                line[unknown + LAGS] = [vocabulary.symbol(words[i]) for i in unknown]
                b, a, w = line[:-2], line[1:-1], line[2:]
                p = float((near[a, w] + far[b, w] - log_sum[a, b]).sum())
                score = p / math.log(10) + float(within[ids].sum())
                rare = Counter(words[i].decode() for i in unknown)
                yield (place + key, doc_id, len(words), len(words) - len(unknown), float(base[ids].sum()), score,
                       list(rare), list(rare.values()))
                key += 1

        return step

    return map_rows(
        docs.select("doc_id", "text"), make,
        "key bigint, doc_id bigint, n_tokens bigint, n_known bigint, base_score double, score double, "
        "words array<string>, times array<bigint>",
        binary=("text",),
    )


def score(docs: DataFrame, scorer: Scorer, counts: DataFrame) -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score``; scores are log10 probabilities of texts."""
    partly = store(_partly_scored(docs, scorer))
    rare = partly.select("key", F.explode(F.arrays_zip("words", "times")).alias("w"))
    rare = rare.select("key", F.col("w.words").alias("word"), F.col("w.times").alias("times"))
    spread = F.lit([float(n + v + 1) for n, v in zip(scorer.bucket_tokens, scorer.bucket_words, strict=True)])
    seen = F.coalesce(F.col("n"), F.lit(0))
    looked_up = rare.join(counts, "word", "left").select(
        "key",
        F.when(seen > 0, F.col("times")).otherwise(0).alias("known"),
        (F.col("times") * F.log10((seen + 1) / F.lit(float(scorer.total + scorer.distinct + 1)))).alias("base"),
        (F.col("times") * F.log10((seen + 1) / F.get(spread, bucket_of(F.col("word")).cast("int")))).alias("within"),
    )
    added = looked_up.groupBy("key").agg(*[F.sum(c).alias(c) for c in ("known", "base", "within")])

    def plus(column: str, more: str) -> Column:
        return (F.col(column) + F.coalesce(F.col(more), F.lit(0))).alias(column)

    return partly.drop("words", "times").join(added, "key", "left").select(
        "doc_id", "n_tokens", plus("n_known", "known"), F.lit(scorer.total).cast("bigint").alias("train_tokens"),
        plus("base_score", "base"), plus("score", "within"),
    )
