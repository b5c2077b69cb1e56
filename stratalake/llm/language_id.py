"""Language identification: averaged hashed subword embeddings and a linear softmax.

A text is lower-cased and every run of bytes that are no letters becomes one word end. Its windows of two,
three and four bytes are hashed to buckets; the text is the mean of their embeddings, and a linear layer with
softmax names the language. Embeddings and layer are trained by stochastic gradient descent in numpy on a
bounded sample of labelled rows (``TRAIN_ROWS``, those with the smallest hashes). A fifth of the sample
calibrates: a temperature makes the probabilities honest, and a text is rejected when its probability is below
that of all but ``REJECT_SHARE`` of the calibration texts (never above one half).

As mean and layer are linear, a trained model is one table of scores per bucket, a few hundred KB whatever the
input. Texts are read whole. A null text, or one without a letter, is ``und`` with score 0 and is rejected; so
is every text if no labelled row was there to learn from. Copies get equal answers. Further columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep_rows, map_rows

BUCKETS, DIMENSIONS = 1 << 13, 16
TRAIN_ROWS = 2_500
STEPS, BATCH, RATE = 800, 64, 0.5
REJECT_SHARE = 0.001
UNKNOWN = "und"

_LETTERS = re.compile(r"[^\W\d_]")
#: ASCII letters and all bytes of longer characters stay; anything else ends a word.
_KEPT = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


class Model(NamedTuple):
    languages: list[str]
    scores: np.ndarray  # bucket x language
    bias: np.ndarray
    temperature: float
    least: float  # probability below which a text is rejected


def subwords(text: str) -> np.ndarray:
    """Share of each bucket among the hashed windows of a text (float32, sums to 1, all 0 without a window)."""
    read = b" " + b" ".join(text.lower().encode().translate(_KEPT).split()) + b" "
    codes = np.frombuffer(read, np.uint8).astype(np.uint32)
    seen = np.zeros(BUCKETS, np.int64)
    window = codes
    for size in (2, 3, 4):
        if len(codes) < size:
            break
        window = window[:-1] * np.uint32(257) + codes[size - 1 :]
        mixed = (window + np.uint32(size * 0x51ED)) * np.uint32(2654435761)
        seen += np.bincount(mixed >> np.uint32(32 - 13), minlength=BUCKETS)
    total = seen.sum()
    return (seen / max(total, 1)).astype(np.float32)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


class Shares(NamedTuple):
    """Rows of ``subwords`` without their zeros: row ``i`` has the entries ``starts[i]`` to ``starts[i + 1]``."""

    starts: np.ndarray
    buckets: np.ndarray
    shares: np.ndarray

    def rows(self, wanted: np.ndarray) -> np.ndarray:
        """The wanted rows in full. Only a batch is ever spread out."""
        size = self.starts[wanted + 1] - self.starts[wanted]
        upto = np.cumsum(size)
        at = np.repeat(self.starts[wanted] - upto + size, size) + np.arange(upto[-1] if len(upto) else 0)
        out = np.zeros((len(wanted), BUCKETS), np.float32)
        out[np.repeat(np.arange(len(wanted)), size), self.buckets[at]] = self.shares[at]
        return out


def fit(features: Shares, labels: list[str], seed: int = 1) -> Model:
    """Train and calibrate on rows of ``subwords`` and their languages."""
    languages = sorted(set(labels))
    y = np.array([languages.index(x) for x in labels])
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(y))
    held = order[: len(y) // 5]
    rows = order[len(held) :]
    embeddings = rng.normal(0, 0.1, (BUCKETS, DIMENSIONS)).astype(np.float32)
    layer = rng.normal(0, 0.1, (DIMENSIONS, len(languages))).astype(np.float32)
    bias = np.zeros(len(languages), np.float32)
    for step in range(STEPS):
        at = step * BATCH % max(len(rows) - BATCH + 1, 1)
        if step * BATCH % len(rows) < BATCH:
            rng.shuffle(rows)
        part = rows[at : at + BATCH]
        rate = RATE * (1 - step / STEPS)
        x = features.rows(part)
        mean = x @ embeddings
        error = _softmax(mean @ layer + bias)
        error[np.arange(len(part)), y[part]] -= 1
        error /= len(part)
        back = error @ layer.T
        layer -= rate * (mean.T @ error)
        bias -= rate * error.sum(axis=0)
        # A bucket is a small part of a mean, so its embedding takes longer steps.
        embeddings -= rate * 50 * (x.T @ back)
    scores = embeddings @ layer
    held = held if len(held) else rows
    logits = np.concatenate([features.rows(held[i : i + BATCH]) @ scores for i in range(0, len(held), BATCH)]) + bias

    def loss(temperature: float) -> float:
        return -float(np.mean(np.log(_softmax(logits / temperature)[np.arange(len(held)), y[held]] + 1e-12)))

    temperature = min(np.geomspace(0.05, 20, 60), key=loss)
    best = np.sort(_softmax(logits / temperature).max(axis=1))
    least = min(0.5, float(best[math.floor(REJECT_SHARE * len(best))]))
    return Model(languages, scores.astype(np.float32), bias, float(temperature), least)


def train(labelled: DataFrame, rows: int = TRAIN_ROWS) -> Model | None:
    """A model from columns ``text`` and ``lang``; rows without a language or a letter teach nothing."""
    usable = labelled.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    # The sample is found by hashes alone, so that no text but its own is moved. Equal hashes are equal rows.
    mark = F.xxhash64("text", "doc_id")
    last = usable.select(mark.alias("h")).orderBy("h").limit(rows).agg(F.max("h")).first()[0]
    if last is None:
        return None

    def make():
        def step(texts, langs) -> Iterator[tuple]:
            for text, lang in zip(texts, langs, strict=True):
                share = subwords(text)
                used = np.flatnonzero(share)
                yield used, share[used], lang

        return step

    sample = usable.where(mark <= last).select("text", "lang")
    found = map_rows(sample, make, "buckets array<smallint>, shares array<float>, lang string").limit(rows).toArrow().combine_chunks()
    starts = np.concatenate([[0], np.cumsum(found["buckets"].combine_chunks().value_lengths().to_numpy())]).astype(np.int64)
    buckets, shares = (found[name].combine_chunks().flatten().to_numpy() for name in ("buckets", "shares"))
    return fit(Shares(starts, buckets, shares), found["lang"].to_pylist())


def classify(text: str | None, model: Model | None) -> tuple[str, float, bool]:
    """Language, calibrated probability, and whether the text is rejected."""
    if model is None or not text or not _LETTERS.search(text):
        return UNKNOWN, 0.0, True
    p = _softmax((subwords(text) @ model.scores + model.bias) / model.temperature)
    best = int(p.argmax())
    return model.languages[best], float(p[best]), bool(p[best] < model.least)


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id, lang_pred, score, rejected`` of every row."""

    def make():
        def step(doc_ids, texts) -> Iterator[tuple]:
            for doc_id, text in zip(doc_ids, texts, strict=True):
                yield doc_id, *classify(text, model)

        return step

    return map_rows(docs.select("doc_id", "text"), make, "doc_id bigint, lang_pred string, score double, rejected boolean")


def keep_known(docs: DataFrame, model: Model | None) -> DataFrame:
    """The rows, with all their columns, that the classifier does not reject."""
    return keep_rows(docs, lambda: lambda texts: [not classify(text, model)[2] for text in texts], ("text",))
