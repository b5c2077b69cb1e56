"""Quality rules by compression bands.

Repetitive text compresses too well and noise too badly. Zstandard ratios are taken of every text: of the whole,
and of each of its fixed chunks of ``CHUNK`` bytes. The best and the worst chunk are judged, so that a part that is
noise or repetition counts however much clean text stands around it. How well clean prose compresses depends on its
length, since a short text has had little time to repeat anything: each ratio has its own lower and upper limit per
band of lengths, a little beyond what clean text of that length reaches.

Base counts are worked out beside it and can reject by themselves. Words are runs of characters other than
ASCII white space. Null and empty texts have no words and are rejected. Copies get equal answers, an empty
table gives no rows, and further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame

from .common import map_rows

LEVEL = 3
CHUNK = 2048
#: Bytes up to which a band reaches, then lowest and highest compressed share of the whole and of any chunk.
BANDS = (
    (192, 0.40, 0.93, 0.40, 0.93),
    (256, 0.40, 0.88, 0.40, 0.88),
    (384, 0.40, 0.78, 0.40, 0.78),
    (512, 0.40, 0.74, 0.40, 0.74),
    (768, 0.40, 0.72, 0.40, 0.72),
    (1024, 0.40, 0.68, 0.40, 0.68),
    (2048, 0.38, 0.61, 0.38, 0.61),
    (8192, 0.34, 0.55, 0.36, 0.60),
    (float("inf"), 0.25, 0.50, 0.36, 0.60),
)
LEAST_WORDS, REPEATED_PERCENT, SPAN = 20, 30, 8

_SYMBOLS = re.compile(rb"[#*$%&|<>]")
_SPACE = b" \t\n\r\x0b\x0c"


def repeated_words(words: list[bytes], span: int = SPAN) -> int:
    """Words inside windows of ``span`` words that occur at least twice, first occurrence included.

    Windows are named exactly: numbers of pairs, then of pairs of pairs, and so on; ``span`` is a power of two.
    """
    if len(words) <= span:
        return 0
    known: dict[bytes, int] = {}
    names = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    size, counts = 1, None
    while size < span:
        pairs = names[:-size] * len(words) + names[size:]
        _, names, counts = np.unique(pairs, return_inverse=True, return_counts=True)
        size *= 2
    starts = np.flatnonzero(counts[names] > 1)
    edge = np.zeros(len(words) + 1, np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + span, -1)
    return int(np.count_nonzero(np.cumsum(edge)))


def measures(text: bytes) -> tuple[int, int, int, int, int]:
    """Words, code points in them, symbols, lines equal to an earlier one, words in repeated windows."""
    words = text.split()
    characters = sum(map(len, words))
    if not text.isascii():  # without the second and later bytes of characters
        codes = np.frombuffer(b"".join(words), np.uint8)
        characters -= int(np.count_nonzero((codes & 0xC0) == 0x80))
    lines = [line for line in text.split(b"\n") if line.strip(_SPACE)]
    return len(words), characters, len(_SYMBOLS.findall(text)), len(lines) - len(set(lines)), repeated_words(words)


def compressed_shares(text: bytes, compressor) -> tuple[float, float, float, float]:
    """Compressed size as a share of the text: of the whole, and the mean, least and most over its chunks.

    A last chunk shorter than half of ``CHUNK`` is part of the one before.
    """
    whole = len(compressor.compress(text)) / len(text)
    count = max(1, (len(text) + CHUNK // 2) // CHUNK)
    if count == 1:
        return whole, whole, whole, whole
    ends = [CHUNK * i for i in range(count)] + [len(text)]
    shares = [len(compressor.compress(text[a:b])) / (b - a) for a, b in zip(ends, ends[1:], strict=False)]
    return whole, sum(shares) / count, min(shares), max(shares)


def in_band(length: int, whole: float, least: float, most: float) -> bool:
    _, low, high, chunk_low, chunk_high = next(band for band in BANDS if length <= band[0])
    return low <= whole <= high and chunk_low <= least and most <= chunk_high


def judge(docs: DataFrame) -> DataFrame:
    """Base counts, compressed shares and the verdict for every row of ``doc_id, text``."""

    def make():
        import zstandard

        compressor = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)

        def step(doc_ids, texts) -> Iterator[tuple]:
            for doc_id, text in zip(doc_ids, texts, strict=True):
                text = text or b""
                words, characters, symbols, lines, repeated = measures(text)
                failed = words < LEAST_WORDS or 100 * repeated > REPEATED_PERCENT * words
                whole, mean, least, most = compressed_shares(text, compressor) if text else (None,) * 4
                kept = not failed and in_band(len(text), whole, least, most)
                yield doc_id, words, characters, symbols, lines, repeated, failed, whole, mean, least, most, kept

        return step

    return map_rows(
        docs.select("doc_id", "text"), make,
        "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
        "n_repeat_words bigint, base_failed boolean, whole_share double, chunk_share double, "
        "least_chunk_share double, most_chunk_share double, kept boolean",
        binary=("text",),
    )
