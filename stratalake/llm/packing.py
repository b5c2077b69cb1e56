"""Packing documents into training sequences by minimum bin slack.

Every document becomes tokens and an end id; what fills a whole window is cut off, and the remainders are put
together. The number of remainders per length is all the plan needs, and it has at most ``window`` rows however
many documents there are. The plan picks, for one window at a time, the largest remainder left and the
multiset of others that comes closest to the rest of the window (a subset-sum table of bits, one shift per
length and power of two of its count, walked back to the counts used), and repeats that window as often as the
counts allow. Pieces are then numbered in order of length, spread over all tasks, and look their place up by
number.

Null text counts as empty: such a document is its end id alone. Rows with the same id, or with none, are
separate documents. An empty table gives no rows. Further columns are ignored.
"""

from __future__ import annotations

import sys
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.keys import dense_key
from ..sources.workspace import store
from .common import in_small_batches

if sys.byteorder != "little" or array("I").itemsize != 4:
    raise ImportError("ids are read as little-endian 32-bit numbers")

WINDOW = 4096
END_ID = 2
#: Words whose ids a task remembers; beyond that only those used last stay.
REMEMBERED = 400_000

PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


class ChunkIds:
    """Chunk of text without white space -> its ids as little-endian 32-bit bytes.

    White space separates tokens and leaves none, so a text's ids are those of its chunks in a row. For
    chunks of Latin-1 characters the tokenizer's own steps are taken one by one, which lets the ids of
    a word be remembered whatever punctuation or case it comes with; any other chunk is encoded whole.
    """

    def __init__(self, tokenizer_path: str):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.tokenizer.encode_special_tokens = True
        self.tokenize = self.tokenizer.model.tokenize
        self.words: dict[str, bytes] = {}
        self.earlier: dict[str, bytes] = {}  # what was used last before the memory was full
        # How the tokenizer splits a chunk, and the characters it reads single bytes as.
        self.split = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+").findall
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in printable]
        self.bytes_as = {b: b for b in printable} | {b: 256 + i for i, b in enumerate(hidden)}
        # ASCII letters and marks, and Latin-1 letters; control and other blank characters are left to the tokenizer.
        self.simple = regex.compile("[\x21-\x7e\xa1-\xac\xae-\xff]*").fullmatch

    def of(self, chunk: str) -> bytes:
        lower = chunk.lower()
        word, mark = (lower, "") if lower[-1:].isalpha() else (lower[:-1], lower[-1:])
        if word.isalpha() and word.isascii() and (not mark or mark in ".,;:!?"):
            return self.word(word) + (self.word(mark) if mark else b"")
        if self.simple(chunk) and "<|" not in chunk:
            return b"".join(map(self.word, self.split(lower)))
        return array("I", self.tokenizer.encode(chunk, add_special_tokens=False).ids).tobytes()

    def word(self, word: str) -> bytes:
        ids = self.words.get(word)
        if ids is None:
            ids = self.earlier.get(word)
            if ids is None:
                symbols = word if word.isascii() else word.encode().decode("latin-1").translate(self.bytes_as)
                ids = array("I", [token.id for token in self.tokenize(symbols)]).tobytes()
            if len(word) <= 64:
                self.words[word] = ids
                if len(self.words) >= REMEMBERED:
                    self.earlier, self.words = self.words, {}
        return ids

    def of_texts(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text; every different chunk is looked at once."""
        chunks = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        ends = chunks.offsets.to_numpy()
        named = chunks.flatten().dictionary_encode()
        number = named.indices.to_numpy(zero_copy_only=False)
        ids = [self.of(chunk) for chunk in named.dictionary.to_pylist()]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        flat, starts = np.frombuffer(b"".join(ids), "<u4"), np.cumsum(sizes) - sizes
        ends = ends - ends[0]
        for i in range(len(ends) - 1):
            used = number[ends[i] : ends[i + 1]]
            size = sizes[used]
            upto = np.cumsum(size)
            yield flat[np.repeat(starts[used] - upto + size, size) + np.arange(upto[-1] if len(upto) else 0)]


def pieces(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, with_ids: bool = False) -> DataFrame:
    """Documents cut into whole windows and a remainder, each with its place in the document and a checksum.

    ``with_ids`` adds the ids themselves.
    """
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", *["ids"] * with_ids]
    types = [pa.int64()] * 5 + [pa.list_(pa.int64())] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = ChunkIds(tokenizer_path)
        end = np.array([END_ID], "<u4")
        for batch in batches:
            rows = []
            for doc_id, ids in zip(batch.column(0).to_pylist(), chunks.of_texts(batch.column(1)), strict=True):
                ids = np.concatenate([ids, end])
                for start in range(0, len(ids), window):
                    part = ids[start : start + window]
                    row = (doc_id, start, len(part), zlib.crc32(part), len(ids))
                    rows.append((*row, part) if with_ids else row)
            if rows:
                columns = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names
                )

    schema = PIECES + (", ids array<bigint>" if with_ids else "")
    return in_small_batches(docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))).mapInArrow(run, schema)


def closest(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """Lengths and how many of each to take so that their sum comes closest to the capacity from below."""
    mask, sums, layers = (1 << (capacity + 1)) - 1, 1, []
    for length in sorted((n for n in counts if n <= capacity), reverse=True):
        left, share = min(counts[length], capacity // length), 1
        while left > 0 and not sums >> capacity & 1:
            take = min(share, left)
            layers.append((length, take, sums))
            sums |= sums << (length * take) & mask
            left, share = left - take, 2 * share
        if sums >> capacity & 1:
            break
    at, used = sums.bit_length() - 1, {}
    for length, take, before in reversed(layers):
        if not before >> at & 1:
            used[length] = used.get(length, 0) + take
            at -= length * take
    return used


def plan_windows(counts: dict[int, int], window: int = WINDOW) -> list[tuple[dict[int, int], int]]:
    """Windows to fill as ``({length: pieces in the window}, how many such windows)``; uses every piece once."""
    left, plan = {n: c for n, c in counts.items() if c > 0}, []
    lengths = sorted(left)
    while lengths:
        largest = lengths[-1]
        left[largest] -= 1
        content = closest({n: c for n, c in left.items() if c > 0}, window - largest)
        left[largest] += 1
        content[largest] = content.get(largest, 0) + 1
        times = min(left[n] // c for n, c in content.items())
        for n, c in content.items():
            left[n] -= c * times
            if not left[n]:
                del left[n]
                lengths.remove(n)
        plan.append((content, times))
    return plan


def _places(counts: dict[int, int], window: int) -> np.ndarray:
    """Rows ``first number, first sequence, pieces per sequence, first offset, length`` by ascending number."""
    number, at = {}, 0
    for length in sorted(counts):
        number[length], at = at, at + counts[length]
    rows, sequence = [], 0
    for content, times in plan_windows(counts, window):
        offset = 0
        for length in sorted(content, reverse=True):
            rows.append((number[length], sequence, content[length], offset, length))
            number[length] += content[length] * times
            offset += content[length] * length
        sequence += times
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def pack(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, with_ids: bool = False) -> DataFrame:
    """Pieces with the sequence they are in and their offset there."""
    cut = store(pieces(docs, tokenizer_path, window, with_ids))
    # At most ``window`` lengths, whatever the input.
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    places = _places(counts, window)
    numbered = dense_key(cut, ["length", "doc_id", "start"], "_number", store)
    numbered = numbered.select(*[F.col(c) for c in cut.columns], "_number")
    schema = ", ".join(f"{n} {t}" for n, t in cut.dtypes) + ", sequence_id bigint, offset bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts = places[:, 0]
        for batch in batches:
            number = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False).astype(np.int64) - 1
            found = places[np.searchsorted(firsts, number, side="right") - 1]
            nth = number - found[:, 0]
            columns = [*batch.columns[:-1], pa.array(found[:, 1] + nth // found[:, 2]),
                       pa.array(found[:, 3] + nth % found[:, 2] * found[:, 4])]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-1], "sequence_id", "offset"])

    return numbered.mapInArrow(run, schema)


def sequences(packed: DataFrame, window: int = WINDOW) -> DataFrame:
    """Packed pieces with ids -> ``sequence_id, ids, length, padded``: the training sequences.

    A sequence is padded to the window unless its length is a power of two.
    """
    joined = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda p: p["ids"]))
    rows = packed.groupBy("sequence_id").agg(joined.alias("ids"), F.sum("length").alias("length"))
    power = F.bit_count("length") == 1
    return rows.withColumn("padded", F.when(power, F.col("length")).otherwise(F.lit(window).cast("long")))
