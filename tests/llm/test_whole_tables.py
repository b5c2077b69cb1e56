"""The registered queries over whole tables against SQL, brute force, an exact round trip or held-out accuracy."""

from __future__ import annotations

import zlib
from collections import defaultdict

import brute
import corpus_pipeline
import numpy as np
import pytest
import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__ as registry
from stratalake.llm import queries
from tools import check

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]


def run(spark, name):
    return registry.queries()[name](spark, FOLDER)


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_registered():
    names = [n for n in registry.queries() if n.startswith("op")]
    assert [int(n[2:].split("_")[0]) for n in names] == list(range(1, 14))
    assert "pipeline" in registry.queries()
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None


@pytest.mark.parametrize("name", queries.oracle_sql())
def test_against_sql(spark, name):
    count, problem = check.compare(spark, check.connect(FOLDER), FOLDER, name)
    assert problem == "" and count > 0


def test_lm_scores(spark, documents):
    found = run(spark, "op1_lm_score").collect()
    want = {r[0]: r[1:] for r in brute.base_scores(documents)}
    assert len(found) == len(want)
    for r in found:
        held_out, n_tokens, n_known, train_tokens, base = want[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held_out, n_tokens, n_known, train_tokens)
        assert r["base_score"] == pytest.approx(base)
    held = [r for r in found if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_pii(spark, documents):
    columns = ("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")
    assert rows(run(spark, "op4_pii"), *columns) == sorted(brute.pii(documents))


def test_decontamination(spark, documents):
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    columns = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    want = sorted(brute.contamination(documents, items))
    assert rows(run(spark, "op5_decontaminate"), *columns) == want
    assert any(r[-1] for r in want)


def test_quality(spark, documents):
    found = run(spark, "op6_quality").collect()
    want = {i: brute.quality(t) for i, t in documents}
    for r in found:
        assert tuple(r)[1:7] == want[r["doc_id"]]
        assert not (r["base_failed"] and r["kept"])
    assert sum(r["kept"] for r in found) > 0.98 * sum(not r["base_failed"] for r in found)


def test_near_duplicates(spark, documents):
    columns = ("doc_id", "n_shingles", "component_id", "kept")
    assert rows(run(spark, "op7_near_dedup"), *columns) == sorted(brute.near_duplicates(documents))


def test_licences(spark, documents):
    notices = {
        "Licensed under CC BY-NC": "cc-by-nc", "GNU General Public License": "gpl", "Apache License": "apache-2.0",
        "MIT License": "mit", "All rights reserved": "proprietary",
    }
    text = dict(documents)
    found = run(spark, "op8_licences").collect()
    assert len(found) == len(text)
    for r in found:
        want = sorted(family for notice, family in notices.items() if notice in text[r["doc_id"]])
        assert r["families"] == ",".join(want)


def packed_right(found, texts, window=4096):
    """Every id is in exactly one piece, sequences have no gap and no more than a window."""
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tokenizer.encode_special_tokens = True
    ids = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for i, t in texts}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in found:
        assert r["doc_tokens"] == len(ids[r["doc_id"]])
        part = np.array(ids[r["doc_id"]][r["start"] : r["start"] + r["length"]], "<u4")
        assert zlib.crc32(part.tobytes()) == r["ids_crc32"]
        pieces[r["doc_id"]].append((r["start"], r["length"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert pieces.keys() == ids.keys()
    for i, spans in pieces.items():
        assert gapless(spans) == len(ids[i])
    filled = [gapless(spans) for spans in sequences.values()]
    assert max(filled) <= window
    return filled


def gapless(spans):
    at = 0
    for start, length in sorted(spans):
        assert start == at and length > 0
        at += length
    return at


def test_packing(spark, documents):
    filled = packed_right(run(spark, "op9_packing").collect(), documents)
    assert sum(filled) > 0.97 * 4096 * len(filled) or len(filled) - sum(f == 4096 for f in filled) <= 1


def test_language(spark, documents):
    found = run(spark, "op10_language_id").collect()
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    assert len(found) == len(truth)
    assert all(r["held_out"] == (brute.crc(r["doc_id"]) % 3 == 1) and 0 <= r["score"] <= 1 for r in found)
    held = [r for r in found if r["held_out"]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.95 * len(held)


def test_pipeline(spark):
    """Each stage against the plain version on what the stage before kept."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, stages = docs.columns, dict(corpus_pipeline.STAGES)
    kept = {r["doc_id"]: r for r in docs.collect()}

    def step(name):
        nonlocal docs
        docs = corpus_pipeline.store(stages[name](spark, docs, FOLDER))
        return docs.collect()

    after = step("language")
    assert docs.columns == columns
    assert len(after) >= 0.99 * len(kept) and all(tuple(kept[r["doc_id"]]) == tuple(r) for r in after)
    kept = {r["doc_id"]: r for r in after}
    want = {i for i, _, _, first in brute.near_duplicates([(i, r["text"]) for i, r in kept.items()]) if first}
    after = step("near_dedup")
    assert docs.columns == columns and {r["doc_id"] for r in after} == want and len(after) == len(want)
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    report = brute.contamination([(r["doc_id"], r["text"]) for r in after], items)
    kept = {r["doc_id"]: r for r in after}
    after = step("decontaminate")
    assert docs.columns == columns and sorted(r["doc_id"] for r in after) == sorted(r[0] for r in report if not r[-1])
    kept = {r["doc_id"]: r for r in after}
    after = step("pii")
    assert docs.columns == columns and len(after) == len(kept)
    for r in after:
        before = kept[r["doc_id"]]["text"]
        assert not brute.base_spans(r["text"]) and len(r["text"]) == r["n_chars"]
        if not brute.base_spans(before):
            assert r["text"] == before
    packed_right(step("packing"), [(r["doc_id"], r["text"]) for r in after])
