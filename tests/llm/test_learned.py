"""Toxicity, exact clustering and whitening: against brute force, held-out labels and odd tables."""

from __future__ import annotations

import itertools
import math
from hashlib import sha256

import brute
import numpy as np
import pytest

import __spark_entry__ as registry
from stratalake.llm import shallot, toxicity, whitening

FOLDER = "/root/testdata/sf0.01"
MILD = "the quick brown fox jumps over a lazy dog while seven calm animals look on in silent wonder".split()
HARSH = ["dreckig", "dreckhaft", "dreckwort", "dreckling", "grimbo"]


# --- toxicity


def brute_marginals(emission, begins, start, steps):
    """By enumeration of all labelings."""
    n = len(emission)
    weight = np.zeros(n)
    total = 0.0
    for labels in itertools.product((0, 1), repeat=n):
        energy = 0.0
        for i, y in enumerate(labels):
            energy += y * emission[i]
            energy += y * start if begins[i] else steps[labels[i - 1], y]
        total += math.exp(energy)
        weight += np.array(labels) * math.exp(energy)
    return weight / total


@pytest.mark.parametrize("seed", range(6))
def test_marginals_by_enumeration(seed, monkeypatch):
    rng = np.random.default_rng(seed)
    monkeypatch.setattr(toxicity, "BLOCK", 3)
    n = 1 + 2 * seed
    emission, steps = rng.normal(0, 2, n), rng.normal(0, 1, (2, 2))
    begins = rng.random(n) < 0.3
    begins[0] = True
    found, _, _ = toxicity.forward_backward(emission, begins, 0.7, steps)
    assert found == pytest.approx(brute_marginals(emission, begins, 0.7, steps))


def test_expected_transitions():
    """The gradient's expectation is that of the enumeration."""
    emission, steps = np.array([0.5, -1.0, 2.0, 0.1]), np.array([[0.0, 0.4], [-0.3, 0.8]])
    begins = np.array([True, False, True, False])
    _, forward, backward = toxicity.forward_backward(emission, begins, -0.2, steps)
    want, total = np.zeros((2, 2)), 0.0
    for y in itertools.product((0, 1), repeat=4):
        w = math.exp(np.dot(y, emission) - 0.2 * (y[0] + y[2]) + steps[y[0], y[1]] + steps[y[2], y[3]])
        total += w
        want[y[0], y[1]] += w
        want[y[2], y[3]] += w
    assert toxicity._expected_steps(emission, begins, steps, forward, backward) == pytest.approx(want / total)


def test_long_sequences_are_stable():
    n = 50_000
    p, _, _ = toxicity.forward_backward(np.full(n, -9.0), np.arange(n) == 0, 0.0, np.array([[0.0, -2.0], [0.0, 1.0]]))
    assert p.shape == (n,) and np.isfinite(p).all() and p.max() < 1e-3


def texts(seed, n, harsh):
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        words = list(rng.choice(MILD, 30))
        if i % 4 == 0:
            for _ in range(3):
                words.insert(int(rng.integers(len(words))), str(rng.choice(harsh)))
        out.append((" ".join(words) + ".", int(i % 4 == 0)))
    return out


def learned(spark, rows):
    docs = [(i, r[0], "d", 1.0) for i, r in enumerate(rows)]
    labels = [(i, r[1], 0, "x") for i, r in enumerate(rows)]
    return toxicity.train(
        spark.createDataFrame(docs, "doc_id bigint, text string, key string, spans double"),
        spark.createDataFrame(labels, "doc_id bigint, toxic int, quality int, text string"),
    )


@pytest.fixture(scope="module")
def model(spark):
    rows = [(t, y, "d", 1.0) for t, y in texts(1, 400, HARSH)]
    # A copied toxic text with a word of its own: its copies are one place, so the word is no marker.
    rows += [("zebrafish " + rows[0][0], 1, "d", 1.0)] * 50
    rows += [(None, 1, "d", 1.0), ("", 0, "d", 1.0), ("no label", None, "d", 1.0), ("odd label", 7, "d", 1.0)]
    return learned(spark, rows)


def scored(spark, model, values):
    df = spark.createDataFrame([(i, t, "s", 2) for i, t in values], "doc_id bigint, text string, source string, score int")
    return toxicity.score(df, model).collect()


def test_toxic_spans(spark, model):
    text = "a calm fox. Dreckvoll grimbo! the 🙂 dog, Grimbo; zebrafish"
    found = scored(spark, model, [
        (1, text), (2, "a calm fox looks on in wonder"), (3, None), (4, ""), (5, "1 2 3 !!"), (None, text),
        (7, ("calm fox " * 40_000) + "grimbo"), (8, "x" * 200_000), (9, "ⅧⅨ ½ grimbo"),
    ])
    by = {r["doc_id"]: r for r in found}
    # A beginning never seen with this ending, and spans in code points.
    assert [text[s["start"] : s["end"]] for s in by[1]["spans"]] == ["Dreckvoll grimbo", "Grimbo"]
    assert by[1]["score"] == by[None]["score"] > 0.9 and by[2]["score"] < 0.3 and not by[2]["spans"]
    assert by[3]["score"] == by[4]["score"] == by[5]["score"] < 0.3
    assert by[7]["score"] > 0.9 and len(by[7]["spans"]) == 1
    assert by[8]["score"] < 0.3 and [s["start"] for s in by[9]["spans"]] == [5]
    assert all(0 <= r["score"] <= 1 for r in found)


def test_unseen_texts(spark, model):
    new = texts(2, 200, HARSH)
    found = scored(spark, model, [(i, t) for i, (t, _) in enumerate(new)])
    assert [int(r["score"] >= toxicity.THRESHOLD) for r in sorted(found)] == [y for _, y in new]


def test_nothing_to_learn_toxicity(spark):
    assert learned(spark, []) is None and learned(spark, [("a b c", 1)]) is None
    few = learned(spark, [("a b c", 1), ("d e f", 0), ("g", 0)])
    assert all(0 <= r["score"] <= 1 and not r["spans"] for r in scored(spark, few, [(1, "a b"), (2, None)]))
    assert [tuple(r) for r in scored(spark, None, [(1, "a b"), (2, None)])] == [(1, 0.0, []), (2, 0.0, [])]
    assert toxicity.score(spark.createDataFrame([], "doc_id bigint, text string"), few).count() == 0


def test_held_out_labels(spark):
    found = registry.queries()["op11_toxicity"](spark, FOLDER).collect()
    ids = [r["doc_id"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id").collect()]
    assert sorted(r["doc_id"] for r in found) == sorted(ids)
    assert all(r["held_out"] == (brute.crc(r["doc_id"]) % 4 == 2) and 0 <= r["score"] <= 1 for r in found)
    assert all(r["predicted"] == (r["score"] >= 0.3) for r in found)
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    held = [(labels[r["doc_id"]], r["predicted"]) for r in found if r["held_out"] and r["doc_id"] in labels]
    assert sum(y and p for y, p in held) >= 0.6 * sum(y for y, _ in held)
    assert sum(p and not y for y, p in held) <= 0.02 * len(held)


# --- clustering


def brute_clusters(rows, k, rounds, scale, salt):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows]
    name = lambda i: sha256(f"{salt}:{'' if i is None else i}".encode()).hexdigest()
    centroids = [v for _, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:k]]
    distance = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    nearest = lambda v: min((distance(v, c), j) for j, c in enumerate(centroids))
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for j, members in groups.items():
            centroids[j] = [sum(column) // len(members) for column in zip(*members, strict=True)]
    final = [(i, *nearest(v)[::-1]) for i, v in kept]
    sums = {}
    for _, j, d in final:
        sums[j] = sums.get(j, 0) + d
    digest = [sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, j, d, sums[j], sum(sums.values()), digest[j]) for i, j, d in final), key=repr)


def clusters(spark, rows, k, rounds=4, dimensions=3, scale=8):
    df = spark.createDataFrame([(i, v, 7, 1.5) for i, v in rows], "vec_id bigint, embedding array<double>, cluster int, upper double")
    state, centroids = shallot.cluster(df, k, rounds, scale, dimensions, "2")
    return sorted((tuple(r) for r in shallot.report(state, centroids).collect()), key=repr)


@pytest.mark.parametrize("seed", range(4))
def test_clusters_by_brute_force(spark, seed):
    rng = np.random.default_rng(seed)
    # Coarse values give ties, repeated vectors and equal first centroids.
    values = np.round(rng.normal(0, 1, (150, 3)) * 2 + 3 * rng.integers(0, 3, (150, 1))) / (1, 2, 8, 8)[seed]
    rows = [(i % 140, v) for i, v in enumerate(values.tolist())] + [(None, values[0].tolist())] * 3
    assert clusters(spark, rows, (12, 5, 40, 1)[seed]) == brute_clusters(rows, (12, 5, 40, 1)[seed], 4, 8, "2")


def test_unfit_vectors(spark):
    good = [(1, [0.1, -0.2, 0.3]), (2, [4.0, 4.0, 4.0])]
    bad = [(3, None), (4, []), (5, [1.0, 2.0]), (6, [1.0, None, 2.0]), (7, [math.nan, 1.0, 1.0]), (8, [1.0, math.inf, 1.0]), (9, [1e30] * 3)]
    assert clusters(spark, good + bad, 40) == brute_clusters(good, 40, 4, 8, "2")
    assert clusters(spark, bad, 40) == [] and clusters(spark, [], 40) == []


def test_search_leaves_distances_out():
    """Clear clusters: far fewer distances than vectors times centroids, equal centroids found."""
    rng = np.random.default_rng(5)
    x = (rng.normal(0, 20, (4_000, 8)) + 1_000 * rng.normal(0, 1, (40, 8))[rng.integers(0, 40, 4_000)]).astype(np.int64)
    centroids, before = x[:40].copy(), None
    n = len(x)
    state = (np.zeros(n, int), np.ones(n, int), np.full(n, np.inf), np.zeros(n))
    needed = 0
    for _ in range(6):
        state, count = shallot.search(x, *state, shallot.move(centroids, before))
        want = ((x[:, None, :] - centroids) ** 2).sum(axis=2).argmin(axis=1)
        assert (state[0] == want).all()
        needed += count
        before = centroids
        centroids = np.array([x[want == j].sum(axis=0) // max((want == j).sum(), 1) if (want == j).any() else c for j, c in enumerate(centroids)])
    assert needed < 0.5 * 6 * n * 40


# --- whitening


def whitened(spark, rows, components=3):
    df = spark.createDataFrame([(i, v, 7, 1) for i, v in rows], "vec_id bigint, embedding array<float>, place int, n int")
    return whitening.whiten(df, components=components).collect()


def check_whitening(found, rows, components):
    """Exact parts as they are, projections up to the sign of a component."""
    x = np.floor(1024 * np.array([v for _, v in rows], np.float32).astype(np.float64)).astype(np.int64) + 100_000
    n, sums = len(x), x.sum(axis=0)
    deviation = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums, strict=True)) for row in x]
    centred = x - sums / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    want = centred @ vectors / np.sqrt(values)
    for c in range(components):
        mine = sorted((r["vec_id"], r["deviation"], r["whitened"]) for r in found if r["component"] == c + 1)
        theirs = sorted((i, d, w) for (i, _), d, w in zip(rows, deviation, want[:, c].tolist(), strict=True))
        assert [r[:2] for r in mine] == [r[:2] for r in theirs]
        a, b = np.array([r[2] for r in mine]), np.array([r[2] for r in theirs])
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-8
    assert {r["n"] for r in found} == {n} and all(r["identity_error"] <= 1e-6 for r in found)
    assert [r["explained"] for r in sorted(found, key=lambda r: r["component"])[::n]] == pytest.approx(list(values / np.trace(centred.T @ centred / n)))


def test_whitening_by_numpy(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 7)  # many blocks and a short last one
    rng = np.random.default_rng(3)
    mixed = rng.normal(0, 1, (60, 5)) @ rng.normal(0, 1, (5, 5))
    rows = [(i, v) for i, v in enumerate(mixed.tolist())]
    bad = [(99, None), (98, []), (97, [1.0] * 4), (96, [1.0, None, 1.0, 1.0, 1.0]), (95, [math.nan] * 5), (94, [math.inf] * 5)]
    check_whitening(whitened(spark, rows + bad), rows, 3)


def test_whole_embeddings(spark):
    found = registry.queries()["op13_whitening"](spark, FOLDER).collect()
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").select("vec_id", "embedding").collect()]
    check_whitening(found, rows, 8)


def test_degenerate_whitening(spark):
    assert whitened(spark, []) == [] and whitened(spark, [(1, None)]) == []
    same = whitened(spark, [(1, [2.0, 3.0]), (None, [2.0, 3.0]), (1, [2.0, 3.0])])
    assert len(same) == 6 and all(r["whitened"] == 0 and r["deviation"] == 0 and r["identity_error"] == 0 for r in same)
    line = whitened(spark, [(i, [float(i), 2.0 * i]) for i in range(5)])
    assert {r["component"] for r in line} == {1, 2} and all(r["whitened"] == 0 for r in line if r["component"] == 2)
    assert all(r["identity_error"] < 1e-9 for r in line)
    far = whitened(spark, [(0, [1e9, 0.0]), (1, [-1e9, 0.0]), (2, [0.0, 1.0])], 1)
    assert [r["deviation"] for r in sorted(far)][2] is not None and any(r["deviation"] is None for r in far)
