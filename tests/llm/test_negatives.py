"""Hard negatives beside brute force in Python integers."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinfold.llm import hyperplanes, negatives
from kinfold.llm.negatives import hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int, id string, vec string, rank int, windows int, row int"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 1, 2, 3) for r in rows], SCHEMA)


def brute(rows, every=5, positives=5, negatives=3, scale=256):
    kept = set()
    for i, vec, label in rows:
        if i is None or label is None or vec is None or any(x is None or not math.isfinite(x) for x in vec):
            continue
        kept.add((i, label, tuple(math.floor(scale * float(np.float32(x))) for x in vec)))
    out = []
    for a, label, vec in kept:
        if a % every:
            continue
        scores = [(-sum(x * y for x, y in zip(vec, v)), i, other) for i, other, v in kept if i != a]
        for s, p, _ in sorted(x for x in scores if x[2] == label)[:positives]:
            fits = sorted(x for x in scores if x[2] != label and -50 * s <= -100 * x[0] <= -95 * s)
            out += [(a, p, rank, i, -s, -n) for rank, (n, i, _) in enumerate(fits[:negatives], 1)]
    return sorted(out)


def found(spark, rows, every=5, **options):
    return sorted(tuple(r) for r in hard_negatives(table(spark, rows), F.col("id") % every == 0, **options).collect())


def clustered(seed, n, dims, labels=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dims))
    return [(i, [float(np.float32(x)) for x in centres[rng.integers(6)] + 0.3 * rng.normal(size=dims)], int(rng.integers(labels))) for i in range(n)]


@pytest.mark.parametrize("seed,n,dims", [(1, 300, 8), (2, 200, 2), (3, 120, 40)])
def test_beside_brute_force(spark, seed, n, dims, monkeypatch):
    monkeypatch.setattr(hyperplanes, "LEAF", 8)
    monkeypatch.setattr(negatives, "TREE_ROWS", 16)
    rows = clustered(seed, n, dims)
    assert found(spark, rows) == brute(rows) != []


def test_tree_leaves_subtrees_out_and_loses_nothing():
    rng = np.random.default_rng(4)
    rows = np.floor(256 * (rng.normal(size=(40, 4))[rng.integers(40, size=6000)] + 0.02 * rng.normal(size=(6000, 4)))).astype(np.int64)
    labels, ids = rng.integers(5, size=6000), np.arange(6000)
    longest = float((rows**2).sum(1).max())
    tree = hyperplanes.Tree(ids, labels, rows, longest, True)
    compared = 0
    plain = tree._compare

    def counted(at, queries, asked):
        nonlocal compared
        compared += len(at) * len(asked)
        plain(at, queries, asked)

    tree._compare = counted
    least = np.full(50, 20_000)
    queries = hyperplanes.Queries(ids[:50], labels[:50], rows[:50], np.arange(50), least, least + 30_000, 3, False)
    tree.best(queries)
    scores = rows[:50] @ rows.T
    for q in range(50):
        fits = sorted((-s, i) for i, s in enumerate(scores[q].tolist()) if labels[i] != labels[q] and 20_000 <= s <= 50_000)[:3]
        got = [(-s, i) for s, i in zip(queries.scores[q][: queries.found[q]].tolist(), queries.rows[q].tolist())]
        assert got == fits
    assert compared < 50 * 6000 / 3


def test_equal_vectors_and_ties(spark, monkeypatch):
    monkeypatch.setattr(negatives, "TREE_ROWS", 32)
    rows = [(i, [0.5, 0.25], i % 3) for i in range(100)] + [(100 + i, [0.5, 0.125], i % 2) for i in range(60)]
    assert found(spark, rows) == brute(rows) != []


def test_awkward_rows(spark):
    rows = clustered(6, 40, 3) + [(None, [1.0, 0.0, 0.0], 1), (45, None, 1), (50, [1.0, None, 0.0], 2), (55, [1.0, float("nan"), 0.0], 2), (60, [float("inf"), 0.0, 0.0], 3)]
    rows += [(65, [1.0, 1.0, 1.0], None), (70, [], 1), (75, [0.5], 2), (80, [1.0, 1.0, 1.0, 1.0], 1), (5, [0.1, 0.2, 0.3], 3), (10, rows[10][1], rows[10][2]), (85, [-1.0, -1.0, -1.0], 0)]
    assert found(spark, rows) == brute(rows) != []
    assert found(spark, []) == found(spark, [(None, None, None)]) == found(spark, [(5, [], 1)]) == []
    assert found(spark, [(i, [1.0, 2.0], 1) for i in range(20)]) == []


def test_large_components(spark):
    rows = [(i, [v * 1e6 for v in vec], label) for i, vec, label in clustered(7, 60, 3)]
    assert found(spark, rows) == brute(rows) != []
    with pytest.raises(ValueError):
        found(spark, [(0, [1e30, 1.0], 1), (1, [1.0, 1.0], 1)])
