"""Hard negatives against scoring every row."""

from __future__ import annotations

import numpy as np
import pytest

from pyspark.sql import functions as F

from sparkprep.llm import negatives, queries_search
from sparkprep.llm.negatives import Anchor, code, mine_negatives

SCHEMA = "vec_id bigint, embedding array<bigint>, label int, rank string"


def brute(rows, every=5, n_pos=5, n_neg=10):
    usable = {}
    for i, v, label in rows:
        if i is None or v is None or label is None or not v or any(c is None for c in v):
            continue
        if i not in usable or (label, v) < usable[i]:
            usable[i] = (label, v)
    limit = (1 << 63) - 1

    def score(a, b):
        return min(max(sum(x * y for x, y in zip(a, b)), -limit), limit)

    out = []
    for a, (label, v) in usable.items():
        if a % every:
            continue
        same_length = {i: r for i, r in usable.items() if len(r[1]) == len(v) and i != a}
        scored = {i: score(v, r[1]) for i, r in same_length.items()}
        best = sorted((i for i, r in same_length.items() if r[0] == label), key=lambda i: (-scored[i], i))[:n_pos]
        for p in best:
            fits = [i for i, r in same_length.items() if r[0] != label and 30 * scored[p] <= 100 * scored[i] <= 90 * scored[p]]
            for rank, i in enumerate(sorted(fits, key=lambda i: (-scored[i], i))[:n_neg], 1):
                out.append((a, p, rank, i, scored[p], scored[i]))
    return sorted(out)


def run(spark, rows, every=5):
    df = spark.createDataFrame([(*r, "z") for r in rows], SCHEMA)
    return sorted(tuple(r) for r in mine_negatives(df, F.col("vec_id") % every == 0).collect())


def made(seed, n, dim, labels=3):
    rng = np.random.default_rng(seed)
    centers = rng.standard_normal((labels, dim))
    return [
        (i, [int(c) for c in np.floor(40 * (centers[i % labels] * 0.6 + rng.standard_normal(dim)))], i % labels)
        for i in range(n)
    ]


@pytest.mark.parametrize("block", [16 << 20, 20_000])
@pytest.mark.parametrize("dim", [3, 64, 70])
def test_clusters(spark, monkeypatch, block, dim):
    monkeypatch.setattr(negatives, "BLOCK_BYTES", block)
    monkeypatch.setattr(negatives, "ANCHOR_BLOCK", 1_024 if block > 20_000 else 16)
    rows = made(dim, 300, dim)
    got = run(spark, rows)
    assert got == brute(rows) and len(got) > 100


def test_odd_rows_and_ties(spark):
    rows = [
        (0, [1, 2], 0), (5, [1, 2], 0), (6, [1, 2], 0), (7, [1, 1], 1), (8, [1, 1], 1), (8, [1, 1], 1), (8, [9, 9], 2),
        (10, None, 0), (15, [], 0), (20, [None, 1], 0), (25, [1, 2], None), (None, [1, 1], 1), (9, [1, 1, 1], 1),
        (30, [0, 0], 3), (31, [0, 0], 3), (32, [0, 0], 4), (35, [-5, 0], 5), (36, [5, 0], 5), (37, [2, 0], 6),
        (40, [4_000_000_000, -3_000_000_000], 7), (41, [4_000_000_000, -3_000_000_000], 7), (42, [3_000_000_000, 1], 8),
    ]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []


def test_bounds_hold_and_filter():
    """Every interval holds the score, and most rows are dropped before scoring."""
    rng = np.random.default_rng(1)
    x = np.floor(60 * rng.standard_normal((4_000, 64)))
    q = np.floor(60 * rng.standard_normal(64))
    low, high = Anchor(q).interval(*code(x))
    true = x @ q
    assert (low <= true).all() and (true <= high).all()
    kept = high >= np.sort(low)[-10]
    assert kept.sum() < 0.25 * len(x) and kept[np.argsort(-true)[:10]].all()


def test_whole_vectors(spark):
    schema = "vec_id bigint, embedding array<float>, label int"
    rows = [(7, [0.5, -0.001], 9), (1, [float("nan"), 1.0], 2), (2, [None, 1.0], 2), (3, None, 2), (14, [1.0, 1.0], None)]
    got = {r["vec_id"]: (r["label"], r["embedding"]) for r in queries_search.whole_vectors(spark.createDataFrame(rows, schema)).collect()}
    assert got == {7: (0, [128, -1]), 1: (2, None), 2: (2, None), 3: (2, None), 14: (None, [256, 256])}
