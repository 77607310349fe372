"""The forest against all pairs."""

from __future__ import annotations

import numpy as np
import pytest

from sparkprep.llm import embeddings
from sparkprep.llm.embeddings import near_duplicates

SCHEMA = "vec_id bigint, embedding array<float>, label int, node string"


def brute(rows):
    """Links and components by comparing every pair, row by row."""
    n = len(rows)
    x = [None if not embeddings_usable(r) else np.array(r[1], np.float32).astype(float) for r in rows]
    links, root = [0] * n, list(range(n))
    for i in range(n):
        for j in range(n):
            if i == j or x[i] is None or x[j] is None or rows[i][2] != rows[j][2] or len(x[i]) != len(x[j]):
                continue
            if x[i] @ x[j] / np.linalg.norm(x[i]) / np.linalg.norm(x[j]) >= 0.93:
                links[i] += 1
    changed = True
    while changed:
        changed = False
        for i in range(n):
            for j in range(n):
                if root[j] < root[i] and links[i] and x[i] is not None and x[j] is not None and rows[i][2] == rows[j][2]:
                    if len(x[i]) == len(x[j]) and x[i] @ x[j] / np.linalg.norm(x[i]) / np.linalg.norm(x[j]) >= 0.93:
                        root[i] = root[j]
                        changed = True
    return links, [rows[r][0] for r in root]


def embeddings_usable(r):
    v = r[1]
    return (
        r[0] is not None and r[2] is not None and v is not None and len(v) > 0
        and all(c is not None and np.isfinite(c) for c in v) and any(v)
    )


def make(seed, n, dim=16, clusters=12, labels=2):
    rng = np.random.default_rng(seed)
    centers = rng.standard_normal((clusters, dim))
    rows = []
    for i in range(n):
        v = centers[rng.integers(clusters)] + 0.22 * rng.standard_normal(dim) if i % 3 else rng.standard_normal(dim)
        rows.append((i, [float(np.float32(c)) for c in v], int(rng.integers(labels)), "z"))
    return rows


@pytest.mark.parametrize("leaf", [10_000, 60])
def test_clusters(spark, leaf):
    rows = make(3, 700)
    out = near_duplicates(spark.createDataFrame(rows, SCHEMA), leaf=leaf).orderBy("vec_id").collect()
    links, roots = brute(rows)
    got = [r["n_links"] for r in out]
    if leaf > len(rows):
        assert got == links and [r["component_id"] for r in out] == roots
    else:
        assert all(a <= b for a, b in zip(got, links))
        assert sum(got) >= 0.9 * sum(links)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in out)


def test_copies_and_odd_vectors(spark):
    v, w = [1.0, 2.0, 3.0], [1.0, 2.0, 3.1]
    rows = [
        (5, v, 1, ""), (3, v, 1, ""), (9, w, 1, ""), (4, v, 2, ""), (6, v, None, ""), (7, None, 1, ""), (8, [], 1, ""),
        (10, [0.0, 0.0, 0.0], 1, ""), (11, [1.0, None, 3.0], 1, ""), (12, [float("nan")] * 3, 1, ""),
        (13, [float("inf"), 1.0, 1.0], 1, ""), (14, [1e38, 2e38, 3e38], 1, ""), (None, v, 1, ""), (15, [1.0, 2.0], 1, ""),
        (16, [-1.0, -2.0, -3.0], 1, ""),
    ]
    out = {r["vec_id"]: tuple(r)[1:] for r in near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert out[3] == (3, 3, True) and out[5] == (3, 3, False) and out[9] == (3, 3, False) and out[14] == (3, 3, False)
    for alone in (4, 6, 7, 8, 10, 11, 12, 13, 15, 16):
        assert out[alone] == (0, alone, True)
    assert out[None] == (0, None, False)


def test_repeated_rows_and_no_rows(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0], 1, "")] * 3, SCHEMA)
    assert [tuple(r) for r in near_duplicates(df).collect()] == [(1, 2, 1, True)] * 3
    assert near_duplicates(df.limit(0)).count() == 0


def test_dense_leaf_is_counted_without_pairs():
    """Links from the core equal links from comparing, with leaf lists of several kinds."""
    import functools

    import pyarrow as pa

    rng = np.random.default_rng(0)
    c = rng.standard_normal(24)
    x = (c + 0.12 * rng.standard_normal((300, 24))).astype("<f4")
    x[::10] = rng.standard_normal((30, 24))
    lists = [sorted({7, *(int(k) for k in rng.choice([3, 5, 9, 11], 2))}) for _ in x]
    table = pa.table({
        "node": pa.array(rng.permutation(300)), "n": pa.array(rng.integers(1, 4, 300)),
        "vector": pa.array([v.tobytes() for v in x], pa.binary()),
        "leaf": pa.array([7] * 300), "leaves": pa.array(lists, pa.list_(pa.int64())),
    })
    run = functools.partial(embeddings._compare, 0.93)
    fast = run(np.cos(np.arccos(0.93) / 2), "<f4", table).to_pylist()
    slow = run(2.0, "<f4", table).to_pylist()  # no vector is that close to the mean
    assert fast == slow and len(fast) > 100


def loose_cluster(rng, n, cosine, dim=64):
    """Vectors around one direction with pairwise cosines near ``cosine``."""
    noise = rng.standard_normal((n, dim)) * np.sqrt((1 / cosine - 1) / dim)
    center = rng.standard_normal(dim)
    return center / np.linalg.norm(center) + noise


@pytest.mark.parametrize("sizes, cosine", [((1024,), 0.945), ((2048, 3000), 0.95), ((1024, 9000), 0.945)])
def test_loose_clusters(spark, monkeypatch, sizes, cosine):
    """Recall of links at least 0.9, none wrong; with blocks smaller than the cluster."""
    monkeypatch.setattr(embeddings, "TASK_ROWS", 700)
    rng = np.random.default_rng(1)
    parts = [loose_cluster(rng, sizes[0], cosine), *(rng.standard_normal((n, 64)) for n in sizes[1:])]
    x = np.concatenate(parts).astype(np.float32)
    rows = [(i, v.tolist(), 1, "") for i, v in enumerate(x)]
    out = near_duplicates(spark.createDataFrame(rows, SCHEMA)).orderBy("vec_id").collect()
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    want = ((unit @ unit.T) >= 0.93).sum(axis=1) - 1
    got = np.array([r["n_links"] for r in out])
    assert (got <= want).all()
    assert got.sum() >= 0.9 * want.sum()
    if len(sizes) == 1:
        assert (got == want).all()
    assert [r["component_id"] for r in out if want[r["vec_id"]]].count(0) >= 0.95 * sizes[0]


def test_blocks_of_a_tight_cluster(spark, monkeypatch):
    """Links counted from the core across blocks, with copies, equal brute force."""
    monkeypatch.setattr(embeddings, "TASK_ROWS", 60)
    rng = np.random.default_rng(2)
    x = np.concatenate([loose_cluster(rng, 260, 0.985, 16), rng.standard_normal((40, 16))]).astype(np.float32)
    rows = [(i, v.tolist(), 1, "") for i, v in enumerate(x)] + [(400 + i, x[i].tolist(), 1, "") for i in range(30)]
    out = near_duplicates(spark.createDataFrame(rows, SCHEMA), leaf=64).orderBy("vec_id").collect()
    links, roots = brute(rows)
    assert [r["n_links"] for r in out] == links
    assert [r["component_id"] for r in out] == roots
