"""Shards and mixes against plain Python on small tables, and the laws on the given data."""

from __future__ import annotations

import collections
import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from sparkprep.llm.mixing import mix, position, source_targets, training_order
from sparkprep.llm.queries import op2
from sparkprep.llm.sharding import assign_shards, write_shards

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id bigint, text string, source string, shard string"


def brute_shards(rows, shards):
    """Fractional ranks by sorting, cuts by position; rows are (id, source)."""
    draw = lambda i: hashlib.md5(f"42:{i}".encode()).hexdigest()
    by = collections.defaultdict(list)
    for i, s in rows:
        by[s].append(i)
    placed = []
    for s, ids in by.items():
        for r, i in enumerate(sorted(ids, key=draw)):
            placed.append(((2 * r + 1) / (2 * len(ids)), s, i))
    placed.sort(key=lambda p: (p[0], p[1]))
    out, slots = {}, collections.Counter()
    for g, (_, s, i) in enumerate(placed):
        shard = g * shards // len(placed)
        out[i] = (shard, slots[shard])
        slots[shard] += 1
    return out


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    rows = op2(spark, SF).collect()
    want = brute_shards([(r["doc_id"], r["source"]) for r in docs], 24)
    assert {r["doc_id"]: (r["shard"], r["slot"]) for r in rows} == want
    text = {r["doc_id"]: r["text"] or "" for r in docs}
    for r in rows:
        data = text[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"]) == (len(data) + 8, zlib.crc32(data))
    counts = collections.Counter(r["shard"] for r in rows)
    assert max(counts.values()) - min(counts.values()) <= 1


@pytest.mark.parametrize("blocks", [1, 3, 50])
def test_mixture_of_every_shard(spark, blocks):
    n = {"a": 600, "b": 90, None: 31, "c": 7}
    rows = [(k * 1000 + i, f"t{i}", s, "z") for k, (s, m) in enumerate(n.items()) for i in range(m)]
    out = assign_shards(spark.createDataFrame(rows, SCHEMA), 5, blocks=blocks).collect()
    total = sum(n.values())
    for shard in range(5):
        mine = [r for r in out if r["shard"] == shard]
        assert sorted(r["slot"] for r in mine) == list(range(len(mine)))
        for s, m in n.items():
            assert abs(sum(r["source"] == s for r in mine) - m * len(mine) / total) < 2


def test_written_shards_hold_every_row_once(spark, tmp_path):
    rows = [(1, "x", "a", "p"), (1, "x", "a", "p"), (1, "y", "a", "p"), (None, None, None, None), (None, None, None, None)]
    rows += [(i, f"text {i}", "b", "q") for i in range(2, 40)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string, extra string")
    write_shards(df, assign_shards(df, 3), str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out")).collect()
    key = lambda r: repr((r["doc_id"], r["text"], r["source"], r["extra"]))
    assert sorted(map(key, back)) == sorted(map(key, df.collect()))
    assert len({(r["shard"], r["slot"]) for r in back}) == len(rows)


def test_empty_tables(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert assign_shards(df, 24).count() == 0
    assert mix(df).count() == 0


def brute_targets(sizes, weights=(5.0, 2.0, 1.0), limit=3):
    """Fill, cap, and share again until none is above its limit."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full, target = set(), {}
    while True:
        left = sum(sizes.values()) - sum(limit * sizes[s] for s in full)
        rest = [s for s in names if s not in full]
        target = {s: float(limit * sizes[s]) for s in full}
        target |= {s: left * weight[s] / sum(weight[r] for r in rest) for s in rest}
        above = [s for s in rest if target[s] > limit * sizes[s]]
        if not above:
            return target
        full |= set(above)


@pytest.mark.parametrize(
    "sizes",
    [{"a": 10, "b": 1000, "c": 500, None: 3}, {"x": 7}, {"a": 1, "b": 1, "c": 1, "d": 5000, "e": 0}, {"é": 40, "z": 90, "Z": 5}],
)
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    got = {r["source"]: r["target"] for r in source_targets(df).collect()}
    assert got == pytest.approx(brute_targets(sizes))


def test_mix_meets_targets_and_reruns_agree(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source")
    docs = docs.union(spark.createDataFrame([(-1, None, None), (-2, " \n", "src0"), (None, "a b", None)], docs.schema))
    rows = mix(docs).collect()
    assert sorted(map(str, rows)) == sorted(map(str, mix(docs.repartition(3)).collect()))
    by = collections.defaultdict(list)
    for r in rows:
        by[r["source"]].append(r)
        assert r["taken"] == r["passes"] * r["size"] <= 3 * r["size"]
        assert list(r["positions"]) == sorted(r["positions"]) and len(r["positions"]) == r["passes"]
        assert all(0 <= p <= 1 for p in r["positions"])
    for mine in by.values():
        largest = max(r["size"] for r in mine)
        assert abs(sum(r["taken"] for r in mine) - mine[0]["target"]) <= largest / 2 + 1
        assert mine[0]["source_size"] == sum(r["size"] for r in mine)
    assert sum(r["taken"] for r in rows) == pytest.approx(sum(r["size"] for r in rows), rel=0.05)


def test_positions_follow_the_schedule(spark):
    """The demand at the position of a share is that share."""
    rows = [(p / 10, a) for p in range(11) for a in (-0.9, -0.2, 0.0, 0.4, 0.9)]
    df = spark.createDataFrame(rows, "p double, a double").withColumn("t", position(F.col("p"), F.col("a")))
    for r in df.collect():
        assert r["t"] + r["a"] * (r["t"] ** 2 - r["t"]) == pytest.approx(r["p"], abs=1e-12)


def test_training_order_is_sorted_and_sources_shift(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    order = training_order(mix(docs)).collect()
    at = [r["position"] for r in order]
    assert at == sorted(at)
