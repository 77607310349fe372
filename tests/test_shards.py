"""Greedy shards against walking every subset."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from sparkprep.sources import manifest as mf
from sparkprep.sources.shards import greedy_shards

SCHEMA = "dataset string, subset string, sample_idx bigint, size int, note string"


def walk(rows, limit):
    out, state = {}, {}
    for d, s, i, size, _ in sorted(rows, key=lambda r: (r[0] or "", r[1] or "", r[2])):
        size = size or 0
        shard, used, any_row = state.get((d, s), (0, 0, False))
        if any_row and used + size > limit:
            shard, used = shard + 1, 0
        state[(d, s)] = (shard, used + size, True)
        out[(d, s, i)] = shard
    return out


def run(spark, rows, limit, **options):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = greedy_shards(df, F.col("size"), limit, **options)
    assert found.columns == [*df.columns, "shard_id"]
    got = found.collect()
    assert len(got) == len(rows)
    return {(r["dataset"], r["subset"], r["sample_idx"]): r["shard_id"] for r in got}


@pytest.mark.parametrize("sizes,limit,cut_rows", [
    ([0, 1, 2, 3, 4, 5, 6, 7], 10, 3),       # many blocks, samples without bytes
    ([1, 9, 10, 11, 40, 0, None], 10, 8),     # some above the limit
    ([3], 10, 2),
    ([5, 5, 10], 10, 4),                      # sums that meet the limit exactly
])
def test_cut_equals_walk(spark, sizes, limit, cut_rows):
    rng = random.Random(limit + cut_rows)
    rows = []
    for subset, n in (("a", 400), ("b", 37), (None, 60), ("c", 1)):
        places = sorted(rng.sample(range(3 * n), n))  # numbers need not be dense
        rows += [("d" if subset != "c" else None, subset, i, rng.choice(sizes), "x") for i in places]
    want = walk(rows, limit)
    got = run(spark, rows, limit, cut_rows=cut_rows, block_rows=16)
    assert got == want
    assert run(spark, rows, limit) == want  # one block


def test_limits_hold_and_numbers_have_no_gaps(spark):
    rng = random.Random(9)
    rows = [("d", "s", i, rng.randrange(1, 60), "x") for i in range(500)] + [("d", "s", 500, 400, "x")]
    found = greedy_shards(spark.createDataFrame(rows, SCHEMA), F.col("size"), 100, cut_rows=20, block_rows=64)
    shards = mf.build_manifest(found, F.col("size")).orderBy("shard_id").collect()
    assert [s["shard_id"] for s in shards] == list(range(len(shards)))
    assert all(s["bytes"] <= 100 or s["samples"] == 1 for s in shards)


def test_odd_tables(spark):
    assert run(spark, [], 10) == {}
    assert run(spark, [("d", "s", i, 0, "x") for i in range(5)], 10) == {("d", "s", i): 0 for i in range(5)}
    assert run(spark, [("d", "s", i, 50, "x") for i in range(4)], 10) == {("d", "s", i): i for i in range(4)}
    with pytest.raises(ValueError):
        run(spark, [("d", "s", 0, 1, "x")], 0)
