"""Golden cases, a brute-force twin, and properties of chunking."""

from __future__ import annotations

import itertools
import random
from dataclasses import replace

import brute
import pytest
from pyspark.sql import functions as F

from sparkprep.operators import chunk as ck
from sparkprep.operators.chunk import DUPLICATE, LOSSLESS, MOVE, NO_BACKFILL, ChunkConfig

BASE = ChunkConfig(10, 0, 1, min_chunk_size=5, always_skip_size=2, backfill=NO_BACKFILL)
SCHEMA = "dataset string, subset string, id string, input_ids array<int>"


def ids(first, last):
    return list(range(first, last + 1))


def run(spark, tokens, cfg):
    df = spark.createDataFrame([("d", "s", "a", tokens)], SCHEMA)
    rows = ck.chunk_dataset(df, cfg).orderBy("chunk_idx").collect()
    stats = ck.chunk_stats(df, cfg).where("subset is null").first()
    return [list(r.input_ids) for r in rows], stats.total_duplicated_tokens, stats.total_tokens_skipped


FULL = [[0, *ids(10, 16), 1], [0, *ids(18, 24), 1]]
GOLDEN = [
    # name, input, changes to BASE, forced draw, chunks, duplicated, skipped
    ("G1", ids(10, 29), {}, None, FULL, 0, 4),
    ("G2", ids(10, 29), {"backfill": DUPLICATE}, None, [*FULL, [0, 22, 23, 24, 1, 26, 27, 28, 1]], 4, 0),
    ("G3", ids(10, 29), {"backfill": MOVE}, 2,
     [FULL[0], [0, *ids(18, 23), 1], [0, 24, 1, *ids(26, 29), 1]], 0, 0),
    ("G4", ids(10, 29), {"backfill": MOVE}, 0, [*FULL, [0, *ids(26, 29), 1]], 0, 0),
    ("G5", ids(10, 26), {"backfill": MOVE}, 2, FULL, 0, 1),
    ("G6", ids(10, 12), {"backfill": MOVE}, None, [[0, 10, 11, 12, 1]], 0, 0),
    ("G7", [0, *ids(10, 23), 1], {}, None, [[0, *ids(10, 16), 1], [0, *ids(17, 23), 1]], 0, 0),
    ("G8", [0, *ids(10, 27), 1], {"backfill": DUPLICATE}, None,
     [[0, *ids(10, 16), 1], [0, *ids(17, 23), 1], [0, 21, 22, 23, 1, 25, 26, 27, 1]], 4, 0),
    ("G9", ids(10, 12), {"add_eos": True}, None, [[0, 10, 11, 12, 1]], 0, 0),
    ("G10", [], {"backfill": MOVE}, None, [], 0, 0),
    ("G11", ids(10, 29), {"eos_id": None, "backfill": DUPLICATE}, None,
     [[0, *ids(10, 17)], [0, *ids(18, 25)], [0, *ids(22, 29)]], 4, 0),
    ("G12", ids(10, 29), {"specials": LOSSLESS}, None,
     [[0, *ids(10, 17), 1], [0, *ids(18, 25), 1]], 0, 4),
    ("G13", ids(10, 29), {"specials": LOSSLESS, "backfill": DUPLICATE}, None,
     [[0, *ids(10, 17), 1], [0, *ids(18, 25), 1], [0, *ids(22, 29), 1]], 4, 0),
    ("G14", ids(10, 29), {"specials": LOSSLESS, "backfill": MOVE}, 2,
     [[0, *ids(10, 17), 1], [0, *ids(18, 23), 1], [0, *ids(24, 29), 1]], 0, 0),
    ("G15", ids(10, 29), {"min_chunk_size": 9}, None, [FULL[0]], 0, 12),
    ("G16", ids(10, 29), {"chunk_size": 2}, None, [], 0, 20),
]


@pytest.mark.parametrize("case", GOLDEN, ids=[c[0] for c in GOLDEN])
def test_golden(spark, monkeypatch, case):
    _, tokens, changes, forced, chunks, duplicated, skipped = case
    if forced is not None:
        monkeypatch.setattr(ck, "draw_int", lambda seed, *key: F.lit(forced))
    assert run(spark, tokens, replace(BASE, **changes)) == (chunks, duplicated, skipped)


def corpus(n=160, seed=7):
    """Documents of all small lengths, some with special ids at the ends or inside."""
    rng = random.Random(seed)
    docs = []
    for i in range(n):
        body = [rng.randint(0, 40) if rng.random() < 0.2 else rng.randint(2, 40) for _ in range(i % 61)]
        if i % 3 == 0:
            body = [0, *body, 1]
        docs.append(("d", f"s{i % 4}", str(i), body))
    return docs


def configs():
    """Common shapes in all combinations, odd ones (windows shorter than a limit) in fewer."""
    ends = [(1, False), (None, False), (1, True)]
    common = itertools.product([(10, 5, 2)], brute.MODES, ends, ["reference", LOSSLESS])
    odd = itertools.product(
        [(7, 9, 1), (12, 6, 11), (3, 2, 1)], brute.MODES, ends[:1], ["reference"]
    )
    for (size, low, skip), mode, (eos, add), specials in itertools.chain(common, odd):
        yield ChunkConfig(
            size, 0, eos, min_chunk_size=low, always_skip_size=skip, backfill=mode,
            specials=specials, add_eos=add,
        )


CONFIGS = list(configs())


@pytest.mark.parametrize("part", range(3))
def test_equals_brute_force(spark, part):
    docs = corpus()
    df = spark.createDataFrame(docs, SCHEMA).repartition(4, "id").persist()
    for cfg in CONFIGS[part::3]:
        want, dup, skip = [], 0, 0
        for d in docs:
            c, a, b = brute.chunks(d[3], cfg, d[2])
            want += [(d[2], i, tuple(x)) for i, x in enumerate(c)]
            dup, skip = dup + a, skip + b
        got = [(r.id, r.chunk_idx, tuple(r.input_ids)) for r in ck.chunk_dataset(df, cfg).collect()]
        assert sorted(got) == sorted(want), cfg
        stats = ck.chunk_stats(df, cfg)
        total = stats.where("subset is null").first()
        assert total == ck.written_chunk_stats(df, ck.chunk_dataset(df, cfg), cfg).where(
            "subset is null"
        ).first()
        assert total.total_output_chunks == len(want)
        assert total.total_tokens_written == sum(len(w[2]) for w in want)
        assert (total.total_duplicated_tokens, total.total_tokens_skipped) == (dup, skip), cfg
        assert total.total_input_samples == len(docs)


def test_lossless_conserves_every_token(spark):
    docs = corpus()
    df = spark.createDataFrame(docs, SCHEMA)
    for mode in brute.MODES:
        cfg = replace(BASE, specials=LOSSLESS, backfill=mode)
        rows = ck.chunk_dataset(df, cfg)
        assert rows.where(F.size("input_ids") > cfg.chunk_size).count() == 0
        total = ck.chunk_stats(df, cfg).where("subset is null").first()
        content = total.total_tokens_written - 2 * total.total_output_chunks
        bare = 0
        for d in docs:
            t = d[3][1:] if d[3] and d[3][0] == 0 else d[3]
            bare += len(t) - (1 if t and t[-1] == 1 else 0)
        assert content + total.total_tokens_skipped - total.total_duplicated_tokens == bare


def test_partitioning_does_not_matter(spark):
    df = spark.createDataFrame(corpus(), SCHEMA)
    cfg = replace(BASE, backfill=MOVE)
    seen = set()
    for n in (1, 4, 16):
        rows = ck.chunk_dataset(df.repartition(n), cfg).collect()
        seen.add(tuple(sorted((r.id, r.chunk_idx, tuple(r.input_ids)) for r in rows)))
    assert len(seen) == 1


def test_short_samples_are_filtered_and_counted(spark):
    rows = [("d", "s", str(n), list(range(5, 5 + n))) for n in range(4)]
    df = spark.createDataFrame(rows, SCHEMA)
    cfg = replace(BASE, min_sample_tokens=2)
    assert sorted(r.id for r in ck.chunk_dataset(df, cfg).collect()) == ["2", "3"]
    total = ck.chunk_stats(df, cfg).where("subset is null").first()
    assert (total.total_input_samples, total.total_samples_skipped_by_length) == (2, 2)


def test_percentiles(spark):
    df = spark.createDataFrame([("s", n) for n in (9, 9, 9, 6, 9, 5, 9)], "subset string, len int")
    row = ck.length_percentiles(df).first()
    assert [row[f"p{p}"] for p in range(0, 101, 10)] == [5, 5, 6, 9, 9, 9, 9, 9, 9, 9, 9]


def test_bad_settings_are_errors():
    with pytest.raises(ValueError):
        replace(BASE, add_eos=True, eos_id=None)
    with pytest.raises(ValueError):
        replace(BASE, backfill="some")
    with pytest.raises(ValueError):
        ck.preset(2048, 0, 1)
    assert ChunkConfig(8192, 0).skip_size == 32 and ChunkConfig(1024, 0).skip_size == 128
    assert ck.preset(4096, 0, 1).min_sample_tokens == 2048


def test_a_short_stored_length_prunes_the_scan(spark, tmp_path):
    path = str(tmp_path / "tokens")
    df = spark.createDataFrame(corpus(), SCHEMA).withColumn("len", F.size("input_ids"))
    df.write.parquet(path)
    cfg = replace(BASE, min_sample_tokens=30)
    plan = ck.chunk_dataset(spark.read.parquet(path), cfg)._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(len,30)" in plan
    assert "Exchange" not in plan


def test_work_is_linear_in_the_document(spark):
    """Eight million ids in one document: a plan that copies them per window takes minutes."""
    import time

    ids = F.transform(F.sequence(F.lit(0), F.lit(8_000_000 - 1)), lambda i: (i % 256).cast("int"))
    df = spark.range(1).select(
        F.lit("d").alias("dataset"), F.lit("s").alias("subset"), F.lit("a").alias("id"), ids.alias("input_ids")
    ).checkpoint()
    start = time.perf_counter()
    cfg = ChunkConfig(1024, 256, 257, min_chunk_size=512)
    assert ck.chunk_dataset(df, cfg).where("len > 0").count() == -(-8_000_000 // cfg.window)
    assert time.perf_counter() - start < 20
