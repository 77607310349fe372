"""Subsets that fail alone, and runs that are stopped between batches."""

from __future__ import annotations

import glob
import os

import pytest
from pyspark.sql import functions as F

from sparkprep.operators.chunk import DUPLICATE, ChunkConfig, chunk_dataset
from sparkprep.operators.split import rows_of_split
from sparkprep.operators.tokenize import tokenize_bytes, tokenize_with
from sparkprep.plans import jobs
from sparkprep.plans.isolation import require_done, run_isolated, units
from sparkprep.sources import datasets as ds, sinks
from sparkprep.streaming import incremental as inc

SUBSETS = [f"000_0000{i}" for i in range(4)]


def corpus(spark, rows=80):
    """Every id is used twice, some are null; places are unique."""
    n = F.col("id")
    return spark.range(rows).select(
        F.lit("docs").alias("dataset"),
        F.concat(F.lit("000_0000"), (n % 4).cast("string")).alias("subset"),
        F.floor(n / 4).cast("bigint").alias("sample_idx"),
        F.when(n % 10 != 0, F.floor(n / 8).cast("string")).alias("id"),
        F.concat(F.lit("text "), F.repeat(F.lit("x"), (n % 7).cast("int"))).alias("text"),
    )


@pytest.fixture
def source(spark, tmp_path):
    path = str(tmp_path / "docs")
    sinks.write_subsets(corpus(spark), path, max_rows_per_file=5)
    return path


def places(spark, path):
    return sorted(tuple(r) for r in ds.read_dataset(spark, path).select("subset", "sample_idx").collect())


def test_resume_goes_by_place_not_by_id(spark, source, tmp_path):
    target = str(tmp_path / "tokens")
    half = tokenize_bytes(ds.read_dataset(spark, source).where("sample_idx % 2 = 0"))
    sinks.write_subsets(half.select("dataset", "subset", "sample_idx", "id", "input_ids", "len"), target)
    jobs.tokenize_job(spark, source, target, tokenize_bytes, resume=True)
    assert places(spark, target) == places(spark, source)
    jobs.tokenize_job(spark, source, target, tokenize_bytes, resume=True)
    assert places(spark, target) == places(spark, source)


def test_sample_with_repeated_ids(spark, source, tmp_path):
    target = str(tmp_path / "tokens")
    jobs.tokenize_job(spark, source, target, tokenize_bytes)
    jobs.sample_job(spark, target, str(tmp_path / "sample"), [0, 8, 100], 4)
    picked = spark.read.parquet(str(tmp_path / "sample")).groupBy("bin_label").count().collect()
    assert sorted(r["count"] for r in picked) == [4, 4]


def damage(source, subset):
    file = glob.glob(f"{source}/dataset=docs/subset={subset}/*.parquet")[0]
    os.remove(os.path.join(os.path.dirname(file), f".{os.path.basename(file)}.crc"))
    good = open(file, "rb").read()
    with open(file, "wb") as f:
        f.write(b"PAR1 no longer a file PAR1")
    return file, good


def test_a_damaged_file_stops_one_subset(spark, source, tmp_path):
    target = str(tmp_path / "tokens")
    file, good = damage(source, SUBSETS[2])

    def refuse_long_ids(rows):
        """An id that does not fit 16 bits, in another subset."""
        tokens = tokenize_bytes(rows)
        wide = F.when(F.col("subset") == SUBSETS[3], F.array(F.lit(70_000))).otherwise(F.col("input_ids"))
        return tokens.withColumn("input_ids", wide)

    jobs.tokenize_job(spark, source, target, refuse_long_ids, max_parallel=3)
    status = {r["subset"]: r for r in spark.read.parquet(target + "_status").collect()}
    assert [status[s]["status"] for s in SUBSETS] == ["done", "done", "failed", "failed"]
    assert status[SUBSETS[0]]["samples"] == 20 and status[SUBSETS[2]]["samples"] is None
    assert "16-bit" in status[SUBSETS[3]]["error"] and status[SUBSETS[2]]["error"]
    assert {s for s, _ in places(spark, target)} == set(SUBSETS[:2])
    with pytest.raises(RuntimeError, match="2 subsets failed"):
        require_done(spark.read.parquet(target + "_status"))

    # Mended: only what failed runs again, and the rest stays.
    with open(file, "wb") as f:
        f.write(good)
    kept = glob.glob(f"{target}/dataset=docs/subset={SUBSETS[0]}/*.parquet")
    stats = jobs.tokenize_job(spark, source, target, tokenize_bytes, max_parallel=2, resume=True)
    assert glob.glob(f"{target}/dataset=docs/subset={SUBSETS[0]}/*.parquet") == kept
    assert places(spark, target) == places(spark, source)
    assert stats.where("dataset is null").first()["num_samples"] == 80
    require_done(spark.read.parquet(target + "_status"))


def test_rejected_rows_in_isolated_jobs(spark, source, tmp_path):
    class Picky:  # workers get it by value
        def tokenize_batch(self, texts):
            if any(t.endswith("xxxxxx") for t in texts):
                raise ValueError("too many x")
            return [[len(t)] for t in texts]

    target = str(tmp_path / "tokens")
    jobs.tokenize_job(spark, source, target, lambda df: tokenize_with(df, Picky, errors="record"), max_parallel=2)
    bad = corpus(spark).where(F.col("text").endswith("xxxxxx")).count()
    status = spark.read.parquet(target + "_status").agg(F.sum("rejected").alias("r"), F.sum("samples").alias("s")).first()
    assert (status["r"], status["s"]) == (bad, 80 - bad)
    assert ds.read_dataset(spark, target + "_failures").count() == bad


def test_isolated_chunks(spark, source, tmp_path):
    tokens, chunks, apart = (str(tmp_path / n) for n in ("tokens", "chunks", "apart"))
    jobs.tokenize_job(spark, source, tokens, tokenize_bytes)
    cfg = ChunkConfig(6, bos_id=0, eos_id=3, min_chunk_size=2, backfill=DUPLICATE)
    one = jobs.chunk_job(spark, tokens, chunks, cfg)
    many = jobs.chunk_job(spark, tokens, apart, cfg, max_parallel=2)
    columns = [c for c in one.columns if c != "output_size"]
    assert sorted(map(repr, many.select(columns).collect())) == sorted(map(repr, one.select(columns).collect()))
    assert ds.read_dataset(spark, apart).count() == ds.read_dataset(spark, chunks).count()


def test_units_are_found_by_name_and_errors_are_kept(spark, source, tmp_path):
    found = units(spark, source)
    assert [(u.dataset, u.subset) for u in found] == [("docs", s) for s in SUBSETS]
    corpus(spark).select("id", "text").write.parquet(str(tmp_path / "flat"))
    assert [(u.dataset, u.subset) for u in units(spark, str(tmp_path / "flat"))] == [("flat", "unnamed")]
    status = run_isolated(spark, found, lambda u: (1, 0) if u.subset != SUBSETS[1] else 1 / 0, 2)
    assert [r["error"] for r in status.orderBy("subset").collect()] == [None, "ZeroDivisionError: division by zero", None, None]
    with pytest.raises(ValueError):
        run_isolated(spark, found, lambda u: (0, 0), 0)


@pytest.mark.parametrize("after_write", [True, False])
def test_a_run_killed_between_batches(spark, source, tmp_path, after_write):
    """The third batch stops the run, before or after its rows are written."""
    target, state = str(tmp_path / "tokens"), str(tmp_path / "state")
    schema = ds.read_dataset(spark, source).schema
    calls = []

    def tokens(rows):
        return tokenize_bytes(rows).drop("text")

    def breaks(rows):
        calls.append(1)
        done = tokens(rows)
        if len(calls) == 3:
            if after_write:
                part = done.withColumn(inc.BATCH, F.lit(2))
                sinks.write_subsets(part, target, by=("dataset", "subset", inc.BATCH), rebalance=False)
            raise RuntimeError("stopped here")
        return done

    options = {"schema": schema, "files_per_batch": 3}
    with pytest.raises(Exception, match="stopped here"):
        inc.run_batches(spark, source, target, state, breaks, **options)
    done = places(spark, target)
    assert 0 < len(done) < 80 and set(done) < set(places(spark, source))
    left = inc.run_batches(spark, source, target, state, tokens, **options)
    assert left == 4  # 16 files by three: six batches, of which two were finished
    assert places(spark, target) == places(spark, source)
    assert inc.read_batches(spark, target).columns.count("batch") == 0
    # Nothing new: nothing is added. A new file is one more batch.
    assert inc.run_batches(spark, source, target, state, tokens, **options) == 0
    late = corpus(spark, 84).where("sample_idx = 20")
    sinks.write_subsets(late, source, mode="append", rebalance=False)
    assert inc.run_batches(spark, source, target, state, tokens, **options) > 0
    assert places(spark, target) == places(spark, source) and len(places(spark, target)) == 84


def test_chunks_in_batches(spark, source, tmp_path):
    """Batches of a subset give the chunks that the whole subset gives."""
    tokens, target = str(tmp_path / "tokens"), str(tmp_path / "chunks")
    jobs.tokenize_job(spark, source, tokens, tokenize_bytes)
    cfg = ChunkConfig(6, bos_id=0, eos_id=3, min_chunk_size=2, backfill=DUPLICATE)
    rows = ds.read_dataset(spark, tokens)
    keep = ("dataset", "subset")
    inc.run_batches(
        spark, tokens, target, str(tmp_path / "state"), lambda df: chunk_dataset(df, cfg, keep=keep),
        schema=rows.schema, files_per_batch=1,
    )
    want = chunk_dataset(rows, cfg, keep=keep)
    got = inc.read_batches(spark, target).select(want.columns)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_rows_of_split_without_a_subset(spark):
    rows = spark.createDataFrame([("d", None, 0, "a"), ("d", "s", 0, "b")], "dataset string, subset string, shard_id long, id string")
    labels = rows.drop("id").withColumn("split", F.lit("val"))
    assert sorted(r["id"] for r in rows_of_split(rows, labels, "val").collect()) == ["a", "b"]
