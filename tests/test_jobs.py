"""Whole jobs on the given documents: train, tokenize, resume, chunk, sample, split."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sparkprep.operators import bpe
from sparkprep.operators.chunk import MOVE, ChunkConfig, chunk_stats, written_chunk_stats
from sparkprep.operators.tokenize import tokenize_bpe, tokenize_bytes
from sparkprep.plans import jobs, tables
from sparkprep.sources import datasets as ds, sinks

SF = "/root/testdata/sf0.001"


def byte_tokens(df):
    return tokenize_bytes(df)


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("raw")
    for name, make in (("docs", tables.documents), ("talks", tables.conversations)):
        sinks.write_subsets(make(spark, SF), str(root / name))
    return root


def test_train_job(spark, raw, tmp_path):
    texts = ds.read_dataset(spark, str(raw / "talks"))
    learned = jobs.train_job(spark, texts, str(tmp_path), vocab_size=100, max_spaces=4)
    vocab = spark.read.parquet(str(tmp_path / "vocab"))
    assert vocab.count() == 128 and vocab.where("token = '  ' and id = 100").count() == 1
    assert vocab.select("id").distinct().count() == 128
    codec = bpe.load_codec(vocab, spark.read.parquet(str(tmp_path / "merges")))
    assert codec.piece(" the") == bpe.codec_of(learned).piece(" the")
    tokens = tokenize_bpe(texts, codec, template=(0, 3))
    assert tokens.where("input_ids[0] != 0 or element_at(input_ids, -1) != 3").count() == 0


def test_tokenize_resume_chunk_sample(spark, raw, tmp_path):
    source, tokens, chunks = str(raw / "docs"), str(tmp_path / "tokens"), str(tmp_path / "chunks")
    corpus = ds.read_dataset(spark, source)
    jobs.tokenize_job(spark, source, tokens, byte_tokens, subset="000_00002")
    assert spark.read.parquet(tokens).select("subset").distinct().count() == 1

    # A subset that was stopped half-way and one that was never begun.
    half = byte_tokens(corpus.where("subset = '000_00003' and sample_idx < 100"))
    sinks.write_subsets(half.select("dataset", "subset", "sample_idx", "id", "input_ids", "len"), tokens)
    before = {r.id for r in spark.read.parquet(tokens).select("id").collect()}
    stats = jobs.tokenize_job(spark, source, tokens, byte_tokens, resume=True)
    written = spark.read.parquet(tokens)
    assert written.count() == corpus.count() == written.select("id").distinct().count()
    assert before < {r.id for r in written.select("id").collect()}
    total = stats.where("dataset is null").first()
    assert total.num_tokens == corpus.agg(F.sum(F.octet_length("text"))).first()[0]
    jobs.tokenize_job(spark, source, tokens, byte_tokens, resume=True)
    assert spark.read.parquet(tokens).count() == corpus.count()

    cfg = ChunkConfig(
        256, 256, 257, min_chunk_size=128, always_skip_size=16, min_sample_tokens=90, backfill=MOVE
    )
    stats = jobs.chunk_job(spark, tokens, chunks, cfg).where("dataset is null").first()
    out = spark.read.parquet(chunks)
    assert out.count() == stats.total_output_chunks
    assert out.agg(F.sum("len")).first()[0] == stats.total_tokens_written
    again = chunk_stats(spark.read.parquet(tokens), cfg, by=["dataset", "subset"])
    assert again.exceptAll(written_chunk_stats(spark.read.parquet(tokens), out, cfg, by=["dataset", "subset"])).count() == 0
    assert spark.read.json(chunks + "_percentiles").count() == 8

    picked = jobs.sample_job(spark, tokens, str(tmp_path / "sample"), [0, 500, 5000], 7)
    assert {r.bin_label: r.collected for r in picked.collect()} == {"(0,500]": 7, "(500,5000]": 7}
    assert spark.read.parquet(str(tmp_path / "sample")).columns == ["input_ids", "len", "bin_label"]


def test_ids_out_of_range_stop_the_job(spark, raw, tmp_path):
    def wide(df):
        return tokenize_bytes(df).withColumn("input_ids", F.transform("input_ids", lambda x: x * 1000))

    with pytest.raises(Exception, match="16-bit"):
        jobs.tokenize_job(spark, str(raw / "talks"), str(tmp_path / "t"), wide)


def test_split_job(spark, raw, tmp_path):
    sources = [str(raw / "docs"), str(raw / "missing"), str(raw / "talks")]
    target = str(tmp_path / "split")
    summary = {r.split: r.samples for r in jobs.split_job(spark, sources, target, small_ratio=0.2).collect()}
    rows = spark.read.parquet(target)
    assert {r.split: r["count"] for r in rows.groupBy("split").count().collect()} == summary
    everything = sum(ds.read_dataset(spark, s).count() for s in sources if "missing" not in s)
    assert summary["train"] + summary["val"] == everything
    small = rows.where("split = 'train_small'").select("dataset", "id")
    assert small.exceptAll(rows.where("split = 'train'").select("dataset", "id")).count() == 0
    only = jobs.split_job(spark, sources, str(tmp_path / "small"), small_only=True).collect()
    assert [r.split for r in only] == ["train_small"]
    with pytest.raises(ValueError):
        jobs.split_job(spark, [str(raw / "missing")], target)


def test_chunk_job_by_subset_and_resumed(spark, raw, tmp_path):
    """Statistics cover the same subsets on both sides, whatever earlier runs left."""
    tokens, chunks = str(tmp_path / "tokens"), str(tmp_path / "chunks")
    jobs.tokenize_job(spark, str(raw / "docs"), tokens, byte_tokens)
    cfg = ChunkConfig(256, 256, 257, min_chunk_size=128, always_skip_size=16, min_sample_tokens=90)
    by = ["dataset", "subset"]
    want = {r.subset: r for r in chunk_stats(spark.read.parquet(tokens), cfg, by=by).collect()}
    for done in (["000_00001"], ["000_00001", "000_00004"]):
        stats = jobs.chunk_job(spark, tokens, chunks, cfg, subset=done[-1])
        got = {r.subset: r for r in stats.collect() if r.subset is not None}
        assert set(got) == set(done)
        for s in done:
            for c in ("total_input_samples", "total_output_chunks", "total_tokens_written"):
                assert got[s][c] == want[s][c]
            assert got[s].output_samples == want[s].total_output_chunks and got[s].output_size > 0
    # A finished subset stays as it is, an interrupted one is cut again.
    kept = {r.f for r in spark.read.parquet(chunks + "/dataset=documents/subset=000_00001").select(
        F.col("_metadata.file_name").alias("f")).distinct().collect()}
    half = spark.read.parquet(tokens).where("subset = '000_00005'").limit(3)
    sinks.write_subsets(half.withColumn("chunk_idx", F.lit(0)), chunks)
    stats = jobs.chunk_job(spark, tokens, chunks, cfg, resume=True)
    total = stats.where("dataset is null").first()
    assert total.total_output_chunks == want[None].total_output_chunks == spark.read.parquet(chunks).count()
    again = {r.f for r in spark.read.parquet(chunks + "/dataset=documents/subset=000_00001").select(
        F.col("_metadata.file_name").alias("f")).distinct().collect()}
    assert kept == again


def test_subset_with_too_many_rows_is_written_again(spark, raw, tmp_path):
    source, tokens = str(raw / "docs"), str(tmp_path / "tokens")
    corpus = ds.read_dataset(spark, source)
    rows = byte_tokens(corpus).select("dataset", "subset", "sample_idx", "id", "input_ids", "len")
    twice = rows.where("subset = '000_00006'")
    sinks.write_subsets(rows.union(twice), tokens)
    jobs.tokenize_job(spark, source, tokens, byte_tokens, resume=True)
    assert spark.read.parquet(tokens).count() == corpus.count()


def test_folder_names_stay_strings(spark, tmp_path):
    df = spark.createDataFrame([(d, s, "x") for d in ("007", "2024") for s in ("1", "02")],
                               "dataset string, subset string, text string")
    df.write.partitionBy("dataset", "subset").parquet(str(tmp_path / "d"))
    got = {(r.dataset, r.subset) for r in ds.read_dataset(spark, str(tmp_path / "d")).collect()}
    assert got == {("007", "1"), ("007", "02"), ("2024", "1"), ("2024", "02")}


def test_space_tokens_are_used(spark, raw, tmp_path):
    texts = ds.read_dataset(spark, str(raw / "talks"))
    jobs.train_job(spark, texts, str(tmp_path), vocab_size=100, max_spaces=4)
    vocab = spark.read.parquet(str(tmp_path / "vocab"))
    codec = bpe.load_codec(vocab, spark.read.parquet(str(tmp_path / "merges")))
    row = tokenize_bpe(spark.createDataFrame([("a    b",)], "text string"), codec).first()
    assert 102 in row.input_ids  # the run of four spaces
