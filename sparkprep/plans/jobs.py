"""Whole jobs: read a dataset, run the operators, write the result and its statistics."""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from sparkprep.functions.groups import join_null_safe, rollup_sums

from sparkprep.operators.bpe import Merges, piece_counts, train_bpe
from sparkprep.operators.chunk import (
    ChunkConfig,
    chunk_dataset,
    length_percentiles,
    written_chunk_stats,
)
from sparkprep.operators.sample import bin_stats, sample_per_bin
from sparkprep.operators.split import (
    only_train_small,
    split_manifest,
    split_summary,
    with_small,
)
from sparkprep.operators.tokenize import require_uint16, token_stats
from sparkprep.operators.vocab import add_space_tokens, pad_vocabulary
from sparkprep.plans.isolation import DONE, STATUS, Unit, read_unit, run_isolated, source_schema, units
from sparkprep.functions.text import nfc
from sparkprep.sources.datasets import read_dataset, subset_filter, union_datasets, with_text
from sparkprep.sources.manifest import file_manifest, with_file_shards
from sparkprep.sources.sinks import renumbered, write_manifest, write_stats, write_subsets
from sparkprep.session import written
from sparkprep.streaming.incremental import (
    failure_status,
    good_rows,
    output_state,
    pending_rows,
    quarantine,
    resume_status,
)

# Labels of some two million files; beyond it they are joined by a shuffle.
LABEL_BYTES = 256 << 20
GROUP = ("dataset", "subset")


def train_job(
    spark: SparkSession,
    texts: DataFrame,
    target: str,
    *,
    vocab_size: int = 32_000,
    max_token_length: int = 64,
    max_spaces: int = 0,
    pad_multiple: int = 64,
    num_unused: int = 0,
) -> Merges:
    """Learn a vocabulary and write it, with space and padding tokens, next to its merges."""
    counts = piece_counts(with_text(texts).select(nfc(F.col("text")).alias("text")))
    learned = train_bpe(counts, vocab_size=vocab_size, max_token_length=max_token_length)
    vocab = add_space_tokens(learned.vocab(spark), max_spaces)
    vocab = pad_vocabulary(vocab, pad_multiple, num_unused)
    vocab.write.mode("overwrite").parquet(os.path.join(target, "vocab"))
    learned.table(spark).write.mode("overwrite").parquet(os.path.join(target, "merges"))
    return learned


def tokenize_job(
    spark: SparkSession,
    source: str,
    target: str,
    tokenize: Callable[[DataFrame], DataFrame],
    *,
    subset: str | None = None,
    resume: bool = False,
    compression: str = "zstd",
    max_parallel: int | None = None,
) -> DataFrame:
    """Tokenize a dataset folder; returns the statistics of what the output then holds.

    With ``resume`` finished subsets and rows already written stay as they are
    and only missing rows are added; a subset with more rows than it should have is
    written again. Rows that a tokenizer with ``errors="record"`` rejects are not
    written: they go to ``<target>_failures``, with counts per subset in
    ``<target>_status``, and a later resume tries them again. Rows are known by their
    place (``sample_idx``) in the subset; ids may repeat or be null.

    With ``max_parallel`` every subset is a job of its own, so many at a time, and an error of
    any kind ends that subset only: see ``isolated_job``.
    """
    if max_parallel is not None:

        def work(rows: DataFrame) -> tuple[DataFrame, DataFrame | None]:
            tokens = tokenize(with_text(rows))
            rejected = quarantine(tokens) if "error" in tokens.columns else None
            kept = good_rows(tokens) if rejected is not None else tokens
            return require_uint16(kept.select(*GROUP, "sample_idx", "id", "input_ids", "len")), rejected

        isolated_job(
            spark, source, target, work, subset=subset, resume=resume, compression=compression, max_parallel=max_parallel
        )
        if not _exists(spark, target):
            return spark.createDataFrame([], "dataset string, subset string, num_tokens bigint, num_samples bigint")
        stats = _with_output_size(spark, token_stats(read_dataset(spark, target), by=list(GROUP)), target)
        write_stats(stats, target.rstrip("/") + "_stats")
        return stats
    corpus = with_text(_with_dataset(read_dataset(spark, source), source))
    if subset is not None:
        corpus = subset_filter(corpus, subset)
    base = target.rstrip("/")

    def run(rows: DataFrame, mode: str) -> None:
        tokens = tokenize(rows)
        isolated = "error" in tokens.columns
        if isolated:
            # Good rows and rejected ones are two writes of one pass.
            tokens = tokens.persist(StorageLevel.DISK_ONLY)
        kept = good_rows(tokens) if isolated else tokens
        # Read from subset folders and not shuffled: the write moves no rows either.
        write_subsets(
            require_uint16(kept.select(*GROUP, "sample_idx", "id", "input_ids", "len")),
            target,
            compression=compression,
            mode=mode,
            rebalance=False,
        )
        if isolated:
            quarantine(tokens).write.mode("append").parquet(base + "_failures")
            failure_status(tokens).write.mode("append").json(base + "_status")
            tokens.unpersist()

    if resume and _exists(spark, target):
        done = read_dataset(spark, target)
        expected = corpus.groupBy(*GROUP).agg(F.count("*").alias("samples"))
        status, _ = written(resume_status(expected, output_state(expected, done)), "status")
        broken = status.where(F.col("status") == "possibly_corrupt").select(*GROUP)
        if broken.take(1):
            run(join_null_safe(corpus, broken, GROUP, "left_semi"), "overwrite")
        unfinished = status.where(F.col("status").isin("resumable", "new")).select(*GROUP)
        rows = join_null_safe(corpus, unfinished, GROUP, "left_semi")
        # Read anew: files of a subset written again are not those listed before.
        run(pending_rows(rows, read_dataset(spark, target), (*GROUP, "sample_idx")), "append")
    else:
        run(corpus, "overwrite")
    stats = token_stats(read_dataset(spark, target), by=list(GROUP))
    stats = _with_output_size(spark, stats, target)
    write_stats(stats, base + "_stats")
    return stats


def isolated_job(
    spark: SparkSession,
    source: str,
    target: str,
    work: Callable[[DataFrame], tuple[DataFrame, DataFrame | None]],
    *,
    subset: str | None = None,
    resume: bool = False,
    compression: str = "zstd",
    max_parallel: int = 4,
) -> DataFrame:
    """Transform every subset of a dataset in a job of its own; returns the status of all.

    ``work`` gives the rows to write and, if it rejects any, those. A subset is replaced as a
    whole when its job ends well, and not touched otherwise; rejected rows go to
    ``<target>_failures``. ``<target>_status`` lists every subset with its
    state, counts and error. With ``resume`` subsets listed there as done stay as they
    are. ``require_done`` turns failures into an error once all others are through.
    """
    base = target.rstrip("/")
    todo = units(spark, source)
    if subset is not None:
        todo = [u for u in todo if u.subset == subset]
        if not todo:
            raise ValueError(f"subset {subset!r} not found")
    schema = source_schema(spark, source) if todo else None
    before = spark.createDataFrame([], STATUS)
    if _exists(spark, base + "_status"):
        before, _ = written(spark.read.schema(before.schema).parquet(base + "_status"), "status")
    if resume:
        done = {(r["dataset"], r["subset"]) for r in before.where(F.col("status") == DONE).collect()}
        todo = [u for u in todo if (u.dataset, u.subset) not in done]

    def run(unit: Unit) -> tuple[int, int]:
        rows, rejected = work(read_unit(spark, source, schema, unit))
        counted = Observation()
        # Dynamic overwrite stages each job's files apart, so jobs do not meet in the target.
        write_subsets(rows.observe(counted, F.count(F.lit(1)).alias("n")), target, compression=compression, rebalance=False)
        bad = 0
        if rejected is not None:
            refused = Observation()
            write_subsets(rejected.observe(refused, F.count(F.lit(1)).alias("n")), base + "_failures", rebalance=False)
            bad = refused.get["n"]
        return counted.get["n"], bad

    status = run_isolated(spark, todo, run, max_parallel)
    current = join_null_safe(before, status, GROUP, "left_anti").unionByName(status)
    current, _ = written(current, "status")
    current.coalesce(1).write.mode("overwrite").parquet(base + "_status")
    return current


def chunk_job(
    spark: SparkSession,
    source: str,
    target: str,
    cfg: ChunkConfig,
    *,
    subset: str | None = None,
    resume: bool = False,
    compression: str = "zstd",
    reencode: Callable[[DataFrame, str], DataFrame] | None = None,
    max_parallel: int | None = None,
) -> DataFrame:
    """Cut a tokenized dataset into chunks; returns the counters of what the target then holds.

    With ``resume`` subsets that the statistics of an earlier run list are finished and
    stay. Statistics are written last, so a subset without them was interrupted and
    is cut again from the start.

    With ``max_parallel`` every subset is a job of its own and fails alone (``isolated_job``);
    what fails is missing in the statistics.
    """
    base = target.rstrip("/")
    if max_parallel is not None:
        status = isolated_job(
            spark, source, target, lambda rows: (chunk_dataset(rows, cfg, keep=GROUP, reencode=reencode), None),
            subset=subset, resume=resume, compression=compression, max_parallel=max_parallel,
        )
        parts = [u for u in units(spark, source) if _is_done(status, u)]
        return _isolated_chunk_stats(spark, source, target, cfg, parts)
    everything = _with_dataset(read_dataset(spark, source), source)
    tokens = everything if subset is None else subset_filter(everything, subset)
    finished = None
    if _exists(spark, target) and _exists(spark, base + "_stats", "json"):
        groups = ", ".join(f"{c} string" for c in GROUP)
        listed = spark.read.schema(groups).json(base + "_stats")
        finished, _ = written(listed.where(" and ".join(f"{c} is not null" for c in GROUP)), "finished")
    todo = tokens
    if resume and finished is not None:
        todo = join_null_safe(tokens, finished, GROUP, "left_anti")
    chunks = chunk_dataset(todo, cfg, keep=GROUP, reencode=reencode)
    write_subsets(chunks, target, compression=compression, rebalance=False)
    # Inputs and outputs of the same subsets: those cut now and those finished before.
    counted = tokens.select(*GROUP)
    if finished is not None:
        counted = counted.union(finished.select(*GROUP))
    counted, _ = written(counted.distinct(), "counted")
    cut = join_null_safe(read_dataset(spark, target), counted, GROUP, "left_semi")
    inputs = join_null_safe(everything, counted, GROUP, "left_semi")
    stats = written_chunk_stats(inputs, cut, cfg, by=list(GROUP))
    stats = _with_output_size(spark, stats, target)
    percentiles = length_percentiles(cut, by=list(GROUP))
    write_stats(percentiles, base + "_percentiles")
    write_stats(stats, base + "_stats")
    return stats


def _is_done(status: DataFrame, unit: Unit) -> bool:
    same = (F.col("dataset") == unit.dataset) & (F.col("subset") == unit.subset)
    return bool(status.where(same & (F.col("status") == DONE)).take(1))


def _isolated_chunk_stats(
    spark: SparkSession, source: str, target: str, cfg: ChunkConfig, parts: list[Unit]
) -> DataFrame:
    """Statistics over the subsets that are done; files of the others are not opened."""
    base = target.rstrip("/")
    if not parts:
        return spark.createDataFrame([], "dataset string, subset string")
    schema = source_schema(spark, source)
    inputs = union_datasets([read_unit(spark, source, schema, u) for u in parts])
    cut = read_dataset(spark, target)
    done = inputs.select(*GROUP).distinct()
    cut = join_null_safe(cut, done, GROUP, "left_semi")
    stats = _with_output_size(spark, written_chunk_stats(inputs, cut, cfg, by=list(GROUP)), target)
    write_stats(length_percentiles(cut, by=list(GROUP)), base + "_percentiles")
    write_stats(stats, base + "_stats")
    return stats


def sample_job(
    spark: SparkSession,
    source: str,
    target: str,
    edges: Sequence[int],
    k: int = 500,
    *,
    seed: int = 42,
    compression: str = "zstd",
) -> DataFrame:
    """Sample k sequences per length bin; returns the statistics per bin."""
    tokens = _with_dataset(read_dataset(spark, source), source)
    # A sample's place in its subset is unique; its id need not be.
    key = (*GROUP, "sample_idx")
    chosen = sample_per_bin(tokens, edges, k, seed=seed, key=key)
    rows = chosen.select("input_ids", "len", "bin_label")
    codec = "uncompressed" if compression == "none" else compression
    rows.write.mode("overwrite").option("compression", codec).parquet(target)
    stats = bin_stats(tokens, edges, chosen=spark.read.parquet(target))
    write_stats(stats, target.rstrip("/") + "_stats")
    return stats


def split_job(
    spark: SparkSession,
    sources: Sequence[str],
    target: str,
    *,
    train_ratio: float = 0.9,
    val_ratio: float = 0.1,
    small_ratio: float = 0.05,
    seed: int = 42,
    small_only: bool = False,
) -> DataFrame:
    """Merge datasets and write train, val and train_small, with a manifest.

    The shards are the files of the sources, so rows are labelled by the file
    they are read from. A source that does not exist is left out; none left is
    an error.
    """
    present = [p for p in sources if _exists(spark, p)]
    rows = union_datasets(
        [with_file_shards(_with_dataset(read_dataset(spark, p), p)) for p in present]
    )
    manifest = file_manifest(rows)
    key = (*GROUP, "basename")
    if small_only:
        labelled = only_train_small(manifest, small_ratio=small_ratio, seed=seed, key=key)
    else:
        labelled = with_small(
            split_manifest(
                manifest,
                train_ratio=train_ratio,
                val_ratio=val_ratio,
                small_ratio=small_ratio,
                seed=seed,
                key=key,
            )
        )
    listing = target.rstrip("/") + "_manifest"
    write_manifest(renumbered(labelled, "position"), listing)
    # Written once and read back, so that labels are not drawn again for each use.
    labelled = spark.read.schema(labelled.schema).json(listing)
    labels = labelled.select(*key, "split")
    # A label per file is small beside the files. It is sent to the scan while it is
    # below a fixed size, so that rows are labelled where they are read.
    size = labels.agg(F.sum(F.lit(64) + sum(F.length(c) for c in labels.columns))).first()[0]
    if (size or 0) <= LABEL_BYTES:
        labels = F.broadcast(labels)
    parts = join_null_safe(rows, labels, key).drop("basename", "file_bytes")
    write_subsets(parts, target, by=("split", *GROUP), rebalance=False)
    return split_summary(labelled)


def _with_dataset(df: DataFrame, path: str) -> DataFrame:
    """Name the dataset after its folder where the layout does not name it."""
    if "dataset" in df.columns:
        return df
    return df.withColumn("dataset", F.lit(os.path.basename(path.rstrip("/"))))


def _with_output_size(spark: SparkSession, stats: DataFrame, target: str) -> DataFrame:
    """Add ``output_samples`` and ``output_size`` (bytes of the files), with the totals."""
    files = file_manifest(with_file_shards(read_dataset(spark, target)))
    counters = {"output_samples": F.sum("samples"), "output_size": F.sum("bytes")}
    return join_null_safe(stats, rollup_sums(files, GROUP, counters), GROUP, "left")


def _exists(spark: SparkSession, path: str, fmt: str = "parquet") -> bool:
    """Is there a readable dataset?"""
    try:
        return bool(spark.read.format(fmt).load(path).columns)
    except Exception as problem:
        if "PATH_NOT_FOUND" in str(problem) or "UNABLE_TO_INFER_SCHEMA" in str(problem):
            return False
        raise
