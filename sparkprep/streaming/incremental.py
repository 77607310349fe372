"""Resume and extend earlier runs.

State is read from the data: what is in the output is done. Nothing is marked
as done before it is written, so a lost executor or a stopped job loses no row.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from sparkprep.functions.groups import join_null_safe
from sparkprep.sources.datasets import read_dataset
from sparkprep.sources.sinks import write_subsets

CORPUS_SCHEMA = T.StructType(
    [
        T.StructField("dataset", T.StringType()),
        T.StructField("subset", T.StringType()),
        T.StructField("sample_idx", T.LongType()),
        T.StructField("id", T.StringType()),
        T.StructField("text", T.StringType()),
    ]
)


def resume_status(
    expected: DataFrame, state: DataFrame, key: Sequence[str] = ("dataset", "subset")
) -> DataFrame:
    """``status`` per subset: complete, resumable, possibly_corrupt or new.

    ``expected`` has ``samples`` per subset; ``state`` has ``samples_processed``
    and ``has_stats`` (the run that wrote the subset finished).
    """
    done = F.coalesce(F.col("samples_processed"), F.lit(0)).cast("bigint")
    finished = F.coalesce(F.col("has_stats"), F.lit(False))
    status = (
        F.when(finished, "complete")
        .when((done > 0) & (done < F.col("samples")), "resumable")
        .when(done > 0, "possibly_corrupt")
        .otherwise("new")
    )
    return join_null_safe(expected, state, key, "left").select(
        *key, "samples", done.alias("samples_processed"), status.alias("status")
    )


def output_state(
    expected: DataFrame, output: DataFrame, key: Sequence[str] = ("dataset", "subset")
) -> DataFrame:
    """The state of an output as its rows show it: a subset with every sample is finished."""
    written = output.groupBy(*key).agg(F.count("*").alias("samples_processed"))
    return join_null_safe(written, expected, key).select(
        *key, "samples_processed", (F.col("samples_processed") == F.col("samples")).alias("has_stats")
    )


def status_summary(status: DataFrame) -> DataFrame:
    """``status, subsets``"""
    return status.groupBy("status").agg(F.count("*").alias("subsets"))


def pending_rows(
    df: DataFrame, output: DataFrame, key: Sequence[str] = ("dataset", "subset", "sample_idx")
) -> DataFrame:
    """Rows that the output does not have yet: an anti join on unique row keys, not on ids."""
    return join_null_safe(df, output.select(*key), key, "left_anti")


def run_incremental(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame],
    *,
    schema: T.StructType = CORPUS_SCHEMA,
    by: Sequence[str] = ("dataset", "subset"),
    max_files_per_trigger: int | None = None,
) -> None:
    """Process the files that arrived in ``source`` since the last call, once each.

    A streaming query over the folder with ``availableNow``: the checkpoint
    remembers the files, the sink's log makes a retried batch visible once.
    """
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    query = (
        transform(reader.parquet(source))
        .writeStream.format("parquet")
        .partitionBy(*by)
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


BATCH = "batch"


def run_batches(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame],
    *,
    schema: T.StructType = CORPUS_SCHEMA,
    by: Sequence[str] = ("dataset", "subset"),
    files_per_batch: int = 16,
    compression: str = "zstd",
) -> int:
    """Process the files of ``source`` in batches that are each written exactly once.

    A subset of many files is done batch by batch, so a run that was stopped goes on inside the
    subset, with the first batch that was not finished. The batch number is the commit key: a
    batch writes below ``batch=<number>`` of its subsets and replaces what an interrupted attempt at
    the same batch left there; the checkpoint gives a repeated batch the same number and the same
    files. ``transform`` sees the rows of one batch and must treat rows one by one, as
    tokenizing and chunking do. Returns how many batches this call finished.
    """
    finished = 0

    def write(rows: DataFrame, number: int) -> None:
        nonlocal finished
        done = transform(rows).withColumn(BATCH, F.lit(number))
        write_subsets(done, target, by=(*by, BATCH), compression=compression, rebalance=False)
        finished += 1

    query = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(source)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return finished


def read_batches(spark: SparkSession, target: str) -> DataFrame:
    """What ``run_batches`` has written, without the number of the batch."""
    return read_dataset(spark, target).drop(BATCH)


def good_rows(df: DataFrame) -> DataFrame:
    """Rows the tokenizer accepted."""
    return df.where(F.col("error").isNull()).drop("error")


def quarantine(df: DataFrame, key: Sequence[str] = ("dataset", "subset", "id")) -> DataFrame:
    """Rows the tokenizer rejected, with the reason."""
    return df.where(F.col("error").isNotNull()).select(*key, "error")


def failure_status(df: DataFrame, key: Sequence[str] = ("dataset", "subset")) -> DataFrame:
    """Per subset: samples written, samples failed and one of the reasons."""
    bad = F.col("error").isNotNull()
    return df.groupBy(*key).agg(
        F.count_if(~bad).alias("samples"),
        F.count_if(bad).alias("failed"),
        F.min("error").alias("error"),
    )


def require_no_failures(status: DataFrame) -> None:
    """Raise when a subset has failed rows."""
    failed = status.where(F.col("failed") > 0)
    row = failed.agg(F.count("*").alias("subsets"), F.sum("failed").alias("rows")).first()
    if row["subsets"]:
        raise RuntimeError(f"{row['rows']} samples failed in {row['subsets']} subsets")
