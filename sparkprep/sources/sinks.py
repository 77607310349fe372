"""Writers: subset datasets, manifests and statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def write_subsets(
    df: DataFrame,
    path: str,
    *,
    by: Sequence[str] = ("dataset", "subset"),
    compression: str = "zstd",
    mode: str = "overwrite",
    max_rows_per_file: int | None = None,
    rebalance: bool = True,
) -> None:
    """Write Parquet below one folder per subset, replacing only subsets in ``df``.

    The rebalance hint lets Spark size the files: small subsets share a task,
    and a subset with a third of all rows is cut over many tasks. It is a
    shuffle. A table that was read from subset folders and not shuffled since
    has few subsets per task already and is written without it.
    """
    if compression not in ("zstd", "gzip", "none"):
        raise ValueError(f"unknown compression {compression!r}")
    codec = "uncompressed" if compression == "none" else compression
    rows = df.hint("rebalance", *by) if rebalance else df
    writer = (
        rows.write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", codec)
        .partitionBy(*by)
    )
    if max_rows_per_file:
        writer = writer.option("maxRecordsPerFile", max_rows_per_file)
    writer.parquet(path)


def write_manifest(manifest: DataFrame, path: str) -> None:
    """One JSON line per shard; a manifest of millions of shards stays many small files."""
    manifest.write.mode("overwrite").json(path)


def renumbered(manifest: DataFrame, position: str, within: Sequence[str] = ("split",)) -> DataFrame:
    """Shard entries of a merged split with new names ``shard.00000``, ``shard.00001``, ...

    ``position`` is the 1-based place of the shard in its split. The original
    place of the data stays in its key columns.
    """
    number = F.lpad((F.col(position) - 1).cast("string"), 5, "0")
    wide = (F.col(position) - 1).cast("string")
    # lpad would cut numbers of more than five digits.
    name = F.when(F.col(position) > 100_000, wide).otherwise(number)
    return manifest.withColumn("new_name", F.concat(F.lit("shard."), name))


def write_stats(stats: DataFrame, path: str, fmt: str = "json") -> None:
    """Statistics as JSON lines or as CSV with a header."""
    if fmt not in ("json", "csv"):
        raise ValueError(f"unknown format {fmt!r}")
    writer = stats.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", "true").csv(path)
    else:
        writer.json(path)
