"""Scans of exactly the files a manifest lists, and digests of files and shards.

A split is decided on files. Its rows are read from those files alone: others are neither
opened nor scanned, and no row is labelled or joined.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from sparkprep.functions.groups import NO_SUBSET, join_null_safe
from sparkprep.sources.datasets import union_datasets

# Paths that pass through the driver in one scan. Longer lists are read in several scans.
FILES_PER_SCAN = 65_536
FILE_KEY = ("dataset", "subset", "basename")


def located_files(spark: SparkSession, source: str, glob: str = "*.parquet") -> DataFrame:
    """``path, dataset, subset, basename, bytes`` of the files below ``source``; none is opened."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .load(source)
    )

    def folder(name: str, default: str):
        found = F.regexp_extract("path", f"/{name}=([^/]*)/", 1)
        # Folder names are escaped by percent signs only; a plus is a plus.
        plain = F.try_url_decode(F.replace(found, F.lit("+"), F.lit("%2B")))
        return F.when(found != "", plain).otherwise(F.lit(default)).alias(name)

    return files.select(
        "path",
        folder("dataset", os.path.basename(source.rstrip("/"))),
        folder("subset", NO_SUBSET),
        F.element_at(F.split("path", "/"), -1).alias("basename"),
        F.col("length").alias("bytes"),
    )


def read_listed(spark: SparkSession, source: str, listed: DataFrame) -> DataFrame | None:
    """The rows of the files that ``listed`` names by ``FILE_KEY``; None if it names none of them.

    Only the paths of the listed files reach the driver, one per file.
    """
    wanted = listed.select(*FILE_KEY).distinct()
    found = join_null_safe(located_files(spark, source), wanted, FILE_KEY, "left_semi")
    rows = sorted(found.select("path", "dataset", "subset").collect())
    if not rows:
        return None
    reader = spark.read.option("basePath", source)
    # Groups come from the folder names, as strings, and from the listing where there are none.
    found_schema = reader.parquet(rows[0]["path"]).schema
    schema = T.StructType(
        [T.StructField(f.name, T.StringType()) if f.name in ("dataset", "subset") else f for f in found_schema]
    )
    paths = [r["path"] for r in rows]
    scans = [paths[at : at + FILES_PER_SCAN] for at in range(0, len(paths), FILES_PER_SCAN)]
    merged = union_datasets([reader.schema(schema).parquet(*part) for part in scans])
    for name in ("dataset", "subset"):
        if name not in merged.columns:
            merged = merged.withColumn(name, F.lit(rows[0][name]))
    return merged


def read_split(spark: SparkSession, sources: Sequence[str], labelled: DataFrame, split: str) -> DataFrame:
    """The rows of one split of a labelled file manifest (``FILE_KEY, split``)."""
    wanted = labelled.where(F.col("split") == split)
    parts = [rows for s in sources if (rows := read_listed(spark, s, wanted)) is not None]
    return union_datasets(parts)


def file_digests(spark: SparkSession, source: str, glob: str = "*.parquet") -> DataFrame:
    """``dataset, subset, basename, bytes, sha1`` of the bytes of every file.

    A task holds one file at a time, so a file may be as large as a shard.
    """
    contents = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(source)
    )
    digests = contents.select(F.col("path").alias("_path"), F.sha1("content").alias("sha1"))
    places = located_files(spark, source, glob)
    return places.join(digests, places["path"] == digests["_path"]).select(*FILE_KEY, "bytes", "sha1")


def changed_files(listed: DataFrame, found: DataFrame) -> DataFrame:
    """``dataset, subset, basename, issue``: files that are missing, changed or not listed.

    Both sides have ``FILE_KEY`` and ``sha1``, the digests then and now.
    """
    then = listed.select(*FILE_KEY, F.col("sha1").alias("_then"))
    now = found.select(*FILE_KEY, F.col("sha1").alias("_now"))
    both = then.join(now, list(FILE_KEY), "full")
    issue = (
        F.when(F.col("_now").isNull(), "missing")
        .when(F.col("_then").isNull(), "not listed")
        .when(F.col("_then") != F.col("_now"), "changed")
    )
    return both.select(*FILE_KEY, issue.alias("issue")).where("issue is not null")


def row_digest(*columns: str):
    """The SHA-256 of a row's columns with their lengths; null is not empty."""
    parts = []
    for c in columns:
        text = F.col(c).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def shard_digests(df: DataFrame, digest: str = "row_digest", order: str = "sample_idx") -> DataFrame:
    """``dataset, subset, shard_id, samples, digest``: the SHA-256 of the row digests in order.

    Two shards agree only if they hold the same rows in the same order. A shard's digests, 64
    characters a row, are one group: a shard is bounded by its byte limit.
    """
    listed = F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), F.col(digest).alias("d"))))
    grouped = df.groupBy("dataset", "subset", "shard_id").agg(F.count("*").alias("samples"), listed.alias("_l"))
    return grouped.select(
        "dataset", "subset", "shard_id", "samples", F.sha2(F.array_join("_l.d", ""), 256).alias("digest")
    )
