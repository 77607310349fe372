"""Manifests: one row per shard, read from files or computed from the data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from sparkprep.functions.groups import join_null_safe, rollup_sums
from sparkprep.functions.order import prefix_sum
from sparkprep.sources.datasets import SUBSET_PATTERN

SHARD_BYTES = 67_108_864  # fixed value: 64 MB
INDEX_NAME = "index.json"  # fixed value: the manifest of a subset folder

_FILE = T.StructType(
    [
        T.StructField("basename", T.StringType()),
        T.StructField("bytes", T.LongType()),
        T.StructField("hashes", T.MapType(T.StringType(), T.StringType())),
    ]
)
# The fields of one shard entry of an index.json file.
SHARD_SCHEMA = T.StructType(
    [
        T.StructField("column_encodings", T.ArrayType(T.StringType())),
        T.StructField("column_names", T.ArrayType(T.StringType())),
        T.StructField("column_sizes", T.ArrayType(T.IntegerType())),
        T.StructField("compression", T.StringType()),
        T.StructField("format", T.StringType()),
        T.StructField("hashes", T.ArrayType(T.StringType())),
        T.StructField("raw_data", _FILE),
        T.StructField("samples", T.LongType()),
        T.StructField("size_limit", T.LongType()),
        T.StructField("version", T.IntegerType()),
        T.StructField("zip_data", _FILE),
    ]
)
INDEX_SCHEMA = T.StructType(
    [
        T.StructField("shards", T.ArrayType(SHARD_SCHEMA)),
        T.StructField("version", T.IntegerType()),
    ]
)


def list_files(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """``path, dataset_path, subset, basename, bytes`` of files; contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .load(root)
    )
    parts = F.split("path", "/")
    folder = F.regexp_replace(F.element_at(parts, -2), "^subset=", "")
    return files.select(
        "path",
        F.array_join(F.slice(parts, F.lit(1), F.size(parts) - 2), "/").alias("dataset_path"),
        folder.alias("subset"),
        F.element_at(parts, -1).alias("basename"),
        F.col("length").alias("bytes"),
    )


def discover_subsets(spark: SparkSession, root: str, name: str = INDEX_NAME) -> DataFrame:
    """``dataset_path, subset`` of the folders with a valid name and a manifest."""
    manifests = list_files(spark, root, name)
    return (
        manifests.where(F.col("subset").rlike(SUBSET_PATTERN))
        .select("dataset_path", "subset")
        .orderBy("dataset_path", "subset")
    )


def read_index_files(spark: SparkSession, root: str, name: str = INDEX_NAME) -> DataFrame:
    """One row per shard of every manifest file below ``root``.

    A file that cannot be parsed gives one row with null ``shard`` fields, so
    that verification can report it.
    """
    raw = (
        spark.read.schema(INDEX_SCHEMA)
        .option("multiLine", "true")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", name)
        .json(root)
    )
    parts = F.split(F.col("_metadata.file_path"), "/")
    located = raw.select(
        F.array_join(F.slice(parts, F.lit(1), F.size(parts) - 2), "/").alias("dataset_path"),
        F.regexp_replace(F.element_at(parts, -2), "^subset=", "").alias("subset"),
        F.posexplode_outer("shards").alias("shard_id", "shard"),
    ).where(F.col("subset").rlike(SUBSET_PATTERN))
    return located.select("dataset_path", "subset", "shard_id", "shard.*")


def assign_shards(
    df: DataFrame, bytes_col: Column, limit: int = SHARD_BYTES, block_rows: int | None = None
) -> DataFrame:
    """Add ``shard_id``: a new shard begins whenever ``limit`` bytes are full.

    Shards are cut at multiples of the limit on the running total: one may exceed
    it by less than a sample, and a sample above the limit leaves a number out. Cutting
    before the limit is passed would make each cut depend on all cuts before it.

    The running total is per subset in sample order and is built from block
    totals, so one large subset is not summed in one task.
    """
    extra = {} if block_rows is None else {"block_rows": block_rows}
    summed = prefix_sum(
        df,
        bytes_col.cast("bigint"),
        within=["dataset", "subset"],
        order="sample_idx",
        out="_cum",
        **extra,
    )
    shard = F.floor(F.greatest(F.col("_cum") - 1, F.lit(0)) / F.lit(limit)).cast("bigint")
    return summed.withColumn("shard_id", shard).drop("_cum")


def build_manifest(sharded: DataFrame, bytes_col: Column) -> DataFrame:
    """``dataset, subset, shard_id, samples, bytes`` from rows with a ``shard_id``."""
    return sharded.groupBy("dataset", "subset", "shard_id").agg(
        F.count("*").alias("samples"), F.sum(bytes_col).cast("bigint").alias("bytes")
    )


def with_file_shards(df: DataFrame) -> DataFrame:
    """Add ``basename`` and ``file_bytes`` of the file a row is read from: its shard."""
    return df.select(
        "*",
        F.col("_metadata.file_name").alias("basename"),
        F.col("_metadata.file_size").alias("file_bytes"),
    )


def file_manifest(rows: DataFrame) -> DataFrame:
    """``dataset, subset, basename, samples, bytes``: one row per file of a dataset.

    Needs rows from ``with_file_shards``; no data column is read.
    """
    return rows.groupBy("dataset", "subset", "basename").agg(
        F.count("*").alias("samples"), F.max("file_bytes").alias("bytes")
    )


def row_fingerprint(*columns: str) -> Column:
    """60 bits of a row. With its place in the row, equal rows differ; null is not empty."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in columns]
    digest = F.md5(F.concat_ws("\u0001", *parts))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def shard_fingerprints(df: DataFrame, row: str = "row_fingerprint") -> DataFrame:
    """Per shard: row count and a fingerprint of its rows, from one number per row.

    The numbers are taken before rows are placed in shards, so no text is shuffled.
    """
    return df.groupBy("dataset", "subset", "shard_id").agg(
        F.count("*").alias("samples"), F.bit_xor(row).alias("fingerprint")
    )


def count_samples(manifest: DataFrame) -> DataFrame:
    """Shards and samples per subset, per dataset (null subset) and in all (nulls)."""
    counters = {"shards": F.count("*"), "samples": F.sum("samples")}
    return rollup_sums(manifest, ["dataset", "subset"], counters)


def is_compressed(manifest: DataFrame) -> DataFrame:
    """Per subset: does any shard list a compressed file?"""
    return manifest.groupBy("dataset_path", "subset").agg(
        F.max(F.col("zip_data.basename").isNotNull()).alias("compressed")
    )


def structure_issues(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """One row per listed but missing file: ``dataset, subset, issue``.

    ``manifest`` needs ``dataset, subset, basename``; a null basename stands for
    a manifest that could not be read.
    """
    keys = ["dataset", "subset", "basename"]
    missing = manifest.where(F.col("basename").isNotNull()).join(
        files.select(*keys).distinct(), keys, "left_anti"
    )
    unreadable = manifest.where(F.col("basename").isNull())
    return missing.select(
        "dataset", "subset", F.concat(F.lit("missing shard file: "), "basename").alias("issue")
    ).unionByName(
        unreadable.select("dataset", "subset", F.lit("unreadable manifest").alias("issue"))
    )


def verify_structure(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """Per dataset: ``valid, total_subsets, total_shards, total_samples, issues``."""
    totals = manifest.groupBy("dataset").agg(
        F.countDistinct("subset").alias("total_subsets"),
        F.count("basename").alias("total_shards"),
        F.coalesce(F.sum("samples"), F.lit(0)).cast("bigint").alias("total_samples"),
    )
    issues = structure_issues(manifest, files).groupBy("dataset").agg(
        F.count("*").alias("issues")
    )
    return totals.join(issues, "dataset", "left").select(
        "dataset",
        ((F.col("total_subsets") > 0) & F.col("issues").isNull()).alias("valid"),
        "total_subsets",
        "total_shards",
        "total_samples",
        F.coalesce("issues", F.lit(0)).cast("bigint").alias("issues"),
    )


def corpus_summary(expected: DataFrame, manifest: DataFrame, files: DataFrame) -> DataFrame:
    """One row per expected dataset, plus the total (null dataset).

    A dataset with no shards or with issues counts as failed.
    """
    checked = expected.select("dataset").join(
        verify_structure(manifest, files), "dataset", "left"
    )
    failed = ~F.coalesce(F.col("valid"), F.lit(False))
    return checked.rollup("dataset").agg(
        F.coalesce(F.sum("total_subsets"), F.lit(0)).cast("bigint").alias("subsets"),
        F.coalesce(F.sum("total_shards"), F.lit(0)).cast("bigint").alias("shards"),
        F.coalesce(F.sum("total_samples"), F.lit(0)).cast("bigint").alias("samples"),
        F.sum(failed.cast("bigint")).alias("failed"),
    )


def with_sample_ranges(manifest: DataFrame) -> DataFrame:
    """Add ``first_index`` and ``end_index``: the global sample numbers of each shard.

    Subsets are laid end to end in dataset, subset order. One window sees a row
    per subset, the other a row per block of shards.
    """
    subset_sizes = manifest.groupBy("dataset", "subset").agg(F.sum("samples").alias("_rows"))
    before = Window.orderBy("dataset", "subset").rowsBetween(Window.unboundedPreceding, -1)
    starts = subset_sizes.select(
        "dataset", "subset", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start")
    )
    summed = prefix_sum(
        manifest, F.col("samples"), within=["dataset", "subset"], order="shard_id", out="_cum"
    )
    summed = join_null_safe(summed, starts, ["dataset", "subset"])
    end = (F.col("_start") + F.col("_cum")).cast("bigint")
    return (
        summed.withColumn("end_index", end)
        .withColumn("first_index", F.col("end_index") - F.col("samples"))
        .drop("_start", "_cum")
    )


def locate_indices(indices: DataFrame, manifest: DataFrame, bucket: int = 4096) -> DataFrame:
    """Global index -> ``dataset, subset, shard_id, offset``.

    A range join turned into an equi-join: each shard is listed in the index
    buckets it touches, and an index looks in its own bucket only.
    """
    ranged = with_sample_ranges(manifest).where(F.col("samples") > 0)
    touched = ranged.withColumn(
        "_bucket",
        F.explode(
            F.sequence(
                F.floor(F.col("first_index") / bucket),
                F.floor((F.col("end_index") - 1) / bucket),
            )
        ),
    ).select("dataset", "subset", "shard_id", "first_index", "end_index", "_bucket")
    looked = indices.withColumn("_bucket", F.floor(F.col("index") / bucket))
    inside = (F.col("index") >= F.col("first_index")) & (F.col("index") < F.col("end_index"))
    return (
        looked.join(touched, "_bucket")
        .where(inside)
        .select(
            "index",
            "dataset",
            "subset",
            "shard_id",
            (F.col("index") - F.col("first_index")).alias("offset"),
        )
    )
