"""Corpus scans: partitioned datasets, JSON lines, unions, limits and filters.

A dataset is a table ``dataset, subset, sample_idx, id, text``. ``subset`` is a
partition value, so a filter on it prunes files; ``sample_idx`` is the explicit
order of a sample in its subset.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window, functions as F, types as T

from sparkprep.functions.draws import draw_hex
from sparkprep.functions.groups import NO_SUBSET
from sparkprep.functions.order import BLOCK_ROWS

# Fixed value: a subset folder is three digits, an underscore and five digits.
SUBSET_PATTERN = r"^\d{3}_\d{5}$"


def read_dataset(spark: SparkSession, path: str, dataset: str | None = None) -> DataFrame:
    """A Parquet dataset laid out as ``[dataset=..../]subset=.../``.

    A dataset without subset folders is read whole, as one subset named ``NO_SUBSET``.
    Folder names are strings, whatever they look like: ``007`` stays ``007``.
    """
    df = spark.read.parquet(path)
    names = [f for f in df.schema if f.name in ("dataset", "subset")]
    if any(not isinstance(f.dataType, T.StringType) for f in names):
        fields = [
            T.StructField(f.name, T.StringType()) if f.name in ("dataset", "subset") else f
            for f in df.schema
        ]
        df = spark.read.schema(T.StructType(fields)).parquet(path)
    if "subset" not in df.columns:
        df = df.withColumn("subset", F.lit(NO_SUBSET))
    if dataset is not None:
        df = df.withColumn("dataset", F.lit(dataset))
    return df


def read_jsonl(
    spark: SparkSession, folder: str, text_key: str = "text", schema: T.StructType | None = None
) -> DataFrame:
    """The text column of every ``*.jsonl`` and ``*.json`` file of a folder.

    Only ``text_key`` is parsed, and no schema inference pass is made.
    """
    schema = schema or T.StructType([T.StructField(text_key, T.StringType())])
    lines = spark.read.option("pathGlobFilter", "*.{jsonl,json}").schema(schema).json(folder)
    return lines.select(F.col(text_key).alias("text"))


def as_corpus(
    df: DataFrame,
    *,
    dataset: str,
    number: int,
    id: Column,
    order: Column,
    subset: Column,
    text: str = "text",
) -> DataFrame:
    """Bring any table of texts to the dataset shape."""
    name = F.concat(
        F.lpad(F.lit(str(number)), 3, "0"), F.lit("_"), F.lpad(subset.cast("string"), 5, "0")
    )
    return df.select(
        F.lit(dataset).alias("dataset"),
        name.alias("subset"),
        order.cast("bigint").alias("sample_idx"),
        id.cast("string").alias("id"),
        F.col(text).alias("text"),
    )


def union_datasets(datasets: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL of datasets; differing columns or types are an error."""
    if not datasets:
        raise ValueError("no dataset to merge")
    first = {f.name: f.dataType for f in datasets[0].schema}
    for other in datasets[1:]:
        fields = {f.name: f.dataType for f in other.schema}
        if fields != first:
            raise ValueError(f"datasets disagree on their columns: {first} and {fields}")
    merged = datasets[0]
    for other in datasets[1:]:
        merged = merged.unionByName(other)
    return merged


def with_text(df: DataFrame, text_key: str = "text") -> DataFrame:
    """Rows that have a text; a sample without the key is ignored."""
    return df.where(F.col(text_key).isNotNull())


def subset_filter(df: DataFrame, subset: str, *, required: bool = True) -> DataFrame:
    """Rows of one subset; an absent subset is an error.

    The check reads one row of a pruned scan.
    """
    rows = df.where(F.col("subset") == subset)
    if required and not rows.select("subset").take(1):
        raise ValueError(f"subset {subset!r} not found")
    return rows


def limit_lines(
    df: DataFrame,
    n: int,
    *,
    datasets: Sequence[str],
    descending: Sequence[str] = (),
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """The first ``n`` texts in dataset, subset, sample order.

    ``datasets`` gives the dataset order; those in ``descending`` list their
    subsets from the last to the first. Row counts per subset, then per block of
    the subset the limit falls in, then the numbers of one block, locate the last
    sample to keep. Three single rows come to the driver; the texts are only
    filtered, by a predicate the scan can prune with, and never shuffled.
    """
    rank = {name: i for i, name in enumerate(datasets)}
    known = df.where(F.col("dataset").isin(*datasets))
    if n <= 0:
        return known.limit(0)
    position = F.lit(-1)
    for name, i in rank.items():
        position = F.when(F.col("dataset") == name, i).otherwise(position)
    backwards = F.col("dataset").isin(*descending) if descending else F.lit(False)

    def running(counts: DataFrame, *order: Column) -> DataFrame:
        w = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return counts.withColumn("_cum", F.sum("_rows").over(w))

    def first_reaching(counts: DataFrame, target: int) -> Row | None:
        return counts.where(F.col("_cum") >= target).orderBy("_cum").first()

    subsets = known.groupBy("dataset", "subset").agg(F.count("*").alias("_rows"))
    cut = first_reaching(
        running(
            subsets,
            position,
            F.when(~backwards, F.col("subset")).asc_nulls_first(),
            F.when(backwards, F.col("subset")).desc_nulls_last(),
        ),
        n,
    )
    if cut is None:
        return known
    target = n - (cut["_cum"] - cut["_rows"])
    in_subset = known.where(
        (F.col("dataset") == cut["dataset"]) & F.col("subset").eqNullSafe(cut["subset"])
    )
    number = F.floor(F.col("sample_idx") / F.lit(block_rows))
    blocks = in_subset.groupBy(number.alias("_block")).agg(F.count("*").alias("_rows"))
    block = first_reaching(running(blocks, F.col("_block")), target)
    target -= block["_cum"] - block["_rows"]
    row_number = F.row_number().over(Window.orderBy("sample_idx"))
    last = (
        in_subset.where(number == block["_block"])
        .select("sample_idx", row_number.alias("_r"))
        .where(F.col("_r") == target)
        .first()["sample_idx"]
    )
    earlier = F.col("subset") < cut["subset"]
    if cut["dataset"] in descending:
        earlier = F.col("subset") > cut["subset"]
    same = F.col("dataset") == cut["dataset"]
    return known.where(
        F.col("dataset").isin(*[d for d in datasets if rank[d] < rank[cut["dataset"]]])
        | (same & F.coalesce(earlier, F.lit(False)))
        | (same & F.col("subset").eqNullSafe(cut["subset"]) & (F.col("sample_idx") <= last))
    )


def shuffled(df: DataFrame, seed: int, *key: str) -> DataFrame:
    """The rows in a seeded random order (a range-partitioned sort by hash)."""
    return df.orderBy(draw_hex(seed, *key), *key)
