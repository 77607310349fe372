"""Tokenizer quality and dataset inspection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from sparkprep.functions.arrays import preview
from sparkprep.functions.text import words


def word_counts(
    df: DataFrame, *, by: Sequence[str] = (), text: str = "text", outer: bool = False
) -> DataFrame:
    """``by..., word, n``: words are counted per task before the shuffle.

    With ``outer`` a text without words is counted under a null word, so that
    its group stays visible.
    """
    explode = F.explode_outer if outer else F.explode
    exploded = df.select(*by, explode(words(text)).alias("word"))
    return exploded.groupBy(*by, "word").agg(F.count("*").alias("n"))


def tokenizer_metrics(
    df: DataFrame,
    tokenizers: Mapping[str, tuple[Column, int]],
    *,
    by: Sequence[str] = ("language", "dataset"),
    text: str = "text",
) -> DataFrame:
    """Fertility and share of continued words per tokenizer and group.

    ``tokenizers`` maps a name to (number of tokens of the column ``word``,
    vocabulary size). Every tokenizer sees each distinct word once; groups
    without words give 0.0.
    """
    counted = word_counts(df, by=by, text=text, outer=True)
    names = list(tokenizers)
    seen = F.when(F.col("word").isNotNull(), F.col("n")).otherwise(0)
    numbered = counted.select(
        *by, seen.alias("n"), *[tokenizers[t][0].cast("bigint").alias(f"_t{i}") for i, t in enumerate(names)]
    )
    aggs = [F.sum("n").alias("_words")]
    for i in range(len(names)):
        aggs.append(F.sum(F.col(f"_t{i}") * F.col("n")).alias(f"_tokens{i}"))
        aggs.append(F.sum(F.when(F.col(f"_t{i}") >= 2, F.col("n")).otherwise(0)).alias(f"_cont{i}"))
    totals = numbered.groupBy(*by).agg(*aggs)

    def mean(total: str) -> Column:
        return F.when(F.col("_words") > 0, F.col(total) / F.col("_words")).otherwise(F.lit(0.0))

    rows = F.array(
        *[
            F.struct(
                F.lit(t).alias("tokenizer"),
                F.lit(tokenizers[t][1]).cast("bigint").alias("vocab_size"),
                mean(f"_tokens{i}").alias("fertility"),
                mean(f"_cont{i}").alias("pcw"),
            )
            for i, t in enumerate(names)
        ]
    )
    return totals.select(*by, F.explode(rows).alias("r")).select(
        "r.tokenizer", *by, "r.fertility", "r.pcw", "r.vocab_size"
    )


def evaluation_summary(metrics: DataFrame) -> DataFrame:
    """Per dataset and tokenizer: mean fertility and PCW, rounded, best first."""
    return (
        metrics.groupBy("dataset", "tokenizer")
        .agg(
            F.round(F.avg("fertility"), 4).alias("fertility"),
            F.round(F.avg("pcw"), 4).alias("pcw"),
            F.max("vocab_size").alias("vocab_size"),
        )
        .orderBy("dataset", "fertility", "tokenizer")
    )


def inspect_samples(
    df: DataFrame, subset: str | None = None, n: int | None = 5, *, decoded: Column | None = None
) -> DataFrame:
    """The first ``n`` samples (all when None) of a subset, by default the first one.

    Columns: ``subset, sample_idx, len, min_id, max_id, input_ids`` and the text
    when ``decoded`` tells how to get it.
    """
    if subset is None:
        row = df.agg(F.min("subset").alias("s")).first()
        subset = row["s"]
    rows = df.where(F.col("subset") == subset)
    if not rows.select("subset").take(1):
        raise ValueError(f"subset {subset!r} not found")
    ordered = rows.orderBy("sample_idx")
    if n is not None:
        ordered = ordered.limit(n)
    extra = [] if decoded is None else [decoded.alias("text")]
    return ordered.select(
        "subset",
        "sample_idx",
        F.size("input_ids").alias("len"),
        F.array_min("input_ids").alias("min_id"),
        F.array_max("input_ids").alias("max_id"),
        "input_ids",
        *extra,
    )


def preview_ids(df: DataFrame, max_display: int = 50) -> DataFrame:
    """Add ``preview``: all ids, or the two ends of a long array."""
    return df.withColumn("preview", preview("input_ids", max_display))
