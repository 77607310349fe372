"""Sharding by proportional stratified interleaving.

Rows are shuffled inside their source by a seeded digest; the r-th of n rows has
the fractional rank (r + 1/2) / n. Sorted by that rank, sources alternate in
proportion to their sizes everywhere, and equal consecutive cuts give shards that
all have the mixture of the whole. Row counts of shards differ by one at most (the
law ``rows``); a source's share of a shard differs from its share of the table by
less than two rows.

Both positions are exact and both come from blocks (``ranks``): the seeded digest
is uniform inside a source, and fractional ranks are uniform over all rows by
construction, so no source and no cut is one task. Texts are not moved: only ids,
sizes and digests are shuffled. ``write_shards`` moves each text once.

A null source is a source of its own. A null text has no bytes. Rows that agree in
id and text are interchangeable. An empty table has no shards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sparkprep.functions.draws import draw_hex
from sparkprep.llm.common import stored
from sparkprep.llm.ranks import block_count, running_total, uniform

SEED = 42
LAW = "rows"
RECORD_BYTES = 8


def assign_shards(
    df: DataFrame,
    shards: int,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    seed: int = SEED,
    blocks: int | None = None,
) -> DataFrame:
    """``doc_id, source, version, size, text_crc32, shard, slot`` for every row.

    ``version`` is a hash of the text, ``slot`` the place in the shard from zero.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    slim = stored(
        df.select(
            F.col(doc_id).alias("doc_id"),
            F.col(source).alias("source"),
            F.xxhash64(text).alias("version"),
            (F.octet_length(body) + RECORD_BYTES).cast("bigint").alias("size"),
            F.crc32(body.cast("binary")).alias("text_crc32"),
            draw_hex(seed, F.coalesce(F.col(doc_id).cast("string"), F.lit(""))).alias("_draw"),
        ),
        "shard-keys",
    )
    rows = slim.count()
    if not rows:
        return slim.select(
            "doc_id", "source", "version", "size", "text_crc32",
            F.lit(0).alias("shard"), F.lit(0).cast("bigint").alias("slot"),
        )
    blocks = blocks or block_count(rows)
    ranked = running_total(
        slim.withColumn("_unit", uniform("_draw")),
        F.lit(1),
        unit="_unit",
        order=["_draw", "doc_id", "version"],
        blocks=blocks,
        within=["source"],
        before="_rank",
        total="_rows",
    ).withColumn("_part", (2 * F.col("_rank") + 1) / (2 * F.col("_rows")))
    placed = running_total(
        ranked.drop("_unit"),
        F.lit(1),
        unit="_part",
        order=["source", "doc_id", "version"],
        blocks=blocks,
        before="_place",
    )
    # Shard s holds the places from ceil(s * rows / shards); the same floor inverts it.
    shard = F.expr(f"_place * {shards}L div {rows}L")
    start = F.expr(f"(shard * {rows}L + {shards - 1}L) div {shards}L")
    return (
        placed.withColumn("shard", shard.cast("int"))
        .withColumn("slot", F.col("_place") - start)
        .select("doc_id", "source", "version", "size", "text_crc32", "shard", "slot")
    )


def write_shards(
    df: DataFrame,
    assigned: DataFrame,
    path: str,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> None:
    """Write the rows as Parquet folders ``shard=...``, each sorted by ``slot``.

    Rows that agree in id, source and text take the slots of one another; each slot
    is written once. Of their other columns one row's values are kept.
    """
    keys = [F.col(doc_id), F.col(source), F.xxhash64(text)]
    names = ["_id", "_source", "_version"]
    texts = df.withColumns(dict(zip(names, keys))).dropDuplicates(names)
    same = (
        F.col("_id").eqNullSafe(assigned["doc_id"])
        & F.col("_source").eqNullSafe(assigned["source"])
        & (F.col("_version") == assigned["version"])
    )
    placed = assigned.select(
        "doc_id", "source", "version", "shard", "slot"
    )
    out = texts.join(placed, same).select(*[df[c] for c in df.columns], "shard", "slot")
    (
        out.repartitionByRange("shard", "slot")
        .sortWithinPartitions("shard", "slot")
        .write.partitionBy("shard")
        .parquet(path)
    )
