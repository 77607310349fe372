"""SimHash near-dedup with pigeonring candidates.

The 64 bits of a fingerprint are cut into eight segments on a ring. If two
fingerprints differ in at most ``t`` bits, some segment starts a chain in which
every l consecutive segments together differ in at most l * t / 8 bits. With t = 2
the first three segments of that chain are equal, so three adjoining segments
(24 bits, from eight starts) are the join key; the rest of the chain prunes
candidates before the Hamming distance decides.

A key that very many different fingerprints share would make too many pairs. Its
fingerprints are linked by another exact way: each is listed under all
fingerprints at one bit's distance and its own; two that differ in two bits or
fewer meet under one of those, and all that meet differ in two bits or fewer, so
they are tied to the smallest one there. That needs 65 rows per fingerprint,
whatever the number of pairs, and no candidate is left out.

Equal fingerprints are one node, however many documents have them. Components are
found on the nodes and joined back.
"""

from __future__ import annotations

import xxhash
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sparkprep.llm.common import stored
from sparkprep.llm.components import connected_components

SEED = 42
SEGMENTS = 8
SEGMENT_BITS = 64 // SEGMENTS
MAX_BITS = 2
# With l * t / 8 < 1 a chain of l segments is equal: three for two bits.
KEY_SEGMENTS = (SEGMENTS - 1) // MAX_BITS
WIDE_KEY = 32
SLAB = 8_192


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The SimHash of a text over word shingles, as an unsigned 64-bit number."""
    words = (text or "").encode().lower().split()  # on bytes: A-Z and ASCII white space only
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = list(map(b" ".join, zip(*(words[i:] for i in range(shingle)))))
    total = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(grams), SLAB):
        hashes = np.array([digest(g, SEED) for g in grams[at : at + SLAB]], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.int64)
    ones = np.flatnonzero(2 * total > len(grams))
    return sum(1 << int(b) for b in ones)


def _fingerprints(batches):
    for batch in batches:
        prints = [fingerprint(t) for t in batch.column(2).to_pylist()]
        signed = np.array(prints, dtype=np.uint64).view(np.int64)
        columns = [batch.column(0), batch.column(1), pa.array(signed)]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "version", "fp"])


def fingerprints(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, version, fp``: a hash of the text, and the fingerprint as a signed BIGINT."""
    version = F.xxhash64(text).alias("version")
    rows = df.select(F.col(doc_id).cast("bigint").alias("doc_id"), version, F.col(text))
    return rows.mapInArrow(_fingerprints, "doc_id bigint, version bigint, fp bigint")


def _segment(fp: Column, i: int) -> Column:
    """Segment i of the ring."""
    i %= SEGMENTS
    return F.shiftrightunsigned(fp, SEGMENT_BITS * i).bitwiseAND(F.lit((1 << SEGMENT_BITS) - 1))


def _keys(fp: Column) -> Column:
    """One key per start on the ring: the start and the equal segments from it."""
    keys = []
    for start in range(SEGMENTS):
        key = F.lit(start).cast("bigint")
        for k in range(KEY_SEGMENTS):
            key = F.shiftleft(key, SEGMENT_BITS).bitwiseOR(_segment(fp, start + k))
        keys.append(key)
    return F.array(*keys)


def _chain(turned: Column) -> Column:
    """Whether every prefix of the chain that begins at bit 0 keeps to its share of the bits."""
    fits = F.lit(True)
    for l in range(1, SEGMENTS + 1):
        mask = (1 << (SEGMENT_BITS * l)) - 1
        mask = mask - (1 << 64) if mask >= 1 << 63 else mask
        fits = fits & (
            F.bit_count(turned.bitwiseAND(F.lit(mask).cast("bigint"))) <= l * MAX_BITS // SEGMENTS
        )
    return fits


def links(prints: DataFrame, wide_key: int = WIDE_KEY) -> DataFrame:
    """``a, b``: pairs of different fingerprints that connect all within two bits.

    ``prints`` has distinct fingerprints in ``fp``. Every pair within the distance
    is either returned or its two ends are tied through others that are.
    """
    keyed = prints.select("fp", F.explode(_keys(F.col("fp"))).alias("key"))
    sizes = stored(keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "keys")
    listed = stored(keyed.join(sizes, "key"), "candidates")
    narrow = listed.where(F.col("n") <= wide_key)
    other = narrow.select("key", F.col("fp").alias("b"))
    pairs = (
        narrow.select("key", F.col("fp").alias("a"))
        .join(other, "key")
        .where("a < b")
        .withColumn("_diff", F.expr("a ^ b"))
        # The ring of differences, turned so that the chain begins at bit 0.
        .withColumn("_turn", F.expr(f"int(shiftright(key, {KEY_SEGMENTS * SEGMENT_BITS})) * {SEGMENT_BITS}"))
        .withColumn(
            "_turned",
            F.expr("shiftrightunsigned(_diff, _turn) | if(_turn = 0, 0L, shiftleft(_diff, 64 - _turn))"),
        )
        .where(_chain(F.col("_turned")))
        .where(F.bit_count("_diff") <= MAX_BITS)
        .select("a", "b")
    )
    return pairs.union(_near_one_bit(listed.where(F.col("n") > wide_key).select("fp").distinct()))


def _near_one_bit(prints: DataFrame) -> DataFrame:
    """Ties among fingerprints by the fingerprints at most one bit from them."""
    flips = [F.col("fp")] + [
        F.expr(f"fp ^ shiftleft(1L, {i})") for i in range(64)
    ]
    balls = prints.select("fp", F.explode(F.array(*flips)).alias("at"))
    # At most 65 fingerprints meet at one, so the list is bounded.
    met = balls.groupBy("at").agg(F.collect_list("fp").alias("all")).where(F.size("all") > 1)
    ties = met.select(F.array_min("all").alias("a"), F.explode("all").alias("b"))
    return ties.where("a != b").distinct()


def near_duplicates(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", wide_key: int = WIDE_KEY
) -> DataFrame:
    """``doc_id, version, fp, component_id``: one row per row of ``df``.

    A null text, an empty one and one of white space have fingerprint zero, and
    link like any other. ``component_id`` is the smallest id of the component; rows
    with a null id take part, and their component is null only if none has an id.
    """
    rows = stored(fingerprints(df, doc_id, text), "fingerprints")
    nodes = stored(
        rows.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")), "nodes"
    )
    found = connected_components(links(nodes.select("fp"), wide_key))
    # A component's root is a member, too; ``found`` lists only those that point at it.
    roots = found.union(found.select("root", "root").distinct())
    named = nodes.join(roots, nodes["fp"] == roots["node"], "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    tied = named.where(F.col("node").isNotNull())
    first = tied.groupBy("root").agg(F.min("first").alias("component_id"))
    # Only shared or tied fingerprints need looking up; others name themselves.
    shared = stored(
        tied.join(first, "root")
        .select("fp", "component_id")
        .union(named.where("node is null and n > 1").select("fp", "first"))
        .withColumn("_shared", F.lit(True)),
        "groups",
    )
    component = F.when(F.col("_shared"), F.col("component_id")).otherwise(F.col("doc_id"))
    return rows.join(shared, "fp", "left").select(
        "doc_id", "version", "fp", component.alias("component_id")
    )


def hex_fingerprint(fp: Column) -> Column:
    """Sixteen lower-case hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
