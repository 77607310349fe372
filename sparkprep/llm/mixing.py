"""Mixing sources to target weights along a time-varying curriculum.

Each source gets a target, its share of all words by weight; no source is taken
more than ``max_epochs`` times, and what that frees goes to the others by weight.
A source's target is filled by whole passes over it, then by part of a seeded
shuffle of it: a document is in the last pass if the middle of its words lies
inside what is left, so the words taken miss the target by at most half a document.

The curriculum says when. A source's weight changes linearly over the training
time t in [0, 1] around its mean; light sources come early, heavy ones late or the
other way round, and at each t all weights add up to the whole. The integral of the
schedule is the demand for the source so far; inverted at the words taken
before a document (a quadratic), it gives the document's position. Sorting by
position is a range sort.

Running totals come from blocks (``ranks``), so that no source is one task. Only
sizes and ids move; texts stay where they are.

A null text and a text of white space have size 0 and are never taken. A null
source is the last source. Rows with equal ids are ordered by their text. An
empty table has an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from sparkprep.functions.draws import draw_hex
from sparkprep.llm.common import SPACE, stored
from sparkprep.llm.ranks import block_count, running_total, uniform

SEED = 42
WEIGHTS = (5.0, 2.0, 1.0)
MAX_EPOCHS = 3
SLOPE = 0.5


def word_count(text: Column) -> Column:
    """Words of a text; zero if it is null."""
    spaced = F.btrim(F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " "))
    gaps = F.length(spaced) - F.length(F.translate(spaced, " ", ""))
    return F.when(spaced == "", 0).otherwise(gaps + 1).cast("bigint")


def source_targets(
    sizes: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    slope: float = SLOPE,
) -> DataFrame:
    """``source, source_size, target, slope`` from ``source, source_size``, one row per source.

    Weights repeat over the sources by code point, null last. A source is full if
    its limit is below its share when all sources with a smaller limit per weight are
    full too; the rest share what is left by weight.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), turn)
    limit = F.col("source_size") * F.lit(float(max_epochs))
    fill = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    onward = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    level = left / F.sum("weight").over(onward)
    shared = (
        sizes.withColumn("weight", weight)
        .withColumn("limit", limit)
        .withColumn("level", level)
        .withColumn("full", F.col("limit") <= F.col("level") * F.col("weight"))
    )
    # The level of the first source that is not full holds for all the others.
    rest = F.max(F.when(~F.col("full"), F.col("level"))).over(everything)
    target = F.when(F.col("full"), F.col("limit")).otherwise(rest * F.col("weight"))
    # Slopes weighted by targets add up to nothing: earliest for the lightest weight.
    tilt = F.lit(slope) * F.col("weight") / F.lit(float(max(weights)))
    mean = F.sum(tilt * F.col("target")).over(everything) / F.sum("target").over(everything)
    return shared.withColumn("target", target).select(
        "source", "source_size", "target", F.coalesce(tilt - mean, F.lit(0.0)).alias("slope")
    )


def position(part: Column, slope: Column) -> Column:
    """The time t at which a share ``part`` of a source's demand is used up.

    With the weight 1 + slope * (2 t - 1), the demand at t is t + slope * (t * t - t).
    """
    b = F.lit(1.0) - slope
    return 2.0 * part / (b + F.sqrt(b * b + 4.0 * slope * part))


def mix(
    df: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    version: Column | None = None,
    seed: int = SEED,
    weights: tuple[float, ...] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    slope: float = SLOPE,
    blocks: int | None = None,
) -> DataFrame:
    """``doc_id, source, version, size, source_size, target, passes, taken, positions`` per row.

    ``passes`` is how often the document is taken, ``positions`` when, ascending.
    ``version`` tells rows of one id apart; by default it is a hash of the text.
    """
    slim = stored(
        df.select(
            F.col(doc_id).alias("doc_id"),
            F.col(source).alias("source"),
            (F.xxhash64(text) if version is None else version).alias("version"),
            word_count(F.col(text)).alias("size"),
            draw_hex(seed, F.coalesce(F.col(doc_id).cast("string"), F.lit(""))).alias("_draw"),
        ),
        "mix-keys",
    )
    sizes = slim.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = stored(source_targets(sizes, weights, max_epochs, slope), "targets").select(
        F.col("source").alias("_source"), "source_size", "target", "slope"
    )
    ordered = running_total(
        slim.withColumn("_unit", uniform("_draw")),
        F.col("size"),
        unit="_unit",
        order=["_draw", "doc_id", "version"],
        blocks=blocks or block_count(slim.count()),
        within=["source"],
        before="_before",
    )
    whole = F.floor(F.col("target") / F.greatest(F.col("source_size"), F.lit(1)))
    left = F.col("target") - whole * F.col("source_size")
    last = (F.col("_before") + F.col("size") / 2 <= left) & (F.col("size") > 0)
    passes = F.when(F.col("size") > 0, whole + last.cast("int")).otherwise(0).cast("int")
    middle = F.col("_before") + F.col("size") / 2
    times = F.when(
        F.col("passes") > 0,
        F.transform(
            F.sequence(F.lit(0), F.col("passes") - 1),
            lambda k: position(
                F.least((k * F.col("source_size") + middle) / F.col("target"), F.lit(1.0)),
                F.col("slope"),
            ),
        ),
    ).otherwise(F.array().cast("array<double>"))
    return (
        ordered.join(targets, F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("passes", passes)
        .withColumn("taken", F.col("passes") * F.col("size"))
        .withColumn("positions", times)
        .select(
            "doc_id", "source", "version", "size", "source_size", "target", "passes", "taken",
            "positions",
        )
    )


def training_order(mixed: DataFrame) -> DataFrame:
    """One row per document and pass, range-sorted by position."""
    each = mixed.select("doc_id", "source", "version", F.explode("positions").alias("position"))
    return each.orderBy("position", F.col("source").asc_nulls_last(), "doc_id", "version")
