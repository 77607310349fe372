"""Line dedup by winnowing: later repeats of long runs of lines are deleted.

A run is a sequence of lines with words (lines without are skipped) of at least
``min_words`` words. A line is deleted if it lies in such a run that also occurs
earlier, in a document with a smaller id or further up in its own, where the two may
overlap: of one short line repeated many times only the first stays. The line's
white space at both ends does not count.

Three steps, all on rows much smaller than the text:

1. Winnowing. From every line, the shortest run of ``min_words`` words is a
   window; its smallest line hash is a fingerprint. Two equal runs contain equal
   windows and so equal fingerprints: none can be missed. Fingerprints are
   counted by place, and those at one place only drop out.
2. Positions. Windows with a shared fingerprint are joined by their content, and
   the earliest place of each content stays. The match is extended both ways: a
   window grows forward from its line, and its mirror grows backward, so that
   every line of a longer match lies in one of the two. Two neighbours that are windows by
   themselves are a window together, which takes the empty lines between them.
3. Lines in windows whose content has an earlier place are deleted.

Counts and earliest places are combined before the shuffle, and what joins is
stored first, so that Spark splits a hot content as any skewed join. Merge joins are
asked for, because all sides grow with the corpus. Nothing is compared pairwise.

Nulls and ties: a null text stays null. Documents that agree in id and text are
one document, and share its outcome. A null id comes after all others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sparkprep.llm.common import SPACE_CHARS, let, stored, words_of

MIN_WORDS = 50


def _lines(text: Column) -> Column:
    """The lines with words: number, words and two independent hashes."""
    trimmed = F.transform(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACE_CHARS)))
    numbered = F.transform(
        trimmed,
        lambda x, i: F.struct(
            i.alias("i"),
            F.size(words_of(x)).alias("n"),
            F.xxhash64(x).alias("h"),
            F.xxhash64(F.lit(1), x).alias("g"),
        ),
    )
    return F.filter(numbered, lambda x: x["n"] > 0)


def _windows(lines: Column, min_words: int, backward: bool) -> Column:
    """For each line the shortest run from it with enough words: first, last, content, fingerprint."""

    def shortest(run: Column) -> Column:
        start = F.struct(F.lit(0).alias("words"), F.lit(0).alias("lines"))
        return F.aggregate(
            run,
            start,
            lambda a, x: F.when(a["words"] >= min_words, a).otherwise(
                F.struct((a["words"] + x["n"]).alias("words"), (a["lines"] + 1).alias("lines"))
            ),
        )

    def window(run: Column, size: Column) -> Column:
        content = F.slice(run, F.lit(1), size["lines"])
        full = size["words"] >= min_words
        if backward:
            # Hashed in the order of the text; only what no forward window is already.
            content = F.reverse(content)
            full = size["words"] - F.get(run, F.lit(0))["n"] >= min_words
        return let(
            content,
            lambda c: F.when(
                full,
                F.struct(
                    F.get(c, F.lit(0))["i"].alias("first"),
                    F.get(c, size["lines"] - 1)["i"].alias("last"),
                    F.xxhash64(c["h"]).alias("k1"),
                    F.xxhash64(c["g"]).alias("k2"),
                    F.array_min(F.transform(c, lambda x: F.struct(x["h"], x["i"]))).alias("low"),
                ),
            ),
        )

    def of(run: Column) -> Column:
        return let(shortest(run), lambda size: window(run, size))

    found = F.transform(
        lines, lambda _, i: let(F.slice(lines, i + 1, F.lit(min_words)), of)
    )
    return F.filter(found, lambda x: x.isNotNull())


def _neighbours(lines: Column, min_words: int) -> Column:
    """Two lines with words, one after the other, of which each has enough words alone."""

    def pair(x: Column, y: Column) -> Column:
        low = F.least(F.struct(x["h"], x["i"]), F.struct(y["h"], y["i"]))
        return F.struct(
            x["i"].alias("first"),
            y["i"].alias("last"),
            F.xxhash64(F.array(x["h"], y["h"])).alias("k1"),
            F.xxhash64(F.array(x["g"], y["g"])).alias("k2"),
            low.alias("low"),
        )

    both = F.zip_with(
        lines,
        F.slice(lines, F.lit(2), F.size(lines)),
        lambda x, y: F.when((x["n"] >= min_words) & (y["n"] >= min_words), pair(x, y)),
    )
    return F.filter(both, lambda x: x.isNotNull())


def windows(df: DataFrame, doc_id: str, text: str, min_words: int) -> DataFrame:
    """``id, version, first, last, k1, k2, mark, place``: one row per window of a document."""

    def both(lines: Column) -> Column:
        forward = _windows(lines, min_words, backward=False)
        backward = let(
            F.reverse(lines), lambda mirror: _windows(mirror, min_words, backward=True)
        )
        return F.concat(forward, backward, _neighbours(lines, min_words))

    found = F.explode(let(_lines(F.col(text)), both)).alias("w")
    return df.where(F.col(text).isNotNull()).select(
        F.col(doc_id).alias("id"), F.xxhash64(text).alias("version"), found
    ).select(
        "id",
        "version",
        "w.first",
        "w.last",
        "w.k1",
        "w.k2",
        F.col("w.low.h").alias("mark"),
        F.col("w.low.i").alias("place"),
    )


def repeated_spans(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS
) -> DataFrame:
    """``id, version, first, last``: spans of lines that occur earlier."""
    found = stored(windows(df, doc_id, text, min_words), "windows")
    # A fingerprint is at two places if any part of its place is not the same everywhere.
    parts = [F.col("id").isNull(), F.coalesce("id", F.lit(0)), F.col("version"), F.col("place")]
    differs = F.lit(False)
    for part in parts:
        differs = differs | (F.min(part) != F.max(part))
    shared = stored(
        found.groupBy("mark").agg(differs.alias("shared")).where("shared").select("mark"), "marks"
    )
    matched = stored(found.join(shared.hint("merge"), "mark", "left_semi").drop("mark", "place"), "matches")
    order = F.struct(F.col("id").isNull().alias("late"), "id", "version", "first")
    earliest = stored(
        matched.groupBy("k1", "k2")
        .agg(F.min(order).alias("start"), F.max(order).alias("end"))
        .where("start != end")
        .select("k1", "k2", "start"),
        "earliest",
    )
    return (
        matched.join(earliest.hint("merge"), ["k1", "k2"])
        .where(order > F.col("start"))
        .select("id", "version", "first", "last")
    )


def dedup_lines(
    df: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    min_words: int = MIN_WORDS,
    removed: str = "removed_lines",
) -> DataFrame:
    """All rows, ``text`` without the repeated lines, and the numbers of those.

    ``removed`` names an added column of ascending line numbers from zero, empty
    where nothing was deleted. Lines without words between deleted ones of a run go
    with it.
    """
    gone = stored(
        repeated_spans(df, doc_id, text, min_words)
        .select("id", "version", F.explode(F.sequence("first", "last")).alias("line"))
        .groupBy("id", "version")
        .agg(F.sort_array(F.collect_set("line")).alias("_lines")),
        "removed",
    ).select(F.col("id").alias("_id"), F.col("version").alias("_version"), "_lines")
    same = F.col(doc_id).eqNullSafe(F.col("_id")) & (F.xxhash64(text) == F.col("_version"))
    none = F.array().cast("array<int>")
    return (
        df.join(gone.hint("merge"), same, "left")
        .withColumn(text, without_lines(F.col(text), F.col("_lines")))
        .withColumn(removed, F.coalesce("_lines", none))
        .drop("_id", "_version", "_lines")
    )


def without_lines(text: Column, numbers: Column) -> Column:
    """The text without the lines of these numbers; the text itself if they are null."""

    def cut(lines: Column) -> Column:
        kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), numbers)
        return F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")

    return F.when(numbers.isNull(), text).otherwise(let(F.split(text, "\n"), cut))
