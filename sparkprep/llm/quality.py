"""Line-first quality rules, in DataFrame functions only.

Each line is judged alone: by its punctuation, as navigation, as boilerplate.
Failing lines go, and a document that loses too much of its text goes with
them. Three base rules on the whole text come on top.

Everything is computed from one row, in arrays, so there is no shuffle and no
group. A null text counts as an empty one: no words, rejected. Repeated rows are
judged alike, and other columns, whatever their names, pass through untouched.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from sparkprep.llm.common import SPACE_CHARS, char_count, let, words_of

# Phrases that mark a short line as boilerplate, in lower case.
BOILERPLATE = (
    "all rights reserved",
    "cookie policy",
    "enable javascript",
    "lorem ipsum",
    "privacy policy",
    "terms of service",
    "terms of use",
)
SYMBOLS = "#*$%&|<>"
SEPARATORS = "|»›•·"
ENDS = ".!?:;,…\"'”’»)]}。！？"


@dataclass(frozen=True)
class QualityConfig:
    """Thresholds. Shares are per word of the line, ``max_loss`` of the document's words."""

    min_words: int = 50
    max_repeat_share: float = 0.5
    max_symbols: float = 0.3
    max_exclamations: float = 0.3
    max_separators: float = 0.2
    max_capitals: float = 0.6
    min_distinct: float = 0.1
    unfinished_words: int = 4
    boilerplate_words: int = 30
    max_loss: float = 0.5


def quality_columns(text: Column, config: QualityConfig = QualityConfig()) -> Column:
    """One struct with the base measures, the verdict and the text without failing lines."""
    whole = F.coalesce(text, F.lit(""))
    return let(
        F.split(whole, "\n"),
        lambda lines: let(
            F.transform(lines, words_of),
            lambda words: let(
                F.transform(lines, lambda line, i: _fails(line, F.get(words, i), config)),
                lambda fails: _document(whole, lines, words, fails, config),
            ),
        ),
    )


def _fails(line: Column, words: Column, config: QualityConfig) -> Column:
    n = F.size(words)
    letters = F.length(F.translate(line, SPACE_CHARS, ""))
    punctuation = (
        (char_count(line, "#*$%&<>") > config.max_symbols * n)
        | (char_count(line, "!") > config.max_exclamations * n)
        | (
            (n < config.unfinished_words)
            & ~F.lit(ENDS).contains(F.right(F.rtrim(F.translate(line, SPACE_CHARS, " ")), F.lit(1)))
        )
    )
    separators = char_count(line, SEPARATORS)
    navigation = (separators >= 2) & (separators > config.max_separators * n)
    lower = F.lower(line)
    phrases = F.lit(False)
    for phrase in BOILERPLATE:
        phrases = phrases | lower.contains(phrase)
    boilerplate = ((n <= config.boilerplate_words) & phrases) | (
        (n >= 10)
        & (
            (F.size(F.array_distinct(words)) < config.min_distinct * n)
            | (F.length(F.regexp_replace(line, r"\P{Lu}", "")) > config.max_capitals * letters)
        )
    )
    return (n > 0) & (punctuation | navigation | boilerplate)


def _document(
    whole: Column, lines: Column, words: Column, fails: Column, config: QualityConfig
) -> Column:
    filled = F.filter(lines, lambda line, i: F.size(F.get(words, i)) > 0)
    removed = F.aggregate(
        F.filter(words, lambda _, i: F.get(fails, i)),
        F.lit(0),
        lambda total, line: total + F.size(line),
    )
    kept_lines = F.filter(lines, lambda _, i: ~F.get(fails, i))

    def fields(flat: Column) -> Column:
        return let(
            F.struct(F.size(flat).alias("n"), repeated_words(flat).alias("repeats")),
            lambda m: _verdict(m["n"], m["repeats"]),
        )

    def _verdict(n: Column, repeats: Column) -> Column:
        failed = (n < config.min_words) | (repeats > config.max_repeat_share * n)
        return F.struct(
            n.cast("bigint").alias("n_words"),
            F.length(F.translate(whole, SPACE_CHARS, "")).cast("bigint").alias("word_chars"),
            char_count(whole, SYMBOLS).cast("bigint").alias("n_symbols"),
            let(filled, lambda x: F.size(x) - F.size(F.array_distinct(x)))
            .cast("bigint")
            .alias("n_dup_lines"),
            repeats.cast("bigint").alias("n_repeat_words"),
            failed.alias("base_failed"),
            (~failed & (removed <= config.max_loss * n)).alias("kept"),
            F.size(filled).cast("bigint").alias("n_lines"),
            (F.size(lines) - F.size(kept_lines)).cast("bigint").alias("n_lines_removed"),
            removed.cast("bigint").alias("n_words_removed"),
            F.array_join(kept_lines, "\n").alias("clean_text"),
        )

    return let(F.flatten(words), fields)


def repeated_words(words: Column, n: int = 3) -> Column:
    """Words inside an n-word window whose n words occur twice or more in the array.

    The windows are sorted by a 64-bit hash with their positions; equal
    neighbours are repeats. Their positions, sorted again, give the words they
    cover. That is n log n in the length of the document.
    """

    def hashes(w: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(w) - n),
            lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(n)]),
        )

    def covered(h: Column) -> Column:
        placed = F.sort_array(
            F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))
        )
        repeats = let(
            placed,
            lambda s: F.filter(
                s,
                lambda x, i: (x["h"] == F.get(s, i - 1)["h"]) | (x["h"] == F.get(s, i + 1)["h"]),
            ),
        )
        places = F.sort_array(F.transform(repeats, lambda x: x["i"]))
        start = F.struct(F.lit(0).alias("n"), F.lit(-n).alias("last"))
        return F.aggregate(
            places,
            start,
            lambda a, p: F.struct(
                (a["n"] + F.least(F.lit(n), p - a["last"])).alias("n"), p.alias("last")
            ),
            lambda a: a["n"],
        )

    def counted(h: Column) -> Column:
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h))

    return F.when(F.size(words) < n, F.lit(0)).otherwise(let(hashes(words), counted))


def quality(
    df: DataFrame,
    text: str = "text",
    out: str = "quality",
    config: QualityConfig = QualityConfig(),
) -> DataFrame:
    """Add the struct of measures and verdict as column ``out`` (which must be a new name)."""
    return df.withColumn(out, quality_columns(F.col(text), config))
