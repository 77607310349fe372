"""Vocabulary tables: ``token STRING, id INT, special BOOLEAN``.

A vocabulary has at most 65,536 entries (ids are stored as 16-bit numbers), and
``bounded_rows`` checks that before one is sent to every executor.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Row, Window, functions as F

from sparkprep.functions.arrays import UINT16_LIMIT

# Special tokens and their ids 0..4, in this order.
SPECIAL_TOKENS = ("[CLS]", "[MASK]", "[PAD]", "[SEP]", "[UNK]")
# Candidates for the opening and the closing token, best first.
BOS_CANDIDATES = ("[CLS]", "[BOS]", "<s>")
EOS_CANDIDATES = ("[SEP]", "[EOS]", "</s>")


def special_tokens(df: DataFrame, tokens: Sequence[str] = SPECIAL_TOKENS) -> DataFrame:
    """The special tokens as the head of a vocabulary, on the session of ``df``."""
    spark = df.sparkSession
    rows = [(t, i, True) for i, t in enumerate(tokens)]
    return spark.createDataFrame(rows, "token string, id int, special boolean")


def initial_alphabet(texts: DataFrame, text: str = "text") -> DataFrame:
    """The distinct UTF-8 bytes of the corpus: ``byte, n``, at most 256 rows.

    Each text is reduced to its own distinct characters first, so the shuffle
    carries a few rows per task and not one per character.
    """
    latin = F.decode(F.col(text).cast("binary"), "ISO-8859-1")
    chars = texts.select(F.explode(F.array_distinct(F.split(latin, ""))).alias("c"))
    return (
        chars.where(F.col("c") != "")
        .groupBy(F.ascii("c").alias("byte"))
        .agg(F.count("*").alias("texts"))
    )


def word_vocabulary(counts: DataFrame, size: int, word: str = "word", n: str = "n") -> DataFrame:
    """Special tokens followed by the most frequent words, ties by word."""
    specials = special_tokens(counts)
    room = size - len(SPECIAL_TOKENS)
    top = counts.orderBy(F.desc(n), F.asc(word)).limit(room)
    order = Window.orderBy(F.desc(n), F.asc(word))  # over `room` rows at most
    numbered = top.select(
        F.col(word).alias("token"),
        (F.row_number().over(order) + len(SPECIAL_TOKENS) - 1)
        .cast("int")
        .alias("id"),
        F.lit(False).alias("special"),
    )
    return specials.unionByName(numbered)


def add_space_tokens(vocab: DataFrame, max_spaces: int) -> DataFrame:
    """Append tokens of 2..``max_spaces`` spaces with the next free ids.

    They are marked as ``added``: an encoder takes them whole, before any merge.
    """
    marked = vocab if "added" in vocab.columns else vocab.withColumn("added", F.lit(False))
    if max_spaces < 2:
        return marked
    return _extended(
        marked,
        lambda size: F.transform(
            F.sequence(F.lit(2), F.lit(max_spaces)),
            lambda i: F.struct(
                F.repeat(F.lit(" "), i), (size + i - 2).cast("int"), F.lit(False), F.lit(True)
            ),
        ),
    )


def pad_vocabulary(vocab: DataFrame, multiple: int = 64, num_unused: int = 0) -> DataFrame:
    """Append ``[unused1..k]``: ``num_unused`` of them, or up to the next multiple."""
    added = [F.lit(False)] if "added" in vocab.columns else []

    def unused(size: Column) -> Column:
        k = F.lit(num_unused) if num_unused > 0 else F.pmod(-size, F.lit(multiple))
        numbers = F.slice(F.sequence(F.lit(1), k + 1), F.lit(1), k)  # none if k is 0
        return F.transform(
            numbers,
            lambda i: F.struct(
                F.concat(F.lit("[unused"), i.cast("string"), F.lit("]")),
                (size + i - 1).cast("int"),
                F.lit(True),
                *added,
            ),
        )

    return _extended(vocab, unused)


def padded_size(size: int, multiple: int = 64, parallel: int = 1) -> int:
    """The vocabulary size rounded up to a multiple for model-parallel training."""
    unit = multiple * parallel
    return -(-size // unit) * unit


def special_ids(vocab: DataFrame) -> DataFrame:
    """One row ``bos_id, eos_id, cls_id, sep_id, pad_id, unk_id``; null when absent."""

    def first(*names: str) -> Column:
        return F.coalesce(*[F.max(F.when(F.col("token") == n, F.col("id"))) for n in names])

    return vocab.agg(
        first(*BOS_CANDIDATES).alias("bos_id"),
        first(*EOS_CANDIDATES).alias("eos_id"),
        first("[CLS]").alias("cls_id"),
        first("[SEP]").alias("sep_id"),
        first("[PAD]").alias("pad_id"),
        first("[UNK]").alias("unk_id"),
    )


def chunk_special_ids(vocab: DataFrame) -> tuple[int, int | None]:
    """The ids that open and close a chunk; a vocabulary without an opening token is an error."""
    row = special_ids(vocab).first()
    if row["bos_id"] is None:
        raise ValueError("the vocabulary has neither a CLS nor a BOS token")
    return row["bos_id"], row["eos_id"]


def bounded_rows(table: DataFrame, limit: int = UINT16_LIMIT) -> list[Row] | None:
    """The rows of a table that has at most ``limit`` of them, else None."""
    rows = table.take(limit + 1)
    return None if len(rows) > limit else rows


def _extended(vocab: DataFrame, more: Callable[[Column], Column]) -> DataFrame:
    """The vocabulary and rows that depend on its size, in one pass over what makes it.

    ``more`` gives an array of structs in the order of ``token, id, special[, added]``.
    """
    columns = [c for c in ("token", "id", "special", "added") if c in vocab.columns]
    one = vocab.agg(F.collect_list(F.struct(*columns)).alias("rows"))  # 65,536 rows at most
    kind = one.schema["rows"].dataType.simpleString()
    rows = F.concat("rows", more(F.size("rows")).cast(kind))
    return one.select(F.explode(rows).alias("row")).select("row.*")

