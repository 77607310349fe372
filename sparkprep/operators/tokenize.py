"""Tokenization: bytes, word vocabulary, BPE or a tokenizer supplied by the user.

Every form adds ``input_ids`` and ``len`` to the rows and shuffles nothing, so
a corpus is tokenized where it is read.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Iterator, Protocol

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from sparkprep.functions.arrays import fits_uint16, template_single
from sparkprep.functions.batches import parts
from sparkprep.functions.groups import rollup_sums
from sparkprep.functions.text import byte_ids, nfc, words
from sparkprep.operators.bpe import BpeCodec, encode
from sparkprep.operators.vocab import bounded_rows

IDS = T.ArrayType(T.IntegerType())


class Tokenizer(Protocol):
    """What a user tokenizer offers: a batch of texts in, a batch of id lists out."""

    def tokenize_batch(self, texts: list[str]) -> Sequence[Sequence[int]]: ...


def tokenize_bytes(df: DataFrame, text: str = "text") -> DataFrame:
    """UTF-8 bytes as ids. ``len`` needs no array, so statistics never build one."""
    return df.withColumn("input_ids", byte_ids(text)).withColumn("len", F.octet_length(text))


def tokenize_words(
    df: DataFrame,
    vocab: DataFrame,
    *,
    unk_id: int,
    text: str = "text",
) -> DataFrame:
    """One id per word by lookup, ``unk_id`` for unknown words.

    A null text has null ids. Of a token that is listed twice the smaller id counts.
    A vocabulary that fits 16-bit ids goes to the tasks and words are looked up
    in Arrow batches. A larger one is joined instead.
    """
    rows = bounded_rows(vocab.select("token", "id"))
    if rows is None:
        return tokenize_words_joined(df, vocab, unk_id=unk_id, text=text)
    rows.sort(key=lambda r: r["id"])  # the first of equal tokens is found
    tokens = pa.array([r["token"] for r in rows], pa.string())
    ids = np.array([r["id"] for r in rows] + [unk_id], dtype=np.int32)

    @F.arrow_udf(IDS)
    def look_up(batch: pa.Array) -> pa.Array:
        offsets = np.asarray(batch.offsets, dtype=np.int64)
        flat = batch.values.slice(offsets[0], offsets[-1] - offsets[0])
        found = pc.fill_null(pc.index_in(flat, value_set=tokens), len(tokens))
        mask = batch.is_null() if batch.null_count else None
        return pa.ListArray.from_arrays(
            pa.array((offsets - offsets[0]).astype(np.int32)),
            pa.array(ids[np.asarray(found)]),
            mask=mask,
        )

    return _with_len(df.withColumn("input_ids", look_up.asNondeterministic()(words(text))))


def tokenize_words_joined(
    df: DataFrame,
    vocab: DataFrame,
    *,
    unk_id: int,
    text: str = "text",
    salts: int = 16,
) -> DataFrame:
    """The same by a join, for a vocabulary of any size.

    Ids depend on the text alone, so each distinct text is looked up once, under
    128 bits of its hashes, and no row key is needed. A frequent word is spread over
    ``salts`` copies of its vocabulary row. The words of one text meet again in one
    group, which is one row's worth.
    """
    key = ["_text_1", "_text_2"]
    df = df.withColumns({"_text_1": F.xxhash64(text), "_text_2": F.xxhash64(F.lit(1), text)})
    texts = df.where(F.col(text).isNotNull()).select(*key, text).dropDuplicates(key)
    placed = texts.select(*key, F.posexplode(words(text)).alias("_pos", "token")).withColumn(
        "_salt", F.pmod(F.xxhash64(*key, "_pos"), F.lit(salts)).cast("int")
    )
    copies = vocab.groupBy("token").agg(F.min("id").alias("_id")).withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    )
    looked = placed.join(copies, ["token", "_salt"], "left").select(
        *key, F.struct("_pos", F.coalesce("_id", F.lit(unk_id)).alias("_id")).alias("_at")
    )
    lists = looked.groupBy(*key).agg(F.sort_array(F.collect_list("_at")).alias("_list"))
    found = F.coalesce(F.col("_list._id"), F.array().cast("array<int>"))
    ids = F.when(F.col(text).isNotNull(), found)
    joined = df.join(lists, key, "left")
    return _with_len(joined.withColumn("input_ids", ids).drop("_list", *key))


def tokenize_bpe(
    df: DataFrame,
    codec: BpeCodec,
    *,
    text: str = "text",
    template: tuple[int, int] | None = None,
    normalize: bool = True,
) -> DataFrame:
    """BPE ids, without truncation or padding.

    ``template=(cls_id, sep_id)`` wraps them as ``[CLS] A [SEP]``.
    """
    source = nfc(F.col(text)) if normalize else F.col(text)
    ids = encode(source, codec)
    if template:
        ids = template_single(ids, *template)
    return _with_len(df.withColumn("input_ids", ids))


def tokenize_with(
    df: DataFrame, factory: Callable[[], Tokenizer], *, text: str = "text", errors: str = "raise"
) -> DataFrame:
    """Ids from any tokenizer.

    ``factory`` is called once per Python worker and may load what it likes
    there; texts arrive in Arrow batches, which it gets in parts of bounded size. With
    ``errors='record'`` a text the tokenizer rejects gets null ids and the message in
    ``error``, and the rest of its batch goes on.
    """
    if errors not in ("raise", "record"):
        raise ValueError(f"unknown errors mode {errors!r}")
    keep_going = errors == "record"
    result = T.StructType([T.StructField("ids", IDS), T.StructField("error", T.StringType())])

    @F.arrow_udf(result)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokenizer = factory()
        for batch in batches:
            for part in parts(batch):
                yield _tokenized(tokenizer, part.to_pylist(), keep_going)

    done = df.withColumn("_result", run.asNondeterministic()(F.col(text))).withColumn("input_ids", F.col("_result.ids"))
    if keep_going:
        done = done.withColumn("error", F.col("_result.error"))
    return _with_len(done.drop("_result"))


def _tokenized(tokenizer: Tokenizer, texts: list[str], keep_going: bool) -> pa.Array:
    try:
        lists, messages = list(tokenizer.tokenize_batch(texts)), [None] * len(texts)
    except Exception:
        if not keep_going:
            raise
        lists, messages = [], []
        for one in texts:
            try:
                lists.append(tokenizer.tokenize_batch([one])[0])
                messages.append(None)
            except Exception as problem:
                lists.append(None)
                messages.append(f"{type(problem).__name__}: {problem}")
    ids = pa.array(
        [None if x is None else np.asarray(x, dtype=np.int32) for x in lists],
        pa.list_(pa.int32()),
    )
    return pa.StructArray.from_arrays([ids, pa.array(messages, pa.string())], ["ids", "error"])


def uint16_violations(df: DataFrame, ids: str = "input_ids") -> DataFrame:
    """Rows with an id that a 16-bit array would wrap."""
    return df.where(~fits_uint16(ids))


def require_uint16(df: DataFrame, ids: str = "input_ids") -> DataFrame:
    """The same rows; a task that meets an id outside 16 bits fails.

    The check is part of the pass that writes the rows, so it costs no second one.
    """
    failure = F.raise_error(F.lit("an id is outside the 16-bit range"))
    return df.withColumn(ids, F.when(fits_uint16(ids), F.col(ids)).otherwise(failure))


def token_stats(df: DataFrame, *, by: Sequence[str] = ("subset",), length: str = "len") -> DataFrame:
    """``num_tokens, num_samples`` per group and overall (null group)."""
    counters = {"num_tokens": F.sum(length), "num_samples": F.count("*")}
    return rollup_sums(df, by, counters)


def _with_len(df: DataFrame) -> DataFrame:
    return df.withColumn("len", F.size("input_ids"))
