"""Tokenizers by kind, each with the same surface: size, end id, tokenize, detokenize.

A kind is a name in a registry; what it stands for is made with options and then works on
DataFrames. ``bytes`` is expressions only; ``bpe``, ``words`` and ``custom`` look up in Arrow
batches. A user adds a kind with ``register``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from typing import Protocol

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from sparkprep.functions.batches import parts
from sparkprep.functions.text import BYTE_VOCAB_SIZE, byte_text
from sparkprep.operators.bpe import BpeCodec, decode
from sparkprep.operators.tokenize import tokenize_bpe, tokenize_bytes, tokenize_with, tokenize_words
from sparkprep.operators.vocab import bounded_rows

# Fixed value: the id that ends a document of bytes.
BYTE_EOD = 0


class TwoWay(Protocol):
    """What the object behind a ``custom`` tokenizer offers, inside a task."""

    def tokenize_batch(self, texts: list[str]) -> Sequence[Sequence[int]]: ...

    def detokenize(self, ids: list[int]) -> str: ...


@dataclass(frozen=True)
class CorpusTokenizer:
    """One tokenizer: ``eod`` is the id that ends a document, if it has one."""

    kind: str
    vocab_size: int
    eod: int | None
    encode: Callable[[DataFrame, str], DataFrame]
    decode: Callable[[Column], Column]

    def tokenize(self, df: DataFrame, text: str = "text", *, end: bool = False) -> DataFrame:
        """Add ``input_ids`` and ``len``; with ``end`` every document closes with ``eod``."""
        done = self.encode(df, text)
        if not end:
            return done
        if self.eod is None:
            raise ValueError(f"the {self.kind} tokenizer has no id that ends a document")
        closed = F.array_append("input_ids", F.lit(self.eod))
        return done.withColumn("input_ids", closed).withColumn("len", F.size("input_ids"))

    def detokenize(self, df: DataFrame, ids: str = "input_ids", out: str = "decoded") -> DataFrame:
        """Add the text of the ids; a closing ``eod`` is no part of it. Null ids give null."""
        inner = F.col(ids)
        if self.eod is not None:
            ended = F.get(inner, F.size(ids) - 1) == self.eod
            inner = F.when(F.coalesce(ended, F.lit(False)), F.slice(ids, 1, F.size(ids) - 1)).otherwise(inner)
        return df.withColumn(out, self.decode(inner))

    def padded_size(self, multiple: int) -> int:
        """The vocabulary size rounded up, as embedding tables want it."""
        return -(-self.vocab_size // multiple) * multiple


_KINDS: dict[str, Callable[..., CorpusTokenizer]] = {}


def register(kind: str) -> Callable[[Callable[..., CorpusTokenizer]], Callable[..., CorpusTokenizer]]:
    """Make a factory known under a name, in any case."""

    def add(factory: Callable[..., CorpusTokenizer]) -> Callable[..., CorpusTokenizer]:
        if kind.lower() in _KINDS:
            raise ValueError(f"tokenizer kind {kind!r} is registered twice")
        _KINDS[kind.lower()] = factory
        return factory

    return add


def make_tokenizer(kind: str, **options) -> CorpusTokenizer:
    """The tokenizer of a kind."""
    factory = _KINDS.get(kind.lower())
    if factory is None:
        raise ValueError(f"unknown tokenizer kind {kind!r}; there are {', '.join(sorted(_KINDS))}")
    return factory(**options)


@register("bytes")
def _bytes(vocab_size: int = BYTE_VOCAB_SIZE) -> CorpusTokenizer:
    """UTF-8 bytes. Decoding gives one character per byte, so only ASCII text comes back whole."""
    return CorpusTokenizer("bytes", vocab_size, BYTE_EOD, tokenize_bytes, lambda ids: byte_text(ids, vocab_size))


@register("bpe")
def _bpe(codec: BpeCodec, eod: str | None = "[SEP]", normalize: bool = True) -> CorpusTokenizer:
    """A learned vocabulary; decoding gives the text with its prefix space."""
    end = codec.tokens.index(eod) if eod is not None else None
    return CorpusTokenizer(
        "bpe",
        len(codec.tokens),
        end,
        lambda df, text: tokenize_bpe(df, codec, text=text, normalize=normalize),
        lambda ids: decode(ids, codec),
    )


@register("words")
def _words(vocab: DataFrame, unk_id: int, eod: int | None = None) -> CorpusTokenizer:
    """A word list of at most 65,536 entries; decoding joins words with a space."""
    rows = bounded_rows(vocab.select("token", "id"))
    if rows is None:
        raise ValueError("a vocabulary of more than 65,536 entries does not fit 16-bit ids")
    names = {r["id"]: r["token"] for r in sorted(rows, key=lambda r: r["token"], reverse=True)}
    tokens = pa.array([names.get(i, "") for i in range(max(names, default=-1) + 1)], pa.string())

    def text_of(ids: Column) -> Column:
        @F.arrow_udf(T.StringType())
        def join(batch: pa.Array) -> pa.Array:
            offsets = np.asarray(batch.offsets, dtype=np.int64)
            flat = batch.values.slice(offsets[0], offsets[-1] - offsets[0])
            mask = batch.is_null() if batch.null_count else None
            starts = pa.array((offsets - offsets[0]).astype(np.int32))
            return pc.binary_join(pa.ListArray.from_arrays(starts, tokens.take(flat), mask=mask), " ")

        return join.asNondeterministic()(ids)

    return CorpusTokenizer(
        "words", len(tokens), eod, lambda df, text: tokenize_words(df, vocab, unk_id=unk_id, text=text), text_of
    )


@register("custom")
def _custom(
    factory: Callable[[], TwoWay], vocab_size: int, eod: int | None = None, errors: str = "raise"
) -> CorpusTokenizer:
    """Any library's tokenizer; ``factory`` makes one per worker, for either direction."""

    def text_of(ids: Column) -> Column:
        @F.arrow_udf(T.StringType())
        def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            tokenizer = factory()
            for batch in batches:
                for part in parts(batch):
                    texts = [None if x is None else tokenizer.detokenize(x) for x in part.to_pylist()]
                    yield pa.array(texts, pa.string())

        return run.asNondeterministic()(ids)

    return CorpusTokenizer(
        "custom", vocab_size, eod, lambda df, text: tokenize_with(df, factory, text=text, errors=errors), text_of
    )
