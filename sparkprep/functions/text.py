"""Text expressions: normalization, pre-tokenization, words and byte ids."""

from __future__ import annotations

import unicodedata

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F, types as T

# The public GPT-2 pre-tokenization pattern. (?U) gives \s the
# Unicode meaning it has in the library that defines the pattern.
PIECE_PATTERN = (
    r"(?U)'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
# Byte tokenizer ids.
BYTE_EOD_ID = 0
BYTE_PAD_ID = 1
BYTE_VOCAB_SIZE = 512
BYTE_MIN_CHAR = 32


@F.arrow_udf(T.StringType())
def nfc(text: pa.Array) -> pa.Array:
    """Unicode NFC; Spark has no built-in for it. A batch of plain ASCII passes as it is.

    Texts already in NFC are returned as they are, by a quick check. (The installed
    Arrow's ``utf8_normalize`` decomposes for the form NFC, so it is of no use here.)
    """
    if pc.all(pc.string_is_ascii(text)).as_py() is not False:
        return text
    return pa.array(
        [None if t is None else unicodedata.normalize("NFC", t) for t in text.to_pylist()],
        pa.string(),
    )


def with_prefix_space(text: str | Column) -> Column:
    """Put a space before a non-empty text that does not start with one."""
    t = _col(text)
    return F.when((t == "") | t.startswith(" "), t).otherwise(F.concat(F.lit(" "), t))


def pre_tokenize(text: str | Column, *, prefix_space: bool = True) -> Column:
    """Split a text into the pieces inside which merges may happen."""
    t = with_prefix_space(text) if prefix_space else _col(text)
    return F.regexp_extract_all(t, F.lit(PIECE_PATTERN), F.lit(0))


def words(text: str | Column) -> Column:
    """Whitespace-separated words that have at least one word character.

    The classes are spelled out because ``\\s`` and ``\\w`` differ between
    regex engines: separators include the file/group/record/unit separators,
    word characters are letters, numbers of any kind and the underscore.
    """
    parts = F.split(_col(text), r"(?U)[\s\x1c-\x1f]+")
    return F.filter(parts, lambda w: w.rlike(r"[\p{L}\p{N}_]"))


def byte_ids(text: str | Column) -> Column:
    """UTF-8 bytes as ids.

    Read as ISO-8859-1 a byte is one character, so an empty-pattern split and
    ``ascii`` give the bytes without a Python worker and in linear time.
    """
    t = _col(text)
    latin = F.decode(t.cast("binary"), "ISO-8859-1")
    ids = F.transform(F.split(latin, ""), lambda c: F.ascii(c))
    return F.when(t == "", F.array().cast("array<int>")).otherwise(ids)


def byte_text(ids: str | Column, vocab_size: int = BYTE_VOCAB_SIZE) -> Column:
    """One character per id, each id clamped to [32, vocab_size].

    Multi-byte text is therefore not restored; that is the operator's contract.
    """

    def char(i: Column) -> Column:
        n = F.greatest(F.lit(BYTE_MIN_CHAR), F.least(i, F.lit(vocab_size)))
        wide = F.decode(F.unhex(F.lpad(F.hex(n), 4, "0")), "UTF-16BE")
        return F.when(n <= 255, F.char(n)).otherwise(wide)

    return F.array_join(F.transform(_col(ids), char), "")


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c
