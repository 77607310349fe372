"""Encoding and decoding with a public word-end BPE tokenizer.

The words of all texts are counted, in each task before they are shuffled; the most frequent
ones, with their ids, are compiled into a minimal acyclic transducer (``lexicon``) of bounded
size. Workers map its file, which Spark hands to every machine. A batch's
different words are looked up together; a word that is not in the lexicon gets
its ids by the merges themselves. So the lexicon only decides speed, never the ids.

The tokenizer's steps: special tokens are cut out first; the rest is NFC, lower
case, and cut into contractions, runs of letters, single digits and runs of other
characters, none of which crosses white space. So a text is split at white space,
and each different word is worked out once. Decoding gives the tokens of the ids,
joined by a space, as the tokenizer without a decoder does.

A null text is an empty one: no ids. Rows are independent; nothing else is shuffled
but the word counts.
"""

from __future__ import annotations

import functools
import heapq
import itertools
import json
import os
import tempfile
import unicodedata
import uuid
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession, functions as F

from sparkprep.llm import lexicon
from sparkprep.llm.common import stored

LEXICON_WORDS = 131_072
# Words and characters after which a task hands on its counts; characters counted at a time.
COUNTED_WORDS = 1_000_000
COUNTED_CHARS = 32_000_000
COUNTED_SLICE = 2_000_000
MARKS = ".,;:!?\"()"
CACHED_WORDS = 300_000
SLICE_CHARS = 500_000
# Fixed value: how the tokenizer cuts words.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
END = "</w>"


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in keep else chr(next(spare)) for b in range(256)]


def pieces_of(word: str) -> list[str]:
    """Cut a word by ``PIECES`` in the Unicode version of ``unicodedata``, the tokenizer's own.

    Characters that are assigned only in a later version are neither letters nor numbers.
    """
    if word.isascii() or not any(unicodedata.category(c) == "Cn" for c in word):
        return _USUAL.findall(word)
    return _exact_pattern().findall(word)


_USUAL = regex.compile(PIECES)


@functools.cache
def _exact_pattern() -> regex.Pattern:
    """``PIECES`` with letters and numbers of later versions excluded; slow, and rarely needed."""
    unassigned = [c for c in map(chr, range(0x110000)) if unicodedata.category(c) == "Cn"]
    later = "".join(regex.escape(c) for c in unassigned if regex.match(r"[\p{L}\p{N}]", c))
    if not later:
        return _USUAL
    marks = PIECES.split("|[")[0]
    rest = rf"[[^\s\p{{L}}\p{{N}}]||[{later}]]+"
    return regex.compile(rf"(?V1){marks}|[\p{{L}}--[{later}]]+|[\p{{N}}--[{later}]]|{rest}")


def plain_pieces(word: str) -> list[str]:
    """The pieces of a word as the tokenizer normalizes it."""
    return pieces_of(unicodedata.normalize("NFC", word).replace("Σ", "σ").lower())


class Merges:
    """The vocabulary and merges of a tokenizer file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        letters = byte_letters()
        self.plain = [vocab[c] for c in letters]
        self.ending = [vocab[c + END] for c in letters]
        # Rank of a pair, both ids in one number, and what the merge of a rank gives.
        self.ranks: dict[int, int] = {}
        self.merged: list[int] = []
        for rank, merge in enumerate(spec["model"]["merges"]):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            self.ranks[vocab[a] << 20 | vocab[b]] = rank
            self.merged.append(vocab[a + b])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        names = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        self.tokens = [names.get(i, "") for i in range(max(names) + 1)]

    def merge(self, piece: bytes) -> list[int]:
        """The ids of one piece: the merge of lowest rank first, from the left."""
        ids = [self.plain[b] for b in piece[:-1]] + [self.ending[piece[-1]]]
        return self._by_heap(ids) if len(ids) > 48 else self._by_scan(ids)

    def _by_scan(self, ids: list[int]) -> list[int]:
        ranks, merged = self.ranks, self.merged
        none = len(merged)
        found = [ranks.get(a << 20 | b, none) for a, b in zip(ids, ids[1:])]
        while found:
            best = min(found)
            if best == none:
                break
            i = found.index(best)
            ids[i] = merged[best]
            del ids[i + 1], found[i]
            if i:
                found[i - 1] = ranks.get(ids[i - 1] << 20 | ids[i], none)
            if i < len(found):
                found[i] = ranks.get(ids[i] << 20 | ids[i + 1], none)
        return ids

    def _by_heap(self, ids: list[int]) -> list[int]:
        """The same for long pieces: links between neighbours, and a heap of pairs."""
        n = len(ids)
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        heap: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            j = right[i]
            if j >= 0:
                rank = self.ranks.get(ids[i] << 20 | ids[j])
                if rank is not None:
                    heapq.heappush(heap, (rank, i, ids[i], ids[j]))

        for i in range(n):
            offer(i)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = right[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j] = self.merged[rank], -1
            right[i] = right[j]
            if right[j] >= 0:
                left[right[j]] = i
            offer(i)
            if left[i] >= 0:
                offer(left[i])
        return [x for x in ids if x >= 0]


class Encoder:
    """Encodes texts; remembers the words it has met, up to a limit."""

    def __init__(self, merges: Merges, known: lexicon.Lexicon | None) -> None:
        self.merges, self.known = merges, known
        self.special = regex.compile("|".join(map(regex.escape, merges.special)) or r"(?!)")
        self.odd = regex.compile("[\x1c-\x1f]")  # white space to Python, but not here
        self._reset()

    def _reset(self) -> None:
        self.code: dict[str, int] = {}
        self.sizes, self.begins, self.ids = array("q"), array("q"), array("i")

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Row offsets and all ids of the texts."""
        if len(self.code) > CACHED_WORDS:
            self._reset()
        words = [self.words(t) for t in texts]
        self._learn(set().union(*words) - self.code.keys())
        code = self.code
        each = map(code.__getitem__, itertools.chain.from_iterable(words))
        codes = np.fromiter(each, np.int64, sum(map(len, words)))
        sizes = np.frombuffer(self.sizes, np.int64)[codes] if len(codes) else codes
        begins = np.frombuffer(self.begins, np.int64)[codes] if len(codes) else codes
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        at = np.arange(total) + np.repeat(begins - (ends - sizes), sizes)
        ids = np.frombuffer(self.ids, np.int32)[at] if total else np.zeros(0, np.int32)
        word_ends = np.concatenate([[0], ends])
        row_ends = np.cumsum([0, *map(len, words)])
        return word_ends[row_ends], ids

    def words(self, text: str) -> list[str]:
        """Special tokens, and what stands between white space."""
        if "<|" not in text or not self.special.search(text):
            return self._split(text)
        out: list[str] = []
        last = 0
        for m in self.special.finditer(text):
            out += self._split(text[last : m.start()])
            out.append(m.group())
            last = m.end()
        return out + self._split(text[last:])

    def _split(self, text: str) -> list[str]:
        if self.odd.search(text):
            return [w for w in regex.split(r"\s+", text) if w]
        return text.split()

    def _learn(self, words: set[str]) -> None:
        """Work out the ids of words, all pieces in one pass over the lexicon."""
        if not words:
            return
        order = list(words)
        pieces: list[bytes] = []
        counts = np.zeros(len(order), np.int64)
        for i, word in enumerate(order):
            if word in self.merges.special:
                pieces.append(word.encode())
                counts[i] = 1
                continue
            found = plain_pieces(word)
            counts[i] = len(found)
            pieces += [p.encode("utf-8", "surrogatepass") for p in found]
        ranks = self.known.ranks(pieces) if self.known else np.full(len(pieces), -1)
        sizes = np.zeros(len(pieces), np.int64)
        hit = ranks >= 0
        if hit.any():
            sizes[hit] = self.known.starts[ranks[hit] + 1] - self.known.starts[ranks[hit]]
        special = {w.encode(): i for w, i in self.merges.special.items()}
        worked = {}
        for i in np.flatnonzero(~hit).tolist():
            piece = pieces[i]
            worked[i] = [special[piece]] if piece in special else self.merges.merge(piece)
            sizes[i] = len(worked[i])
        ends = np.cumsum(sizes)
        flat = np.zeros(int(ends[-1]) if len(ends) else 0, np.int32)
        if hit.any():
            n = sizes[hit]
            begin, first = ends[hit] - n, self.known.starts[ranks[hit]]
            inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            flat[np.repeat(begin, n) + inside] = self.known.ids[np.repeat(first, n) + inside]
        for i, ids in worked.items():
            flat[ends[i] - len(ids) : ends[i]] = ids
        bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
        self.code.update(zip(order, range(len(self.sizes), len(self.sizes) + len(order))))
        base = len(self.ids)
        self.begins.frombytes((bounds[:-1] + base).astype(np.int64).tobytes())
        self.sizes.frombytes(np.diff(bounds).astype(np.int64).tobytes())
        self.ids.frombytes(flat.tobytes())


@functools.lru_cache(maxsize=1)  # a worker lives on after its query
def _encoder(tokenizer: str, words: str) -> Encoder:
    return Encoder(
        Merges(SparkFiles.get(tokenizer)), lexicon.Lexicon(SparkFiles.get(words))
    )


def _slices(texts: pa.Array, chars: int = SLICE_CHARS):
    """Parts of a batch with a bounded number of characters, or a single row."""
    sizes = np.cumsum(pc.fill_null(pc.utf8_length(texts), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(texts):
        before = sizes[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(sizes, before + chars, "right")))
        yield start, end
        start = end


def _encode(tokenizer: str, words: str, batches):
    encoder = _encoder(tokenizer, words)
    for batch in batches:
        texts = batch.column(batch.num_columns - 1)
        for start, end in _slices(texts):
            part = ["" if t is None else t for t in texts.slice(start, end - start).to_pylist()]
            offsets, ids = encoder.encode(part)
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids))
            kept = [c.slice(start, end - start) for c in batch.columns[:-1]]
            yield pa.RecordBatch.from_arrays([*kept, lists], [*batch.schema.names[:-1], "ids"])


def _decode(tokenizer: str, batches):
    tokens = _tokens(tokenizer)
    for batch in batches:
        ids = batch.column(batch.num_columns - 1)
        flat = pa.ListArray.from_arrays(ids.offsets, tokens.take(ids.values))
        text = pc.binary_join(flat, " ")
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], text], [*batch.schema.names[:-1], "decoded"]
        )


@functools.cache
def _tokens(tokenizer: str) -> pa.Array:
    return pa.array(Merges(SparkFiles.get(tokenizer)).tokens)


def share_tokenizer(spark: SparkSession, path: str) -> str:
    """Give every machine the tokenizer file; returns its name among Spark's files."""
    spark.sparkContext.addFile(path)
    return os.path.basename(path)


def _count(batches):
    """``w, n`` of the pieces of all texts of a task; a piece has a row each time counts are handed on."""
    met: list[pa.StructArray] = []
    chars = 0
    for batch in batches:
        texts = batch.column(0)
        for start, end in _slices(texts, COUNTED_SLICE):
            part = texts.slice(start, end - start)
            met.append(pc.value_counts(pc.ascii_split_whitespace(part).flatten()))
            chars += pc.sum(pc.utf8_length(part)).as_py() or 0
            if chars > COUNTED_CHARS or sum(map(len, met)) > COUNTED_WORDS:
                yield _piece_counts(met)
                met, chars = [], 0
    if met:
        yield _piece_counts(met)
    # The worker goes on to encode; Arrow would keep what the counts took.
    met = []
    pa.default_memory_pool().release_unused()


def _piece_counts(met: list[pa.StructArray]) -> pa.RecordBatch:
    words = pa.table([pa.chunked_array([m.field(i) for m in met]) for i in (0, 1)], ["w", "n"])
    words = words.group_by("w", use_threads=False).aggregate([("n", "sum")])
    each = (words.column(c).to_numpy().tolist() for c in ("w", "n_sum"))  # faster than to_pylist
    pieces: dict[str, int] = {}
    for word, n in zip(*each):
        # Most words are letters, with marks behind them.
        core = word.rstrip(MARKS)
        plain = core.lower()
        if plain.isalpha() and (core.isascii() or unicodedata.is_normalized("NFC", core) and "Σ" not in core):
            pieces[plain] = pieces.get(plain, 0) + n
            found = [word[len(core) :]] if len(core) < len(word) else ()
        else:
            found = plain_pieces(word)
        for piece in found:
            pieces[piece] = pieces.get(piece, 0) + n
    columns = [pa.array(pieces.keys(), pa.string()), pa.array(pieces.values(), pa.int64())]
    return pa.RecordBatch.from_arrays(columns, ["w", "n"])


def frequent_words(df: DataFrame, text: str, words: int) -> list[str]:
    """At most ``words`` of the most frequent pieces of the whole column, counted over all rows.

    Which words are found decides speed only; one that is met once gains nothing by it.

    A histogram of the counts on a logarithmic scale, a few hundred rows, tells the count
    from which on all pieces fit; only those come to the driver.
    """
    met = df.select(F.col(text)).mapInArrow(_count, "w string, n bigint")
    counted = met.groupBy("w").agg(F.sum("n").alias("count")).where("count > 1")
    level = F.floor(F.log2("count") * 16)
    ranked = stored(counted.select("w", level.alias("level")), "words")
    room, lowest = words, None
    for row in sorted(ranked.groupBy("level").count().collect(), key=lambda r: -r["level"]):
        room -= row["count"]
        if room < 0:
            break
        lowest = row["level"]
    if lowest is None:
        return []
    return [r["w"] for r in ranked.where(F.col("level") >= lowest).select("w").collect()]


def share_lexicon(spark: SparkSession, words: list[str], path: str) -> str:
    """Compile the words and give every machine the file; returns its name."""
    merges = Merges(path)
    encoded = sorted({w.encode("utf-8", "surrogatepass") for w in words if w})
    name = f"lexicon-{uuid.uuid4().hex}"
    # Spark itself copies the file to the machines, so it may begin in a folder of the driver.
    file = os.path.join(tempfile.mkdtemp(prefix="lexicon-"), name)
    lexicon.build(encoded, [merges.merge(w) for w in encoded], file)
    spark.sparkContext.addFile(file)
    return name


def encode(
    df: DataFrame,
    path: str,
    text: str = "text",
    lexicon_words: int = LEXICON_WORDS,
) -> DataFrame:
    """``df`` without ``text`` and with ``ids``, an array of INT.

    ``lexicon_words`` bounds the words in the transducer, which is the only thing that
    passes through the driver: 131,072 words take about 5 MB. Every text is counted for
    them, and encoded exactly, with or without them.
    """
    spark = df.sparkSession
    tokenizer = share_tokenizer(spark, path)
    words = share_lexicon(spark, frequent_words(df, text, lexicon_words), path)
    rest = [c for c in df.columns if c not in (text, "ids")]
    rows = df.select(*rest, F.col(text))
    names = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
    return rows.mapInArrow(
        functools.partial(_encode, tokenizer, words), ", ".join([*names, "ids array<int>"])
    )


def decode(df: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """``df`` without ``ids`` and with ``decoded``, the tokens joined by a space."""
    tokenizer = share_tokenizer(df.sparkSession, path)
    rest = [c for c in df.columns if c not in (ids, "decoded")]
    rows = df.select(*rest, F.col(ids))
    names = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
    return rows.mapInArrow(functools.partial(_decode, tokenizer), ", ".join([*names, "decoded string"]))
