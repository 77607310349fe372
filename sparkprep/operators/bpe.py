"""Byte-level BPE: learn merges from piece counts, encode and decode.

Inside the training job a token is one character: token id -> code point, in id
order. A piece is then a string with one character per token, applying a merge
is ``replace`` (left to right, without overlaps, which is what a merge means),
and the order of two pairs as strings is their order as id pairs. The whole
loop stays in built-in string functions.

Training counts all pairs once. After that a round looks only at pieces that hold a merged
pair: what they had before is taken off the counts and what they have now is added. The driver
keeps the most frequent pairs (``PairPool``); the pieces stay where they are. Pieces keep the
symbols they began with, so a plain substring test finds those a merge can touch.

Pieces are cut first where two bytes meet that are too rare together to be merged (``_parts``).
Rounds then work on the distinct parts, of which a larger corpus has hardly more.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from sparkprep.functions.batches import by_parts
from sparkprep.functions.text import pre_tokenize, with_prefix_space
from sparkprep.operators.vocab import SPECIAL_TOKENS, bounded_rows
from sparkprep.session import drop_scratch, written

PIECES_PER_TASK = 65_536
POOL_PAIRS = 65_536
# Merges that are applied on the fly before the pieces are written anew, and the most of one
# round: more would make the expression that applies them too long.
PENDING_MERGES = 32
LOOSE_SHARE = 0.5
# Byte pairs beside which pieces stay whole, for every merge that is still to come.
WHOLE_PAIRS = 2
BYTE_PAIRS = 1 << 16

_FIRST_CODE = 0x100
_SURROGATES = 0xD800, 0x800


def _byte_characters() -> list[str]:
    """The public byte-to-character table: printable bytes stand for themselves."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


BYTE_CHARS = _byte_characters()
CHAR_BYTES = {c: b for b, c in enumerate(BYTE_CHARS)}


def token_code(token_id: int) -> str:
    """The character that stands for a token while training."""
    code = _FIRST_CODE + token_id
    start, width = _SURROGATES
    return chr(code + width if code >= start else code)


@dataclass
class Merges:
    """A learned vocabulary in plain values: small, bounded by ``vocab_size``."""

    tokens: list[str] = field(default_factory=list)
    merges: list[tuple[int, int, int, int]] = field(default_factory=list)
    n_specials: int = len(SPECIAL_TOKENS)
    rounds: int = 0

    def vocab(self, spark: SparkSession) -> DataFrame:
        rows = [(t, i, i < self.n_specials) for i, t in enumerate(self.tokens)]
        return spark.createDataFrame(rows, "token string, id int, special boolean")

    def table(self, spark: SparkSession) -> DataFrame:
        """``rank, left_id, right_id, new_id, token, n``"""
        rows = [
            (r, a, b, c, self.tokens[c], n) for r, (a, b, c, n) in enumerate(self.merges)
        ]
        schema = "rank int, left_id int, right_id int, new_id int, token string, n bigint"
        return spark.createDataFrame(rows, schema)


def piece_counts(texts: DataFrame, text: str = "text") -> DataFrame:
    """``piece, n`` over the corpus; counted per task before the shuffle."""
    pieces = texts.select(F.explode(pre_tokenize(text)).alias("piece"))
    return pieces.groupBy("piece").agg(F.count("*").alias("n"))


def adjacent_pairs(symbols: Column) -> Column:
    """The pairs of neighbours in a string with one character per symbol, in one pass."""
    return F.regexp_extract_all(symbols, F.lit("(?s)(?=(..))"), F.lit(1))


def pair_counts(symbols: DataFrame, column: str = "symbols", n: str = "n") -> DataFrame:
    """``pair, n``: adjacent symbol pairs, one character per symbol, weighted."""
    pairs = symbols.select(F.col(n).alias("_n"), F.explode(adjacent_pairs(F.col(column))).alias("pair"))
    return pairs.groupBy("pair").agg(F.sum("_n").alias("n"))


class PairPool:
    """The most frequent pairs with their exact counts, on the driver.

    A pair that is not in the pool has at most ``floor`` occurrences. That stays true: a
    merge adds to no pair but those that hold the new token, and a new token's pairs are all
    reported, in full, in the round that makes it.
    """

    def __init__(self, counts: dict[str, int], floor: int, size: int) -> None:
        self.counts, self.floor, self.size = counts, floor, size
        self.fresh = True  # nothing has changed: ties at the floor are in order, too

    def change(self, changes: Iterable[tuple[str, int]]) -> None:
        """Add the changes of a round. A pair from outside must be a new token's."""
        self.fresh = False
        for pair, n in changes:
            now = self.counts.get(pair, 0) + n
            if now > self.floor:
                self.counts[pair] = now
            else:
                self.counts.pop(pair, None)
        if len(self.counts) > 2 * self.size:
            kept = heapq.nsmallest(self.size + 1, self.counts.items(), key=_by_rank)
            self.floor = kept.pop()[1]
            self.counts = {p: n for p, n in kept if n > self.floor}

    def best(self, k: int) -> tuple[list[tuple[str, int]], int]:
        """The k best pairs that are certainly the best of all, and the count others may have."""
        certain = self.counts.items()
        if not self.fresh:
            certain = ((p, n) for p, n in certain if n > self.floor)
        ranked = heapq.nsmallest(k + 1, certain, key=_by_rank)
        rest = max(self.floor, ranked[k][1] if len(ranked) > k else 0)
        return ranked[:k], rest


def _by_rank(item: tuple[str, int]) -> tuple[int, str]:
    return -item[1], item[0]


def _count_pool(symbols: DataFrame, lengths: list[int], longest: int, size: int) -> PairPool:
    """Count all pairs; the best ``size`` that may merge come to the driver."""
    pairs = pair_counts(symbols).where(F.substring("pair", 1, 1) >= chr(_FIRST_CODE))
    long = _too_long_pairs(lengths, longest)
    if long is not None:
        pairs = pairs.where(~long)
    rows = pairs.orderBy(F.desc("n"), F.asc("pair")).limit(size + 1).collect()
    floor = rows[size]["n"] if len(rows) > size else 0
    return PairPool({r["pair"]: r["n"] for r in rows[:size]}, floor, size)


def _byte_pairs(pieces: DataFrame, merges: int) -> list[tuple[str, int]]:
    """All pairs of bytes with their counts, most frequent first; none if that many merges need them all."""
    if WHOLE_PAIRS * merges >= BYTE_PAIRS:
        return []
    rows = pair_counts(pieces, "start").where(F.substring("pair", 1, 1) >= chr(_FIRST_CODE)).collect()
    return sorted(((r["pair"], r["n"]) for r in rows), key=_by_rank)


def _parts(pieces: DataFrame, kept: Iterable[str]) -> DataFrame:
    """``start, n``: the pieces cut between two bytes that are no pair of ``kept``, counted.

    A pair of tokens has at most as many occurrences as the two bytes it meets with. So while
    all merges are more frequent than any pair of bytes that is cut, none crosses a cut, and the
    counts of all others are those of the whole pieces.
    """
    after: dict[str, list[str]] = {}
    for pair in kept:
        after.setdefault(pair[0], []).append(pair[1])
    starts = "".join(sorted(after))
    ends = [f"{a}(?![{''.join(sorted(b))}])" for a, b in sorted(after.items())]
    last = "|".join([*ends, f"[^{starts}]"] if starts else ["(?s:.)"])
    cut = F.regexp_replace("start", F.lit(f"({last})"), F.lit("$1 "))
    parts = pieces.select(F.explode(F.split(cut, " ")).alias("start"), "n").where(F.length("start") > 1)
    return parts.groupBy("start").agg(F.sum("n").alias("n"))


def _changes(symbols: DataFrame, floor: int) -> list[tuple[str, int]]:
    """How pair counts differ between ``was`` and ``symbols``, over the pieces that may have changed.

    Only pairs beside a merged one change, a number that the vocabulary bounds; new
    pairs too rare for the pool stay away.
    """
    both = F.array(
        F.struct(F.col("was").alias("s"), (-F.col("n")).alias("n")),
        F.struct(F.col("symbols").alias("s"), F.col("n").alias("n")),
    )
    sides = symbols.select(F.explode(both).alias("e")).select("e.*")
    pairs = pair_counts(sides, "s").where(F.substring("pair", 1, 1) >= chr(_FIRST_CODE))
    return [(r["pair"], r["n"]) for r in pairs.where((F.col("n") < 0) | (F.col("n") > floor)).collect()]


def train_bpe(
    counts: DataFrame,
    *,
    vocab_size: int,
    max_token_length: int = 64,
    specials: Sequence[str] = SPECIAL_TOKENS,
    alphabet: str = "seen",
    candidates: int = 256,
    pending_merges: int = PENDING_MERGES,
    exact: bool = True,
    pool_pairs: int = POOL_PAIRS,
) -> Merges:
    """Learn merges from ``piece, n``.

    One round takes the best ``candidates`` pairs of the pool and applies as many merges as
    are certain to come next in the one-at-a-time order (``_certain_merges``), so the result
    is the same as with one merge per round. Ties go to the pair with the smaller ids. When
    the pool cannot tell the best pair any more, all pairs are counted again. The same holds
    when a merge would be as rare as a pair of bytes that was cut; pieces are cut less then.

    ``exact=False`` is for large vocabularies: a round also takes pairs whose place in the order
    is not certain, if they are independent of the others and have at least ``LOOSE_SHARE`` of the
    best one's count. That needs far fewer rounds; tokens may come in another order.

    ``alphabet='seen'`` starts from the bytes of the corpus, ``'all'`` from all
    256, with which every text can be encoded without loss.
    """
    latin = F.decode(F.col("piece").cast("binary"), "ISO-8859-1")
    if alphabet == "all":
        seen = list(range(256))
    else:
        chars = counts.select(F.explode(F.array_distinct(F.split(latin, ""))).alias("c"))
        seen = [r.b for r in chars.select(F.ascii("c").alias("b")).distinct().collect()]
    ordered = sorted(BYTE_CHARS[b] for b in seen)
    learned = Merges(tokens=[*specials, *ordered], n_specials=len(specials))
    ids = {t: i for i, t in enumerate(learned.tokens)}
    lengths = [0] * len(specials) + [1] * len(ordered)

    source = "".join(chr(CHAR_BYTES[c]) for c in ordered)
    target = "".join(token_code(ids[c]) for c in ordered)
    start = F.translate(latin, source, target)
    pieces = counts.select(start.alias("start"), "n").where(F.length("start") > 1)
    # The loop is bound by CPU, so it uses every core even when the table is small, and
    # more tasks than cores when it is large.
    spark = counts.sparkSession
    pieces, whole = written(pieces, "pieces")

    def spread_out(table: DataFrame) -> DataFrame:
        width = max(spark.sparkContext.defaultParallelism, table.count() // PIECES_PER_TASK)
        return table.repartition(width, "symbols").persist()

    def parts_above(rank: int) -> tuple[DataFrame, str, int]:
        """The parts that the pairs up to this rank leave, merged as far as it goes; the least count of a merge there."""
        least = byte_pairs[rank - 1][1] if rank < len(byte_pairs) else 0
        table = _parts(pieces, [p for p, n in byte_pairs if n >= least]) if least else pieces
        table, place = written(table.select("start", F.col("start").alias("symbols"), "n"), "pieces")
        done = [m[:3] for m in learned.merges]
        for at in range(0, len(done), pending_merges):
            now = table.select("start", _merged(F.col("symbols"), done[at : at + pending_merges]).alias("symbols"), "n")
            before, (table, place) = place, written(now, "pieces")
            drop_scratch(spark, before)
        return spread_out(table), place, least

    byte_pairs = _byte_pairs(pieces, vocab_size - len(learned.tokens))
    rank = max(1, int(WHOLE_PAIRS * (vocab_size - len(learned.tokens))))
    symbols, path, least = parts_above(rank)
    # Merges learned since the pieces were written; a round applies them where it reads.
    pending: list[tuple[int, int, int]] = []
    pool: PairPool | None = None
    while len(learned.tokens) < vocab_size:
        if pool is None:
            now = symbols.select(_merged(F.col("symbols"), pending).alias("symbols"), "n")
            pool = _count_pool(now, lengths, max_token_length, pool_pairs)
        best, rest = pool.best(candidates)
        if least and (best[0][1] < least if best else not pool.floor or pool.fresh):
            # Pairs across the cuts may come next.
            symbols.unpersist()
            drop_scratch(spark, path)
            rank *= 4
            symbols, path, least = parts_above(rank)
            pending, pool = [], None
            continue
        if not best:
            if not pool.floor or pool.fresh:
                break
            pool = None
            continue
        ranked = [(_id_of(p[0]), _id_of(p[1]), n) for p, n in best]
        if exact:
            chosen = _certain_merges(ranked, rest, learned.tokens, ids)
        else:
            chosen = _independent_merges(ranked, learned.tokens, ids)
        fresh: list[tuple[int, int, int]] = []
        recount = False
        for a, b, n in chosen[:pending_merges]:
            if len(learned.tokens) >= vocab_size or n < least:
                break
            token = learned.tokens[a] + learned.tokens[b]
            new = ids.setdefault(token, len(learned.tokens))
            if new == len(learned.tokens):
                learned.tokens.append(token)
                lengths.append(lengths[a] + lengths[b])
            else:
                recount = True  # a known token gains occurrences, so pairs outside the pool may
            learned.merges.append((a, b, new, n))
            fresh.append((a, b, new))
        learned.rounds += 1
        if recount:
            pool = None
        else:
            # A piece that holds a pair spells it, whatever was merged in between.
            spells = [_spelled(learned.tokens[new], ids) for _, _, new in fresh]
            near = symbols.where(functools.reduce(Column.__or__, [F.contains("start", F.lit(t)) for t in spells]))
            sides = near.select(_merged(F.col("symbols"), pending).alias("was"), "n")
            sides = sides.select("was", _merged(F.col("was"), fresh).alias("symbols"), "n")
            changes = _changes(sides, pool.floor)
            pool.change((p, n) for p, n in changes if n < 0 or _may_merge(p, lengths, max_token_length))
        pending += fresh
        if len(pending) > pending_merges:
            # A piece that has become one token can take no further merge. The table
            # written before is not needed any more.
            done = symbols.select("start", _merged(F.col("symbols"), pending).alias("symbols"), "n")
            kept, newer = written(done.where(F.length("symbols") > 1), "pieces")
            symbols.unpersist()
            symbols = spread_out(kept)
            drop_scratch(spark, path)
            path, pending = newer, []
    symbols.unpersist()
    drop_scratch(spark, path)
    drop_scratch(spark, whole)
    return learned


def _merged(symbols: Column, merges: Sequence[tuple[int, int, int]]) -> Column:
    """The symbols after some merges, in their order."""
    for a, b, new in merges:
        symbols = F.replace(symbols, F.lit(token_code(a) + token_code(b)), F.lit(token_code(new)))
    return symbols


def _spelled(token: str, ids: dict[str, int]) -> str:
    """A token as the symbols that training starts from."""
    return "".join(token_code(ids[c]) for c in token)


def _may_merge(pair: str, lengths: list[int], longest: int) -> bool:
    """Whether the pair's token stays below the limit; two starting symbols always may merge."""
    both = lengths[_id_of(pair[0])] + lengths[_id_of(pair[1])]
    return both <= 2 or both < longest


def _independent_merges(
    ranked: list[tuple[int, int, int]], tokens: list[str], ids: dict[str, int]
) -> list[tuple[int, int, int]]:
    """The leading pair and the later ones that touch no pair taken before."""
    taken: list[tuple[int, int, int]] = []
    lefts: set[int] = set()
    rights: set[int] = set()
    spelled: set[str] = set()
    for a, b, n in ranked:
        token = tokens[a] + tokens[b]
        alone = a == b or token in ids or token in spelled
        if taken and (alone or b in lefts or a in rights or n < LOOSE_SHARE * taken[0][2]):
            continue
        taken.append((a, b, n))
        if alone:
            break
        lefts.add(a)
        rights.add(b)
        spelled.add(token)
    return taken


def _certain_merges(
    ranked: list[tuple[int, int, int]], rest: int, tokens: list[str], ids: dict[str, int]
) -> list[tuple[int, int, int]]:
    """The leading pairs that keep their rank whatever the merges before them do.

    Merging (a, b) changes only pairs that end in a or begin with b, and a pair
    it creates is no more frequent than one of those was. So the walk goes down
    to the first pair that ends in an accepted left symbol or begins with an
    accepted right one; accepted pairs counted more often than that are certain.
    A pair of equal symbols and a pair that spells an existing token are taken
    alone. What is not listed has a count of at most ``rest``.
    """
    taken: list[tuple[int, int, int]] = []
    lefts: set[int] = set()
    rights: set[int] = set()
    spelled: set[str] = set()
    stop = rest
    for a, b, n in ranked:
        token = tokens[a] + tokens[b]
        alone = a == b or token in ids or token in spelled
        if taken and (alone or b in lefts or a in rights):
            stop = n
            break
        taken.append((a, b, n))
        if alone:
            return taken
        lefts.add(a)
        rights.add(b)
        spelled.add(token)
    return taken[:1] + [t for t in taken[1:] if t[2] > stop]


def _too_long_pairs(lengths: list[int], limit: int) -> Column | None:
    """Pairs whose token would reach ``limit`` bytes.

    Two starting symbols always may merge; after that the merged length stays
    below the limit.
    """
    by_length: dict[int, list[str]] = {}
    for token_id, n in enumerate(lengths):
        if n > 1:
            by_length.setdefault(n, []).append(token_code(token_id))
    if not by_length or 2 * max(by_length) < limit:
        return None
    text = "".join(c for chars in by_length.values() for c in chars)
    # Length as a character: translate maps a symbol to chr(length + 1).
    codes = "".join(chr(n + 1) for n, chars in by_length.items() for _ in chars)

    def length(c: Column) -> Column:
        code = F.ascii(F.translate(c, text, codes))
        return F.when(code > max(by_length) + 1, 1).otherwise(code - 1)

    left = length(F.substring("pair", 1, 1))
    right = length(F.substring("pair", 2, 1))
    return (left + right > 2) & (left + right >= limit)


def _id_of(char: str) -> int:
    code = ord(char)
    start, width = _SURROGATES
    return (code - width if code >= start else code) - _FIRST_CODE


# Encoded pieces per vocabulary, kept by a Python worker from task to task.
_PIECES: dict[str, dict[str, list[int]]] = {}
_MAX_PIECES = 200_000
# Symbols of a piece that is merged without a heap.
SHORT_PIECE = 32
_NO_MERGE = (1 << 62, -1)
_NO_RANK = np.iinfo(np.int64).max


class BpeCodec:
    """Encode and decode with one vocabulary, inside a task.

    ``vocab`` and ``merges`` are bounded by the 16-bit id range. Text repeats its
    words, so a piece once encoded is remembered.
    """

    def __init__(
        self, tokens: list[str], merges: list[tuple[int, int, int]], added: Sequence[str] = ()
    ) -> None:
        self.tokens = tokens
        self.added = {t: tokens.index(t) for t in added}
        self.rank = {(a, b): (r, c) for r, (a, b, c) in reversed(list(enumerate(merges)))}
        # Pairs as sorted numbers with their ranks, and the token of each rank; one that no pair can be if none.
        ranked = sorted((a << 32 | b, r) for (a, b), (r, _) in self.rank.items()) or [(-1, 0)]
        keys, ranks = np.array(ranked, np.int64).T
        self._ranks = keys.copy(), ranks.copy(), np.array([c for _, _, c in merges] or [0], np.int64)
        index = {t: i for i, t in enumerate(tokens)}
        self.byte_id = [index.get(c, -1) for c in BYTE_CHARS]
        self.raw = [self._bytes(t) for t in tokens]
        content = repr((tokens, merges, tuple(added))).encode("utf-8", "surrogatepass")
        self.key = hashlib.sha256(content).hexdigest()

    def piece(self, text: str) -> list[int]:
        known = _PIECES.get(self.key)
        if known is None or len(known) >= _MAX_PIECES:
            _PIECES.clear()
            known = _PIECES[self.key] = {}
        found = known.get(text)
        if found is None:
            found = [self.added[text]] if text in self.added else self._merge(text)
            known[text] = found
        return found

    def pieces(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Sizes and all ids of the pieces, the short ones merged together."""
        wide = texts.cast(pa.large_string())
        _, offsets, data = wide.buffers()
        ends = np.frombuffer(offsets, np.int64)[wide.offset : wide.offset + len(wide) + 1]
        text = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if ends[-1] > ends[0] else np.zeros(0, np.uint8)
        symbols = np.array(self.byte_id)[text]
        known = symbols >= 0
        ends = np.concatenate([[0], np.cumsum(known)])[ends - ends[0]]
        sizes, symbols = np.diff(ends), symbols[known]
        owner = np.repeat(np.arange(len(wide)), sizes)
        alone = sizes > SHORT_PIECE
        if self.added:
            alone |= pc.is_in(wide, value_set=pa.array(list(self.added), pa.large_string())).to_numpy(zero_copy_only=False)
        short = ~alone[owner]
        owners, ids = self._merge_together(owner[short], symbols[short])
        for i in np.flatnonzero(alone).tolist():
            found = self.piece(wide[i].as_py())
            owners.append(np.full(len(found), i))
            ids.append(np.array(found, np.int64))
        owner = np.concatenate(owners)
        order = np.argsort(owner, kind="stable")
        return np.bincount(owner, minlength=len(wide)), np.concatenate(ids)[order].astype(np.int32)

    def _merge_together(self, owner: np.ndarray, symbols: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Merge many pieces, in each the leftmost of its best pairs a round; ``owner`` numbers a symbol's piece."""
        owners, ids = [owner[:0]], [symbols[:0]]
        keys, ranks, merged = self._ranks
        while len(symbols):
            first = np.concatenate([[True], owner[1:] != owner[:-1]])
            pairs = symbols[:-1] << 32 | symbols[1:]
            at = np.minimum(np.searchsorted(keys, pairs), len(keys) - 1)
            rank = np.full(len(symbols), _NO_RANK)
            rank[:-1] = np.where((keys[at] == pairs) & ~first[1:], ranks[at], _NO_RANK)
            best = np.minimum.reduceat(rank, np.flatnonzero(first))[np.cumsum(first) - 1]
            done = best == _NO_RANK
            owners.append(owner[done])
            ids.append(symbols[done])
            where = np.flatnonzero((rank == best) & ~done)
            where = where[np.concatenate([[True], owner[where[1:]] != owner[where[:-1]]])] if len(where) else where
            symbols = symbols.copy()
            symbols[where] = merged[rank[where]]
            kept = ~done
            kept[where + 1] = False
            owner, symbols = owner[kept], symbols[kept]
        return owners, ids

    def _merge(self, text: str) -> list[int]:
        """Lowest-ranked pair first, leftmost of equals."""
        ids = [i for i in map(self.byte_id.__getitem__, text.encode("utf-8")) if i >= 0]
        return self._merge_short(ids) if len(ids) <= SHORT_PIECE else self._merge_long(ids)

    def _merge_short(self, ids: list[int]) -> list[int]:
        """For a few symbols: the best of all pairs is looked for after each merge."""
        rank = self.rank
        pairs = [rank.get(p, _NO_MERGE) for p in zip(ids, ids[1:])]
        while pairs:
            best = min(pairs)
            if best is _NO_MERGE:
                break
            i = pairs.index(best)
            ids[i : i + 2] = (best[1],)
            del pairs[i]
            if i:
                pairs[i - 1] = rank.get((ids[i - 1], ids[i]), _NO_MERGE)
            if i < len(pairs):
                pairs[i] = rank.get((ids[i], ids[i + 1]), _NO_MERGE)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """A heap over a linked list."""
        n = len(ids)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        alive = [True] * n
        heap: list[tuple[int, int, int, int, int]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j < n:
                hit = self.rank.get((ids[i], ids[j]))
                if hit:
                    heapq.heappush(heap, (hit[0], i, ids[i], ids[j], hit[1]))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, a, b, new = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i] = new
            alive[j] = False
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            if before[i] >= 0:
                offer(before[i])
            offer(i)
        return [t for t, ok in zip(ids, alive) if ok]

    def text(self, ids: Sequence[int]) -> str:
        return b"".join(self.raw[i] for i in ids).decode("utf-8", "replace")

    @staticmethod
    def _bytes(token: str) -> bytes:
        if all(c in CHAR_BYTES for c in token):
            return bytes(CHAR_BYTES[c] for c in token)
        return token.encode("utf-8")


def load_codec(
    vocab: DataFrame, merges: DataFrame, added: Sequence[str] = ()
) -> BpeCodec:
    """A codec from the vocabulary and merge tables; their size is checked first.

    Tokens that the vocabulary marks as ``added`` (runs of spaces) are matched whole,
    as are those listed in ``added``.
    """
    rows, ranked = bounded_rows(vocab), bounded_rows(merges)
    if rows is None or ranked is None:
        raise ValueError("a vocabulary of more than 65,536 entries does not fit 16-bit ids")
    if "added" in vocab.columns:
        marked = [r["token"] for r in rows if r["added"]]
        added = [*added, *(t for t in marked if t not in added)]
    tokens = [""] * (max(r["id"] for r in rows) + 1)
    for r in rows:
        tokens[r["id"]] = r["token"]
    ranked.sort(key=lambda r: r["rank"])
    triples = [(r["left_id"], r["right_id"], r["new_id"]) for r in ranked]
    return BpeCodec(tokens, triples, added)


def codec_of(learned: Merges, added: Sequence[str] = ()) -> BpeCodec:
    return BpeCodec(learned.tokens, [m[:3] for m in learned.merges], added)


def pieces_with_added(text: str | Column, added: Sequence[str] = ()) -> Column:
    """Pieces of a text in which added tokens (specials, runs of spaces) stay whole.

    The text is first cut at the added tokens, longest first; each stretch
    between them is then pre-tokenized on its own.
    """
    if not added:
        return pre_tokenize(text)
    ordered = sorted(added, key=len, reverse=True)
    any_added = "|".join(r"\Q" + t + r"\E" for t in ordered)
    sections = F.regexp_extract_all(
        F.col(text) if isinstance(text, str) else text,
        F.lit(rf"(?s)(?:{any_added})|.+?(?=(?:{any_added})|\z)"),
        F.lit(0),
    )
    return F.flatten(
        F.transform(
            sections,
            lambda s: F.when(s.isin(*ordered), F.array(s)).otherwise(pre_tokenize(s)),
        )
    )


def encode_pieces(pieces: Column, codec: BpeCodec) -> Column:
    """Token ids of an array of pieces; each distinct piece of a part of a batch is merged once.

    The function is declared nondeterministic although it is not: Spark then
    neither repeats it to push a filter down nor copies the expressions around it.
    """

    def encoded(batch: pa.Array) -> pa.Array:
        offsets = np.asarray(batch.offsets, dtype=np.int64)
        flat = batch.values.slice(offsets[0], offsets[-1] - offsets[0])
        coded = flat.dictionary_encode() if len(flat) else None
        if coded is None:
            empty = pa.array([], pa.int32())
            zeros = np.zeros(len(batch) + 1, dtype=np.int32)
            return _lists(zeros, empty, batch)
        sizes, table = codec.pieces(coded.dictionary)
        first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        which = np.asarray(coded.indices)
        lengths = sizes[which]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        # Position of every output id in the table of distinct pieces.
        take = np.repeat(first[which] - ends[:-1], lengths) + np.arange(ends[-1])
        new_offsets = ends[offsets - offsets[0]].astype(np.int32)
        return _lists(new_offsets, pa.array(table[take]), batch)

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def encode(batch: pa.Array) -> pa.Array:
        return by_parts(encoded, batch)

    return encode.asNondeterministic()(pieces)


def encode(text: str | Column, codec: BpeCodec) -> Column:
    """Token ids of a text: JVM regex pieces, then merges in Arrow batches."""
    return encode_pieces(pieces_with_added(text, tuple(codec.added)), codec)


def decode(ids: str | Column, codec: BpeCodec) -> Column:
    """The text of token ids; bytes that are no UTF-8 become replacement characters."""

    raw = pa.array(codec.raw, pa.binary())

    def decoded(batch: pa.Array) -> pa.Array:
        offsets = np.asarray(batch.offsets)
        values = batch.values.slice(offsets[0], offsets[-1] - offsets[0])
        joined = pc.binary_join(_lists(offsets - offsets[0], raw.take(values), batch), b"")
        try:
            return joined.cast(pa.string())
        except pa.ArrowInvalid:  # some bytes are no UTF-8
            texts = [None if x is None else x.decode("utf-8", "replace") for x in joined.to_pylist()]
            return pa.array(texts, pa.string())

    @F.arrow_udf(T.StringType())
    def text_of(batch: pa.Array) -> pa.Array:
        return by_parts(decoded, batch)

    return text_of.asNondeterministic()(F.col(ids) if isinstance(ids, str) else ids)


def prefix_space_step(codec: BpeCodec):
    """The chunker's optional step: make an id array start with a space.

    Arrays whose text already starts with one are returned as they are; only the
    others are pre-tokenized and encoded again.
    """

    def step(df: DataFrame, column: str) -> DataFrame:
        decoded = df.withColumn("_text", decode(column, codec))
        redo = F.when(~F.col("_text").startswith(" "), F.col("_text"))
        again = decoded.withColumn("_again", encode(redo, codec))
        return again.withColumn(column, F.coalesce("_again", column)).drop("_text", "_again")

    return step


def round_trip(df: DataFrame, codec: BpeCodec, text: str = "text") -> DataFrame:
    """Add ``decoded`` and ``same``: decoding gives the text back, with its prefix space."""
    decoded = df.withColumn("decoded", decode(encode(text, codec), codec))
    return decoded.withColumn("same", F.col("decoded") == with_prefix_space(text))


def space_consistency(words: DataFrame, codec: BpeCodec, word: str = "word") -> DataFrame:
    """``word, n_encodings``: distinct encodings of a word at the start of a text,
    after another word and after two spaces. 1 means consistent.
    """
    w = F.col(word)
    lead = len(codec.piece(" x"))
    spaces = len(codec.piece(" "))
    placed = words.select(
        word,
        encode(w, codec).alias("_start"),
        encode(F.concat(F.lit("x "), w), codec).alias("_middle"),
        encode(F.concat(F.lit("  "), w), codec).alias("_after"),
    )

    def rest(c: str, skip: int) -> Column:
        return F.slice(c, F.lit(skip + 1), F.size(c))

    forms = F.array("_start", rest("_middle", lead), rest("_after", spaces))
    return placed.select(word, F.size(F.array_distinct(forms)).alias("n_encodings"))


def _lists(offsets: np.ndarray, values: pa.Array, like: pa.Array) -> pa.Array:
    mask = like.is_null() if like.null_count else None
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values, mask=mask)
