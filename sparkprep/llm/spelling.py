"""Spelling variants: words one edit apart, the frequent form of each, and where forms lead.

Two words are near if one inserted, deleted or replaced code point makes them equal. That is
so exactly if their common prefix and their common suffix together reach the longer
length minus one. Words are compared in dense blocks: a block is a matrix of
code points, padded on the right for prefixes and on the left for suffixes, and is compared
with itself or with another block, all rows with all rows.

Which blocks meet: the shorter of two near words is cut into segments of about
``SEGMENT`` code points; the edit falls into one of them, so what stands before that segment and
what stands behind it is equal in both words. Words that agree there are a bucket. A bucket
larger than ``TILE`` words is dealt into tiles, and every pair of tiles is compared
by itself, so no bucket is one task and none is cut short. Two words that meet in several
buckets count in the first of them, which the lengths of prefix and suffix tell.

Joins merge sorted rows: a word has a row in some twenty buckets, which Spark's estimates do not
know, so it would send tables to the driver and every task that only look small.

No pairs are written. A block returns, for each of its words, how many others are near and
the best of them; these are added up with map-side combining.

Words are whatever the caller counts; a null word takes no part, and equal words are one,
their counts added. An empty word is near to every word of one code point.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sparkprep.llm.common import stored
from sparkprep.session import drop_scratch, written

SEGMENT = 3
MAX_SEGMENTS = 8
TILE = 256
RATIO = 5
# Code points of one matrix, and cells of one comparison.
BLOCK_CELLS = 4_000_000
COMPARED_CELLS = 16_000_000


def _segment_count(n: Column) -> Column:
    return F.greatest(F.lit(2), F.least(F.lit(MAX_SEGMENTS), F.ceil(n / F.lit(SEGMENT)))).cast("int")


def _buckets(word: Column, length: Column, short: Column, longer: int) -> Column:
    """One key per segment for pairs whose shorter word has ``short`` code points.

    ``longer`` is 1 if the other word has one more, 0 if it has as many.
    """
    count = _segment_count(short)

    def key(i: Column) -> Column:
        head = F.floor(short * i / count).cast("int")
        tail = (short - F.floor(short * (i + 1) / count)).cast("int")
        return F.struct(
            F.xxhash64(
                short, F.lit(longer), i, F.substr(word, F.lit(1), head), F.substr(word, length - tail + 1, tail)
            ).alias("bucket"),
            short.alias("short"),
            F.lit(longer).alias("longer"),
            i.alias("segment"),
        )

    return F.transform(F.sequence(F.lit(0), count - 1), key)


def keyed(words: DataFrame) -> DataFrame:
    """``word, n, bucket, short, longer, segment``: every bucket of every word."""
    word, length = F.col("word"), F.char_length("word")
    keys = F.concat(
        _buckets(word, length, length, 0),
        _buckets(word, length, length, 1),
        F.when(length > 0, _buckets(word, length, length - 1, 1)).otherwise(F.array()),
    )
    return words.select("word", "n", F.explode(keys).alias("k")).select("word", "n", "k.*")


def tiles(words: DataFrame, tile: int = TILE) -> DataFrame:
    """Rows of ``keyed``, each once for every pair of tiles it is compared in.

    ``lo, hi`` number the pair, ``mine`` is the tile of the row. Words alone in a bucket go.
    """
    rows = keyed(words)
    sizes = rows.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    count = F.ceil(F.col("size") / F.lit(tile)).cast("int")
    mine = F.pmod(F.xxhash64("word", F.lit(7)), count).cast("int")
    dealt = rows.join(sizes.hint("merge"), "bucket").withColumns({"mine": mine, "_count": count})
    met = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_count") - 1)))
    return met.select(
        "bucket", "short", "longer", "segment",
        F.least("mine", "_other").alias("lo"), F.greatest("mine", "_other").alias("hi"), "mine",
        "word", "n",
    )


def _code_points(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lengths, and the words as rows of code points padded on the right and on the left."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4") + 1
    kind = np.uint8 if not len(flat) or flat.max() < 256 else np.uint32
    width = int(lengths.max(initial=0)) + 1  # the last column of both always differs or is padding
    row = np.repeat(np.arange(len(words)), lengths)
    at = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    left = np.zeros((len(words), width), kind)
    left[row, at] = flat
    right = np.zeros((len(words), width), kind)
    right[row, np.repeat(lengths, lengths) - 1 - at] = flat  # reversed, so suffixes are prefixes
    return lengths, left, right


def _near(left, right, lengths, longer, first_tail, last_tail):
    """Which rows of each block are near to which, counted in the bucket that owns the pair.

    Arrays are by block and row. A bucket owns a pair if the common suffix covers its tail
    and not the tail of the segment before, and the lengths differ as its words were keyed for.
    """
    prefix = (left[:, :, None, :] != left[:, None, :, :]).argmax(axis=3)
    suffix = (right[:, :, None, :] != right[:, None, :, :]).argmax(axis=3)
    longest = np.maximum(lengths[:, :, None], lengths[:, None, :])
    owned = (suffix >= first_tail[:, None, None]) & (suffix < last_tail[:, None, None])
    owned &= longest - np.minimum(lengths[:, :, None], lengths[:, None, :]) == longer[:, None, None]
    return owned & (prefix + suffix >= longest - 1)


def _compare(table: pa.Table) -> pa.RecordBatch | None:
    """``word, n_near, best`` of the words in a run of whole pairs of tiles."""
    words = table.column("word").to_pylist()
    lengths, left, right = _code_points(words)
    n = table.column("n").to_numpy()
    mine, lo, hi = (table.column(c).to_numpy() for c in ("mine", "lo", "hi"))
    ident = np.stack([table.column(c).to_numpy() for c in ("bucket", "short", "longer", "segment", "lo", "hi")])
    starts = np.flatnonzero(np.concatenate([[True], (ident[:, 1:] != ident[:, :-1]).any(axis=0)]))
    sizes = np.diff(np.concatenate([starts, [len(words)]]))
    short, longer, segment = (
        table.column(c).to_numpy().astype(np.int64)[starts] for c in ("short", "longer", "segment")
    )
    count = np.clip(-(-short // SEGMENT), 2, MAX_SEGMENTS)
    first_tail = short - short * (segment + 1) // count
    last_tail = np.where(segment == 0, np.iinfo(np.int64).max, short - short * segment // count)
    # Better words have smaller places: more frequent first, then by code points.
    place = np.empty(len(words), np.int64)
    place[sorted(range(len(words)), key=lambda i: (-n[i], words[i]))] = np.arange(len(words))
    near, best = np.zeros(len(words), np.int64), np.full(len(words), len(words), np.int64)
    padded = 1 << np.ceil(np.log2(np.maximum(sizes, 2))).astype(int)
    for size in np.unique(padded):
        here = np.flatnonzero((padded == size) & (sizes > 1))
        step = max(1, COMPARED_CELLS // (size * size * left.shape[1]))
        for at in range(0, len(here), step):
            blocks = here[at : at + step]
            rows = starts[blocks, None] + np.arange(size)
            real = np.arange(size) < sizes[blocks, None]
            rows = np.where(real, rows, 0)
            pairs = _near(
                left[rows], right[rows], lengths[rows], longer[blocks], first_tail[blocks], last_tail[blocks]
            )
            pairs &= real[:, :, None] & real[:, None, :] & ~np.eye(size, dtype=bool)
            # A pair of different tiles compares across only.
            across = (lo[starts[blocks]] == hi[starts[blocks]])[:, None, None]
            pairs &= across | (mine[rows][:, :, None] != mine[rows][:, None, :])
            found = pairs.sum(axis=2)
            top = np.where(pairs, place[rows][:, None, :], len(words)).min(axis=2)
            near[rows[real]] += found[real]
            best[rows[real]] = np.minimum(best[rows[real]], top[real])
    some = np.flatnonzero(near)
    if not len(some):
        return None
    at_place = np.empty(len(words), np.int64)
    at_place[place] = np.arange(len(words))
    who = at_place[best[some]]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([words[i] for i in some], pa.string()),
            pa.array(near[some]),
            pa.array(n[who], pa.int64()),
            pa.array([words[i] for i in who], pa.string()),
        ],
        ["word", "n_near", "best_n", "best"],
    )


def _blocks(batches):
    """Cut the sorted rows of a partition into runs of whole pairs of tiles, and compare each."""
    waiting: list[pa.Table] = []
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        while rows.num_rows:
            # Rows of one run have the same width, or memory would follow the longest word.
            short = rows.column("short").to_numpy()
            room = max(1, BLOCK_CELLS // (int(short[0]) + 2))
            if waiting and waiting[0].column("short")[0].as_py() != short[0]:
                yield from _compared(waiting)
                waiting = []
            take = min(int(np.searchsorted(short, short[0], "right")), room)
            waiting.append(rows.slice(0, take))
            rows = rows.slice(take)
            if sum(t.num_rows for t in waiting) >= room // 2:
                whole, rest = _whole(pa.concat_tables(waiting))
                waiting = [rest] if rest.num_rows else []
                if whole.num_rows:
                    yield from _compared([whole])
    if waiting:
        yield from _compared(waiting)


def _whole(table: pa.Table) -> tuple[pa.Table, pa.Table]:
    """The rows up to the last pair of tiles, which may go on, and that one."""
    ident = np.stack([table.column(c).to_numpy() for c in ("bucket", "longer", "segment", "lo", "hi")])
    last = np.flatnonzero((ident != ident[:, -1:]).any(axis=0))
    cut = int(last[-1]) + 1 if len(last) else 0
    return table.slice(0, cut), table.slice(cut)


def _compared(tables: list[pa.Table]):
    found = _compare(pa.concat_tables(tables))
    if found is not None:
        yield found


def near_words(words: DataFrame, tile: int = TILE) -> DataFrame:
    """``word, n_near, best_n, best`` of the words that have a near one.

    ``best`` is the near word of largest ``n``, of equals the first by code points.
    """
    key = ["short", "bucket", "longer", "segment", "lo", "hi"]
    dealt = tiles(words, tile).repartition("bucket", "lo", "hi").sortWithinPartitions(*key)
    parts = dealt.mapInArrow(_blocks, "word string, n_near bigint, best_n bigint, best string")
    top = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word")))
    return (
        parts.groupBy("word")
        .agg(F.sum("n_near").alias("n_near"), top.alias("top"))
        .select("word", "n_near", (-F.col("top.n")).alias("best_n"), F.col("top.word").alias("best"))
    )


def roots(forms: DataFrame) -> DataFrame:
    """``word, root``: follow ``word, form`` to the last form, doubling the step each round.

    A form is more frequent than its word, so no chain runs in a circle.
    """
    spark = forms.sparkSession
    now, path = written(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        after = now.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        step, newer = written(
            now.join(after.hint("merge"), "root", "left").select(
                "word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")
            ),
            "forms",
        )
        drop_scratch(spark, path)
        now, path = step.select("word", "root"), newer
        if not step.where("moved").take(1):
            return now


def spelling_variants(words: DataFrame, ratio: int = RATIO, tile: int = TILE) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` for every different word of ``words`` (``word, n``).

    ``form`` is the near word of largest ``n`` if that is at least ``ratio`` times the
    word's own, else null; ``ratio`` must be above 1.
    """
    if ratio <= 1:
        raise ValueError(f"the ratio must be above 1, got {ratio}")
    counted = words.where(F.col("word").isNotNull()).groupBy("word").agg(F.sum("n").cast("bigint").alias("n"))
    counted = stored(counted, "words")
    near = near_words(counted, tile)
    good = F.col("best_n") >= F.lit(ratio) * F.col("n")
    judged = stored(
        counted.join(near.hint("merge"), "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(good, F.col("best")).alias("form"),
            F.when(good, F.col("best_n")).alias("form_n"),
        ),
        "variants",
    )
    ends = roots(judged.where("form is not null"))
    return judged.join(ends.hint("merge"), "word", "left").withColumn("root", F.coalesce("root", "word"))
