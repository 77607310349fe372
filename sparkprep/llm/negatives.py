"""Hard negatives by rotated one-bit codes whose bounds are certain.

Vectors are integers and a score is an exact inner product. Every vector is indexed by a short code:
it is rotated, and the signs of its components are kept, one bit each. With the bits stands
the alignment of the vector with its code vector (the signs, scaled to length one). What the
code vector leaves over is coded again under another rotation, ``LEVELS`` times; the length of
the last residual is stored too. So a vector is

    x  =  sum over levels of  alignment * code vector  +  residual,

and the residual is orthogonal to the last code vector.

For an anchor q the inner products with all code vectors are popcounts: the rotated anchor is
rounded to ``PLANES`` bits a component, and each plane of bits is ANDed with the code. The sum over
levels estimates the score. What can be missing is bounded, not guessed: the residual by
Cauchy-Schwarz with the part of q that is orthogonal to the last code vector, the rounding of
q by Cauchy-Schwarz with its own, known error. So each row has an interval that certainly
holds its score. Rows whose interval cannot reach the wanted range, or that are certainly
beaten by k others, are dropped; the rest are scored in integers. Nothing is lost.

Anchors, a stated query set, meet all rows in blocks: a cell is one block of anchors and one
block of rows, both of bounded size, so a label with a third of all rows is many cells.
A cell returns the best k per anchor or range; these are ranked together.

Of rows that share an id the one with the smallest label, then vector, counts. Rows without an
id, label or vector, or with a null component, or with an empty vector, take no part, and only
vectors of one length are compared. Scores beyond 64 bits stop at the limits of a BIGINT.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from sparkprep.llm.common import stored

LEVELS = 6
PLANES = 8
SEED = 42
ANCHOR_BLOCK = 1_024
BLOCK_BYTES = 16 << 20
SLAB_CELLS = 65_536
_EXACT = float(1 << 53)  # below it sums of products of integers are exact in a double
_LIMIT = (1 << 63) - 1
_SLACK = 1e-9  # more than rounding in doubles can add to an interval, relative to its lengths


@functools.lru_cache(maxsize=8)
def rotations(dim: int, levels: int = LEVELS, seed: int = SEED) -> np.ndarray:
    """One random rotation per level."""
    rng = np.random.default_rng([seed, dim])
    return np.stack([np.linalg.qr(rng.standard_normal((dim, dim)))[0] for _ in range(levels)])


def pack(bits: np.ndarray) -> np.ndarray:
    """The last axis of a 0/1 array as 64-bit words, padded with zeros."""
    packed = np.packbits(bits, axis=-1, bitorder="little")
    short = -packed.shape[-1] % 8
    packed = np.pad(packed, [(0, 0)] * (packed.ndim - 1) + [(0, short)])
    return np.ascontiguousarray(packed).view(np.uint64)


def code(x: np.ndarray, levels: int = LEVELS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bits (row, level, word), alignments (row, level) and the lengths of the last residuals."""
    n, dim = x.shape
    bits, aligned = [], []
    left = x.astype(float)
    for turn in rotations(dim, levels):
        turned = left @ turn.T
        signs = np.where(turned >= 0, 1.0, -1.0) / np.sqrt(dim)
        along = (turned * signs).sum(axis=1)
        bits.append(pack(turned >= 0))
        aligned.append(along)
        left = (turned - along[:, None] * signs) @ turn
    words = -(-dim // 64)
    return (
        np.stack(bits, axis=1) if bits else np.zeros((n, 0, words), np.uint64),
        np.stack(aligned, axis=1),
        np.linalg.norm(left, axis=1),
    )


class Anchor:
    """An anchor's rounded rotations as planes of bits, and what rounding may hide."""

    def __init__(self, q: np.ndarray, levels: int = LEVELS, planes: int = PLANES) -> None:
        self.dim, self.norm = len(q), float(np.linalg.norm(q))
        turned = rotations(len(q), levels) @ q
        self.low = turned.min(axis=1)
        self.step = np.maximum((turned.max(axis=1) - self.low) / ((1 << planes) - 1), 1e-300)
        whole = np.clip(np.rint((turned - self.low[:, None]) / self.step[:, None]), 0, (1 << planes) - 1).astype(np.int64)
        self.total = whole.sum(axis=1)
        back = whole * self.step[:, None] + self.low[:, None]
        self.error = np.linalg.norm(turned - back, axis=1)
        self.sum = back.sum(axis=1)
        self.planes = np.stack([pack(whole >> b & 1) for b in range(planes)], axis=1)

    def interval(self, bits: np.ndarray, aligned: np.ndarray, residual: np.ndarray):
        """Lower and upper bounds of the inner products with coded rows."""
        n, levels, words = bits.shape
        ones = np.bitwise_count(bits).sum(axis=2, dtype=np.int64)
        shared = np.bitwise_count(bits[:, :, None, :] & self.planes)
        inside = shared.reshape(n, levels, -1) @ np.repeat(2.0 ** np.arange(self.planes.shape[1]), words)
        # Components under a set bit count plus, the others minus.
        chosen = inside * self.step + ones * self.low
        along = (2 * chosen - self.sum) / np.sqrt(self.dim)
        # The residual is orthogonal to the last code vector, so only the rest of q meets it.
        sure = np.maximum(np.abs(along[:, -1]) - self.error[-1], 0)
        rest = np.sqrt(np.maximum(self.norm**2 - sure**2, 0))
        size = np.abs(aligned)
        slack = size @ self.error + residual * rest + _SLACK * self.norm * (size.sum(axis=1) + residual)
        at = (aligned * along).sum(axis=1)
        return at - slack, at + slack


def scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products of integer vectors, within the limits of 64 bits."""
    size = np.linalg.norm(q.astype(float)) * np.linalg.norm(x.astype(float), axis=1).max(initial=0)
    if size < _EXACT / 2:
        return (x.astype(float) @ q.astype(float)).astype(np.int64)
    exact = [sum(map(int.__mul__, row, q.tolist())) for row in x.tolist()]
    return np.array([min(max(s, -_LIMIT), _LIMIT) for s in exact], np.int64)


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """The places of the k highest scores, ties by smaller id."""
    return np.lexsort((ids, -score))[:k]


def _reach(low: np.ndarray, k: int) -> float:
    """A score that k rows certainly have; minus infinity if there are fewer rows."""
    return float(np.partition(low, len(low) - k)[len(low) - k]) if len(low) >= k else -np.inf


def _vectors(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i8").reshape(-1, dim)


class Rows:
    """One block of rows with its codes."""

    def __init__(self, table: pa.Table) -> None:
        self.dim = table.column("dim")[0].as_py()
        self.id = table.column("id").to_numpy()
        self.label = table.column("label").to_numpy()
        self.x = _vectors(table.column("vector"), self.dim)
        words, n = -(-self.dim // 64), len(self.id)
        self.bits = np.frombuffer(b"".join(table.column("bits").to_pylist()), np.uint64).reshape(n, -1, words)
        self.aligned = np.frombuffer(b"".join(table.column("aligned").to_pylist())).reshape(n, -1)
        self.residual = table.column("residual").to_numpy()

    def bounds(self, anchor: Anchor):
        """Bounds of all rows; codes are read in slabs, which bounds what popcounts need."""
        step = max(1, SLAB_CELLS // anchor.planes.size)
        parts = [
            anchor.interval(self.bits[i : i + step], self.aligned[i : i + step], self.residual[i : i + step])
            for i in range(0, len(self.id), step)
        ]
        return tuple(np.clip(np.concatenate(p), -float(_LIMIT), float(_LIMIT)) for p in zip(*parts))


def _positives(k: int, anchors: pa.Table, table: pa.Table) -> pa.Table:
    """The best k rows of one block for each anchor of the same label; labels are equal here."""
    out: list[tuple] = []
    if len(anchors) and len(table):
        rows = Rows(table)
        for anchor_id, q in zip(anchors.column("id").to_pylist(), _vectors(anchors.column("vector"), rows.dim)):
            other = np.flatnonzero(rows.id != anchor_id)
            low, high = (b[other] for b in rows.bounds(Anchor(q.astype(float))))
            other = other[high >= _reach(low, k)]
            score = scores(q, rows.x[other])
            ids = rows.id[other]
            out += [(anchor_id, int(ids[i]), int(score[i])) for i in _best(score, ids, k)]
    columns = list(zip(*out)) or [[]] * 3
    names = ["anchor_id", "positive_id", "positive_score"]
    return pa.table([pa.array(c, pa.int64()) for c in columns], names=names)


def in_range(score, positive, low: int, high: int):
    """Whether a score lies between ``low`` and ``high`` hundredths of the positive's."""
    return (low * positive <= 100 * score) & (100 * score <= high * positive)


def _negatives(k: int, low_share: int, high_share: int, anchors: pa.Table, table: pa.Table) -> pa.Table:
    """The best k rows of one block for each anchor and positive."""
    out: list[tuple] = []
    if len(anchors) and len(table):
        rows = Rows(table)
        vectors = _vectors(anchors.column("vector"), rows.dim)
        every = zip(
            anchors.column("id").to_pylist(), anchors.column("label").to_pylist(), vectors,
            anchors.column("positives").to_pylist(),
        )
        for anchor_id, label, q, positives in every:
            other = np.flatnonzero(rows.label != label)
            low, high = (b[other] for b in rows.bounds(Anchor(q.astype(float))))
            live = np.zeros(len(other), bool)
            for p in positives:
                bottom, top = low_share * p["score"] / 100, high_share * p["score"] / 100
                if bottom > top:
                    continue
                edge = _SLACK * abs(p["score"])
                sure = low[(low >= bottom + edge) & (high <= top - edge)]
                live |= (high >= max(bottom - edge, _reach(sure, k))) & (low <= top + edge)
            other = other[live]
            score = scores(q, rows.x[other])
            ids = rows.id[other]
            plain = [int(s) for s in score] if len(score) and np.abs(score).max() > 1 << 56 else score
            for p in positives:
                big = isinstance(plain, list) or abs(p["score"]) > 1 << 56
                values = np.array(plain, object) if big else score
                fits = np.flatnonzero(np.asarray(in_range(values, p["score"], low_share, high_share), bool))
                for i in fits[_best(score[fits], ids[fits], k)]:
                    out.append((anchor_id, p["id"], p["score"], int(ids[i]), int(score[i])))
    columns = list(zip(*out)) or [[]] * 5
    names = ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"]
    return pa.table([pa.array(c, pa.int64()) for c in columns], names=names)


def _coded(batches):
    for batch in batches:
        vectors = batch.column("vector").to_pylist()
        dims = np.array([len(v) for v in vectors], np.int64)
        packed, bits, aligned, residual = ([None] * len(vectors) for _ in range(4))
        for dim in np.unique(dims):
            at = np.flatnonzero(dims == dim)
            x = np.array([vectors[i] for i in at], np.int64)
            b, a, r = code(x.astype(float))
            for j, i in enumerate(at):
                packed[i], bits[i], aligned[i], residual[i] = x[j].tobytes(), b[j].tobytes(), a[j].tobytes(), float(r[j])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("id"), batch.column("label"), pa.array(dims, pa.int32()),
                pa.array(packed, pa.binary()), pa.array(bits, pa.binary()), pa.array(aligned, pa.binary()),
                pa.array(residual, pa.float64()),
            ],
            ["id", "label", "dim", "vector", "bits", "aligned", "residual"],
        )


CODES = "id bigint, label bigint, dim int, vector binary, bits binary, aligned binary, residual double"


def index_vectors(df: DataFrame, *, vec_id: str, vector: str, label: str) -> DataFrame:
    """``CODES`` of every row that takes part, written to the shared folder."""
    whole = F.forall(vector, lambda x: x.isNotNull()) & (F.size(vector) > 0)
    rows = df.where(F.col(vec_id).isNotNull() & F.col(label).isNotNull() & F.coalesce(whole, F.lit(False)))
    row = F.struct(F.col(label).cast("bigint").alias("label"), F.col(vector).cast("array<bigint>").alias("vector"))
    one = rows.groupBy(F.col(vec_id).cast("bigint").alias("id")).agg(F.min(row).alias("row"))
    return stored(one.select("id", "row.label", "row.vector").mapInArrow(_coded, CODES), "codes")


def _cells(anchors: DataFrame, rows: DataFrame, within: list[str]) -> tuple[DataFrame, DataFrame]:
    """Both tables with the numbers of the cells they are in: ``a`` and ``r`` inside each group."""

    def blocks(df: DataFrame, room: Column, name: str) -> DataFrame:
        sizes = df.groupBy(*within).agg(F.count("*").alias("_n"))
        return sizes.select(*within, F.greatest(F.lit(1), F.ceil(F.col("_n") / room)).cast("int").alias(name))

    per_row = F.greatest(F.lit(1), F.floor(F.lit(BLOCK_BYTES) / (F.col("dim") * 8 + 128)))
    counts = blocks(anchors, F.lit(ANCHOR_BLOCK), "_a").join(blocks(rows, per_row, "_r"), within)

    def numbered(df: DataFrame, own: str, other: str) -> DataFrame:
        mine = F.pmod(F.xxhash64("id", F.lit(3)), F.col(f"_{own}")).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.col(f"_{other}") - 1))
        return df.join(counts, within).withColumn(own, mine).withColumn(other, every).drop("_a", "_r")

    return numbered(anchors, "a", "r"), numbered(rows, "r", "a")


def _ranked(df: DataFrame, group: list[str], score: str, ident: str, k: int) -> DataFrame:
    order = Window.partitionBy(*group).orderBy(F.desc(score), F.asc(ident))
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine_negatives(
    df: DataFrame,
    anchors: Column,
    *,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``vector`` holds integers; ``anchors`` is a condition on the columns of ``df``. An anchor's
    positives are its best ``positives`` other rows of its label; for each, the best
    ``negatives`` rows of other labels whose score is between ``low`` and ``high`` hundredths of
    the positive's.
    """
    rows = index_vectors(df, vec_id=vec_id, vector=vector, label=label)
    wanted = df.where(anchors).select(F.col(vec_id).cast("bigint").alias("id")).distinct()
    chosen = stored(rows.join(wanted, "id", "left_semi").select("id", "label", "dim", "vector"), "anchors")
    left, right = _cells(chosen, rows, ["dim", "label"])
    cell = ["dim", "label", "a", "r"]
    found = (
        left.groupBy(*cell)
        .cogroup(right.groupBy(*cell))
        .applyInArrow(
            functools.partial(_call, _positives, (positives,)),
            "anchor_id bigint, positive_id bigint, positive_score bigint",
        )
    )
    best = _ranked(found, ["anchor_id"], "positive_score", "positive_id", positives)
    one = F.struct(F.col("positive_id").alias("id"), F.col("positive_score").alias("score"))
    pairs = best.groupBy(F.col("anchor_id").alias("id")).agg(F.collect_list(one).alias("positives"))
    with_positives = stored(chosen.join(pairs, "id"), "positives")
    left, right = _cells(with_positives, rows, ["dim"])
    cell = ["dim", "a", "r"]
    taken = (
        left.groupBy(*cell)
        .cogroup(right.groupBy(*cell))
        .applyInArrow(
            functools.partial(_call, _negatives, (negatives, low, high)),
            "anchor_id bigint, positive_id bigint, positive_score bigint, negative_id bigint, negative_score bigint",
        )
    )
    return _ranked(taken, ["anchor_id", "positive_id"], "negative_score", "negative_id", negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


def _call(work, settings, anchors: pa.Table, rows: pa.Table) -> pa.Table:
    return work(*settings, anchors, rows)
