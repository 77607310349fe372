"""Near-duplicate vectors by a forest of random-projection trees with spill.

Vectors are compared inside a group (a label). Every tree splits a group by random
directions: a direction is drawn, the vectors are projected on it, and the two sides
of a threshold go on separately. Vectors close to the threshold go to both sides
(spill), so that neighbours are rarely parted. Among several directions and thresholds
the one is taken that parts the fewest linked pairs of a sample and has few vectors in
its spill, so a cluster is not cut if there is another place. Leaves are compared
within, exactly, in double precision. Several trees find what one misses.

A node is left whole, at any size, where many of its sampled pairs are linked and every
cut would part some of them: there most comparisons find links. Leaves of more than
``TASK_ROWS`` vectors are dealt into blocks, and each pair of blocks is a group of its own.

Splits are fitted in Spark tasks, leaf by leaf, on about ``FIT_VECTORS`` vectors of each
leaf; every vector is routed and compared. Leaves that come out too large are split
again with a sample of their own in the next round. A split is the number of a
direction, which is drawn again where it is needed, and two thresholds.

Pairs are not written out. A leaf returns for each of its vectors the weight of its
linked partners and one link toward the root of its component. Two vectors that meet in
several leaves count in the first leaf they share, which each leaf can tell from the leaf
lists of its rows. In a leaf, vectors within half the angle of the leaf's mean direction
are all linked with each other and are counted without comparing them. Copies of
a vector are one node with a weight.

A vector links with nothing if its label or id is null, or if it is null, empty, all zero,
or holds a null or non-finite component. Rows of one id and one vector are copies
and count each other. Vectors of different lengths are never compared.
"""

from __future__ import annotations

import functools
import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sparkprep.llm.common import stored
from sparkprep.llm.components import connected_components

COSINE = 0.93
TREES = 3
LEAF = 256
TASK_ROWS = 16_384  # vectors of one block of a large leaf
FIT_VECTORS = 8_192
MIN_FIT = 48
SPILL = 0.06
CANDIDATES = 6
SHARES = (0.5, 0.4, 0.6, 0.3, 0.7, 0.2, 0.8, 0.1, 0.9)
PAIR_SAMPLE = 384  # sampled vectors of a node whose pairs are looked at
DENSE_SHARE = 0.02  # from this share of linked pairs on a node is dense,
PARTED = 0.01  # and is cut only if that parts no more of them
ROUNDS = 6
SEED = 42
BLOCK = 1_024

Split = tuple[int, float, float]  # number of the direction, and where its spill begins and ends


@functools.lru_cache(maxsize=1 << 16)
def leaf_id(name: str) -> int:
    """A 64-bit number for a leaf's name, the same in every process."""
    return int.from_bytes(hashlib.blake2b(name.encode(), digest_size=8).digest(), "big", signed=True)


@functools.lru_cache(maxsize=1 << 14)
def direction(seed: int, leaf: int, node: int, candidate: int, size: int) -> np.ndarray:
    """A random unit vector that any process draws alike."""
    drawn = np.random.default_rng([seed, leaf & (1 << 63) - 1, node, candidate]).standard_normal(size)
    return drawn / np.linalg.norm(drawn)


class Forest:
    """Fitted splits: under the id of a leaf, the subtree that replaces it."""

    def __init__(self, cosine: float, leaf: int, spill: float, seed: int) -> None:
        self.cosine, self.half_angle = cosine, math.cos(math.acos(cosine) / 2)
        self.leaf, self.spill, self.seed = leaf, spill, seed
        self.trees: dict[int, dict[int, Split]] = {}

    def fit(self, leaf: int, sample: np.ndarray, total: int) -> dict[int, Split]:
        """Split one leaf until the expected sizes fit or too few vectors are left to tell."""
        scale = total / len(sample)
        nodes: dict[int, Split] = {}
        todo = [(1, np.arange(len(sample)))]
        while todo:
            node, rows = todo.pop()
            if len(rows) * scale <= self.leaf or len(rows) < MIN_FIT:
                continue
            split = self._split(leaf, node, sample[rows])
            if split is None:
                continue
            nodes[node] = split
            at = sample[rows] @ direction(self.seed, leaf, node, split[0], sample.shape[1])
            todo.append((2 * node, rows[at <= split[2]]))
            todo.append((2 * node + 1, rows[at >= split[1]]))
        return nodes

    def _split(self, leaf: int, node: int, x: np.ndarray) -> Split | None:
        """The best of several cuts; none if it would part the links of a dense node."""
        some = np.linspace(0, len(x) - 1, min(len(x), PAIR_SAMPLE)).astype(int)
        i, j = np.nonzero(np.triu(x[some] @ x[some].T >= self.cosine, 1))
        dense = len(i) >= DENSE_SHARE * len(some) * (len(some) - 1) / 2
        best, found, loss = math.inf, None, 0.0
        for candidate in range(CANDIDATES):
            along = x @ direction(self.seed, leaf, node, candidate, x.shape[1])
            at = np.sort(along)
            lower = np.minimum(along[some][i], along[some][j])
            upper = np.maximum(along[some][i], along[some][j])
            half = self.spill * float(at.std())
            for share in SHARES:
                cut = (at[int(share * (len(at) - 1))] + at[int(share * (len(at) - 1)) + 1]) / 2
                a, b = np.searchsorted(at, (cut - half, cut + half))
                parted = float(((upper > cut + half) & (lower < cut - half)).mean()) if len(i) else 0.0
                cost = (b - a) / len(at) + 0.1 * abs(share - 0.5) + 2 * parted
                # Both sides must be smaller than the whole.
                if 0 < a and b < len(at) and cost < best:
                    best, found, loss = cost, (candidate, float(cut - half), float(cut + half)), parted
        return None if dense and loss > PARTED else found

    def route(self, leaf: int, x: np.ndarray, rows: np.ndarray):
        """The leaves below ``leaf`` and the rows that reach each."""
        todo = [(leaf, 1, rows)]
        while todo:
            tree, node, at = todo.pop()
            if not len(at):
                continue
            nodes = self.trees.get(tree)
            split = nodes.get(node) if nodes else None
            if split is None:
                if node == 1:
                    yield tree, at
                else:  # an end of this subtree: a leaf, perhaps split in a later round
                    todo.append((leaf_id(f"{tree}.{node}"), 1, at))
                continue
            along = x[at] @ direction(self.seed, tree, node, split[0], x.shape[1])
            todo.append((tree, 2 * node, at[along <= split[2]]))
            todo.append((tree, 2 * node + 1, at[along >= split[1]]))

    def ways(self, starts: tuple[int, ...]) -> tuple[int, ...]:
        """The trees to follow: all, or one that was not split, which compares all with all."""
        whole = [s for s in starts if not self.trees.get(s)]
        return tuple(whole[:1]) or starts


def _core(x: np.ndarray, half_angle: float) -> np.ndarray:
    """Vectors within half the linking angle of the mean direction."""
    mean = x.mean(axis=0)
    size = np.linalg.norm(mean)
    # Strictly inside, by more than rounding can be off.
    return x @ (mean / size) >= half_angle + 1e-9 if size > 0 else np.zeros(len(x), bool)


def _matrix(vectors: list[bytes], kind: str) -> np.ndarray:
    """Vectors of equal length as unit rows in double precision."""
    x = np.frombuffer(b"".join(vectors), kind).reshape(len(vectors), -1).astype(float)
    x /= np.abs(x).max(axis=1, keepdims=True)  # squares of large components would overflow
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def usable(vec_id: Column, vector: Column, label: Column) -> Column:
    """Whether a vector can link with others."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    nonzero = F.exists(vector, lambda x: x != 0)
    return F.coalesce(vec_id.isNotNull() & label.isNotNull() & finite & nonzero, F.lit(False))


def _route(forest: Forest, kind: str, batches):
    """Add the sorted ids of all leaves a vector reaches; vectors become bytes."""
    for batch in batches:
        vectors = [np.asarray(v, kind).tobytes() for v in batch.column("vector").to_pylist()]
        groups: dict[tuple[int, ...], list[int]] = {}
        for r, starts in enumerate(batch.column("starts").to_pylist()):
            groups.setdefault(tuple(starts), []).append(r)
        leaves: list[list[int]] = [[] for _ in vectors]
        for starts, members in groups.items():
            rows = np.array(members)
            x = _matrix([vectors[r] for r in members], kind)
            for start in forest.ways(starts):
                for leaf, inside in forest.route(start, x, np.arange(len(rows))):
                    for r in rows[inside].tolist():
                        leaves[r].append(leaf)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("node"),
                batch.column("n"),
                pa.array(vectors, pa.binary()),
                pa.array([sorted(x) for x in leaves], pa.list_(pa.int64())),
            ],
            ["node", "n", "vector", "leaves"],
        )


def routed(nodes: DataFrame, forest: Forest, kind: str) -> DataFrame:
    """``node, n, vector, leaves`` of every vector."""
    return nodes.select("node", "n", "starts", "vector").mapInArrow(
        functools.partial(_route, forest, kind), "node bigint, n bigint, vector binary, leaves array<bigint>"
    )


def _fit(forest: Forest, kind: str, table: pa.Table) -> pa.Table:
    """The splits of one leaf from its sample; a node 0 if it stays whole."""
    order = np.argsort(table.column("draw").to_numpy(), kind="stable")
    vectors = table.column("vector").to_pylist()
    packed = [v if isinstance(v, bytes) else np.asarray(v, kind).tobytes() for v in vectors]
    leaf = table.column("leaf")[0].as_py()
    nodes = forest.fit(leaf, _matrix([packed[i] for i in order], kind), table.column("size")[0].as_py())
    rows = [(leaf, node, *split) for node, split in sorted(nodes.items())] or [(leaf, 0, 0, 0.0, 0.0)]
    names = ["leaf", "split", "candidate", "low", "high"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.float64(), pa.float64()]
    return pa.table([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def build_forest(nodes: DataFrame, forest: Forest, kind: str) -> DataFrame | None:
    """Fit splits, round by round, until every leaf is small or stays whole.

    Returns the sizes of the large leaves, or nothing if no group is large. Only splits come to
    the driver, 28 bytes each, about one for every ``leaf`` vectors of a tree.
    """
    groups = nodes.groupBy("starts").agg(F.count("*").alias("size")).where(F.col("size") > forest.leaf)
    large = sizes = stored(groups.select(F.explode("starts").alias("leaf"), "size"), "large-leaves")
    reached = nodes.select("node", F.explode("starts").alias("leaf"), "vector")
    whole = None

    def fit(leaf_rows: pa.Table) -> pa.Table:
        return _fit(forest, kind, leaf_rows)

    for _ in range(ROUNDS):
        if large.isEmpty():
            break
        draw = F.pmod(F.xxhash64("leaf", "node", "vector"), F.lit(1 << 30))
        sample = reached.join(large, "leaf").withColumn("draw", draw)
        sample = sample.where(F.col("draw") < F.lit(FIT_VECTORS * (1 << 30)) / F.col("size"))
        splits = stored(
            sample.select("leaf", "size", "draw", "vector")
            .groupBy("leaf")
            .applyInArrow(fit, "leaf bigint, split bigint, candidate int, low double, high double"),
            "splits",
        )
        for leaf, node, *split in zip(*(c.to_pylist() for c in splits.where("split > 0").toArrow().columns)):
            forest.trees.setdefault(leaf, {})[node] = tuple(split)
        kept = splits.where("split = 0").select("leaf")
        whole = kept if whole is None else whole.union(kept)
        reached = routed(nodes, forest, kind).select("node", "vector", F.explode("leaves").alias("leaf"))
        counts = reached.groupBy("leaf").agg(F.count("*").alias("size"))
        # Fitting aims below the limit; a little above it is not worth another round.
        sizes = stored(counts.where(F.col("size") > min(4 * forest.leaf, TASK_ROWS)), "large-leaves")
        large = sizes.where(F.col("size") > 4 * forest.leaf).join(whole, "leaf", "left_anti")
    return sizes if whole is not None else None


def in_blocks(leaves: DataFrame, sizes: DataFrame) -> DataFrame:
    """Rows of leaves for each pair of blocks they are in; small leaves are one block.

    A row of block k is ``right`` in the pairs with smaller blocks and not in the others.
    """
    blocks = F.ceil(F.col("size") / TASK_ROWS).cast("int")
    several = sizes.where(F.col("size") > TASK_ROWS).select("leaf", blocks.alias("blocks"))
    dealt = leaves.join(several, "leaf", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("node", "vector"), F.col("blocks")).cast("int"))
    pairs = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return pairs.select(
        "leaf", "node", "n", "vector", "leaves",
        F.least("own", "other").alias("block_a"),
        F.greatest("own", "other").alias("block_b"),
        (F.col("own") > F.col("other")).alias("right"),
    )


def _compare(cosine: float, half_angle: float, kind: str, table: pa.Table) -> pa.Table:
    """Inside one leaf: for each vector the weight of its partners, and its root.

    With rows that are ``right``, these are compared with the others only.
    """
    node = table.column("node").to_numpy()
    order = np.argsort(node, kind="stable")
    node = node[order]
    weight = table.column("n").to_numpy()[order]
    vectors = table.column("vector").to_pylist()
    x = _matrix([vectors[i] for i in order], kind)
    here = table.column("leaf")[0].as_py()
    lists = table.column("leaves").to_pylist()
    width = max(map(len, lists))
    listed = np.zeros((len(node), width), np.int64)
    filled = np.zeros((len(node), width), bool)
    for at, i in enumerate(order):
        listed[at, : len(lists[i])] = lists[i]
        filled[at, : len(lists[i])] = True
    # Rows that reach the same leaves are of one kind; the links to count depend on kinds only.
    _, example, kind_of = np.unique(
        np.hstack([np.where(filled, listed, 0), filled]), axis=0, return_index=True, return_inverse=True
    )
    kind_of = kind_of.ravel()

    def counted(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether links of kind a with kind b count here, pair by pair."""
        a, b = example[a], example[b]
        return _first_shared(listed[a], filled[a], listed[b], filled[b], here)

    sides = [np.arange(len(node))] * 2
    one_block = True
    if "right" in table.column_names:
        right = table.column("right").to_numpy()[order]
        if right.any():
            one_block, sides = False, [np.flatnonzero(~right), np.flatnonzero(right)]
        elif table.column("block_a")[0] != table.column("block_b")[0]:
            sides = [sides[0], sides[0][:0]]
    links = np.zeros(len(node), np.int64)
    root = np.arange(len(node))
    distinct = len(np.unique(node)) == len(node)
    core = _core(x, half_angle) if distinct and len(sides[1]) else np.zeros(len(node), bool)
    if core.sum() > 1:
        _link_core([s[core[s]] for s in sides], one_block, weight, kind_of, counted, links, root)
    for a in range(0, len(sides[0]), BLOCK):
        for b in range(a if one_block else 0, len(sides[1]), BLOCK):
            left, right = sides[0][a : a + BLOCK], sides[1][b : b + BLOCK]
            if core[left].all() and core[right].all():
                continue
            linked = x[left] @ x[right].T >= cosine
            linked &= ~(core[left][:, None] & core[right][None, :])
            if one_block and a == b:
                linked = np.triu(linked, 1)
            if not distinct:
                linked &= node[left][:, None] != node[right][None, :]
            _union_linked(root, left, right, linked)
            _count_linked(linked, left, right, weight, kind_of, counted, links)
    some = (links > 0) | (root < np.arange(len(node)))
    return pa.table(
        [pa.array(node[some]), pa.array(links[some]), pa.array(node[root[some]])],
        names=["node", "links", "root"],
    )


def _count_linked(linked, left, right, weight, kind_of, counted, links) -> None:
    """Add the weights of linked partners, as far as the links count here."""
    found = np.count_nonzero(linked)
    if not found:
        return
    kinds_a, of_a = np.unique(kind_of[left], return_inverse=True)
    kinds_b, of_b = np.unique(kind_of[right], return_inverse=True)
    if len(kinds_a) * len(kinds_b) <= found:
        pairs = counted(np.repeat(kinds_a, len(kinds_b)), np.tile(kinds_b, len(kinds_a)))
        linked = linked & pairs.reshape(len(kinds_a), -1)[of_a][:, of_b]
        ones = linked.astype(float)  # sums of whole numbers, exact
        links[left] += (ones @ weight[right].astype(float)).astype(np.int64)
        links[right] += (weight[left].astype(float) @ ones).astype(np.int64)
        return
    i, j = np.nonzero(linked)
    first = counted(kind_of[left][i], kind_of[right][j])
    i, j = left[i[first]], right[j[first]]
    np.add.at(links, i, weight[j])
    np.add.at(links, j, weight[i])


def _link_core(sides, one_block, weight, kind_of, counted, links, root) -> None:
    """Link all rows of two sides (or of one block) with each other, kind by kind."""
    if not len(sides[0]) or not len(sides[1]):
        return
    both = np.concatenate(sides)
    root[both] = both.min()
    for mine, others in [sides] if one_block else [sides, sides[::-1]]:
        kinds = np.unique(kind_of[others])
        weights = np.bincount(np.searchsorted(kinds, kind_of[others]), weight[others], len(kinds)).astype(np.int64)
        for k in np.unique(kind_of[mine]):
            first = counted(np.full(len(kinds), k), kinds)
            rows = mine[kind_of[mine] == k]
            own = one_block and first[np.searchsorted(kinds, k)]
            links[rows] += weights[first].sum() - (weight[rows] if own else 0)


def _union_linked(root, left, right, linked) -> None:
    """Join the components of linked rows; one partner of each row at a time."""
    while True:
        apart = linked & (root[left][:, None] != root[right][None, :])
        rows = np.flatnonzero(apart.any(axis=1))
        if not len(rows):
            return
        _union(root, left[rows], right[apart[rows].argmax(axis=1)])


def _union(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Join the components of pairs; ``root`` points straight to the smallest of each."""
    while True:
        a, b = root[i], root[j]
        apart = a != b
        if not apart.any():
            return
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root[root] != root).any():
            root[:] = root[root]


def _first_shared(a, a_filled, b, b_filled, here: int) -> np.ndarray:
    """Whether ``here`` is the smallest leaf that the rows of a and b share, pair by pair."""
    decided = np.zeros(len(a), bool)
    first = np.zeros(len(a), bool)
    for k in range(a.shape[1]):
        same = ((b == a[:, k, None]) & b_filled).any(axis=1)
        shared = ~decided & a_filled[:, k] & same
        first |= shared & (a[:, k] == here)
        decided |= shared
    return first


def near_duplicates(
    df: DataFrame,
    *,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    cosine: float = COSINE,
    leaf: int = LEAF,
    spill: float = SPILL,
    seed: int = SEED,
) -> DataFrame:
    """``vec_id, n_links, component_id, kept``: one row per row of ``df``."""
    kind = "<f8" if df.schema[vector].dataType.elementType.typeName() == "double" else "<f4"
    rows = df.select(
        F.col(vec_id).cast("bigint").alias("vec_id"),
        F.col(vector).alias("vector"),
        usable(F.col(vec_id), F.col(vector), F.col(label)).alias("usable"),
        F.concat_ws(".", F.col(label).cast("string"), F.size(vector).cast("string")).alias("group"),
    )
    keys = {"k1": F.xxhash64("group", "vector"), "k2": F.xxhash64(F.lit(1), "group", "vector")}
    valid = rows.where("usable").withColumns(keys)
    copies = stored(
        valid.groupBy("k1", "k2")
        .agg(F.min("vec_id").alias("node"), F.count("*").alias("n"))
        .where("n > 1"),
        "copies",
    )
    marked = valid.join(copies, ["k1", "k2"], "left")
    starts = F.array(*[F.xxhash64("group", F.lit(t)) for t in range(TREES)]).alias("starts")
    one = F.lit(1).cast("bigint").alias("n")
    single = marked.where("n is null").select(F.col("vec_id").alias("node"), one, starts, "vector")
    several = marked.where("vec_id = node").dropDuplicates(["k1", "k2"]).select("node", "n", starts, "vector")
    nodes = single.union(several)

    forest = Forest(cosine, leaf, spill, seed)
    sizes = build_forest(nodes, forest, kind)
    leaves = routed(nodes, forest, kind).withColumn("leaf", F.explode("leaves"))
    keys_of_task = ["leaf"]
    if sizes is not None:
        leaves, keys_of_task = in_blocks(leaves, sizes), ["leaf", "block_a", "block_b"]
    half_angle = forest.half_angle

    def compare(leaf_rows: pa.Table) -> pa.Table:
        return _compare(cosine, half_angle, kind, leaf_rows)

    found = stored(
        leaves.groupBy(*keys_of_task).applyInArrow(compare, "node bigint, links bigint, root bigint"),
        "leaf-links",
    )
    roots = connected_components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    known = stored(
        links.join(roots, "node", "left").select("node", "links", F.coalesce("root", "node").alias("root")),
        "links",
    )

    slim = rows.select(
        "vec_id", "usable", *[F.when(F.col("usable"), k).alias(n) for n, k in keys.items()]
    ).join(copies, ["k1", "k2"], "left")
    own = F.when(F.col("usable"), F.coalesce("node", "vec_id"))
    named = slim.select("vec_id", own.alias("node"), (F.coalesce("n", F.lit(1)) - 1).alias("twins"))
    component = F.coalesce("root", "node", "vec_id")
    return named.join(known, "node", "left").select(
        "vec_id",
        (F.col("twins") + F.coalesce("links", F.lit(0))).alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
