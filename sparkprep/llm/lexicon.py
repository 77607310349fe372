"""A minimal acyclic transducer from words to id sequences, in memory-mapped arrays.

Words that end alike share their tail states. Every transition carries a number;
the numbers along a word add up to its rank among the words, and the rank finds
its ids. The arrays lie in one file, which all workers of a machine map at once.
"""

from __future__ import annotations

import json
import os
from collections.abc import Sequence

import numpy as np

_ARRAYS = ("keys", "targets", "adds", "finals", "starts", "ids")
_HEADER = 4_096  # bytes before the arrays, which begin at multiples of it


def build(words: Sequence[bytes], outputs: Sequence[Sequence[int]], path: str) -> None:
    """Write the arrays for distinct words in ascending order and their ids."""
    root, nodes = _minimal(words)
    counts: list[int] = []
    keys, targets, adds = [], [], []
    for number, (final, edges) in enumerate(nodes):  # children come before parents
        seen = int(final)
        for label, child in edges:
            keys.append(number << 8 | label)
            targets.append(child)
            adds.append(seen)
            seen += counts[child]
        counts.append(seen)
    starts = np.zeros(len(words) + 1, np.int64)
    starts[1:] = np.cumsum([len(o) for o in outputs])
    flat = [i for o in outputs for i in o]
    arrays = (
        np.array(keys, np.int64),
        np.array(targets, np.int32),
        np.array(adds, np.int32),
        np.array([root, *(f for f, _ in nodes)], np.int32),
        starts,
        np.array(flat, np.int32),
    )
    places, at = {}, _HEADER
    for name, a in zip(_ARRAYS, arrays):
        places[name] = (a.dtype.str, len(a), at)
        at += -(-a.nbytes // _HEADER) * _HEADER
    with open(path, "wb") as out:
        out.write(json.dumps(places).encode().ljust(_HEADER))
        for (_, _, start), a in zip(places.values(), arrays):
            out.seek(start)
            out.write(a.tobytes())


def _minimal(words: Sequence[bytes]) -> tuple[int, list[tuple[bool, tuple]]]:
    """The root and the states ``(final, ((label, child), ...))``, equal ones merged."""
    known: dict[tuple, int] = {}
    nodes: list[tuple[bool, tuple]] = []

    def close(state: list) -> int:
        key = (state[0], tuple(state[1]))
        if key not in known:
            known[key] = len(nodes)
            nodes.append(key)
        return known[key]

    # The states on the way to the last word are open; a word closes those it leaves.
    path: list[list] = [[False, []]]
    last = b""
    for word in words:
        same = len(os.path.commonprefix([word, last]))
        for depth in range(len(last), same, -1):
            child = close(path.pop())
            path[-1][1].append((last[depth - 1], child))
        path += [[False, []] for _ in range(len(word) - same)]
        path[-1][0] = True
        last = word
    for depth in range(len(last), 0, -1):
        child = close(path.pop())
        path[-1][1].append((last[depth - 1], child))
    return close(path.pop()), nodes


class Lexicon:
    """The mapped arrays."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as f:
            places = json.loads(f.read(_HEADER))
        loaded = [
            np.asarray(np.memmap(path, kind, "r", at, (n,))) if n else np.zeros(0, kind)
            for kind, n, at in (places[name] for name in _ARRAYS)
        ]
        self.keys, self.targets, self.adds, roots, self.starts, self.ids = loaded
        self.root, self.finals = int(roots[0]), roots[1:]

    def ranks(self, words: Sequence[bytes]) -> np.ndarray:
        """The rank of every word, -1 for a word that is not in the lexicon.

        All words take a step at a time: one search among the transitions for all.
        """
        rank = np.full(len(words), -1, np.int64)
        if not words or not len(self.keys):
            return rank
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        begins = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        letters = np.frombuffer(b"".join(words), np.uint8)
        alive = np.flatnonzero(sizes > 0)
        state = np.full(len(alive), self.root, np.int64)
        total = np.zeros(len(alive), np.int64)
        depth = 0
        while len(alive):
            key = state << 8 | letters[begins[alive] + depth]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            ok = self.keys[at] == key
            alive, at = alive[ok], at[ok]
            state = self.targets[at].astype(np.int64)
            total = total[ok] + self.adds[at]
            depth += 1
            done = sizes[alive] == depth
            hit = done & (self.finals[state] != 0)
            rank[alive[hit]] = total[hit]
            alive, state, total = alive[~done], state[~done], total[~done]
        return rank
