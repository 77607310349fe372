"""Regular expressions to one minimal deterministic automaton over bytes.

The syntax is what the rules need: literals, ``\\xHH`` and escaped characters,
classes, groups, alternatives and the repeats ``? * + {n} {n,}``. Rules become
one nondeterministic automaton; subset construction and partition refinement make
it deterministic and minimal. Bytes that no rule tells apart share a class, so
the transition array has one column per class.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


class _Nfa:
    """States with byte transitions and free moves."""

    def __init__(self) -> None:
        self.moves: list[list[tuple[frozenset, int]]] = []
        self.free: list[list[int]] = []

    def state(self) -> int:
        self.moves.append([])
        self.free.append([])
        return len(self.moves) - 1

    def closure(self, states: list[int]) -> set[int]:
        seen, todo = set(states), list(states)
        while todo:
            for t in self.free[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return seen


class _Parser:
    """Adds the automaton of a pattern to an ``_Nfa``; every part is a pair (start, end)."""

    def __init__(self, nfa: _Nfa, pattern: str, ignore_case: bool = False) -> None:
        self.nfa, self.p, self.at, self.fold = nfa, pattern, 0, ignore_case

    def alternatives(self) -> tuple[int, int]:
        start, end = self.nfa.state(), self.nfa.state()
        while True:
            a, b = self.sequence()
            self.nfa.free[start].append(a)
            self.nfa.free[b].append(end)
            if self._peek() != "|":
                return start, end
            self.at += 1

    def sequence(self) -> tuple[int, int]:
        start = end = self.nfa.state()
        while self._peek() not in ("", "|", ")"):
            a, b = self.repeat()
            self.nfa.free[end].append(a)
            end = b
        return start, end

    def repeat(self) -> tuple[int, int]:
        begin = self.at
        part = self.atom()
        after_atom = self.at
        low, high = 1, 1
        mark = self._peek()
        if mark and mark in "?*+":
            self.at += 1
            low, high = {"?": (0, 1), "*": (0, None), "+": (1, None)}[mark]
        elif mark == "{":
            close = self.p.index("}", self.at)
            bounds = self.p[self.at + 1 : close].split(",")
            low, high = int(bounds[0]), int(bounds[0]) if len(bounds) == 1 else None
            self.at = close + 1
        else:
            return part
        after = self.at
        start = end = self.nfa.state()
        copies = [part]

        def another() -> tuple[int, int]:
            if copies:
                return copies.pop()
            self.at = begin
            again = self.atom()
            assert self.at == after_atom
            return again

        for _ in range(low):
            a, b = another()
            self.nfa.free[end].append(a)
            end = b
        if high is None:
            if low:
                self.nfa.free[end].append(a)
            else:
                a, b = another()
                self.nfa.free[end].append(a)
                self.nfa.free[b].append(end)
        elif high > low:
            a, b = another()
            out = self.nfa.state()
            self.nfa.free[end] += [a, out]
            self.nfa.free[b].append(out)
            end = out
        self.at = after
        return start, end

    def atom(self) -> tuple[int, int]:
        c = self.p[self.at]
        if c == "(":
            self.at += 1
            part = self.alternatives()
            self.at += 1
            return part
        return self._step(self._class() if c == "[" else self._char())

    def _step(self, allowed: set) -> tuple[int, int]:
        if self.fold:
            allowed = {o for b in allowed for o in (b, *_other_case(b))}
        a, b = self.nfa.state(), self.nfa.state()
        self.nfa.moves[a].append((frozenset(allowed), b))
        return a, b

    def _class(self) -> set:
        self.at += 1
        allowed: set = set()
        while self._peek() != "]":
            (low,) = self._char()
            if self._peek() == "-" and self.p[self.at + 1] != "]":
                self.at += 1
                (high,) = self._char()
                allowed |= set(range(low, high + 1))
            else:
                allowed.add(low)
        self.at += 1
        return allowed

    def _char(self) -> set:
        c = self.p[self.at]
        self.at += 1
        if c == "\\":
            c = self.p[self.at]
            self.at += 1
            if c == "x":
                self.at += 2
                return {int(self.p[self.at - 2 : self.at], 16)}
        return {ord(c)}

    def _peek(self) -> str:
        return self.p[self.at] if self.at < len(self.p) else ""


def _other_case(b: int) -> tuple[int, ...]:
    return (b ^ 32,) if 65 <= b & ~32 <= 90 else ()


@dataclass(frozen=True)
class Dfa:
    """``next[state * classes + class_of[byte]]`` is the next state, times ``classes``.

    States from ``first_accepting`` on accept; ``rules[state]`` is the bit set of the
    rules that a match ends for. State 0 is the start. All states are given times
    ``classes``, so a step is one addition and one lookup.
    """

    classes: int
    class_of: bytes
    next: list[int]
    first_accepting: int
    rules: dict[int, int]


def compile_rules(rules: list[tuple[str, bool]], search: bool = True) -> Dfa:
    """The minimal automaton of patterns with their ignore-case flags.

    With ``search`` a match may begin anywhere; a state then tells for every rule
    whether a match ends here.
    """
    nfa = _Nfa()
    root = nfa.state()
    ends: dict[int, int] = {}
    for k, (pattern, fold) in enumerate(rules):
        start, end = _Parser(nfa, pattern, fold).alternatives()
        nfa.free[root].append(start)
        ends[end] = k
    return _determine(nfa, root, ends, search)


def reverse_rule(pattern: str, ignore_case: bool) -> Dfa:
    """The automaton that reads a match of the pattern backward, from its end."""
    nfa = _Nfa()
    start, end = _Parser(nfa, pattern, ignore_case).alternatives()
    back = _Nfa()
    for _ in nfa.moves:
        back.state()
    for s, moves in enumerate(nfa.moves):
        for allowed, t in moves:
            back.moves[t].append((allowed, s))
        for t in nfa.free[s]:
            back.free[t].append(s)
    return _determine(back, end, {start: 0}, search=False)


def _determine(nfa: _Nfa, root: int, ends: dict[int, int], search: bool) -> Dfa:
    sets = {allowed for moves in nfa.moves for allowed, _ in moves}
    kinds: dict[tuple, int] = {}
    ordered = sorted(sets, key=sorted)
    class_of = bytes(
        kinds.setdefault(tuple(b in s for s in ordered), len(kinds)) for b in range(256)
    )
    sample = {class_of[b]: b for b in range(256)}
    n = len(kinds)

    # Sets of states are bit masks; a move already includes the free moves after it.
    masks = [sum(1 << t for t in nfa.closure([s])) for s in range(len(nfa.moves))]
    moves = [
        [(c, masks[t]) for allowed, t in out for c, b in sample.items() if b in allowed]
        for out in nfa.moves
    ]
    start = masks[root]
    number = {start: 0}
    table: list[list[int]] = []
    marks: list[int] = []
    todo = [start]
    for states in todo:
        marks.append(sum(1 << k for end, k in ends.items() if states >> end & 1))
        row = [start if search else 0] * n
        rest = states
        while rest:
            low = rest & -rest
            rest ^= low
            for c, mask in moves[low.bit_length() - 1]:
                row[c] |= mask
        for target in row:
            if target not in number:
                number[target] = len(number)
                todo.append(target)
        table.append([number[t] for t in row])
    return _minimal(np.array(table), marks, class_of, n)


def _minimal(table: np.ndarray, marks: list[int], class_of: bytes, n: int) -> Dfa:
    """Merge states that accept alike and move to merged states alike, until nothing splits."""
    block = np.unique(np.array(marks), return_inverse=True)[1]
    count = 0
    while block.max() + 1 > count:
        count = block.max() + 1
        rows = np.ascontiguousarray(np.column_stack([block, block[table]]).astype(np.int32))
        whole = rows.view([("", rows.dtype)] * rows.shape[1]).ravel()
        block = np.unique(whole, return_inverse=True)[1]
    _, members = np.unique(block, return_index=True)
    # Start first, accepting states last.
    ranked = sorted(range(count), key=lambda b: (marks[members[b]] > 0, members[b]))
    place = np.empty(count, np.int64)
    place[ranked] = np.arange(count) * n
    flat = place[block[table[members[ranked]]]].ravel().tolist()
    rules = {int(place[b]): marks[members[b]] for b in ranked if marks[members[b]]}
    return Dfa(n, class_of, flat, min(rules, default=len(flat)), rules)
