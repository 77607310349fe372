"""Secret scans with one combined deterministic automaton.

The patterns of all rules are compiled into one minimal automaton (``automaton``),
which reads a text's bytes once. It reports for every rule where a match ends. A
match's start is found by the rule's reversed automaton, from its end back to the end of
the match before; the earliest start wins. That is the leftmost, longest,
non-overlapping match, since in no rule a match inside another one ends before it.
Matches that are too short are dropped afterwards: they still use up their text. Only the
length of a hex run, which ends where its characters do, is part of its pattern;
elsewhere counting would multiply the states.

Offsets are code points, ends exclusive. Every row is computed alone, in Arrow
batches, with nothing to shuffle. A null text is an empty one. The automaton
is built once, on the driver, and sent along.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sparkprep.llm.automaton import Dfa, compile_rules, reverse_rule


@dataclass(frozen=True)
class Rule:
    """A pattern, and how long a match, or what follows ``key`` in it, must be."""

    kind: str
    pattern: str
    min_length: int = 0
    ignore_case: bool = False
    value_of: str = ""  # pattern of the part before the value, if only the value counts


_ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""

# Base rules first; their order is the order of kinds.
BASE = (
    Rule("assign", _ASSIGN + r"[A-Za-z0-9+/_.=-]+", 12, True, _ASSIGN),
    Rule("access", r"AKIA[A-Z0-9]+", 18),
    Rule("hex", r"[0-9a-f]{16,}"),  # a run is one match, so the pattern may count
)
# Public token formats with a mark of their own.
EXTRA = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 40),
    Rule("pem", r"-----BEGIN ([A-Z0-9]+ )*PRIVATE KEY-----"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 15),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]+", 24),
)
RULES = BASE + EXTRA


class Scanner:
    """All rules compiled."""

    def __init__(self, rules: tuple[Rule, ...] = RULES) -> None:
        self.rules = rules
        self.combined = compile_rules([(r.pattern, r.ignore_case) for r in rules])
        self.back = [reverse_rule(r.pattern, r.ignore_case) for r in rules]
        self.keys = [
            compile_rules([(r.value_of, r.ignore_case)], search=False) if r.value_of else None
            for r in rules
        ]

    def spans(self, data: bytes) -> list[tuple[int, int, int]]:
        """``(rule, start, end)`` in bytes, by rule and start."""
        ends = self._ends(data)
        found = []
        for k, rule in enumerate(self.rules):
            free = 0
            for end in ends[k]:
                start = _earliest(self.back[k], data, end, free)
                if start is None:
                    continue
                free = end
                value = start
                if self.keys[k]:
                    value = _longest(self.keys[k], data, start)
                if end - value >= rule.min_length:
                    found.append((k, start, end))
        return found

    def _ends(self, data: bytes) -> list[list[int]]:
        """Where matches of each rule end and do not go on, ascending."""
        dfa = self.combined
        step, accepting, marks = dfa.next, dfa.first_accepting, dfa.rules
        ends: list[list[int]] = [[] for _ in self.rules]
        state, open_rules = 0, 0
        for at, c in enumerate(data.translate(dfa.class_of)):
            state = step[state + c]
            if state >= accepting or open_rules:
                now = marks.get(state, 0)
                closed = open_rules & ~now
                if closed:
                    for k in range(len(ends)):
                        if closed >> k & 1:
                            ends[k].append(at)
                open_rules = now
        for k in range(len(ends)):
            if open_rules >> k & 1:
                ends[k].append(len(data))
        return ends


def _earliest(dfa: Dfa, data: bytes, end: int, floor: int) -> int | None:
    """The smallest start, not below ``floor``, of a match that ends at ``end``."""
    state, start = 0, None
    dead = None
    for at in range(end - 1, floor - 1, -1):
        before = state
        state = dfa.next[state + dfa.class_of[data[at]]]
        if state >= dfa.first_accepting:
            start = at
        elif state == before and state != 0:
            # A state that every byte leads back to can only be the dead end.
            if dead is None:
                dead = all(
                    t == state for t in dfa.next[state : state + dfa.classes]
                )
            if dead:
                break
            dead = None
    return start


def _longest(dfa: Dfa, data: bytes, start: int) -> int:
    """The end of the longest match that begins at ``start``."""
    state, end = 0, start
    for at in range(start, len(data)):
        state = dfa.next[state + dfa.class_of[data[at]]]
        if state >= dfa.first_accepting:
            end = at + 1
        elif all(t == state for t in dfa.next[state : state + dfa.classes]):
            break
    return end


@functools.cache
def _scanner() -> Scanner:
    return Scanner()


def find_secrets(text: str | None, scanner: Scanner | None = None) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` in code points, by start and then by the order of kinds."""
    data = (text or "").encode("utf-8", "surrogatepass")
    scanner = scanner or _scanner()
    found = scanner.spans(data)
    if not found:
        return []
    points = sorted({p for _, start, end in found for p in (start, end)})
    place, count, last = {}, 0, 0
    for p in points:
        count += len(data[last:p].decode("utf-8", "surrogatepass"))
        place[p] = count
        last = p
    return [
        (scanner.rules[k].kind, place[start], place[end])
        for k, start, end in sorted(found, key=lambda f: (f[1], f[0]))
    ]


_SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"
_SPAN_TYPE = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
)


def _scan(scanner, batches):
    for batch in batches:
        spans = [
            [{"kind": k, "start": a, "end": b} for k, a, b in find_secrets(t, scanner)]
            for t in batch.column(1).to_pylist()
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(spans, _SPAN_TYPE)], ["doc_id", "spans"]
        )


def scan(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, spans``: one row per row of ``df``, spans in order of their start."""
    rows = df.select(F.col(doc_id).cast("bigint").alias("doc_id"), text)
    return rows.mapInArrow(functools.partial(_scan, _scanner()), f"doc_id bigint, spans {_SPANS}")


def digest_columns(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, a digest of the base spans, and all spans as text."""

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    def joined(spans):
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
        )

    base = F.filter("spans", lambda s: s["kind"].isin([r.kind for r in BASE]))
    return found.select(
        "doc_id",
        *[count(r.kind) for r in BASE],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
