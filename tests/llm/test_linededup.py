"""Line dedup against spelling out every window, and small texts by hand."""

from __future__ import annotations

import random
import re

from sparkprep.llm.linededup import dedup_lines

SPACE = " \t\n\x0b\x0c\r"


def brute(docs, min_words):
    """Lines in a run of enough words that occurs earlier; docs are (id, text)."""
    order = sorted({d for d in docs if d[1] is not None}, key=lambda d: (d[0] is None, d[0] or 0, d[1]))
    first, runs = {}, {d: [] for d in order}
    for d in order:
        lines = [
            (i, x.strip(SPACE), len(re.findall("[^\x20\x09-\x0d]+", x))) for i, x in enumerate(d[1].split("\n"))
        ]
        lines = [x for x in lines if x[2]]
        for a in range(len(lines)):
            for b in range(a, len(lines)):
                if sum(x[2] for x in lines[a : b + 1]) >= min_words:
                    content = tuple(x[1] for x in lines[a : b + 1])
                    first.setdefault(content, (d, lines[a][0]))
                    runs[d].append((content, lines[a][0], lines[b][0]))
    out = {}
    for d in order:
        gone = {i for c, a, b in runs[d] if first[c] != (d, a) for i in range(a, b + 1)}
        out[d] = sorted(gone)
    return out


def removed(spark, docs, min_words):
    df = spark.createDataFrame([(*d, "x") for d in docs], "doc_id bigint, text string, version string")
    rows = dedup_lines(df, min_words=min_words).collect()
    assert len(rows) == len(docs)
    return {(r["doc_id"], r["text"], tuple(r["removed_lines"])) for r in rows}


def expected(docs, min_words):
    out = set()
    gone = brute(docs, min_words)
    for d in docs:
        lines = gone.get(d, [])
        text = d[1]
        if lines:
            text = "\n".join(x for i, x in enumerate(d[1].split("\n")) if i not in lines)
        out.add((d[0], text, tuple(lines)))
    return out


def test_random_documents(spark):
    rng = random.Random(11)
    pool = ["a", "b b", "c c c", "", "  ", " d d\t", "e e e e e e", "f\r", "a a"]
    docs = []
    for i in range(60):
        lines = [rng.choice(pool) for _ in range(rng.randrange(9))]
        docs.append((i, "\n".join(lines)))
    for min_words in (1, 4, 7):
        # Versions of one id are told apart by a hash, so ids differ here.
        assert removed(spark, docs, min_words) == expected(docs, min_words)


def test_nulls_repeated_rows_and_long_texts(spark):
    run = "one two three\nfour five six"
    docs = [(5, run), (None, run), (1, None), (2, ""), (5, run), (9, "x\n" * 3000 + run), (None, "short")]
    got = removed(spark, docs, 5)
    assert (5, run, ()) in got  # both rows of document 5 are the first place
    assert (None, "", (0, 1)) in got
    assert (1, None, ()) in got and (2, "", ()) in got and (None, "short", ()) in got
    long = next(g for g in got if g[0] == 9)
    # An earlier place may overlap: the run of five lines at line 1 is that of line 0 again.
    assert long[2] == tuple(range(1, 3002)) and long[1] == "x"


def test_empty_lines_between_long_lines(spark):
    """Paragraphs with an empty line between them go with it if they were neighbours before."""
    a, b = "a1 a2 a3 a4 a5", "b1 b2 b3 b4 b5"
    docs = [(1, f"{a}\n{b}"), (2, f"x\n{a}\n\n \n{b}\ny"), (3, f"{b}\n\n{a}")]
    got = removed(spark, docs, 5)
    assert (2, "x\ny", (1, 2, 3, 4)) in got
    assert (3, "", (0, 2)) in got  # never neighbours in this order: the empty line stays
    assert got == expected(docs, 5)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert dedup_lines(df).count() == 0
