"""The positional index against comparing every window with every place of every document."""

from __future__ import annotations

import random
import re

import pyarrow as pa
import pytest

from sparkprep.llm import postings
from sparkprep.llm.postings import decontaminate

DOCS = "doc_id bigint, text string, item_id string, segment string"
ITEMS = "item_id bigint, text string, term string"


def words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute(docs, items, width=10, slop=2):
    out = []
    for doc in docs:
        ws = words(doc[1])
        hits, found, near = set(), set(), set()
        for item in items:
            iw = words(item[1])
            for s in range(max(len(iw) - width, 0) + 1) if iw else ():
                win = iw[s : s + width]
                for at in range(len(ws) - len(win) + 1):
                    if ws[at : at + len(win)] == win:
                        hits.update(range(at, at + len(win)))
                        if item[0] is not None:
                            found.add(str(item[0]))
                for at in range(-slop, len(ws) + slop):
                    if all(w in ws[max(at + k - slop, 0) : max(at + k + slop + 1, 0)] for k, w in enumerate(win)):
                        if item[0] is not None:
                            near.add(str(item[0]))
        out.append((doc[0], len(ws), sorted(hits), sorted(found), sorted(near)))
    return sorted(out, key=repr)


def run(spark, docs, items, **options):
    found = decontaminate(
        spark.createDataFrame([(*d, "x", "y") for d in docs], DOCS),
        spark.createDataFrame([(*i, "z") for i in items], ITEMS),
        **options,
    )
    return sorted(((r["doc_id"], r["n_words"], r["hits"], r["items"], r["near_items"]) for r in found.collect()), key=repr)


@pytest.mark.parametrize("segment_chars,per_task", [(8_000_000, 65_536), (60, 3)])
def test_random_texts(spark, monkeypatch, segment_chars, per_task):
    monkeypatch.setattr(postings, "SEGMENT_CHARS", segment_chars)
    monkeypatch.setattr(postings, "WINDOWS_PER_TASK", per_task)
    rng = random.Random(5)

    def text(n, pool):
        return "".join(rng.choice(pool) + rng.choice([" ", ", ", "\n", "-", "\t "]) for _ in range(n))

    pool = ["A", "b", "c", "ñ", "D2", "é", "z"]
    items = [(i, text(rng.choice([1, 3, 4, 5, 9]), pool)) for i in range(12)] + [(3, text(4, pool))]
    docs = [(i, text(rng.randrange(40), pool)) for i in range(40)]
    docs += [(i, text(3, pool) + (t or "") + text(3, pool)) for i, (_, t) in enumerate(items)]
    assert run(spark, docs, items, width=4) == brute(docs, items, width=4)


def test_ten_word_windows(spark):
    passage = " ".join(f"w{i}" for i in range(25))
    swapped = passage.replace("w7 w8", "w8 w7")
    docs = [(1, passage.upper()), (2, "x y " + " ".join(passage.split()[4:14])), (3, " ".join(passage.split()[4:13])),
            (4, swapped), (5, passage + " . " + passage), (6, "w3 w2 w1")]
    items = [(10, passage), (9, "short one"), (11, "w3")]
    got = {g[0]: g[1:] for g in run(spark, docs, items)}
    assert sorted(got.items()) == [(d, tuple(rest)) for d, *rest in sorted(brute(docs, items))]
    assert got[1][1] == list(range(25)) and got[1][2] == ["10", "11"]
    assert got[2][1] == list(range(2, 12)) and got[3][1] == [] and "10" in got[4][3]


def test_nulls_repeats_and_long_texts(spark):
    long = "filler " * 60_000 + "one two three"
    docs = [(1, "one two three"), (1, "one two three"), (None, "one two three"), (2, None), (3, ""), (4, " \t.,"), (5, long)]
    items = [(7, "One two, three!"), (7, "One two, three!"), (None, "two three"), (8, None), (9, ""), (6, "--")]
    got = run(spark, docs, items)
    for doc in (1, None):
        assert (doc, 3, [0, 1, 2], ["7"], ["7"]) in got
    assert got.count((1, 3, [0, 1, 2], ["7"], ["7"])) == 2
    assert (5, 60_003, [60_000, 60_001, 60_002], ["7"], ["7"]) in got
    assert all((d, 0, [], [], []) in got for d in (2, 3, 4))
    assert run(spark, [], items) == []
    assert run(spark, docs[:1], []) == [(1, 3, [], [], [])]


def test_tokens_of_a_sliced_array():
    texts = pa.array(["skip", None, "É 1_a--B", "", " x "])
    flat, counts = postings.tokens(texts.slice(1))
    assert flat.to_pylist() == ["É", "1", "a", "b", "x"] and counts.tolist() == [0, 4, 0, 1]
