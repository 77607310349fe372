"""Spelling variants against comparing every pair of words by its definition."""

from __future__ import annotations

import random
import zlib

import pytest

from sparkprep.llm import queries_search, spelling
from sparkprep.llm.spelling import near_words, spelling_variants


def one_edit(a: str, b: str) -> bool:
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    long, short = (a, b) if len(a) > len(b) else (b, a)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute(counts: dict[str, int], ratio: int = 5) -> dict[str, tuple]:
    forms, out = {}, {}
    for w, n in counts.items():
        near = [o for o in counts if one_edit(w, o)]
        best = min(near, key=lambda o: (-counts[o], o), default=None)
        form = best if best is not None and counts[best] >= ratio * n else None
        forms[w] = form
        out[w] = (n, len(near), form, counts[form] if form is not None else None)
    for w in counts:
        root = w
        while forms[root] is not None:
            root = forms[root]
        out[w] += (root,)
    return out


def run(spark, counts, **options):
    rows = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    found = spelling_variants(rows, **options).collect()
    assert len(found) == len(counts)
    return {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in found}


@pytest.mark.parametrize("tile", [256, 5])
def test_random_words(spark, tile):
    rng = random.Random(tile)
    counts = {}
    for _ in range(900):
        n = rng.choice([1, 2, 3, 6, 7, 8, 12, 30])
        counts["".join(rng.choice("abé\U0001f600" if n < 9 else "ab") for _ in range(n))] = rng.choice([1, 5, 25, 125, 126])
    base = "long" * 20
    for i in range(40):
        counts[base[:i] + "x" + base[i + 1 :]] = 7
        counts[base[:i] + base[i + 1 :]] = 3
    counts[base] = 1000
    assert run(spark, counts, tile=tile) == brute(counts)


def test_one_hot_bucket_in_tiles(spark):
    """Words that differ in one place only are one bucket, cut into many pairs of tiles."""
    counts = {f"prefix{chr(0x4E00 + i)}suffix": i + 1 for i in range(700)}
    got = run(spark, counts, tile=64)
    assert all(v[1] == 699 for v in got.values())
    assert got == brute(counts)


def test_odd_rows(spark):
    rows = [(None, 3), ("", 2), ("a", 20), ("a", 5), ("b", 1), ("x" * 50_000, 1), ("x" * 50_001, 9), ("ab", 1)]
    found = spelling_variants(spark.createDataFrame(rows, "word string, n bigint")).collect()
    got = {r["word"][:3] + str(len(r["word"])): (r["n"], r["n_near"], (r["form"] or "")[:1], r["root"][:1]) for r in found}
    assert got == {
        "0": (2, 2, "a", "a"), "a1": (25, 3, "", "a"), "b1": (1, 3, "a", "a"), "ab2": (1, 2, "a", "a"),
        "xxx50000": (1, 1, "x", "x"), "xxx50001": (9, 1, "", "x"),
    }
    empty = spark.createDataFrame([], "word string, n bigint")
    assert spelling_variants(empty).count() == 0 and near_words(empty).count() == 0
    with pytest.raises(ValueError):
        spelling_variants(empty, ratio=1)


def test_runs_of_the_block_stream(spark, monkeypatch):
    """Blocks cut at any row give the same result."""
    table = spelling.tiles(spark.createDataFrame(
        [("".join(p), i % 9 + 1) for i, p in enumerate(__import__("itertools").product("abc", repeat=5))],
        "word string, n bigint",
    ), 16).sort("short", "bucket", "longer", "segment", "lo", "hi").toArrow()

    def totals(cells, rows):
        monkeypatch.setattr(spelling, "BLOCK_CELLS", cells)
        out = {}
        for batch in spelling._blocks(table.to_batches(max_chunksize=rows)):
            for r in batch.to_pylist():
                n, best = out.get(r["word"], (0, (0, "")))
                out[r["word"]] = (n + r["n_near"], min(best, (-r["best_n"], r["best"])))
        return out

    whole = totals(1 << 30, 1 << 30)
    assert len(whole) == 243 and all(n == 10 for n, _ in whole.values())
    assert totals(300, 7) == whole and totals(2_000, 1) == whole


def test_query_against_brute_force(spark, tmp_path):
    rng = random.Random(3)
    pool = ["planet", "planets", "Planet", "señora", "stone", "bridges", "bridged", "x÷yzabc", "ABCDEF"]
    rows = [(i if i % 11 else None, " ".join(rng.choice(pool) for _ in range(rng.randrange(60)))) for i in range(400)]
    rows += [(7, None), (8, ""), (9, "1234 -- !!")]
    folder = tmp_path / "documents.parquet"
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(str(folder))
    counts: dict[str, int] = {}
    letters = {chr(c) for c in [*range(65, 91), *range(97, 123), *range(0xC0, 0x100)]}
    for doc_id, text in rows:
        for run_ in "".join(c if c in letters else " " for c in text or "").split():
            word = "".join(c.lower() if c.isascii() else c for c in run_)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % 199 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            if len(word) >= 6:
                counts[word] = counts.get(word, 0) + 1
    counts = {w: n for w, n in counts.items() if n >= 5}
    got = {r["word"]: tuple(r)[1:] for r in queries_search.op13(spark, str(tmp_path)).collect()}
    want = {w: (n, near, form, form_n, root) for w, (n, near, form, form_n, root) in brute(counts).items()}
    assert {w: (v[0], v[1], v[2], v[3], v[4]) for w, v in got.items()} == want


def test_nothing_is_broadcast(spark, monkeypatch):
    """Spark does not see how many rows a word's buckets make, so no size may decide on a broadcast."""
    plans = []

    def seen(write):
        def put(df, *args):
            plans.append(df._jdf.queryExecution().executedPlan().toString())
            return write(df, *args)

        return put

    for name in ("stored", "written"):
        monkeypatch.setattr(spelling, name, seen(getattr(spelling, name)))
    words = spark.createDataFrame([("abcdef", 50), ("abcdeg", 9), ("abcdfg", 1), ("xyz", 2)], "word string, n bigint")
    found = spelling_variants(words)
    assert {r["word"]: r["root"] for r in found.collect()} == {"abcdef": "abcdef", "abcdeg": "abcdef", "abcdfg": "abcdef", "xyz": "xyz"}
    plans.append(found._jdf.queryExecution().executedPlan().toString())
    assert sum("SortMergeJoin" in p for p in plans) >= 3 and not any("Broadcast" in p for p in plans)
