"""SimHash: fingerprints bit by bit, links by comparing all pairs."""

from __future__ import annotations

import random
import re

import pytest
import xxhash

from sparkprep.llm.simhash import fingerprint, hex_fingerprint, links, near_duplicates
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"


def brute_fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall("[^\x20\x09-\x0d]+", text)
    if not words:
        return 0
    grams = [words[i : i + 3] for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(" ".join(g).encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """Smallest id reachable over pairs within two bits, by comparing every pair."""
    ids, fps = [p[0] for p in prints], [p[1] for p in prints]
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 2:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least = {}
    for i, x in enumerate(ids):
        if x is not None:
            least[find(i)] = min(x, least.get(find(i), x))
    return sorted(((x, least.get(find(i))) for i, x in enumerate(ids)), key=repr)


def test_fingerprint_of_odd_texts():
    for text in (None, "", " \t\n", "One", "One two", "a b c", "É A b c d", "x " * 20_000):
        assert fingerprint(text) == brute_fingerprint(text)


@pytest.mark.parametrize("wide", [2, 32])
def test_documents_against_all_pairs(spark, wide):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs = docs.select("doc_id", "text", F.lit(1).alias("fp"), F.lit(2).alias("component_id"))
    out = near_duplicates(docs, wide_key=wide).withColumn("hex", hex_fingerprint(F.col("fp"))).collect()
    prints = [(r["doc_id"], brute_fingerprint(r["text"])) for r in docs.collect()]
    assert sorted((r["doc_id"], r["hex"]) for r in out) == sorted((i, f"{p:016x}") for i, p in prints)
    got = sorted(((r["doc_id"], r["component_id"]) for r in out), key=repr)
    assert got == brute_components(prints)


@pytest.mark.parametrize("wide", [1, 8, 10_000])
def test_links_of_dense_fingerprints(spark, wide):
    """A ball of fingerprints close together, on both sides of the switch between the two ways."""
    base = 0x0123456789ABCDEF
    fps = {base}
    for i in range(0, 64, 3):
        fps |= {base ^ 1 << i, base ^ 1 << i ^ 1 << (i + 5) % 64, base ^ 7 << i % 61}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp bigint")
    pairs = links(df, wide).collect()
    root = {f: f for f in signed}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for r in pairs:
        assert bin((r["a"] ^ r["b"]) & (1 << 64) - 1).count("1") <= 2
        root[find(r["a"])] = find(r["b"])
    got = {frozenset(g for g in signed if find(g) == find(f)) for f in signed}
    want = brute_components(list(zip(signed, signed)))
    groups = {}
    for f, c in want:
        groups.setdefault(c, set()).add(f)
    assert got == {frozenset(g) for g in groups.values()}


def test_nulls_ties_and_no_rows(spark):
    rows = [(3, None), (1, ""), (2, " \n"), (None, "a b c d"), (7, "a b c d"), (7, "a b c d"), (None, "q r s")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted(((r["doc_id"], r["component_id"]) for r in near_duplicates(df).collect()), key=repr)
    assert got == sorted([(3, 1), (1, 1), (2, 1), (None, 7), (7, 7), (7, 7), (None, None)], key=repr)
    assert near_duplicates(df.limit(0)).count() == 0


def test_chains_of_edits_with_the_smallest_id_anywhere(spark):
    """Fingerprints that differ by a bit or two; the smallest id may be with any of them."""
    rng = random.Random(1)
    rows = []
    for _ in range(6):
        words = [f"w{rng.randrange(5000)}" for _ in range(300)]
        for _ in range(30):
            words[rng.randrange(300)] = f"x{rng.randrange(99999)}"
            rows.append((rng.randrange(10**6) - 500_000, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    prints = [(i, brute_fingerprint(t)) for i, t in rows]
    want = brute_components(prints)
    assert len({c for _, c in want}) < len({p for _, p in prints})
    for wide in (2, 32):
        out = near_duplicates(df, wide_key=wide).collect()
        assert sorted(((r["doc_id"], r["component_id"]) for r in out), key=repr) == want
