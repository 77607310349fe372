"""Secret scans against Python's own regular expressions."""

from __future__ import annotations

import hashlib
import random
import re

from sparkprep.llm.automaton import compile_rules
from sparkprep.llm.secrets import BASE, EXTRA, digest_columns, find_secrets, scan

SF = "/root/testdata/sf0.01"
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)


def brute(text):
    """The kinds as the contract words them, one regular expression after another."""
    text = text or ""
    found = [("assign", m) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [("access", m) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [("hex", m) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    for rule in EXTRA:
        found += [(rule.kind, m) for m in re.finditer(rule.pattern, text)
                  if len(m[0]) >= rule.min_length]
    order = {r.kind: i for i, r in enumerate(BASE + EXTRA)}
    spans = [(kind, m.start(), m.end()) for kind, m in found]
    return sorted(spans, key=lambda s: (s[1], order[s[0]]))


CASES = [
    None, "", "é" * 40 + " token=abcdefghijklmnop",
    "secret=passwd: abcdefghijklmnop", "token=token=abcdefghijklmnop", "token==abcdefghijklm",
    "TOKEN '  :   \"abcdefghijkl", "Api_Key'=x", "apikey=\"" + "a" * 12 + "\"", "api__key=abcdefghijklmn",
    "AKIA" + "A" * 14, "AKIAKIA" + "B" * 13, "xAKIA" + "Z" * 20 + "é", "AKIA",
    "0123456789abcdef0", "0123456789abcde", "g0123456789abcdefg", "token=" + "0123456789abcdef" * 3,
    "passwordpassword = abcdefghijkl", "secretoken:abcdefghijklmn", "token: \n abcdefghijklmnop",
    "-----BEGIN RSA PRIVATE KEY-----", "-----BEGIN PRIVATE KEY-----x", "ghp_" + "a" * 40, "ghp_" + "a" * 35,
    "xoxb-" + "1" * 12, "sk_live_" + "Z" * 16,
    "password=a" * 50, "ÀKIA secretſ=abcdefghijklmn toKen=abcdefghijklmn",
]


def test_cases():
    for text in CASES:
        assert find_secrets(text) == brute(text), text


def test_random_texts():
    rng = random.Random(7)
    parts = ["token", "secret", "passwd", "api_", "key", "AKIA", "=", ":", " ", "'", '"', "abc", "0f", "Z9",
             "é", "\n", "x" * 12, "eyJ", ".", "ghp_", "-", "_", "deadbeef" * 2, "BEGIN", "TOKEN", "AK"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(40)))
        assert find_secrets(text) == brute(text), text


def test_automaton_is_minimal_and_shared():
    one = compile_rules([("(a|b)*abb", False)], search=False)
    assert len(one.next) // one.classes == 5  # four states and the dead end
    assert compile_rules([("ab|ab", False)]).next == compile_rules([("ab", False)]).next


def test_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = digest_columns(scan(docs)).collect()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert len(out) == len(texts)
    for r in out:
        spans = brute(texts[r["doc_id"]])
        base = [s for s in spans if s[0] in ("assign", "access", "hex")]
        joined = ",".join(":".join(map(str, s)) for s in base)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert r["spans"] == ",".join(":".join(map(str, s)) for s in spans)
        for kind in ("assign", "access", "hex"):
            assert r[f"n_{kind}"] == sum(s[0] == kind for s in base)


def test_odd_tables(spark):
    rows = [(None, None, 1), (1, "", 2), (1, "token=abcdefghijkl", 3), (1, "token=abcdefghijkl", 3), (2, "a" * 300_000, 4)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, spans int")
    out = [(r["doc_id"], r["spans"]) for r in digest_columns(scan(df)).collect()]
    want = [(None, ""), (1, ""), (1, "assign:0:18"), (1, "assign:0:18"), (2, "hex:0:300000")]
    assert sorted(out, key=repr) == sorted(want, key=repr)
    assert scan(df.limit(0)).count() == 0
