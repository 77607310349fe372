"""BPE encoding and decoding against the tokenizers library."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sparkprep.llm import bpe, lexicon
from sparkprep.llm.bpe import Encoder, Merges, decode, encode, frequent_words
from sparkprep.llm.queries import op7

SF = "/root/testdata/sf0.01"
PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    return Encoder(Merges(PATH), None)


def ids_of(encoder, texts):
    offsets, ids = encoder.encode(texts)
    return [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])]


CASES = [
    "", " ", "Hello WORLD's it's 'll don't 'S", "ΑΣ Σς ΟΔΟΣ", "İstanbul ﬁ Å", "é ́x", "a1b22c٣", "x" * 5000,
    "abc" * 3000, "<|endoftext|>", "a<|endoftext|>b <|startoftext|><|endoftext|> <|END|> <|endoftext|", "\x1c\x1da b\x85c d　e",
    "日本語テキスト と 中文", "🙂🙂👍🏽!?...", "\x00\x01 \x7f", "a\tb\nc\r\nd\x0be\x0cf", "$$$*** &&& ### %%%", "'s's't'", "ǅ ǆ ß ẞ",
    "\U0001e030 \U00011de0 ՘ ࢏ ꟏", "﻿bom ​ zero", "ａｂｃ １２", "1234567890",
]


def test_cases(library, encoder):
    for text, ids in zip(CASES, ids_of(encoder, CASES)):
        assert ids == library.encode(text, add_special_tokens=False).ids, text


def test_random_texts(library, encoder):
    rng = random.Random(3)
    letters = "aAbeEtThHnN sS'dDéÉßΣςİ́̊ 12٣½\t\n.,;!?-_<|>日本🙂‍\xa0\x85" + "the in an re " * 2
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(4000)]
    for text, ids in zip(texts, ids_of(encoder, texts)):
        assert ids == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_both_ways_of_merging_agree():
    merges = Merges(PATH)
    rng = random.Random(5)
    for _ in range(2000):
        piece = [rng.choice(merges.plain[97:123]) for _ in range(rng.randrange(1, 60))]
        assert merges._by_scan(list(piece)) == merges._by_heap(list(piece))


def test_lexicon_finds_its_words_and_no_others(tmp_path):
    rng = random.Random(1)
    words = sorted({bytes(rng.choice(b"abcd") for _ in range(rng.randrange(1, 8))) for _ in range(800)})
    known, unknown = words[::2], words[1::2]
    lexicon.build(known, [[i, i + 1] for i in range(len(known))], str(tmp_path / "words"))
    lex = lexicon.Lexicon(str(tmp_path / "words"))
    assert lex.ranks(known).tolist() == list(range(len(known)))
    assert set(lex.ranks([*unknown, b"", b"zzz", b"a" * 50]).tolist()) == {-1}
    assert lex.ids[lex.starts[7] : lex.starts[8]].tolist() == [7, 8]
    # Tails are shared: far fewer states than the letters of all words.
    assert len(lex.finals) < sum(map(len, known)) / 2


def test_empty_lexicon(tmp_path):
    lexicon.build([], [], str(tmp_path / "words"))
    assert lexicon.Lexicon(str(tmp_path / "words")).ranks([b"a"]).tolist() == [-1]


def test_query_equals_library(spark, library):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    want = {}
    for r in rows:
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), text)]
        want[r["doc_id"]] = (len(ids), *sha)
    got = {r["doc_id"]: tuple(r)[1:] for r in op7(spark, SF).collect()}
    assert got == want


def test_frequent_words_fit_the_bound(spark):
    df = spark.createDataFrame([("a " * 9 + "b " * 7 + "c c d d e",)], "text string")
    assert [sorted(frequent_words(df, "text", n)) for n in (0, 1, 3, 4)] == [[], ["a"], ["a", "b"], ["a", "b", "c", "d"]]


def test_words_of_all_texts_are_counted(spark, monkeypatch):
    """Every word is in two of 30,000 texts: one that is not read would lose it."""
    letters = F.translate(F.expr("id div 2").cast("string"), "0123456789", "abcdefghij")
    df = spark.range(30_000).select(F.concat(F.lit("The "), letters, F.lit(", the")).alias("text"))
    want = {"the", ","} | {"".join(chr(97 + int(c)) for c in str(i)) for i in range(15_000)}
    assert set(frequent_words(df, "text", 20_000)) == want
    monkeypatch.setattr(bpe, "COUNTED_WORDS", 3)
    texts = ["Éa éa", "don't x,x", "a1 b c d", "a b c d\x85e", "", None]
    rows = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])
    got = Counter()
    for part in bpe._count(iter([rows, rows])):
        got.update(dict(zip(*(c.to_pylist() for c in part.columns))))
    once = [p for t in texts if t for w in t.split() for p in bpe.plain_pieces(w)]
    assert got == Counter(once + once)


def test_odd_tables(spark, library):
    rows = [(None, None, 5), (1, "", 6), (1, "the the", 7), (1, "the the", 7), (2, "ab " * 200_000, 8)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids int")
    out = encode(df, PATH, lexicon_words=1)
    assert out.columns == ["doc_id", "ids"]
    got = sorted(((r["doc_id"], len(r["ids"])) for r in out.collect()), key=repr)
    assert got == sorted([(None, 0), (1, 0), (1, 2), (1, 2), (2, 200_000)], key=repr)
    text = {r["decoded"] for r in decode(out.where("doc_id = 1"), PATH).collect()}
    assert text == {"", "the</w> the</w>"}
    assert encode(df.limit(0), PATH).count() == 0
