"""Learned vocabularies and encodings against the public `tokenizers` library."""

from __future__ import annotations

import json
import random

import brute
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer, decoders, models, pre_tokenizers, processors, trainers

from sparkprep.functions.text import pre_tokenize, words
from sparkprep.operators import bpe, tokenize as tk, vocab as vo
from sparkprep.operators.chunk import ChunkConfig, chunk_dataset

ODD_TEXTS = [
    "",
    " ",
    "\nabc",
    "  two  spaces   here ",
    "it's they'll  I'd\tTab\r\n\r\n  x",
    "naïve café — 東京 ١٢٣ ½ ²",
    "aaaa aaa aa a aaaaaaaa",
    "x y　z\u0085w​v",
    "😀😀 é no_under_score",
    "[CLS] text [SEP]",
]


@pytest.fixture(scope="module")
def texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    odd = spark.createDataFrame([(1_000_000 + i, t) for i, t in enumerate(ODD_TEXTS)], "doc_id long, text string")
    return docs.select("doc_id", "text").unionByName(odd).repartition(4, "doc_id").persist()


@pytest.fixture(scope="module")
def lines(texts):
    return [r.text for r in texts.orderBy("doc_id").collect()]


def library(lines, size, longest):
    t = Tokenizer(models.BPE())
    t.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=True)
    t.decoder = decoders.ByteLevel()
    trainer = trainers.BpeTrainer(
        vocab_size=size,
        special_tokens=list(vo.SPECIAL_TOKENS),
        max_token_length=longest,
        show_progress=False,
    )
    t.train_from_iterator(lines, trainer=trainer)
    return t


@pytest.fixture(scope="module")
def learned(spark, texts):
    return bpe.train_bpe(bpe.piece_counts(texts).persist(), vocab_size=270)


def test_pieces(spark, texts, lines):
    split = pre_tokenizers.ByteLevel(add_prefix_space=True)
    got = [
        ["".join(bpe.BYTE_CHARS[b] for b in p.encode()) for p in r.p]
        for r in texts.select("doc_id", pre_tokenize("text").alias("p")).orderBy("doc_id").collect()
    ]
    assert got == [[p for p, _ in split.pre_tokenize_str(t)] for t in lines]


def test_training_equals_library(learned, lines):
    model = json.loads(library(lines, 270, 64).to_str())["model"]
    assert {t: i for i, t in enumerate(learned.tokens)} == model["vocab"]
    merges = [[learned.tokens[a], learned.tokens[b]] for a, b, _, _ in learned.merges]
    assert merges == model["merges"]
    assert learned.rounds < len(merges)


def test_token_length_limit_equals_library(texts, lines):
    model = json.loads(library(lines, 250, 4).to_str())["model"]
    short = bpe.train_bpe(bpe.piece_counts(texts), vocab_size=250, max_token_length=4)
    assert {t: i for i, t in enumerate(short.tokens)} == model["vocab"]
    # The library never lets a merge of merged tokens reach the limit.
    assert max(len(t) for t in short.tokens[5:]) == 3


def test_ties_and_repeats_equal_library(spark):
    corpus = ["abab baba aabb bbaa", "aaa aaaa aaaaa b", "ab ba ab ba cdcd dcdc", "zz zzz zzzz"]
    df = spark.createDataFrame([(t,) for t in corpus], "text string")
    model = json.loads(library(corpus, 60, 64).to_str())["model"]
    mine = bpe.train_bpe(bpe.piece_counts(df), vocab_size=60, candidates=4)
    assert {t: i for i, t in enumerate(mine.tokens)} == model["vocab"]
    assert [[mine.tokens[a], mine.tokens[b]] for a, b, _, _ in mine.merges] == model["merges"]


@pytest.mark.parametrize("pool,pending", [(1, 1), (3, 2), (20, 4)])
def test_small_pools_learn_the_same(spark, learned, texts, pool, pending):
    """However few pairs the driver keeps, and however often pieces are written anew."""
    counts = bpe.piece_counts(texts.where("doc_id < 30 or doc_id >= 1000000")).persist()
    plain = bpe.train_bpe(counts, vocab_size=150)
    tight = bpe.train_bpe(counts, vocab_size=150, pool_pairs=pool, pending_merges=pending)
    assert (tight.tokens, tight.merges) == (plain.tokens, plain.merges)


def test_rare_pieces_do_not_widen_the_rounds(spark, monkeypatch):
    """Three thousand pieces of rare byte pairs: rounds see their common parts only, merges stay the same."""
    rng = random.Random(1)
    rare = [" " + "".join(rng.choice("0123456789abcdef") for _ in range(12)) for _ in range(3000)]
    rows = [(p, 1) for p in rare] + [(f" {a}{b}", 5000) for a in ("the", "then", "other") for b in ("", "re", "in")]
    counts = spark.createDataFrame(rows, "piece string, n bigint").persist()
    sizes, change = [], bpe._changes

    def sized(symbols, floor):
        sizes.append(symbols.count())
        return change(symbols, floor)

    monkeypatch.setattr(bpe, "_changes", sized)
    cut = bpe.train_bpe(counts, vocab_size=5 + 256 + 8, alphabet="all")
    assert max(sizes) < 100
    monkeypatch.setattr(bpe, "WHOLE_PAIRS", 1 << 16)  # nothing is cut
    whole = bpe.train_bpe(counts, vocab_size=5 + 256 + 8, alphabet="all")
    assert (cut.tokens, cut.merges) == (whole.tokens, whole.merges) and max(sizes) >= 9


@pytest.mark.parametrize("share,size", [(1, 60), (0.1, 60), (0.02, 200)])
def test_cuts_that_were_too_deep_are_taken_back(texts, monkeypatch, share, size):
    """However many pairs of bytes are cut at first."""
    counts = bpe.piece_counts(texts.where("doc_id < 30 or doc_id >= 1000000")).persist()
    plain = bpe.train_bpe(counts, vocab_size=size + 105)
    monkeypatch.setattr(bpe, "WHOLE_PAIRS", share)
    deep = bpe.train_bpe(counts, vocab_size=size + 105)
    assert (deep.tokens, deep.merges) == (plain.tokens, plain.merges)


def test_pool_keeps_what_it_must():
    pool = bpe.PairPool({"ab": 9, "bc": 5, "cd": 4}, 3, 2)
    assert pool.best(2) == ([("ab", 9), ("bc", 5)], 4)
    pool.change([("ab", -9), ("bc", -1), ("xy", 7), ("yz", 3), ("qq", -2)])
    assert pool.best(5) == ([("xy", 7), ("bc", 4), ("cd", 4)], 3)
    pool.change([("x1", 6), ("x2", 5)])  # more than twice its size: cut, and the floor rises
    assert pool.counts == {"xy": 7, "x1": 6} and pool.floor == 5
    assert pool.best(9) == ([("xy", 7), ("x1", 6)], 5)


def test_loose_training(spark, texts, learned):
    """Fewer rounds, as many tokens, mostly the same ones, and texts come back whole."""
    counts = bpe.piece_counts(texts).persist()
    loose = bpe.train_bpe(counts, vocab_size=270, exact=False)
    assert len(loose.tokens) == 270 and loose.rounds < learned.rounds
    assert len(set(loose.tokens) & set(learned.tokens)) > 0.9 * 270
    again = bpe.train_bpe(counts, vocab_size=270, exact=False)
    assert (again.tokens, again.merges) == (loose.tokens, loose.merges)
    codec = bpe.codec_of(loose)
    assert bpe.round_trip(texts, codec).where("not same").count() == 0


def test_encode_and_decode_equal_library(texts, lines, learned):
    t = library(lines, 270, 64)
    codec = bpe.codec_of(learned)
    got = texts.select("doc_id", bpe.encode("text", codec).alias("ids"))
    rows = got.withColumn("back", bpe.decode("ids", codec)).orderBy("doc_id").collect()
    # Special tokens in a text are found only when they are declared as added.
    plain = [(r, s) for r, s in zip(rows, lines) if "[" not in s]
    want = t.encode_batch([s for _, s in plain])
    assert [list(r.ids) for r, _ in plain] == [w.ids for w in want]
    decoded = [t.decode(w.ids, skip_special_tokens=False) for w in want]
    assert [r.back for r, _ in plain] == decoded


def test_short_pieces_merge_like_long_ones(learned):
    """Without a heap: the same ids, also where merges overlap or two of them spell one token."""
    rng = random.Random(2)
    twice = bpe.BpeCodec(list("abc") + ["ab", "abc", "bc", "aa"], [(0, 0, 6), (0, 1, 3), (3, 2, 4), (1, 2, 5), (0, 5, 4), (4, 0, 3)])
    for codec, letters in ((bpe.codec_of(learned), " etaoin<>é"), (twice, "abc")):
        for _ in range(3000):
            text = "".join(rng.choice(letters) for _ in range(rng.randrange(1, 24)))
            ids = [i for i in map(codec.byte_id.__getitem__, text.encode()) if i >= 0]
            assert codec._merge_short(list(ids)) == codec._merge_long(list(ids)), text


def test_added_tokens_equal_library(spark, lines, learned):
    t = library(lines, 270, 64)
    runs = [" " * n for n in range(2, 25)]
    t.add_tokens(runs)
    codec = bpe.BpeCodec(
        [*learned.tokens, *runs], [m[:3] for m in learned.merges], [*vo.SPECIAL_TOKENS, *runs]
    )
    cases = [*ODD_TEXTS, "a" + " " * 30 + "b", "[MASK][PAD]  [UNK] [unk]", "end  "]
    df = spark.createDataFrame(list(enumerate(cases)), "i int, text string").repartition(3, "i")
    rows = df.select("i", bpe.encode("text", codec).alias("ids")).orderBy("i").collect()
    assert [list(r.ids) for r in rows] == [t.encode(c).ids for c in cases]


def test_encode_keeps_nulls(spark, learned):
    df = spark.createDataFrame([(1, None), (2, "a b"), (3, "")], "i int, text string").coalesce(1)
    codec = bpe.codec_of(learned)
    rows = df.select("i", bpe.encode("text", codec).alias("ids")).orderBy("i").collect()
    assert rows[0].ids is None and rows[2].ids == []
    assert list(rows[1].ids) == codec.piece(" a") + codec.piece(" b")


def test_long_pieces_equal_library(spark, lines, learned):
    t = library(lines, 270, 64)
    codec = bpe.codec_of(learned)
    long = ["then" * 40, "e" * 333, "the" + "-" * 90, "in" * 16, "erth" * 8 + "e", " " * 200 + "x"]
    df = spark.createDataFrame(list(enumerate(long)), "i int, text string").coalesce(2)
    rows = df.select("i", bpe.encode("text", codec).alias("ids")).orderBy("i").collect()
    assert [list(r.ids) for r in rows] == [t.encode(x).ids for x in long]


def test_all_bytes_round_trip(spark, texts):
    counts = bpe.piece_counts(texts.where("doc_id < 50"))
    codec = bpe.codec_of(bpe.train_bpe(counts, vocab_size=270, alphabet="all"))
    assert bpe.round_trip(texts, codec).where(~F.col("same")).count() == 0


def test_template_equals_library(texts, lines, learned):
    t = library(lines, 270, 64)
    t.post_processor = processors.TemplateProcessing(
        single="[CLS]:0 $A:0 [SEP]:0", special_tokens=[("[CLS]", 0), ("[SEP]", 3)]
    )
    rows = tk.tokenize_bpe(
        texts.where("doc_id < 1000000"), bpe.codec_of(learned), template=(0, 3)
    ).orderBy("doc_id").collect()
    want = t.encode_batch(lines[: len(rows)])
    assert [list(r.input_ids) for r in rows] == [w.ids for w in want]
    assert [r.len for r in rows] == [len(w.ids) for w in want]


def library_factory(saved: str):
    """A user tokenizer around the library, built on the worker."""

    class LibraryTokenizer:
        def __init__(self) -> None:
            self.inner = Tokenizer.from_str(saved)

        def tokenize_batch(self, batch):
            return [e.ids for e in self.inner.encode_batch(batch)]

    return LibraryTokenizer


def test_pluggable_tokenizer_equals_own_encoding(texts, lines, learned):
    saved = library(lines, 270, 64).to_str()
    df = texts.where("doc_id < 1000000")
    theirs = tk.tokenize_with(df, library_factory(saved))
    mine = tk.tokenize_bpe(df, bpe.codec_of(learned), normalize=False)
    both = theirs.select("doc_id", "input_ids").exceptAll(mine.select("doc_id", "input_ids"))
    assert both.count() == 0


def test_words_equal_python(spark, texts, lines):
    import re

    def plain(text):
        return [w for w in re.split(r"\s+", text) if w and re.search(r"\w", w)]

    rows = texts.select("doc_id", words("text").alias("w")).orderBy("doc_id").collect()
    assert [list(r.w) for r in rows] == [plain(t) for t in lines]
    one = spark.createDataFrame([("Xin chào, -- 3 x y",)], "text string").select(words("text").alias("w"))
    assert one.first().w == ["Xin", "chào,", "3", "x", "y"]


def test_prefix_space_step(spark, learned):
    codec = bpe.codec_of(learned)
    inner = codec.piece(" the")
    bare = [i for b in b"the" for i in [codec.byte_id[b]]]
    df = spark.createDataFrame([(0, inner), (1, bare), (2, None)], "i int, ids array<int>").coalesce(1)
    rows = bpe.prefix_space_step(codec)(df, "ids").orderBy("i").collect()
    assert list(rows[0].ids) == inner
    assert codec.text(rows[1].ids) == " the"
    assert rows[2].ids is None


@pytest.mark.parametrize("mode", brute.MODES)
@pytest.mark.parametrize("specials", ["reference", "lossless"])
def test_prefix_space_in_chunks_equals_brute_force(texts, lines, learned, mode, specials):
    t = library(lines, 270, 64)
    t.add_special_tokens(list(vo.SPECIAL_TOKENS))
    codec = bpe.BpeCodec(learned.tokens, [m[:3] for m in learned.merges], vo.SPECIAL_TOKENS)
    df = tk.tokenize_bpe(texts.where("doc_id % 10 = 0"), codec).withColumnRenamed("doc_id", "id")
    df = df.select("id", "input_ids", "len").persist()
    cfg = ChunkConfig(
        24, 0, 3, min_chunk_size=12, always_skip_size=3, backfill=mode, specials=specials
    )

    def again(ids):
        text = t.decode(list(ids), skip_special_tokens=False)
        return list(ids) if text.startswith(" ") else t.encode(text, add_special_tokens=False).ids

    want = []
    for r in df.collect():
        made, _, _ = brute.chunks(list(r.input_ids), cfg, str(r.id), again)
        want += [(r.id, i, tuple(x)) for i, x in enumerate(made)]
    rows = chunk_dataset(df, cfg, keep=(), reencode=bpe.prefix_space_step(codec))
    got = [(r.id, r.chunk_idx, tuple(r.input_ids)) for r in rows.collect()]
    assert sorted(got) == sorted(want)


def test_word_lookup_beyond_the_broadcast_bound(spark, monkeypatch, texts):
    vocab = spark.createDataFrame([("a", 7), ("the", 8)], "token string, id int")
    df = texts.withColumnRenamed("doc_id", "id")
    small = tk.tokenize_words(df, vocab, unk_id=4)
    monkeypatch.setattr(tk, "bounded_rows", lambda *a: None)
    large = tk.tokenize_words(df, vocab, unk_id=4)
    assert small.select("id", "input_ids", "len").exceptAll(large.select("id", "input_ids", "len")).count() == 0
    assert large.count() == df.count()


def test_vocab_rules(spark):
    base = spark.createDataFrame([(f"t{i}", i, False) for i in range(70)], "token string, id int, special boolean")
    spaces = vo.add_space_tokens(base.where("id < 10"), 4).where("id >= 10").orderBy("id").collect()
    assert [(r.token, r.id) for r in spaces] == [("  ", 10), ("   ", 11), ("    ", 12)]
    assert vo.add_space_tokens(base, 0).count() == 70
    assert vo.pad_vocabulary(base).count() == 128
    assert vo.pad_vocabulary(base.where("id < 64")).count() == 64
    assert vo.pad_vocabulary(base.where("id < 64"), num_unused=3).count() == 67
    last = vo.pad_vocabulary(base).orderBy(F.desc("id")).first()
    assert (last.token, last.id, last.special) == ("[unused58]", 127, True)
    assert (vo.padded_size(70), vo.padded_size(64), vo.padded_size(70, 64, 2)) == (128, 64, 128)
    with pytest.raises(ValueError):
        vo.chunk_special_ids(base)


def test_short_pieces_are_merged_together(monkeypatch):
    """Random merges, also two that give one token, of which the later may hold a better pair."""
    rng = random.Random(11)
    for k in range(60):
        letters = [bpe.BYTE_CHARS[b] for b in b"abc"]
        tokens, merges = ["[X]", *letters], []
        for _ in range(rng.randrange(12)):
            a, b = rng.randrange(1, len(tokens)), rng.randrange(1, len(tokens))
            if tokens[a] + tokens[b] not in tokens:
                tokens.append(tokens[a] + tokens[b])
            merges.append((a, b, tokens.index(tokens[a] + tokens[b])))
        codec = bpe.BpeCodec(tokens, merges, ["[X]"] if k % 2 else [])
        some = ["".join(rng.choice("abcaadé") for _ in range(rng.choice([0, 1, 2, 9, 32, 33, 70]))) for _ in range(40)]
        some += ["[X]", "é", "a" * 32, "a" * 33]
        want = [codec.piece(p) for p in some]
        for texts in (pa.array(some), pa.array(["a", *some]).slice(1), pa.array(some[:0], pa.string()), pa.array([""])):
            sizes, ids = codec.pieces(texts)
            wanted = want if len(texts) == len(some) else [[]] * len(texts)
            assert sizes.tolist() == [len(w) for w in wanted]
            assert ids.tolist() == [i for w in wanted for i in w]
    monkeypatch.setattr(bpe.BpeCodec, "_merge_short", None)
    codec.pieces(pa.array(["ab", "abcab"]))
