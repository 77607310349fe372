"""The registry: every kind has a size, an end id and both directions."""

from __future__ import annotations

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sparkprep.functions.batches import PART_ITEMS, by_parts, parts
from sparkprep.operators import bpe
from sparkprep.operators.tokenize import tokenize_with
from sparkprep.operators.tokenizers import CorpusTokenizer, make_tokenizer, register

TEXTS = ["one two one", "two", "", None, "three one"]


def frame(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "i int, text string")


def there_and_back(tokenizer, df, **options):
    rows = tokenizer.detokenize(tokenizer.tokenize(df, **options)).orderBy("i").collect()
    return [r["input_ids"] for r in rows], [r["decoded"] for r in rows]


def test_bytes(spark):
    t = make_tokenizer("Bytes")
    assert (t.kind, t.vocab_size, t.eod, t.padded_size(100)) == ("bytes", 512, 0, 600)
    ids, back = there_and_back(t, frame(spark), end=True)
    assert back == TEXTS and ids[1] == [*b"two", 0] and ids[2] == [0]


def test_words(spark):
    vocab = spark.createDataFrame([("[UNK]", 0), ("one", 1), ("two", 2), ("[END]", 5)], "token string, id int")
    t = make_tokenizer("words", vocab=vocab, unk_id=0, eod=5)
    ids, back = there_and_back(t, frame(spark), end=True)
    assert t.vocab_size == 6 and ids[0] == [1, 2, 1, 5]
    assert back == ["one two one", "two", "", None, "[UNK] one"]
    bare = make_tokenizer("words", vocab=vocab, unk_id=0)
    with pytest.raises(ValueError, match="no id that ends"):
        bare.tokenize(frame(spark), end=True)


def test_bpe(spark):
    learned = bpe.train_bpe(bpe.piece_counts(frame(spark)), vocab_size=20)
    t = make_tokenizer("BPE", codec=bpe.codec_of(learned))
    assert t.vocab_size == len(learned.tokens) and learned.tokens[t.eod] == "[SEP]"
    plain, back = there_and_back(t, frame(spark))
    ended, again = there_and_back(t, frame(spark), end=True)
    assert back == again and back[0] == " one two one" and back[3] is None
    assert [x + [t.eod] for x in plain if x is not None] == [x for x in ended if x is not None]


def test_custom_and_registering(spark):
    class Lengths:  # workers get it by value
        def tokenize_batch(self, texts):
            return [[len(w) for w in t.split()] for t in texts]

        def detokenize(self, ids):
            return " ".join("x" * n for n in ids)

    df = frame(spark).where(F.col("text").isNotNull())
    t = make_tokenizer("custom", factory=Lengths, vocab_size=100, eod=99)
    ids, back = there_and_back(t, df, end=True)
    assert ids == [[3, 3, 3, 99], [3, 99], [99], [5, 3, 99]] and back == ["xxx xxx xxx", "xxx", "", "xxxxx xxx"]

    @register("upper bytes of a test")
    def upper(**options):
        base = make_tokenizer("bytes")
        return CorpusTokenizer("upper", 512, 0, lambda df, text: base.encode(df.withColumn(text, F.upper(text)), text), base.decode)

    assert there_and_back(make_tokenizer("Upper bytes of a test"), df)[1][1] == "TWO"
    with pytest.raises(ValueError, match="twice"):
        register("BYTES")(upper)
    with pytest.raises(ValueError, match="unknown"):
        make_tokenizer("none")


def bounded(most=PART_ITEMS):
    """Code points by a tokenizer that refuses to hold more than a part at once."""

    class Bounded:
        def tokenize_batch(self, texts):
            assert len(texts) == 1 or sum(len(t or "") for t in texts) <= most, "too much at once"
            return [None if t is None else [ord(c) for c in t] for t in texts]

    return Bounded


def long_texts(spark):
    rows = spark.range(0, 1500, 1, 1).withColumnRenamed("id", "i")
    long = F.when(F.col("i") % 100 == 7, None).otherwise(F.repeat(F.lit("abcd"), F.lit(100)))
    return rows.withColumn("text", F.when(F.col("i") == 5, F.repeat(F.lit("x"), F.lit(PART_ITEMS + 9))).otherwise(long))


def test_a_tokenizer_gets_bounded_parts(spark):
    done = tokenize_with(long_texts(spark), bounded())
    back = F.array_join(F.transform("input_ids", lambda c: F.char(c)), "")
    assert done.where(~back.eqNullSafe(F.col("text"))).count() == 0
    assert done.where("len is null or input_ids is null").count() == 15 and done.count() == 1500


def test_parts_keep_all_rows():
    lists = pa.array([[1, 2, 3], None, [], [4], [5, 6, 7, 8, 9], [1]], pa.list_(pa.int32()))
    for most in (1, 3, 4, 100):
        for batch in (lists, lists.slice(1, 4), lists.slice(6)):
            assert by_parts(lambda p: p, batch, most).to_pylist() == batch.to_pylist()
    assert [len(p) for p in parts(lists, 4)] == [4, 1, 1]


def test_decoding_gets_bounded_parts(spark):
    """The whole column comes in one batch; a detokenizer's texts are freed part by part."""
    made = long_texts(spark).where("i != 5 and text is not null").withColumn("ids", F.split("text", "").cast("array<string>"))
    ids = made.withColumn("input_ids", F.transform("ids", lambda c: F.ascii(c))).drop("ids")
    limit = PART_ITEMS // 400

    class Counting:
        """Refuses when its caller's list of id lists is longer than a part's."""

        def detokenize(self, row):
            import inspect

            held = inspect.currentframe().f_back.f_locals.get("part")
            assert held is not None and len(held) <= limit + 1, "too much at once"
            return "".join(map(chr, row))

    t = make_tokenizer("custom", factory=Counting, vocab_size=256)
    back = t.detokenize(ids)
    assert back.where("decoded = text").count() == 1484
