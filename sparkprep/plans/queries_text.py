"""Queries on vocabularies, tokenization and text functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sparkprep.functions import arrays, text as tx
from sparkprep.operators import bpe, vocab as vo
from sparkprep.operators.evaluate import word_counts
from sparkprep.operators.tokenize import (
    token_stats,
    tokenize_bpe,
    tokenize_bytes,
    tokenize_with,
    tokenize_words,
    tokenize_words_joined,
    uint16_violations,
)
from sparkprep.operators.tokenizers import make_tokenizer
from sparkprep.plans import tables as tb
from sparkprep.plans.registry import query
from sparkprep.plans.tables import ids_md5, sql_md5
from sparkprep.streaming.incremental import failure_status

UNK = vo.SPECIAL_TOKENS.index("[UNK]")
MAX_SPACES = 24
OVERFLOW = 400


@query(
    "byte_tokenize",
    f"""WITH {tb.SQL_BYTES}
    SELECT id, CAST(len(b) AS BIGINT) AS len, {sql_md5('b')} AS ids_md5 FROM bytes""",
)
def byte_tokenize(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tokenize_bytes(tb.documents(spark, sf_dir))
    return rows.select("id", F.col("len").cast("bigint").alias("len"), ids_md5("input_ids").alias("ids_md5"))


@query(
    "byte_detokenize",
    f"""WITH {tb.SQL_BYTES}
    SELECT id, md5(array_to_string(list_transform(t,
      lambda x: chr(greatest(32, least(x, 512)))), '')) AS text_md5 FROM tok""",
)
def byte_detokenize(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tb.byte_tokens(spark, sf_dir)
    return rows.select("id", F.md5(tx.byte_text("input_ids")).alias("text_md5"))


@query(
    "token_stats",
    f"""WITH {tb.SQL_DOCUMENTS}
    SELECT subset, CAST(sum(strlen(text)) AS BIGINT) AS num_tokens, count(*) AS num_samples
    FROM docs GROUP BY ROLLUP (subset)""",
)
def token_stats_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_stats(tokenize_bytes(tb.documents(spark, sf_dir)))


@query(
    "word_split",
    f"""WITH {tb.SQL_WORDS}
    SELECT id, CAST(len(ws) AS BIGINT) AS words, {sql_md5('ws')} AS words_md5 FROM doc_words""",
)
def word_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tb.documents(spark, sf_dir).select("id", tx.words("text").alias("ws"))
    return rows.select("id", F.size("ws").cast("bigint").alias("words"), ids_md5("ws").alias("words_md5"))


@query(
    "word_counts",
    f"""WITH {tb.SQL_WORDS}
    SELECT lang AS language, word, count(*) AS n FROM exploded GROUP BY lang, word""",
)
def word_counts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_counts(tb.languages(spark, sf_dir), by=["language"])


@query(
    "nfc_normalize",
    f"""WITH {tb.SQL_DOCUMENTS} SELECT id, md5(nfc_normalize(replace(text, 'e', 'e' || chr(769)))) AS text_md5
    FROM docs""",
)
def nfc_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every e becomes two characters that compose to one, so no text is in NFC yet."""
    apart = F.replace(F.col("text"), F.lit("e"), F.lit("e\u0301"))
    return tb.documents(spark, sf_dir).select("id", F.md5(tx.nfc(apart)).alias("text_md5"))


@query(
    "pre_tokenize",
    f"""WITH {tb.SQL_PIECES}
    SELECT id, count(*) AS pieces, CAST(sum(strlen(piece)) AS BIGINT) AS bytes,
           bit_xor(CAST('0x' || substr(md5(piece), 1, 15) AS BIGINT)) AS fingerprint
    FROM pieces GROUP BY id""",
)
def pre_tokenize(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tb.documents(spark, sf_dir).select("id", F.explode(tx.pre_tokenize("text")).alias("piece"))
    word = F.conv(F.substring(F.md5("piece"), 1, 15), 16, 10).cast("bigint")
    return rows.groupBy("id").agg(
        F.count("*").alias("pieces"),
        F.sum(F.octet_length("piece")).alias("bytes"),
        F.bit_xor(word).alias("fingerprint"),
    )


@query("piece_counts", f"WITH {tb.SQL_PIECES} SELECT piece, n FROM piece_counts")
def piece_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.piece_counts(tb.documents(spark, sf_dir))


@query(
    "pair_counts",
    f"""WITH {tb.SQL_PIECES},
    coded AS (SELECT n, hex(encode(piece)) AS h FROM piece_counts),
    pairs AS (SELECT n, substr(h, 2 * unnest(range(0, strlen(h) // 2 - 1)) + 1, 4) AS p FROM coded)
    SELECT CAST('0x' || substr(p, 1, 2) AS INTEGER) AS left_byte,
           CAST('0x' || substr(p, 3, 2) AS INTEGER) AS right_byte, CAST(sum(n) AS BIGINT) AS n
    FROM pairs GROUP BY ALL""",
)
def pair_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    latin = F.decode(F.col("piece").cast("binary"), "ISO-8859-1")
    counts = bpe.piece_counts(tb.documents(spark, sf_dir)).select(latin.alias("symbols"), "n")
    return bpe.pair_counts(counts).select(
        F.ascii(F.substring("pair", 1, 1)).alias("left_byte"),
        F.ascii(F.substring("pair", 2, 1)).alias("right_byte"),
        "n",
    )


@query(
    "initial_alphabet",
    f"""WITH {tb.SQL_BYTES}
    SELECT byte, count(*) AS texts
    FROM (SELECT id, unnest(list_distinct(b)) AS byte FROM bytes) GROUP BY byte""",
)
def initial_alphabet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vo.initial_alphabet(tb.documents(spark, sf_dir))


@query("vocab_words", f"WITH {tb.SQL_WORD_VOCAB} SELECT token, id, special FROM vocab")
def vocab_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tb.word_vocab(spark, sf_dir)


@query(
    "vocab_special",
    f"""WITH {tb.SQL_WORD_VOCAB}
    SELECT max(id) FILTER (WHERE token = '[CLS]') AS bos_id,
           max(id) FILTER (WHERE token = '[SEP]') AS eos_id,
           max(id) FILTER (WHERE token = '[CLS]') AS cls_id,
           max(id) FILTER (WHERE token = '[SEP]') AS sep_id,
           max(id) FILTER (WHERE token = '[PAD]') AS pad_id,
           max(id) FILTER (WHERE token = '[UNK]') AS unk_id FROM vocab""",
)
def vocab_special(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vo.special_ids(tb.word_vocab(spark, sf_dir))


@query(
    "vocab_space_tokens",
    f"""WITH {tb.SQL_WORD_VOCAB}
    SELECT token, id, special, false AS added FROM vocab UNION ALL
    SELECT repeat(' ', i::INT), CAST((SELECT count(*) FROM vocab) + i - 2 AS INTEGER), false, true
    FROM range(2, {MAX_SPACES + 1}) r(i)""",
)
def vocab_space_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vo.add_space_tokens(tb.word_vocab(spark, sf_dir), MAX_SPACES)


@query(
    "vocab_pad",
    f"""WITH {tb.SQL_WORD_VOCAB}, size AS (SELECT count(*) AS n FROM vocab)
    SELECT token, id, special FROM vocab UNION ALL
    SELECT '[unused' || i || ']', CAST(n + i - 1 AS INTEGER), true
    FROM size, range(1, 64) r(i) WHERE i <= (64 - n % 64) % 64""",
)
def vocab_pad(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vo.pad_vocabulary(tb.word_vocab(spark, sf_dir), 64)


_WORD_IDS = f"""WITH {tb.SQL_WORD_VOCAB},
    placed AS (SELECT id AS doc, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM doc_words),
    looked AS (SELECT doc, list(coalesce(v.id, {UNK}) ORDER BY pos) AS ids
               FROM placed p LEFT JOIN vocab v ON v.token = p.word GROUP BY doc)
    SELECT d.id, CAST(coalesce(len(ids), 0) AS BIGINT) AS len,
           md5(coalesce(array_to_string(ids, ','), '')) AS ids_md5
    FROM docs d LEFT JOIN looked l ON l.doc = d.id"""


def _word_ids(rows: DataFrame) -> DataFrame:
    return rows.select("id", F.col("len").cast("bigint").alias("len"), ids_md5("input_ids").alias("ids_md5"))


@query("word_vocab_tokenize", _WORD_IDS)
def word_vocab_tokenize(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocab = tb.word_vocab(spark, sf_dir)
    return _word_ids(tokenize_words(tb.documents(spark, sf_dir), vocab, unk_id=UNK))


@query("word_vocab_tokenize_joined", _WORD_IDS)
def word_vocab_tokenize_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocab = tb.word_vocab(spark, sf_dir)
    return _word_ids(tokenize_words_joined(tb.documents(spark, sf_dir), vocab, unk_id=UNK))


@query(
    "template_single",
    f"""WITH {tb.SQL_BYTES}
    SELECT id, CAST(len(t) AS BIGINT) AS len, {sql_md5('t')} AS ids_md5 FROM tok""",
)
def template_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _word_ids(tb.byte_tokens(spark, sf_dir))


_TURNS = """turns AS (
      SELECT conv_id, turn, [('0x' || h)::INT FOR h IN regexp_extract_all(hex(encode(text)), '..')] AS b
      FROM conversations
    ),
    pairs AS (
      SELECT a.conv_id, a.turn, a.b AS a, n.b AS b
      FROM turns a JOIN turns n ON n.conv_id = a.conv_id AND n.turn = a.turn + 1
    )"""


def _turn_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = tb.table(spark, sf_dir, "conversations")
    turns = c.select("conv_id", "turn", tx.byte_ids("text").alias("a"))
    after = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("a").alias("b"))
    return turns.join(after, ["conv_id", "turn"])


@query(
    "template_pair",
    f"""WITH {_TURNS}
    SELECT conv_id, turn,
           md5(array_to_string([{tb.CLS}] || a || [{tb.SEP}] || b || [{tb.SEP}], ',')) AS ids_md5,
           md5(repeat('0', len(a)::INT + 2) || repeat('1', len(b)::INT + 1)) AS types_md5
    FROM pairs""",
)
def template_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = _turn_pairs(spark, sf_dir)
    ids = arrays.template_pair("a", "b", tb.CLS, tb.SEP)
    types = F.array_join(arrays.pair_type_ids("a", "b").cast("array<string>"), "")
    return pairs.select("conv_id", "turn", ids_md5(ids).alias("ids_md5"), F.md5(types).alias("types_md5"))


@query(
    "verify_template",
    f"""WITH {tb.SQL_BYTES}, {_TURNS},
    forms AS (
      SELECT 'single' AS form, t[1] = {tb.CLS} AND t[-1] = {tb.SEP} AS ok FROM tok
      UNION ALL
      SELECT 'pair', p[1] = {tb.CLS} AND len(list_filter(p, lambda x: x = {tb.SEP})) = 2
      FROM (SELECT [{tb.CLS}] || a || [{tb.SEP}] || b || [{tb.SEP}] AS p FROM pairs)
      UNION ALL
      SELECT 'bare', coalesce(b[1] = {tb.CLS} AND b[-1] = {tb.SEP}, false) FROM bytes
    )
    SELECT form, count(*) AS samples, count(*) FILTER (WHERE NOT ok) AS violations
    FROM forms GROUP BY form""",
)
def verify_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = tb.byte_tokens(spark, sf_dir)
    single = arrays.single_is_valid("input_ids", tb.CLS, tb.SEP)
    bare = arrays.single_is_valid(tx.byte_ids("text"), tb.CLS, tb.SEP)
    pair = arrays.pair_is_valid(arrays.template_pair("a", "b", tb.CLS, tb.SEP), tb.CLS, tb.SEP)
    forms = (
        tokens.select(F.lit("single").alias("form"), single.alias("ok"))
        .unionByName(_turn_pairs(spark, sf_dir).select(F.lit("pair").alias("form"), pair.alias("ok")))
        .unionByName(
            tb.documents(spark, sf_dir).select(F.lit("bare").alias("form"), bare.alias("ok"))
        )
    )
    return forms.groupBy("form").agg(
        F.count("*").alias("samples"), F.count_if(~F.col("ok")).alias("violations")
    )


@query(
    "drop_template",
    f"""WITH {tb.SQL_BYTES}
    SELECT id, CAST(len(b) AS BIGINT) AS len, {sql_md5('b')} AS ids_md5 FROM bytes""",
)
def drop_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    bare = arrays.drop_ids("input_ids", [tb.CLS, tb.SEP])
    rows = tb.byte_tokens(spark, sf_dir).withColumn("input_ids", bare)
    return _word_ids(rows.withColumn("len", F.size("input_ids")))


@query(
    "uint16_guard",
    f"""WITH {tb.SQL_BYTES},
    wide AS (SELECT subset, list_transform(b, lambda x: x * {OVERFLOW}) AS w FROM bytes)
    SELECT subset, count(*) AS violations FROM wide WHERE list_max(w) >= 65536 GROUP BY subset""",
)
def uint16_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids stretched so that some texts leave the 16-bit range."""
    rows = tokenize_bytes(tb.documents(spark, sf_dir))
    wide = rows.withColumn("input_ids", F.transform("input_ids", lambda x: x * OVERFLOW))
    return uint16_violations(wide).groupBy("subset").agg(F.count("*").alias("violations"))


class CodePointTokenizer:
    """A user tokenizer: one id per character, refusing text with a bar."""

    def tokenize_batch(self, texts: list[str]) -> list[list[int]]:
        for t in texts:
            if "|" in t:
                raise ValueError("bar in text")
        return [[ord(c) for c in t] for t in texts]


@query(
    "pluggable_tokenizer",
    f"""WITH {tb.SQL_DOCUMENTS},
    coded AS (SELECT id, CASE WHEN text NOT LIKE '%|%' THEN
      list_transform(string_split(text, ''), lambda c: unicode(c)) END AS u FROM docs)
    SELECT id, CAST(coalesce(len(u), -1) AS BIGINT) AS len, {sql_md5('u')} AS ids_md5 FROM coded""",
)
def pluggable_tokenizer(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tokenize_with(tb.documents(spark, sf_dir), CodePointTokenizer, errors="record")
    rows = rows.withColumn("len", F.coalesce("len", F.lit(-1)))
    return _word_ids(rows)


class TwoWayCodePoints:
    """A user tokenizer with both directions: one id per character."""

    def tokenize_batch(self, texts: list[str]) -> list[list[int]]:
        return [[ord(c) for c in t] for t in texts]

    def detokenize(self, ids: list[int]) -> str:
        return "".join(map(chr, ids))


@query(
    "tokenizer_round_trip",
    f"""WITH {tb.SQL_DOCUMENTS}
    SELECT id, CAST(length(text) + 1 AS INTEGER) AS len, md5(text) AS decoded_md5 FROM docs""",
)
def tokenizer_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts closed with the end id, and decoded again, by a tokenizer from the registry."""
    points = make_tokenizer("custom", factory=TwoWayCodePoints, vocab_size=0x110001, eod=0x110000)
    ids = points.tokenize(tb.documents(spark, sf_dir), end=True)
    return points.detokenize(ids).select("id", "len", F.md5("decoded").alias("decoded_md5"))


@query(
    "tokenize_failures",
    f"""WITH {tb.SQL_DOCUMENTS}
    SELECT subset, count(*) FILTER (WHERE text NOT LIKE '%|%') AS samples,
           count(*) FILTER (WHERE text LIKE '%|%') AS failed,
           max(CASE WHEN text LIKE '%|%' THEN 'ValueError: bar in text' END) AS error
    FROM docs GROUP BY subset""",
)
def tokenize_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tokenize_with(tb.documents(spark, sf_dir), CodePointTokenizer, errors="record")
    return failure_status(rows, ["subset"])


@query(
    "bpe_train",
    f"""WITH {tb.SQL_BPE}
    SELECT DISTINCT CAST(k - 1 AS INTEGER) AS rank,
           CAST(unicode(substr(pair, 1, 1)) - 256 AS INTEGER) AS left_id,
           CAST(unicode(substr(pair, 2, 1)) - 256 AS INTEGER) AS right_id,
           CAST(260 + k AS INTEGER) AS new_id, pair_n AS n
    FROM step WHERE k > 0""",
)
def bpe_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tb.trained(spark, sf_dir)[1].drop("token")


@query(
    "bpe_encode",
    f"""WITH {tb.SQL_BPE},
    final AS (
      SELECT piece, list_transform(string_split(symbols, ''), lambda c: unicode(c) - 256) AS ids
      FROM step WHERE k = {tb.BPE_MERGES}
    ),
    placed AS (
      SELECT id, unnest(ps) AS piece, generate_subscripts(ps, 1) AS pos FROM piece_lists
    ),
    encoded AS (
      SELECT p.id, [0] || coalesce(flatten(list(f.ids ORDER BY pos)), []) || [3] AS ids
      FROM placed p JOIN final f ON f.piece = p.piece GROUP BY p.id
    )
    SELECT id, CAST(len(ids) AS BIGINT) AS len, {sql_md5('ids')} AS ids_md5 FROM encoded""",
)
def bpe_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    cls, sep = vo.chunk_special_ids(tb.trained(spark, sf_dir)[0])
    codec = tb.codec(spark, sf_dir)
    return _word_ids(tokenize_bpe(tb.documents(spark, sf_dir), codec, template=(cls, sep)))


@query(
    "bpe_round_trip",
    f"""WITH {tb.SQL_DOCUMENTS}
    SELECT id, md5(CASE WHEN text = '' OR text LIKE ' %' THEN text ELSE ' ' || text END) AS text_md5,
           true AS same FROM docs""",
)
def bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bpe.round_trip(tb.documents(spark, sf_dir), tb.codec(spark, sf_dir))
    return rows.select("id", F.md5("decoded").alias("text_md5"), "same")


@query(
    "space_consistency",
    f"""WITH {tb.SQL_WORDS}
    SELECT DISTINCT word, CAST(1 AS INTEGER) AS n_encodings FROM exploded""",
)
def space_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    distinct = word_counts(tb.documents(spark, sf_dir)).select("word")
    return bpe.space_consistency(distinct, tb.codec(spark, sf_dir))



SPACED = " " * 5


@query(
    "space_tokens_encode",
    f"""WITH {tb.SQL_DOCUMENTS},
    runs AS (SELECT id, regexp_extract_all(replace(text, chr(10), '{SPACED}'), ' {{2,{MAX_SPACES}}}') AS r
             FROM docs)
    SELECT id, CAST(len(r) AS BIGINT) AS space_tokens,
           CAST(coalesce(list_sum([length(x) FOR x IN r]), 0) AS BIGINT) AS spaces FROM runs""",
)
def space_tokens_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of spaces become the added tokens of the vocabulary, without naming them."""
    vocab, merges = tb.trained(spark, sf_dir)
    size = vocab.count()
    codec = bpe.load_codec(vo.add_space_tokens(vocab, MAX_SPACES), merges)
    spaced = F.replace(F.col("text"), F.lit("\n"), F.lit(SPACED))
    rows = tokenize_bpe(tb.documents(spark, sf_dir).withColumn("text", spaced), codec)
    added = F.filter("input_ids", lambda i: i >= size)
    spaces = F.aggregate(added, F.lit(0), lambda n, i: n + i - F.lit(size) + 2)
    return rows.select(
        "id", F.size(added).cast("bigint").alias("space_tokens"), spaces.cast("bigint").alias("spaces")
    )


_ODD_ROWS = """odd(id, text) AS (VALUES ('5', 'a b'), ('5', 'b'), ('6', NULL), ('7', ''), ('8', 'b zz a')),
    listed(token, id) AS (VALUES ('a', 9), ('b', 2), ('a', 1))"""


@query(
    "word_tokenize_odd_rows",
    f"""WITH {_ODD_ROWS},
    smallest AS (SELECT token, min(id) AS id FROM listed GROUP BY token),
    all_rows AS (
      SELECT * FROM odd UNION ALL SELECT CAST(doc_id AS VARCHAR), text FROM documents UNION ALL
      SELECT CAST(item_id AS VARCHAR), text FROM benchmark
    ),
    split AS (SELECT row_number() OVER () AS rid, id, text,
              CASE WHEN text IS NOT NULL THEN list_filter(regexp_split_to_array(text, '{tb.SQL_WORD_SPACE}+'),
                lambda w: regexp_matches(w, '[\\p{{L}}\\p{{N}}_]')) END AS ws FROM all_rows),
    placed AS (SELECT rid, unnest(ws) AS w, generate_subscripts(ws, 1) AS pos FROM split),
    looked AS (SELECT rid, list(coalesce(s.id, {UNK}) ORDER BY pos) AS ids
               FROM placed LEFT JOIN smallest s ON s.token = w GROUP BY rid),
    result AS (SELECT split.id, text IS NULL AS missing,
               CASE WHEN text IS NOT NULL THEN md5(coalesce(array_to_string(ids, ','), '')) END AS ids_md5
               FROM split LEFT JOIN looked USING (rid))
    SELECT way, result.* FROM result, (VALUES ('looked up'), ('joined')) v(way)""",
)
def word_tokenize_odd_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both ways over rows that share ids, have no text, and a vocabulary with a token twice."""
    odd = [("5", "a b"), ("5", "b"), ("6", None), ("7", ""), ("8", "b zz a")]
    rows = spark.createDataFrame(odd, "id string, text string")
    for make in (tb.documents, tb.benchmark):
        rows = rows.unionByName(make(spark, sf_dir).select("id", "text"))
    vocab = spark.createDataFrame([("a", 9), ("b", 2), ("a", 1)], "token string, id int")
    done = [
        run(rows, vocab, unk_id=UNK).withColumn("way", F.lit(way))
        for way, run in (("looked up", tokenize_words), ("joined", tokenize_words_joined))
    ]
    return done[0].unionByName(done[1]).select(
        "way", "id", F.col("text").isNull().alias("missing"), ids_md5("input_ids").alias("ids_md5")
    )
