"""The given tables in the shape the operators expect, and the same in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from sparkprep.functions.arrays import template_single
from sparkprep.functions.groups import join_null_safe
from sparkprep.functions.order import prefix_sum
from sparkprep.operators.bpe import BpeCodec, load_codec, piece_counts, train_bpe
from sparkprep.operators.evaluate import word_counts
from sparkprep.operators.tokenize import tokenize_bytes
from sparkprep.operators.vocab import word_vocabulary
from sparkprep.session import scratch_path, spread
from sparkprep.sources.datasets import as_corpus, union_datasets
from sparkprep.sources.manifest import assign_shards, build_manifest

SUBSETS = 8
SEED = 42
# Ids above the byte range open and close a byte sequence.
CLS, SEP = 256, 257
SHARD_LIMIT = 32_768
WORD_VOCAB = 2_000
BPE_MERGES = 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``dataset, subset, sample_idx, id, text`` of the documents."""
    d = spread(table(spark, sf_dir, "documents"), "doc_id")
    key = F.col("doc_id")
    return as_corpus(
        d, dataset="documents", number=0, id=key, order=key, subset=F.pmod(key, F.lit(SUBSETS))
    )


def languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with ``language`` and ``dataset`` (the source) for evaluation."""
    d = spread(table(spark, sf_dir, "documents"), "doc_id")
    return d.select(
        F.col("doc_id").cast("string").alias("id"),
        F.col("lang").alias("language"),
        F.col("source").alias("dataset"),
        "text",
    )


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``dataset, subset, sample_idx, id, text`` of the turns, numbered without gaps in a subset."""
    c = table(spark, sf_dir, "conversations")
    key = F.concat_ws(":", "conv_id", "turn")
    subset = F.pmod(F.col("conv_id"), F.lit(SUBSETS))
    turns = c.groupBy("conv_id").agg(F.count("*").alias("_turns"))
    ends = prefix_sum(
        turns.withColumns({"_subset": subset, "_number": F.floor(F.col("conv_id") / F.lit(SUBSETS))}),
        F.col("_turns"), within=["_subset"], order="_number", out="_end",
    )
    starts = ends.select("conv_id", (F.col("_end") - F.col("_turns")).alias("_start"))
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn")) - 1
    c = join_null_safe(c.withColumn("_place", place), starts, ["conv_id"])
    order = F.col("_start") + F.col("_place")
    return as_corpus(c, dataset="conversations", number=1, id=key, order=order, subset=subset)


def benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = table(spark, sf_dir, "benchmark")
    key = F.col("item_id")
    return as_corpus(
        b, dataset="benchmark", number=2, id=key, order=key, subset=F.pmod(key, F.lit(SUBSETS))
    )


def corpora(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All three datasets."""
    return union_datasets([make(spark, sf_dir) for make in (documents, conversations, benchmark)])


def byte_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as bytes between CLS and SEP."""
    ids = tokenize_bytes(documents(spark, sf_dir)).drop("text")
    return ids.withColumn("input_ids", template_single("input_ids", CLS, SEP)).withColumn(
        "len", F.col("len") + 2
    )


def shard_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All three datasets with ``nbytes`` and ``shard_id``."""
    rows = corpora(spark, sf_dir).withColumn("nbytes", F.octet_length("text"))
    return assign_shards(rows, F.col("nbytes"), SHARD_LIMIT)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back: computed once, whatever reads it."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shard table of all three datasets, from one pass over the texts."""
    sizes = corpora(spark, sf_dir).select(
        "dataset", "subset", "sample_idx", F.octet_length("text").alias("nbytes")
    )
    sharded = assign_shards(stored(sizes, "sizes"), F.col("nbytes"), SHARD_LIMIT)
    return stored(build_manifest(sharded, F.col("nbytes")), "manifest")


def word_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Special tokens and the most frequent words of the documents."""
    return word_vocabulary(word_counts(documents(spark, sf_dir)), WORD_VOCAB)


_TRAINED: dict[tuple[str, str], str] = {}


def trained(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The vocabulary and merge tables learned from the documents.

    Learned once per application and kept as tables in the shared folder.
    """
    run = (spark.sparkContext.applicationId, sf_dir)
    if run not in _TRAINED:
        path = scratch_path(spark, "bpe")
        counts = piece_counts(documents(spark, sf_dir))
        learned = train_bpe(counts, vocab_size=_START_IDS + BPE_MERGES, alphabet="all")
        learned.vocab(spark).write.parquet(path + "/vocab")
        learned.table(spark).write.parquet(path + "/merges")
        _TRAINED[run] = path
    path = _TRAINED[run]
    return spark.read.parquet(path + "/vocab"), spark.read.parquet(path + "/merges")


def codec(spark: SparkSession, sf_dir: str) -> BpeCodec:
    return load_codec(*trained(spark, sf_dir))


def ids_md5(ids: str | Column) -> Column:
    """One comparable value for a whole id array."""
    c = F.col(ids) if isinstance(ids, str) else ids
    return F.md5(F.array_join(c.cast("array<string>"), ","))


# ---- the same in SQL ---------------------------------------------------------

# The character classes of the word and piece rules, spelled for RE2.
SQL_SPACE = r"[\x{09}-\x{0d} \x{85}\p{Z}]"
SQL_WORD_SPACE = r"[\x{09}-\x{0d}\x{1c}-\x{1f} \x{85}\p{Z}]"

SQL_DOCUMENTS = f"""
docs AS (
  SELECT 'documents' AS dataset,
         '000_' || lpad(CAST(doc_id % {SUBSETS} AS VARCHAR), 5, '0') AS subset,
         doc_id AS sample_idx, CAST(doc_id AS VARCHAR) AS id, text, lang, source
  FROM documents
)"""

SQL_CORPORA = f"""{SQL_DOCUMENTS},
corpora AS (
  SELECT dataset, subset, sample_idx, id, text FROM docs
  UNION ALL
  SELECT 'conversations', '001_' || lpad(CAST(conv_id % {SUBSETS} AS VARCHAR), 5, '0'),
         row_number() OVER (PARTITION BY conv_id % {SUBSETS} ORDER BY conv_id, turn) - 1,
         conv_id || ':' || turn, text
  FROM conversations
  UNION ALL
  SELECT 'benchmark', '002_' || lpad(CAST(item_id % {SUBSETS} AS VARCHAR), 5, '0'),
         item_id, CAST(item_id AS VARCHAR), text
  FROM benchmark
)"""

SQL_SHARDS = f"""{SQL_CORPORA},
shard_rows AS (
  SELECT *, strlen(text) AS nbytes,
         CAST(floor((greatest(sum(strlen(text)) OVER (
           PARTITION BY dataset, subset ORDER BY sample_idx), 1) - 1) / {SHARD_LIMIT}) AS BIGINT)
           AS shard_id
  FROM corpora
),
manifest AS (
  SELECT dataset, subset, shard_id, count(*) AS samples, CAST(sum(nbytes) AS BIGINT) AS bytes
  FROM shard_rows GROUP BY ALL
)"""

# Shards cut one after another: the next begins at the first sample that would exceed the limit.
SQL_GREEDY_SHARDS = f"""RECURSIVE {SQL_CORPORA},
cums AS (
  SELECT dataset, subset, sample_idx, strlen(text) AS nbytes,
         sum(strlen(text)) OVER (PARTITION BY dataset, subset ORDER BY sample_idx) AS cum
  FROM corpora
),
cuts(dataset, subset, shard_id, start, before) AS (
  SELECT dataset, subset, CAST(0 AS BIGINT), min(sample_idx), CAST(0 AS HUGEINT) FROM cums GROUP BY ALL
  UNION ALL
  SELECT s.dataset, s.subset, s.shard_id + 1, min(c.sample_idx), arg_min(c.cum - c.nbytes, c.sample_idx)
  FROM cuts s JOIN cums c ON c.dataset = s.dataset AND c.subset = s.subset
       AND c.sample_idx > s.start AND c.cum > s.before + {SHARD_LIMIT}
  GROUP BY s.dataset, s.subset, s.shard_id
),
greedy AS (
  SELECT c.dataset, c.subset, c.sample_idx, c.nbytes, s.shard_id
  FROM cums c ASOF JOIN cuts s
    ON c.dataset = s.dataset AND c.subset = s.subset AND c.sample_idx >= s.start
)"""

SQL_BYTES = f"""{SQL_DOCUMENTS},
bytes AS (
  SELECT dataset, subset, sample_idx, id,
         [('0x' || h)::INT FOR h IN regexp_extract_all(hex(encode(text)), '..')] AS b
  FROM docs
),
tok AS (SELECT dataset, subset, sample_idx, id, [{CLS}] || b || [{SEP}] AS t FROM bytes)"""

_WORDS = f"""
doc_words AS (
  SELECT *, list_filter(regexp_split_to_array(text, '{SQL_WORD_SPACE}+'),
                        lambda w: regexp_matches(w, '[\\p{{L}}\\p{{N}}_]')) AS ws
  FROM docs
),
exploded AS (SELECT id, lang, source, subset, unnest(ws) AS word FROM doc_words)"""
SQL_WORDS = f"{SQL_DOCUMENTS},{_WORDS}"

SQL_WORD_VOCAB = f"""{SQL_WORDS},
ranked AS (
  SELECT word, row_number() OVER (ORDER BY n DESC, word) AS r
  FROM (SELECT word, count(*) AS n FROM exploded GROUP BY word)
),
vocab AS (
  SELECT token, id, true AS special FROM (VALUES ('[CLS]', 0), ('[MASK]', 1), ('[PAD]', 2),
    ('[SEP]', 3), ('[UNK]', 4)) AS s(token, id)
  UNION ALL
  SELECT word, CAST(r + 4 AS INTEGER), false FROM ranked WHERE r <= {WORD_VOCAB} - 5
)"""

# A mark before the last space of a run lets RE2, which cannot look ahead, stop
# a run of spaces where the piece rule stops it.


def sql_pieces(text: str) -> str:
    """The pieces of a text expression, as a list."""
    prefixed = f"CASE WHEN {text} = '' OR {text} LIKE ' %' THEN {text} ELSE ' ' || {text} END"
    space = r"\x{09}-\x{0d} \x{85}\p{Z}"
    marked = f"regexp_replace({prefixed}, '([{space}])([^{space}])', chr(1) || '\\1\\2', 'g')"
    pattern = (
        rf"''s|''t|''re|''ve|''m|''ll|''d| ?\p{{L}}+| ?\p{{N}}+"
        rf"| ?[^\x{{01}}{space}\p{{L}}\p{{N}}]+|[{space}]+"
    )
    return f"regexp_extract_all({marked}, '{pattern}')"


SQL_PIECES = f"""{SQL_DOCUMENTS},
piece_lists AS (SELECT id, {sql_pieces('text')} AS ps FROM docs),
pieces AS (SELECT id, unnest(ps) AS piece FROM piece_lists),
piece_counts AS (SELECT piece, count(*) AS n FROM pieces GROUP BY piece)"""

# Merges learned one at a time: a piece is a string with one character per token,
# and each step replaces the most frequent pair by the next character.
_START_IDS = 5 + 256
_CODED = """array_to_string(list_transform(
    [('0x' || h)::INT FOR h IN regexp_extract_all(hex(encode(piece)), '..')],
    lambda x: chr(code_of[x + 1])), '')"""
SQL_BPE = f"""RECURSIVE {SQL_PIECES},
characters AS (
  SELECT b, CASE WHEN plain THEN b ELSE 255 + row_number() OVER (PARTITION BY plain ORDER BY b) END AS c
  FROM (SELECT b, (b BETWEEN 33 AND 126) OR (b BETWEEN 161 AND 172) OR (b BETWEEN 174 AND 255) AS plain
        FROM range(256) r(b))
),
codes AS (SELECT list(code ORDER BY b) AS code_of
          FROM (SELECT b, CAST(260 + row_number() OVER (ORDER BY c) AS INTEGER) AS code FROM characters)),
coded AS (
  SELECT piece, n, {_CODED} AS symbols FROM piece_counts, codes
),
step AS (
  SELECT 0 AS k, piece, symbols, n, '' AS pair, CAST(0 AS BIGINT) AS pair_n FROM coded
  UNION ALL
  SELECT k + 1, piece, replace(symbols, best.pair, chr(CAST(256 + {_START_IDS} + k AS INTEGER))), n,
         best.pair, best.pair_n
  FROM step, (
    SELECT substr(symbols, i, 2) AS pair, CAST(sum(n) AS BIGINT) AS pair_n
    FROM (SELECT symbols, n, unnest(range(1, length(symbols))) AS i FROM step)
    GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1
  ) AS best
  WHERE k < {BPE_MERGES}
)"""


# The number of tokens of each distinct word, encoded alone.
SQL_WORD_TOKENS = f"""{SQL_BPE},{_WORDS},
merges AS (
  SELECT list(pair || chr(CAST(255 + {_START_IDS} + k AS INTEGER)) ORDER BY k) AS ms
  FROM (SELECT DISTINCT k, pair FROM step WHERE k > 0)
),
word_pieces AS (
  SELECT word, unnest({sql_pieces('word')}) AS piece FROM (SELECT DISTINCT word FROM exploded)
),
alone AS (
  SELECT DISTINCT piece, {_CODED} AS symbols FROM word_pieces, codes
),
merged AS (
  SELECT piece, length(list_reduce(ms, lambda acc, m: replace(acc, substr(m, 1, 2), substr(m, 3, 1)),
                                   symbols)) AS tokens
  FROM alone, merges
),
word_tokens AS (
  SELECT word, sum(tokens) AS tokens FROM word_pieces JOIN merged USING (piece) GROUP BY word
)"""


def sql_md5(list_expr: str) -> str:
    return f"md5(array_to_string({list_expr}, ','))"


def sql_draw(seed: int, key: str) -> str:
    return f"CAST('0x' || substr(md5('{seed}:' || {key}), 1, 8) AS BIGINT)"
