"""Queries on tokenizer quality and inspection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sparkprep.functions.text import byte_text
from sparkprep.operators import evaluate as ev
from sparkprep.operators.bpe import encode
from sparkprep.operators.tokenize import tokenize_bytes
from sparkprep.plans import tables as tb
from sparkprep.plans.registry import query
from sparkprep.plans.tables import ids_md5, sql_md5

BYTE_VOCAB, CHAR_VOCAB = 512, 1_114_112


def _tokenizers() -> dict[str, tuple[Column, int]]:
    """Tokens of one word: its bytes, or its characters."""
    return {
        "bytes": (F.octet_length("word"), BYTE_VOCAB),
        "characters": (F.length("word"), CHAR_VOCAB),
    }


_MATRIX = f"""WITH {tb.SQL_WORDS},
    lengths AS (
      SELECT 'bytes' AS tokenizer, {BYTE_VOCAB} AS vocab_size, lang, source, strlen(word) AS k FROM exploded
      UNION ALL
      SELECT 'characters', {CHAR_VOCAB}, lang, source, length(word) FROM exploded
    ),
    groups AS (SELECT DISTINCT lang, source FROM docs),
    matrix AS (
      SELECT t.tokenizer, g.lang AS language, g.source AS dataset, CAST(t.vocab_size AS BIGINT) AS vocab_size,
             coalesce(avg(k), 0.0) AS fertility,
             coalesce(count(*) FILTER (WHERE k >= 2) / CAST(count(k) AS DOUBLE), 0.0) AS pcw
      FROM groups g CROSS JOIN (SELECT DISTINCT tokenizer, vocab_size FROM lengths) t
           LEFT JOIN lengths l ON l.lang = g.lang AND l.source = g.source AND l.tokenizer = t.tokenizer
      GROUP BY ALL
    )"""


@query(
    "eval_matrix",
    f"""{_MATRIX}
    SELECT tokenizer, language, dataset, vocab_size, round(fertility, 6) AS fertility, round(pcw, 6) AS pcw
    FROM matrix""",
)
def eval_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ev.tokenizer_metrics(tb.languages(spark, sf_dir), _tokenizers())
    return rows.withColumn("fertility", F.round("fertility", 6)).withColumn("pcw", F.round("pcw", 6))


@query(
    "eval_summary",
    f"""{_MATRIX}
    SELECT dataset, tokenizer, round(avg(fertility), 4) AS fertility, round(avg(pcw), 4) AS pcw,
           max(vocab_size) AS vocab_size FROM matrix GROUP BY dataset, tokenizer""",
)
def eval_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.evaluation_summary(ev.tokenizer_metrics(tb.languages(spark, sf_dir), _tokenizers()))


@query(
    "fertility",
    f"""WITH {tb.SQL_WORDS}
    SELECT lang AS language, round(avg(strlen(word)), 6) AS fertility FROM exploded GROUP BY lang""",
)
def fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ev.tokenizer_metrics(
        tb.languages(spark, sf_dir), {"bytes": (F.octet_length("word"), BYTE_VOCAB)}, by=["language"]
    )
    return rows.select("language", F.round("fertility", 6).alias("fertility"))


@query(
    "pcw",
    f"""WITH {tb.SQL_WORDS}
    SELECT lang AS language, round(avg(CASE WHEN strlen(word) >= 2 THEN 1.0 ELSE 0.0 END), 6) AS pcw
    FROM exploded GROUP BY lang""",
)
def pcw(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ev.tokenizer_metrics(
        tb.languages(spark, sf_dir), {"bytes": (F.octet_length("word"), BYTE_VOCAB)}, by=["language"]
    )
    return rows.select("language", F.round("pcw", 6).alias("pcw"))


@query(
    "eval_bpe",
    f"""WITH {tb.SQL_WORD_TOKENS},
    lengths AS (
      SELECT 'learned' AS tokenizer, {5 + 256 + tb.BPE_MERGES} AS vocab_size, lang, source, tokens AS k
      FROM exploded JOIN word_tokens USING (word)
      UNION ALL
      SELECT 'bytes', {BYTE_VOCAB}, lang, source, strlen(word) FROM exploded
    )
    SELECT tokenizer, lang AS language, source AS dataset, CAST(max(vocab_size) AS BIGINT) AS vocab_size,
           round(avg(k), 6) AS fertility,
           round(avg(CASE WHEN k >= 2 THEN 1.0 ELSE 0.0 END), 6) AS pcw
    FROM lengths GROUP BY tokenizer, lang, source""",
)
def eval_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learned tokens per word next to bytes per word."""
    codec = tb.codec(spark, sf_dir)
    tokenizers = {
        "learned": (F.size(encode("word", codec)), len(codec.tokens)),
        "bytes": (F.octet_length("word"), BYTE_VOCAB),
    }
    rows = ev.tokenizer_metrics(tb.languages(spark, sf_dir), tokenizers)
    return rows.withColumn("fertility", F.round("fertility", 6)).withColumn("pcw", F.round("pcw", 6))


@query(
    "inspect_samples",
    f"""WITH {tb.SQL_BYTES}
    SELECT subset, sample_idx, CAST(len(b) AS INTEGER) AS len, list_min(b) AS min_id, list_max(b) AS max_id,
           {sql_md5('b')} AS ids_md5,
           md5(array_to_string(list_transform(b, lambda x: chr(greatest(32, x))), '')) AS text_md5
    FROM bytes WHERE subset = (SELECT min(subset) FROM bytes) ORDER BY sample_idx LIMIT 5""",
)
def inspect_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tokenize_bytes(tb.documents(spark, sf_dir)).drop("text")
    shown = ev.inspect_samples(rows, n=5, decoded=byte_text("input_ids"))
    return shown.select(
        "subset",
        "sample_idx",
        "len",
        "min_id",
        "max_id",
        ids_md5("input_ids").alias("ids_md5"),
        F.md5("text").alias("text_md5"),
    )


@query(
    "preview_ids",
    f"""WITH {tb.SQL_BYTES}
    SELECT id, array_to_string(CASE WHEN len(b) <= 50 THEN b ELSE b[1:25] || b[len(b) - 24 :] END, ',') AS preview
    FROM bytes""",
)
def preview_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ev.preview_ids(tokenize_bytes(tb.documents(spark, sf_dir)))
    return rows.select("id", F.array_join(F.col("preview").cast("array<string>"), ",").alias("preview"))
