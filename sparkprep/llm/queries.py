"""One query per operator over its whole table, with the SQL that must agree where there is one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sparkprep.llm.bpe import decode, encode
from sparkprep.llm.embeddings import near_duplicates as near_vectors
from sparkprep.llm.htmltext import extract_text
from sparkprep.llm.linededup import dedup_lines
from sparkprep.llm.mixing import mix
from sparkprep.llm.quality import quality
from sparkprep.llm.secrets import digest_columns, scan
from sparkprep.llm.sharding import LAW, assign_shards
from sparkprep.llm.simhash import hex_fingerprint, near_duplicates
from sparkprep.llm.warc import read_archives, write_archives
from sparkprep.plans.registry import query


def tokenizer_path() -> str:
    """Where the public word-end BPE vocabulary lies."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Words, lines and repeated windows by unnesting; no part of the Spark version is used.
SQL_QUALITY = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT rid, unnest(ws) AS w, generate_subscripts(ws, 1) AS i
  FROM (SELECT rid, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d)
),
g AS (
  SELECT rid, i, w AS w1, lead(w, 1) OVER p AS w2, lead(w, 2) OVER p AS w3
  FROM w WINDOW p AS (PARTITION BY rid ORDER BY i)
),
twice AS (
  SELECT rid, i FROM g WHERE w3 IS NOT NULL
  QUALIFY count(*) OVER (PARTITION BY rid, w1, w2, w3) > 1
),
repeats AS (
  SELECT rid, count(DISTINCT i + k) AS n_repeat_words
  FROM twice, (VALUES (0), (1), (2)) v(k) GROUP BY rid
),
counts AS (
  SELECT rid, count(*) AS n_words, sum(length(w)) AS word_chars FROM w GROUP BY rid
),
l AS (
  SELECT rid, line, ws, len(ws) AS n, len(list_distinct(ws)) AS nd
  FROM (SELECT rid, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS ws
        FROM (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM d))
),
judged AS (
  SELECT rid, line, n,
    n > 0 AND (
      length(regexp_replace(line, '[^#*$%&<>]', '', 'g')) > 0.3 * n
      OR length(regexp_replace(line, '[^!]', '', 'g')) > 0.3 * n
      OR (n < 4 AND NOT regexp_matches(line, '[.!?:;,…"''”’»)\]}。！？][\x20\x09-\x0D]*$'))
      OR (length(regexp_replace(line, '[^|»›•·]', '', 'g')) >= 2
          AND length(regexp_replace(line, '[^|»›•·]', '', 'g')) > 0.2 * n)
      OR (n <= 30 AND regexp_matches(lower(line), 'all rights reserved|cookie policy|enable javascript|lorem ipsum|privacy policy|terms of service|terms of use'))
      OR (n >= 10 AND (nd < 0.1 * n
          OR length(regexp_replace(line, '\P{Lu}', '', 'g'))
             > 0.6 * length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g'))))
    ) AS fails
  FROM l
),
lines AS (
  SELECT rid, count(*) FILTER (n > 0) AS n_lines,
    count(*) FILTER (n > 0) - count(DISTINCT CASE WHEN n > 0 THEN line END) AS n_dup_lines,
    count(*) FILTER (fails) AS n_lines_removed,
    coalesce(sum(n) FILTER (fails), 0) AS n_words_removed
  FROM judged GROUP BY rid
),
m AS (
  SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words, n_lines, n_lines_removed, n_words_removed
  FROM d LEFT JOIN counts USING (rid) LEFT JOIN repeats USING (rid) LEFT JOIN lines USING (rid)
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars,
  n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
  n_repeat_words::BIGINT AS n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
    AND n_words_removed <= 0.5 * n_words AS kept,
  n_lines::BIGINT AS n_lines, n_lines_removed::BIGINT AS n_lines_removed,
  n_words_removed::BIGINT AS n_words_removed
FROM m
"""


@query("op3_line_quality", SQL_QUALITY)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select("doc_id", "quality.*").drop("clean_text")


# Runs of lines by brute force: windows forward, backward and of two neighbours, spelled out as text.
SQL_LINE_DEDUP = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, text FROM documents),
l AS (
  SELECT rid, doc_id, i - 1 AS i, trim(line, E' \t\n\x0b\x0c\r') AS line,
         len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n
  FROM (SELECT rid, doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS i
        FROM (SELECT rid, doc_id, string_split(text, chr(10)) AS ls FROM d))
),
k AS (
  SELECT *, row_number() OVER p AS r, sum(n) OVER p AS total
  FROM l WHERE n > 0 WINDOW p AS (PARTITION BY rid ORDER BY i)
),
w AS (
  SELECT a.rid, a.r AS r1, min(b.r) AS r2 FROM k a JOIN k b
    ON a.rid = b.rid AND b.r BETWEEN a.r AND a.r + 49 AND b.total - a.total + a.n >= 50 GROUP BY ALL
  UNION
  SELECT b.rid, max(a.r), b.r FROM k a JOIN k b
    ON a.rid = b.rid AND a.r BETWEEN b.r - 49 AND b.r AND b.total - a.total + a.n >= 50 GROUP BY b.rid, b.r
  UNION
  SELECT a.rid, a.r, b.r FROM k a JOIN k b ON a.rid = b.rid AND b.r = a.r + 1 AND a.n + b.n >= 50
),
c AS (
  SELECT w.rid, min(k.doc_id) AS doc_id, min(k.i) AS first, max(k.i) AS last,
         string_agg(k.line, chr(10) ORDER BY k.r) AS content
  FROM w JOIN k ON w.rid = k.rid AND k.r BETWEEN w.r1 AND w.r2 GROUP BY w.rid, w.r1, w.r2
),
late AS (
  SELECT rid, first, last FROM c
  QUALIFY row_number() OVER (PARTITION BY content ORDER BY doc_id NULLS LAST, rid, first) > 1
),
gone AS (SELECT DISTINCT rid, unnest(generate_series(first, last)) AS i FROM late),
cut AS (SELECT rid, list(i ORDER BY i) AS removed FROM gone GROUP BY rid),
kept AS (
  SELECT rid, string_agg(line, chr(10) ORDER BY i) AS text
  FROM (SELECT rid, unnest(ls) AS line, generate_subscripts(ls, 1) - 1 AS i
        FROM (SELECT rid, string_split(text, chr(10)) AS ls FROM d))
  WHERE (rid, i) NOT IN (SELECT rid, i FROM gone) GROUP BY rid
)
SELECT doc_id, coalesce(array_to_string(removed, ','), '') AS removed_lines,
       coalesce(kept.text, CASE WHEN d.text IS NULL THEN NULL ELSE '' END) AS text,
       len(coalesce(removed, []))::BIGINT AS n_removed
FROM d LEFT JOIN cut USING (rid) LEFT JOIN kept USING (rid)
"""


@query("op1_line_dedup", SQL_LINE_DEDUP)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select(
        "doc_id",
        F.array_join("removed_lines", ",").alias("removed_lines"),
        "text",
        F.size("removed_lines").cast("bigint").alias("n_removed"),
    )


@query("op4_simhash_near_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


@query("op2_stratified_shards")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return assign_shards(docs, 24).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit(LAW).alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


# Targets by filling sources one round after another; order and positions by plain windows.
SQL_MIX = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, md5('42:' || coalesce(doc_id::VARCHAR, '')) AS draw,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
  FROM documents
),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5.0, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS weight
  FROM d GROUP BY source
),
f(step, source, source_size, weight, level) AS (
  SELECT 0, source, source_size, weight, sum(source_size) OVER () / sum(weight) OVER () FROM s
  UNION ALL
  SELECT step + 1, source, source_size, weight,
         (sum(source_size) OVER ()
          - sum(CASE WHEN 3.0 * source_size <= level * weight THEN 3.0 * source_size ELSE 0 END) OVER ())
         / nullif(sum(CASE WHEN 3.0 * source_size <= level * weight THEN 0 ELSE weight END) OVER (), 0)
  FROM f WHERE step < 30 AND level IS NOT NULL
),
g AS (SELECT * FROM f WHERE step = (SELECT max(step) FROM f WHERE level IS NOT NULL) AND level IS NOT NULL),
t AS (
  SELECT source, source_size, least(3.0 * source_size, level * weight)::DOUBLE AS target,
         0.5 * weight / 5.0 AS tilt FROM g
),
c AS (SELECT *, tilt - sum(tilt * target) OVER () / sum(target) OVER () AS slope FROM t),
o AS (
  SELECT d.*, source_size, target, slope,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY draw, doc_id
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
         floor(target / greatest(source_size, 1)) AS whole
  FROM d JOIN c ON d.source IS NOT DISTINCT FROM c.source
),
p AS (
  SELECT *, CASE WHEN size = 0 THEN 0 ELSE
    whole + CASE WHEN before + size / 2.0 <= target - whole * source_size THEN 1 ELSE 0 END END::INTEGER AS passes,
    least((before + size / 2.0) / target, 1.0) AS part
  FROM o
)
SELECT doc_id, size, source_size, target, passes, (passes * size)::BIGINT AS taken,
       CASE WHEN passes > 0 THEN round(2.0 * part / ((1.0 - slope)
         + sqrt((1.0 - slope) * (1.0 - slope) + 4.0 * slope * part)), 9) END AS first_position
FROM p
"""


@query("op9_curriculum_mix", SQL_MIX)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    first = F.round(F.get("positions", F.lit(0)), 9)
    return (
        mixed.withColumn("first_position", first)
        .select("doc_id", "size", "source_size", "target", "passes", "taken", "first_position")
        .orderBy("first_position", "doc_id")
    )


@query("op10_secret_scan")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_columns(scan(table(spark, sf_dir, "documents").select("doc_id", "text")))


@query("op7_transducer_bpe")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_path()
    encoded = encode(table(spark, sf_dir, "documents").select("doc_id", "text"), path)
    written = encoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        "ids",
    )
    decoded = decode(written, path)
    return decoded.select(
        "doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256")
    )


@query("op5_tag_path_text")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = extract_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return pages.select(
        "page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars")
    )


SQL_WARC = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes,
         sha1(coalesce(html, '')) AS payload_digest
  FROM pages
),
o AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS owner FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND owner <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND owner <> page_id THEN owner END AS refers_to
FROM o
"""


@query("op8_dictionary_warc", SQL_WARC)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", F.col("html").alias("payload"))
    return read_archives(write_archives(pages), with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@query("op6_projection_forest")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


from sparkprep.llm import queries_search  # noqa: E402, F401
