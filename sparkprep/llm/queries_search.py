"""Queries of the operators that search: hard negatives, benchmark passages, spelling variants."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sparkprep.llm.negatives import mine_negatives
from sparkprep.llm.postings import decontaminate
from sparkprep.llm.spelling import spelling_variants
from sparkprep.plans.registry import query

# Scores of all rows, by plain inner products.
SQL_NEGATIVES = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
         list_inner_product(a.v, b.v)::BIGINT AS score
  FROM e a JOIN e b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE a.vec_id % 100 = 0
),
p AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
)
SELECT anchor_id, positive_id,
       (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other))::INTEGER AS rank,
       other AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""


def whole_vectors(df: DataFrame) -> DataFrame:
    """The vectors as integers, with every seventh label moved on; odd vectors become null."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    scaled = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return df.select("vec_id", moved.alias("label"), F.when(finite, scaled).alias("embedding"))


@query("op11_onebit_negatives", SQL_NEGATIVES)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = whole_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return mine_negatives(vectors, F.col("vec_id") % 100 == 0)


# Windows and document word runs as texts, compared for equality; near ones by counting agreement.
SQL_DECONTAMINATE = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS ws
  FROM documents
),
b AS (
  SELECT item_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM benchmark WHERE text IS NOT NULL
),
iw AS (
  SELECT DISTINCT item_id, ws[i:i + 9] AS terms, array_to_string(ws[i:i + 9], ' ') AS win
  FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS i FROM b WHERE len(ws) > 0)
),
w AS (SELECT DISTINCT win, terms, len(terms) AS n FROM iw),
g AS (
  SELECT rid, i, n, array_to_string(ws[i:i + n - 1], ' ') AS win
  FROM (SELECT rid, ws, n, unnest(range(1, len(ws) - n + 2)) AS i
        FROM d, (SELECT DISTINCT n FROM w) l WHERE len(ws) >= n)
),
m AS (SELECT rid, i, n, win FROM g WHERE win IN (SELECT win FROM w)),
hit AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM m) GROUP BY rid),
found AS (SELECT DISTINCT rid, item_id FROM m JOIN iw USING (win) WHERE item_id IS NOT NULL),
listed AS (
  SELECT rid, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
  FROM found GROUP BY rid
),
k AS (SELECT win, n, unnest(terms) AS term, generate_subscripts(terms, 1) AS k FROM w),
dw AS (SELECT rid, unnest(ws) AS term, generate_subscripts(ws, 1) AS i FROM d),
r AS (
  SELECT k.win, any_value(n) AS n, arg_min(k.term, coalesce(c, 0)) AS term, arg_min(k.k, coalesce(c, 0)) AS k
  FROM k LEFT JOIN (SELECT term, count(*) AS c FROM dw GROUP BY term) USING (term) GROUP BY k.win
),
cand AS (
  SELECT DISTINCT rid, win, n, i - k + t AS s
  FROM dw JOIN r USING (term), (SELECT unnest(range(-2, 3)) AS t) steps
),
near AS (
  SELECT DISTINCT rid, win FROM (
    SELECT cand.rid, cand.win, s, cand.n, count(DISTINCT k.k) AS agreed
    FROM cand JOIN k ON cand.win = k.win
    JOIN dw ON dw.rid = cand.rid AND dw.term = k.term AND abs(dw.i - s - k.k) <= 2
    GROUP BY ALL
  ) WHERE agreed = n
),
close AS (
  SELECT rid, count(DISTINCT item_id) AS n_near_items FROM near JOIN iw USING (win) GROUP BY rid
)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated, coalesce(n_near_items, 0)::BIGINT AS n_near_items
FROM d LEFT JOIN hit USING (rid) LEFT JOIN listed USING (rid) LEFT JOIN close USING (rid)
"""


@query("op12_positional_decontamination", SQL_DECONTAMINATE)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    n_hit = F.size("hits").cast("bigint")
    return decontaminate(docs, items).select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
        F.size("near_items").cast("bigint").alias("n_near_items"),
    )


# Which characters make a run, and how often one is deleted.
RUN = r"[A-Za-zÀ-ÿ]+"
DELETED = 199
MIN_LENGTH, MIN_COUNT = 6, 5


def misspelt(doc_id: Column, run: Column) -> Column:
    """A run of a document with one code point deleted where the hash of both says so."""
    h = F.crc32(F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("")), run).cast("binary"))
    at = (h % F.char_length(run)).cast("int")
    shorter = F.concat(F.substr(run, F.lit(1), at), F.substr(run, at + 2))
    return F.when(h % DELETED == 0, shorter).otherwise(run)


def word_counts(docs: DataFrame) -> DataFrame:
    """``word, n`` of the words long and frequent enough."""
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all(lower, F.lit(RUN), F.lit(0))).alias("run"))
    # Shorter runs cannot become words.
    long = runs.where(F.char_length("run") >= MIN_LENGTH)
    words = long.select(misspelt(F.col("doc_id"), F.col("run")).alias("word"))
    counted = words.where(F.char_length("word") >= MIN_LENGTH).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= MIN_COUNT)


@query("op13_spelling_variants")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return spelling_variants(word_counts(docs)).select("word", "n", "n_near", "form", "form_n", "root")
