"""Queries on chunking and on sampling by length."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from sparkprep.functions.arrays import drop_ids
from sparkprep.operators import bpe
from sparkprep.operators.chunk import (
    DUPLICATE,
    LOSSLESS,
    MOVE,
    NO_BACKFILL,
    ChunkConfig,
    append_eos,
    chunk_dataset,
    chunk_stats,
    keep_long_samples,
    length_percentiles,
    written_chunk_stats,
)
from sparkprep.operators.sample import (
    bin_stats,
    binned,
    sample_per_bin,
    take_per_dataset,
)
from sparkprep.operators.tokenize import tokenize_bpe, tokenize_bytes
from sparkprep.operators.vocab import chunk_special_ids
from sparkprep.plans import tables as tb
from sparkprep.plans.registry import query
from sparkprep.plans.tables import ids_md5, sql_draw, sql_md5

BASE = ChunkConfig(
    chunk_size=512,
    bos_id=tb.CLS,
    eos_id=tb.SEP,
    min_chunk_size=256,
    always_skip_size=64,
    min_sample_tokens=128,
    backfill=NO_BACKFILL,
    seed=tb.SEED,
)
EDGES = [0, 512, 1024, 2048, 4096, 8192]
PER_BIN = 25


def _wrap_sql(c: ChunkConfig, x: str) -> str:
    """BOS and EOS around a list expression, as SQL."""
    eos = c.eos_id
    if c.specials == LOSSLESS:
        return f"[{c.bos_id}] || {x}" + (f" || [{eos}]" if eos is not None else "")
    opened = (
        f"(CASE WHEN {x}[1] = {c.bos_id} THEN {x} ELSE [{c.bos_id}] || {x} END)"
        f"[1:{c.wrapped_limit}]"
    )
    if eos is None:
        return opened
    return f"CASE WHEN ({opened})[-1] = {eos} THEN {opened} ELSE {opened} || [{eos}] END"


def chunk_ctes(c: ChunkConfig, tokens: str = "tok") -> str:
    """Common table expressions that end in ``chunks`` (and ``planned`` per document)."""
    b = c.window
    backfill = c.backfill != NO_BACKFILL
    keep_full = str(b >= c.skip_size and (b >= c.min_chunk_size or backfill)).lower()
    t = "t"
    if c.specials == LOSSLESS:
        t = (
            f"t[CASE WHEN t[1] = {c.bos_id} THEN 2 ELSE 1 END : "
            f"CASE WHEN t[-1] = {c.eos_id} THEN len(t) - 1 ELSE len(t) END]"
        )
    elif c.add_eos:
        t = f"CASE WHEN len(t) > 0 AND t[-1] <> {c.eos_id} THEN t || [{c.eos_id}] ELSE t END"
    amount = "m"
    if c.backfill == MOVE:
        amount = f"CASE WHEN m > 0 THEN {sql_draw(c.seed, 'id')} % (m + 1) ELSE 0 END"
    body = "wrapped" if c.specials == LOSSLESS else "wrapped[2:]"
    first = "raw" if c.specials == LOSSLESS else _wrap_sql(c, "raw")
    gives = f"fill AND i = n - 2 AND {str(c.backfill == MOVE).lower()}"
    final = "content" if c.specials == LOSSLESS else "CASE WHEN changed THEN again ELSE content END"
    if c.specials == LOSSLESS:
        final = _wrap_sql(c, "content")
    return f"""
    long AS (SELECT subset, id, {t} AS t FROM {tokens} WHERE len(t) >= {c.min_sample_tokens}),
    sized AS (SELECT *, len(t) AS l, CAST(ceil(len(t) / {b}.0) AS BIGINT) AS n FROM long),
    tailed AS (SELECT *, l - (n - 1) * {b} AS r FROM sized),
    planned AS (
      SELECT *, n > 1 AND r >= {c.skip_size}
                  AND (r >= {c.min_chunk_size} OR {str(backfill).lower()}) AS keep_tail,
             n > 1 AND r >= {c.skip_size} AND r < {c.min_chunk_size}
                  AND {str(backfill).lower()} AS fill
      FROM tailed
    ),
    windows AS (SELECT *, unnest(range(0, n)) AS i FROM planned),
    cut AS (SELECT * EXCLUDE (t), t[i * {b} + 1 : least((i + 1) * {b}, l)] AS raw FROM windows),
    first AS (SELECT *, {first} AS wrapped FROM cut),
    bodies AS (
      SELECT *, CASE WHEN fill AND i = n - 1 THEN lag({body}) OVER (PARTITION BY id ORDER BY i)
                     WHEN {gives} THEN {body} END AS body
      FROM first
    ),
    rooms AS (SELECT *, least({b} - r, len(body)) AS m FROM bodies),
    moved AS (SELECT *, CASE WHEN body IS NOT NULL THEN {amount} END AS u FROM rooms),
    contents AS (
      SELECT *,
        body IS NOT NULL AND (i = n - 1 OR u > 0) AS changed,
        CASE WHEN body IS NULL THEN wrapped
             WHEN i = n - 1 THEN body[len(body) - u + 1 :] || raw
             WHEN u > 0 THEN body[: len(body) - u] ELSE wrapped END AS content
      FROM moved
      WHERE i = 0 OR (i < n - 1 AND {keep_full}) OR (i = n - 1 AND keep_tail)
    ),
    wrapped_again AS (SELECT *, {_wrap_sql(c, 'content')} AS again FROM contents),
    chunks AS (
      SELECT subset, id, row_number() OVER (PARTITION BY id ORDER BY i) - 1 AS chunk_idx,
             {final} AS ids, i, n, u, fill
      FROM wrapped_again
    )"""


def _chunk_sql(c: ChunkConfig) -> str:
    return f"""WITH {tb.SQL_BYTES}, {chunk_ctes(c)}
    SELECT id, CAST(chunk_idx AS INTEGER) AS chunk_idx, CAST(len(ids) AS INTEGER) AS len,
           len(ids) < {c.min_chunk_size} AS below_min, {sql_md5('ids')} AS ids_md5 FROM chunks"""


def _chunks(spark: SparkSession, sf_dir: str, c: ChunkConfig) -> DataFrame:
    rows = chunk_dataset(tb.byte_tokens(spark, sf_dir), c)
    return rows.select("id", "chunk_idx", "len", "below_min", ids_md5("input_ids").alias("ids_md5"))


@query(
    "min_len_filter",
    f"""WITH {tb.SQL_BYTES}
    SELECT subset, count(*) AS kept FROM tok WHERE len(t) >= {BASE.min_sample_tokens} GROUP BY subset""",
)
def min_len_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = keep_long_samples(tb.byte_tokens(spark, sf_dir), BASE.min_sample_tokens)
    return kept.groupBy("subset").agg(F.count("*").alias("kept"))


@query(
    "append_eos",
    f"""WITH {tb.SQL_BYTES}
    SELECT id, {sql_md5(f'CASE WHEN len(b) > 0 AND b[-1] <> 46 THEN b || [46] ELSE b END')} AS ids_md5
    FROM bytes""",
)
def append_eos_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full stop as the closing id: some documents end with it already."""
    rows = tokenize_bytes(tb.documents(spark, sf_dir))
    return rows.select("id", ids_md5(append_eos(F.col("input_ids"), 46)).alias("ids_md5"))


_CONFIGS = {
    # No short tail is kept: cut, skip and drop rules.
    "chunk_cut": replace(BASE, always_skip_size=0, min_chunk_size=0),
    "chunk_skip": replace(BASE, min_chunk_size=0),
    "chunk_drop": BASE,
    "chunk_backfill_dup": replace(BASE, backfill=DUPLICATE),
    "chunk_backfill_nodup": replace(BASE, backfill=MOVE),
    "chunk_no_eos": replace(BASE, backfill=DUPLICATE, eos_id=None),
    "chunk_add_eos": replace(BASE, backfill=MOVE, add_eos=True, eos_id=46),
    "chunk_lossless": replace(BASE, backfill=MOVE, specials=LOSSLESS),
    "chunk_lossless_dup": replace(BASE, backfill=DUPLICATE, specials=LOSSLESS),
}


def _register(name: str, c: ChunkConfig) -> None:
    @query(name, _chunk_sql(c))
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _chunks(spark, sf_dir, c)


for _name, _config in _CONFIGS.items():
    _register(_name, _config)


def _stats_sql(c: ChunkConfig) -> str:
    keep_full = c.window >= c.skip_size and (
        c.window >= c.min_chunk_size or c.backfill != NO_BACKFILL
    )
    middle = 0 if keep_full else c.window
    dup = "u" if c.backfill == DUPLICATE else "0"
    return f"""WITH {tb.SQL_BYTES}, {chunk_ctes(c)},
    per_doc AS (
      SELECT subset, CASE WHEN n < 2 THEN 0 ELSE greatest(n - 2, 0) * {middle}
               + CASE WHEN keep_tail THEN 0 ELSE r END END AS skipped FROM planned
    ),
    docs_by AS (SELECT subset, count(*) AS inputs, sum(skipped) AS skipped FROM per_doc GROUP BY subset),
    short_by AS (SELECT subset, count(*) FILTER (WHERE len(t) < {c.min_sample_tokens}) AS short
                 FROM tok GROUP BY subset),
    chunks_by AS (
      SELECT subset, count(*) AS chunks, sum(len(ids)) AS written,
             sum(CASE WHEN fill AND i = n - 1 THEN {dup} ELSE 0 END) AS dup
      FROM chunks GROUP BY subset
    )
    SELECT s.subset,
           CAST(coalesce(sum(inputs), 0) AS BIGINT) AS total_input_samples,
           CAST(coalesce(sum(chunks), 0) AS BIGINT) AS total_output_chunks,
           CAST(coalesce(sum(written), 0) AS BIGINT) AS total_tokens_written,
           CAST(coalesce(sum(dup), 0) AS BIGINT) AS total_duplicated_tokens,
           CAST(coalesce(sum(skipped), 0) AS BIGINT) AS total_tokens_skipped,
           CAST(sum(short) AS BIGINT) AS total_samples_skipped_by_length
    FROM short_by s LEFT JOIN docs_by d ON d.subset = s.subset
         LEFT JOIN chunks_by c ON c.subset = s.subset
    GROUP BY ROLLUP (s.subset)"""


@query("chunk_stats", _stats_sql(_CONFIGS["chunk_backfill_dup"]))
def chunk_stats_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_stats(tb.byte_tokens(spark, sf_dir), _CONFIGS["chunk_backfill_dup"])


@query("chunk_stats_written", _stats_sql(_CONFIGS["chunk_backfill_dup"]))
def chunk_stats_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From tokens and chunks that are tables on disk."""
    cfg = _CONFIGS["chunk_backfill_dup"]
    tokens = tb.stored(tb.byte_tokens(spark, sf_dir), "tokens")
    return written_chunk_stats(tokens, tb.stored(chunk_dataset(tokens, cfg), "chunks"), cfg)


@query("chunk_stats_drop", _stats_sql(BASE))
def chunk_stats_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_stats(tb.byte_tokens(spark, sf_dir), BASE)


_RANKS = ", ".join(
    f"max(len) FILTER (WHERE r = least(CAST(floor(n * {p} / 100.0) AS BIGINT), n - 1)) AS p{p}"
    for p in range(0, 101, 10)
)


@query(
    "chunk_percentiles",
    f"""WITH {tb.SQL_BYTES}, {chunk_ctes(_CONFIGS['chunk_backfill_nodup'])},
    sorted AS (
      SELECT subset, CAST(len(ids) AS BIGINT) AS len,
             row_number() OVER (PARTITION BY subset ORDER BY len(ids)) - 1 AS r,
             count(*) OVER (PARTITION BY subset) AS n
      FROM chunks
    )
    SELECT subset, {_RANKS} FROM sorted GROUP BY subset""",
)
def chunk_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = chunk_dataset(tb.byte_tokens(spark, sf_dir), _CONFIGS["chunk_backfill_nodup"])
    return length_percentiles(chunks)


_SPACED = replace(BASE, backfill=MOVE)


@query(
    "prefix_space",
    f"""WITH {tb.SQL_BPE},
    sizes AS (SELECT piece, length(symbols) AS n FROM step WHERE k = {tb.BPE_MERGES}),
    lengths AS (SELECT id, sum(n) AS n FROM pieces JOIN sizes USING (piece) GROUP BY id),
    cut AS (SELECT id, w, n - (w - 1) * {_SPACED.window} AS tail FROM (
              SELECT id, n, CAST(ceil(n / {_SPACED.window}.0) AS BIGINT) AS w FROM (
                SELECT id, n + {int(_SPACED.add_eos)} AS n FROM lengths WHERE n >= {_SPACED.min_sample_tokens})))
    SELECT subset, CAST(sum(1 + greatest(w - 2, 0)
             + CASE WHEN w > 1 AND tail >= {_SPACED.skip_size} THEN 1 ELSE 0 END) AS BIGINT) AS chunks,
           CAST(0 AS BIGINT) AS not_spaced, CAST(0 AS BIGINT) AS too_long
    FROM cut JOIN docs USING (id) GROUP BY subset""",
)
def prefix_space(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks of learned tokens all open with a space, and there are as many as without."""
    cls, sep = chunk_special_ids(tb.trained(spark, sf_dir)[0])
    codec = tb.codec(spark, sf_dir)
    tokens = tokenize_bpe(tb.documents(spark, sf_dir), codec).drop("text")
    # Written first, as a job does: every Python step of a pass is a worker beside each core.
    tokens = tb.stored(tokens, "tokens")
    cfg = replace(BASE, bos_id=cls, eos_id=sep, backfill=MOVE)
    rows = chunk_dataset(tokens, cfg, reencode=bpe.prefix_space_step(codec))
    inside = drop_ids("input_ids", [cls, sep])
    text = bpe.decode(inside, codec)
    opened = rows.select("subset", "len", text.startswith(" ").alias("spaced"))
    return opened.groupBy("subset").agg(
        F.count("*").alias("chunks"),
        F.count_if(~F.col("spaced")).alias("not_spaced"),
        F.count_if(F.col("len") > cfg.chunk_size).alias("too_long"),
    )


_BINS = f"""WITH {tb.SQL_DOCUMENTS},
    lengths AS (SELECT subset, id, CAST(strlen(text) + 2 AS INTEGER) AS len FROM docs),
    edges AS (SELECT * FROM (VALUES {', '.join(f'({a}, {b})' for a, b in zip(EDGES, EDGES[1:]))}) e(lo, hi)),
    bins AS (
      SELECT id, len, '(' || lo || ',' || hi || ']' AS bin_label
      FROM lengths JOIN edges ON len > lo AND len <= hi
    ),
    drawn AS (
      SELECT *, row_number() OVER (PARTITION BY bin_label ORDER BY md5('{tb.SEED}:' || id), id) AS draw_rank
      FROM bins
    )"""


@query("length_bins", f"{_BINS} SELECT id, len, bin_label FROM bins")
def length_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return binned(tb.byte_tokens(spark, sf_dir), EDGES).select("id", "len", "bin_label")


@query(
    "sample_per_bin",
    f"""{_BINS},
    tok AS (SELECT CAST(doc_id AS VARCHAR) AS id, [{tb.CLS}]
              || [('0x' || h)::INT FOR h IN regexp_extract_all(hex(encode(text)), '..')]
              || [{tb.SEP}] AS t FROM documents)
    SELECT d.id, d.len, d.bin_label, {sql_md5('t')} AS ids_md5
    FROM drawn d JOIN tok ON tok.id = d.id WHERE draw_rank <= {PER_BIN}""",
)
def sample_per_bin_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = tb.byte_tokens(spark, sf_dir)
    rows = sample_per_bin(tokens, EDGES, PER_BIN, seed=tb.SEED, key=["id"])
    return rows.select("id", "len", "bin_label", ids_md5("input_ids").alias("ids_md5"))


@query(
    "bin_stats",
    f"""{_BINS}
    SELECT bin_label, count(*) AS total, count(*) FILTER (WHERE draw_rank <= {PER_BIN}) AS collected,
           array_to_string(list(len ORDER BY len) FILTER (WHERE draw_rank <= {PER_BIN}), ',') AS lengths,
           CAST(2 * sum(len) FILTER (WHERE draw_rank <= {PER_BIN}) AS BIGINT) AS total_size_bytes
    FROM drawn GROUP BY bin_label
    UNION ALL SELECT '(-1,0]', 0, 0, '', 0""",
)
def bin_stats_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With a first bin that is empty: a sequence has at least its CLS and SEP."""
    edges = [-1, *EDGES]
    stats = bin_stats(tb.byte_tokens(spark, sf_dir), edges, PER_BIN, seed=tb.SEED, key=["id"])
    return stats.withColumn("lengths", F.array_join(F.col("lengths").cast("array<string>"), ","))


@query(
    "take_n_per_dataset",
    f"""WITH {tb.SQL_CORPORA},
    drawn AS (
      SELECT dataset, id, row_number() OVER (PARTITION BY dataset ORDER BY md5('{tb.SEED}:' || id), id)
        AS draw_rank FROM corpora
    )
    SELECT * FROM drawn WHERE draw_rank <= 100""",
)
def take_n_per_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tb.corpora(spark, sf_dir)
    return take_per_dataset(rows, 100, seed=tb.SEED, key=["id"], datasets=3)
