"""Queries on scans, manifests, merging, splitting and incremental runs."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from sparkprep.functions.order import shuffled_rank
from sparkprep.operators import split as sp
from sparkprep.operators.chunk import LOSSLESS, NO_BACKFILL, ChunkConfig, chunk_dataset
from sparkprep.operators.tokenize import token_stats, tokenize_bytes, tokenize_with
from sparkprep.plans import jobs, tables as tb
from sparkprep.plans.registry import query
from sparkprep.session import scratch_path
from sparkprep.sources import datasets as ds, listed as lf, manifest as mf, sinks
from sparkprep.sources.shards import greedy_shards
from sparkprep.streaming import incremental as inc

TRAIN, VAL, SMALL = 0.8, 0.2, 0.15
LINES = 700
DATASETS = ["conversations", "documents", "benchmark"]
SUBSET = "000_00003"
_KEYS = "dataset || ':' || subset || ':' || shard_id"


# ---- scans -------------------------------------------------------------------


@query(
    "merge_datasets",
    f"WITH {tb.SQL_CORPORA} SELECT dataset, subset, sample_idx, id, md5(text) AS text_md5 FROM corpora",
)
def merge_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tb.corpora(spark, sf_dir)
    return rows.select("dataset", "subset", "sample_idx", "id", F.md5("text").alias("text_md5"))


@query(
    "subset_filter",
    f"WITH {tb.SQL_DOCUMENTS} SELECT id, md5(text) AS text_md5 FROM docs WHERE subset = '{SUBSET}'",
)
def subset_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From a dataset on disk, where the filter prunes folders."""
    path = scratch_path(spark, "subsets")
    sinks.write_subsets(tb.documents(spark, sf_dir), path)
    rows = ds.subset_filter(ds.read_dataset(spark, path), SUBSET)
    return rows.select("id", F.md5("text").alias("text_md5"))


@query(
    "limit_lines",
    f"""WITH {tb.SQL_CORPORA},
    placed AS (
      SELECT *, row_number() OVER (ORDER BY
        CASE dataset WHEN 'conversations' THEN 0 WHEN 'documents' THEN 1 ELSE 2 END,
        CASE WHEN dataset = 'documents' THEN '' ELSE subset END,
        CASE WHEN dataset = 'documents' THEN subset END DESC, sample_idx) AS r
      FROM corpora
    )
    SELECT dataset, subset, id FROM placed WHERE r <= {LINES}""",
)
def limit_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ds.limit_lines(
        tb.corpora(spark, sf_dir), LINES, datasets=DATASETS, descending=["documents"]
    )
    return rows.select("dataset", "subset", "id")


@query(
    "shuffled_scan",
    f"""WITH {tb.SQL_CORPORA}
    SELECT dataset, id, row_number() OVER (ORDER BY md5('{tb.SEED}:' || dataset || ':' || id), dataset, id)
      AS position FROM corpora""",
)
def shuffled_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tb.corpora(spark, sf_dir).select("dataset", "id")
    return shuffled_rank(rows, seed=tb.SEED, key=["dataset", "id"], rank="position")


@query("jsonl_scan", f"WITH {tb.SQL_CORPORA} SELECT md5(text) AS text_md5 FROM corpora")
def jsonl_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "jsonl")
    tb.corpora(spark, sf_dir).select("id", "text").write.json(path)
    return ds.read_jsonl(spark, path).select(F.md5("text").alias("text_md5"))


# ---- manifests ---------------------------------------------------------------


@query(
    "shard_by_bytes",
    f"WITH {tb.SQL_SHARDS} SELECT dataset, subset, sample_idx, shard_id FROM shard_rows",
)
def shard_by_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tb.shard_rows(spark, sf_dir)
    return rows.select("dataset", "subset", "sample_idx", "shard_id")


@query(
    "shard_manifest",
    f"WITH {tb.SQL_SHARDS} SELECT dataset, subset, shard_id, samples, bytes FROM manifest",
)
def shard_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tb.manifest(spark, sf_dir)


def _sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tb.corpora(spark, sf_dir).select(
        "dataset", "subset", "sample_idx", F.octet_length("text").cast("bigint").alias("nbytes")
    )


@query(
    "shard_greedy",
    f"WITH {tb.SQL_GREEDY_SHARDS} SELECT dataset, subset, sample_idx, nbytes, shard_id FROM greedy",
)
def shard_greedy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards that never exceed the limit, cut over many small blocks."""
    return greedy_shards(_sizes(spark, sf_dir), F.col("nbytes"), tb.SHARD_LIMIT, cut_rows=64)


@query(
    "shard_greedy_manifest",
    f"""WITH {tb.SQL_GREEDY_SHARDS}
    SELECT dataset, subset, shard_id, count(*) AS samples, CAST(sum(nbytes) AS BIGINT) AS bytes
    FROM greedy GROUP BY ALL""",
)
def shard_greedy_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = greedy_shards(_sizes(spark, sf_dir), F.col("nbytes"), tb.SHARD_LIMIT)
    return mf.build_manifest(placed, F.col("nbytes"))


@query(
    "shard_fingerprint",
    f"""WITH {tb.SQL_SHARDS}
    SELECT dataset, subset, shard_id, count(*) AS samples,
           bit_xor(CAST('0x' || substr(md5(sample_idx || chr(1) || id || chr(1) || text), 1, 15) AS BIGINT))
             AS fingerprint
    FROM shard_rows GROUP BY ALL""",
)
def shard_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tb.corpora(spark, sf_dir).select(
        "dataset",
        "subset",
        "sample_idx",
        F.octet_length("text").alias("nbytes"),
        mf.row_fingerprint("sample_idx", "id", "text").alias("row_fingerprint"),
    )
    return mf.shard_fingerprints(mf.assign_shards(rows, F.col("nbytes"), tb.SHARD_LIMIT))


@query(
    "count_samples",
    f"""WITH {tb.SQL_SHARDS}
    SELECT dataset, subset, count(*) AS shards, CAST(sum(samples) AS BIGINT) AS samples
    FROM manifest GROUP BY ROLLUP (dataset, subset)""",
)
def count_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mf.count_samples(tb.manifest(spark, sf_dir))


@query(
    "by_global_index",
    f"""WITH {tb.SQL_SHARDS}
    SELECT row_number() OVER (ORDER BY dataset, subset, sample_idx) - 1 AS index,
           dataset, subset, shard_id,
           row_number() OVER (PARTITION BY dataset, subset, shard_id ORDER BY sample_idx) - 1 AS "offset"
    FROM shard_rows""",
)
def by_global_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sample number of the corpus, looked up in the manifest."""
    rows = tb.corpora(spark, sf_dir).count()
    indices = spark.range(rows).withColumnRenamed("id", "index")
    return mf.locate_indices(indices, tb.manifest(spark, sf_dir))


def _written(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """The corpora written as subset folders, with the manifest of their files."""
    path = scratch_path(spark, "corpus")
    sinks.write_subsets(tb.corpora(spark, sf_dir), path)
    rows = mf.with_file_shards(ds.read_dataset(spark, path))
    return path, mf.file_manifest(rows)


def _listing(spark: SparkSession, path: str) -> DataFrame:
    files = mf.list_files(spark, path, "*.parquet")
    folder = F.regexp_extract("dataset_path", r"dataset=([^/]+)$", 1)
    return files.withColumn("dataset", folder)


@query(
    "write_subsets",
    f"""WITH {tb.SQL_CORPORA}
    SELECT dataset, subset, count(*) AS samples, CAST(sum(strlen(text)) AS BIGINT) AS bytes
    FROM corpora GROUP BY ALL""",
)
def write_subsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, _ = _written(spark, sf_dir)
    return ds.read_dataset(spark, path).groupBy("dataset", "subset").agg(
        F.count("*").alias("samples"), F.sum(F.octet_length("text")).alias("bytes")
    )


@query(
    "verify_structure",
    f"""WITH {tb.SQL_CORPORA}
    SELECT dataset, dataset <> 'documents' AS valid, count(DISTINCT subset) AS total_subsets,
           count(*) AS total_samples,
           CASE WHEN dataset = 'documents' THEN count(DISTINCT subset) ELSE 0 END AS issues
    FROM corpora GROUP BY dataset""",
)
def verify_structure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of one dataset names a file per subset that the folder does not hold."""
    path, manifest = _written(spark, sf_dir)
    lost = manifest.where(F.col("dataset") == "documents").select(
        "dataset", "subset", F.concat(F.lit("lost-"), "subset").alias("basename"),
        F.lit(0).cast("bigint").alias("samples"), F.lit(0).cast("bigint").alias("bytes"),
    ).distinct()
    listed = manifest.unionByName(lost)
    return mf.verify_structure(listed, _listing(spark, path)).drop("total_shards")


@query(
    "structure_issues",
    f"""WITH {tb.SQL_CORPORA}
    SELECT DISTINCT dataset, subset, 'missing shard file: lost-' || subset AS issue FROM corpora""",
)
def structure_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest names one more file per subset than the folder holds."""
    path, manifest = _written(spark, sf_dir)
    lost = manifest.select(
        "dataset", "subset", F.concat(F.lit("lost-"), "subset").alias("basename")
    ).distinct()
    listed = manifest.select("dataset", "subset", "basename").unionByName(lost)
    return mf.structure_issues(listed, _listing(spark, path))


@query(
    "corpus_summary",
    f"""WITH {tb.SQL_CORPORA},
    expected AS (SELECT * FROM (VALUES ('documents'), ('conversations'), ('benchmark'), ('absent')) e(dataset)),
    found AS (SELECT dataset, count(DISTINCT subset) AS subsets, count(*) AS samples
              FROM corpora GROUP BY dataset)
    SELECT e.dataset, CAST(coalesce(sum(subsets), 0) AS BIGINT) AS subsets,
           CAST(coalesce(sum(samples), 0) AS BIGINT) AS samples,
           CAST(count(*) FILTER (WHERE f.dataset IS NULL) AS BIGINT) AS failed
    FROM expected e LEFT JOIN found f ON f.dataset = e.dataset GROUP BY ROLLUP (e.dataset)""",
)
def corpus_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, manifest = _written(spark, sf_dir)
    names = [(n,) for n in ("documents", "conversations", "benchmark", "absent")]
    expected = spark.createDataFrame(names, "dataset string")
    return mf.corpus_summary(expected, manifest, _listing(spark, path)).drop("shards")


def _index_files(spark: SparkSession, sf_dir: str) -> str:
    """One manifest file per subset folder, in the nested form, as Spark names it."""
    root = scratch_path(spark, "index")
    shards = tb.manifest(spark, sf_dir)
    entry = F.struct(
        F.lit("mds").alias("format"),
        F.lit(2).alias("version"),
        F.col("samples"),
        F.lit("zstd").alias("compression"),
        F.struct(
            F.concat(F.lit("shard."), F.lpad(F.col("shard_id").cast("string"), 5, "0"), F.lit(".mds")).alias(
                "basename"
            ),
            F.col("bytes"),
        ).alias("raw_data"),
        F.when(
            F.col("dataset") == "documents", F.struct(F.lit("shard.zstd").alias("basename"))
        ).alias("zip_data"),
    )
    one = shards.groupBy("dataset", "subset").agg(
        F.sort_array(F.collect_list(F.struct("shard_id", entry.alias("e")))).alias("s")
    )
    text = F.to_json(F.struct(F.lit(2).alias("version"), F.col("s.e").alias("shards")))
    one.select("dataset", "subset", text.alias("value")).write.partitionBy(
        "dataset", "subset"
    ).text(root)
    return root


@query(
    "load_index_files",
    f"""WITH {tb.SQL_SHARDS}
    SELECT subset, row_number() OVER (PARTITION BY dataset, subset ORDER BY shard_id) - 1 AS shard_id,
           samples, 'shard.' || lpad(CAST(shard_id AS VARCHAR), 5, '0') || '.mds' AS basename, bytes
    FROM manifest""",
)
def load_index_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = mf.read_index_files(spark, _index_files(spark, sf_dir), "*.txt")
    return shards.select(
        "subset",
        F.col("shard_id").cast("bigint").alias("shard_id"),
        "samples",
        F.col("raw_data.basename").alias("basename"),
        F.col("raw_data.bytes").alias("bytes"),
    )


@query(
    "compression_detection",
    f"""WITH {tb.SQL_SHARDS}
    SELECT DISTINCT subset, dataset = 'documents' AS compressed FROM manifest""",
)
def compression_detection(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = mf.read_index_files(spark, _index_files(spark, sf_dir), "*.txt")
    return mf.is_compressed(shards).select("subset", "compressed")


@query(
    "discover_subsets",
    f"WITH {tb.SQL_CORPORA} SELECT DISTINCT subset FROM corpora",
)
def discover_subsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mf.discover_subsets(spark, _index_files(spark, sf_dir), "*.txt").select("subset")


# ---- merge and split ---------------------------------------------------------

_SPLIT = f"""WITH {tb.SQL_SHARDS},
    ranked AS (
      SELECT *, row_number() OVER (ORDER BY md5('{tb.SEED}:' || {_KEYS}), dataset, subset, shard_id) AS r,
             count(*) OVER () AS n FROM manifest
    ),
    sized AS (SELECT *, CAST(floor(n * {TRAIN}::DOUBLE) AS BIGINT) AS tc FROM ranked),
    split AS (
      SELECT dataset, subset, shard_id, samples, bytes,
             CASE WHEN r <= tc THEN 'train' ELSE 'val' END AS split,
             r <= CASE WHEN tc > 0 THEN greatest(1, CAST(floor(tc * {SMALL}::DOUBLE) AS BIGINT)) ELSE 0 END
               AS in_train_small,
             CASE WHEN r <= tc THEN r ELSE r - tc END AS position
      FROM sized
    ),
    labelled AS (
      SELECT dataset, subset, shard_id, samples, bytes, split, position FROM split UNION ALL
      SELECT dataset, subset, shard_id, samples, bytes, 'train_small', position FROM split
      WHERE in_train_small
    )"""


def _split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sp.split_manifest(
        tb.manifest(spark, sf_dir),
        train_ratio=TRAIN,
        val_ratio=VAL,
        small_ratio=SMALL,
        seed=tb.SEED,
    )


@query("split_train_val", f"{_SPLIT} SELECT * FROM split")
def split_train_val(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split(spark, sf_dir)


@query("train_small", f"{_SPLIT} SELECT * FROM labelled WHERE split = 'train_small'")
def train_small(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sp.with_small(_split(spark, sf_dir)).where(F.col("split") == "train_small")


@query(
    "only_train_small",
    f"""{_SPLIT}
    SELECT dataset, subset, shard_id, samples, bytes, 'train_small' AS split, r AS position
    FROM ranked WHERE r <= greatest(1, CAST(floor(n * {SMALL}::DOUBLE) AS BIGINT))""",
)
def only_train_small(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sp.only_train_small(tb.manifest(spark, sf_dir), small_ratio=SMALL, seed=tb.SEED)


@query(
    "split_summary",
    f"""{_SPLIT}
    SELECT split, count(*) AS shards, CAST(sum(samples) AS BIGINT) AS samples FROM labelled GROUP BY split""",
)
def split_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sp.split_summary(sp.with_small(_split(spark, sf_dir)))


@query(
    "split_rows",
    f"""{_SPLIT}
    SELECT w.dataset, w.id, md5(text) AS text_md5 FROM shard_rows w
    WHERE EXISTS (SELECT 1 FROM labelled l WHERE l.split = 'val' AND l.dataset = w.dataset
                  AND l.subset = w.subset AND l.shard_id = w.shard_id)""",
)
def split_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = sp.with_small(_split(spark, sf_dir))
    # The digest of a text travels to its shard, the text does not.
    rows = tb.corpora(spark, sf_dir).select(
        "dataset", "subset", "sample_idx", "id",
        F.octet_length("text").alias("nbytes"), F.md5("text").alias("text_md5"),
    )
    placed = mf.assign_shards(rows, F.col("nbytes"), tb.SHARD_LIMIT)
    return sp.rows_of_split(placed, labelled, "val").select("dataset", "id", "text_md5")


@query(
    "split_rows_hash",
    f"""WITH {tb.SQL_CORPORA},
    drawn AS (SELECT dataset, id, {tb.sql_draw(tb.SEED, "dataset || ':' || id")} / 4294967296.0::DOUBLE AS u
              FROM corpora)
    SELECT dataset, id, CASE WHEN u < {TRAIN}::DOUBLE THEN 'train' ELSE 'val' END AS split,
           u < {TRAIN}::DOUBLE * {SMALL}::DOUBLE AS in_train_small FROM drawn""",
)
def split_rows_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tb.corpora(spark, sf_dir).select("dataset", "id")
    return sp.split_rows(
        rows, train_ratio=TRAIN, val_ratio=VAL, small_ratio=SMALL, seed=tb.SEED, key=["dataset", "id"]
    )


@query(
    "merged_manifest",
    f"""{_SPLIT}
    SELECT *, 'shard.' || lpad(CAST(position - 1 AS VARCHAR), 5, '0') AS new_name FROM labelled""",
)
def merged_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written as JSON lines and read back."""
    path = scratch_path(spark, "manifest")
    labelled = sinks.renumbered(sp.with_small(_split(spark, sf_dir)), "position")
    sinks.write_manifest(labelled, path)
    return spark.read.schema(labelled.schema).json(path)


# ---- incremental runs --------------------------------------------------------
# `labels` names the documents an earlier run has finished. A source's name decides what that
# run left of it: everything, the labelled documents, nothing, or everything twice.

_DONE = f"""WITH {tb.SQL_DOCUMENTS},
    expected AS (SELECT dataset, source AS subset, count(*) AS samples,
                 CAST('0x' || substr(md5(source), 1, 1) AS INTEGER) % 4 AS pick FROM docs GROUP BY ALL),
    labelled AS (SELECT d.dataset, d.source AS subset, count(*) AS n FROM docs d
                 JOIN labels l ON l.doc_id = d.sample_idx WHERE l.quality = 1 GROUP BY ALL),
    state AS (SELECT dataset, subset, samples,
              CASE pick WHEN 0 THEN samples WHEN 1 THEN coalesce(n, 0) WHEN 3 THEN 2 * samples ELSE 0 END AS p
              FROM expected LEFT JOIN labelled USING (dataset, subset)),
    judged AS (SELECT dataset, subset, samples, CAST(p AS BIGINT) AS samples_processed,
               CASE WHEN p = samples THEN 'complete' WHEN p > samples THEN 'possibly_corrupt'
                    WHEN p > 0 THEN 'resumable' ELSE 'new' END AS status FROM state)"""


def _finished(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = tb.table(spark, sf_dir, "labels").where(F.col("quality") == 1)
    return labels.select(F.col("doc_id").cast("string").alias("id"))


@query(
    "resume_status",
    f"{_DONE} SELECT * FROM judged",
)
def resume_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tb.languages(spark, sf_dir).select(
        F.lit("documents").alias("dataset"), F.col("dataset").alias("subset"), "id"
    )
    expected = docs.groupBy("dataset", "subset").agg(F.count("*").alias("samples"))
    pick = F.conv(F.substring(F.md5("subset"), 1, 1), 16, 10).cast("int") % 4
    labelled = docs.where(pick == 1).join(_finished(spark, sf_dir), "id", "left_semi")
    twice = docs.where(pick == 3)
    output = docs.where(pick == 0).union(labelled.select(docs.columns)).union(twice).union(twice)
    return inc.resume_status(expected, inc.output_state(expected, output))


@query(
    "resume_summary",
    f"{_DONE} SELECT status, count(*) AS subsets FROM judged GROUP BY status",
)
def resume_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inc.status_summary(resume_status(spark, sf_dir))


@query(
    "resume_pending",
    f"""WITH {tb.SQL_DOCUMENTS}
    SELECT subset, id, md5(text) AS text_md5 FROM docs
    WHERE sample_idx NOT IN (SELECT doc_id FROM labels WHERE quality = 1)""",
)
def resume_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    pending = inc.pending_rows(tb.documents(spark, sf_dir), _finished(spark, sf_dir), ["id"])
    return pending.select("subset", "id", F.md5("text").alias("text_md5"))


@query(
    "incremental_tokenize",
    f"""WITH {tb.SQL_CORPORA}
    SELECT dataset, subset, CAST(sum(strlen(text)) AS BIGINT) AS num_tokens, count(*) AS num_samples
    FROM corpora GROUP BY ROLLUP (dataset, subset)""",
)
def incremental_tokenize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files arrive in two deliveries; each is tokenized once, by a run of its own."""
    source, target, state = (scratch_path(spark, n) for n in ("inbox", "tokens", "state"))

    def tokenize(rows: DataFrame) -> DataFrame:
        return tokenize_bytes(rows).drop("text")

    deliveries = [
        tb.documents(spark, sf_dir),
        tb.conversations(spark, sf_dir).unionByName(tb.benchmark(spark, sf_dir)),
    ]
    for delivery in deliveries:
        delivery.write.mode("append").parquet(source)
        inc.run_incremental(spark, source, target, state, tokenize)
    # Nothing new has arrived: this run must add nothing.
    inc.run_incremental(spark, source, target, state, tokenize)
    return token_stats(spark.read.parquet(target), by=["dataset", "subset"])


@query(
    "stats_sinks",
    f"""WITH {tb.SQL_DOCUMENTS}
    SELECT subset, CAST(sum(strlen(text)) AS BIGINT) AS num_tokens, count(*) AS num_samples
    FROM docs GROUP BY ROLLUP (subset)""",
)
def stats_sinks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics written as JSON and CSV, read back from both and found equal."""
    stats = token_stats(tokenize_bytes(tb.documents(spark, sf_dir)))
    base = scratch_path(spark, "stats")
    sinks.write_stats(stats, os.path.join(base, "json"))
    sinks.write_stats(stats, os.path.join(base, "csv"), "csv")
    as_json = spark.read.schema(stats.schema).json(os.path.join(base, "json"))
    as_csv = spark.read.schema(stats.schema).option("header", "true").csv(os.path.join(base, "csv"))
    return as_json.intersectAll(as_csv)


# ---- whole jobs --------------------------------------------------------------


def _plain(spark: SparkSession, sf_dir: str) -> str:
    """The documents as a dataset without subset folders; its folder is named ``root``."""
    path = os.path.join(scratch_path(spark, "plain"), "root")
    tb.documents(spark, sf_dir).select("sample_idx", "id", "text").write.parquet(path)
    return path


def _half_tokenized(spark: SparkSession, source: str) -> str:
    """Tokens of every second sample, as an interrupted run leaves them."""
    target = scratch_path(spark, "tokens")
    rows = ds.read_dataset(spark, source, "root").where("sample_idx % 2 = 0")
    tokens = tokenize_bytes(rows).select("dataset", "subset", "sample_idx", "id", "input_ids", "len")
    sinks.write_subsets(tokens, target)
    return target


@query(
    "root_level_tokenize",
    f"""WITH {tb.SQL_DOCUMENTS}, plain AS (SELECT 'root' AS dataset, 'unnamed' AS subset, text FROM docs)
    SELECT dataset, subset, CAST(sum(strlen(text)) AS BIGINT) AS num_tokens, count(*) AS num_samples,
           count(*) AS output_samples
    FROM plain GROUP BY ROLLUP (dataset, subset)""",
)
def root_level_tokenize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dataset without subsets, tokenized half and then resumed."""
    source = _plain(spark, sf_dir)
    target = _half_tokenized(spark, source)
    stats = jobs.tokenize_job(spark, source, target, tokenize_bytes, resume=True)
    return stats.drop("output_size")


@query(
    "root_level_shards",
    f"""WITH {tb.SQL_DOCUMENTS},
    placed AS (SELECT strlen(text) AS n, CAST(floor((greatest(sum(strlen(text)) OVER (ORDER BY sample_idx), 1)
               - 1) / {tb.SHARD_LIMIT}) AS BIGINT) AS shard_id FROM docs)
    SELECT shard_id, count(*) AS samples, CAST(sum(n) AS BIGINT) AS bytes FROM placed GROUP BY shard_id""",
)
def root_level_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards of rows whose subset is null."""
    rows = tb.documents(spark, sf_dir).select(
        F.lit("root").alias("dataset"), F.lit(None).cast("string").alias("subset"), "sample_idx",
        F.octet_length("text").alias("nbytes"),
    )
    placed = mf.assign_shards(rows, F.col("nbytes"), tb.SHARD_LIMIT)
    return mf.build_manifest(placed, F.col("nbytes")).select("shard_id", "samples", "bytes")


@query(
    "root_level_sample_split",
    f"""WITH {tb.SQL_DOCUMENTS}, sizes AS (SELECT strlen(text) AS n FROM docs)
    SELECT 'sampled' AS step, least(9, count(*) FILTER (WHERE n > 0 AND n <= 1000))
           + least(9, count(*) FILTER (WHERE n > 1000 AND n <= 50000)) AS samples FROM sizes
    UNION ALL SELECT 'split', count(*) FROM sizes""",
)
def root_level_sample_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampling and splitting the tokens of a dataset without subsets."""
    source = _plain(spark, sf_dir)
    target = _half_tokenized(spark, source)
    jobs.tokenize_job(spark, source, target, tokenize_bytes, resume=True)
    edges = [0, 1000, 50_000]
    sampled = jobs.sample_job(spark, target, scratch_path(spark, "sampled"), edges, 9)
    split = jobs.split_job(spark, [target], scratch_path(spark, "split"))
    parts = split.where("split in ('train', 'val')")
    return sampled.agg(F.lit("sampled").alias("step"), F.sum("collected").alias("samples")).unionByName(
        parts.agg(F.lit("split").alias("step"), F.sum("samples").alias("samples"))
    )


class _NoBars:
    """A tokenizer that gives the code points of a text and refuses one with a bar."""

    def tokenize_batch(self, texts: list[str]) -> list[list[int]]:
        if any("|" in t for t in texts):
            raise ValueError("bar in text")
        return [[ord(c) for c in t] for t in texts]


@query(
    "tokenize_job_failures",
    f"""WITH {tb.SQL_DOCUMENTS}
    SELECT subset, count(*) FILTER (WHERE text NOT LIKE '%|%') AS written,
           count(*) FILTER (WHERE text LIKE '%|%') AS rejected FROM docs GROUP BY subset""",
)
def tokenize_job_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected texts are kept apart, and a resumed run finds nothing to add."""
    source, target = scratch_path(spark, "texts"), scratch_path(spark, "tokens")
    sinks.write_subsets(tb.documents(spark, sf_dir), source)

    def tokenize(rows: DataFrame) -> DataFrame:
        return tokenize_with(rows, _NoBars, errors="record")

    jobs.tokenize_job(spark, source, target, tokenize)
    jobs.tokenize_job(spark, source, target, tokenize, resume=True)
    written = ds.read_dataset(spark, target).groupBy("subset").agg(F.count("*").alias("written"))
    failed = spark.read.parquet(target + "_failures").select("subset", "id").distinct()
    rejected = failed.groupBy("subset").agg(F.count("*").alias("rejected"))
    return written.join(rejected, "subset", "full").select(
        "subset", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("written", "rejected")]
    )


# ---- jobs that go on after failures ------------------------------------------

# Ids repeat and are missing; a sample is known by its place in its subset.
_ODD_IDS = "CASE WHEN sample_idx % 10 <> 0 THEN CAST(sample_idx // 3 AS VARCHAR) END"


def _odd_ids(spark: SparkSession, sf_dir: str) -> str:
    """The documents with repeated and null ids, as subset folders of several files each."""
    path = scratch_path(spark, "odd-ids")
    number = F.floor(F.col("sample_idx") / 3).cast("string")
    docs = tb.documents(spark, sf_dir).withColumn("id", F.when(F.col("sample_idx") % 10 != 0, number))
    sinks.write_subsets(docs, path)
    return path


@query(
    "resume_repeated_ids",
    f"""WITH {tb.SQL_DOCUMENTS}
    SELECT subset, sample_idx, {_ODD_IDS} AS id, CAST(strlen(text) AS INTEGER) AS len FROM docs""",
)
def resume_repeated_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of every subset is tokenized, then the job resumes."""
    source, target = _odd_ids(spark, sf_dir), scratch_path(spark, "tokens")
    half = tokenize_bytes(ds.read_dataset(spark, source).where("sample_idx % 2 = 0"))
    sinks.write_subsets(half.select("dataset", "subset", "sample_idx", "id", "input_ids", "len"), target)
    jobs.tokenize_job(spark, source, target, tokenize_bytes, resume=True)
    return ds.read_dataset(spark, target).select("subset", "sample_idx", "id", "len")


@query(
    "sample_repeated_ids",
    f"""WITH {tb.SQL_DOCUMENTS}, sizes AS (SELECT strlen(text) AS n FROM docs)
    SELECT least(25, count(*) FILTER (WHERE n > 0 AND n <= 1000))
           + least(25, count(*) FILTER (WHERE n > 1000 AND n <= 50000)) AS samples FROM sizes""",
)
def sample_repeated_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sample holds as many rows as asked for, whatever their ids."""
    source, target, sample = _odd_ids(spark, sf_dir), scratch_path(spark, "tokens"), scratch_path(spark, "sample")
    jobs.tokenize_job(spark, source, target, tokenize_bytes)
    jobs.sample_job(spark, target, sample, [0, 1000, 50_000], 25)
    return spark.read.parquet(sample).agg(F.count("*").alias("samples"))


@query(
    "tokenize_isolated",
    f"""WITH {tb.SQL_DOCUMENTS}
    SELECT subset, CASE WHEN subset = '{SUBSET}' THEN 'failed' ELSE 'done' END AS status,
           CASE WHEN subset <> '{SUBSET}' THEN count(*) END AS samples,
           CASE WHEN subset <> '{SUBSET}' THEN CAST(sum(strlen(text)) AS BIGINT) END AS num_tokens
    FROM docs GROUP BY subset""",
)
def tokenize_isolated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One subset gets ids beyond 16 bits: its job fails, the others are written."""
    source, target = _odd_ids(spark, sf_dir), scratch_path(spark, "tokens")

    def tokenize(rows: DataFrame) -> DataFrame:
        wide = F.when(F.col("subset") == SUBSET, F.array(F.lit(1 << 16))).otherwise(F.col("input_ids"))
        return tokenize_bytes(rows).withColumn("input_ids", wide)

    stats = jobs.tokenize_job(spark, source, target, tokenize, max_parallel=3)
    status = spark.read.parquet(target + "_status").select("subset", "status", "samples")
    return status.join(stats.where("dataset is not null").select("subset", "num_tokens"), "subset", "left")


BATCHES = 3


@query(
    "chunk_in_batches",
    f"""WITH {tb.SQL_DOCUMENTS}
    SELECT subset, count(*) AS documents, CAST(sum(strlen(text)) AS BIGINT) AS tokens,
           CAST(sum(ceil(strlen(text) / 62.0)) AS BIGINT) AS chunks
    FROM docs GROUP BY subset""",
)
def chunk_in_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens and chunks written batch by batch; each run is stopped once and goes on."""
    source, tokens, chunks, state = (scratch_path(spark, n) for n in ("texts", "tokens", "chunks", "state"))
    sinks.write_subsets(tb.documents(spark, sf_dir), source)
    cfg = ChunkConfig(
        64, bos_id=256, eos_id=257, min_chunk_size=0, always_skip_size=0, backfill=NO_BACKFILL, specials=LOSSLESS
    )
    keep = ("dataset", "subset")

    def tokenize(rows: DataFrame) -> DataFrame:
        return tokenize_bytes(rows).drop("text")

    def twice(path: str, out: str, step, schema) -> None:
        """Stop in the second batch, after some of its rows may be written, and run again."""
        seen: list[int] = []
        # A few batches, however many files there are: each is wide enough for all cores.
        files = max(3, lf.located_files(spark, path).count() // BATCHES)

        def stops(rows: DataFrame) -> DataFrame:
            seen.append(1)
            if len(seen) == 2:
                return step(rows).withColumn("len", F.raise_error(F.lit("stopped")).cast("int"))
            return step(rows)

        try:
            inc.run_batches(spark, path, out, out + "_state", stops, schema=schema, files_per_batch=files)
        except Exception as problem:
            if "stopped" not in str(problem):
                raise
        inc.run_batches(spark, path, out, out + "_state", step, schema=schema, files_per_batch=files)

    twice(source, tokens, tokenize, inc.CORPUS_SCHEMA)
    made = inc.read_batches(spark, tokens)
    schema = ds.read_dataset(spark, tokens).schema
    twice(tokens, chunks, lambda df: chunk_dataset(df.drop(inc.BATCH), cfg, keep=keep), schema)
    cut = inc.read_batches(spark, chunks).groupBy("subset").agg(F.count("*").alias("chunks"))
    totals = made.groupBy("subset").agg(
        F.count("*").alias("documents"), F.sum("len").cast("bigint").alias("tokens")
    )
    return totals.join(cut, "subset")


# ---- scans by manifest, digests ----------------------------------------------


@query(
    "split_scan",
    f"""WITH {tb.SQL_DOCUMENTS}
    SELECT subset, count(*) AS samples, CAST(sum(strlen(text)) AS BIGINT) AS bytes, 2 AS files
    FROM docs GROUP BY subset""",
)
def split_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train and validation, each read from its own files: together every row, once."""
    source = scratch_path(spark, "texts")
    half = F.col("sample_idx") % (2 * tb.SUBSETS) < tb.SUBSETS
    for part in (half, ~half):
        # One file of a subset is one task's; every subset has a task of its own.
        rows = tb.documents(spark, sf_dir).where(part).repartitionByRange(2 * tb.SUBSETS, "subset")
        sinks.write_subsets(rows, source, mode="append", rebalance=False)
    files = lf.located_files(spark, source).withColumn("samples", F.lit(1))
    labelled = sp.split_manifest(files, train_ratio=TRAIN, val_ratio=VAL, seed=tb.SEED, key=lf.FILE_KEY)
    rows = [
        lf.read_split(spark, [source], labelled, name).select(
            "subset", F.octet_length("text").alias("n"), F.col("_metadata.file_path").alias("f")
        )
        for name in ("train", "val")
    ]
    return rows[0].unionByName(rows[1]).groupBy("subset").agg(
        F.count("*").alias("samples"),
        F.sum("n").cast("bigint").alias("bytes"),
        F.countDistinct("f").cast("int").alias("files"),
    )


@query(
    "shard_digests",
    f"""WITH {tb.SQL_GREEDY_SHARDS},
    rows_of AS (
      SELECT g.dataset, g.subset, g.shard_id, g.sample_idx,
             sha256(coalesce(strlen(c.id) || ':' || c.id, '-') || coalesce(strlen(c.text) || ':' || c.text, '-')) AS d
      FROM greedy g JOIN corpora c USING (dataset, subset, sample_idx)
    )
    SELECT dataset, subset, shard_id, count(*) AS samples, sha256(string_agg(d, '' ORDER BY sample_idx)) AS digest
    FROM rows_of GROUP BY ALL""",
)
def shard_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An ordered digest of every greedy shard; the texts themselves are not moved."""
    rows = tb.corpora(spark, sf_dir).select(
        "dataset", "subset", "sample_idx", F.octet_length("text").alias("nbytes"),
        lf.row_digest("id", "text").alias("row_digest"),
    )
    return lf.shard_digests(greedy_shards(rows, F.col("nbytes"), tb.SHARD_LIMIT))
