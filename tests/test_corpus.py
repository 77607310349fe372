"""Scans, manifests, ranks, sampling, splitting and inspection on small data."""

from __future__ import annotations

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from sparkprep.functions import arrays, text as tx
from sparkprep.functions.order import prefix_sum, shuffled_rank
from sparkprep.operators import evaluate as ev, sample as sm, split as sp
from sparkprep.operators.tokenize import tokenize_bytes
from sparkprep.sources import datasets as ds, manifest as mf, sinks
from sparkprep.streaming import incremental as inc

CORPUS = "dataset string, subset string, sample_idx long, id string, text string"


def digest(seed, *key):
    return hashlib.md5(":".join(map(str, (seed, *key))).encode()).hexdigest()


def make(spark, n=100, dataset="d", subsets=4):
    rows = [
        (dataset, f"000_{i % subsets:05d}", i, str(i), "x" * (i % 7 + 1)) for i in range(n)
    ]
    return spark.createDataFrame(rows, CORPUS)


def one_hot_group(spark, n=300):
    """A third of all rows in one subset."""
    rows = [("d", "hot" if i % 3 == 0 else f"s{i}", i, str(i), "y" * (i % 5)) for i in range(n)]
    return spark.createDataFrame(rows, CORPUS)


# ---- ranks and totals --------------------------------------------------------


@pytest.mark.parametrize("block", [1, 3, 1000])
def test_prefix_sum(spark, block):
    df = one_hot_group(spark)
    out = prefix_sum(
        df, F.octet_length("text"), within=["subset"], order="sample_idx", out="c", block_rows=block
    )
    want, running = {}, {}
    for r in df.orderBy("sample_idx").collect():
        running[r.subset] = running.get(r.subset, 0) + len(r.text)
        want[r.id] = running[r.subset]
    assert {r.id: r.c for r in out.collect()} == want


@pytest.mark.parametrize("partitions", [1, 5, 16])
def test_shuffled_rank(spark, partitions):
    df = one_hot_group(spark).repartition(partitions)
    out = shuffled_rank(df, seed=3, key=["id"], within=["dataset"], rank="r", total="t").collect()
    order = sorted((str(i) for i in range(300)), key=lambda i: (digest(3, i), i))
    assert {r.id: r.r for r in out} == {k: i + 1 for i, k in enumerate(order)}
    assert {r.t for r in out} == {300}
    head = shuffled_rank(df, seed=3, key=["id"], rank="r", limit=20, groups=1).collect()
    assert {r.id: r.r for r in head} == {k: i + 1 for i, k in enumerate(order[:20])}


def test_limited_rank_does_not_move_the_rows_beyond_it(spark):
    plan = shuffled_rank(one_hot_group(spark), seed=3, key=["id"], rank="r", limit=20, groups=1)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "CartesianProduct" not in text


# ---- scans -------------------------------------------------------------------


@pytest.mark.parametrize("n", [0, 1, 25, 26, 60, 99, 100, 139, 500])
@pytest.mark.parametrize("block", [4, 1000])
def test_limit_lines(spark, n, block):
    a, b = make(spark, 100, "a"), make(spark, 40, "b")
    rows = a.unionByName(b)
    got = ds.limit_lines(rows, n, datasets=["b", "a"], descending=["a"], block_rows=block)
    first = sorted(range(40), key=lambda i: (i % 4, i))
    then = sorted(range(100), key=lambda i: (-(i % 4), i))
    want = ([("b", str(i)) for i in first] + [("a", str(i)) for i in then])[:n]
    assert sorted((r.dataset, r.id) for r in got.collect()) == sorted(want)


def test_subset_filter_prunes_and_requires(spark, tmp_path):
    path = str(tmp_path / "c")
    sinks.write_subsets(make(spark), path)
    df = ds.read_dataset(spark, path)
    rows = ds.subset_filter(df, "000_00002")
    assert rows.count() == 25
    assert "PartitionFilters: [isnotnull(subset" in rows._jdf.queryExecution().toString()
    with pytest.raises(ValueError):
        ds.subset_filter(df, "000_00009")


def test_dataset_without_subsets(spark, tmp_path):
    path = str(tmp_path / "flat")
    make(spark).drop("subset", "dataset").write.parquet(path)
    df = ds.read_dataset(spark, path, "flat")
    assert df.where("subset = 'unnamed' and dataset = 'flat'").count() == 100


def test_read_jsonl(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"text": "one", "n": 1}\n{"other": 2}\n')
    (tmp_path / "b.json").write_text('{"text": "two"}\n')
    (tmp_path / "c.txt").write_text('{"text": "no"}\n')
    rows = ds.with_text(ds.read_jsonl(spark, str(tmp_path)))
    assert sorted(r.text for r in rows.collect()) == ["one", "two"]
    (tmp_path / "d.jsonl").write_text('{"body": "three"}\n')
    body = ds.with_text(ds.read_jsonl(spark, str(tmp_path), text_key="body"))
    assert [r.text for r in body.collect()] == ["three"]


def test_union_needs_equal_columns(spark):
    with pytest.raises(ValueError):
        ds.union_datasets([make(spark), make(spark).withColumn("sample_idx", F.lit("x"))])
    with pytest.raises(ValueError):
        ds.union_datasets([])
    assert ds.union_datasets([make(spark), make(spark)]).count() == 200


def test_seeded_order(spark):
    df = make(spark)
    got = [r.id for r in ds.shuffled(df.repartition(7), 5, "id").collect()]
    assert got == sorted((str(i) for i in range(100)), key=lambda i: (digest(5, i), i))


# ---- manifests ---------------------------------------------------------------


@pytest.fixture
def index_root(tmp_path):
    """Folders in the given layout: two good, one without manifest, one broken, one misnamed."""

    def shard(name, samples, zipped=False):
        entry = {"samples": samples, "format": "mds", "version": 2, "compression": None,
                 "column_names": ["id", "text"], "column_encodings": ["str", "str"],
                 "column_sizes": [None, None], "hashes": [], "size_limit": 67108864,
                 "raw_data": {"basename": name, "bytes": 10, "hashes": {}}, "zip_data": None}
        if zipped:
            entry["zip_data"] = {"basename": name + ".zstd", "bytes": 5, "hashes": {"sha1": "0"}}
        return entry

    def folder(name, shards, files):
        (tmp_path / name).mkdir()
        (tmp_path / name / "index.json").write_text(json.dumps({"version": 2, "shards": shards}, indent=2))
        for f in files:
            (tmp_path / name / f).write_bytes(b"0123456789")

    folder("000_00000", [shard("shard.00000.mds", 3), shard("shard.00001.mds", 4)],
           ["shard.00000.mds", "shard.00001.mds"])
    folder("000_00002", [shard("shard.00000.mds", 5, True)], ["shard.00000.mds.zstd"])
    folder("tmp", [shard("shard.00000.mds", 9)], [])
    (tmp_path / "000_00001").mkdir()
    (tmp_path / "000_00003").mkdir()
    (tmp_path / "000_00003" / "index.json").write_text("{not json")
    return str(tmp_path)


def test_index_files(spark, index_root):
    found = [r.subset for r in mf.discover_subsets(spark, index_root).collect()]
    assert found == ["000_00000", "000_00002", "000_00003"]
    shards = mf.read_index_files(spark, index_root)
    assert shards.where("samples is not null").count() == 3
    assert shards.where("subset = '000_00003' and samples is null").count() == 1
    packed = {r.subset: r.compressed for r in mf.is_compressed(shards).collect()}
    assert packed["000_00002"] and not packed["000_00000"]

    raw = shards.select(F.lit("d").alias("dataset"), "subset", "samples",
                        F.col("raw_data.basename").alias("basename"))
    packed_files = shards.where("zip_data is not null").select(
        F.lit("d").alias("dataset"), "subset", F.lit(0).cast("long").alias("samples"),
        F.col("zip_data.basename").alias("basename"))
    files = mf.list_files(spark, index_root).withColumn("dataset", F.lit("d"))
    listed = raw.unionByName(packed_files)
    issues = {(r.subset, r.issue) for r in mf.structure_issues(listed, files).collect()}
    assert issues == {
        ("000_00002", "missing shard file: shard.00000.mds"),
        ("000_00003", "unreadable manifest"),
    }
    report = mf.verify_structure(listed, files).first()
    assert (report.valid, report.total_subsets, report.total_samples, report.issues) == (False, 3, 12, 2)


def test_written_dataset_is_valid_until_a_file_is_lost(spark, tmp_path):
    path = str(tmp_path / "c")
    sinks.write_subsets(make(spark), path)
    listing = mf.list_files(spark, path, "*.parquet").withColumn("dataset", F.lit("d"))
    manifest = mf.file_manifest(mf.with_file_shards(ds.read_dataset(spark, path)))
    assert manifest.agg(F.sum("samples")).first()[0] == 100
    assert mf.verify_structure(manifest, listing).first().valid
    fewer = listing.where("subset != '000_00001'")
    assert not mf.verify_structure(manifest, fewer).first().valid
    expected = spark.createDataFrame([("d",), ("absent",)], "dataset string")
    total = mf.corpus_summary(expected, manifest, listing).where("dataset is null").first()
    assert (total.subsets, total.samples, total.failed) == (4, 100, 1)


def test_rewriting_one_subset_keeps_the_others(spark, tmp_path):
    path = str(tmp_path / "c")
    sinks.write_subsets(make(spark), path)
    again = make(spark).where("subset = '000_00001'").withColumn("text", F.lit("new"))
    sinks.write_subsets(again, path, compression="gzip")
    df = ds.read_dataset(spark, path)
    assert df.count() == 100 and df.where("text = 'new'").count() == 25
    with pytest.raises(ValueError):
        sinks.write_subsets(again, path, compression="lz9")


def test_shards_fill_up_to_the_limit(spark):
    df = make(spark, 50, subsets=1)
    rows = mf.assign_shards(df, F.octet_length("text"), limit=10, block_rows=8).orderBy("sample_idx")
    total, want = 0, []
    for i in range(50):
        total += i % 7 + 1
        want.append((total - 1) // 10)
    assert [r.shard_id for r in rows.collect()] == want


def test_locate_every_index(spark):
    rows = mf.assign_shards(one_hot_group(spark), F.octet_length("text"), limit=16)
    manifest = mf.build_manifest(rows, F.octet_length("text"))
    found = mf.locate_indices(spark.range(300).withColumnRenamed("id", "index"), manifest, bucket=7)
    ordered = rows.orderBy("dataset", "subset", "sample_idx").collect()
    seen, want = {}, []
    for i, r in enumerate(ordered):
        place = (r.subset, r.shard_id)
        seen[place] = seen.get(place, -1) + 1
        want.append((i, *place, seen[place]))
    assert sorted((r["index"], r.subset, r.shard_id, r.offset) for r in found.collect()) == want


def test_shard_names(spark):
    m = spark.createDataFrame([("a", 1), ("a", 100_000), ("a", 100_001)], "split string, position long")
    names = [r.new_name for r in sinks.renumbered(m, "position").orderBy("position").collect()]
    assert names == ["shard.00000", "shard.99999", "shard.100000"]


# ---- sampling ----------------------------------------------------------------


def test_bins(spark):
    df = spark.createDataFrame([(n,) for n in (0, 1, 512, 513, 1024, 1025)], "len int")
    got = [r.b for r in df.select(sm.bin_label("len", [0, 512, 1024]).alias("b")).collect()]
    assert got == [None, "(0,512]", "(0,512]", "(512,1024]", "(512,1024]", None]
    assert sm.parse_edges("0, 512,1024") == [0, 512, 1024]
    with pytest.raises(ValueError):
        sm.parse_edges("5,5")


def test_length_falls_back_to_the_ids(spark):
    df = spark.createDataFrame([("a", [1, 2], None), ("b", None, None), ("c", [1], 9)],
                               "id string, input_ids array<int>, len int")
    got = {r.id: r.n for r in df.select("id", sm.sample_length(df).alias("n")).collect()}
    assert got["a"] == 2 and got["c"] == 9 and got["b"] in (None, -1)
    bare = df.drop("len")
    assert {r.id for r in sm.binned(bare, [0, 10]).collect()} == {"a", "c"}


@pytest.mark.parametrize("k", [2, 5])
def test_sample_sizes_and_uniform_choice(spark, k):
    rows = [(str(i), [1] * (1 + i % 2 * 10)) for i in range(3)] + [(str(i), [1] * 30) for i in range(3, 60)]
    df = spark.createDataFrame(rows, "id string, input_ids array<int>").withColumn("len", F.size("input_ids"))
    got = sm.sample_per_bin(df, [0, 5, 20, 40], k, seed=1, key=["id"])
    counts = {r.bin_label: r["count"] for r in got.groupBy("bin_label").count().collect()}
    assert counts == {"(0,5]": min(k, 2), "(5,20]": 1, "(20,40]": k}
    want = sorted((str(i) for i in range(3, 60)), key=lambda i: digest(1, i))[:k]
    assert sorted(r.id for r in got.where("len = 30").collect()) == sorted(want)
    stats = {r.bin_label: (r.total, r.collected, r.lengths) for r in
             sm.bin_stats(df, [0, 5, 20, 40], k, seed=1, key=["id"]).collect()}
    assert stats["(20,40]"] == (57, k, [30] * k)


def test_every_row_is_equally_likely(spark):
    df = make(spark, 40).select("dataset", "id")
    hits = {}
    for seed in range(60):
        for r in sm.take_per_dataset(df, 10, seed=seed, key=["id"], datasets=1).collect():
            hits[r.id] = hits.get(r.id, 0) + 1
        if seed == 24:
            break
    # 25 draws of 10 out of 40: about 6 each.
    assert sum(hits.values()) == 250 and max(hits.values()) < 18 and len(hits) == 40


# ---- splits ------------------------------------------------------------------


def shards(spark, n):
    rows = [("d", f"s{i % 3}", i, 10) for i in range(n)]
    return spark.createDataFrame(rows, "dataset string, subset string, shard_id long, samples long")


@pytest.mark.parametrize(
    "n, ratio, train, val, small",
    [(10, 0.9, 9, 1, 1), (100, 0.29, 28, 72, 1), (1, 0.9, 0, 1, 0), (200, 0.5, 100, 100, 5)],
)
def test_split_sizes(spark, n, ratio, train, val, small):
    out = sp.split_manifest(shards(spark, n), train_ratio=ratio, val_ratio=1 - ratio, small_ratio=0.05)
    rows = out.collect()
    assert sum(r.split == "train" for r in rows) == train
    assert sum(r.split == "val" for r in rows) == val
    assert sum(r.in_train_small for r in rows) == small
    assert all(r.split == "train" for r in rows if r.in_train_small)
    for s in ("train", "val"):
        places = sorted(r.position for r in rows if r.split == s)
        assert places == list(range(1, len(places) + 1))
    summary = {r.split: r.shards for r in sp.split_summary(sp.with_small(out)).collect()}
    assert summary == {k: v for k, v in (("train", train), ("val", val), ("train_small", small)) if v}


def test_only_small_and_ratios(spark):
    assert sp.only_train_small(shards(spark, 10), small_ratio=0.05).count() == 1
    assert sp.only_train_small(shards(spark, 100), small_ratio=0.29).count() == 28
    for bad in ((0.5, 0.4, 0.1), (0.9, 0.1, 0), (0.9, 0.1, 1.5)):
        with pytest.raises(ValueError):
            sp.check_ratios(*bad)
    sp.check_ratios(0.9, 0.1005, 1)


def test_row_split_is_stable(spark):
    df = make(spark, 400)
    a = sp.split_rows(df, train_ratio=0.8, val_ratio=0.2, small_ratio=0.25)
    b = sp.split_rows(df.where("sample_idx < 100").repartition(3), train_ratio=0.8, val_ratio=0.2, small_ratio=0.25)
    label = {r.id: r.split for r in a.collect()}
    assert all(label[r.id] == r.split for r in b.collect())
    assert a.where("in_train_small and split = 'val'").count() == 0
    assert 280 < a.where("split = 'train'").count() < 360


# ---- evaluation, inspection, arrays -------------------------------------------


def test_metrics(spark):
    df = spark.createDataFrame([("a", "x yy zzz w"), ("b", "-- ...")], "dataset string, text string")
    got = ev.tokenizer_metrics(df, {"len": (F.length("word"), 9)}, by=["dataset"])
    assert {r.dataset: (r.fertility, r.pcw, r.vocab_size) for r in got.collect()} == {
        "a": (1.75, 0.5, 9), "b": (0.0, 0.0, 9)}
    summary = ev.evaluation_summary(got).first()
    assert (summary.dataset, summary.tokenizer, summary.fertility) == ("a", "len", 1.75)


def test_inspection(spark):
    df = tokenize_bytes(make(spark))
    rows = ev.inspect_samples(df, n=3, decoded=tx.byte_text("input_ids")).collect()
    assert [r.sample_idx for r in rows] == [0, 4, 8]
    assert (rows[0].len, rows[0].min_id, rows[0].text) == (1, ord("x"), "x")
    assert ev.inspect_samples(df, "000_00001", None).count() == 25
    with pytest.raises(ValueError):
        ev.inspect_samples(df, "nope")
    long = spark.createDataFrame([(list(range(60)),), (list(range(50)),)], "input_ids array<int>")
    shown = [r.preview for r in ev.preview_ids(long).collect()]
    assert list(shown[0]) == [*range(25), *range(35, 60)] and list(shown[1]) == list(range(50))


def test_templates(spark):
    df = spark.createDataFrame([([5, 6], [7])], "a array<int>, b array<int>")
    row = df.select(
        arrays.template_single("a", 0, 3).alias("s"),
        arrays.template_pair("a", "b", 0, 3).alias("p"),
        arrays.pair_type_ids("a", "b").alias("t"),
        arrays.drop_ids(arrays.template_pair("a", "b", 0, 3), [0, 3]).alias("d"),
        arrays.single_is_valid(arrays.template_single("a", 0, 3), 0, 3).alias("v"),
        arrays.pair_is_valid(arrays.template_single("a", 0, 3), 0, 3).alias("w"),
        arrays.fits_uint16(F.array(F.lit(65536))).alias("u"),
        arrays.fits_uint16(F.array().cast("array<int>")).alias("e"),
    ).first()
    assert list(row.s) == [0, 5, 6, 3] and list(row.p) == [0, 5, 6, 3, 7, 3]
    assert list(row.t) == [0, 0, 0, 0, 1, 1] and list(row.d) == [5, 6, 7]
    assert row.v and not row.w and not row.u and row.e


def test_byte_text_clamps(spark):
    df = spark.createDataFrame([([0, 31, 65, 200, 300, 900],)], "ids array<int>")
    assert df.select(tx.byte_text("ids").alias("t")).first().t == "  A" + chr(200) + chr(300) + chr(512)
    texts = ["", "a\0b\n", "é東😀"]
    rows = spark.createDataFrame([(t,) for t in texts], "text string").select(tx.byte_ids("text").alias("i"))
    assert [list(r.i) for r in rows.collect()] == [list(t.encode()) for t in texts]


def test_nfc(spark):
    df = spark.createDataFrame([("é",), ("plain",), (None,), ("Å",)], "t string").coalesce(1)
    assert [r.n for r in df.select(tx.nfc(F.col("t")).alias("n")).collect()] == ["é", "plain", None, "Å"]


# ---- incremental -------------------------------------------------------------


def test_resume_states(spark):
    key = "dataset string, subset string, "
    expected = spark.createDataFrame([("d", s, 10) for s in "abcd"], key + "samples long")
    state = spark.createDataFrame(
        [("d", "a", 10, True), ("d", "b", 4, False), ("d", "c", 10, False)],
        key + "samples_processed long, has_stats boolean",
    )
    status = inc.resume_status(expected, state)
    assert {r.subset: r.status for r in status.collect()} == {
        "a": "complete", "b": "resumable", "c": "possibly_corrupt", "d": "new"}
    assert {r.status: r.subsets for r in inc.status_summary(status).collect()}["new"] == 1


def test_incremental_run_sees_each_file_once(spark, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))

    def tokens(df):
        return tokenize_bytes(df).drop("text")

    make(spark, 30).write.mode("append").parquet(source)
    inc.run_incremental(spark, source, target, state, tokens)
    inc.run_incremental(spark, source, target, state, tokens)
    assert spark.read.parquet(target).count() == 30
    make(spark, 12, "other").write.mode("append").parquet(source)
    inc.run_incremental(spark, source, target, state, tokens, max_files_per_trigger=1)
    out = spark.read.parquet(target)
    assert out.count() == 42 and out.where("dataset = 'other'").count() == 12


def test_failures_are_kept_apart(spark):
    from sparkprep.operators.tokenize import tokenize_with
    from sparkprep.plans.queries_text import CodePointTokenizer

    df = make(spark, 10).withColumn("text", F.when(F.col("sample_idx") == 3, "a|b").otherwise(F.col("text")))
    rows = tokenize_with(df, CodePointTokenizer, errors="record")
    assert inc.good_rows(rows).count() == 9
    bad = inc.quarantine(rows).collect()
    assert [(r.id, r.error) for r in bad] == [("3", "ValueError: bar in text")]
    status = inc.failure_status(rows)
    assert status.agg(F.sum("samples"), F.sum("failed")).first()[:] == (9, 1)
    with pytest.raises(RuntimeError):
        inc.require_no_failures(status)
    with pytest.raises(Exception, match="bar in text"):
        tokenize_with(df, CodePointTokenizer).collect()


def test_a_sample_keeps_few_rows_before_the_shuffle(spark):
    df = make(spark, 40).select("dataset", "id")
    plan = sm.take_per_dataset(df, 10, key=["id"], datasets=1)._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan


def test_empty_bins_and_null_subsets(spark):
    rows = [(None, str(i), [1] * 3) for i in range(9)]
    df = spark.createDataFrame(rows, "subset string, id string, input_ids array<int>")
    key = ["subset", "id"]
    stats = {r.bin_label: (r.total, r.collected) for r in sm.bin_stats(df, [0, 2, 5], 4, key=key).collect()}
    assert stats == {"(0,2]": (0, 0), "(2,5]": (9, 4)}
    assert sm.sample_per_bin(df, [0, 2, 5], 4, key=key).count() == 4
