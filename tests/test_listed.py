"""Scans that open the listed files only, and digests that notice a change."""

from __future__ import annotations

import glob
import os

from pyspark.sql import functions as F

from sparkprep.operators.split import split_manifest, with_small
from sparkprep.sources import datasets as ds, listed, sinks


def make(spark, rows=120):
    n = F.col("id")
    return spark.range(rows).select(
        F.lit("a+b c").alias("dataset"),
        F.concat(F.lit("000_0000"), (n % 3).cast("string")).alias("subset"),
        n.alias("sample_idx"),
        n.cast("string").alias("id"),
        F.concat(F.lit("text "), n.cast("string")).alias("text"),
    )


def test_a_split_opens_its_own_files(spark, tmp_path):
    source = str(tmp_path / "docs")
    sinks.write_subsets(make(spark), source, max_rows_per_file=7)
    files = listed.located_files(spark, source)
    on_disk = glob.glob(source + "/**/*.parquet", recursive=True)
    assert files.count() == len(on_disk) and files.select("dataset").distinct().first()[0] == "a+b c"
    labelled = with_small(split_manifest(files, train_ratio=0.6, val_ratio=0.4, small_ratio=0.3, key=listed.FILE_KEY)).persist()
    ids = {}
    for name in ("train", "val", "train_small"):
        rows = listed.read_split(spark, [source], labelled, name)
        want = {r["basename"] for r in labelled.where(F.col("split") == name).collect()}
        assert {os.path.basename(f) for f in rows.inputFiles()} == want
        assert rows.columns == make(spark).select("sample_idx", "id", "text", "dataset", "subset").columns
        ids[name] = [r["id"] for r in rows.collect()]
    assert sorted(ids["train"] + ids["val"], key=int) == [str(i) for i in range(120)]
    assert set(ids["train_small"]) < set(ids["train"])


def test_many_scans_and_flat_datasets(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(listed, "FILES_PER_SCAN", 2)
    flat = str(tmp_path / "flat")
    make(spark, 30).select("id", "text").repartition(5).write.parquet(flat)
    files = listed.located_files(spark, flat)
    rows = listed.read_listed(spark, flat, files)
    assert rows.count() == 30 and rows.select("dataset", "subset").distinct().collect() == [("flat", ds.NO_SUBSET)]
    assert listed.read_listed(spark, flat, files.where("false")) is None


def test_digests_notice_changes(spark, tmp_path):
    source = str(tmp_path / "docs")
    sinks.write_subsets(make(spark), source, max_rows_per_file=20)
    digests = listed.file_digests(spark, source)
    before = spark.createDataFrame(digests.collect(), digests.schema)
    assert listed.changed_files(before, listed.file_digests(spark, source)).count() == 0
    one, two = sorted(glob.glob(source + "/**/*.parquet", recursive=True))[:2]
    with open(one, "ab") as f:
        f.write(b"x")
    os.remove(os.path.join(os.path.dirname(one), f".{os.path.basename(one)}.crc"))
    os.rename(two, two.replace(".parquet", "-moved.parquet"))
    issues = {r["basename"]: r["issue"] for r in listed.changed_files(before, listed.file_digests(spark, source)).collect()}
    base = os.path.basename
    assert issues == {base(one): "changed", base(two): "missing", base(two).replace(".parquet", "-moved.parquet"): "not listed"}


def test_shard_digests_depend_on_order_and_nulls(spark):
    def digest(rows):
        df = spark.createDataFrame([("d", None, 0, i, *r) for i, r in enumerate(rows)], "dataset string, subset string, shard_id long, sample_idx long, id string, text string")
        found = listed.shard_digests(df.withColumn("row_digest", listed.row_digest("id", "text"))).collect()
        return found[0]["digest"] if found else None

    rows = [("1", "a"), ("2", None), ("3", "")]
    assert digest(rows) == digest(rows) and digest([]) is None
    others = [digest(rows[::-1]), digest([("1", "a"), ("2", ""), ("3", None)]), digest([("1a", ""), *rows[1:]]), digest(rows[:2])]
    assert len({digest(rows), *others}) == 5
