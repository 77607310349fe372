"""The pipeline's stages against plain Python on a small table."""

from __future__ import annotations

import corpus_pipeline as cp
import public_tokenizers
from tokenizers import Tokenizer

from sparkprep.llm.common import stored
from sparkprep.llm.mixing import mix, training_order

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, version string"


def words(n, tag):
    return " ".join(f"{tag}word{i}" for i in range(n)) + "."


def table(spark):
    good = "\n".join(words(30, f"a{k}") for k in range(4))
    texts = [
        good,  # 0 stays
        good,  # 1 emptied by line dedup
        "Home | News | Sport | Login\n" * 30,  # 2 rejected
        None,  # 3 rejected
        words(80, "b") + "\nHome | News | Login",  # 4 stays without its menu
        words(60, "c") + "\n" + good,  # 5 keeps its first line
        words(90, "d"),  # 6 stays
    ]
    rows = [(i, t, "en", "s", len(t or ""), "v") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def test_stages_in_turn(spark):
    docs = table(spark)
    kept = cp.quality_rules(spark, docs, "")
    assert kept.columns == docs.columns
    rows = {r["doc_id"]: r for r in kept.collect()}
    assert sorted(rows) == [0, 1, 4, 5, 6]
    assert rows[4]["text"] == words(80, "b") and rows[4]["n_chars"] == len(rows[4]["text"])

    unique = cp.line_dedup(spark, kept, "")
    rows = {r["doc_id"]: r for r in unique.collect()}
    assert sorted(rows) == [0, 4, 5, 6] and rows[5]["text"] == words(60, "c")

    near = docs.where("doc_id in (0, 1, 6)").union(docs.where("doc_id = 6"))
    assert sorted(r["doc_id"] for r in cp.near_dedup(spark, near, "").collect()) == [0, 6]

    mixed = cp.source_mix(spark, unique, "")
    assert mixed.columns == docs.columns
    assert {r["doc_id"] for r in mixed.collect()} == {0, 4, 5, 6}  # one source: each once
    assert mixed.count() == 4

    out = cp.bpe_encode(spark, mixed, "").collect()
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    text = {r["doc_id"]: r["text"] for r in mixed.collect()}
    for r in out:
        assert r["ids"] == library.encode(text[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(r["ids"])


def test_stages_on_no_rows(spark):
    docs = table(spark).limit(0)
    for _, stage in cp.STAGES:
        docs = stage(spark, docs, "")
        assert docs.count() == 0


def test_rows_without_an_id_and_shared_ids(spark):
    """Copies without an id become one row; unlike rows of one id stay; no row is multiplied."""
    a, b, c = words(60, "a"), words(60, "b"), words(60, "c")
    rows = [(None, a, "en", "s", len(a), "v")] * 40 + [(None, b, None, "s", len(b), "v")] * 3
    rows += [(7, b, "en", "s", len(b), "v"), (7, c, "en", "s", len(c), "v"), (8, c, "en", "t", len(c), "v")]
    docs = spark.createDataFrame(rows, SCHEMA)
    near = cp.near_dedup(spark, docs, "").collect()
    assert sorted(((r["doc_id"], r["text"]) for r in near), key=str) == sorted([(None, a), (7, b), (7, c)], key=str)

    taken = {}
    for r in mix(docs).collect():
        key = (r["doc_id"], r["source"], r["size"] and r["version"])
        taken[key] = taken.get(key, 0) + r["passes"]
    out = cp.source_mix(spark, docs, "").collect()
    assert len(out) == sum(taken.values()) > 0
    assert sum(r["doc_id"] is None for r in out) == sum(n for k, n in taken.items() if k[0] is None)


def test_mix_is_written_in_training_order(spark):
    """Three sources, some documents taken more than once."""
    rows = []
    for i in range(120):
        text = words(5 + i % 7, f"t{i}")
        rows.append((i, text, "en", "abc"[min(i // 15, 2)], len(text), "v"))
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    written = stored(cp.source_mix(spark, docs, ""), "mix")
    files = sorted(written.inputFiles())
    got = [r["doc_id"] for f in files for r in spark.read.parquet(f).collect()]
    want = [r["doc_id"] for r in training_order(mix(docs)).collect()]
    assert got == want and len(set(got)) < len(got)


def test_columns_named_like_the_stages_own(spark):
    """Extra columns keep their values, whatever their names; the rules are worked out once."""
    names = ["quality", "removed", "id", "row", "position", "rest", "_id", "_version", "_lines", "hash", "a.b"]
    text = "\n".join(f"Line {i} of this text has its own words, w{i} x{i} y{i} z{i}, and then it ends." for i in range(9))
    rows = [(i, text.replace("own", f"own{i // 2}"), "en", "s", 1, *[f"{n}{i}" for n in names]) for i in range(4)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"`{n}` string" for n in names)
    docs = spark.createDataFrame(rows, schema)
    for name, stage in cp.STAGES[:4]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns
        for r in out.collect():
            assert [r[n] for n in names] == [f"{n}{r['doc_id']}" for n in names], name
    plan = cp.quality_rules(spark, docs, "")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("all rights reserved") == 1
