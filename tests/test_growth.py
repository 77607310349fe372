"""What must not grow with the tables: work of one task, number of batches, workers beside a core."""

from __future__ import annotations

from sparkprep.plans import queries_chunk, queries_corpus as qc
from sparkprep.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"


def test_split_scan_writes_subsets_in_tasks_of_their_own(spark, monkeypatch):
    plans, write = [], qc.sinks.write_subsets

    def seen(df, *args, **options):
        plans.append(df._jdf.queryExecution().toString())
        write(df, *args, **options)

    monkeypatch.setattr(qc.sinks, "write_subsets", seen)
    assert sum(r["samples"] for r in QUERIES["split_scan"](spark, SF).collect()) == 200
    assert len(plans) == 2 and not any("Coalesce 1" in p for p in plans)


def test_batches_do_not_grow_with_files(spark, monkeypatch):
    """Twenty-four files and more are still done in about three batches."""
    batches, run, write = [], qc.inc.run_batches, qc.sinks.write_subsets

    def counted(*args, **options):
        batches.append(run(*args, **options))
        return batches[-1]

    def small(df, path, **options):
        write(df, path, max_rows_per_file=7, **options)

    monkeypatch.setattr(qc.inc, "run_batches", counted)
    monkeypatch.setattr(qc.sinks, "write_subsets", small)
    rows = QUERIES["chunk_in_batches"](spark, SF).collect()
    assert sum(r["documents"] for r in rows) == 200
    assert batches and max(batches) <= 4


def test_prefix_space_has_few_python_steps_in_a_pass(spark):
    plan = queries_chunk.prefix_space(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") <= 5
