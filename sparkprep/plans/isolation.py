"""Subset jobs that fail alone: one Spark job per subset, a bounded number at a time.

What goes wrong in one subset (a damaged file, an id that does not fit, a tokenizer that gives
up) ends that subset's job, and is written down; the others go on. The list of subsets is read
from the names of the files, so that a damaged file is first opened by the job it belongs to.
"""

from __future__ import annotations

import os
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from sparkprep.functions.groups import NO_SUBSET

# The states of a subset's job.
DONE, FAILED = "done", "failed"
STATUS = "dataset string, subset string, status string, samples bigint, rejected bigint, error string, seconds double"
MESSAGE_CHARS = 500


@dataclass(frozen=True)
class Unit:
    """One subset of a dataset and the folder that holds it."""

    dataset: str
    subset: str
    folder: str


def units(spark: SparkSession, source: str) -> list[Unit]:
    """The subsets below ``source``, by the folders of its Parquet files; no file is opened."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(source)
    )
    folders = files.select(F.regexp_replace("path", "/[^/]*$", "").alias("f")).distinct().collect()
    default = os.path.basename(source.rstrip("/"))

    def unit(folder: str) -> Unit:
        names = dict(p.split("=", 1) for p in folder.split("/") if "=" in p)
        dataset, subset = names.get("dataset", default), names.get("subset", NO_SUBSET)
        return Unit(unquote(dataset), unquote(subset), folder)

    return sorted((unit(r["f"]) for r in folders), key=lambda u: (u.dataset, u.subset, u.folder))


def source_schema(spark: SparkSession, source: str) -> T.StructType:
    """The columns of a dataset, from a file that can be read; names of folders are strings."""
    found = spark.read.option("ignoreCorruptFiles", "true").parquet(source).schema
    groups = [f for f in found if f.name not in ("dataset", "subset")]
    folders = [T.StructField(n, T.StringType()) for n in ("dataset", "subset") if n in found.names]
    return T.StructType(groups + folders)


def read_unit(spark: SparkSession, source: str, schema: T.StructType, unit: Unit) -> DataFrame:
    """The rows of one subset. A damaged file is an error here, not a gap."""
    rows = (
        spark.read.schema(schema)
        .option("basePath", source)
        .option("ignoreCorruptFiles", "false")
        .parquet(unit.folder)
    )
    return rows.withColumns({"dataset": F.lit(unit.dataset), "subset": F.lit(unit.subset)})


def run_isolated(
    spark: SparkSession, todo: list[Unit], work: Callable[[Unit], tuple[int, int]], max_parallel: int
) -> DataFrame:
    """Run ``work`` for every unit and return one row of ``STATUS`` for each.

    ``work`` returns how many samples it has written and how many it rejected. At most
    ``max_parallel`` units run at a time; Spark shares the executors among their jobs.
    """
    if max_parallel < 1:
        raise ValueError(f"at least one job must run at a time, got {max_parallel}")

    def run(unit: Unit) -> tuple:
        began = time.monotonic()
        try:
            samples, rejected = work(unit)
            status, error = DONE, None
        except Exception as problem:  # whatever it is, it is this subset's alone
            samples, rejected, status = None, None, FAILED
            error = f"{type(problem).__name__}: {problem}"[:MESSAGE_CHARS]
        return unit.dataset, unit.subset, status, samples, rejected, error, time.monotonic() - began

    with ThreadPoolExecutor(max_parallel) as pool:
        rows = list(pool.map(inheritable_thread_target(spark)(run), todo))
    return spark.createDataFrame(rows, STATUS)


def require_done(status: DataFrame) -> None:
    """Raise when a subset's job has failed."""
    failed = status.where(F.col("status") == FAILED)
    first = failed.orderBy("dataset", "subset").first()
    if first is not None:
        raise RuntimeError(f"{failed.count()} subsets failed, the first is {first['subset']}: {first['error']}")
