"""Session defaults and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Settings for a session this repository starts itself (tests, bench). On a
# cluster the submitter's own settings stand.
LOCAL_DEFAULTS = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Writing to a few folders at a time needs no sort by folder first.
    "spark.sql.maxConcurrentOutputFileWriters": "16",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "16g",
    "spark.sql.dataFrameQueryContext.enabled": "false",
}


def local_session(cpus: int | None = None, name: str = "sparkprep", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks."""
    cores = str(cpus) if cpus else "*"
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    for key, value in {**LOCAL_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, named by ``spark.checkpoint.dir``.

    Only a local session may run without that setting: it gets a temporary
    folder. On a cluster a missing setting is an error, because a folder on
    one machine would lose checkpoints with that machine.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="sparkprep-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(base)
    return base


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return os.path.join(shared_dir(spark), f"{label}-{uuid.uuid4().hex}")


def written(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Write a table to a new path in the shared folder; the table read back, and the path."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete a table that ``written`` made and nothing reads any more."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give this package to the Python workers, once per application.

    Workers import it by name. A job submitted with ``--py-files`` has it already;
    adding it again does no harm. Spark itself hands the archive to executors,
    so it may be built in a temporary folder of the driver.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    name = os.path.basename(package)
    archive = os.path.join(tempfile.mkdtemp(prefix=f"{name}-"), f"{name}.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, files in os.walk(package):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    out.write(full, os.path.join(name, os.path.relpath(full, package)))
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(app)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Use all cores when a scan has fewer splits than the cluster has cores.

    A small table in one file is one split. A large one has more splits than
    cores, so nothing is shuffled there. Call it on a plain scan only.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, *keys)
