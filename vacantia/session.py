"""Session settings, shared scratch space and staged tables."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

TASK_ROWS = 250_000  # narrow rows that a task groups or joins, some 50 MB for each of its hash maps and sorts


def build_session(
    app: str = "vacantia", master: str | None = None, start_partitions: int | None = None,
    shared: str | None = None, **conf: str,
) -> SparkSession:
    """A session with adaptive execution, skew handling and UTC time.

    ``master`` is left to ``spark-submit`` unless given.  Adaptive execution only merges partitions, so
    ``start_partitions`` should be high for much data (a few per 100 MB of shuffle); without it the
    session's number of shuffle partitions holds.  ``shared`` is the folder for staged tables that all executors reach.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if start_partitions:
        conf["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(start_partitions)
    if shared:
        conf["spark.checkpoint.dir"] = shared
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once a session: it may be on the driver's path only."""
    if any(os.path.basename(f) == "vacantia.zip" for f in spark.sparkContext.listFiles):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = shutil.make_archive(
        os.path.join(tempfile.mkdtemp(prefix="vacantia-ship-"), "vacantia"), "zip", os.path.dirname(root), os.path.basename(root))
    spark.sparkContext.addPyFile(archive)


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Where it is unset, a temporary folder is made - in local mode only, since a
    machine-local folder cannot be read by other executors.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if path:
        return path
    if not _is_local(spark):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    path = tempfile.mkdtemp(prefix="vacantia-")
    spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for one written table in the application's own part of the shared folder.

    That part is removed when the session's file system is closed, at the end of the application.
    """
    own = os.path.join(shared_dir(spark), f"vacantia-{spark.sparkContext.applicationId}")
    folder = spark._jvm.org.apache.hadoop.fs.Path(own)
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(folder):
        store.mkdirs(folder)
        store.deleteOnExit(folder)
    return os.path.join(own, f"{name}-{uuid.uuid4().hex}")


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder and read it from there.

    Cuts the lineage, so that a lost executor re-reads a file instead of recomputing, and
    makes later passes read only the columns they need.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(scan: DataFrame) -> DataFrame:
    """Repartition a plain scan that has fewer splits than there are cores.

    For work that costs far more than moving its input; many or large files have enough
    splits and are left as they are.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


def parts_of(spark: SparkSession, rows: int) -> int | None:
    """Partitions in which a task meets about ``TASK_ROWS`` of ``rows`` narrow rows, None where one per core will do.

    Adaptive execution merges partitions, down to one per core, by their compressed bytes, and so puts
    millions of narrow rows in one task; it leaves alone what is repartitioned by a number.
    """
    parts = -(-rows // TASK_ROWS)
    if parts <= spark.sparkContext.defaultParallelism:
        return None
    return max(parts, int(spark.conf.get("spark.sql.shuffle.partitions")))
