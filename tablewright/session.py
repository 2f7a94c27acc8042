"""Session settings and the shared folder that jobs write intermediate tables to."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from datetime import UTC, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession

# Settings every operator here is written for. ANSI stays on: lenient conversions say try_cast.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.ansi.enabled": "true",
}

# For a large cluster: start with many small shuffle partitions and let AQE merge them up to the advisory
# size. The number to start with follows the input's bytes, see partitions_for.
CLUSTER_SETTINGS = {
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    # Splitting a hot key is worth the shuffle it may cost after the join.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.hive.metastorePartitionPruning": "true",
}

_LOCAL_FOLDER = "tablewright.local.folder"


def partitions_for(input_bytes: int, partition_bytes: int = 128 << 20) -> int:
    """Shuffle partitions to start with, so that one holds about `partition_bytes` if all input is shuffled."""
    return max(200, -(-input_bytes // partition_bytes))


def build_session(
    app: str, master: str | None = None, cluster: bool = False, input_bytes: int = 1 << 40, **conf: str
) -> SparkSession:
    """A session with the settings above; `conf` keys use '__' for '.' and win over them.

    On a cluster, input_bytes is what the job reads at most (1 TB if nothing is said; 100 TB start with
    819,200 partitions, which AQE merges to what the data really needs).
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    chosen = {**SETTINGS, **(CLUSTER_SETTINGS if cluster else {})}
    if cluster:
        # The same number where AQE starts and where a program asks how far it may divide its work.
        for key in ("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.shuffle.partitions"):
            chosen[key] = str(partitions_for(input_bytes))
    chosen.update({key.replace("__", "."): value for key, value in conf.items()})
    for key, value in chosen.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, as named by spark.checkpoint.dir.

    Only a local master may go without that setting; it then gets one temporary folder per session.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(_LOCAL_FOLDER, None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        folder = tempfile.mkdtemp(prefix="tablewright-")
        spark.conf.set(_LOCAL_FOLDER, folder)
    return folder.rstrip("/")


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of all executors; once per application."""
    context = spark.sparkContext
    if getattr(context, "_tablewright_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="tablewright-"), "tablewright.zip")
    with zipfile.ZipFile(target, "w") as archive:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.relpath(path, os.path.dirname(root)))
    context.addPyFile(target)
    context._tablewright_shipped = True


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nobody has used before."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, path: str | None = None, label: str = "stage") -> DataFrame:
    """Write `df` once as Parquet and return the written copy.

    Everything built on the result sees the same rows, and a lost executor costs a re-read, not a
    recomputation. The copy is not removed: `remove_staged` does that once its job is done.
    """
    spark = df.sparkSession
    target = f"{path.rstrip('/')}/{uuid.uuid4().hex}" if path else fresh_path(spark, label)
    df.write.parquet(target)
    return spark.read.schema(df.schema).parquet(target)


def remove_staged(spark: SparkSession, older_than: timedelta) -> int:
    """Delete copies that jobs have left in the shared folder, and returns how many.

    Only folders that `fresh_path` has named go, and only those nothing has been written to for that long:
    longer than any job runs that may still read them.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    before, gone = (datetime.now(UTC) - older_than).timestamp() * 1000, 0
    for entry in system.listStatus(path) if system.exists(path) else ():
        if re.fullmatch(r"[\w-]+-[0-9a-f]{32}", entry.getPath().getName()) and entry.isDirectory() and entry.getModificationTime() < before:
            gone += system.delete(entry.getPath(), True)
    return gone
