"""Session set-up, scratch folders and plan size checks."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Settings that hold on a large cluster as well as in local mode. Partition counts are left to AQE:
# it starts from `initialPartitionNum` and merges small partitions, and splits skewed join partitions.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
}


def session(app: str = "gridlake", master: str | None = None, **conf: str) -> SparkSession:
    """Build (or get) a session with the engine's defaults; `conf` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship_code(spark: SparkSession) -> None:
    """Send this package to the executors of a cluster where it is not installed. Tasks of `gridlake.llm` import it."""
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="gridlake-code-")) / "gridlake.zip"  # the driver's copy; Spark sends it on
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f"{package.name}/{f.relative_to(package)}")
    spark.sparkContext.addPyFile(str(archive))


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for written intermediates, under the shared folder the cluster names.

    Without `spark.checkpoint.dir` a temporary folder is used, but only in local mode: on a cluster
    executors do not share the driver's disk.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="gridlake-")
    return f"{base.rstrip('/')}/gridlake/{name}-{uuid.uuid4().hex}"


def plan_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate for the optimised plan (file sizes scaled by the columns read)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def path_status(spark: SparkSession, path: str) -> str | None:
    """"dir", "file" or None, asked of the path's own file system."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(jvm_path):
        return None
    return "dir" if fs.getFileStatus(jvm_path).isDirectory() else "file"


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder, in order; none when there is no such folder."""
    if path_status(spark, path) != "dir":
        return []
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(jvm_path)
    return sorted(f.getPath().getName() for f in found)


def move_path(spark: SparkSession, path: str, to: str) -> None:
    """Rename a folder within its file system; `to` must not exist."""
    source, target = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (path, to))
    if not source.getFileSystem(spark._jsc.hadoopConfiguration()).rename(source, target):
        raise OSError(f"cannot move {path} to {to}")


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder this engine wrote, if it is there."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)
