"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}
_marked: set[str] = set()


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; on plain local Spark a temporary one, removed at exit."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = tempfile.mkdtemp(prefix="ledgerlark-")
        atexit.register(shutil.rmtree, _own[app], ignore_errors=True)
    return _own[app]


def run_folder(spark: SparkSession) -> str:
    """This application's own folder in the shared one. Its JVM deletes it when it ends."""
    folder = f"{shared_folder(spark)}/ledgerlark-{spark.sparkContext.applicationId}"
    if folder not in _marked:
        path, files = _hadoop(spark, folder)
        files.mkdirs(path)
        files.deleteOnExit(path)
        _marked.add(folder)
    return folder


def _hadoop(spark: SparkSession, folder: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def release(spark: SparkSession) -> None:
    """Delete this application's folder now. Tables stored in it can be read no more."""
    folder = run_folder(spark)
    path, files = _hadoop(spark, folder)
    files.delete(path, True)
    _marked.discard(folder)


def new_path(spark: SparkSession, name: str) -> str:
    """A path in this application's folder that nothing else uses."""
    return f"{run_folder(spark)}/{name}-{uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as parquet to the shared folder and read it back.

    Cuts the lineage so that a lost executor costs a read, not a recomputation; gives later
    joins the true size of the table; keeps retried tasks from seeing anything half written.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
