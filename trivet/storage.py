"""Durable cuts of lineage in the folder that the whole cluster shares."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}
_left: dict[str, SparkSession] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors see: spark.checkpoint.dir.

    Where that is unset, a local session gets a temporary folder of its own; on a cluster executors
    could not see such a folder, so it is an error there.
    """
    given = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if given:
        return given.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = "file://" + tempfile.mkdtemp(prefix="trivet-")
    return _own[app]


def new_path(spark: SparkSession, what: str) -> str:
    """A fresh folder name in the shared folder; removed when the driver's Python ends, if not before."""
    path = f"{shared_dir(spark)}/trivet-{what}-{uuid.uuid4().hex}"
    _left[path] = spark
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder through Hadoop's file system; a session that has ended leaves it."""
    _left.pop(path, None)
    if spark.sparkContext._jsc is None:
        return
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


@atexit.register
def _remove_left() -> None:
    for path, spark in list(_left.items()):
        remove(spark, path)


def cut(df: DataFrame, what: str) -> DataFrame:
    """Writes df as a table in the shared folder and reads it back: a durable cut of lineage."""
    spark = df.sparkSession
    path = new_path(spark, what)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._cut_path = path
    return out


def free(*cuts: DataFrame) -> None:
    """Deletes the tables behind cuts that nothing reads any more; frames that are no cuts stay."""
    for df in cuts:
        if path := getattr(df, "_cut_path", None):
            remove(df.sparkSession, path)
