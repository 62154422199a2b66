"""Tables written in the cluster's shared folder to cut lineage."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}
_WRITTEN: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which driver and executors share.

    Only where the session names none (tests on one machine) a folder is made.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        _OWN[app] = "file://" + tempfile.mkdtemp(prefix="pvscan-")
    return _OWN[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, deleted when the driver's Python ends."""
    path = f"{shared_dir(spark)}/pvscan-{name}-{uuid.uuid4().hex}"
    _WRITTEN.append((spark, path))
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back: later plans start from it."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._scratch = path
    return table


def discard(*tables: DataFrame) -> None:
    """Deletes tables that ``written`` returned and that no later plan reads."""
    for table in tables:
        path = getattr(table, "_scratch", None)
        if path:
            remove(table.sparkSession, path)
            _WRITTEN[:] = [x for x in _WRITTEN if x[1] != path]


def remove(spark: SparkSession, path: str) -> None:
    """Delete a path of any store that Spark's Hadoop client reaches."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


@atexit.register
def _clean() -> None:
    for spark, path in _WRITTEN:
        try:
            remove(spark, path)
        except Exception:  # the session may be gone already
            pass
    for folder in _OWN.values():
        shutil.rmtree(folder.removeprefix("file://"), ignore_errors=True)
