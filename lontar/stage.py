"""Intermediate tables in the folder that the cluster shares.

An iterative operator cuts its lineage by writing a table under ``spark.checkpoint.dir``
and reading it back, so a lost executor costs a re-read and not a re-run. Where that
setting is missing a local session gets a temporary folder; any other session is refused,
because a machine-local folder is not visible to the other executors.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_local: list[str] = []
_bases: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, or a temporary one in a local session."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if where:
        return where.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if not _local:
        _local.append(tempfile.mkdtemp(prefix="lontar-"))
    return "file://" + _local[0]


def sweep(spark: SparkSession) -> None:
    """Delete all stages of this process, on any file system. Their results can't be read after that."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for base in list(_bases):
        path = jvm.org.apache.hadoop.fs.Path(base)
        path.getFileSystem(conf).delete(path, True)
        _bases.remove(base)


@atexit.register
def _at_exit() -> None:
    """Stages go with the driver: through Spark while it runs, which reaches any file system."""
    spark = SparkSession.getActiveSession()
    try:
        if spark is not None and spark.sparkContext._jsc is not None:
            sweep(spark)
    except Exception:  # noqa: BLE001  the JVM may be gone; local folders are still cleared
        pass
    for folder in (*_local, *(b.removeprefix("file://") for b in _bases if b.startswith(("/", "file://")))):
        shutil.rmtree(folder, ignore_errors=True)


FEW = 10_000  # rows that may be broadcast


def few(df: DataFrame, rows: int = FEW) -> DataFrame:
    """``df`` marked for broadcast if it is counted to have at most ``rows`` rows, else as it is."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def beside(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """The columns of a table of one row at every row of ``df``."""
    return df.withColumn("_one", F.lit(1)).join(F.broadcast(one_row.withColumn("_one", F.lit(1))), "_one").drop("_one")


class Stages:
    """Tables written by one run of an operator, each under a name of its own. They stay until
    the driver ends, as results read them lazily, or until :func:`sweep`."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.base = f"{shared_folder(spark)}/lontar-{label}-{uuid.uuid4().hex}"
        _bases.append(self.base)

    def write(self, df: DataFrame, name: str, by: str | None = None) -> DataFrame:
        """Write ``df`` and return the table read back with the same schema; ``by`` names a column
        of few values that has a folder for each, so that a filter on it reads no other."""
        path = f"{self.base}/{name}"
        (df.write.partitionBy(by) if by else df.write).mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Delete tables that nothing reads any more."""
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}")
            path.getFileSystem(conf).delete(path, True)
