"""The folder that driver and executors share, and tables and checkpoints in it."""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

#: Tables that are there: path -> the session that wrote it.
_tables: dict[str, SparkSession] = {}
_own: list[str] = []


def shared_root(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Only in local mode, where driver and executors are one process, a temporary folder of
    this process stands in where it is unset, as in tests."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError(f"spark.checkpoint.dir must name a folder that driver and executors share (master is {master})")
    if not _own:
        _own.append(tempfile.mkdtemp(prefix="siltlake-"))
        atexit.register(shutil.rmtree, _own[0], ignore_errors=True)
    return _own[0]


def reliable(df: DataFrame) -> DataFrame:
    """The same partitions and rows at every evaluation, kept in the shared folder."""
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(shared_root(df.sparkSession))
    return df.checkpoint()


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of the JVM's Hadoop client."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def new_folder(spark: SparkSession, label: str) -> str:
    """The name of a folder in the shared one that nobody else has. Its writer makes it."""
    return f"{shared_root(spark)}/siltlake/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write df to a table in the shared folder and read it again: cuts the lineage, so that a lost
    executor costs the tasks it ran and no more. The rows are those that the committed tasks wrote.
    Tables that are not discarded before are deleted when the process ends."""
    spark = df.sparkSession
    path = new_folder(spark, label)
    _tables[path] = spark
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._siltlake_path = path
    return out


def _delete(path: str) -> None:
    spark = _tables.pop(path, None)
    if spark:
        system, p = hadoop_path(spark, path)
        system.delete(p, True)


def discard(*tables: DataFrame) -> None:
    """Delete tables of materialise() that nothing needs any more."""
    for df in tables:
        _delete(getattr(df, "_siltlake_path", ""))


@contextlib.contextmanager
def scratch() -> Iterator[list[DataFrame]]:
    """Deletes at its end the tables that were written within it, but for those put into the list it gives."""
    before, keep = set(_tables), []
    try:
        yield keep
    finally:
        for path in set(_tables) - before - {getattr(df, "_siltlake_path", "") for df in keep}:
            _delete(path)


@atexit.register
def _delete_all() -> None:
    for path in list(_tables):
        with contextlib.suppress(Exception):  # the JVM may be gone
            _delete(path)
