"""The shared folder of the cluster, for tables that cut lineage, and how long these live.

A table written inside ``with scope(spark):`` goes when the block ends, unless the block's ``keep`` has handed it to
the scope around it. Without a scope it lives until ``release`` or the end of Python.
"""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

ROW_GROUP_BYTES = 16 << 20

_WRITTEN: dict[str, list[str]] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``, else the context's checkpoint folder, else one in the warehouse.

    A folder that nobody named and that is on the driver's own disk is refused on a cluster, whose executors would
    each write to a disk of their own.
    """
    if named := spark.conf.get("spark.checkpoint.dir", None):
        return named.rstrip("/")
    folder = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/checkpoints"
    if not spark.sparkContext.master.startswith("local") and _file_system(spark, folder)[1].getUri().getScheme() == "file":
        raise ValueError(f"{folder} is local to the driver: set spark.checkpoint.dir to a folder that all executors share")
    return folder.rstrip("/")


def new_table_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    path = f"{shared_folder(spark)}/guestbook/{name}-{uuid.uuid4().hex}"
    application = spark.sparkContext.applicationId
    if application not in _WRITTEN:
        _WRITTEN[application] = []
        atexit.register(release, spark)
    _WRITTEN[application].append(path)
    return path


@contextmanager
def scope(spark: SparkSession) -> Iterator[Scope]:
    """Delete what is written to the shared folder in the block when it ends, with or without an error."""
    application = spark.sparkContext.applicationId
    outer = _WRITTEN.pop(application, None)
    if outer is None:
        atexit.register(release, spark)
    _WRITTEN[application] = []
    block = Scope()
    try:
        yield block
    finally:
        written = _WRITTEN[application]
        _WRITTEN[application] = (outer or []) + [path for path in written if path in block.kept]
        for path in written:
            if path not in block.kept:
                _delete(spark, path)


class Scope:
    def __init__(self):
        self.kept: set[str] = set()

    def keep(self, df: DataFrame) -> DataFrame:
        """The tables that ``df`` reads outlive the block."""
        self.kept.update(_paths_of(df))
        return df


def settled(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: later plans start from the table, and a
    lost executor costs no recomputation of what led to it."""
    path = new_table_path(df.sparkSession, name)
    df.write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)  # small groups: whole texts fill a writer's memory
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _paths_of(df: DataFrame) -> list[str]:
    """Settled tables that ``df`` reads."""
    folders = {file.rpartition("/")[0].rpartition("/")[2] for file in df.inputFiles()}
    return [path for path in _WRITTEN.get(df.sparkSession.sparkContext.applicationId, []) if path.rpartition("/")[2] in folders]


def drop_tables(*tables: DataFrame) -> None:
    """Delete settled tables that no later plan reads."""
    for df in tables:
        spark = df.sparkSession
        for path in _paths_of(df):
            _delete(spark, path)
            _WRITTEN[spark.sparkContext.applicationId].remove(path)


def release(spark: SparkSession) -> None:
    """Delete every table that this application has written to the shared folder."""
    if spark.sparkContext._jsc is None:  # the session has been stopped
        return
    for path in _WRITTEN.pop(spark.sparkContext.applicationId, []):
        _delete(spark, path)


def _file_system(spark: SparkSession, path: str):
    """Hadoop's path and the store that holds it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = where.getFileSystem(spark._jsc.hadoopConfiguration())
    return where, store


def _delete(spark: SparkSession, path: str) -> None:
    where, store = _file_system(spark, path)
    store.delete(where, True)
