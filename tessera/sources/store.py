"""The folder that driver and executors share, for files that one job writes and a later one reads."""

from __future__ import annotations

import atexit
import contextlib
import gc
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Folders of this process's intermediates, deleted when it ends.
_MADE: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """A new folder URI under spark.checkpoint.dir; where that is unset, under the warehouse, or for a local master under a temporary folder.

    A path without a scheme is one of Hadoop's default file system. The folder is deleted when the driver's Python ends, or by ``cleanup``."""
    conf = spark.sparkContext.getConf()
    base = conf.get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if master.startswith("local") and not master.startswith("local-cluster"):
            base = "file://" + os.path.join(tempfile.gettempdir(), "tessera-work")
        else:
            base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_work"
    _MADE.append(f"{qualified(spark, base).rstrip('/')}/{uuid.uuid4().hex}")
    return _MADE[-1]


def qualified(spark: SparkSession, path: str) -> str:
    """The path as a URI, by Hadoop's default file system where it has no scheme."""
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    uri = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return uri if "://" in uri else uri.replace(":", "://", 1)


def cleanup() -> None:
    """Delete all folders that this process has made; results that still read from them are lost."""
    from pyarrow import fs

    while _MADE:
        try:
            store, path = fs.FileSystem.from_uri(_MADE.pop())
            store.delete_dir(path)
        except OSError:
            pass  # never written to, or its store is gone


atexit.register(cleanup)


def discard(*handed: DataFrame) -> None:
    """Delete what ``handed`` wrote for these frames; nothing may read them any more."""
    from pyarrow import fs

    for df in handed:
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            try:
                store, path = fs.FileSystem.from_uri(folder)
                store.delete_dir(path)
            except OSError:
                pass  # a store that only Spark knows; ``cleanup`` tries again


def swept(spark: SparkSession) -> None:
    """Let the shuffles of jobs that have ended go now; else they stay on disk until the driver happens to collect its garbage."""
    gc.collect()
    spark._jvm.System.gc()


@contextlib.contextmanager
def sparing(spark: SparkSession):
    """Within it a job's shuffles go as soon as its rows are written or collected, where Spark can do that."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def handed(df: DataFrame | list[DataFrame], name: str = "t", codec: str = "zstd") -> DataFrame:
    """Write the rows to the shared folder as Parquet and read them back: later jobs start from files, not from lineage.

    Of several frames, all of the same columns, one is written after another."""
    each = df if isinstance(df, list) else [df]
    spark, schema = each[0].sparkSession, each[0].schema
    path = f"{shared_dir(spark)}/{name}"
    for x in each:
        x.write.mode("append").option("compression", codec).parquet(path)
    return spark.read.schema(schema).parquet(path)
