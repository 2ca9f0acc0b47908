"""Files that all executors see, and memory given back."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable
from contextlib import suppress

import pyarrow as pa
from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in spark.checkpoint.dir; one of this machine only where none is named and all tasks run in this process, as in tests."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and (not context.master.startswith("local") or context.master.startswith("local-cluster")):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors see")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoint-"))
    return context.getCheckpointDir()


def trimmed(spark: SparkSession) -> None:
    """The driver's JVM gives back native memory that it has freed, which the C library would hold for long; a JVM without that command goes on as it is."""
    jvm, new_array = spark.sparkContext._jvm, spark.sparkContext._gateway.new_array
    try:
        # by the interface's method: the server's own class is closed to reflection
        invoke = next(m for m in jvm.java.lang.Class.forName("javax.management.MBeanServer").getMethods() if m.getName() == "invoke")
        args = new_array(jvm.java.lang.Object, 4)
        args[0], args[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
        invoke.invoke(jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), args)
    except Py4JError:
        pass


def released() -> None:
    """A Python worker gives back memory that it has freed: it is kept for later stages, and its allocators would hold what its largest block took."""
    pa.default_memory_pool().release_unused()
    with suppress(AttributeError, OSError):  # a C library without that call
        ctypes.CDLL(None).malloc_trim(0)


def lean(f: Callable) -> Callable:
    """f, a function of a group (key, table) or of two (key, table, other), with released() after each call."""

    def one(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        out = f(key, table)
        released()
        return out

    def two(key: tuple[pa.Scalar, ...], table: pa.Table, other: pa.Table) -> pa.Table:
        out = f(key, table, other)
        released()
        return out

    return one if f.__code__.co_argcount == 2 else two


def cut(df: DataFrame) -> DataFrame:
    """df, computed now and kept in the shared folder: later plans read it, and lost executors cost nothing."""
    shared_folder(df.sparkSession)
    out = df.checkpoint(eager=True)
    trimmed(df.sparkSession)
    return out


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder, read again."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """df over all cores: an input of fewer partitions than cores is dealt out before costly work; others stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.isStreaming or df._jdf.rdd().getNumPartitions() >= cores else df.repartition(cores)


def dealt(df: DataFrame) -> DataFrame:
    """df for work that costs far more than reading: at least eight tasks a core, so that a task's share of a large input stays small."""
    tasks = 8 * df.sparkSession.sparkContext.defaultParallelism
    return df if df.isStreaming or df._jdf.rdd().getNumPartitions() >= tasks else df.repartition(tasks)


def removed(df: DataFrame) -> None:
    """Deletes the files of a table that written() gave."""
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        deleted(df.sparkSession, folder)


def deleted(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
