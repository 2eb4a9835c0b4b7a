"""Ways to cut lineage and to keep intermediate tables that survive the loss of executors."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir. Only on one machine, as in tests,
    a temporary folder stands in and becomes the session's checkpoint folder."""
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not named:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        named = f"file://{tempfile.mkdtemp(prefix='checkpoint-')}"
        context.setCheckpointDir(named)
    return named


def checkpoint(df: DataFrame) -> DataFrame:
    """The same rows, computed now and read from the shared folder from here on."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def _where(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def delete_at_exit(spark: SparkSession, path: str) -> None:
    where, system = _where(spark, path)
    system.deleteOnExit(where)


def written(df: DataFrame, codec: str = "zstd") -> DataFrame:
    """The same rows, written now as Parquet in the shared folder, deleted when the driver ends or by
    ``drop``. Compressed columns take less room than checkpoint() needs for large rows."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    df.write.option("compression", codec).parquet(path)
    delete_at_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def drop(df: DataFrame) -> None:
    """Deletes the files of a table made by ``written``; nothing may read it afterwards."""
    spark = df.sparkSession
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        where, system = _where(spark, folder)
        system.delete(where, True)


def give_back() -> None:
    """Hands freed memory back to the system, where the C library can. Workers are used again by later
    tasks and stages, which would find what earlier ones have left."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def giving_back(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The same function of batches, with freed memory handed back at its end."""

    def inner(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            give_back()

    return inner
