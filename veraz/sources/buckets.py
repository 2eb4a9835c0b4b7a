"""Tables laid out in hash buckets of their key, so that a change rewrites only the buckets it touches.

A bucket is a partition folder of the table. The partition column's name holds the number of buckets,
so the layout needs no record beside the table. A change reads the buckets that its keys fall in,
merges, writes them to a staged folder and swaps these folders alone. It pays while the change has
fewer keys than the table has buckets; a change of more keys rewrites them all, as a table without
buckets would.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PREFIX = "_balde_de_"
_FOLDER = re.compile(PREFIX + r"(\d+)=(\d+)")


def bucket(key: str | list[str], n: int) -> Column:
    return F.pmod(F.xxhash64(*([key] if isinstance(key, str) else key)), F.lit(n)).cast("int")


def folder(n: int, number: int) -> str:
    return f"{PREFIX}{n}={number}"


def plain(df: DataFrame) -> DataFrame:
    """The rows without the column of the layout."""
    return df.drop(*(c for c in df.columns if c.startswith(PREFIX)))


def laid_out(df: DataFrame, key: str | list[str], n: int) -> DataFrame:
    """The rows with the column of the layout, each bucket in one task."""
    name = f"{PREFIX}{n}"
    return df.withColumn(name, bucket(key, n)).repartition(name)


def layout(spark: SparkSession, path: str) -> int | None:
    """How many buckets a table has, or None if it isn't laid out so."""
    context = spark.sparkContext
    where = context._jvm.org.apache.hadoop.fs.Path(path)
    system = where.getFileSystem(context._jsc.hadoopConfiguration())
    if not system.exists(where):
        return None
    found = {int(m[1]) for s in system.listStatus(where) if (m := _FOLDER.fullmatch(s.getPath().getName()))}
    if len(found) > 1:
        raise ValueError(f"several layouts in {path}")
    return found.pop() if found else None


def touched(source: DataFrame, key: str | list[str], n: int) -> list[int]:
    """The buckets that hold the source's keys, ``n`` at most."""
    return sorted(r[0] for r in source.select(bucket(key, n)).distinct().collect())


def only(df: DataFrame, n: int, numbers: list[int], others: bool = False) -> DataFrame:
    """The rows in some buckets (or in all others), of which alone the files are read."""
    inside = F.col(f"{PREFIX}{n}").isin(numbers)
    return df.where(~inside if others else inside)
