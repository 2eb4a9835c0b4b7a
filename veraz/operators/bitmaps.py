"""Exact distinct counts that add up: bitmaps of dense ids by period.

Values get dense ids once. A period's values in a group are bitmaps of 32,768 ids each, which is what is
kept; any stretch of periods is counted by putting its bitmaps together, without the rows. It suits
coarse groups (categories, agencies) with many values; for fine groups, whose bitmaps would be nearly
empty, ``gold.distinct_counts`` moves less.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Values are numbered side by side in so many parts.
PARTS = 1024


def dense_ids(rows: DataFrame, column: str) -> DataFrame:
    """(valor, id): the distinct values that aren't null with ids from 1 on, without gaps. Values are numbered
    in order within parts by their hash, after all of the parts before, so the ids depend on the
    values alone."""
    values = rows.select(F.col(column).alias("valor")).where("valor is not null").distinct().withColumn("parte", F.pmod(F.xxhash64("valor"), F.lit(PARTS)))
    before = values.groupBy("parte").count().select("parte", (F.sum("count").over(W.orderBy("parte")) - F.col("count")).alias("antes"))  # PARTS rows at most
    own = F.row_number().over(W.partitionBy("parte").orderBy("valor"))
    return values.join(F.broadcast(before), "parte").select("valor", (F.col("antes") + own).alias("id"))


def by_period(rows: DataFrame, keys: Sequence[str], column: str, ids: DataFrame) -> DataFrame:
    """(keys, balde, mapa): the bitmaps of a column's values for each combination of keys, the period among
    them. Rows that say the same are one before they are joined, so a frequent value is no hot key."""
    once = rows.select(*keys, F.col(column).alias("valor")).distinct().join(ids, "valor")
    return once.groupBy(*keys, F.bitmap_bucket_number("id").alias("balde")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("mapa"))


def counted(maps: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """The number of distinct values by ``keys`` (any of those of the bitmaps), whatever periods these come from."""
    together = maps.groupBy(*keys, "balde").agg(F.bitmap_or_agg("mapa").alias("mapa"))
    return together.groupBy(*keys).agg(F.sum(F.bitmap_count("mapa")).alias(name))
