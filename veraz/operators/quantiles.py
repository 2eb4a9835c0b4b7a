"""Quantiles that add up: sketches by period and group, merged without the rows.

A sketch (KLL) keeps a bounded sample of ranks; the rank of a quantile that it gives is off by at most
``rank_error`` in 99 of 100 cases, whatever the values are, and a merged sketch is as good as one of all
rows. With many equal values a quantile is exact as soon as the value covers that range of ranks.
Smallest and largest values and counts are exact.

``discrete`` gives exact quantiles of all rows instead, without a table of all values in one task.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from fractions import Fraction
from functools import reduce
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: What sketches keep; a sketch takes some 3 * SIZE numbers.
SIZE = 4000


def rank_error(size: int = SIZE) -> float:
    """Of a share between 0 and 1, as published for this kind of sketch."""
    return 2.296 / size**0.9723


def by_period(rows: DataFrame, keys: Sequence[str], value: str, size: int = SIZE) -> DataFrame:
    """(keys, esboco, observacoes, minimo, maximo) of the values that aren't null; the period is one of the keys."""
    v = F.col(value).cast("double")
    known = rows.where(v.isNotNull() & ~F.isnan(v)).withColumn("_v", v)
    return known.groupBy(*keys).agg(F.kll_sketch_agg_double("_v", size).alias("esboco"), F.count("*").alias("observacoes"), F.min("_v").alias("minimo"), F.max("_v").alias("maximo"))


def merged(sketches: DataFrame, keys: Sequence[str], size: int = SIZE) -> DataFrame:
    """The same by fewer keys, from sketches of any periods."""
    return sketches.groupBy(*keys).agg(F.kll_merge_agg_double("esboco", size).alias("esboco"), F.sum("observacoes").alias("observacoes"), F.min("minimo").alias("minimo"), F.max("maximo").alias("maximo"))


def quantiles(sketches: DataFrame, shares: Mapping[str, float]) -> DataFrame:
    """Adds a column for each share (name -> between 0 and 1) in the place of the sketch."""
    return sketches.withColumns({n: F.kll_sketch_get_quantile_double("esboco", F.lit(p)) for n, p in shares.items()}).drop("esboco")


def off_by(rows: DataFrame, found: DataFrame, keys: Sequence[str], value: str, shares: Mapping[str, float]) -> DataFrame:
    """By keys, how far the ranks of quantiles lie from their shares (the largest of them), counted over the
    rows: a quantile may lie anywhere within the ranks of its equals."""
    named = found.select(*(F.col(k).alias(f"_{k}") for k in keys), *(F.col(n).alias(f"_{n}") for n in shares))
    joined = rows.where(F.col(value).isNotNull()).join(named, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    below = lambda n: F.avg((F.col(value) < F.col(f"_{n}")).cast("double"))
    up_to = lambda n: F.avg((F.col(value) <= F.col(f"_{n}")).cast("double"))
    return joined.groupBy(*keys).agg(F.greatest(F.lit(0.0), *(below(n) - p for n, p in shares.items()), *(p - up_to(n) for n, p in shares.items())).alias("desvio"))


def discrete(rows: DataFrame, value: str, shares: Mapping[str, float], accuracy: int = 10000) -> DataFrame:
    """One row: for each share the smallest value that at least this share of the values doesn't exceed; nulls
    aren't values, and without values it is null.

    Sketched quantiles on both sides of each share cut the values into cells, the rows of the cells are counted,
    and the cells that hold a wanted rank are taken apart by value. The cuts decide how many rows these hold
    (some 4 / ``accuracy`` of all for a share, and a value with more has a cell of its own), never what is found.
    The rows are read three times; two of these jobs run here, as the ranks depend on them.
    """
    known = rows.select(F.col(value).alias("_v")).where(F.col("_v").isNotNull())
    near = sorted({min(1.0, max(0.0, p + d / accuracy)) for p in shares.values() for d in (-2, 2)})
    size = F.col("_v").cast("double")
    seen = known.agg(F.count("*").alias("n"), F.percentile_approx(size, near, accuracy).alias("cuts")).first()
    cuts = {c for c in seen.cuts or () if not math.isnan(c)}
    # Below, at or above each cut: cells follow the order of the values, as doubles of larger ones are never smaller.
    cells = known.withColumn("_cell", reduce(add, ((size >= c).cast("int") + (size > c).cast("int") for c in cuts), F.lit(0)))
    place, below = {}, 0
    ranks = {name: max(1, math.ceil(Fraction(str(p)) * seen.n)) for name, p in shares.items()}
    for cell, n in sorted(map(tuple, cells.groupBy("_cell").count().collect())):
        place |= {name: (cell, k - below) for name, k in ranks.items() if below < k <= below + n}
        below += n
    values = cells.where(F.col("_cell").isin([cell for cell, _ in place.values()])).groupBy("_cell", "_v").agg(F.count("*").alias("_n"))
    ranked = values.withColumn("_up_to", F.sum("_n").over(W.partitionBy("_cell").orderBy("_v")))
    at = lambda cell, k: F.min(F.when((F.col("_cell") == cell) & (F.col("_up_to") >= k), F.col("_v")))
    return ranked.agg(*(at(*place.get(name, (-1, 1))).alias(name) for name in shares))
