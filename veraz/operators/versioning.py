"""Current versions of entities, and versions that contradict each other.

Both operators reduce rows before the shuffle (conflicts by partial aggregation, the latest row by a
group limit that Spark pushes below the exchange), so an entity that holds a large part of all rows
is reduced where its rows lie and does not gather in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from veraz.functions.expr import content_hash


def latest(df: DataFrame, entity: Sequence[str] | str, order: Sequence[str]) -> DataFrame:
    """One row per entity: the one with the greatest ``order`` columns (nulls lowest). Ties are
    broken by all other columns, so the result doesn't depend on the order of rows."""
    entity = [entity] if isinstance(entity, str) else list(entity)
    ranked = [*order, *(c for c in df.columns if c not in order and c not in entity)]
    first = W.partitionBy(*entity).orderBy(*(F.desc_nulls_last(c) for c in ranked), *([] if ranked else entity))
    return df.withColumn("_place", F.row_number().over(first)).where(F.col("_place") == 1).drop("_place")


def with_content_hash(df: DataFrame, fields: Sequence[str], version: str) -> DataFrame:
    return df.withColumn("hash_conteudo", content_hash(fields, version)).withColumn("versao_hash", F.lit(version))


def split_versions(df: DataFrame, entity: str, moment: str = "atualizado_em", digest: str = "hash_conteudo", order: Sequence[str] = ("atualizado_em", "source_file_id")) -> tuple[DataFrame, DataFrame]:
    """(current rows, conflicting rows).

    Rows of one entity and moment with more than one content are all conflicts and leave; of the
    others the latest is current, so an older version can be current. An entity whose every version
    is in conflict has no current row. Null entities and moments are never in conflict.
    """
    moments = df.where(F.col(entity).isNotNull() & F.col(moment).isNotNull()).groupBy(entity, moment).agg(F.min(digest).alias("_lo"), F.max(digest).alias("_hi"))
    torn = moments.where("_lo <> _hi").select(entity, moment)
    conflicts = df.join(torn, [entity, moment], "left_semi")
    current = latest(df.join(torn, [entity, moment], "left_anti"), entity, order)
    return current, conflicts
