"""Sharding by a two-pass external shuffle, in DataFrame functions only.

First pass: every record is scattered by seeded hashes into a bucket that fits in memory. The
record's key picks the shard by rendezvous hashing (the shard whose hash with the key is highest),
so one more shard takes records only into itself; a hash of the record's contents picks one of
the shard's buckets, so a frequent key is spread over them. Second pass: each bucket is one task. It is put
in the order of its contents, shuffled by Fisher and Yates' algorithm (what ``shuffle`` does to an
array, with a seed of the bucket) and laid out behind the shard's earlier buckets. ``stored``
writes the buckets by shard and reads them back.

The same records get the same slots however the input is partitioned. Records that are equal in all
columns share a bucket, unless that overflows: then its records are dealt by their place in the input,
which is written first so that a retry finds the same places.

The number of buckets follows the bytes and rows of the table. Beyond ``MAX_BUCKETS`` tasks (4 TB at
16 MB) buckets grow instead.

Defined results: a null text has size 16 and checksum 0; null keys are one key; repeated rows get
a slot each; an empty table gives no rows; other columns are carried along (those that have no order
or hash, such as maps, don't take part in the choice of the bucket or the order before the shuffle).
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veraz.llm.shared import delete_at_exit, shared_dir, written

OVERHEAD = 16
BUCKET_BYTES, BUCKET_ROWS = 16 << 20, 100_000
MAX_BUCKETS = 1 << 18


def record_size(text_col: str) -> Column:
    return (F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)) + OVERHEAD).cast("long")


def rendezvous(key: str, shards: int, seed: int) -> str:
    """SQL: the shard in 0 .. shards - 1 with the highest hash; ties go to the higher number."""
    return f"array_max(transform(sequence(0, {shards - 1}), s -> named_struct('h', xxhash64({seed}, s, {key}), 's', s))).s"


def _plain(kind: T.DataType) -> bool:
    """Whether values of a type can be hashed and ordered."""
    if isinstance(kind, T.StructType):
        return all(_plain(f.dataType) for f in kind)
    if isinstance(kind, T.ArrayType):
        return _plain(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType, T.CalendarIntervalType))


def shard(df: DataFrame, shards: int, key_col: str = "doc_id", text_col: str = "text", seed: int = 20_011, bucket_bytes: int = BUCKET_BYTES, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """All columns of the input with shard int, slot long (gapless from 0 in each shard, in random
    order) and grown_shard int (the shard if there were one more). Columns of these names are replaced."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    own = [c for c in df.columns if c.lower() not in ("shard", "slot", "grown_shard")]
    plain = [c for c in own if _plain(df.schema[c].dataType)]
    first = [c for c in (key_col, text_col) if c in plain]
    ordered = [*first, *(c for c in plain if c not in first), *(c for c in own if c not in plain)]
    stats = df.agg(F.sum(record_size(text_col)).alias("bytes"), F.count("*").alias("rows")).first()
    parts = max(1, -(-(stats["bytes"] or 0) // (shards * bucket_bytes)), -(-stats["rows"] // (shards * bucket_rows)))
    parts = min(parts, max(1, MAX_BUCKETS // shards))

    def bucket(within: Column) -> Column:
        return (F.expr(rendezvous(f"`{key_col}`", shards, seed)) * parts + F.pmod(within, F.lit(parts))).cast("int")

    def counted(rows: DataFrame) -> DataFrame:
        return rows.select("_bucket", record_size(text_col).alias("_size")).groupBy("_bucket").agg(F.count("*").alias("_n"), F.sum("_size").alias("_bytes"))

    placed = df.select(*own, bucket(F.xxhash64(F.lit(seed + 1), *(F.col(c) for c in ordered[: len(plain)]))).alias("_bucket"))
    sizes = written(counted(placed))
    if parts > 1 and sizes.where(F.col("_bytes") > 4 * bucket_bytes).limit(1).count():
        full = sizes.where(F.col("_bytes") > 4 * bucket_bytes).select("_bucket", F.lit(True).alias("_full"))
        dealt = F.when(F.col("_full"), bucket(F.xxhash64(F.monotonically_increasing_id()))).otherwise(F.col("_bucket"))
        placed = written(placed.join(full, "_bucket", "left").withColumn("_bucket", dealt).drop("_full"))
        sizes = written(counted(placed))
    offsets = sizes.select("_bucket", F.expr(f"coalesce(sum(_n) over (partition by _bucket div {parts} order by _bucket rows between unbounded preceding and 1 preceding), 0)").alias("_offset"))
    records = placed.select("_bucket", F.struct(*ordered).alias("_record"))
    both = records.withColumn("_offset", F.lit(None).cast("long")).unionByName(offsets.withColumn("_record", F.lit(None).cast(records.schema["_record"].dataType)))
    # One task a bucket: shuffle() seeds its random numbers by the number of the task.
    buckets = both.repartitionById(shards * parts, F.col("_bucket")).groupBy("_bucket").agg(F.collect_list("_record").alias("_records"), F.max("_offset").alias("_offset"))
    if len(plain) == len(own):
        kept = F.array_sort("_records")
    else:  # structs with maps can't be compared: their places are ordered instead
        keys = F.transform("_records", lambda r, i: F.struct(*(r[c].alias(c) for c in ordered[: len(plain)]), i.alias("_i")))
        kept = F.transform(F.array_sort(keys), lambda k: F.element_at("_records", k["_i"] + 1))
    laid = buckets.select("_bucket", "_offset", F.shuffle(kept, seed).alias("_records")).select("_bucket", "_offset", F.posexplode("_records").alias("_place", "_record"))
    out = laid.select(*(F.col("_record")[c].alias(c) for c in own), F.expr(f"cast(_bucket div {parts} as int)").alias("shard"), (F.col("_offset") + F.col("_place")).alias("slot"))
    grown = F.expr(rendezvous(f"`{key_col}`", shards + 1, seed)).cast("int")
    return out.withColumn("grown_shard", grown)


def write(sharded: DataFrame, path: str) -> None:
    """One folder for each shard; the rows of a file are those of a bucket in the order of their slots."""
    sharded.write.partitionBy("shard").parquet(path)


def stored(sharded: DataFrame) -> DataFrame:
    """The shards as they are read back after they have been written in the shared folder."""
    spark = sharded.sparkSession
    path = f"{shared_dir(spark)}/shards-{uuid.uuid4().hex}"
    write(sharded, path)
    delete_at_exit(spark, path)
    return spark.read.schema(sharded.schema).parquet(path)
