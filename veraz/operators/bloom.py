"""Semi joins that drop most rows before they are shuffled.

By the number of wanted keys, counted first: few are broadcast whole; more become a Bloom filter that is
broadcast and applied to the rows where they lie, and an exact semi join of what passes decides; beyond
``FILTERED`` the exact join runs alone. The rows are the same each time.

The filter is a table of 64-bit words: a key's hash names one word and ``BITS`` bits in it, and the word of
all keys is their ``bit_or``, aggregated where the keys lie. With some four keys a word about one foreign key
in a hundred passes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Keys up to which they are broadcast themselves (some 20 MB), and up to which their filter is (at most 2^21 words, some 100 MB).
BROADCAST, FILTERED = 200_000, 8_000_000
KEYS_A_WORD, BITS = 4, 4


def words(keys: int) -> int:
    """The words of a filter of so many keys: a power of two."""
    return 1 << max(0, -(-keys // KEYS_A_WORD) - 1).bit_length()


def _word(key: Column, size: int) -> Column:
    return F.xxhash64(key).bitwiseAND(F.lit(size - 1))


def _bits(key: Column) -> Column:
    """Bits of a word, from a part of the hash that doesn't pick the word."""
    h = F.xxhash64(key)
    bits = F.lit(0).cast("long")
    for k in range(BITS):
        place = F.shiftrightunsigned(h, 64 - 6 * (k + 1)).bitwiseAND(F.lit(63)).cast("int")
        bits = bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))
    return bits


def bloom_filter(keys: DataFrame, count: int) -> DataFrame:
    """(_palavra, _bits) of the only column of ``keys``, of which there are so many."""
    key = F.col(keys.columns[0])
    return keys.where(key.isNotNull()).groupBy(_word(key, words(count)).alias("_palavra")).agg(F.bit_or(_bits(key)).alias("_bits"))


def passing(rows: DataFrame, key: str, filtered: DataFrame, count: int) -> DataFrame:
    """Rows whose key may be among those of a filter of so many keys."""
    own = rows[key]
    here = (_word(own, words(count)) == filtered["_palavra"]) & (F.bitwise_not(filtered["_bits"]).bitwiseAND(_bits(own)) == 0)
    return rows.join(F.broadcast(filtered), here, "left_semi")


def semi_join(rows: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """Rows whose key is in the only column of ``wanted``. Nulls never are. Runs a job that counts the keys."""
    (name,) = wanted.columns
    keys = wanted.select(F.col(name).cast(rows.schema[key].dataType).alias("_chave")).where("_chave is not null").distinct()
    count = keys.count()
    if count <= BROADCAST:
        return rows.join(F.broadcast(keys), rows[key] == keys["_chave"], "left_semi")
    if count <= FILTERED:
        rows = passing(rows, key, bloom_filter(keys, count), count)
    return rows.join(keys, rows[key] == keys["_chave"], "left_semi")
