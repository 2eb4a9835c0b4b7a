"""Semi joins behind a filter against plain ones."""

import pytest
from pyspark.sql import functions as F

from veraz.operators import bloom

SIZES = {"broadcast": (10**9, 10**9), "filter": (0, 10**9), "plain": (0, 0)}


@pytest.mark.parametrize("way", SIZES)
def test_same_rows(spark, monkeypatch, way):
    """Half of the rows hold one key; nulls, repeated keys, keys of the rows' and of another type, no keys."""
    monkeypatch.setattr(bloom, "BROADCAST", SIZES[way][0])
    monkeypatch.setattr(bloom, "FILTERED", SIZES[way][1])
    data = spark.range(20_000).select(F.expr("if(id % 2 = 0, '00000007', if(id % 101 = 0, null, lpad(cast(id as string), 8, '0')))").alias("k"), "id").repartition(4)
    wanted = spark.range(3_000).select(F.expr("if(id % 50 = 0, null, lpad(cast(id div 2 * 7 as string), 8, '0'))").alias("cnpj"))
    for rows, keys in ((data, wanted), (data.withColumn("k", F.col("k").cast("long")), wanted), (data, wanted.limit(0)), (data.limit(0), wanted)):
        plain = rows.join(keys.select(F.col("cnpj").cast(rows.schema["k"].dataType).alias("c")), F.col("k") == F.col("c"), "left_semi")
        got = bloom.semi_join(rows, "k", keys)
        assert got.columns == ["k", "id"] and sorted(map(tuple, got.collect())) == sorted(map(tuple, plain.collect()))


def test_few_foreign_keys_pass_and_no_wanted_one_is_lost(spark):
    """The exchange gets the rows that pass only: near the number of matches."""
    keys = spark.range(0, 60_000, 3).select(F.col("id").cast("string").alias("k"))
    rows = spark.range(600_000).select(F.col("id").cast("string").alias("k"))
    through = bloom.passing(rows, "k", bloom.bloom_filter(keys, 20_000), 20_000)
    assert through.join(keys, "k", "left_semi").count() == 20_000
    assert through.count() <= 20_000 + 0.02 * 580_000


def test_the_filter_runs_before_the_exchange(spark, monkeypatch):
    monkeypatch.setattr(bloom, "BROADCAST", 10)
    rows, keys = spark.range(100_000).withColumnRenamed("id", "k"), spark.range(0, 100_000, 50)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = bloom.semi_join(rows, "k", keys)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = plan.splitlines()
    exact, exchange, early = (next(i for i, x in enumerate(lines) if n in x) for n in ("SortMergeJoin", "Exchange hashpartitioning(", "BroadcastHashJoin"))
    assert exact < exchange < early and "LeftSemi" in lines[early]


def test_words():
    assert [bloom.words(n) for n in (0, 1, 4, 5, 8, 9, 8_000_000)] == [1, 1, 1, 2, 2, 4, 1 << 21]
