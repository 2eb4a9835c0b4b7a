"""Distinct counts by bitmaps and by rows, against Spark's own."""

from pyspark.sql import functions as F

from tests.test_operators import rows
from veraz.operators import bitmaps, gold

KIND = "periodo string, g string, v string"


def _data(spark):
    made = [(f"2026-{m:02d}", g, f"v{(i * m) % 40_000}") for m in (1, 2, 3) for g, n in (("a", 50_000), ("b", 7)) for i in range(n)]
    return spark.createDataFrame(made + [("2026-01", "a", None), ("2026-01", None, "v1"), ("2026-01", "c", None)], KIND).repartition(5)


def test_dense_ids(spark):
    data = _data(spark)
    got = sorted((r.id, r.valor) for r in bitmaps.dense_ids(data, "v").collect())
    assert [i for i, _ in got] == list(range(1, 40_001)) and len({v for _, v in got}) == 40_000
    again = sorted((r.id, r.valor) for r in bitmaps.dense_ids(data.repartition(3).union(data), "v").collect())
    assert got == again and bitmaps.dense_ids(data.limit(0), "v").count() == 0


def test_periods_add_up(spark):
    data = _data(spark)
    maps = bitmaps.by_period(data, ("periodo", "g"), "v", bitmaps.dense_ids(data, "v"))
    assert maps.groupBy("periodo", "g", "balde").count().where("count > 1").count() == 0
    for some in (["2026-01"], ["2026-01", "2026-03"], ["2026-01", "2026-02", "2026-03"]):
        chosen = F.col("periodo").isin(some)
        got = bitmaps.counted(maps.where(chosen), ["g"], "n")
        want = data.where(chosen).where("v is not null").groupBy("g").agg(F.count_distinct("v").alias("n"))
        assert rows(got, "g", "n") == rows(want, "g", "n")
    # Later bitmaps of the same ids, written apart, add up with the first.
    parts = [bitmaps.by_period(data.where(F.col("periodo") == p), ("periodo", "g"), "v", bitmaps.dense_ids(data, "v")) for p in ("2026-01", "2026-02")]
    both = data.where("periodo <> '2026-03' and v is not null").groupBy("g").agg(F.count_distinct("v").alias("n"))
    assert rows(bitmaps.counted(parts[0].unionByName(parts[1]), ["g"], "n"), "g", "n") == rows(both, "g", "n")


def test_counts_by_rows(spark):
    data = _data(spark)
    got = gold.distinct_counts(data, ("g",), {"v": "vs", "periodo": "ps"}, "periodo")
    want = data.groupBy("g").agg(F.count_distinct("v").alias("vs"), F.count_distinct("periodo").alias("ps"), F.min("periodo").alias("_first"), F.max("periodo").alias("_last"))
    assert rows(got, *want.columns) == rows(want, *want.columns)
    assert "Expand" not in got._jdf.queryExecution().executedPlan().toString()
    assert gold.distinct_counts(data.limit(0), ("g",), {"v": "vs"}).count() == 0
