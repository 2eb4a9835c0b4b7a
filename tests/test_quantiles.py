"""Merged sketches against the rows: many equal values, skew, nulls."""

import math
import random
from decimal import Decimal

import pytest

from tests.test_operators import rows
from veraz.operators import quality, quantiles

AT = {"p01": 0.01, "p10": 0.1, "p50": 0.5, "p90": 0.9, "p99": 0.99}


def test_merged_sketches_keep_the_error(spark):
    rnd = random.Random(7)
    kinds = {"ties": lambda: float(rnd.choice([1, 1, 1, 2, 5])), "skew": lambda: rnd.paretovariate(0.5), "even": rnd.random}
    made = [(f"2026-{m:02d}", k, f()) for k, f in kinds.items() for m in range(1, 7) for _ in range(4_000 * m)]
    data = spark.createDataFrame([*made, ("2026-01", "even", None), ("2026-01", "empty", None), ("2026-01", "even", float("nan"))], "periodo string, g string, v double").repartition(6)
    size = 300
    months = quantiles.by_period(data, ("periodo", "g"), "v", size).cache()
    assert months.count() == 18
    sound = data.where("v is not null and not isnan(v)")
    for chosen in ("periodo <= '2026-03'", "true"):
        whole = quantiles.merged(months.where(chosen), ["g"], size)
        direct = quantiles.by_period(data.where(chosen), ["g"], "v", size)
        facts = [rows(x, "g", "observacoes", "minimo", "maximo") for x in (whole, direct)]
        assert facts[0] == facts[1] and len(facts[0]) == 3
        for sketches in (whole, direct):
            off = quantiles.off_by(sound.where(chosen), quantiles.quantiles(sketches, AT), ["g"], "v", AT)
            assert {r.g for r in off.collect()} == set(kinds) and all(r.desvio <= 3 * quantiles.rank_error(size) for r in off.collect())
    (ties,) = quantiles.quantiles(quantiles.merged(months, ["g"], size), AT).where("g = 'ties'").collect()
    assert (ties.p01, ties.p10, ties.p50, ties.p90, ties.p99) == (1.0, 1.0, 1.0, 5.0, 5.0)
    assert quantiles.merged(months.limit(0), ["g"], size).count() == 0


def test_a_wrong_quantile_is_seen(spark):
    data = spark.createDataFrame([("a", float(i)) for i in range(100)], "g string, v double")
    found = spark.createDataFrame([("a", 80.0)], "g string, m double")
    assert abs(quantiles.off_by(data, found, ["g"], "v", {"m": 0.5}).first().desvio - 0.3) < 1e-9


def picked(values, p):
    known = sorted(values, key=lambda v: (math.isnan(v), v))
    return known[max(1, math.ceil(Decimal(str(p)) * len(known))) - 1]


@pytest.mark.parametrize("accuracy", [10000, 50, 1])
def test_discrete_quantiles_whatever_the_cuts(spark, accuracy):
    rnd = random.Random(11)
    at = {"p0": 0.0, "p5": 0.5, "p9": 0.9, "p999": 0.999, "p1": 1.0}
    kinds = {
        "even": [rnd.random() for _ in range(5_000)],
        "hot": [0.0] * 3_000 + [rnd.gauss(0, 1) for _ in range(2_000)],
        "few": [float(i) for i in range(10)],
        "odd": [-math.inf, -0.0, 0.0, 1e300, math.inf, math.nan, math.nan],
        "one": [7.5],
    }
    for kind, values in kinds.items():
        shuffled = rnd.sample([*values, None, None], len(values) + 2)
        data = spark.createDataFrame([(v,) for v in shuffled], "v double").repartition(3)
        (got,) = quantiles.discrete(data, "v", at, accuracy).collect()
        want = {n: picked(values, p) for n, p in at.items()}
        assert all(got[n] == w or math.isnan(got[n]) and math.isnan(w) for n, w in want.items()), (kind, got, want)
    assert set(quantiles.discrete(data.where("v is null"), "v", at).first()) == set(quantiles.discrete(data.limit(0), "v", at).first()) == {None}


def test_discrete_quantiles_of_decimals_beyond_doubles(spark):
    values = [Decimal(9_999_999_999_999_000) + Decimal(i) / 100 for i in range(1_000)]
    data = spark.createDataFrame([(v,) for v in reversed(values)], "v decimal(18,2)")
    assert quantiles.discrete(data, "v", {"a": 0.5, "b": 0.999}).first().asDict() == {"a": values[499], "b": values[998]}


def test_exact_audit_holds_no_table_of_all_values(spark):
    awards = spark.range(30_000).selectExpr("cast(id * 7919 % 30000 as decimal(18,2)) as valor_total_homologado", "id % 2 = 0 as cancelado")
    out = quality.value_audit(awards, exact=True)
    assert rows(out, "resultados", "valor_total", "p5", "p9", "p99", "p999") == [(30_000, Decimal(449_985_000), 14_999.0, 26_999.0, 29_699.0, 29_969.0)]
    assert "percentile" not in out._jdf.queryExecution().toString()
