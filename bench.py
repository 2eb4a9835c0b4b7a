"""Runs the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and prints one line of JSON.

With $BENCH_COPIES the join strategies run over so many copies of the benchmark's tables with keys of
their own, written to a temporary folder first, to measure at a given number of rows.
"""

from __future__ import annotations

import json
import os
import shutil
import statistics
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veraz.plans import benchmark, catalogue

SF = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = ("bench_agg", "bench_checksum", "recorrencia", "rede", "presenca", "kpis_compras", "concentracao", "qualidade_cobertura", "variacao_precos", "evolucao_contratual", "version_split_generic", "version_split_contratacoes", "elegibilidade_monetaria", "fornecedores_contexto")
RUNS = 3
COPIES = int(os.environ.get("BENCH_COPIES", "1"))


def seconds(run) -> float:
    began = time.perf_counter()
    run()
    return time.perf_counter() - began


def copied(tables: dict[str, DataFrame], copies: int, folder: str) -> dict[str, DataFrame]:
    """The tables so many times over; agencies stay as they are."""
    out = {}
    for name, df in tables.items():
        if copies > 1 and name != "agencies":
            keys = [c for c in ("contratacao_id", "item_id", "resultado_id") if c in df.columns]
            df = df.crossJoin(F.broadcast(df.sparkSession.range(copies).toDF("_copy"))).withColumns({k: F.concat_ws("#", k, "_copy") for k in keys}).drop("_copy")
        df.write.parquet(f"{folder}/{name}")
        out[name] = df.sparkSession.read.parquet(f"{folder}/{name}")
    return out


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE if COPIES == 1 else ():
        run = lambda f=catalogue.QUERIES[name]: f(spark, SF).write.format("noop").mode("overwrite").save()
        run()  # to warm up
        times[name] = round(statistics.median(seconds(run) for _ in range(RUNS)), 3)
    tables, folder = catalogue.benchmark_tables(spark, SF), tempfile.mkdtemp()
    if COPIES > 1:
        tables = copied(tables, COPIES, folder)
    rows = sum(df.count() for df in tables.values())
    strategies = benchmark.compare(spark, tables, RUNS)
    moved = {k: {"shuffle_mb": round(t.shuffled / 1e6, 2), "spill_mb": round(t.spilled / 1e6, 2)} for k, t in benchmark.compare_traffic(spark, tables).items()}
    shutil.rmtree(folder)
    times |= {f"strategy_{k}": round(v, 3) for k, v in strategies.items()}
    print(json.dumps({"metric": "headline queries, sum of medians", "value": round(sum(times.get(n, 0) for n in HEADLINE), 3), "unit": "sec", "queries": times, "sf": os.path.basename(SF.rstrip("/")), "strategy_rows": rows, "strategy_traffic": moved}))
    spark.stop()


if __name__ == "__main__":
    main()
