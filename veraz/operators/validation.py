"""Checks of published tables: eleven functions over tables, and one that runs them over a store."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _united(parts: list[DataFrame]) -> DataFrame:
    if not parts:
        raise ValueError("no tables")
    return reduce(DataFrame.unionByName, parts)


def _named(name: str, df: DataFrame, label: str = "tabela") -> DataFrame:
    return df.select(F.lit(name).alias(label), *df.columns)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(tabela, linhas)."""
    return _united([_named(n, df.agg(F.count("*").alias("linhas"))) for n, df in tables.items()])


def time_bounds(tables: Mapping[str, tuple[DataFrame, str | Column]]) -> DataFrame:
    """(tabela, primeiro, ultimo, linhas): the first and last day of a column."""
    day = lambda c: F.to_date(F.try_to_timestamp((F.col(c) if isinstance(c, str) else c).cast("string")))
    text = lambda c: F.date_format(c, "yyyy-MM-dd")
    return _united([_named(n, df.agg(text(F.min(day(c))).alias("primeiro"), text(F.max(day(c))).alias("ultimo"), F.count("*").alias("linhas"))) for n, (df, c) in tables.items()])


def uniqueness(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """(tabela, linhas, chaves, duplicadas): rows and distinct keys; null keys are no keys."""
    counted = _united([_named(n, df.agg(F.count("*").alias("linhas"), F.count_distinct(k).alias("chaves"))) for n, (df, k) in tables.items()])
    return counted.withColumn("duplicadas", F.col("linhas") - F.col("chaves"))


def orphan_counts(rules: Mapping[str, tuple[DataFrame, DataFrame, str]]) -> DataFrame:
    """(tabela, orfaos): rows whose key isn't among the parents."""
    return _united([_named(n, rows.select(key).join(parents.select(key), key, "left_anti").agg(F.count("*").alias("orfaos"))) for n, (rows, parents, key) in rules.items()])


def last_run(results: DataFrame, run: str = "run_id", moment: str = "registrado_em", order: str | None = None) -> DataFrame:
    """The rows of the run that was registered last; ``order`` breaks ties of moments."""
    latest = results.agg(F.max_by(run, F.struct(moment, order or run)).alias(run))
    return results.join(F.broadcast(latest), run, "left_semi")  # one row


def status_counts(tables: Mapping[str, DataFrame], columns: tuple[str, ...] = ("status_publicacao",)) -> DataFrame:
    """(tabela, the columns, linhas)."""
    return _united([_named(n, df.groupBy(*columns).agg(F.count("*").alias("linhas"))) for n, df in tables.items()])


def group_sizes(rows: DataFrame, key: str, at: tuple[float, ...] = (0.5, 0.95, 0.99), exact: bool = False) -> DataFrame:
    """One row: percentiles and the maximum of rows by key, to find skew."""
    n = rows.groupBy(key).agg(F.count("*").alias("n"))
    share = (lambda p: F.expr(f"percentile_disc({p}) within group (order by n)").cast("long")) if exact else (lambda p: F.percentile_approx("n", p, 10000))
    return n.agg(*(share(p).alias(f"p{round(100 * p)}") for p in at), F.max("n").alias("maximo"))


def published_columns(tables: Mapping[str, DataFrame], hidden: tuple[str, ...] = ()) -> DataFrame:
    """(tabela, coluna, permitida): the columns of tables, and whether they may be shown."""
    spark = next(iter(tables.values())).sparkSession
    rows = [(n, c, c not in hidden) for n, df in tables.items() for c in df.columns]
    return spark.createDataFrame(rows, "tabela string, coluna string, permitida boolean")
