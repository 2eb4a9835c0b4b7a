"""Audits of raw tables on the path of production: the same operators, without a store."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veraz.operators import classify, gold, quality, silver
from veraz.sources import files
from veraz.sources.collect import stamp_evidence


def windowed(procurements: DataFrame, items: DataFrame, awards: DataFrame, first: date, last: date) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Raw procurements published on some days, and the items and awards that belong to them."""
    kept = files.within_days(procurements, "data_publicacao_pncp", first.isoformat(), last.isoformat())
    keys = kept.select(F.trim("numero_controle_PNCP").alias("_control")).where(F.col("_control").isNotNull()).distinct()
    own = lambda df: df.join(keys, F.trim(df["numero_controle_PNCP_compra"]) == F.col("_control"), "left_semi")
    return kept, own(items), own(awards)


def prepared(procurements: DataFrame, items: DataFrame, awards: DataFrame, secret: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(items, awards, procurements, links), closed over their parents as the core job does it."""
    known = silver.procurements(procurements).current
    own_items = silver.close_over(classify.services(classify.equipment(silver.items(items).current)), known, "contratacao_id", "")[0]
    own_awards = silver.close_over(silver.awards(awards, secret).current, own_items, "item_id", "")[0]
    return own_items, own_awards, known, silver.procurement_links(procurements)


def kpis(procurements: DataFrame, items: DataFrame, awards: DataFrame, secret: str) -> DataFrame:
    """The published key figures from raw rows: one row."""
    return gold.procurement_kpis(gold.relations(*prepared(procurements, items, awards, secret)))


def value_semantics(procurements: DataFrame, items: DataFrame, awards: DataFrame, first: date, last: date, secret: str, exact: bool = False) -> dict:
    """Evidence on awarded values of technology items: counts and percentiles, reasons, the 20 largest."""
    _, own_items, own_awards = windowed(procurements, items, awards, first, last)
    wanted = classify.services(classify.equipment(silver.items(own_items).current)).where(F.col("categoria_tecnologia") != classify.UNKNOWN)
    judged = gold.monetary_eligibility(silver.awards(own_awards, secret).current.join(wanted.select("item_id"), "item_id", "left_semi"))
    document = {
        "janela": [first.isoformat(), last.isoformat()],
        "resumo": quality.value_audit(judged, exact=exact).first().asDict(),
        "motivos": {r.motivo: r.linhas for r in quality.histogram(judged).collect()},
        "maiores": [r.asDict() for r in quality.largest_awards(judged).select("resultado_id", "item_id", "quantidade_homologada", "valor_unitario_homologado", "valor_total_homologado", "cancelado", "motivo_inelegibilidade_monetaria").collect()],
    }
    return stamp_evidence(document, origem="auditoria_valores", status="NAO_PUBLICAVEL")
