"""The gold job: all indicators from published tables, and the checks that they must pass before
any of them replaces its predecessor.

The relation of awards and the indicators of relations lie in buckets of the supplier. Each of their
groups has one supplier, so a bucket of an indicator depends on the same bucket of the relation alone,
and ``run_delta`` computes the buckets anew that hold suppliers of changed awards, and no others.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veraz.jobs import contracts as contract_job
from veraz.jobs import core
from veraz.jobs.runs import RESULTS
from veraz.jobs.store import Store
from veraz.operators import context, gold, quality, silver
from veraz.sources import buckets, files

CONTEXT = {"empresas": "silver.cnpj_empresas_contexto", "socios": "silver.cnpj_qsa_resumo", "sancoes": "silver.sancoes_fornecedores_contexto"}
INDEX = "silver.ipca"
RELATIONS = "gold.relacoes"
#: Indicators whose groups have one supplier each.
BY_SUPPLIER = {
    "gold.recorrencia_orgao_fornecedor": lambda related, units: gold.recurrence(related),
    "gold.presenca_fornecedores": gold.supplier_presence,
    "gold.arestas_orgao_fornecedor": lambda related, units: gold.agency_supplier_edges(related),
}


@dataclass(frozen=True)
class Gates:
    min_suppliers: int = 2
    min_awards: int = 3
    min_coverage: float = 0.8
    source_validated: bool = False


def violations(tables: dict[str, DataFrame]) -> dict[str, int]:
    """How many rows break a check: bounds of shares, prices that must not be published, and words
    that context must not use."""
    found = {
        "invariantes_concentracao": gold.concentration_violations(tables["gold.concentracao_fornecedores"]),
        "precos_publicados": tables["gold.variacao_precos"].where("status_publicacao = 'publicada'"),
    }
    if "gold.fornecedores_contexto" in tables:
        found["linguagem_proibida"] = tables["gold.fornecedores_contexto"].where(F.lower("interpretacao").contains("fraude"))
    return {r.nome: r.linhas for r in quality.counts_of(found).collect()}


def run(store: Store, run_id: str, gates: Gates = Gates(), period: str | None = None, reference: str | None = None) -> str:
    """Computes, checks and publishes the indicators. Those of contracts, context and the price index
    are left out where their tables don't exist."""
    items, awards, procurements, links, units, rules = (store.read(t) for t in (core.ITEMS, core.AWARDS, core.PROCUREMENTS, core.LINKS, core.UNITS, RESULTS))
    work = store.stage({})
    try:
        # Read by four indicators, and again when only some of its buckets change.
        work.lay_out(RELATIONS, gold.relations(items, awards, procurements, links), "fornecedor_id")
        related = work.read(RELATIONS)
        for name, indicator in BY_SUPPLIER.items():
            work.lay_out(name, indicator(related, units), "fornecedor_id")
        out = {
            "gold.qualidade_cobertura": gold.quality_coverage(items, awards, procurements, links, rules),
            "gold.concentracao_fornecedores": gold.supplier_concentration(items, awards, procurements, links, gates.min_suppliers, gates.min_awards, gates.min_coverage, gates.source_validated),
            "gold.servicos_cobertura": gold.service_coverage(items),
            "gold.variacao_precos": gold.price_distribution(items, awards, procurements),
        }
        people = [store.read(core.SUPPLIERS)]
        if store.exists(contract_job.CONTRACTS):
            kept = silver.technology_population(*(store.read(t) for t in (contract_job.CONTRACTS, contract_job.ITEMS, contract_job.EVENTS, contract_job.SUPPLIERS)))
            out["gold.evolucao_contratual"] = gold.contract_evolution(kept.contracts, kept.events)
            people.append(kept.suppliers)
        if all(store.exists(t) for t in CONTEXT.values()):
            known = context.supplier_context(context.united_suppliers(*people), *(store.read(t) for t in CONTEXT.values()))
            out["gold.fornecedores_contexto"] = known.withColumn("competencia", F.lit(period))
        if store.exists(INDEX):
            out["gold.ipca_referencia"] = context.index_factor(store.read(INDEX), reference)
        kpis = gold.procurement_kpis(related).first().asDict()
        work.add(out)
        tables = {t: work.read(t) for t in (*out, *BY_SUPPLIER)}
        broken = violations(tables)
        if any(broken.values()):
            raise quality.GateFailed(f"broken checks: {', '.join(k for k, n in broken.items() if n)}")
        counts = {r.nome: r.linhas for r in quality.counts_of(tables).collect()}
        work.publish(RELATIONS, *tables)
    finally:
        work.discard()
    return store.note("gold", run_id, {"linhas": counts, "kpis_compras": kpis, "violacoes": broken})


def changed_awards(days: tuple[date, date], items: DataFrame, awards: DataFrame, procurements: DataFrame, links: DataFrame) -> DataFrame:
    """Ids of the awards that changed on these days, or whose item, procurement or link did."""
    recent = lambda rows, key: files.within_days(rows, "atualizado_em", *(d.isoformat() for d in days)).select(key)
    bought = recent(procurements, "contratacao_id").union(recent(links, "contratacao_id")).distinct()
    wanted = recent(items, "item_id").union(items.join(bought, "contratacao_id", "left_semi").select("item_id")).distinct()
    return recent(awards, "resultado_id").union(awards.join(wanted, "item_id", "left_semi").select("resultado_id")).distinct()


def run_delta(store: Store, run_id: str, days: tuple[date, date]) -> str:
    """After an incremental run of the core job: the indicators of relations, for the suppliers of what
    changed on the days that it read. Key figures are counted over the stored relation. The other
    indicators stay as the last full run left them."""
    n = buckets.layout(store.spark, store.path(RELATIONS)) if store.exists(RELATIONS) else None
    if n is None or any(buckets.layout(store.spark, store.path(t)) not in (n, None) for t in BY_SUPPLIER):
        raise ValueError("a delta needs the relation of a full run")
    items, awards, procurements, links, units = (store.read(t) for t in (core.ITEMS, core.AWARDS, core.PROCUREMENTS, core.LINKS, core.UNITS))
    stored = store.read(RELATIONS)
    work = store.stage({"work.alterados": changed_awards(days, items, awards, procurements, links)})
    try:
        changed = work.read("work.alterados")
        work.add({"work.novas": gold.relations(items, awards.join(changed, "resultado_id", "left_semi"), procurements, links)})
        new = work.read("work.novas")
        moved = files.within_days(units, "atualizado_em", *(d.isoformat() for d in days)).select("unidade_id")
        gone = stored.join(changed, "resultado_id", "left_semi").select("fornecedor_id").union(stored.join(moved, "unidade_id", "left_semi").select("fornecedor_id"))
        numbers = buckets.touched(gone.union(new.select("fornecedor_id")), "fornecedor_id", n)
        kept = store.in_buckets(RELATIONS, n, numbers).join(changed, "resultado_id", "left_anti")
        work.replace_buckets(RELATIONS, kept.unionByName(new), "fornecedor_id", n, numbers)
        own = work.staged(RELATIONS)
        for name, indicator in BY_SUPPLIER.items():
            work.replace_buckets(name, indicator(own, units), "fornecedor_id", n, numbers)
        kpis = gold.procurement_kpis(work.read(RELATIONS)).first().asDict()
        if numbers:
            work.publish(RELATIONS, *BY_SUPPLIER)
    finally:
        work.discard()
    return store.note("gold_delta", run_id, {"baldes": len(numbers), "de": n, "kpis_compras": kpis})
