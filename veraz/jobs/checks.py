"""The validation suite over a store: what a user looks at after the jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame

from veraz.jobs import contracts, core
from veraz.jobs.runs import RESULTS
from veraz.jobs.store import Store
from veraz.operators import gold, silver, validation
from veraz.sources import tables as changes

GOLD = ("qualidade_cobertura", "concentracao_fornecedores", "recorrencia_orgao_fornecedor", "presenca_fornecedores", "variacao_precos", "evolucao_contratual", "arestas_orgao_fornecedor", "fornecedores_contexto")
_KEYS = {core.PROCUREMENTS: "contratacao_id", core.ITEMS: "item_id", core.AWARDS: "resultado_id", contracts.CONTRACTS: "contrato_id"}
_PARENTS = {"item_sem_contratacao": (core.ITEMS, core.PROCUREMENTS, "contratacao_id"), "resultado_sem_item": (core.AWARDS, core.ITEMS, "item_id"), "item_contrato_sem_contrato": (contracts.ITEMS, contracts.CONTRACTS, "contrato_id"), "evento_sem_contrato": (contracts.EVENTS, contracts.CONTRACTS, "contrato_id")}
_DAYS = {core.PROCUREMENTS: "publicado_em", contracts.CONTRACTS: "data_publicacao"}
_SILVER = (*_KEYS, core.SUPPLIERS, core.AGENCIES, core.UNITS, contracts.ITEMS, contracts.EVENTS)


def validate(store: Store) -> dict[str, DataFrame]:
    """Eleven checks by name, over the tables that exist."""
    has = {t: store.read(t) for t in {*_SILVER, RESULTS, contracts.COVERAGE, *(f"gold.{g}" for g in GOLD)} if store.exists(t)}
    short = lambda t: t.partition(".")[2]
    published = {g: has[f"gold.{g}"] for g in GOLD if f"gold.{g}" in has}
    out = {
        "contagens": validation.row_counts({short(t): has[t] for t in _SILVER if t in has}),
        "limites_temporais": validation.time_bounds({short(t): (has[t], c) for t, c in _DAYS.items() if t in has}),
        "unicidade": validation.uniqueness({short(t): (has[t], k) for t, k in _KEYS.items() if t in has}),
        "integridade": validation.orphan_counts({r: (has[a], has[b], k) for r, (a, b, k) in _PARENTS.items() if a in has and b in has}),
        "skew": validation.group_sizes(has[core.ITEMS], "contratacao_id"),
        "arquivos": changes.physical(has[core.ITEMS]),
    }
    if RESULTS in has:
        out["ultima_execucao"] = validation.last_run(has[RESULTS])
    if published:
        out["status"] = validation.status_counts(published)
        out["colunas"] = validation.published_columns(published, silver.SENSITIVE)
    if "concentracao_fornecedores" in published:
        out["limites_concentracao"] = gold.concentration_violations(published["concentracao_fornecedores"])
    if contracts.COVERAGE in has:
        out["cobertura"] = has[contracts.COVERAGE]
    return out
