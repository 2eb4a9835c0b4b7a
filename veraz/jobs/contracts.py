"""The contract job: contracts, their items, events and suppliers, the six rules, and coverage."""

from __future__ import annotations

from pyspark.sql import functions as F

from veraz.jobs.runs import Run
from veraz.jobs.store import Store
from veraz.operators import context, quality, silver

CONTRACTS, ITEMS, EVENTS, SUPPLIERS = (f"silver.{t}" for t in ("contratos", "itens_contrato", "eventos_contrato", "fornecedores_contratos"))
PROBLEMS, COVERAGE = "silver.contratos_problemas", "gold.contratos_cobertura"
RAW = {"contratos": "bronze.contratos_raw", "itens": "bronze.contratos_itens_raw", "eventos": "bronze.contratos_historicos_raw"}
WITHOUT = "contrato_nao_carregado"


def run(store: Store, job: Run, secret: str) -> str:
    """Contracts are snapshots: each run reads all raw rows. Nothing is published if a rule fails."""
    raw = {k: store.read(t) for k, t in RAW.items()}
    work = store.stage({"work.itens_brutos": raw["itens"], "work.eventos_brutos": raw["eventos"]})
    try:
        contracts, items, events = silver.contracts(raw["contratos"], secret), silver.contract_items(work.read("work.itens_brutos")), silver.contract_events(work.read("work.eventos_brutos"))
        work.add({CONTRACTS: contracts.current, "work.itens": items.current, "work.eventos": events.current})
        known = work.read(CONTRACTS)
        own_items, items_without = silver.close_over(work.read("work.itens"), known, "contrato_id", WITHOUT)
        own_events, events_without = silver.close_over(work.read("work.eventos"), known, "contrato_id", WITHOUT)
        tag = lambda df: df.withColumn(silver.REASON, F.lit("empate_conteudo_divergente"))
        log = silver.problem_log([
            ("contrato", contracts.quarantine, "id_origem_contrato"), ("contrato", tag(contracts.conflicts), "id_origem_contrato"),
            ("item_contrato", items.quarantine, "id_origem_item_contrato"), ("item_contrato", tag(items.conflicts), "id_origem_item_contrato"), ("item_contrato", items_without, "id_origem_item_contrato"),
            ("evento_contrato", events.quarantine, "id_origem_evento"), ("evento_contrato", tag(events.conflicts), "id_origem_evento"), ("evento_contrato", events_without, "id_origem_evento"),
        ], job.run_id)
        suppliers = contracts.suppliers.join(known.select("fornecedor_id"), "fornecedor_id", "left_semi")
        work.add({ITEMS: own_items, EVENTS: own_events, SUPPLIERS: suppliers, PROBLEMS: log, "work.itens_sem": items_without, "work.eventos_sem": events_without})
        tables = {t: work.read(t) for t in work.folders}
        counts = {"fornecedores": work.counts[SUPPLIERS], **{f"{k}_brutos": work.counts[f"work.{k}_brutos"] for k in ("itens", "eventos")}, **{f"{k}_sem_contrato": work.counts[f"work.{k}_sem"] for k in ("itens", "eventos")}}
        results = quality.contract_suite(known, tables[ITEMS], tables[EVENTS], tables[SUPPLIERS], counts)
        job.record(store, results)
        work.publish(PROBLEMS)
        quality.gate(results)
        counted = {r.regra: r.observados for r in results}
        wanted = tables[ITEMS].where("categoria_tecnologia <> 'incerto'")
        extent = context.contract_coverage(known, tables[ITEMS], tables[EVENTS]).crossJoin(wanted.agg(F.count("*").alias("itens_tecnologia"), F.count_distinct("contrato_id").alias("contratos_tecnologia")))  # one row by one row
        extent = extent.withColumns({"run_id": F.lit(job.run_id), "itens_sem_contrato": F.lit(counted["itens_sem_contrato"]), "eventos_sem_contrato": F.lit(counted["eventos_sem_contrato"]), "registrado_em": F.current_timestamp()})
        work.add({COVERAGE: extent})
        work.publish(CONTRACTS, ITEMS, EVENTS, SUPPLIERS, COVERAGE)
    finally:
        work.discard()
    return store.note("contratos", job.run_id, {"regras": {r.regra: r.status for r in results}})
