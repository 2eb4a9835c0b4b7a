"""The core job: procurements, items, awards, suppliers, agencies, units and links from raw tables.

Everything is computed into staged folders, the ten rules are counted there, and only if none fails
do the new tables replace the old ones. The watermark moves last. An incremental run reads the
raw rows that changed in its window (of raw tables that are laid out by day, only those files) and
merges their entities into the published ones, the newer version winning. Procurements, links, items
and awards lie in buckets of their ids, and only the buckets with changed ids are written; agencies,
units and suppliers, which are far smaller, are written whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veraz.jobs.runs import Run, in_window
from veraz.jobs.store import Store
from veraz.operators import classify, quality, silver
from veraz.operators.versioning import latest
from veraz.sources import tables as changes

PROCUREMENTS, ITEMS, AWARDS, SUPPLIERS, AGENCIES, UNITS, LINKS = (f"silver.{t}" for t in ("contratacoes", "itens_contratacao", "resultados_itens", "fornecedores", "orgaos", "unidades_compradoras", "contratacoes_dimensoes"))
PROBLEMS = "silver.nucleo_problemas"
CONFLICT = "empate_conteudo_divergente"
#: Raw tables and the column that says when their rows changed.
RAW = {"contratacoes": "bronze.contratacoes_raw", "itens": "bronze.itens_raw", "resultados": "bronze.resultados_raw"}
CHANGED = "data_atualizacao_pncp"


def _whole(store: Store, table: str, rows: DataFrame, key: str, moment: str | None, incremental: bool) -> DataFrame:
    """Published rows with newer ones in their places; a bootstrap begins anew."""
    if not incremental or not store.exists(table):
        return rows
    old = store.read(table)
    return changes.upsert_newer(old, rows, key, moment) if moment else latest(old.withColumn("_own", F.lit(0)).unionByName(rows.withColumn("_own", F.lit(1)), allowMissingColumns=True), key, ("_own",)).drop("_own")


def run(store: Store, job: Run, secret: str) -> str:
    """Runs the job and returns its summary; raises GateFailed and leaves every table but the problems
    and rule results as it was if a blocking rule fails."""
    window, incremental = job.window(store), job.mode == "incremental"
    raw = {k: in_window(store.read(t, window), window, CHANGED) for k, t in RAW.items()}
    # Raw rows are read once: what several operators read is staged first, and counted as it is written. Awards
    # are staged as they came, as typed ones hold what identifies persons.
    work = store.stage({"work.contratacoes_brutas": raw["contratacoes"], "work.itens_tipados": silver.type_items(raw["itens"]), "work.resultados_brutos": raw["resultados"]})
    try:
        bought = work.read("work.contratacoes_brutas")
        procurements = silver.procurements(bought)
        items, awards = silver.split_items(work.read("work.itens_tipados")), silver.awards(work.read("work.resultados_brutos"), secret)
        agencies, units = silver.agencies_and_units(bought)
        work.add({
            "work.contratacoes": procurements.current, "work.contratacoes_quarentena": procurements.quarantine, "work.contratacoes_conflitos": procurements.conflicts,
            "work.vinculos": silver.procurement_links(bought),
            AGENCIES: _whole(store, AGENCIES, agencies, "orgao_id", "atualizado_em", incremental),
            UNITS: _whole(store, UNITS, units, "unidade_id", "atualizado_em", incremental),
            "work.itens": classify.services(classify.equipment(items.current)), "work.itens_quarentena": items.quarantine, "work.itens_conflitos": items.conflicts,
            "work.resultados": awards.current, "work.resultados_quarentena": awards.quarantine, "work.resultados_conflitos": awards.conflicts,
            "work.fornecedores": awards.suppliers,
        })
        work.merge(PROCUREMENTS, work.read("work.contratacoes"), "contratacao_id", "atualizado_em", incremental)
        work.merge(LINKS, work.read("work.vinculos"), "contratacao_id", "atualizado_em", incremental)
        own, without = silver.close_over(work.read("work.itens"), work.read(PROCUREMENTS), "contratacao_id", "contratacao_nao_carregada")
        work.add({"work.itens_publicados": own, "work.itens_pendentes": without})
        work.merge(ITEMS, work.read("work.itens_publicados"), "item_id", "atualizado_em", incremental)
        own, without = silver.close_over(work.read("work.resultados"), work.read(ITEMS), "item_id", "item_nao_carregado")
        work.add({"work.resultados_publicados": own, "work.resultados_pendentes": without})
        work.merge(AWARDS, work.read("work.resultados_publicados"), "resultado_id", "atualizado_em", incremental)
        suppliers = _whole(store, SUPPLIERS, work.read("work.fornecedores"), "fornecedor_id", None, incremental)
        tag = lambda df: df.withColumn(silver.REASON, F.lit(CONFLICT))
        log = silver.problem_log([
            ("contratacao", work.read("work.contratacoes_quarentena"), "id_origem"), ("contratacao", tag(work.read("work.contratacoes_conflitos")), "contratacao_id"),
            *(("item", df, "id_origem_item") for df in (work.read("work.itens_quarentena"), tag(work.read("work.itens_conflitos")), work.read("work.itens_pendentes"))),
            *(("resultado", df, "id_origem_resultado") for df in (work.read("work.resultados_quarentena"), tag(work.read("work.resultados_conflitos")), work.read("work.resultados_pendentes"))),
        ], job.run_id)
        work.add({SUPPLIERS: suppliers.join(work.read(AWARDS).select("fornecedor_id"), "fornecedor_id", "left_semi"), PROBLEMS: log})
        both = lambda kind: work.counts[f"work.itens_{kind}"] + work.counts[f"work.resultados_{kind}"]
        read = work.counts["work.itens_tipados"] + work.counts["work.resultados_brutos"]
        counts = quality.CoreCounts(read, both("quarentena"), both("conflitos"), both("pendentes"), both("publicados"), work.counts[SUPPLIERS])
        results = quality.core_suite(counts, work.read(PROCUREMENTS), work.read(ITEMS), work.read(AWARDS), work.read(SUPPLIERS))
        job.record(store, results)
        work.publish(PROBLEMS)
        quality.gate(results)
        work.publish(PROCUREMENTS, ITEMS, AWARDS, SUPPLIERS, AGENCIES, UNITS, LINKS)
    finally:
        work.discard()
    mark = job.advance(store)
    return store.note("nucleo", job.run_id, {"janela": window, "watermark": mark, "regras": {r.regra: r.status for r in results}})
