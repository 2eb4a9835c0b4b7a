"""The jobs end to end on temporary folders: gates before writes, watermarks after them, audits on the same path."""

import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from tests.test_operators import AWARD, CONTRACT, frame, procurement, rows
from veraz.jobs import audit, checks, contracts, core, gold
from veraz.jobs.runs import RESULTS, STATE, Run, in_window
from veraz.jobs.store import SUMMARIES, Store
from veraz.operators import classify, context, quality, silver
from veraz.sources import buckets, tables

SECRET = "segredo-de-teste"
ITEM = {"id_compra_item": "i", "numero_controle_PNCP_compra": "A-1", "numero_item_pncp": "1", "descricao_resumida": "Notebook", "descricao_detalhada": "14", "material_ou_servico": "M", "quantidade": "2", "unidade_medida": "UN", "valor_unitario_estimado": "3", "valor_total": "6", "data_atualizacao_pncp": "2026-01-05", "_source_file_id": "f1"}
PLACE = {"orgao_entidade_razao_social": "Orgao", "unidade_orgao_codigo_unidade": "U1", "unidade_orgao_nome_unidade": "Unidade", "unidade_orgao_uf_sigla": "SP", "unidade_orgao_municipio_nome": "M"}


def raw_rows(spark):
    one = procurement(spark)[0] | PLACE
    compras = [one, one | {"numero_controle_PNCP": "A-2", "id_compra": "2"}, one | {"numero_controle_PNCP": "A-3", "id_compra": "3", "orgao_entidade_cnpj": ""}]
    itens = [ITEM | {"numero_controle_PNCP_compra": c, "numero_item_pncp": n, "id_compra_item": f"{c}{n}"} for c in ("A-1", "A-2", "A-3") for n in ("1", "2")]
    itens += [itens[0], ITEM | {"id_compra_item": "x", "data_atualizacao_pncp": "?"}]
    premios = [AWARD | {"numero_controle_PNCP_compra": c, "numero_item_pncp": n, "tipo_pessoa": "PJ", "ni_fornecedor": f"{s}2345678000190", "situacao_compra_item_resultado_nome": "Informado", "valor_total_homologado": "6"} for c, n, s in (("A-1", "1", 1), ("A-2", "1", 1), ("A-1", "2", 2), ("A-3", "1", 3))]
    return frame(spark, compras), frame(spark, itens), frame(spark, premios)


@pytest.fixture
def store(spark, tmp_path):
    made = Store(spark, str(tmp_path / "lake"), buckets=5)
    made.put(dict(zip(core.RAW.values(), raw_rows(spark), strict=True)))
    items = [{"id": str(k), "contrato_id": str(k), "tipo_id": "Material", "descricao_complementar": d, "quantidade": "1", "valorunitario": "2", "valortotal": "2", "_coletado_em_utc": "2026-01-01", "_source_file_id": "f"} for k, d in ((1, "x"), (9, "y"))]
    items.append(items[0] | {"id": "2", "descricao_complementar": "notebook"})
    event = {"id": "1", "contrato_id": "1", "tipo": "t", "valor_global": "10", "novo_valor_global": "12.5", "criado_em": "2026-01-01", "vigencia_fim": "2027-06-30", "_source_file_id": "f"}
    # The catalogue number stands before the description.
    items[2]["catmatseritem_id"] = "notebook"
    made.put(dict(zip(contracts.RAW.values(), (frame(spark, [CONTRACT]), frame(spark, items), frame(spark, [event])), strict=True)))
    return made


def files_of(store, *tables_):
    return {t: sorted(store.read(t).inputFiles()) for t in tables_}


def test_core_contracts_gold_and_checks(spark, store):
    out = json.loads(core.run(store, Run("r1", date(2026, 1, 31)), SECRET))
    assert out["watermark"] == "2026-01-31" and out["regras"]["itens_duplicados"] == "PASS"
    assert {k: v for k, v in out["regras"].items() if v != "PASS"} == {"vinculos_pendentes": "ALERT", "registros_em_quarentena": "ALERT", "duplicatas_fisicas_descartadas": "ALERT"}
    assert [store.read(t).count() for t in (core.PROCUREMENTS, core.ITEMS, core.AWARDS, core.SUPPLIERS, core.AGENCIES, core.UNITS, core.LINKS)] == [2, 4, 3, 2, 1, 1, 2]
    problems = rows(store.read(core.PROBLEMS), "entidade", "motivo_quarentena")
    assert problems == [("contratacao", "cnpj_orgao_ausente"), ("item", "contratacao_nao_carregada"), ("item", "contratacao_nao_carregada"), ("item", "data_atualizacao_invalida"), ("resultado", "item_nao_carregado")]
    assert len(set(r.registro_problema_id for r in store.read(core.PROBLEMS).collect())) == 5

    contract = json.loads(contracts.run(store, Run("c1", date(2026, 1, 31), pipeline="contratos"), SECRET))
    assert contract["regras"]["itens_sem_contrato"] == "ALERT" and contract["regras"]["contratos_duplicados"] == "PASS"
    (extent,) = store.read(contracts.COVERAGE).collect()
    assert (extent.contratos, extent.contratos_com_itens, extent.cobertura_eventos, extent.itens_sem_contrato, extent.itens_tecnologia) == (1, 1, 1.0, 1, 1)

    store.put({gold.INDEX: spark.createDataFrame([("202601", 100.0), ("202602", 110.0)], "competencia string, numero_indice double")})
    empty = {gold.CONTEXT["empresas"]: context.companies(frame(spark, [{"cnpj_basico": "12345678", "razao_social": "A", "capital_social": "1,5"}])), gold.CONTEXT["socios"]: context.partner_summary(frame(spark, [{"cnpj_basico": "1", "data_entrada_sociedade": ""}])), gold.CONTEXT["sancoes"]: context.sanctions(frame(spark, [{"cnpj_sancionado": "1", "data_inicio_sancao": "", "data_final_sancao": ""}]))}
    store.put(empty)
    report = json.loads(gold.run(store, "g1", gold.Gates(source_validated=True), period="202601", reference="202602"))
    assert report["kpis_compras"] == {"compras_tecnologia": 2, "itens_tecnologia": 3, "resultados_tecnologia": 3, "fornecedores_compras_tecnologia": 2, "relacoes_recorrentes": 1}
    assert set(report["violacoes"].values()) == {0} and report["linhas"]["gold.evolucao_contratual"] == 1
    assert rows(store.read("gold.recorrencia_orgao_fornecedor"), "contratacoes_distintas") == [(2,)]
    assert rows(store.read("gold.ipca_referencia"), "competencia", "fator_para_referencia", "periodo_referencia") == [("202601", 1.1, "202602"), ("202602", 1.0, "202602")]

    assert sorted(r.job for r in store.read(SUMMARIES).collect()) == ["contratos", "gold", "nucleo"]
    # The audit from raw rows gives what the jobs published.
    assert audit.kpis(*raw_rows(spark), SECRET).first().asDict() == report["kpis_compras"]
    found = checks.validate(store)
    assert {r.tabela: r.linhas for r in found["contagens"].collect()}["itens_contratacao"] == 4
    assert all(r.duplicadas == 0 for r in found["unicidade"].collect()) and all(r.orfaos == 0 for r in found["integridade"].collect())
    assert found["limites_concentracao"].count() == 0 and found["cobertura"].count() == 1
    assert {r.run_id for r in found["ultima_execucao"].collect()} == {"c1"}
    assert all(r.permitida for r in found["colunas"].collect()) and found["arquivos"].first().arquivos >= 1
    assert {(r.primeiro, r.ultimo) for r in found["limites_temporais"].where("tabela = 'contratacoes'").collect()} == {("2026-01-02", "2026-01-02")}
    assert tuple(found["skew"].first())[-1] == 2 and ("evolucao_contratual", "publicada", 1) in {tuple(r) for r in found["status"].collect()}


def test_a_failed_rule_leaves_everything_published_as_it_was(spark, store, monkeypatch):
    core.run(store, Run("r1", date(2026, 1, 31)), SECRET)
    gold.run(store, "g1")
    silver_tables = (core.PROCUREMENTS, core.ITEMS, core.AWARDS, core.SUPPLIERS, core.AGENCIES, core.UNITS, core.LINKS)
    gold_tables = ("gold.concentracao_fornecedores", "gold.qualidade_cobertura", "gold.variacao_precos")
    before = files_of(store, *silver_tables, *gold_tables)
    with monkeypatch.context() as m:
        m.setattr(quality, "leaked_numbers", lambda suppliers: suppliers)
        with pytest.raises(quality.GateFailed, match="cpf_publico"):
            core.run(store, Run("r2", date(2026, 2, 28)), SECRET)
    assert files_of(store, *silver_tables, *gold_tables) == before
    assert store.read(STATE).first().watermark_concluido == date(2026, 1, 31)
    assert rows(store.read(RESULTS).where("run_id = 'r2' and status = 'FAIL'"), "regra") == [("cpf_publico",)]
    from veraz.operators import gold as indicators

    with monkeypatch.context() as m:
        m.setattr(indicators, "concentration_violations", lambda df: df)
        with pytest.raises(quality.GateFailed, match="invariantes_concentracao"):
            gold.run(store, "g2")
    assert files_of(store, *silver_tables, *gold_tables) == before


def test_a_failed_rename_brings_all_tables_back(spark, store, monkeypatch):
    core.run(store, Run("r1", date(2026, 1, 31)), SECRET)
    before = files_of(store, core.ITEMS, core.AWARDS, core.PROCUREMENTS)
    real = tables._rename
    monkeypatch.setattr(tables, "_rename", lambda spark, old, new: "/fornecedores.new-" not in old and real(spark, old, new))
    with pytest.raises(OSError, match="could not be renamed"):
        core.run(store, Run("r2", date(2026, 2, 28)), SECRET)
    monkeypatch.undo()
    assert files_of(store, core.ITEMS, core.AWARDS, core.PROCUREMENTS) == before


def test_a_stopped_swap_is_recovered(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.replace(spark.range(3), path)
    (tmp_path / "t").rename(tmp_path / "t.old-1")
    assert Store(spark, str(tmp_path)).read("t").count() == 3 and not tables.recover(spark, path)


def test_incremental_runs_read_a_window_and_merge(spark, store):
    with pytest.raises(ValueError, match="bootstrap"):
        core.run(store, Run("r0", date(2026, 1, 31), "incremental"), SECRET)
    core.run(store, Run("r1", date(2026, 1, 31)), SECRET)
    newer = ITEM | {"numero_item_pncp": "1", "valor_total": "7", "data_atualizacao_pncp": "2026-02-01"}
    stale = ITEM | {"numero_item_pncp": "2", "valor_total": "99", "data_atualizacao_pncp": "2026-01-20"}
    added = ITEM | {"numero_item_pncp": "3", "data_atualizacao_pncp": "2026-01-30"}
    store.append(core.RAW["itens"], frame(spark, [newer, stale, added]))
    out = json.loads(core.run(store, Run("r2", date(2026, 2, 2), "incremental"), SECRET))
    assert out["janela"] == ["2026-01-29", "2026-02-02"] and out["watermark"] == "2026-02-02"
    got = {(r.numero_controle_pncp, r.numero_item): float(r.valor_total) for r in store.read(core.ITEMS).collect()}
    assert got == {("A-1", "1"): 7.0, ("A-1", "2"): 6.0, ("A-1", "3"): 6.0, ("A-2", "1"): 6.0, ("A-2", "2"): 6.0}
    assert store.read(core.AWARDS).count() == 3 and store.read(core.SUPPLIERS).count() == 2 and store.read(STATE).first().versao_estado == 2


def _stamps(store, table):
    """What lies in each folder of a table: names and times of its files."""
    from pathlib import Path

    found = {}
    for f in Path(store.path(table)).rglob("*.parquet"):
        found.setdefault(f.parent.name, set()).add((f.name, f.stat().st_mtime_ns))
    return found


def test_an_incremental_run_writes_touched_buckets_only(spark, store):
    """Buckets without changed ids keep their files; the rows are those of a merge of whole tables."""
    many = [ITEM | {"numero_item_pncp": str(n), "id_compra_item": f"m{n}"} for n in range(10, 200)]
    store.append(core.RAW["itens"], frame(spark, many))
    store = Store(spark, store.root, buckets=20)
    core.run(store, Run("r1", date(2026, 1, 31)), SECRET)
    before = {t: _stamps(store, t) for t in (core.ITEMS, core.PROCUREMENTS, core.AWARDS)}
    old = spark.createDataFrame(store.read(core.ITEMS).collect(), store.read(core.ITEMS).schema)
    assert len(before[core.ITEMS]) == 20 and buckets.layout(spark, store.path(core.ITEMS)) == 20
    store.append(core.RAW["itens"], frame(spark, [ITEM | {"numero_item_pncp": "17", "valor_total": "8", "quantidade": "2", "data_atualizacao_pncp": "2026-02-01"}]))
    core.run(store, Run("r2", date(2026, 2, 2), "incremental"), SECRET)
    after = {t: _stamps(store, t) for t in before}
    assert sum(after[core.ITEMS][b] != before[core.ITEMS][b] for b in before[core.ITEMS]) == 1 and len(after[core.ITEMS]) == 20
    assert after[core.PROCUREMENTS] == before[core.PROCUREMENTS] and after[core.AWARDS] == before[core.AWARDS]
    new = silver.items(store.read(core.RAW["itens"]).where("data_atualizacao_pncp = '2026-02-01'")).current
    want = tables.upsert_newer(old, classify.services(classify.equipment(new)), "item_id", "atualizado_em")
    assert rows(store.read(core.ITEMS), *sorted(want.columns)) == rows(want, *sorted(want.columns)) and set(store.read(core.ITEMS).columns) == set(want.columns)


def test_gold_by_delta_equals_a_full_run(spark, store):
    """Inserts, updates, cancellations, new categories and a procurement of another day."""
    by_supplier = (gold.RELATIONS, *gold.BY_SUPPLIER)
    core.run(store, Run("r1", date(2026, 1, 31)), SECRET)
    with pytest.raises(ValueError, match="full run"):
        gold.run_delta(store, "g0", (date(2026, 1, 29), date(2026, 2, 2)))
    gold.run(store, "g1")
    before = {t: _stamps(store, t) for t in by_supplier}
    one, day = procurement(spark)[0] | PLACE, {"data_atualizacao_pncp": "2026-02-01"}
    award = AWARD | day | {"tipo_pessoa": "PJ", "situacao_compra_item_resultado_nome": "Informado", "valor_total_homologado": "6"}
    store.append(core.RAW["contratacoes"], frame(spark, [one | day | {"numero_controle_PNCP": "A-2", "id_compra": "2", "data_publicacao_pncp": "2026-01-20"}, one | day | {"numero_controle_PNCP": "A-4", "id_compra": "4"}]))
    store.append(core.RAW["itens"], frame(spark, [ITEM | day | {"numero_controle_PNCP_compra": "A-4", "id_compra_item": "n"}, ITEM | day | {"numero_item_pncp": "2", "id_compra_item": "A-12", "descricao_resumida": "Impressora"}]))
    store.append(core.RAW["resultados"], frame(spark, [award | {"numero_controle_PNCP_compra": "A-4", "numero_item_pncp": "1", "ni_fornecedor": "72345678000190"}, award | {"numero_controle_PNCP_compra": "A-1", "numero_item_pncp": "1", "ni_fornecedor": "12345678000190", "situacao_compra_item_resultado_nome": "Cancelado", "data_cancelamento_pncp": "2026-02-01"}]))
    window = json.loads(core.run(store, Run("r2", date(2026, 2, 2), "incremental"), SECRET))["janela"]
    old = {t: rows(store.read(t), *sorted(store.read(t).columns)) for t in by_supplier}
    report = json.loads(gold.run_delta(store, "g2", tuple(date.fromisoformat(d) for d in window)))
    got = {t: rows(store.read(t), *sorted(store.read(t).columns)) for t in by_supplier}
    after = {t: _stamps(store, t) for t in by_supplier}
    full = json.loads(gold.run(store, "g3"))
    assert got == {t: rows(store.read(t), *sorted(store.read(t).columns)) for t in by_supplier} and all(got[t] != old[t] for t in (gold.RELATIONS, "gold.presenca_fornecedores"))
    assert report["kpis_compras"] == full["kpis_compras"] and 0 < report["baldes"] <= report["de"] == 5
    assert all(len({b for b in before[t] if before[t][b] != after[t].get(b)}) <= report["baldes"] for t in by_supplier)
    # Days without changes touch nothing.
    quiet = {t: _stamps(store, t) for t in by_supplier}
    assert json.loads(gold.run_delta(store, "g4", (date(2027, 1, 1), date(2027, 1, 2))))["baldes"] == 0
    assert quiet == {t: _stamps(store, t) for t in by_supplier}


def test_a_failed_or_stopped_swap_of_buckets_leaves_the_old_rows(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path / "lake"), buckets=8)
    kind = "k string, m int, v string"
    first = spark.createDataFrame([(f"k{i}", 1, "old") for i in range(6)], kind)
    work = store.stage({})
    work.merge("t.x", first, "k", "m", True)
    work.publish()
    want = rows(store.read("t.x"), "k", "v")
    change = spark.createDataFrame([("k1", 2, "new"), ("k2", 0, "stale"), ("k3", 1, "tie"), *((f"n{i}", 1, "new") for i in range(20))], kind)

    def staged():
        work = store.stage({})
        work.merge("t.x", change, "k", "m", True)
        return work

    merged = rows(tables.upsert_newer(first, change, "k", "m"), "k", "v")
    work = staged()
    assert rows(work.read("t.x"), "k", "v") == merged and rows(store.read("t.x"), "k", "v") == want
    real, calls = tables._rename, []
    for allowed in (1, 4, 8):  # renames that go well before one fails
        monkeypatch.setattr(tables, "_rename", lambda spark, old, new, n=allowed: (calls.append(1), len(calls) != n + 1 and real(spark, old, new))[1])
        calls.clear()
        with pytest.raises(OSError, match="could not be renamed"):
            staged().publish()
        monkeypatch.undo()
        assert rows(store.read("t.x"), "k", "v") == want and not list(tmp_path.glob("lake/t/x.old-*"))
        calls.clear()

        class Stopped(BaseException):
            pass

        def stop(spark, old, new, n=allowed):
            calls.append(1)
            if len(calls) > n:
                raise Stopped
            return real(spark, old, new)

        monkeypatch.setattr(tables, "_rename", stop)
        with pytest.raises(Stopped):
            staged().publish()
        monkeypatch.undo()
        assert list(tmp_path.glob("lake/t/x.old-*"))
        assert rows(store.read("t.x"), "k", "v") == want and not list(tmp_path.glob("lake/t/x.old-*"))
    staged().publish()
    assert rows(store.read("t.x"), "k", "v") == merged and buckets.layout(spark, store.path("t.x")) == 8


def test_raw_tables_by_day_read_only_the_window(spark, tmp_path):
    store = Store(spark, str(tmp_path / "lake"))
    made = [("a", "2026-01-05 10:00:00"), ("b", "2026-01-06T00:00:00"), ("c", "?"), ("d", None), ("e", "2026-01-07")]
    store.append("bronze.r", spark.createDataFrame(made[:3], "k string, m string"), day_of="m")
    store.append("bronze.r", spark.createDataFrame([(*r, 1) for r in made[3:]], "k string, m string, n int"), day_of="m")
    assert store.read("bronze.r").columns == ["k", "m", "n"] and store.read("bronze.r").count() == 5
    window = (date(2026, 1, 6), date(2026, 1, 8))
    got = in_window(store.read("bronze.r", window), window, "m")
    assert rows(got, "k", "n") == [("b", None), ("e", 1)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_dia" in plan and len(store.read("bronze.r", window).inputFiles()) >= 2
    assert store.read("bronze.r", window).select("k").count() == 2
    with pytest.raises(ValueError, match="bronze.r.n"):
        store.append("bronze.r", spark.createDataFrame([("x", "y", "z")], "k string, m string, n string"), day_of="m")


def test_rows_are_counted_while_they_are_written(spark, tmp_path):
    store = Store(spark, str(tmp_path / "lake"), buckets=3)
    work = store.stage({"t.a": spark.range(10).repartition(4), "t.none": spark.range(0), "t.joined": spark.range(10).join(spark.range(5), "id")})
    work.merge("t.b", spark.createDataFrame([(f"k{i}", 1) for i in range(7)], "k string, m int"), "k", "m", False)
    assert work.counts == {"t.a": 10, "t.none": 0, "t.joined": 5, "t.b": 7}
    assert quality.keyed(spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string"), "k").first().asDict() == {"observados": 1, "total": 4}


def test_schemas_are_noted(spark, tmp_path):
    store = Store(spark, str(tmp_path / "lake"))
    store.put({"t.a": spark.createDataFrame([(1,)], "x int")})
    store.append("t.a", spark.createDataFrame([(2, "y")], "x int, y string"))
    assert rows(store.read("t.a"), "x", "y") == [(1, None), (2, "y")] and store.known_schema("t.a").names == ["x", "y"]
    spark.createDataFrame([(3, 4)], "x int, z int").write.parquet(store.path("t.b"))
    spark.createDataFrame([(5,)], "x int").write.mode("append").parquet(store.path("t.b"))
    assert store.known_schema("t.b") is None and rows(store.read("t.b"), "x", "z") == [(3, 4), (5, None)]
    store.append("t.b", spark.createDataFrame([(6,)], "x int"))
    assert rows(store.read("t.b"), "x", "z") == [(3, 4), (5, None), (6, None)]


def test_value_audit(spark):
    compras, itens, premios = raw_rows(spark)
    out = audit.value_semantics(compras, itens, premios, date(2026, 1, 1), date(2026, 1, 31), SECRET, exact=True)
    assert (out["resumo"]["resultados"], float(out["resumo"]["p5"]), out["motivos"], len(out["maiores"]), out["_meta"]["status"]) == (4, 6.0, {"elegivel": 4}, 4, "NAO_PUBLICAVEL")
    assert audit.value_semantics(compras, itens, premios, date(2025, 1, 1), date(2025, 1, 2), SECRET)["resumo"]["resultados"] == 0


def test_empty_raw_tables(spark, store):
    for t in core.RAW.values():
        store.put({t: store.read(t).limit(0)})
    out = json.loads(core.run(store, Run("r1", date(2026, 1, 31)), SECRET))
    assert set(out["regras"].values()) == {"SEM_DADOS"}
    report = json.loads(gold.run(store, "g1"))
    assert report["kpis_compras"]["resultados_tecnologia"] == 0 and store.read("gold.concentracao_fornecedores").count() == 0


def test_null_ids_of_awards_count_as_one(spark):
    from veraz.operators import gold as indicators

    columns = "resultado_id string, quantidade_homologada double, valor_unitario_homologado double, valor_total_homologado double"
    one = spark.createDataFrame([(None, 1.0, 2.0, 2.0), ("a", 1.0, 2.0, 2.0)], columns)
    assert rows(indicators.monetary_eligibility(one), "resultado_id", "elegivel_monetario") == [("a", True), (None, True)]
    two = one.union(one.where("resultado_id is null"))
    assert rows(indicators.monetary_eligibility(two), "resultado_id", "motivo_inelegibilidade_monetaria") == [("a", None), (None, "resultado_duplicado"), (None, "resultado_duplicado")]
    assert indicators.monetary_eligibility(one.limit(0)).count() == 0


def test_repeated_items_count_once_in_coverage(spark):
    from tests.test_operators import gold_inputs
    from veraz.operators import gold as indicators

    items, awards, procurements, links = gold_inputs(spark)
    history = spark.createDataFrame([], "regra string, run_id string, observados int, total int, percentual double, severidade string, status string, registrado_em string")
    out = indicators.quality_coverage(items.union(items), awards, procurements, links, history).where("categoria_tecnologia = 'monitor'").first()
    assert (out.total_itens, out.itens_com_resultado, out.itens_com_preco_unitario, out.resultados) == (4, 4, 4, 10)


def test_concentration_of_groups_without_a_method(spark):
    from tests.test_operators import gold_inputs
    from veraz.operators import gold as indicators

    items, awards, procurements, links = gold_inputs(spark)
    (r,) = indicators.supplier_concentration(items, awards, procurements.withColumn("modalidade", F.lit(None).cast("string")), links, source_validated=True).collect()
    assert (r.resultados_observados, r.fornecedores_distintos, r.resultados_elegiveis, r.top_1, r.limitacao) == (3, 0, 0, None, "resultados_insuficientes")
