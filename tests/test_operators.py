"""Behaviour of single operators on small rows."""

import hashlib
import hmac
import json
import re
from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from veraz.functions import expr
from veraz.operators import classify, context, gold, quality, silver, versioning


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


def procurement(spark, **changes):
    base = {"id_compra": "1", "numero_controle_PNCP": "A-1", "orgao_entidade_cnpj": "11", "objeto_compra": "x", "valor_total_estimado": "10.5", "data_publicacao_pncp": "2026-01-02", "modalidade_id_pncp": "6", "modalidade_nome": "P", "data_atualizacao_pncp": "2026-01-03", "ind_atual": "true", "contratacao_excluida": "false", "_sistema_origem": "S", "_source_file_id": "f1", "_run_id": "r", "_coletado_em_utc": "2026-01-04"}
    return [base | c for c in ([changes] if changes else [{}])]


def frame(spark, records):
    names = list(dict.fromkeys(k for r in records for k in r))
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in records], ", ".join(f"`{n}` string" for n in names))


def test_procurements_take_the_newest_and_tell_conflicts(spark):
    one = procurement(spark)[0]
    split = silver.procurements(frame(spark, [one, one | {"data_atualizacao_pncp": "2026-02-01", "objeto_compra": "new"}, one | {"id_compra": "2", "numero_controle_PNCP": "B", "objeto_compra": "p"}, one | {"id_compra": "2", "numero_controle_PNCP": "b", "objeto_compra": "q", "_run_id": "z"}]))
    assert rows(split.current, "objeto", "contratacao_id") == [("new", hashlib.sha256(b"pncp|a-1").hexdigest())]
    assert rows(split.conflicts, "objeto") == [("p",), ("q",)] and split.quarantine.count() == 0


def test_an_older_clean_version_becomes_current(spark):
    one = procurement(spark)[0]
    split = silver.procurements(frame(spark, [one, one | {"data_atualizacao_pncp": "2026-05-01", "objeto_compra": "a"}, one | {"data_atualizacao_pncp": "2026-05-01", "objeto_compra": "b"}]))
    assert rows(split.current, "objeto") == [("x",)] and split.conflicts.count() == 2


def test_metadata_is_not_content(spark):
    one = procurement(spark)[0]
    split = silver.procurements(frame(spark, [one, one | {"_source_file_id": "f2", "_run_id": "other"}]))
    assert rows(split.current, "source_file_id") == [("f2",)] and split.conflicts.count() == 0


@pytest.mark.parametrize(("change", "reason"), [({"orgao_entidade_cnpj": " "}, "cnpj_orgao_ausente"), ({"id_compra": None}, "id_origem_ausente"), ({"data_atualizacao_pncp": "??"}, "data_atualizacao_invalida"), ({"valor_total_estimado": "-1"}, "valor_total_negativo"), ({"orgao_entidade_cnpj": None, "valor_total_estimado": "-1"}, "cnpj_orgao_ausente")])
def test_quarantine_names_the_first_reason(spark, change, reason):
    split = silver.procurements(frame(spark, procurement(spark, **change)))
    assert rows(split.quarantine, "motivo_quarentena") == [(reason,)] and split.current.count() == 0


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(1, 3), st.integers(0, 1), st.sampled_from("xy")), max_size=12))
def test_versions_split_as_the_rule_says(spark, records):
    df = spark.createDataFrame([(k, t, str(h), f) for k, t, h, f in records], "e string, atualizado_em int, hash_conteudo string, source_file_id string")
    current, conflicts = versioning.split_versions(df, "e")
    torn = {(k, t) for k, t, h, _ in records for k2, t2, h2, _ in records if (k, t) == (k2, t2) and h != h2}
    want = {}
    for k, t, h, f in records:
        if (k, t) not in torn:
            want[k] = max(want.get(k, (0, "", "")), (t, f, str(h)))
    assert {(r.e, r.atualizado_em, r.source_file_id) for r in current.collect()} == {(k, t, f) for k, (t, f, _) in want.items()}
    assert conflicts.count() == sum((k, t) in torn for k, t, _, _ in records)


def test_null_keys_are_never_in_conflict(spark):
    df = spark.createDataFrame([(None, 1, "a", "f"), (None, 1, "b", "g")], "e string, atualizado_em int, hash_conteudo string, source_file_id string")
    current, conflicts = versioning.split_versions(df, "e")
    assert conflicts.count() == 0 and current.count() == 1


AWARD = {"srk_item_resultado": "1", "numero_controle_PNCP_compra": "A", "numero_item_pncp": "1", "sequencial_resultado": "1", "tipo_pessoa": "PF", "codigo_pais": "BRA", "ni_fornecedor": "123.456.789-00", "nome_razao_social_fornecedor": "Fulano", "quantidade_homologada": "2", "valor_unitario_homologado": "3", "valor_total_homologado": "6", "data_atualizacao_pncp": "2026-01-01", "_source_file_id": "f"}


def test_awards_hide_natural_persons(spark):
    out = silver.awards(frame(spark, [AWARD, AWARD | {"numero_item_pncp": "2", "tipo_pessoa": "PJ", "ni_fornecedor": "12.345.678/0001-90"}, AWARD | {"numero_item_pncp": "3", "tipo_pessoa": None}, AWARD | {"numero_item_pncp": "4", "ni_fornecedor": ""}]), "secret")
    assert rows(out.suppliers, "tipo_pessoa", "identificador_publico") == [("PF", None), ("PJ", "12345678000190"), (None, None)]
    person = hmac.new(b"secret", b"PF|BRA|12345678900", hashlib.sha256).hexdigest()
    assert person in {r.fornecedor_id for r in out.suppliers.collect()}
    for df in (out.current, out.quarantine, out.conflicts):
        assert not {"identificador_normalizado", "chave_fornecedor", "nome_fornecedor"} & set(df.columns)
    assert rows(out.quarantine, "motivo_quarentena") == [("fornecedor_ausente",)]


def test_cancellation_has_three_values(spark):
    base = frame(spark, [AWARD | {"numero_item_pncp": str(i), "data_cancelamento_pncp": d, "situacao_compra_item_resultado_nome": s} for i, (d, s) in enumerate([(None, None), ("2026-01-01", None), (None, "Cancelado"), (None, "Informado")])])
    assert rows(silver.awards(base, "s").current, "numero_item", "cancelado") == [("0", None), ("1", True), ("2", True), ("3", False)]
    missing = silver.awards(frame(spark, [AWARD]), "s").current
    assert rows(missing, "cancelado") == [(None,)]


@pytest.mark.parametrize("secret", ["k", "x" * 100])
def test_native_hmac(spark, secret):
    df = spark.createDataFrame([("PF|BRA|é1",), ("",), (None,)], "c string").select(expr.hmac_sha256(F.col("c"), secret).alias("h"))
    assert [r.h for r in df.collect()] == [hmac.new(secret.encode(), "PF|BRA|é1".encode(), hashlib.sha256).hexdigest(), None, None]


def test_content_hash_covers_nulls_and_order(spark):
    df = spark.createDataFrame([("a", None), (None, "a")], "x string, y string").select(expr.content_hash(["x", "y"], "v").alias("h"))
    a, b = (r.h for r in df.collect())
    assert a != b and a == hashlib.sha256(json.dumps({"versao": "v", "x": "a", "y": None}, separators=(",", ":")).encode()).hexdigest()


def test_equipment(spark):
    texts = ["Notebooks 14", "computador de mesa", "computadores", "Monitor  de vídeo", "monitor cardiaco", "impressora laser", "Servidor publico", "access point wifi", "mesa", None]
    df = spark.createDataFrame([(t, "M") for t in texts] + [("notebook", "S"), ("notebook", None)], "descricao string, material_ou_servico string")
    assert [r.categoria_tecnologia for r in classify.equipment(df).collect()] == ["computador_notebook", "computador_notebook", "incerto", "monitor", "incerto", "impressora_scanner", "servidor", "equipamento_rede", "incerto", "incerto", "incerto", "incerto"]


def test_services(spark):
    texts = ["  Software como Serviço - SaaS ", "CESSÃO temporária de direitos sobre programa de computador", "Fábrica de software", "Outsourcing de impressão", "suporte técnico em TIC", "Serviço de instalação e manutenção de rede local de computadores", "limpeza"]
    df = spark.createDataFrame([(t, "S") for t in texts] + [("limpeza", "M")], "descricao string, material_ou_servico string")
    out = classify.services(classify.equipment(df)).collect()
    assert [r.categoria_servico for r in out] == ["cloud", "licenciamento", "desenvolvimento", "outsourcing", "suporte", "infraestrutura", "incerto", None]
    assert (out[0].categoria_tecnologia, out[0].status_preco_servico, out[6].status_preco_servico, out[7].status_preco_servico) == ("servico_cloud", "nao_publicavel", "fora_escopo", None)


CONTRACT = {"id": "1", "numero": "9", "fornecedor_tipo": "Pessoa Juridica", "fonecedor_cnpj_cpf_idgener": "12.345.678/0001-90", "vigencia_inicio": "2026-01-01", "vigencia_fim": "2026-12-31", "valor_inicial": "1", "valor_global": "1", "_coletado_em_utc": "2026-02-01", "_source_file_id": "f"}


def test_contracts(spark):
    bad = [CONTRACT | {"id": "2", "valor_global": "-1", "vigencia_fim": "2020-01-01"}, CONTRACT | {"id": "3", "vigencia_fim": "2020-01-01"}, CONTRACT | {"id": "4", "_coletado_em_utc": "x"}, CONTRACT | {"id": "5", "fornecedor_tipo": "PESSOA JURÍDICA"}]
    out = silver.contracts(frame(spark, [CONTRACT | {"_data_publicacao_arquivo": "2026-03-01"}, *bad]), "s")
    assert rows(out.quarantine, "id_origem_contrato", "motivo_quarentena") == [("2", "valor_global_negativo"), ("3", "vigencia_incoerente"), ("4", "observacao_invalida")]
    assert [str(r.atualizado_em)[:10] for r in out.current.orderBy("id_origem_contrato").collect()] == ["2026-03-01", "2026-02-01"]
    assert rows(out.suppliers, "tipo_pessoa", "identificador_publico") == [("DESCONHECIDO", None), ("PJ", "12345678000190")]


def test_contract_items_and_events(spark):
    item = {"id": "1", "contrato_id": "1", "tipo_id": "Material", "descricao_complementar": "notebook", "quantidade": "1", "valorunitario": " ", "valortotal": "2", "data_inicio_item": "{'date': '2026-04-05 00:00:00.000000', 'timezone': 'x'}", "_coletado_em_utc": "2026-01-01", "_source_file_id": "f"}
    split = silver.contract_items(frame(spark, [item, item | {"id": "2", "contrato_id": ""}]))
    (r,) = split.current.collect()
    assert (r.descricao, r.valor_unitario, r.motivo_ineligibilidade_preco, str(r.data_inicio_item)[:10]) == ("notebook", None, "valor_unitario_ausente", "2026-04-05")
    assert rows(split.quarantine, "motivo_quarentena") == [("contrato_ausente",)]
    event = {"id": "1", "contrato_id": "1", "tipo": "t", "valor_global": "10", "novo_valor_global": "12.5", "criado_em": "2026-01-01", "_source_file_id": "f"}
    (e,) = silver.contract_events(frame(spark, [event, event | {"alterado_em": "2026-02-01", "novo_valor_global": "15"}])).current.collect()
    assert float(e.variacao_valor) == 5.0


def gold_inputs(spark):
    items = spark.createDataFrame([("c1", f"i{k}", "monitor" if k < 4 else "incerto", "UN", 1.0, 2.0, "M") for k in range(5)], "contratacao_id string, item_id string, categoria_tecnologia string, unidade_medida string, quantidade double, valor_unitario_estimado double, material_ou_servico string")
    awards = spark.createDataFrame([("r0", "i0", "s1", 1.0, 9.0, 9.0, False), ("r1", "i1", "s1", 1.0, 81.0, 81.0, False), ("r2", "i2", "s2", 1.0, 10.0, 10.0, False), ("r3", "i3", "s2", 1.0, 10.0, 10.0, True), ("r4", "i3", "s3", 1.0, 10.0, 10.0, None)], "resultado_id string, item_id string, fornecedor_id string, quantidade_homologada double, valor_unitario_homologado double, valor_total_homologado double, cancelado boolean")
    procurements = spark.createDataFrame([("c1", "2026-01-02", "6", "Pregão")], "contratacao_id string, publicado_em string, modalidade_id string, modalidade string")
    links = spark.createDataFrame([("c1", "o1", "u1")], "contratacao_id string, orgao_id string, unidade_id string")
    return items, awards, procurements, links


def test_concentration_shares_and_gates(spark):
    items, awards, procurements, links = gold_inputs(spark)
    (r,) = gold.supplier_concentration(items, awards, procurements, links, source_validated=True).collect()
    assert (round(r.top_1, 6), round(r.top_3, 6), round(r.hhi, 6), r.status_publicacao) == (0.9, 1.0, 0.82, "publicada")
    (r,) = gold.supplier_concentration(items, awards, procurements, links).collect()
    assert (r.top_1, r.valor_observado, r.limitacao, r.gate_monetario) == (None, None, "semantica_fonte_nao_validada", "reprovado")
    (r,) = gold.supplier_concentration(items, awards, procurements, links, min_suppliers=3, source_validated=True).collect()
    assert r.limitacao == "fornecedores_insuficientes"
    odd = awards.withColumn("valor_total_homologado", F.when(F.col("resultado_id") == "r0", 500.0).otherwise(F.col("valor_total_homologado")))
    (r,) = gold.supplier_concentration(items, odd, procurements, links, source_validated=True).collect()
    assert (r.limitacao, r.resultados_observados, r.resultados_semantica_elegivel) == ("semantica_valor_inconsistente", 3, 2)
    (r,) = gold.supplier_concentration(items, awards.withColumn("fornecedor_id", F.lit(None).cast("string")), procurements, links, source_validated=True).collect()
    assert (r.fornecedores_distintos, r.resultados_elegiveis, r.limitacao) == (0, 0, "resultados_insuficientes")


def test_rounded_shares_stay_within_one(spark):
    items, awards, procurements, links = gold_inputs(spark)
    cents = awards.where("resultado_id in ('r0', 'r1', 'r2')").withColumns({"fornecedor_id": F.col("resultado_id"), **{c: F.when(F.col("resultado_id") == "r2", 4).otherwise(1).cast("decimal(38,2)") for c in ("valor_total_homologado", "valor_unitario_homologado")}})
    out = gold.supplier_concentration(items, cents, procurements, links, source_validated=True)
    assert gold.concentration_violations(out).count() == 0 and float(out.first().top_3) <= 1


def test_eligibility_needs_its_columns(spark):
    with pytest.raises(ValueError, match="valor_total_homologado"):
        gold.monetary_eligibility(spark.createDataFrame([("r",)], "resultado_id string"))


def test_relations_and_their_indicators(spark):
    items, awards, procurements, links = gold_inputs(spark)
    related = gold.relations(items, awards, procurements, links)
    assert rows(related, "resultado_id") == [("r0",), ("r1",), ("r2",)]  # neither cancelled nor unknown
    assert gold.recurrence(related).count() == 0 and gold.recurrence(related, 1).count() == 2
    assert rows(gold.agency_supplier_edges(related), "fornecedor_id", "resultados_distintos") == [("s1", 2), ("s2", 1)]
    units = spark.createDataFrame([("u1", "SP", "x")], "unidade_id string, uf string, municipio string")
    assert rows(gold.supplier_presence(related, units), "fornecedor_id", "ufs_distintas") == [("s1", 1), ("s2", 1)]
    assert tuple(gold.procurement_kpis(related).first()) == (1, 3, 3, 2, 0)


def test_coverage_counts_cancelled_awards(spark):
    items, awards, procurements, links = gold_inputs(spark)
    history = spark.createDataFrame([("x", "1", 1, 2, 50.0, "erro", "FAIL", "2026-01-01"), ("x", "2", 0, 2, 0.0, "erro", "PASS", "2026-02-01")], "regra string, run_id string, observados int, total int, percentual double, severidade string, status string, registrado_em string")
    out = gold.quality_coverage(items, awards, procurements, links, history).collect()
    monitor = next(r for r in out if r.categoria_tecnologia == "monitor")
    assert (monitor.total_itens, monitor.resultados, monitor.cobertura_resultado) == (4, 5, 1.0)
    assert [(r.metrica, r.status_qualidade) for r in out if r.entidade == "pipeline"] == [("x", "PASS")]


def test_contract_evolution(spark):
    contracts = spark.createDataFrame([("1", "o", "f", "2026-01-01", "2026-12-31", 1.0, 1.0), ("2", "o", "f", "2026-01-01", None, 1.0, 1.0)], "contrato_id string, orgao_codigo string, fornecedor_id string, vigencia_inicio string, vigencia_fim string, valor_inicial double, valor_global double")
    events = spark.createDataFrame([("e1", "1", "t", "2026-02-01", "2027-03-31", 5.0), ("e2", "1", "t", "2026-03-01", None, None)], "evento_contrato_id string, contrato_id string, tipo_evento string, data_assinatura string, vigencia_fim string, variacao_valor double")
    a, b = gold.contract_evolution(contracts, events).orderBy("contrato_id").collect()
    assert (a.extensao_vigencia_dias, a.eventos_distintos, a.variacao_valor_acumulada, a.vigencia_fim_atual) == (90, 2, 5.0, date(2027, 3, 31))
    assert (b.extensao_vigencia_dias, b.eventos_distintos) == (None, 0)


def test_context(spark):
    companies = context.companies(frame(spark, [{"cnpj_basico": "12.345.678", "razao_social": " A ", "natureza_juridica": "1", "capital_social": "1000,50", "porte_empresa": "5"}, {"cnpj_basico": "12345678", "capital_social": "x"}, {"cnpj_basico": "1"}]))
    partners = context.partner_summary(frame(spark, [{"cnpj_basico": "12345678", "tipo_socio": "1", "data_entrada_sociedade": "20200101"}, {"cnpj_basico": "12345678", "tipo_socio": "2", "data_entrada_sociedade": ""}]))
    listed = context.sanctions(frame(spark, [{"cnpj_sancionado": "12345678000190", "cadastro": "CEIS", "codigo_sancao": "1", "data_inicio_sancao": "01/02/2026", "data_final_sancao": ""}]))
    suppliers = frame(spark, [{"fornecedor_id": "a", "identificador_publico": "12.345.678/0001-90", "nome_fornecedor": "A"}, {"fornecedor_id": "b", "identificador_publico": "98765432000100", "nome_fornecedor": "B"}, {"fornecedor_id": "c", "identificador_publico": None}])
    a, b = context.supplier_context(suppliers, companies, partners, listed).orderBy("fornecedor_id").collect()
    assert (float(a.capital_social), a.registros_socios, a.socios_pessoa_juridica, a.sancoes_ceis, a.cobertura_cnpj_receita, a.entrada_socio_mais_recente) == (1000.5, 2, 1, 1, 1.0, date(2020, 1, 1))
    assert (b.registros_socios, b.sancoes_distintas, b.cobertura_cnpj_receita) == (0, 0, 0.0)


def test_watermark_and_rules():
    assert quality.incremental_window(date(2026, 1, 10), date(2026, 1, 12)) == (date(2026, 1, 8), date(2026, 1, 12))
    with pytest.raises(ValueError):
        quality.incremental_window(date(2026, 1, 10), date(2026, 1, 9))
    old, new = date(2026, 1, 1), date(2026, 2, 1)
    assert [quality.next_watermark(p, new, m, ok) for p, m, ok in ((old, "bootstrap", True), (None, "bootstrap", True), (old, "incremental", True), (old, "incremental", False), (old, "reprocessamento", True))] == [old, new, new, old, old]
    assert [quality.judge_rule("r", o, t, 0, s).status for o, t, s in ((0, 0, "erro"), (1, 3, "erro"), (1, 3, "alerta"), (0, 3, "erro"))] == ["SEM_DADOS", "FAIL", "ALERT", "PASS"]
    assert quality.judge_rule("r", 1, 3, 0, "erro").percentual == 33.3333
    with pytest.raises(quality.GateFailed):
        quality.gate([quality.judge_rule("r", 1, 3, 0, "erro")])
    assert quality.reconciliation({"entrada": 5, "quarentena": 1, "conflitos": 1, "publicados": 3, "pendentes": 1}) == 1


def test_http_dates(spark):
    df = spark.createDataFrame([("Tue, 15 Nov 1994 08:12:31 GMT",), ("x",), (None,)], "c string").select(expr.rfc1123(F.col("c")).cast("string").alias("t"))
    assert [r.t for r in df.collect()] == ["1994-11-15 08:12:31", None, None]


def test_overlapping_rules_give_the_first(spark):
    """One pattern for all rules, alternatives within rules included, decides nothing about their order."""
    rules = (("ab", r"^a(b|c)"), ("a", r"^a|x$"), ("any", r"^..z"))
    texts = ["abz", "acz", "adz", "bx", "bbz", "ab", "", "zz", None, "q"]
    want = {t: next((n for n, p in rules if t is not None and re.search(p, t)), None) for t in texts}
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert {r.t: r.c for r in df.select("t", classify.by_rules(F.col("t"), rules).alias("c")).collect()} == want
