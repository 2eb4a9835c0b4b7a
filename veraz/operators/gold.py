"""Indicators with publication gates.

The star join of awards, items, procurements and links is prepared once (``relations``) and handed
to the indicators that read it. Group totals that are sums over rows use decimals or exact counts;
ratios are doubles. A gate that fails masks the values and says why in ``limitacao``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from veraz.functions.expr import first_reason, ratio, require
from veraz.operators.classify import UNKNOWN
from veraz.operators.versioning import latest

DIMENSIONS = ("periodo", "orgao_id", "categoria_tecnologia", "modalidade_id", "modalidade")
COVERAGE = ("resultado", "fornecedor", "unidade", "quantidade", "preco_unitario", "categoria", "orgao")


def period(c: str) -> Column:
    return F.date_format(F.try_to_timestamp(F.col(c).cast("string")), "yyyy-MM")


def distinct_counts(rows: DataFrame, keys: tuple[str, ...], columns: dict[str, str], within: str | None = None) -> DataFrame:
    """Distinct counts of several columns (column -> name), and the first and last value of ``within``. What is
    counted becomes rows (keys, place of the column, value), which are made distinct where they lie
    before they move; so each value of a group counts in its own task, however large the group is."""
    bounds = [F.col(within).alias("_first"), F.col(within).alias("_last")] if within else []
    ends = [F.min("_first").alias("_first"), F.max("_last").alias("_last")] if within else []
    listed = rows.select(*keys, F.posexplode(F.array(*(F.col(c).cast("string") for c in columns))).alias("_place", "_value"), *bounds)
    once = listed.groupBy(*keys, "_place", "_value").agg(*ends) if within else listed.distinct()
    counts = [F.count_if((F.col("_place") == i) & F.col("_value").isNotNull()).alias(n) for i, n in enumerate(columns.values())]
    return once.groupBy(*keys).agg(*counts, *ends)


def with_share(rows: DataFrame, value: str, keys: tuple[str, ...], name: str) -> DataFrame:
    """Adds the share of each row's value in the sum of its group. The sums are aggregated and joined
    back, so that a large group doesn't gather in one task; null keys are one group."""
    sums = rows.groupBy(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys))).agg(F.sum(value).alias("_sum"))
    same = [rows[k].eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    return rows.join(sums, same).withColumn(name, F.col(value) / F.col("_sum")).select(*rows.columns, name)


def published(df: DataFrame, limitation: str | None = None, masked_total: bool = False) -> DataFrame:
    columns = {"status_publicacao": F.lit("publicada")}
    if masked_total:
        columns["valor_total_homologado"] = F.lit(None).cast("decimal(38,2)")
    if limitation:
        columns["limitacao"] = F.lit(limitation)
    return df.withColumns(columns)


def monetary_eligibility(awards: DataFrame) -> DataFrame:
    """Adds motivo_inelegibilidade_monetaria and elegivel_monetario. Repeated ids, the null id among them,
    are found by one count with partial aggregation, joined back."""
    require(awards, "resultado_id", "quantidade_homologada", "valor_unitario_homologado", "valor_total_homologado")
    total, quantity, unit = F.col("valor_total_homologado"), F.col("quantidade_homologada"), F.col("valor_unitario_homologado")
    # The id as an array is never null, so null ids can be joined like others. Only a null id may stand in many
    # rows of a sound table, so its rows are spread over salts, for each of which it is marked.
    salts = 64
    salt = F.when(F.col("resultado_id").isNull(), F.pmod(F.xxhash64(*(c for c in awards.columns if c != "resultado_id")), F.lit(salts))).otherwise(F.lit(0).cast("long"))
    places = F.when(F.col("_id")[0].isNull(), F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))).otherwise(F.array(F.lit(0).cast("long")))
    repeated = awards.groupBy(F.array("resultado_id").alias("_id")).count().where("count > 1").select("_id", F.explode(places).alias("_salt"), F.lit(True).alias("_twice"))
    marked = awards.withColumns({"_id": F.array("resultado_id"), "_salt": salt}).join(repeated, ["_id", "_salt"], "left")
    reason = first_reason([
        ("resultado_duplicado", F.col("_twice")),
        ("quantidade_homologada_invalida", quantity.isNull() | (quantity <= 0)),
        ("valor_unitario_homologado_invalido", unit.isNull() | (unit <= 0)),
        ("valor_total_homologado_invalido", total.isNull() | (total <= 0)),
        ("total_diverge_quantidade_vezes_unitario", F.abs(total - quantity * unit) > F.greatest(F.lit(0.01), F.abs(total) * 0.01)),
    ])
    return marked.withColumn("motivo_inelegibilidade_monetaria", reason).withColumn("elegivel_monetario", F.col("motivo_inelegibilidade_monetaria").isNull()).select(*awards.columns, "motivo_inelegibilidade_monetaria", "elegivel_monetario")


def latest_rules(quality: DataFrame) -> DataFrame:
    """The latest result of each quality rule."""
    moment = quality.withColumn("_em", F.try_to_timestamp(F.col("registrado_em").cast("string")))
    return latest(moment, "regra", ("_em", "run_id")).drop("_em")


def quality_coverage(items: DataFrame, awards: DataFrame, procurements: DataFrame, links: DataFrame, quality: DataFrame) -> DataFrame:
    """Coverage of items by period, method and category, and the latest operational rules. Cancelled
    awards count here."""
    # Distinct counts in two steps: one row for each award and item, then sums.
    once = awards.groupBy("item_id", "resultado_id").agg(F.max(F.col("fornecedor_id").isNotNull().cast("int")).alias("_com"))
    per_item = once.where(F.col("resultado_id").isNotNull()).groupBy("item_id").agg(F.count("*").alias("resultados"), F.sum("_com").alias("resultados_com_fornecedor"))
    base = items.select("item_id", "contratacao_id", "categoria_tecnologia", "unidade_medida", "quantidade", "valor_unitario_estimado")
    base = base.join(procurements.select("contratacao_id", "publicado_em", "modalidade_id", "modalidade"), "contratacao_id", "left").join(links.select("contratacao_id", "orgao_id"), "contratacao_id", "left").join(per_item, "item_id", "left")
    base = base.withColumns({
        "periodo": F.coalesce(period("publicado_em"), F.lit("nao_informado")),
        "modalidade_id": F.coalesce("modalidade_id", F.lit("nao_informada")),
        "modalidade": F.coalesce("modalidade", F.lit("Nao informada")),
        "categoria_tecnologia": F.coalesce("categoria_tecnologia", F.lit(UNKNOWN)),
    })
    dims = ("periodo", "modalidade_id", "modalidade", "categoria_tecnologia")
    has = {
        "resultado": F.col("resultados") > 0,
        "unidade": F.col("unidade_medida").isNotNull(),
        "quantidade": F.col("quantidade") > 0,
        "preco_unitario": F.col("valor_unitario_estimado").isNotNull(),
        "categoria": F.col("categoria_tecnologia") != UNKNOWN,
        "orgao": F.col("orgao_id").isNotNull(),
    }
    summed = ("resultados", "resultados_com_fornecedor")
    flag = lambda c: F.max((c & F.col("item_id").isNotNull()).cast("int"))
    # An item that occurs more than once in a group counts once.
    by_item = base.groupBy(*dims, "item_id").agg(*(F.sum(F.coalesce(c, F.lit(0))).alias(c) for c in summed), *(flag(c).alias(f"itens_com_{n}") for n, c in has.items()))
    counted = by_item.groupBy(*dims).agg(F.count("item_id").alias("total_itens"), *(F.sum(c).alias(c) for c in summed), *(F.coalesce(F.sum(f"itens_com_{n}"), F.lit(0)).alias(f"itens_com_{n}") for n in has))
    names = ("total_itens", "itens_com_resultado", *summed, *(f"itens_com_{n}" for n in has if n != "resultado"))
    covered = counted.select(*dims, *names)
    shares = {f"cobertura_{c}": ratio(F.col("resultados_com_fornecedor"), F.col("resultados")) if c == "fornecedor" else F.col(f"itens_com_{c}").cast("double") / F.col("total_itens") for c in COVERAGE}
    covered = covered.withColumns({**shares, "entidade": F.lit("item_contratacao"), "metrica": F.lit("cobertura_analitica"), "status_qualidade": F.lit("PASS")})
    rules = latest_rules(quality).select(
        F.lit("janela_atual").alias("periodo"), F.lit("todos").alias("modalidade_id"), F.lit("Todas").alias("modalidade"), F.lit("todas").alias("categoria_tecnologia"), F.lit("pipeline").alias("entidade"), F.col("regra").alias("metrica"),
        F.col("observados").cast("long"), F.col("total").cast("long"), F.col("percentual").cast("double"), F.col("severidade").cast("string"), F.col("status").alias("status_qualidade"),
    )
    return published(covered.unionByName(rules, allowMissingColumns=True))


def supplier_concentration(items: DataFrame, awards: DataFrame, procurements: DataFrame, links: DataFrame, min_suppliers: int = 2, min_awards: int = 3, min_coverage: float = 0.8, source_validated: bool = False) -> DataFrame:
    """Shares of suppliers by period, agency, category and method, masked unless every gate holds."""
    dims = list(DIMENSIONS)
    judged = monetary_eligibility(awards).select("resultado_id", "item_id", "fornecedor_id", "valor_total_homologado", "cancelado", "elegivel_monetario")
    base = (
        judged.where(~F.col("cancelado"))
        .join(items.where(F.col("categoria_tecnologia") != UNKNOWN).select("item_id", "contratacao_id", "categoria_tecnologia"), "item_id")
        .join(procurements.select("contratacao_id", period("publicado_em").alias("periodo"), "modalidade_id", "modalidade"), "contratacao_id")
        .join(links.select("contratacao_id", "orgao_id"), "contratacao_id")
        .where(F.col("periodo").isNotNull() & F.col("orgao_id").isNotNull() & F.col("modalidade_id").isNotNull())
    )
    # One relation, reduced in steps: awards of a group, suppliers of a group, groups. An eligible
    # award occurs once, so its supplier and value are those of its only row.
    value, good = F.col("valor_total_homologado"), F.col("elegivel_monetario")
    by_award = base.groupBy(*dims, "resultado_id").agg(
        F.sum(F.when(value > 0, value).otherwise(0)).alias("_seen"),
        F.max(good.cast("int")).alias("_good"),
        F.max(F.when(good, F.col("fornecedor_id"))).alias("fornecedor_id"),
        F.sum(F.when(good, value)).alias("_value"),
    )
    by_supplier = by_award.groupBy(*dims, "fornecedor_id").agg(F.count("resultado_id").alias("_n"), F.sum(F.when(F.col("resultado_id").isNotNull(), F.col("_good"))).alias("_awards"), F.sum("_seen").alias("_seen"), F.sum("_value").alias("_value"))
    # A missing method leaves a group without suppliers.
    known = F.col("fornecedor_id").isNotNull() & F.col("modalidade").isNotNull()
    group = W.partitionBy(*dims)
    shares = (
        by_supplier.withColumns({"_known": known, "_own": F.when(known, F.col("_value"))})
        .withColumns({"_total": F.sum("_own").over(group), "_place": F.row_number().over(group.orderBy(F.desc_nulls_last("_known"), F.desc_nulls_last("_own"), "fornecedor_id"))})
        .withColumn("_share", F.col("_own") / F.col("_total"))
    )
    # Rounded decimal shares can add up to a little over one.
    joined = shares.groupBy(*dims).agg(
        F.sum("_n").alias("resultados_observados"),
        F.coalesce(F.sum("_awards"), F.lit(0)).cast("long").alias("resultados_semantica_elegivel"),
        F.sum("_seen").alias("valor_observado"),
        F.max("_total").alias("valor_total_homologado"),
        F.count_if(F.col("_known")).alias("fornecedores_distintos"),
        F.coalesce(F.sum(F.when(F.col("_known"), F.col("_awards"))), F.lit(0)).cast("long").alias("resultados_elegiveis"),
        F.max("_share").alias("top_1"),
        F.least(F.lit(1.0), F.sum(F.when(F.col("_known") & (F.col("_place") <= 3), F.col("_share")))).alias("top_3"),
        F.sum(F.col("_share") * F.col("_share")).alias("hhi"),
    )
    joined = joined.withColumns({
        "cobertura_valor": F.when(F.col("valor_observado") > 0, F.col("valor_total_homologado") / F.col("valor_observado")).otherwise(F.lit(0.0)),
        "cobertura_semantica_valor": F.col("resultados_semantica_elegivel") / F.col("resultados_observados"),
    })
    limitation = first_reason([
        ("semantica_fonte_nao_validada", F.lit(not source_validated)),
        ("semantica_valor_inconsistente", F.col("cobertura_semantica_valor") < 1),
        ("resultados_insuficientes", F.col("resultados_elegiveis") < min_awards),
        ("fornecedores_insuficientes", F.col("fornecedores_distintos") < min_suppliers),
        ("cobertura_valor_insuficiente", F.col("cobertura_valor") < min_coverage),
    ])
    passed = F.col("limitacao").isNull()
    masked = ("top_1", "top_3", "hhi", "valor_total_homologado", "valor_observado", "cobertura_valor")
    return joined.withColumn("limitacao", limitation).withColumns({
        "status_publicacao": F.when(passed, "publicada").otherwise("nao_publicavel"),
        "gate_monetario": F.when(passed, "aprovado").otherwise("reprovado"),
        **{c: F.when(passed, F.col(c)) for c in masked},
    })


def concentration_violations(concentration: DataFrame) -> DataFrame:
    """Rows that break 0 <= top_1 <= top_3 <= 1, 0 <= hhi <= 1 or a coverage between 0 and 1."""
    between = lambda c: F.col(c).between(0, 1)
    sound = between("top_1") & between("top_3") & (F.col("top_1") <= F.col("top_3")) & between("hhi") & between("cobertura_valor") & between("cobertura_semantica_valor")
    return concentration.where(~F.coalesce(sound, F.lit(True)))


def service_coverage(items: DataFrame) -> DataFrame:
    known = items.where(F.col("categoria_servico").isNotNull() & (F.col("categoria_servico") != UNKNOWN))
    marked = known.withColumns({"_unit": F.when(F.col("unidade_medida").isNotNull(), F.col("item_id")), "_price": F.when(F.col("valor_unitario_estimado").isNotNull(), F.col("item_id"))})
    counted = distinct_counts(marked, ("categoria_servico",), {"item_id": "total_itens", "_unit": "itens_com_unidade", "_price": "itens_com_preco", "unidade_medida": "unidades_distintas"})
    return counted.withColumns({
        "cobertura_unidade": F.col("itens_com_unidade").cast("double") / F.col("total_itens"),
        "cobertura_preco": F.col("itens_com_preco").cast("double") / F.col("total_itens"),
        "status_publicacao_preco": F.lit("nao_publicavel"),
        "limitacao_preco": F.lit("escopo_unidade_sla_nao_estruturados"),
    })


RELATION = ("resultado_id", "item_id", "contratacao_id", "orgao_id", "unidade_id", "fornecedor_id", "categoria_tecnologia", "modalidade_id", "modalidade", "valor_total_homologado", "cancelado", "publicado_em", "data_publicacao", "periodo")


def relations(items: DataFrame, awards: DataFrame, procurements: DataFrame, links: DataFrame) -> DataFrame:
    """One row per award that isn't cancelled, of a classified item, with supplier, agency and date.
    Persist it where several indicators read it."""
    day = F.to_date(F.try_to_timestamp(F.col("publicado_em").cast("string")))
    joined = (
        awards.where(~F.col("cancelado") & F.col("fornecedor_id").isNotNull())
        .select("resultado_id", "item_id", "fornecedor_id", "valor_total_homologado", "cancelado")
        .join(items.where(F.col("categoria_tecnologia") != UNKNOWN).select("item_id", "contratacao_id", "categoria_tecnologia"), "item_id")
        .join(procurements.select("contratacao_id", "publicado_em", day.alias("data_publicacao"), "modalidade_id", "modalidade").where(F.col("data_publicacao").isNotNull()), "contratacao_id")
        .join(links.where(F.col("orgao_id").isNotNull()).select("contratacao_id", "orgao_id", "unidade_id"), "contratacao_id")
        .withColumn("periodo", F.date_format("data_publicacao", "yyyy-MM"))
    )
    return latest(joined.select(*RELATION), "resultado_id", ("data_publicacao",))


def recurrence(related: DataFrame, at_least: int = 2) -> DataFrame:
    """Agencies and suppliers that meet in ``at_least`` procurements of a category."""
    counted = distinct_counts(related, ("orgao_id", "fornecedor_id", "categoria_tecnologia"), {"contratacao_id": "contratacoes_distintas", "resultado_id": "resultados_distintos", "periodo": "periodos_distintos"}, "data_publicacao")
    counted = counted.withColumnsRenamed({"_first": "primeira_ocorrencia", "_last": "ultima_ocorrencia"})
    kept = counted.where(F.col("contratacoes_distintas") >= at_least).withColumn("dias_entre_primeira_ultima", F.datediff("ultima_ocorrencia", "primeira_ocorrencia"))
    return published(kept, "recorrencia_descritiva_nao_indica_irregularidade", masked_total=True)


def procurement_kpis(related: DataFrame, at_least: int = 2) -> DataFrame:
    """One row of distinct counts, and of recurrent relations. The relation is read once: what is
    counted becomes rows (kind, key, part), which are made distinct and counted by kind and key."""
    once = related.groupBy("contratacao_id", "item_id", "fornecedor_id", "orgao_id", "categoria_tecnologia").agg(F.count("resultado_id").alias("_n"))
    row = lambda kind, key, part, n: F.struct(F.lit(kind).alias("kind"), key.alias("key"), part.alias("part"), n.alias("n"))
    none, zero = F.lit(None).cast("string"), F.lit(0).cast("long")
    text = lambda c: F.col(c).cast("string")
    triple = F.to_json(F.array(text("orgao_id"), text("fornecedor_id"), text("categoria_tecnologia")))
    single = {"compra": "contratacao_id", "item": "item_id", "fornecedor": "fornecedor_id"}
    rows = once.select(F.explode(F.array(*(row(k, text(c), none, zero) for k, c in single.items()), row("relacao", triple, text("contratacao_id"), F.col("_n")))).alias("r")).select("r.*")
    keys = rows.groupBy("kind", "key", "part").agg(F.sum("n").alias("n")).groupBy("kind", "key").agg(F.count("part").alias("parts"), F.sum("n").alias("n"))
    counted = lambda kind: F.count_if((F.col("kind") == kind) & F.col("key").isNotNull())
    return keys.agg(
        counted("compra").alias("compras_tecnologia"),
        counted("item").alias("itens_tecnologia"),
        F.coalesce(F.sum("n"), zero).alias("resultados_tecnologia"),
        counted("fornecedor").alias("fornecedores_compras_tecnologia"),
        F.count_if((F.col("kind") == "relacao") & (F.col("parts") >= at_least)).alias("relacoes_recorrentes"),
    )


def supplier_presence(related: DataFrame, units: DataFrame) -> DataFrame:
    """Where suppliers occur. Rows that say the same are one before anything is joined or counted."""
    distinct = {"orgao_id": "orgaos_distintos", "unidade_id": "unidades_distintas", "uf": "ufs_distintas", "municipio": "municipios_distintos", "modalidade_id": "modalidades_distintas", "periodo": "periodos_distintos", "contratacao_id": "contratacoes_distintas"}
    keys = ("fornecedor_id", "categoria_tecnologia")
    own = [c for c in distinct if c not in ("uf", "municipio")]
    joined = related.select(*keys, *own).distinct().join(units.select("unidade_id", "uf", "municipio"), "unidade_id", "left")
    counted = distinct_counts(joined, keys, distinct)
    return published(counted, "presenca_restrita_a_resultados_homologados", masked_total=True)


def agency_supplier_edges(related: DataFrame) -> DataFrame:
    distinct = {"contratacao_id": "contratacoes_distintas", "resultado_id": "resultados_distintos", "periodo": "periodos_distintos", "modalidade_id": "modalidades_distintas"}
    counted = distinct_counts(related, ("orgao_id", "fornecedor_id", "categoria_tecnologia"), distinct)
    return published(counted, "aresta_descritiva_nao_indica_irregularidade", masked_total=True)


def price_distribution(items: DataFrame, awards: DataFrame, procurements: DataFrame, exact: bool = False) -> DataFrame:
    """Unit prices of materials by period, category and unit. ``exact`` takes discrete percentiles
    of all values instead of the sketch, which is exact up to 10,000 values a group."""
    price = F.col("valor_unitario_homologado")
    base = (
        awards.where(~F.col("cancelado") & (price > 0))
        .select("resultado_id", "item_id", "valor_unitario_homologado")
        .join(items.where((F.col("material_ou_servico") == "M") & (F.col("categoria_tecnologia") != UNKNOWN) & F.col("unidade_medida").isNotNull()).select("item_id", "contratacao_id", "categoria_tecnologia", "unidade_medida"), "item_id")
        .join(procurements.select("contratacao_id", period("publicado_em").alias("periodo")).where(F.col("periodo").isNotNull()), "contratacao_id")
    )
    at = (lambda p: F.expr(f"percentile_disc({p}) within group (order by valor_unitario_homologado)")) if exact else (lambda p: F.percentile_approx("valor_unitario_homologado", p, 10000))
    counted = base.groupBy("periodo", "categoria_tecnologia", "unidade_medida").agg(F.count_distinct("resultado_id").alias("observacoes"), at(0.1).alias("p10"), at(0.5).alias("mediana"), at(0.9).alias("p90"), F.min(price).alias("minimo"), F.max(price).alias("maximo"))
    return counted.withColumns({"comparabilidade_avaliada": F.lit(False), "status_publicacao": F.lit("nao_publicavel"), "limitacao": F.lit("comparabilidade_desabilitada_sem_especificacao_produto")})


def contract_evolution(contracts: DataFrame, events: DataFrame) -> DataFrame:
    day = lambda c: F.to_date(F.try_to_timestamp(F.col(c).cast("string")))
    summary = events.groupBy("contrato_id").agg(
        F.count_distinct("evento_contrato_id").alias("eventos_distintos"), F.count_distinct("tipo_evento").alias("tipos_evento_distintos"), F.min(day("data_assinatura")).alias("primeiro_evento_em"), F.max(day("data_assinatura")).alias("ultimo_evento_em"),
        F.max(day("vigencia_fim")).alias("vigencia_fim_eventos"), F.sum(F.coalesce("variacao_valor", F.lit(0))).alias("variacao_valor_acumulada"),
    )
    own = contracts.select("contrato_id", "orgao_codigo", "fornecedor_id", day("vigencia_inicio").alias("vigencia_inicio"), day("vigencia_fim").alias("vigencia_fim_original"), "valor_inicial", "valor_global")
    joined = own.join(summary, "contrato_id", "left").fillna({"eventos_distintos": 0, "tipos_evento_distintos": 0, "variacao_valor_acumulada": 0})
    joined = joined.withColumn("vigencia_fim_atual", F.greatest("vigencia_fim_original", "vigencia_fim_eventos"))
    extension = F.when(F.col("vigencia_fim_original").isNotNull(), F.greatest(F.datediff("vigencia_fim_atual", "vigencia_fim_original"), F.lit(0)))
    return published(joined.withColumn("extensao_vigencia_dias", extension), "fonte_comprasnet_com_vinculo_pncp_nativo_parcial_c3")
