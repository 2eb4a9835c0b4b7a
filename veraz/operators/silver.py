"""Typed, keyed and versioned entities from raw string tables.

Every operator projects the raw columns once, tags rows that can't be used with the first reason
that holds (quarantine), and splits the rest into current rows and conflicting versions. Malformed
numbers and moments become null and so reach quarantine instead of failing the job.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veraz.functions.expr import blank, decimal, digits, embedded_timestamp, first_reason, hmac_sha256, key, optional, strict_key, text, timestamp
from veraz.operators.classify import equipment, services
from veraz.operators.versioning import latest, split_versions, with_content_hash

# The ordered fields of each canonical hash.
HASHED = {
    "contratacao_v1": ("numero_controle_pncp", "cnpj_orgao", "objeto", "valor_total_estimado", "publicado_em", "modalidade_id", "modalidade", "atualizado_em", "ind_atual", "contratacao_excluida"),
    "item_v1": ("numero_controle_pncp", "numero_item", "descricao", "material_ou_servico", "quantidade", "unidade_medida", "valor_unitario_estimado", "valor_total", "elegivel_preco", "motivo_ineligibilidade_preco", "atualizado_em"),
    "resultado_v1": ("item_id", "sequencial_resultado", "fornecedor_id", "quantidade_homologada", "valor_unitario_homologado", "valor_total_homologado", "cancelado_em", "motivo_cancelamento", "situacao_resultado", "cancelado", "atualizado_em"),
    "contrato_snapshot_v1": ("numero_contrato", "orgao_codigo", "unidade_codigo", "fornecedor_id", "processo", "objeto", "data_assinatura", "data_publicacao", "vigencia_inicio", "vigencia_fim", "valor_inicial", "valor_global", "valor_acumulado", "situacao_contrato"),
    "contrato_item_snapshot_v1": ("contrato_id", "material_ou_servico", "descricao", "grupo_origem", "quantidade", "valor_unitario", "valor_total", "numero_item_compra", "data_inicio_item"),
    "evento_contrato_snapshot_v1": ("contrato_id", "tipo_evento", "qualificacao_termo", "observacao", "data_assinatura", "data_publicacao", "vigencia_inicio", "vigencia_fim", "valor_inicial", "valor_global", "novo_valor_global", "variacao_valor", "situacao_contrato", "situacao_termo"),
}
REASON = "motivo_quarentena"
#: Columns that identify natural persons and never leave an operator.
SENSITIVE = ("identificador_normalizado", "chave_fornecedor")


class Split(NamedTuple):
    """What an operator makes of its input."""

    current: DataFrame
    quarantine: DataFrame
    conflicts: DataFrame


class WithSuppliers(NamedTuple):
    current: DataFrame
    suppliers: DataFrame
    quarantine: DataFrame
    conflicts: DataFrame


def _split(typed: DataFrame, entity: str, version: str, order: Sequence[str] = ("atualizado_em", "source_file_id")) -> Split:
    valid = with_content_hash(typed.where(F.col(REASON).isNull()).drop(REASON), HASHED[version], version)
    current, conflicts = split_versions(valid, entity, order=order)
    return Split(current, typed.where(F.col(REASON).isNotNull()), conflicts)


def procurement_key(control: Column) -> Column:
    return strict_key("pncp|", F.lower(control))


def type_procurements(raw: DataFrame) -> DataFrame:
    control, origin, system = text(raw, "numero_controle_PNCP"), text(raw, "id_compra"), optional(raw, "_sistema_origem")
    natural = F.when(~blank(control), F.concat(F.lit("pncp|"), F.lower(control))).otherwise(F.concat(F.lower(system), F.lit("|"), origin))
    typed = raw.select(
        origin.alias("id_origem"), control.alias("numero_controle_pncp"), text(raw, "orgao_entidade_cnpj").alias("cnpj_orgao"), text(raw, "objeto_compra").alias("objeto"),
        decimal(raw, "valor_total_estimado", 2).alias("valor_total_estimado"), timestamp(optional(raw, "data_publicacao_pncp")).alias("publicado_em"),
        text(raw, "modalidade_id_pncp").alias("modalidade_id"), text(raw, "modalidade_nome").alias("modalidade"), timestamp(optional(raw, "data_atualizacao_pncp")).alias("atualizado_em"),
        optional(raw, "ind_atual").try_cast("boolean").alias("ind_atual"), optional(raw, "contratacao_excluida").try_cast("boolean").alias("contratacao_excluida"),
        system.alias("sistema_origem"), optional(raw, "_source_file_id").alias("source_file_id"), optional(raw, "_run_id").alias("run_id"), timestamp(optional(raw, "_coletado_em_utc")).alias("coletado_em_utc"),
        natural.alias("chave_natural"), F.sha2(natural, 256).alias("contratacao_id"),
    )
    return typed.withColumn(REASON, first_reason([
        ("cnpj_orgao_ausente", blank(F.col("cnpj_orgao"))),
        ("id_origem_ausente", blank(F.col("id_origem"))),
        ("data_atualizacao_invalida", F.col("atualizado_em").isNull()),
        ("valor_total_negativo", F.col("valor_total_estimado") < 0),
    ]))


def procurements(raw: DataFrame, drop_deleted: bool = False) -> Split:
    """Procurements. ``drop_deleted`` leaves out rows marked as deleted, which are kept by default."""
    typed = type_procurements(raw)
    if drop_deleted:
        typed = typed.where(~F.coalesce("contratacao_excluida", F.lit(False)))
    return _split(typed, "contratacao_id", "contratacao_v1", ("atualizado_em", "coletado_em_utc", "source_file_id"))


def type_items(raw: DataFrame) -> DataFrame:
    control = text(raw, "numero_controle_PNCP_compra")
    typed = raw.select(
        text(raw, "id_compra_item").alias("id_origem_item"), control.alias("numero_controle_pncp"), text(raw, "numero_item_pncp").alias("numero_item"),
        F.concat_ws(" ", text(raw, "descricao_resumida"), text(raw, "descricao_detalhada")).alias("descricao"), text(raw, "material_ou_servico").alias("material_ou_servico"),
        decimal(raw, "quantidade", 6).alias("quantidade"), text(raw, "unidade_medida").alias("unidade_medida"), decimal(raw, "valor_unitario_estimado", 4).alias("valor_unitario_estimado"),
        decimal(raw, "valor_total", 2).alias("valor_total"), timestamp(optional(raw, "data_atualizacao_pncp")).alias("atualizado_em"), optional(raw, "_source_file_id").alias("source_file_id"),
        text(raw, "situacao_compra_item_nome").alias("situacao_item"), procurement_key(control).alias("contratacao_id"), key(procurement_key(control), text(raw, "numero_item_pncp")).alias("item_id"),
    )
    price = first_reason([
        ("quantidade_nao_positiva", F.col("quantidade").isNull() | (F.col("quantidade") <= 0)),
        ("unidade_ausente", blank(F.col("unidade_medida"))),
        ("valor_unitario_negativo", F.col("valor_unitario_estimado") < 0),
        ("valor_total_negativo", F.col("valor_total") < 0),
    ])
    return typed.withColumn("motivo_ineligibilidade_preco", price).withColumns({
        "elegivel_preco": F.col("motivo_ineligibilidade_preco").isNull(),
        REASON: first_reason([("contratacao_ausente", F.col("numero_controle_pncp").isNull()), ("numero_item_ausente", F.col("numero_item").isNull()), ("data_atualizacao_invalida", F.col("atualizado_em").isNull())]),
    })


def items(raw: DataFrame) -> Split:
    """Procurement items. Items without a usable price stay; they are marked."""
    return split_items(type_items(raw))


def split_items(typed: DataFrame) -> Split:
    return _split(typed, "item_id", "item_v1")


def supplier_identity(df: DataFrame, secret: str) -> DataFrame:
    """Adds chave_fornecedor, fornecedor_id and identificador_publico from tipo_pessoa, pais and
    identificador_normalizado. Companies get a plain hash and keep their public number; natural
    persons and unknown kinds get a keyed hash and no public number."""
    company = F.col("tipo_pessoa") == "PJ"
    named = df.withColumn("chave_fornecedor", F.concat_ws("|", "tipo_pessoa", "pais", "identificador_normalizado"))
    return named.withColumns({
        "fornecedor_id": F.when(company, F.sha2("chave_fornecedor", 256)).otherwise(hmac_sha256(F.col("chave_fornecedor"), secret)),
        "identificador_publico": F.when(company, F.col("identificador_normalizado")),
    })


def suppliers_of(rows: DataFrame) -> DataFrame:
    return latest(rows.select("fornecedor_id", "tipo_pessoa", "pais", "identificador_publico", "nome_fornecedor", "atualizado_em", "source_file_id"), "fornecedor_id", ("atualizado_em", "source_file_id")).drop("atualizado_em", "source_file_id")


def cancelled(moment: Column, status: Column) -> Column:
    """Three-valued: null when there is neither a moment of cancellation nor a status."""
    return moment.isNotNull() | F.contains(F.lower(status), F.lit("cancel"))


def type_awards(raw: DataFrame, secret: str) -> DataFrame:
    control = text(raw, "numero_controle_PNCP_compra")
    item = key(procurement_key(control), text(raw, "numero_item_pncp"))
    typed = raw.select(
        text(raw, "srk_item_resultado").alias("id_origem_resultado"), text(raw, "id_compra_item").alias("id_origem_item"), control.alias("numero_controle_pncp"), text(raw, "numero_item_pncp").alias("numero_item"),
        text(raw, "sequencial_resultado").alias("sequencial_resultado"), text(raw, "tipo_pessoa").alias("tipo_pessoa"), text(raw, "codigo_pais").alias("pais"),
        digits(optional(raw, "ni_fornecedor")).alias("identificador_normalizado"), text(raw, "nome_razao_social_fornecedor").alias("nome_fornecedor"),
        decimal(raw, "quantidade_homologada", 6).alias("quantidade_homologada"), decimal(raw, "valor_unitario_homologado", 4).alias("valor_unitario_homologado"), decimal(raw, "valor_total_homologado", 2).alias("valor_total_homologado"),
        timestamp(optional(raw, "data_cancelamento_pncp")).alias("cancelado_em"), text(raw, "motivo_cancelamento").alias("motivo_cancelamento"), text(raw, "situacao_compra_item_resultado_nome").alias("situacao_resultado"),
        timestamp(optional(raw, "data_atualizacao_pncp")).alias("atualizado_em"), optional(raw, "_source_file_id").alias("source_file_id"), item.alias("item_id"), key(item, text(raw, "sequencial_resultado")).alias("resultado_id"),
    )
    typed = supplier_identity(typed.withColumn("cancelado", cancelled(F.col("cancelado_em"), F.col("situacao_resultado"))), secret)
    return typed.withColumn(REASON, first_reason([
        ("item_ausente", F.col("item_id").isNull()),
        ("fornecedor_ausente", blank(F.col("identificador_normalizado"))),
        ("quantidade_negativa", F.col("quantidade_homologada") < 0),
        ("valor_unitario_negativo", F.col("valor_unitario_homologado") < 0),
        ("valor_total_negativo", F.col("valor_total_homologado") < 0),
        ("data_atualizacao_invalida", F.col("atualizado_em").isNull()),
    ]))


def _public(split: Split, hidden: tuple[str, ...] = SENSITIVE) -> WithSuppliers:
    own = (*hidden, "nome_fornecedor", "identificador_publico")
    return WithSuppliers(split.current.drop(*own), suppliers_of(split.current), split.quarantine.drop(*own), split.conflicts.drop(*own))


def awards(raw: DataFrame, secret: str) -> WithSuppliers:
    """Awards of items to suppliers, and the suppliers. Ids of awards without a control or item
    number are still hashes, as null parts of a key are skipped."""
    return _public(_split(type_awards(raw, secret), "resultado_id", "resultado_v1"))


def agencies_and_units(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The latest row of every buying agency and of every purchasing unit; rows without keys are left out."""
    cnpj, unit = text(raw, "orgao_entidade_cnpj"), text(raw, "unidade_orgao_codigo_unidade")
    rows = raw.select(
        cnpj.alias("cnpj_orgao"), text(raw, "orgao_entidade_razao_social").alias("nome_orgao"), text(raw, "orgao_entidade_esfera_id").alias("esfera"), text(raw, "orgao_entidade_poder_id").alias("poder"),
        unit.alias("codigo_unidade"), text(raw, "unidade_orgao_nome_unidade").alias("nome_unidade"), text(raw, "unidade_orgao_uf_sigla").alias("uf"), text(raw, "unidade_orgao_municipio_nome").alias("municipio"), text(raw, "unidade_orgao_codigo_ibge").alias("codigo_ibge"),
        timestamp(optional(raw, "data_atualizacao_pncp")).alias("atualizado_em"), optional(raw, "_source_file_id").alias("source_file_id"),
    ).where(~blank(F.col("cnpj_orgao")))
    order = ("atualizado_em", "source_file_id")
    agencies = rows.select(strict_key("orgao|", F.col("cnpj_orgao")).alias("orgao_id"), "cnpj_orgao", "nome_orgao", "esfera", "poder", *order)
    units = rows.where(~blank(F.col("codigo_unidade"))).select(key(F.col("cnpj_orgao"), F.col("codigo_unidade")).alias("unidade_id"), strict_key("orgao|", F.col("cnpj_orgao")).alias("orgao_id"), "codigo_unidade", "nome_unidade", "uf", "municipio", "codigo_ibge", *order)
    return latest(agencies, "orgao_id", order), latest(units, "unidade_id", order)


def procurement_links(raw: DataFrame) -> DataFrame:
    """The latest agency and unit of each procurement; rows without all three keys are left out."""
    control, cnpj, unit = text(raw, "numero_controle_PNCP"), text(raw, "orgao_entidade_cnpj"), text(raw, "unidade_orgao_codigo_unidade")
    rows = raw.where(~blank(control) & ~blank(cnpj) & ~blank(unit)).select(
        procurement_key(control).alias("contratacao_id"), strict_key("orgao|", cnpj).alias("orgao_id"), key(cnpj, unit).alias("unidade_id"), timestamp(optional(raw, "data_atualizacao_pncp")).alias("atualizado_em"), optional(raw, "_source_file_id").alias("source_file_id")
    )
    return latest(rows, "contratacao_id", ("atualizado_em", "source_file_id"))


def _date(raw: DataFrame, name: str) -> Column:
    return F.to_date(timestamp(optional(raw, name)))


def _observed(raw: DataFrame, *first: Column) -> Column:
    return F.coalesce(*first, timestamp(optional(raw, "_data_publicacao_arquivo")), timestamp(optional(raw, "_coletado_em_utc")))


CONTRACTS = "comprasnet_contratos|"


def type_contracts(raw: DataFrame, secret: str) -> DataFrame:
    kind = F.lower(optional(raw, "fornecedor_tipo"))
    typed = raw.select(
        text(raw, "id").alias("id_origem_contrato"), text(raw, "numero").alias("numero_contrato"), *(text(raw, c).alias(c) for c in ("orgao_codigo", "orgao_nome", "unidade_codigo", "unidade_nome")),
        F.when(F.contains(kind, F.lit("fisica")), "PF").when(F.contains(kind, F.lit("juridica")), "PJ").otherwise("DESCONHECIDO").alias("tipo_pessoa"), F.lit("BRA").alias("pais"),
        digits(optional(raw, "fonecedor_cnpj_cpf_idgener")).alias("identificador_normalizado"), text(raw, "fornecedor_nome").alias("nome_fornecedor"), text(raw, "processo").alias("processo"), text(raw, "objeto").alias("objeto"),
        text(raw, "tipo").alias("tipo_contrato"), text(raw, "categoria").alias("categoria_contrato"), text(raw, "modalidade").alias("modalidade"),
        *(_date(raw, c).alias(c) for c in ("data_assinatura", "data_publicacao", "vigencia_inicio", "vigencia_fim")), *(decimal(raw, c, 2).alias(c) for c in ("valor_inicial", "valor_global", "valor_acumulado")),
        text(raw, "situacao").alias("situacao_contrato"), _observed(raw).alias("atualizado_em"), optional(raw, "_source_file_id").alias("source_file_id"), strict_key(CONTRACTS, text(raw, "id")).alias("contrato_id"),
    )
    return supplier_identity(typed, secret).withColumn(REASON, first_reason([
        ("id_contrato_ausente", blank(F.col("id_origem_contrato"))),
        ("fornecedor_ausente", blank(F.col("identificador_normalizado"))),
        ("valor_global_negativo", F.col("valor_global") < 0),
        ("valor_inicial_negativo", F.col("valor_inicial") < 0),
        ("vigencia_incoerente", F.col("vigencia_fim") < F.col("vigencia_inicio")),
        ("observacao_invalida", F.col("atualizado_em").isNull()),
    ]))


def contracts(raw: DataFrame, secret: str) -> WithSuppliers:
    return _public(_split(type_contracts(raw, secret), "contrato_id", "contrato_snapshot_v1"))


def type_contract_items(raw: DataFrame) -> DataFrame:
    kind = F.lower(optional(raw, "tipo_id"))
    typed = raw.select(
        text(raw, "id").alias("id_origem_item_contrato"), text(raw, "contrato_id").alias("id_origem_contrato"),
        F.when(F.contains(kind, F.lit("servi")), "S").when(F.contains(kind, F.lit("material")), "M").alias("material_ou_servico"), F.concat_ws(" ", text(raw, "catmatseritem_id"), text(raw, "descricao_complementar")).alias("descricao"),
        text(raw, "grupo_id").alias("grupo_origem"), decimal(raw, "quantidade", 6).alias("quantidade"), decimal(raw, "valorunitario", 4).alias("valor_unitario"), decimal(raw, "valortotal", 2).alias("valor_total"),
        text(raw, "numero_item_compra").alias("numero_item_compra"), embedded_timestamp(optional(raw, "data_inicio_item")).alias("data_inicio_item"), _observed(raw).alias("atualizado_em"), optional(raw, "_source_file_id").alias("source_file_id"),
        strict_key(CONTRACTS, text(raw, "contrato_id")).alias("contrato_id"), strict_key(f"{CONTRACTS}item|", text(raw, "id")).alias("contrato_item_id"),
    )
    price = first_reason([("quantidade_nao_positiva", F.col("quantidade").isNull() | (F.col("quantidade") <= 0)), ("valor_unitario_ausente", F.col("valor_unitario").isNull()), ("valor_total_ausente", F.col("valor_total").isNull())])
    return typed.withColumn("motivo_ineligibilidade_preco", price).withColumns({
        "elegivel_preco": F.col("motivo_ineligibilidade_preco").isNull(),
        REASON: first_reason([
            ("id_item_ausente", blank(F.col("id_origem_item_contrato"))), ("contrato_ausente", blank(F.col("id_origem_contrato"))), ("valor_unitario_negativo", F.col("valor_unitario") < 0),
            ("valor_total_negativo", F.col("valor_total") < 0), ("observacao_invalida", F.col("atualizado_em").isNull()),
        ]),
    })


def contract_items(raw: DataFrame) -> Split:
    """Contract items, classified; versions are compared before classification."""
    split = _split(type_contract_items(raw), "contrato_item_id", "contrato_item_snapshot_v1")
    return Split(services(equipment(split.current)), split.quarantine, split.conflicts)


def type_contract_events(raw: DataFrame) -> DataFrame:
    typed = raw.select(
        text(raw, "id").alias("id_origem_evento"), text(raw, "contrato_id").alias("id_origem_contrato"), text(raw, "tipo").alias("tipo_evento"), *(text(raw, c).alias(c) for c in ("qualificacao_termo", "observacao", "situacao_contrato", "situacao_termo")),
        *(_date(raw, c).alias(c) for c in ("data_assinatura", "data_publicacao", "vigencia_inicio", "vigencia_fim")), *(decimal(raw, c, 2).alias(c) for c in ("valor_inicial", "valor_global", "novo_valor_global")),
        _observed(raw, embedded_timestamp(optional(raw, "alterado_em")), embedded_timestamp(optional(raw, "criado_em"))).alias("atualizado_em"), optional(raw, "_source_file_id").alias("source_file_id"),
        strict_key(CONTRACTS, text(raw, "contrato_id")).alias("contrato_id"), strict_key(f"{CONTRACTS}evento|", text(raw, "id")).alias("evento_contrato_id"),
    )
    return typed.withColumns({
        "variacao_valor": F.col("novo_valor_global") - F.col("valor_global"),
        REASON: first_reason([
            ("id_evento_ausente", blank(F.col("id_origem_evento"))), ("contrato_ausente", blank(F.col("id_origem_contrato"))), ("valor_global_negativo", F.col("valor_global") < 0),
            ("novo_valor_global_negativo", F.col("novo_valor_global") < 0), ("data_evento_invalida", F.col("atualizado_em").isNull()),
        ]),
    })


def contract_events(raw: DataFrame) -> Split:
    return _split(type_contract_events(raw), "evento_contrato_id", "evento_contrato_snapshot_v1")


class Population(NamedTuple):
    contracts: DataFrame
    items: DataFrame
    events: DataFrame
    suppliers: DataFrame


def technology_population(contracts: DataFrame, items: DataFrame, events: DataFrame, suppliers: DataFrame) -> Population:
    """Contracts with a classified item, and the items, events and suppliers that belong to them."""
    wanted = items.where(F.col("categoria_tecnologia") != "incerto")
    kept = contracts.join(wanted.select("contrato_id"), "contrato_id", "left_semi")
    ids = kept.select("contrato_id")
    return Population(kept, wanted.join(ids, "contrato_id", "left_semi"), events.join(ids, "contrato_id", "left_semi"), suppliers.join(kept.select("fornecedor_id"), "fornecedor_id", "left_semi"))


def close_over(rows: DataFrame, parents: DataFrame, keys: str, reason: str) -> tuple[DataFrame, DataFrame]:
    """(rows with a parent, orphans tagged with the reason)."""
    ids = parents.select(keys)
    return rows.join(ids, keys, "left_semi"), rows.join(ids, keys, "left_anti").withColumn(REASON, F.lit(reason))


def problem_log(problems: Sequence[tuple[str, DataFrame, str]], run_id: str) -> DataFrame:
    """One table of all problem rows: (entity name, rows, key column) several times over. Columns are
    united by name; the id of a problem is the same in every run that meets it again."""
    out = None
    for entity, rows, id_col in problems:
        ident = key(F.lit(entity), optional(rows, "source_file_id"), F.col(id_col), optional(rows, REASON), optional(rows, "hash_conteudo"))
        own = rows.withColumns({"entidade": F.lit(entity), "run_id": F.lit(run_id), "registro_problema_id": ident})
        out = own if out is None else out.unionByName(own, allowMissingColumns=True)
    if out is None:
        raise ValueError("no problem tables")
    return out
