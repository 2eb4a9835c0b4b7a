"""The supplied tables in the shape of the procurement domain.

The statements are written in the part of SQL that Spark and DuckDB read alike, so a query and the
SQL that it is compared with begin from the same rows. Values are doubles here, so that ratios are
doubles on both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages")

SQL = {
    "procurements": "select cast(o_orderkey as string) as contratacao_id, o_orderdate as publicado_em, substr(o_orderpriority, 1, 1) as modalidade_id, o_orderpriority as modalidade, o_totalprice as valor_total_estimado from {orders}",
    "links": "select cast(o_orderkey as string) as contratacao_id, cast(c_nationkey as string) as orgao_id, cast(c_custkey as string) as unidade_id from {orders} join {customer} on o_custkey = c_custkey",
    "region_links": "select cast(o_orderkey as string) as contratacao_id, r_name as orgao_id, cast(c_custkey as string) as unidade_id from {orders} join {customer} on o_custkey = c_custkey join {nation} on c_nationkey = n_nationkey join {region} on n_regionkey = r_regionkey",
    "agencies": "select cast(n_nationkey as string) as orgao_id, n_name as nome_orgao from {nation}",
    "units": "select cast(c_custkey as string) as unidade_id, n_name as uf, c_mktsegment as municipio from {customer} join {nation} on c_nationkey = n_nationkey",
    "items": "select concat(cast(l_orderkey as string), '-', cast(l_linenumber as string)) as item_id, cast(l_orderkey as string) as contratacao_id, min(case when p_type = 'ECONOMY' then 'incerto' else p_type end) as categoria_tecnologia, nullif(min(p_brand), 'Brand#11') as unidade_medida, min(case when p_size % 2 = 0 then 'M' else 'S' end) as material_ou_servico, max(l_quantity) as quantidade, nullif(max(p_size), 7) as _size, max(case when p_size > 10 then p_retailprice end) as valor_unitario_estimado, max(l_extendedprice) as valor_total from {lineitem} join {part} on l_partkey = p_partkey group by l_orderkey, l_linenumber",
    "awards": "select concat(cast(l_orderkey as string), '-', cast(l_linenumber as string), '-', cast(l_suppkey as string), '-', cast(l_partkey as string)) as resultado_id, concat(cast(l_orderkey as string), '-', cast(l_linenumber as string)) as item_id, case when l_suppkey % 17 = 3 then null else cast(l_suppkey as string) end as fornecedor_id, l_quantity as quantidade_homologada, case when l_partkey % 10 = 0 then l_extendedprice else floor(l_extendedprice / l_quantity * 100) / 100 end as valor_unitario_homologado, l_extendedprice as valor_total_homologado, case l_returnflag when 'R' then true when 'A' then false end as cancelado, l_shipdate as enviado_em, l_linestatus as situacao from {lineitem}",
    "suppliers": "select cast(s_suppkey as string) as fornecedor_id, concat('000000', cast(s_suppkey + 10000000 as string)) as identificador_publico, s_name as nome_fornecedor, case when s_nationkey % 3 = 0 then 'PF' else 'PJ' end as tipo_pessoa from {supplier}",
    "contracts": "select cast(o_orderkey as string) as contrato_id, cast(o_custkey as string) as orgao_codigo, cast(o_custkey % 50 as string) as fornecedor_id, substr(cast(o_orderdate as string), 1, 10) as vigencia_inicio, case when o_orderkey % 9 = 0 then null else substr(cast(o_orderdate as string), 1, 10) end as vigencia_fim, o_totalprice as valor_inicial, o_totalprice as valor_global from {orders}",
    "contract_events": "select concat(cast(l_orderkey as string), '-', cast(l_linenumber as string), '-', cast(l_partkey as string)) as evento_contrato_id, cast(l_orderkey as string) as contrato_id, l_linestatus as tipo_evento, substr(cast(l_shipdate as string), 1, 10) as data_assinatura, substr(cast(l_shipdate as string), 1, 10) as vigencia_fim, case when l_linenumber = 2 then null else -floor(l_extendedprice) end as variacao_valor from {lineitem}",
    "quality_history": "select event_type as regra, cast(event_id as string) as run_id, cast(user_id as bigint) as observados, cast(user_id + event_id as bigint) as total, value as percentual, 'alerta' as severidade, case when value > 50 then 'ALERT' else 'PASS' end as status, cast(ts as string) as registrado_em from {events}",
    "versions": "select concat(cast(l_orderkey as string), '-', cast(l_linenumber as string)) as entidade, substr(cast(l_shipdate as string), 1, 7) as atualizado_em, cast(l_partkey as string) as source_file_id, concat_ws('|', cast(l_partkey as string), cast(l_suppkey as string), l_returnflag, l_linestatus) as conteudo from {lineitem}",
}


def tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of the domain."""
    text = SQL[name]
    used = {t: df for t in TABLES if "{" + t + "}" in text for df in [spark.read.parquet(f"{sf_dir}/{t}.parquet")]}
    return spark.sql(text, **used)


def ctes(*names: str) -> str:
    """The same tables as common table expressions over views of the supplied tables."""
    return ", ".join(f"{n} as ({SQL[n].format(**{t: t for t in TABLES})})" for n in names)
