"""The registered queries over whole tables, each with the SQL that it must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veraz.functions import expr
from veraz.operators import bitmaps, classify, context, gold, quality, quantiles, silver, validation, versioning
from veraz.plans import benchmark, domain
from veraz.sources import files
from veraz.sources import tables as changes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
SECRET = "segredo-de-teste"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _v(spark: SparkSession, sf: str, *names: str) -> list[DataFrame]:
    return [domain.view(spark, sf, n) for n in names]


def _rounded(df: DataFrame, **places: int) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), p) for c, p in places.items()})


def _day(c: str) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


# --- scans, projections, filters ---


@query("select l_orderkey, l_linenumber, cast(l_quantity as double) as quantidade, strftime(l_shipdate, '%Y-%m-%d') as enviado from lineitem")
def scan_parquet(spark, sf):
    return _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("quantidade"), _day("l_shipdate").alias("enviado"))


@query("select cast(l_orderkey as bigint) as chave, 'lineitem' as _dataset_origem from lineitem union all select o_orderkey, 'orders' from orders")
def scan_union_provenance(spark, sf):
    return files.union_with_origin({t: _t(spark, sf, t).select(F.col(k).alias("chave")) for t, k in (("lineitem", "l_orderkey"), ("orders", "o_orderkey"))})


@query("select cast(event_id as bigint) as event_id, cast(regexp_extract(props, '([0-9]+)', 1) as bigint) as k from events")
def scan_json_props(spark, sf):
    return _t(spark, sf, "events").select("event_id", F.from_json("props", "k long").getField("k").alias("k"))


@query("select trim(c_name) as nome, cast(c_acctbal as decimal(18,2))::double as saldo, lower(c_mktsegment) as segmento from customer")
def proj_typed(spark, sf):
    return _t(spark, sf, "customer").select(F.trim("c_name").alias("nome"), F.col("c_acctbal").cast("decimal(18,2)").cast("double").alias("saldo"), F.lower("c_mktsegment").alias("segmento"))


@query("select s_suppkey, s_name, cast(null as varchar) as s_phone from supplier")
def proj_missing_col(spark, sf):
    df = _t(spark, sf, "supplier")
    return df.select("s_suppkey", expr.optional(df, "s_name").alias("s_name"), expr.optional(df, "s_phone").alias("s_phone"))


@query("select p_partkey, nullif(p_brand, 'Brand#11') as marca from part where nullif(p_brand, 'Brand#11') is not null and p_name <> ''")
def filter_nonblank(spark, sf):
    return _t(spark, sf, "part").select("p_partkey", "p_name", F.nullif(F.col("p_brand"), F.lit("Brand#11")).alias("marca")).where(~expr.blank(F.col("marca")) & ~expr.blank(F.col("p_name"))).drop("p_name")


@query("select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as dia from orders where cast(o_orderdate as date) between date '1995-01-01' and date '1996-12-31'")
def filter_date_window(spark, sf):
    return files.within_days(_t(spark, sf, "orders"), "o_orderdate", "1995-01-01", "1996-12-31").select("o_orderkey", _day("o_orderdate").alias("dia"))


@query("select s_suppkey, regexp_replace(concat('10.', cast(s_suppkey + 100000 as varchar), '-x'), '[^0-9]', '', 'g') as raiz from supplier where length(regexp_replace(concat('10.', cast(s_suppkey + 100000 as varchar), '-x'), '[^0-9]', '', 'g')) = 8")
def filter_digits_len(spark, sf):
    df = _t(spark, sf, "supplier").select("s_suppkey", F.concat(F.lit("10."), (F.col("s_suppkey") + 100000).cast("string"), F.lit("-x")).alias("raiz"))
    return context.with_digits(df, "raiz", 8)


@query("select page_id, url from pages where regexp_matches(url, '[0-9]{2}')")
def filter_rlike(spark, sf):
    return _t(spark, sf, "pages").select("page_id", "url").where(F.col("url").rlike("[0-9]{2}"))


@query("select p_partkey, p_name from part where p_name like '%red%'")
def filter_like(spark, sf):
    return _t(spark, sf, "part").select("p_partkey", "p_name").where("p_name like '%red%'")


@query(f"with {domain.ctes('awards')} select resultado_id, cancelado from awards where not cancelado")
def filter_not_cancelled_3vl(spark, sf):
    return _v(spark, sf, "awards")[0].where(~F.col("cancelado")).select("resultado_id", "cancelado")


@query("select cast(event_id as bigint) as event_id, event_type, 'k' as chave, cast(regexp_extract(props, '([0-9]+)', 1) as bigint) + 1 as seguinte from events")
def json_nested_fields(spark, sf):
    nested = _t(spark, sf, "events").select("event_id", F.struct("event_type", F.struct(F.from_json("props", "k long").alias("p")).alias("b")).alias("a"))
    return nested.select("event_id", F.col("a.event_type").alias("event_type"), F.lit("k").alias("chave"), (F.col("a.b.p.k") + 1).alias("seguinte"))


@query("select distinct cast(regexp_extract(props, '([0-9]+)', 1) as bigint) as k from events")
def json_key_extract(spark, sf):
    return files.json_keys(_t(spark, sf, "events"), "props", "$.k", "bigint").withColumnRenamed("chave", "k")


@query("select distinct regexp_extract(c, '^([0-9]{14})-[0-9]+-([0-9]+)/([0-9]{4})$', 1) as cnpj, cast(regexp_extract(c, '^([0-9]{14})-[0-9]+-([0-9]+)/([0-9]{4})$', 2) as bigint) as sequencial, cast(regexp_extract(c, '^([0-9]{14})-[0-9]+-([0-9]+)/([0-9]{4})$', 3) as int) as ano from (select concat('1000', cast(o_custkey + 1000000000 as varchar), '-1-', cast(o_orderkey as varchar), '/', strftime(o_orderdate, '%Y')) as c from orders)")
def regex_key_parse(spark, sf):
    df = _t(spark, sf, "orders").select(F.concat(F.lit("1000"), (F.col("o_custkey") + 1000000000).cast("string"), F.lit("-1-"), F.col("o_orderkey").cast("string"), F.lit("/"), F.date_format("o_orderdate", "yyyy")).alias("c"))
    return files.parse_control(df, "c").select("cnpj", "sequencial", "ano").distinct()


@query("select page_id, sha256(html) as hash_calculado, sha256(html) = sha256(case when page_id % 7 = 0 then concat(html, ' ') else html end) as integro from pages")
def payload_hash_check(spark, sf):
    pages = _t(spark, sf, "pages")
    named = F.sha2(F.when(F.col("page_id") % 7 == 0, F.concat("html", F.lit(" "))).otherwise(F.col("html")), 256)
    return files.hashed_payloads(pages.select("page_id", "html", named.alias("hash_payload")), "html", "hash_payload").select("page_id", "hash_calculado", "integro")


@query("select cast(event_id as bigint) as event_id, strftime(ts, '%Y-%m-%d') as dia from events")
def parse_embedded_ts(spark, sf):
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    written = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("{'date': '"), stamp, F.lit("', 'timezone': 'UTC'}"))).otherwise(stamp)
    return _t(spark, sf, "events").select("event_id", _day(expr.embedded_timestamp(written)).alias("dia"))


# --- joins, sets, order ---

RELATED = """related as (select distinct a.resultado_id, a.item_id, p.contratacao_id, l.orgao_id, l.unidade_id, a.fornecedor_id, i.categoria_tecnologia, p.modalidade_id, p.modalidade,
  cast(p.publicado_em as date) as data_publicacao, strftime(p.publicado_em, '%Y-%m') as periodo
  from awards a join items i using (item_id) join procurements p on p.contratacao_id = i.contratacao_id join links l on l.contratacao_id = p.contratacao_id
  where not a.cancelado and a.fornecedor_id is not null and l.orgao_id is not null and i.categoria_tecnologia <> 'incerto' and p.publicado_em is not null)"""
STAR = f"with {domain.ctes('awards', 'items', 'procurements', 'links', 'units')}, {RELATED}"


@query(f"with {domain.ctes('awards', 'items', 'procurements')} select a.resultado_id, i.item_id, p.modalidade, i.categoria_tecnologia from awards a join items i on a.item_id = i.item_id join procurements p on p.contratacao_id = i.contratacao_id")
def join_inner_star(spark, sf):
    awards, items, procurements = _v(spark, sf, "awards", "items", "procurements")
    return awards.join(items, "item_id").join(procurements, "contratacao_id").select("resultado_id", "item_id", "modalidade", "categoria_tecnologia")


@query("select c_custkey, count(o_orderkey) as pedidos from customer left join orders on o_custkey = c_custkey group by c_custkey")
def join_left_coverage(spark, sf):
    per = _t(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("pedidos"))
    return _t(spark, sf, "customer").select("c_custkey").join(per, "c_custkey", "left").withColumn("pedidos", F.coalesce("pedidos", F.lit(0).cast("long")))


@query("select s_suppkey, n_name from supplier left join nation on s_nationkey = n_nationkey and n_regionkey = 1")
def join_left_diffnames(spark, sf):
    nation = _t(spark, sf, "nation").where("n_regionkey = 1")
    return _t(spark, sf, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left").select("s_suppkey", "n_name")


@query("select l_orderkey, l_linenumber, l_partkey from lineitem where l_orderkey in (select o_orderkey from orders where o_orderdate >= timestamp '1996-01-01')")
def semi_window_restrict(spark, sf):
    kept = _t(spark, sf, "orders").where("o_orderdate >= timestamp '1996-01-01'").select(F.col("o_orderkey").alias("l_orderkey"))
    return files.restrict(_t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), kept, "l_orderkey")


@query("select lpad(cast(c_custkey as varchar), 8, '0') as cnpj_basico, c_mktsegment from customer where c_custkey in (select s_suppkey from supplier)")
def semi_join_minimized(spark, sf):
    raw = _t(spark, sf, "customer").select(F.lpad(F.col("c_custkey").cast("string"), 8, "0").alias("cnpj_basico"), "c_mktsegment", "c_name")
    wanted = _t(spark, sf, "supplier").select(F.lpad(F.col("s_suppkey").cast("string"), 8, "0").alias("cnpj"))
    return context.minimised(raw, wanted, "cnpj_basico", ["c_mktsegment"], 8)


def _with_orphans(spark, sf):
    """Orders, and one planted order for each customer whose own key and whose customer's are in no table."""
    planted = _t(spark, sf, "customer").select((-1 - F.col("c_custkey")).alias("o_orderkey"), (-1 - F.col("c_custkey")).alias("o_custkey"))
    return _t(spark, sf, "orders").select("o_orderkey", "o_custkey").unionByName(planted)


_ORPHANS = "planted as (select o_orderkey, o_custkey from orders union all select -1 - c_custkey, -1 - c_custkey from customer)"


@query(f"with {_ORPHANS} select o_orderkey, 'item_nao_carregado' as motivo_quarentena from planted where o_orderkey not in (select l_orderkey from lineitem)")
def anti_orphans(spark, sf):
    parents = _t(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return silver.close_over(_with_orphans(spark, sf).select("o_orderkey"), parents, "o_orderkey", "item_nao_carregado")[1]


@query("select l_orderkey, l_linenumber, l_suppkey from lineitem where l_orderkey in (select o_orderkey from orders where o_orderstatus = 'F')")
def fk_closure(spark, sf):
    parents = _t(spark, sf, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    return silver.close_over(_t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey"), parents, "l_orderkey", "contratacao_nao_carregada")[0]


@query(f"with {domain.ctes('versions')} select distinct s.entidade, s.atualizado_em, s.conteudo from versions s join versions t on s.entidade = t.entidade and s.atualizado_em = t.atualizado_em and s.conteudo <> t.conteudo where cast(s.source_file_id as int) % 2 = 1 and cast(t.source_file_id as int) % 2 = 0")
def merge_conflict_detect(spark, sf):
    """All versions: those of even files are the stored side, those of odd files the new one."""
    versions = _v(spark, sf, "versions")[0]
    odd = F.col("source_file_id").cast("int") % 2 == 1
    found = changes.stored_conflicts(versions.where(~odd), versions.where(odd).select("entidade", "atualizado_em", "conteudo"), "entidade", "atualizado_em", "conteudo")
    return found.select("entidade", "atualizado_em", "conteudo")


@query("select 'cliente' as origem, cast(c_custkey as varchar) as chave, cast(null as varchar) as motivo from customer union all select 'fornecedor', cast(s_suppkey as varchar), case when s_acctbal < 0 then 'saldo_negativo' end from supplier")
def union_problems(spark, sf):
    a = _t(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("chave"))
    b = _t(spark, sf, "supplier").select(F.col("s_suppkey").cast("string").alias("chave"), F.when(F.col("s_acctbal") < 0, "saldo_negativo").alias(silver.REASON))
    log = silver.problem_log([("fornecedor", b, "chave"), ("cliente", a, "chave")], "r")
    return log.select(F.col("entidade").alias("origem"), "chave", F.col(silver.REASON).alias("motivo"))


@query("select resultado_id, valor from (select distinct concat(l_orderkey, '-', l_linenumber, '-', l_suppkey, '-', l_partkey) as resultado_id, l_extendedprice as valor from lineitem) order by valor desc nulls last, resultado_id limit 20")
def topk_values(spark, sf):
    return quality.largest_awards(_v(spark, sf, "awards")[0].select("resultado_id", "valor_total_homologado").distinct()).withColumnRenamed("valor_total_homologado", "valor")


ELIGIBLE = """judged as (select *, case when count(*) over (partition by resultado_id) > 1 then 'resultado_duplicado'
  when quantidade_homologada is null or quantidade_homologada <= 0 then 'quantidade_homologada_invalida'
  when valor_unitario_homologado is null or valor_unitario_homologado <= 0 then 'valor_unitario_homologado_invalido'
  when valor_total_homologado is null or valor_total_homologado <= 0 then 'valor_total_homologado_invalido'
  when abs(valor_total_homologado - quantidade_homologada * valor_unitario_homologado) > greatest(0.01, abs(valor_total_homologado) * 0.01) then 'total_diverge_quantidade_vezes_unitario' end as motivo from awards)"""


@query(f"with {domain.ctes('awards')}, {ELIGIBLE} select coalesce(motivo, 'elegivel') as motivo, count(*) as linhas from judged group by 1")
def reason_histogram(spark, sf):
    judged = gold.monetary_eligibility(_v(spark, sf, "awards")[0])
    return quality.histogram(judged)


# --- versions and duplicates ---


@query(f"with {domain.ctes('versions')} select entidade, atualizado_em, source_file_id, conteudo from (select *, row_number() over (partition by entidade order by atualizado_em desc, source_file_id desc, conteudo desc) as n from versions) where n = 1")
def latest_version(spark, sf):
    return versioning.latest(_v(spark, sf, "versions")[0], "entidade", ("atualizado_em", "source_file_id"))


@query(f"with {domain.ctes('quality_history')} select regra, run_id, observados, status from (select *, row_number() over (partition by regra order by cast(registrado_em as timestamp) desc, run_id desc) as n from quality_history) where n = 1")
def latest_quality_rule(spark, sf):
    return gold.latest_rules(_v(spark, sf, "quality_history")[0]).select("regra", "run_id", "observados", "status")


@query("select n_nationkey, s_suppkey, round(s_acctbal / sum(s_acctbal) over (partition by n_nationkey), 6) as participacao from supplier join nation on s_nationkey = n_nationkey")
def share_of_total(spark, sf):
    joined = _t(spark, sf, "supplier").join(_t(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    return gold.with_share(joined, "s_acctbal", ("n_nationkey",), "participacao").select("n_nationkey", "s_suppkey", F.round("participacao", 6).alias("participacao"))


@query("select c_nationkey, max(c_custkey) as c_custkey from customer group by c_nationkey")
def dedup_first(spark, sf):
    return versioning.latest(_t(spark, sf, "customer").select("c_nationkey", "c_custkey"), "c_nationkey", ("c_custkey",))


@query("select distinct l_returnflag, l_linestatus, l_linenumber from lineitem")
def dedup_distinct(spark, sf):
    return _t(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber").distinct()


@query("select concat(l_orderkey, '-', l_linenumber) as chave, count(*) as linhas from lineitem group by 1 having count(*) > 1")
def dup_key_check(spark, sf):
    return quality.duplicates(_t(spark, sf, "lineitem").select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("chave")), "chave")


SPLIT = """torn as (select entidade, atualizado_em from versions group by 1, 2 having count(distinct conteudo) > 1),
  current_rows as (select *, row_number() over (partition by entidade order by atualizado_em desc, source_file_id desc) as n from versions v where not exists (select 1 from torn t where t.entidade = v.entidade and t.atualizado_em = v.atualizado_em))"""


@query(f"with {domain.ctes('versions')}, {SPLIT} select entidade, atualizado_em, source_file_id, 'corrente' as situacao from current_rows where n = 1 union all select v.entidade, v.atualizado_em, v.source_file_id, 'conflito' from versions v join torn t on t.entidade = v.entidade and t.atualizado_em = v.atualizado_em")
def version_split_generic(spark, sf):
    current, conflicts = versioning.split_versions(_v(spark, sf, "versions")[0], "entidade", digest="conteudo")
    pick = lambda df, s: df.select("entidade", "atualizado_em", "source_file_id", F.lit(s).alias("situacao"))
    return pick(current, "corrente").unionByName(pick(conflicts, "conflito"))


@query("select l_orderkey, l_linenumber, sha256(concat_ws('|', 'v1', cast(l_partkey as varchar), cast(l_suppkey as varchar), l_returnflag, nullif(l_linestatus, 'O'))) as hash_conteudo from lineitem")
def content_hash(spark, sf):
    return _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", expr.key("v1", F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"), F.col("l_returnflag"), F.nullif(F.col("l_linestatus"), F.lit("O"))).alias("hash_conteudo"))


# --- silver ---


def _raw_procurements(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("o_orderkey")
    return _t(spark, sf, "orders").select(
        F.when(k % 13 == 0, "").otherwise(k.cast("string")).alias("id_compra"), F.when(k % 4 == 0, None).otherwise(F.concat(F.lit("PNCP-"), F.floor(k / 2).cast("string"))).alias("numero_controle_PNCP"),
        F.when(k % 11 == 0, " ").otherwise(F.col("o_custkey").cast("string")).alias("orgao_entidade_cnpj"), F.col("o_orderpriority").alias("objeto_compra"),
        F.when(k % 5 == 0, F.lit("-1")).otherwise(F.format_string("%.2f", "o_totalprice")).alias("valor_total_estimado"), _day("o_orderdate").alias("data_publicacao_pncp"),
        F.lit("1").alias("modalidade_id_pncp"), F.col("o_orderpriority").alias("modalidade_nome"), F.when(k % 7 == 0, "sem data").otherwise(F.date_format("o_orderdate", "yyyy-MM-01")).alias("data_atualizacao_pncp"),
        F.lit("true").alias("ind_atual"), F.lit("false").alias("contratacao_excluida"), F.lit("PNCP").alias("_sistema_origem"), F.lpad(F.col("o_custkey").cast("string"), 9, "0").alias("_source_file_id"), F.lit("r").alias("_run_id"), F.lit("2026-01-01").alias("_coletado_em_utc"),
    )


RAW_P = """raw as (select o_orderkey as k, case when o_orderkey % 13 = 0 then '' else cast(o_orderkey as varchar) end as id_origem, case when o_orderkey % 4 = 0 then null else concat('PNCP-', cast(o_orderkey // 2 as varchar)) end as controle,
  case when o_orderkey % 11 = 0 then '' else cast(o_custkey as varchar) end as cnpj, o_orderpriority, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') as pub, case when o_orderkey % 7 = 0 then null else strftime(o_orderdate, '%Y-%m-01') end as ts, o_orderkey % 5 = 0 as neg, lpad(cast(o_custkey as varchar), 9, '0') as arq from orders),
  typed as (select *, sha256(case when controle is not null then concat('pncp|', lower(controle)) else concat('pncp|', id_origem) end) as contratacao_id,
  case when cnpj = '' then 'cnpj_orgao_ausente' when id_origem = '' then 'id_origem_ausente' when ts is null then 'data_atualizacao_invalida' when neg then 'valor_total_negativo' end as motivo_quarentena from raw)"""


@query(f"with {RAW_P} select motivo_quarentena, contratacao_id from typed where motivo_quarentena is not null")
def quarantine_reasons(spark, sf):
    return silver.procurements(_raw_procurements(spark, sf)).quarantine.select("motivo_quarentena", "contratacao_id")


@query(f"with {RAW_P}, ok as (select * from typed where motivo_quarentena is null), torn as (select contratacao_id, ts from ok group by 1, 2 having count(distinct concat_ws('|', coalesce(controle, '-'), cnpj, o_orderpriority, cast(o_totalprice as varchar), pub)) > 1), "
       "clean as (select *, row_number() over (partition by contratacao_id order by ts desc, arq desc, k desc) as n from ok o where not exists (select 1 from torn t where t.contratacao_id = o.contratacao_id and t.ts = o.ts)) "
       "select contratacao_id, ts as dia, 'corrente' as situacao from clean where n = 1 union all select o.contratacao_id, o.ts, 'conflito' from ok o join torn t on t.contratacao_id = o.contratacao_id and t.ts = o.ts")  # fmt: skip
def version_split_contratacoes(spark, sf):
    split = silver.procurements(_raw_procurements(spark, sf))
    pick = lambda df, s: df.select("contratacao_id", _day("atualizado_em").alias("dia"), F.lit(s).alias("situacao"))
    return pick(split.current, "corrente").unionByName(pick(split.conflicts, "conflito"))


@query("select concat(cast(l_orderkey as varchar), '-', cast(l_linenumber as varchar), '-', cast(l_partkey as varchar)) as chave, case when l_quantity <= 5 then 'quantidade_nao_positiva' when l_linestatus = 'O' and l_linenumber = 1 then 'unidade_ausente' when l_discount > 0.08 then 'valor_unitario_negativo' when l_tax > 0.06 then 'valor_total_negativo' end as motivo from lineitem")
def itens_eligibility(spark, sf):
    raw = _t(spark, sf, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("id_compra_item"), F.col("l_orderkey").cast("string").alias("numero_controle_PNCP_compra"), F.col("l_linenumber").cast("string").alias("numero_item_pncp"), F.lit("x").alias("descricao_resumida"), F.lit("y").alias("descricao_detalhada"), F.lit("M").alias("material_ou_servico"),
        F.when(F.col("l_quantity") <= 5, "0").otherwise("1.5").alias("quantidade"), F.when((F.col("l_linestatus") == "O") & (F.col("l_linenumber") == 1), " ").otherwise("UN").alias("unidade_medida"), F.when(F.col("l_discount") > 0.08, "-2").otherwise("2").alias("valor_unitario_estimado"), F.when(F.col("l_tax") > 0.06, "-3").otherwise("3").alias("valor_total"), F.lit("2026-01-01").alias("data_atualizacao_pncp"), F.lit("a").alias("_source_file_id"),
    )
    return silver.type_items(raw).select(F.col("id_origem_item").alias("chave"), F.col("motivo_ineligibilidade_preco").alias("motivo"))


def _raw_awards(spark: SparkSession, sf: str) -> DataFrame:
    line = _t(spark, sf, "lineitem").join(_t(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    return line.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("srk_item_resultado"), F.lit("i").alias("id_compra_item"), F.col("l_orderkey").cast("string").alias("numero_controle_PNCP_compra"), F.col("l_linenumber").cast("string").alias("numero_item_pncp"), F.col("l_partkey").cast("string").alias("sequencial_resultado"),
        F.when(F.col("s_nationkey") % 3 == 0, "PF").otherwise("PJ").alias("tipo_pessoa"), F.lit("BRA").alias("codigo_pais"), F.when(F.col("l_suppkey") % 9 == 0, "-").otherwise(F.concat(F.lit("1."), F.col("l_suppkey").cast("string"))).alias("ni_fornecedor"), F.col("s_name").alias("nome_razao_social_fornecedor"),
        F.when(F.col("l_quantity") > 45, "-1").otherwise("2").alias("quantidade_homologada"), F.when(F.col("l_discount") > 0.08, "-1").otherwise("3").alias("valor_unitario_homologado"), F.when(F.col("l_tax") > 0.06, "-1").otherwise("6").alias("valor_total_homologado"),
        F.when(F.col("l_linenumber") == 7, "x").otherwise(_day("l_shipdate")).alias("data_atualizacao_pncp"), F.lit("f").alias("_source_file_id"), F.when(F.col("l_returnflag") == "R", "Cancelado").when(F.col("l_returnflag") == "A", "Informado").alias("situacao_compra_item_resultado_nome"),
    )


@query("select concat(l_orderkey, '-', l_linenumber, '-', l_partkey) as id_origem_resultado, case when l_returnflag = 'R' then true when l_returnflag = 'A' then false end as cancelado, case when l_suppkey % 9 = 0 then 'fornecedor_ausente' when l_quantity > 45 then 'quantidade_negativa' when l_discount > 0.08 then 'valor_unitario_negativo' when l_tax > 0.06 then 'valor_total_negativo' when l_linenumber = 7 then 'data_atualizacao_invalida' end as motivo_quarentena from lineitem join supplier on l_suppkey = s_suppkey")
def resultados_quarantine(spark, sf):
    return silver.type_awards(_raw_awards(spark, sf), SECRET).select("id_origem_resultado", "cancelado", "motivo_quarentena")


_INNER, _OUTER = ("".join(f"\\x{b ^ pad:02X}" for b in SECRET.encode().ljust(64, b"\0")) for pad in (0x36, 0x5C))


@query(f"select distinct case when s_nationkey % 3 = 0 then sha256('{_OUTER}'::blob || unhex(sha256('{_INNER}'::blob || encode(concat('PF|BRA|', cast(s_suppkey as varchar))))))  else sha256(concat('PJ|BRA|', cast(s_suppkey as varchar))) end as fornecedor_id, case when s_nationkey % 3 > 0 then cast(s_suppkey as varchar) end as identificador_publico from supplier")
def supplier_identity(spark, sf):
    df = _t(spark, sf, "supplier").select(F.when(F.col("s_nationkey") % 3 == 0, "PF").otherwise("PJ").alias("tipo_pessoa"), F.lit("BRA").alias("pais"), F.col("s_suppkey").cast("string").alias("identificador_normalizado"))
    return silver.supplier_identity(df, SECRET).select("fornecedor_id", "identificador_publico").distinct()


def _raw_dimensions(spark: SparkSession, sf: str) -> DataFrame:
    joined = _t(spark, sf, "orders").join(_t(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return joined.select(
        F.concat(F.lit("P"), F.col("o_orderkey").cast("string")).alias("numero_controle_PNCP"), F.when(F.col("c_nationkey") == 3, "").otherwise(F.col("c_nationkey").cast("string")).alias("orgao_entidade_cnpj"), F.concat(F.lit("orgao "), F.col("o_orderkey").cast("string")).alias("orgao_entidade_razao_social"),
        F.when(F.col("c_custkey") % 10 == 0, None).otherwise((F.col("c_custkey") % 20).cast("string")).alias("unidade_orgao_codigo_unidade"), F.concat(F.lit("unidade "), F.col("o_orderkey").cast("string")).alias("unidade_orgao_nome_unidade"), F.col("c_mktsegment").alias("unidade_orgao_uf_sigla"),
        _day("o_orderdate").alias("data_atualizacao_pncp"), F.lpad(F.col("o_orderkey").cast("string"), 10, "0").alias("_source_file_id"),
    )


DIMS = "dims as (select *, cast(c_nationkey as varchar) as cnpj, case when c_custkey % 10 > 0 then cast(c_custkey % 20 as varchar) end as unidade, strftime(o_orderdate, '%Y-%m-%d') as dia from orders join customer on o_custkey = c_custkey where c_nationkey <> 3)"


@query(f"with {DIMS} select sha256(concat('orgao|', cnpj)) as orgao_id, concat('orgao ', cast(o_orderkey as varchar)) as nome_orgao from (select *, row_number() over (partition by cnpj order by dia desc, o_orderkey desc) as n from dims) where n = 1")
def dim_orgaos(spark, sf):
    return silver.agencies_and_units(_raw_dimensions(spark, sf))[0].select("orgao_id", "nome_orgao")


@query(f"with {DIMS} select sha256(concat(cnpj, '|', unidade)) as unidade_id, c_mktsegment as uf, concat('unidade ', cast(o_orderkey as varchar)) as nome_unidade from (select *, row_number() over (partition by cnpj, unidade order by dia desc, o_orderkey desc) as n from dims where unidade is not null) where n = 1")
def dim_unidades(spark, sf):
    return silver.agencies_and_units(_raw_dimensions(spark, sf))[1].select("unidade_id", "uf", "nome_unidade")


@query(f"with {DIMS} select sha256(concat('pncp|p', cast(o_orderkey as varchar))) as contratacao_id, sha256(concat('orgao|', cnpj)) as orgao_id, sha256(concat(cnpj, '|', unidade)) as unidade_id from dims where unidade is not null")
def vinculos(spark, sf):
    return silver.procurement_links(_raw_dimensions(spark, sf)).select("contratacao_id", "orgao_id", "unidade_id")


RULES = (("vermelho", r"^red\b"), ("azul", r"^(blue|navy)"), ("outros", r"^[g-l]"))
_CASE = "case when regexp_matches(x, '^red\\b') then 'vermelho' when regexp_matches(x, '^(blue|navy)') then 'azul' when regexp_matches(x, '^[g-l]') then 'outros' end"


@query(f"select p_partkey, coalesce(case when p_size % 2 = 0 then {_CASE} end, 'incerto') as categoria_tecnologia from (select *, lower(p_name) as x from part)")
def classify_equipment(spark, sf):
    df = _t(spark, sf, "part").select("p_partkey", F.upper("p_name").alias("descricao"), F.when(F.col("p_size") % 2 == 0, "M").otherwise("S").alias("material_ou_servico"))
    return classify.equipment(df, RULES).select("p_partkey", "categoria_tecnologia")


@query(f"select p_partkey, case when p_size % 2 = 1 then coalesce({_CASE}, 'incerto') end as categoria_servico, case when p_size % 2 = 1 then case when {_CASE} is null then 'fora_escopo' else 'nao_publicavel' end end as status_preco_servico, coalesce('servico_' || case when p_size % 2 = 1 then {_CASE} end, 'incerto') as categoria_tecnologia from (select *, lower(p_name) as x from part)")
def classify_service(spark, sf):
    df = _t(spark, sf, "part").select("p_partkey", F.concat(F.lit("  "), F.translate(F.upper("p_name"), "EU", "ÉÚ")).alias("descricao"), F.when(F.col("p_size") % 2 == 0, "M").otherwise("S").alias("material_ou_servico"), F.lit("incerto").alias("categoria_tecnologia"))
    return classify.services(df, RULES).select("p_partkey", "categoria_servico", "status_preco_servico", "categoria_tecnologia")


@query("select cast(o_orderkey as varchar) as id_origem_contrato, case when o_custkey % 9 = 0 then 'fornecedor_ausente' when o_orderkey % 5 = 0 then 'valor_global_negativo' when o_orderkey % 7 = 0 then 'valor_inicial_negativo' when o_orderkey % 11 = 0 then 'vigencia_incoerente' when o_orderkey % 13 = 0 then 'observacao_invalida' end as motivo_quarentena from orders")
def contratos_quarantine(spark, sf):
    k = F.col("o_orderkey")
    raw = _t(spark, sf, "orders").select(
        k.cast("string").alias("id"), F.lit("Pessoa Juridica").alias("fornecedor_tipo"), F.when(F.col("o_custkey") % 9 == 0, "").otherwise(F.col("o_custkey").cast("string")).alias("fonecedor_cnpj_cpf_idgener"), _day("o_orderdate").alias("vigencia_inicio"), F.when(k % 11 == 0, "1980-01-01").otherwise("2030-01-01").alias("vigencia_fim"),
        F.when(k % 7 == 0, "-1").otherwise("1").alias("valor_inicial"), F.when(k % 5 == 0, "-1").otherwise("1").alias("valor_global"), F.when(k % 13 == 0, "?").otherwise("2026-01-01").alias("_coletado_em_utc"), F.lit("f").alias("_source_file_id"),
    )
    return silver.type_contracts(raw, SECRET).select("id_origem_contrato", "motivo_quarentena")


@query("select cast(p_partkey as varchar) as id_origem_item_contrato, case when p_size % 3 = 0 then 'S' when p_size % 3 = 1 then 'M' end as material_ou_servico, case when p_size < 5 then 'quantidade_nao_positiva' when p_size < 9 then 'valor_unitario_ausente' when p_size < 12 then 'valor_total_ausente' end as motivo_ineligibilidade_preco, case when p_partkey % 10 = 0 then 'contrato_ausente' when p_partkey % 7 = 0 and p_size >= 9 then 'valor_unitario_negativo' end as motivo_quarentena from part")
def contrato_itens(spark, sf):
    size = F.col("p_size")
    raw = _t(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("id"), F.when(F.col("p_partkey") % 10 == 0, "").otherwise("c1").alias("contrato_id"), F.when(size % 3 == 0, "Serviço").when(size % 3 == 1, "Material").otherwise("?").alias("tipo_id"), F.col("p_name").alias("descricao_complementar"),
        F.when(size < 5, "0").otherwise("2").alias("quantidade"), F.when(size < 9, "").when(F.col("p_partkey") % 7 == 0, "-4").otherwise("4").alias("valorunitario"), F.when(size < 12, " ").otherwise("8").alias("valortotal"), F.lit("2026-01-01").alias("_coletado_em_utc"), F.lit("f").alias("_source_file_id"),
    )
    return silver.type_contract_items(raw).select("id_origem_item_contrato", "material_ou_servico", "motivo_ineligibilidade_preco", "motivo_quarentena")


@query("select cast(event_id as varchar) as id_origem_evento, case when event_id % 5 = 0 then 'contrato_ausente' when event_id % 7 = 0 then 'valor_global_negativo' when event_id % 11 = 0 then 'novo_valor_global_negativo' end as motivo_quarentena, case when event_id % 7 = 0 then (case when event_id % 11 = 0 then -2 else 9 end) + 3.0 else (case when event_id % 11 = 0 then -2 else 9 end) - 4.0 end::double as variacao_valor, strftime(ts, '%Y-%m-%d') as dia from events")
def contrato_eventos(spark, sf):
    k, stamp = F.col("event_id"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    raw = _t(spark, sf, "events").select(
        k.cast("string").alias("id"), F.when(k % 5 == 0, "").otherwise("c").alias("contrato_id"), F.when(k % 7 == 0, "-3").otherwise("4").alias("valor_global"), F.when(k % 11 == 0, "-2").otherwise("9").alias("novo_valor_global"), F.when(k % 2 == 0, F.concat(F.lit("{'date': '"), stamp, F.lit("'}"))).alias("alterado_em"), stamp.alias("criado_em"), F.lit("f").alias("_source_file_id"),
    )
    return silver.type_contract_events(raw).select("id_origem_evento", "motivo_quarentena", F.col("variacao_valor").cast("double").alias("variacao_valor"), _day("atualizado_em").alias("dia"))


@query(f"with {domain.ctes('contracts', 'items', 'contract_events')}, kept as (select * from contracts where contrato_id in (select contratacao_id from items where categoria_tecnologia = 'PROMO')) select 'contratos' as tabela, count(*) as linhas from kept union all select 'itens', count(*) from items where categoria_tecnologia = 'PROMO' and contratacao_id in (select contrato_id from kept) union all select 'eventos', count(*) from contract_events where contrato_id in (select contrato_id from kept) union all select 'fornecedores', count(distinct fornecedor_id) from kept")
def contract_population(spark, sf):
    contracts, items, events = _v(spark, sf, "contracts", "items", "contract_events")
    some = items.select("item_id", F.col("contratacao_id").alias("contrato_id"), F.when(F.col("categoria_tecnologia") == "PROMO", "PROMO").otherwise("incerto").alias("categoria_tecnologia"))
    kept = silver.technology_population(contracts, some, events, contracts.select("fornecedor_id").distinct())
    counted = [df.agg(F.count("*").alias("linhas")).select(F.lit(n).alias("tabela"), "linhas") for n, df in zip(("contratos", "itens", "eventos", "fornecedores"), kept, strict=True)]
    return counted[0].unionByName(counted[1]).unionByName(counted[2]).unionByName(counted[3])


# --- gold ---


@query(f"with {domain.ctes('awards')}, {ELIGIBLE} select resultado_id, motivo as motivo_inelegibilidade_monetaria, motivo is null as elegivel_monetario from judged")
def elegibilidade_monetaria(spark, sf):
    return gold.monetary_eligibility(_v(spark, sf, "awards")[0]).select("resultado_id", "motivo_inelegibilidade_monetaria", "elegivel_monetario")


_COUNTED = "total_itens, itens_com_resultado, resultados, resultados_com_fornecedor, itens_com_unidade, itens_com_quantidade, itens_com_preco_unitario, itens_com_categoria, itens_com_orgao"


@query(f"""with {domain.ctes('items', 'awards', 'procurements', 'links', 'quality_history')}, per as (select item_id, count(distinct resultado_id) as resultados, count(distinct case when fornecedor_id is not null then resultado_id end) as com from awards group by 1),
  covered as (select strftime(publicado_em, '%Y-%m') as periodo, modalidade_id, modalidade, categoria_tecnologia, count(*) as total_itens, count(case when resultados > 0 then 1 end) as itens_com_resultado, sum(resultados)::bigint as resultados, sum(com)::bigint as resultados_com_fornecedor,
    count(unidade_medida) as itens_com_unidade, count(case when quantidade > 0 then 1 end) as itens_com_quantidade, count(valor_unitario_estimado) as itens_com_preco_unitario, count(case when categoria_tecnologia <> 'incerto' then 1 end) as itens_com_categoria, count(orgao_id) as itens_com_orgao
    from items left join procurements using (contratacao_id) left join links using (contratacao_id) left join per using (item_id) group by 1, 2, 3, 4),
  rules as (select regra, observados, total, percentual, severidade, status from (select *, row_number() over (partition by regra order by cast(registrado_em as timestamp) desc, run_id desc) as n from quality_history) where n = 1)
  select periodo, modalidade_id, modalidade, categoria_tecnologia, {_COUNTED}, round(itens_com_resultado / total_itens, 6) as cobertura_resultado, round(case when resultados > 0 then resultados_com_fornecedor / resultados else 0 end, 6) as cobertura_fornecedor, round(itens_com_unidade / total_itens, 6) as cobertura_unidade, round(itens_com_quantidade / total_itens, 6) as cobertura_quantidade,
    round(itens_com_preco_unitario / total_itens, 6) as cobertura_preco_unitario, round(itens_com_categoria / total_itens, 6) as cobertura_categoria, round(itens_com_orgao / total_itens, 6) as cobertura_orgao, 'item_contratacao' as entidade, 'cobertura_analitica' as metrica, null::bigint as observados, null::bigint as total, null::double as percentual, null::varchar as severidade, 'PASS' as status_qualidade, 'publicada' as status_publicacao from covered
  union all select 'janela_atual', 'todos', 'Todas', 'todas', {', '.join(['null::bigint'] * 9)}, {', '.join(['null::double'] * 7)}, 'pipeline', regra, observados, total, round(percentual, 6), severidade, status, 'publicada' from rules""")  # fmt: skip
def qualidade_cobertura(spark, sf):
    out = gold.quality_coverage(*_v(spark, sf, "items", "awards", "procurements", "links", "quality_history"))
    names = ["periodo", "modalidade_id", "modalidade", "categoria_tecnologia", *_COUNTED.split(", "), *(f"cobertura_{c}" for c in gold.COVERAGE), "entidade", "metrica", "observados", "total", "percentual", "severidade", "status_qualidade", "status_publicacao"]
    return _rounded(out, percentual=6, **{f"cobertura_{c}": 6 for c in gold.COVERAGE}).select(names)


def _concentration_sql(validated: bool) -> str:
    value = lambda c, p: f"round(case when limitacao is null then {c} end, {p}) as {c}"
    return f"""with {domain.ctes('awards', 'items', 'procurements', 'region_links')}, {ELIGIBLE},
  base as (select strftime(publicado_em, '%Y-%m') as periodo, orgao_id, categoria_tecnologia, modalidade_id, modalidade, a.*, motivo is null as ok from judged a join items i on i.item_id = a.item_id join procurements p on p.contratacao_id = i.contratacao_id join region_links l on l.contratacao_id = p.contratacao_id where categoria_tecnologia <> 'incerto' and not cancelado),
  groups as (select periodo, orgao_id, categoria_tecnologia, modalidade_id, modalidade, count(distinct resultado_id) as resultados_observados, count(distinct case when ok then resultado_id end) as resultados_semantica_elegivel, sum(case when valor_total_homologado > 0 then valor_total_homologado else 0 end) as valor_observado from base group by 1, 2, 3, 4, 5),
  sup as (select periodo, orgao_id, categoria_tecnologia, modalidade_id, modalidade, fornecedor_id, sum(valor_total_homologado) as v, count(distinct resultado_id) as n from base where ok and fornecedor_id is not null group by 1, 2, 3, 4, 5, 6),
  sh as (select *, sum(v) over w as t, v / sum(v) over w as s, row_number() over (partition by periodo, orgao_id, categoria_tecnologia, modalidade_id, modalidade order by v desc, fornecedor_id) as pos from sup window w as (partition by periodo, orgao_id, categoria_tecnologia, modalidade_id, modalidade)),
  con as (select periodo, orgao_id, categoria_tecnologia, modalidade_id, modalidade, max(t) as valor_total_homologado, count(*) as fornecedores_distintos, sum(n)::bigint as resultados_elegiveis, max(s) as top_1, least(1.0, sum(case when pos <= 3 then s else 0 end)) as top_3, sum(s * s) as hhi from sh group by 1, 2, 3, 4, 5),
  j as (select g.*, valor_total_homologado, coalesce(fornecedores_distintos, 0) as fornecedores_distintos, coalesce(resultados_elegiveis, 0) as resultados_elegiveis, top_1, top_3, hhi, case when valor_observado > 0 then valor_total_homologado / valor_observado else 0 end as cobertura_valor, resultados_semantica_elegivel / resultados_observados as cobertura_semantica_valor from groups g left join con using (periodo, orgao_id, categoria_tecnologia, modalidade_id, modalidade)),
  m as (select *, case when {"false" if validated else "true"} then 'semantica_fonte_nao_validada' when cobertura_semantica_valor < 1 then 'semantica_valor_inconsistente' when resultados_elegiveis < 2 then 'resultados_insuficientes' when fornecedores_distintos < 2 then 'fornecedores_insuficientes' when cobertura_valor < 0.8 then 'cobertura_valor_insuficiente' end as limitacao from j)
  select periodo, orgao_id, categoria_tecnologia, modalidade_id, modalidade, resultados_observados, resultados_semantica_elegivel, fornecedores_distintos, resultados_elegiveis, {value("top_1", 6)}, {value("top_3", 6)}, {value("hhi", 6)}, {value("valor_total_homologado", 2)}, {value("valor_observado", 2)}, {value("cobertura_valor", 6)}, round(cobertura_semantica_valor, 6) as cobertura_semantica_valor, limitacao, case when limitacao is null then 'publicada' else 'nao_publicavel' end as status_publicacao, case when limitacao is null then 'aprovado' else 'reprovado' end as gate_monetario from m"""  # fmt: skip


def _concentration(spark: SparkSession, sf: str, validated: bool) -> DataFrame:
    items, awards, procurements, links = _v(spark, sf, "items", "awards", "procurements", "region_links")
    out = gold.supplier_concentration(items, awards, procurements, links, min_awards=2, source_validated=validated)
    return _rounded(out, top_1=6, top_3=6, hhi=6, valor_total_homologado=2, valor_observado=2, cobertura_valor=6, cobertura_semantica_valor=6)


@query(_concentration_sql(True))
def concentracao(spark, sf):
    return _concentration(spark, sf, True)


@query(_concentration_sql(False))
def concentracao_masked(spark, sf):
    return _concentration(spark, sf, False)


@query("with s as (select s_suppkey, s_acctbal / 10000 as top_1, (s_acctbal + case when s_suppkey % 7 = 0 then -500 else 500 end) / 10000 as top_3, case when s_suppkey % 11 = 0 then 1.5 when s_suppkey % 13 = 0 then null else 0.5 end as hhi, s_nationkey / 20.0 as cobertura_valor from supplier) select s_suppkey from s where not coalesce(top_1 between 0 and 1 and top_3 between 0 and 1 and top_1 <= top_3 and hhi between 0 and 1 and cobertura_valor between 0 and 1, true)")
def invariant_violations(spark, sf):
    """Rows that break every bound in turn, planted among sound ones."""
    k = F.col("s_suppkey")
    made = _t(spark, sf, "supplier").select(
        "s_suppkey", (F.col("s_acctbal") / 10000).alias("top_1"), ((F.col("s_acctbal") + F.when(k % 7 == 0, -500).otherwise(500)) / 10000).alias("top_3"), F.when(k % 11 == 0, 1.5).when(k % 13 == 0, None).otherwise(0.5).alias("hhi"),
        (F.col("s_nationkey") / 20.0).alias("cobertura_valor"), F.lit(1.0).alias("cobertura_semantica_valor"),
    )
    return gold.concentration_violations(made).select("s_suppkey")


@query("select 0::bigint as violacoes")
def concentracao_sound(spark, sf):
    """The published shares break no bound."""
    return gold.concentration_violations(_concentration(spark, sf, True)).agg(F.count("*").alias("violacoes"))


@query(f"with {domain.ctes('items')} select categoria_tecnologia as categoria_servico, count(*) as total_itens, count(unidade_medida) as itens_com_unidade, count(valor_unitario_estimado) as itens_com_preco, count(distinct unidade_medida) as unidades_distintas, round(count(unidade_medida) / count(*), 6) as cobertura_unidade, round(count(valor_unitario_estimado) / count(*), 6) as cobertura_preco, 'nao_publicavel' as status_publicacao_preco, 'escopo_unidade_sla_nao_estruturados' as limitacao_preco from items where material_ou_servico = 'S' and categoria_tecnologia <> 'incerto' group by 1")
def cobertura_servicos(spark, sf):
    items = _v(spark, sf, "items")[0].withColumn("categoria_servico", F.when(F.col("material_ou_servico") == "S", F.col("categoria_tecnologia")))
    return _rounded(gold.service_coverage(items), cobertura_unidade=6, cobertura_preco=6)


def _related(spark: SparkSession, sf: str) -> DataFrame:
    return gold.relations(*_v(spark, sf, "items", "awards", "procurements", "links"))


@query(f"{STAR} select * from related")
def relacoes_base(spark, sf):
    return _related(spark, sf).drop("valor_total_homologado", "cancelado", "publicado_em")


@query(f"{STAR} select orgao_id, fornecedor_id, categoria_tecnologia, count(distinct contratacao_id) as contratacoes_distintas, count(distinct resultado_id) as resultados_distintos, count(distinct periodo) as periodos_distintos, min(data_publicacao) as primeira_ocorrencia, max(data_publicacao) as ultima_ocorrencia, date_diff('day', min(data_publicacao), max(data_publicacao))::int as dias_entre_primeira_ultima, 'publicada' as status_publicacao, 'recorrencia_descritiva_nao_indica_irregularidade' as limitacao from related group by 1, 2, 3 having count(distinct contratacao_id) >= 2")
def recorrencia(spark, sf):
    return gold.recurrence(_related(spark, sf)).drop("valor_total_homologado")


@query(f"{STAR}, r as (select 1 from related group by orgao_id, fornecedor_id, categoria_tecnologia having count(distinct contratacao_id) >= 2) select count(distinct contratacao_id) as compras_tecnologia, count(distinct item_id) as itens_tecnologia, count(distinct resultado_id) as resultados_tecnologia, count(distinct fornecedor_id) as fornecedores_compras_tecnologia, (select count(*) from r) as relacoes_recorrentes from related")
def kpis_compras(spark, sf):
    return gold.procurement_kpis(_related(spark, sf))


@query("select concat(year(o_orderdate), '-', quarter(o_orderdate)) as trimestre, o_orderpriority, count(*)::bigint as observacoes, min(o_totalprice) as minimo, max(o_totalprice) as maximo, true as dentro_do_erro from orders group by 1, 2")
def quantis_por_trimestre(spark, sf):
    """Sketches of months, merged by quarter; whether their quantiles lie within three times the error is counted over the rows."""
    orders = _t(spark, sf, "orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("periodo"), F.concat_ws("-", F.year("o_orderdate"), F.quarter("o_orderdate")).alias("trimestre"), "o_orderpriority", "o_totalprice")
    keys, shares = ["trimestre", "o_orderpriority"], {"p10": 0.1, "mediana": 0.5, "p90": 0.9}
    months = quantiles.by_period(orders, ["periodo", *keys], "o_totalprice")
    found = quantiles.quantiles(quantiles.merged(months, keys), shares)
    off = quantiles.off_by(orders, found, keys, "o_totalprice", shares)
    return found.join(off, keys).select(*keys, "observacoes", "minimo", "maximo", (F.col("desvio") <= 3 * quantiles.rank_error()).alias("dentro_do_erro"))


@query(f"{STAR} select substr(periodo, 1, 4) as ano, categoria_tecnologia, count(distinct contratacao_id) as contratacoes_distintas, count(distinct fornecedor_id) as fornecedores_distintos from related group by 1, 2")
def distintos_por_ano(spark, sf):
    """Bitmaps of months, put together by year."""
    related = _related(spark, sf)
    out, keys = None, ("ano", "categoria_tecnologia")
    for column, name in (("contratacao_id", "contratacoes_distintas"), ("fornecedor_id", "fornecedores_distintos")):
        months = bitmaps.by_period(related, ("periodo", "categoria_tecnologia"), column, bitmaps.dense_ids(related, column))
        years = bitmaps.counted(months.withColumn("ano", F.substring("periodo", 1, 4)), keys, name)
        out = years if out is None else out.join(years, list(keys))
    return out


@query(f"{STAR} select fornecedor_id, categoria_tecnologia, count(distinct orgao_id) as orgaos_distintos, count(distinct unidade_id) as unidades_distintas, count(distinct uf) as ufs_distintas, count(distinct municipio) as municipios_distintos, count(distinct modalidade_id) as modalidades_distintas, count(distinct periodo) as periodos_distintos, count(distinct contratacao_id) as contratacoes_distintas, 'publicada' as status_publicacao, 'presenca_restrita_a_resultados_homologados' as limitacao from related left join units using (unidade_id) group by 1, 2")
def presenca(spark, sf):
    return gold.supplier_presence(_related(spark, sf), _v(spark, sf, "units")[0]).drop("valor_total_homologado")


@query(f"{STAR} select orgao_id, fornecedor_id, categoria_tecnologia, count(distinct contratacao_id) as contratacoes_distintas, count(distinct resultado_id) as resultados_distintos, count(distinct periodo) as periodos_distintos, count(distinct modalidade_id) as modalidades_distintas, 'publicada' as status_publicacao, 'aresta_descritiva_nao_indica_irregularidade' as limitacao from related group by 1, 2, 3")
def rede(spark, sf):
    return gold.agency_supplier_edges(_related(spark, sf)).drop("valor_total_homologado")


@query(f"with {domain.ctes('awards', 'items', 'procurements')} select strftime(publicado_em, '%Y-%m') as periodo, categoria_tecnologia, unidade_medida, count(distinct resultado_id) as observacoes, quantile_disc(valor_unitario_homologado, 0.1) as p10, quantile_disc(valor_unitario_homologado, 0.5) as mediana, quantile_disc(valor_unitario_homologado, 0.9) as p90, min(valor_unitario_homologado) as minimo, max(valor_unitario_homologado) as maximo, false as comparabilidade_avaliada, 'nao_publicavel' as status_publicacao, 'comparabilidade_desabilitada_sem_especificacao_produto' as limitacao from awards join items using (item_id) join procurements using (contratacao_id) where not cancelado and material_ou_servico = 'M' and categoria_tecnologia <> 'incerto' and unidade_medida is not null and valor_unitario_homologado > 0 group by 1, 2, 3")
def variacao_precos(spark, sf):
    return gold.price_distribution(*_v(spark, sf, "items", "awards", "procurements"), exact=True)


@query()
def variacao_precos_approx(spark, sf):
    return gold.price_distribution(*_v(spark, sf, "items", "awards", "procurements"))


@query(f"with {domain.ctes('contracts', 'contract_events')}, s as (select contrato_id, count(distinct evento_contrato_id) as eventos_distintos, count(distinct tipo_evento) as tipos_evento_distintos, min(cast(data_assinatura as date)) as primeiro_evento_em, max(cast(data_assinatura as date)) as ultimo_evento_em, max(cast(vigencia_fim as date)) as vigencia_fim_eventos, sum(coalesce(variacao_valor, 0)) as v from contract_events group by 1) select contrato_id, orgao_codigo, fornecedor_id, cast(vigencia_inicio as date) as vigencia_inicio, cast(vigencia_fim as date) as vigencia_fim_original, valor_inicial, valor_global, coalesce(eventos_distintos, 0) as eventos_distintos, coalesce(tipos_evento_distintos, 0) as tipos_evento_distintos, primeiro_evento_em, ultimo_evento_em, vigencia_fim_eventos, round(coalesce(v, 0), 2) as variacao_valor_acumulada, greatest(cast(vigencia_fim as date), vigencia_fim_eventos) as vigencia_fim_atual, (case when vigencia_fim is not null then greatest(date_diff('day', cast(vigencia_fim as date), greatest(cast(vigencia_fim as date), vigencia_fim_eventos)), 0) end)::int as extensao_vigencia_dias, 'publicada' as status_publicacao, 'fonte_comprasnet_com_vinculo_pncp_nativo_parcial_c3' as limitacao from contracts left join s using (contrato_id)")
def evolucao_contratual(spark, sf):
    out = gold.contract_evolution(*_v(spark, sf, "contracts", "contract_events"))
    return _rounded(out, variacao_valor_acumulada=2)


# --- context ---


def _companies(spark: SparkSession, sf: str) -> DataFrame:
    raw = _t(spark, sf, "supplier").select(F.format_string("%08d", F.col("s_suppkey") + 10000000).alias("cnpj_basico"), F.concat(F.lit(" "), F.col("s_name")).alias("razao_social"), F.col("s_nationkey").cast("string").alias("natureza_juridica"), F.regexp_replace(F.format_string("%.2f", "s_acctbal"), "\\.", ",").alias("capital_social"), F.lit("05").alias("porte_empresa"))
    return context.companies(raw)


@query("select cast(s_suppkey + 10000000 as varchar) as cnpj_basico, s_name as razao_social_receita, cast(s_nationkey as varchar) as natureza_juridica, round(s_acctbal, 2) as capital_social, '05' as porte_empresa from supplier")
def ctx_empresas(spark, sf):
    return _companies(spark, sf).withColumn("capital_social", F.col("capital_social").cast("double"))


def _partners(spark: SparkSession, sf: str) -> DataFrame:
    raw = _t(spark, sf, "customer").select(F.format_string("%08d", F.col("c_nationkey") + 10000001).alias("cnpj_basico"), F.when(F.col("c_mktsegment") == "BUILDING", "1").when(F.col("c_mktsegment") == "MACHINERY", "3").otherwise("2").alias("tipo_socio"), F.format_string("20%02d0615", (F.col("c_custkey") % 25).cast("int")).alias("data_entrada_sociedade"))
    return context.partner_summary(raw)


@query("select cast(c_nationkey + 10000001 as varchar) as cnpj_basico, count(*) as registros_socios, count(case when c_mktsegment = 'BUILDING' then 1 end) as socios_pessoa_juridica, count(case when c_mktsegment not in ('BUILDING', 'MACHINERY') then 1 end) as socios_pessoa_fisica, count(case when c_mktsegment = 'MACHINERY' then 1 end) as socios_estrangeiros, max(make_date(2000 + cast(c_custkey % 25 as int), 6, 15)) as entrada_socio_mais_recente from customer group by 1")
def qsa_resumo(spark, sf):
    return _partners(spark, sf)


def _sanctions(spark: SparkSession, sf: str) -> DataFrame:
    raw = _t(spark, sf, "events").where("event_type in ('error', 'signup')").select(F.format_string("%014d", F.col("user_id") + 10000000).alias("cnpj_sancionado"), F.when(F.col("event_type") == "error", "CEIS").otherwise("CNEP").alias("cadastro"), (F.col("event_id") % 50).cast("string").alias("codigo_sancao"), F.date_format("ts", "dd/MM/yyyy").alias("data_inicio_sancao"), F.lit("").alias("data_final_sancao"))
    return context.sanctions(raw)


@query("select lpad(cast(user_id + 10000000 as varchar), 14, '0') as cnpj_sancionado, count(distinct event_id % 50) as sancoes_distintas, count(distinct case when event_type = 'error' then event_id % 50 end) as sancoes_ceis, count(distinct case when event_type = 'signup' then event_id % 50 end) as sancoes_cnep, max(cast(ts as date)) as sancao_inicio_mais_recente, cast(null as date) as sancao_final_mais_recente from events where event_type in ('error', 'signup') group by 1")
def sancoes(spark, sf):
    return _sanctions(spark, sf)


@query(f"with {domain.ctes('suppliers')}, q as (select cast(c_nationkey + 10000001 as varchar) as raiz, count(*) as n from customer group by 1), s as (select lpad(cast(user_id + 10000000 as varchar), 14, '0') as cnpj, count(distinct event_id % 50) as n from events where event_type in ('error', 'signup') group by 1), c as (select cast(s_suppkey + 10000000 as varchar) as raiz, s_name from supplier) select f.fornecedor_id, f.identificador_publico as cnpj, substr(f.identificador_publico, 1, 8) as cnpj_basico, s_name as razao_social_receita, coalesce(q.n, 0) as registros_socios, coalesce(s.n, 0) as sancoes_distintas, case when s_name is null then 0.0 else 1.0 end::double as cobertura_cnpj_receita, 'publicada' as status_publicacao from suppliers f left join q on q.raiz = substr(f.identificador_publico, 1, 8) left join s on s.cnpj = f.identificador_publico left join c on c.raiz = substr(f.identificador_publico, 1, 8) where length(f.identificador_publico) = 14")
def fornecedores_contexto(spark, sf):
    out = context.supplier_context(_v(spark, sf, "suppliers")[0], _companies(spark, sf), _partners(spark, sf), _sanctions(spark, sf))
    return out.select("fornecedor_id", "cnpj", "cnpj_basico", "razao_social_receita", "registros_socios", "sancoes_distintas", "cobertura_cnpj_receita", "status_publicacao")


@query("with m as (select strftime(o_orderdate, '%Y%m') as competencia, sum(cast(o_totalprice as decimal(18,2)))::double as numero_indice from orders group by 1) select competencia, round(numero_indice, 2) as numero_indice, round((select max(numero_indice) from m where competencia = '199612') / numero_indice, 6) as fator_para_referencia from m")
def ipca_factor(spark, sf):
    index = _t(spark, sf, "orders").groupBy(F.date_format("o_orderdate", "yyyyMM").alias("competencia")).agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("numero_indice"))
    return _rounded(context.price_factor(index, reference="199612"), numero_indice=2, fator_para_referencia=6)


@query("select fornecedor_id, max(nome) as nome_fornecedor from (select cast(s_suppkey as varchar) as fornecedor_id, s_name as nome from supplier union all select cast(c_custkey as varchar), c_name from customer) group by 1")
def union_suppliers(spark, sf):
    a = _t(spark, sf, "supplier").select(F.col("s_suppkey").cast("string").alias("fornecedor_id"), F.lit("1").alias("identificador_publico"), F.col("s_name").alias("nome_fornecedor"))
    b = _t(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("fornecedor_id"), F.lit("1").alias("identificador_publico"), F.col("c_name").alias("nome_fornecedor"))
    return context.united_suppliers(a, b).select("fornecedor_id", "nome_fornecedor")


@query(f"with {domain.ctes('contracts', 'items', 'contract_events')} select count(*) as contratos, count(case when contrato_id in (select contratacao_id from items where material_ou_servico = 'M') then 1 end) as contratos_com_itens, count(case when contrato_id in (select contrato_id from contract_events) then 1 end) as contratos_com_eventos, round(count(case when contrato_id in (select contratacao_id from items where material_ou_servico = 'M') then 1 end) / count(*), 6) as cobertura_itens, round(count(case when contrato_id in (select contrato_id from contract_events) then 1 end) / count(*), 6) as cobertura_eventos from contracts")
def contratos_cobertura(spark, sf):
    contracts, items, events = _v(spark, sf, "contracts", "items", "contract_events")
    return _rounded(context.contract_coverage(contracts, items.where("material_ou_servico = 'M'").select(F.col("contratacao_id").alias("contrato_id")), events), cobertura_itens=6, cobertura_eventos=6)


@query("select count(*) as consultadas, count(case when o_orderkey in (select l_orderkey from lineitem) then 1 end) as com_vinculo, round(count(case when o_orderkey in (select l_orderkey from lineitem) then 1 end) / count(*), 6) as taxa_vinculo from orders")
def link_coverage(spark, sf):
    linked = _t(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return _rounded(context.linked_share(_t(spark, sf, "orders"), linked, "o_orderkey"), taxa_vinculo=6)


@query("select count(*) as consultas, count(case when event_type = 'error' then 1 end) as erros, count(case when event_type = 'signup' then 1 end) as termos, count(distinct user_id) as contratos from events")
def capability_counts(spark, sf):
    return context.tallied(_t(spark, sf, "events"), {"erros": F.col("event_type") == "error", "termos": F.col("event_type") == "signup"}, distinct={"contratos": "user_id"})


# --- operations, benchmark, validation ---


@query(f"with {_ORPHANS}, c as (select 'itens_duplicados' as regra, 'erro' as severidade, (select count(*) from (select 1 from lineitem group by l_orderkey, l_linenumber having count(*) > 1)) as observados, (select count(*) from lineitem) as total union all select 'orfaos', 'alerta', (select count(*) from planted where o_orderkey not in (select l_orderkey from lineitem)), (select count(*) from planted) union all select 'cpf_publico', 'erro', 0, (select count(*) from supplier) union all select 'sem_dados', 'erro', 0, 0) select regra, severidade, observados::bigint as observados, total::bigint as total, case when total > 0 then round(100.0 * observados / total, 4) end as percentual, case when total = 0 then 'SEM_DADOS' when observados > 0 and severidade = 'erro' then 'FAIL' when observados > 0 then 'ALERT' else 'PASS' end as status from c")
def quality_rules(spark, sf):
    lines, suppliers, orders = _t(spark, sf, "lineitem"), _t(spark, sf, "supplier"), _with_orphans(spark, sf)
    people = suppliers.select(F.lit("PF").alias("tipo_pessoa"), F.lit(None).cast("string").alias("identificador_publico"))
    counts = quality.rule_counts({
        "itens_duplicados": (quality.duplicates(lines.select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("k")), "k"), lines, "erro"),
        "orfaos": (quality.orphans(orders, lines.withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey"), orders, "alerta"),
        "cpf_publico": (quality.leaked_numbers(people), suppliers, "erro"),
        "sem_dados": (orders.where("false"), orders.where("false"), "erro"),
    })
    return _rounded(quality.judged(counts).drop("limite"), percentual=4)


@query("select run_id, count(distinct source_file_id) as arquivos, sum(n)::bigint as linhas from (select distinct concat('run', cast(l_linenumber as varchar)) as run_id, cast(l_suppkey as varchar) as source_file_id, l_linenumber * 10 as n from lineitem) group by 1")
def run_summary(spark, sf):
    artifacts = _t(spark, sf, "lineitem").select(F.concat(F.lit("run"), F.col("l_linenumber").cast("string")).alias("run_id"), F.concat_ws("-", "l_linenumber", "l_suppkey").alias("artifact_id"), F.col("l_suppkey").cast("string").alias("source_file_id"), (F.col("l_linenumber") * 10).cast("long").alias("total_linhas"))
    return quality.run_summary(artifacts)


@query("with a as (select l_suppkey as f, count(*) as n from lineitem group by 1), b as (select l_partkey as f, count(*) as n from lineitem group by 1), m as (select f, max(n) as n from (select * from a union all select * from b) group by 1) select cast(s_suppkey as varchar) as source_file_id, coalesce(m.n, -1) as total_linhas from supplier left join m on m.f = s_suppkey")
def backfill_counts(spark, sf):
    lines = _t(spark, sf, "lineitem")
    counts = quality.row_counts(*(lines.select(F.col(c).cast("string").alias("_source_file_id")) for c in ("l_suppkey", "l_partkey")))
    artifacts = _t(spark, sf, "supplier").select(F.col("s_suppkey").cast("string").alias("source_file_id"), F.lit(-1).cast("long").alias("total_linhas"))
    return quality.backfill_counts(artifacts, counts)


_VALUE = "cast(valor_total_homologado as decimal(18,2))"


@query(f"with {domain.ctes('awards')} select count(*) as resultados, count(case when valor_total_homologado is null then 1 end) as sem_valor, count(case when valor_total_homologado <= 0 then 1 end) as nao_positivos, count(case when cancelado then 1 end) as cancelados, count(case when cancelado is null then 1 end) as cancelamento_desconhecido, round(sum({_VALUE})::double, 2) as valor_total, " + ", ".join(f"quantile_disc({_VALUE}, {p})::double as p{str(p)[2:]}" for p in (0.5, 0.9, 0.99, 0.999)) + " from awards")
def audit_values(spark, sf):
    out = quality.value_audit(_v(spark, sf, "awards")[0].withColumn("valor_total_homologado", F.col("valor_total_homologado").cast("decimal(18,2)")), exact=True)
    return _rounded(out, valor_total=2, p5=2, p9=2, p99=2, p999=2)


def benchmark_tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """The tables of the benchmark, with decimals."""
    out = {}
    for name, df in zip(benchmark.TABLES, _v(spark, sf, *benchmark.TABLES), strict=True):
        money = [c for c in ("valor_total", "valor_total_homologado") if c in df.columns]
        out[name] = df.withColumns({c: F.col(c).cast("decimal(18,2)") for c in money}) if money else df
    return out


_BENCH = f"with {domain.ctes('awards', 'items', 'links', 'agencies')}, r as (select item_id, count(distinct resultado_id) as n, sum(cast(valor_total_homologado as decimal(18,2))) as v from awards group by 1), g as (select d.orgao_id, coalesce(categoria_tecnologia, 'incerto') as categoria_tecnologia, count(*) as itens, sum(coalesce(r.n, 0))::bigint as resultados, sum(cast(valor_total as decimal(18,2))) as e, sum(coalesce(r.v, 0)) as h from items i join links d using (contratacao_id) join agencies o on o.orgao_id = d.orgao_id left join r on r.item_id = i.item_id group by 1, 2)"


@query(f"{_BENCH} select orgao_id, categoria_tecnologia, itens, resultados, e::double as valor_estimado, h::double as valor_homologado from g")
def bench_agg(spark, sf):
    return _rounded(benchmark.grouped(benchmark_tables(spark, sf)), valor_estimado=2, valor_homologado=2)


@query(f"{_BENCH} select count(*) as grupos, sum(itens)::bigint as itens, sum(resultados)::bigint as resultados, sum(e)::double as valor_estimado, sum(h)::double as valor_homologado, sha256(string_agg(concat_ws('|', orgao_id, categoria_tecnologia, cast(itens as varchar), cast(resultados as varchar), cast(cast(e as decimal(38,2)) as varchar), cast(cast(h as decimal(38,2)) as varchar)), '||' order by concat_ws('|', orgao_id, categoria_tecnologia, cast(itens as varchar), cast(resultados as varchar), cast(cast(e as decimal(38,2)) as varchar), cast(cast(h as decimal(38,2)) as varchar)))) as checksum_resultado from g")
def bench_checksum(spark, sf):
    return _rounded(benchmark.summary(benchmark.grouped(benchmark_tables(spark, sf))), valor_estimado=2, valor_homologado=2)


_COUNTS = {"pedidos": ("orders", "o_orderkey"), "linhas": ("lineitem", "l_orderkey"), "clientes": ("customer", "c_custkey"), "fornecedores": ("supplier", "s_suppkey")}


@query(" union all ".join(f"select '{n}' as tabela, count(*) as linhas from {t}" for n, (t, _) in _COUNTS.items()))
def val_counts(spark, sf):
    return validation.row_counts({n: _t(spark, sf, t) for n, (t, _) in _COUNTS.items()})


@query("select 'pedidos' as tabela, strftime(min(o_orderdate), '%Y-%m-%d') as primeiro, strftime(max(o_orderdate), '%Y-%m-%d') as ultimo from orders union all select 'linhas', strftime(min(l_shipdate), '%Y-%m-%d'), strftime(max(l_shipdate), '%Y-%m-%d') from lineitem")
def val_bounds(spark, sf):
    return validation.time_bounds({n: (_t(spark, sf, t), c) for t, c, n in (("orders", "o_orderdate", "pedidos"), ("lineitem", "l_shipdate", "linhas"))}).drop("linhas")


@query(" union all ".join(f"select '{n}' as tabela, count(*) as linhas, count(distinct {k}) as chaves from {t}" for n, (t, k) in _COUNTS.items()))
def val_uniqueness(spark, sf):
    return validation.uniqueness({n: (_t(spark, sf, t), k) for n, (t, k) in _COUNTS.items()}).drop("duplicadas")


@query(f"with {_ORPHANS} select 'linhas' as tabela, count(case when o_orderkey is null then 1 end) as orfaos from lineitem left join orders on l_orderkey = o_orderkey union all select 'pedidos', count(case when c_custkey is null then 1 end) from planted left join customer on o_custkey = c_custkey")
def val_ref_integrity(spark, sf):
    lines, orders, customers = _t(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey"), _with_orphans(spark, sf), _t(spark, sf, "customer")
    return validation.orphan_counts({"linhas": (lines, orders, "o_orderkey"), "pedidos": (orders, customers.withColumnRenamed("c_custkey", "o_custkey"), "o_custkey")})


@query("select event_type as regra, count(*) as linhas from events where user_id = (select user_id from events order by ts desc, event_id desc limit 1) group by 1 order by 1")
def val_last_run(spark, sf):
    last = validation.last_run(_t(spark, sf, "events"), "user_id", "ts", "event_id")
    return last.groupBy(F.col("event_type").alias("regra")).agg(F.count("*").alias("linhas")).orderBy("regra")


@query("select status_publicacao, limitacao, count(*) as linhas from (" + _concentration_sql(True) + ") group by 1, 2")
def val_status_counts(spark, sf):
    return validation.status_counts({"concentracao": _concentration(spark, sf, True)}, ("status_publicacao", "limitacao")).drop("tabela")


@query("with n as (select l_suppkey, count(*) as n from lineitem group by 1) select quantile_disc(n, 0.5)::bigint as p50, quantile_disc(n, 0.95)::bigint as p95, quantile_disc(n, 0.99)::bigint as p99, max(n)::bigint as maximo from n")
def val_skew(spark, sf):
    return validation.group_sizes(_t(spark, sf, "lineitem"), "l_suppkey", exact=True)


@query(f"with {domain.ctes('contracts', 'items', 'contract_events')} select 'contratos' as tabela, 'contrato_id' as coluna, true as permitida union all select 'contratos', c, c <> 'fornecedor_id' from (values ('orgao_codigo'), ('fornecedor_id'), ('vigencia_inicio'), ('vigencia_fim'), ('valor_inicial'), ('valor_global')) v(c)")
def val_columns(spark, sf):
    return validation.published_columns({"contratos": _v(spark, sf, "contracts")[0]}, ("fornecedor_id",))
