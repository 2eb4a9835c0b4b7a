"""Company, partner and sanction context of suppliers, and the price-index factor."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veraz.functions.expr import digits, optional, ratio, text
from veraz.operators.bloom import semi_join
from veraz.operators.versioning import latest
from veraz.sources.zipped import read_zipped_csv

# The columns of the company registry; of the partner registry, those that are kept and their places
# among its eleven (names and numbers of persons are in the others); of the sanction lists, the places from 0.
# CNEP has the fine in place 10, so that everything from there on stands one place further than in CEIS.
COMPANY_FIELDS = ("cnpj_basico", "razao_social", "natureza_juridica", "qualificacao_responsavel", "capital_social", "porte_empresa", "ente_federativo_responsavel")
PARTNER_WIDTH = 11
PARTNER_PLACES = {"cnpj_basico": 0, "tipo_socio": 1, "qualificacao_socio": 4, "data_entrada_sociedade": 5, "pais": 6, "qualificacao_representante": 9, "faixa_etaria": 10}
SANCTION_WIDTH = {"CEIS": 24, "CNEP": 25}
SANCTION_PLACES = {
    "codigo_sancao": 1, "cnpj_sancionado": 3, "categoria_sancao": 9, "data_inicio_sancao": 10, "data_final_sancao": 11, "data_publicacao": 12,
    "abrangencia_sancao": 16, "orgao_sancionador": 17, "uf_orgao_sancionador": 18, "esfera_orgao_sancionador": 19, "data_origem_informacao": 21,
}
SHIFTED_FROM, FINE_PLACE = 10, 10
SANCTION_FIELDS = ("cadastro", "codigo_sancao", "cnpj_sancionado", "categoria_sancao", "valor_multa", "data_inicio_sancao", "data_final_sancao", "data_publicacao", "abrangencia_sancao", "orgao_sancionador", "uf_orgao_sancionador", "esfera_orgao_sancionador", "data_origem_informacao")

ZERO_FILLED = ("registros_socios", "socios_pessoa_juridica", "socios_pessoa_fisica", "socios_estrangeiros", "sancoes_distintas", "sancoes_ceis", "sancoes_cnep")


def with_digits(df: DataFrame, name: str, length: int) -> DataFrame:
    """Rows whose column has so many digits, with the column reduced to them."""
    return df.withColumn(name, digits(F.col(name))).where(F.length(name) == length)


def _day(c: Column, pattern: str) -> Column:
    return F.to_date(F.try_to_timestamp(c, F.lit(pattern)))


def companies(raw: DataFrame) -> DataFrame:
    """Companies by the eight-digit root. A root that occurs twice keeps one row, so that joining
    companies to suppliers makes no rows."""
    typed = raw.select(
        F.col("cnpj_basico"), text(raw, "razao_social").alias("razao_social_receita"), text(raw, "natureza_juridica").alias("natureza_juridica"),
        F.regexp_replace("capital_social", ",", ".").try_cast("decimal(38,2)").alias("capital_social"), text(raw, "porte_empresa").alias("porte_empresa"),
    )
    return latest(with_digits(typed, "cnpj_basico", 8), "cnpj_basico", ("capital_social",))


def partner_summary(raw: DataFrame) -> DataFrame:
    typed = with_digits(raw.select("cnpj_basico", text(raw, "tipo_socio").alias("_kind"), _day(F.col("data_entrada_sociedade"), "yyyyMMdd").alias("_since")), "cnpj_basico", 8)
    kind = lambda k: F.sum(F.when(F.col("_kind") == k, 1).otherwise(0))
    return typed.groupBy("cnpj_basico").agg(F.count("*").alias("registros_socios"), kind("1").alias("socios_pessoa_juridica"), kind("2").alias("socios_pessoa_fisica"), kind("3").alias("socios_estrangeiros"), F.max("_since").alias("entrada_socio_mais_recente"))


def sanctions(raw: DataFrame) -> DataFrame:
    typed = with_digits(raw.select("cnpj_sancionado", text(raw, "cadastro").alias("_list"), text(raw, "codigo_sancao").alias("_code"), _day(F.col("data_inicio_sancao"), "dd/MM/yyyy").alias("_from"), _day(F.col("data_final_sancao"), "dd/MM/yyyy").alias("_to")), "cnpj_sancionado", 14)
    listed = lambda k: F.count_distinct(F.when(F.col("_list") == k, F.col("_code")))
    return typed.groupBy("cnpj_sancionado").agg(F.count_distinct("_code").alias("sancoes_distintas"), listed("CEIS").alias("sancoes_ceis"), listed("CNEP").alias("sancoes_cnep"), F.max("_from").alias("sancao_inicio_mais_recente"), F.max("_to").alias("sancao_final_mais_recente"))


def supplier_context(suppliers: DataFrame, companies: DataFrame, partners: DataFrame, sanctions: DataFrame) -> DataFrame:
    """Suppliers with a 14-digit public number, one row each, with what the registries say."""
    own = with_digits(suppliers.select("fornecedor_id", F.col("identificador_publico").alias("cnpj"), "nome_fornecedor"), "cnpj", 14)
    own = latest(own, "fornecedor_id", ("cnpj",)).withColumn("cnpj_basico", F.substring("cnpj", 1, 8))
    joined = own.join(companies, "cnpj_basico", "left").join(partners, "cnpj_basico", "left").join(sanctions, own["cnpj"] == sanctions["cnpj_sancionado"], "left").drop("cnpj_sancionado")
    return joined.fillna(0, list(ZERO_FILLED)).withColumns({
        "cobertura_cnpj_receita": F.col("razao_social_receita").isNotNull().cast("double"),
        "status_publicacao": F.lit("publicada"),
        "interpretacao": F.lit("contexto_cadastral_nao_indica_irregularidade"),
    })


def united_suppliers(*tables: DataFrame) -> DataFrame:
    """Suppliers of several sources, one row for each id."""
    first, *rest = (t.select("fornecedor_id", "identificador_publico", "nome_fornecedor") for t in tables)
    for t in rest:
        first = first.unionByName(t)
    return latest(first, "fornecedor_id", ("identificador_publico", "nome_fornecedor"))


def minimised(raw: DataFrame, wanted: DataFrame, key: str, keep: list[str], length: int) -> DataFrame:
    """Registry rows whose key (its first digits) is wanted, with only the columns in ``keep``:
    names and numbers of natural persons never leave the source."""
    rows = raw.select(F.substring(digits(F.col(key)), 1, length).alias(key), *(c for c in keep if c != key))
    return semi_join(rows, key, wanted.select(F.substring(digits(F.col(wanted.columns[0])), 1, length).alias("cnpj")))


def _placed(width: int, places: dict[str, int]) -> list[str]:
    """Names for all columns of a headerless file: those that are kept by name, the others by place."""
    names = {i: c for c, i in places.items()}
    return [names.get(i, f"_{i}") for i in range(width)]


def _whole_numbers(suppliers: DataFrame, column: str, length: int) -> DataFrame:
    """The distinct beginnings of 14-digit public numbers; others, such as those of persons, are left out."""
    return with_digits(suppliers.select(F.col(column).alias("cnpj")), "cnpj", 14).select(F.substring("cnpj", 1, length).alias("cnpj")).distinct()


def company_registry(spark: SparkSession, path: str, suppliers: DataFrame, column: str = "identificador_publico") -> DataFrame:
    """Companies of the suppliers, from zipped registry files (seven columns, no header)."""
    rows = read_zipped_csv(spark, path, list(COMPANY_FIELDS), list(COMPANY_FIELDS))
    return semi_join(rows, "cnpj_basico", _whole_numbers(suppliers, column, 8))


def partner_registry(spark: SparkSession, path: str, suppliers: DataFrame, column: str = "identificador_publico") -> DataFrame:
    """Partners of the suppliers, from zipped registry files (eleven columns, no header). Names and
    numbers of persons don't leave the reader. registro_origem_id tells the rows apart by what is kept."""
    keep = list(PARTNER_PLACES)
    rows = read_zipped_csv(spark, path, _placed(PARTNER_WIDTH, PARTNER_PLACES), keep, number="registro_origem_id")
    kept = semi_join(rows, "cnpj_basico", _whole_numbers(suppliers, column, 8))
    return kept.select("registro_origem_id", *keep)


def sanction_registry(spark: SparkSession, path: str, listed_in: str, suppliers: DataFrame, column: str = "identificador_publico") -> DataFrame:
    """Sanctions of the suppliers, from a zipped list with a header; CNEP adds a fine, which CEIS hasn't.
    Names don't leave the reader."""
    name = listed_in.upper()
    if name not in SANCTION_WIDTH:
        raise ValueError(f"not a list of sanctions: {listed_in}")
    shift = int(name == "CNEP")
    places = {c: i + shift * (i >= SHIFTED_FROM) for c, i in SANCTION_PLACES.items()} | ({"valor_multa": FINE_PLACE} if shift else {})
    rows = read_zipped_csv(spark, path, _placed(SANCTION_WIDTH[name], places), list(places), header=True)
    own = rows.withColumns({"cnpj_sancionado": digits(F.col("cnpj_sancionado")), "cadastro": F.lit(name)})
    if not shift:
        own = own.withColumn("valor_multa", F.lit(""))
    return semi_join(own, "cnpj_sancionado", _whole_numbers(suppliers, column, 14)).select(*SANCTION_FIELDS)


def index_factor(index: DataFrame, reference: str) -> DataFrame:
    """The price index with the factor to its highest value and the period that is named as reference."""
    return price_factor(index).withColumn("periodo_referencia", F.lit(reference))


def coverage_share(counted: DataFrame, part: str, whole: str, name: str) -> DataFrame:
    """Adds a share of two counts, 0.0 without any."""
    return counted.withColumn(name, ratio(F.col(part), F.col(whole)))


def linked_share(asked: DataFrame, linked: DataFrame, key: str) -> DataFrame:
    """One row: how many keys were asked for (consultadas), how many have a link (com_vinculo) and their share."""
    marks = linked.select(key).distinct().withColumn("_linked", F.lit(1))
    counted = asked.select(key).join(marks, key, "left").agg(F.count("*").alias("consultadas"), F.count("_linked").alias("com_vinculo"))
    return coverage_share(counted, "com_vinculo", "consultadas", "taxa_vinculo")


def tallied(rows: DataFrame, kinds: dict[str, Column], whole: str = "consultas", distinct: dict[str, str] | None = None) -> DataFrame:
    """One row: all rows, those of each kind, and distinct values of columns."""
    return rows.agg(F.count("*").alias(whole), *(F.count_if(c).alias(n) for n, c in kinds.items()), *(F.count_distinct(c).alias(n) for n, c in (distinct or {}).items()))


def price_factor(index: DataFrame, value: str = "numero_indice", reference: str | None = None, period: str = "competencia") -> DataFrame:
    """Adds fator_para_referencia: the index of the reference period (or the highest) over each index."""
    basis = index.where(F.col(period) == reference) if reference else index
    top = basis.agg(F.max(value).alias("_top"))
    return index.crossJoin(F.broadcast(top)).withColumn("fator_para_referencia", F.col("_top") / F.col(value)).drop("_top")  # one row


def contract_coverage(contracts: DataFrame, items: DataFrame, events: DataFrame) -> DataFrame:
    """One row: contracts, those with items and with events, and their shares (0.0 without contracts)."""
    marks = [t.select("contrato_id").distinct().withColumn(m, F.lit(1)) for t, m in ((items, "_i"), (events, "_e"))]
    counted = contracts.select("contrato_id").distinct().join(marks[0], "contrato_id", "left").join(marks[1], "contrato_id", "left").agg(F.count("*").alias("contratos"), F.count("_i").alias("contratos_com_itens"), F.count("_e").alias("contratos_com_eventos"))
    share = lambda c: F.when(F.col("contratos") > 0, F.col(c).cast("double") / F.col("contratos")).otherwise(0.0)
    return counted.withColumns({"cobertura_itens": share("contratos_com_itens"), "cobertura_eventos": share("contratos_com_eventos")})


def municipalities(raw: DataFrame) -> DataFrame:
    """Municipalities from nested JSON."""
    state = "microrregiao.mesorregiao.UF"
    return raw.select(F.col("id").cast("string").alias("codigo_ibge"), F.col("nome").alias("municipio"), F.col(f"{state}.sigla").alias("uf"), F.col(f"{state}.regiao.sigla").alias("regiao"))


def price_index(raw: DataFrame) -> DataFrame:
    """Monthly index values from string columns (D3C, V); other rows are left out."""
    return raw.where(F.col("D3C").rlike(r"^\d{6}$")).select(F.col("D3C").alias("competencia"), optional(raw, "V").try_cast("decimal(18,6)").alias("numero_indice")).where(F.col("numero_indice").isNotNull())
