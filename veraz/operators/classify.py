"""Classification of item descriptions by ordered tables of prefix patterns; the first match wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veraz.functions.expr import first_reason, fold

# The published taxonomies. Equipment is matched in lower case with accents.
EQUIPMENT = (
    ("computador_notebook", r"^(notebook|computador\b|desktop\b|microcomputador\b)"),
    ("monitor", r"^monitor\s+(de\s+vídeo|vídeo|imagem|lcd|led|computador)"),
    ("impressora_scanner", r"^(impressora|scanner|multifuncional)\b"),
    ("servidor", r"^servidor\b"),
    ("equipamento_rede", r"^(switch|roteador|access point|comutador)\b"),
)
# Services are matched without accents.
SERVICES = (
    ("cloud", r"^(software como servico\s*-?\s*saas|servicos? de computacao em nuvem|computacao em nuvem|infraestrutura como servico|plataforma como servico|servicos? em nuvem|servicos? especializados de disponibilizacao de copias de seguranca de dados)\b"),
    ("licenciamento", r"^(cessao temporaria de direitos sobre programas? de computador|licenciamento de direitos|licen(?:ca|ciamento) de (?:uso de )?(?:software|programas? de computador)|subscricao de software)\b"),
    ("desenvolvimento", r"^(desenvolvimento de novo software|servicos? de desenvolvimento de (?:software|sistemas?|aplicativos?)|fabrica de software)\b"),
    ("outsourcing", r"^outsourcing (?:de impressao|de ti|de tecnologia|de infraestrutura|de servicos?)\b"),
    ("suporte", r"^(servicos? de suporte tecnico (?:de|em) (?:tecnologia da informacao|tic|informatica)|suporte tecnico (?:de|em) (?:tecnologia da informacao|tic|informatica)|manutencao (?:evolutiva )?de software|servicos? de manutencao e reparacao de computadores)\b"),
    ("infraestrutura", r"^(outros servicos para a infraestrutura de tecnologia da informacao e comunicacao|servicos? de gerenciamento de infraestrutura de tecnologia da ?informacao|servicos? de hospedagem de sistemas|servicos? de data ?center|servico de infraestrutura de redes? de comunicacao de dados|instalacao de cabeamento estruturado|servico de instalacao.{0,80}manutencao de rede local de computadores)\b"),
)
UNKNOWN = "incerto"


def by_rules(text: Column, rules: tuple[tuple[str, str], ...]) -> Column:
    """The first rule that matches. One pattern of all rules comes first, as most texts match none."""
    matches_any = text.rlike("|".join(f"(?:{pattern})" for _, pattern in rules))
    return F.when(matches_any, first_reason((name, text.rlike(pattern)) for name, pattern in rules))


def equipment(items: DataFrame, rules: tuple[tuple[str, str], ...] = EQUIPMENT) -> DataFrame:
    """Adds categoria_tecnologia (materials only, else ``incerto``) and versao_regra."""
    texts = items.withColumn("_texto", F.when(F.col("material_ou_servico") == "M", F.lower("descricao")))  # once, not for each rule
    return texts.withColumns({"categoria_tecnologia": F.coalesce(by_rules(F.col("_texto"), rules), F.lit(UNKNOWN)), "versao_regra": F.lit("equipamentos_v2")}).drop("_texto")


def services(items: DataFrame, rules: tuple[tuple[str, str], ...] = SERVICES) -> DataFrame:
    """Adds categoria_servico (services only), its price status and reason, and names the
    technology category after a service that is known."""
    service = F.col("material_ou_servico") == "S"
    texts = items.withColumn("_texto", F.when(service, fold(F.col("descricao"))))
    items = texts.withColumn("categoria_servico", F.when(service, F.coalesce(by_rules(F.col("_texto"), rules), F.lit(UNKNOWN)))).drop("_texto")
    known = F.col("categoria_servico") != UNKNOWN
    return items.withColumns(
        {
            "categoria_tecnologia": F.when(known, F.concat(F.lit("servico_"), "categoria_servico")).otherwise(F.col("categoria_tecnologia")),
            "status_preco_servico": F.when(known, "nao_publicavel").when(service, "fora_escopo"),
            "motivo_preco_servico": F.when(known, "escopo_unidade_sla_nao_estruturados").when(service, "familia_nao_identificada"),
            "versao_regra_servico": F.lit("servicos_v1"),
        }
    )
