"""The corpus pipeline: five stages from raw documents to packed sequences.

Each stage takes (spark, docs, sf_dir) and returns a table; all but the last return the columns of
``documents``. Stages work on whole tables and whole texts, and their intermediate tables lie in
the folder that spark.checkpoint.dir names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veraz.llm import jaccard, packing, quality_classifier, quality_rules, secret_scan
from veraz.llm.queries import WORD_BPE
from veraz.llm.shared import checkpoint, drop, written

#: Ids up to which they are broadcast (some 24 MB); more go through a shuffled join.
BROADCAST_IDS = 1_000_000


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules or the perplexity band of their language reject go."""
    return quality_rules.kept_rows(docs)


def quality_classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score below 0.3 go. The model learns from the labelled rows of the training folds."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    weights = quality_classifier.train(docs, labels, usable=~quality_classifier.held_out())
    return quality_classifier.scored(docs, weights, score_col="_score").where(F.col("_score") >= 0.3).select(docs.columns)


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """The documents and the column that tells their rows apart: doc_id, or where ids are null or
    occur twice a number that is written with the rows."""
    if not docs.groupBy("doc_id").count().where("count > 1 or doc_id is null").limit(1).count():
        return docs, "doc_id"
    return written(docs.withColumn("_row", F.monotonically_increasing_id())), "_row"


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, the document with the smallest id stays."""
    rows, key = _numbered(docs)
    gone = checkpoint(jaccard.join(rows, key).where(F.col(key) != F.col("component_id")).select(F.col(key).alias("_gone")))
    if gone.count() <= BROADCAST_IDS:
        gone = F.broadcast(gone)
    return rows.join(gone, rows[key] == gone["_gone"], "left_anti").select(docs.columns)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; n_chars follows the text."""
    scanned = secret_scan.scan(docs).withColumn("text", secret_scan.redacted())
    return scanned.withColumn("n_chars", F.when(F.size("secret_spans") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 4096 tokens."""
    return packing.pack(docs, WORD_BPE)


STAGES = [
    ("quality_rules", quality_rules_stage),
    ("quality_classifier", quality_classifier_stage),
    ("ngram_jaccard_join", jaccard_stage),
    ("secret_scan", secrets_stage),
    ("best_fit_packing", packing_stage),
]

#: Models, tokenizers and components have no SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next; what a stage has
    read is deleted once its successor is written."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    *first, (_, last) = STAGES
    for _, stage in first:
        docs = written(stage(spark, docs, sf_dir))
        if before is not None:
            drop(before)
        before = docs
    return last(spark, docs, sf_dir)
