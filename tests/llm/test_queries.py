"""The registered queries: contract columns, agreement with SQL, and the pipeline."""

from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from tests.conftest import TESTDATA
from tests.llm.test_jaccard import brute
from tests.llm.test_text_operators import brute_spans
from veraz.llm import packing, quality_classifier, quality_rules, queries

TABLES = ("documents", "labels", "conversations", "embeddings")


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{TESTDATA}/{t}.parquet'")
    result = con.execute(queries.ORACLE_SQL[name])
    names = [d[0] for d in result.description]
    df = queries.QUERIES[name](spark, TESTDATA)
    assert sorted(names) == sorted(df.columns)
    assert Counter(tuple(r[c] for c in names) for r in df.collect()) == Counter(result.fetchall())


def test_registered():
    assert {f"op{n}_" for n in range(1, 14)} == {k.partition("_")[0] + "_" for k in __spark_entry__.queries() if k.startswith("op")}
    assert "pipeline" in __spark_entry__.queries()
    assert [k for k, _ in corpus_pipeline.STAGES] == ["quality_rules", "quality_classifier", "ngram_jaccard_join", "secret_scan", "best_fit_packing"]


def test_pipeline_stages(spark):
    """Each stage's output against what its operator or brute force says of its input."""
    docs = spark.read.parquet(f"{TESTDATA}/documents.parquet")
    columns = docs.columns
    table = {r.doc_id: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, TESTDATA).cache()
        assert out.columns == columns
        got = {r.doc_id: r for r in out.collect()}
        if name == "quality_rules":
            assert set(got) == {r.doc_id for r in quality_rules.judge(docs).collect() if r.kept}
        elif name == "quality_classifier":
            labels = spark.read.parquet(f"{TESTDATA}/labels.parquet")
            w = quality_classifier.train(docs, labels, usable=~quality_classifier.held_out())
            assert set(got) == {r.doc_id for r in quality_classifier.score(docs, w).collect() if r.score >= 0.3}
        elif name == "ngram_jaccard_join":
            assert set(got) == {i for i, (_, c) in brute([(r.doc_id, r.text) for r in table.values()]).items() if i == c}
        else:
            for i, r in table.items():
                text, at, parts = r.text, 0, []
                for a, _, b in brute_spans(text):
                    if a >= at:
                        parts += [text[at:a], "[SECRET]"]
                    at = max(at, b)
                assert got[i].text == "".join([*parts, text[at:]]) and got[i].n_chars == (len(got[i].text) if parts else r.n_chars)
        docs, table = out, got
    packed = corpus_pipeline.STAGES[4][1](spark, docs, TESTDATA).collect()
    assert {r.doc_id for r in packed} == set(table)
    assert Counter((r.doc_id, r.piece, r.ids) for r in packed) == Counter((r.doc_id, r.piece, r.ids) for r in packing.pack(docs, queries.WORD_BPE).collect())
    assert {r.doc_id for r in corpus_pipeline.run(spark, TESTDATA).collect()} == set(table)


def test_pipeline_stages_on_odd_rows(spark):
    """Null and repeated ids, null texts, clashing columns and empty tables: verdicts are those of each row."""
    docs = spark.read.parquet(f"{TESTDATA}/documents.parquet")
    numbered = docs.withColumn("kept", F.col("doc_id"))  # tells the rows apart in this test
    odd = numbered.withColumn("doc_id", F.when(F.col("doc_id") % 3 == 0, F.lit(None).cast("long")).when(F.col("doc_id") % 3 == 1, F.lit(5).cast("long")).otherwise(F.col("doc_id")))
    odd = odd.unionByName(odd.where("kept < 3").withColumn("text", F.lit(None).cast("string"))).withColumns({"_row": F.lit("x"), "score": F.lit(1), "_gone": F.lit(2)})
    plain, strange = docs, odd
    for name, stage in corpus_pipeline.STAGES[:2]:
        got, want = stage(spark, strange, TESTDATA), {r.doc_id for r in stage(spark, plain, TESTDATA).collect()}
        assert got.columns == odd.columns, name
        if name == "quality_rules":
            assert Counter(r.kept for r in got.collect()) == Counter(want)
        assert stage(spark, odd.limit(0), TESTDATA).count() == 0
    jaccard_stage, secrets, pack = (f for _, f in corpus_pipeline.STAGES[2:])
    distinct = odd.where("text is not null")
    left = jaccard_stage(spark, distinct, TESTDATA)
    groups = brute([(r.kept, r.text) for r in distinct.collect()])
    kept = {r.kept for r in left.collect()}
    assert left.columns == odd.columns and {groups[k][1] for k in kept} == {c for _, c in groups.values()} and len(kept) == len({c for _, c in groups.values()})
    assert secrets(spark, odd, TESTDATA).count() == odd.count() and pack(spark, odd, TESTDATA).count() >= odd.count()
    for f in (jaccard_stage, secrets, pack):
        assert f(spark, odd.limit(0), TESTDATA).count() == 0
