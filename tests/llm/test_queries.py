import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from graphtide.llm.common import fold
from graphtide.llm.queries import ORACLE, REGISTRY
from tests.compare import compare, connect

HELD_OUT = {"op1_quality": (4, 2), "op2_toxicity": (3, 1), "op7_language": (3, 1)}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_agrees_with_sql(spark, sf_dir, name):
    assert compare(REGISTRY[name](spark, sf_dir), connect(sf_dir), ORACLE[name]) is None


@pytest.mark.parametrize("name", sorted(set(REGISTRY) - set(ORACLE)))
def test_query_returns_a_row_for_each_row(spark, sf_dir, name):
    table, key = ("pages", "page_id") if name.startswith("op3") else ("documents", "doc_id")
    ids = spark.read.parquet(f"{sf_dir}/{table}.parquet").select(key)
    got = REGISTRY[name](spark, sf_dir)
    assert sorted(r[0] for r in got.select(key).collect()) == sorted(r[0] for r in ids.collect())
    if name in HELD_OUT:
        parts, out = HELD_OUT[name]
        assert got.where(F.col("held_out") != (fold(F.col(key), parts) == out)).count() == 0


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (None, "", "en", "s", 0), (7, "", "en", "s", 0)], docs.schema)
    docs = docs.union(odd).withColumns({"score": F.lit("own"), "kept": F.lit(1), "contaminated": F.lit("no")})
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = docs.count()
        docs = stage(spark, docs, sf_dir)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        assert 0.7 * before < docs.count() <= before, name
        assert docs.columns[: len(columns)] == columns, name
    assert docs.where("score <> 'own' or kept <> 1").count() == 0
    assert corpus_pipeline.ORACLE_SQL is None and [n for n, _ in corpus_pipeline.STAGES][-1] == "mixing"
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.select(columns).where("false"), sf_dir).count() == 0
