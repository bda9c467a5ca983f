import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from netwatch.llm import catalog, decontamination, quality_rules
from tools.parity import TABLES, compare

ROOT = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_matches_its_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{ROOT}/{t}.parquet')")
    df = contract.queries()[name](spark, ROOT)
    res = con.execute(contract.oracle_sql()[name])
    assert compare([tuple(r) for r in df.collect()], df.columns, res.fetchall(), [d[0] for d in res.description]) is None


def test_ten_queries_and_the_pipeline_are_registered():
    names = contract.queries()
    for n in range(1, 11):
        assert sum(k.startswith(f"op{n}_") for k in names) == 1
    assert "pipeline" in names


def test_stages_hand_on_documents(spark):
    docs = spark.read.parquet(f"{ROOT}/documents.parquet").withColumn("__q", F.lit(1)).withColumn("copies", F.lit("c"))
    bench = spark.read.parquet(f"{ROOT}/benchmark.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, ROOT)
        assert after.columns == docs.columns, name
        ids = {r.doc_id for r in after.select("doc_id").collect()}
        had = {r.doc_id for r in before.select("doc_id").collect()}
        assert ids <= had and ids
        if name == "quality_rules":
            kept = quality_rules.quality_rules(before).filter("kept")
            assert ids == {r.doc_id for r in kept.collect()}
        if name == "decontamination":
            bad = {r.doc_id for r in decontamination.contaminated(before, bench).collect()}
            assert ids == had - bad
        before = spark.createDataFrame(after.collect(), docs.schema)
    last = corpus_pipeline.STAGES[-1][1](spark, before, ROOT).collect()
    assert sorted(r.doc_id for r in last) == sorted(r.doc_id for r in before.collect())
    assert sorted(map(tuple, corpus_pipeline.run(spark, ROOT).collect())) == sorted(map(tuple, last))


def test_pipeline_of_an_empty_table(spark):
    docs = spark.read.parquet(f"{ROOT}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, ROOT)
        assert out.collect() == []
