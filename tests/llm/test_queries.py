"""Registered queries against their SQL, and the pipeline stage by stage."""

import os

import corpus_pipeline
import duckdb
import pytest
from harness import integers_are_long, oracle_rows, spark_rows
from treelens.llm.queries import ORACLES, QUERIES

SF_DIR = os.environ.get("TREELENS_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    df = QUERIES[name](spark, SF_DIR)
    assert integers_are_long(df.drop("rank"))  # a small number by contract
    assert spark_rows(df) == oracle_rows(con, ORACLES[name])


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, before = docs.columns, docs.count()
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR).cache()
        assert docs.count() <= before
        before = docs.count()
        if name != names[-1]:
            assert docs.columns == columns
        if name == "line_dedup":
            assert docs.filter("n_chars <> length(text)").count() == 0
        assert docs.select("doc_id").distinct().count() == before
    assert corpus_pipeline.run(spark, SF_DIR).count() == before
