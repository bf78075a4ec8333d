"""Corpus queries that SQL can express, against their SQL; and the pipeline's laws."""

import pytest

import __spark_entry__
from fareloom.llm.oracle import ORACLE
from suite.compare import differences, oracle_connection

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_oracle(spark, name):
    result = __spark_entry__.queries()[name](spark, SF)
    assert differences(result, oracle_connection(SF), __spark_entry__.oracle_sql()[name]) == []


def test_pipeline_takes_awkward_rows(spark, docs, tmp_path):
    import corpus_pipeline

    columns = docs.withColumn("n_chars", docs.doc_id).select(*corpus_pipeline.COLUMNS)
    columns.write.parquet(f"{tmp_path}/documents.parquet")
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    kept = {row.doc_id for row in rows}
    assert {10, 11, 12, 13, 14} <= kept and not kept & {0, 1, 2, 3, 30, 31, 33, 50, 52}
    # 32 lies five bits from 12: no copy to the fingerprints, but its repeated words go.
    assert sum(row.length for row in rows if row.doc_id == 32) < 5
    columns.limit(0).write.parquet(f"{tmp_path}/empty/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/empty").count() == 0
