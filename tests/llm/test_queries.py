"""Registered queries against DuckDB on the given tables, and the pipeline's stages."""

import pytest

import corpus_pipeline
from harborline.llm import queries
from harborline.llm.common import stored, table
from tests.oracle_check import connect, difference


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, sf_dir, name):
    assert difference(queries.queries()[name](spark, sf_dir), connect(sf_dir), queries.SQL[name]) is None


def test_pipeline_stages(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    columns, sizes = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
        if name != "packing":
            assert docs.columns == columns
            sizes.append(docs.count())
    assert sizes[0] > sizes[1] > sizes[2] == sizes[3]
    assert docs.groupBy("sequence_id").sum("length").filter("`sum(length)` > 4096").count() == 0
    assert corpus_pipeline.run(spark, sf_dir).count() == docs.count()
