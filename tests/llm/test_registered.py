"""Registered queries against their SQL, the pipeline, and what the native ones may not use."""

import pytest

import corpus_pipeline
from gaugeworks.llm import quality
from gaugeworks.llm.queries import ORACLES, QUERIES
from tests.llm.helpers import SF, table
from tests.oracle import compare, connect


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, name):
    assert compare(QUERIES[name](spark, SF), connect(SF), ORACLES[name]) == ""


@pytest.mark.parametrize("name", ["op1_line_dedup", "op3_mix_sources"])
def test_native_plans(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept, seen = docs, [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, SF)
        assert kept.columns == docs.columns and kept.dtypes == docs.dtypes
        kept = spark.createDataFrame(kept.collect(), docs.schema)
        seen.append(kept.count())
    assert seen[0] > seen[1] > seen[2] > seen[3] > 0
    good = {r.doc_id for r in quality.judge(docs).filter("kept").collect()}
    ids = [r.doc_id for r in kept.collect()]
    assert set(ids) <= good and len(ids) > len(set(ids))
    index = corpus_pipeline.STAGES[-1][1](spark, kept, SF).collect()
    assert sorted(r.doc_id for r in index) == sorted(ids)
    assert {r.doc_id for r in corpus_pipeline.run(spark, SF).collect()} == set(ids)
    assert max(d for (d,) in table("documents", "doc_id")) >= max(ids)
