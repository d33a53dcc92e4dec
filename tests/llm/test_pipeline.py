"""The pipeline, and every registered query where it meets its SQL."""

import pytest

import corpus_pipeline as pipeline
from reachmap.llm.registry import ORACLES, QUERIES

from ..compare import connect, difference
from .helpers import documents, odd_rows


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_its_sql(spark, sf_dir, name):
    assert difference(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLES[name]) is None


def test_all_operators_are_registered():
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))


def test_stages_keep_columns_and_shrink_as_they_should(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    first = docs
    counts = [docs.count()]
    for i, (_, stage) in enumerate(pipeline.STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        assert docs.columns == first.columns
        counts.append(docs.count())
    assert counts[0] >= counts[1] > counts[2] > counts[3] > 0
    out = pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert out.count() == counts[4] and {r.shard for r in out.select("shard").distinct().collect()} <= set(range(16))


@pytest.mark.parametrize("rows", [[], odd_rows()])
def test_stages_on_odd_tables(spark, sf_dir, rows):
    docs = documents(spark, rows, extra=True)
    for _, stage in pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        assert out.count() <= 3 * len(rows)
