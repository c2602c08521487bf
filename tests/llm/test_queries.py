"""The registered queries against their SQL, and the pipeline's stages against what they must keep."""

import os

import pytest

import corpus_pipeline
from compare import check_rows, connect, difference, spark_rows
from scenetrail.llm import registry

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
QUERIES, CHECKS = registry.all_queries(), registry.all_checks()


@pytest.mark.parametrize("name", list(CHECKS))
def test_query_matches_check(spark, name):
    got = spark_rows(QUERIES[name](spark, SF_DIR))
    assert got[1]
    assert difference(got, check_rows(connect(SF_DIR), CHECKS[name])) is None


def test_one_query_each():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


def test_quality_against_labels(spark):
    """Held-out labels: nearly all junk goes, and clean documents stay."""
    found = QUERIES["op5_quality"](spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id")
    counts = {(r.quality, r.keep): r["count"] for r in found.groupBy("quality", "keep").count().collect()}
    assert counts.get((1, False), 0) == 0
    assert counts.get((0, True), 0) <= 0.1 * counts[(0, False)]


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SF_DIR).collect(), docs.schema)
        assert docs.columns == columns
        assert 0 < docs.count() <= before, name
        before = docs.count()
    mixed = corpus_pipeline.run(spark, SF_DIR)
    assert mixed.count() > 0 and mixed.filter("taken <= 0 or taken > 2 * size").count() == 0
