"""Documents at scale: what is shuffled and stored by the queries on them, with the rows that they had."""

import json

import pytest
from pyspark.sql import functions as F

from scenetrail import session
from scenetrail.operators import lineage
from scenetrail.plans import flows, registry
from scenetrail.sources import documents

SF = "/root/testdata/sf0.001"


def _node(name, *inputs, script="s.py"):
    return {f"{name}.img": {"filename": f"{name}.img 2025-01-01 00:00:00", "metadata": {"script": script if inputs else ""}, "input": list(inputs)}}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_links_of_the_shared_graph_are_shuffled_once(spark, monkeypatch, rows):
    stored = []
    monkeypatch.setattr(lineage, "cut_in_buckets", lambda df, *a, **k: stored.append(df) or session.cut_in_buckets(df, *a, **k))
    twice = _node("b", _node("c", _node("d"), _node("d")))
    docs = spark.createDataFrame([(i, json.dumps(_node(f"a{i}", twice, twice, _node("d")))) for i in range(5)], "doc_id int, doc string")
    got = lineage.shared_occurrences(*lineage.shared_provenance(docs), "s").groupBy("depth", "artifact").agg(F.sum("occurrences"))
    plain = lineage.flatten_provenance(docs, "s").groupBy("depth", "artifact").agg(F.count("*"))
    assert rows(got) == rows(plain)
    assert stored[0].columns == ["parent", "child", "n"] and len(stored) == 5
    assert [_plan(df).count("Exchange hashpartitioning") for df in stored[1:]] == [1, 1, 1, 1]  # the counts of a round, not the links


@pytest.mark.parametrize("name", ["q_step_members", "q_steps", "q_step_deps", "q_fan_in", "q_step_levels"])
def test_names_are_worked_out_once_for_a_document(spark, name):
    plan = _plan(registry.all_queries()[name](spark, SF))
    assert plan.count("_plain_nodes(") == 1 and plan.count("lower(") == 1 and plan.count("from_json") == 1
    assert plan.index("lower(") < plan.index("Exchange hashpartitioning(doc_id") < plan.index("_plain_nodes(")


def test_nodes_need_not_come_together(spark, rows):
    texts = [json.dumps(_node("a", _node("b", _node("c"), _node("b", _node("c"))), _node("c"))), "{'x.img': {'metadata': {'script': 's.py'}, 'input': [{'y.img': {}}]}}"]
    docs = spark.createDataFrame([(i // 2, t) for i, t in enumerate(texts * 2)], "doc_id int, doc string")
    columns = ("artifact", "parent_artifact", "parent_step", "fqn", "recorded", "position")
    apart = lineage.flatten_provenance(docs, "s", columns=columns, together=False)
    assert "hashpartitioning" not in _plan(apart) and rows(apart) == rows(lineage.flatten_provenance(docs, "s").select("doc_id", *columns))


@pytest.mark.parametrize("name", ["q_steps_merged", "q_fqn_collisions"])
def test_documents_that_need_not_come_together_are_not_shuffled(spark, name):
    plan = _plan(registry.all_queries()[name](spark, SF))
    assert plan.count("_plain_nodes(") == 1 and "hashpartitioning(doc_id" not in plan and plan.count("lower(") <= 1


def test_each_path_is_named_once(spark):
    plan = _plan(registry.all_queries()["q_fqn_collisions"](spark, SF))
    assert plan.count("hashpartitioning(artifact") == 1 and plan.index("store.scenes.public") < plan.index("hashpartitioning(artifact")
    assert "store.scenes.public" not in plan[plan.index("hashpartitioning(artifact") :]


def test_only_the_lineage_tables_asked_for(spark, rows):
    a, b, c, d = ("n" * 23 + x for x in "abcd")
    docs = spark.createDataFrame([(1, json.dumps(_node(a, _node(b, _node(c)), _node(d))))], "doc_id int, doc string")
    every, some = flows.lineage_tables(docs, "s"), flows.lineage_tables(docs, "s", ("deps", "levels"))
    assert list(every) == list(flows.LINEAGE_TABLES) and list(some) == ["deps", "levels"]
    assert all(rows(some[t]) == rows(every[t]) and some[t].count() for t in some)
    assert rows(every["nodes"]) == rows(lineage.flatten_provenance(docs, "s").select(every["nodes"].columns))
    assert every["steps"].count() == 2


def test_files_of_long_documents_are_read_in_one_arrow_pass(spark, monkeypatch):
    read, made, counted = documents.read_provenance, [], []
    monkeypatch.setattr(documents, "read_provenance", lambda *a: made.append(read(*a)) or made[-1])
    monkeypatch.setattr(lineage, "cluster", lambda *a, **k: counted.append(k["rows_known"]) or session.cluster(*a, **k))
    plan = _plan(registry.all_queries()["q_prov_files"](spark, SF))
    assert plan.count("_plain_nodes(") == 1 and plan.count("FileScan text") == 1 and plan.count("hashpartitioning") == 1
    n, size = made[0].agg(F.count("*"), F.sum(F.octet_length("body"))).first()
    assert counted == [size // lineage.DOCUMENT_BYTES] and counted[0] > 10 * n  # long documents are dealt to more tasks
