"""Provenance at scale: nodes are not stored, documents that are clustered stay so, and no depth is lost by that."""

import json
import os

import pytest
from pyspark.sql import functions as F

from scenetrail.operators import graph, lineage
from scenetrail.plans import registry
from scenetrail.session import cluster, cut
from scenetrail.sources import documents

SF = "/root/testdata/sf0.001"


def _chain(n, doc=None):
    for i in reversed(range(n)):
        path = f"aaaaaa_t00xxx_20250101_n{i:03}.img"
        doc = {path: {"filename": f"{path} 2025-01-01 00:00:00", "metadata": {"script": "step.py"}, "input": [doc] if doc else []}}
    return doc


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["q_prov_nodes", "q_prov_edges", "q_step_members", "q_step_deps", "q_fan_in", "q_steps", "q_roots", "q_all_inputs"])
def test_grouping_by_document_shuffles_only_the_flat_rows(spark, name):
    plan = _plan(registry.all_queries()[name](spark, SF))
    assert plan.count("hashpartitioning") == 1 and plan.count("from_json") == 1
    assert plan.count("FileScan parquet") == 1 and "lineitem.parquet" in plan


def test_rounds_meet_at_every_depth(spark):
    deep = {n: json.dumps(_chain(n)) for n in (1, 9, 10, 11, 20, 21, 33)}
    escaped = {100 + n: text.replace('"input"', '"\\u0069nput"') for n, text in deep.items()}
    quoted = {200 + n: text.replace('"', "'") for n, text in deep.items()}
    docs = spark.createDataFrame(list((deep | escaped | quoted).items()), "doc_id int, body string")
    nodes = lineage.flatten_provenance(cluster(docs, "doc_id", per_task=2), "s", doc="body")
    got = nodes.groupBy("doc_id").agg(F.count("*").alias("n"), F.max("depth").alias("d")).collect()
    assert {r.doc_id: (r.n, r.d) for r in got} == {i: (i % 100, i % 100 - 1) for i in docs.toPandas()["doc_id"]}


ODD = [
    '{"a.img": {"metadata": {"script": "s.py"}, "input": [{"b": {}, "b": {"filename": "x"}}, null, {}]}} rest',
    "{'a.img': {'metadata': {'script': 's.py'}, 'input': [{'b': null}]}}",
    '{"a.img": {"filename": 1.50, "metadata": {"script": {"k": 1.0}}, "input": [{"b": {"metadata": [], "input": "c"}}]}}',
    '{"a.img": {"metadata": {"script": []}, "input": [{"b": {"metadata": {"script": ""}, "input": [{"c": {}}]}}]}}',
    '{"a\\ud800": {"filename": "x"}}',
    '{"a.img": {"metadata": {"script": "s.py"}, "input": [{"b": {}}',
    "[{}]", "", None,
]


def test_plain_documents_are_unnested_at_once_and_give_what_the_rounds_give(spark, rows):
    whole = [json.dumps(_chain(n)) for n in (1, 9, 33)]
    whole += ['{"a": {"metadata": {"script": "s.py"}, "input": [{"z": {"filename": "é"}, "b": {}, "b": {"metadata": {"script": null}}}, null]}, "": null}', "{}", "null"]
    plain = spark.createDataFrame([(t,) for t in whole + ODD], "body string").select("body", lineage._plain_nodes("body").alias("n"))
    assert {r.body for r in plain.filter("n IS NULL").collect()} == set(ODD)
    docs = spark.createDataFrame(list(enumerate(whole + ODD)), "doc_id int, body string")
    at_once = rows(lineage.flatten_provenance(docs, "s", doc="body", at_once=True))
    assert rows(lineage.flatten_provenance(docs, "s", doc="body")) == at_once and len(at_once) > 50


@pytest.mark.parametrize("name", ["q_step_ids", "q_steps_merged", "q_recorded", "q_versions", "q_fqn_collisions", "q_artifacts"])
def test_what_does_not_group_by_document_is_unnested_at_once(spark, name):
    assert _plan(registry.all_queries()[name](spark, SF)).count("_plain_nodes(") == 1


COLUMNS = ("depth", "artifact", "fqn", "script", "step_id", "recorded", "parent_artifact", "parent_step", "position", "place")


@pytest.mark.parametrize("levels", [3, 33])
@pytest.mark.parametrize("columns", [COLUMNS, ("artifact", "parent_artifact"), ("parent_step", "place"), ("recorded", "depth")])
def test_nodes_brought_together_are_those_of_the_rounds(spark, rows, levels, columns):
    deep = [json.dumps(_chain(n)) for n in (1, levels)]
    odd = [t.replace('"', "'") for t in deep] + [t.replace('"input"', '"\\u0069nput"') for t in deep] + ODD
    plain = ['{"a": {"metadata": {"script": "s.py"}, "input": [{"z": {"filename": "é"}, "b": {}, "b": {"metadata": {"script": null}}}, null]}, "": null}', "{}", "null"]
    docs = spark.createDataFrame([(i // 2, t) for i, t in enumerate(deep + odd + plain)], "doc_id int, body string")
    every = lineage.flatten_provenance(docs, "s", doc="body").withColumn("place", F.element_at("position", -1))
    got = lineage.flatten_provenance(docs, "s", doc="body", columns=columns)
    assert got.columns == ["doc_id", *columns] and rows(got) == rows(every.select("doc_id", *columns)) and got.count() > 10
    assert lineage.flatten_provenance(docs.limit(0), "s", doc="body", columns=columns).count() == 0


@pytest.mark.parametrize("name", ["q_prov_edges", "q_all_inputs", "q_roots"])
def test_documents_are_unnested_at_once_and_then_clustered(spark, name):
    plan = _plan(registry.all_queries()[name](spark, SF))
    assert plan.count("_plain_nodes(") == 1 and plan.index("Exchange hashpartitioning(doc_id") < plan.index("_plain_nodes(")


def test_deep_documents_are_shuffled_as_flat_rows_only(spark):
    plan = _plan(registry.all_queries()["q_prov_deep"](spark, SF))
    assert plan.count("hashpartitioning") == 1 and plan.count("from_json") == 1


def test_documents_of_many_short_branches_are_not_looked_through_again(spark):
    wide = {"a": {"metadata": {"script": "s"}, "input": [{"b": {"input": []}}] * 30}}
    texts = [json.dumps(wide), json.dumps(wide, separators=(",", ":")), json.dumps(_chain(10)), json.dumps(_chain(11))]
    deep = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").filter(lineage._may_go_deeper(F.col("t")))
    assert [r.i for r in deep.sort("i").collect()] == [3]


def test_documents_of_one_id_count_together(spark, rows):
    docs = spark.createDataFrame([(i // 2, json.dumps(_chain(2))) for i in range(400)], "doc_id int, body string")
    members = lineage.step_members(lineage.flatten_provenance(cluster(docs, "doc_id", per_task=10), "s", doc="body"), firsts=True)
    assert members.count() == 600 and {r.occurrences for r in members.collect()} == {2}
    assert lineage.step_dependencies(members).count() == 200


def test_dependencies_with_several_producers_and_consumers(spark, rows):
    made = [(1, s, "output", "f") for s in "ab"] + [(1, s, "input", "f") for s in "acd"] + [(1, "d", "raw", "f"), (2, "z", "output", "f"), (1, "e", "input", "g")]
    members = spark.createDataFrame(made, "doc_id int, step_id string, role string, fqn string")
    want = [(1, u, d) for u in "ab" for d in "acd" if u != d]
    assert rows(lineage.step_dependencies(members)) == want
    other = members.withColumnRenamed("doc_id", "run")
    assert rows(lineage.step_dependencies(other, ("run",))) == want


def test_steps_from_members_alone(spark, rows):
    one = "{\"t.img\": {\"metadata\": {\"script\": \"%s\"}, \"input\": [{\"r.meta\": {}}, {\"r.meta\": {}}, {\"u.img\": {\"metadata\": {\"script\": \"u.py\"}}}]}}"
    docs = spark.createDataFrame([(1, one % "t.py"), (2, one % "T.py"), (2, one % "t.py")], "doc_id int, doc string")
    nodes = lineage.flatten_provenance(docs, "s")
    for keys in (("doc_id",), ()):
        joined = lineage.build_steps(nodes, lineage.step_members(nodes, keys), keys)
        alone = lineage.build_steps(nodes, lineage.step_members(nodes, keys, firsts=True), keys)
        assert joined.columns == alone.columns and rows(joined) == rows(alone)


def test_stored_documents_are_compressed(spark, tmp_path):
    path = str(tmp_path / "docs")
    body = json.dumps(_chain(5))
    documents.write_documents(spark.range(2000).select(F.concat(F.lit("p"), "id", F.lit(".img")).alias("product"), F.lit(body).alias("body")), "product", "body", path)
    stored = sum(os.path.getsize(f"{path}/{f}") for f in os.listdir(path))
    assert stored * 5 < 2000 * len(body)
    assert documents.read_documents(spark, path).filter("doc IS NOT NULL").count() == 2000


def test_levels_in_groups_are_those_of_levels(spark, rows):
    made = [(g, f"n{a}", f"n{b}") for g in range(40) for a in range(12) for b in range(a + 1, 12) if (a * 7 + b * 5 + g) % 4 == 0]
    made += [(99, f"c{i}", f"c{i + 1}") for i in range(12)] + made[:50] + [(98, "n1", "n0")]
    edges = spark.createDataFrame(made, "doc_id int, parent string, child string")
    assert rows(graph.levels_in_groups(edges, ["doc_id"])) == rows(graph.levels(edges, ["doc_id"]))
    assert graph.levels_in_groups(edges.limit(0), ["doc_id"]).count() == 0
    lacking = spark.createDataFrame([(1, None, "b"), (1, "a", "c"), (1, "c", "d")], edges.schema)
    assert rows(graph.levels_in_groups(lacking, ["doc_id"])) == rows(graph.levels(lacking, ["doc_id"]))
    with pytest.raises(Exception, match="cycle"):
        graph.levels_in_groups(spark.createDataFrame([(1, "a", "b"), (1, "b", "a"), (2, "a", "b")], edges.schema), ["doc_id"]).collect()


def test_levels_of_documents_shuffle_only_the_flat_rows(spark):
    plan = _plan(registry.all_queries()["q_step_levels"](spark, SF))
    assert plan.count("hashpartitioning") == 1 and "SortMergeJoin" not in plan and "levels-" not in plan


def test_shared_subtrees_are_parsed_and_stored_once_a_level(spark, monkeypatch, rows):
    stored = []
    monkeypatch.setattr(lineage, "cut", lambda df, label="cut": stored.append(df) or cut(df, label))
    docs = spark.createDataFrame([(1, json.dumps(_chain(4))), (2, json.dumps(_chain(4)))], "doc_id int, body string")
    roots, nodes, links = lineage.shared_provenance(docs, "body")
    assert [(r.n) for r in roots.collect()] == [2] and (nodes.count(), links.count()) == (4, 3)
    assert len(stored) == 4 and all(df.filter("n > 0").count() == 1 for df in stored)
