"""Operators on small fixtures, and on rows where one key owns a large part."""

import collections
import io
import random
import tarfile

import pytest
from pyspark.sql import functions as F

from scenetrail.operators import catalog, graph, jobs, lineage, nested, ordered, raster, reports, rowfns, runs, slots, stages
from scenetrail import session
from scenetrail.functions import text
from scenetrail.plans import stage_data
from scenetrail.session import scratch_path
from scenetrail.sources import documents, manifests, tables

CHAIN = """
{"aaaaaa_t00xxx_20250101_ad6m4.img": {"filename": "aaaaaa_t00xxx_20250101_ad6m4.img 2025-01-02 00:00:10",
  "metadata": {"script": "make_index.py"}, "input": [
    {"aaaaaa_t00xxx_20250101_abam4.img": {"filename": "aaaaaa_t00xxx_20250101_abam4.img 2025-01-02 00:00:05",
      "metadata": {"script": "make_ref.py"}, "input": [
        {"aaaaaa_t00xxx_20250101_aa0m4.meta": {"filename": "aaaaaa_t00xxx_20250101_aa0m4.meta 2025-01-02 00:00:01",
          "metadata": {"script": ""}, "input": []}}]}}]}}
"""


def _deep(n):
    """A chain of n nodes, each made from the next and twice from a raw file."""
    doc = {}
    for i in reversed(range(n)):
        raw = {"raw.meta": {"filename": "raw.meta 2025-01-01 00:00:00", "metadata": {"script": ""}, "input": []}}
        path = f"aaaaaa_t00xxx_20250101_n{i:03}.img"
        doc = {path: {"filename": f"{path} 2025-01-01 00:00:00", "metadata": {"script": "step.py"}, "input": ([doc] if doc else []) + [raw, raw]}}
    return doc


def _docs(spark, *texts):
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "doc_id string, body string")
    return df.select("doc_id", F.parse_json("body").alias("doc"))


def test_minimal_document(spark, rows):
    nodes = lineage.flatten_provenance(_docs(spark, CHAIN), "s.d.p")
    assert nodes.count() == 3 and lineage.provenance_edges(nodes).count() == 2
    members = lineage.step_members(nodes)
    steps = lineage.build_steps(nodes, members).select("step_id", "script", "n_outputs", "n_inputs", "n_raw_inputs")
    assert rows(steps) == [("make-index_ad6m4_img", "make_index.py", 1, 1, 0), ("make-ref_abam4_img", "make_ref.py", 1, 0, 1)]
    deps = lineage.step_dependencies(members)
    assert rows(deps) == [("0", "make-ref_abam4_img", "make-index_ad6m4_img")]
    assert rows(lineage.root_steps(members, "make-ref")) == [("0", "make-ref_abam4_img", True)]
    levels = graph.levels(deps.select("doc_id", F.col("up_step").alias("parent"), F.col("down_step").alias("child")), ["doc_id"])
    assert rows(levels.select("node", "level")) == [("make-index_ad6m4_img", 2), ("make-ref_abam4_img", 1)]


def test_documents_of_any_depth(spark):
    import json

    nodes = lineage.flatten_provenance(_docs(spark, *[json.dumps(_deep(n)) for n in (1, 4, 5, 11)]), "s.d.p")
    got = {r.doc_id: (r.n, r.d) for r in nodes.groupBy("doc_id").agg(F.count("*").alias("n"), F.max("depth").alias("d")).collect()}
    assert got == {"0": (3, 1), "1": (12, 4), "2": (15, 5), "3": (33, 11)}
    raw = lineage.step_members(nodes).filter("role = 'raw'")
    assert {r.occurrences for r in raw.collect()} == {2}


def test_first_spelling_of_a_script_counts(spark, rows):
    def node(path, script, *inputs):
        return f'{{"{path}": {{"filename": "{path} 2025-01-01 00:00:00", "metadata": {{"script": "{script}"}}, "input": [{", ".join(inputs)}]}}}}'

    deeper_first = node("t_top.img", "top.py", node("u_mid.img", "mid.py", node("a_x.img", "make_x.py")), node("a_x.img", "Make_X.py"))
    not_by_text = node("t_top.img", "top.py", node("a_x.img", "make_x.py"), node("a_x.img", "Make_X.py"))
    nodes = lineage.flatten_provenance(_docs(spark, deeper_first, not_by_text), "s.d.p")
    steps = lineage.build_steps(nodes, lineage.step_members(nodes)).filter("lower(script) = 'make_x.py'")
    assert rows(steps.select("doc_id", "script")) == [("0", "make_x.py"), ("1", "make_x.py")]


def _node(path, script, *inputs):
    return f'"{path}": {{"filename": "{path} 2025-01-01 00:00:00", "metadata": {{"script": "{script}"}}, "input": [{", ".join(inputs)}]}}'


def test_keys_of_an_object_keep_their_order(spark, rows):
    two = "{" + _node("z_x.img", "Make_X.py") + ", " + _node("a_x.img", "make_x.py", "{" + _node("r.meta", "") + "}") + "}"
    raw_first = "{" + _node("y.meta", "") + ", " + _node("b_y.img", "make_y.py") + "}"
    doc = "{" + _node("top.img", "top.py", two, raw_first, "null", "{}") + "}"
    text = spark.createDataFrame([("0", doc), ("1", None), ("2", "{"), ("3", "{}")], "doc_id string, body string")
    nodes = lineage.flatten_provenance(text, "s", doc="body")
    ordered_names = [r.artifact for r in nodes.orderBy("position").collect()]
    assert ordered_names == ["top.img", "z_x.img", "a_x.img", "r.meta", "y.meta", "b_y.img"]
    members = lineage.step_members(nodes)
    assert rows(members.filter("step_id = 'top_'").select("role", "fqn", "occurrences")) == [
        ("input", "s.z_x_img", 1), ("output", "s.top_img", 1), ("raw", "s.y_meta", 1),
    ]
    scripts = {r.step_id: r.script for r in lineage.build_steps(nodes, members).collect()}
    assert scripts == {"top_": "top.py", "make-x_": "Make_X.py", "make-y_": "make_y.py"}


def test_shared_subtrees_count_as_the_plain_unnesting(spark, rows):
    """Two ways down in each of seven levels: 255 visits of eight different subtrees, in two documents."""
    inner = _node("n7.img", "s.py")
    for k in reversed(range(7)):
        inner = _node(f"n{k}.img", "s.py", "{" + inner + "}", "{" + inner + "}")
    hidden = "{" + _node("raw.meta", "", "{" + _node("hidden.img", "s.py") + "}") + "}"
    docs = [(0, "{" + inner + "}"), (1, "{" + _node("other.img", "t.py", "{" + inner + "}", hidden, hidden) + "}"), (2, None), (3, "[")]
    df = spark.createDataFrame(docs, "doc_id int, doc string")
    roots, nodes, links = lineage.shared_provenance(df)
    assert (roots.count(), nodes.count(), links.count()) == (2, 10, 9)
    assert {r.n for r in links.collect()} == {1, 2}
    got = lineage.shared_occurrences(roots, nodes, links, "s").groupBy("depth", "artifact", "fqn", "step_id").agg(F.sum("occurrences"))
    plain = lineage.flatten_provenance(df, "s").groupBy("depth", "artifact", "fqn", "step_id").agg(F.count("*"))
    assert rows(got) == rows(plain) and plain.agg(F.sum("count(1)")).first()[0] == 255 * 2 + 3
    none = lineage.shared_occurrences(*lineage.shared_provenance(df.filter("doc_id > 1")), "s")
    assert none.collect() == []


def test_raw_nodes_are_not_entered_and_a_space_is_a_script(spark, rows):
    doc = """{"a_short.img": {"filename": "a_short.img 2025-01-01 00:00:00", "metadata": {"script": " "}, "input": [
      {"/x/raw.img": {"filename": "/x/raw.img 2025-01-01 00:00:00", "metadata": {"script": ""}, "input": [
        {"hidden.img": {"filename": "h 2025-01-01 00:00:00", "metadata": {"script": "s.py"}, "input": []}}]}},
      {"/y/raw.img": {"filename": "/y/raw.img 2025-01-01 00:26:21", "metadata": {"script": ""}}}]}}"""
    nodes = lineage.flatten_provenance(_docs(spark, doc), "s.d.p")
    assert rows(nodes.select("artifact", "step_id")) == [("/x/raw.img", None), ("/y/raw.img", None), ("a_short.img", "_")]
    assert rows(lineage.fqn_collisions(lineage.distinct_artifacts(nodes))) == [("s.d.p.raw_img", 2)]
    raw = lineage.step_members(nodes).filter("role = 'raw'").select("fqn", "occurrences")
    assert rows(raw) == [("s.d.p.raw_img", 2)]


def test_declared_edges(spark, rows):
    wide = [("mosaic", "inlet", f"tile{i}", "north") for i in range(3)] + [("mosaic", "outlet", f"sheet{i}", "north") for i in range(2)]
    rest = [("mosaic", "outlet", "sheet9", "south"), ("clip", "inlet", "sheet0", "north"), ("clip", "outlet", "cut", "north")]
    df = spark.createDataFrame(wide + rest, "dag string, direction string, fqn string, key string")
    edges = lineage.declared_edges(df).select("dag", "from_fqn", "to_fqn")
    assert rows(edges) == [("clip", "sheet0", "cut")] + [("mosaic", f"tile{i}", f"sheet{j}") for i in range(3) for j in range(2)]
    alone = lineage.declared_groups(df).filter("n_inlets = 0")
    assert rows(alone.select("dag", "key")) == [("mosaic", "south")]


def test_hubs_stand_for_the_product(spark, rows):
    rng = random.Random(3)
    rows_in = [(f"d{g % 3}", rng.choice(("inlet", "outlet", "other")), f"f{rng.randrange(25)}", f"k{g}") for g in range(12) for _ in range(rng.randrange(9))]
    rows_in += [("d", d, f"w{i}{d[0]}", "wide") for i in range(200) for d in ("inlet", "outlet")] + [("d", "inlet", "f1", None), ("d", "outlet", "f2", None)]
    df = spark.createDataFrame(rows_in + rows_in[:5], "dag string, direction string, fqn string, key string")
    hubs, edges = lineage.declared_hubs(df), lineage.declared_edges(df)
    assert edges.count() >= 200 * 200 and hubs.count() < 600
    links = edges.select("dag", "key", F.col("from_fqn").alias("parent"), F.col("to_fqn").alias("child"))
    assert rows(lineage.hub_degrees(hubs)) == rows(graph.degrees(links))
    start = df.select(F.col("fqn").alias("node")).distinct()
    assert rows(lineage.hub_ancestors(hubs, start)) == rows(graph.ancestors(links.select("parent", "child"), start))


def test_inherited_inlets(spark, rows):
    edges = spark.createDataFrame(
        [("d", p, c) for p, c in (("fetch", "clip"), ("clip", "warp"), ("clip", "mask"), ("warp", "join"), ("mask", "join"))],
        "dag string, parent string, child string",
    )
    outlets = spark.createDataFrame(
        [("d", "fetch", "raw"), ("d", "warp", "grid"), ("d", "mask", "cloud"), ("d", "mask", "shadow")], "dag string, task string, url string"
    )
    auto = lineage.auto_inlets(edges, outlets, spark.createDataFrame([("d", "join"), ("d", "warp")], "dag string, task string"))
    assert rows(auto) == [("d", "join", "cloud"), ("d", "join", "grid"), ("d", "join", "shadow")]
    refs = spark.createDataFrame([("d", "join", "fetch"), ("d", "join", "mask"), ("d", "mask", "warp")], "dag string, task string, ref string")
    start = refs.select("dag", F.col("task").alias("node")).distinct()
    named = lineage.named_inlets(refs, graph.ancestors(edges, start, ["dag"]), outlets)
    assert rows(named) == [("d", "join", "cloud"), ("d", "join", "raw"), ("d", "join", "shadow")]


def test_graph_cases(spark, rows):
    diamond = spark.createDataFrame([("a", "b"), ("a", "c"), ("b", "d"), ("c", "d"), ("a", "d")], "parent string, child string")
    assert rows(graph.levels(diamond)) == [("a", 1), ("b", 2), ("c", 2), ("d", 3)]
    reach = graph.ancestors(diamond, spark.createDataFrame([("d",)], "node string"))
    assert rows(reach) == [("d", "a", 1), ("d", "b", 1), ("d", "c", 1)]
    with pytest.raises(ValueError):
        graph.levels(spark.createDataFrame([("a", "b"), ("b", "a")], "parent string, child string"))


def test_components_of_long_and_wide_graphs(spark):
    rng = random.Random(5)
    path = [(i, i + 1) for i in range(200)]
    star = [(1000, 1000 + i) for i in range(1, 400)]
    loose = [(rng.randrange(2000, 2300), rng.randrange(2000, 2300)) for _ in range(150)]
    edges = path + star + loose
    rng.shuffle(edges)
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            parent[max(find(a), find(b))] = min(find(a), find(b))
    got = dict(tuple(r) for r in graph.components(spark.createDataFrame(edges, "parent long, child long")).collect())
    assert got == {n: find(n) for n in parent}


def _hot(n=6000, seed=3):
    """Rows (k, t, v) where one key owns half of the rows, and a third share one instant."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        k = 0 if i % 2 else rng.randrange(1, 40)
        t = 500 if i % 3 == 0 else rng.randrange(1000)
        out.append((k, t, i))
    return out


def test_previous_value_with_a_hot_key(spark):
    rows_in = _hot()
    df = spark.createDataFrame(rows_in, "k int, t int, v int").repartition(8)
    got = {r.v: r.p for r in ordered.previous_value(df, ["k"], ["t", "v"], "v", "p").collect()}
    want, last = {}, {}
    for k, t, v in sorted(rows_in):
        want[v], last[k] = last.get(k), v
    assert got == want


def test_enumerate_with_equal_keys(spark):
    df = spark.createDataFrame([(i % 2 and 7,) for i in range(5000)], "x int").repartition(8)
    got = ordered.enumerate_rows(df, ["x"]).collect()
    assert sorted(r.idx for r in got) == list(range(5000))
    assert all((r.x == 0) == (r.idx < 2500) for r in got)


def test_number_in_key_with_a_hot_key(spark):
    rows_in = _hot(3000)
    df = spark.createDataFrame(rows_in, "k int, t int, v int").repartition(8)
    got = {r.v: r.number for r in ordered.number_in_key(df, ["k"], ["t", "v"]).collect()}
    want, seen = {}, collections.Counter()
    for k, _, v in sorted(rows_in):
        seen[k] += 1
        want[v] = seen[k]
    assert got == want


def test_shuffle_partitions_follow_the_data(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.bin").write_bytes(b"0" * 1000)
    assert session.stored_bytes(spark, str(tmp_path)) == 1000
    assert session.shuffle_partitions(1000, 8) == 8
    assert session.shuffle_partitions(10 * 2**30, 8) == 80
    assert session.shuffle_partitions(100 * 2**40, 8) == 50_000
    before = spark.conf.get("spark.sql.shuffle.partitions")
    assert session.configure(spark, str(tmp_path)).conf.get("spark.sql.shuffle.partitions") == before


def test_last_known_with_a_hot_key(spark):
    left, right = _hot(4000, 1), [(k, t, v) for k, t, v in _hot(900, 2) if k != 5]
    a = spark.createDataFrame(left, "k int, t int, id int").repartition(8)
    b = spark.createDataFrame(right, "k int, t int, value int").repartition(5)
    got = {r.id: r.found for r in ordered.last_known(a, b, ["k"], "t", "value", "found").collect()}
    newest = collections.defaultdict(dict)
    for k, t, v in right:
        newest[k][t] = max(v, newest[k].get(t, v))
    want = {}
    for k, t, i in left:
        at = [u for u in newest[k] if u <= t]
        want[i] = newest[k][max(at)] if at else None
    assert got == want


def test_slots(spark, rows):
    df = spark.createDataFrame([(i, f"u{i}") for i in range(7)], "i int, url string")
    assert rows(slots.assign_slots(df, "url", 5, ["i"])) == [(i, f"u{i}") for i in range(5)]
    assert rows(slots.slot_overflow(df, 5, ["i"]).select("url")) == [("u5",), ("u6",)]
    few = slots.assign_slots(df.filter("i < 3"), "url", 5, ["i"])
    assert rows(few) == [(0, "u0"), (1, "u1"), (2, "u2"), (3, None), (4, None)]


def test_stage_inputs(spark):
    files = [(c, "re", f"s_{c}_{n}.img") for c in ("da1", "da2", "da3") for n in ("b", "a")] + [("dbh", "th", "s_dbh.img")]
    df = spark.createDataFrame([("s", f, c, n) for c, f, n in files], "scene_key string, family string, code string, file_name string")
    got = {r.stage_no: r for r in stages.resolve_stage_inputs(df, "landsat").collect()}
    assert [n for n, r in got.items() if r.ready] == [1, 2, 4, 5, 9, 11]
    assert got[2].files == ["s_da1_a.img", "s_da2_a.img"]
    assert got[7].missing == 1 and got[3].missing == 1
    edges = stages.plan_edges(stage_data.stage_outputs(spark), stage_data.stage_inputs(spark))
    sentinel = {(r.up_stage, r.down_stage) for r in edges.filter("sensor = 'sentinel'").collect()}
    assert sentinel == {(3, 4), (3, 5)}


def test_slots_of_a_null_group_and_a_large_take(spark, rows):
    df = spark.createDataFrame([(None, 1), (None, 2), (None, 3), ("g", 4)], "g string, i int")
    assert rows(slots.assign_slots(df, "i", 2, ["i"], ["g"])) == [("g", 0, 4), ("g", 1, None), (None, 0, 1), (None, 1, 2)]
    assert rows(slots.slot_overflow(df, 2, ["i"], ["g"])) == [(None, 3)]
    hot = spark.range(20000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise("cold").alias("g"), F.col("id").alias("i"))
    got = slots.take(hot, 2500, ["i"], ["g"]).groupBy("g").agg(F.count("*").alias("n"), F.max("idx").alias("last"), F.max("i").alias("i"))
    assert rows(got.select("g", "n", "last", "i")) == [("cold", 2500, 2499, 7497), ("hot", 2500, 2499, 3749)]
    # Few and many rows are taken in different ways, but alike, also where the order leaves ties.
    tied = hot.withColumn("tie", F.col("i") % 4).repartition(5)
    for by in (["g"], None):
        few = slots.take(tied, 40, ["tie"], by)
        assert few.dtypes == slots.take(tied, slots.FEW + 1, ["tie"], by).dtypes
        assert rows(few) == rows(slots.take(tied, slots.FEW + 1, ["tie"], by).filter("idx < 40"))
    assert "WindowGroupLimit" in slots.take(tied, 40, ["tie"], ["g"])._jdf.queryExecution().toString()


def test_sentinel_inputs(spark, rows):
    files = [("s", "ab0", "b"), ("s", "ab0", "a"), ("s", "aba", "c"), ("t", "abb", "d")]
    df = spark.createDataFrame([(k, "re", c, n) for k, c, n in files], "scene_key string, family string, code string, file_name string")
    got = rows(stages.stage_input_files(df, "sentinel").select("scene_key", "stage_no", "code", "file_name"))
    assert [r[1:] for r in got if r[0] == "s"] == [
        (1, "ab0", "a"), (2, "ab0", "a"), (2, "ab0", "b"), (3, "ab0", "a"), (3, "ab0", "b"), (4, "aba", "c"), (4, "abb", None), (5, "aba", "c"),
    ]
    assert [r[1:] for r in got if r[0] == "t" and r[1] == 2] == [(2, "ab0", None)]
    assert all(r.ready for r in stages.resolve_stage_inputs(df, "sentinel").collect())


def test_readiness_of_roots_and_unstarted_runs(spark, rows):
    edges = spark.createDataFrame([("d", "a", "b")], "dag string, parent string, child string")
    states = [("d", "a", 1, "success"), ("d", "lone", 2, None)]
    task_runs = spark.createDataFrame(states, "dag string, task string, logical_ts int, state string")
    rules = spark.createDataFrame([], "dag string, task string, trigger_rule string")
    got = rows(runs.readiness(edges, task_runs, rules).select("task", "logical_ts", "ready"))
    assert got == [("a", 1, True), ("a", 2, True), ("b", 1, True), ("b", 2, False), ("lone", 1, True), ("lone", 2, True)]


def test_run_state(spark, rows):
    edges = [("fail", "a", "b"), ("allfail", "a", "b"), ("block", "a", "b")]
    states = [
        ("fail", "a", "failed"), ("fail", "b", "upstream_failed"),
        ("allfail", "a", "failed"), ("allfail", "b", "success"),
        ("root", "a", "success"), ("root", "b", "failed"),
        ("open", "a", None), ("open", "b", "failed"),
        ("block", "a", None), ("block", "b", None),
    ]
    task_runs = spark.createDataFrame([(d, t, 1, s) for d, t, s in states], "dag string, task string, logical_ts int, state string")
    task_edges = spark.createDataFrame(edges, "dag string, parent string, child string")
    blocked = task_runs.filter("dag = 'block'")
    got = rows(runs.run_state(task_runs, task_edges, blocked).select("dag", "run_state"))
    assert got == [("allfail", "success"), ("block", "failed"), ("fail", "failed"), ("open", "running"), ("root", "failed")]


def test_depends_on_past(spark, rows):
    states = [("up", 1, "success"), ("down", 1, "failed"), ("up", 2, "success"), ("down", 2, "success"), ("up", 3, "running")]
    task_runs = spark.createDataFrame([("d", t, n, s) for t, n, s in states], "dag string, task string, logical_ts int, state string")
    edges = spark.createDataFrame([("d", "up", "down")], "dag string, parent string, child string")
    plain = rows(runs.depends_on_past(task_runs).select("task", "logical_ts", "may_run"))
    assert plain == [("down", 1, True), ("down", 2, False), ("up", 1, True), ("up", 2, True), ("up", 3, True)]
    waiting = spark.createDataFrame([("d", "up")], "dag string, task string")
    held = rows(runs.depends_on_past(task_runs, edges, waiting).filter("task = 'up'").select("logical_ts", "may_run"))
    assert held == [(1, True), (2, False), (3, True)]


def test_reports(spark, rows):
    base = [("2031-06-01", "buoy", 12.5), ("2031-06-01", "mast", 3.0), ("2031-06-02", "buoy", 8.0), ("2031-06-09", "drone", 0.5)]
    schema = "date date, type string, depth double"
    a = tables.values(spark, base, schema)
    b = tables.values(spark, base[1:2] * 3 + [("2031-06-02", "buoy", 9.0), ("2031-06-30", None, 1.0)], schema)
    both = reports.combine(a, b)
    assert both.count() == 6
    counts = {(r.date.day, r.type): r.number for r in reports.count_by(both, ["date", "type"], "type").collect()}
    assert counts == {(1, "buoy"): 1, (1, "mast"): 1, (2, "buoy"): 2, (9, "drone"): 1, (30, None): 0}
    empty = spark.createDataFrame([], "value int")
    assert reports.total(empty, "value").first().total is None and reports.mean(empty, "value").first()["mean"] is None
    busy = spark.createDataFrame([("running" if i % 2 else "queued", "q") for i in range(17)] + [("success", "q")], "state string, queue string")
    assert reports.scale_target(reports.active(busy), 16).first().target == 2
    assert reports.scale_target(reports.active(busy, "q"), 16).first().target == 0
    ticks = spark.range(15).select(F.timestamp_seconds(F.col("id") * 60).alias("ts"), F.lit(1).alias("value"))
    assert [r.total for r in reports.running_total(ticks, "ts", "value").orderBy("slot_end").collect()] == [5, 10, 15]


def test_catalog(spark, rows):
    tables_in = spark.createDataFrame([("s.d.p.a",), ("s.d.p.b",), ("s.d.p.b",), ("s.d.q.a",)], "fqn string")
    known = catalog.with_parents(spark.createDataFrame([("s.d.p.a",)], "fqn string"))
    new = catalog.register_missing(catalog.with_parents(tables_in), known)
    assert rows(new.select("create_order", "fqn")) == [(3, "s.d.q"), (4, "s.d.p.b"), (4, "s.d.q.a")]
    paths = catalog.catalog_path(catalog.registered(catalog.with_parents(tables_in), known))
    assert rows(paths.filter("table_fqn = 's.d.q.a'")) == [("s.d.q.a", "s.d.q", "s.d", "s")]


def test_job_output_in_chunks(spark):
    lines = [("j", "out", i, f"line {i}") for i in range(2500)] + [("j", "err", 0, "bad"), ("k", "out", 0, "x"), ("k", "err", 0, "")]
    df = spark.createDataFrame(lines, "job_id string, stream string, line_no int, line string").repartition(4)
    chunks = [r for r in jobs.collect_output(df, 1000).collect() if r.job_id == "j" and r.stream == "out"]
    whole = "\n".join(c.text for c in sorted(chunks, key=lambda c: c.chunk_no))
    assert len(chunks) == 3 and whole == "\n".join(f"line {i}" for i in range(2500))
    failed = {r.job_id: r.failed for r in jobs.job_outcome(df).collect()}
    assert failed == {"j": True, "k": False}
    assert not jobs.job_outcome(df, check_stderr=False).filter("failed").count()


def test_raster(spark, rows):
    px = spark.createDataFrame([("s", 3, 0, i, float(v)) for i, v in enumerate((1, 10000, 0, 20000))], "scene string, band int, row int, col int, value double")
    assert [r[0] for r in raster.rescale_bands(px).orderBy("col").select("value").collect()] == [0, 255, 0, 255]
    tile = raster.retile(spark.createDataFrame([("s", 1097, 1098)], "scene string, row int, col int")).first()
    assert (tile.tile_row, tile.tile_col, tile.in_row, tile.in_col) == (0, 1, 1097, 0)


def test_segments_against_flood_fill(spark):
    rng = random.Random(11)
    grid = {(r, c): rng.choice((1, 1, 2)) for r in [*range(15), *range(505, 519)] for c in list(range(12)) + list(range(500, 520)) if rng.random() < 0.9}
    df = spark.createDataFrame([("s", 1, r, c, v) for (r, c), v in grid.items()], "scene string, band int, row int, col int, value int")
    got = {(r.seed_row, r.seed_col): (r.value, r.n_pixels, r.min_row, r.max_row, r.min_col, r.max_col) for r in raster.segments(df).collect()}
    want, seen = {}, set()
    for start in sorted(grid):
        if start in seen:
            continue
        todo, part = [start], []
        seen.add(start)
        while todo:
            r, c = todo.pop()
            part.append((r, c))
            for q in ((r + i, c + j) for i in (-1, 0, 1) for j in (-1, 0, 1)):
                if q not in seen and grid.get(q) == grid[start]:
                    seen.add(q)
                    todo.append(q)
        rs, cs = [p[0] for p in part], [p[1] for p in part]
        want[start] = (grid[start], len(part), min(rs), max(rs), min(cs), max(cs))
    assert got == want


def test_nested(spark, rows):
    mixed = nested.expand_mixed(spark.createDataFrame([(1, '[1, 2, {"a": "b"}]'), (2, "[]"), (3, "broken")], "id int, items string"), "items")
    assert rows(mixed) == [(1, 0, "BIGINT", "1"), (1, 1, "BIGINT", "2"), (1, 2, "OBJECT<a: STRING>", '{"a":"b"}')]
    lists = spark.createDataFrame([(1, [3, 1, 2]), (2, [])], "id int, items array<int>")
    chained = nested.expand_chain(lists, "items", lambda x: x + 10, lambda x: x * 2)
    assert rows(chained) == [(1, 0, 3, 13, 26), (1, 1, 1, 11, 22), (1, 2, 2, 12, 24)]
    assert rows(nested.collect_mapped(chained, ["id"], "idx", "step_2", chunk=2)) == [(1, 0, [26, 22]), (1, 1, [24])]


def test_reduce_group_with_a_hot_key(spark):
    data = [(0 if i % 3 else i % 7, i) for i in range(6500)]  # the hot group has more than 64 x 64 values
    df = spark.createDataFrame(data, "k int, v long").repartition(8)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")  # a partial row for each value
    try:
        out = rowfns.reduce_group(
            df, ["k"], "v", lambda v: (int(v.sum()), len(v)), lambda p: (int(p.s.sum()), int(p.n.sum())), "s long, n long", fan_in=16
        )
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = collections.defaultdict(lambda: [0, 0])
    for k, v in data:
        want[k][0] += v
        want[k][1] += 1
    assert {r.k: [r.s, r.n] for r in out.collect()} == want


def test_manifest_files(spark, tmp_path):
    (tmp_path / "b.txt").write_text("\n".join(f" item {i} " if i % 5 else "" for i in range(20000)))
    (tmp_path / "a.txt").write_text("x\n\nx\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
    try:
        got = manifests.read_manifest(spark, str(tmp_path)).orderBy("path", "line_no").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    b = [(r.line_no, r.item) for r in got if r.path.endswith("b.txt")]
    assert b == [(i, f"item {i}") for i in range(20000) if i % 5]
    assert [(r.line_no, r.item) for r in got if r.path.endswith("a.txt")] == [(0, "x"), (2, "x")]


def test_files_of_documents_and_archives(spark, tmp_path):
    (tmp_path / "docs").mkdir()
    (tmp_path / "docs" / "p_metadata.json").write_text(CHAIN)
    (tmp_path / "docs" / "broken.json").write_text("{")
    docs = documents.read_provenance(spark, str(tmp_path / "docs"))
    assert lineage.flatten_provenance(docs, "s.d.p").count() == 3
    with tarfile.open(tmp_path / "x.tar.gz", "w:gz") as tar:
        for name, data in (("a/b.txt", b"hello"), ("c.bin", b"\0\1")):
            info = tarfile.TarInfo(name)
            info.size = len(data)
            tar.addfile(info, io.BytesIO(data))
    got = documents.read_archive(spark, str(tmp_path / "x.tar.gz")).select("member", "size", "content").collect()
    assert sorted((r.member, r.size, bytes(r.content)) for r in got) == [("a/b.txt", 5, b"hello"), ("c.bin", 2, b"\0\1")]


def test_state_defaults(spark, rows):
    path = scratch_path(spark, "state-test")
    tables.state_put(spark.createDataFrame([("a", ["x", "y"])], "key string, items array<string>"), "key", "items", path)
    wanted = spark.createDataFrame([("a",), ("b",)], "name string")
    assert rows(tables.state_get(wanted, "name", path)) == [("a", '["x","y"]'), ("b", "[]")]


def test_catalog_names_of_other_lengths(spark, rows):
    names = spark.createDataFrame([("s.d.p.a.b",), ("s.d.p.a.c",), ("x.y",)], "fqn string")
    assert rows(catalog.with_parents(names)) == [
        ("s", "service", None), ("s.d", "database", "s"), ("s.d.p", "schema", "s.d"), ("s.d.p.a.b", "table", "s.d.p"),
        ("s.d.p.a.c", "table", "s.d.p"), ("x", "service", None), ("x.y", "database", "x"),
    ]


def test_documents_of_one_name_in_two_folders(spark, tmp_path):
    for folder in ("a", "b"):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "na me+.json").write_text(CHAIN)
    docs = documents.read_provenance(spark, str(tmp_path / "*")).collect()
    assert len({d.doc_id for d in docs}) == 2 and {d.file_name for d in docs} == {"na me+.json"}


def test_newest_event_is_not_the_largest_text(spark):
    events = spark.createDataFrame([(1, "start", "on-start-999", 999), (1, "start", "on-start-10000", 10000)], "u int, event string, dataset string, at int")
    assert runs.event_states(events, ["u"], "event", ["start"], "at").first().start == "on-start-10000"


def test_module_failure_without_a_name(spark):
    log = "Failed to load gdal module.\nFailed to load modules.\n"
    assert spark.range(1).select(text.module_failures(F.lit(log)).alias("m")).first().m == ["gdal", ""]


def test_one_region_over_many_squares(spark, rows):
    """A frame with a spiral in it: the squares know parts only; and the same places in another scene and band."""
    side, step = 1100, 60
    frame = {(r, c) for k in range(0, side // 2, step) for r in (k, side - 1 - k) for c in range(k, side - k)}
    frame |= {(r, c) for k in range(0, side // 2, step) for c in (k, side - 1 - k) for r in range(k, side - k)}
    bridge = {(r, side // 2) for r in range(side)}
    df = spark.createDataFrame([(r, c) for r, c in frame | bridge], "row int, col int").selectExpr("explode(array('s', 't')) AS scene", "1S AS band", "row", "col", "CASE WHEN scene = 't' THEN double('NaN') WHEN col % 2 = 0 THEN 0D ELSE -0D END AS value")
    got = raster.segments(df).select("scene", "seed_row", "seed_col", "n_pixels", "max_row", "max_col")
    n = len(frame | bridge)
    assert rows(got) == [("s", 0, 0, n, side - 1, side - 1), ("t", 0, 0, n, side - 1, side - 1)]


def test_places_out_of_range_are_an_error(spark):
    one = "scene string, band int, row long, col long, value string"
    assert raster.segments(spark.createDataFrame([], one)).collect() == []
    for place in ((-1, 0), (0, -1), (1 << 31, 0)):
        with pytest.raises(Exception, match="out of range"):
            raster.segments(spark.createDataFrame([("s", 1, *place, "a")], one)).collect()


def test_null_pixels_are_no_data(spark):
    pixels = spark.createDataFrame([("s", 1, r, c, None if r < 2 and c < 2 else 1.0) for r in range(2) for c in range(3)], "scene string, band int, row int, col int, value double")
    found = raster.segments(pixels).collect()
    assert [(r.seed_row, r.seed_col, r.n_pixels) for r in found] == [(0, 2, 2)]


def test_levels_against_the_longest_ways(spark, rows):
    """Short and long ways to one node, keys told apart, a chain of 40, repeated edges, and cycles behind a root."""
    rng = random.Random(5)
    edges = {(1, f"n{a:02}", f"n{b:02}") for a, b in (sorted(rng.sample(range(30), 2)) for _ in range(80))}
    edges |= {(2, f"n{i:02}", f"n{i + 1:02}") for i in range(40)} | {(2, "n00", "n40"), (2, "x", "n40")}
    want = {}
    for g, a, b in sorted(edges):
        want.setdefault((g, a), 1)
        want[g, b] = max(want.get((g, b), 1), want[g, a] + 1)
    df = spark.createDataFrame([*edges, *edges], "g int, parent string, child string")
    assert rows(graph.levels(df, ["g"]).select("g", "node", "level")) == sorted((*k, v) for k, v in want.items())
    assert graph.levels(df.limit(0)).collect() == []
    for loop in ([("a", "b"), ("b", "c"), ("c", "b"), ("c", "d")], [("a", "a")]):
        with pytest.raises(ValueError, match="cycle"):
            graph.levels(spark.createDataFrame(loop, "parent string, child string"))


def test_reach_over_shared_nodes(spark, rows):
    """Many nodes under few, several ways of unlike length, and a cycle, against a walk from each node."""
    edges = [(f"a{i}", f"b{i % 40}") for i in range(400)] + [(f"a{i}", f"c{i % 7}") for i in range(0, 400, 3)]
    edges += [(f"b{i}", f"c{i % 7}") for i in range(40)] + [(f"c{i}", f"d{i % 2}") for i in range(7)] + [("d0", "e"), ("e", "f"), ("f", "d0"), ("d1", "d0")]
    up = collections.defaultdict(set)
    for a, b in edges:
        up[a].add(b)

    def walk(node):
        found, layer, far = {}, {node}, 0
        while layer:
            far += 1
            layer = {b for a in layer for b in up[a]} - set(found)
            found.update(dict.fromkeys(layer, far))
        return found

    df = spark.createDataFrame([(k, *e) for k in (1, 2) for e in edges], "g int, child string, parent string")
    starts = [f"a{i}" for i in range(400)] + ["c3", "e", "nobody"]
    start = spark.createDataFrame([(1, n) for n in starts] + [(2, "b1")], "g int, node string")
    want = sorted(((1, n, m, d) for n in starts for m, d in walk(n).items()), key=repr)
    want = sorted([*want, *((2, "b1", m, d) for m, d in walk("b1").items())], key=repr)
    assert rows(graph.ancestors(df, start, ["g"]).select("g", "node", "ancestor", "distance")) == want
    assert graph.ancestors(df, start.filter("node = 'nobody'"), ["g"]).collect() == []
