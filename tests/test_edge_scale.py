"""Edges are made distinct as numbers, and shuffles have partitions by the room that rows take."""

import pyarrow as pa

from scenetrail import session
from scenetrail.operators import graph, lineage
from scenetrail.plans import queries_reports
from scenetrail.plans.derived import VIEWS, table, view
from scenetrail.sources import documents

SF = "/root/testdata/sf0.001"


def test_edges_of_repeated_and_lacking_keys(spark, rows, tmp_path):
    for name in ("orders", "customer", "supplier", "nation"):
        table(spark, SF, name).limit(20).unionByName(table(spark, SF, name).limit(5)).write.parquet(f"{tmp_path}/{name}.parquet")
    lines = [(1, 2, 3), (1, 2, 3), (1, None, 3), (1, 3, None), (None, 1, 3), (-1, -2, 3), (None, None, None), (None, 1, 3), (1, 2, 4)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long").write.parquet(f"{tmp_path}/lineitem.parquet")
    edges = view(spark, str(tmp_path), "edges")
    assert edges.count() == edges.distinct().count()
    name = lambda line: "lines/" + "-".join(str(k) for k in line if k is not None)
    want = {(f"{kind}/{'' if k is None else k}", name(line)) for line in lines for kind, k in zip(("orders", "part", "supplier"), line)}
    assert {tuple(r) for r in edges.filter("child LIKE 'lines/%'").collect()} == want
    whole = spark.sql(VIEWS["edges"], **{t: table(spark, SF, t) for t in ("lineitem", "orders", "customer", "supplier", "nation")})
    assert rows(view(spark, SF, "edges")) == rows(whole)


def test_names_of_lines_are_not_shuffled_to_be_made_distinct(spark):
    plan = view(spark, SF, "edges")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(l_orderkey" in plan


def test_partitions_follow_the_room_of_rows(spark, tmp_path):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        with open(tmp_path / "big", "wb") as f:
            f.truncate(1 << 30)
        assert session.configure(spark, str(tmp_path)).conf.get("spark.sql.shuffle.partitions") == str(session.ROOM * 8)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_reach_with_repeated_edges_and_ways_back_to_the_start(spark, rows):
    up = [(f"a{i}", f"b{i % 3}") for i in range(40)] * 2 + [("b0", "c"), ("b1", "a1"), ("b2", "d"), ("d", "a5"), ("c", "c")]
    df = spark.createDataFrame(up, "child string, parent string")
    starts = [f"a{i}" for i in range(40)]
    want = set()
    for node in starts:
        layer, far, seen = {node}, 0, set()
        while layer:
            far += 1
            layer = {b for a, b in up if a in layer} - seen
            seen |= layer
            want |= {(node, b, far) for b in layer}
    got = rows(graph.ancestors(df, spark.createDataFrame([(n,) for n in starts], "node string")))
    assert got == sorted(want)
    once = df.filter("child <> parent AND parent NOT LIKE 'a%'").selectExpr("parent", "child")
    assert rows(graph.levels(once)) == rows(graph.levels(once.distinct()))


def test_rounds_of_a_closure_read_only_the_edges_above(spark, monkeypatch):
    stored = []
    monkeypatch.setattr(graph, "cut", lambda df, label="cut": stored.append(session.cut(df, label)) or stored[-1])
    lines = spark.range(400).selectExpr("'l' || id AS child", "'o' || id % 20 AS parent")
    orders = spark.range(20).selectExpr("'o' || id AS child", "'c' || id % 4 AS parent")
    reach = graph.ancestors(lines.unionByName(orders), lines.selectExpr("child AS node"))
    assert reach.count() == 800
    assert [df.count() for df in stored][:2] == [420, 20]


def test_a_walk_shuffles_its_edges_once(spark, monkeypatch, rows):
    buckets, ends = [], []
    monkeypatch.setattr(graph, "cut_in_buckets", lambda df, keys, label: buckets.append(session.cut_in_buckets(df, keys, label)) or buckets[-1])
    monkeypatch.setattr(graph, "cut", lambda df, label="cut": ends.append(session.cut(df, label)) or ends[-1])
    edges = spark.range(4, 400).selectExpr("cast(id % 3 AS int) AS g", "'n' || id div 4 AS parent", "'n' || id AS child")
    for keys in ([], ["g"]):
        reach = graph.descendants(edges, edges.selectExpr("g", "parent AS node").limit(9), keys)
        assert len(ends) == len(buckets) == 1  # no further round of parting, so no look for ways back
        frontier = spark.createDataFrame([(0, "n1")], "g int, _at string").hint("merge").join(buckets[-1].hint("merge"), [*keys, "_at"])
        assert frontier._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
        want = {(*(r[k] for k in keys), r.parent, r.child) for r in edges.collect()}
        direct = {tuple(r)[:-1] for r in reach.filter("distance = 1").collect()}
        assert direct and direct <= want
        buckets.clear(), ends.clear()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("scenetrail_")]


def test_sides_of_a_group_are_made_distinct_once(spark, rows):
    declared = view(spark, SF, "declared")
    hubs = lineage.declared_hubs(declared.unionByName(declared.limit(50)))
    plan = hubs._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(dag") == 3 and "Expand" not in plan and plan.count("hashpartitioning(dag#") == plan.count("hashpartitioning(")
    assert sum("fqn" in line and "hashpartitioning" in line for line in plan.splitlines()) == 1
    assert rows(hubs) == rows(lineage.declared_hubs(declared))
    assert "hashpartitioning(dag" not in lineage.hub_degrees(hubs)._jdf.queryExecution().executedPlan().toString()


def test_archives_and_their_members_come_in_bounded_batches():
    texts = [f"{i:07}" * 20_000 for i in range(100)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(100)), "text": texts})
    packed = list(queries_reports._pack([batch, batch.slice(7, 1), batch.slice(0, 0)]))
    assert [a.num_rows for a in packed] == [1] * 5
    members = list(documents._members(packed))
    assert max(m.nbytes for m in members) < 5 << 20
    got = [(r["archive"], r["member"], r["size"], r["content"]) for m in members for r in m.to_pylist()]
    assert [(int(m), s, c.decode()) for _, m, s, c in got] == [(i, len(t), t) for i, t in [*enumerate(texts), (7, texts[7])]]
    assert [m.num_rows for m in documents._members([])] == [0]
