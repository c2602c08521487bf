"""Queries on provenance documents, graphs, the catalogue and declared lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scenetrail.operators import catalog, graph, lineage
from scenetrail.plans import flows
from scenetrail.plans.derived import line_nodes, table, view
from scenetrail.plans.registry import query
from scenetrail.session import cluster, cut, scratch_path
from scenetrail.sources import documents

PREFIX = "store.scenes.public"
START_MARK = "qv-sentinel2angles"


def history_documents(spark: SparkSession, sf: str, clustered: bool = True) -> DataFrame:
    """The ``history`` view as nested documents (doc_id, product, body), one JSON text per row, clustered by the id or as they lie."""

    def node(path, script, stamp, *inputs):
        return F.concat(
            F.lit('{"'), path, F.lit('": {"filename": "'), path, F.lit(" "), stamp,
            F.lit('", "metadata": {"script": "'), script, F.lit('"}, "input": ['), F.concat_ws(", ", *inputs), F.lit("]}}"),
        )

    written, later = F.col("written"), F.col("later")
    raw = node(F.col("raw_file"), F.lit(""), written)
    angles = F.lit("qv_sentinel2angles.py")
    ref = node(F.col("ref"), F.col("ref_script"), written, node(F.col("angle"), angles, written, raw), raw)
    top = node(
        F.col("product"), F.col("product_script"), later, ref, node(F.col("angle"), angles, later, raw), raw
    )
    flat = view(spark, sf, "history", spread_scans=True)
    return (cluster(flat, "doc_id") if clustered else flat).select("doc_id", "product", top.alias("body"))


def _nodes(spark, sf, at_once: bool = False) -> DataFrame:
    return lineage.flatten_provenance(history_documents(spark, sf), PREFIX, doc="body", at_once=at_once)


def _nodes_with(spark, sf, *columns: str, together: bool = True) -> DataFrame:
    docs = history_documents(spark, sf, clustered=False)
    return lineage.flatten_provenance(docs, PREFIX, doc="body", columns=columns, together=together)


def _step(script: str, path: str) -> str:
    code = f"replace(replace(substr({path}, 24), '/', '_'), '.', '_')"
    return (
        f"CASE WHEN {script} <> '' THEN lower(replace(replace(replace({script}, ' ', ''), '.py', ''), '_', '-'))"
        f" || '_' || {code} END"
    )


def _fqn(path: str) -> str:
    return f"'{PREFIX}.' || replace(regexp_extract({path}, '([^/]*)$', 1), '.', '_')"


_NODES = f"""
    SELECT doc_id, depth, parent_artifact, parent_script, artifact, script, recorded,
           {_fqn('artifact')} AS fqn, {_step('script', 'artifact')} AS step_id,
           {_step('parent_script', 'parent_artifact')} AS parent_step
    FROM history_nodes
"""
_MEMBERS = f"""
    SELECT doc_id, step_id, role, fqn, count(*) AS occurrences FROM (
      SELECT doc_id, step_id, 'output' AS role, fqn FROM ({_NODES}) a WHERE step_id IS NOT NULL
      UNION ALL
      SELECT doc_id, parent_step, CASE WHEN step_id IS NULL THEN 'raw' ELSE 'input' END, fqn
      FROM ({_NODES}) b WHERE parent_step IS NOT NULL) m GROUP BY 1, 2, 3, 4
"""
_DEPS = f"""
    SELECT DISTINCT u.doc_id, u.step_id AS up_step, d.step_id AS down_step
    FROM ({_MEMBERS}) u JOIN ({_MEMBERS}) d ON u.doc_id = d.doc_id AND u.fqn = d.fqn
    WHERE u.role = 'output' AND d.role = 'input' AND u.step_id <> d.step_id
"""
_V = ("history_nodes",)


@query("q_documents", "SELECT doc_id, regexp_replace(product, '\\.[^.]*$', '') || '_metadata.json' AS metadata_file, product AS root FROM history", ("history",))
def stored_documents(spark, sf):
    path = scratch_path(spark, "documents")
    docs = history_documents(spark, sf)
    documents.write_documents(
        docs.select(F.concat("doc_id", F.lit("|"), "product").alias("product"), "body"), "product", "body", path
    )
    read = documents.read_documents(spark, path)
    root = F.map_keys(F.expr("variant_get(doc, '$', 'map<string, variant>')"))[0]
    return read.select(
        F.substring_index("metadata_file", "|", 1).alias("doc_id"),
        F.substring_index("metadata_file", "|", -1).alias("metadata_file"),
        root.alias("root"),
    )


@query(
    "q_prov_nodes",
    f"SELECT doc_id, depth, artifact, fqn, script, recorded, count(*) AS n FROM ({_NODES}) x GROUP BY ALL",
    _V,
)
def prov_nodes(spark, sf):
    return _nodes(spark, sf).groupBy("doc_id", "depth", "artifact", "fqn", "script", "recorded").agg(
        F.count("*").alias("n")
    )


@query(
    "q_prov_shared",
    f"""
    SELECT depth, artifact, fqn, script, step_id, recorded, count(*) AS occurrences FROM ({_NODES}) x
    GROUP BY 1, 2, 3, 4, 5, 6
    """,
    _V,
)
def prov_shared(spark, sf):
    shared = lineage.shared_provenance(history_documents(spark, sf, clustered=False), "body")
    counted = lineage.shared_occurrences(*shared, PREFIX)
    return counted.groupBy("depth", "artifact", "fqn", "script", "step_id", "recorded").agg(
        F.sum("occurrences").alias("occurrences")
    )


DEEP = 8


def _deep_documents(spark, sf) -> DataFrame:
    """A chain of nine artifacts for each order; every second step also reads a raw file of the customer."""

    def text(path, script, inputs):
        return F.concat(
            F.lit('{"'), path, F.lit('": {"filename": "'), path, F.lit(" 2025-01-01 00:00:00\", \"metadata\": {\"script\": \""),
            F.lit(script), F.lit('"}, "input": ['), F.concat_ws(", ", *inputs), F.lit("]}}"),
        )

    raw = text(F.concat(F.lit("customer_"), "o_custkey", F.lit(".meta")), "", [])
    doc = None
    for k in reversed(range(DEEP + 1)):
        path = F.concat(F.lit("cgmsre_t21kpq_"), F.lpad(F.col("o_orderkey").cast("string"), 8, "0"), F.lit(f"_n{k}.img"))
        inputs = ([raw] if k % 2 and k < DEEP else []) + ([doc] if k < DEEP else [])
        doc = text(path, f"Step_{k}.py" if k < DEEP else "", inputs)
    orders = cluster(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), "o_orderkey")
    return orders.select("o_orderkey", doc.alias("body"))


@query(
    "q_prov_deep",
    f"""
    WITH c AS (SELECT o_orderkey, 'customer_' || o_custkey || '.meta' AS raw, cast(k AS int) AS k,
                      'cgmsre_t21kpq_' || lpad(cast(o_orderkey AS varchar), 8, '0') || '_n' AS stem
               FROM orders, range({DEEP + 1}) r(k)),
    n AS (SELECT o_orderkey, k AS depth, stem || k || '.img' AS artifact,
                 CASE WHEN k < {DEEP} THEN 'Step_' || k || '.py' ELSE '' END AS script,
                 CASE WHEN k > 0 THEN stem || (k - 1) || '.img' END AS parent_artifact FROM c
          UNION ALL SELECT o_orderkey, k + 1, raw, '', stem || k || '.img' FROM c WHERE k % 2 = 1 AND k < {DEEP})
    SELECT *, CASE WHEN script <> '' THEN 'step-' || depth || '_n' || depth || '_img' END AS step_id,
           artifact || ' 2025-01-01 00:00:00' AS recorded, count(*) AS n FROM n GROUP BY ALL
    """,
)
def prov_deep(spark, sf):
    nodes = lineage.flatten_provenance(_deep_documents(spark, sf), PREFIX, "o_orderkey", "body")
    return nodes.groupBy(
        F.col("doc_id").alias("o_orderkey"), "depth", "artifact", "script", "parent_artifact", "step_id", "recorded"
    ).agg(F.count("*").alias("n"))


def _supplier_documents(spark, sf) -> DataFrame:
    """A document for each supplier in each of two folders: (folder, doc, body).

    The top artifact has one input object for each order line, with two keys whose names sort against their order.
    """

    def entry(path, script):
        return F.concat(
            F.lit('"'), path, F.lit('": {"filename": "'), path, F.lit(' 2025-01-01 00:00:00", "metadata": {"script": "'),
            script, F.lit('"}, "input": []}'),
        )

    def path(start, number, end):
        return F.concat(F.lit(start + "gmsre_t21kpq_"), F.lpad(number.cast("string"), 8, "0"), F.lit("_"), end)

    def entries(line):
        end = F.concat(F.lit("abam"), line["l_linenumber"].cast("string"), F.lit(".img"))
        first = entry(path("z", line["l_partkey"], end), F.when(line["l_returnflag"] == "R", "").otherwise("Make_Ref.py"))
        second = entry(path("a", line["l_orderkey"], end), F.when(line["l_linenumber"] % 2 == 0, "make_ref.py").otherwise(""))
        return F.concat(F.lit("{"), first, F.lit(", "), second, F.lit("}"))

    # Lines are brought together as numbers, and become texts afterwards.
    line = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")
    lines = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.array_sort(F.collect_list(line)).alias("lines"))
    items = lines.select("l_suppkey", F.transform("lines", entries).alias("items"))
    top = path("c", F.col("l_suppkey"), F.lit("ad7m4.img"))
    scripts = F.create_map(F.lit("a"), F.lit("Make_Top.py"), F.lit("b"), F.lit("make_top.py"))
    body = F.concat(
        F.lit('{"'), top, F.lit('": {"filename": "'), top, F.lit(' 2025-01-01 00:00:00", "metadata": {"script": "'),
        scripts[F.col("folder")], F.lit('"}, "input": ['), F.array_join("items", ", "), F.lit("]}}"),
    )
    folders = items.withColumn("folder", F.explode(F.array(F.lit("a"), F.lit("b"))))
    return folders.select("folder", F.col("l_suppkey").alias("doc"), body.alias("body"))


@query(
    "q_prov_files",
    """
    WITH made AS (
      SELECT l_suppkey, l_linenumber, l_orderkey, l_partkey, l_returnflag, '0Make_Ref.py' AS script, 'z' || l_partkey AS made
      FROM lineitem WHERE l_returnflag <> 'R'
      UNION ALL SELECT l_suppkey, l_linenumber, l_orderkey, l_partkey, l_returnflag, '1make_ref.py', 'a' || l_orderkey
      FROM lineitem WHERE l_linenumber % 2 = 0),
    steps AS (
      SELECT l_suppkey AS doc, 'make-ref_abam' || l_linenumber || '_img' AS step_id,
             substr(min(lpad(cast(l_orderkey AS varchar), 12, '0') || lpad(cast(l_partkey AS varchar), 12, '0')
                        || l_returnflag || script), 27) AS script,
             count(DISTINCT made) AS n_outputs, 0 AS n_inputs, 0 AS n_raw_inputs, 0 AS n_raw_distinct
      FROM made GROUP BY l_suppkey, l_linenumber
      UNION ALL
      SELECT l_suppkey, 'make-top_ad7m4_img', NULL, 1,
             count(DISTINCT l_partkey || '-' || l_linenumber) FILTER (l_returnflag <> 'R'),
             count(*) FILTER (l_returnflag = 'R'), count(DISTINCT l_partkey || '-' || l_linenumber) FILTER (l_returnflag = 'R')
      FROM lineitem GROUP BY l_suppkey)
    SELECT folder, doc, step_id, coalesce(script, top) AS script, n_outputs, n_inputs, n_raw_inputs, n_raw_distinct
    FROM steps, (VALUES ('a', 'Make_Top.py'), ('b', 'make_top.py')) f(folder, top)
    """,
)
def prov_files(spark, sf):
    path = scratch_path(spark, "history")
    docs = _supplier_documents(spark, sf)
    docs.repartition("folder", "doc").write.partitionBy("folder", "doc").option("compression", "gzip").text(path)
    nodes = lineage.flatten_provenance(documents.read_provenance(spark, path), PREFIX, doc="body", columns=lineage.STEP_COLUMNS)
    steps = lineage.build_steps(nodes, lineage.step_members(nodes, firsts=True))
    place = lambda name: F.regexp_extract("doc_id", f"/{name}=([^/]*)/", 1)
    return steps.withColumns({"folder": place("folder"), "doc": place("doc").cast("long")}).drop("doc_id")


@query(
    "q_prov_edges",
    """
    SELECT doc_id, artifact AS parent_input, parent_artifact AS child_output, count(*) AS n
    FROM history_nodes WHERE parent_artifact IS NOT NULL GROUP BY ALL
    """,
    _V,
)
def prov_edges(spark, sf):
    edges = lineage.provenance_edges(_nodes_with(spark, sf, "artifact", "parent_artifact"))
    return edges.groupBy("doc_id", "parent_input", "child_output").agg(F.count("*").alias("n"))


@query("q_step_ids", f"SELECT step_id, count(*) AS n FROM ({_NODES}) x WHERE step_id IS NOT NULL GROUP BY 1", _V)
def step_ids(spark, sf):
    nodes = _nodes(spark, sf, at_once=True).filter(F.col("step_id").isNotNull())
    return nodes.groupBy("step_id").agg(F.count("*").alias("n"))


@query(
    "q_recorded",
    r"""
    SELECT regexp_extract(recorded, '^(.*) (\d{4}-.*)$', 1) AS recorded_path,
           cast(regexp_extract(recorded, '^(.*) (\d{4}-.*)$', 2) AS timestamp) AS written_at, count(*) AS n
    FROM history_nodes GROUP BY 1, 2
    """,
    _V,
)
def recorded(spark, sf):
    parts = lineage.split_recorded(_nodes(spark, sf, at_once=True))
    return parts.groupBy("recorded_path", "written_at").agg(F.count("*").alias("n"))


@query("q_step_members", _MEMBERS, _V)
def step_members(spark, sf):
    return lineage.step_members(_nodes_with(spark, sf, *lineage.MEMBER_COLUMNS))


@query(
    "q_steps",
    f"""
    SELECT s.doc_id, s.step_id, s.script, n_outputs, n_inputs, n_raw_inputs, n_raw_distinct
    FROM (SELECT doc_id, step_id, split_part(min(cast(depth AS varchar) || '|' || script), '|', 2) AS script
          FROM ({_NODES}) x WHERE step_id IS NOT NULL GROUP BY 1, 2) s
    JOIN (SELECT doc_id, step_id, count(*) FILTER (role = 'output') AS n_outputs,
                 count(*) FILTER (role = 'input') AS n_inputs,
                 cast(coalesce(sum(occurrences) FILTER (role = 'raw'), 0) AS bigint) AS n_raw_inputs,
                 count(*) FILTER (role = 'raw') AS n_raw_distinct
          FROM ({_MEMBERS}) m GROUP BY 1, 2) z ON z.doc_id = s.doc_id AND z.step_id = s.step_id
    """,
    _V,
)
def steps(spark, sf):
    nodes = _nodes_with(spark, sf, *lineage.STEP_COLUMNS)
    return lineage.build_steps(nodes, lineage.step_members(nodes, firsts=True))


@query(
    "q_steps_merged",
    f"SELECT step_id, role, fqn, cast(sum(occurrences) AS bigint) AS occurrences FROM ({_MEMBERS}) m GROUP BY 1, 2, 3",
    _V,
)
def steps_merged(spark, sf):
    return lineage.step_members(_nodes_with(spark, sf, *lineage.MEMBER_COLUMNS, together=False), keys=())


@query("q_step_deps", _DEPS, _V)
def step_deps(spark, sf):
    return lineage.step_dependencies(lineage.step_members(_nodes_with(spark, sf, *lineage.MEMBER_COLUMNS)))


@query(
    "q_fan_in",
    f"""
    SELECT doc_id, down_step, count(*) AS n_upstream, CASE WHEN count(*) > 1 THEN 'group' ELSE 'single' END AS link
    FROM ({_DEPS}) d GROUP BY 1, 2
    """,
    _V,
)
def fan_in(spark, sf):
    return lineage.fan_in(lineage.step_dependencies(lineage.step_members(_nodes_with(spark, sf, *lineage.MEMBER_COLUMNS))))


@query(
    "q_roots",
    f"""
    SELECT doc_id, step_id, contains(step_id, '{START_MARK}') AS from_start
    FROM ({_MEMBERS}) m GROUP BY 1, 2 HAVING count(*) FILTER (role = 'input') = 0
    """,
    _V,
)
def root_steps(spark, sf):
    nodes = _nodes_with(spark, sf, *lineage.MEMBER_COLUMNS)
    return lineage.root_steps(lineage.step_members(nodes), START_MARK)


@query("q_all_inputs", f"SELECT DISTINCT doc_id, step_id, fqn FROM ({_MEMBERS}) m WHERE role <> 'output'", _V)
def all_inputs(spark, sf):
    nodes = _nodes_with(spark, sf, *lineage.MEMBER_COLUMNS)
    return lineage.all_inputs(lineage.step_members(nodes))


@query(
    "q_step_levels",
    f"""
    , deps AS ({_DEPS}),
    walk(doc_id, node, level) AS (
      SELECT doc_id, node, 1 FROM (SELECT doc_id, up_step AS node FROM deps EXCEPT SELECT doc_id, down_step FROM deps) r
      UNION SELECT d.doc_id, d.down_step, w.level + 1 FROM walk w JOIN deps d ON d.doc_id = w.doc_id AND d.up_step = w.node)
    SELECT doc_id, node, max(level) AS level FROM walk GROUP BY 1, 2
    """,
    _V,
)
def step_levels(spark, sf):
    docs = history_documents(spark, sf, clustered=False).select("doc_id", F.col("body").alias("doc"))
    return flows.lineage_tables(docs, PREFIX, ("levels",))["levels"]


@query(
    "q_versions",
    r"""
    SELECT artifact, count(DISTINCT w) AS n_versions, max(w) AS newest, count(*) AS n_seen
    FROM (SELECT artifact, cast(regexp_extract(recorded, '(\d{4}-\d\d-\d\d \d\d:\d\d:\d\d)$', 1) AS timestamp) AS w
          FROM history_nodes) x GROUP BY 1
    """,
    _V,
)
def versions(spark, sf):
    return lineage.versions(_nodes(spark, sf, at_once=True))


@query(
    "q_fqn_collisions",
    f"""
    SELECT fqn, count(*) AS n_artifacts FROM (SELECT DISTINCT artifact, {_fqn('artifact')} AS fqn FROM (
      SELECT artifact FROM history_nodes UNION ALL
      SELECT CASE WHEN starts_with(artifact, '/') THEN substr(artifact, 8) ELSE '/copy/' || artifact END
      FROM history_nodes WHERE script = 'make ref.py') b) a GROUP BY 1 HAVING count(*) > 1
    """,
    _V,
)
def fqn_collisions(spark, sf):
    nodes = _nodes_with(spark, sf, "artifact", "script", together=False)
    copied = F.when(
        F.startswith("artifact", F.lit("/")), F.substr("artifact", F.lit(8))
    ).otherwise(F.concat(F.lit("/copy/"), "artifact"))
    paths = F.when(F.col("script") == "make ref.py", F.array("artifact", copied)).otherwise(F.array("artifact"))
    # Counted and not only made distinct, which Spark would leave to the next distinct, after the names of all nodes.
    seen = nodes.select(F.explode(paths).alias("artifact")).groupBy("artifact").agg(F.count("*").alias("n")).filter("n > 0")
    both = seen.withColumn("fqn", lineage.artifact_fqn(PREFIX, "artifact"))
    return lineage.fqn_collisions(lineage.distinct_artifacts(both))


@query("q_artifacts", f"SELECT DISTINCT artifact, {_fqn('artifact')} AS fqn FROM history_nodes", _V)
def artifacts(spark, sf):
    return lineage.distinct_artifacts(_nodes(spark, sf, at_once=True))


@query("q_edges_roots", "SELECT parent AS node FROM edges EXCEPT SELECT child FROM edges", ("edges",))
def edge_roots(spark, sf):
    return graph.roots(view(spark, sf, "edges"))


@query("q_leaves", "SELECT child AS node FROM edges EXCEPT SELECT parent FROM edges", ("edges",))
def edge_leaves(spark, sf):
    return graph.leaves(view(spark, sf, "edges"))


@query(
    "q_degree",
    """
    SELECT node, n_in, n_out, CASE WHEN n_in > 1 AND n_out > 1 THEN 'both' WHEN n_in > 1 THEN 'fan_in'
           WHEN n_out > 1 THEN 'fan_out' WHEN n_in = 1 AND n_out = 1 THEN 'chain' ELSE 'end' END AS shape
    FROM (SELECT node, cast(sum(i) AS bigint) AS n_in, cast(sum(o) AS bigint) AS n_out
          FROM (SELECT parent AS node, 0 AS i, 1 AS o FROM edges UNION ALL SELECT child, 1, 0 FROM edges) x GROUP BY 1) d
    """,
    ("edges",),
)
def degree(spark, sf):
    return graph.fan_shapes(view(spark, sf, "edges"))


_WALK = """
    , walk(node, ancestor, distance) AS (
      SELECT child, parent, 1 FROM edges WHERE starts_with(child, '{0}/')
      UNION SELECT w.node, e.parent, w.distance + 1 FROM walk w JOIN edges e ON e.child = w.ancestor)
    SELECT node, ancestor, min(distance) AS distance FROM walk GROUP BY 1, 2
"""


@query("q_ancestors", _WALK.format("lines"), ("edges",))
def ancestors(spark, sf):
    edges = view(spark, sf, "edges")
    start = table(spark, sf, "lineitem").select(line_nodes().alias("node"))
    return graph.ancestors(edges, start)


@query(
    "q_descendants",
    """
    , walk(node, descendant, distance) AS (
      SELECT parent, child, 1 FROM edges WHERE starts_with(parent, 'customer/')
      UNION SELECT w.node, e.child, w.distance + 1 FROM walk w JOIN edges e ON e.parent = w.descendant)
    SELECT node, descendant, min(distance) AS distance FROM walk GROUP BY 1, 2
    """,
    ("edges",),
)
def descendants(spark, sf):
    edges = view(spark, sf, "edges")
    start = table(spark, sf, "orders").select(F.concat(F.lit("customer/"), "o_custkey").alias("node"))
    return graph.descendants(edges, start)


@query(
    "q_levels",
    """
    , walk(node, level) AS (
      SELECT node, 1 FROM (SELECT parent AS node FROM edges EXCEPT SELECT child FROM edges) r
      UNION SELECT e.child, w.level + 1 FROM walk w JOIN edges e ON e.parent = w.node)
    SELECT node, max(level) AS level FROM walk GROUP BY 1
    """,
    ("edges",),
)
def levels(spark, sf):
    return graph.levels(view(spark, sf, "edges"))


_KNOWN = "SELECT f.fqn FROM customer_fqns f WHERE f.c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')"


def _entity_sql(source: str) -> str:
    parts = "string_split(fqn, '.')"
    return " UNION ".join(
        f"SELECT array_to_string({parts}[1:{i + 1}], '.') AS fqn, '{kind}' AS kind, "
        + (f"array_to_string({parts}[1:{i}], '.')" if i else "cast(NULL AS varchar)")
        + f" AS parent_fqn FROM ({source}) s{i}"
        for i, kind in enumerate(catalog.KINDS)
    )


def _known(spark, sf):
    done = table(spark, sf, "orders").filter(F.col("o_orderstatus") == "F").select(F.col("o_custkey").alias("c_custkey"))
    return view(spark, sf, "customer_fqns").join(done, "c_custkey", "left_semi")


@query(
    "q_register_missing",
    f"""
    SELECT fqn, kind, parent_fqn, CASE kind WHEN 'service' THEN 1 WHEN 'database' THEN 2 WHEN 'schema' THEN 3 ELSE 4 END
           AS create_order
    FROM ({_entity_sql('SELECT fqn FROM customer_fqns')}) c
    WHERE fqn NOT IN (SELECT fqn FROM ({_entity_sql(_KNOWN)}) k)
    """,
    ("customer_fqns",),
)
def register_missing(spark, sf):
    candidates = catalog.with_parents(view(spark, sf, "customer_fqns"))
    return catalog.register_missing(candidates, catalog.with_parents(_known(spark, sf)))


@query(
    "q_registered",
    _entity_sql("SELECT fqn FROM customer_fqns"),
    ("customer_fqns",),
)
def registered(spark, sf):
    candidates = catalog.with_parents(view(spark, sf, "customer_fqns"))
    return catalog.registered(candidates, catalog.with_parents(_known(spark, sf)))


@query(
    "q_catalog_path",
    """
    SELECT fqn AS table_fqn, array_to_string(string_split(fqn, '.')[1:3], '.') AS schema_fqn,
           array_to_string(string_split(fqn, '.')[1:2], '.') AS database_fqn, string_split(fqn, '.')[1] AS service_fqn
    FROM customer_fqns
    """,
    ("customer_fqns",),
)
def catalog_path(spark, sf):
    stored = cut(catalog.with_parents(view(spark, sf, "customer_fqns")), "catalog")
    return catalog.catalog_path(stored)


@query(
    "q_declared_edges",
    """
    SELECT DISTINCT i.dag, i.key, i.fqn AS from_fqn, o.fqn AS to_fqn FROM declared i JOIN declared o
    ON i.dag = o.dag AND i.key = o.key WHERE i.direction = 'inlet' AND o.direction = 'outlet'
    """,
    ("declared",),
)
def declared_edges(spark, sf):
    return lineage.declared_edges(view(spark, sf, "declared"))


@query(
    "q_declared_groups",
    """
    SELECT dag, key, count(DISTINCT fqn) FILTER (direction = 'inlet') AS n_inlets,
           count(DISTINCT fqn) FILTER (direction = 'outlet') AS n_outlets FROM declared GROUP BY 1, 2
    """,
    ("declared",),
)
def declared_groups(spark, sf):
    return lineage.declared_groups(view(spark, sf, "declared"))


_DECLARED = """
    SELECT DISTINCT i.dag, i.key, i.fqn AS from_fqn, o.fqn AS to_fqn FROM declared i JOIN declared o
    ON i.dag = o.dag AND i.key = o.key WHERE i.direction = 'inlet' AND o.direction = 'outlet'
"""


@query(
    "q_declared_hubs",
    f"""
    SELECT fqn, cast(sum(i) AS bigint) AS n_in, cast(sum(o) AS bigint) AS n_out FROM (
      SELECT from_fqn AS fqn, 0 AS i, 1 AS o FROM ({_DECLARED}) a
      UNION ALL SELECT to_fqn, 1, 0 FROM ({_DECLARED}) b) e GROUP BY 1
    """,
    ("declared",),
)
def declared_hubs(spark, sf):
    return lineage.hub_degrees(lineage.declared_hubs(view(spark, sf, "declared")))


@query(
    "q_declared_reach",
    f"""
    , d AS (SELECT DISTINCT from_fqn, to_fqn FROM ({_DECLARED}) x),
    walk(node, ancestor, distance) AS (
      SELECT to_fqn, from_fqn, 1 FROM d
      UNION SELECT w.node, d.from_fqn, w.distance + 1 FROM walk w JOIN d ON d.to_fqn = w.ancestor WHERE w.distance < 50)
    SELECT node, ancestor, min(distance) AS distance FROM walk GROUP BY 1, 2
    """,
    ("declared",),
)
def declared_reach(spark, sf):
    start = table(spark, sf, "lineitem").select(line_nodes().alias("node"))
    return lineage.hub_ancestors(lineage.declared_hubs(view(spark, sf, "declared")), start)


_PROVEN = """
    SELECT 'dag-' || cast(l_orderkey AS varchar) AS dag, 'outlet' AS direction, 'lines/' || cast(l_orderkey AS varchar)
           || '-' || cast(l_partkey AS varchar) || '-' || cast(l_suppkey AS varchar) AS fqn FROM lineitem
    UNION SELECT 'dag-' || cast(l_orderkey AS varchar), 'inlet', 'part/' || cast(l_partkey AS varchar)
    FROM lineitem WHERE l_returnflag <> 'R'
"""


@query(
    "q_orphans",
    f"""
    SELECT *, 'proven' AS only_in FROM (({_PROVEN}) EXCEPT SELECT dag, direction, fqn FROM declared) a
    UNION ALL SELECT *, 'declared' FROM (SELECT dag, direction, fqn FROM declared EXCEPT ({_PROVEN})) b
    """,
    ("declared",),
)
def orphans(spark, sf):
    made = F.struct(F.lit("outlet").alias("direction"), line_nodes().alias("fqn"))
    used = F.when(
        F.col("l_returnflag") != "R",
        F.struct(F.lit("inlet").alias("direction"), F.concat(F.lit("part/"), "l_partkey").alias("fqn")),
    )
    proven = table(spark, sf, "lineitem").select(
        F.concat(F.lit("dag-"), "l_orderkey").alias("dag"), F.inline(F.array_compact(F.array(made, used)))
    )
    return lineage.orphans(proven, view(spark, sf, "declared"), ["dag", "direction", "fqn"])


_OUTLETS = "SELECT DISTINCT dag, task, '/data/' || dag || '/' || task AS url FROM task_runs"


def _outlets(spark, sf):
    runs = view(spark, sf, "task_runs").select("dag", "task").distinct()
    return runs.withColumn("url", F.concat_ws("/", F.lit("/data"), "dag", "task"))


@query(
    "q_auto_inlets",
    f"""
    SELECT DISTINCT e.dag, e.child AS task, o.url, row_number() OVER (PARTITION BY e.dag, e.child ORDER BY o.url) AS inlet_no
    FROM task_edges e JOIN ({_OUTLETS}) o ON o.dag = e.dag AND o.task = e.parent WHERE e.child IN ('t2', 't4')
    """,
    ("task_edges", "task_runs"),
)
def auto_inlets(spark, sf):
    edges = view(spark, sf, "task_edges")
    wanting = edges.filter(F.col("child").isin("t2", "t4")).select("dag", F.col("child").alias("task")).distinct()
    return lineage.numbered_inlets(lineage.auto_inlets(edges, _outlets(spark, sf), wanting))


@query(
    "q_named_inlets",
    f"""
    SELECT o.dag, 't4' AS task, o.url FROM ({_OUTLETS}) o JOIN dags d ON d.dag = o.dag WHERE o.task IN ('t1', 't3')
    """,
    ("dags", "task_runs"),
)
def named_inlets(spark, sf):
    edges = view(spark, sf, "task_edges")
    dags = view(spark, sf, "dags")
    references = dags.select(
        "dag", F.lit("t4").alias("task"), F.explode(F.array(*[F.lit(t) for t in ("t1", "t3", "t5")])).alias("ref")
    )
    reach = graph.ancestors(edges, dags.withColumn("node", F.lit("t4")), ["dag"])
    return lineage.named_inlets(references, reach, _outlets(spark, sf))
