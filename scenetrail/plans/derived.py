"""Input views derived from the given tables.

Each text runs unchanged in Spark and in the SQL used to check results: integer arithmetic, string
concatenation and CASE only. Table names stand in braces.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scenetrail.session import spread

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()

YMD = "replace(substr(cast({0} AS string), 1, 10), '-', '')"


def _ymd(column: str) -> str:
    return YMD.format(column)


VIEWS: dict[str, str] = {}

VIEWS["s2_names"] = f"""
SELECT o_orderkey,
       'S2' || substr('ABCD', cast(o_orderkey % 4 + 1 AS int), 1) || '_MSIL1C_' || {_ymd('o_orderdate')}
       || 'T101531_N0402_R117_' || CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE 'T' END
       || lpad(cast(o_custkey % 60 + 1 AS string), 2, '0') || 'KPQ_' || {_ymd('o_orderdate')}
       || 'T113046.zip' AS file_name
FROM {{orders}}
"""

VIEWS["landsat_names"] = f"""
SELECT o_orderkey,
       'LC0' || cast(8 + o_orderkey % 2 AS string)
       || CASE WHEN o_orderkey % 5 = 0 THEN '_L1GT_' ELSE '_L1TP_' END
       || lpad(cast(o_custkey % 200 AS string), 3, '0') || lpad(cast(o_orderkey % 180 AS string), 3, '0')
       || '_' || {_ymd('o_orderdate')} || '_02_T1' AS file_name
FROM {{orders}}
"""

# A scene per order; the line number picks the product code, the supplier its family.
VIEWS["products"] = """
SELECT scene_key, family, code,
       scene_key || '_' || code || cast(l_partkey AS string) || '.img' AS file_name,
       l_orderkey, l_linenumber, l_partkey, l_suppkey
FROM (SELECT 'l' || cast(8 + l_orderkey % 2 AS string) || 'ol'
             || CASE WHEN l_suppkey % 4 = 0 THEN 'th' ELSE 're' END
             || '_p' || lpad(cast(l_orderkey AS string), 12, '0') AS scene_file,
             'scene-' || cast(l_orderkey AS string) AS scene_key,
             CASE WHEN l_suppkey % 4 = 0 THEN 'th' ELSE 're' END AS family,
             CASE l_linenumber WHEN 1 THEN 'da1' WHEN 2 THEN 'da2' WHEN 3 THEN 'da3' WHEN 4 THEN 'db3'
                  WHEN 5 THEN 'db8' WHEN 6 THEN 'dbg' ELSE 'dd6' END AS code,
             l_orderkey, l_linenumber, l_partkey, l_suppkey
      FROM {lineitem}) x
"""

VIEWS["s2_products"] = """
SELECT 'scene-' || cast(l_orderkey AS string) AS scene_key, 're' AS family,
       CASE WHEN l_linenumber <= 2 THEN 'ab0' WHEN l_linenumber = 3 THEN 'ab1' WHEN l_linenumber IN (4, 6) THEN 'aba'
            WHEN l_linenumber = 5 THEN 'abb' ELSE 'ad0' END AS code,
       'scene-' || cast(l_orderkey AS string) || '_' || cast(l_partkey AS string) || 'm.img' AS file_name
FROM {lineitem} WHERE l_orderkey % 5 > 0 OR l_linenumber > 2
"""

# One history per order line, as flat rows: a product made from a part and a supplier artifact, which
# share one raw input. Scripts and paths include the cases that are easy to get wrong.
VIEWS["history"] = """
SELECT doc_id, product, product_script, ref, ref_script, angle, raw_file, written, later
FROM (SELECT 'doc-' || cast(l_orderkey AS string) || '-' || cast(l_partkey AS string) || '-'
             || cast(l_suppkey AS string) || '-' || cast(l_linenumber AS string) || '-'
             || cast(cast(l_quantity AS bigint) AS string) || '-'
             || cast(cast(round(l_extendedprice * 100) AS bigint) AS string)  AS doc_id,
             'cgmsre_t21kpq_' || lpad(cast(l_orderkey AS string), 8, '0') || '_ad' || cast(l_linenumber AS string)
             || 'm4.img' AS product,
             CASE WHEN l_linenumber = 7 THEN ' ' ELSE 'Make_Index.py' END AS product_script,
             CASE WHEN l_partkey % 9 = 0 THEN '/store/' ELSE '' END
             || 'cgmsre_t21kpq_' || lpad(cast(l_partkey AS string), 8, '0') || '_abam4.img' AS ref,
             'make ref.py' AS ref_script,
             CASE WHEN l_suppkey % 5 = 0 THEN 'short' || cast(l_suppkey AS string) || '.img'
                  ELSE 'cgmsre_t21kpq_' || lpad(cast(l_suppkey AS string), 8, '0') || '_aa1m4.img' END AS angle,
             'cgmsre_t21kpq_' || lpad(cast(l_partkey AS string), 8, '0') || '_aa0m4.meta' AS raw_file,
             substr(cast(l_shipdate AS string), 1, 10) || ' 00:00:10' AS written,
             substr(cast(l_shipdate AS string), 1, 10) || ' 00:21:32' AS later
      FROM {lineitem}) x
"""

# Artifact rows of ``history`` as the recursive documents hold them (occurrences, depth first).
VIEWS["history_nodes"] = """
SELECT doc_id, 0 AS depth, cast(NULL AS string) AS parent_artifact, cast(NULL AS string) AS parent_script,
       product AS artifact, product_script AS script, product || ' ' || later AS recorded FROM {history}
UNION ALL
SELECT doc_id, 1, product, product_script, ref, ref_script, ref || ' ' || written FROM {history}
UNION ALL
SELECT doc_id, 1, product, product_script, angle, 'qv_sentinel2angles.py', angle || ' ' || later FROM {history}
UNION ALL
SELECT doc_id, 1, product, product_script, raw_file, '', raw_file || ' ' || written FROM {history}
UNION ALL
SELECT doc_id, 2, ref, ref_script, angle, 'qv_sentinel2angles.py', angle || ' ' || written FROM {history}
UNION ALL
SELECT doc_id, 2, ref, ref_script, raw_file, '', raw_file || ' ' || written FROM {history}
UNION ALL
SELECT doc_id, 2, angle, 'qv_sentinel2angles.py', raw_file, '', raw_file || ' ' || written FROM {history}
UNION ALL
SELECT doc_id, 3, angle, 'qv_sentinel2angles.py', raw_file, '', raw_file || ' ' || written FROM {history}
"""

# Foreign keys as edges from an input to an output.
VIEWS["edges"] = """
SELECT DISTINCT parent, child FROM (
  SELECT 'orders/' || cast(l_orderkey AS string) AS parent,
         'lines/' || cast(l_orderkey AS string) || '-' || cast(l_partkey AS string) || '-'
         || cast(l_suppkey AS string) AS child FROM {lineitem}
  UNION ALL
  SELECT 'part/' || cast(l_partkey AS string),
         'lines/' || cast(l_orderkey AS string) || '-' || cast(l_partkey AS string) || '-'
         || cast(l_suppkey AS string) FROM {lineitem}
  UNION ALL
  SELECT 'supplier/' || cast(l_suppkey AS string),
         'lines/' || cast(l_orderkey AS string) || '-' || cast(l_partkey AS string) || '-'
         || cast(l_suppkey AS string) FROM {lineitem}
  UNION ALL
  SELECT 'customer/' || cast(o_custkey AS string), 'orders/' || cast(o_orderkey AS string) FROM {orders}
  UNION ALL
  SELECT 'nation/' || cast(c_nationkey AS string), 'customer/' || cast(c_custkey AS string) FROM {customer}
  UNION ALL
  SELECT 'nation/' || cast(s_nationkey AS string), 'supplier/' || cast(s_suppkey AS string) FROM {supplier}
  UNION ALL
  SELECT 'region/' || cast(n_regionkey AS string), 'nation/' || cast(n_nationkey AS string) FROM {nation}) x
"""

# Catalogue names: service, region, nation, customer.
VIEWS["customer_fqns"] = """
SELECT c_custkey,
       'shop.' || replace(lower(r_name), ' ', '_') || '.' || lower(n_name) || '.customer_' || cast(c_custkey AS string) AS fqn
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey
"""

# Hand-declared lineage: inlets and outlets of the same key; some tasks declare the wrong side.
VIEWS["declared"] = """
SELECT 'dag-' || cast(l_orderkey AS string) AS dag, 'step-' || cast(l_linenumber AS string) AS key,
       'inlet' AS direction, 'part/' || cast(l_partkey AS string) AS fqn FROM {lineitem}
UNION ALL
SELECT 'dag-' || cast(l_orderkey AS string), 'step-' || cast(l_linenumber AS string),
       CASE WHEN l_suppkey % 10 = 0 THEN 'inlet' ELSE 'outlet' END,
       'lines/' || cast(l_orderkey AS string) || '-' || cast(l_partkey AS string) || '-'
       || cast(l_suppkey AS string) FROM {lineitem}
"""

# Poll texts of jobs.
VIEWS["job_status"] = """
SELECT event_id, 'job-' || cast(cast(floor(event_id / 8) AS bigint) AS string) AS job_id, ts AS observed_at,
       CASE event_type WHEN 'click' THEN 'PENDING' WHEN 'view' THEN 'RUNNING' WHEN 'purchase' THEN 'COMPLETED'
            WHEN 'error' THEN 'FAILED' ELSE '' END AS raw_state,
       CASE event_type WHEN 'click' THEN 'PD' WHEN 'view' THEN 'R' WHEN 'purchase' THEN 'CG' ELSE 'F' END AS code,
       event_type, user_id,
       cast(event_id % 3 AS int) AS exit_code, value
FROM {events}
"""

# Command output lines of jobs: one error line for some events, output lines for the others.
VIEWS["job_lines"] = """
SELECT 'job-' || cast(cast(floor(event_id / 8) AS bigint) AS string) AS job_id,
       CASE WHEN event_type = 'error' THEN 'err' ELSE 'out' END AS stream,
       event_id % 8 AS line_no, event_type || ' ' || cast(user_id AS string) AS line
FROM {events}
"""

# Runs of five tasks per dag; the newest order of a task and day decides its state.
VIEWS["task_runs"] = """
SELECT dag, task, logical_ts,
       CASE substr(newest, 13, 1) WHEN 'F' THEN 'success' WHEN 'O' THEN 'failed' ELSE 'running' END AS state
FROM (SELECT 'dag-' || cast(cast(floor(o_custkey / 10) AS bigint) AS string) AS dag,
             't' || substr(o_orderpriority, 1, 1) AS task, o_orderdate AS logical_ts,
             max(lpad(cast(o_orderkey AS string), 12, '0') || o_orderstatus) AS newest
      FROM {orders} GROUP BY 1, 2, 3) x
"""

VIEWS["dags"] = """
SELECT DISTINCT 'dag-' || cast(cast(floor(o_custkey / 10) AS bigint) AS string) AS dag FROM {orders}
"""

# t1 feeds t2 and t3, both feed t4; t5 stands alone.
VIEWS["task_edges"] = """
SELECT dag, 't1' AS parent, 't2' AS child FROM {dags} UNION ALL SELECT dag, 't1', 't3' FROM {dags}
UNION ALL SELECT dag, 't2', 't4' FROM {dags} UNION ALL SELECT dag, 't3', 't4' FROM {dags}
"""

# One message per purchase and error; the other events read.
VIEWS["messages"] = """
SELECT user_id, ts AS logical_ts, value FROM {events} WHERE event_type IN ('purchase', 'error')
"""

VIEWS["readers"] = """
SELECT event_id, user_id, ts AS logical_ts FROM {events} WHERE event_type IN ('click', 'view', 'signup')
"""

# A grid of orders, 128 wide, with the order status as value.
VIEWS["mask"] = """
SELECT 's' AS scene, 1 AS band, cast(floor(o_orderkey / 128) AS bigint) AS row, o_orderkey % 128 AS col,
       CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS value
FROM {orders}
"""

VIEWS["pixels"] = """
SELECT 's' || cast(l_suppkey AS string) AS scene, l_linenumber AS band, l_partkey AS row,
       l_orderkey % 2500 AS col, max(l_extendedprice) / 10 AS value
FROM {lineitem} GROUP BY 1, 2, 3, 4
"""

VIEWS["log_lines"] = """
SELECT o_orderkey,
       CASE WHEN o_orderkey % 11 = 0 THEN 'Failed to load qvf module.'
            WHEN o_orderstatus = 'P' THEN 'Stage finished.'
            WHEN o_orderstatus = 'O' THEN 'Failed at stage ' || cast(o_orderkey % 14 + 1 AS string) || ': command ended.'
            ELSE 'note' || chr(10) || 'Failed at stage ' || cast(o_orderkey % 14 + 1 AS string)
                 || ': Required input files not found.' || chr(10) || 'Failed at stage '
                 || cast(o_custkey % 14 + 1 AS string) || ': late.' END AS body
FROM {orders}
"""

VIEWS["downloads"] = """
SELECT page_id, CASE WHEN page_id % 10 = 0 THEN 'None' WHEN page_id % 10 = 1 THEN '' ELSE url END AS url,
       cast(CASE WHEN page_id % 10 = 2 THEN 22 ELSE 0 END AS int) AS exit_code,
       CASE WHEN page_id % 10 = 3 THEN ' warning ' WHEN page_id % 10 = 4 THEN '  ' ELSE '' END AS stderr,
       CASE WHEN page_id % 10 = 5 THEN NULL ELSE url || '/S2A_' || cast(page_id AS string) || '.zip' END AS uri
FROM {pages}
"""

VIEWS["tagged"] = """
SELECT o_orderkey,
       'start' || chr(10) || 'OUT_COUNT: 1' || chr(10) || ' OUT_COUNT: 99' || chr(10)
       || 'OUT_COUNT: ' || cast(o_custkey % 50 AS string) || chr(10)
       || CASE WHEN o_orderkey % 6 = 0 THEN 'end' ELSE 'OUT_PATH: /lists/OUT_PATH:'
               || cast(o_custkey AS string) || '.txt ' END AS body
FROM {orders}
"""

VIEWS["list_text"] = """
SELECT o_orderkey,
       '[' || chr(39) || o_orderpriority || chr(39) || ', ' || chr(39) || o_orderstatus || chr(39) || ', '
       || chr(39) || 'c' || cast(o_custkey AS string) || chr(39) || ']' AS body
FROM {orders}
"""

VIEWS["heads"] = """
SELECT page_id,
       'HTTP/1.1 302 Found' || chr(13) || chr(10) || 'location: lower' || chr(13) || chr(10)
       || CASE WHEN page_id % 8 = 0 THEN '' ELSE 'Location:  ' || url || chr(13) || chr(10) || 'Location: second' END AS body
FROM {pages}
"""

VIEWS["poll_text"] = """
SELECT event_id,
       'JOBID PARTITION NAME USER ST TIME NODES NODELIST' || CASE WHEN event_type = 'signup' THEN '' ELSE chr(10)
       || '  ' || cast(event_id AS string) || ' main  run me ' || code || CASE WHEN event_id % 9 = 0 THEN '' ELSE ' 0:01' END
       || ' 1 node' || chr(10) END AS queue_body,
       CASE WHEN raw_state = '' AND event_id % 2 = 0 THEN ''
            ELSE cast(event_id AS string) || '|' || CASE WHEN raw_state = '' THEN 'TIMEOUT' ELSE raw_state END || '|'
            || cast(exit_code AS string) || ':0|' END AS accounting_body,
       CASE WHEN event_type = 'error' THEN 'sbatch: error 7' ELSE 'note' || chr(10) || 'Submitted batch job '
            || cast(event_id AS string) || chr(10) END AS submit_body
FROM {job_status}
"""


def _needs(name: str) -> list[str]:
    """Views that a view is built on, in order, itself last."""
    out: list[str] = []
    for used in re.findall(r"\{(\w+)\}", VIEWS[name]):
        if used in VIEWS:
            out += [n for n in _needs(used) if n not in out]
    return [*out, name]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pairs(*pairs: tuple[Column, Column]) -> Column:
    return F.inline(F.array(*[F.struct(a.alias("parent"), b.alias("child")) for a, b in pairs]))


def _key(prefix: str, *columns: str) -> Column:
    return F.concat(F.lit(f"{prefix}/"), F.concat_ws("-", *[F.col(c).cast("string") for c in columns]))


def line_nodes() -> Column:
    return _key("lines", "l_orderkey", "l_partkey", "l_suppkey")


def _edges(t) -> DataFrame:
    """Each edge once. Keys are made distinct as numbers, before names are made of them; equal keys are equal names.

    Only the name of a line that lacks a key can be that of another one, so these few edges are compared by name.
    """
    line = line_nodes()
    keys = ["l_orderkey", "l_partkey", "l_suppkey"]
    fed = _pairs((_key("orders", keys[0]), line), (_key("part", keys[1]), line), (_key("supplier", keys[2]), line))
    lacking = reduce(Column.__or__, [F.col(k).isNull() for k in keys])
    links = [("orders", "customer", "o_custkey", "orders", "o_orderkey"), ("customer", "nation", "c_nationkey", "customer", "c_custkey"),
             ("supplier", "nation", "s_nationkey", "supplier", "s_suppkey"), ("nation", "region", "n_regionkey", "nation", "n_nationkey")]
    parts = [
        t("lineitem").filter(~lacking).select(*keys).distinct().select(fed),
        t("lineitem").filter(lacking).select(fed).distinct(),
        *[t(used).select(a, b).distinct().select(_pairs((_key(up, a), _key(down, b)))) for used, up, a, down, b in links],
    ]
    return reduce(DataFrame.unionByName, parts)


def _task_edges(t) -> DataFrame:
    links = [(F.lit(a), F.lit(b)) for a, b in (("t1", "t2"), ("t1", "t3"), ("t2", "t4"), ("t3", "t4"))]
    return t("dags").select("dag", _pairs(*links))


def _declared(t) -> DataFrame:
    side = F.when(F.col("l_suppkey") % 10 == 0, F.lit("inlet")).otherwise(F.lit("outlet"))
    rows = F.array(
        F.struct(F.lit("inlet").alias("direction"), _key("part", "l_partkey").alias("fqn")),
        F.struct(side.alias("direction"), line_nodes().alias("fqn")),
    )
    return t("lineitem").select(
        F.concat(F.lit("dag-"), "l_orderkey").alias("dag"),
        F.concat(F.lit("step-"), "l_linenumber").alias("key"),
        F.inline(rows),
    )


# Views that Spark makes from one scan per table, where the text unites several.
ONE_SCAN = {"edges": _edges, "task_edges": _task_edges, "declared": _declared}


def view(spark: SparkSession, sf_dir: str, name: str, spread_scans: bool = False) -> DataFrame:
    """A derived view as a DataFrame."""

    def source(used: str) -> DataFrame:
        if used in VIEWS:
            return view(spark, sf_dir, used, spread_scans)
        scan = table(spark, sf_dir, used)
        return spread(scan) if spread_scans else scan

    if name in ONE_SCAN:
        return ONE_SCAN[name](source)
    return spark.sql(VIEWS[name], **{u: source(u) for u in set(re.findall(r"\{(\w+)\}", VIEWS[name]))})


def with_views(sql: str, *names: str) -> str:
    """The check SQL with the views it reads put in front."""
    order: list[str] = []
    for name in names:
        order += [n for n in _needs(name) if n not in order]
    parts = [f"{n} AS ({re.sub(r'[{](\w+)[}]', r'\1', VIEWS[n]).strip()})" for n in order]
    return "WITH RECURSIVE " + ", ".join(parts) + " " + sql.strip()
