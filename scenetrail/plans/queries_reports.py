"""Queries of the SQL reports, tables and scalar helpers."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from scenetrail.functions import params as P
from scenetrail.operators import reports
from scenetrail.plans.derived import table
from scenetrail.plans.registry import query
from scenetrail.session import scratch_path
from scenetrail.sources import documents, tables

_CENTRE_1 = "SELECT cast(cast(o_orderdate AS date) AS varchar) AS day, o_orderstatus AS type, o_orderpriority AS name FROM orders"
_CENTRE_2 = "SELECT cast(cast(l_shipdate AS date) AS varchar), l_linestatus, l_returnflag FROM lineitem"


@query("q_combine", f"{_CENTRE_1} UNION {_CENTRE_2}")
def combined(spark, sf):
    a = table(spark, sf, "orders").select(
        F.to_date("o_orderdate").alias("day"), F.col("o_orderstatus").alias("type"), F.col("o_orderpriority").alias("name")
    )
    b = table(spark, sf, "lineitem").select(
        F.to_date("l_shipdate").alias("day"), F.col("l_linestatus").alias("type"), F.col("l_returnflag").alias("name")
    )
    return reports.combine(a, b).withColumn("day", F.col("day").cast("string"))


@query(
    "q_report",
    "SELECT cast(cast(ts AS date) AS varchar) AS day, nullif(event_type, 'signup') AS type, count(nullif(event_type, 'signup')) AS number FROM events GROUP BY 1, 2",  # noqa: E501
)
def report(spark, sf):
    events = table(spark, sf, "events").select(
        F.to_date("ts").alias("day"), F.nullif("event_type", F.lit("signup")).alias("type")
    )
    return reports.count_by(events, ["day", "type"], "type").withColumn("day", F.col("day").cast("string"))


@query("q_total", "SELECT cast(sum(cast(value AS decimal(18,2))) AS double) AS total FROM events")
def total(spark, sf):
    events = table(spark, sf, "events")
    return reports.total(events, F.col("value").cast("decimal(18,2)")).withColumn("total", F.col("total").cast("double"))


@query("q_mean", "SELECT avg(cast(round(value * 100) AS bigint)) AS mean FROM events")
def mean(spark, sf):
    return reports.mean(table(spark, sf, "events"), F.round(F.col("value") * 100).cast("long"))


_INSTANCES = """
    SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN 'running' WHEN 'O' THEN 'queued' ELSE 'success' END AS state,
           o_orderpriority AS queue FROM orders
"""


def _instances(spark, sf):
    state = (
        F.when(F.col("o_orderstatus") == "P", "running").when(F.col("o_orderstatus") == "O", "queued").otherwise("success")
    )
    return table(spark, sf, "orders").select("o_orderkey", state.alias("state"), F.col("o_orderpriority").alias("queue"))


@query("q_filter_state", f"SELECT * FROM ({_INSTANCES}) i WHERE state IN ('running', 'queued') AND queue <> '5-LOW'")
def filter_state(spark, sf):
    return reports.active(_instances(spark, sf), "5-LOW")


@query(
    "q_scale_target",
    f"""
    SELECT 'workers' AS kind, cast(ceil(count(*) / 16.0) AS bigint) AS target FROM ({_INSTANCES}) i
    WHERE state IN ('running', 'queued')
    UNION ALL SELECT 'workers outside queue', cast(ceil(count(*) / 16.0) AS bigint) FROM ({_INSTANCES}) i
    WHERE state IN ('running', 'queued') AND queue <> '5-LOW'
    UNION ALL SELECT 'triggerers', cast(ceil(count(*) / 1000.0) AS bigint) FROM orders
    """,
)
def scale_target(spark, sf):
    kinds = [("workers", reports.is_active(), 16), ("workers outside queue", reports.is_active("5-LOW"), 16), ("triggerers", F.lit(True), 1000)]
    return reports.scale_targets(_instances(spark, sf), kinds)


@query(
    "q_reconcile",
    """
    SELECT o_orderkey AS run, o_custkey % 7 AS reported, coalesce(n, 0) AS listed, o_custkey % 7 = coalesce(n, 0) AS matches
    FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) l ON l_orderkey = o_orderkey
    """,
)
def reconcile(spark, sf):
    reported = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("run"), (F.col("o_custkey") % 7).alias("num_files")
    )
    return reports.manifest_reconcile(reported, table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("run")), "run")


@query(
    "q_running_total",
    """
    SELECT slot_end, cast(sum(v) OVER (ORDER BY slot_end) AS double) AS total FROM (
      SELECT time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE AS slot_end, sum(cast(value AS decimal(18,2))) AS v
      FROM events GROUP BY 1) s
    """,
)
def running_total(spark, sf):
    events = table(spark, sf, "events").select(F.col("ts").cast("timestamp").alias("ts"), "value")
    out = reports.running_total(events, "ts", F.col("value").cast("decimal(18,2)"))
    return out.withColumn("total", F.col("total").cast("double"))


@query("q_ddl", "SELECT c_custkey, c_name, c_nationkey FROM customer UNION ALL SELECT s_suppkey, s_name, s_nationkey FROM supplier")
def ddl(spark, sf):
    name, path = f"combined_{uuid.uuid4().hex}", scratch_path(spark, "table")
    schema = "c_custkey BIGINT, c_name STRING, c_nationkey INT"
    tables.create_if_absent(spark, name, schema, path)
    tables.create_if_absent(spark, name, schema, path)
    tables.insert_into(table(spark, sf, "customer"), name)
    suppliers = table(spark, sf, "supplier").select(
        F.col("s_name").alias("c_name"), F.col("s_suppkey").alias("c_custkey"), F.col("s_nationkey").alias("c_nationkey")
    )
    tables.insert_into(suppliers, name)
    tables.drop_if_exists(spark, name)
    tables.drop_if_exists(spark, name)
    return spark.read.schema(schema).parquet(path)


@query(
    "q_values",
    """
    SELECT cast(since AS varchar) AS since, label, count(*) AS orders FROM orders JOIN (VALUES ('1-URGENT', DATE '1995-01-01', 'fast'),
      ('2-HIGH', DATE '1996-01-01', 'fast'), ('5-LOW', DATE '1997-01-01', 'slow')) v(priority, since, label)
    ON o_orderpriority = priority AND cast(o_orderdate AS date) >= since GROUP BY 1, 2
    """,
)
def literal_rows(spark, sf):
    labels = tables.values(
        spark,
        [("1-URGENT", "1995-01-01", "fast"), ("2-HIGH", "1996-01-01", "fast"), ("5-LOW", "1997-01-01", "slow")],
        "priority string, since date, label string",
    )
    joined = table(spark, sf, "orders").join(F.broadcast(labels), F.col("o_orderpriority") == F.col("priority"))
    dated = joined.filter(F.to_date("o_orderdate") >= F.col("since"))
    counted = dated.groupBy("since", "label").agg(F.count("*").alias("orders"))
    return counted.withColumn("since", F.col("since").cast("string"))


@query("q_state", "SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN '[\"' || replace(c_name, '#', '\",\"') || '\"]' ELSE '[]' END AS value FROM customer")
def keyed_state(spark, sf):
    path = scratch_path(spark, "state")
    customers = table(spark, sf, "customer")
    kept = customers.filter("c_acctbal > 0").select("c_custkey", F.split("c_name", "#").alias("items"))
    tables.state_put(kept, "c_custkey", "items", path)
    return tables.state_get(customers.select("c_custkey"), "c_custkey", path)


@query("q_items", "SELECT c_custkey, c_name, c_mktsegment, c_nationkey FROM customer")
def items(spark, sf):
    rows = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    return documents.write_items(rows, scratch_path(spark, "items"))


@query("q_items_dry_run", "SELECT '{\"c_custkey\":' || c_custkey || ',\"c_name\":\"' || c_name || '\"}' AS item FROM customer")
def items_dry_run(spark, sf):
    pretty = documents.write_items(table(spark, sf, "customer").select("c_custkey", "c_name"), "", dry_run=True)
    return pretty.select(F.regexp_replace("item", r"\s", "").alias("item"))


@query("q_archive", "SELECT doc_id, md5(text) AS digest, strlen(text) AS size FROM documents")
def archive(spark, sf):
    packed = table(spark, sf, "documents").select("doc_id", "text").mapInArrow(_pack, "path string, content binary")
    return documents.archive_members(packed).select(
        F.col("member").cast("long").alias("doc_id"), F.md5("content").alias("digest"), "size"
    )


_ARCHIVE_BYTES = 4 * 1024 * 1024


def _pack(batches):
    """Documents as archives, a member each; an archive ends when its texts come to 4 MB."""
    import io
    import tarfile

    import pyarrow as pa

    i = 0
    for batch in batches:
        entries, last = zip(batch.column("doc_id"), batch.column("text")), batch.num_rows - 1
        buffer, tar, held = None, None, 0
        for at, (doc_id, text) in enumerate(entries):
            if tar is None:
                buffer, held = io.BytesIO(), 0
                tar = tarfile.open(fileobj=buffer, mode="w:gz")
            data = text.as_buffer()
            info = tarfile.TarInfo(str(doc_id))
            info.size = data.size
            tar.addfile(info, pa.BufferReader(data))
            tar.members = []  # which would keep the headers of all members
            held += data.size
            if held >= _ARCHIVE_BYTES or at == last:
                tar.close()
                yield pa.RecordBatch.from_pydict({"path": [f"{i}.tar.gz"], "content": [buffer.getvalue()]})
                tar, i = None, i + 1


@query(
    "q_elapsed",
    """
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, count(*) AS n,
           cast(date_diff('second', o_orderdate, l_shipdate) AS bigint) AS seconds
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL
    """,
)
def elapsed(spark, sf):
    both = table(spark, sf, "lineitem").join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    text = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    seconds = P.elapsed_seconds(text("o_orderdate"), text("l_shipdate"))
    return both.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", seconds.alias("seconds")).groupBy(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "seconds"
    ).agg(F.count("*").alias("n"))


@query(
    "q_arith",
    """
    SELECT o_orderkey, o_custkey + 10 AS plus, o_custkey - 3 AS minus, o_orderstatus || '_downloaded' AS done,
           'preprocessed_' || o_orderkey AS prepared FROM orders
    """,
)
def arith(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey",
        P.plus_const("o_custkey", 10).alias("plus"),
        P.minus_const("o_custkey", 3).alias("minus"),
        P.label("o_orderstatus", suffix="_downloaded").alias("done"),
        P.label("o_orderkey", prefix="preprocessed_").alias("prepared"),
    )


@query(
    "q_render_dates",
    """
    SELECT o_orderkey, category, '/data/' || category || '/' || strftime(o_orderdate, '%Y-%m-%d') || '/'
           || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS dataset
    FROM orders, (VALUES ('raw'), ('clean'), ('final')) v(category)
    """,
)
def render_dates(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    template = "/data/{category}/{{ ds }}/{{ data_interval_start }}"
    return P.datasets_by_category(orders, template, "o_orderdate", ["raw", "clean", "final"]).drop("o_orderdate")


@query(
    "q_validate",
    """
    SELECT * FROM (
      SELECT o_orderkey, 'status' AS name, CASE WHEN o_orderstatus = 'P' THEN 'null' END AS violations FROM orders
      UNION ALL SELECT o_orderkey, 'priority', CASE WHEN length(o_orderpriority) > 8 THEN 'too long'
        WHEN length(o_orderpriority) < 6 THEN 'too short' END FROM orders) x WHERE violations IS NOT NULL
    """,
)
def validate(spark, sf):
    both = table(spark, sf, "orders").select(
        "o_orderkey",
        F.inline(
            F.array(
                F.struct(F.lit("status").alias("name"), F.nullif("o_orderstatus", F.lit("P")).alias("value")),
                F.struct(F.lit("priority").alias("name"), F.col("o_orderpriority").alias("value")),
            )
        ),
    )
    rules = {"status": {"min_length": 1, "max_length": 4}, "priority": {"nullable": True, "min_length": 6, "max_length": 8}}
    checked = P.validate_params(both, "name", "value", rules).filter(F.size("violations") > 0)
    return checked.select("o_orderkey", "name", F.array_join("violations", ",").alias("violations"))
