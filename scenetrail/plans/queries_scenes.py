"""Queries on product names, manifests, slots and stage plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from scenetrail.functions import names as N
from scenetrail.functions import text as X
from scenetrail.operators import ordered, slots, stages
from scenetrail.plans import flows, stage_data
from scenetrail.plans.derived import table, view
from scenetrail.plans.registry import query
from scenetrail.session import scratch_path
from scenetrail.sources import manifests

_TILE = r"T\d{2}[A-Z]{3}_\d{8}"
_PREFIX = "WHEN 'S2A' THEN 'cemsre_' WHEN 'S2B' THEN 'cfmsre_'"
_C = "WHEN 'S2C' THEN 'cgmsre_'"
_STRIP = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _scene_sql(prefix: str, keep_all: bool) -> str:
    where = "" if keep_all else f" WHERE regexp_matches(file_name, '{_TILE}')"
    key = f"{prefix} || nullif(lower(regexp_extract(file_name, '{_TILE}')), '')"
    return f"SELECT o_orderkey, {key} AS scene_key FROM s2_names{where}"


def _scenes(mode: str):
    def run(spark, sf):
        return N.sentinel_scenes(view(spark, sf, "s2_names"), "file_name", mode).select("o_orderkey", "scene_key")

    return run


for _mode, _prefix, _keep in (
    ("passthrough", f"CASE substr(file_name, 1, 3) {_PREFIX} {_C} ELSE '' END", False),
    ("strict", f"CASE substr(file_name, 1, 3) {_PREFIX} {_C} END", True),
    ("v2", f"CASE substr(file_name, 1, 3) {_PREFIX} ELSE '' END", False),
    ("legacy", "'cemsre_'", True),
):
    query(f"q_scene_key_{_mode}", _scene_sql(_prefix, _keep), ("s2_names",))(_scenes(_mode))


_LANDSAT = r"LC(\d{2})_L1TP_(\d{3})(\d{3})_(\d{8})"


@query(
    "q_landsat_key",
    f"""
    SELECT o_orderkey, 'l' || substr(regexp_extract(file_name, '{_LANDSAT}', 1), 2) || 'olre_p'
           || regexp_extract(file_name, '{_LANDSAT}', 2) || 'r' || regexp_extract(file_name, '{_LANDSAT}', 3) || '_'
           || regexp_extract(file_name, '{_LANDSAT}', 4) AS scene_key
    FROM landsat_names WHERE regexp_matches(file_name, '{_LANDSAT}')
    """,
    ("landsat_names",),
)
def landsat_key(spark, sf):
    return N.landsat_scenes(view(spark, sf, "landsat_names"), "file_name").select("o_orderkey", "scene_key")


@query(
    "q_scene_counts",
    f"""
    SELECT platform, scene_key, count(*) AS n FROM (
      SELECT substr(file_name, 1, 3) AS platform, CASE substr(file_name, 1, 3) {_PREFIX} {_C} ELSE '' END
             || lower(regexp_extract(file_name, '{_TILE}')) AS scene_key
      FROM s2_names WHERE regexp_matches(file_name, '{_TILE}')) x GROUP BY 1, 2
    """,
    ("s2_names",),
)
def scene_counts(spark, sf):
    keyed = N.sentinel_scenes(view(spark, sf, "s2_names"), "file_name")
    return keyed.groupBy(F.substring("file_name", 1, 3).alias("platform"), "scene_key").agg(F.count("*").alias("n"))


@query(
    "q_product_parts",
    r"""
    SELECT doc_id, ref, regexp_extract(ref, '([^/]*)$', 1) AS base,
           regexp_replace(regexp_extract(ref, '([^/]*)$', 1), '\.[^.]+$', '') AS stem,
           list_extract(string_split(ref, '.'), -1) AS ext,
           replace(replace(substr(angle, 24), '/', '_'), '.', '_') AS angle_code,
           replace(replace(substr(ref, 24), '/', '_'), '.', '_') AS ref_code,
           string_split(list_extract(string_split(regexp_extract(ref, '([^/]*)$', 1), '_'), -1), '.')[1] AS ref_name_code,
           substr(product, 1, length(product) - 6) AS short
    FROM history
    """,
    ("history",),
)
def product_parts(spark, sf):
    return view(spark, sf, "history").select(
        "doc_id",
        "ref",
        N.basename("ref").alias("base"),
        N.stem("ref").alias("stem"),
        N.extension("ref").alias("ext"),
        N.stage_code("angle").alias("angle_code"),
        N.stage_code("ref").alias("ref_code"),
        N.stage_code("ref", "by_name").alias("ref_name_code"),
        N.drop_suffix("product", 6).alias("short"),
    )


@query(
    "q_derived_outputs",
    """
    SELECT file_name, regexp_replace(regexp_replace(file_name, 'da1', 'ddh'), 'n', 'N') AS stage_7,
           regexp_replace(file_name, 'dbg', 'dil') AS stage_12, replace(file_name, '.img', '.tif') AS tif
    FROM (SELECT DISTINCT file_name FROM products) p
    """,
    ("products",),
)
def derived_outputs(spark, sf):
    return (
        view(spark, sf, "products")
        .select("file_name")
        .distinct()
        .select(
            "file_name",
            N.derive_output("file_name", [("da1", "ddh"), ("n", "N")]).alias("stage_7"),
            N.derive_output("file_name", [("dbg", "dil")]).alias("stage_12"),
            N.swap_extension("file_name", ".img", ".tif").alias("tif"),
        )
    )


@query(
    "q_manifest",
    f"""
    SELECT doc_id, line_no, trim(line, {_STRIP}) AS item FROM (
      SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) - 1 AS line_no
      FROM (SELECT doc_id, regexp_split_to_array(text, '\\r\\n|\\n|\\r') AS l FROM documents) a) b
    WHERE length(trim(line, {_STRIP})) > 0
    """,
)
def manifest(spark, sf):
    return manifests.manifest_items(table(spark, sf, "documents"), "text", "doc_id")


@query("q_manifest_write", "SELECT row_number() OVER (ORDER BY page_id) - 1 AS item_no, url AS item FROM pages")
def manifest_write(spark, sf):
    path = scratch_path(spark, "manifest")
    manifests.write_manifest(table(spark, sf, "pages"), "url", ["page_id"], path)
    items = manifests.read_manifest(spark, path)
    return ordered.enumerate_rows(items, ["path", "line_no"], "item_no").select("item_no", "item")


@query(
    "q_tagged_output",
    """
    SELECT o_orderkey, cast(n AS int) AS out_count, f AS out_path,
           CASE WHEN f IS NULL THEN 'missing out_path' END AS error
    FROM (SELECT o_orderkey,
                 trim(replace(list_filter(string_split(body, chr(10)), lambda x: starts_with(x, 'OUT_COUNT:'))[-1],
                              'OUT_COUNT:', '')) AS n,
                 trim(replace(list_filter(string_split(body, chr(10)), lambda x: starts_with(x, 'OUT_PATH:'))[-1],
                              'OUT_PATH:', '')) AS f
          FROM tagged) t
    """,
    ("tagged",),
)
def tagged_output(spark, sf):
    return manifests.read_tagged_output(
        view(spark, sf, "tagged"),
        "o_orderkey",
        "body",
        {"OUT_COUNT": "int", "OUT_PATH": "string"},
        required=("OUT_COUNT", "OUT_PATH"),
    )


@query(
    "q_list_literal",
    """
    SELECT o_orderkey, unnest(l) AS item, generate_subscripts(l, 1) - 1 AS idx
    FROM (SELECT o_orderkey, regexp_extract_all(body, '''([^'']*)''', 1) AS l FROM list_text) t
    """,
    ("list_text",),
)
def list_literal(spark, sf):
    return view(spark, sf, "list_text").select(
        "o_orderkey", F.posexplode(X.parse_list_literal("body")).alias("idx", "item")
    )


@query("q_decode_payload", "SELECT doc_id, md5(text || '#') AS digest, length(text) + 1 AS n FROM documents")
def decode_payload(spark, sf):
    plain = F.concat("text", F.lit("#"))
    sent = F.when(F.col("doc_id") % 2 == 0, F.base64(plain)).otherwise(plain)
    docs = table(spark, sf, "documents").select("doc_id", X.decode_payload(sent).alias("got"))
    return docs.select("doc_id", F.md5("got").alias("digest"), F.length("got").alias("n"))


@query(
    "q_slots",
    """
    SELECT c.o_custkey, s.slot, cast(o.o_orderkey AS varchar) AS item
    FROM (SELECT DISTINCT o_custkey FROM orders) c CROSS JOIN (SELECT unnest(range(5)) AS slot) s
    LEFT JOIN (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS slot
               FROM orders) o ON o.o_custkey = c.o_custkey AND o.slot = s.slot
    """,
)
def assigned_slots(spark, sf):
    runs = table(spark, sf, "orders").select("o_custkey", "o_orderkey", F.col("o_orderkey").cast("string").alias("item"))
    return slots.assign_slots(runs, "item", 5, ["o_orderkey"], ["o_custkey"])


@query(
    "q_slot_overflow",
    """
    SELECT o_custkey, o_orderkey FROM (
      SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS r FROM orders) o
    WHERE r > 5
    """,
)
def overflow(spark, sf):
    runs = table(spark, sf, "orders").select("o_custkey", "o_orderkey")
    return slots.slot_overflow(runs, 5, ["o_orderkey"], ["o_custkey"])


@query("q_enumerate", "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS idx FROM orders")
def enumerated(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return ordered.enumerate_rows(rows, ["o_orderdate", "o_orderkey"]).select("o_orderkey", "idx")


@query("q_first_file", "SELECT scene_key, code, min(file_name) AS file_name FROM products GROUP BY 1, 2", ("products",))
def first_files(spark, sf):
    return stages.first_file(view(spark, sf, "products"))


@query(
    "q_take",
    """
    SELECT event_type, idx, event_id FROM (
      SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS idx
      FROM events) e WHERE idx < 2
    """,
)
def taken(spark, sf):
    events = table(spark, sf, "events").select("event_type", "ts", "event_id")
    return slots.take(events, 2, ["ts", "event_id"], ["event_type"]).select("event_type", "idx", "event_id")


@query(
    "q_sorted",
    """
    SELECT o_orderkey, unnest(l) AS item, generate_subscripts(l, 1) - 1 AS idx
    FROM (SELECT o_orderkey, list_sort(regexp_extract_all(body, '''([^'']*)''', 1)) AS l FROM list_text) t
    """,
    ("list_text",),
)
def sorted_lists(spark, sf):
    lists = view(spark, sf, "list_text").select("o_orderkey", X.parse_list_literal("body").alias("items"))
    return slots.sorted_items(lists, "items").select("o_orderkey", F.posexplode("items").alias("idx", "item"))


@query("q_slot_of", "SELECT o_orderkey, cast(o_custkey % 5 AS int) AS slot FROM orders")
def slot_numbers(spark, sf):
    task = N.run_key("batch_processing.download_", F.col("o_custkey") % 5)
    return table(spark, sf, "orders").select("o_orderkey", N.slot_of(task).alias("slot"))


@query("q_meta_names", r"SELECT file_name, regexp_replace(file_name, '\.[^.]*$', '') || '_metadata.json' AS metadata_file FROM (SELECT DISTINCT file_name FROM products) p", ("products",))
def metadata_names(spark, sf):
    files = view(spark, sf, "products").select("file_name").distinct()
    return files.select("file_name", N.metadata_name("file_name").alias("metadata_file"))


def _rows(rows) -> str:
    return ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in r) + ")" for r in rows)


_S2_STAGES = _rows([(n, name, fatal) for s, n, name, fatal in stage_data.STAGES if s == "sentinel"])
_LS_INPUTS = _rows([(n, c, f) for s, n, codes, f in stage_data.STAGE_INPUTS if s == "landsat" for c in codes])
_LS_OUTPUTS = _rows([(n, c) for s, n, codes in stage_data.STAGE_OUTPUTS if s == "landsat" for c in codes])
_LS_FATAL = _rows([(n, fatal) for s, n, _, fatal in stage_data.STAGES if s == "landsat"])

_SCENE_LIST = f"""
    SELECT DISTINCT CASE substr(file_name, 1, 3) {_PREFIX} {_C} ELSE '' END
           || lower(regexp_extract(file_name, '{_TILE}')) AS scene_key
    FROM s2_names WHERE regexp_matches(file_name, '{_TILE}')
"""


def _scene_list(spark, sf):
    return N.sentinel_scenes(view(spark, sf, "s2_names"), "file_name").select("scene_key").distinct()


@query(
    "q_stage_plan",
    f"SELECT scene_key, stage_no, stage_name, fatal FROM ({_SCENE_LIST}) s CROSS JOIN (VALUES {_S2_STAGES}) t(stage_no, stage_name, fatal)",  # noqa: E501
    ("s2_names",),
)
def stage_plan(spark, sf):
    return stages.plan(_scene_list(spark, sf), "sentinel")


@query(
    "q_stage_chain",
    f"""
    SELECT scene_key, stage_no, coalesce(lag(stage_no) OVER (PARTITION BY scene_key ORDER BY stage_no), 0) AS after_stage
    FROM ({_SCENE_LIST}) s CROSS JOIN (VALUES {_S2_STAGES}) t(stage_no, stage_name, fatal)
    """,
    ("s2_names",),
)
def stage_chain(spark, sf):
    chain = stages.stage_chain(stages.plan(_scene_list(spark, sf), "sentinel"), "sentinel")
    return chain.select("scene_key", "stage_no", F.coalesce("after_stage", F.lit(0)).alias("after_stage"))


_READY = f"""
    SELECT s.scene_key, i.stage_no, i.code, i.family, min(p.file_name) AS file_name
    FROM (SELECT DISTINCT scene_key FROM products) s CROSS JOIN (VALUES {_LS_INPUTS}) i(stage_no, code, family)
    LEFT JOIN products p ON p.scene_key = s.scene_key AND p.code = i.code AND p.family = i.family
    GROUP BY 1, 2, 3, 4
"""


@query("q_stage_inputs", _READY, ("products",))
def stage_inputs(spark, sf):
    return stages.stage_input_files(view(spark, sf, "products"), "landsat")


_LS_SWAPS = _rows([(n, swaps[0][0], swaps[0][1]) for n, swaps in stage_data.OUTPUT_SWAPS])


@query(
    "q_stage_outputs",
    f"""
    SELECT scene_key, r.stage_no, regexp_replace(regexp_replace(file_name, old, new),
           CASE WHEN r.stage_no = 7 THEN 'th' ELSE '$^' END, 're') AS output_name
    FROM ({_READY}) r JOIN (VALUES {_LS_SWAPS}) o(stage_no, old, new) ON o.stage_no = r.stage_no AND o.old = r.code
    WHERE file_name IS NOT NULL
    """,
    ("products",),
)
def stage_outputs(spark, sf):
    return stages.stage_output_files(stages.stage_input_files(view(spark, sf, "products"), "landsat"))


@query(
    "q_stage_ready",
    f"""
    SELECT scene_key, stage_no, count(*) - count(file_name) AS missing, count(*) = count(file_name) AS ready
    FROM ({_READY}) r GROUP BY 1, 2
    """,
    ("products",),
)
def stage_ready(spark, sf):
    ready = stages.resolve_stage_inputs(view(spark, sf, "products"), "landsat")
    return ready.select("scene_key", "stage_no", "missing", "ready")


# The rows that the Sentinel stages read, written out: stages 1, 4 and 5 take the first file, 2 and 3 every file.
_S2_INPUTS = """
    SELECT * FROM (WITH s AS (SELECT DISTINCT scene_key FROM s2_products),
    f AS (SELECT DISTINCT scene_key, code, file_name FROM s2_products),
    one AS (SELECT scene_key, code, min(file_name) AS file_name FROM f GROUP BY 1, 2)
    SELECT s.scene_key, i.stage_no, 're' AS family, i.code, one.file_name
    FROM s CROSS JOIN (VALUES (1, 'ab0'), (4, 'aba'), (4, 'abb'), (5, 'aba')) i(stage_no, code)
    LEFT JOIN one ON one.scene_key = s.scene_key AND one.code = i.code
    UNION ALL SELECT s.scene_key, i.stage_no, 're', 'ab0', f.file_name
    FROM s CROSS JOIN (VALUES (2), (3)) i(stage_no) LEFT JOIN f ON f.scene_key = s.scene_key AND f.code = 'ab0') q
"""


@query("q_sentinel_inputs", _S2_INPUTS, ("s2_products",))
def sentinel_inputs(spark, sf):
    return stages.stage_input_files(view(spark, sf, "s2_products"), "sentinel")


@query(
    "q_sentinel_ready",
    f"""
    SELECT scene_key, stage_no, count(DISTINCT code) - count(DISTINCT CASE WHEN file_name IS NOT NULL THEN code END) AS missing,
           true AS ready FROM ({_S2_INPUTS}) r GROUP BY 1, 2
    """,
    ("s2_products",),
)
def sentinel_ready(spark, sf):
    ready = stages.resolve_stage_inputs(view(spark, sf, "s2_products"), "sentinel")
    return ready.select("scene_key", "stage_no", "missing", "ready")


@query(
    "q_stage_edges",
    f"""
    SELECT DISTINCT p.scene_key, o.stage_no AS up_stage, i.stage_no AS down_stage
    FROM products p JOIN (VALUES {_LS_OUTPUTS}) o(stage_no, code) ON o.code = p.code
    JOIN (VALUES {_LS_INPUTS}) i(stage_no, code, family) ON i.code = p.code AND i.family = p.family
    """,
    ("products",),
)
def stage_edges(spark, sf):
    of_sensor = F.col("sensor") == "landsat"
    return stages.scene_plan_edges(
        view(spark, sf, "products"),
        stage_data.stage_outputs(spark).filter(of_sensor),
        stage_data.stage_inputs(spark).filter(of_sensor),
    )


_FAILED = r"""
    SELECT o_orderkey, cast(regexp_extract(line, '^Failed at stage (\d+): (.*)$', 1) AS int) AS stage_no,
           trim(regexp_extract(line, '^Failed at stage (\d+): (.*)$', 2)) AS message
    FROM (SELECT o_orderkey, unnest(string_split(body, chr(10))) AS line FROM log_lines) l
    WHERE regexp_matches(line, '^Failed at stage \d+: ')
"""


@query("q_failures", _FAILED, ("log_lines",))
def stage_failures(spark, sf):
    return stages.failures(view(spark, sf, "log_lines"), "body", "o_orderkey")


@query(
    "q_setup_failures",
    "SELECT o_orderkey, 'qvf' AS module FROM log_lines WHERE starts_with(body, 'Failed to load')",
    ("log_lines",),
)
def setup_failures(spark, sf):
    return stages.setup_failures(view(spark, sf, "log_lines"), "body", "o_orderkey")


@query(
    "q_failure_summary",
    f"""
    SELECT f.stage_no, NOT (starts_with(message, 'Required input files not found') OR fatal) AS silent, count(*) AS failures
    FROM ({_FAILED}) f JOIN (VALUES {_LS_FATAL}) s(stage_no, fatal) ON s.stage_no = f.stage_no GROUP BY 1, 2
    """,
    ("log_lines",),
)
def failure_summary(spark, sf):
    failed = stages.failures(view(spark, sf, "log_lines"), "body", "o_orderkey")
    return stages.failure_summary(failed, "landsat")


_LS_STAGES = _rows([(n, name, fatal) for s, n, name, fatal in stage_data.STAGES if s == "landsat"])


@query(
    "q_landsat_batch",
    f"""
    SELECT scene_key, stage_no, stage_name, fatal, stage_no - 1 AS after_stage
    FROM (SELECT DISTINCT 'l' || substr(regexp_extract(file_name, '{_LANDSAT}', 1), 2) || 'olre_p'
                 || regexp_extract(file_name, '{_LANDSAT}', 2) || 'r' || regexp_extract(file_name, '{_LANDSAT}', 3) || '_'
                 || regexp_extract(file_name, '{_LANDSAT}', 4) AS scene_key
          FROM landsat_names WHERE regexp_matches(file_name, '{_LANDSAT}')) s
    CROSS JOIN (VALUES {_LS_STAGES}) t(stage_no, stage_name, fatal)
    """,
    ("landsat_names",),
)
def landsat_batch(spark, sf):
    text = F.concat(F.lit("['readme.txt', '"), "file_name", F.lit("']"))
    lists = view(spark, sf, "landsat_names").select(F.base64(text).alias("payload"))
    return flows.landsat_batch(lists, "payload").withColumn("after_stage", F.coalesce("after_stage", F.lit(0)))


@query(
    "q_sentinel_ingest",
    f"""
    SELECT o_custkey, slot, scene_key, stage_no, stage_name, fatal, stage_no - 1 AS after_stage
    FROM (SELECT o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY n.o_orderkey) - 1 AS slot,
                 CASE substr(file_name, 1, 3) {_PREFIX} {_C} END
                 || nullif(lower(regexp_extract(file_name, '{_TILE}')), '') AS scene_key
          FROM s2_names n JOIN orders o ON o.o_orderkey = n.o_orderkey) x
    CROSS JOIN (VALUES {_S2_STAGES}) t(stage_no, stage_name, fatal) WHERE slot < 5 AND scene_key IS NOT NULL
    """,
    ("s2_names",),
)
def sentinel_ingest(spark, sf):
    runs = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    found = view(spark, sf, "s2_names").join(runs, "o_orderkey")
    planned = flows.sentinel_ingest(found, "o_custkey", "file_name", ["o_orderkey"])
    return planned.withColumn("after_stage", F.coalesce("after_stage", F.lit(0)))
