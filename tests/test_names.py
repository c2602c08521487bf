"""Names, texts and parameters on literal cases."""

import pytest
from pyspark.sql import functions as F

from scenetrail.functions import names as N
from scenetrail.functions import params as P
from scenetrail.functions import text as X
from scenetrail.sources import manifests

S2 = [
    ("S2B_MSIL1C_20230704T093549_N0402_R117_T21KPQ_20230704T113046.zip", "t21kpq_20230704", "cfmsre_"),
    ("S2A_MSIL1C_20220119T093401_N0402_R093_T33UVP_20220119T101010.zip", "t33uvp_20220119", "cemsre_"),
    ("S2C_MSIL1C_20231130T093409_N0402_R136_T10SEG_20231130T120207.zip", "t10seg_20231130", "cgmsre_"),
    ("S2D_MSIL1C_20231130T093409_N0402_R136_T10SEG_20231130T120207.zip", "t10seg_20231130", ""),
]


def one(spark, **columns):
    """Evaluate expressions on one row."""
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()


@pytest.mark.parametrize("mode", N.SENTINEL_MODES)
def test_sentinel_modes(spark, mode):
    df = spark.createDataFrame([(n,) for n, *_ in S2] + [("readme.txt",)], "file_name string")
    got = {r.file_name: r.scene_key for r in N.sentinel_scenes(df, "file_name", mode).collect()}
    for name, key, prefix in S2:
        want = prefix + key
        if mode == "strict" and not prefix:
            want = None
        if mode == "v2" and name.startswith("S2C"):
            want = key
        if mode == "legacy":
            want = "cemsre_" + key
        assert got[name] == want
    assert ("readme.txt" in got) == (mode in ("strict", "legacy"))
    assert got.get("readme.txt") is None


def test_unknown_mode_is_refused():
    with pytest.raises(ValueError):
        N.sentinel_scene_key("file_name", "other")


def test_landsat(spark, rows):
    names = ["LC09_L1TP_012031_20230209_x", "LC08_L1TP_012047_20230209_x", "LC09_L1GT_012031_20230209_x"]
    df = spark.createDataFrame([(n,) for n in names], "file_name string")
    got = rows(N.landsat_scenes(df, "file_name").select("scene_key"))
    assert got == [("l8olre_p012r047_20230209",), ("l9olre_p012r031_20230209",)]


def test_path_parts(spark):
    p = F.lit("/a/b.c/cgmsre_t10seg_20231130_abam4.tar.gz")
    short = F.lit("cgmsre_t10seg_20231130_abam4.img")
    got = one(
        spark,
        base=N.basename(p),
        stem=N.stem(p),
        ext=N.extension(p),
        hidden=N.stem(F.lit(".profile")),
        bare=N.stem(F.lit("plain")),
        code=N.stage_code(short),
        empty=N.stage_code(F.lit("short.img")),
        absolute=N.stage_code(F.lit("/store/scenes/2025/02/11/x_abam4.img")),
        by_name=N.stage_code(p, "by_name"),
        step=N.step_id(F.lit("Make_Ref.py.py"), short),
        space=N.step_id(F.lit(" "), F.lit("short.img")),
        fqn=N.artifact_fqn("a.b.c", p),
        meta=N.metadata_name(p),
        script=N.drop_suffix(F.lit("job_1.batch"), 6),
        tiny=N.drop_suffix(F.lit("abc"), 6),
        slot=N.slot_of(F.lit("batch.download_12")),
    ).asDict()
    assert got == {
        "base": "cgmsre_t10seg_20231130_abam4.tar.gz",
        "stem": "cgmsre_t10seg_20231130_abam4.tar",
        "ext": "gz",
        "hidden": ".profile",
        "bare": "plain",
        "code": "abam4_img",
        "empty": "",
        "absolute": "1_x_abam4_img",
        "by_name": "abam4",
        "step": "make-ref_abam4_img",
        "space": "_",
        "fqn": "a.b.c.cgmsre_t10seg_20231130_abam4_tar_gz",
        "meta": "cgmsre_t10seg_20231130_abam4.tar_metadata.json",
        "script": "job_1",
        "tiny": "",
        "slot": 12,
    }


def test_outputs_and_recorded(spark):
    got = one(
        spark,
        first=N.derive_output(F.lit("x_da1_th_da1.img"), [("da1", "ddh"), ("th", "re")]),
        none=N.derive_output(F.lit("x.img"), [("da1", "ddh")]),
        dollar=N.replace_first(F.lit("a$b$"), "$", "\\"),
        every=N.swap_extension(F.lit("a.img.img"), ".img", ".tif"),
        path=N.recorded_path(F.lit("/x y/a.img 2025-01-02 00:21:32")),
        at=N.recorded_at(F.lit("/x y/a.img 2025-01-02 00:21:32")).cast("string"),
        bad=N.recorded_at(F.lit("a.img 2025-13-02 00:21:32")),
    )
    assert tuple(got) == (
        "x_ddh_re_da1.img", "x.img", "a\\b$", "a.tif.tif", "/x y/a.img", "2025-01-02 00:21:32", None,
    )


HEADER = "JOBID PARTITION NAME USER ST TIME NODES NODELIST(REASON)\n"


@pytest.mark.parametrize(
    "body,status",
    [
        (HEADER, "done"),
        ("", "done"),
        (HEADER + " 7 main run me R 0:01 1 n1\n", "running"),
        (HEADER + " 7 main run me PD 0:01 1 n1\n", "running"),
        (HEADER + " 7 main run me CG 0:01 1 n1\n", "waiting"),
        (HEADER + " 7 main run me R 0:01 1\n", "malformed"),
    ],
)
def test_queue(spark, body, status):
    assert one(spark, s=X.queue_status(F.lit(body))).s == status


@pytest.mark.parametrize(
    "body,state,code",
    [
        ("12|COMPLETED|0:0|", "COMPLETED", 0),
        ("12|FAILED|2:0|", "FAILED", 2),
        ("", "UNKNOWN", None),
        ("12|TIMEOUT|0:1|", "UNMAPPED", 0),
        ("nonsense", "UNMAPPED", None),
    ],
)
def test_accounting(spark, body, state, code):
    got = one(spark, s=X.accounting_state(F.lit(body)), c=X.accounting_exit_code(F.lit(body)))
    assert (got.s, got.c) == (state, code)


def test_submit(spark):
    got = one(
        spark,
        ok=X.submitted_job(F.lit("note\nSubmitted batch job 77\n")),
        bad=X.submitted_job(F.lit("Submitted batch job 77\nbye 9")),
        word=X.submitted_job(F.lit("Submitted batch job 77\nbye 9"), strict=False),
        none=X.export_arg(F.create_map().cast("map<string,string>")),
        two=X.export_arg(F.create_map(F.lit("b"), F.lit("1"), F.lit("a"), F.lit("2"))),
    )
    assert tuple(got) == ("77", None, "9", "--export=", "--export=b=1,a=2")


def test_location(spark):
    body = "HTTP/1.1 302\r\nlocation: low\r\nLocation:  first x \r\nLocation: second"
    got = one(spark, a=X.location_header(F.lit(body)), b=X.location_header(F.lit("location: low")))
    assert tuple(got) == ("first x", None)


@pytest.mark.parametrize(
    "url,code,err,uri,status",
    [
        (None, 0, "", "u", "Skipped"),
        ("", 0, "", "u", "Skipped"),
        ("None", 0, "", "u", "Skipped"),
        ("x", 1, "", "u", "Failed"),
        ("x", 0, " warn ", "u", "Failed"),
        ("x", 0, "", None, "Failed"),
        ("x", 0, "  \n", "u", "Success"),
    ],
)
def test_download(spark, url, code, err, uri, status):
    cols = [F.lit(v).cast(t) for v, t in ((url, "string"), (code, "int"), (err, "string"), (uri, "string"))]
    assert one(spark, s=X.download_status(*cols)).s == status


def test_payloads_and_lists(spark):
    got = one(
        spark,
        b64=X.decode_payload(F.lit("w6kgYQ==")),
        raw=X.decode_payload(F.lit("not base64!")),
        lst=X.parse_list_literal(F.lit("['a', \"b\", 'c d']")),
        bad=X.parse_list_literal(F.lit("not a list")),
    )
    assert tuple(got) == ("é a", "not base64!", ["a", "b", "c d"], None)


def test_failures_in_logs(spark):
    log = F.lit("x\nFailed at stage 3: Required input files not found.\nFailed to load qvf module.\nFailed at stage 12: a: b\n")
    got = one(spark, f=X.stage_failures(log), m=X.module_failures(log))
    assert [tuple(f) for f in got.f] == [(3, "Required input files not found."), (12, "a: b")]
    assert got.m == ["qvf"]


def test_params(spark, rows):
    df = spark.createDataFrame([("p", v) for v in ("a", "ab", "abcd", "abcde", None)], "name string, value string")
    out = P.validate_params(df, "name", "value", {"p": {"min_length": 2, "max_length": 4}})
    got = {r.value: r.violations for r in out.collect()}
    assert got == {"a": ["too short"], "ab": [], "abcd": [], "abcde": ["too long"], None: ["null"]}
    free = P.validate_params(df, "name", "value", {"p": {"nullable": True}})
    assert free.filter(F.size("violations") > 0).count() == 0
    got = one(
        spark,
        s=P.elapsed_seconds(F.lit("2025-01-01 00:00:00"), F.lit("2025-01-02 00:00:01")),
        bad=P.elapsed_seconds(F.lit("x"), F.lit("2025-01-02 00:00:01")),
        day=P.render_dates("/d/{{ ds }}/x", F.lit("2025-03-04 05:06:07").cast("timestamp")),
    )
    assert tuple(got) == (86401, None, "/d/2025-03-04/x")


def test_tagged_output(spark):
    bodies = [
        (1, "XCOM_A: 1\r\nXCOM_A: 2XCOM_A:\n XCOM_B:no\nXCOM_B: yes "),
        (2, "XCOM_A: x\nXCOM_B:"),
        (3, "nothing"),
    ]
    df = spark.createDataFrame(bodies, "run int, body string")
    out = manifests.read_tagged_output(df, "run", "body", {"XCOM_A": "int", "XCOM_B": "string"}, ("XCOM_B",))
    got = {r.run: (r.xcom_a, r.xcom_b, r.error) for r in out.collect()}
    assert got == {1: (2, "yes", None), 2: (None, "", "missing xcom_b"), 3: (None, None, "missing xcom_b")}
