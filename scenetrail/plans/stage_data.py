"""Reference data of the processing stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Fixed values: (sensor, number, name, ends the job on error).
STAGES = [
    ("landsat", 1, "incidence angles", True),
    ("landsat", 2, "toa_brdf_reflectance", True),
    ("landsat", 3, "topocorrectref", True),
    ("landsat", 4, "incidencemask", True),
    ("landsat", 5, "castshadowmask", False),
    ("landsat", 6, "fpc_topocorrected", False),
    ("landsat", 7, "temperature", False),
    ("landsat", 8, "watermask_topocorrected", False),
    ("landsat", 9, "surfacereflectance", False),
    ("landsat", 10, "ndvi", False),
    ("landsat", 11, "fmaskcloud", False),
    ("landsat", 12, "fractionalcover_sfcref", False),
    ("landsat", 13, "binarywatermask", False),
    ("landsat", 14, "waterindex_2015", False),
    ("sentinel", 1, "cloud mask", True),
    ("sentinel", 2, "topographic masks", True),
    ("sentinel", 3, "surface reflectance", True),
    ("sentinel", 4, "water index", True),
    ("sentinel", 5, "fractional cover", True),
]

# Fixed values: (sensor, stage, required product codes, family of the product name).
STAGE_INPUTS = [
    ("landsat", 1, ["da2"], "re"),
    ("landsat", 2, ["da1", "da2"], "re"),
    ("landsat", 3, ["db3", "da2", "da3"], "re"),
    ("landsat", 4, ["da3"], "re"),
    ("landsat", 5, ["da2"], "re"),
    ("landsat", 6, ["db8"], "re"),
    ("landsat", 7, ["da1"], "th"),
    ("landsat", 8, ["db8"], "re"),
    ("landsat", 9, ["da1", "da2", "da3"], "re"),
    ("landsat", 10, ["dbg"], "re"),
    ("landsat", 11, ["da1", "da2"], "re"),
    ("landsat", 11, ["dbh"], "th"),
    ("landsat", 12, ["dbg"], "re"),
    ("landsat", 13, ["dd6"], "re"),
    ("landsat", 14, ["dbg"], "re"),
    ("sentinel", 1, ["ab0"], "re"),
    ("sentinel", 2, ["ab0"], "re"),
    ("sentinel", 3, ["ab0"], "re"),
    ("sentinel", 4, ["aba", "abb"], "re"),
    ("sentinel", 5, ["aba"], "re"),
]

# Stages that run on every matching file; the others take the first.
ALL_FILES = [("sentinel", 2), ("sentinel", 3)]

# Sensors whose stages end at a missing input.
INPUT_CHECKED = ["landsat"]

# Fixed values: (sensor, stage, output product codes).
STAGE_OUTPUTS = [
    ("landsat", 1, ["da3"]),
    ("landsat", 2, ["db3"]),
    ("landsat", 3, ["db8"]),
    ("landsat", 4, ["ddc"]),
    ("landsat", 5, ["ddb"]),
    ("landsat", 7, ["ddh"]),
    ("landsat", 8, ["dd6"]),
    ("landsat", 9, ["dbg"]),
    ("landsat", 12, ["dil"]),
    ("landsat", 14, ["ddi", "ddj"]),
    ("sentinel", 1, ["ad2", "ad3", "ad4"]),
    ("sentinel", 2, ["ad0", "ad1"]),
    ("sentinel", 3, ["aba", "abb"]),
    ("sentinel", 4, ["ad5", "ad6"]),
    ("sentinel", 5, ["ac0"]),
]

# Fixed values: (Landsat stage, swaps of the first occurrence in the input's name that give an output's name).
OUTPUT_SWAPS = [
    (4, [("da3", "ddc")]),
    (5, [("da2", "ddb")]),
    (7, [("da1", "ddh"), ("th", "re")]),
    (9, [("da1", "dbg")]),
    (12, [("dbg", "dil")]),
    (14, [("dbg", "ddi")]),
    (14, [("dbg", "ddj")]),
]


def stages(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(STAGES, "sensor string, stage_no int, stage_name string, fatal boolean")


def stage_inputs(spark: SparkSession) -> DataFrame:
    rows = [(s, n, c, f) for s, n, codes, f in STAGE_INPUTS for c in codes]
    return spark.createDataFrame(rows, "sensor string, stage_no int, code string, family string")


def stage_outputs(spark: SparkSession) -> DataFrame:
    rows = [(s, n, c) for s, n, codes in STAGE_OUTPUTS for c in codes]
    return spark.createDataFrame(rows, "sensor string, stage_no int, code string")
