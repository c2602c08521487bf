"""Column expressions on product names and paths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Scene-key prefix by platform, and the name patterns.
SENTINEL_PREFIXES = {"S2A": "cemsre_", "S2B": "cfmsre_", "S2C": "cgmsre_"}
SENTINEL_TILE_DATE = r"(T\d{2}[A-Z]{3}_\d{8})"
LANDSAT_L1TP = r"LC(\d{2})_L1TP_(\d{3})(\d{3})_(\d{8})"
STAGE_CODE_OFFSET = 23

SENTINEL_MODES = ("passthrough", "strict", "v2", "legacy")
WHITESPACE = " \t\r\n\f\x0b"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: str | Column) -> Column:
    """Remove white space of any kind from both ends."""
    return F.btrim(col(c), F.lit(WHITESPACE))


def _match(c: Column, pattern: str, group: int = 1) -> Column:
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def sentinel_scene_key(name: str | Column, mode: str = "passthrough") -> Column:
    """Scene key of a Sentinel-2 product name; null where the mode yields none.

    ``passthrough`` leaves the key of an unknown platform bare, ``strict`` gives null for it,
    ``v2`` does not know S2C, ``legacy`` uses the S2A prefix for every platform.
    """
    if mode not in SENTINEL_MODES:
        raise ValueError(f"unknown mode {mode!r}")
    name = col(name)
    key = F.lower(_match(name, SENTINEL_TILE_DATE))
    if mode == "legacy":
        return F.concat(F.lit(SENTINEL_PREFIXES["S2A"]), key)
    known = {p: x for p, x in SENTINEL_PREFIXES.items() if not (mode == "v2" and p == "S2C")}
    platform = F.substring(name, 1, 3)
    found = F.coalesce(*[F.when(platform == p, F.lit(x)) for p, x in known.items()])
    return F.concat(found if mode == "strict" else F.coalesce(found, F.lit("")), key)


def sentinel_scenes(df: DataFrame, name: str, mode: str = "passthrough") -> DataFrame:
    """Add ``scene_key``; names without a key are dropped, except in strict and legacy mode."""
    out = df.withColumn("scene_key", sentinel_scene_key(name, mode))
    return out if mode in ("strict", "legacy") else out.filter(F.col("scene_key").isNotNull())


def landsat_scene_key(name: str | Column) -> Column:
    """``l<platform digit>olre_p<path>r<row>_<date>`` of an L1TP product name, else null."""
    name = col(name)
    part = [_match(name, LANDSAT_L1TP, i) for i in range(1, 5)]
    return F.concat(
        F.lit("l"), F.substring(part[0], 2, 1), F.lit("olre_p"), part[1], F.lit("r"), part[2], F.lit("_"), part[3]
    )


def landsat_scenes(df: DataFrame, name: str) -> DataFrame:
    return df.filter(F.col(name).rlike(LANDSAT_L1TP)).withColumn("scene_key", landsat_scene_key(name))


def basename(path: str | Column) -> Column:
    return F.substring_index(col(path), "/", -1)


def stem(path: str | Column) -> Column:
    """Base name without its last extension."""
    return F.regexp_replace(basename(path), r"(?<=.)\.[^.]+$", "")


def extension(path: str | Column) -> Column:
    """Text after the last dot; the whole base name if it has none."""
    return F.substring_index(basename(path), ".", -1)


def drop_suffix(c: str | Column, n: int) -> Column:
    c = col(c)
    return F.left(c, F.greatest(F.length(c) - F.lit(n), F.lit(0)))


def _underscored(c: Column, *marks: str) -> Column:
    for mark in marks:  # a replacement works on bytes, a translation looks every character up
        c = F.replace(c, F.lit(mark), F.lit("_"))
    return c


def stage_code(path: str | Column, mode: str = "offset") -> Column:
    """Product code of a path.

    ``offset`` takes everything behind a fixed offset of the whole path, as recorded step names do;
    ``by_name`` takes the last underscore-separated part of the base name up to its first dot.
    """
    path = col(path)
    if mode == "offset":
        return _underscored(F.substr(path, F.lit(STAGE_CODE_OFFSET + 1)), "/", ".")
    if mode == "by_name":
        return F.substring_index(F.substring_index(basename(path), "_", -1), ".", 1)
    raise ValueError(f"unknown mode {mode!r}")


def step_id(script: str | Column, path: str | Column) -> Column:
    """Name of the processing step that wrote ``path`` with ``script``."""
    bare = F.replace(F.replace(col(script), F.lit(" "), F.lit("")), F.lit(".py"), F.lit(""))
    return F.concat(F.lower(F.replace(bare, F.lit("_"), F.lit("-"))), F.lit("_"), stage_code(path))


def artifact_fqn(prefix: str | Column, path: str | Column) -> Column:
    """Catalogue name of an artifact below ``prefix`` (``service.database.schema``)."""
    prefix = F.lit(prefix) if isinstance(prefix, str) else prefix
    return F.concat_ws(".", prefix, _underscored(basename(path), "."))


def recorded_path(recorded: str | Column) -> Column:
    return _match(col(recorded), r"(?s)^(.*) (\d{4}-.*)$", 1)


def recorded_at(recorded: str | Column) -> Column:
    return F.try_to_timestamp(_match(col(recorded), r"(?s)^(.*) (\d{4}-.*)$", 2), F.lit("yyyy-MM-dd HH:mm:ss"))


def replace_first(c: str | Column, old: str, new: str) -> Column:
    """Replace the first occurrence of a literal."""
    c = col(c)
    at = F.instr(c, F.lit(old))
    return F.when(
        at > 0, F.concat(F.left(c, at - 1), F.lit(new), F.substr(c, at + F.lit(len(old))))
    ).otherwise(c)


def derive_output(path: str | Column, swaps: list[tuple[str, str]]) -> Column:
    """Output name of a stage: each swap replaces the first occurrence of a code."""
    out = col(path)
    for old, new in swaps:
        out = replace_first(out, old, new)
    return out


def swap_extension(path: str | Column, old: str, new: str) -> Column:
    return F.replace(col(path), F.lit(old), F.lit(new))


def metadata_name(path: str | Column) -> Column:
    """Name of the history document that belongs to a product."""
    return F.concat(stem(path), F.lit("_metadata.json"))


def slot_of(task_id: str | Column) -> Column:
    return F.substring_index(col(task_id), "_", -1).cast("int")


def job_paths(directory: str | Column, script: str | Column, job_id: str | Column) -> Column:
    """Struct of the remote and local output and error files of a job."""
    base = F.concat(F.lit(directory) if isinstance(directory, str) else directory, F.lit("/"), col(script))
    local = F.concat(base, F.lit("_"), col(job_id).cast("string"))
    return F.struct(
        F.concat(base, F.lit(".out")).alias("remote_out"),
        F.concat(base, F.lit(".err")).alias("remote_err"),
        F.concat(local, F.lit(".out")).alias("local_out"),
        F.concat(local, F.lit(".err")).alias("local_err"),
    )


def run_key(prefix: str, *parts: str | Column) -> Column:
    return F.concat(F.lit(prefix), F.concat_ws("_", *[col(p).cast("string") for p in parts]))
