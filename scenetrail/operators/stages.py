"""Stage planning: scenes to stages, required inputs, dependencies and failures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scenetrail.functions.names import derive_output
from scenetrail.functions.text import module_failures, stage_failures
from scenetrail.plans import stage_data


def _stage_structs(sensor: str, *fields: str):
    """The stages of one sensor as an array literal; fixed and at most 14 long."""
    rows = [dict(zip(("sensor", "stage_no", "stage_name", "fatal"), r)) for r in stage_data.STAGES if r[0] == sensor]
    return F.array(*[F.struct(*[F.lit(r[f]).alias(f) for f in fields]) for r in rows])


def plan(scenes: DataFrame, sensor: str) -> DataFrame:
    """Every scene with every stage of its sensor. Rows grow in place, so nothing is shuffled."""
    return scenes.select("*", F.inline(_stage_structs(sensor, "stage_no", "stage_name", "fatal")))


def stage_chain(planned: DataFrame, sensor: str) -> DataFrame:
    """Add ``after_stage``, the stage that runs before in the same scene; null for the first.

    The chain depends on the sensor only, so it is looked up instead of windowed per scene.
    """
    numbers = sorted(n for s, n, *_ in stage_data.STAGES if s == sensor)
    before = F.create_map(*[F.lit(x) for pair in zip(numbers[1:], numbers[:-1]) for x in pair])
    return planned.withColumn("after_stage", F.try_element_at(before, F.col("stage_no")))


def first_file(products: DataFrame) -> DataFrame:
    """Lexicographically first file per scene and code."""
    return products.groupBy("scene_key", "code").agg(F.min("file_name").alias("file_name"))


def _wanted_inputs(sensor: str) -> dict[int, list[tuple[str, str]]]:
    """Stage number to its required (family, code) pairs."""
    wanted: dict[int, list[tuple[str, str]]] = {}
    for s, n, codes, family in stage_data.STAGE_INPUTS:
        if s == sensor:
            wanted.setdefault(n, []).extend((family, c) for c in codes)
    return dict(sorted(wanted.items()))


def _firsts_by_scene(products: DataFrame, wanted: dict[int, list[tuple[str, str]]]) -> DataFrame:
    """One row per scene with the first file of each (family, code) that some stage asks for.

    Each is a conditional minimum, so one partially aggregated shuffle by scene is all it takes.
    """
    kinds = sorted({k for ks in wanted.values() for k in ks})
    return products.groupBy("scene_key").agg(
        *[
            F.min(F.when((F.col("family") == f) & (F.col("code") == c), F.col("file_name"))).alias(f"{f}_{c}")
            for f, c in kinds
        ]
    )


def stage_input_files(products: DataFrame, sensor: str) -> DataFrame:
    """One row per scene, stage and required code, with the first matching file or null.

    A stage that runs on every matching file has a row for each. ``products`` has scene_key, family, code and
    file_name.
    """
    wanted = _wanted_inputs(sensor)
    every = [n for s, n in stage_data.ALL_FILES if s == sensor]
    rows = [
        F.struct(
            F.lit(n).alias("stage_no"),
            F.lit(f).alias("family"),
            F.lit(c).alias("code"),
            F.col(f"{f}_{c}").alias("file_name"),
        )
        for n, kinds in wanted.items()
        for f, c in kinds
    ]
    found = _firsts_by_scene(products, wanted).select("scene_key", F.inline(F.array(*rows)))
    if not every:
        return found
    kinds = [
        F.struct(F.lit(n).alias("stage_no"), F.lit(f).alias("family"), F.lit(c).alias("code"))
        for n in every
        for f, c in wanted[n]
    ]
    matches = (
        products.select("scene_key", F.col("family").alias("_f"), F.col("code").alias("_c"), "file_name")
        .distinct()
        .select("*", F.inline(F.array(*kinds)))
        .filter((F.col("_f") == F.col("family")) & (F.col("_c") == F.col("code")) & F.col("file_name").isNotNull())
        .select(*found.columns)
    )
    return found.filter(~F.col("stage_no").isin(*every) | F.col("file_name").isNull()).unionByName(matches)


def resolve_stage_inputs(products: DataFrame, sensor: str) -> DataFrame:
    """One row per scene and stage: the first file of each input, how many are missing, and ``ready``.

    Missing files hold a stage back only where its sensor checks them.
    """
    wanted = _wanted_inputs(sensor)
    rows = [
        F.struct(F.lit(n).alias("stage_no"), F.array(*[F.col(f"{f}_{c}") for f, c in kinds]).alias("files"))
        for n, kinds in wanted.items()
    ]
    return (
        _firsts_by_scene(products, wanted)
        .select("scene_key", F.inline(F.array(*rows)))
        .withColumn("missing", F.size("files") - F.size(F.array_compact("files")))
        .withColumn("ready", (F.col("missing") == 0) | F.lit(sensor not in stage_data.INPUT_CHECKED))
    )


def stage_output_files(inputs: DataFrame) -> DataFrame:
    """Names of the files that the Landsat stages write, from the ``stage_input_files`` they are named after."""
    names = [
        F.when((F.col("stage_no") == n) & (F.col("code") == swaps[0][0]), derive_output("file_name", swaps))
        for n, swaps in stage_data.OUTPUT_SWAPS
    ]
    return inputs.select("scene_key", "stage_no", F.explode(F.array_compact(F.array(*names))).alias("output_name"))


def plan_edges(outputs: DataFrame, inputs: DataFrame) -> DataFrame:
    """A stage depends on the stages that write a code it reads."""
    up = outputs.select("sensor", "code", F.col("stage_no").alias("up_stage"))
    down = inputs.select("sensor", "code", F.col("stage_no").alias("down_stage"))
    return up.join(down, ["sensor", "code"]).select("sensor", "up_stage", "down_stage").distinct()


def scene_plan_edges(products: DataFrame, outputs: DataFrame, inputs: DataFrame) -> DataFrame:
    """The stage dependencies of each scene, as far as the file that links two stages is there.

    ``outputs`` and ``inputs`` are the fixed tables of one sensor, so their join is a few rows.
    """
    links = (
        outputs.select("code", F.col("stage_no").alias("up_stage"))
        .join(inputs.select("code", "family", F.col("stage_no").alias("down_stage")), "code")
        .distinct()
    )
    files = products.select("scene_key", "family", "code").distinct()
    return files.join(F.broadcast(links), ["family", "code"]).select("scene_key", "up_stage", "down_stage").distinct()


def failures(logs: DataFrame, body: str, *keys: str) -> DataFrame:
    """One row per stage failure that a log names."""
    return logs.select(*keys, F.inline(stage_failures(body)))


def setup_failures(logs: DataFrame, body: str, *keys: str) -> DataFrame:
    """One row per module that a log could not load."""
    return logs.select(*keys, F.explode(module_failures(body)).alias("module"))


def failure_summary(failed: DataFrame, sensor: str) -> DataFrame:
    """Failures by stage and whether they were silent, that is, did not end the job.

    A missing input always ends the job; an error of the command does so only in fatal stages.
    """
    fatal = {n: x for s, n, _, x in stage_data.STAGES if s == sensor}
    ends = F.create_map(*[F.lit(x) for pair in fatal.items() for x in pair])
    no_input = F.startswith(F.col("message"), F.lit("Required input files not found"))
    silent = ~(no_input | F.coalesce(F.try_element_at(ends, F.col("stage_no")), F.lit(False)))
    return failed.groupBy("stage_no", silent.alias("silent")).agg(F.count("*").alias("failures"))
