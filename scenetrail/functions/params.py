"""Scalar helpers: dates in paths, parameter rules, arithmetic and labels."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scenetrail.functions.names import col


def render_dates(template: str | Column, ts: str | Column) -> Column:
    """Fill the run date and the start of the data interval into a dataset path."""
    template = F.lit(template) if isinstance(template, str) else template
    ts = col(ts)
    with_day = F.replace(template, F.lit("{{ ds }}"), F.date_format(ts, "yyyy-MM-dd"))
    return F.replace(with_day, F.lit("{{ data_interval_start }}"), F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))


def datasets_by_category(df: DataFrame, template: str, ts: str, categories: list[str]) -> DataFrame:
    """One rendered dataset per row and category; ``{category}`` in the template names the category."""
    return df.withColumn("category", F.explode(F.array(*[F.lit(c) for c in categories]))).withColumn(
        "dataset", render_dates(F.replace(F.lit(template), F.lit("{category}"), F.col("category")), ts)
    )


def validate_params(df: DataFrame, name: str, value: str, rules: Mapping[str, Mapping]) -> DataFrame:
    """Add ``violations``: the rules that the value of each named parameter breaks.

    A rule has ``nullable``, ``min_length`` and ``max_length``; parameters without a rule pass.
    """
    checks = []
    for param, rule in rules.items():
        here, v = F.col(name) == param, F.col(value)
        if not rule.get("nullable", False):
            checks.append(F.when(here & v.isNull(), F.lit("null")))
        if "min_length" in rule:
            checks.append(F.when(here & (F.length(v) < rule["min_length"]), F.lit("too short")))
        if "max_length" in rule:
            checks.append(F.when(here & (F.length(v) > rule["max_length"]), F.lit("too long")))
    found = F.array_compact(F.array(*checks)) if checks else F.array().cast("array<string>")
    return df.withColumn("violations", found)


def plus_const(c: str | Column, n: int | float) -> Column:
    return col(c) + F.lit(n)


def minus_const(c: str | Column, n: int | float) -> Column:
    return col(c) - F.lit(n)


def label(c: str | Column, prefix: str = "", suffix: str = "") -> Column:
    return F.concat(F.lit(prefix), col(c).cast("string"), F.lit(suffix))


def elapsed_seconds(start: str | Column, end: str | Column) -> Column:
    """Seconds between two ``yyyy-MM-dd HH:mm:ss`` texts; null where one is not a time."""
    fmt = F.lit("yyyy-MM-dd HH:mm:ss")
    return F.timestamp_diff("SECOND", F.try_to_timestamp(col(start), fmt), F.try_to_timestamp(col(end), fmt))
