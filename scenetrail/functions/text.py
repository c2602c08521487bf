"""Column expressions that read batch-queue, download and log text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from scenetrail.functions.names import basename, col, strip

# Accounting states that have a meaning, queue codes of a job that still runs,
# number of fields of a queue row, and the message patterns.
ACCOUNTING_STATES = ("COMPLETED", "RUNNING", "PENDING", "FAILED")
RUNNING_CODES = ("R", "PD")
QUEUE_FIELDS = 8
SUBMITTED = r"^Submitted batch job (\d+)"
STAGE_FAILED = r"(?m)^Failed at stage (\d+): ([^\r\n]*)"
MODULE_FAILED = r"(?m)^Failed to load (?:([^\r\n]*?) module|modules)\."


def lines(text: str | Column) -> Column:
    return F.split(col(text), "\r\n|\n|\r")


def location_header(text: str | Column) -> Column:
    """Target of the first ``Location: `` line of a response head."""
    mark = "Location: "
    first = F.get(F.filter(F.split(col(text), "\n"), lambda x: F.startswith(x, F.lit(mark))), F.lit(0))
    return strip(F.substr(first, F.lit(len(mark) + 1)))


def queue_code(text: str | Column) -> Column:
    """State code of a queue listing; null when the job is gone or the row is malformed."""
    fields = F.split(strip(F.get(lines(strip(text)), F.lit(1))), r"\s+")
    return F.when(F.size(fields) == QUEUE_FIELDS, F.get(fields, F.lit(4)))


def queue_status(text: str | Column) -> Column:
    """``done``, ``running``, ``waiting`` or ``malformed``."""
    code = queue_code(text)
    return (
        F.when(F.size(lines(strip(text))) <= 1, F.lit("done"))
        .when(code.isNull(), F.lit("malformed"))
        .when(code.isin(*RUNNING_CODES), F.lit("running"))
        .otherwise(F.lit("waiting"))
    )


def normalise_state(raw: str | Column) -> Column:
    """Accounting state; null text is UNKNOWN, a state without a meaning is UNMAPPED."""
    raw = col(raw)
    return (
        F.when(raw.isNull(), F.lit("UNKNOWN"))
        .when(raw.isin(*ACCOUNTING_STATES), raw)
        .otherwise(F.lit("UNMAPPED"))
    )


def accounting_state(text: str | Column) -> Column:
    text = col(text)
    return F.when(text == "", F.lit("UNKNOWN")).otherwise(
        normalise_state(F.coalesce(F.get(F.split(text, r"\|"), F.lit(1)), F.lit("")))
    )


def accounting_exit_code(text: str | Column) -> Column:
    text = col(text)
    field = F.get(F.split(text, r"\|"), F.lit(2))
    return F.when(text != "", F.substring_index(field, ":", 1).try_cast("int"))


def submitted_job(text: str | Column, strict: bool = True) -> Column:
    """Job id that a submit command reports; null where the strict form does not match."""
    text = strip(text)
    if strict:
        last = F.element_at(F.split(text, "\n"), -1)
        return F.nullif(F.regexp_extract(last, SUBMITTED, 1), F.lit(""))
    return F.nullif(F.element_at(F.split(text, r"\s+"), -1), F.lit(""))


def export_arg(pairs: str | Column) -> Column:
    """``--export=k=v,...`` in map order."""
    entries = F.transform(F.map_entries(col(pairs)), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return F.concat(F.lit("--export="), F.array_join(entries, ","))


def download_status(url: str | Column, exit_code: str | Column, stderr: str | Column, uri: str | Column) -> Column:
    url, exit_code, stderr, uri = col(url), col(exit_code), strip(stderr), col(uri)
    skipped = url.isNull() | (url == "") | (url == "None")
    failed = (
        F.coalesce(exit_code != 0, F.lit(True))
        | (F.coalesce(stderr, F.lit("")) != "")
        | uri.isNull()
        | (uri == "")
    )
    return F.when(skipped, F.lit("Skipped")).when(failed, F.lit("Failed")).otherwise(F.lit("Success"))


def downloaded_name(uri: str | Column) -> Column:
    return basename(uri)


def stage_failures(log: str | Column) -> Column:
    """Array of (stage_no, message) for the stage failures that a log names."""
    log = col(log)
    numbers = F.regexp_extract_all(log, F.lit(STAGE_FAILED), F.lit(1))
    messages = F.regexp_extract_all(log, F.lit(STAGE_FAILED), F.lit(2))
    return F.zip_with(
        numbers,
        messages,
        lambda n, m: F.struct(n.try_cast("int").alias("stage_no"), strip(m).alias("message")),
    )


def module_failures(log: str | Column) -> Column:
    """Array of the modules that a log could not load; an empty name where it names none."""
    return F.regexp_extract_all(col(log), F.lit(MODULE_FAILED), F.lit(1))


def decode_payload(c: str | Column) -> Column:
    """Base64 text as UTF-8; text that does not decode stays as it is."""
    c = col(c)
    raw = F.try_to_binary(c, F.lit("base64"))
    return F.coalesce(F.try_validate_utf8(raw.cast("string")), c)


def parse_list_literal(c: str | Column) -> Column:
    """Quoted list text as an array of strings; null if it is no list."""
    return F.from_json(col(c), "array<string>", {"allowSingleQuotes": "true"})
