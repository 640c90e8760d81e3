"""JSON-lines result and error files of a batch service."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from batchloom.functions.text import is_blank

_TEXT = T.StringType()

_MESSAGE = T.StructType([T.StructField("content", _TEXT)])
_CHOICE = T.StructType([T.StructField("message", _MESSAGE), T.StructField("finish_reason", _TEXT)])
# Counters are read as text and cast later: a field of the wrong type then costs its own value,
# not the whole line.
_USAGE = T.StructType(
    [T.StructField(n, _TEXT) for n in ("prompt_tokens", "completion_tokens", "total_tokens")]
)
_BODY = T.StructType(
    [
        T.StructField("id", _TEXT),
        T.StructField("request_id", _TEXT),
        T.StructField("model", _TEXT),
        T.StructField("choices", T.ArrayType(_CHOICE)),
        T.StructField("usage", _USAGE),
    ]
)
_RESPONSE = T.StructType(
    [T.StructField("status_code", _TEXT), T.StructField("request_id", _TEXT), T.StructField("body", _BODY)]
)
RESULT_LINE = T.StructType(
    [
        T.StructField("custom_id", _TEXT),
        T.StructField("id", _TEXT),
        T.StructField("response", _RESPONSE),
        T.StructField("_corrupt", _TEXT),
    ]
)
ERROR_LINE = T.StructType(
    [
        T.StructField("custom_id", _TEXT),
        T.StructField("error", T.StructType([T.StructField("code", _TEXT), T.StructField("message", _TEXT)])),
        T.StructField("_corrupt", _TEXT),
    ]
)


def read_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Lines of text files as (line, source_file)."""
    lines = spark.read.text(paths)
    return lines.select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("source_file"))


def parse_lines(lines: DataFrame, schema: T.StructType, line_col: str = "line") -> DataFrame:
    """Parse every non-blank line; ``quarantine_reason`` is set on those that cannot be used.

    A line is set aside when it is not JSON of the expected shape, names no request, or carries
    an explicit null response.
    """
    parsed = lines.where(~is_blank(F.col(line_col))).withColumn("record", _record(F.col(line_col), schema))
    return parsed.withColumn("quarantine_reason", _reason(F.col(line_col), "record", "response" in schema.names))


def _record(line: Column, schema: T.StructType) -> Column:
    return F.from_json(line, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})


def _reason(line: Column, record: str, has_response: bool) -> Column:
    """Why a parsed line can't be used. Names are looked up only where the response is missing."""
    reason = F.when(F.col(f"{record}._corrupt").isNotNull() | F.col(record).isNull(), "not_json").when(
        F.coalesce(F.col(f"{record}.custom_id"), F.lit("")) == "", "no_custom_id"
    )
    if not has_response:
        return reason
    named = F.array_contains(F.json_object_keys(line), "response")
    return reason.when(F.col(f"{record}.response").isNull() & named, "null_response")


def parse_answers(scored: DataFrame) -> DataFrame:
    """Lines of both kinds (line, kind) parsed in one pass: ``record`` of a result, ``problem`` of an error."""
    is_error, line = F.col("kind") == "error", F.col("line")
    lines = scored.select("line", "kind").where(F.col("kind").isin("result", "error") & ~is_blank(line))
    parsed = lines.withColumns(
        {"record": F.when(~is_error, _record(line, RESULT_LINE)), "problem": F.when(is_error, _record(line, ERROR_LINE))}
    )
    reason = F.when(is_error, _reason(line, "problem", False)).otherwise(_reason(line, "record", True))
    return parsed.withColumn("quarantine_reason", reason)


def quarantined(parsed: DataFrame, line_col: str = "line") -> DataFrame:
    """The lines that were set aside, with the reason."""
    kept = [c for c in parsed.columns if c != "record"]
    return parsed.where(F.col("quarantine_reason").isNotNull()).select(*kept)


def usable(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("quarantine_reason").isNull()).drop("quarantine_reason")


def read_result_lines(lines: DataFrame, line_col: str = "line") -> tuple[DataFrame, DataFrame]:
    """Usable result lines, still nested, and the quarantined ones."""
    parsed = parse_lines(lines, RESULT_LINE, line_col)
    return usable(parsed), quarantined(parsed, line_col)


def read_error_lines(lines: DataFrame, line_col: str = "line") -> tuple[DataFrame, DataFrame]:
    """Errors as (custom_id, error_code, error_message, raw), and the quarantined lines.

    A null or missing error object leaves code and message NULL.
    """
    parsed = parse_lines(lines, ERROR_LINE, line_col)
    extra = [c for c in lines.columns if c != line_col]
    errors = usable(parsed).select(
        F.col("record.custom_id").alias("custom_id"),
        F.col("record.error.code").alias("error_code"),
        F.col("record.error.message").alias("error_message"),
        F.col(line_col).alias("raw"),
        *extra,
    )
    return errors, quarantined(parsed, line_col)
