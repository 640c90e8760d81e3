"""Turn result lines into typed, audited rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchloom import schemas
from batchloom.functions.ids import restore_keys
from batchloom.sources.lines import parse_answers


def _first_filled(*cols: Column) -> Column:
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cols], F.lit(""))


def _counter(col: Column) -> Column:
    return F.coalesce(col.try_cast("double").try_cast("int"), F.lit(0))


def _or_empty(col: Column) -> Column:
    return F.coalesce(col, F.lit(""))


def flatten_results(records: DataFrame, line_col: str = "line") -> DataFrame:
    """Nested result records to flat columns, defaults filled in.

    Content and finish reason are those of the first choice. ``response_id`` is the first filled
    of the ids a provider may use. ``raw_response`` is the compact response body, '' if empty.
    Failed statuses are kept; see ``only_status``.
    """
    response, body = "record.response", "record.response.body"
    choice = F.get(F.col(f"{body}.choices"), F.lit(0))
    raw = F.get_json_object(F.col(line_col), "$.response.body")
    extra = [c for c in records.columns if c not in ("record", line_col)]
    return records.select(
        F.col("record.custom_id").alias("custom_id"),
        _or_empty(choice["message"]["content"]).alias("content"),
        _or_empty(F.col(f"{body}.model")).alias("model"),
        *[_counter(F.col(f"{body}.usage.{n}")).alias(n) for n in ("prompt_tokens", "completion_tokens", "total_tokens")],
        _counter(F.col(f"{response}.status_code")).alias("status_code"),
        _or_empty(choice["finish_reason"]).alias("finish_reason"),
        _first_filled(
            F.col(f"{response}.request_id"), F.col(f"{body}.request_id"), F.col(f"{body}.id"), F.col("record.id")
        ).alias("response_id"),
        F.when(raw.isin("{}", "null"), "").otherwise(_or_empty(raw)).alias("raw_response"),
        *extra,
    )


def flatten_answers(scored: DataFrame) -> DataFrame:
    """Result and error lines (line, kind) as one flat table, each line parsed once for all that reads it.

    Results have the columns of ``flatten_results``, errors ``error_code`` and ``error_message``. A line itself is
    kept where it is an error or could not be used.
    """
    flat = flatten_results(parse_answers(scored).withColumn("kept", F.col("line")))
    is_error = F.col("kind") == "error"
    whole = is_error | F.col("quarantine_reason").isNotNull()
    return flat.withColumns(
        {
            "custom_id": F.when(is_error, F.col("problem.custom_id")).otherwise(F.col("custom_id")),
            "error_code": F.col("problem.error.code"),
            "error_message": F.col("problem.error.message"),
            "line": F.when(whole, F.col("kept")),
        }
    ).drop("problem", "kept")


def split_answers(answers: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``flatten_answers`` as results, errors (custom_id, error_code, error_message, raw) and quarantine."""
    fine = answers.where(F.col("quarantine_reason").isNull())
    own = [c for c in answers.columns if c not in ("kind", "quarantine_reason", "error_code", "error_message", "line")]
    good = fine.where(F.col("kind") == "result").select(*own)
    bad = fine.where(F.col("kind") == "error").select("custom_id", "error_code", "error_message", F.col("line").alias("raw"))
    return good, bad, answers.where(F.col("quarantine_reason").isNotNull()).select("line", "quarantine_reason")


def only_status(results: DataFrame, status: int | None = None) -> DataFrame:
    """Results with one status; every parsed result where none is asked for."""
    return results if status is None else results.where(F.col("status_code") == status)


def attach_request_context(results: DataFrame, requests: DataFrame) -> DataFrame:
    """Add the source text of each result's request, '' where the request is unknown.

    The encoded id is the join key: unlike keys joined by a separator it is unambiguous.
    """
    context = requests.select("custom_id", "source_text")
    joined = results.join(context, "custom_id", "left")
    return joined.withColumn("source_text", _or_empty(F.col("source_text")))


def attach_file_metadata(
    results: DataFrame, files: DataFrame, volume: str, prompt: str, path_col: str = "relative_path"
) -> DataFrame:
    """Add path, volume and size of each result's file; an unlisted file has size 0."""
    sizes = files.select(F.col(path_col).alias("file_path"), F.col("size").alias("file_size"))
    joined = restore_keys(results, ["file_path"]).join(sizes, "file_path", "left")
    return joined.withColumns(
        {
            "volume_name": F.lit(volume),
            "file_size": F.coalesce(F.col("file_size").cast("bigint"), F.lit(0)),
            "source_text": F.lit(prompt),
        }
    )


def processed_at(at: Column) -> Column:
    """An instant as text at the fixed offset +08:00, whatever the session's time zone is."""
    local = F.from_utc_timestamp(F.to_utc_timestamp(at, F.current_timezone()), "+08:00")
    return F.concat(F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+08:00"))


def stamp_metadata(
    results: DataFrame,
    provider: str,
    batch_id: str | Column,
    at: str | None = None,
    include_raw: bool = True,
) -> DataFrame:
    """Complete the audit columns. ``at`` is the run's time in ISO form; now if not given."""
    batch = F.lit(batch_id) if isinstance(batch_id, str) else batch_id
    instant = F.lit(at).cast("timestamp") if at else F.current_timestamp()
    stamped = {"provider": F.lit(provider), "batch_id": batch, "processed_at": processed_at(instant)}
    if not include_raw:
        stamped["raw_response"] = F.lit("")
    if "source_text" not in results.columns:
        stamped["source_text"] = F.lit("")
    return results.withColumns(stamped)


def table_results(
    results: DataFrame, keys: Sequence[str], result_column: str = schemas.DEFAULT_RESULT_COLUMN
) -> DataFrame:
    """Stamped results in target order: keys, result, audit columns."""
    keyed = restore_keys(results, keys).withColumn(result_column, F.col("content"))
    return keyed.select(*keys, result_column, *schemas.METADATA_COLUMNS)


def file_results(results: DataFrame, result_column: str = schemas.DEFAULT_RESULT_COLUMN) -> DataFrame:
    """Stamped results with file metadata in target order."""
    named = results.withColumn(result_column, F.col("content"))
    return named.select(*schemas.FILE_COLUMNS.names, result_column, *schemas.METADATA_COLUMNS)


def error_histogram(errors: DataFrame) -> DataFrame:
    """Errors per code; a missing code is a bucket of its own."""
    return errors.groupBy("error_code").agg(F.count("*").alias("errors"))
