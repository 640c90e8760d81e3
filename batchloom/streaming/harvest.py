"""Continuous harvest, selection and enrichment.

All three run until their input is used up and then stop (``availableNow``); started again with the
same checkpoint they take only what is new. A caller that wants an always-on query passes a
processing-time trigger.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from batchloom.operators import incremental, results
from batchloom.operators.grouping import keep_first
from batchloom.operators.sinks import align_to_schema, evolve_table, idempotent_append
from batchloom.sources.lines import RESULT_LINE, parse_lines, quarantined, usable
from batchloom.storage import path_exists, read_table, table_exists

ONCE = {"availableNow": True}


def batch_from_file(path: Column, folder: str) -> Column:
    """Batch id of a result file: its path below the watched folder, without the extension."""
    root = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", folder).rstrip("/") + "/"
    below = F.substring_index(F.url_decode(path), root, -1)
    return F.regexp_extract(below, r"^(.+?)(\.[A-Za-z0-9]+)?$", 1)


def stream_harvest(
    spark: SparkSession,
    folder: str,
    target: str,
    checkpoint: str,
    keys: Sequence[str],
    provider: str,
    requests: DataFrame | None = None,
    quarantine: str | None = None,
    at: str | None = None,
    layout: T.StructType | None = None,
    volume: str | None = None,
    prompt: str = "",
    trigger: dict[str, Any] = ONCE,
) -> list[StreamingQuery]:
    """Parse new result files as they arrive and append their rows exactly once.

    Every micro-batch goes through the same append as a batch run: a file is a batch, a batch that
    the target holds is skipped, so a repeated micro-batch adds nothing, and rows that were in the
    target before stay. The target may be a folder or a catalog table and may hold rows of
    batch runs. ``requests`` gives source texts, or file sizes in file mode, which a ``volume``
    asks for. Unusable lines go to ``quarantine``, if a path is given, by batch in the same way. Rows
    take the types of ``layout`` if there is one; keys are text otherwise.
    """
    lines = spark.readStream.option("recursiveFileLookup", "true").text(folder).select(
        F.col("value").alias("line"), batch_from_file(F.col("_metadata.file_path"), folder).alias("batch_id")
    )

    def take(batch: DataFrame, _epoch: int) -> None:
        parsed = parse_lines(batch, RESULT_LINE)
        flat = results.flatten_results(usable(parsed))
        if volume is not None:
            flat = results.attach_file_metadata(flat, requests, volume, prompt)
        elif requests is not None:
            flat = results.attach_request_context(flat, requests)
        audited = results.stamp_metadata(flat, provider, F.col("batch_id"), at)
        rows = results.file_results(audited) if volume is not None else results.table_results(audited, keys)
        if not table_exists(batch.sparkSession, target):
            rows = align_to_schema(rows, layout) if layout else rows
        else:
            evolve_table(batch.sparkSession, target)
        idempotent_append(rows, target)
        if quarantine:
            idempotent_append(quarantined(parsed), quarantine)

    writer = lines.writeStream.foreachBatch(take).option("checkpointLocation", f"{checkpoint}/rows")
    return [writer.trigger(**trigger).start()]


def stream_incremental(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    keys: Sequence[str],
    target: str,
    selected: str,
    checkpoint: str,
    order: Sequence[str] = (),
    event_time: str | None = None,
    lateness: str = "1 hour",
    trigger: dict[str, Any] = ONCE,
) -> StreamingQuery:
    """Select each arriving key once, if the target does not have it.

    Repeats within a micro-batch are reduced to the first in ``order``; repeats of earlier ones,
    also after a failed write, are caught by the anti-join with what was selected before. That
    keeps no state and loses no late row. Rows with a NULL in the key could never be matched again and
    are not selected.

    With ``event_time``, repeats within ``lateness`` are dropped from state before the joins, which
    saves work on sources that repeat much. Spark then also drops rows that come later than that:
    they are left to the next batch run.
    """
    rows = spark.readStream.schema(schema).parquet(folder)
    if event_time:
        timed = rows.withColumn(event_time, F.col(event_time).cast("timestamp"))
        rows = timed.withWatermark(event_time, lateness).dropDuplicatesWithinWatermark(list(keys))

    def take(batch: DataFrame, _epoch: int) -> None:
        session = batch.sparkSession
        batch, _ = incremental.split_null_keys(batch, keys)
        batch = keep_first(batch, keys, order or keys)
        for known in (target, selected):
            held = read_table(session, known) if table_exists(session, known) else None
            batch = incremental.unprocessed_rows(batch, held, keys)
        batch.write.mode("append").parquet(selected)

    writer = rows.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger).start()


def stream_enriched_view(
    spark: SparkSession,
    base: DataFrame | Callable[[SparkSession], DataFrame],
    folder: str,
    schema: T.StructType,
    keys: Sequence[str],
    columns: Sequence[str],
    view: str,
    checkpoint: str,
    pending: str | None = None,
    trigger: dict[str, Any] = ONCE,
) -> StreamingQuery:
    """Keep base rows joined with results as new result files arrive.

    A result whose base row is not there yet waits in ``pending`` (below the checkpoint if not given)
    and is tried again with every later micro-batch; a function as ``base`` is asked for the base rows
    each time. The view has a part for each micro-batch, ``read_view`` reads them all; a repeated
    micro-batch replaces its own part, and what it leaves waiting, so nothing is lost or doubled.
    """
    waiting = pending or f"{checkpoint}/pending"

    def take(batch: DataFrame, epoch: int) -> None:
        session = batch.sparkSession
        results_ = batch.select(*keys, *columns)
        earlier = f"{waiting}/epoch={epoch - 1}"
        if path_exists(session, earlier):
            results_ = results_.unionByName(session.read.schema(results_.schema).parquet(earlier))
        rows = base(session) if callable(base) else base
        results_.join(rows, list(keys)).write.mode("overwrite").parquet(f"{view}/epoch={epoch}")
        late = results_.join(rows.select(*keys), list(keys), "left_anti")
        late.write.mode("overwrite").parquet(f"{waiting}/epoch={epoch}")

    arriving = spark.readStream.schema(schema).parquet(folder)
    writer = arriving.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger).start()


def read_view(spark: SparkSession, view: str) -> DataFrame:
    """All parts of an enriched view."""
    return spark.read.parquet(view).drop("epoch")
