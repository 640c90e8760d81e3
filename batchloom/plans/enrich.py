"""Enrichment runs: select new rows or files, build requests, score, write audited results."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from batchloom import schemas
from batchloom.functions.media import media_type
from batchloom.operators import incremental, planning, requests, results
from batchloom.operators.grouping import first_of_stored
from batchloom.operators.ledger import find_job
from batchloom.operators.requests import RequestOptions
from batchloom.operators.sinks import (
    align_to_schema,
    append_aligned,
    append_results,
    evolve_table,
    idempotent_append,
    new_batches,
)
from batchloom.sources.files import attach_urls, extension_glob, list_files
from batchloom.sources.lines import read_result_lines
from batchloom.sources.tree import Lister, list_tree
from batchloom.storage import inline_rows, materialise_counted, path_exists, table_exists

# A scorer maps requests (custom_id, request, ...) to result and error lines (custom_id, line, kind),
# where kind is 'result' or 'error'.
Scorer = Callable[[DataFrame], DataFrame]

SCORED = "custom_id string, line string, kind string"


def pandas_scorer(fn: Callable[[Iterator[Any]], Iterable[Any]], partitions: int | None = None) -> Scorer:
    """A scorer from a function over pandas batches of (custom_id, request).

    ``partitions`` sets how finely the requests are split for the external model; how many are in
    flight is bounded by the executor slots of the session.
    """

    def score(built: DataFrame) -> DataFrame:
        narrow = built.select("custom_id", "request")
        if partitions:
            narrow = narrow.repartition(partitions, "custom_id")
        return narrow.mapInPandas(fn, SCORED)

    return score


def column_scorer(line: Column, kind: Column | None = None) -> Scorer:
    """A scorer from a Column expression over the request columns."""
    return lambda built: built.select(
        "custom_id", line.alias("line"), (F.lit("result") if kind is None else kind).alias("kind")
    )


@dataclass
class Run:
    """What one run built, got back and will write, as DataFrames, and what it counted on the way.

    Counts come from the writes of the run's own tables and of its target, so that nothing is read again for them.
    ``written`` is what reached the target: nothing before ``write_run``, and nothing where the batch was there.
    """

    selected: DataFrame
    requests: DataFrame
    results: DataFrame
    errors: DataFrame
    quarantine: DataFrame
    rows: DataFrame
    labels: dict[str, str]
    layout: T.StructType
    counts: dict[str, int]
    unkeyed: DataFrame | None = None

    def counted(self) -> dict[str, int]:
        """All counts. Without stored responses, those of results and errors are taken here, which calls the scorer."""
        if "failed" not in self.counts:
            counts = {"success": self.results, "failed": self.errors, "quarantined": self.quarantine}
            self.counts |= {name: df.count() for name, df in counts.items()}
        shown = {"source_rows": "selected", "success_count": "success", "error_count": "failed", "written_rows": "written"}
        return self.counts | {name: self.counts[held] for name, held in shown.items()}

    def stats(self, source: str) -> DataFrame:
        """Selected, answered, failed and written rows as one row."""
        return planning.run_stats(self.rows.sparkSession, source, self.counted(), self.labels)

    def outcomes(self, source: str) -> DataFrame:
        """What became of the selected rows, by reason; see ``planning.OUTCOMES``."""
        return planning.run_outcomes(self.rows.sparkSession, source, self.counted())


def _labels(options: RequestOptions, batch_id: str) -> dict[str, str]:
    return {"provider": options.provider, "model": options.model, "batch_id": batch_id}


def _score(
    sent: DataFrame, scorer: Scorer, keep: bool, status: int | None = None
) -> tuple[DataFrame, DataFrame, DataFrame, dict[str, int]]:
    """Results, errors and quarantine, parsed once, and their counts.

    With ``keep``, parsed responses are written first: the scorer may be slow, costly and not repeatable,
    and must not be called again by a later stage or a retried task of one.
    """
    answers, counts = results.flatten_answers(scorer(sent)), {}
    if keep:
        fine, is_error = F.col("quarantine_reason").isNull(), F.col("kind") == "error"
        wanted = ~is_error if status is None else ~is_error & F.coalesce(F.col("status_code") == status, F.lit(False))
        answers, counts = materialise_counted(
            answers,
            "responses",
            success=F.count_if(fine & wanted),
            failed=F.count_if(fine & is_error),
            quarantined=F.count_if(~fine),
        )
    flat, errors, quarantine = results.split_answers(answers)
    return results.only_status(flat, status), errors, quarantine, counts


def _sendable(
    groups: DataFrame,
    usable: int,
    rows: DataFrame,
    keys: Sequence[str],
    text_col: str,
    order: Sequence[str],
    options: RequestOptions,
    limit: int,
) -> tuple[DataFrame, dict[str, int]]:
    """Stored requests of the key groups, without the rendered line, which would hold the text twice.

    With a cap, text is fetched for as many keys as the cap asks for; only if some of those are too large to be
    sent, for twice as many, and so on.
    """
    asked = limit
    while True:
        some = first_of_stored(groups.where("_best IS NOT NULL"), keys, asked) if limit > 0 else groups
        judged = requests.judge_requests(requests.copies_of(some, rows, keys, text_col, order), keys, text_col, options)
        fits = F.col("fits")
        stored, counts = materialise_counted(judged, "requests", sent=F.count_if(fits), oversized=F.count_if(~fits))
        if limit <= 0 or counts["sent"] >= limit or asked >= usable:
            break
        asked *= 2
    ready = stored.where("fits")
    if 0 < limit < counts["sent"]:
        ready, counts["sent"] = first_of_stored(ready, keys, limit), limit
    counts["capped"] = usable - counts["oversized"] - counts["sent"]
    return requests.with_request(ready.drop("fits"), options), counts


def enrich(
    source: DataFrame,
    target: DataFrame | None,
    keys: Sequence[str],
    text_col: str,
    scorer: Scorer,
    options: RequestOptions,
    batch_id: str,
    at: str | None = None,
    where: str | None = None,
    limit: int = 0,
    order: Sequence[str] = (),
    result_column: str = schemas.DEFAULT_RESULT_COLUMN,
    include_raw: bool = True,
    status: int | None = None,
    keep: bool = True,
) -> Run:
    """Text mode from source to rows ready for the target.

    Rows that would be skipped are dropped before the row cap applies, so a cap cannot be used up
    by rows that are never sent. The new rows are in ``Run.rows``; see ``write_run``.

    First copies are chosen and processed keys removed on keys and ranks alone, with or without an ``order``; text is
    read for the fresh keys. ``keep`` stores responses; without it every look at results calls the scorer again.
    """
    wanted = source.where(F.expr(where)) if where else source
    groups = requests.key_groups(wanted, target, keys, text_col, order)
    groups, counts = requests.store_key_groups(groups, keys)
    sent, made = _sendable(groups, counts.pop("usable"), wanted, keys, text_col, order, options, limit)
    flat, errors, quarantine, answered = _score(sent, scorer, keep, status)
    audited = results.stamp_metadata(
        results.attach_request_context(flat, sent), options.provider, batch_id, at, include_raw
    )
    rows = results.table_results(audited, keys, result_column)
    layout = schemas.target_schema(source.schema, list(keys), result_column)
    _, unkeyed = incremental.split_null_keys(wanted, keys)
    selected = groups.select(*keys, F.col("_rows").alias("rows"))
    every = counts | made | answered | {"written": 0}
    return Run(selected, sent, flat, errors, quarantine, rows, _labels(options, batch_id), layout, every, unkeyed)


def discover_files(
    spark: SparkSession,
    root: str,
    target: DataFrame | None = None,
    extensions: Sequence[str] = (),
    prefix: str = "",
    limit: int = 0,
    lister: Lister | None = None,
) -> DataFrame:
    """List new files of a folder. Extensions, and a prefix that names a folder, prune the listing.

    With a ``lister``, such as ``tree.list_folder``, tasks list the tree, empty files included; otherwise the driver's
    file index does.
    """
    if lister:
        return incremental.unprocessed_files(list_tree(spark, root, prefix, extensions, lister), target, limit=limit)
    folders = [prefix] if prefix.endswith("/") else []
    if folders and not path_exists(spark, f"{root.rstrip('/')}/{prefix}"):
        return inline_rows(spark, [], "relative_path string, size bigint")
    listed = list_files(spark, root, folders, extension_glob(extensions))
    return incremental.unprocessed_files(listed, target, extensions, prefix, limit)


def enrich_files(
    files: DataFrame,
    urls: DataFrame,
    target: DataFrame | None,
    scorer: Scorer,
    options: RequestOptions,
    batch_id: str,
    volume: str,
    at: str | None = None,
    extensions: Sequence[str] = (),
    prefix: str = "",
    limit: int = 0,
    result_column: str = schemas.DEFAULT_RESULT_COLUMN,
    include_raw: bool = True,
    keep: bool = True,
) -> Run:
    """File mode from listing to rows ready for the target; a cap counts sendable files only."""
    fresh = incremental.unprocessed_files(files, target, extensions, prefix)
    judged = requests.judge_media_requests(attach_urls(fresh, urls), options)
    outcomes = {name: F.count_if(F.col("outcome") == name) for name in ("no_url", "unsupported", "oversized", "ready")}
    stored, counts = materialise_counted(judged, "requests", selected=F.count("*"), **outcomes)
    sent = stored.where("outcome = 'ready'")
    ready = counts.pop("ready")
    if limit > 0:
        sent = first_of_stored(sent, ["relative_path"], limit)
    counts |= {"sent": min(ready, limit) if limit > 0 else ready, "written": 0}
    counts["capped"] = ready - counts["sent"]
    sent = sent.drop("outcome")
    flat, errors, quarantine, answered = _score(sent, scorer, keep)
    located = results.attach_file_metadata(flat, sent, volume, options.user_prompt)
    audited = results.stamp_metadata(located, options.provider, batch_id, at, include_raw)
    rows = results.file_results(audited, result_column)
    selected = stored.select("relative_path", "size", "outcome")
    layout = schemas.file_target_schema(result_column)
    return Run(selected, sent, flat, errors, quarantine, rows, _labels(options, batch_id), layout, counts | answered)


def write_run(
    run: Run, target: str, mode: str = "append", full_refresh: bool = False, include_metadata: bool = True
) -> int:
    """Write a run's rows, count them in the run and return how many were written. Appends skip batches the target has.

    A new target gets key types from the source. A target that lacks audit columns gets them;
    otherwise only columns the target has are written. Overwriting after an incremental
    selection would lose all earlier rows, so it has to be asked for with ``full_refresh``.

    Without ``include_metadata`` only keys (or file columns) and result are written, and a target keeps its columns. It has
    no batch ids then, so nothing tells a second write of the run from the first.
    """
    run.counts["written"] = _write_rows(run, target, mode, full_refresh, include_metadata)
    return run.counts["written"]


def _write_rows(run: Run, target: str, mode: str, full_refresh: bool, include_metadata: bool) -> int:
    spark = run.rows.sparkSession
    if mode != "append" and not full_refresh:
        raise ValueError("overwrite keeps only this run's rows; pass full_refresh=True if that is meant")
    new = mode != "append" or not table_exists(spark, target)
    rows = align_to_schema(run.rows, run.layout) if new else run.rows
    if not include_metadata:
        plain = rows.drop(*schemas.METADATA_COLUMNS)
        return append_results(plain, target, mode) if new else append_aligned(plain, target)
    if mode != "append":
        return append_results(rows, target, mode, partition_by=["batch_id"])
    if not new:
        evolve_table(spark, target)
    return idempotent_append(rows, target, rebalance=False, batches=[run.labels["batch_id"]])


class SourcesFailed(RuntimeError):
    """Some sources of ``enrich_all`` failed. ``failures`` has their errors, ``stats`` the rows of the others (or None)."""

    def __init__(self, failures: dict[str, Exception], stats: DataFrame | None):
        super().__init__(f"sources failed: {failures}")
        self.failures, self.stats = failures, stats


def enrich_all(
    runs: dict[str, Callable[[], Run]],
    write: Callable[[str, Run], Any] | None = None,
    concurrent: int = 4,
    report_failures: bool = False,
) -> DataFrame:
    """Run several sources at once, each into its own target, and return stats per source and in total.

    A source is a driver thread; ``concurrent`` of them run at a time, each in the scheduler pool of its name, so that
    with ``spark.scheduler.mode`` FAIR a large source doesn't hold up the others. A source that fails does not
    stop the others. Its error is raised after all have run, as ``SourcesFailed`` with the others' stats; with
    ``report_failures`` it is a row of the stats with status failed and the error's text. A source without new rows
    simply counts 0.
    """
    if not runs:
        raise ValueError("no source is enabled")
    spark = SparkSession.active()

    def one(name: str, start: Callable[[], Run]) -> tuple[Run, float]:
        began = time.monotonic()
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        try:
            run = start()
            if write:
                write(name, run)
            run.counted()
            return run, time.monotonic() - began
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)

    stats, failures = [], {}
    with ThreadPoolExecutor(min(concurrent, len(runs))) as threads:
        started = {name: threads.submit(inheritable_thread_target(spark)(one), name, start) for name, start in runs.items()}
    for name, future in started.items():
        try:
            run, seconds = future.result()
            stats.append(run.stats(name).withColumn("elapsed_seconds", F.lit(seconds)))
        except Exception as error:  # noqa: BLE001 - sources are isolated from each other
            failures[name] = error
    if failures and not report_failures:
        raise SourcesFailed(failures, planning.total_stats(stats) if stats else None)
    if report_failures:
        stats = [s.withColumn("error", F.lit(None).cast("string")) for s in stats]
    stats += [planning.failed_stats(spark, name, str(error)) for name, error in failures.items()]
    return planning.total_stats(stats)


def resume(
    ledger: DataFrame,
    batch_id: str,
    lines: DataFrame,
    sent: DataFrame,
    target: DataFrame | None,
    keys: Sequence[str],
    provider: str,
    at: str | None = None,
    tiebreak: str | None = None,
    volume: str | None = None,
    prompt: str = "",
) -> DataFrame:
    """Harvest a finished batch again from its result lines, with nothing lost.

    The ledger must hold the batch as completed, otherwise there is nothing to harvest. Source
    text, or file sizes where a ``volume`` is named, come from the request table. Rows of a batch
    the target already has are not returned; its batch ids are read when this is called.
    """
    job = find_job(ledger, batch_id, tiebreak).where(F.col("status") == "completed").select("batch_id")
    good, _ = read_result_lines(lines)
    flat = results.flatten_results(good)
    if volume is None:
        context = results.attach_request_context(flat, sent)
        rows = results.table_results(results.stamp_metadata(context, provider, batch_id, at), keys)
    else:
        context = results.attach_file_metadata(flat, sent, volume, prompt)
        rows = results.file_results(results.stamp_metadata(context, provider, batch_id, at))
    return new_batches(rows.join(job, "batch_id", "left_semi").select(*rows.columns), target)


def preview(
    source: DataFrame,
    keys: Sequence[str],
    text_col: str,
    scorer: Scorer,
    options: RequestOptions,
    n: int = 1,
    order: Sequence[str] = (),
) -> DataFrame:
    """Score the first ``n`` rows without writing: key, input, output, tokens, model."""
    sample = requests.build_requests(source, keys, text_col, options, order).orderBy(*keys).limit(n)
    good, _ = read_result_lines(scorer(sample).where(F.col("kind") == "result").select("line"))
    flat = results.attach_request_context(results.flatten_results(good), sample)
    shown = F.trim(F.col("content"))
    return flat.select(
        "custom_id",
        F.col("source_text").alias("input"),
        shown.alias("output"),
        F.col("total_tokens").alias("tokens"),
        F.lit(options.model).alias("model"),
        F.lit("table").alias("source_type"),
    )


def preview_files(files: DataFrame, urls: DataFrame, scorer: Scorer, options: RequestOptions, n: int = 1) -> DataFrame:
    """Score the first ``n`` files that can be sent, without writing."""
    sendable = requests.build_media_requests(attach_urls(files, urls), options)
    sample = sendable.orderBy("relative_path").limit(n)
    good, _ = read_result_lines(scorer(sample).where(F.col("kind") == "result").select("line"))
    flat = results.attach_file_metadata(results.flatten_results(good), sample, "", options.user_prompt)
    described = F.concat(F.lit("["), media_type(F.col("file_path")), F.lit("] "), F.col("file_path"))
    return flat.select(
        "custom_id",
        described.alias("input"),
        F.trim(F.col("content")).alias("output"),
        F.col("total_tokens").alias("tokens"),
        F.lit(options.model).alias("model"),
        F.lit("file").alias("source_type"),
    )


def enriched_view(base: DataFrame, enriched: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Base rows with the chosen result columns, for keys that have a result."""
    typed = {f.name: f.dataType for f in base.select(*keys).schema.fields}
    found = enriched.select(*[F.col(k).try_cast(typed[k]).alias(k) for k in keys], *columns)
    return base.join(found, list(keys))
