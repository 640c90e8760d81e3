"""One query per operator over the test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from batchloom import schemas as S
from batchloom.functions import ids, ranges, text
from batchloom.operators import grouping, incremental, ledger, planning, requests, results, retry, sinks
from batchloom.operators.requests import RequestOptions
from batchloom.plans import analytics, channels, enrich, quality
from batchloom.registry.fixtures import ai_tables, recipe, sales_tables, stored, table
from batchloom.sources import files, lines, tables, tree
from batchloom.storage import materialise, read_table, work_path
from batchloom.streaming import harvest, selection

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

KEYS = ["doc_id", "source"]
AT = "2024-03-01T20:30:00Z"
OPTIONS = RequestOptions("m1", "Label the language.", "Text: {text}", params={"temperature": 0.5, "max_tokens": 64, "top_p": None})
MEDIA = RequestOptions("m2", "", "Describe this file", provider="zhipuai")
MEDIA_ALL = RequestOptions("m3", "Be brief.", "Describe this file", provider="dashscope", params={"enable_thinking": False})
OWN = "17-brand"
PEERS = ["17-brand", "4-brand", "25-brand", "9-brand", "absent-brand"]


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# --- scans and sources ---


@query
def source_scan(spark, sf):
    return tables.read_source(recipe(spark, sf, "f_req"), KEYS, "text", where="lang <> 'de' OR copy_no = 1")


@query
def file_listing(spark, sf):
    """Write one small file per source and language, and list the folders found."""
    path = work_path(spark, "listing")
    docs = table(spark, sf, "documents")
    docs.select("source", "lang", F.col("doc_id").cast("string")).write.partitionBy("source", "lang").text(path)
    listed = files.list_files(spark, path, glob="*.txt")
    folder = F.regexp_extract("relative_path", r"^(.*)/[^/]*$", 1)
    return listed.groupBy(folder.alias("folder")).agg((F.sum("size") > 0).alias("has_bytes"))


@query
def file_tree(spark, sf):
    """A tree of text files, one in each folder, listed by tasks: every file's folder and bytes."""
    path = work_path(spark, "tree")
    docs = table(spark, sf, "documents").select(F.coalesce("lang", F.lit("none")).alias("lang"), (F.col("doc_id") % 50).alias("bucket"), "text")
    docs.repartition("lang", "bucket").write.partitionBy("lang", "bucket").text(path)
    listed = tree.list_tree(spark, path, prefix="lang=e", extensions=["txt"])
    return listed.select(F.regexp_replace("relative_path", "/[^/]*$", "").alias("folder"), "size")


@query
def file_inventory(spark, sf):
    return files.from_inventory(recipe(spark, sf, "f_inventory"))


def _results(spark, sf) -> tuple[DataFrame, DataFrame]:
    good, bad = lines.read_result_lines(recipe(spark, sf, "f_res").select("line"))
    return results.flatten_results(good), bad


@query
def result_parse(spark, sf):
    return _results(spark, sf)[0]


@query
def result_success(spark, sf):
    return results.only_status(_results(spark, sf)[0], 200).select("custom_id", "status_code")


@query
def result_quarantine(spark, sf):
    return _results(spark, sf)[1].select("line", "quarantine_reason")


def _errors(spark, sf) -> DataFrame:
    return lines.read_error_lines(recipe(spark, sf, "f_err"))[0]


@query
def error_parse(spark, sf):
    return _errors(spark, sf).select("custom_id", "error_code", "error_message", "raw")


@query
def sheet_normalise(spark, sf):
    cells = recipe(spark, sf, "f_sheet").select("row_no", F.array("c0", "c1", "c2", "c3").alias("cells"))
    return tables.import_sheets({"Parts": cells, "Notes": cells}, {"Parts": "part_sheet"})["part_sheet"]


@query
def url_attach(spark, sf):
    found = files.attach_urls(recipe(spark, sf, "f_files"), recipe(spark, sf, "f_url"))
    return files.drop_unresolved_urls(found)


@query
def url_skips(spark, sf):
    found = files.attach_urls(recipe(spark, sf, "f_files"), recipe(spark, sf, "f_url"))
    return found.agg(
        F.count("presigned_url").alias("resolved"), F.count_if(F.col("presigned_url").isNull()).alias("skipped")
    )


@query
def source_profile(spark, sf):
    return tables.table_profile(table(spark, sf, "events"), ["event_id"], 5)


def _jd_self(spark, sf) -> DataFrame:
    return sales_tables(spark, sf)["京东自营"]


@query
def distinct_formats(spark, sf):
    columns = ["成交金额", "成交商品件数", "浏览量", "成交转化率", "成交客单价"]
    return tables.distinct_formats(_jd_self(spark, sf), columns, 8)


# --- selection ---


@query
def incremental_rows(spark, sf):
    fresh = incremental.unprocessed_rows(
        recipe(spark, sf, "f_req"), recipe(spark, sf, "f_tgt"), KEYS, where="lang <> 'es'"
    )
    return fresh.select(*KEYS, "lang", "copy_no")


@query
def incremental_capped(spark, sf):
    """The capped form: the first 500 unprocessed rows in key order."""
    done = recipe(spark, sf, "f_tgt")
    return incremental.unprocessed_rows(table(spark, sf, "documents"), done, KEYS, limit=500).select(*KEYS)


@query
def incremental_files(spark, sf):
    found = incremental.unprocessed_files(
        recipe(spark, sf, "f_files"), recipe(spark, sf, "f_done_files"), ["jpg", ".png", ".MP4"], "src1"
    )
    return found


@query
def files_by_extension(spark, sf):
    return files.filter_extensions(recipe(spark, sf, "f_files"), ["JPG", ".png", "mov"])


@query
def files_by_prefix(spark, sf):
    return files.filter_prefix(recipe(spark, sf, "f_files"), "src1")


@query
def media_types(spark, sf):
    return files.classify_media(recipe(spark, sf, "f_files"))


@query
def media_supported(spark, sf):
    return files.drop_unsupported_media(recipe(spark, sf, "f_files"), "zhipuai")


@query
def file_type_histogram(spark, sf):
    return files.type_histogram(recipe(spark, sf, "f_files"))


# --- requests ---


def _requests(spark, sf) -> DataFrame:
    return requests.build_requests(recipe(spark, sf, "f_req"), KEYS, "text", OPTIONS, ["copy_no"])


@query
def request_build(spark, sf):
    return _requests(spark, sf)


@query
def request_ids(spark, sf):
    """Ids over a key of free text: spaces, punctuation, line breaks and non-ASCII letters."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return ids.stamp_request_id(docs, ["text", "doc_id"]).select("doc_id", "custom_id")


@query
def key_roundtrip(spark, sf):
    stamped = ids.stamp_request_id(table(spark, sf, "documents").select("doc_id", "text"), ["text", "doc_id"])
    back = ids.restore_keys(stamped.select("custom_id"), ["text", "doc_id", "missing"])
    return back.select("text", "doc_id", "missing")


@query
def skip_accounting(spark, sf):
    return requests.skip_accounting(recipe(spark, sf, "f_req"), KEYS, "text", OPTIONS, ["copy_no"], max_bytes=20_000)


@query
def request_shards(spark, sf):
    sent = materialise(_requests(spark, sf), "requests")
    sharded = requests.shard_requests(sent, max_rows=40, max_bytes=100_000, max_line_bytes=50_000)
    return sharded.select("custom_id", "shard")


@query
def request_jsonl(spark, sf):
    """Requests as written: every line of every shard file, read back as text."""
    path = work_path(spark, "jsonl")
    sharded = requests.shard_requests(materialise(_requests(spark, sf), "requests"), max_bytes=10_000_000)
    requests.write_requests(sharded, path)
    return spark.read.text(path).select(F.col("value").alias("line"))


def _media_requests(spark, sf, options) -> DataFrame:
    found = files.attach_urls(recipe(spark, sf, "f_files"), recipe(spark, sf, "f_url"))
    return requests.build_media_requests(found, options).select("relative_path", "custom_id", "request")


@query
def media_requests(spark, sf):
    return _media_requests(spark, sf, MEDIA)


@query
def media_requests_audio(spark, sf):
    return _media_requests(spark, sf, MEDIA_ALL)


@query
def cost_estimate(spark, sf):
    return planning.cost_estimate(table(spark, sf, "documents"))


@query
def plan_files(spark, sf):
    return planning.plan_files(recipe(spark, sf, "f_files"))


@query
def plan_profile(spark, sf):
    return planning.plan_profile(table(spark, sf, "documents"))


# --- results ---


def _sent(spark, sf) -> DataFrame:
    docs = table(spark, sf, "documents").where("lang <> 'de'")
    return requests.build_requests(docs, ["doc_id"], "text", OPTIONS)


@query
def results_with_source(spark, sf):
    joined = results.attach_request_context(_results(spark, sf)[0], _sent(spark, sf))
    return joined.select("custom_id", "content", "source_text")


def _table_results(spark, sf) -> DataFrame:
    joined = results.attach_request_context(_results(spark, sf)[0], _sent(spark, sf))
    return results.table_results(results.stamp_metadata(joined, "dashscope", "batch-7", AT), ["doc_id"])


@query
def results_table(spark, sf):
    return _table_results(spark, sf)


@query
def file_results(spark, sf):
    """Answers to media requests, keyed by path; one file in seven is not in the listing."""
    stamped = ids.stamp_request_id(recipe(spark, sf, "f_files"), ["relative_path"])
    answer = F.concat(
        F.lit('{"custom_id":"'), F.col("custom_id"),
        F.lit('","response":{"status_code":200,"body":{"choices":[{"message":{"content":"seen"}}]}}}'),
    )
    flat = results.flatten_results(lines.read_result_lines(stamped.select(answer.alias("line")))[0])
    listed = recipe(spark, sf, "f_inventory").where("relative_path <> '' AND size IS NOT NULL")
    located = results.attach_file_metadata(flat, listed, "my_vol", "Describe")
    return results.file_results(results.stamp_metadata(located, "dashscope", "batch-8", AT, include_raw=False))


@query
def error_histogram(spark, sf):
    return results.error_histogram(_errors(spark, sf))


@query
def retry_plan(spark, sf):
    planned = retry.retry_plan(_errors(spark, sf))
    return planned.select("custom_id", "attempt", "error_code", "retryable", "action", "next_attempt", "next_delay")


@query
def failed_requests(spark, sf):
    """Errors with the requests they came from."""
    events = table(spark, sf, "events").select("event_id", "props", "value")
    sent = requests.build_requests(events, ["event_id"], "props", OPTIONS, ["value"])
    return retry.failed_requests(_errors(spark, sf), sent).select("custom_id", "action", "request")


@query
def fenced_json(spark, sf):
    answers = recipe(spark, sf, "f_fenced").withColumn("answer", text.fenced_body(F.col("answer")))
    return channels.parse_product_json(answers, ["lang"], "answer")


# --- targets ---


@query
def target_schema(spark, sf):
    """The created target's columns, and how many values each holds after a write."""
    docs = table(spark, sf, "documents")
    layout = S.target_schema(docs.schema, ["doc_id", "source"])
    return _written_columns(spark, layout, recipe(spark, sf, "f_tgt"))


@query
def file_target_schema(spark, sf):
    done = recipe(spark, sf, "f_done_files").select("file_path", F.col("quality").cast("string").alias("ai_result"))
    return _written_columns(spark, S.file_target_schema(), done)


def _written_columns(spark, layout, rows: DataFrame) -> DataFrame:
    path = work_path(spark, "target")
    sinks.ensure_table(spark, path, layout)
    sinks.append_results(sinks.add_missing_columns(rows, layout).select(*layout.names), path)
    written = read_table(spark, path, layout)
    counted = written.agg(*[F.count(c).alias(c) for c in layout.names]).unpivot([], layout.names, "column_name", "filled")
    types = {f.name: f.dataType.simpleString() for f in layout.fields}
    kinds = F.create_map(*[F.lit(x) for pair in types.items() for x in pair])
    return counted.withColumn("data_type", kinds[F.col("column_name")])


@query
def schema_evolve(spark, sf):
    old = recipe(spark, sf, "f_tgt").select("doc_id", "ai_result")
    new = _table_results(spark, sf).select(F.col("doc_id").cast("bigint"), "ai_result", *S.METADATA_COLUMNS)
    both = sinks.add_missing_columns(old).unionByName(new)
    return both.select("doc_id", "ai_result", "model", "total_tokens", "batch_id")


@query
def schema_align(spark, sf):
    layout = S.T.StructType.fromDDL("item_key string, sales double, volume int, note string")
    rows = recipe(spark, sf, "f_sales_a").withColumn("extra", F.lit(1)).withColumnRenamed("volume", "VOLUME")
    dirty = rows.withColumn("sales", F.when(F.col("VOLUME") == "8", "n/a").otherwise(F.col("sales")))
    return sinks.align_to_schema(dirty, layout, flag_failures=True).withColumnRenamed("VOLUME", "volume")


@query
def results_table_roundtrip(spark, sf):
    path = work_path(spark, "roundtrip")
    rows = _table_results(spark, sf).select("doc_id", "ai_result", "total_tokens", "batch_id")
    sinks.append_results(rows.where("total_tokens = 0"), path, "overwrite")
    sinks.append_results(rows.where("total_tokens > 0"), path, "append")
    return read_table(spark, path)


@query
def idempotent_append(spark, sf):
    """Three batches are there; five are offered twice; two are new and each is added once."""
    path = work_path(spark, "append")
    sinks.idempotent_append(recipe(spark, sf, "f_tgt"), path)
    offered = table(spark, sf, "documents").select(
        "doc_id", "source", F.col("lang").alias("ai_result"),
        F.concat(F.lit("batch-"), (F.col("doc_id") % 5).cast("string")).alias("batch_id"),
    )
    sinks.idempotent_append(offered, path)
    sinks.idempotent_append(offered, path)
    return read_table(spark, path).select("doc_id", "source", "ai_result", "batch_id")


@query
def existing_batches(spark, sf):
    asked = recipe(spark, sf, "f_jobs").select("batch_id")
    return sinks.existing_counts(recipe(spark, sf, "f_tgt"), asked)


@query
def raw_archive(spark, sf):
    path = work_path(spark, "archive")
    batch = F.concat(F.lit("batch-"), F.col("doc_id") % 3).alias("batch_id")
    kept = recipe(spark, sf, "f_res").select(batch, F.lit("result").alias("kind"), "line")
    failed = recipe(spark, sf, "f_err").select(F.lit("batch-0").alias("batch_id"), F.lit("error").alias("kind"), "line")
    sinks.archive_raw(kept.unionByName(failed), path)
    return spark.read.text(path).groupBy("batch_id", "kind").agg(
        F.count("*").alias("lines"), F.sum(F.octet_length("value")).alias("bytes")
    )


@query
def job_ledger_latest(spark, sf):
    path = work_path(spark, "ledger")
    jobs = recipe(spark, sf, "f_jobs")
    ledger.record_job(jobs.where("status = 'submitted'"), path)
    ledger.record_job(jobs.where("status <> 'submitted'"), path)
    return ledger.latest_jobs(spark.read.parquet(path), "event_id").select("batch_id", "status", "event_id")


@query
def job_status(spark, sf):
    return ledger.job_status(recipe(spark, sf, "f_jobs"), "event_id").drop("updated_at", "event_id")


# --- runs ---


def _answer() -> enrich.Scorer:
    """A scorer with a known answer: the request's length, and an error for every long request."""
    size = F.octet_length("request")
    ok = F.concat(
        F.lit('{"custom_id":"'), F.col("custom_id"),
        F.lit('","response":{"status_code":200,"request_id":"q","body":{"model":"m1","choices":[{"message":{"content":"'),
        size.cast("string"), F.lit('"},"finish_reason":"stop"}],"usage":{"prompt_tokens":1,"completion_tokens":1,"total_tokens":2}}}}'),
    )
    failed = F.concat(F.lit('{"custom_id":"'), F.col("custom_id"), F.lit('","error":{"code":"429","message":"rate limit"}}'))
    long = size > 6000
    return enrich.column_scorer(F.when(long, failed).otherwise(ok), F.when(long, "error").otherwise("result"))


def _text_run(spark, sf) -> enrich.Run:
    return enrich.enrich(
        recipe(spark, sf, "f_req"), recipe(spark, sf, "f_tgt"), KEYS, "text", _answer(), OPTIONS, "batch-9",
        at=AT, order=["copy_no"],
    )


def _file_run(spark, sf) -> enrich.Run:
    return enrich.enrich_files(
        recipe(spark, sf, "f_files"), recipe(spark, sf, "f_url"), recipe(spark, sf, "f_done_files"), _answer(), MEDIA,
        "batch-10", "my_vol", at=AT, extensions=["jpg", "png", "mp3", "mov"], prefix="src",
    )


@query
def enrich_text(spark, sf):
    run = _text_run(spark, sf)
    path = work_path(spark, "enriched")
    enrich.write_run(run, path)
    enrich.write_run(run, path)
    return read_table(spark, path).select(*run.rows.columns)


@query
def enrich_files(spark, sf):
    return _file_run(spark, sf).rows


@query
def run_stats(spark, sf):
    runs = {"text": lambda: _text_run(spark, sf), "files": lambda: _file_run(spark, sf)}
    targets = {name: work_path(spark, "enriched") for name in runs}
    stats = enrich.enrich_all(runs, lambda name, run: enrich.write_run(run, targets[name]))
    return stats.drop("elapsed_seconds")


@query
def run_outcomes(spark, sf):
    """Skips by reason and rows written, of both modes; the same batches again write nothing."""
    found = []
    for name, start in (("text", _text_run), ("files", _file_run)):
        target = work_path(spark, "enriched")
        for again in ("", " again"):
            run = start(spark, sf)
            enrich.write_run(run, target)
            found.append(run.outcomes(name + again))
    return reduce(DataFrame.unionByName, found)


@query
def resume_batch(spark, sf):
    """Harvest the documents' result lines for a batch the ledger holds as completed."""
    jobs = recipe(spark, sf, "f_jobs").select(
        F.lit("batch-7").alias("batch_id"), F.lit("completed").alias("status"), "updated_at", "event_id"
    )
    answers = recipe(spark, sf, "f_res").select("line")
    done = recipe(spark, sf, "f_tgt")
    return enrich.resume(jobs, "batch-7", answers, _sent(spark, sf), done, ["doc_id"], "dashscope", AT, "event_id")


@query
def preview_sample(spark, sf):
    return enrich.preview(recipe(spark, sf, "f_req"), KEYS, "text", _answer(), OPTIONS, 5, ["copy_no"])


@query
def enriched_view(spark, sf):
    done = recipe(spark, sf, "f_tgt").withColumn("doc_id", F.col("doc_id").cast("string"))
    base = table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    return enrich.enriched_view(base, done, ["doc_id"], ["ai_result", "batch_id"])


# --- streaming ---


@query
def stream_harvest(spark, sf):
    """Two rounds of result files through the same checkpoint; no line is taken twice."""
    folder, target, state = work_path(spark, "incoming"), work_path(spark, "harvested"), work_path(spark, "state")
    answers = recipe(spark, sf, "f_res")
    halves = [answers.where("line LIKE '%\"stop\"%'"), answers.where("NOT line LIKE '%\"stop\"%'")]
    for half in halves:
        half.select("line").write.mode("append").text(folder)
        for started in harvest.stream_harvest(spark, folder, target, state, ["doc_id"], "dashscope", at=AT):
            started.awaitTermination()
    rows = read_table(spark, target)
    return rows.select("doc_id", "ai_result", "status_code", "total_tokens", "processed_at")


@query
def stream_incremental(spark, sf):
    """Events arrive twice; each user that is not a customer of one segment is selected once."""
    folder, state = work_path(spark, "arriving"), work_path(spark, "state")
    target, selected = work_path(spark, "target"), work_path(spark, "selected")
    events = table(spark, sf, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    known = table(spark, sf, "customer").where("c_mktsegment = 'BUILDING'")
    known.select(F.col("c_custkey").alias("user_id")).write.parquet(target)
    for _ in range(2):
        events.write.mode("append").parquet(folder)
        harvest.stream_incremental(
            spark, folder, events.schema, ["user_id"], target, selected, state, ["ts"]
        ).awaitTermination()
    return spark.read.parquet(selected).select("user_id")


@query
def stream_selection(spark, sf):
    """The same selection by state: seeded once from the target, then each user once, however often events arrive."""
    folder, state, selected = work_path(spark, "arriving"), work_path(spark, "state"), work_path(spark, "selected")
    events = table(spark, sf, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    known = table(spark, sf, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("user_id"))
    for part in ("ts < '2024-01-02'", "TRUE"):
        events.where(part).write.mode("append").parquet(folder)
        selection.stream_selection(spark, folder, events.schema, ["user_id"], selected, state, known, ["ts"]).awaitTermination()
    return spark.read.schema(events.schema).parquet(selected).select("user_id")


@query
def stream_enriched(spark, sf):
    folder, view, state = work_path(spark, "results"), work_path(spark, "view"), work_path(spark, "state")
    done = recipe(spark, sf, "f_tgt")
    base = table(spark, sf, "documents").select("doc_id", "lang")
    for wanted in ("batch_id = 'batch-0'", "batch_id <> 'batch-0'"):
        done.where(wanted).write.mode("append").parquet(folder)
        harvest.stream_enriched_view(
            spark, base, folder, done.schema, ["doc_id"], ["ai_result"], view, state
        ).awaitTermination()
    return harvest.read_view(spark, view).select("doc_id", "lang", "ai_result")


# --- channels ---


def _master(spark, sf) -> DataFrame:
    return stored(spark, sf, "product_master", lambda: _build_master(spark, sf))


def _build_master(spark, sf) -> DataFrame:
    return channels.product_master(ai_tables(spark, sf), sales_tables(spark, sf))


def _summary(spark, sf) -> DataFrame:
    return stored(spark, sf, "channel_summary", lambda: _build_summary(spark, sf))


def _build_summary(spark, sf) -> DataFrame:
    return channels.channel_summary(_master(spark, sf), sales_tables(spark, sf))


@query
def union_channels(spark, sf):
    return channels.union_channels(ai_tables(spark, sf))


@query
def dedupe_master(spark, sf):
    union = channels.union_channels(ai_tables(spark, sf))
    return grouping.keep_first(union, ["platform", "source_key"], ["ai_result"])


@query
def llm_json_fields(spark, sf):
    answers = recipe(spark, sf, "f_ai").select("region", "source_key", "ai_result")
    return channels.parse_product_json(answers).drop("ai_result")


@query
def product_master(spark, sf):
    return _build_master(spark, sf)


@query
def sequence_sliced(spark, sf):
    """The numbering of the master's groups on the path that splits large groups."""
    union = channels.dedupe_results(channels.union_channels(ai_tables(spark, sf)))
    parsed = channels.parse_product_json(union).select(S.BRAND, S.CAT_CODE, "platform", "source_key")
    return grouping.sequence_in_group(parsed, [S.BRAND, S.CAT_CODE], ["platform", "source_key"], slices=16)


@query
def channel_summary(spark, sf):
    path = work_path(spark, "summary")
    sinks.rebuild_table(_build_summary(spark, sf), path, S.SUMMARY, S.SUMMARY_COMMENT)
    return read_table(spark, path)


@query
def range_midpoints(spark, sf):
    names = ["amount_range", "count_range", "price_range", "visits_range", "conv_range"]
    rows = recipe(spark, sf, "f_sales_de")
    return ranges.normalise_ranges(rows, {c: c for c in names}).select("region", "item_key", *names)


@query
def range_rules(spark, sf):
    rows = ranges.normalise_ranges(
        recipe(spark, sf, "f_sales_de"), {S.PRICE: "price_range", S.CONVERSION: "conv_range"}
    )
    ranked = rows.withColumn(S.RANK, text.to_integer(F.col("rank_no")).cast("double"))
    return channels.bound_metrics(ranked).select("region", "item_key", S.PRICE, S.CONVERSION, S.RANK)


@query
def taxonomy_violations(spark, sf):
    codes = recipe(spark, sf, "f_codes").withColumnRenamed("code", S.CAT_CODE)
    return channels.taxonomy_violations(_master(spark, sf), codes).select(S.PLATFORM, S.SOURCE_KEY, S.CAT_CODE)


@query
def master_sample(spark, sf):
    where = f"`{S.BRAND}` <> '{OWN}'"
    columns = [S.BRAND, S.CAT3, S.CAT4, S.PRODUCT, S.CODE, S.SPEC, S.FORMULA, S.PLATFORM, S.SOURCE_KEY]
    return sinks.sample_rows(_master(spark, sf), where, [S.PLATFORM, S.SOURCE_KEY], 5, columns)


@query
def schema_diff(spark, sf):
    """How the raw sales table and the summary differ, with the values each column holds."""
    raw, summary = _jd_self(spark, sf), _summary(spark, sf)
    diff = sinks.schema_diff(raw, summary)
    filled = [
        df.agg(*[F.count(c).alias(c) for c in df.columns]).unpivot([], df.columns, "column_name", name)
        for df, name in ((raw, "left_filled"), (summary, "right_filled"))
    ]
    return diff.join(filled[0], "column_name", "left").join(filled[1], "column_name", "left")


# --- audit ---


@query
def dq_table_counts(spark, sf):
    named = {f"sales_{i}": df for i, df in enumerate(sales_tables(spark, sf).values())}
    named |= {"channel_summary": _summary(spark, sf), "product_master": _master(spark, sf), "old_master": None}
    return sinks.table_counts(named, spark)


@query
def dq_price_anomaly(spark, sf):
    return quality.price_anomalies(_summary(spark, sf), above=100)


@query
def dq_conv_anomaly(spark, sf):
    return quality.conversion_anomalies(_summary(spark, sf), above=90)


@query
def dq_empty_brand(spark, sf):
    return quality.empty_brands(_summary(spark, sf))


@query
def dq_negative(spark, sf):
    shifted = _summary(spark, sf).withColumn(S.PRICE, F.col(S.PRICE) - 100)
    return quality.negative_values(shifted)


@query
def dq_null_rates(spark, sf):
    return quality.null_rates(_summary(spark, sf))


@query
def dq_duplicates(spark, sf):
    return quality.duplicates(_summary(spark, sf))


@query
def dq_raw_vs_parsed(spark, sf):
    return quality.raw_vs_parsed(_jd_self(spark, sf), _master(spark, sf))


@query
def dq_range_readings(spark, sf):
    """All range channels; some products of one are sold twice."""
    sales = sales_tables(spark, sf)
    sales["天猫"] = sales["天猫"].unionByName(sales["天猫"].where("`商品编码` LIKE '%7'"))
    return quality.range_readings(sales, _master(spark, sf))


@query
def dq_price_bands(spark, sf):
    return quality.audit_price_bands(_summary(spark, sf))


@query
def dq_master(spark, sf):
    return quality.master_completeness(_master(spark, sf))


@query
def dq_empty_columns(spark, sf):
    return tables.empty_counts(_master(spark, sf), [S.BRAND, S.CAT3, S.CAT_CODE, S.PRODUCT, S.FORMULA, S.SPEC])


@query
def spec_histogram(spark, sf):
    return tables.value_histogram(_master(spark, sf), S.SPEC)


@query
def dq_report(spark, sf):
    named = {f"sales_{i}": df for i, df in enumerate(sales_tables(spark, sf).values())}
    return quality.dq_report(
        _summary(spark, sf), _master(spark, sf), {**named, "old_master": None}, _jd_self(spark, sf)
    )


# --- analyses ---


@query
def channel_counts(spark, sf):
    return analytics.channel_counts(_summary(spark, sf))


@query
def price_distribution(spark, sf):
    return analytics.price_distribution(_summary(spark, sf))


@query
def conversion_distribution(spark, sf):
    return analytics.conversion_distribution(_summary(spark, sf))


@query
def volume_spread(spark, sf):
    return analytics.volume_spread(_summary(spark, sf))


@query
def brand_share(spark, sf):
    return analytics.brand_share(_summary(spark, sf))


@query
def category_structure(spark, sf):
    return analytics.category_structure(_summary(spark, sf))


@query
def brand_vs_peers(spark, sf):
    return analytics.brand_vs_peers(_summary(spark, sf), PEERS)


@query
def brand_cross_channel(spark, sf):
    return analytics.brand_cross_channel(_summary(spark, sf), OWN)


@query
def price_bands(spark, sf):
    return analytics.price_bands(_summary(spark, sf))


@query
def top_sellers(spark, sf):
    return analytics.top_sellers(_summary(spark, sf))


@query
def high_conversion(spark, sf):
    return analytics.high_conversion(_summary(spark, sf))


@query
def top_brand_channels(spark, sf):
    return analytics.top_brand_channels(_summary(spark, sf))
