"""Whole runs: incremental reruns, scorers, isolation, streaming."""

import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from batchloom.operators import incremental
from batchloom.operators.requests import RequestOptions
from batchloom.plans import enrich
from batchloom.storage import read_table, work_path
from batchloom.streaming import harvest

OPTIONS = RequestOptions("m", user_prompt="{text}!")


def _echo():
    """The model as a nested function: workers cannot import a test module."""

    def echo(batches):
        """A model that answers with the prompt in upper case and fails on prompts that say so."""
        for batch in batches:
            out = []
            for custom_id, request in zip(batch["custom_id"], batch["request"]):
                prompt = json.loads(request)["body"]["messages"][-1]["content"]
                if "fail" in prompt:
                    out.append((custom_id, json.dumps({"custom_id": custom_id, "error": {"code": "500"}}), "error"))
                    continue
                body = {"model": "m", "choices": [{"message": {"content": prompt.upper()}, "finish_reason": "stop"}]}
                line = {"custom_id": custom_id, "response": {"status_code": 200, "body": body}}
                out.append((custom_id, json.dumps(line), "result"))
            yield pd.DataFrame(out, columns=["custom_id", "line", "kind"])

    return echo


echo = _echo()


def _source(spark):
    return spark.createDataFrame([(i, f"text {i}" if i % 4 else "fail") for i in range(1, 21)], "id int, text string")


def _run(spark, target, **more):
    held = read_table(spark, target) if more.pop("known", False) else None
    return enrich.enrich(_source(spark), held, ["id"], "text", enrich.pandas_scorer(echo, 3), OPTIONS, more.pop("batch", "b1"), **more)


def test_rerun_retries_failures_only(spark):
    target = work_path(spark, "runs")
    run = _run(spark, target)
    enrich.write_run(run, target)
    rows = read_table(spark, target)
    assert rows.count() == 15 and run.errors.count() == 5
    assert rows.schema["id"].dataType.simpleString() == "int"
    first = rows.where("id = 1").first()
    assert (first.ai_result, first.source_text, first.provider) == ("TEXT 1!", "text 1", "dashscope")
    again = _run(spark, target, known=True, batch="b2")
    assert sorted(r.id for r in again.requests.collect()) == [4, 8, 12, 16, 20]
    stats = run.stats("t").first()
    assert (stats.source_rows, stats.success_count, stats.error_count, stats.written_rows) == (20, 15, 5, 15)


def test_cap_counts_sendable_rows(spark):
    source = spark.createDataFrame([(i, " " if i < 5 else "x") for i in range(10)], "id int, text string")
    run = enrich.enrich(source, None, ["id"], "text", enrich.pandas_scorer(echo), OPTIONS, "b", limit=3)
    assert sorted(r.id for r in run.requests.collect()) == [5, 6, 7]


def test_overwrite_has_to_be_meant(spark):
    target = work_path(spark, "runs")
    run = _run(spark, target)
    with pytest.raises(ValueError):
        enrich.write_run(run, target, mode="overwrite")
    enrich.write_run(run, target, mode="overwrite", full_refresh=True)
    assert read_table(spark, target).count() == 15


def test_sources_are_isolated(spark):
    target, done = work_path(spark, "runs"), []

    def broken():
        raise OSError("gone")

    with pytest.raises(RuntimeError, match="gone"):
        enrich.enrich_all({"bad": broken, "good": lambda: _run(spark, target)}, lambda n, r: done.append(n))
    assert done == ["good"]
    with pytest.raises(ValueError):
        enrich.enrich_all({})


def test_source_without_new_rows_is_skipped(spark):
    nothing = enrich.enrich(_source(spark).where("id < 0"), None, ["id"], "text", enrich.pandas_scorer(echo), OPTIONS, "b")
    stats = {r.source: r for r in enrich.enrich_all({"none": lambda: nothing}).collect()}
    assert stats["none"].batch_status == "skipped" and stats["total"].source_rows == 0


def test_one_text_shuffle_before_requests(spark):
    """Limit copies, shuffle, keep first, anti-join: the source is exchanged once."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        path, known = work_path(spark, "src"), work_path(spark, "known")
        _source(spark).write.parquet(path)
        _source(spark).select("id").write.parquet(known)
        from batchloom.operators import requests

        rows = requests.first_copies(spark.read.parquet(path).where("text <> 'no'"), ["id"], "text")
        fresh = requests.render_requests(incremental.unprocessed_rows(rows, spark.read.parquet(known), ["id"]), ["id"], "text", OPTIONS)
        plan = fresh._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 2 and "LeftAnti" in plan
    assert "Not(EqualTo(text,no))" in plan


def test_string_target_keys_match_numbers(spark):
    target = spark.createDataFrame([("1",), ("junk",), (None,)], "id string")
    assert incremental.unprocessed_rows(_source(spark), target, ["id"]).count() == 19


def test_file_preview(spark):
    listed = spark.createDataFrame([("a.png", 3), ("b.csv", 4)], "relative_path string, size bigint")
    urls = spark.createDataFrame([("a.png", "u")], "relative_path string, url string")
    scorer = enrich.column_scorer(F.concat(F.lit('{"custom_id":"'), "custom_id", F.lit('","response":{"body":{"choices":[{"message":{"content":" ok "}}]}}}')))
    shown = enrich.preview_files(listed, urls, scorer, RequestOptions("v", user_prompt="D"), 5).collect()
    assert [(r.input, r.output) for r in shown] == [("[image] a.png", "ok")]


def test_discovery(spark, tmp_path):
    for name in ("in/a.JPG", "in/b.png", "in/deep/c.jpg", "in.jpg", "out/d.jpg", "in/e.txt"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"1")
    done = spark.createDataFrame([("in/b.png",)], "file_path string")

    def found(**more):
        return sorted(r.relative_path for r in enrich.discover_files(spark, str(tmp_path), **more).collect())

    assert found(target=done, extensions=["jpg", ".PNG"], prefix="in/") == ["in/a.JPG", "in/deep/c.jpg"]
    assert found(extensions=["jpg"], prefix="in") == ["in.jpg", "in/a.JPG", "in/deep/c.jpg"]
    assert found(prefix="none/") == []
    assert found(limit=2) == ["in.jpg", "in/a.JPG"]


def test_harvest_takes_each_file_once(spark):
    folder, target, state, bad = (work_path(spark, n) for n in ("in", "out", "state", "bad"))
    sent = spark.createDataFrame([("req-1", "hello")], "custom_id string, source_text string")
    line = '{"custom_id":"req-%d","response":{"status_code":200,"body":{"choices":[{"message":{"content":"c%d"}}]}}}'
    for round_no in (1, 2, 2):
        lines = [line % (round_no, round_no), "junk"] if round_no == 1 else [line % (2, 2)]
        if round_no == 1 or not done:
            spark.createDataFrame([(t,) for t in lines], "v string").coalesce(1).write.mode("append").text(folder)
        done = round_no == 2
        for query in harvest.stream_harvest(spark, folder, target, state, ["id"], "p", sent, bad, "2024-01-01T00:00:00Z"):
            query.awaitTermination()
    rows = {r.id: r for r in read_table(spark, target).collect()}
    assert {k: r.ai_result for k, r in rows.items()} == {"1": "c1", "2": "c2"}
    assert rows["1"].source_text == "hello" and rows["2"].source_text == ""
    assert rows["1"].batch_id.startswith("part-")
    assert [r.line for r in read_table(spark, bad).collect()] == ["junk"]


def test_harvest_of_file_results(spark):
    folder, target, state = (work_path(spark, n) for n in ("in", "out", "state"))
    sent = spark.createDataFrame([("a/b.png", 9)], "relative_path string, size bigint")
    line = '{"custom_id":"req-a%2Fb.png","response":{"status_code":200,"body":{}}}'
    spark.createDataFrame([(line,)], "v string").write.text(folder)
    for query in harvest.stream_harvest(spark, folder, target, state, [], "p", sent, volume="vol", prompt="P"):
        query.awaitTermination()
    row = spark.read.parquet(target).first()
    assert (row.file_path, row.file_size, row.volume_name, row.source_text) == ("a/b.png", 9, "vol", "P")


def test_streamed_keys_are_selected_once(spark):
    folder, target, selected, state = (work_path(spark, n) for n in ("in", "tgt", "sel", "state"))
    rows = spark.createDataFrame([(i % 5, f"2024-01-01 00:0{i % 6}:00") for i in range(30)], "k int, ts string")
    rows = rows.withColumn("ts", F.col("ts").cast("timestamp"))
    spark.createDataFrame([(0,)], "k int").write.parquet(target)
    for _ in range(2):
        rows.write.mode("append").parquet(folder)
        harvest.stream_incremental(spark, folder, rows.schema, ["k"], target, selected, state, ["ts"], event_time="ts").awaitTermination()
    assert sorted(r.k for r in spark.read.parquet(selected).collect()) == [1, 2, 3, 4]


def test_run_into_a_catalog_table_without_audit_columns(spark):
    spark.createDataFrame([(1, "old")], "id int, ai_result string").write.saveAsTable("plain_target")
    run = _run(spark, "plain_target", known=True)
    for _ in range(2):
        enrich.write_run(run, "plain_target")
    rows = spark.table("plain_target")
    assert rows.count() == 15 and rows.where("id = 1 AND batch_id IS NULL").count() == 1
    assert rows.where("batch_id = 'b1' AND source_text = 'text 2'").count() == 1
    spark.sql("DROP TABLE plain_target")


def test_stats_of_a_written_catalog_target(spark):
    spark.createDataFrame([(1, "old")], "id int, ai_result string").write.saveAsTable("counted_target")
    runs = {"t": lambda: _run(spark, "counted_target", known=True)}
    stats = {r.source: r for r in enrich.enrich_all(runs, lambda n, r: enrich.write_run(r, "counted_target")).collect()}
    assert (stats["t"].source_rows, stats["t"].written_rows, stats["t"].provider) == (19, 14, "dashscope")
    assert stats["t"].elapsed_seconds > 0 and stats["total"].error_count == 5
    spark.sql("DROP TABLE counted_target")


def test_resume_of_files(spark):
    ledger = spark.createDataFrame([("b1", "completed", 1), ("b2", "failed", 1)], "batch_id string, status string, updated_at int")
    lines = spark.createDataFrame([('{"custom_id":"req-a%2Fb.png","response":{"status_code":200,"body":{}}}',)], "line string")
    sent = spark.createDataFrame([("a/b.png", 9)], "relative_path string, size bigint")
    row = enrich.resume(ledger, "b1", lines, sent, None, [], "p", volume="vol", prompt="P").first()
    assert (row.file_path, row.file_size, row.volume_name, row.source_text) == ("a/b.png", 9, "vol", "P")
    assert enrich.resume(ledger, "b2", lines, sent, None, [], "p", volume="vol").count() == 0
