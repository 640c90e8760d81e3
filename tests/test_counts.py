"""What a run counts, how it selects, and sources that run at once."""

import threading
import time

import pytest
from pyspark.sql import functions as F

from batchloom.operators import requests
from batchloom.operators.requests import RequestOptions
from batchloom.plans import enrich
from batchloom.storage import materialise, read_table, work_path

OPTIONS = RequestOptions("m")
ROWS = "k int, o int, body string"


def answer():
    """'bad' gives a broken line, 'fail' an error, 'late' another status; the rest is answered."""
    text = F.col("source_text")
    status = F.when(text == "late", F.lit("500")).otherwise(F.lit("200"))
    ok = F.concat(
        F.lit('{"custom_id":"'), "custom_id", F.lit('","response":{"status_code":'), status,
        F.lit(',"body":{"choices":[{"message":{"content":"'), text, F.lit('"}}]}}}'),
    )
    error = F.concat(F.lit('{"custom_id":"'), "custom_id", F.lit('","error":{"code":"429"}}'))
    line = F.when(text == "bad", F.lit("{")).when(text == "fail", error).otherwise(ok)
    return enrich.column_scorer(line, F.when(text == "fail", "error").otherwise("result"))


def source(spark):
    rows = [(1, 1, "a"), (1, 2, "b"), (1, 2, "b"), (2, 1, " "), (2, 2, "c"), (3, 1, None), (None, 1, "d"), (None, 2, " ")]
    rows += [(4, 1, "bad"), (5, 1, "fail"), (6, 1, "late"), (7, 1, "done"), (7, 2, "done"), (8, 1, "x" * 50)]
    return spark.createDataFrame(rows, ROWS)


def run(spark, target=None, **more):
    return enrich.enrich(source(spark), target, ["k"], "body", answer(), OPTIONS, more.pop("batch", "b1"), **more)


@pytest.mark.parametrize("order", [(), ("o",)])
@pytest.mark.parametrize("keep", [True, False])
def test_every_selected_row_has_an_outcome(spark, order, keep, monkeypatch):
    monkeypatch.setattr(requests.judge_requests, "__defaults__", (200,))
    done = spark.createDataFrame([(7,)], "k int")
    made = run(spark, done, order=order, keep=keep)
    target = work_path(spark, "counted")
    expected = {
        "null_key": 2, "blank_text": 2, "duplicate": 2, "oversized": 1, "capped": 0, "sent": 5, "quarantined": 1, "failed": 1, "written": 0
    }
    assert {r.outcome: r.rows for r in made.outcomes("s").collect()} == expected
    assert enrich.write_run(made, target) == 3 == read_table(spark, target).count()
    assert made.stats("s").first().written_rows == 3
    assert enrich.write_run(made, target) == 0
    stats = made.stats("s").first()
    assert (stats.source_rows, stats.success_count, stats.error_count, stats.written_rows) == (12, 3, 1, 0)
    parts = sum(expected[o] for o in ("null_key", "blank_text", "duplicate", "oversized", "sent"))
    assert parts == stats.source_rows


def test_one_status_is_counted_and_written(spark):
    made = run(spark, status=200)
    assert made.counted()["success"] == made.results.count() == enrich.write_run(made, work_path(spark, "counted"))
    assert "late" not in {r.content for r in made.results.collect()}


def test_file_outcomes(spark):
    paths = ["a.jpg", "b.png", "c.mp3", "d.txt", "e.jpg", "f.jpg"]
    files = spark.createDataFrame([(p, 1) for p in paths], "relative_path string, size long")
    urls = spark.createDataFrame([(p, "http://x/" + p) for p in paths if p != "b.png"] + [("b.png", "")], "relative_path string, url string")
    line = F.concat(F.lit('{"custom_id":"'), "custom_id", F.lit('","response":{"status_code":200,"body":{}}}'))
    options = RequestOptions.for_provider("zhipuai", files=True, user_prompt="D")
    made = enrich.enrich_files(files, urls, None, enrich.column_scorer(line), options, "b", "v", limit=2)
    target = work_path(spark, "counted")
    assert enrich.write_run(made, target) == 2
    found = {r.outcome: r.rows for r in made.outcomes("f").collect()}
    assert found == {"no_url": 1, "unsupported": 2, "oversized": 0, "capped": 1, "sent": 2, "quarantined": 0, "failed": 0, "written": 2}
    assert made.stats("f").first().source_rows == 6
    assert sorted(r.file_path for r in read_table(spark, target).collect()) == ["a.jpg", "e.jpg"]


def test_cap_asks_for_more_keys_where_some_cannot_be_sent(spark, monkeypatch):
    monkeypatch.setattr(requests.judge_requests, "__defaults__", (300,))
    rows = spark.range(40).select(F.col("id").cast("int").alias("k"), F.lit(1).alias("o"), F.when(F.col("id") < 6, "y" * 400).otherwise("ok").alias("body"))
    made = enrich.enrich(rows, None, ["k"], "body", answer(), OPTIONS, "b", limit=4)
    assert sorted(r.k for r in made.requests.collect()) == [6, 7, 8, 9]
    assert made.counts["sent"] == 4 and made.counts["oversized"] == 6 and made.counts["capped"] == 30
    everything = enrich.enrich(rows, None, ["k"], "body", answer(), OPTIONS, "b", limit=39)
    assert everything.counts["sent"] == 34 and everything.counts["capped"] == 0


@pytest.mark.parametrize("order", [[], ["o"]])
def test_no_text_moves_before_processed_keys_are_gone(spark, order):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stored = materialise(source(spark), "source")
        done = materialise(spark.createDataFrame([(7,)], "k int"), "done")
        groups = requests.key_groups(stored, done, ["k"], "body", order)
        plan = groups._jdf.queryExecution().optimizedPlan().toString()
        joined = plan[: plan.index("Aggregate")]
        assert "LeftAnti" in joined and "body" not in joined
        physical = groups._jdf.queryExecution().executedPlan().toString()
        assert physical.count("Exchange hashpartitioning") == 2  # groups and target keys; the join adds none
        fresh = requests.fresh_copies(stored, done, ["k"], "body", order)
        old = requests.unprocessed_rows(requests.first_copies(stored, ["k"], "body", order), done, ["k"])
        assert sorted(map(str, fresh.collect())) == sorted(map(str, old.collect()))
        again = fresh._jdf.queryExecution().executedPlan().toString().partition("== Initial Plan ==")[2]
        assert again.count("Exchange hashpartitioning") == 2  # the winners' join; their copies are told apart in place
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_key_is_aggregated_before_it_moves(spark):
    rows = spark.range(0, 3000, 1, 4).select(F.lit(1).alias("k"), F.col("id").cast("int").alias("o"), F.col("id").cast("string").alias("body"))
    groups, counts = requests.store_key_groups(requests.key_groups(rows, None, ["k"], "body", ["o"]), ["k"])
    assert counts == {"selected": 3000, "null_key": 0, "blank_text": 0, "duplicate": 2999, "usable": 1}
    assert [r.body for r in requests.copies_of(groups, rows, ["k"], "body", ["o"]).collect()] == ["0"]
    plan = requests.key_groups(rows, None, ["k"], "body")._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan


@pytest.mark.parametrize("kind", ["path", "catalog"])
def test_results_without_audit_columns(spark, kind):
    target = work_path(spark, "plain") if kind == "path" else "plain_results"
    assert enrich.write_run(run(spark), target, include_metadata=False) == 5
    assert read_table(spark, target).columns == ["k", "ai_result"]
    known = read_table(spark, target)
    again = run(spark, known, batch="b2")
    assert sorted(r.k for r in again.requests.collect()) == [4, 5]
    more = spark.createDataFrame([(20, 1, "new")], ROWS)
    late = enrich.enrich(more, known, ["k"], "body", answer(), OPTIONS, "b3")
    assert enrich.write_run(late, target, include_metadata=False) == 1
    if kind == "catalog":
        spark.catalog.refreshTable(target)
    assert read_table(spark, target).columns == ["k", "ai_result"] and read_table(spark, target).count() == 6
    if kind == "catalog":
        spark.sql(f"DROP TABLE {target}")


def test_sources_run_at_once_and_keep_their_stats(spark):
    both = threading.Barrier(2, timeout=60)

    def start():
        both.wait()  # neither gets on before the other has started
        return run(spark)

    def broken():
        raise OSError("gone")

    target = work_path(spark, "runs")
    spans = {}

    def write(name, made):
        spans[name] = time.monotonic()
        enrich.write_run(made, f"{target}/{name}")

    sources = {"a": start, "b": start, "bad": broken}
    with pytest.raises(enrich.SourcesFailed, match="gone") as failed:
        enrich.enrich_all(sources, write)
    assert set(spans) == {"a", "b"} and set(failed.value.failures) == {"bad"}
    kept = {r.source: r for r in failed.value.stats.collect()}
    assert kept["a"].written_rows == kept["b"].written_rows == 5 and kept["total"].written_rows == 10
    shown = {r.source: r for r in enrich.enrich_all(sources, write, report_failures=True).collect()}
    assert shown["bad"].batch_status == "failed" and "gone" in shown["bad"].error and shown["bad"].written_rows is None
    assert shown["a"].batch_status == "completed" and shown["a"].written_rows == 0 and shown["total"].source_rows == 28
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None


def test_all_sources_failing(spark):
    def broken():
        raise OSError("gone")

    with pytest.raises(enrich.SourcesFailed) as failed:
        enrich.enrich_all({"x": broken})
    assert failed.value.stats is None
    row = {r.source: r for r in enrich.enrich_all({"x": broken}, report_failures=True).collect()}
    assert row["x"].batch_status == "failed" and row["total"].source_rows is None


def test_profile_measures_all_columns_in_one_job(spark, monkeypatch):
    from batchloom.operators import planning

    rows = [(i, float(i % 7), f"text {i}", None if i == 3 else str(i), [i], {"a": i}, 0.0 if i else -0.0) for i in range(60)]
    plain = spark.createDataFrame(rows, "k int, v double, body string, gap string, list array<int>, held map<string,int>, zero double")
    df = plain.withColumnRenamed("k", "a.b")
    watched, calls = watch(spark, plain)
    found = {r.column_name: r for r in planning.plan_profile(watched.withColumnRenamed("k", "a.b")).collect()}
    assert calls.value == 60
    assert {n for n, r in found.items() if r.key_candidate} == {"a.b", "body", "list"}
    assert [n for n, r in found.items() if r.text_candidate] == ["body"]
    assert found["body"].mean_chars == sum(len(r[2]) for r in rows) / 60 and found["held"].mean_chars is None
    plan_calls = []
    monkeypatch.setattr(planning, "_is_unique", lambda *a: plan_calls.append(a) or True)
    monkeypatch.setattr(planning, "_digests", lambda value: (F.abs(F.hash(value)) % 40, F.xxhash64(value)))
    found = {r.column_name: r for r in planning.plan_profile(df).collect()}
    assert {n for n, r in found.items() if r.key_candidate} == {"a.b", "body", "list"} and len(plan_calls) == 3
    none = {r.column_name: r for r in planning.plan_profile(df.where("v < 0")).collect()}
    assert none["body"].row_count == 0 and none["body"].mean_chars == 0.0


def watch(spark, df):
    calls = spark.sparkContext.accumulator(0)

    def touched(batches):
        for batch in batches:
            calls.add(batch.num_rows)
            yield batch

    return df.mapInArrow(touched, df.schema), calls


def test_product_master_stores_its_wide_rows_once_and_does_not_sort_them(spark):
    import os

    from batchloom.plans import channels
    from batchloom.storage import work_folder

    spec = channels.CHANNELS[1]
    answer = '{"品牌":"a","类目编码":"x","规格":"2"}'
    results = spark.createDataFrame([("1", answer), ("2", answer), (None, "no json")], [spec.key, "ai_result"])
    sales = spark.createDataFrame([("1", "one"), ("1", "another"), ("2", "two")], [spec.key, spec.title])
    folder = work_folder(spark).removeprefix("file://")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    master = channels.product_master({spec.channel: results}, {spec.channel: sales})
    stored = sorted(name.rsplit("-", 1)[0] for name in set(os.listdir(folder)) - before)
    assert stored == ["sequence-rows", "sequence-slices"]
    assert "ShuffledHashJoin" in master._jdf.queryExecution().sparkPlan().toString()
    assert master.count() == 3
