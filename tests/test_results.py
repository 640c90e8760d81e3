import random

from pyspark.sql import functions as F

from batchloom.operators import results, retry
from batchloom.sources import lines


def _flat(spark, texts):
    good, bad = lines.read_result_lines(spark.createDataFrame([(t,) for t in texts], "line string"))
    return results.flatten_results(good), bad


def test_defaults_and_id_priority(spark):
    flat, bad = _flat(
        spark,
        [
            '{"custom_id":"a","response":{"status_code":200,"request_id":"","body":{"request_id":"r2","id":"r3"}}}',
            '{"custom_id":"b","id":"top","response":{"body":{}}}',
            '{"custom_id":"c"}',
            '{"custom_id":"d","response":{"status_code":"x","body":{"choices":[{"message":{"content":null}}],"usage":{"total_tokens":3.0}}}}',
            "",
            "   ",
        ],
    )
    rows = {r.custom_id: r for r in flat.collect()}
    assert [rows[k].response_id for k in "abcd"] == ["r2", "top", "", ""]
    assert rows["b"].raw_response == "" and rows["c"].status_code == 0 and rows["c"].content == ""
    assert rows["d"].status_code == 0 and rows["d"].total_tokens == 3
    assert bad.count() == 0


def test_raw_response_keeps_unknown_fields(spark):
    flat, _ = _flat(spark, ['{"custom_id":"a","response":{"body":{"z":null,"new":{"k":[1,"é"]},"model":"m"}}}'])
    assert flat.first().raw_response == '{"z":null,"new":{"k":[1,"é"]},"model":"m"}'


def test_quarantine_reasons(spark):
    _, bad = _flat(spark, ["junk", '{"custom_id":""}', '{"x":1}', '{"custom_id":"a","response":null}', "[1]", "5"])
    assert sorted(r.quarantine_reason for r in bad.collect()) == [
        "no_custom_id", "no_custom_id", "not_json", "not_json", "not_json", "null_response",
    ]


def test_parser_takes_any_text(spark):
    rng = random.Random(5)
    parts = ['{"custom_id":"a"', '"response":', "{", "}", "[", "]", "null", '"body"', ":", ",", "1e9", "\\u00", "é", '"']
    noise = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 9))) for _ in range(400)]
    flat, bad = _flat(spark, noise)
    assert flat.count() + bad.count() == len(noise)


def test_error_lines(spark):
    frame = spark.createDataFrame([('{"custom_id":"a","error":{"code":"429","message":"m"}}',), ('{"custom_id":"b","error":null}',), ("x",)], "line string")
    errors, bad = lines.read_error_lines(frame)
    assert [(r.custom_id, r.error_code) for r in errors.orderBy("custom_id").collect()] == [("a", "429"), ("b", None)]
    assert bad.count() == 1


def test_retry_policy(spark):
    rows = [("429", "x", 1), ("404", "timeout", 1), ("500", "x", 4), ("500", "x", 5), ("odd", "Broken Pipe", 2), (None, None, 1)]
    plan = retry.retry_plan(spark.createDataFrame(rows, "error_code string, error_message string, attempt int"))
    got = [(r.action, r.next_delay) for r in plan.collect()]
    assert got == [("retry", 2.0), ("dead_letter", None), ("retry", 16.0), ("dead_letter", None), ("retry", 4.0), ("dead_letter", None)]
    capped = retry.retry_plan(spark.createDataFrame([("503", "x", 9)], "error_code string, error_message string, attempt int"), 20)
    assert capped.first().next_delay == 60.0


def test_ambiguous_keys_stay_apart(spark):
    sent = spark.createDataFrame([("req-a%7Cb|c", "one"), ("req-a|b%7Cc", "two")], "custom_id string, source_text string")
    flat = spark.createDataFrame([("req-a%7Cb|c",), ("req-a|b%7Cc",), ("req-z",)], "custom_id string")
    got = {r.custom_id: r.source_text for r in results.attach_request_context(flat, sent).collect()}
    assert got == {"req-a%7Cb|c": "one", "req-a|b%7Cc": "two", "req-z": ""}


def test_processed_at_is_fixed_offset(spark):
    for zone in ("UTC", "America/New_York", "Asia/Tokyo"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            at = F.lit("2024-07-01T20:00:00Z").cast("timestamp")
            assert spark.range(1).select(results.processed_at(at)).first()[0] == "2024-07-02T04:00:00+08:00"
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
