import json

import pytest
from pyspark.sql import functions as F

from batchloom.operators import requests
from batchloom.operators.requests import RequestOptions
from batchloom.storage import work_path

OPTIONS = RequestOptions("m", 'Say "hi"\n', "Q: {text}", params={"temperature": 1e-07, "top_p": None, "enable_thinking": True})


def _frame(spark, rows):
    return spark.createDataFrame(rows, "id string, text string, n int")


def test_request_json_is_compact_and_ordered(spark):
    text = 'a "quoted" \\ slash/ 中文 　 tab\tline\n'
    line = requests.build_requests(_frame(spark, [("k 1", text, 0)]), ["id"], "text", OPTIONS).first().request
    expected = {
        "custom_id": "req-k%201", "method": "POST", "url": "/v1/chat/completions",
        "body": {
            "model": "m",
            "messages": [{"role": "system", "content": 'Say "hi"\n'}, {"role": "user", "content": "Q: " + text}],
            "temperature": 1e-07, "enable_thinking": True,
        },
    }
    assert line == json.dumps(expected, ensure_ascii=False, separators=(",", ":"))


def test_order_of_checks(spark):
    rows = [("a", "x" * 500, 0), ("a", "small", 1), ("b", " ", 0), ("b", "kept", 1), (None, "no key", 0)]
    built = requests.build_requests(_frame(spark, rows), ["id"], "text", OPTIONS, ["n"], max_bytes=400).collect()
    assert [(r.id, r.source_text) for r in built] == [("b", "kept")]
    counts = requests.skip_accounting(_frame(spark, rows), ["id"], "text", OPTIONS, ["n"], max_bytes=400)
    assert {r.outcome: r.rows for r in counts.collect()} == {
        "null_key": 1, "blank_text": 1, "duplicate": 1, "oversized": 1, "ready": 1,
    }


def test_line_cap_counts_bytes(spark):
    frame = spark.createDataFrame([("é" * 10,), ("e" * 10,)], "request string")
    assert [r.request for r in requests.drop_oversized(frame, max_bytes=12).collect()] == ["e" * 10]


@pytest.mark.parametrize("max_rows,max_bytes,buckets", [(7, 3000, None), (1000, 1500, 3), (5, 100_000, 1)])
def test_shards_keep_both_caps(spark, max_rows, max_bytes, buckets):
    rows = spark.range(600).select(
        F.concat(F.lit("req-"), "id").alias("custom_id"), F.repeat(F.lit("é"), (F.col("id") * 37 % 400).cast("int")).alias("request")
    )
    sharded = requests.shard_requests(rows, max_rows, max_bytes, buckets, max_line_bytes=900)
    sizes = sharded.groupBy("shard").agg(F.count("*").alias("n"), F.sum(F.octet_length("request") + 1).alias("b")).collect()
    assert sum(r.n for r in sizes) == 600
    assert max(r.n for r in sizes) <= max_rows and max(r.b for r in sizes) <= max_bytes


def test_written_shards_are_single_files(spark):
    rows = spark.range(300).select(F.concat(F.lit("req-"), "id").alias("custom_id"), F.repeat(F.lit("x"), 100).alias("request"))
    path = work_path(spark, "shards")
    requests.write_requests(requests.shard_requests(rows, max_rows=20, max_bytes=5000, max_line_bytes=200), path)
    files = spark.read.text(path).groupBy(F.col("_metadata.file_path"), "shard").count().collect()
    assert sum(r["count"] for r in files) == 300
    assert max(r["count"] for r in files) <= 20
    assert len({r.shard for r in files}) == len(files)


def test_nothing_to_send_is_an_error(spark):
    empty = spark.createDataFrame([], "shard string, request string")
    with pytest.raises(ValueError):
        requests.write_requests(empty, work_path(spark, "none"))


def test_media_parts(spark):
    files = spark.createDataFrame(
        [("a/x.JPG", "u1"), ("b.mp3", "u2"), ("c.mov", "u3"), ("d.csv", "u4"), ("e.png", None), ("f.png", "")],
        "relative_path string, presigned_url string",
    )
    taken = {}
    for provider in ("dashscope", "zhipuai", "other"):
        options = RequestOptions("v", "", "Describe", provider=provider)
        taken[provider] = {r.relative_path: json.loads(r.request) for r in requests.build_media_requests(files, options).collect()}
    assert set(taken["dashscope"]) == {"a/x.JPG", "b.mp3", "c.mov"}
    assert set(taken["zhipuai"]) == {"a/x.JPG", "c.mov"}
    assert taken["other"] == {}
    assert taken["dashscope"]["b.mp3"]["body"]["messages"] == [
        {"role": "user", "content": [{"type": "input_audio", "input_audio": {"url": "u2"}}, {"type": "text", "text": "Describe"}]}
    ]
    assert taken["zhipuai"]["a/x.JPG"]["custom_id"] == "req-a%2Fx.JPG"


def test_provider_defaults():
    options = RequestOptions.for_provider("zhipuai", files=True, user_prompt="x")
    assert (options.model, options.endpoint, options.provider) == ("glm-4v-plus", "/v4/chat/completions", "zhipuai")
