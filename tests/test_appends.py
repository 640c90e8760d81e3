"""Appends of batch and stream runs into targets that hold rows already, and streams with gaps."""

from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from batchloom import schemas
from batchloom.operators import sinks
from batchloom.plans import channels, enrich, quality
from batchloom.sources import tables
from batchloom.storage import has_data, read_table, table_exists, work_path
from batchloom.streaming import harvest

ROWS = "id string, batch_id string"
LINE = '{"custom_id":"req-%s","response":{"status_code":200,"body":{"choices":[{"message":{"content":"c%s"}}]}}}'


def _harvest(spark, folder, target, state, quarantine=None):
    for query in harvest.stream_harvest(spark, folder, target, state, ["id"], "p", quarantine=quarantine, at="2024-01-01T00:00:00Z"):
        query.awaitTermination()


def test_rows_without_a_batch_id_are_never_replaced(spark):
    for blank in (None, ""):
        path = work_path(spark, "blank")
        for first in (0, 3):
            rows = [(str(i), blank) for i in range(first, first + 3)] + [("x", "b1")]
            sinks.idempotent_append(spark.createDataFrame(rows, ROWS), path)
        found = sorted(r.id for r in read_table(spark, path).collect())
        assert found == ["0", "1", "2", "3", "4", "5", "x"]


def test_rows_without_a_batch_id_in_a_catalog_table(spark):
    for _ in range(2):
        sinks.idempotent_append(spark.createDataFrame([("1", None), ("2", "b1")], ROWS), "append_blank")
    assert sorted(r.id for r in spark.table("append_blank").collect()) == ["1", "1", "2"]
    spark.sql("DROP TABLE append_blank")


def test_an_empty_partitioned_folder_is_a_target(spark):
    path = work_path(spark, "empty")
    layout = T.StructType.fromDDL(ROWS)
    sinks.ensure_table(spark, path, layout, ["batch_id"])
    assert table_exists(spark, path) and not has_data(spark, path)
    assert read_table(spark, path).schema == layout and read_table(spark, path).count() == 0
    for _ in range(2):
        sinks.idempotent_append(spark.createDataFrame([("1", "b 1/2")], ROWS), path)
    assert [tuple(r) for r in read_table(spark, path).select("id", "batch_id").collect()] == [("1", "b 1/2")]


def test_a_folder_left_empty_by_a_failed_write(spark, tmp_path):
    path = str(tmp_path / "left")
    (tmp_path / "left").mkdir()
    assert not table_exists(spark, path)
    sinks.idempotent_append(spark.createDataFrame([("1", "b")], ROWS), path)
    assert read_table(spark, path).count() == 1


def test_a_path_target_without_audit_columns_gets_them(spark):
    path = work_path(spark, "plain")
    spark.createDataFrame([("0", "old")], "id string, ai_result string").write.parquet(path)
    added = sinks.evolve_table(spark, path)
    assert "batch_id" in added and sinks.evolve_table(spark, path) == []
    rows = spark.createDataFrame([("1", "new", "b1", "p")], "id string, ai_result string, batch_id string, provider string")
    for _ in range(2):
        sinks.idempotent_append(rows, path)
    found = {r.id: r for r in read_table(spark, path).collect()}
    assert len(found) == read_table(spark, path).count() == 2
    assert (found["0"].batch_id, found["1"].batch_id, found["1"].provider) == (None, "b1", "p")
    assert set(schemas.METADATA.names) <= set(read_table(spark, path).columns)


def test_harvest_into_a_target_with_batch_rows(spark):
    folder, state, bad = (work_path(spark, n) for n in ("in", "state", "bad"))
    for target in (work_path(spark, "target"), "harvest_target"):
        held = spark.createDataFrame([(str(i), "old", "batch-1") for i in range(5)], "id string, ai_result string, batch_id string")
        sinks.idempotent_append(sinks.add_missing_columns(held), target)
        for name, keys in (("a/p", "78"), ("b/p", "9")):
            lines = [(LINE % (k, k),) for k in keys] + [("junk",)]
            spark.createDataFrame(lines, "v string").coalesce(1).write.mode("overwrite").text(f"{folder}/{target[-6:]}/{name}")
            for _ in range(2):
                _harvest(spark, f"{folder}/{target[-6:]}", target, f"{state}{target[-6:]}", f"{bad}{target[-6:]}")
        again = f"{state}-again{target[-6:]}"
        _harvest(spark, f"{folder}/{target[-6:]}", target, again)  # a lost checkpoint adds nothing
        rows = read_table(spark, target).collect()
        assert sorted(r.id for r in rows) == ["0", "1", "2", "3", "4", "7", "8", "9"]
        batches = {r.batch_id for r in rows if r.id in "789"}
        assert len(batches) == 2 and all(b.startswith(("a/p/part-", "b/p/part-")) for b in batches)
        assert read_table(spark, f"{bad}{target[-6:]}").count() == 2
    spark.sql("DROP TABLE harvest_target")


def test_batch_ids_of_files(spark):
    paths = ["file:/data/in/a%20b/x.y.jsonl", "file:///data/in/p.jsonl", "file:/data/in/plain"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    for folder in ("/data/in", "file:///data/in/"):
        got = [r[0] for r in df.select(harvest.batch_from_file(F.col("p"), folder)).collect()]
        assert got == ["a b/x.y", "p", "plain"]


def test_null_keys_are_not_selected(spark):
    folder, target, selected, state = (work_path(spark, n) for n in ("in", "tgt", "sel", "state"))
    rows = spark.createDataFrame([(1, "a"), (None, "b"), (2, "c")], "k int, v string")
    for _ in range(3):
        rows.write.mode("append").parquet(folder)
        harvest.stream_incremental(spark, folder, rows.schema, ["k"], target, selected, state, ["v"]).awaitTermination()
    assert sorted(r.k for r in spark.read.parquet(selected).collect()) == [1, 2]


def test_results_wait_for_late_base_rows(spark):
    folder, base, view, state = (work_path(spark, n) for n in ("in", "base", "view", "state"))
    results = "k int, r string"

    def round_of(found, known):
        spark.createDataFrame(found, results).coalesce(1).write.mode("append").parquet(folder)
        if known:
            spark.createDataFrame(known, "k int, b string").write.mode("append").parquet(base)
        schema = T.StructType.fromDDL(results)
        harvest.stream_enriched_view(
            spark, lambda s: s.read.parquet(base), folder, schema, ["k"], ["r"], view, state
        ).awaitTermination()
        return sorted(tuple(r) for r in harvest.read_view(spark, view).select("k", "r", "b").collect())

    assert round_of([(1, "x"), (2, "early")], [(1, "one")]) == [(1, "x", "one")]
    assert round_of([(1, "y")], []) == [(1, "x", "one"), (1, "y", "one")]
    expected = [(1, "x", "one"), (1, "y", "one"), (2, "early", "two"), (3, "z", "three")]
    assert round_of([(3, "z")], [(2, "two"), (3, "three")]) == expected


def test_texts_meet_their_own_numbers_only(spark):
    spec = channels.CHANNELS[3]
    texts = [spec.midpoint[m] for m in (quality.S.SALES, quality.S.VOLUME, quality.S.PRICE)]
    columns = [spec.key, spec.title, *spec.midpoint.values(), spec.rank]
    rows = []
    for i in range(5):
        values = dict.fromkeys(columns, "1 ~ 3") | {spec.key: "k", spec.title: "t", spec.rank: "1"}
        if i == 0:
            values[texts[0]] = "unreadable"
        rows.append(tuple(values[c] for c in columns))
    raw = spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in columns))
    master = spark.createDataFrame([(spec.channel, "k"), (spec.channel, "k")], f"`{quality.S.PLATFORM}` string, `{quality.S.SOURCE_KEY}` string")
    assert quality.raw_vs_parsed(raw, master).count() == 5
    unread = {r.metric: r["rows"] for r in quality.unread_texts(raw, master).collect()}
    assert unread == {quality.S.SALES: 1, quality.S.VOLUME: 0, quality.S.PRICE: 0}


def test_equal_headers_are_told_apart():
    assert tables.sheet_header(["a", "A", None, "a_2", "col_2"]) == ["a", "A_2", "col_2", "a_2_2", "col_2_2"]


def test_preview_skips_files_that_cannot_be_sent(spark):
    from batchloom.operators.requests import RequestOptions

    files = spark.createDataFrame([("a.csv", 1), ("b.jpg", 2), ("c.jpg", 3)], "relative_path string, size bigint")
    urls = spark.createDataFrame([("a.csv", "u"), ("b.jpg", ""), ("c.jpg", "u")], "relative_path string, url string")
    line = F.concat(F.lit('{"custom_id":"'), "custom_id", F.lit('","response":{"status_code":200,"body":{}}}'))
    shown = enrich.preview_files(files, urls, enrich.column_scorer(line), RequestOptions.for_provider("dashscope", files=True), n=1)
    assert [r.custom_id for r in shown.collect()] == ["req-c.jpg"]


def test_text_of_processed_keys_is_not_moved(spark):
    from batchloom.operators import requests
    from batchloom.storage import materialise

    rows = [(i % 40, i, f"text {i} " * 20) for i in range(120)] + [(50, None, "late"), (50, None, "late"), (51, 1, " "), (None, 1, "x")]
    source = materialise(spark.createDataFrame(rows, "k int, o int, body string"), "source")
    done = materialise(spark.range(38).select(F.col("id").cast("int").alias("k")), "done")
    fresh = requests.fresh_copies(source, done, ["k"], "body", ["o"])
    old = requests.unprocessed_rows(requests.first_copies(source, ["k"], "body", ["o"]), done, ["k"])
    assert sorted(map(str, fresh.collect())) == sorted(map(str, old.collect())) and fresh.count() == 3
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    above = plan[: plan.index("LeftSemi")]
    assert above.count("Exchange hashpartitioning") == 1 and "BroadcastExchange" in plan


@pytest.mark.parametrize("known", [True, False])
def test_append_looks_at_no_batch_but_its_own(spark, monkeypatch, known):
    """Neither partitions nor files of earlier batches are listed, also where ids need escapes."""
    path = work_path(spark, "indexed")
    ids = ["a/b=c", "2024-05-01", "x y'z", "back\\slash", "é%41"]
    for i in ids:
        sinks.idempotent_append(spark.createDataFrame([("1", i)], ROWS), path)

    def never(*_):
        raise AssertionError("the whole history is listed")

    monkeypatch.setattr(sinks, "partition_values", never)
    monkeypatch.setattr(sinks, "read_table", never)
    for i in ids:
        offered = spark.createDataFrame([("2", i)], ROWS)
        assert sinks.idempotent_append(offered, path, batches=[i] if known else None) == 0
    assert sinks.idempotent_append(spark.createDataFrame([("3", "new"), ("4", "new")], ROWS), path, batches=["new"] if known else None) == 2
    assert Counter(r.batch_id for r in read_table(spark, path).collect()) == Counter([*ids, "new", "new"])


@pytest.mark.parametrize("kind", ["path", "catalog"])
def test_more_batches_than_are_looked_up(spark, monkeypatch, kind):
    monkeypatch.setattr(sinks, "LOOKUPS", 3)
    target = work_path(spark, "many") if kind == "path" else "many_batches"
    rows = [(str(i), f"b{i % 6}") for i in range(12)]
    assert sinks.idempotent_append(spark.createDataFrame(rows, ROWS), target) == 12
    more = rows + [("n", f"b{i}") for i in range(5, 9)] + [("blank", None), ("blank", "")]
    assert sinks.idempotent_append(spark.createDataFrame(more, ROWS), target) == 5
    assert sinks.idempotent_append(spark.createDataFrame([("q", "b9"), ("q", "b1")], ROWS), target) == 1
    after = Counter(r.batch_id or "" for r in read_table(spark, target).collect())
    assert after == Counter({**{f"b{i}": 2 for i in range(6)}, "b6": 1, "b7": 1, "b8": 1, "b9": 1, "": 2})
    if kind == "catalog":
        spark.sql(f"DROP TABLE {target}")


def test_targets_of_earlier_layouts_are_still_read(spark):
    """A partitioned folder without a kept layout, as other writers leave it."""
    path = work_path(spark, "foreign")
    spark.createDataFrame([("1", "b1")], ROWS).write.partitionBy("batch_id").parquet(path)
    assert sinks.idempotent_append(spark.createDataFrame([("1", "b1"), ("2", "b2")], ROWS), path) == 1
    assert read_table(spark, path).count() == 2
