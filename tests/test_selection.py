"""Selection with keys as state."""

from batchloom.storage import work_path
from batchloom.streaming import selection

ROWS = "k int, o int, v string"


def select(spark, paths, rows, done, order=("o",), **more):
    spark.createDataFrame(rows, ROWS).write.mode("append").parquet(paths[0])
    schema = spark.createDataFrame([], ROWS).schema
    query = selection.stream_selection(spark, paths[0], schema, ["k"], paths[1], paths[2], done, order, **more)
    query.awaitTermination()
    return sorted((r.k, r.o if r.o is not None else -1, r.v) for r in spark.read.schema(schema).parquet(paths[1]).collect())


def untouchable(spark):
    def read(batches):
        raise AssertionError("the target is read again")
        yield

    return spark.createDataFrame([(1,)], "k int").mapInArrow(read, "k int")


def test_each_key_once_and_the_target_only_at_first(spark):
    paths = [work_path(spark, n) for n in ("arriving", "selected", "state")]
    done = spark.createDataFrame([("1",), ("1",), ("2",), ("junk",), (None,)], "k string")
    first = [(i % 6, i, "x") for i in range(6, 40)] + [(None, 0, "no key"), (3, None, "least"), (9, 1, "tie"), (9, 1, "tie")]
    expected = [(0, 6, "x"), (3, -1, "least"), (4, 10, "x"), (5, 11, "x"), (9, 1, "tie")]
    settings = [spark.conf.get(name, None) for name in selection.SETTINGS]
    assert select(spark, paths, first, done) == expected
    assert [spark.conf.get(name, None) for name in selection.SETTINGS] == settings
    again = select(spark, paths, first + [(1, 0, "done"), (20, 5, "b"), (20, 4, "a")], untouchable(spark))
    assert again == expected + [(20, 4, "a")]
    assert select(spark, paths, [], untouchable(spark)) == again


def test_without_a_target_or_order(spark):
    paths = [work_path(spark, n) for n in ("arriving", "selected", "state")]
    found = select(spark, paths, [(1, 1, "a"), (2, 2, "b"), (2, 2, "b")], None, order=())
    assert found == [(1, 1, "a"), (2, 2, "b")]


def test_a_running_query_has_no_target_in_its_plan(spark):
    paths = [work_path(spark, n) for n in ("arriving", "selected", "state")]
    schema = spark.createDataFrame([], ROWS).schema
    spark.createDataFrame([(1, 1, "a"), (2, 1, "b")], ROWS).write.parquet(paths[0])
    done = spark.createDataFrame([(1,)], "k int")
    query = selection.stream_selection(spark, paths[0], schema, ["k"], paths[1], paths[2], done, trigger={"processingTime": "1 second"})
    try:
        spark.createDataFrame([(1, 2, "c"), (2, 2, "d"), (3, 2, "e")], ROWS).write.mode("append").parquet(paths[0])
        query.processAllAvailable()
        plan = query._jsq.explainInternal(False)
        assert "WithInitState" not in plan and "TransformWithState" in plan
    finally:
        query.stop()
    assert sorted(r.v for r in spark.read.parquet(paths[1]).collect()) == ["b", "e"]


def test_a_key_is_forgotten_after_its_lifetime(spark):
    paths = [work_path(spark, n) for n in ("arriving", "selected", "state")]
    assert select(spark, paths, [(1, 1, "a")], None, lifetime_ms=1) == [(1, 1, "a")]
    assert select(spark, paths, [(1, 2, "b")], None, lifetime_ms=1) == [(1, 1, "a"), (1, 2, "b")]
