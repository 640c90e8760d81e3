import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from batchloom import schemas
from batchloom.operators import grouping, ledger, sinks
from batchloom.sources import files, tables
from batchloom.storage import materialise, qualify, read_table, table_exists, work_path


def test_append_twice_is_append_once(spark):
    path = work_path(spark, "target")
    rows = spark.range(100).select("id", F.concat(F.lit("b"), F.col("id") % 3).alias("batch_id"))
    sinks.idempotent_append(rows, path)
    sinks.idempotent_append(rows.unionByName(rows.withColumn("batch_id", F.lit("b9"))), path)
    counts = {r.batch_id: r["count"] for r in read_table(spark, path).groupBy("batch_id").count().collect()}
    assert counts == {"b0": 34, "b1": 33, "b2": 33, "b9": 100}


def test_append_to_catalog_table(spark):
    rows = spark.range(10).select("id", F.lit("b1").alias("batch_id"))
    sinks.idempotent_append(rows, "appended")
    sinks.idempotent_append(rows, "appended")
    sinks.idempotent_append(rows.withColumn("batch_id", F.lit("b2")), "appended")
    assert spark.table("appended").groupBy("batch_id").count().where("count = 10").count() == 2
    spark.sql("DROP TABLE appended")


def test_evolve_catalog_table(spark):
    spark.range(3).selectExpr("id", "'x' AS Model").write.saveAsTable("grown")
    added = sinks.evolve_table(spark, "grown")
    assert "model" not in added and len(added) == len(schemas.METADATA_COLUMNS) - 1
    assert sinks.evolve_table(spark, "grown") == []
    assert spark.table("grown").where("batch_id IS NULL").count() == 3
    spark.sql("DROP TABLE grown")


def test_key_types_follow_the_source():
    source = T.StructType.fromDDL("a bigint, b int, c float, d decimal(20,6), e date, f boolean")
    layout = schemas.target_schema(source, ["A", "b", "c", "d", "e", "f", "gone"], include_metadata=False)
    assert [f.dataType.simpleString() for f in layout.fields] == [
        "bigint", "int", "double", "decimal(20,6)", "string", "string", "string", "string",
    ]


def test_rebuild_keeps_types_and_comments(spark):
    layout = T.StructType([T.StructField("a", T.StringType(), True, {"comment": "the a"}), T.StructField("v", T.DoubleType())])
    sinks.rebuild_table(spark.range(2).select(F.lit("x").alias("a"), F.lit(None).alias("v")), "rebuilt", layout, "it's new")
    described = {r.col_name: r for r in spark.sql("DESCRIBE EXTENDED rebuilt").collect()}
    assert described["a"].comment == "the a" and described["v"].data_type == "double"
    assert described["Comment"].data_type == "it's new"
    spark.sql("DROP TABLE rebuilt")


def test_ensure_table_leaves_an_existing_one(spark):
    path = work_path(spark, "ensured")
    layout = schemas.file_target_schema()
    assert not table_exists(spark, path)
    sinks.ensure_table(spark, path, layout)
    sinks.append_results(sinks.add_missing_columns(spark.createDataFrame([("p",)], "file_path string"), layout), path)
    sinks.ensure_table(spark, path, layout)
    assert read_table(spark, path, layout).count() == 1


def test_names_are_qualified():
    assert [qualify(t, "s") for t in ("t", "o.t", "/data/t", "")] == ["s.t", "o.t", "/data/t", ""]


@pytest.mark.parametrize("slices", [None, 7])
def test_sequence_of_a_hot_group(spark, slices):
    """One group holds most rows; another has a NULL key; the number of slices doesn't matter."""
    rows = spark.range(900).select(
        F.when(F.col("id") % 3 > 0, "hot").when(F.col("id") % 2 == 0, F.lit(None)).otherwise("cold").alias("g"),
        (F.col("id") * 7919 % 900).alias("o"),
    )
    got = grouping.sequence_in_group(rows.withColumn("wide", F.lit("x")), ["g"], ["o"], slices=slices).collect()
    seen = {}
    for row in sorted(got, key=lambda r: (str(r.g), r.o)):
        seen[row.g] = seen.get(row.g, 0) + 1
        assert row.seq == seen[row.g]
    assert len(got) == 900 and set(seen) == {"hot", "cold", None}


def test_keep_first_limits_before_the_shuffle(spark):
    rows = materialise(spark.range(1000).select((F.col("id") % 2).alias("k"), F.col("id").alias("o")), "copies")
    first = grouping.keep_first(rows, ["k"], ["o"])
    assert sorted(tuple(r) for r in first.collect()) == [(0, 0), (1, 1)]
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Partial") > plan.index("Exchange") > plan.index("Final")


def test_ledger(spark):
    path = work_path(spark, "ledger")
    layout = "batch_id string, status string, updated_at timestamp, total_requests int, completed_requests int, failed_requests int"
    for status, at, done in (("submitted", "2024-01-01", 0), ("completed", "2024-01-02", 8)):
        state = spark.createDataFrame([("b1", status, at, 10, done, 2)], layout.replace("timestamp", "string"))
        ledger.record_job(state.withColumn("updated_at", F.col("updated_at").cast("timestamp")), path)
    jobs = spark.read.parquet(path)
    status = ledger.job_status(jobs).first()
    assert (status.status, status.progress_pct, status.ended) == ("completed", 100.0, True)
    assert ledger.find_job(jobs, "unknown").count() == 0


def test_sheet_rules(spark):
    rows = [(0, [" k ", None, "v"]), (1, ["1"]), (2, [None, " ", ""]), (3, ["3", "b", "　c", "cut"]), (4, ["", "", "", "only beyond"])]
    sheet = tables.normalise_sheet(spark.createDataFrame(rows, "row_no int, cells array<string>"))
    assert sheet.columns == ["k", "col_1", "v"]
    assert sorted(tuple(r) for r in sheet.collect()) == [("", "", ""), ("1", "", ""), ("3", "b", "c")]
    header_only = spark.createDataFrame(rows[:1], "row_no int, cells array<string>")
    assert tables.normalise_sheet(header_only) is None
    assert tables.import_sheets({"S": header_only}, {"S": "s"}) == {}


def test_listing(spark, tmp_path):
    for name in ("a/x.jpg", "a/b/y.PNG", "c/z.txt"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"12345")
    listed = {r.relative_path: r.size for r in files.list_files(spark, str(tmp_path)).collect()}
    assert listed == {"a/x.jpg": 5, "a/b/y.PNG": 5, "c/z.txt": 5}
    some = files.list_files(spark, str(tmp_path), prefixes=["a/b", "c"])
    assert sorted(r.relative_path for r in some.collect()) == ["a/b/y.PNG", "c/z.txt"]


def test_volume_locations():
    roots = {"external": "/e/", "user": "/u", "table": "/t"}
    got = [files.volume_location(k, n, roots) for k, n in (("external", "v"), ("user", ""), ("table", "x"))]
    assert got == ["/e/v", "/u", "/t/x"]
    with pytest.raises(ValueError):
        files.volume_location("table", "", roots)


def test_large_cap_is_exact(spark):
    rows = spark.range(500).select((F.col("id") * 7 % 50).alias("k"), F.col("id").alias("v"))
    expected = sorted(r.k for r in rows.collect())[:123]
    got = grouping.take_first(rows, ["k"], 123)
    assert sorted(r.k for r in got.collect()) == expected and got.columns == ["k", "v"]
    assert grouping.take_first(rows, ["k", "v"], 9999).count() == 500


def test_batch_ids_that_look_like_dates(spark):
    path = work_path(spark, "dated")
    rows = spark.range(5).select("id", F.lit("2024-05-01").alias("batch_id"))
    sinks.idempotent_append(rows, path)
    sinks.idempotent_append(rows, path)
    sinks.idempotent_append(rows.withColumn("batch_id", F.lit("007")), path)
    counts = read_table(spark, path).groupBy("batch_id").count().collect()
    assert {r.batch_id: r["count"] for r in counts} == {"2024-05-01": 5, "007": 5}


@pytest.mark.parametrize("target", ["flat_target", None])
def test_target_of_another_layout_keeps_its_rows(spark, target):
    target = target or work_path(spark, "flat")
    held = spark.range(4).select(F.col("id").cast("int"), F.lit("old").alias("batch_id"), F.lit(1.5).alias("own"))
    sinks.append_results(held, target)
    rows = spark.range(3).select(F.col("id").cast("string"), F.lit("new").alias("batch_id"), F.lit(1).alias("extra"))
    sinks.idempotent_append(rows, target)
    sinks.idempotent_append(rows, target)
    after = read_table(spark, target)
    assert after.columns == ["id", "batch_id", "own"] and after.schema["id"].dataType == T.IntegerType()
    assert after.count() == 7 and after.where("own IS NULL").count() == 3
    if "/" not in target:
        spark.sql(f"DROP TABLE {target}")


def test_bucketed_master_is_not_shuffled(spark):
    """A channel summary over a bucketed master shuffles the sales rows only."""
    layout = T.StructType.fromDDL("platform string, source_key string, v bigint")
    rows = spark.range(50).select(F.lit("p").alias("platform"), F.col("id").cast("string").alias("source_key"), F.col("id").alias("v"))
    sinks.rebuild_table(rows, "bucketed", layout, bucket_by=["platform", "source_key"], buckets=4)
    path = work_path(spark, "sales")
    rows.drop("v").write.parquet(path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.read.parquet(path).join(spark.table("bucketed"), ["platform", "source_key"])
        assert joined._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
        assert joined.count() == 50
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.sql("DROP TABLE bucketed")


def test_work_folder_is_the_sessions(spark):
    assert work_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def _calls(spark, rows):
    """``rows`` behind a Python function that counts how often it is called."""
    calls = spark.sparkContext.accumulator(0)

    def touched(batches):
        for batch in batches:
            calls.add(batch.num_rows)
            yield batch

    return rows.mapInArrow(touched, rows.schema), calls


@pytest.mark.parametrize("n", [1, 7, 250, 999, 1000, 1500, 2400, 5000])
def test_cap_reads_its_input_once_and_is_exact(spark, n):
    """Ties that fill whole ranges, NULLs, and two order columns; caps below and above the per-partition limit."""
    k = F.when(F.col("id") % 3 == 0, 5).when(F.col("id") % 17 == 0, None).otherwise(F.col("id") * 7 % 40)
    rows = spark.range(0, 2400, 1, 6).select(k.alias("k"), (F.col("id") % 2).cast("string").alias("s"), F.col("id").alias("v"))
    order = lambda r: tuple((x is not None, x if x is not None else 0) for x in (r.k, r.s))
    expected = sorted(map(order, rows.collect()))[:n]
    watched, calls = _calls(spark, rows)
    got = grouping.take_first(watched, ["k", "s"], n)
    found = got.collect()
    assert sorted(map(order, found)) == expected and len({r.v for r in found}) == len(found)
    assert calls.value == 2400 and got.columns == ["k", "s", "v"]


def test_small_cap_is_cut_before_rows_move(spark):
    plan = grouping._first_of_each_partition(spark.range(100).select("id"), ["id"], 10)
    assert "WindowGroupLimit" in plan._jdf.queryExecution().executedPlan().toString()


def test_sequence_keeps_ties_apart(spark):
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 1, "y"), ("a", 1, "y"), (None, 2, "z"), ("a", 0, "w"), (None, None, "q")], "g string, o int, v string")
    watched, calls = _calls(spark, rows)
    got = grouping.sequence_in_group(watched, ["g"], ["o"], slices=3).collect()
    assert sorted((r.g or "", r.seq) for r in got) == [("", 1), ("", 2), ("a", 1), ("a", 2), ("a", 3), ("a", 4)]
    assert {(r.g, r.v): r.seq for r in got if r.v in "wqz"} == {("a", "w"): 1, (None, "q"): 1, (None, "z"): 2}
    assert calls.value == 6


def test_one_hot_group_spreads_over_slices(spark):
    rows = spark.range(0, 3000, 1, 4).select(F.lit("hot").alias("g"), F.lit(1).alias("o"), F.col("id").alias("v"))
    got = grouping.sequence_in_group(rows, ["g"], ["o"], slices=4).collect()
    assert sorted(r.seq for r in got) == list(range(1, 3001)) and len({r.v for r in got}) == 3000
