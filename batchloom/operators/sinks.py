"""Targets: layout, evolution, alignment, idempotent appends."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from batchloom import schemas
from batchloom.storage import (
    has_partition,
    inline_rows,
    is_path,
    keep_layout,
    layout_of,
    layout_schema,
    materialise,
    partition_values,
    partitioned_by,
    read_table,
    table_exists,
)

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_REAL = (T.FloatType, T.DoubleType, T.DecimalType)


def ensure_table(spark: SparkSession, target: str, schema: T.StructType, partition_by: Sequence[str] = ()) -> None:
    """Create an empty target with this layout unless it exists."""
    if table_exists(spark, target):
        return
    if is_path(target):
        keep_layout(spark, target, schema, partition_by)
    else:
        _write(inline_rows(spark, [], schema), target, "ignore", partition_by)


def missing_columns(existing: T.StructType, wanted: T.StructType = schemas.METADATA) -> list[T.StructField]:
    held = {n.lower() for n in existing.names}
    return [f for f in wanted.fields if f.name.lower() not in held]


def add_missing_columns(df: DataFrame, wanted: T.StructType = schemas.METADATA) -> DataFrame:
    """Add the columns a table lacks, as NULLs of their type, after its own."""
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing_columns(df.schema, wanted)})


def evolve_table(spark: SparkSession, target: str, wanted: T.StructType = schemas.METADATA) -> list[str]:
    """Add missing columns to a target in place; no data is rewritten.

    A folder keeps its new layout beside the data, by which ``read_table`` reads it.
    """
    held = layout_schema(spark, target)
    missing = missing_columns(held, wanted)
    if missing and is_path(target):
        parts = [c for c in held.names if partitioned_by(spark, target, c)]
        keep_layout(spark, target, T.StructType([*held.fields, *missing]), parts)
    elif missing:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in missing)
        spark.sql(f"ALTER TABLE {target} ADD COLUMNS ({columns})")
    return [f.name for f in missing]


def align_to_schema(df: DataFrame, target: T.StructType, flag_failures: bool = False) -> DataFrame:
    """Keep the columns the target has, in its types, empty values filled.

    NULL text becomes ''; NULL or '' becomes 0 in a numeric column. Text that is no number becomes
    NULL; ``flag_failures`` adds ``cast_failed``, so that such rows can be set aside.
    """
    types = {f.name.lower(): f.dataType for f in target.fields}
    kept = [c for c in df.columns if c.lower() in types]
    columns = [_aligned(F.col(c), types[c.lower()]).alias(c) for c in kept]
    if not flag_failures:
        return df.select(*columns)
    failed = [_aligned(F.col(c), types[c.lower()]).isNull() for c in kept]
    return df.select(*columns, F.greatest(*failed, F.lit(False)).alias("cast_failed"))


def _aligned(col: Column, wanted: T.DataType) -> Column:
    if isinstance(wanted, (*_WHOLE, *_REAL)):
        empty = col.isNull() | (col.cast("string") == "")
        return F.when(empty, F.lit(0).cast(wanted)).otherwise(col.try_cast(wanted))
    if isinstance(wanted, T.StringType):
        return F.coalesce(col.cast("string"), F.lit(""))
    return col.try_cast(wanted)


def append_results(df: DataFrame, target: str, mode: str = "append", partition_by: Sequence[str] = ()) -> int:
    """Write results and return how many rows were written; ``mode`` is append or overwrite."""
    if mode not in ("append", "overwrite"):
        raise ValueError(f"unknown write mode: {mode}")
    counted, seen = _counted(df)
    _write(counted, target, mode, partition_by)
    return seen.get["rows"]


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df`` with a count of its rows, which the write takes on the way."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def _write(df: DataFrame, target: str, mode: str, partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if is_path(target):
        writer.parquet(target)
    else:
        writer.saveAsTable(target)


#: Up to so many incoming batch ids are looked up one by one; more are compared with the target's partition names.
LOOKUPS = 1_000


def new_batches(df: DataFrame, existing: DataFrame | None) -> DataFrame:
    """Rows of batches the target does not hold; a target without batch ids holds none.

    Rows without a batch id always pass: nothing says that they were seen before. Only the batches that ``df`` brings
    are looked for, so that files of other batches are skipped by their statistics.
    """
    if existing is None or "batch_id" not in [c.lower() for c in existing.columns]:
        return df
    wanted = existing.select("batch_id").where("batch_id <> ''")
    incoming = incoming_batches(df)
    if len(incoming) <= LOOKUPS:
        wanted = wanted.where(F.col("batch_id").isin([i for i in incoming if i]))
    known = materialise(wanted.distinct(), "known-batches")
    return df.join(known, "batch_id", "left_anti").select(*df.columns)


def incoming_batches(df: DataFrame) -> list[str | None]:
    """The batch ids of ``df``; if there are more than ``LOOKUPS``, one more than that."""
    return [r[0] for r in df.select("batch_id").distinct().limit(LOOKUPS + 1).collect()]


def idempotent_append(df: DataFrame, target: str, rebalance: bool = True, batches: Sequence[str] | None = None) -> int:
    """Append only batches the target does not hold yet, each batch whole or not at all; returns the rows written.

    A target made here is partitioned by batch, and keeps its layout beside its data. An append looks up the partitions
    of its own batches and no others, so its cost doesn't grow with the target's history. A retried write replaces a batch's
    partition instead of adding to it. ``batches`` names the batch ids of ``df``, all of them filled, where the caller
    knows them; otherwise they are read from it first. The rebalance spreads a very large batch over several files and
    joins small ones, where a plain repartition would make it one task; rows of a single batch do without. A target
    of another layout gets a plain append of its new batches; rows take its column types. A target without batch
    ids gets that column first.

    Rows with a NULL or empty batch id can't be told from earlier ones: they are appended each time
    and never replace anything.
    """
    spark = df.sparkSession
    if not table_exists(spark, target):
        if is_path(target):
            keep_layout(spark, target, _layout(df), ["batch_id"])
        counted, seen = _counted(_spread(df, rebalance))
        writer = counted.write.mode("append").partitionBy("batch_id")
        writer.parquet(target) if is_path(target) else writer.saveAsTable(target)
        return seen.get["rows"]
    if "batch_id" in df.columns:
        evolve_table(spark, target, T.StructType([T.StructField("batch_id", T.StringType())]))
    schema = layout_schema(spark, target)
    aligned = add_missing_columns(align_to_schema(df, schema), schema).select(*schema.names)
    if not partitioned_by(spark, target, "batch_id"):
        return _append(new_batches(aligned, read_table(spark, target)), target)
    incoming = list(batches) if batches is not None else incoming_batches(aligned)
    if len(incoming) <= LOOKUPS:
        held = [i for i in incoming if i and has_partition(spark, target, "batch_id", i)]
    else:
        held = partition_values(spark, target, "batch_id")
    blank = F.coalesce(F.col("batch_id"), F.lit("")) == ""
    written = 0
    if len(incoming) > LOOKUPS or any(i and i not in held for i in incoming):
        known = inline_rows(spark, [(v,) for v in held], "batch_id string")
        fresh = aligned.where(~blank).join(known, "batch_id", "left_anti").select(*schema.names)
        written = _replace_batches(fresh, target, rebalance)
    if len(incoming) > LOOKUPS or not all(incoming):
        written += _append(aligned.where(blank), target)
    return written


def _layout(df: DataFrame) -> T.StructType:
    """The columns as a reader will find them: partition columns come last, and everything may be NULL."""
    fields = sorted(df.schema.fields, key=lambda f: f.name == "batch_id")
    return T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in fields])


def _replace_batches(fresh: DataFrame, target: str, rebalance: bool) -> int:
    if not is_path(target):
        return _append(_spread(fresh, rebalance), target)
    counted, seen = _counted(_spread(fresh, rebalance))
    replacing = counted.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    replacing.partitionBy("batch_id").parquet(target)
    return seen.get["rows"]


def append_aligned(df: DataFrame, target: str) -> int:
    """Add rows to an existing target in its columns and types, missing ones NULL; returns how many. Nothing is compared."""
    schema = layout_schema(df.sparkSession, target)
    return _append(add_missing_columns(align_to_schema(df, schema), schema).select(*schema.names), target)


def _append(df: DataFrame, target: str) -> int:
    """Add rows to an existing target under its own layout; returns how many."""
    df, seen = _counted(df)
    if not is_path(target):
        df.write.mode("append").insertInto(target)
        return seen.get["rows"]
    kept = layout_of(df.sparkSession, target)
    parts = kept["partition_by"] if kept else []
    if not parts and partitioned_by(df.sparkSession, target, "batch_id"):
        parts = ["batch_id"]
    writer = df.write.mode("append")
    (writer.partitionBy(*parts) if parts else writer).parquet(target)
    return seen.get["rows"]


def _spread(df: DataFrame, rebalance: bool) -> DataFrame:
    return df.hint("rebalance", "batch_id") if rebalance else df


def existing_counts(target: DataFrame, batches: DataFrame) -> DataFrame:
    """Rows the target already holds per asked batch id, 0 where it holds none."""
    held = target.groupBy("batch_id").agg(F.count("*").alias("existing_rows"))
    asked = batches.select("batch_id").distinct().join(held, "batch_id", "left")
    return asked.withColumn("existing_rows", F.coalesce("existing_rows", F.lit(0)))


def archive_raw(lines: DataFrame, path: str) -> None:
    """Keep raw text per batch and kind (result, error); input is (batch_id, kind, line).

    A batch archived again replaces its own copy and no other.
    """
    rows = lines.select("batch_id", "kind", F.col("line").alias("value")).hint("rebalance", "batch_id", "kind")
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("batch_id", "kind").text(path)


def rebuild_table(
    df: DataFrame,
    target: str,
    schema: T.StructType,
    comment: str = "",
    bucket_by: Sequence[str] = (),
    buckets: int = 0,
) -> None:
    """Replace a table by ``df`` under an explicit schema with column comments.

    The schema's types apply, so an all-NULL column is written in its type and not as void. A
    catalog table may be bucketed: joins on those columns then read it without a shuffle, which pays
    for a product master that many channel tables are joined to.
    """
    typed = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name, metadata=f.metadata) for f in schema.fields])
    if is_path(target):
        typed.write.mode("overwrite").parquet(target)
        return
    writer = typed.write.mode("overwrite")
    if buckets:
        # One task per bucket, so that each bucket is one file.
        writer = typed.repartition(buckets, *bucket_by).write.mode("overwrite")
        writer = writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
    writer.saveAsTable(target)
    if comment:
        quoted = comment.replace("'", "''")
        df.sparkSession.sql(f"COMMENT ON TABLE {target} IS '{quoted}'")


def table_counts(tables: dict[str, DataFrame | None], spark: SparkSession) -> DataFrame:
    """Row count per named table; a table given as None is missing and has no count."""
    schema = "table_name string, rows bigint, missing boolean"
    result = inline_rows(spark, [(n, None, True) for n, df in tables.items() if df is None], schema)
    for name, df in tables.items():
        if df is not None:
            counted = df.agg(F.count("*").alias("rows"))
            result = result.unionByName(
                counted.select(F.lit(name).alias("table_name"), "rows", F.lit(False).alias("missing"))
            )
    return result


def sample_rows(df: DataFrame, where: str, order_by: Sequence[str], n: int, columns: Sequence[str]) -> DataFrame:
    """The first ``n`` rows that satisfy a predicate."""
    return df.where(F.expr(where)).orderBy(*order_by).limit(n).select(*columns)


def schema_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Columns of two tables side by side with their presence and types."""
    spark = left.sparkSession

    def columns(df: DataFrame, name: str) -> DataFrame:
        fields = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
        return inline_rows(spark, fields, f"column_name string, {name} string")

    both = columns(left, "left_type").join(columns(right, "right_type"), "column_name", "full_outer")
    status = (
        F.when(F.col("right_type").isNull(), "only_left")
        .when(F.col("left_type").isNull(), "only_right")
        .when(F.col("left_type") != F.col("right_type"), "type_differs")
        .otherwise("same")
    )
    return both.withColumn("status", status)
