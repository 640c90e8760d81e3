"""Tables on shared storage: work tables that cut lineage, and path-or-catalog targets."""

from __future__ import annotations

import json
import re
import tempfile
import uuid
from collections.abc import Sequence
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

_local_folders: dict[str, str] = {}
_LAYOUT = "_layout.json"


def work_folder(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local-mode session that names none gets a folder of its own; a cluster without the
    setting is refused, since executors could not read each other's machine-local files.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="batchloom-")
    return _local_folders[context.applicationId]


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the work folder."""
    return f"{work_folder(spark)}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet on shared storage and read it back.

    Cuts lineage like a checkpoint, but the copy is columnar: later scans prune columns, push
    filters, and know the table's size. It survives lost executors.
    """
    path = work_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialise_counted(df: DataFrame, label: str, **counts: Column) -> tuple[DataFrame, dict[str, int]]:
    """``materialise`` with aggregates of the rows, taken by the write itself; an aggregate of no rows is 0."""
    seen = Observation()
    stored = materialise(df.observe(seen, *[c.alias(name) for name, c in counts.items()]), label)
    return stored, {name: value or 0 for name, value in seen.get.items()}


def inline_rows(spark: SparkSession, rows: Sequence[tuple], schema: str | T.StructType) -> DataFrame:
    """A caller's few rows as a local relation, whose size Spark knows when it plans joins."""
    layout = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(layout)
    columns = [pa.array([r[i] for r in rows], type=f.type) for i, f in enumerate(arrow)]
    return spark.createDataFrame(pa.table(columns, schema=arrow), schema=layout)


def qualify(table: str, schema: str | None) -> str:
    """Prefix an unqualified table name with the default schema; paths stay as they are."""
    if not table or not schema or "." in table or is_path(table):
        return table
    return f"{schema}.{table}"


def is_path(target: str) -> bool:
    return "/" in target


def table_exists(spark: SparkSession, target: str) -> bool:
    """Whether a target is there: a folder counts once it has data or a layout of its own."""
    if not is_path(target):
        return spark.catalog.tableExists(target)
    return layout_of(spark, target) is not None or has_data(spark, target)


def _hadoop(spark: SparkSession, location: str):
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(location)
    return path.getFileSystem(context._jsc.hadoopConfiguration()), path


def path_exists(spark: SparkSession, location: str) -> bool:
    files, path = _hadoop(spark, location)
    return files.exists(path)


def has_data(spark: SparkSession, folder: str) -> bool:
    """Whether a folder holds a file that readers would see; stops at the first."""
    files, path = _hadoop(spark, folder)
    if not files.exists(path):
        return False
    found = files.listFiles(path, True)
    while found.hasNext():
        name = found.next().getPath().getName()
        if not name.startswith(("_", ".")):
            return True
    return False


def layout_of(spark: SparkSession, folder: str) -> dict | None:
    """The layout kept beside the data of a folder: its schema and the columns it is partitioned by."""
    files, path = _hadoop(spark, f"{folder.rstrip('/')}/{_LAYOUT}")
    if not files.exists(path):
        return None
    stream = files.open(path)
    try:
        kept = json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    return {"schema": T.StructType.fromJson(kept["schema"]), "partition_by": kept["partition_by"]}


def keep_layout(spark: SparkSession, folder: str, schema: T.StructType, partition_by: Sequence[str] = ()) -> None:
    """Keep a folder's layout: it has one before it has data, and may gain columns later."""
    files, path = _hadoop(spark, f"{folder.rstrip('/')}/{_LAYOUT}")
    text = json.dumps({"schema": schema.jsonValue(), "partition_by": list(partition_by)})
    stream = files.create(path, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def read_table(spark: SparkSession, target: str, schema: T.StructType | None = None) -> DataFrame:
    """A target as a DataFrame. Batch ids are text, also where partition names look like dates.

    A folder's kept layout decides its columns; files written before a column was added give NULLs.
    """
    if not is_path(target):
        return spark.table(target)
    if schema is None and (kept := layout_of(spark, target)):
        schema = kept["schema"]
        if not has_data(spark, target):
            return inline_rows(spark, [], schema)
    if schema is None:
        found = spark.read.parquet(target)
        typed = [T.StructField(f.name, T.StringType()) if f.name == "batch_id" else f for f in found.schema.fields]
        if T.StructType(typed) == found.schema:
            return found
        schema = T.StructType(typed)
    return spark.read.schema(schema).parquet(target)


def partitioned_by(spark: SparkSession, target: str, column: str) -> bool:
    """Whether an existing target is laid out in partitions of ``column``."""
    if not is_path(target):
        return any(c.name == column and c.isPartition for c in spark.catalog.listColumns(target))
    if (kept := layout_of(spark, target)) and kept["partition_by"]:
        return column in kept["partition_by"]
    return bool(_partition_folders(spark, target, column))


def has_partition(spark: SparkSession, target: str, column: str, value: str) -> bool:
    """Whether a partitioned target holds rows of one value; no other partition is looked at."""
    jvm = spark.sparkContext._jvm
    if is_path(target):
        escaped = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(value)
        return has_data(spark, f"{target.rstrip('/')}/{column}={escaped}")
    quoted = value.replace("\\", "\\\\").replace("'", "\\'")
    return bool(spark.sql(f"SHOW PARTITIONS {target} PARTITION ({column} = '{quoted}')").take(1))


def layout_schema(spark: SparkSession, target: str) -> T.StructType:
    """An existing target's columns: from its kept layout, which needs no listing of its files, where it has one."""
    if is_path(target) and (kept := layout_of(spark, target)):
        return kept["schema"]
    return read_table(spark, target).schema


def _partition_folders(spark: SparkSession, folder: str, column: str) -> list[str]:
    files, path = _hadoop(spark, f"{folder.rstrip('/')}/{column}=*")
    return [status.getPath().getName().partition("=")[2] for status in files.globStatus(path)]


def partition_values(spark: SparkSession, target: str, column: str) -> list[str]:
    """Values of a target's partition column from names alone; no data file is opened."""
    if is_path(target):
        names = _partition_folders(spark, target, column)
    else:
        rows = spark.sql(f"SHOW PARTITIONS {target}").collect()
        parts = (dict(p.split("=", 1) for p in r[0].split("/")) for r in rows)
        names = [p[column] for p in parts]
    return [unquote(n) for n in names if n != "__HIVE_DEFAULT_PARTITION__"]
