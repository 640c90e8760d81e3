"""Listing of deep or very large folder trees by tasks instead of the driver."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from batchloom.sources.files import filter_extensions, from_inventory
from batchloom.storage import inline_rows, materialise_counted

# Entries of one folder as (is_folder, name, size).
Lister = Callable[[str], Iterable[tuple[bool, str, int]]]

BATCH_ROWS = 10_000


def list_folder(folder: str) -> Iterator[tuple[bool, str, int]]:
    """The entries of a folder that tasks can reach: by path, or by a URI that Arrow knows (file, hdfs, s3, gs)."""
    local = folder.removeprefix("file://").removeprefix("file:")
    if local.startswith("/"):
        with os.scandir(local) as entries:
            for entry in entries:
                is_folder = entry.is_dir()
                yield is_folder, entry.name, 0 if is_folder else entry.stat().st_size
        return
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(folder.replace("s3a://", "s3://", 1))
    for found in store.get_file_info(fs.FileSelector(path)):
        yield found.type == fs.FileType.Directory, found.base_name, found.size or 0


def is_hidden(name: str) -> bool:
    """Names that Spark's own listing passes over as well."""
    return name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")


def list_tree(
    spark: SparkSession,
    root: str,
    prefix: str = "",
    extensions: Sequence[str] = (),
    lister: Lister = list_folder,
    tasks: int | None = None,
) -> DataFrame:
    """Files below ``root`` as (relative_path, size), level by level, each level dealt over ``tasks``.

    Every level's entries are written, its folders are the next level, and they are dealt out anew, so a folder
    with very many subfolders is spread like many folders with few. The driver sees how many folders a level has and
    no name of any. One folder is read by one task, which passes its entries on in batches. Folders in which no path
    can start with ``prefix`` are not entered. ``lister`` reads one folder; give your own for other stores. A root that
    isn't there is an error, a folder that vanishes while others are read has no entries.
    """
    base = root.rstrip("/")
    parts = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def entered(path: str) -> bool:
        return path.startswith(prefix) or prefix.startswith(path + "/")

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[bool, str, int]] = []

        def batch() -> pa.RecordBatch:
            columns = zip(*rows) if rows else ((), (), ())
            types = (pa.bool_(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["is_folder", "path", "size"])

        for given in batches:
            for folder in given.column("folder").to_pylist():
                try:
                    for is_folder, name, size in lister(f"{base}/{folder}" if folder else base):
                        path = f"{folder}/{name}" if folder else name
                        if not is_hidden(name) and (entered(path) if is_folder else path.startswith(prefix)):
                            rows.append((is_folder, path, size))
                        if len(rows) >= BATCH_ROWS:
                            yield batch()
                            rows.clear()
                except FileNotFoundError:
                    if not folder:
                        raise
        yield batch()

    level, found = inline_rows(spark, [("",)], "folder string"), []
    while True:
        dealt = level.repartition(parts) if found else level
        entries = dealt.mapInArrow(listed, "is_folder boolean, path string, size long")
        entries, counts = materialise_counted(entries, "listing", folders=F.count_if("is_folder"))
        found.append(entries.where("NOT is_folder").select(F.col("path").alias("relative_path"), "size"))
        if not counts["folders"]:
            break
        level = entries.where("is_folder").select(F.col("path").alias("folder"))
    return filter_extensions(from_inventory(reduce(DataFrame.unionByName, found)), extensions)
