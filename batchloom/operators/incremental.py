"""Select what has not been processed yet."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from batchloom.operators.grouping import take_first
from batchloom.sources.files import filter_extensions, filter_prefix


def split_null_keys(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with a full key, and rows with a NULL in it, which could never be matched again."""
    complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return df.where(complete), df.where(~complete)


def unprocessed_rows(
    source: DataFrame,
    target: DataFrame | None,
    keys: Sequence[str],
    where: str | None = None,
    limit: int = 0,
) -> DataFrame:
    """Source rows whose key is not in the target; without a target, all of them.

    The predicate applies to the source before the join, so its names are the source's own and it
    reaches the scan. Target keys are made distinct before they are shuffled; only key columns of
    the target are read. A row cap takes the first rows in key order.
    """
    rows = source.where(F.expr(where)) if where else source
    if target is not None:
        rows = rows.join(target_keys(source, target, keys), list(keys), "left_anti")
    return take_first(rows, keys, limit) if limit > 0 else rows


def target_keys(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A target's distinct keys in the types of the source's."""
    return target.select(*[_as_source_type(source, target, k) for k in keys]).distinct()


def _as_source_type(source: DataFrame, target: DataFrame, key: str) -> Column:
    """A target key; text is read in the source's type where that is not text."""
    wanted = source.select(key).schema[0].dataType
    held = target.select(key).schema[0].dataType
    reread = isinstance(held, T.StringType) and not isinstance(wanted, T.StringType)
    return (F.col(key).try_cast(wanted) if reread else F.col(key)).alias(key)


def unprocessed_files(
    files: DataFrame,
    target: DataFrame | None,
    extensions: Sequence[str] = (),
    prefix: str = "",
    limit: int = 0,
) -> DataFrame:
    """Listed files that pass the filters and whose path is not in the target's file_path."""
    rows = filter_prefix(filter_extensions(files, extensions), prefix)
    if target is not None and "file_path" in target.columns:
        done = target.where(F.col("file_path") != "").select(F.col("file_path").alias("relative_path")).distinct()
        rows = rows.join(done, "relative_path", "left_anti")
    return take_first(rows, ["relative_path"], limit) if limit > 0 else rows
