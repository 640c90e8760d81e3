"""Keep-first, numbering and capping that stay even when one group, or the cap, is very large."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from batchloom.storage import materialise


def keep_first(df: DataFrame, keys: Sequence[str | Column], order: Sequence[str | Column]) -> DataFrame:
    """One row per key, the first in ``order``.

    Spark limits each group to its first row before the shuffle as well as after it, so the copies
    of a frequent key do not meet in one task.
    """
    return keep_n(df, keys, order, 1)


def keep_n(df: DataFrame, keys: Sequence[str | Column], order: Sequence[str | Column], n: int) -> DataFrame:
    """At most ``n`` rows per key, the first in ``order``."""
    first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(first)).where(F.col("_rn") <= n).drop("_rn")


def _running_counts(df: DataFrame, group: Sequence[str], order: Sequence[str], out: str, slices: int | None) -> DataFrame:
    """Rows numbered from 1 in each group, by slices that are range-partitioned on group and order.

    The slices are written, numbered each on its own, and shifted by the rows of the same group in
    earlier slices, so a group of any size is spread over many tasks.
    """
    parts = slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, *group, *order).withColumn("_slice", F.spark_partition_id())
    # spark_partition_id() would be drawn again on a second read, hence the written copy.
    cut = materialise(ranged, "sequence-slices")
    earlier = Window.partitionBy(*group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        cut.groupBy(*group, "_slice")
        .agg(F.count("*").alias("_rows"))
        .withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
        .drop("_rows")
    )
    local = Window.partitionBy(*group, "_slice").orderBy(*order)
    numbered = cut.withColumn("_local", F.row_number().over(local))
    left, right = numbered.alias("n"), offsets.alias("o")
    same = [F.col(f"n.{c}").eqNullSafe(F.col(f"o.{c}")) for c in (*group, "_slice")]
    joined = left.join(right, reduce(lambda a, b: a & b, same))
    return joined.select(*[F.col(f"n.{c}").alias(c) for c in df.columns], (F.col("_local") + F.col("o._before")).alias(out))


def sequence_in_group(
    df: DataFrame, group: Sequence[str], order: Sequence[str], out: str = "seq", slices: int | None = None
) -> DataFrame:
    """Number the rows of each group from 1 in ``order``; a NULL group value is a group.

    One way for groups of every size. ``df`` is evaluated once and its rows are stored once; only their group and
    order columns are sliced and numbered, and the numbers come back to each row by its place in the store. Rows that
    are equal in group and order get numbers of their own, in any order. ``slices`` sets how many slices are cut.
    """
    rows = _placed(materialise(df, "sequence-rows"))
    narrow = rows.select(*dict.fromkeys([*group, *order]), *_PLACE)
    numbered = _running_counts(narrow, group, [*order, *_PLACE], out, slices)
    numbers = numbered.select(*_PLACE, F.col(out).cast("int").alias(out))
    # Places are unique, so the narrow side's hash tables are even, and the wide rows need no sort.
    return rows.join(numbers.hint("shuffle_hash"), _PLACE).select(*[rows[c] for c in df.columns], out)


#: A row's place in a stored table: no two rows share it, and reading again gives the same.
_PLACE = ["_file", "_index"]


def _placed(stored: DataFrame) -> DataFrame:
    place = {"_file": "_metadata.file_name", "_index": "_metadata.row_index"}
    return stored.select("*", *[F.col(c).alias(name) for name, c in place.items()])


def take_first(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows in ``order``, exactly; NULLs come first. Of rows that are equal in it any may be taken.

    ``df`` is evaluated once, and its rows are stored. A small cap is applied to each partition before that, so
    that at most ``n`` rows of it are. See ``first_of_stored``.
    """
    if n <= 0:
        return df.limit(0)
    return first_of_stored(materialise(_first_of_each_partition(df, order, n), "first-rows"), order, n)


def _first_of_each_partition(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """At most ``n`` rows of each partition, cut before they move; caps above Spark's limit for that leave all."""
    if n > int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")):
        return df
    return keep_n(df.withColumn("_part", F.spark_partition_id()), ["_part"], order, n).drop("_part")


def first_of_stored(stored: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """``take_first`` for a table read from files, or a filter of one.

    A histogram finds the cut: the order columns are range-partitioned, and each range gives its count and last
    value. Ranges before the cut are taken whole by comparison with a bound; only the range with the cut is
    sorted. A row's place in the files tells rows apart that are equal in ``order``, so that ranges stay even
    whatever repeats. The driver sees one count for each range.
    """
    if n <= 0:
        return stored.limit(0)
    rows = _placed(stored).withColumn("_at", F.struct(*order, *_PLACE))
    parts = int(stored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.select("_at").repartitionByRange(parts, "_at").withColumn("_range", F.spark_partition_id())
    ranges = materialise(ranged.groupBy("_range").agg(F.count("*").alias("_rows"), F.max("_at").alias("_last")), "ranges")
    before = 0
    lower = None
    for name, count in sorted(ranges.select("_range", "_rows").collect()):
        if before + count >= n:
            return _up_to_cut(rows, ranges, lower, name, n - before).select(*stored.columns)
        before, lower = before + count, name
    return stored


def _up_to_cut(rows: DataFrame, ranges: DataFrame, lower: int | None, cut: int, left: int) -> DataFrame:
    def last(name: int) -> Column:
        return ranges.where(F.col("_range") == name).select("_last").scalar()

    inside = rows.where(F.col("_at") <= last(cut))
    if lower is None:
        return inside.orderBy("_at").limit(left)
    cut_through = inside.where(F.col("_at") > last(lower)).orderBy("_at").limit(left)
    return rows.where(F.col("_at") <= last(lower)).unionByName(cut_through)
