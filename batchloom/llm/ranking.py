"""Running totals in a global order, without bringing the rows of a group or of the table together."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from batchloom.llm.common import task_partitions
from batchloom.storage import materialise

SLICE_ROWS = 500_000


def running(df: DataFrame, order: Sequence[str], value: Column, out: str, group: Sequence[str] = ()) -> DataFrame:
    """``df`` with ``out``: the sum of ``value`` over the earlier rows of the same ``group`` in ``order``.

    Rows are range-partitioned on group and order into slices that are written out with their number; sums run
    within a slice and group, and start at the group's total over the slices before. A hot group spans many
    slices. Only slice totals, one row for each slice and group in it, are put in order. Rows equal in group and
    order may come in any order; make ``order`` unique for a stable result.
    """
    rows = df.count()
    parts = max(task_partitions(df), -(-rows // SLICE_ROWS))
    cut = df.repartitionByRange(parts, *group, *order).withColumn("__slice", F.spark_partition_id())
    cut = materialise(cut.withColumn("__value", value.cast("long")), "slices")
    keys = [*group, "__slice"]
    totals = cut.groupBy(*keys).agg(F.sum("__value").alias("__total"))
    before = Window.partitionBy(*group).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("__start", F.coalesce(F.sum("__total").over(before), F.lit(0)))
    totals = totals.select(*(F.col(k).alias(f"__of_{k}") for k in keys), "__start")
    match = [F.col(k).eqNullSafe(F.col(f"__of_{k}")) for k in keys]
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summed = cut.withColumn("__before", F.coalesce(F.sum("__value").over(inside), F.lit(0)))
    joined = summed.join(totals, match, "left")
    return joined.withColumn(out, F.col("__start") + F.col("__before")).drop(
        "__slice", "__value", "__before", "__start", *(f"__of_{k}" for k in keys)
    )
