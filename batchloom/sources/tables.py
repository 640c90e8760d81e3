"""Table scans, sheet extracts and source profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from batchloom.functions.text import as_text, has_value, strip
from batchloom.operators.grouping import take_first
from batchloom.storage import inline_rows


def read_source(
    df: DataFrame,
    keys: Sequence[str],
    text_col: str,
    where: str | None = None,
    limit: int = 0,
) -> DataFrame:
    """Keys and text of a source as strings, NULL as ''; ``where`` is a SQL predicate.

    A row cap takes the first rows in key order, so that reruns take the same ones.
    """
    rows = df.where(F.expr(where)) if where else df
    if limit > 0:
        rows = take_first(rows, keys, limit)
    return rows.select(*[as_text(F.col(c)).alias(c) for c in (*keys, text_col)])


def sheet_header(cells: Sequence[str | None]) -> list[str]:
    """Column names of a sheet's first row; blank cells are named by their position.

    A name that was met before, in whatever case, gets the first free number behind it.
    """
    names, taken = [], set()
    for i, cell in enumerate(cells):
        name = first = (cell or "").strip() or f"col_{i}"
        number = 2
        while name.lower() in taken:
            name, number = f"{first}_{number}", number + 1
        taken.add(name.lower())
        names.append(name)
    return names


def normalise_sheet(rows: DataFrame, cells_col: str = "cells", row_col: str = "row_no") -> DataFrame | None:
    """An untyped sheet extract (row number, array of cells) as an all-string table.

    The lowest row number is the header. Cells are trimmed, NULL becomes '', rows without any
    text go, short rows are padded and long ones cut. None when there is no data row to keep.
    """
    first = rows.orderBy(row_col).limit(2).select(row_col, cells_col).collect()
    if len(first) < 2:
        return None
    header = sheet_header(first[0][cells_col])
    cells = F.transform(F.col(cells_col), lambda c: strip(as_text(c)))
    body = rows.where(F.col(row_col) != first[0][row_col]).withColumn(cells_col, cells)
    body = body.where(F.concat_ws("", F.col(cells_col)) != "")
    return body.select(
        *[F.coalesce(F.get(F.col(cells_col), F.lit(i)), F.lit("")).alias(h) for i, h in enumerate(header)]
    )


def import_sheets(sheets: dict[str, DataFrame], tables: dict[str, str]) -> dict[str, DataFrame]:
    """Normalise each sheet that the sheet-to-table map names; others and empty ones are left out."""
    loaded = {tables[name]: normalise_sheet(rows) for name, rows in sheets.items() if name in tables}
    return {name: table for name, table in loaded.items() if table is not None and not table.isEmpty()}


def inline_values(spark, column: str, values: Sequence[str]) -> DataFrame:
    """A caller's own short list of strings as a one-column relation."""
    return inline_rows(spark, [(v,) for v in values], T.StructType([T.StructField(column, T.StringType())]))


def table_profile(df: DataFrame, order_by: Sequence[str], n: int = 5) -> DataFrame:
    """Schema, row count and the first ``n`` rows as (section, position, name, value).

    Sample rows are JSON objects of strings in which NULL reads "NULL".
    """
    spark = df.sparkSession
    columns = inline_rows(
        spark,
        [("column", i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)],
        "section string, position int, name string, value string",
    )
    count = df.agg(F.count("*").cast("string").alias("value")).select(
        F.lit("row_count").alias("section"), F.lit(0).alias("position"), F.lit("").alias("name"), "value"
    )
    shown = F.to_json(
        F.struct(*[F.coalesce(F.col(c).cast("string"), F.lit("NULL")).alias(c) for c in df.columns])
    )
    # The window below has no partitions, but numbers these n rows only.
    top = df.orderBy(*order_by).limit(n)
    sample = top.select(
        F.lit("sample").alias("section"),
        F.row_number().over(Window.orderBy(*order_by)).alias("position"),
        F.lit("").alias("name"),
        shown.alias("value"),
    )
    return columns.unionByName(count).unionByName(sample)


def distinct_formats(df: DataFrame, columns: Sequence[str], n: int = 8) -> DataFrame:
    """The first ``n`` distinct non-empty values of each column, in one scan.

    Values are made distinct before they are ranked, so the ranking sees each form once and every
    task keeps at most ``n`` of them per column.
    """
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value")) for c in columns])
    )
    distinct = (
        df.select(pairs.alias("p"))
        .select("p.column_name", "p.value")
        .where(F.col("value").isNotNull() & (F.col("value") != ""))
        .distinct()
    )
    order = Window.partitionBy("column_name").orderBy("value")
    return distinct.withColumn("position", F.row_number().over(order)).where(F.col("position") <= n)


def value_histogram(df: DataFrame, column: str, n: int = 15) -> DataFrame:
    """The ``n`` most frequent non-empty values of a column."""
    counts = df.where(F.col(column).isNotNull() & (F.col(column) != "")).groupBy(column).agg(
        F.count("*").alias("cnt")
    )
    return counts.orderBy(F.desc("cnt"), column).limit(n)


def empty_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows without a value per column, in one scan; columns without any are left out."""
    totals = df.agg(*[F.count_if(~has_value(F.col(c))).alias(c) for c in columns])
    return _unpivot(totals, columns, "column_name", "empty_rows").where(F.col("empty_rows") > 0)


def _unpivot(df: DataFrame, columns: Sequence[str], name: str, value: str) -> DataFrame:
    return df.unpivot([], list(columns), name, value)
