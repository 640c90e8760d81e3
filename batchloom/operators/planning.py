"""What a run would process: sizes, cost, and hints for keys and text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from batchloom.sources.files import type_histogram
from batchloom.storage import inline_rows

# The estimate's constants.
TOKENS_PER_ROW = 200
TOKENS_PER_FILE = 300
PRICE_PER_MILLION = 2.0
BATCH_DISCOUNT = 0.5


def cost_estimate(df: DataFrame, tokens_each: int = TOKENS_PER_ROW) -> DataFrame:
    """Rows, estimated tokens and batch price as one row."""
    rows = F.count("*")
    tokens = rows * tokens_each
    price = tokens / F.lit(1_000_000) * F.lit(PRICE_PER_MILLION) * F.lit(BATCH_DISCOUNT)
    return df.agg(rows.alias("items"), tokens.alias("estimated_tokens"), price.alias("estimated_cost"))


def plan_files(files: DataFrame, sample: int = 10, path_col: str = "relative_path") -> DataFrame:
    """What a file run would process, as (section, name, value).

    Files per extension, their number, estimated tokens and batch price, and the first paths with
    their sizes. The listing is aggregated once per extension; totals come from those few rows.
    """
    per_type = type_histogram(files, path_col)
    every = F.sum("files")
    tokens = every * TOKENS_PER_FILE
    price = tokens / F.lit(1_000_000) * F.lit(PRICE_PER_MILLION) * F.lit(BATCH_DISCOUNT)
    totals = per_type.agg(
        every.cast("double").alias("file_count"),
        tokens.cast("double").alias("estimated_tokens"),
        price.alias("estimated_cost"),
    )
    total_rows = totals.unpivot([], totals.columns, "name", "value").select(F.lit("total").alias("section"), "name", "value")
    type_rows = per_type.select(
        F.lit("extension").alias("section"), F.col("extension").alias("name"), F.col("files").cast("double").alias("value")
    )
    first = files.orderBy(path_col).limit(sample)
    sample_rows = first.select(
        F.lit("sample").alias("section"), F.col(path_col).alias("name"), F.col("size").cast("double").alias("value")
    )
    return total_rows.unionByName(type_rows).unionByName(sample_rows)


def plan_profile(df: DataFrame) -> DataFrame:
    """Per column: type, rows, mean text length, and whether it could be the key or the text.

    One job measures all columns, exactly: every cell becomes a 64-bit digest with its column's number, equal cells
    are counted together, on the map side first, and a second digest tells repeats of a value from different values
    that share a digest. Only a column whose repeats are all of the latter kind, as chance allows from some billions
    of rows, is counted again on both digests. No text crosses the shuffle. Maps and variants can't be keys.
    """
    fields = df.schema.fields
    measured = {i: f for i, f in enumerate(fields) if f.dataType.typeName() not in ("map", "variant")}
    # A cell of no column counts the rows.
    cells = [_cell(-1, F.lit(0), None)] + [_cell(i, _column(f), f) for i, f in measured.items()]
    each = df.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*").where(F.col("digest").isNotNull())
    values = each.groupBy("column", "digest").agg(
        F.count("*").alias("cells"),
        F.sum("chars").alias("chars"),
        F.min("second").alias("least"),
        F.max("second").alias("most"),
    )
    again = F.col("cells") > 1
    found = {
        r.column: r
        for r in values.groupBy("column")
        .agg(
            F.sum("cells").alias("filled"),
            F.sum("chars").alias("chars"),
            F.count_if(again & (F.col("least") == F.col("most"))).alias("repeats"),
            F.count_if(again & (F.col("least") != F.col("most"))).alias("shared"),
        )
        .collect()
    }
    rows = found[-1].filled if -1 in found else 0
    chars = {f.name: _mean_chars(found.get(i)) for i, f in measured.items() if f.dataType.typeName() == "string"}
    longest = max(chars, key=lambda c: chars[c], default=None)

    def unique(i: int) -> bool:
        if i not in measured or (i not in found and rows):
            return False
        if not rows:
            return True
        at = found[i]
        whole = at.filled == rows and not at.repeats
        return whole and (not at.shared or _is_unique(df, _column(fields[i]), rows))

    described = [
        (f.name, f.dataType.simpleString(), rows, chars.get(f.name), unique(i), f.name == longest) for i, f in enumerate(fields)
    ]
    return inline_rows(
        df.sparkSession,
        described,
        "column_name string, data_type string, row_count bigint, mean_chars double, "
        "key_candidate boolean, text_candidate boolean",
    )


def _column(field: T.StructField) -> Column:
    return F.col("`" + field.name.replace("`", "``") + "`")


def _digests(value: Column) -> tuple[Column, Column]:
    return F.xxhash64(value), F.xxhash64(F.lit(1), value)


def _cell(number: int, value: Column, field: T.StructField | None) -> Column:
    digest, second = _digests(value)
    chars = F.length(value) if field and field.dataType.typeName() == "string" else F.lit(None)
    return F.struct(
        F.lit(number).alias("column"),
        F.when(value.isNotNull(), digest).alias("digest"),
        second.alias("second"),
        chars.cast("long").alias("chars"),
    )


def _mean_chars(found: Row | None) -> float:
    return found.chars / found.filled if found and found.chars is not None else 0.0


def _is_unique(df: DataFrame, value: Column, rows: int) -> bool:
    """Uniqueness by both digests of a value, 16 bytes."""
    return df.where(value.isNotNull()).agg(F.count_distinct(*_digests(value))).first()[0] == rows


#: Counts of a run: what its stats show, and the reasons for which selected rows were not sent or gave no result.
STATS = ("source_rows", "success_count", "error_count", "written_rows")
OUTCOMES = (
    "null_key", "blank_text", "duplicate", "no_url", "unsupported", "oversized", "capped", "sent", "quarantined", "failed", "written"
)


def run_stats(spark: SparkSession, source: str, counts: Mapping[str, int], labels: Mapping[str, str]) -> DataFrame:
    """Counts of one source's run as one row; ``labels`` are provider, model and the like.

    A run that selected nothing has the status skipped.
    """
    status = "completed" if counts["source_rows"] else "skipped"
    row = (source, *(counts[name] for name in STATS), *labels.values(), status)
    fields = [*(f"{name} long" for name in STATS), *(f"{name} string" for name in labels)]
    return inline_rows(spark, [row], ", ".join(["source string", *fields, "batch_status string"]))


def failed_stats(spark: SparkSession, source: str, error: str) -> DataFrame:
    """The row of a source whose run failed: no counts, status failed, and the error's text."""
    fields = ", ".join(["source string", *(f"{name} long" for name in STATS), "batch_status string", "error string"])
    return inline_rows(spark, [(source, *[None] * len(STATS), "failed", error)], fields)


def run_outcomes(spark: SparkSession, source: str, counts: Mapping[str, int]) -> DataFrame:
    """What became of a run's selected rows, as (source, outcome, rows); outcomes that its mode can't have are left out."""
    rows = [(source, name, counts[name]) for name in OUTCOMES if name in counts]
    return inline_rows(spark, rows, "source string, outcome string, rows long")


def total_stats(per_source: Sequence[DataFrame]) -> DataFrame:
    """Stats of several sources, and their sums as source 'total'."""
    every = per_source[0]
    for stats in per_source[1:]:
        every = every.unionByName(stats, allowMissingColumns=True)
    total = every.agg(*[F.sum(c).alias(c) for c in STATS]).withColumn("source", F.lit("total"))
    return every.unionByName(total, allowMissingColumns=True)
