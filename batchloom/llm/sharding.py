"""Shards that all have the mixture of the sources, by proportional stratified interleaving.

Rows are shuffled by a seeded digest and ranked within their source; the rank, moved by a phase of the source, as
a fraction of the source's size is the row's place in the corpus. Rows sorted by that place are cut into shards
of equal row counts, so every run of rows, hence every shard, has each source in proportion.

Law ``rows``: counts of two shards differ by one at most. A null source is a source of its own; a null or empty
text has size 1. Equal texts are no group here: like all rows they are spread. Rows that agree in id, source
and text are interchangeable. An empty table gives no rows. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchloom.llm.ranking import running
from batchloom.storage import materialise

SHARDS = 8
SEED = "42"


def interleaved(
    docs: DataFrame, shards: int = SHARDS, seed: str = SEED, id_col: str = "doc_id", source: str = "source"
) -> DataFrame:
    """Rows (id_col, source, size, text_crc32, shard, slot): every row of ``docs`` in one of ``shards`` shards."""
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.col(source).cast("string").alias("source"),
        (F.octet_length("text") + 1).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
        F.md5(F.concat_ws(":", F.lit(seed), F.col(id_col).cast("string")).cast("binary")).alias("shuffle"),
    ).withColumn("size", F.coalesce("size", F.lit(1).cast("long")))
    ranked = running(rows, ["shuffle", "id", "text_crc32", "size"], F.lit(1), "rank", group=["source"])
    ranked = materialise(ranked, "ranked")
    sizes = ranked.groupBy("source").count().select(F.col("source").alias("of"), "count")
    phase = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.coalesce("source", F.lit(""))).cast("binary")), 1, 8), 16, 10)
    placed = ranked.join(sizes, F.col("source").eqNullSafe(F.col("of"))).select(
        "id",
        "source",
        "size",
        "text_crc32",
        "shuffle",
        ((F.col("rank") + phase.cast("double") / float(1 << 32)) / F.col("count")).alias("place"),
    )
    placed = materialise(running(placed, ["place", "shuffle", "id", "text_crc32", "size"], F.lit(1), "at"), "placed")
    n = placed.count()
    shard = F.expr(f"at * {shards} div {max(n, 1)}")
    first = F.expr(f"(at * {shards} div {max(n, 1)} * {n} + {shards - 1}) div {shards}")
    return placed.select(
        F.col("id").alias(id_col),
        "source",
        "size",
        "text_crc32",
        shard.cast("int").alias("shard"),
        (F.col("at") - first).cast("long").alias("slot"),
    )
