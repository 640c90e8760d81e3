"""Benchmark decontamination with DataFrame operations only.

Test items are cut into windows of ``WINDOW`` words; an item with fewer words, but at least one, is a single
window of its own length. A document word inside an occurrence of a window is hit.

A window of L words is found by a shorter gram of about L/2 words: documents are sampled at every step-th
position, the step chosen so that each occurrence of a window covers a whole sampled gram. The hash set of
all window grams is broadcast, the sampled grams are looked up, and each hit is confirmed on the words of
the windows around it, so hash collisions never count.

Up to ``LITERAL_KEYS`` gram keys are part of the plan, and misses are dropped where they are hashed. Grams and
windows are broadcast only up to ``BROADCAST_ROWS`` rows; beyond that the same joins are left to Spark, which
shuffles both sides and splits skewed keys. Results do not depend on these bounds. Null and empty texts have no words: they are never
hit and hit nothing. Items with equal windows all count, a null item id counts as none. Equal rows get equal results.
Only the named input columns are read; ``without_contaminated`` passes all others through untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchloom.storage import materialise

WINDOW = 10
BROADCAST_ROWS = 1_000_000
#: Gram keys that may stand in the plan itself, so that misses are dropped where they are hashed.
LITERAL_KEYS = 100_000

#: Characters between words, once A-Z are in lower case, as a class and listed.
_BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_BREAK_CHARS = "".join(chr(c) for c in [*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Normalised words; a text without any gives one empty word (see ``count_words``)."""
    plain = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    return F.split(F.btrim(plain, F.lit(_BREAK_CHARS)), _BREAKS)


def count_words(listed: Column) -> Column:
    return F.when(listed[0] == "", 0).otherwise(F.size(listed))


def item_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Rows (item_id, length, window): the distinct windows of each item, as lists of words."""
    listed = items.select("item_id", words(F.col("text")).alias("w")).select("*", count_words(F.col("w")).alias("n"))
    cut = F.transform(
        F.sequence(F.lit(1), F.greatest(F.col("n") - window + 1, F.lit(1))), lambda i: F.slice("w", i, window)
    )
    return (
        listed.where("n > 0 AND item_id IS NOT NULL")
        .select("item_id", F.explode(cut).alias("window"))
        .distinct()
        .select("item_id", F.size("window").alias("length"), "window")
    )


def _gram(length: int) -> tuple[int, int]:
    """Gram length and sampling step by which every occurrence of a window holds a sampled gram."""
    gram = (length + 1) // 2
    return gram, length - gram + 1


def _key(length: int, listed: str, at: str) -> str:
    """SQL for the key of the gram of ``listed`` that starts at position ``at``."""
    gram, _ = _gram(length)
    return f"xxhash64({length}, {', '.join(f'get({listed}, {at} + {k - 1})' for k in range(gram))})"


def _grams(length: int) -> Column:
    """Keys of the grams of ``window`` that sampling can meet: one for each offset."""
    _, step = _gram(length)
    return F.expr(f"transform(sequence(1, {step}), o -> {_key(length, 'window', 'o')})")


def _sampled(length: int, known: list[int] | None) -> Column:
    """Sampled grams of the words ``w``: (length, at, first, gram key, surrounding words).

    With ``known``, only grams of those keys, before anything else of them is built.
    """
    gram, step = _gram(length)
    places = f"sequence(1, greatest(n - {gram - 1}, 1), {step})"
    if known is not None:
        listed = ", ".join(map(str, known)) or "NULL"
        places = f"filter({places}, p -> {_key(length, 'w', 'p')} IN ({listed}))"
    first = f"greatest(p - {step - 1}, 1)"
    return F.expr(
        f"CASE WHEN n >= {length} THEN transform({places}, p -> named_struct('length', {length}, 'at', p, "
        f"'first', {first}, 'key', {_key(length, 'w', 'p')}, 'around', slice(w, {first}, p + {length} - {first}))) END"
    )


def _small(table: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(table) if rows <= BROADCAST_ROWS else table


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", window: int = WINDOW) -> DataFrame:
    """One row per document: id_col, text_key, n_words, n_hit, item_ids (sorted as strings)."""
    windows = materialise(item_windows(items, window), "windows")
    lengths = sorted(r["length"] for r in windows.select("length").distinct().collect())  # ``window`` values at most
    grams = None
    for length in lengths:
        part = windows.where(F.col("length") == length).select(F.explode(_grams(length)).alias("key"))
        grams = part if grams is None else grams.union(part)
    listed = (
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(id_col).alias("id"),
            F.xxhash64("text").alias("text_key"),
            words(F.col("text")).alias("w"),
        )
        .withColumn("n", count_words(F.col("w")))
    )
    if grams is None:
        return listed.select(
            F.col("id").alias(id_col),
            "text_key",
            F.col("n").cast("long").alias("n_words"),
            F.lit(0).cast("long").alias("n_hit"),
            F.array().cast("array<string>").alias("item_ids"),
        )
    grams = materialise(grams.distinct(), "grams")
    n_grams = grams.count()
    known = sorted(r["key"] for r in grams.collect()) if n_grams <= LITERAL_KEYS else None
    by_window = materialise(
        windows.groupBy(F.array_join("window", " ").alias("text")).agg(
            F.collect_set(F.col("item_id").cast("string")).alias("items")
        ),
        "window-items",
    )

    none = "array<struct<length:int,at:int,first:int,key:bigint,around:array<string>>>"
    head = F.array(F.struct(*(F.lit(None).cast(t).alias(c) for c, t in (
        ("length", "int"), ("at", "int"), ("first", "int"), ("key", "bigint"), ("around", "array<string>")
    ))))
    entries = F.concat(head, *(F.coalesce(_sampled(n, known), F.array().cast(none)) for n in lengths))
    looked_up = listed.select("row", "id", "text_key", "n", F.explode(entries).alias("e")).select(
        "row", "id", "text_key", "n", "e.*"
    )
    found = looked_up.join(
        _small(grams.select("key", F.lit(True).alias("known")), grams.count()), "key", "left"
    ).where("known OR length IS NULL")
    last = F.least(F.col("at") - F.col("first"), F.size("around") - F.col("length"))
    near = F.when(
        last >= 0,
        F.transform(
            F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
            lambda k: F.struct(
                (F.col("first") + k).alias("start"),
                (F.col("first") + k + F.col("length")).alias("end"),
                F.array_join(F.slice("around", k + 1, F.col("length")), " ").alias("text"),
            ),
        ),
    )
    spans = found.select("row", "id", "text_key", "n", F.explode_outer(near).alias("s")).select(
        "row", "id", "text_key", "n", "s.*"
    )
    confirmed = spans.join(_small(by_window, by_window.count()), "text", "left")
    hit = F.when(F.col("items").isNotNull(), F.struct("start", "end"))
    per_row = confirmed.groupBy("row").agg(
        F.first("id").alias("id"),
        F.first("text_key").alias("text_key"),
        F.first("n").alias("n"),
        F.sort_array(F.collect_set(hit)).alias("spans"),
        F.collect_set("items").alias("items"),
    )
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).cast("long").alias("total"), F.lit(0).alias("upto")),
        lambda a, s: F.struct(
            (a["total"] + F.greatest(s["end"] - F.greatest(s["start"], a["upto"]), F.lit(0))).alias("total"),
            F.greatest(s["end"], a["upto"]).alias("upto"),
        ),
        lambda a: a["total"],
    )
    return per_row.select(
        F.col("id").alias(id_col),
        "text_key",
        F.col("n").cast("long").alias("n_words"),
        covered.alias("n_hit"),
        F.sort_array(F.array_distinct(F.flatten("items"))).alias("item_ids"),
    )


def without_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", window: int = WINDOW) -> DataFrame:
    """``docs`` without the documents that hold a window of a test item; all columns stay.

    Whether a document goes depends on its text alone, so texts are matched by their hash and length.
    """
    found = contamination(docs, items, id_col, window).where("n_hit > 0")
    gone = materialise(found.select(F.col("text_key").alias("__gone")).distinct(), "contaminated")
    return docs.join(gone, F.xxhash64(docs["text"]) == gone["__gone"], "left_anti")
