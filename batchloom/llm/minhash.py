"""Near copies by the share of word shingles: Jaccard similarity of ``SHINGLE``-word sets at or above ``SIMILARITY``.

Candidates come from SimHash first: fingerprints of the same shingles that differ in at most ``simhash.BITS`` bits, found
along pigeonring chains. Of texts with one fingerprint, each is held against one of them, which stands for it in the chains.
At similarity 0.8 about a tenth of the 64 bits differ, give or take three, and a budget of 16 or more bits leaves no
selective blocking key. Candidates that differ in more bits come from MinHash:
``BANDS`` keys of ``ROWS`` minima each, so a pair at similarity s shares no key with probability
(1 - s ** ROWS) ** BANDS: 7 in a million at 0.8, and less above. Each candidate is then checked exactly on the two sets.

Only distinct sets are compared, so exact copies cost nothing. First every set is held against the centre of each of
its blocks, the set whose blocks hold most sets: of a group of near copies, one that few edits tell from the common
original, so that it ties most of what the group links at all. What is tied is one component, and then, as in
``simhash``, rows of a block's largest component are only met by rows of other components. Links inside one component are not listed. Pairs are only made when the parities of
the two sets in ``64 * WORDS`` buckets differ in no more places than similar sets can have elements of their own, which
loses no link. No cap is set anywhere.

A text of fewer words than a shingle has one shingle, all its words; null and blank texts share the empty set.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchloom.llm import simhash
from batchloom.llm.common import task_partitions, words_of
from batchloom.llm.components import components
from batchloom.storage import materialise

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 30, 5
WORDS = 8
CHUNK = 1_000

_DRAWN = np.random.default_rng(42).integers(0, 1 << 64, (2, BANDS * ROWS, 1), dtype=np.uint64)
_MIXED, _FACTORS = _DRAWN[0], _DRAWN[1] | np.uint64(1)


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles."""
    words = words_of(text)
    if not words:
        return np.empty(0, dtype=np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) > size:
        starts, ends = starts[: 1 - size], ends[size - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest, spans = xxhash.xxh64_intdigest, zip(starts.tolist(), ends.tolist())
    return np.unique(np.fromiter((digest(joined[a:b], 42) for a, b in spans), dtype=np.uint64, count=len(starts)))


def bands(hashes: np.ndarray) -> list[int]:
    """Signed blocking keys of a set: a hash of the minima of each band and its number."""
    least = np.full(BANDS * ROWS, ~np.uint64(0))
    for at in range(0, len(hashes), CHUNK):
        least = np.minimum(least, ((hashes[at : at + CHUNK] ^ _MIXED) * _FACTORS).min(axis=1))
    rows = least.reshape(BANDS, ROWS)
    return [xxhash.xxh64_intdigest(rows[i].tobytes(), seed=i) - (1 << 63) for i in range(BANDS)]


def parities(hashes: np.ndarray) -> list[int]:
    """For each of ``64 * WORDS`` buckets a bit: whether it has an odd number of the set's elements."""
    odd = np.bincount((hashes % np.uint64(64 * WORDS)).astype(np.int64), minlength=64 * WORDS) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8").tolist()


def _signatures(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for texts in parts:
        rows = []
        for text in texts:
            found = shingles(text)
            fp = xxhash.xxh64_intdigest(found.tobytes(), seed=42) - (1 << 63)
            rows.append((fp, len(found), bands(found), parities(found), simhash.fingerprint(text, SHINGLE)))
        yield pd.DataFrame(rows, columns=["fp", "n", "bands", "odd", "sim"])


def _sets(text: Column) -> Column:
    @F.pandas_udf("array<long>")
    def of(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: shingles(t).view(np.int64))

    return of(text)


def signatures(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (id, text_key, fp, n, bands, odd, sim) on shared storage: a hash of the set, its size, ..., the SimHash."""
    of = F.pandas_udf(_signatures, "fp long, n int, bands array<long>, odd array<long>, sim long")
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_key"), of(F.col(text)).alias("s"))
    return materialise(rows.select("id", "text_key", "s.*"), "signatures")


def _alike(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The ``pairs`` (a, b) of fingerprints whose ``sets`` (fp, shingles) are similar enough."""
    for side in "ab":
        pairs = pairs.join(sets.select(F.col("fp").alias(side), F.col("shingles").alias(f"of_{side}")).hint("merge"), side)
    common = F.size(F.array_intersect("of_a", "of_b"))
    return pairs.where(common / (F.size("of_a") + F.size("of_b") - common) >= SIMILARITY).drop("of_a", "of_b")


def _shingle_sets(docs: DataFrame, wanted: DataFrame, id_col: str, text: str) -> DataFrame:
    """(fp, shingles) for the sets of ``wanted`` (fp, id, text_key, ...), on shared storage."""
    needed = wanted.select("fp", F.col("id").alias("__id"), F.col("text_key").alias("__key"))
    match = docs[id_col].eqNullSafe(needed["__id"]) & (F.xxhash64(docs[text]) == needed["__key"])
    sets = docs.select(id_col, text).join(needed, match).select("fp", _sets(F.col(text)).alias("shingles"))
    return materialise(sets.dropDuplicates(["fp"]), "shingles")


def _of_heads(pairs: DataFrame, heads: DataFrame) -> DataFrame:
    """``pairs`` of SimHash fingerprints (a, b) as pairs of the sets that stand for them in ``heads`` (sim, head)."""
    for side in "ab":
        pairs = pairs.join(heads.select(F.col("sim").alias(side), F.col("head").alias(f"head_{side}")).hint("merge"), side)
    return pairs.drop("a", "b").withColumnsRenamed({"head_a": "a", "head_b": "b"})


def _ordered(pairs: DataFrame) -> DataFrame:
    """Each pair (a, b) with its components (ca, cb) once, the greater first."""
    up = F.col("a") > F.col("b")
    return pairs.select(
        F.greatest("a", "b").alias("a"),
        F.least("a", "b").alias("b"),
        F.when(up, F.col("ca")).otherwise(F.col("cb")).alias("ca"),
        F.when(up, F.col("cb")).otherwise(F.col("ca")).alias("cb"),
    ).distinct()


def set_components(docs: DataFrame, rows: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(fp, component) for the distinct sets of ``rows``, the signatures of ``docs``.

    What a set's keys need to know of it is joined while it is one row with a list of at most ``BANDS`` keys. Joins of small
    tables merge: their broadcasts would stay in the driver's memory.
    """
    first = F.min_by(F.struct("id", "text_key", "n", "bands", "odd", "sim"), F.struct("text_key", "id")).alias("r")
    distinct = materialise(rows.groupBy("fp").agg(first).select("fp", "r.*"), "distinct-sets")
    keys = distinct.repartition(task_partitions(distinct), "fp").select("fp", "n", F.explode("bands").alias("key"))
    shared = keys.groupBy("key").agg(F.count("*").alias("rows")).where("rows > 1")
    shared = keys.join(shared.hint("merge"), "key").groupBy("fp").agg(
        F.first("n").alias("n"), F.sum("rows").alias("weight"), F.collect_list("key").alias("keys")
    )
    shared = materialise(shared, "shared-keys")
    weighed = shared.select("fp", "n", "weight", F.explode("keys").alias("key"))
    centres = weighed.groupBy("key").agg(F.max(F.struct("weight", "fp", "n")).alias("c"))
    centres = centres.select("key", F.col("c.fp").alias("b"), F.col("c.n").alias("m"))

    # SimHash: sets with the fingerprint of a head, and heads whose fingerprints agree outside one nibble.
    heads = materialise(distinct.groupBy("sim").agg(F.min("fp").alias("head")), "heads")
    copies = distinct.join(heads.hint("merge"), "sim").where("fp <> head").select(F.col("fp").alias("a"), F.col("head").alias("b"))
    nibbles = simhash._nibble_links(simhash._dealt(heads.select(F.col("sim").alias("fp"))))
    near = materialise(copies.unionByName(_of_heads(nibbles, heads)), "near-fingerprints")

    close = lambda n, m: F.least(n, m) / F.greatest(n, m) >= SIMILARITY
    ends = shared.select("fp").union(near.select("a")).union(near.select("b")).distinct()
    sets = _shingle_sets(docs, distinct.join(ends.hint("merge"), "fp", "left_semi"), id_col, text)
    stars = weighed.join(centres.hint("merge"), "key").where((F.col("fp") != F.col("b")) & close(F.col("n"), F.col("m")))
    stars = _alike(stars.select(F.col("fp").alias("a"), "b").unionByName(near).distinct(), sets)
    tied = materialise(simhash._labelled(distinct.select("fp"), components(stars)), "tied-sets")

    led = heads.join(tied.withColumnRenamed("fp", "head").hint("merge"), "head")
    chains = simhash.chain_pairs(led.select(F.col("sim").alias("fp"), "component"))
    chains = materialise(_ordered(_of_heads(chains, heads)), "chains")
    ends = chains.select(F.col("a").alias("fp")).union(chains.select("b")).distinct()
    unread = ends.join(sets.select("fp").hint("merge"), "fp", "left_anti")
    unread = distinct.join(unread.hint("merge"), "fp", "left_semi")
    sets = sets.unionByName(_shingle_sets(docs, unread, id_col, text))

    found = shared.join(tied.hint("merge"), "fp").join(distinct.select("fp", "odd").hint("merge"), "fp")
    found = found.select("fp", "n", "component", "odd", F.explode("keys").alias("key"))
    mixed = found.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    mixed = mixed.where("low < high").select("key")
    found = materialise(found.join(mixed.hint("merge"), "key", "left_semi"), "mixed-blocks")
    sizes = found.groupBy("key", "component").count()
    largest = sizes.groupBy("key").agg(F.max(F.struct("count", "component")).alias("m")).select(
        "key", F.col("m.component").alias("largest")
    )
    x, y = found.join(largest.hint("merge"), "key").where("component <> largest").alias("x"), found.alias("y")
    # Each pair of a block once: rows of its largest component are on one side only, others meet in the order of fp.
    once = (F.col("y.component") == F.col("x.largest")) | (F.col("x.fp") > F.col("y.fp"))
    met = (F.col("x.key") == F.col("y.key")) & (F.col("x.component") != F.col("y.component")) & once
    # Of n + m elements, sets at similarity s have at most (1 - s) / (1 + s) * (n + m) that only one of them has.
    own = sum(F.bit_count(F.col("x.odd")[i].bitwiseXOR(F.col("y.odd")[i])) for i in range(WORDS))
    few = own * (1 + SIMILARITY) <= (1 - SIMILARITY) * (F.col("x.n") + F.col("y.n")) + 1e-6
    pairs = x.join(y, met & close(F.col("x.n"), F.col("y.n")) & few)
    pairs = pairs.select(
        F.col("x.fp").alias("a"), F.col("y.fp").alias("b"), F.col("x.component").alias("ca"), F.col("y.component").alias("cb")
    )
    links = _alike(_ordered(pairs.unionByName(chains)), sets).select(F.col("ca").alias("a"), F.col("cb").alias("b"))
    merged = components(links).select(F.col("node").alias("component"), F.col("component").alias("root"))
    return tied.join(merged, "component", "left").select("fp", F.coalesce("root", "component").alias("component"))


def near_copies(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id_col, text_key, fp, component_id, as ``simhash.near_duplicates`` has them."""
    rows = signatures(docs, id_col, text)
    return simhash.by_component(rows, set_components(docs, rows, id_col, text), id_col)


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The document with the least id of each component, by the rules of ``simhash.one_of_each``."""
    rows = signatures(docs, id_col, text)
    joined = materialise(set_components(docs, rows, id_col, text), "set-components")
    return simhash.survivors(docs, simhash.by_component(rows, joined, id_col), joined, id_col, text)
