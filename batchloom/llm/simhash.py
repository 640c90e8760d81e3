"""SimHash near duplicates, with candidates pruned by the pigeonring principle.

Fingerprints link when they differ in at most ``BITS`` = 4 of 64 bits. They are cut into 5 segments on a ring.
If two differ in at most 4 bits, some segment starts a chain whose first l segments differ, for every l, in at
most l * 4 / 5 bits: in none for l = 1, 1 for l = 2, then 2, 3 and 4. So a pair agrees on a segment and differs
in at most one bit of the next, which makes the blocking key; the rest of the chain is checked before the
whole distance.

Only distinct fingerprints are compared, so exact copies cost nothing. Dense groups don't become all pairs: first,
fingerprints that agree outside one nibble (hence all link to each other) are tied to their least; in each
block, rows of its largest component are then only met by rows of other components. Links between
fingerprints of one component are not listed, as they add nothing to reachability. No cap is set anywhere.

A null or empty text has fingerprint zero and links like any other. A null id never becomes a component id
unless all ids of the component are null. Repeated rows come out once each. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchloom.llm.common import task_partitions, words_of
from batchloom.llm.components import components
from batchloom.storage import materialise

SHINGLE = 4
BITS = 4
#: (offset, width) of the segments of the ring.
SEGMENTS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))
CHUNK = 100_000


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Signed 64-bit SimHash of a text's word shingles, repeats included."""
    words = words_of(text)
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) > shingle:
        starts, ends = starts[: 1 - shingle], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, dtype=np.int64)
    for at in range(0, len(starts), CHUNK):
        spans = zip(starts[at : at + CHUNK].tolist(), ends[at : at + CHUNK].tolist())
        hashes = np.array([digest(joined[a:b], 42) for a, b in spans], dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view("<i8")[0])


def _fingerprints(text: Column) -> Column:
    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return texts.map(fingerprint).astype("int64")

    return of(text)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (id, text_key, fp) on shared storage; the key is a hash of the whole text."""
    rows = docs.select(
        F.col(id_col).alias("id"), F.xxhash64(text).alias("text_key"), _fingerprints(F.col(text)).alias("fp")
    )
    return materialise(rows, "fingerprints")


def _masks(segments: int) -> Column:
    """For each start of a chain, the mask of its first ``segments`` segments."""
    masks = []
    for start in range(len(SEGMENTS)):
        mask = 0
        for i in range(segments):
            offset, width = SEGMENTS[(start + i) % len(SEGMENTS)]
            mask |= ((1 << width) - 1) << offset
        masks.append(F.lit(mask - (1 << 64) if mask >> 63 else mask).cast("long"))
    return F.array(*masks)


def _bits(fp: Column, segment: int) -> Column:
    offset, width = SEGMENTS[segment % len(SEGMENTS)]
    return F.shiftrightunsigned(fp, offset).bitwiseAND(F.lit((1 << width) - 1).cast("long"))


def chain_ok(x: Column, start: Column) -> Column:
    """Whether the differing bits ``x`` stay within the budget of every chain prefix from ``start``."""
    ok = F.bit_count(x) <= BITS
    for length in range(2, len(SEGMENTS)):
        budget = length * BITS // len(SEGMENTS)
        ok = (F.bit_count(x.bitwiseAND(F.get(_masks(length), start))) <= budget) & ok
    return ok


def _blocked(fps: DataFrame) -> DataFrame:
    """``fps`` (fp, component) with a row for each key: as it is, and with a set bit of the second segment cleared.

    Of two fingerprints that differ in one bit there, the one that has it set meets the other's own key. Starts and bits
    are two short lists: spelt out, the 69 keys make plans and generated code that fill the driver's memory.
    """
    fp, n = F.col("fp"), len(SEGMENTS)
    starts = F.array(*(F.lit(i << 26).cast("long") + F.shiftleft(_bits(fp, i), 13) + _bits(fp, i + 1) for i in range(n)))
    bits = F.array(*(F.lit(b).cast("long") for b in (0, *(1 << i for i in range(max(w for _, w in SEGMENTS))))))
    rows = fps.select("fp", "component", F.explode(starts).alias("of")).select("*", F.explode(bits).alias("bit"))
    rows = rows.where("bit = 0 OR (of & bit) <> 0")
    return rows.select("fp", "component", (F.col("of") - F.col("bit")).alias("key"), (F.col("bit") == 0).alias("own"))


def _nibble_links(fps: DataFrame) -> DataFrame:
    """Ties between fingerprints that agree outside one nibble, to the least of them."""
    outside = F.array(*(F.lit(_signed(~(0xF << 4 * k))).cast("long") for k in range(16)))
    rows = fps.select("fp", F.posexplode(outside).alias("k", "mask"))
    rows = rows.select("fp", "k", F.col("fp").bitwiseAND(F.col("mask")).alias("rest"))
    groups = rows.groupBy("k", "rest").agg(F.min("fp").alias("least"), F.max("fp").alias("most")).where("least < most")
    return rows.join(groups.drop("most"), ["k", "rest"]).where("fp <> least").select(
        F.col("fp").alias("a"), F.col("least").alias("b")
    )


def _signed(value: int) -> int:
    value &= (1 << 64) - 1
    return value - (1 << 64) if value >> 63 else value


def _dealt(fps: DataFrame) -> DataFrame:
    """``fps`` over all tasks: the table is small, but each row becomes dozens."""
    return fps.repartition(task_partitions(fps), "fp")


def _labelled(fps: DataFrame, labels: DataFrame) -> DataFrame:
    found = labels.select(F.col("node").alias("fp"), "component")
    return fps.join(found, "fp", "left").select("fp", F.coalesce("component", "fp").alias("component"))


def chain_pairs(fps: DataFrame) -> DataFrame:
    """Linked fingerprints (a, b) of different components (ca, cb) of ``fps`` (fp, component); a pair may come again."""
    rows = _blocked(_dealt(fps))
    mixed = rows.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    mixed = mixed.where("low < high").select("key")
    rows = materialise(rows.join(mixed, "key", "left_semi"), "blocks")
    sizes = rows.groupBy("key", "component").count()
    largest = sizes.groupBy("key").agg(F.max(F.struct("count", "component")).alias("m")).select(
        "key", F.col("m.component").alias("largest")
    )
    fewer = rows.join(largest, "key").where("component <> largest").drop("largest")
    a, b = fewer.alias("a"), rows.alias("b")
    start = F.shiftright(F.col("a.key"), 26).cast("int")
    pairs = a.join(
        b,
        (F.col("a.key") == F.col("b.key"))
        & (F.col("a.component") != F.col("b.component"))
        & (F.col("a.own") | F.col("b.own"))
        & chain_ok(F.col("a.fp").bitwiseXOR(F.col("b.fp")), start),
    )
    return pairs.select(
        F.col("a.fp").alias("a"), F.col("b.fp").alias("b"), F.col("a.component").alias("ca"), F.col("b.component").alias("cb")
    )


def chain_links(fps: DataFrame) -> DataFrame:
    """Links (a, b) between the components of ``fps`` (fp, component), by fingerprints that link."""
    return chain_pairs(fps).select(F.greatest("ca", "cb").alias("a"), F.least("ca", "cb").alias("b")).distinct()


def fingerprint_components(fps: DataFrame) -> DataFrame:
    """(fp, component) for the distinct fingerprints of ``fps``."""
    distinct = materialise(fps.select("fp").distinct(), "distinct-fps")
    tied = materialise(_labelled(distinct, components(_nibble_links(_dealt(distinct)))), "tied-fps")
    merged = components(chain_links(tied)).select(F.col("node").alias("component"), F.col("component").alias("root"))
    return tied.join(merged, "component", "left").select("fp", F.coalesce("root", "component").alias("component"))


def by_component(fps: DataFrame, joined: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows (id_col, text_key, fp, component_id) of ``fps`` (id, text_key, fp), given (fp, component)."""
    least = fps.groupBy("fp").agg(F.min("id").alias("id")).join(joined, "fp")
    roots = least.groupBy("component").agg(F.min("id").alias("component_id"))
    by_fp = materialise(least.select("fp", "component").join(roots, "component").select("fp", "component_id"), "roots")
    return fps.join(by_fp, "fp").select(F.col("id").alias(id_col), "text_key", "fp", "component_id")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id_col, text_key, fp, component_id (the least id that its links reach)."""
    fps = fingerprints(docs, id_col, text)
    return by_component(fps, fingerprint_components(fps), id_col)


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The document with the least id of each component, all columns kept.

    Of rows that share that id, the text with the least hash stays, once. A component whose ids are all null
    keeps the text with the least hash. The choice is made on ids and hashes; texts are read when it is known.
    """
    fps = fingerprints(docs, id_col, text)
    joined = materialise(fingerprint_components(fps), "fp-components")
    return survivors(docs, by_component(fps, joined, id_col), joined, id_col, text)


def survivors(docs: DataFrame, found: DataFrame, joined: DataFrame, id_col: str, text: str) -> DataFrame:
    """The rows of ``docs`` that ``one_of_each`` keeps, given the rows of ``by_component`` and (fp, component)."""
    first = found.where(F.col(id_col).eqNullSafe(F.col("component_id")))
    # Components without an id are told apart by their least fingerprint's text; all others by their id.
    per_row = first.groupBy("component_id", "text_key").agg(F.count("*").alias("copies"), F.min("fp").alias("fp"))
    named = per_row.where("component_id IS NOT NULL").groupBy("component_id").agg(F.min_by("copies", "text_key").alias("copies"), F.min("text_key").alias("text_key"))
    nameless = per_row.where("component_id IS NULL").join(joined, "fp").groupBy("component").agg(
        F.lit(None).cast("long").alias("component_id"), F.min_by("copies", "text_key").alias("copies"), F.min("text_key").alias("text_key")
    )
    stay = named.select("component_id", "text_key", "copies").unionByName(nameless.drop("component"))
    stay = materialise(stay.withColumnsRenamed({"component_id": "__id", "text_key": "__key", "copies": "__copies"}), "stay")
    match = docs[id_col].eqNullSafe(stay["__id"]) & (F.xxhash64(docs[text]) == stay["__key"])
    repeated = stay.where("__copies > 1")
    if repeated.isEmpty():
        return docs.join(stay, match, "left_semi")
    single = docs.join(stay.where("__copies = 1"), match, "left_semi")
    return single.unionByName(docs.join(repeated, match, "left_semi").dropDuplicates([id_col, text]))
