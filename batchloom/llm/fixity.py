"""Merkle fixity audit of the replicas of a WARC archive.

Records are hashed, and hashes are combined over ordered offset ranges: a leaf covers ``RANGE_BYTES`` of a file
and takes in each record's offset and hash, a node covers ``FANOUT`` ranges of the level below, up to one root per
file. Two replicas are compared from the roots down, and only branches that differ are descended, so an intact
archive costs one comparison per file.

Ranges are places in the file, not counts of records. Places come from the archive's index (``place_records``), and a
replica's records are hashed where the index has them (``at_index``): a lost, added or altered record changes its
own branch only, also when its length changes. A replica whose places were made anew from what it still holds would
differ from the first damage to the end. A range holds few records however large the archive is. Files may have any
size; a file that one replica lacks differs at its root. Records at the same place are combined in the order of their hashes. A null payload is an
empty record. Rows without a file or offset can't be placed and are refused by ``place_records``, which makes
both. An empty replica has no roots. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchloom.llm.ranking import running
from batchloom.storage import materialise

RANGE_BYTES = 65_536
FANOUT = 16
FILE_BYTES = 1 << 30


def warc_record(uri: Column, payload: Column) -> Column:
    """A WARC/1.0 resource record as text."""
    body = F.coalesce(payload, F.lit(""))
    head = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: resource\r\nWARC-Target-URI: "),
        F.coalesce(uri, F.lit("")),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
    )
    return F.concat(head, body, F.lit("\r\n\r\n"))


def hashed(records: DataFrame, key: str, *more: str) -> DataFrame:
    """(key, length, digest) of the bytes of ``records`` (key, record), and the columns ``more``."""
    return records.select(
        F.col(key).alias("key"),
        F.octet_length("record").cast("long").alias("length"),
        F.sha2(F.col("record").cast("binary"), 256).alias("digest"),
        *more,
    )


def place_records(records: DataFrame, key: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """``records`` (key, record) laid out one after another: (key, file, offset, length, digest).

    A record belongs to the file in which it starts; files start every ``file_bytes`` bytes of the archive.
    """
    placed = running(hashed(records, key), ["key", "digest"], F.col("length"), "start")
    return placed.select(
        "key",
        F.expr(f"start div {file_bytes}").alias("file"),
        (F.col("start") % file_bytes).alias("offset"),
        "length",
        "digest",
    )


def at_index(records: DataFrame, key: str, index: DataFrame) -> DataFrame:
    """A replica's ``records`` (key, was, record) at the places of ``index``: (key, file, offset, length, digest).

    ``was`` is the digest that the index has for the record; together with the key, which may be null, it says which
    entry a record belongs to. Length and digest are those of the replica's own bytes. Entries of the index without
    a record are lost. Rows with equal key and ``was`` fill all entries of the index that have them.
    """
    found = hashed(records, key, "was").dropDuplicates(["key", "was"]).select(
        F.col("key").alias("of"), "was", F.col("length").alias("new_length"), F.col("digest").alias("new_digest")
    )
    match = F.col("key").eqNullSafe(F.col("of")) & (F.col("digest") == F.col("was"))
    return index.join(found, match).select(
        "key", "file", "offset", F.col("new_length").alias("length"), F.col("new_digest").alias("digest")
    )


def _combined(order: list[str]) -> Column:
    listed = F.array_sort(F.collect_list(F.struct(*order, "digest")))
    return F.sha2(F.array_join(F.transform(listed, lambda x: x["digest"]), ""), 256).alias("digest")


def merkle_levels(replica: DataFrame, levels: int, range_bytes: int = RANGE_BYTES) -> list[DataFrame]:
    """Nodes (file, range, digest) of every level, leaves first; each level is written once."""
    placed = F.concat_ws(":", F.col("offset").cast("string"), "digest").alias("digest")
    leaves = replica.select("file", F.expr(f"offset div {range_bytes}").alias("range"), "offset", placed)
    nodes = [materialise(leaves.groupBy("file", "range").agg(_combined(["offset"])), "merkle")]
    for _ in range(levels):
        up = nodes[-1].select("file", F.expr(f"range div {FANOUT}").alias("up"), "range", "digest")
        up = up.groupBy("file", "up").agg(_combined(["range"])).withColumnRenamed("up", "range")
        nodes.append(materialise(up, "merkle"))
    return nodes


def depth(range_bytes: int = RANGE_BYTES, file_bytes: int = FILE_BYTES) -> int:
    """Levels above the leaves until one node covers a file."""
    ranges, levels = -(-file_bytes // range_bytes), 0
    while ranges > 1:
        ranges, levels = -(-ranges // FANOUT), levels + 1
    return levels


def _differing(a: DataFrame, b: DataFrame, within: DataFrame | None) -> DataFrame:
    """Nodes (file, range) of one level that differ, among the children of ``within``."""
    if within is not None:
        parents = within.select(F.col("file").alias("pf"), F.col("range").alias("pr"))
        child = lambda t: t.join(
            parents, (t["file"] == parents["pf"]) & (F.expr(f"range div {FANOUT}") == parents["pr"]), "left_semi"
        )
        a, b = child(a), child(b)
    b = b.select(F.col("file").alias("bf"), F.col("range").alias("br"), F.col("digest").alias("bd"))
    both = a.join(b, (F.col("file") == F.col("bf")) & (F.col("range") == F.col("br")), "full")
    return both.where(~F.col("digest").eqNullSafe(F.col("bd"))).select(
        F.coalesce("file", "bf").alias("file"), F.coalesce("range", "br").alias("range")
    )


def audit(a: DataFrame, b: DataFrame, range_bytes: int = RANGE_BYTES, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Damaged records of replicas (key, file, offset, length, digest): place, kind and both digests.

    Kinds, seen from ``a``: ``changed``, ``missing`` (not in ``b``), ``added`` (only in ``b``).
    """
    a, b = materialise(a, "replica-a"), materialise(b, "replica-b")
    levels = depth(range_bytes, file_bytes)
    nodes_a, nodes_b = merkle_levels(a, levels, range_bytes), merkle_levels(b, levels, range_bytes)
    within = None
    for of_a, of_b in zip(reversed(nodes_a), reversed(nodes_b)):
        within = materialise(_differing(of_a, of_b, within), "differing")
    bad = within.select(F.col("file").alias("wf"), F.col("range").alias("wr"))

    def suspects(t: DataFrame) -> DataFrame:
        inside = (t["file"] == bad["wf"]) & (F.expr(f"offset div {range_bytes}") == bad["wr"])
        return t.join(bad, inside, "left_semi")

    sides = suspects(a).withColumn("side", F.lit("a")).unionByName(suspects(b).withColumn("side", F.lit("b")))
    in_a, in_b = F.col("side") == "a", F.col("side") == "b"
    found = sides.groupBy("file", "offset", "key").agg(
        F.max(F.when(in_a, F.col("length"))).alias("length"),
        F.array_join(F.sort_array(F.collect_list(F.when(in_a, F.col("digest")))), ",").alias("digest_a"),
        F.array_join(F.sort_array(F.collect_list(F.when(in_b, F.col("digest")))), ",").alias("digest_b"),
    )
    kind = F.when(F.col("digest_b") == "", "missing").when(F.col("digest_a") == "", "added").otherwise("changed")
    return found.where("digest_a <> digest_b").select("key", "file", "offset", "length", kind.alias("kind"), "digest_a", "digest_b")
