"""Vector code compression: a product quantiser in exact integers over Hilbert-sorted flat blocks.

A vector is cut into ``parts`` equal parts. Once, every task turns its vectors into slabs of up to ``SLAB_ROWS``. For
each part position a slab keeps the parts in the order of a Hilbert curve, cut into flat blocks of ``BLOCK_ROWS``, with
each block's least and greatest components (its box) and its sums. In every round, the distances between a
block's box and the codebook's entries give the block's shortlist: entries that are no farther from the nearest point
of the box than some entry is from its farthest point. No other entry can be nearest to any part in the block. A
block with a shortlist of one adds its stored sums as a whole; the others are evaluated together, by width of shortlist,
in exact integers. Blocks with shortlists are many and small, so the kernels' memory is bounded by ``KERNEL_ITEMS``.

Slabs stay where their task wrote them: nothing is shuffled by vector, and equal vectors cost no more than others. A
round sends one row of sums for each task, part position and used entry. The driver holds the codebooks,
parts x entries x components integers.

Null vectors, those of a length other than ``dims``, and those with null, NaN or infinite components are left out.
Equal distances go to the lower entry. Repeated rows count, and appear, as often as they occur; null ids come after all
others when the codebook starts, and rows of equal id are taken in the order of their vectors. With fewer than
``entries`` vectors the codebooks are shorter. An empty table gives an empty result. Only the id, the vector and the
label are read, whatever else there is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchloom.llm.vectors import is_whole, matrix, to_integers
from batchloom.storage import inline_rows, materialise

SLAB_ROWS = 8_192
BLOCK_ROWS = 8
KERNEL_ITEMS = 1 << 21
KEY_BITS = 60


def hilbert_order(points: np.ndarray) -> np.ndarray:
    """Order of integer points along a Hilbert curve through their bounding box.

    The axes are turned into the curve's transposed index by exchanges and inversions from the highest bit down,
    then Gray-decoded (Skilling 2004). Bits that don't fit the key are left out, and axes beyond the first sixty:
    the order decides only how tight the blocks are.
    """
    axes = (points[:, :KEY_BITS] - points[:, :KEY_BITS].min(0)).T.copy()
    d = len(axes)
    bits = max(1, KEY_BITS // d)
    axes >>= max(0, int(axes.max()).bit_length() - bits)
    for b in range(bits - 1, 0, -1):
        low = (1 << b) - 1
        for i in range(d):
            inverted = (axes[i] >> b & 1).astype(bool)
            swap = np.where(inverted, 0, (axes[0] ^ axes[i]) & low)
            axes[0] = np.where(inverted, axes[0] ^ low, axes[0] ^ swap)
            if i:
                axes[i] ^= swap
    for i in range(1, d):
        axes[i] ^= axes[i - 1]
    turn = np.zeros_like(axes[0])
    for b in range(bits - 1, 0, -1):
        turn ^= np.where(axes[d - 1] >> b & 1, (1 << b) - 1, 0)
    axes ^= turn
    key = np.zeros_like(axes[0])
    for b in range(bits - 1, -1, -1):
        for i in range(d):
            key = key << 1 | (axes[i] >> b & 1)
    return np.argsort(key, kind="stable")


def blocks_of(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Points in whole blocks (blocks, BLOCK_ROWS, components), rows of each that count, and the order.

    The last block is filled up with copies of its last point.
    """
    order = hilbert_order(points)
    count = -(-len(points) // BLOCK_ROWS)
    fill = np.minimum(np.arange(count * BLOCK_ROWS), len(points) - 1)
    rows = np.full(count, BLOCK_ROWS)
    rows[-1] = len(points) - (count - 1) * BLOCK_ROWS
    return points[order][fill].reshape(count, BLOCK_ROWS, -1), rows, order


def shortlists(low: np.ndarray, high: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Which entries (blocks, entries) may be nearest to a point inside each box; ties stay in."""
    near, far = np.zeros((len(low), len(entries)), np.int64), np.zeros((len(low), len(entries)), np.int64)
    for axis in range(low.shape[1]):
        below, above = low[:, axis, None] - entries[None, :, axis], entries[None, :, axis] - high[:, axis, None]
        outside = np.maximum(np.maximum(below, above), 0)
        near += outside * outside
        farthest = np.maximum(np.abs(below), np.abs(above))
        far += farthest * farthest
    return near <= far.min(1)[:, None]


def nearest_listed(points: np.ndarray, listed: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry and squared distance of all points (blocks, rows, components), from each block's shortlist.

    Blocks whose shortlists have about the same width are evaluated together. Shortlists are in ascending order and
    filled up with their last entry, so the first of equal distances is the lowest entry.
    """
    count, rows, dims = points.shape
    code, error = np.empty((count, rows), np.int64), np.empty((count, rows), np.int64)
    widths = listed.sum(1)
    ranks = np.argsort(~listed, axis=1, kind="stable")  # listed entries first, in ascending order
    width = 1
    while width // 2 < len(entries):
        group = np.flatnonzero((widths > width // 2) & (widths <= width))
        step = max(1, KERNEL_ITEMS // (rows * width))
        for at in range(0, len(group), step):
            some = group[at : at + step]
            columns = np.minimum(np.arange(width)[None, :], widths[some, None] - 1)
            short = np.take_along_axis(ranks[some], columns, axis=1)
            distance = np.zeros((len(some), rows, width), np.int64)
            for axis in range(dims):
                difference = points[some, :, axis, None] - entries[short, axis][:, None, :]
                distance += difference * difference
            best = distance.argmin(2)
            code[some] = np.take_along_axis(short, best, axis=1)
            error[some] = np.take_along_axis(distance, best[:, :, None], axis=2)[:, :, 0]
        width *= 2
    return code, error


class Slabs:
    """Writes and reads slabs. Every list of a slab holds one run of values for each part position."""

    SCHEMA = (
        "n int, points array<int>, rows array<int>, low array<int>, high array<int>, totals array<long>, "
        "order array<int>"
    )

    def __init__(self, parts: int, dims: int):
        self.parts, self.size = parts, dims // parts

    def made(self, ids: pa.Array, labels: pa.Array, vectors: np.ndarray) -> list:
        out = {name: [] for name in ("points", "rows", "low", "high", "totals", "order")}
        for p in range(self.parts):
            points, rows, order = blocks_of(vectors[:, p * self.size : (p + 1) * self.size])
            counts = np.arange(BLOCK_ROWS)[None, :] < rows[:, None]
            out["points"].append(points)
            out["rows"].append(rows)
            out["low"].append(points.min(1))
            out["high"].append(points.max(1))
            out["totals"].append(np.where(counts[:, :, None], points, 0).sum(1))
            out["order"].append(order)
        flat = {name: np.concatenate([v.ravel() for v in values]) for name, values in out.items()}
        lists = [_one_list(pa.array(v.astype(np.int64 if name == "totals" else np.int32))) for name, v in flat.items()]
        return [pa.array([len(vectors)], pa.int32()), *lists, _one_list(ids), _one_list(labels)]

    def parts_of(self, slab: dict) -> Iterator[tuple[int, dict[str, np.ndarray]]]:
        """For each part position, the slab's columns in their shapes."""
        blocks = -(-slab["n"] // BLOCK_ROWS)
        shapes = {
            "points": (blocks, BLOCK_ROWS, self.size),
            "rows": (blocks,),
            "low": (blocks, self.size),
            "high": (blocks, self.size),
            "totals": (blocks, self.size),
            "order": (slab["n"],),
        }
        whole = {name: slab[name].reshape(self.parts, *shape) for name, shape in shapes.items() if name in slab}
        for p in range(self.parts):
            yield p, {name: values[p] for name, values in whole.items()}


def _one_list(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _slabs_in(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple[dict, pa.RecordBatch, int]]:
    for batch in batches:
        for i in range(batch.num_rows):
            slab = {"n": batch.column("n")[i].as_py()}
            for name in names:
                slab[name] = batch.column(name)[i].values.to_numpy(zero_copy_only=False).astype(np.int64)
            yield slab, batch, i


def build_slabs(kept: DataFrame, parts: int, dims: int) -> DataFrame:
    """``kept`` (id, vector, label) as slabs, written once."""
    layout = Slabs(parts, dims)
    types = {name: kept.schema[name].dataType.simpleString() for name in ("id", "label")}
    schema = f"{Slabs.SCHEMA}, id array<{types['id']}>, label array<{types['label']}>"
    names = [part.split()[0] for part in schema.split(", ")]

    def slabs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0

        def made() -> Iterator[pa.RecordBatch]:
            whole = pa.Table.from_batches(held).combine_chunks()
            for at in range(0, len(whole), SLAB_ROWS):
                part = whole.slice(at, SLAB_ROWS).combine_chunks()
                columns = {name: part.column(name).chunk(0) for name in ("id", "vector", "label")}
                rows = matrix(columns["vector"], dims).astype(np.int64)
                yield pa.RecordBatch.from_arrays(layout.made(columns["id"], columns["label"], rows), names=names)

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += batch.num_rows
            if size >= SLAB_ROWS:
                yield from made()
                held, size = [], 0
        if held:
            yield from made()

    return materialise(kept.select("id", "vector", "label").mapInArrow(slabs, schema), "slabs")


def refined(slabs: DataFrame, layout: Slabs, books: np.ndarray) -> np.ndarray:
    """The codebooks (parts, entries, components) after one round: exact floored means; unused entries stay."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, counts = np.zeros(books.shape, np.int64), np.zeros(books.shape[:2], np.int64)
        for slab, _, _ in _slabs_in(batches, ["points", "rows", "low", "high", "totals"]):
            for p, of in layout.parts_of(slab):
                listed = shortlists(of["low"], of["high"], books[p])
                sole = listed.sum(1) == 1
                entry = listed[sole].argmax(1)
                np.add.at(totals[p], entry, of["totals"][sole])
                np.add.at(counts[p], entry, of["rows"][sole])
                points = of["points"][~sole]
                if len(points):
                    code, _ = nearest_listed(points, listed[~sole], books[p])
                    inside = np.arange(BLOCK_ROWS)[None, :] < of["rows"][~sole, None]
                    counts[p] += np.bincount(code[inside], minlength=books.shape[1])
                    for axis in range(layout.size):  # sums of one slab are far below 2^53, so they are exact
                        sums_of = np.bincount(code[inside], points[:, :, axis][inside], books.shape[1])
                        totals[p, :, axis] += sums_of.astype(np.int64)
        part, entry = np.nonzero(counts)
        lists = pa.array(list(totals[part, entry]), pa.list_(pa.int64()))
        columns = [pa.array(part), pa.array(entry), pa.array(counts[part, entry]), lists]
        yield pa.RecordBatch.from_arrays(columns, names=["part", "entry", "n", "totals"])

    read = slabs.select("n", "points", "rows", "low", "high", "totals")
    sent = read.mapInArrow(sums, "part long, entry long, n long, totals array<long>")
    totals = [F.sum(F.col("totals")[i]).alias(f"t{i}") for i in range(layout.size)]
    after = books.copy()
    for part, entry, n, *total in sent.groupBy("part", "entry").agg(F.sum("n").alias("n"), *totals).collect():
        after[part, entry] = [t // n for t in total]
    return after


def quantise(
    vectors: DataFrame,
    parts: int = 16,
    entries: int = 64,
    rounds: int = 2,
    dims: int = 64,
    scale: int = 256,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> tuple[DataFrame, np.ndarray]:
    """Each kept vector's id and label with its ``code`` (array<int>, an entry for each part) and ``error``; the codebooks.

    The codebooks start as the parts of the ``entries`` vectors with the least ids.
    """
    kept = vectors.select(F.col(vec_id).alias("id"), F.col(vector).alias("vector"), F.col(label).alias("label"))
    kept = kept.where(is_whole(F.col("vector"), dims)).withColumn("vector", to_integers(F.col("vector"), scale))
    first = kept.select("id", "vector").orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries).collect()
    layout = Slabs(parts, dims)
    start = np.array([r.vector for r in first], np.int64).reshape(len(first), parts, layout.size)
    books = start.transpose(1, 0, 2).copy()
    types = {name: kept.schema[name].dataType.simpleString() for name in ("id", "label")}
    schema = f"id {types['id']}, label {types['label']}, code array<int>, error long"
    named = {"id": vec_id, "label": label}
    if not first:
        return inline_rows(vectors.sparkSession, [], schema).withColumnsRenamed(named), books
    slabs = build_slabs(kept, parts, dims)
    for _ in range(rounds):
        books = refined(slabs, layout, books)
    final = books

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for slab, batch, i in _slabs_in(batches, ["points", "low", "high", "order"]):
            codes, errors = np.empty((slab["n"], parts), np.int32), np.zeros(slab["n"], np.int64)
            for p, of in layout.parts_of(slab):
                code, error = nearest_listed(of["points"], shortlists(of["low"], of["high"], final[p]), final[p])
                codes[of["order"], p] = code.ravel()[: slab["n"]]
                errors[of["order"]] += error.ravel()[: slab["n"]]
            ends = pa.array(np.arange(0, codes.size + 1, parts, dtype=np.int32))
            lists = pa.ListArray.from_arrays(ends, pa.array(codes.ravel()))
            ids, labels = batch.column("id")[i].values, batch.column("label")[i].values
            yield pa.RecordBatch.from_arrays([ids, labels, lists, pa.array(errors)], names=["id", "label", "code", "error"])

    read = slabs.select("n", "points", "low", "high", "order", "id", "label")
    return read.mapInArrow(coded, schema).withColumnsRenamed(named), books


def with_label_error(coded: DataFrame, label: str = "label") -> DataFrame:
    """``coded`` with ``label_error``, the errors summed over rows of equal label; nulls are equal.

    Sums are pre-aggregated in the tasks. The labels' totals are a stored table, so Spark broadcasts them by their
    size or else joins them with a split of hot labels.
    """
    coded = materialise(coded, "codes")
    totals = materialise(coded.groupBy(F.col(label).alias("of_label")).agg(F.sum("error").alias("label_error")), "labels")
    return coded.join(totals, F.col(label).eqNullSafe(F.col("of_label"))).drop("of_label")


def books_digest(books: np.ndarray) -> str:
    """Lowercase hex SHA-256 of all entries' components by part, entry and position."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
