"""Token ids as binary files, Simple-8b coded.

Documents are range-partitioned and sorted by ``doc_id``; every task encodes its documents and writes one file, so
files in name order hold all documents in ascending order. Ids of a document are those of the tokenizers library,
followed by ``end_id``. Spark's own writer commits the files, so a lost executor leaves no half file behind, and any
store that Spark can reach will do.

A file is a sequence of segments of whole documents. A segment is a sequence of 64-bit little-endian words: a head
(``HEAD``), the documents' ids and ends, the blocks' offsets, the blocks, and a trailer whose last byte is a line feed.
A block holds ``block_ids`` ids (the last one fewer) as packed words and, behind them, escaped ids. A packed word is
a selector of four bits above 60 bits of lanes; the selector fixes how many ids of how many bits the lanes hold.
Selector ``ESCAPE`` stands for one id too wide for any lane; it is the block's next escaped id, in full. As every
block's offset is kept, blocks are decoded each on its own and all words of one selector at once.

Null and empty texts have the end id alone. Documents with null ids come first. Documents with equal ids follow each
other by the hash of their text; repeated rows are all written. Columns other than ``doc_id`` and the text are not
read, whatever their names. An empty table gives no segments. Memory follows ``SEGMENT_IDS`` and the longest document's
ids, texts being encoded in groups of ``PART_CHARS``, and longer ones in parts that end before white space.
"""

from __future__ import annotations

import os
import sys
import zlib
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from batchloom.llm.bpe import byte_symbols
from batchloom.llm.common import task_partitions
from batchloom.storage import inline_rows, materialise

#: Lanes of a word by selector: (ids, bits of each). The first two selectors have none of their own.
ESCAPE = 0
LANES = {1: (120, 0)} | {s: (60 // b, b) for s, b in enumerate((1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60), 2)}

#: Lane widths in ascending order, 64 standing for none, and the least id that each of them can't hold.
_ROOM = np.array(sorted({b for _, b in LANES.values()} | {64}), np.uint8)
_FULL = np.uint64(1) << _ROOM[:-1].astype(np.uint64)

MAGIC, TRAILER = int.from_bytes(b"S8B-IDS1", "little"), b"S8B-END\n"
HEAD = ("magic", "file", "docs", "null_docs", "ids", "block_ids", "blocks", "words")
BLOCK_IDS = 16_384
SEGMENT_IDS = 1_000_000
FILE_TEXT_BYTES = 128 << 20
PART_CHARS = 1_000_000
CACHED_WORDS = 300_000
#: A byte that no text in UTF-8 holds, and how many words it joins.
BETWEEN, JOINED_WORDS = b"\xff", 32

Index = dict[str, np.ndarray]


# -- Simple-8b


def _widths(ids: np.ndarray) -> np.ndarray:
    """Bits of the narrowest lane that holds each id; 64 if none does."""
    if int(ids.max()) < len(_LOW_WIDTHS):
        return _LOW_WIDTHS[ids]
    return _ROOM[np.searchsorted(_FULL, ids, side="right")]


#: The same for ids of two bytes, which nearly all are, as a table.
_LOW_WIDTHS = _ROOM[np.searchsorted(_FULL, np.arange(1 << 16, dtype=np.uint64), side="right")]


def pack_block(ids: np.ndarray) -> tuple[np.ndarray, int]:
    """Words of one block of ids (uint64), the escaped ones last, and how many are escaped."""
    n = len(ids)
    if not n:
        return np.zeros(0, np.uint64), 0
    step, chosen = np.ones(n, np.uint8), np.zeros(n, np.uint8)  # what no lane can hold is escaped
    widest, width, reach = _widths(ids), int(ids.max()).bit_length(), 1
    for selector, (count, bits) in sorted(LANES.items(), reverse=True):
        while reach < count:  # now the greatest width among each id and the reach - 1 after it
            more = min(reach, count - reach)
            inside = max(n - more, 0)  # beyond the block nothing is wide
            np.maximum(widest[:inside], widest[more:], out=widest[:inside])
            reach += more
        fits = widest <= bits if bits < width else np.True_
        if not fits.any():  # nor do more ids fit narrower lanes
            break
        step, chosen = np.where(fits, np.uint8(count), step), np.where(fits, np.uint8(selector), chosen)
    steps, starts, i = step.tolist(), [], 0
    while i < n:
        starts.append(i)
        i += steps[i]
    starts = np.array(starts)
    selectors = chosen[starts].astype(np.uint64)
    words = selectors << np.uint64(60)
    padded = np.concatenate([ids, np.zeros(max(c for c, _ in LANES.values()), np.uint64)])
    for selector, (count, bits) in LANES.items():
        of = np.flatnonzero(selectors == selector)
        if bits and len(of):
            first, lanes = starts[of], words[of]
            for lane in range(count):
                lanes |= padded[first + lane] << np.uint64(lane * bits)
            words[of] = lanes
    escaped = ids[starts[selectors == ESCAPE]]
    return np.concatenate([words, escaped]), len(escaped)


def unpack_block(words: np.ndarray, escaped: int, n: int) -> np.ndarray:
    """The ``n`` ids of one block; its last ``escaped`` words are ids in full."""
    packed, full = words[: len(words) - escaped], words[len(words) - escaped :]
    selectors = (packed >> np.uint64(60)).astype(np.int64)
    counts = np.ones(16, np.int64)
    for selector, (count, _) in LANES.items():
        counts[selector] = count
    ends = np.cumsum(counts[selectors])
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint64)
    starts = ends - counts[selectors]
    out[starts[selectors == ESCAPE]] = full
    for selector, (count, bits) in LANES.items():
        of = np.flatnonzero(selectors == selector)
        if bits and len(of):
            shifts = np.arange(count, dtype=np.uint64) * np.uint64(bits)
            mask = np.uint64((1 << bits) - 1)
            out[starts[of, None] + np.arange(count)] = (packed[of, None] >> shifts) & mask
    return out[:n]


# -- segments


def write_segment(file: int, doc_ids: list[int | None], lengths: list[int], ids: np.ndarray, block_ids: int = BLOCK_IDS) -> bytes:
    """One segment without the line feed that ends its trailer: the line writer adds that."""
    blocks = [pack_block(ids[i : i + block_ids].astype(np.uint64)) for i in range(0, len(ids), block_ids)]
    sizes = np.array([len(words) for words, _ in blocks], np.int64)
    head = (MAGIC, file, len(doc_ids), doc_ids.count(None), len(ids), block_ids, len(blocks), int(sizes.sum()))
    words = [
        np.array(head, np.int64),
        np.array([i or 0 for i in doc_ids], np.int64),
        np.cumsum(np.array(lengths, np.int64)),
        np.cumsum(sizes) - sizes,
        np.array([escaped for _, escaped in blocks], np.int64),
        *(words.view(np.int64) for words, _ in blocks),
    ]
    return b"".join(w.astype("<i8").tobytes() for w in words) + TRAILER[:-1]


def segments(content: memoryview) -> Iterator[tuple[dict[str, int], Index, np.ndarray]]:
    """Head, tables and words of every segment of a file; no id is decoded yet."""
    at, words = 0, np.frombuffer(content, "<i8")
    while at < len(words):
        head = dict(zip(HEAD, words[at : at + len(HEAD)].tolist()))
        if head["magic"] != MAGIC:
            raise ValueError(f"no segment starts at byte {8 * at}")
        at += len(HEAD)
        tables = {}
        for name, size in (("doc_id", "docs"), ("end", "docs"), ("offset", "blocks"), ("escaped", "blocks"), ("words", "words")):
            tables[name] = words[at : at + head[size]]
            at += head[size]
        if content[8 * at : 8 * at + 8] != TRAILER:
            raise ValueError(f"no trailer at byte {8 * at}")
        at += 1
        yield head, tables, tables.pop("words").view(np.uint64)


def segment_ids(head: dict[str, int], tables: Index, words: np.ndarray) -> np.ndarray:
    """All ids of a segment, block after block."""
    out, size = np.empty(head["ids"], np.uint64), head["block_ids"]
    ends = np.append(tables["offset"][1:], head["words"])
    for b, (start, end, escaped) in enumerate(zip(tables["offset"], ends, tables["escaped"])):
        n = min(size, head["ids"] - b * size)
        out[b * size : b * size + n] = unpack_block(words[start:end], int(escaped), n)
    return out


# -- the library's ids


class _Cache:
    """Ids of words met before, as bytes. When it is full it becomes the older generation, so frequent words stay."""

    def __init__(self, encode: Callable[[list[bytes]], list[bytes]]):
        self._encode, self._words, self._older = encode, {}, {}

    def of(self, words: list[bytes]) -> list[bytes]:
        """Ids of distinct words; those not met before are encoded together."""
        made = list(map(self._words.get, words))
        missed = [word for word, ids in zip(words, made) if ids is None]
        if not missed:
            return made
        found = {word: ids for word in missed if (ids := self._older.get(word)) is not None}
        new = [word for word in missed if word not in found]
        found.update(zip(new, self._encode(new)))
        if len(self._words) + len(found) > CACHED_WORDS:
            self._words, self._older = {}, self._words
        self._words.update(islice(found.items(), CACHED_WORDS))
        return [found[word] if ids is None else ids for word, ids in zip(words, made)]


#: What a code point is to the vocabulary's pattern; MARK stands behind every text.
OTHER, BLANK, NUMBER, LETTER, MARK = range(5)


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """Kind of every code point, as the matcher of ``bpe.SPLIT`` has it."""
    points = np.arange(sys.maxunicode + 1, dtype="<u4").tobytes().decode("utf-32-le", "surrogatepass")
    kinds = np.full(len(points), OTHER, np.uint8)
    for kind, pattern in ((BLANK, r"\s+"), (NUMBER, r"\p{N}+"), (LETTER, r"\p{L}+")):
        for run in regex.finditer(pattern, points):
            kinds[run.start() : run.end()] = kind
    return kinds


def word_starts(points: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Where the words of ``bpe.SPLIT`` start in code points of texts, for all texts at once.

    Each text ends with one more code point, at ``marks``, which counts as a word.
    """
    kinds = _kinds()[points]
    kinds[marks] = MARK
    starts = np.append(True, kinds[1:] != kinds[:-1])
    starts[marks] = True
    # the last white space before a word stands alone; a space goes with the word
    last = np.flatnonzero((kinds[:-1] == BLANK) & (kinds[1:] != BLANK) & (kinds[1:] != MARK))
    starts[last] = True
    starts[last[points[last] == ord(" ")] + 1] = False
    # an apostrophe that starts a word takes the letters of a contraction from those behind it
    quotes = np.flatnonzero(points == ord("'"))
    quotes = quotes[starts[quotes] & (kinds[quotes + 1] == LETTER)]
    one, two = points[quotes + 1], points[quotes + 2]
    long = np.isin(one, [ord("r"), ord("v")]) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
    taken = np.where(long, 2, np.isin(one, [ord(c) for c in "stmd"]))
    quotes, taken = quotes[taken > 0], taken[taken > 0]
    starts[quotes + 1] = False
    starts[quotes + 1 + taken] = True
    return starts


class LibraryIds:
    """Ids of the tokenizers library for a byte-level vocabulary.

    The library's model merges each distinct word once; words are split off by the vocabulary's pattern, those of many
    texts at once, and each distinct one among them is looked up once. Only texts that hold special tokens go through
    the library whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks share the cores already
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_file(path)
        self._library.no_truncation()
        self._library.no_padding()
        specials = [t.content for t in self._library.get_added_tokens_decoder().values()]
        self._special = regex.compile("|".join(map(regex.escape, specials))) if specials else None
        self._cut = regex.compile(r"(?<=\S)[ \n]")
        self._model = model = self._library.model
        self._symbols = dict(enumerate(byte_symbols()))
        between = self._symbols[BETWEEN[0]]
        plain = not (model.ignore_merges or model.continuing_subword_prefix or model.end_of_word_suffix)
        holders = [id for token, id in self._library.get_vocab(False).items() if between in token]
        self._between = model.token_to_id(between) if plain and len(holders) == 1 else None
        self._cache = _Cache(self._merged)

    def _whole(self, text: str) -> bytes:
        return np.array(self._library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _tokens(self, word: bytes) -> list[int]:
        return [token.id for token in self._model.tokenize(word.decode("latin-1").translate(self._symbols))]

    def _merged(self, words: list[bytes]) -> list[bytes]:
        """Ids of words by the library's model, some words in a call: it merges nothing with the byte between them."""
        if self._between is None:
            return [np.array(self._tokens(word), "<u4").tobytes() for word in words]
        ids = []
        for i in range(0, len(words), JOINED_WORDS):
            ids += self._tokens(BETWEEN.join(words[i : i + JOINED_WORDS]))
            ids.append(self._between)
        ids = np.array(ids, "<u4")
        ends, ids = (4 * np.flatnonzero(ids == self._between)).tolist(), ids.tobytes()
        return [ids[a:b] for a, b in zip([0, *(end + 4 for end in ends)], ends)]

    def _parts(self, text: str) -> Iterator[str]:
        start = 0
        while len(text) - start > PART_CHARS and (cut := self._cut.search(text, start + PART_CHARS)):
            yield text[start : cut.start()]
            start = cut.start()
        yield text[start:]

    def _split(self, texts: list[str]) -> list[bytes]:
        """Ids of every text, none of which holds a special token."""
        if not texts:
            return []
        joined = "".join(f"{t}\0" for t in texts)
        points = np.frombuffer(joined.encode("utf-32-le"), "<u4")
        marks = np.cumsum([len(t) + 1 for t in texts]) - 1
        starts = np.flatnonzero(word_starts(points, marks))
        offsets, marks = starts, np.searchsorted(starts, marks)
        if not joined.isascii():
            sizes = np.ones(len(points), np.uint8)
            for more in (0x80, 0x800, 0x10000):
                sizes += points >= more
            offsets = np.cumsum(sizes, dtype=np.int64)[starts] - sizes[starts]
        data = joined.encode()
        buffers = [None, pa.py_buffer(np.append(offsets, len(data)).astype(np.int64)), pa.py_buffer(data)]
        words = pa.Array.from_buffers(pa.large_binary(), len(starts), buffers).dictionary_encode()
        made = self._cache.of(words.dictionary.to_numpy(zero_copy_only=False).tolist())
        sizes = np.fromiter(map(len, made), np.int64, len(made)) // 4
        word = words.indices.to_numpy()
        counts = sizes[word]
        counts[marks] = 0
        ends = np.cumsum(counts)
        firsts = (np.cumsum(sizes) - sizes)[word]
        at = np.repeat(firsts - ends + counts, counts) + np.arange(ends[-1])
        ids = np.frombuffer(b"".join(made), "<u4")[at].tobytes()
        cuts = (4 * ends[marks]).tolist()
        return [ids[a:b] for a, b in zip([0, *cuts], cuts)]

    def encode_many(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """Ids of whole texts, each as little-endian unsigned 32-bit integers. A text with special tokens isn't split."""
        group, chars = [], 0
        for text in texts:
            text = text or ""
            special = self._special and self._special.search(text)
            alone = special or len(text) > PART_CHARS
            if alone or chars + len(text) > PART_CHARS:
                yield from self._split(group)
                group, chars = [], 0
            if special:
                yield self._whole(text)
            elif alone:
                yield b"".join(self._split([part])[0] for part in self._parts(text))
            else:
                group.append(text)
                chars += len(text)
        yield from self._split(group)

    def encode(self, text: str | None) -> bytes:
        return next(self.encode_many([text]))


@lru_cache(maxsize=2)
def library(path: str) -> LibraryIds:
    return LibraryIds(path)


# -- files


def write_token_files(docs: DataFrame, folder: str, path: str, end_id: int = 0, text: str = "text", files: int | None = None) -> None:
    """Write the ids of ``docs`` (doc_id as an integer, ``text``) to new files in ``folder``.

    ``files`` follows the size of the texts if it isn't given. Texts cross one shuffle, ids none. Rows of one doc_id
    may fill several files, so copies of a single row don't all land in one task.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"))
    if files is None:
        size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        files = max(task_partitions(docs), -(-size // FILE_TEXT_BYTES))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.col("text"), F.col("row")]
    rows = docs.withColumn("row", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(files, *(order[i] for i in (0, 1, 3))).sortWithinPartitions(*order)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end, file = np.array([end_id], "<u4").tobytes(), TaskContext.get().partitionId()
        encode_many = library(path).encode_many
        doc_ids, parts, size = [], [], 0

        def segment() -> pa.RecordBatch:
            lengths = [len(p) // 4 for p in parts]
            made = write_segment(file, doc_ids, lengths, np.frombuffer(b"".join(parts), "<u4"))
            return pa.RecordBatch.from_arrays([pa.array([made], pa.binary())], names=["segment"])

        for batch in batches:
            texts = (text.as_py() for text in batch.column("text"))
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encode_many(texts)):
                doc_ids.append(doc_id)
                parts.append(ids + end)
                size += len(parts[-1]) // 4
                if size >= SEGMENT_IDS:
                    yield segment()
                    doc_ids, parts, size = [], [], 0
        if doc_ids:
            yield segment()

    made = rows.select("doc_id", "text").mapInArrow(encoded, "segment binary")
    made.select(F.col("segment").cast("string").alias("value")).write.text(folder, lineSep="\n")


def _of_files(spark: SparkSession, folder: str, schema: str, read: Callable[[memoryview], Iterator[dict[str, list]]]) -> DataFrame:
    found = spark.read.format("binaryFile").load(folder).select("content")

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                for made in read(memoryview(content.as_buffer())):
                    yield pa.RecordBatch.from_pydict(made)

    return found.mapInArrow(of, schema)


def file_index(spark: SparkSession, folder: str) -> DataFrame:
    """Every file's number, its documents and ids, and ``start``: the ids in all files before it.

    Heads alone are looked at. There is one row for each file; their running sum takes two levels, so that no task
    sees more than the files of one slice, or one row for each slice of 1,024 files.
    """

    def heads(content: memoryview) -> Iterator[dict[str, list]]:
        found = [head for head, _, _ in segments(content)]
        if found:
            yield {
                "file": pa.array([found[0]["file"]], pa.int32()),
                "docs": pa.array([sum(h["docs"] for h in found)], pa.int64()),
                "ids": pa.array([sum(h["ids"] for h in found)], pa.int64()),
            }

    files = materialise(_of_files(spark, folder, "file int, docs long, ids long", heads), "files")
    files = files.withColumn("slice", F.col("file").bitwiseAND(~1023))
    slices = files.groupBy("slice").agg(F.sum("ids").alias("slice_ids"))
    earlier = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    base = slices.select("slice", F.coalesce(F.sum("slice_ids").over(earlier), F.lit(0)).alias("base"))
    before = Window.partitionBy("slice").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("ids").over(before), F.lit(0))
    return files.join(base, "slice").select("file", "docs", "ids", (F.col("base") + inside).alias("start"))


def read_token_files(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """Documents of the files: doc_id, start, n_tokens, ids_crc32, and with ``with_ids`` the ids themselves.

    ``start`` counts the ids of all documents before, over all files; n_tokens and ids_crc32 (of the ids as
    little-endian unsigned 32-bit integers) include the end id.
    """
    ids_too = ", ids array<long>" if with_ids else ""

    def documents(content: memoryview) -> Iterator[dict[str, list]]:
        start = 0
        for head, tables, words in segments(content):
            ids = segment_ids(head, tables, words)
            ends = tables["end"]
            starts = np.append(0, ends[:-1])
            raw = memoryview(ids.astype("<u4").tobytes())
            null = np.arange(head["docs"]) < head["null_docs"]
            made = {
                "doc_id": pa.array(tables["doc_id"], pa.int64(), mask=null),
                "file": pa.array(np.full(head["docs"], head["file"], np.int32)),
                "start": pa.array(start + starts),
                "n_tokens": pa.array(ends - starts),
                "ids_crc32": pa.array([zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts, ends)], pa.int64()),
            }
            if with_ids:
                made["ids"] = pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(ids.astype(np.int64)))
            start += head["ids"]
            yield made

    schema = f"doc_id long, file int, start long, n_tokens long, ids_crc32 long{ids_too}"
    found = _of_files(spark, folder, schema, documents)
    base = file_index(spark, folder).select("file", F.col("start").alias("base"))
    return found.join(base, "file").withColumn("start", F.col("start") + F.col("base")).drop("file", "base")
