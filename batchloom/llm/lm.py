"""Scoring by a bigram language model with deleted interpolation.

P(w | v) mixes three estimates: uniform over the vocabulary and one unknown word, the unigram share of w, and the
share of w among what follows v. The weights depend on how frequent v is, in buckets of powers of two, and are
learned by expectation-maximisation on held-out counts: every occurrence in the learning documents is
predicted from the counts without itself. A text is its words, A-Z in lower case, then one end; the end
is also what comes before the first word.

Counts cover all learning documents. Documents are packed into chunks of tokens; each chunk sends the sorted
64-bit keys of its distinct words and bigrams, with their counts, to ranges of the key space, where totals are
formed and sent back to the chunks that asked. So a frequent word travels once per chunk, no task holds more
than a range, and neither the vocabulary nor the bigrams meet in one place. Keys and totals travel as
compressed arrays. The weights need a table of binned held-out counts, which has a fixed size.

Null and empty texts are just an end. Documents with a null id are scored, but neither learned from nor held
out. Repeated rows count each time. With nothing to learn from every probability is 1. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchloom.llm.common import id_remainder, words_of
from batchloom.storage import materialise

CHUNK_TOKENS = 1_000_000
RANGE_KEYS = 1_500_000
BUCKETS = 24
BINS = 128
PER_OCTAVE = 3

_END = np.uint64(xxhash.xxh64_intdigest(b"\n"))
_CHUNK = "chunk string, ids array<bigint>, learn array<boolean>, held array<boolean>, n array<int>, words binary, tokens binary"


def pack(values: np.ndarray) -> bytes:
    """An array as compressed byte planes: the high bytes of sorted keys and small numbers shrink to little."""
    planes = values.reshape(-1, 1).view(np.uint8).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpack(data: bytes, dtype: str) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8)
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(raw.reshape(width, -1).T).reshape(-1).view(dtype)


def bigram_keys(before: np.ndarray, words: np.ndarray) -> np.ndarray:
    """A 64-bit key for each pair of word hashes."""
    x = (before * np.uint64(0x9E3779B97F4A7C15)) ^ (words + (before >> np.uint64(29)))
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _pack_chunks(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    context, made = TaskContext.get(), 0
    ids, learn, held, lengths, tokens = [], [], [], [], []
    local: dict[bytes, int] = {}

    def chunk() -> pd.DataFrame:
        nonlocal made
        name = f"{context.partitionId() if context else 0}-{made}"
        made += 1
        hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in local), dtype=np.uint64, count=len(local))
        flat = np.concatenate(tokens) if tokens else np.zeros(0, np.int32)
        row = (name, list(ids), list(learn), list(held), list(lengths), pack(hashes), pack(flat))
        for used in (ids, learn, held, lengths, tokens, local):
            used.clear()
        return pd.DataFrame([row], columns=[c.split()[0] for c in _CHUNK.split(", ")])

    total = 0
    for part in parts:
        for doc, text, learned, out in zip(part["id"], part["text"], part["learn"], part["held"]):
            words = words_of(text)
            at = np.fromiter((local.setdefault(w, len(local)) for w in words), dtype=np.int32, count=len(words))
            ids.append(None if pd.isna(doc) else int(doc))
            learn.append(bool(learned))
            held.append(bool(out))
            lengths.append(len(words))
            tokens.append(at)
            total += len(words)
            if total >= CHUNK_TOKENS:
                yield chunk()
                total = 0
    if ids:
        yield chunk()


class Chunk:
    """A chunk row with its distinct words and bigrams, each sorted by key."""

    def __init__(self, row):
        self.ids, self.learn, self.held = list(row.ids), np.asarray(row.learn, bool), np.asarray(row.held, bool)
        n = np.asarray(row.n, dtype=np.int64)
        hashes = np.append(unpack(row.words, "<u8"), _END)
        local = unpack(row.tokens, "<i4") if n.sum() else np.zeros(0, np.int32)
        ends = np.cumsum(n + 1) - 1
        flat = np.full(int(n.sum()) + len(n), len(hashes) - 1, dtype=np.int64)
        inner = np.ones(len(flat), dtype=bool)
        inner[ends] = False
        flat[inner] = local
        self.doc = np.repeat(np.arange(len(n)), n + 1)
        order = np.argsort(hashes, kind="stable")
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        self.words, self.word = hashes[order], place[flat]
        self.before = np.concatenate(([place[len(hashes) - 1]], self.word[:-1]))
        pairs = bigram_keys(self.words[self.before], self.words[self.word])
        self.pairs, self.pair = np.unique(pairs, return_inverse=True)
        self.learned = self.learn[self.doc]

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        """How often each distinct word and bigram stands in learning documents."""
        return (
            np.bincount(self.word[self.learned], minlength=len(self.words)),
            np.bincount(self.pair[self.learned], minlength=len(self.pairs)),
        )


def _requests(ranges_log2: int):
    shift = np.uint64(64 - ranges_log2)

    def of(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for row in part.itertuples():
                chunk, rows = Chunk(row), []
                for kind, keys, n in zip((0, 1), (chunk.words, chunk.pairs), chunk.counts()):
                    at = (keys >> shift).astype(np.int64)
                    for a, b in zip(*_runs(at)):
                        rows.append((kind, int(at[a]), row.chunk, pack(keys[a:b]), pack(n[a:b].astype("<u4"))))
                yield pd.DataFrame(rows, columns=["kind", "range", "chunk", "keys", "n"])

    return of


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    cuts = np.flatnonzero(np.diff(values)) + 1
    return np.concatenate(([0], cuts)), np.append(cuts, len(values))


def _totals(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
    """Answers to the requests of one range, and a row without a chunk for the number of known keys."""
    part = part.sort_values("chunk", kind="stable")
    keys = [unpack(k, "<u8") for k in part["keys"]]
    n = np.concatenate([unpack(x, "<u4") for x in part["n"]]).astype(np.int64)
    found, where = np.unique(np.concatenate(keys), return_inverse=True)
    totals = np.zeros(len(found), dtype=np.int64)
    np.add.at(totals, where, n)
    answers = np.split(totals[where], np.cumsum([len(k) for k in keys])[:-1])
    rows = [(c, key[0], key[1], pack(a.astype("<u8")), None) for c, a in zip(part["chunk"], answers)]
    rows.append((None, key[0], key[1], None, int((totals > 0).sum())))
    return pd.DataFrame(rows, columns=["chunk", "kind", "range", "totals", "known"])


def _resolved(chunk: Chunk, answers: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every token: counts of the word, of the bigram and of what stands before."""
    answers = answers.sort_values(["kind", "range"])
    word, pair = (
        np.concatenate([unpack(t, "<u8") for t in answers.loc[answers["kind"] == k, "totals"]]).astype(np.float64)
        for k in (0, 1)
    )
    return word[chunk.word], pair[chunk.pair], word[chunk.before]


def estimates(word, pair, before, total: float, types: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket, unigram and bigram estimate of every token."""
    bucket = np.minimum(np.log2(np.maximum(before, 0) + 1).astype(np.int64), BUCKETS - 1)
    return bucket, word / max(total, 1), np.divide(pair, before, out=np.zeros_like(pair), where=before > 0)


def _bin(p: np.ndarray, base: float) -> np.ndarray:
    """0 for none, else steps of 1 / PER_OCTAVE octave above and below the uniform estimate."""
    octaves = np.log2(np.maximum(p, 1e-300) / base)
    return np.where(p > 0, np.clip(np.rint(octaves * PER_OCTAVE) + BINS // 3, 1, BINS - 1), 0).astype(np.int64)


def _bin_ratio(bins: np.ndarray) -> np.ndarray:
    return np.where(bins > 0, np.exp2((bins - BINS // 3) / PER_OCTAVE), 0.0)


def learn_weights(cells: np.ndarray, n: np.ndarray, rounds: int = 100) -> np.ndarray:
    """Weights (bucket, estimate) by EM over binned held-out counts; buckets without any rely on the uniform."""
    weights = np.tile([1 / 3, 1 / 3, 1 / 3], (BUCKETS, 1))
    bucket, one, two = cells // BINS**2, cells // BINS % BINS, cells % BINS
    ratio = np.column_stack((np.ones(len(cells)), _bin_ratio(one), _bin_ratio(two)))
    for _ in range(rounds):
        share = weights[bucket] * ratio
        share *= (n / share.sum(axis=1))[:, None]
        sums = np.column_stack([np.bincount(bucket, share[:, k], minlength=BUCKETS) for k in range(3)])
        mass = sums.sum(axis=1, keepdims=True)
        weights = np.where(mass > 0, sums / np.maximum(mass, 1e-300), [[1.0, 0.0, 0.0]])
    weights = np.maximum(weights, [1e-6, 0, 0])
    return weights / weights.sum(axis=1, keepdims=True)


def scores(docs: DataFrame, id_col: str = "doc_id", text: str = "text", modulus: int = 10) -> DataFrame:
    """One row per document: id_col, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    rest = id_remainder(F.col(id_col), modulus)
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.col(text).alias("text"),
        F.coalesce(rest != 0, F.lit(False)).alias("learn"),
        F.coalesce(rest == 0, F.lit(False)).alias("held"),
    )
    chunks = materialise(rows.mapInPandas(_pack_chunks, _CHUNK), "lm-chunks")
    sizes = F.transform(F.arrays_zip("n", "learn"), lambda x: F.struct((x["n"] + 1).cast("long").alias("n"), x["learn"]))
    each = chunks.select(F.explode(sizes).alias("x")).select("x.*")
    size = each.agg(F.sum("n").alias("all"), F.sum(F.when(F.col("learn"), F.col("n"))).alias("learn")).collect()[0]
    total = size["learn"] or 0
    ranges_log2 = max(5, int(np.ceil(np.log2(max(1, (size["all"] or 0) / RANGE_KEYS)))))
    asked = chunks.mapInPandas(
        _requests(ranges_log2), "kind int, range int, chunk string, keys binary, n binary"
    )
    answers = asked.groupBy("kind", "range").applyInPandas(
        _totals, "chunk string, kind int, range int, totals binary, known long"
    )
    answers = materialise(answers, "lm-totals")
    types = answers.where("chunk IS NULL AND kind = 0").agg(F.sum("known")).collect()[0][0] or 0
    asked_back = answers.where("chunk IS NOT NULL").select("chunk", "kind", "range", "totals").groupBy("chunk")
    base = 1 / (types + 1)

    def held_out_counts(_, part: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        cells = np.zeros(0, np.int64)
        for row in part.itertuples():
            chunk = Chunk(row)
            word, pair, before = (x[chunk.learned] - 1 for x in _resolved(chunk, found))
            bucket, one, two = estimates(word, pair, before, total - 1, types)
            cells = np.concatenate((cells, (bucket * BINS + _bin(one, base)) * BINS + _bin(two, base)))
        cell, n = np.unique(cells, return_counts=True)
        return pd.DataFrame({"cell": cell, "n": n})

    binned = chunks.groupBy("chunk").cogroup(asked_back).applyInPandas(held_out_counts, "cell long, n long")
    binned = binned.groupBy("cell").agg(F.sum("n").alias("n")).orderBy("cell").toPandas()  # BUCKETS * BINS^2 rows at most
    weights = learn_weights(binned["cell"].to_numpy(np.int64), binned["n"].to_numpy(np.float64))

    def score(_, part: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row in part.itertuples():
            chunk = Chunk(row)
            word, pair, before = _resolved(chunk, found)
            bucket, one, two = estimates(word, pair, before, total, types)
            w = weights[bucket]
            p = np.log10(w[:, 0] * base + w[:, 1] * one + w[:, 2] * two) if total else np.zeros(len(word))
            plain = np.log10((word + 0.1) / (total + 0.1 * (types + 1)))
            docs_ = len(chunk.ids)
            out.append(
                pd.DataFrame(
                    {
                        "id": pd.array(chunk.ids, dtype="Int64"),
                        "held_out": chunk.held,
                        "n_tokens": np.bincount(chunk.doc, minlength=docs_),
                        "n_known": np.bincount(chunk.doc, word > 0, minlength=docs_).astype(np.int64),
                        "train_tokens": total,
                        "base_score": np.bincount(chunk.doc, plain, minlength=docs_),
                        "score": np.bincount(chunk.doc, p, minlength=docs_),
                    }
                )
            )
        return pd.concat(out)

    return (
        chunks.groupBy("chunk")
        .cogroup(answers.where("chunk IS NOT NULL").select("chunk", "kind", "range", "totals").groupBy("chunk"))
        .applyInPandas(
            score,
            "id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
        )
        .withColumnRenamed("id", id_col)
    )
