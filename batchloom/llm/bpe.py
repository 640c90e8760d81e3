"""Byte-level BPE by forced-boundary splitting.

A merge can only join two neighbouring bytes if some token of the vocabulary holds that byte pair. A pair
that no token holds is therefore a certain cut: the fragments on both sides are merged independently and
their ids concatenated, with the same result as merging the whole word.

Null and empty texts have no ids and decode to the empty text. Texts of any length are encoded in segments
that end before white space, which no token of the pre-splitting pattern crosses, so memory follows the
segment and the ids. Repeated rows are encoded alike. Other columns pass through untouched.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import regex
from pyspark.sql import DataFrame

from batchloom.llm.common import with_made

#: Published pre-splitting pattern of this family of tokenizers (fixed value).
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: The same for ASCII texts, where the standard library's matcher reads it in fewer steps.
SPLIT_ASCII = r"'(?:[stmd]|re|ve|ll)| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+"

SEGMENT_CHARS = 1_000_000
CACHED_WORDS = 200_000
#: Bytes up to which a scan beats a heap, and a rank above all others.
SHORT, NO_RANK = 48, 1 << 40


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary file.

    Printable Latin-1 characters stand for themselves; the rest take the code points from 256 on, in order.
    """
    own = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    spare = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


class _Words(dict):
    """Ids of words met before. When it is full it becomes the older generation, so frequent words stay."""

    def __init__(self, encode_word):
        self._encode_word = encode_word
        self._older: dict[str, tuple[int, ...]] = {}

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= CACHED_WORDS:
            self._older = dict(self)
            self.clear()
        ids = self._older.get(word)
        if ids is None:
            ids = self._encode_word(word.encode("utf-8", "replace"))
        self[word] = ids
        return ids


class ForcedBoundaryBpe:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        value = {s: b for b, s in enumerate(byte_symbols())}
        vocab: dict[str, int] = spec["model"]["vocab"]
        specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of = {i: bytes(value[c] for c in t) for t, i in vocab.items() if t not in specials}
        self.inside = {pair for token in self.bytes_of.values() for pair in zip(token, token[1:])}
        self.byte_id = [vocab.get(s) for s in byte_symbols()]
        pairs = (m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"])
        pairs = list(pairs)
        self.merged = [vocab[a + b] for a, b in pairs]
        self.rank = {(vocab[a], vocab[b]): rank for rank, (a, b) in enumerate(pairs)}
        plain = all(i is not None and i < 256 for i in self.byte_id)
        self.byte_table = bytes(self.byte_id) if plain else None
        self.bytes_of |= {i: t.encode() for t, i in specials.items()}
        self.specials = specials
        found = "|".join(regex.escape(t) for t in sorted(specials, key=len, reverse=True))
        self._special = regex.compile(f"({found})") if found else None
        self._find = regex.compile(SPLIT).findall
        self._find_ascii = re.compile(SPLIT_ASCII, re.ASCII).findall
        self._cut = regex.compile(r"(?<=\S)[ \n]")
        self._words = _Words(self.encode_word)

    def fragments(self, word: bytes) -> list[bytes]:
        """``word`` cut at every byte pair that no token holds."""
        inside, start, parts = self.inside, 0, []
        pairs = list(zip(word, word[1:]))
        if inside.issuperset(pairs):
            return [word]
        for i, pair in enumerate(pairs, 1):
            if pair not in inside:
                parts.append(word[start:i])
                start = i
        parts.append(word[start:])
        return parts

    def merge(self, fragment: bytes) -> list[int]:
        """Merges by rank, leftmost first."""
        return self._merge_short(fragment) if len(fragment) <= SHORT else self._merge_long(fragment)

    def _merge_short(self, fragment: bytes) -> list[int]:
        """Scans a list of ranks for the least: quickest for words of usual length."""
        rank, merged = self.rank.get, self.merged
        ids = [self.byte_id[b] for b in fragment] if self.byte_table is None else list(fragment.translate(self.byte_table))
        ranks = [rank(p, NO_RANK) for p in zip(ids, ids[1:])]
        while ranks and (least := min(ranks)) < NO_RANK:
            i = ranks.index(least)
            ids[i : i + 2] = (merged[least],)
            del ranks[i]
            if i:
                ranks[i - 1] = rank((ids[i - 1], ids[i]), NO_RANK)
            if i < len(ranks):
                ranks[i] = rank((ids[i], ids[i + 1]), NO_RANK)
        return ids

    def _merge_long(self, fragment: bytes) -> list[int]:
        """A linked list with a heap: n log n for any length."""
        ids: list[int | None] = [self.byte_id[b] for b in fragment]
        n, ranks, merged = len(ids), self.rank, self.merged
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(ranks[p], i, p) for i, p in enumerate(zip(ids, ids[1:])) if p in ranks]
        heapq.heapify(heap)
        while heap:
            rank, i, pair = heapq.heappop(heap)
            j = after[i]
            if j >= n or (ids[i], ids[j]) != pair:
                continue  # one of the two was merged elsewhere meanwhile
            ids[i], ids[j], after[i] = merged[rank], None, after[j]
            if after[j] < n:
                before[after[j]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right < n and (p := (ids[left], ids[right])) in ranks:
                    heapq.heappush(heap, (ranks[p], left, p))
        return [i for i in ids if i is not None]

    def encode_word(self, word: bytes) -> tuple[int, ...]:
        return tuple(chain.from_iterable(map(self.merge, self.fragments(word))))

    def _segments(self, text: str) -> Iterator[str]:
        start = 0
        while len(text) - start > SEGMENT_CHARS and (cut := self._cut.search(text, start + SEGMENT_CHARS)):
            yield text[start : cut.start()]
            start = cut.start()
        yield text[start:]

    def encode(self, text: str | None) -> list[int]:
        ids: list[int] = []
        for part in self._special.split(text or "") if self._special else [text or ""]:
            if part in self.specials:
                ids.append(self.specials[part])
            else:
                for segment in self._segments(part):
                    words = (self._find_ascii if segment.isascii() else self._find)(segment)
                    ids.extend(chain.from_iterable(map(self._words.__getitem__, words)))
        return ids

    def decode(self, ids: list[int] | None) -> str:
        return b"".join(map(self.bytes_of.__getitem__, [] if ids is None else ids)).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def loaded(path: str) -> ForcedBoundaryBpe:
    return ForcedBoundaryBpe(path)


def encode_documents(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the token ids of ``text`` in a column ``ids`` (replaced if it exists).

    The vocabulary file must be at ``path`` on every executor.
    """
    return with_made(docs, [text], lambda texts: [list(map(loaded(path).encode, texts))], f"`{ids}` array<int>")


def decode_documents(encoded: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``encoded`` with the text of its token ids in a column ``text`` (replaced if it exists)."""
    return with_made(encoded, [ids], lambda lists: [list(map(loaded(path).decode, lists))], f"`{text}` string")


def encode_and_decode(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` with columns ``ids`` and ``decoded`` (replaced if they exist) from one pass over ``text``."""

    def both(texts: list[str | None]) -> list[list]:
        bpe = loaded(path)
        ids = list(map(bpe.encode, texts))
        return [ids, list(map(bpe.decode, ids))]

    return with_made(docs, [text], both, "ids array<int>, decoded string")
