"""Quality rules: features of a text, and lines that too many documents of a host share.

Lines are normalised (A-Z in lower case, white space runs as one space) and hashed. A line of a host is
boilerplate when it stands in at least ``min_documents`` different texts of the host and in more than ``max_share`` of
them; texts count once, so exact copies don't make their own lines boilerplate. Such lines are removed, and
a document is rejected when they held more than ``max_removed`` of its words. Documents that fail a base rule
(too few words, too many words in repeated three-word windows) are rejected too.

A null text has no words and no lines and fails; a null host is a host of its own. Equal rows get equal
verdicts. Hot hosts are counted by (host, line, text) first, with map-side sums, and a host has at most
lines-per-document / max_share boilerplate lines, so its list stays short however large the host is.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchloom.llm.common import SPACE, with_made
from batchloom.storage import materialise

SYMBOLS = "#*$%&|<>"

FEATURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_removed_words long, "
    "cleaned string"
)


@dataclass(frozen=True)
class Limits:
    min_words: int = 50
    max_repeat_share: float = 0.5
    min_documents: int = 20
    max_share: float = 0.1
    max_removed: float = 0.5


def repeat_words(words: list[bytes]) -> int:
    """Words that lie in a three-word window found twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    total, upto = 0, 0
    for i, window in enumerate(windows):
        if counts[window] > 1:
            total += i + 3 - max(i, upto)
            upto = i + 3
    return total


def line_keys(text: str) -> list[tuple[int, int]]:
    """Signed hash and number of words of every line, 0 words for blank lines."""
    keys = []
    for line in text.encode("utf-8", "replace").lower().split(b"\n"):
        words = line.split()
        value = xxhash.xxh64_intdigest(b" ".join(words), seed=42)
        keys.append((value - (1 << 64) if value >> 63 else value, len(words)))
    return keys


def features(text: str | None, boilerplate: frozenset[int]) -> tuple:
    """A row of FEATURES."""
    if text is None:
        return 0, 0, 0, 0, 0, 0, None
    words = text.encode("utf-8", "replace").split()
    lines = [x for x in text.split("\n") if x.strip(SPACE)]
    removed, cleaned = 0, text
    if boilerplate:
        keys = line_keys(text)
        gone = [n > 0 and key in boilerplate for key, n in keys]
        removed = sum(n for (_, n), out in zip(keys, gone) if out)
        if removed:
            cleaned = "\n".join(line for line, out in zip(text.split("\n"), gone) if not out)
    return (
        len(words),
        len(text) - sum(map(text.count, SPACE)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeat_words(words),
        removed,
        cleaned,
    )


def _line_rows(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for part in parts:
        rows = []
        for host, text in zip(part["host"], part["text"]):
            if text is not None:
                of_text = xxhash.xxh64_intdigest(text.encode("utf-8", "replace"), seed=42) - (1 << 63)
                rows.append((host, None, of_text))
                rows.extend((host, key, of_text) for key in {k for k, n in line_keys(text) if n})
        yield pd.DataFrame(
            {
                "host": pd.Series([r[0] for r in rows], dtype=object),
                "line": pd.array([r[1] for r in rows], dtype="Int64"),
                "of_text": pd.Series([r[2] for r in rows], dtype="int64"),
            }
        )


def boilerplate_lines(docs: DataFrame, host: str = "source", text: str = "text", limits: Limits = Limits()) -> DataFrame:
    """Rows (host, lines): hashes of the lines that are above the limits on a host."""
    rows = docs.select(F.col(host).cast("string").alias("host"), F.col(text).alias("text")).mapInPandas(
        _line_rows, "host string, line long, of_text long"
    )
    counts = rows.groupBy("host", "line").agg(F.count_distinct("of_text").alias("n"))
    counts = materialise(counts.where((F.col("n") >= limits.min_documents) | F.col("line").isNull()), "line-counts")
    totals = counts.where("line IS NULL").select(F.col("host").alias("of"), F.col("n").alias("texts"))
    above = counts.where("line IS NOT NULL").join(totals, F.col("host").eqNullSafe(F.col("of")))
    above = above.where(F.col("n") > F.col("texts") * limits.max_share)
    return materialise(above.groupBy("host").agg(F.collect_set("line").alias("lines")), "boilerplate")


def _features(texts: list[str | None], lines: list[list[int] | None]) -> list[list]:
    sets: dict[tuple[int, ...], frozenset[int]] = {}
    rows = []
    for text, listed in zip(texts, lines):
        key = tuple(listed or ())
        rows.append(features(text, sets.setdefault(key, frozenset(key))))
    return list(map(list, zip(*rows)))


def quality(docs: DataFrame, host: str = "source", text: str = "text", limits: Limits = Limits()) -> DataFrame:
    """``docs`` with a column ``quality``: FEATURES, base_failed and kept."""
    by_host = boilerplate_lines(docs, host, text, limits).select(
        F.col("host").alias("__quality_host"), F.col("lines").alias("__quality_lines")
    )
    found = docs.join(by_host, docs[host].cast("string").eqNullSafe(by_host["__quality_host"]), "left")
    names = [f.split()[0] for f in FEATURES.split(", ")]
    made = ", ".join(f"__quality_{f}" for f in FEATURES.split(", "))
    found = with_made(found, [text, "__quality_lines"], _features, made)
    q = F.struct(*(F.col(f"__quality_{n}").alias(n) for n in names))
    failed = (q["n_words"] < limits.min_words) | (q["n_repeat_words"] > limits.max_repeat_share * q["n_words"])
    depleted = q["n_removed_words"] > limits.max_removed * q["n_words"]
    judged = q.withField("base_failed", failed).withField("kept", ~failed & ~depleted)
    found = found.withColumn("quality", judged)
    return found.drop("__quality_host", "__quality_lines", *(f"__quality_{n}" for n in names))


def kept_documents(docs: DataFrame, host: str = "source", limits: Limits = Limits()) -> DataFrame:
    """The documents that pass, without their boilerplate lines; ``n_chars`` follows where it exists."""
    cleaned = F.col("quality")["cleaned"]
    columns: list[Column] = [
        cleaned.alias("text") if c == "text" else F.length(cleaned).cast(t).alias(c) if c == "n_chars" else F.col(f"`{c}`")
        for c, t in docs.dtypes
    ]
    return quality(docs, host, "text", limits).where("quality.kept").select(*columns)
