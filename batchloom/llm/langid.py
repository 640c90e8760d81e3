"""Language identification by prediction by partial matching over bytes.

Every language has a context tree of order 0 to ``ORDER``: counts of the byte that follows each context. A byte is
coded in the longest context that the language knows; if it never followed there, an escape is coded and the next
shorter context tried, down to a uniform code over all bytes (method C: the escape has the weight of the number
of distinct followers). Statistics are frozen, so the code length of a byte depends only on itself and the bytes
before it. For all contexts of all languages together these lengths are put into a table once, and the exact code
length of a text under every language is a sum of table entries. The shortest code wins; ties go to the
language that sorts first. The score is the posterior with equal priors.

Trees are learned from at most ``SAMPLE_DOCS`` documents of each language, taken by the hash of the id; predictions
cover whole texts, with A-Z in lower case. Contexts seen fewer than ``MIN_CONTEXT`` times are pruned. Null texts and
texts without a letter are ``und`` with score 0, and so is everything when nothing can be learned. Equal texts
get equal results; null ids are never learned from.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from batchloom.llm.common import has_letter
from batchloom.storage import materialise

ORDER = 3
SAMPLE_DOCS = 1_000
MIN_CONTEXT = 20
FORMAT = "lang_pred string, score double"


def _bytes_of(text: str) -> np.ndarray:
    """Bytes of a text, after a line feed that stands for its beginning."""
    return np.frombuffer(b"\n" + text.encode("utf-8", "replace").lower(), dtype=np.uint8)


def learning_sample(docs: DataFrame, per_language: int = SAMPLE_DOCS) -> DataFrame:
    """Rows (lang, text) of the ``per_language`` documents (doc_id, text, lang) with the least id hashes.

    The choice is made on ids alone; texts are fetched for the chosen ones.
    """
    ids = docs.where("doc_id IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL").select("doc_id", "lang")
    nth = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))
    chosen = materialise(ids.withColumn("nth", nth).where(F.col("nth") <= per_language).select("doc_id").distinct(), "lang-ids")
    texts = docs.where("lang IS NOT NULL AND text IS NOT NULL").select("doc_id", "lang", "text")
    return texts.join(chosen, "doc_id", "left_semi").select("lang", "text")


def _gram_rows(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for part in parts:
        for lang, texts in part.groupby("lang")["text"]:
            for order in range(ORDER + 1):
                found = []
                for text in texts:
                    b = _bytes_of(text).astype(np.int64)
                    if len(b) > order:
                        key = np.zeros(len(b) - order, dtype=np.int64)
                        for k in range(order + 1):
                            key = key << 8 | b[k : len(b) - order + k]
                        found.append(key if order else key[1:])
                keys, n = np.unique(np.concatenate(found or [np.zeros(0, np.int64)]), return_counts=True)
                yield pd.DataFrame({"lang": lang, "order": order, "gram": keys, "n": n})


class ContextTrees:
    """Code lengths in bits by (context node, byte, language), and the way from a text to its nodes."""

    def __init__(self, counts: dict[str, list[dict[int, int]]]):
        self.langs = sorted(counts)
        followers = {lang: [defaultdict(dict) for _ in range(ORDER + 1)] for lang in self.langs}
        for lang, orders in counts.items():
            for order, grams in enumerate(orders):
                for gram, n in grams.items():
                    followers[lang][order][gram >> 8][gram & 255] = n
        known = [set() for _ in range(ORDER + 1)]
        for lang in self.langs:
            for order in range(ORDER + 1):
                known[order] |= {
                    c for c, f in followers[lang][order].items() if not order or sum(f.values()) >= MIN_CONTEXT
                }
        for order in range(ORDER, 0, -1):  # a node's suffix is a node, so that nodes form a tree
            known[order - 1] |= {c & (1 << 8 * (order - 1)) - 1 for c in known[order]}
        known[0] |= {0}
        nodes = [(order, c) for order in range(ORDER + 1) for c in sorted(known[order])]
        self.node = {key: i for i, key in enumerate(nodes)}
        seen = sorted({10} | {g & 255 for lang in self.langs for g in counts[lang][0]})
        #: Bytes seen in training get a symbol each; all others share the last, at the price of a uniform code.
        self.symbol = np.full(256, len(seen), dtype=np.int64)
        self.symbol[seen] = np.arange(len(seen))
        width = len(seen) + 1
        bits = np.zeros((len(nodes), width, len(self.langs)), dtype=np.float32)
        for at, lang in enumerate(self.langs):
            for i, (order, context) in enumerate(nodes):
                if order:
                    shorter = self.node[order - 1, context & (1 << 8 * (order - 1)) - 1]
                    row = bits[shorter, :, at].copy()
                else:
                    row = np.full(width, 8.0, dtype=np.float32)
                found = followers[lang][order].get(context)
                if found:
                    total, kinds = sum(found.values()), len(found)
                    row += np.float32(np.log2((total + kinds) / kinds))
                    for byte, n in found.items():
                        row[self.symbol[byte]] = np.log2((total + kinds) / n)
                bits[i, :, at] = row
        self.width = width
        self.bits = bits.reshape(len(nodes) * width, len(self.langs))
        #: The node of the last three symbols: that of the longest known context, longer ones written last.
        by_context = np.zeros((width,) * ORDER, dtype=np.int32)
        for (order, context), i in self.node.items():
            if order:
                symbols = [self.symbol[context >> 8 * k & 255] for k in reversed(range(order))]
                by_context[(..., *symbols)] = i
        self.by_context = by_context.reshape(-1)

    def code_lengths(self, text: str) -> np.ndarray:
        """Bits of the whole text under every language."""
        total = np.zeros(len(self.langs))
        s = np.concatenate((np.full(ORDER - 1, self.symbol[10]), self.symbol[_bytes_of(text)]))
        for at in range(0, len(s) - ORDER, 1 << 20):
            part = s[at : at + (1 << 20) + ORDER]
            context = (part[:-3] * self.width + part[1:-2]) * self.width + part[2:-1]
            place = self.by_context[context].astype(np.int64) * self.width + part[3:]
            total += self.bits[place].sum(axis=0, dtype=np.float64)
        return total

    def predict(self, text: str | None) -> tuple[str, float]:
        if text is None or not self.langs or not has_letter(text):
            return "und", 0.0
        bits = self.code_lengths(text)
        best = int(np.argmin(bits))
        return self.langs[best], float(1 / np.exp2(np.maximum(bits[best] - bits, -1000)).sum())


def learn(docs: DataFrame, per_language: int = SAMPLE_DOCS) -> ContextTrees:
    """Trees from documents (doc_id, text, lang). What reaches the driver is bounded by the sample."""
    sample = learning_sample(docs, per_language)
    rows = sample.mapInPandas(_gram_rows, "lang string, order int, gram long, n long")
    grams = rows.groupBy("lang", "order", "gram").agg(F.sum("n").alias("n")).toPandas()
    counts: dict[str, list[dict[int, int]]] = defaultdict(lambda: [{} for _ in range(ORDER + 1)])
    for (lang, order), part in grams.groupby(["lang", "order"]):
        counts[lang][order] = dict(zip(part["gram"].tolist(), part["n"].tolist()))
    return ContextTrees(dict(counts))


def language(text: Column, trees: ContextTrees) -> Column:
    """A struct of FORMAT for a text column."""
    shared = F.pandas_udf(
        lambda texts: pd.DataFrame([trees.predict(t) for t in texts], columns=["lang_pred", "score"]), FORMAT
    )
    return shared(text)
