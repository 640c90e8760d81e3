"""Toxicity as an ordinal regression over sparse text features.

A cumulative-link model with shared weights: P(grade > k) = sigmoid(score - threshold_k), with increasing
thresholds. The score of a text is the sum over its distinct words of the weights of the word's features: the
word itself, and each of its beginnings that is shorter than it. The expected severity is the sum of
P(grade > k) over k.

The model is fitted on at most ``SAMPLE_ROWS`` labelled documents, taken by the hash of the id; features are
those whose tie to grade > 0 is significant on that sample (``MIN_CHI2``), at most ``MAX_FEATURES`` of them.
Scoring covers every text whole. Labels repeated for an id count once, with the highest grade; labels that are
null or of unknown ids are ignored. Without labels of two grades nothing can be told: scores are those of
no evidence and no text is toxic. A null or empty text has no words, hence no evidence, and is not toxic.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchloom.storage import materialise

SAMPLE_ROWS = 10_000
MAX_FEATURES = 512
MIN_CHI2 = 40.0
MIN_DOCUMENTS = 5
SHORTEST, LONGEST = 3, 8

FORMAT = "toxic_score double, expected_severity double, p_toxic double, toxic boolean"

_WORD = re.compile(r"[^\W\d_]+")


def word_features(word: str) -> list[str]:
    """``=word`` and its proper beginnings of SHORTEST to LONGEST characters."""
    return ["=" + word, *(word[:k] for k in range(SHORTEST, min(LONGEST, len(word) - 1) + 1))]


def text_words(text: str | None) -> set[str]:
    return set(_WORD.findall(text.lower())) if text else set()


@dataclass
class OrdinalModel:
    """Weights by feature and increasing thresholds, the first for grade > 0."""

    weights: dict[str, float] = field(default_factory=dict)
    thresholds: list[float] = field(default_factory=lambda: [5.0])

    def __post_init__(self):
        self._words: dict[str, float] = {}

    def word_weight(self, word: str) -> float:
        found = self._words.get(word)
        if found is None:
            if len(self._words) >= 200_000:
                self._words.clear()
            found = self._words[word] = sum(self.weights.get(f, 0.0) for f in word_features(word))
        return found

    def score(self, text: str | None) -> float:
        return float(sum(sorted(map(self.word_weight, text_words(text)))))

    def exceed(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > k), a column for each k."""
        z = scores[:, None] - np.asarray(self.thresholds)[None, :]
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def _likelihood(z: np.ndarray, theta: np.ndarray, grade: np.ndarray) -> tuple[float, np.ndarray]:
    """Negative log-likelihood of the grades, and P(grade > k - 1) for k = 0 .. levels + 1."""
    inner = 1 / (1 + np.exp(-np.clip(z[:, None] - theta[None, :], -40, 40)))
    above = np.column_stack((np.ones(len(z)), inner, np.zeros(len(z))))
    rows = np.arange(len(z))
    return -float(np.log(np.maximum(above[rows, grade] - above[rows, grade + 1], 1e-12)).sum()), above


def fit_ordinal(x: np.ndarray, grade: np.ndarray, ridge: float = 0.1, rounds: int = 25) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds of the cumulative-link model, by Fisher scoring on the penalised likelihood.

    Weights and thresholds take turns; a step is halved until the loss falls and the thresholds stay ordered.
    """
    n, levels = len(grade), int(grade.max())
    shares = np.array([(grade > k).mean() for k in range(levels)])
    w, theta = np.zeros(x.shape[1]), -np.log(shares / (1 - shares))
    rows = np.arange(n)

    def better(w1: np.ndarray, theta1: np.ndarray, loss: float) -> tuple[bool, float]:
        found = _likelihood(x @ w1, theta1, grade)[0] + ridge * float(w1 @ w1) / 2
        return bool(np.all(np.diff(theta1) > 1e-3)) and found < loss, found

    loss = better(w, theta, np.inf)[1]
    for _ in range(rounds):
        before = loss
        for of_weights in (True, False):
            above = _likelihood(x @ w, theta, grade)[1]
            slope = above * (1 - above)
            p = np.maximum(above[:, :-1] - above[:, 1:], 1e-12)
            if of_weights:
                pull = (slope[rows, grade] - slope[rows, grade + 1]) / p[rows, grade]
                weight = ((slope[:, :-1] - slope[:, 1:]) ** 2 / p).sum(axis=1).astype(x.dtype)
                info = ridge * np.eye(x.shape[1])
                for at in range(0, n, 1_000):  # in blocks, for the driver's memory
                    part = x[at : at + 1_000]
                    info += (part.T * weight[at : at + 1_000]) @ part
                step = np.linalg.solve(info, x.T @ pull - ridge * w)
            else:
                pull = np.zeros(levels + 2)
                np.add.at(pull, grade + 1, slope[rows, grade + 1] / p[rows, grade])
                np.add.at(pull, grade, -slope[rows, grade] / p[rows, grade])
                info = (slope**2 * (np.pad(1 / p, ((0, 0), (1, 0))) + np.pad(1 / p, ((0, 0), (0, 1))))).sum(axis=0)
                step = pull[1:-1] / np.maximum(info[1:-1], 1e-9)
            for _ in range(20):
                ok, found = better(w + step, theta, loss) if of_weights else better(w, theta + step, loss)
                if ok:
                    w, theta, loss = (w + step, theta, found) if of_weights else (w, theta + step, found)
                    break
                step = step / 2
        if before - loss < 1e-6 * before:
            break
    return w, theta


def labelled_sample(docs: DataFrame, grades: DataFrame, id_col: str = "doc_id", rows: int = SAMPLE_ROWS) -> DataFrame:
    """Rows (text, grade): the distinct texts of at most ``rows`` labelled ids, those whose hashes are least."""
    chosen = (
        grades.where(F.col(id_col).isNotNull() & F.col("grade").isNotNull())
        .groupBy(F.col(id_col).alias("id"))
        .agg(F.max("grade").cast("int").alias("grade"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(rows)
    )
    chosen = F.broadcast(materialise(chosen, "labels"))
    texts = docs.select(F.col(id_col).alias("of"), F.col("text"))
    joined = texts.join(chosen, texts["of"] == chosen["id"])
    once = joined.groupBy("text").agg(F.max("grade").alias("grade"))  # copies count once
    return materialise(once.where("text IS NOT NULL"), "labelled")


def _feature_counts(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for part in parts:
        toxic, clean = Counter(), Counter()
        for text, grade in zip(part["text"], part["grade"]):
            found = {f for w in text_words(text) for f in word_features(w)}
            (toxic if grade > 0 else clean).update(found)
        names = list(toxic.keys() | clean.keys())
        yield pd.DataFrame(
            {"feature": names, "toxic": [toxic[f] for f in names], "clean": [clean[f] for f in names]}
        ).astype({"toxic": "int64", "clean": "int64"})


def telling_features(sample: DataFrame) -> list[str]:
    """Features of the sample that are significantly more frequent where the grade is above 0."""
    sizes = sample.groupBy((F.col("grade") > 0).alias("toxic")).count().collect()
    n = {r["toxic"]: r["count"] for r in sizes}
    t, c = n.get(True, 0), n.get(False, 0)
    if not t or not c:
        return []
    counts = sample.select("text", "grade").mapInPandas(_feature_counts, "feature string, toxic long, clean long")
    counts = counts.groupBy("feature").agg(F.sum("toxic").alias("a"), F.sum("clean").alias("b"))
    a, b = F.col("a").cast("double"), F.col("b").cast("double")
    chi2 = (t + c) * F.pow(a * (c - b) - b * (t - a), 2) / ((a + b) * (t + c - a - b + 0.5) * t * c)
    chosen = counts.where((a + b >= MIN_DOCUMENTS) & (a * c > b * t)).select("feature", chi2.alias("chi2"))
    chosen = chosen.where(F.col("chi2") >= MIN_CHI2).orderBy(F.desc("chi2"), "feature").limit(MAX_FEATURES)
    return sorted(r["feature"] for r in chosen.collect())


def fit(
    docs: DataFrame, grades: DataFrame, id_col: str = "doc_id", rows: int = SAMPLE_ROWS, split: bool = False
) -> OrdinalModel:
    """The model for documents and a table (id, grade) of severity grades 0, 1, 2, ...

    With ``split``, 0/1 grades are refined: of the documents above 0, those with more distinct telling words than
    the median get grade 2.
    """
    sample = labelled_sample(docs, grades, id_col, rows)
    features = telling_features(sample)
    if not features:
        return OrdinalModel()
    index = {f: i for i, f in enumerate(features)}

    def sparse(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            found = []
            for text in part["text"]:
                words = text_words(text)
                counts = Counter(index[f] for w in words for f in word_features(w) if f in index)
                telling = sum(any(f in index for f in word_features(w)) for w in words)
                found.append((list(counts), list(counts.values()), telling))
            yield pd.DataFrame({"grade": part["grade"]}).assign(
                at=[f[0] for f in found], n=[f[1] for f in found], dose=[f[2] for f in found]
            )

    found = sample.mapInPandas(sparse, "grade int, at array<int>, n array<int>, dose int").toPandas()
    found["order"] = [(g, s, sorted(zip(a, n))) for g, a, n, s in zip(found["grade"], found["at"], found["n"], found["dose"])]
    found = found.sort_values("order", kind="stable")
    grade = found["grade"].to_numpy()
    if split:
        dose = found["dose"].to_numpy()
        grade = np.where((grade > 0) & (dose > np.median(dose[grade > 0])), 2, grade)
    grade = np.searchsorted(np.unique(grade), grade)
    x = np.zeros((len(found), len(features)), dtype=np.float32)
    for i, (at, n) in enumerate(zip(found["at"], found["n"])):
        x[i, at] = n
    weights, thresholds = fit_ordinal(x, grade)
    return OrdinalModel(dict(zip(features, weights.tolist())), thresholds.tolist())


def severity(text: Column, model: OrdinalModel) -> Column:
    """A struct of FORMAT for a text column."""

    def of(texts: pd.Series) -> pd.DataFrame:
        scores = np.array([model.score(t) for t in texts], dtype=float)
        above = model.exceed(scores) if len(scores) else np.zeros((0, len(model.thresholds)))
        toxic = above[:, 0]
        return pd.DataFrame(
            {"toxic_score": scores, "expected_severity": above.sum(axis=1), "p_toxic": toxic, "toxic": toxic >= 0.5}
        )

    return F.pandas_udf(of, FORMAT)(text)


def fit_labels(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", rows: int = SAMPLE_ROWS) -> OrdinalModel:
    """The model for 0/1 labels in a column ``toxic``."""
    return fit(docs, labels.select(id_col, F.col("toxic").cast("int").alias("grade")), id_col, rows, split=True)
