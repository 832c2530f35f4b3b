"""Severity of toxic language by cumulative-link ordinal regression on sparse text features.

Features are the words of a text and their beginnings, hashed. Counts over the labelled rows pick
those that speak for the label; the model gives each one weight, shared by all thresholds between
grades, and outputs the expected grade. The labelled rows are a bounded sample; scoring is a pass
over all texts without a shuffle.

Labels tell only toxic from not toxic. Grades are derived from them: 0 for rows that are not toxic; for the
others 1, 2 or 3 by how many of their words carry a picked feature that is rarely seen elsewhere.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 21
PREFIXES = (4, 5, 6, 7)
GRADES = 4
_LETTERS = re.compile(r"[^\W\d_]+")
_KNOWN_WORDS = 200_000


@dataclass(frozen=True)
class Training:
    """Production parameters. ``max_labelled`` bounds the labelled rows used, picked by hash."""

    max_labelled: int = 20_000
    max_features: int = 2048
    min_documents: int = 3
    min_z: float = 2.5
    grade_hits: tuple[int, ...] = (3, 8)
    decay: float = 1e-4
    steps: int = 400


@dataclass(frozen=True)
class OrdinalModel:
    """``features`` (sorted bucket numbers), a weight for each, and the thresholds between grades."""

    features: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def above(self, score: np.ndarray) -> np.ndarray:
        """Probability of a grade above each threshold, one column per threshold."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -50, 50)))


def words_of(text: str | None) -> Counter:
    return Counter(_LETTERS.findall((text or "").lower()))


def features_of(word: str) -> list[int]:
    """Buckets of a word and of its beginnings; those of beginnings are marked as such."""
    raw = [word.encode("utf-8", "surrogatepass")]
    raw += [b"^" + word[:n].encode("utf-8", "surrogatepass") for n in PREFIXES if len(word) > n]
    return [zlib.crc32(x) % BUCKETS for x in raw]


class _Features(dict):
    """Word to the positions of its features among the picked ones, most often none."""

    def __init__(self, picked: np.ndarray) -> None:
        self.places = {int(f): i for i, f in enumerate(picked)}

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= _KNOWN_WORDS:
            self.clear()
        found = tuple(self.places[f] for f in features_of(word) if f in self.places)
        self[word] = found
        return found


def sparse_counts(words: Counter, known: _Features) -> dict[int, int]:
    counts: dict[int, int] = {}
    for word, times in words.items():
        for place in known[word]:
            counts[place] = counts.get(place, 0) + times
    return counts


def _feature_counts(rows: DataFrame) -> DataFrame:
    """Labelled documents, and toxic ones, that have each feature."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros((2, BUCKETS), np.int32)
        known: dict[str, list[int]] = {}
        for batch in batches:
            for text, toxic in zip(batch["text"], batch["toxic"]):
                found = set()
                for word in words_of(text):
                    if word not in known:
                        if len(known) >= _KNOWN_WORDS:
                            known.clear()
                        known[word] = features_of(word)
                    found.update(known[word])
                own = np.fromiter(found, np.int64, len(found))
                counts[0, own] += 1
                if toxic:
                    counts[1, own] += 1
        there = np.flatnonzero(counts[0])
        for start in range(0, len(there), 100_000):
            own = there[start : start + 100_000]
            yield pd.DataFrame({"feature": own, "n": counts[0, own], "t": counts[1, own]})

    counted = rows.select("text", "toxic").mapInPandas(run, "feature long, n long, t long")
    return counted.groupBy("feature").agg(F.sum("n").alias("n"), F.sum("t").alias("t"))


def _picked(rows: DataFrame, training: Training) -> pd.DataFrame:
    """The features that speak most clearly for the label, by the z value of their log odds ratio."""
    total, toxic = rows.agg(F.count(F.lit(1)), F.sum("toxic")).first()
    if not toxic or toxic == total:
        return pd.DataFrame({"feature": [], "n": [], "t": []})
    t, rest = F.col("t") + 0.5, F.col("n") - F.col("t") + 0.5
    odds = F.log(t / F.lit(toxic + 1.0)) - F.log(rest / F.lit(total - toxic + 1.0))
    z = odds / F.sqrt(1 / t + 1 / rest)
    top = (
        _feature_counts(rows)
        .filter(F.col("n") >= training.min_documents)
        .withColumn("z", z)
        .filter(F.col("z") >= training.min_z)
        .orderBy(F.desc("z"), "feature")
        .limit(training.max_features)
    )
    return top.toPandas().sort_values("feature", ignore_index=True)


def _examples(rows: DataFrame, picked: pd.DataFrame) -> pd.DataFrame:
    """The labelled rows as picked features and their counts, with the number of telling words."""
    features = picked["feature"].to_numpy(np.int64)
    telling = (picked["t"] >= 0.9 * picked["n"]).to_numpy()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = _Features(features)
        for batch in batches:
            out = []
            for doc_id, text, toxic in zip(batch["doc_id"], batch["text"], batch["toxic"]):
                words = words_of(text)
                counts = sparse_counts(words, known)
                hits = sum(n for w, n in words.items() if any(telling[p] for p in known[w]))
                out.append((doc_id, toxic, hits, list(counts), list(counts.values())))
            yield pd.DataFrame(out, columns=["doc_id", "toxic", "hits", "places", "counts"])

    schema = "doc_id long, toxic int, hits long, places array<int>, counts array<int>"
    found = rows.select("doc_id", "text", "toxic").mapInPandas(run, schema)
    return found.toPandas().sort_values("doc_id", ignore_index=True)


def fit_ordinal(
    rows: np.ndarray, columns: np.ndarray, values: np.ndarray, grades: np.ndarray, n_features: int,
    training: Training,
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds of the proportional-odds model, by gradient steps with momentum.

    ``rows``, ``columns``, ``values`` are the entries of a sparse matrix. Each threshold but the first is
    the one before plus the exponential of a parameter, which keeps them in order.
    """
    n, cuts = len(grades), GRADES - 1
    weights, first, gaps = np.zeros(n_features), 1.0, np.zeros(cuts - 1)
    state = np.zeros((2, n_features + cuts))
    grade = grades[:, None]
    for step in range(1, training.steps + 1):
        thresholds = first + np.concatenate([[0.0], np.cumsum(np.exp(gaps))])
        score = np.bincount(rows, values * weights[columns], n)
        below = 1 / (1 + np.exp(np.clip(score[:, None] - thresholds[None, :], -50, 50)))
        edges = np.hstack([np.zeros((n, 1)), below, np.ones((n, 1))])
        slope = edges * (1 - edges)
        high = np.take_along_axis(edges, grade + 1, 1)[:, 0]
        low = np.take_along_axis(edges, grade, 1)[:, 0]
        p = np.maximum(high - low, 1e-12)
        up = np.take_along_axis(slope, grade + 1, 1)[:, 0] / p
        down = np.take_along_axis(slope, grade, 1)[:, 0] / p
        by_score = (up - down) / n
        by_cut = np.array([
            -(up[grades == k].sum() - down[grades == k + 1].sum()) / n for k in range(cuts)
        ])
        by_gap = np.array([by_cut[k + 1 :].sum() * np.exp(gaps[k]) for k in range(cuts - 1)])
        by_weight = np.bincount(columns, values * by_score[rows], n_features) + training.decay * weights
        gradient = np.concatenate([by_weight, [by_cut.sum()], by_gap])
        state[0] = 0.9 * state[0] + 0.1 * gradient
        state[1] = 0.99 * state[1] + 0.01 * gradient**2
        move = 0.05 * (state[0] / (1 - 0.9**step)) / (np.sqrt(state[1] / (1 - 0.99**step)) + 1e-8)
        weights -= move[:n_features]
        first -= move[n_features]
        gaps -= move[n_features + 1 :]
    return weights, first + np.concatenate([[0.0], np.cumsum(np.exp(gaps))])


def fit_severity(
    docs: DataFrame, labels: DataFrame, training: Training = Training(),
    id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
) -> OrdinalModel:
    """Fit on at most ``max_labelled`` labelled rows of ``docs``, those with the least hashes of ids.

    Rows without an id or a label are left out; a repeated id is toxic if one of its labels is.
    Without both labels, or without a feature that tells them apart, the model has no features and
    gives every text the severity 0.
    """
    sample = (
        labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("toxic"))
        .dropna()
        .groupBy("doc_id")
        .agg((F.max("toxic") > 0).cast("int").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(training.max_labelled)
    )
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = texts.join(F.broadcast(sample), "doc_id")  # max_labelled rows of two numbers
    picked = _picked(rows, training)
    if not len(picked):
        return OrdinalModel(np.empty(0, np.int64), np.empty(0), np.full(GRADES - 1, 50.0))
    known = _examples(rows, picked)
    grades = 1 + sum((known["hits"] >= h).to_numpy(np.int64) for h in training.grade_hits)
    grades = np.where(known["toxic"] == 1, grades, 0)
    sizes = known["places"].map(len).to_numpy()
    places = np.concatenate([np.asarray(p, np.int64) for p in known["places"]])
    counts = np.concatenate([np.asarray(c, float) for c in known["counts"]])
    row = np.repeat(np.arange(len(known)), sizes)
    weights, thresholds = fit_ordinal(row, places, np.log1p(counts), grades, len(picked), training)
    return OrdinalModel(picked["feature"].to_numpy(np.int64), weights, thresholds)


def severity(
    docs: DataFrame, model: OrdinalModel, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id``, ``expected_severity`` (0 to 3), ``grade`` and ``toxic`` of each row.

    ``grade`` is the number of thresholds that are passed with a probability of a half or more, and
    ``toxic`` whether it is above 0. Null and empty texts are scored as texts without features. Repeated
    rows are scored alike, null ids stay null; other columns are not looked at.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = _Features(model.features)
        for batch in batches:
            scores = np.zeros(len(batch))
            for i, text in enumerate(batch["text"]):
                for place, times in sparse_counts(words_of(text), known).items():
                    scores[i] += model.weights[place] * np.log1p(times)
            above = model.above(scores)
            grade = (above >= 0.5).sum(axis=1)
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"].astype("Int64"),
                    "expected_severity": above.sum(axis=1),
                    "grade": grade.astype(np.int32),
                    "toxic": grade > 0,
                }
            )

    rows = docs.select(F.col(id_col).cast("long").cast("string").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInPandas(run, "doc_id long, expected_severity double, grade int, toxic boolean")
