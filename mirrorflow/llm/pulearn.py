"""Quality of texts by positive-unlabelled learning: rows labelled good, and texts of unknown quality.

The model is logistic in measures of the whole text that hold for any language. It minimises the non-negative
form of the unbiased risk: the loss of trusted positives as positives, weighted with the class prior, plus the
loss of unlabelled texts as negatives less the part of it that positives must account for, where
that difference counts as zero once it falls below. The prior comes from the same rows: a first model, fitted on
half of them, tells positives from unlabelled texts, and the prior is the least ratio of the shares of both that
score above a limit in the other half, taken where sampling error leaves it reliable.

Measures are formed in one pass over all texts and written. Each step of a fit is one pass over them that
adds up loss, gradient and curvature; all rows take part, and only sums reach the driver.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mirrorflow.llm.batches import bounded_batches
from mirrorflow.llm.sums import matrix, table_sums
from mirrorflow.sources.scratch import materialise

_SYMBOLS = [b"|", b"!", b"#$%&*<>", b".,;:?", b"'\"()[]{}", b"-_/\\@+=~^`"]
_CODE = np.full(256, 4 + len(_SYMBOLS), np.int64)
for _i, _set in enumerate([bytes(range(65, 91)), bytes(range(97, 123)), b"0123456789", b" \t\r\v\f", *_SYMBOLS]):
    _CODE[np.frombuffer(_set, np.uint8)] = _i
_CODE[10] = 5 + len(_SYMBOLS)
_CODE[128:] = 6 + len(_SYMBOLS)
_CLASSES = 7 + len(_SYMBOLS)
_WORD = regex.compile(r"[^\x20\x09-\x0D]+")

MEASURES = _CLASSES + 12
BINS = 1000


@dataclass(frozen=True)
class Training:
    """Production parameters. ``decay`` weighs the squared coefficients against one positive row's loss;
    ``clip`` bounds a scaled measure."""

    decay: float = 2.0
    clip: float = 6.0
    max_steps: int = 25
    tolerance: float = 1e-6
    confidence: float = 0.1


@dataclass(frozen=True)
class QualityModel:
    """Mean and deviation of the measures over unlabelled texts, and the coefficients, constant first."""

    mean: np.ndarray
    deviation: np.ndarray
    weights: np.ndarray
    prior: float
    clip: float

    def rows(self, measures: np.ndarray) -> np.ndarray:
        return design(measures, self.mean, self.deviation, self.clip)

    def score(self, measures: np.ndarray) -> np.ndarray:
        return _sigmoid(self.rows(measures) @ self.weights)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def design(measures: np.ndarray, mean: np.ndarray, deviation: np.ndarray, clip: float) -> np.ndarray:
    """A constant, the scaled measures and their squares, so that both ends of a measure can count."""
    z = np.clip((measures - mean) / deviation, -clip, clip)
    return np.hstack([np.ones((len(z), 1)), z, z * z / clip])


def measures_of(text: str | None) -> np.ndarray:
    """Shares of character classes, and what repeats among words and lines; zeros for a text without words."""
    out = np.zeros(MEASURES)
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = _WORD.findall(text or "")
    if not words:
        return out
    counts = np.bincount(_CODE, np.bincount(np.frombuffer(raw, np.uint8), minlength=256), _CLASSES)
    out[:_CLASSES] = np.sqrt(counts / len(raw))
    n = len(words)
    known = Counter(words)
    lines = [line for line in text.split("\n") if line.strip()]
    ends = sum(line.rstrip()[-1] in ".!?" for line in lines)
    lengths = np.fromiter(map(len, words), np.int64, n)
    same = sum(a == b for a, b in zip(words, words[1:]))
    windows = n - 2
    again = windows - len(set(zip(words, words[1:], words[2:]))) if windows > 0 else 0
    out[_CLASSES:] = [
        np.log1p(n),
        np.log(lengths.mean()),
        np.sqrt((lengths <= 3).mean()),
        np.sqrt(len(known) / n),
        np.sqrt(max(known.values()) / n),
        np.sqrt(same / n),
        np.sqrt(again / max(windows, 1)),
        np.log1p(n / len(lines)),
        np.sqrt(1 - len(set(lines)) / len(lines)),
        np.sqrt(ends / len(lines)),
        np.sqrt(sum(w.isupper() and len(w) > 1 for w in words) / n),
        np.sqrt(sum(not w[-1].isalnum() for w in words) / n),
    ]
    return out


def text_measures(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id`` and ``measures`` of every row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [measures_of(t.as_py()) for t in batch.column("text")]
            flat = pa.array(np.concatenate(found) if found else np.empty(0))
            ends = pa.array(np.arange(len(found) + 1) * MEASURES, pa.int32())
            yield pa.record_batch(
                [batch.column("doc_id"), pa.ListArray.from_arrays(ends, flat)], names=["doc_id", "measures"]
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, measures array<double>")


def _sums(rows: DataFrame, length: int, part: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum over all rows of what ``part`` makes of the measures and marks (positive, unlabelled) of a batch."""

    def marked(batch: pa.RecordBatch) -> np.ndarray:
        marks = [batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in ("positive", "unlabelled")]
        return part(matrix(batch.column("measures")), *marks)

    return table_sums(rows.select("measures", "positive", "unlabelled"), length, marked)


class _Fit:
    """Passes over the written measures; ``n_p`` and ``n_u`` rows are positive and unlabelled."""

    def __init__(self, rows: DataFrame, training: Training) -> None:
        self.rows, self.training = rows, training
        m = MEASURES

        def moments(x: np.ndarray, p: np.ndarray, u: np.ndarray) -> np.ndarray:
            return np.concatenate([[p.sum(), u.sum()], u @ x, u @ (x * x)])

        found = _sums(rows, 2 + 2 * m, moments)
        self.n_p, self.n_u = found[0], found[1]
        self.mean = found[2 : 2 + m] / max(self.n_u, 1.0)
        spread = np.sqrt(np.maximum(found[2 + m :] / max(self.n_u, 1.0) - self.mean**2, 0.0))
        self.deviation = np.where(spread > 1e-6, spread, 1.0)
        self.size = 1 + 2 * m

    def model(self, weights: np.ndarray, prior: float) -> QualityModel:
        return QualityModel(self.mean, self.deviation, weights, prior, self.training.clip)

    def losses(self, weights: np.ndarray) -> dict[str, np.ndarray]:
        """Means over both kinds of rows of the losses, their gradients and curvatures."""
        model, k = self.model(weights, 0.0), self.size

        def part(x: np.ndarray, p: np.ndarray, u: np.ndarray) -> np.ndarray:
            rows = model.rows(x)
            z = rows @ weights
            s = _sigmoid(z)
            out = []
            for mark in (p, u):
                curved = rows.T @ (rows * (mark * s * (1 - s))[:, None])
                out += [[mark @ np.logaddexp(0, -z), mark @ np.logaddexp(0, z)], rows.T @ (mark * s), mark @ rows, curved.ravel()]
            return np.concatenate(out)

        step = 2 + 2 * k + k * k
        found = _sums(self.rows, 2 * step, part)
        means = {}
        for name, n, own in (("p", self.n_p, found[:step]), ("u", self.n_u, found[step:])):
            own = own / max(n, 1.0)
            means |= {
                f"{name}_plus": own[0], f"{name}_minus": own[1], f"{name}_by_score": own[2 : 2 + k],
                f"{name}_rows": own[2 + k : 2 + 2 * k], f"{name}_curve": own[2 + 2 * k :].reshape(k, k),
            }
        return means

    def minimise(self, risk: Callable[[dict], tuple[float, np.ndarray, np.ndarray]]) -> np.ndarray:
        """Newton steps with halving; ``risk`` gives value, gradient and curvature without the decay."""
        decay = np.full(self.size, self.training.decay / max(self.n_p, 1.0))
        decay[0] = 0.0
        weights = np.zeros(self.size)

        def at(w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
            value, gradient, curve = risk(self.losses(w))
            return value + 0.5 * float(decay @ (w * w)), gradient + decay * w, curve + np.diag(decay + 1e-9)

        value, gradient, curve = at(weights)
        for _ in range(self.training.max_steps):
            step = np.linalg.solve(curve, gradient)
            step *= min(1.0, 5.0 / max(float(np.abs(step).max()), 1e-300))
            share = 1.0
            while share > 1e-3:
                new = at(weights - share * step)
                if new[0] < value:
                    break
                share /= 2
            else:
                break
            weights, gained = weights - share * step, value - new[0]
            value, gradient, curve = new
            if gained < self.training.tolerance * max(abs(value), 1e-3):
                break
        return weights

    def histograms(self, weights: np.ndarray, rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
        """Positive and unlabelled ones of ``rows`` per bin of the score, best bin first."""
        model = self.model(weights, 0.0)

        def part(x: np.ndarray, p: np.ndarray, u: np.ndarray) -> np.ndarray:
            at = np.minimum(((1 - model.score(x)) * BINS).astype(np.int64), BINS - 1)
            return np.concatenate([np.bincount(at, p, BINS), np.bincount(at, u, BINS)])

        found = _sums(rows, 2 * BINS, part)
        return found[:BINS], found[BINS:]


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray, confidence: float) -> float:
    """Share of positives among unlabelled rows, from the numbers of both per bin, best bin first.

    Above any limit unlabelled rows are at least the prior times positives; the limit taken is the one
    where that bound with its sampling error is least.
    """
    n_p, n_u = max(positive.sum(), 1.0), max(unlabelled.sum(), 1.0)
    above_p, above_u = np.cumsum(positive) / n_p, np.cumsum(unlabelled) / n_u
    error = np.sqrt(np.log(4 / confidence) / 2) * (n_p**-0.5 + n_u**-0.5)
    there = above_p > 0
    if not there.any():
        return 0.5
    best = int(np.argmin((above_u[there] + error) / above_p[there]))
    return float(np.clip(above_u[there][best] / above_p[there][best], 0.01, 0.99))


def non_negative_risk(prior: float) -> Callable[[dict], tuple[float, np.ndarray, np.ndarray]]:
    """Value, gradient and curvature of the non-negative risk with the logistic loss.

    While the negative part is not below zero its sum with the positive part is convex, as the
    difference of the two losses of a positive is its score. Below, only the positive part counts.
    """

    def risk(m: dict) -> tuple[float, np.ndarray, np.ndarray]:
        negative = m["u_minus"] - prior * m["p_minus"]
        plus = prior * m["p_plus"]
        if negative >= 0:
            return plus + negative, m["u_by_score"] - prior * m["p_rows"], m["u_curve"]
        return plus, prior * (m["p_by_score"] - m["p_rows"]), prior * m["p_curve"]

    return risk


def told_apart(m: dict) -> tuple[float, np.ndarray, np.ndarray]:
    """Value, gradient and curvature of the logistic loss of positives against unlabelled rows."""
    gradient = (m["p_by_score"] - m["p_rows"] + m["u_by_score"]) / 2
    return (m["p_plus"] + m["u_minus"]) / 2, gradient, (m["p_curve"] + m["u_curve"]) / 2


def fit_quality(rows: DataFrame, training: Training = Training()) -> QualityModel:
    """Fit on a written table of ``measures`` with the marks ``positive``, ``unlabelled`` and ``half`` (boolean).

    Without a positive or without an unlabelled row in either half every text scores 0.5.
    """
    fit, first = _Fit(rows, training), _Fit(rows.filter("half"), training)
    if not first.n_p or not first.n_u:
        return fit.model(np.zeros(fit.size), 0.5)
    counts = first.histograms(first.minimise(told_apart), rows.filter("not half"))
    if not counts[0].sum():
        return fit.model(np.zeros(fit.size), 0.5)
    prior = estimate_prior(*counts, training.confidence)
    return fit.model(fit.minimise(non_negative_risk(prior)), prior)


def held_out(doc_id: Column) -> Column:
    """Whether the CRC-32 of the id as text leaves 2 when divided by 4; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def quality_scores(
    docs: DataFrame, labels: DataFrame, training: Training = Training(),
    id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", threshold: float = 0.7,
) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of each row of ``docs``.

    Positives are rows with the label 1 (all labels of a repeated id agreeing) that are not held out; all
    rows that are not held out are the unlabelled ones. Only texts are scored: null and empty ones and those
    without words have zero measures. Null ids are unlabelled; repeated rows score alike; other columns are not
    looked at. An empty table gives an empty table.
    """
    bounded_batches(docs.sparkSession)
    measured = materialise(text_measures(docs, id_col, text_col), "text_measures")
    good = (
        labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).alias("label"))
        .groupBy("doc_id")
        .agg((F.min("label") == 1).alias("good"))
        .filter("good")
    )
    rows = measured.join(good, "doc_id", "left").withColumn("unlabelled", ~held_out(F.col("doc_id")))
    rows = rows.withColumn("positive", F.coalesce("good", F.lit(False)) & F.col("unlabelled"))
    half = F.pmod(F.xxhash64("measures"), F.lit(2)) == 0
    rows = rows.filter("unlabelled").select("measures", "positive", "unlabelled", half.alias("half"))
    rows = materialise(rows, "training_rows")
    model = fit_quality(rows, training)

    @F.arrow_udf("double")
    def score(measures: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in measures:
            flat = batch.flatten().to_numpy(zero_copy_only=False)
            yield pa.array(model.score(flat.reshape(len(batch), MEASURES)))

    scored = measured.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score("measures").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
