"""Quality classifier by positive-unlabelled learning.

Trusted positives are the documents labelled 1 outside the held-out fold; every other
document stands for unlabelled web text. Labels 0 are not used. The class prior, the
share of good documents among the unlabelled, is estimated first: a classifier between
positives and unlabelled ranks texts, and the prior is the smallest ratio of the
unlabelled to the positive score tail, each tail corrected by its confidence band.
Then a logistic model minimises the non-negative unbiased risk

    prior * E_P[l(g)] + max(0, E_U[l(-g)] - prior * E_P[l(-g)])

by Adam; when the negative part falls below zero its gradient is reversed. Features
are shape and repetition measures of the whole text, each as one-hot quantile bins
taken from the unlabelled sample. Labels, language, source and doc_id are no inputs.

Scale. Positives and unlabelled are bounded samples (``max_positive``,
``max_unlabelled`` rows, chosen by hash); the model is a few hundred numbers. Every
whole text is measured and scored where it is read, without a shuffle.

Defined results. Null text is empty and is scored by the features of an empty text.
Null labels or ids are ignored; repeated label rows count once. A null doc_id is not
held out. Without positives every score is 0. Extra columns do not matter; an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewright.llm.labels import held_out, sample
from candlewright.llm.quality_rules import measure
from candlewright.llm.textops import Words, chunks

FEATURES = ["log_words", "word_length", "symbol_share", "repeat_share", "dup_line_share", "upper_share",
            "digit_share", "punct_share", "wide_share", "distinct_share", "line_length"]
BINS = 8


def _mask(chars: bytes) -> np.ndarray:
    m = np.zeros(256, bool)
    m[list(chars)] = True
    return m


_UPPER, _DIGIT = _mask(bytes(range(65, 91))), _mask(b"0123456789")
_PUNCT = _mask(b"!\"'(),-./:;?@[\\]^_`{}~+=")


def features(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """One row of :data:`FEATURES` per document."""
    m = measure(data, off)
    w = Words(data, off)
    n = np.maximum(m["n_words"], 1)
    chars = np.maximum(m["word_chars"], 1)
    sums = lambda mask: np.diff(np.concatenate(([0], np.cumsum(mask[data])))[off])
    h, doc = w.hashes(), w.doc()
    order = np.lexsort([h, doc])
    new = np.concatenate(([True], (h[order][1:] != h[order][:-1]) | (doc[order][1:] != doc[order][:-1])))[: len(h)]
    distinct = np.bincount(doc[order][new], minlength=len(n))[: len(n)]
    wide = _mask(bytes(range(192, 256)))
    return np.column_stack([
        np.log1p(m["n_words"]), m["word_chars"] / n, m["n_symbols"] / n, m["n_repeat_words"] / n,
        m["n_dup_lines"] / np.maximum(m["n_lines"], 1), sums(_UPPER) / chars, sums(_DIGIT) / chars,
        sums(_PUNCT) / chars, sums(wide) / chars, distinct / n, np.log1p(n / np.maximum(m["n_lines"], 1))])


def _task(keep: list[str]):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, data, off in chunks(batches, "text"):
            x = pa.FixedSizeListArray.from_arrays(pa.array(features(data, off).ravel()), len(FEATURES))
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], x.cast(pa.list_(pa.float64()))],
                                             [*keep, "x"])
    return task


class Model:
    """Bin edges, weights and the prior; ``score`` maps features to a probability."""

    def __init__(self, edges: list[np.ndarray], weights: np.ndarray, bias: float, prior: float):
        self.edges, self.weights, self.bias, self.prior = edges, weights, bias, prior

    def score(self, x: np.ndarray) -> np.ndarray:
        g = one_hot(x, self.edges) @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(g, -30, 30)))


def bin_edges(x: np.ndarray) -> list[np.ndarray]:
    return [np.unique(np.quantile(c, np.arange(1, BINS) / BINS)) for c in x.T]


def one_hot(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """Quantile bins; a bin of its own for values above the highest edge by far (outliers
    of a measure that is constant in most texts)."""
    cols = []
    for c, e in zip(x.T, edges):
        b = np.searchsorted(e, c, "left")
        out = np.zeros((len(c), BINS + 1))
        out[np.arange(len(c)), b] = 1
        cols.append(out)
    return np.concatenate(cols, axis=1)


def _fit(p: np.ndarray, u: np.ndarray, prior: float | None, steps: int = 400, rate: float = 0.05,
         ridge: float = 1e-2) -> tuple[np.ndarray, float]:
    """Weights and bias: logistic P against U without a prior, else non-negative PU risk."""
    w, b = np.zeros(p.shape[1]), 0.0
    state = [np.zeros(len(w) + 1), np.zeros(len(w) + 1)]
    sig = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    soft = lambda z: np.logaddexp(0, z)
    for t in range(1, steps + 1):
        gp, gu = p @ w + b, u @ w + b
        pos, neg_p, neg_u = -(1 - sig(gp)) / len(gp), sig(gp) / len(gp), sig(gu) / len(gu)
        if prior is None:
            dp, du = pos / 2, neg_u / 2
        elif soft(gu).mean() - prior * soft(gp).mean() < 0:
            dp, du = prior * neg_p, -neg_u  # undo over-fitting of the negative part
        else:
            dp, du = prior * (pos - neg_p), neg_u
        grad = np.append(p.T @ dp + u.T @ du + ridge * w, dp.sum() + du.sum())
        state[0] = 0.9 * state[0] + 0.1 * grad
        state[1] = 0.999 * state[1] + 0.001 * grad ** 2
        step = rate * (state[0] / (1 - 0.9 ** t)) / (np.sqrt(state[1] / (1 - 0.999 ** t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return w, b


def class_prior(pos: np.ndarray, unl: np.ndarray, delta: float = 0.1) -> float:
    """Smallest corrected ratio of the unlabelled to the positive upper tail of a score."""
    t = np.quantile(pos, np.linspace(0.0, 0.9, 91))
    fp = (pos[:, None] >= t).mean(axis=0)
    fu = (unl[:, None] >= t).mean(axis=0)
    band = lambda n: np.sqrt(np.log(2 / delta) / (2 * max(n, 1)))
    ratio = (fu + band(len(unl))) / np.maximum(fp - band(len(pos)), 1e-9)
    return float(np.clip(ratio[fp > 2 * band(len(pos))].min(initial=1.0), 0.01, 0.99))


def train(docs: DataFrame, labels: DataFrame, *, max_positive: int = 10_000, max_unlabelled: int = 20_000,
          prior: float | None = None) -> Model:
    """``docs``: doc_id, text; ``labels``: doc_id, label."""
    good = labels.where((F.col("label") == 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    good = sample(good.select("doc_id").distinct(), max_positive, "doc_id").withColumn("kind", F.lit(1))
    other = docs.select("doc_id").where("doc_id is not null").distinct()
    any_ = sample(other, max_unlabelled, "doc_id").withColumn("kind", F.lit(0))
    chosen = good.union(any_)  # at most max_positive + max_unlabelled ids
    rows = (docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
            .mapInArrow(_task(["doc_id", "kind"]), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, "
                        "kind int, x array<double>").collect())
    rows.sort(key=lambda r: (r.kind, r.doc_id, r.x))
    p = np.array([r.x for r in rows if r.kind], float).reshape(-1, len(FEATURES))
    u = np.array([r.x for r in rows if not r.kind], float).reshape(-1, len(FEATURES))
    if not len(p) or not len(u):
        edges = [np.zeros(0)] * len(FEATURES)
        return Model(edges, np.zeros((BINS + 1) * len(FEATURES)), -30.0, 0.0)
    edges = bin_edges(u)
    hp, hu = one_hot(p, edges), one_hot(u, edges)
    if prior is None:
        w, b = _fit(hp, hu, None)
        prior = class_prior(hp @ w + b, hu @ w + b)
    w, b = _fit(hp, hu, prior)
    return Model(edges, w, b, prior)


def score_documents(docs: DataFrame, model: Model, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``doc_id``, ``held_out``, ``score``, ``predicted``."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, data, off in chunks(batches, "text"):
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(model.score(features(data, off)))],
                                             ["doc_id", "score"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        task, f"doc_id {kind}, score double")
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                       (F.col("score") >= 0.5).cast("int").alias("predicted"))
