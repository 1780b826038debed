"""Toxic passages by maximum-scoring segments over token log-odds.

Training. Words of labelled documents (ASCII lower case, cut at punctuation) and their
4, 5, 6 and 8 byte prefixes are counted by label; a prefix stands for the inflections
of a stem; a document counts a token once, so that repetition is no evidence. The log-odds of a token between toxic and clean text use an informative
Dirichlet prior (``prior`` times the labelled counts, spread as in all labelled text); tokens whose
log-odds exceed ``z`` standard errors form the lexicon (whole: each was seen in ``min_count`` toxic places of the sample).

Scoring. A word scores the largest log-odds among its lexicon entries, any other word
the log-odds of a word outside the lexicon (``drift`` < 0). One linear pass finds every maximal scoring segment of the text. Under
clean text, segment scores follow an extreme-value law with the rate lambda that solves
``E[exp(lambda * score)] = 1``; a segment of score S in n words has the normalised score
``lambda * S - ln(n)``. A document's evidence is the sum of its segments' positive
normalised scores (its best one when none is positive); a logistic fit on the labelled
rows turns it into a probability.

Scale. Labelled rows are a bounded sample (``max_labelled``); counting is a Spark
aggregate with task-side sums; lexicon and parameters, which follow that sample and
not the corpus, go with the tasks. Every whole text is scored where it is read, without a shuffle.

Defined results. Null or empty text has no words and gets the score of no evidence.
Labels that are null or lack a document are ignored; repeated label rows count once, and
a labelled id with several texts counts with its smallest one. A
null doc_id is never labelled and not held out. Without both labels every score is the
share of toxic labels (0 without labels). Extra columns do not matter; an empty table
gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewright.llm.labels import held_out, sample
from candlewright.llm.textops import chunks, span_hashes, stage

PREFIXES = (4, 5, 6, 8)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = _WORD[128:] = True


def tokens(data: np.ndarray, off: np.ndarray):
    """Word spans ``start``, ``end``, word ranges ``at`` per document and the hashes of each
    word and its prefixes (0 where the word is no longer than the prefix)."""
    data = _LOWER[data]
    word = np.zeros(len(data) + 2, bool)
    word[1:-1] = _WORD[data]
    edge_start, edge_end = word[1:-1] & ~word[:-2], word[1:-1] & ~word[2:]
    inner = off[(off > 0) & (off < len(data))]
    edge_start[inner] = word[inner + 1]
    edge_end[inner - 1] = word[inner]
    start, end = np.flatnonzero(edge_start), np.flatnonzero(edge_end) + 1
    hashes = [span_hashes(data, start, end)]
    for p in PREFIXES:
        long = end - start > p
        h = np.zeros(len(start), np.uint64)
        h[long] = span_hashes(data, start[long], start[long] + p) ^ np.uint64(p)
        hashes.append(h)
    return start, end, np.searchsorted(start, off), hashes


def segments(pos: list[int], score: list[float], drift: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments ``(first, last, score)`` of a sequence that scores
    ``score`` at ``pos`` (ascending) and ``drift`` elsewhere; linear in ``len(pos)``."""
    found: list[list] = []  # [first, last, left, right, index of the nearest segment with a smaller left]
    total, last = 0.0, -1
    for p, s in zip(pos, score):
        total += (p - last - 1) * drift
        last = p
        seg = [p, p, total, total + s, -1]
        total += s
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= seg[2]:
                j = found[j][4]
            if j < 0 or found[j][3] >= seg[3]:
                seg[4] = j
                found.append(seg)
                break
            seg[0], seg[2] = found[j][0], found[j][2]
            del found[j:]
    return [(a, b, r - le) for a, b, le, r, _ in found]


class Model:
    """Lexicon hashes (sorted) and log-odds, drift, lambda and the logistic fit."""

    def __init__(self, keys, odds, drift: float, rate: float, a: float = 0.0, b: float = 0.0,
                 constant: float | None = None):
        self.keys, self.odds, self.drift, self.rate = keys, odds, drift, rate
        self.a, self.b, self.constant = a, b, constant

    def hits(self, hashes) -> tuple[np.ndarray, np.ndarray]:
        best = np.zeros(len(hashes[0]))
        if len(self.keys):
            for h in hashes:
                at = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
                best = np.maximum(best, np.where(self.keys[at] == h, self.odds[at], 0.0))
        where = np.flatnonzero(best)
        return where, best[where]

    def evidence(self, segs, n: int) -> float:
        norm = [self.rate * s - math.log(max(n, 1)) for _, _, s in segs]
        good = [x for x in norm if x > 0]
        return sum(good) if good else max(norm, default=-math.log(max(n, 1)) - 1.0)

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.a * x + self.b, -30, 30)))

    def documents(self, data: np.ndarray, off: np.ndarray):
        """(evidence, segments) of each document; segments in words with byte spans."""
        start, end, at, hashes = tokens(data, off)
        where, s = self.hits(hashes)
        cut = np.searchsorted(where, at)
        for i in range(len(off) - 1):
            n = int(at[i + 1] - at[i])
            w = where[cut[i]:cut[i + 1]]
            segs = segments((w - at[i]).tolist(), s[cut[i]:cut[i + 1]].tolist(), self.drift) if len(w) else []
            yield self.evidence(segs, n), [(a, b, x, int(start[at[i] + a]), int(end[at[i] + b])) for a, b, x in segs]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b, data, off in chunks(batches, "text"):
        label = np.array(b.column("label").to_pylist(), np.int64)
        _, _, at, hashes = tokens(data, off)
        doc = np.tile(np.repeat(np.arange(b.num_rows), np.diff(at)), len(hashes))
        whole = np.repeat(np.arange(len(hashes)) == 0, len(hashes[0]))
        h = np.concatenate(hashes)
        order = np.lexsort([h, doc])
        h, doc, whole = h[order], doc[order], whole[order]
        once = (h != 0) & np.concatenate(([True], (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])))[: len(h)]
        h, whole, y = h[once], whole[once], label[doc[once]]
        key, code = np.unique(h, return_inverse=True)
        toxic = np.bincount(code, weights=y, minlength=len(key))
        every = np.bincount(code, minlength=len(key))
        words = np.bincount(code, weights=whole, minlength=len(key))
        yield pa.RecordBatch.from_arrays(
            [pa.array(key.view(np.int64)), pa.array(toxic.astype(np.int64)),
             pa.array((every - toxic).astype(np.int64)), pa.array(words.astype(np.int64))],
            ["token", "toxic", "clean", "words"])


def labelled(docs: DataFrame, labels: DataFrame, limit: int) -> DataFrame:
    """``text``, ``label`` of at most ``limit`` labelled documents outside the held-out fold."""
    use = labels.where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    use = sample(use.groupBy("doc_id").agg(F.max("label").cast("int").alias("label")), limit, "doc_id")
    rows = docs.select("doc_id", "text").join(F.broadcast(use), "doc_id")  # limit rows
    return rows.groupBy("doc_id", "label").agg(F.min("text").alias("text"))


def train(docs: DataFrame, labels: DataFrame, *, max_labelled: int = 20_000, prior: float = 0.1,
          z: float = 4.0, min_count: int = 4) -> Model:
    """``docs``: doc_id, text; ``labels``: doc_id, label."""
    rows = stage(labelled(docs, labels, max_labelled).select("text", "label"), "labelled")
    sums = rows.mapInArrow(_count, "token long, toxic long, clean long, words long")
    sums = sums.groupBy("token").agg(*[F.sum(c).alias(c) for c in ("toxic", "clean", "words")])
    sums = stage(sums, "token-counts")
    # totals of words; prefixes are counted beside the words they begin
    t = sums.agg(F.sum(F.when(F.col("words") > 0, F.col("toxic"))), F.sum(F.when(F.col("words") > 0, F.col("clean")))).first()
    n1, n0 = t[0] or 0, t[1] or 0
    share = rows.agg(F.avg("label")).first()[0]
    if not n1 or not n0 or not share or share == 1.0:
        return Model(np.zeros(0, np.uint64), np.zeros(0), -1.0, 1.0, constant=float(share or 0.0))
    prior *= n1 + n0
    alpha = F.lit(prior) * (F.col("toxic") + F.col("clean")) / F.lit(float(n1 + n0))
    odds = (F.log((F.col("toxic") + alpha) / (F.lit(float(n1 + prior)) - F.col("toxic") - alpha))
            - F.log((F.col("clean") + alpha) / (F.lit(float(n0 + prior)) - F.col("clean") - alpha)))
    error = F.sqrt(1 / (F.col("toxic") + alpha) + 1 / (F.col("clean") + alpha))
    top = (sums.where(F.col("toxic") >= min_count).select("token", odds.alias("odds"), (odds / error).alias("z"),
                                                          ((F.col("clean") + alpha) / (n0 + prior)).alias("q"))
           .where((F.col("z") > z) & (F.col("odds") > 0)).collect())  # of the labelled sample, each min_count times
    keys = np.array([r.token for r in top], np.int64).view(np.uint64)
    order = np.argsort(keys)
    keys, odd, q = keys[order], np.array([r.odds for r in top])[order], np.array([r.q for r in top])[order]
    model = Model(keys, odd, -1.0, 1.0)

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, data, off in chunks(batches, "text"):
            _, _, at, hashes = tokens(data, off)
            n = np.diff(np.searchsorted(model.hits(hashes)[0], at))
            yield pa.RecordBatch.from_arrays([b.column("label"), pa.array(n), pa.array(np.diff(at))],
                                             ["label", "hits", "words"])

    # a word outside the lexicon: its share among toxic over its share among clean words
    per = {r.label: (r.h, r.n) for r in rows.mapInArrow(hits, "label int, hits long, words long").groupBy(
        "label").agg(F.sum("hits").alias("h"), F.sum("words").alias("n")).collect()}  # two rows
    outside = [math.log((per[y][1] - per[y][0] + 1) / (per[y][1] + 2)) for y in (0, 1)]
    model.drift = min(outside[1] - outside[0], -1e-3)
    model.rate = _rate(odd, q, model.drift)

    def evidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, data, off in chunks(batches, "text"):
            x = [e for e, _ in model.documents(data, off)]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.float64()), b.column("label")], ["x", "label"])

    fit = rows.mapInArrow(evidence, "x double, label int").collect()  # max_labelled rows
    fit.sort(key=lambda r: (r.x, r.label))
    model.a, model.b = logistic(np.array([r.x for r in fit]), np.array([r.label for r in fit], float))
    return model


def _rate(odds: np.ndarray, q: np.ndarray, drift: float) -> float:
    """lambda > 0 with sum q exp(lambda s) + (1 - sum q) exp(lambda drift) = 1."""
    rest = max(1.0 - q.sum(), 1e-9)
    f = lambda x: (q * np.exp(np.minimum(x * odds, 500))).sum() + rest * math.exp(x * drift) - 1
    lo, hi = 1e-6, 1.0
    while f(hi) < 0 and hi < 64:
        hi *= 2
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if f(mid) < 0 else (lo, mid)
    return hi


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> tuple[float, float]:
    """Slope and intercept of a one-dimensional logistic fit (Newton, ridge on the slope)."""
    a, b = 0.0, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        w = np.maximum(p * (1 - p), 1e-9)
        g = np.array([((p - y) * x).sum() + ridge * a, (p - y).sum()])
        h = np.array([[(w * x * x).sum() + ridge, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        step *= min(1.0, 2.0 / max(np.abs(step).max(), 1e-12))
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-9:
            break
    return float(a), float(b)


def score_documents(docs: DataFrame, model: Model, *, doc_id: str = "doc_id", text: str = "text",
                    threshold: float = 0.7) -> DataFrame:
    """Per row: ``doc_id``, ``held_out``, ``score``, ``predicted``, ``n_segments``."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, data, off in chunks(batches, "text"):
            found = list(model.documents(data, off))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(model.score(np.array([x for x, _ in found]))),
                 pa.array([len(s) for _, s in found], pa.int32())], ["doc_id", "score", "n_segments"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        task, f"doc_id {kind}, score double, n_segments int")
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                       (F.col("score") >= threshold).cast("int").alias("predicted"), "n_segments")


def passages(docs: DataFrame, model: Model, *, doc_id: str = "doc_id", text: str = "text",
             max_expected: float = 0.05) -> DataFrame:
    """Every significant passage: ``doc_id``, word span ``first``..``last``, ``passage`` (its
    text), ``score`` and ``expected`` (passages as good in as much clean text)."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, data, off in chunks(batches, "text"):
            out = []
            raw = data.tobytes()
            ids = b.column("doc_id").to_pylist()
            n = np.diff(tokens(data, off)[2])
            for i, (_, segs) in enumerate(model.documents(data, off)):
                for first, last, s, x, y in segs:
                    e = float(n[i]) * math.exp(-min(model.rate * s, 700))
                    if e <= max_expected:
                        out.append((ids[i], first, last, raw[x:y].decode("utf-8", "replace"), s, e))
            cols = list(zip(*out)) or [()] * 6
            kinds = [b.schema.field("doc_id").type, pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                             ["doc_id", "first", "last", "passage", "score", "expected"])

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        task, f"doc_id {kind}, first long, last long, passage string, score double, expected double")
