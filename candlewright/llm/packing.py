"""Vector best-fit packing of token sequences.

A bin has three capacities: tokens, documents (pieces) and attention cost (the sum of
squared piece lengths, the cost of block-diagonal attention). Pieces are taken in
decreasing order of length; a piece goes to the open bin that satisfies every
constraint and scores best: smallest weighted norm of the residual vector after
placing (``score="norm"``) or largest weighted dot product of the piece's demand with
the residual before (``"dot"``). Bins are kept by their token residual, and a search
ends as soon as the token term alone cannot beat the best score found, so the choice
is the exact optimum over all open bins.

Scale. Texts are tokenized where they are read; only piece descriptions (about 40
bytes) are shuffled, dealt round-robin into groups of about ``GROUP`` pieces that are
packed independently. Equal, hot or repeated rows spread evenly by construction. A
group wastes less than one bin over one global packing whenever it holds enough short
pieces, under 1 in 10,000 bins at this group size.

Defined results. A document's ids are its text's ids and ``end_id``; a null or empty
text is ``[end_id]``. Only documents above the piece limit (the token capacity, or the
length whose square fits the attention capacity) are cut; the last piece may be
shorter. Repeated rows are packed once each. Ties go to the lowest bin number. Extra
columns do not matter; an empty table gives no rows.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from candlewright.llm.textops import chunks, stage
from candlewright.llm.tokens import encoder

GROUP = 65_536


class Bins:
    """Open bins of one group, found by token residual and then by (documents,
    attention) residual."""

    def __init__(self, tokens: int, docs: int, attention: int,
                 weights: tuple[float, float, float] = (1.0, 1e-5, 1e-5), score: str = "norm"):
        if score not in ("norm", "dot"):
            raise ValueError("score is 'norm' or 'dot'")
        self.cap, self.w, self.score = (tokens, docs, attention), weights, score
        self.by_tokens: dict[int, dict[tuple[int, int], list[int]]] = {}
        self.mask = 0  # bit r: some open bin has r tokens left
        self.n = 0

    def _value(self, s: int, r: int, d: int, a: int) -> float:
        (t, dd, aa), (wt, wd, wa) = self.cap, self.w
        if self.score == "norm":
            return (wt * ((r - s) / t) ** 2 + wd * ((d - 1) / dd) ** 2 + wa * ((a - s * s) / aa) ** 2)
        return -(wt * s * r / t / t + wd * d / dd / dd + wa * s * s * a / aa / aa)

    def _bound(self, s: int, r: int) -> float:
        """No bin with ``r`` tokens left, nor any later in the search, scores below this."""
        (t, dd, aa), (wt, wd, wa) = self.cap, self.w
        if self.score == "norm":
            return wt * ((r - s) / t) ** 2
        return -(wt * s * r / t / t + wd / dd + wa * s * s / aa)

    def _residuals(self, s: int) -> Iterator[int]:
        if self.score == "norm":
            m = self.mask >> s
            r = s
            while m:
                low = (m & -m).bit_length() - 1
                r += low
                yield r
                m >>= low + 1
                r += 1
        else:
            m = self.mask
            while m and m.bit_length() - 1 >= s:
                r = m.bit_length() - 1
                yield r
                m ^= 1 << r

    def place(self, s: int) -> int:
        best = None
        for r in self._residuals(s):
            if best and self._bound(s, r) >= best[0]:
                break
            for (d, a), ids in self.by_tokens[r].items():
                if d >= 1 and a >= s * s:
                    v = (self._value(s, r, d, a), ids[-1], r, d, a)
                    if best is None or v < best:
                        best = v
        if best is None:
            b, (r, d, a) = self.n, self.cap
            self.n += 1
        else:
            _, b, r, d, a = best
            states = self.by_tokens[r]
            states[d, a].pop()
            if not states[d, a]:
                del states[d, a]
                if not states:
                    del self.by_tokens[r]
                    self.mask &= ~(1 << r)
        r, d, a = r - s, d - 1, a - s * s
        if r and d and a > 0:
            self.by_tokens.setdefault(r, {}).setdefault((d, a), []).append(b)
            self.mask |= 1 << r
        return b


def pack_lengths(lengths: np.ndarray, tokens: int, docs: int, attention: int,
                 weights: tuple[float, float, float] = (1.0, 1e-5, 1e-5),
                 score: str = "norm") -> np.ndarray:
    """Bin number of each length (decreasing order, then order of arrival)."""
    bins = Bins(tokens, docs, attention, weights, score)
    out = np.empty(len(lengths), np.int64)
    for i in np.argsort(-lengths, kind="stable").tolist():
        out[i] = bins.place(int(lengths[i]))
    return out


def _pieces(path: str, limit: int, end_id: int, text: str, doc_id: str):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for b, data, off in chunks(batches, text):
            ids, at = enc.encode(data, off)
            row, piece, start, length, crc = [], [], [], [], []
            end = np.array([end_id], np.uint32)
            for i in range(b.num_rows):
                doc = np.concatenate([ids[at[i]:at[i + 1]], end]).astype("<u4")
                for p, s in enumerate(range(0, len(doc), limit)):
                    part = doc[s:s + limit]
                    row.append(i)
                    piece.append(p)
                    start.append(s)
                    length.append(len(part))
                    crc.append(zlib.crc32(part.tobytes()))
            yield pa.RecordBatch.from_arrays(
                [b.column(doc_id).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                 pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                ["doc_id", "piece", "start", "length", "ids_crc32"])
    return task


def _pack(tokens: int, docs: int, attention: int, weights, score: str):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = list(batches)  # one group: about GROUP short rows
        if not rows:
            return
        t = pa.Table.from_batches(rows)
        length = t.column("length").to_numpy()
        b = pack_lengths(length, tokens, docs, attention, weights, score)
        order = np.argsort(b, kind="stable")
        sizes = length[order]
        before = np.cumsum(sizes) - sizes
        first = np.concatenate(([True], b[order][1:] != b[order][:-1]))
        offset = np.empty(len(b), np.int64)
        offset[order] = before - np.maximum.accumulate(np.where(first, before, 0))
        t = t.append_column("sequence_id", pa.array(b + (TaskContext.get().partitionId() << 32)))
        yield from t.append_column("offset", pa.array(offset)).combine_chunks().to_batches()
    return task


def pack_documents(docs: DataFrame, vocab: str, *, tokens: int = 2048, max_docs: int = 2048,
                   max_attention: int | None = None, end_id: int = 0,
                   weights: tuple[float, float, float] = (1.0, 1e-5, 1e-5), score: str = "norm",
                   doc_id: str = "doc_id", text: str = "text", group: int = GROUP) -> DataFrame:
    """One row per piece: ``doc_id``, ``piece``, ``start`` (ids of its document before it),
    ``length``, ``ids_crc32``, ``sequence_id`` and ``offset`` (its place there)."""
    attention = tokens * tokens if max_attention is None else max_attention
    limit = min(tokens, math.isqrt(attention))
    if limit < 1 or max_docs < 1:
        raise ValueError("every capacity must hold one token")
    kind = docs.schema[doc_id].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"
    pieces = stage(docs.select(doc_id, text).mapInArrow(_pieces(vocab, limit, end_id, text, doc_id), schema),
                   "pieces")
    groups = max(1, math.ceil(pieces.count() / group))
    return pieces.repartition(groups).mapInArrow(_pack(tokens, max_docs, attention, weights, score),
                                                 schema + ", sequence_id long, offset long")
