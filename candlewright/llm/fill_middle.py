"""Fill-in-middle by a piecewise-linear learned rank index over token boundaries.

A text's tokens are ``[A-Za-z]+|[^A-Za-z]`` in code points; its ``n + 1`` boundary
offsets grow with their rank. :func:`rank_index` fits line segments to all boundaries of
every whole text: a segment grows while some slope keeps each of its boundaries within
``error`` code points (shrinking cone, one pass), so their number follows the text's
shape, not its length. Each boundary's distance from its line is stored in one byte
beside the segments. :func:`locate` predicts the offset of any rank from its segment and
adds the stored residual: exact, in two array reads, without looking at the text.

:func:`fill_in_middle` draws two ranks and two format numbers from ``sha256("{seed}:" +
doc_id)``, looks the cuts up in the index, and rearranges prefix, middle and suffix; a
stored index serves any number of seeds. :func:`restore` is built of SQL functions.

Scale. Both steps are maps over rows: no shuffle, no driver state. Texts are scanned in
chunks of bounded bytes, so memory follows the chunk or the longest text; the index has
about one byte a token.

Defined results. Null text is empty; an empty text, one with a sentinel inside, or the
share of texts that ``plain_percent`` leaves out is ``plain`` and stays as it is. A null id
counts as an empty string in the draw. Repeated rows get equal results. All columns stay;
results are in one struct column each, named ``rank_index`` and ``fim``, with ``_`` in front where that
name is taken. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewright.llm.textops import chunks, free_name

#: Code points that a boundary may lie from its line; a residual then fits one byte.
ERROR = 120
WINDOW = 256

#: The sentinels of the output.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

INDEX = T.StructType([
    T.StructField("n", T.LongType()),
    T.StructField("first", T.ArrayType(T.LongType())),
    T.StructField("base", T.ArrayType(T.LongType())),
    T.StructField("slope", T.ArrayType(T.DoubleType())),
    T.StructField("residuals", T.BinaryType())])
FIM = T.StructType([
    T.StructField("n", T.LongType()), T.StructField("form", T.StringType()),
    T.StructField("prefix_chars", T.LongType()), T.StructField("middle_chars", T.LongType()),
    T.StructField("output", T.StringType())])

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True


def boundaries(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Boundary offsets (code points) of all texts of a chunk, one after the other, and
    the ``texts + 1`` places where each text's boundaries begin."""
    cont = np.flatnonzero((data & 0xC0) == 0x80)
    letter = _LETTER[data]
    inner = np.zeros(len(data), bool)          # a letter after a letter of the same text
    inner[1:] = letter[1:] & letter[:-1]
    inner[off[:-1][off[:-1] < len(data)]] = False
    inner[cont] = True
    starts = np.flatnonzero(~inner)
    # every text gets one more boundary, its end
    at = np.searchsorted(starts, off)
    n = np.diff(at)
    y = np.insert(starts, at[1:], off[1:])
    y -= np.searchsorted(cont, y)
    first = off - np.searchsorted(cont, off)
    return y - np.repeat(first[:-1], n + 1), at + np.arange(len(at))


def fit(y: np.ndarray, error: int = ERROR) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(first rank, base offset, slope)`` of the segments of a growing sequence."""
    first, slope = [], []
    at, n = 0, len(y)
    while at < n:
        lo, hi, i, size = -np.inf, np.inf, at + 1, WINDOW
        while i < n:
            j = min(n, i + size)
            dx = np.arange(i - at, j - at, dtype=np.float64)
            dy = (y[i:j] - y[at]).astype(np.float64)
            low = np.maximum(np.maximum.accumulate((dy - error) / dx), lo)
            high = np.minimum(np.minimum.accumulate((dy + error) / dx), hi)
            ok = int(np.argmax(low > high)) if low[-1] > high[-1] else j - i
            if ok:
                lo, hi = low[ok - 1], high[ok - 1]
            i += ok
            if i < j:
                break
            size *= 2
        first.append(at)
        slope.append((lo + hi) / 2 if np.isfinite(lo) else 0.0)
        at = i
    first = np.array(first, np.int64)
    return first, y[first], np.array(slope)


def predict(rank: np.ndarray, first: np.ndarray, base: np.ndarray, slope: np.ndarray) -> np.ndarray:
    s = np.searchsorted(first, rank, "right") - 1
    return base[s] + np.floor(slope[s] * (rank - first[s])).astype(np.int64)


def locate(index: dict, ranks: list[int]) -> list[int]:
    """Exact offsets of boundary ranks from a stored index."""
    r = np.array(ranks, np.int64)
    line = predict(r, np.array(index["first"], np.int64), np.array(index["base"], np.int64),
                   np.array(index["slope"], np.float64))
    return (line + np.frombuffer(index["residuals"], np.int8)[r]).tolist()


def rank_index(docs: DataFrame, text: str = "text", error: int = ERROR) -> DataFrame:
    """All columns of ``docs`` and the struct ``rank_index``."""
    if not 0 <= error <= ERROR:
        raise ValueError(f"error is 0 to {ERROR}: residuals are stored in one byte")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, data, off in chunks(batches, text):
            y, at = boundaries(data, off)
            rows = []
            for lo, hi in zip(at[:-1].tolist(), at[1:].tolist()):
                first, base, slope = fit(y[lo:hi], error)
                res = y[lo:hi] - predict(np.arange(hi - lo), first, base, slope)
                rows.append((hi - lo - 1, first, base, slope, res.astype(np.int8).tobytes()))
            n, first, base, slope, res = zip(*rows)
            col = pa.StructArray.from_arrays(
                [pa.array(n, pa.int64()), pa.array(first, pa.list_(pa.int64())), pa.array(base, pa.list_(pa.int64())),
                 pa.array(slope, pa.list_(pa.float64())), pa.array(res, pa.binary())], INDEX.fieldNames())
            yield pa.RecordBatch.from_arrays([*b.columns, col], [*b.schema.names, name])

    name = free_name(docs, "rank_index")
    return docs.mapInArrow(task, T.StructType([*docs.schema.fields, T.StructField(name, INDEX)]))


def fill_in_middle(docs: DataFrame, *, seed: int = 1, text: str = "text", doc_id: str = "doc_id",
                   index: str = "rank_index", plain_percent: int = 10, spm_percent: int = 20) -> DataFrame:
    """All columns of ``docs`` (with an index by :func:`rank_index`) and the struct ``fim``:
    ``n``, ``form`` (plain, psm or spm), ``prefix_chars``, ``middle_chars``, ``output``."""
    def cut(key, t, ix):
        t = t or ""
        digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
        h1, h2, h3, h4 = (int(digest[i:i + 8], 16) for i in (0, 8, 16, 24))
        n = ix["n"]
        if not t or h3 % 100 >= 100 - plain_percent or PREFIX in t or SUFFIX in t or MIDDLE in t:
            return n, "plain", None, None, t
        lo, hi = locate(ix, sorted((h1 % (n + 1), h2 % (n + 1))))
        p, m, s = t[:lo], t[lo:hi], t[hi:]
        if h4 % 100 < spm_percent:
            return n, "spm", lo, hi - lo, SUFFIX + s + PREFIX + p + MIDDLE + m
        return n, "psm", lo, hi - lo, PREFIX + p + SUFFIX + s + MIDDLE + m

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, _, _ in chunks(batches, text):
            rows = [cut(*r) for r in zip(b.column(doc_id).to_pylist(), b.column(text).to_pylist(),
                                         b.column(index).to_pylist())]
            n, form, prefix, middle, out = zip(*rows)
            col = pa.StructArray.from_arrays(
                [pa.array(n, pa.int64()), pa.array(form), pa.array(prefix, pa.int64()),
                 pa.array(middle, pa.int64()), pa.array(out, pa.string())], FIM.fieldNames())
            yield pa.RecordBatch.from_arrays([*b.columns, col], [*b.schema.names, name])

    name = free_name(docs, "fim")
    return docs.mapInArrow(task, T.StructType([*docs.schema.fields, T.StructField(name, FIM)]))


def restore(output: Column, form: Column) -> Column:
    """The exact text from an output and its form. A sentinel occurs once: texts that hold
    one are plain, and no piece of text can complete a part of one."""
    middle = F.substring_index(output, MIDDLE, -1)
    before = F.substring_index(output, MIDDLE, 1)

    def head(sentinel):
        return F.substring(F.substring_index(before, sentinel, 1), 4, 2**31 - 1)
    return (F.when(form == "psm", F.concat(head(SUFFIX), middle, F.substring_index(before, SUFFIX, -1)))
            .when(form == "spm", F.concat(F.substring_index(before, PREFIX, -1), middle, head(PREFIX)))
            .otherwise(output))
