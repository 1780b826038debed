"""Words and hashes of Arrow text batches, and small staging helpers.

A word is a maximal run of characters other than space and ``\\x09-\\x0D``
(``[^\\x20\\x09-\\x0D]+``); in UTF-8 these separators are single bytes, so words
are found on the raw bytes of a batch without decoding. Null text has no words.

Word and shingle hashes are 64-bit, deterministic across processes, and computed
for a whole chunk of documents at once with numpy. Chunks are bounded in bytes
(a single longer document is a chunk of its own), so memory follows
``CHUNK_BYTES`` and the longest document, never the partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from candlewright.session import shared_dir

CHUNK_BYTES = 2 << 20

_U = np.uint64
_P = _U(0x9E3779B97F4A7C15 | 1)
_PINV = _U(pow(int(_P), -1, 1 << 64))
_SEP = np.zeros(256, bool)
_SEP[[32, 9, 10, 11, 12, 13]] = True


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finalizer (splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def seeds(seed: int, n: int) -> np.ndarray:
    """``n`` fixed odd 64-bit multipliers."""
    return mix64(np.arange(1, n + 1, dtype=np.uint64) * _P + _U(seed)) | _U(1)


_BYTE = mix64(np.arange(256, dtype=np.uint64) + _U(0xC0FFEE))
_pows: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "p" not in _pows or len(_pows["p"]) < n:
        n = max(n, CHUNK_BYTES + 1)
        for name, base in (("p", _P), ("i", _PINV)):
            t = np.full(n, base, np.uint64)
            t[0] = 1
            _pows[name] = np.cumprod(t, dtype=np.uint64)
    return _pows["p"], _pows["i"]


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """One 64-bit hash per byte span."""
    p, inv = _powers(len(data) + 1)
    s = np.empty(len(data) + 1, np.uint64)
    s[0] = 0
    np.cumsum(_BYTE[data] * p[: len(data)], out=s[1:])
    return mix64((s[end] - s[start]) * inv[start] + (end - start).astype(np.uint64))


class Words:
    """The words of a chunk: byte spans ``start``/``end`` into ``data``; the words of
    document ``i`` are ``off[i]:off[i + 1]``."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets
        n = len(data)
        word = ~_SEP[data]
        before = np.empty(n, bool)
        after = np.empty(n, bool)
        before[1:], after[:-1] = word[:-1], word[1:]
        if n:
            before[0] = after[-1] = False
        inner = offsets[(offsets > 0) & (offsets < n)]
        before[inner] = False
        after[inner - 1] = False
        self.start = np.flatnonzero(word & ~before)
        self.end = np.flatnonzero(word & ~after) + 1
        self.off = np.searchsorted(self.start, offsets)
        self.n_words = np.diff(self.off)

    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.n_words)), self.n_words)

    def hashes(self) -> np.ndarray:
        """One 64-bit hash per word."""
        return span_hashes(self.data, self.start, self.end)

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i]:self.offsets[i + 1]].tobytes()


def roll(h: np.ndarray, k: int, seed: int, at: np.ndarray | None = None) -> np.ndarray:
    """Hash of ``k`` consecutive items from each position (or the positions ``at``);
    the caller keeps only positions whose run stays inside one document."""
    m = seeds(seed, k)
    if at is None:
        at = np.arange(max(0, len(h) - k + 1))
    out = np.zeros(len(at), np.uint64)
    for j in range(k):
        out += h[at + j] * m[j]
    return mix64(out)


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the ``n + 1`` offsets (null: empty)."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    col = col.cast(pa.large_string())
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = col.buffers()
    off = np.frombuffer(offs, np.int64)[col.offset:col.offset + len(col) + 1]
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return buf[off[0]:off[-1]], off - off[0]


def chunks(batches: Iterator[pa.RecordBatch], text: str = "text",
           limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches with at most ``limit`` text bytes (or one document each),
    with their text bytes and offsets. Every row is in exactly one slice."""
    for b in batches:
        if not b.num_rows:
            continue
        data, off = text_bytes(b.column(text))
        lo = 0
        while lo < b.num_rows:
            hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, "right")) - 1)
            yield b.slice(lo, hi - lo), data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
            lo = hi


def long_key(h: np.ndarray) -> pa.Array:
    """uint64 hashes as a Spark long column."""
    return pa.array(h.view(np.int64))


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts lineage, so a
    lost executor costs only the tasks after it."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read(spark: SparkSession, sf_dir: str, table: str, columns: list[str]) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet").select(*columns)


def free_name(df: DataFrame, stem: str) -> str:
    """A column name not used by ``df`` (Spark compares names without case)."""
    used = {c.lower() for c in df.columns}
    name = stem
    while name.lower() in used:
        name = "_" + name
    return name
