"""Blocks of hashed references: the rows one task sends to one bucket, as one packed row.

Operators that group billions of short rows ``(hash, document, position)`` send them as
blocks ``(bucket, kind, block)``: hashes sorted and stored as differences, numbers as
byte planes, compressed together. A block costs a third of the same rows shuffled one
by one. Buckets split the hash space evenly; their number follows the input's size, so
a bucket stays small whatever the corpus. Blocks are ordinary rows: Spark shuffles,
retries and recovers them.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewright.llm.textops import mix64

SCHEMA = "bucket int, kind int, block binary"
#: Text bytes per bucket.
BUCKET_BYTES = 8 << 20


def bucket_count(docs: DataFrame, text: str) -> int:
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return max(1, math.ceil(size / BUCKET_BYTES))


def pack(cols: list[np.ndarray]) -> bytes:
    planes = [np.ascontiguousarray(c).view(np.uint8).reshape(len(c), -1).T.tobytes() for c in cols]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def unpack(block: bytes, kinds: list[str]) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(block)
    n = len(raw) // sum(np.dtype(k).itemsize for k in kinds)
    out, at = [], 0
    for k in kinds:
        size = np.dtype(k).itemsize * n
        planes = np.frombuffer(raw, np.uint8, size, at).reshape(-1, n)
        out.append(np.ascontiguousarray(planes.T).view(k).reshape(n))
        at += size
    return out


def send(key: np.ndarray, cols: list[np.ndarray], buckets: int, kind: int) -> pa.RecordBatch:
    """Blocks of the rows ``(key, *cols)``, by ``key`` (uint64, well mixed)."""
    order = np.argsort(key, kind="stable")
    key, cols = key[order], [c[order] for c in cols]
    # bucket by the top 32 bits: sorted keys are then in bucket order
    b = ((key >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)
    edge = np.flatnonzero(np.concatenate(([True], b[1:] != b[:-1]))) if len(b) else np.zeros(0, int)
    ends = np.append(edge[1:], len(b))
    rows = []
    for s, e in zip(edge, ends):
        k = key[s:e].copy()
        k[1:] -= key[s:e - 1]
        rows.append(pack([k, *[c[s:e] for c in cols]]))
    return pa.RecordBatch.from_arrays(
        [pa.array(b[edge]), pa.array(np.full(len(edge), kind, np.int32)), pa.array(rows, pa.binary())],
        ["bucket", "kind", "block"])


def spread(k: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """Keys for rows that need no company."""
    return mix64(k.view(np.uint64) * np.uint64(3) + pos.view(np.uint64))


def by_bucket(rows: DataFrame, buckets: int, settle: Callable, kinds: list[str], schema: str) -> DataFrame:
    """``settle({kind: [columns]}) -> RecordBatch`` on each bucket's rows; holds one bucket."""
    def columns(held: list[tuple[int, bytes]]) -> dict[int, list[np.ndarray]]:
        out: dict[int, list] = {}
        for kind, block in held:
            cols = unpack(block, kinds)
            cols[0] = np.cumsum(cols[0], dtype=np.uint64)
            out.setdefault(kind, []).append(cols)
        return {kind: [np.concatenate(c) for c in zip(*parts)] for kind, parts in out.items()}

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []
        for b in batches:
            for bucket, kind, block in zip(*(b.column(c).to_pylist() for c in ("bucket", "kind", "block"))):
                if bucket != at and held:
                    yield settle(columns(held))
                    held = []
                at = bucket
                held.append((kind, block))
        if held:
            yield settle(columns(held))

    return rows.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(task, schema)
