"""Substring dedup by difference-cover anchors.

A window is ``window`` consecutive words of one document. Every word covered by a
window whose word sequence also starts earlier (smaller id, or the same document
at an earlier word) is removed; windows are judged on the input.

Method. The set ``COVER = {0, 1, 3, 9}`` is a difference cover modulo 13: for any
two positions i, j some shift d < 13 puts both i + d and j + d on cover positions
(modulo 13). So two equal 20-word windows always contain an equal 8-word run that
starts on a cover position in both documents. Only runs at cover positions (4 of
13) are hashed and shuffled. A run seen twice anywhere is an anchor; each anchor
extends to the windows around it that contain it, and only those windows get a
full hash (96 bits) and are compared by exact grouping. No pairs are formed.

Skew. Before both shuffles a task settles copies within itself: it sends one row
per distinct hash and task, so a passage held by a third of all rows contributes
at most one row per task to any key. Rows travel in packed blocks (``blocks.py``).
The text is exchanged once by document; both joins reuse that exchange.

Defined results. Null or empty text: no words, nothing removed, kept text ''.
Ids in ascending order, null first; rows with the same id are ordered by a hash of
their text (31 bits, carried only when ids repeat). Rows equal in id and text are one document: each gets the same result
and none counts as earlier than the other. Extra columns pass through. An empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewright.llm.blocks import SCHEMA as BLOCKS
from candlewright.llm.blocks import bucket_count, by_bucket, send, spread
from candlewright.llm.textops import Words, chunks, free_name, mix64, roll

#: A perfect difference set modulo 13: its pairwise differences give every residue.
PERIOD, COVER = 13, (0, 1, 3, 9)
#: Hashes held in one task before they are settled and sent on.
FLUSH = 4_000_000
NULL_ID = -(1 << 63)


def run_length(window: int) -> int:
    """Longest run that fits a window at every shift below the period."""
    n = window - PERIOD + 1
    if n < 1:
        raise ValueError(f"window must be at least {PERIOD} words")
    return n


def ref_columns(doc_id: Column, text: Column) -> tuple[Column, Column]:
    """Order key of a document and 31 bits of its text, to tell rows with one id apart."""
    return (F.coalesce(doc_id.cast("long"), F.lit(NULL_ID)),
            F.xxhash64(F.coalesce(text, F.lit(""))).bitwiseAND(F.lit(0x7FFFFFFF)))


def _flat(held: list[tuple]) -> list[np.ndarray]:
    return [np.concatenate(c) for c in zip(*held)]


def _groups(keys: list[np.ndarray], k: np.ndarray, pos: np.ndarray):
    """Order by (keys, k, pos) without equal rows; with it, whether a row's keys equal the
    row's before it."""
    order = np.lexsort([pos, k, *keys[::-1]])
    same = np.ones(max(0, len(order) - 1), bool)
    for c in keys:
        same &= c[order][1:] == c[order][:-1]
    equal = same & (k[order][1:] == k[order][:-1]) & (pos[order][1:] == pos[order][:-1])
    keep = np.concatenate(([True], ~equal))[: len(order)]
    return order[keep], np.concatenate(([False], same))[: len(order)][keep]


def _settle(keys: list[np.ndarray], k: np.ndarray, pos: np.ndarray, buckets: int,
            smallest: bool) -> Iterator[pa.RecordBatch]:
    """What a task knows by itself. One row per distinct key (its smallest reference) goes
    to the key's bucket: kind 0, or kind 1 when a copy here already makes it an anchor.
    The other references are settled and go anywhere: kind 2."""
    order, copy = _groups(keys, k, pos)
    keys, k, pos = [c[order] for c in keys], k[order], pos[order]
    first = ~copy
    has_copy = np.zeros(len(k), bool)
    has_copy[:-1] = copy[1:]
    for kind, rows in ((0, first & (smallest | ~has_copy)), (1, first & has_copy & (not smallest)), (2, copy)):
        if rows.any():
            key = spread(k[rows], pos[rows]) if kind == 2 else keys[0][rows]
            yield send(key, [c[rows] for c in keys[1:]] + [k[rows], pos[rows]], buckets, kind)


def _to_docs(k: np.ndarray, pos: np.ndarray, buckets: int) -> pa.RecordBatch:
    """Blocks of references, by document."""
    order = np.lexsort([pos, k])
    return send(mix64(k[order].view(np.uint64)), [k[order], pos[order]], buckets, 0)


def _by_doc(rows: dict[int, list[np.ndarray]]) -> pa.RecordBatch:
    """One row per document: its positions as a list."""
    _, k, pos = rows[0]
    order, _ = _groups([], k, pos)
    k, pos = k[order], pos[order]
    h, p = pos >> 32, (pos & 0xFFFFFFFF).astype(np.int32)
    edge = np.flatnonzero(np.concatenate(([True], (k[1:] != k[:-1]) | (h[1:] != h[:-1])))[: len(k)])
    lists = pa.ListArray.from_arrays(pa.array(np.append(edge, len(k)).astype(np.int32)), pa.array(p))
    return pa.RecordBatch.from_arrays([pa.array(k[edge]), pa.array(h[edge]), lists], ["_k", "_h", "_at"])


def _repeated(rows: dict[int, list[np.ndarray]], buckets: int) -> pa.RecordBatch:
    """References whose key another reference has too."""
    out = [c[1:] for kind, c in rows.items() if kind]
    if 0 in rows or 1 in rows:
        key, k, pos = _flat([rows[i] for i in (0, 1) if i in rows])
        order, copy = _groups([key], k, pos)
        many = copy.copy()
        many[:-1] |= copy[1:]
        out.append([k[order][many], pos[order][many]])
    k, pos = _flat(out)
    return _to_docs(k, pos, buckets)


def _not_first(rows: dict[int, list[np.ndarray]], buckets: int) -> pa.RecordBatch:
    """References that are not the smallest of their keys."""
    out = [rows[2][2:]] if 2 in rows else []
    if 0 in rows:
        key, key2, k, pos = rows[0]
        order, copy = _groups([key, key2], k, pos)
        out.append([k[order][copy], pos[order][copy]])
    return _to_docs(*_flat(out), buckets)


def _refs(b: pa.RecordBatch, doc: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    k = b.column("_k").to_numpy(zero_copy_only=False)
    h = b.column("_h").to_numpy(zero_copy_only=False)
    return k[doc], (h[doc] << 32) | pos


def _anchors(run: int, buckets: int, text: str):
    def flush(held, smallest):
        *keys, k, pos = _flat(held)
        yield from _settle(keys, k, pos, buckets, smallest)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b, data, off in chunks(batches, text):
            w = Words(data, off)
            if len(w.start) < run:
                continue
            doc = w.doc()
            pos = np.arange(len(doc)) - w.off[doc]
            at = np.flatnonzero(np.isin(pos % PERIOD, COVER) & (pos + run <= w.n_words[doc]))
            held.append((roll(w.hashes(), run, 0xA2C, at), *_refs(b, doc[at], pos[at])))
            n += len(at)
            if n >= FLUSH:
                yield from flush(held, False)
                held, n = [], 0
        if n:
            yield from flush(held, False)
    return task


def _lists(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Flat values and row lengths of a list column (null: empty)."""
    n = pc.fill_null(pc.list_value_length(col), 0).to_numpy(zero_copy_only=False)
    return col.flatten().to_numpy(zero_copy_only=False), n.astype(np.int64)


def _windows(window: int, run: int, buckets: int, text: str):
    def flush(held, smallest):
        *keys, k, pos = _flat(held)
        yield from _settle(keys, k, pos, buckets, smallest)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b, data, off in chunks(batches, text):
            w = Words(data, off)
            anchor, per = _lists(b.column("_at"))
            doc = np.repeat(np.arange(b.num_rows), per)
            cover = np.zeros(len(w.start) + window + 1, np.int64)
            # windows that contain the anchor start at most window - run words before it
            np.add.at(cover, w.off[doc] + np.maximum(0, anchor - (window - run)), 1)
            np.add.at(cover, w.off[doc] + anchor + 1, -1)
            at = np.flatnonzero(np.cumsum(cover)[: len(w.start)] > 0)
            wdoc = w.doc()
            at = at[at + window <= w.off[wdoc[at] + 1]]
            if not len(at):
                continue
            h = w.hashes()
            second = (roll(h, window, 0x5EED2, at) >> np.uint64(32)).astype(np.uint32)
            held.append((roll(h, window, 0x5EED1, at), second, *_refs(b, wdoc[at], at - w.off[wdoc[at]])))
            n += len(at)
            if n >= FLUSH:
                yield from flush(held, True)
                held, n = [], 0
        if n:
            yield from flush(held, True)
    return task


def _cut(window: int, text: str, keep: list[str], names: dict[str, str], digest: bool):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, data, off in chunks(batches, text):
            start, per = _lists(b.column("_at"))
            first = np.concatenate(([0], np.cumsum(per)))
            kept, n_words, n_removed = [], [], []
            raw = data.tobytes()
            for i in range(b.num_rows):
                words = raw[off[i]:off[i + 1]].split()
                gone = 0
                n_words.append(len(words))
                if per[i]:
                    cover = np.zeros(len(words) + 1, np.int64)
                    s = start[first[i]:first[i + 1]]
                    cover[np.unique(s)] += 1
                    np.add.at(cover, np.minimum(np.unique(s) + window, len(words)), -1)
                    stay = np.cumsum(cover)[:-1] <= 0
                    gone = int(len(words) - stay.sum())
                    words = compress(words, stay)
                out = b" ".join(words)
                n_removed.append(gone)
                kept.append(hashlib.sha256(out).hexdigest() if digest else out)
            cols = [b.column(c) for c in keep]
            cols += [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                     pa.array(kept, pa.binary()).cast(pa.string()) if not digest else pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays(cols, [*keep, names["words"], names["removed"], names["kept"]])
    return task


def repeated_windows(docs: DataFrame, window: int, doc_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """``docs`` with its reference columns ``_k``, ``_h``, and per document (``_k``, ``_h``)
    the starts ``_at`` of its windows that also start earlier."""
    run = run_length(window)
    buckets = bucket_count(docs, text)
    unique = docs.groupBy(doc_id).count().where("count > 1").isEmpty()
    k, h = ref_columns(F.col(doc_id), F.col(text))
    refs = docs.withColumns({"_k": k, "_h": F.lit(0).cast("long") if unique else h})

    def lists(rows: DataFrame, settle, kinds: list[str]) -> DataFrame:
        hits = by_bucket(rows, buckets, partial(settle, buckets=buckets), kinds, BLOCKS)
        return by_bucket(hits, buckets, _by_doc, ["u8", "i8", "i8"], "_k long, _h long, _at array<int>")

    runs = refs.select("_k", "_h", text).mapInArrow(_anchors(run, buckets, text), BLOCKS)
    near = refs.join(lists(runs, _repeated, ["u8", "i8", "i8"]), ["_k", "_h"])
    full = near.mapInArrow(_windows(window, run, buckets, text), BLOCKS)
    return refs, lists(full, _not_first, ["u8", "u4", "i8", "i8"])


def dedup_substrings(docs: DataFrame, window: int = 20, *, doc_id: str = "doc_id", text: str = "text",
                     digest: bool = False) -> DataFrame:
    """``docs`` (all columns) with ``n_words``, ``n_removed`` and the kept words joined by one
    space: ``kept_text``, or with ``digest`` its SHA-256 ``kept_sha256``. A clash with a
    column of ``docs`` gets a leading underscore."""
    names = {"words": free_name(docs, "n_words"), "removed": free_name(docs, "n_removed"),
             "kept": free_name(docs, "kept_sha256" if digest else "kept_text")}
    inner = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)])
    at = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    refs, hits = repeated_windows(inner, window, at[doc_id], at[text])
    keep = [c for c in inner.columns if not (digest and c == at[text])]
    schema = T.StructType([inner.schema[c] for c in keep] + [
        T.StructField("x_words", T.LongType()), T.StructField("x_removed", T.LongType()),
        T.StructField("x_kept", T.StringType())])
    out = refs.join(hits, ["_k", "_h"], "left").mapInArrow(
        _cut(window, at[text], keep, {"words": "x_words", "removed": "x_removed", "kept": "x_kept"}, digest),
        schema)
    back = {v: c for c, v in at.items()}
    return out.select(*[F.col(c).alias(back[c]) for c in keep], F.col("x_words").alias(names["words"]),
                      F.col("x_removed").alias(names["removed"]), F.col("x_kept").alias(names["kept"]))
