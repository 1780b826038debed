"""Alignment of two tokenizers' tokens by products of sparse incidence matrices.

For a run of text, ``A`` (tokens of the first tokenizer x bytes) and ``B`` (tokens of the
second x bytes) are 0/1 incidence matrices in compressed sparse rows (:class:`Rows`,
built here from token lengths). Row products in Gustavson's order (:func:`multiply`: the
rows of the right factor that a left row names are added up) give

* ``A Bᵀ``: an entry for every two tokens that overlap, its value the bytes they share
  (*overlap links*); those whose byte ranges end together are the *end links*;
* ``A·G`` with the byte x group incidence ``G`` (groups are the runs between offsets where
  both tokenizers end a token): the group of every token; the product of the two
  token-group incidences gives an entry for every two tokens of one group (*group links*),
  its transposes the members of each group.

Products run in blocks of rows, so a block's entries bound the memory, and links of long
groups come out block by block.

:func:`align` aligns every whole text. Texts are cut into units before a single space
between two printable characters: neither tokenizer joins text across such a place, so
both end a token there and a text's groups are its units' groups in order. The products
run over distinct units and are kept in a bounded cache; occurrences look them up. Texts
that hold a unit whose tokens do not spell its bytes are encoded whole.

Counts of linked id pairs are corpus-wide: pairs are counted per chunk of documents
(bounded bytes), summed by (a, b) with Spark, joined with the best count of their b id,
brought back to their chunk (one row per chunk and distinct pair, so a pair that is in
every text has one row per chunk, not per text), and read there by every document. Every
partition of a shuffle is keyed by pair, b id (at most the first vocabulary's size in rows) or chunk.

Defined results. The first tokenizer sees a space and the text, the second the text (it
adds the space); special tokens inside texts are plain text. Null and empty texts, and
texts whose tokens' bytes differ from space and text in either tokenizer, have no tokens:
zeros and ``''``. Repeated rows count as often as they occur. Extra columns do not matter;
an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlewright.llm.textops import chunks, span_hashes, stage

#: Entries of a product that are expanded at once.
BLOCK = 1 << 18
#: Distinct units kept by a worker, and units aligned together.
CACHE, BATCH = 500_000, 1 << 14


# --- sparse rows ---------------------------------------------------------------

class Rows(NamedTuple):
    """Compressed sparse rows: row ``i`` has columns ``col[ptr[i]:ptr[i + 1]]``."""
    ptr: np.ndarray
    col: np.ndarray
    val: np.ndarray
    width: int

    @property
    def height(self) -> int:
        return len(self.ptr) - 1

    def row_of(self) -> np.ndarray:
        return np.repeat(np.arange(self.height), np.diff(self.ptr))


def incidence(lengths: np.ndarray, width: int | None = None) -> Rows:
    """Tokens x bytes: token ``i`` covers the ``lengths[i]`` bytes after those before it."""
    ptr = np.concatenate(([0], np.cumsum(lengths))).astype(np.int64)
    n = int(ptr[-1])
    return Rows(ptr, np.arange(n), np.ones(n, np.int64), n if width is None else width)


def transpose(m: Rows) -> Rows:
    order = np.argsort(m.col, kind="stable")
    ptr = np.concatenate(([0], np.cumsum(np.bincount(m.col, minlength=m.width))))
    return Rows(ptr, m.row_of()[order], m.val[order], m.height)


def multiply(a: Rows, b: Rows, block: int = BLOCK) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The entries ``(row, column, value)`` of ``a b`` by rows, in blocks of whole rows of
    ``a`` (a row that alone expands to more is a block of its own)."""
    fan = np.diff(b.ptr)[a.col]                       # entries each entry of a brings in
    work = np.concatenate(([0], np.cumsum(fan)))[a.ptr]
    lo = 0
    while lo < a.height:
        hi = max(lo + 1, int(np.searchsorted(work, work[lo] + block, "right")) - 1)
        e = slice(a.ptr[lo], a.ptr[hi])
        n = fan[e]
        before = np.cumsum(n) - n
        at = np.repeat(b.ptr[a.col[e]] - before, n) + np.arange(int(n.sum()))
        row = np.repeat(np.repeat(np.arange(lo, hi), np.diff(a.ptr[lo:hi + 1])), n)
        col, val = b.col[at], np.repeat(a.val[e], n) * b.val[at]
        key = row * b.width + col
        if len(key) and (key[1:] < key[:-1]).any():
            order = np.argsort(key, kind="stable")
            key, val = key[order], val[order]
        if len(key):
            first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            key = key[first]
            yield key // b.width, key % b.width, np.add.reduceat(val, first)
        lo = hi


class Alignment(NamedTuple):
    """Two tokenizations of the same bytes."""
    a: Rows            # tokens x bytes
    b: Rows
    group_a: Rows      # tokens x groups, value: bytes in the group
    group_b: Rows


def alignment(len_a: np.ndarray, len_b: np.ndarray) -> Alignment:
    """Both incidences and the token-group incidences ``A·G`` and ``B·G``."""
    a, b = incidence(len_a), incidence(len_b)
    ends = a.ptr[1:][np.diff(a.ptr) > 0]
    other = np.append(b.ptr[1:], -1)
    ends = ends[other[np.searchsorted(b.ptr[1:], ends)] == ends]
    n = len(ends)
    group = Rows(np.arange(a.width + 1), np.repeat(np.arange(n), np.diff(ends, prepend=0)),
                 np.ones(a.width, np.int64), n)
    return Alignment(a, b, *(_gather(multiply(m, group), m.height, n) for m in (a, b)))


def _gather(entries, height: int, width: int) -> Rows:
    parts = list(entries) or [(np.zeros(0, np.int64),) * 3]
    row, col, val = (np.concatenate(x) for x in zip(*parts))
    return Rows(np.concatenate(([0], np.cumsum(np.bincount(row, minlength=height)))), col, val, width)


def overlap_links(x: Alignment) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    return multiply(x.a, transpose(x.b))


def end_links(x: Alignment) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for i, j, shared in overlap_links(x):
        keep = x.a.ptr[i + 1] == x.b.ptr[j + 1]
        yield i[keep], j[keep], shared[keep]


def group_links(x: Alignment) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Tokens of one group; the value is not used (products of byte counts)."""
    return multiply(x.group_a, transpose(x.group_b))


# --- the two tokenizers --------------------------------------------------------

def byte_chars() -> dict[str, int]:
    """Byte-level vocabularies write bytes as characters: printable ones of Latin-1 as
    themselves, the others, in order, from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [x for x in range(256) if x not in set(shown)]
    return {**{chr(x): x for x in shown}, **{chr(256 + i): x for i, x in enumerate(hidden)}}


class Pair:
    """Both tokenizers and their tokens' bytes; one per Python worker."""

    def __init__(self, path_a: str, path_b: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer
        self.tok_a = Tokenizer.from_file(path_a)
        self.tok_a.encode_special_tokens = True
        self.tok_b = SentencePieceProcessor(model_file=path_b)
        bytes_of = byte_chars()
        specials = {t.content for t in self.tok_a.get_added_tokens_decoder().values()}
        self.bytes_a = []
        for i in range(self.tok_a.get_vocab_size()):
            t = self.tok_a.id_to_token(i)
            self.bytes_a.append(t.encode() if t in specials else bytes(bytes_of[c] for c in t))
        self.bytes_b = [bytes([int(p[1:-1], 16)]) if self.tok_b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in ((i, self.tok_b.id_to_piece(i)) for i in range(self.tok_b.get_piece_size()))]
        self.len_a = np.array([len(x) for x in self.bytes_a])
        self.len_b = np.array([len(x) for x in self.bytes_b])
        self.n_a, self.n_b = len(self.len_a), len(self.len_b)
        self.written = [f"{i}{sign}" for n, signs in ((self.n_a, ",|"), (self.n_b, ",;")) for sign in signs
                        for i in range(n)]
        self.written_len = np.array([len(w) for w in self.written])
        #: no piece holds a space after another character, so none crosses a cut
        self.cuts = not any(b" " in x.lstrip(b" ") for x in self.bytes_b)
        self.clear()

    def clear(self) -> None:
        self.hash = np.zeros(0, np.uint64)
        self.slot = np.zeros(0, np.int64)
        self.text: list[str] = []
        #: by slot: tokens, groups, whether the tokens spell the unit, and its codes in the pool
        self.size = np.zeros((0, 3), np.int64)
        self.good = np.zeros(0, bool)
        self.code_at = np.zeros(1, np.int64)
        self.pool = np.zeros(0, np.int64)

    def encode(self, texts: list[bytes]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of texts that begin with the space which the second tokenizer adds."""
        s = [t.decode("utf-8", "replace") for t in texts]
        return ([e.ids for e in self.tok_a.encode_batch_fast(s, add_special_tokens=False)],
                self.tok_b.encode([t[1:] for t in s], num_threads=1))

    def spells(self, text: bytes, a: list[int], b: list[int]) -> bool:
        return (b"".join(map(self.bytes_a.__getitem__, a)) == text
                and b"".join(map(self.bytes_b.__getitem__, b)) == text)

    def learn(self, texts: list[bytes]) -> range:
        """Align new texts, together in one product; their slots."""
        ids_a, ids_b = self.encode(texts)
        good = np.ones(len(texts), bool)
        if not self.spells(b"".join(texts), [i for x in ids_a for i in x], [i for x in ids_b for i in x]):
            good[:] = [self.spells(*x) for x in zip(texts, ids_a, ids_b)]
            ids_a = [x if g else [] for x, g in zip(ids_a, good)]
            ids_b = [x if g else [] for x, g in zip(ids_b, good)]
        n_a, n_b = (np.fromiter(map(len, x), np.int64, len(x)) for x in (ids_a, ids_b))
        a, b = (np.fromiter((i for y in x for i in y), np.int64, int(n.sum())) for x, n in ((ids_a, n_a), (ids_b, n_b)))
        x = alignment(self.len_a[a], self.len_b[b])
        own = np.repeat(np.arange(len(texts)), n_a)            # the text of each token of A
        parts = [(own[i], a[i] << 32 | b[j]) for i, j, _ in end_links(x)] or [(own[:0], a[:0])]
        at, code = (np.concatenate(p) for p in zip(*parts))
        edge = np.arange(len(texts) + 1)
        members = transpose(x.group_a)
        group_at = np.searchsorted(own[members.col[members.ptr[:-1]]], edge)
        lo = len(self.text)
        self.text += self._groups(a, b, x, group_at)
        self.size = np.concatenate([self.size, np.stack([n_a, n_b, np.diff(group_at)], 1)])
        self.good = np.concatenate([self.good, good])
        self.code_at = np.concatenate([self.code_at, len(self.pool) + np.searchsorted(at, edge[1:])])
        self.pool = np.concatenate([self.pool, code])
        return range(lo, len(self.text))

    def _groups(self, a: np.ndarray, b: np.ndarray, x: Alignment, group_at: np.ndarray) -> list[str]:
        """``a1,a2|b1;a3|b2`` of every text: all tokens written in one pass, in the order of
        groups and, inside a group, of A before B, each with the sign that follows it."""
        ptr_a, ptr_b = transpose(x.group_a).ptr, transpose(x.group_b).ptr
        item = np.empty(len(a) + len(b), np.int64)
        end_a, end_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
        end_a[ptr_a[1:] - 1] = end_b[ptr_b[1:] - 1] = True     # every group has tokens of both
        item[np.arange(len(a)) + ptr_b[x.group_a.col]] = a + self.n_a * end_a
        item[np.arange(len(b)) + ptr_a[x.group_b.col + 1]] = 2 * self.n_a + b + self.n_b * end_b
        whole = "".join(map(self.written.__getitem__, item.tolist()))
        cut = np.concatenate(([0], np.cumsum(self.written_len[item])))[(ptr_a + ptr_b)[group_at]].tolist()
        return [whole[i:max(i, j - 1)] for i, j in zip(cut[:-1], cut[1:])]

    def look_up(self, hashes: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The slot of every unit; unseen ones are learnt."""
        uniq, first, code = np.unique(hashes, return_index=True, return_inverse=True)

        def unseen():
            if not len(self.hash):
                return np.ones(len(uniq), bool)
            at = np.minimum(np.searchsorted(self.hash, uniq), len(self.hash) - 1)
            return self.hash[at] != uniq
        new = unseen()
        if new.any() and len(self.hash) + new.sum() > CACHE:  # start anew with this chunk
            self.clear()
            new = unseen()
        if new.any():
            at = first[new]
            slots = [s for k in range(0, len(at), BATCH) for s in self.learn(
                [data[a:b].tobytes() for a, b in zip(start[at[k:k + BATCH]], end[at[k:k + BATCH]])])]
            h = np.concatenate([self.hash, uniq[new]])
            order = np.argsort(h, kind="stable")
            self.slot = np.concatenate([self.slot, np.array(slots, np.int64)])[order]
            self.hash = h[order]
        return self.slot[np.searchsorted(self.hash, uniq)][code]


_pairs: dict[tuple[str, str], Pair] = {}


def pair(path_a: str, path_b: str) -> Pair:
    if (path_a, path_b) not in _pairs:
        _pairs[path_a, path_b] = Pair(path_a, path_b)
    return _pairs[path_a, path_b]


# --- whole texts ---------------------------------------------------------------

#: ASCII printable characters other than space, and lead bytes of U+00C0 to U+07FF (no white space there).
_SHOWN = np.zeros(256, bool)
_SHOWN[0x21:0x7F] = True
_LEAD = np.zeros(256, bool)
_LEAD[0xC3:0xE0] = True


def spaced(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A space before every text that is not empty."""
    has = np.diff(off) > 0
    return np.insert(data, off[:-1][has], 32), off + np.concatenate(([0], np.cumsum(has)))


def unit_starts(data: np.ndarray, off: np.ndarray, cuts: bool) -> np.ndarray:
    """Starts of the units: texts, and single spaces between two shown characters."""
    begin = off[:-1][np.diff(off) > 0]
    if not cuts:
        return begin
    shown = _SHOWN[data]
    before = shown.copy()                                # a shown character ends here
    before[1:] |= _LEAD[data[:-1]] & ((data[1:] & 0xC0) == 0x80)
    after = shown | _LEAD[data]                          # or begins here
    at = np.flatnonzero(data[1:-1] == 32) + 1
    at = at[before[at - 1] & after[at + 1]]
    first = np.zeros(len(data), bool)
    first[begin] = first[at] = True
    return np.flatnonzero(first)


def _align(path_a: str, path_b: str, text: str, doc_id: str):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pair(path_a, path_b)
        number = TaskContext.get().partitionId() << 32
        for b, data, off in chunks(batches, text):
            data, off = spaced(data, off)
            start = unit_starts(data, off, p.cuts)
            end = np.append(start[1:], off[-1])
            unit = p.look_up(span_hashes(data, start, end), data, start, end) if len(start) else start
            at = np.searchsorted(start, off)
            bad = np.flatnonzero(~p.good[unit])
            for i in np.unique(np.searchsorted(at, bad, "right") - 1)[::-1].tolist():
                # the whole text as one unit; without tokens if that does not spell it either
                k = p.learn([data[off[i]:off[i + 1]].tobytes()])[0]
                own = np.array([k] if p.good[k] else [], np.int64)
                unit = np.concatenate([unit[:at[i]], own, unit[at[i + 1]:]])
                at = at + (np.arange(len(at)) > i) * (len(own) - (at[i + 1] - at[i]))
            n_codes = np.diff(p.code_at)[unit]
            place = np.cumsum(n_codes) - n_codes
            code = p.pool[np.repeat(p.code_at[unit] - place, n_codes) + np.arange(int(n_codes.sum()))]
            total = np.concatenate(([0], np.cumsum(n_codes)))[at]
            sums = np.concatenate((np.zeros((1, 3), np.int64), np.cumsum(p.size[unit], 0)))[at]
            words = list(map(p.text.__getitem__, unit.tolist()))
            groups = [";".join(words[i:j]) for i, j in zip(at[:-1].tolist(), at[1:].tolist())]
            shas = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]
            if len(p.text) > 2 * CACHE:
                p.clear()
            uniq, slot, count = np.unique(code, return_inverse=True, return_counts=True)
            rank = np.argsort(np.argsort(-count, kind="stable"), kind="stable")  # small numbers for common pairs
            back = np.argsort(rank, kind="stable")
            pairs = pa.StructArray.from_arrays(
                [pa.array((uniq >> 32)[back].astype(np.int32)), pa.array((uniq & 0xFFFFFFFF)[back].astype(np.int32)),
                 pa.array(count[back])], ["a", "b", "n"])
            held = np.concatenate(([0], np.full(b.num_rows, len(uniq)))).astype(np.int32)  # all in the first row
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(b.num_rows, number)), b.column(doc_id).cast(pa.int64()),
                 *map(pa.array, np.diff(sums, axis=0).T), pa.array(np.diff(total)), pa.array(shas), pa.array(groups),
                 pa.ListArray.from_arrays(pa.array(total.astype(np.int32)), pa.array(rank[slot].astype(np.int32))),
                 pa.ListArray.from_arrays(pa.array(held), pairs)],
                ["chunk", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "groups", "links", "pairs"])
            number += 1
    return task


ALIGNED = ("chunk long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
           "groups string, links array<int>, pairs array<struct<a:int,b:int,n:long>>")


def align(docs: DataFrame, path_a: str, path_b: str, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: token, group and link numbers, ``groups`` (``a1,a2|b1;a3|b2``),
    and its end links as places in its chunk's ``pairs`` (id pairs and their number in the
    chunk, held by the chunk's first row)."""
    return docs.select(doc_id, text).mapInArrow(_align(path_a, path_b, text, doc_id), ALIGNED)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``a``, ``b``, ``count`` (links of the corpus) and ``best``: no other ``a`` has more with this ``b``."""
    n = (aligned.select(F.explode("pairs").alias("p")).groupBy("p.b", "p.a").agg(F.sum("p.n").alias("count")))
    top = F.max("count").over(Window.partitionBy("b"))
    return n.withColumn("best", F.col("count") == top)


def score_links(aligned: DataFrame) -> DataFrame:
    """Per document (``aligned`` is a written table) ``n_best`` and ``count_sum`` beside its numbers."""
    held = aligned.select("chunk", F.posexplode("pairs").alias("slot", "p")).select("chunk", "slot", "p.a", "p.b")
    counted = (held.join(pair_counts(aligned), ["a", "b"])
               .select(F.col("chunk").alias("of"), "slot", "count", "best"))
    keep = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    docs = aligned.select("chunk", "links", *keep)

    def read(docs: pa.Table, counts: pa.Table) -> pa.Table:
        slot = counts.column("slot").to_numpy()
        count, best = np.zeros(len(slot), np.int64), np.zeros(len(slot), np.int64)
        count[slot] = counts.column("count").to_numpy()
        best[slot] = counts.column("best").to_numpy(zero_copy_only=False)
        links = docs.column("links").combine_chunks()
        end = np.concatenate(([0], np.cumsum(docs.column("n_links").to_numpy())))
        flat = links.flatten().to_numpy(zero_copy_only=False)
        total = [np.concatenate(([0], np.cumsum(x[flat]))) for x in (best, count)]
        t = docs.select(keep)
        for name, x in zip(("n_best", "count_sum"), total):
            t = t.append_column(name, pa.array(x[end[1:]] - x[end[:-1]], pa.int64()))
        return t

    schema = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, "
              "count_sum long")
    return docs.groupBy("chunk").cogroup(counted.groupBy("of")).applyInArrow(read, schema)


def alignment_digests(docs: DataFrame, path_a: str, path_b: str, **names) -> DataFrame:
    """Per document: ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum``, ``groups_sha256``."""
    return score_links(stage(align(docs, path_a, path_b, **names).drop("groups"), "aligned"))


LINKS = {"overlap": overlap_links, "end": end_links, "group": group_links}


def token_links(docs: DataFrame, path_a: str, path_b: str, kind: str = "overlap", *, doc_id: str = "doc_id",
                text: str = "text") -> DataFrame:
    """Every link of a kind: ``doc_id``, places and ids of both tokens, ``shared`` bytes (null for groups)."""
    links = LINKS[kind]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pair(path_a, path_b)
        for b, data, off in chunks(batches, text):
            data, off = spaced(data, off)
            raw = [data[x:y].tobytes() for x, y in zip(off[:-1], off[1:])]
            for i, (t, ids_a, ids_b) in enumerate(zip(raw, *p.encode(raw))):
                if not t or not p.spells(t, ids_a, ids_b):
                    continue
                a, c = np.array(ids_a), np.array(ids_b)
                for x, y, shared in links(alignment(p.len_a[a], p.len_b[c])):
                    n = len(x)
                    yield pa.RecordBatch.from_arrays(
                        [b.column(doc_id).cast(pa.int64()).take(pa.array(np.full(n, i))), pa.array(x), pa.array(a[x]),
                         pa.array(y), pa.array(c[y]), pa.array(shared) if kind != "group" else pa.nulls(n, pa.int64())],
                        ["doc_id", "a_at", "a", "b_at", "b", "shared"])

    return docs.select(doc_id, text).mapInArrow(
        task, "doc_id long, a_at long, a long, b_at long, b long, shared long")
