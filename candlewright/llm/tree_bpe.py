"""Byte-pair encoding by tree concatenation, and decoding.

The model's merges are applied to many symbol runs at once (:meth:`Merges.merge`): in
every round each run merges all occurrences, left to right, of its pair of lowest rank.
A run of text that the pre-tokenizer does not split is halved down to leaves of at most
``LEAF`` symbols; leaves are encoded side by side, then the tree is climbed level by
level (:meth:`Merges.encode`). At every join the last and first ``w`` tokens of both
sides are encoded again together: when the first and the last token come out as they
were (or a side is covered whole), the window replaces them, else ``w`` doubles. This is
exact: a token sequence is the encoding of its text if and only if every two neighbours
are, so pairs outside the window, and those at its edges, keep.

Texts of any length are split by the vocabulary file's own normalizer and pre-tokenizer;
distinct units are encoded once and looked up (as in ``tokens``). Runs longer than
``SPLIT`` symbols (scripts without spaces, dumps, padding) leave their document: their
pieces are rows of their own, encoded by tasks in parallel, and come back to one task
per document which only concatenates and joins. Nothing else is shuffled. Only texts of more
than ``SPLIT`` bytes are staged; all others are finished where they are read.

Decoding joins the tokens' strings with one space, which is what the library does for a
file without a decoder; files with one are refused.

Defined results. Null text is empty and has no ids; its digests are those of ''. Special
tokens inside texts are their ids, as in the library. Repeated rows are encoded once
each. Extra columns do not matter; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewright.llm.alignment import byte_chars
from candlewright.llm.textops import chunks, stage
from candlewright.llm.tokens import Encoder

#: Symbols of a leaf.
LEAF = 16
#: Symbols of a run from which its pieces become rows.
SPLIT = 1 << 16
#: Units encoded, and documents decoded, at once.
BATCH, ROWS = 1 << 14, 128

NEVER = np.iinfo(np.int64).max


def ragged(values: np.ndarray, off: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``values[off[i] + lo[i] : off[i] + hi[i]]`` for all ``i``, and their offsets."""
    n = hi - lo
    out = np.concatenate(([0], np.cumsum(n)))
    return values[np.repeat(off[:-1] + lo - out[:-1], n) + np.arange(out[-1])], out


def interleave(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Row-wise concatenation of ragged arrays."""
    n = [np.diff(off) for _, off in parts]
    total = np.concatenate(([0], np.cumsum(sum(n))))
    out = np.empty(total[-1], np.int64)
    at = total[:-1].copy()
    for (values, off), k in zip(parts, n):
        out[np.repeat(at - off[:-1], k) + np.arange(off[-1])] = values
        at += k
    return out, total


class Merges:
    """The merge table of a byte-level vocabulary file whose words end in a suffix (or in none)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if spec.get("decoder") is not None or model.get("dropout") or model.get("continuing_subword_prefix"):
            raise ValueError("needs a BPE file without decoder, dropout and prefix")
        vocab = model["vocab"]
        self.tokens = {i: t for t, i in vocab.items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        end = model.get("end_of_word_suffix") or ""
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        if len(set(made.tolist())) < len(made):
            raise ValueError("a token made by two merges: neighbours would not decide an encoding")
        order = np.argsort(left << 32 | right)
        self.key, self.rank, self.made = (left << 32 | right)[order], order.astype(np.int64), made[order]
        # symbols: bytes inside a word, and bytes at its end
        chars = byte_chars()
        self.inner, self.last = np.zeros(256, np.int64), np.zeros(256, np.int64)
        for c, x in chars.items():
            self.inner[x], self.last[x] = vocab[c], vocab[c + end]
        self.char_byte = np.full(1 + max(map(ord, chars)), -1, np.int64)
        for c, x in chars.items():
            self.char_byte[ord(c)] = x
        # the symbols of every token
        size = 1 + max(self.tokens)
        symbols: list[list[int]] = [[] for _ in range(size)]
        for i, t in self.tokens.items():
            word = bool(end) and t.endswith(end) and t not in self.specials
            raw = [chars.get(c) for c in (t[:-len(end)] if word else t)]
            if raw and None not in raw:
                symbols[i] = self.inner[raw].tolist()
                if word:
                    symbols[i][-1] = int(self.last[raw[-1]])
        self.sym_off = np.concatenate(([0], np.cumsum([len(s) for s in symbols])))
        self.sym = np.array([x for s in symbols for x in s], np.int64)

    def symbols(self, word: str) -> np.ndarray:
        """Symbols of one pre-token (byte characters)."""
        raw = self.char_byte[np.frombuffer(word.encode("utf-32-le"), np.uint32)]
        out = self.inner[raw]
        out[-1:] = self.last[raw[-1:]]
        return out

    def expand(self, ids: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Back to symbols."""
        lo = np.zeros(len(ids), np.int64)
        n = np.diff(self.sym_off)[ids]
        start = self.sym_off[ids]
        out = np.concatenate(([0], np.cumsum(n)))
        values = self.sym[np.repeat(start + lo - out[:-1], n) + np.arange(out[-1])]
        return values, out[off]

    def merge(self, ids: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Encodings of symbol runs: rounds over the runs that still have a pair to merge."""
        n_runs = len(off) - 1
        run = np.repeat(np.arange(n_runs), np.diff(off))
        ids = ids.astype(np.int64)
        done_ids, done_run = [], []
        while len(ids):
            key = ids[:-1] << 32 | ids[1:]
            at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
            hit = (self.key[at] == key) & (run[1:] == run[:-1])
            rank = np.full(len(ids), NEVER)
            rank[:-1][hit] = self.rank[at[hit]]
            first = np.flatnonzero(np.concatenate(([True], run[1:] != run[:-1])))
            best = np.minimum.reduceat(rank, first)
            size = np.diff(np.append(first, len(ids)))
            live = np.repeat(best < NEVER, size)
            if not live.all():
                done_ids.append(ids[~live])
                done_run.append(run[~live])
                if not live.any():
                    break
            pick = live & (rank == np.repeat(best, size))
            # neighbouring picks overlap (a pair of equal tokens): take every second one, from the left
            p = np.flatnonzero(pick)
            streak = np.flatnonzero(np.concatenate(([True], np.diff(p) > 1)))
            within = np.arange(len(p)) - np.repeat(streak, np.diff(np.append(streak, len(p))))
            p = p[within % 2 == 0]
            ids[p] = self.made[at[p]]
            live[p + 1] = False
            ids, run = ids[live], run[live]
        if not done_ids:
            return np.zeros(0, np.int64), np.zeros(n_runs + 1, np.int64)
        out_ids, out_run = np.concatenate(done_ids), np.concatenate(done_run)
        order = np.argsort(out_run, kind="stable")
        return out_ids[order], np.searchsorted(out_run[order], np.arange(n_runs + 1))

    def join(self, left: tuple[np.ndarray, np.ndarray],
             right: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Encodings of the texts of ``left[i]`` and ``right[i]`` together."""
        (a, a_off), (b, b_off) = left, right
        n_a, n_b = np.diff(a_off), np.diff(b_off)
        rows = len(n_a)
        cut_a, cut_b = n_a.copy(), np.zeros(rows, np.int64)   # tokens kept on the left, dropped on the right
        middle: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        todo, w = np.flatnonzero((n_a > 0) & (n_b > 0)), 1
        while len(todo):
            la, lb = np.minimum(n_a[todo], w), np.minimum(n_b[todo], w)
            pick = np.concatenate((todo, [-1]))
            x = ragged(a, np.append(a_off[todo], 0), n_a[todo] - la, n_a[todo])
            y = ragged(b, np.append(b_off[todo], 0), np.zeros(len(todo), np.int64), lb)
            new, off = self.merge(*self.expand(*interleave([x, y])))
            same_a = (la == n_a[todo]) | (new[off[:-1]] == x[0][x[1][:-1]])
            same_b = (lb == n_b[todo]) | (new[off[1:] - 1] == y[0][y[1][1:] - 1])
            ok = same_a & same_b
            cut_a[todo[ok]] -= la[ok]
            cut_b[todo[ok]] = lb[ok]
            got = np.flatnonzero(ok)
            values, voff = ragged(new, np.append(off[got], 0), np.zeros(len(got), np.int64), np.diff(off)[got])
            middle.append((todo[got], values, np.diff(voff)))
            todo, w = pick[:-1][~ok], 2 * w
        row = np.concatenate([m[0] for m in middle]) if middle else np.zeros(0, np.int64)
        size = np.zeros(rows, np.int64)
        size[row] = np.concatenate([m[2] for m in middle]) if middle else 0
        order = np.argsort(np.repeat(row, size[row]), kind="stable") if len(row) else np.zeros(0, np.int64)
        values = np.concatenate([m[1] for m in middle])[order] if middle else np.zeros(0, np.int64)
        return interleave([ragged(a, a_off, np.zeros(rows, np.int64), cut_a),
                           (values, np.concatenate(([0], np.cumsum(size)))),
                           ragged(b, b_off, cut_b, n_b)])

    def climb(self, ids: np.ndarray, off: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Trees whose encoded leaves are neighbours (``nodes[i]`` of them, none is none) up to their roots."""
        while (nodes > 1).any():
            base = np.cumsum(nodes) - nodes
            half = (nodes + 1) // 2
            at = np.repeat(base - 2 * (np.cumsum(half) - half), half) + 2 * np.arange(half.sum())
            end = np.repeat(base + nodes, half)
            size = np.diff(off)
            zero = np.zeros(len(at), np.int64)
            mate = np.minimum(at + 1, len(size) - 1)
            left = ragged(ids, np.append(off[at], 0), zero, size[at])
            right = ragged(ids, np.append(off[mate], 0), zero, np.where(at + 1 < end, size[mate], 0))
            ids, off = self.join(left, right)
            nodes = half
        return ids, off

    def encode(self, symbols: np.ndarray, off: np.ndarray, leaf: int = LEAF) -> tuple[np.ndarray, np.ndarray]:
        """Encodings of symbol runs of any length: leaves side by side, then up the trees."""
        n = np.diff(off)
        nodes = np.maximum(1, 1 << np.ceil(np.log2(np.maximum(1, n) / leaf)).clip(0).astype(np.int64))
        run = np.repeat(np.arange(len(n)), nodes)
        k = np.arange(len(run)) - np.repeat(np.cumsum(nodes) - nodes, nodes)
        leaf_off = np.append(off[:-1][run] + n[run] * k // nodes[run], off[-1])
        return self.climb(*self.merge(symbols, leaf_off), nodes)


class TreeEncoder(Encoder):
    """Units looked up as in :class:`Encoder`; unseen ones are split by the file's own
    normalizer and pre-tokenizer and encoded by :class:`Merges`."""

    def __init__(self, path: str):
        super().__init__(path)
        self.merges = Merges(path)
        self.special = re.compile("|".join(map(re.escape, self.merges.specials)) or r"(?!)")

    def normal(self, text: str) -> str:
        n = self.tok.normalizer
        return text if n is None else n.normalize_str(text)

    def words(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """Pre-tokens (byte characters) of all texts, one after the other, and their number in each."""
        if not texts:
            return [], np.zeros(0, np.int64)
        got = [self.tok.pre_tokenizer.pre_tokenize_str(t) for t in texts] if len(texts) == 1 or not self.units else None
        if got is None:
            # white space splits words and is dropped, so many texts are split in one call
            ends = np.cumsum([len(t) + 1 for t in texts])
            pre = self.tok.pre_tokenizer.pre_tokenize_str(" ".join(texts))
            at = np.searchsorted(ends, np.fromiter((s for _, (s, _) in pre), np.int64, len(pre)), "right")
            return [w for w, _ in pre], np.bincount(at, minlength=len(texts))
        return [w for x in got for w, _ in x], np.array([len(x) for x in got])

    def split(self, text: str) -> list[str | int]:
        """Text between special tokens, and their ids."""
        out, at = [], 0
        for m in self.special.finditer(text):
            out += [text[at:m.start()], self.merges.specials[m.group()]]
            at = m.end()
        return [x for x in (*out, text[at:]) if x != ""]

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        m = self.merges
        n = np.array([len(w) for w in words], np.int64)
        off = np.concatenate(([0], np.cumsum(n))).astype(np.int64)
        raw = m.char_byte[np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)]
        symbols = m.inner[raw]
        symbols[off[1:] - 1] = m.last[raw[off[1:] - 1]]
        return m.encode(symbols, off)

    def encode_texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts one after the other, and their offsets."""
        parts = [self.split(t) if "<|" in t else [t] for t in texts]
        flat = [p for x in parts for p in x]
        is_text = np.array([isinstance(p, str) for p in flat], bool)
        plain = [p.lower() if self.lower and p.isascii() and not re.search(r"\s", p) else self.normal(p)
                 for p in flat if isinstance(p, str)]
        words, n_words = self.words(plain)
        ids, off = self.encode_words(words) if words else (np.zeros(0, np.int64), np.zeros(1, np.int64))
        n = np.ones(len(flat), np.int64)
        text_off = off[np.concatenate(([0], np.cumsum(n_words))).astype(np.int64)]
        n[is_text] = np.diff(text_off)
        out, out_off = np.empty(n.sum(), np.int64), np.concatenate(([0], np.cumsum(n)))
        filled = np.repeat(is_text, n)
        out[filled] = ids
        out[~filled] = [p for p in flat if not isinstance(p, str)]
        ends = np.concatenate(([0], np.cumsum([len(x) for x in parts]))).astype(np.int64)
        return out, out_off[ends]

    def _learn(self, h: np.ndarray, texts: list[str]) -> None:
        parts = [self.encode_texts(texts[k:k + BATCH]) for k in range(0, len(texts), BATCH)]
        n = np.concatenate([np.diff(off) for _, off in parts])
        self._keep(h, np.concatenate([ids for ids, _ in parts]).astype(np.uint32), np.concatenate(([0], np.cumsum(n))))

    def _keep(self, h: np.ndarray, ids: np.ndarray, off: np.ndarray) -> None:
        order = np.argsort(np.concatenate([self.h, h]), kind="stable")
        self.at = np.concatenate([self.at, len(self.pool) + off[:-1]])[order]
        self.n = np.concatenate([self.n, np.diff(off)])[order]
        self.h = np.concatenate([self.h, h])[order]
        self.pool = np.concatenate([self.pool, ids])


_encoders: dict[str, TreeEncoder] = {}


def tree_encoder(path: str) -> TreeEncoder:
    if path not in _encoders:
        _encoders[path] = TreeEncoder(path)
    return _encoders[path]


_names: dict[str, list[str]] = {}


def names(path: str) -> list[str]:
    """The strings of a file's tokens by id; kept between tasks."""
    if path not in _names:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if spec.get("decoder") is not None:
            raise ValueError("needs a file without decoder")
        tokens = {i: t for t, i in spec["model"]["vocab"].items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
        _names[path] = [tokens.get(i, "") for i in range(1 + max(tokens))]
    return _names[path]


# --- documents -----------------------------------------------------------------

DONE, IDS, RUN, MORE = 0, 1, 2, 3   # a finished document; its ids so far; a run to encode; its continuation
PIECES = "doc_id {kind}, key long, part int, kind int, ids array<int>"


def _pieces(path: str, split: int, text: str, doc_id: str):
    def pieces(enc: TreeEncoder, t: str) -> list[tuple[int, np.ndarray]]:
        """A document with long runs: ids and pieces of runs, in order."""
        out: list[tuple[int, np.ndarray]] = []
        for p in enc.split(t):
            if isinstance(p, int):
                out.append((IDS, np.array([p])))
                continue
            near: list[str] = []
            for w in [*enc.words([enc.normal(p)])[0], None]:
                if w is not None and len(w) <= split:
                    near.append(w)
                    continue
                if near:
                    out.append((IDS, enc.encode_words(near)[0]))
                    near = []
                if w is not None:
                    cuts = np.array_split(enc.merges.symbols(w), -(-len(w) // split))
                    out += [(MORE if k else RUN, c) for k, c in enumerate(cuts)]
        return out

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = tree_encoder(path)
        key = TaskContext.get().partitionId() << 40
        for b, data, off in chunks(batches, text):
            row, kind, part, lists = [], [], [], []
            big = np.zeros(b.num_rows, bool)
            for i in np.flatnonzero(np.diff(off) > split).tolist():
                t = data[off[i]:off[i + 1]].tobytes().decode()
                # a run has no white space inside; a code point gives at most 16 symbols
                if max(map(len, re.split(r"[\x20\x09-\x0D]+", t))) * 16 > split and \
                        any(len(w) > split for p in enc.split(t) if isinstance(p, str)
                            for w in enc.words([enc.normal(p)])[0]):
                    big[i] = True
                    for k, (what, ids) in enumerate(pieces(enc, t)):
                        row.append(i), kind.append(what), part.append(k), lists.append(ids)
            if big.any():
                keep = np.repeat(~big, np.diff(off))
                data, off = data[keep], np.concatenate(([0], np.cumsum(np.where(big, 0, np.diff(off)))))
            ids, at = enc.encode(data, off)
            for i in np.flatnonzero(~big).tolist():
                row.append(i), kind.append(DONE), part.append(0), lists.append(ids[at[i]:at[i + 1]])
            n = np.concatenate(([0], np.cumsum([len(x) for x in lists]))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column(doc_id).take(pa.array(row, pa.int64())), pa.array(np.array(row) + key),
                 pa.array(part, pa.int32()), pa.array(kind, pa.int32()),
                 pa.ListArray.from_arrays(pa.array(n), pa.array(np.concatenate(lists).astype(np.int32)))],
                ["doc_id", "key", "part", "kind", "ids"])
            key += b.num_rows
    return task


def _runs(path: str):
    """Encodes the pieces of long runs."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = tree_encoder(path)
        for b in batches:
            for i in range(b.num_rows):
                r = b.slice(i, 1)
                if r.column("kind")[0].as_py() != IDS:
                    x = r.column("ids").flatten().to_numpy().astype(np.int64)
                    ids, _ = enc.merges.encode(x, np.array([0, len(x)]))
                    r = r.set_column(4, "ids", pa.array([ids.astype(np.int32)], pa.list_(pa.int32())))
                yield r
    return task


def _concatenate(path: str):
    """One document's pieces in order: runs are joined as a tree, the rest is concatenated."""
    def whole(t: pa.Table) -> pa.Table:
        enc = tree_encoder(path)
        t = t.sort_by("part").combine_chunks()
        kind = t.column("kind").to_numpy()
        off = np.concatenate(([0], np.cumsum(t.column("ids").combine_chunks().value_lengths().to_numpy())))
        ids = t.column("ids").combine_chunks().flatten().to_numpy().astype(np.int64)
        nodes = np.diff(np.append(np.flatnonzero(kind != MORE), len(kind)))
        ids, _ = enc.merges.climb(ids, off, nodes)
        return pa.table([t.column("doc_id")[:1], pa.array([ids.astype(np.int32)], pa.list_(pa.int32()))], ["doc_id", "ids"])
    return whole


def encode(docs: DataFrame, vocab: str, *, doc_id: str = "doc_id", text: str = "text",
           split: int = SPLIT) -> DataFrame:
    """``doc_id`` and ``ids`` of every whole text."""
    name = docs.schema[doc_id].dataType.simpleString()
    long = F.coalesce(F.octet_length(text), F.lit(0)) > split

    def pieces(part: DataFrame) -> DataFrame:
        return part.select(doc_id, text).mapInArrow(_pieces(vocab, split, text, doc_id), PIECES.format(kind=name))
    done = pieces(docs.where(~long)).select("doc_id", "ids")
    rows = stage(pieces(docs.where(long)), "tree_bpe")
    parts = rows.where(F.col("kind") != DONE).repartition("key", "part")
    joined = (parts.mapInArrow(_runs(vocab), PIECES.format(kind=name))
              .groupBy("key").applyInArrow(_concatenate(vocab), f"doc_id {name}, ids array<int>"))
    return done.unionByName(rows.where(F.col("kind") == DONE).select("doc_id", "ids")).unionByName(joined)


def decode(encoded: DataFrame, vocab: str) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids_sha256`` and the text ``decoded``."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = names(vocab)
        digits = list(map(str, range(len(token))))
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                b = batch.slice(at, ROWS)
                ids = [x.values.to_numpy().tolist() for x in b.column("ids")]
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), pa.array(map(len, ids), pa.int64()),
                     pa.array([hashlib.sha256(" ".join(map(digits.__getitem__, x)).encode()).hexdigest() for x in ids],
                              pa.string()),
                     pa.array([" ".join(map(token.__getitem__, x)) for x in ids], pa.string())],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded"])
    name = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.mapInArrow(task, f"doc_id {name}, n_tokens long, ids_sha256 string, decoded string")
