"""Token ids of whole texts with the ``tokenizers`` library, a batch at a time.

The ids equal ``Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids``.
The library is asked once per distinct unit instead of once per occurrence: the
pre-tokenizer of the vocabularies used here never joins text across ASCII white space
nor from an ASCII letter into ASCII punctuation, so a text's ids are the ids of its
units in order. ``|`` is no cut, so special tokens stay whole; text is lower-cased for
the cache only when the file itself lower-cases and the chunk holds no ``<|``. A file
with another pre-tokenizer is used without units (``exact=False`` is never guessed:
see :func:`_splits`).

The cache is keyed by a 64-bit hash of the unit and holds ``CACHE`` units, then starts
anew; memory does not grow with the corpus. Null text is empty and has no ids.
"""

from __future__ import annotations

import json
import os

import numpy as np

from candlewright.llm.textops import Words

CACHE = 1_000_000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_PUNCT = np.zeros(256, bool)
_PUNCT[33:48] = _PUNCT[58:65] = _PUNCT[91:97] = _PUNCT[123:127] = True
_PUNCT[ord("|")] = False

#: Fixed value: the pre-tokenizer pattern for which units are known to be exact.
UNIT_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _splits(path: str) -> tuple[bool, bool]:
    """(units are exact, the file lower-cases)."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    norm = json.dumps(spec.get("normalizer"))
    pre = json.dumps(spec.get("pre_tokenizer"))
    return json.dumps(UNIT_PATTERN) in pre and '"Removed"' in pre, '"Lowercase"' in norm


class Encoder:
    """Encodes chunks of documents; one per Python worker (see :func:`encoder`)."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.units, self.lower = _splits(path)
        self.wide = self.tok.get_vocab_size() > 1 << 16
        self.clear()

    def clear(self) -> None:
        self.h = np.zeros(0, np.uint64)
        self.at = np.zeros(0, np.int64)
        self.n = np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.uint32)

    def _learn(self, h: np.ndarray, texts: list[str]) -> None:
        if len(self.h) + len(h) > CACHE:
            self.clear()
        ids = [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]
        n = np.fromiter(map(len, ids), np.int64, len(ids))
        at = len(self.pool) + np.concatenate(([0], np.cumsum(n)[:-1])) if len(n) else n
        self.pool = np.concatenate([self.pool, np.fromiter((i for x in ids for i in x), np.uint32, int(n.sum()))])
        order = np.argsort(np.concatenate([self.h, h]), kind="stable")
        self.h = np.concatenate([self.h, h])[order]
        self.at = np.concatenate([self.at, at])[order]
        self.n = np.concatenate([self.n, n])[order]

    def encode(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all documents one after the other (uint32) and their ``n + 1`` offsets."""
        if not self.units:
            raw = data.tobytes()
            texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(off[:-1], off[1:])]
            ids = [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]
            n = np.fromiter(map(len, ids), np.int64, len(ids))
            return (np.fromiter((i for x in ids for i in x), np.uint32, int(n.sum())),
                    np.concatenate(([0], np.cumsum(n))))
        if self.lower and b"<|" not in data.tobytes():
            data = _LOWER[data]
        w = Words(data, off)
        cut = np.flatnonzero(_LETTER[data[:-1]] & _PUNCT[data[1:]]) + 1
        cut = cut[np.isin(cut, off, invert=True)] if len(cut) else cut
        w.start = np.sort(np.concatenate([w.start, cut]))
        w.end = np.sort(np.concatenate([cut, w.end]))
        unit_off = np.searchsorted(w.start, off)
        h = w.hashes()
        uniq, first, code = np.unique(h, return_index=True, return_inverse=True)
        found = np.searchsorted(self.h, uniq)
        new = np.ones(len(uniq), bool)
        if len(self.h):
            new = self.h[np.minimum(found, len(self.h) - 1)] != uniq
        if new.any():
            miss = first[new]
            if len(self.h) + len(miss) > CACHE:  # start anew with this whole chunk
                self.clear()
                miss, new = first, np.ones(len(uniq), bool)
            raw = data.tobytes()
            self._learn(uniq[new], [raw[a:b].decode("utf-8", "replace")
                                    for a, b in zip(w.start[miss], w.end[miss])])
            found = np.searchsorted(self.h, uniq)
        at, n = self.at[found][code], self.n[found][code]
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.pool[np.repeat(at - (ends - n), n) + np.arange(total)]
        return ids, np.concatenate(([0], ends))[unit_off]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a vocabulary file; kept between tasks."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
