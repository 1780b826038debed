"""Merges, joins and whole texts against the tokenizers library."""

import hashlib
import json

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from candlewright.llm import tree_bpe as TB
from candlewright.llm.queries import QUERIES, vocabulary

SF = "/root/testdata/sf0.001"
WORD = "word_bpe_49k.json"


@pytest.fixture(scope="module")
def enc():
    return TB.TreeEncoder(vocabulary(WORD))


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(vocabulary(WORD))
    tok.no_truncation()
    tok.no_padding()
    return tok


def ids_of(library, t):
    return library.encode(t or "", add_special_tokens=False).ids


def symbols(enc, words):
    s = [enc.merges.symbols(w) for w in words]
    return np.concatenate(s), np.concatenate(([0], np.cumsum([len(x) for x in s])))


WORDS = st.one_of(st.text(alphabet="ab", min_size=1, max_size=70), st.text(alphabet="aein", min_size=1, max_size=90),
                  st.text(alphabet="etaoinshrdlu", min_size=1, max_size=120))


@settings(max_examples=150, deadline=None)
@given(words=st.lists(WORDS, min_size=1, max_size=8), leaf=st.integers(1, 20))
def test_trees_equal_the_library(enc, library, words, leaf):
    ids, off = enc.merges.encode(*symbols(enc, words), leaf=leaf)
    assert [ids[a:b].tolist() for a, b in zip(off[:-1], off[1:])] == [ids_of(library, w) for w in words]


@pytest.mark.parametrize("word", ["a" * 5000, "ha" * 3001, "the" * 1000 + "x", "e" * 4095 + "th", "n" * 17])
def test_long_repeats(enc, library, word):
    ids, _ = enc.merges.encode(*symbols(enc, [word]))
    assert ids.tolist() == ids_of(library, word)


def test_joins_grow_until_both_sides_agree(enc, library):
    """Halves whose encodings differ far from the cut: a window of one token would be wrong."""
    m, grown = enc.merges, 0
    rng = np.random.default_rng(4)
    for _ in range(300):
        s = m.symbols("".join(rng.choice(list("ahe"), 60)))
        k = int(rng.integers(1, 60))
        a, b = (m.merge(x, np.array([0, len(x)])) for x in (s[:k], s[k:]))
        whole = m.merge(s, np.array([0, len(s)]))[0]
        got, off = m.join(a, b)
        assert got.tolist() == whole.tolist() and off.tolist() == [0, len(whole)]
        grown += whole[:len(a[0]) - 1].tolist() != a[0][:-1].tolist() or whole[::-1][:len(b[0]) - 1].tolist() != b[0][::-1][:-1].tolist()
    assert grown > 10


@settings(max_examples=200, deadline=None)
@given(texts=st.lists(st.text(alphabet=st.one_of(st.sampled_from("aAé́İß '’sStTm|<>1٣\n\t\xa0　日本🙂_-.!"), st.characters(codec="utf-8", exclude_characters="\x00")), max_size=30), max_size=6))
def test_texts_equal_the_library(enc, library, texts):
    raw = [t.encode() for t in texts]
    off = np.concatenate(([0], np.cumsum([len(r) for r in raw]))).astype(np.int64)
    ids, at = enc.encode(np.frombuffer(b"".join(raw), np.uint8), off)
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == [ids_of(library, t) for t in texts]


def test_special_tokens_inside_texts(enc, library):
    texts = ["<|endoftext|>", "a<|endoftext|>b", "A <|startoftext|><|endoftext|> B", "<|ENDOFTEXT|>", "<|end", "x <|endoftext|>É"]
    for t in texts:
        raw = np.frombuffer(t.encode(), np.uint8)
        assert enc.encode(raw, np.array([0, len(raw)]))[0].tolist() == ids_of(library, t)


def brute(library, t):
    ids = ids_of(library, t)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))


def test_documents_match_the_library(spark, library):
    want = {r.doc_id: brute(library, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert {r.doc_id: tuple(r)[1:] for r in QUERIES["op13_tree_bpe"](spark, SF).collect()} == want


def test_long_runs_leave_their_document(spark, library):
    rng = np.random.default_rng(9)
    run = "".join(rng.choice(list("etaoin"), 900))
    texts = ["words only " * 200, run, f"before {run} between {run.upper()} <|endoftext|> after", "日本語テキスト" * 90,
             "=" * 700, "1" * 700, "a" * 63 + " " + "b" * 65, "é" * 400, f"{run}'s {run}!{run}", None, "", run]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.ids for r in TB.encode(df, vocabulary(WORD), split=64).collect()}
    assert [got[i] for i in range(len(texts))] == [ids_of(library, t) for t in texts]


def test_odd_rows(spark, library, odd, nothing):
    df = odd.withColumnsRenamed({"lang": "ids", "source": "key", "size": "kind"})
    for split in (40, TB.SPLIT):
        rows = TB.decode(TB.encode(df, vocabulary(WORD), split=split), vocabulary(WORD)).collect()
        got = sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, hashlib.sha256(r.decoded.encode()).hexdigest()) for r in rows)
        assert got == sorted((str(r.doc_id), *brute(library, r.text)) for r in odd.collect())
    assert TB.decode(TB.encode(nothing, vocabulary(WORD)), vocabulary(WORD)).count() == 0


def test_a_small_cache_changes_nothing(enc, library, monkeypatch):
    from candlewright.llm import tokens
    monkeypatch.setattr(tokens, "CACHE", 4)
    e = TB.TreeEncoder(vocabulary(WORD))
    for t in ("one two three four five six", "two seven", "eight nine one", "one"):
        raw = np.frombuffer(t.encode(), np.uint8)
        assert e.encode(raw, np.array([0, len(raw)]))[0].tolist() == ids_of(library, t)


def test_files_that_need_another_decoder_are_refused(tmp_path):
    with open(vocabulary(WORD)) as f:
        spec = json.load(f)
    spec["decoder"] = {"type": "ByteLevel"}
    p = tmp_path / "v.json"
    p.write_text(json.dumps(spec))
    with pytest.raises(ValueError):
        TB.Merges(str(p))
