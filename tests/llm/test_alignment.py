"""Incidence products against dense matrices and interval arithmetic, and whole texts against the libraries."""

import bisect
import collections
import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from candlewright.llm import alignment as AL
from candlewright.llm.queries import QUERIES, vocabulary

SF = "/root/testdata/sf0.001"
A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"


@pytest.fixture(scope="module")
def tools():
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(vocabulary(A))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=vocabulary(B))


def spans(tools, t):
    """(ids and byte ranges by A, by B), or None without tokens."""
    a, b = tools
    if not t:
        return None
    table = {}
    for x in range(256):
        shown = 33 <= x <= 126 or 161 <= x <= 172 or x >= 174
        table[chr(x) if shown else chr(256 + len([v for v in table.values() if v[0] == 0]))] = (shown, x)
    raw_a = [(i, bytes(table[c][1] for c in a.id_to_token(i))) for i in a.encode(" " + t, add_special_tokens=False).ids]
    raw_b = [(i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode())
             for i, p in ((i, b.id_to_piece(i)) for i in b.encode(t))]
    out = []
    for raw in (raw_a, raw_b):
        at, s = 0, []
        for i, x in raw:
            s.append((i, at, at + len(x)))
            at += len(x)
        if b"".join(x for _, x in raw) != (" " + t).encode():
            return None
        out.append(s)
    return out


def brute(tools, texts):
    found = [spans(tools, t) for t in texts]
    counts = collections.Counter()
    links = []
    for x in found:
        at = {e: j for j, _, e in x[1]} if x else {}
        links.append([(i, at[e]) for i, _, e in x[0] if e in at] if x else [])
        counts.update(links[-1])
    top = collections.Counter()
    for (_, j), n in counts.items():
        top[j] = max(top[j], n)
    rows = []
    for x, link in zip(found, links):
        if not x:
            rows.append((0, 0, 0, 0, 0, 0, ""))
            continue
        ends = sorted({e for *_, e in x[0]} & {e for *_, e in x[1]})
        sides = [collections.defaultdict(list), collections.defaultdict(list)]
        for members, side in zip(sides, x):
            for i, _, e in side:
                members[bisect.bisect_left(ends, e)].append(str(i))
        groups = ["|".join(",".join(members[g]) for members in sides) for g in range(len(ends))]
        rows.append((len(x[0]), len(x[1]), len(ends), len(link), sum(counts[p] == top[p[1]] for p in link),
                     sum(counts[p] for p in link), hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return rows


def digest(r):
    return r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 2**32), st.integers(1, 12), st.integers(1, 9), st.integers(1, 11), st.integers(1, 40))
def test_products_equal_dense_ones(seed, n, k, m, block):
    rng = np.random.default_rng(seed)
    x, y = rng.integers(0, 3, (n, k)), rng.integers(0, 3, (k, m))

    def rows(d):
        return AL.Rows(np.concatenate(([0], np.cumsum((d > 0).sum(1)))), np.nonzero(d)[1], d[d > 0], d.shape[1])
    out = np.zeros((n, m), np.int64)
    for i, j, v in AL.multiply(rows(x), rows(y), block):
        out[i, j] += v
    assert (out == x @ y).all()
    t = AL.transpose(rows(x))
    assert t.height == k and all(set(t.col[t.ptr[c]:t.ptr[c + 1]]) == set(np.nonzero(x[:, c])[0]) for c in range(k))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=15), st.randoms())
def test_links_of_every_kind_equal_interval_arithmetic(lengths, rnd):
    total = sum(lengths)
    cuts = sorted(rnd.sample(range(1, total), rnd.randint(0, total - 1))) if total > 1 else []
    other = np.diff([0, *cuts, total])
    x = AL.alignment(np.array(lengths), other)
    ea, eb = np.cumsum(lengths), np.cumsum(other)
    sa, sb = ea - lengths, eb - other
    ends = sorted(set(ea.tolist()) & set(eb.tolist()))
    want = collections.defaultdict(dict)
    for i in range(len(ea)):
        for j in range(len(eb)):
            both = min(ea[i], eb[j]) - max(sa[i], sb[j])
            if both > 0:
                want["overlap"][i, j] = both
                if ea[i] == eb[j]:
                    want["end"][i, j] = both
            if np.searchsorted(ends, ea[i]) == np.searchsorted(ends, eb[j]):
                want["group"][i, j] = None
    for kind, links in AL.LINKS.items():
        got = {(i, j): v for part in links(x) for i, j, v in zip(*(p.tolist() for p in part))}
        assert got.keys() == want[kind].keys()
        assert kind == "group" or got == want[kind]


def test_documents_match_the_libraries(spark, tools):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = dict(zip([r.doc_id for r in rows], brute(tools, [r.text for r in rows])))
    assert {r.doc_id: digest(r) for r in QUERIES["op12_token_alignment"](spark, SF).collect()} == want


def test_texts_that_units_could_get_wrong(spark, tools):
    texts = [" ", "  ", " a", "a ", "a  b", "a \n b", "\ta  b", "　 x", "é à ü", "naïve  café ", "日本 語 a", "a▁b c",
             "▁", "<|endoftext|> a <|endoftext|>", "<s> </s> <unk>", "<0x41> <0x0A>", "don't we'll I'd", "a 1 22 333",
             "x\x00 y", "\u0085 a", "é ä", "ﬁ ① Ⅳ", "… … a", "🙂 🙂🙂 a", "a-b -c- d", "\r\n \r\n", "tab\t tab", "ʼ ʼn",
             "؀ ؀", "ß ẞ", "=" * 300, "ab" * 400, " " * 70, "a\n\n\n b", "a   b", None, "", "z ​ z"]
    texts = [*texts, *texts[::-1], " ".join(t or "" for t in texts)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: digest(r) for r in AL.alignment_digests(df, vocabulary(A), vocabulary(B)).collect()}
    assert [got[i] for i in range(len(texts))] == brute(tools, texts)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet="ab é\n 日'1<|.▁", max_size=25), min_size=1, max_size=30))
def test_units_give_whole_texts_tokens(texts):
    p = AL.pair(vocabulary(A), vocabulary(B))
    raw = [t.encode() for t in texts]
    off = np.concatenate(([0], np.cumsum([len(r) for r in raw]))).astype(np.int64)
    data, off = AL.spaced(np.frombuffer(b"".join(raw), np.uint8), off)
    start = AL.unit_starts(data, off, p.cuts)
    end = np.append(start[1:], off[-1])
    for lo, hi in zip(off[:-1], off[1:]):
        whole = data[lo:hi].tobytes()
        if whole:
            parts = [data[a:b].tobytes() for a, b in zip(start, end) if lo <= a < hi]
            assert b"".join(parts) == whole
            for w, ids in zip(p.encode([whole]), p.encode(parts)):
                assert w[0] == [i for x in ids for i in x]


def test_a_full_cache_changes_nothing(spark, tools, monkeypatch):
    monkeypatch.setattr(AL, "CACHE", 3)
    p = AL.Pair(vocabulary(A), vocabulary(B))
    for t in (b" one two three four", b" two five", b" six seven eight nine ten", b" one two"):
        data, off = np.frombuffer(t, np.uint8), np.array([0, len(t)])
        s = AL.unit_starts(data, off, True)
        e = np.append(s[1:], len(t))
        slots = p.look_up(AL.span_hashes(data, s, e), data, s, e)
        a, b = spans(tools, t.decode()[1:])
        assert sum(p.size[i][0] for i in slots) == len(a) and sum(p.size[i][1] for i in slots) == len(b)


def test_links_table(spark, tools):
    text = "Tokenizers disagree about unbelievable words"
    df = spark.createDataFrame([(7, text, 1), (8, None, 2), (None, "", 3)], "doc_id long, text string, shared int")
    a, b = spans(tools, text)
    rows = AL.token_links(df, vocabulary(A), vocabulary(B)).collect()
    want = {(7, i, x[0], j, y[0], min(x[2], y[2]) - max(x[1], y[1])) for i, x in enumerate(a) for j, y in enumerate(b)
            if min(x[2], y[2]) > max(x[1], y[1])}
    assert {tuple(r) for r in rows} == want and len(rows) == len(want)


def test_odd_rows(spark, tools, odd, nothing):
    df = odd.withColumnsRenamed({"lang": "n_a", "source": "links", "size": "pairs"})
    rows = AL.alignment_digests(df, vocabulary(A), vocabulary(B)).collect()
    data = odd.collect()
    want = brute(tools, [r.text for r in data])
    key = lambda x: (x[0] is not None, x)
    assert sorted(((r.doc_id, digest(r)) for r in rows), key=key) == sorted(zip([r.doc_id for r in data], want), key=key)
    assert AL.alignment_digests(nothing, vocabulary(A), vocabulary(B)).count() == 0
