"""The rank index against a scan for tokens, and fill-in-middle against SQL and plain slicing."""

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from candlewright.llm import fill_middle as FM
from candlewright.llm.queries import ORACLE, QUERIES
from tests.oracle_util import compare, duck

SF = "/root/testdata/sf0.001"
TOKEN = re.compile("[A-Za-z]+|[^A-Za-z]")


def offsets(t):
    return [m.start() for m in TOKEN.finditer(t)] + [len(t)]


def chunk(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate(([0], np.cumsum([len(r) for r in raw]))).astype(np.int64)


def brute(key, t, seed=1):
    t = t or ""
    d = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    h = [int(d[i:i + 8], 16) for i in range(0, 32, 8)]
    w = TOKEN.findall(t)
    if not t or h[2] % 100 >= 90 or re.search("<[PSM]>", t):
        return len(w), "plain", None, None, t
    a, b = sorted((h[0] % (len(w) + 1), h[1] % (len(w) + 1)))
    p, m, s = "".join(w[:a]), "".join(w[a:b]), "".join(w[b:])
    if h[3] % 100 < 20:
        return len(w), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(w), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="aZ é\n€𝄞<", max_size=40), min_size=1, max_size=6))
def test_boundaries_of_every_text(texts):
    y, at = FM.boundaries(*chunk(texts))
    assert [y[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == [offsets(t) for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 400), max_size=1200), st.integers(0, 120))
def test_segments_keep_their_error_and_locate_is_exact(steps, error):
    y = np.concatenate(([0], np.cumsum(steps))).astype(np.int64)
    first, base, slope = FM.fit(y, error)
    line = FM.predict(np.arange(len(y)), first, base, slope)
    res = y - line
    assert np.abs(res).max() <= error + 1 and first[0] == 0
    index = {"first": first, "base": base, "slope": slope, "residuals": res.astype(np.int8).tobytes()}
    assert FM.locate(index, list(range(len(y)))) == y.tolist()


def test_segments_are_far_fewer_than_boundaries():
    y = np.cumsum(np.random.default_rng(1).integers(1, 9, 200_000))
    first, _, _ = FM.fit(y)
    assert len(first) < len(y) / 1000
    straight, _, _ = FM.fit(np.arange(0, 7 * 50_000, 7))
    assert len(straight) == 1
    jump, _, _ = FM.fit(np.array([0, 1, 2, 30_000, 30_001, 30_002]), 0)
    assert len(jump) <= 3


def test_cuts_match_sql(spark):
    ok, msg = compare(QUERIES["op11_rank_index_fim"](spark, SF), duck(SF), ORACLE["op11_rank_index_fim"])
    assert ok, msg


def test_one_index_serves_many_seeds(spark, tmp_path):
    rows = [(i, "word " * i + "é, ünd €5\n" * (i % 7)) for i in range(300)]
    docs = FM.rank_index(spark.createDataFrame(rows, "doc_id long, text string"))
    docs.write.parquet(str(tmp_path / "index"))
    stored = spark.read.parquet(str(tmp_path / "index"))
    for seed in (1, 2):
        got = FM.fill_in_middle(stored, seed=seed).withColumn("back", FM.restore(F.col("fim.output"), F.col("fim.form")))
        for r in got.collect():
            assert tuple(r.fim) == brute(r.doc_id, r.text, seed) and r.back == r.text


def test_odd_rows(spark, odd, nothing):
    docs = odd.withColumns({"n": F.lit("x"), "form": F.lit(1), "FIM": F.lit("mine"), "rank_index": F.lit(2.0),
                            "output": F.lit(None).cast("string")})
    indexed = FM.rank_index(docs)
    assert indexed.columns[-1] == "_rank_index"
    rows = FM.fill_in_middle(indexed, index="_rank_index").collect()
    assert len(rows) == docs.count() and all(r.FIM == "mine" and r.form == 1 for r in rows)
    assert all(tuple(r["_fim"]) == brute(r.doc_id, r.text) for r in rows)
    assert FM.fill_in_middle(FM.rank_index(nothing)).count() == 0


def test_sentinels_and_angle_brackets(spark):
    texts = ["a<P>b", "x<S>", "<M>", "<", "<<<P", "P>S>M>", "<P <S <M", "<P" * 50, ">" * 9, "S><" * 30, "<p>low</p>"]
    rows = [(i, t) for t in texts for i in range(30)]
    got = FM.fill_in_middle(FM.rank_index(spark.createDataFrame(rows, "doc_id long, text string")))
    got = got.withColumn("back", FM.restore(F.col("fim.output"), F.col("fim.form"))).collect()
    assert all(tuple(r.fim) == brute(r.doc_id, r.text) and r.back == r.text for r in got)
    assert {r.fim.form for r in got if r.text == "<<<P"} == {"plain", "psm", "spm"}


def test_a_residual_must_fit_its_byte(spark, nothing):
    with pytest.raises(ValueError):
        FM.rank_index(nothing, error=121)
