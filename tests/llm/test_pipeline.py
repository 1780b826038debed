"""Every stage of the corpus pipeline against brute force, on awkward rows and on nothing."""

import collections
import hashlib

import pytest

import corpus_pipeline
from candlewright.llm.queries import ORACLE
from tests.llm.test_operators import SF, brute_classes, brute_measures, brute_windows, words
from tests.oracle_util import duck

STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").repartition(7).cache()


def rows(df):
    return collections.Counter(tuple(r) for r in df.collect())


def test_quality_stage_drops_junk_only(spark, docs):
    got = STAGES["quality_rules"](spark, docs, SF)
    assert got.columns == docs.columns and not rows(got) - rows(docs)
    kept = {r.doc_id for r in got.select("doc_id").collect()}
    text = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    assert not any(brute_measures(text[k])[-1] for k in kept)
    for r in spark.read.parquet(f"{SF}/labels.parquet").collect():
        assert (r.doc_id in kept) == (r.quality == 1 and not brute_measures(text[r.doc_id])[-1])


def test_near_dedup_stage_keeps_one_of_each_class(spark, docs):
    got = STAGES["near_dedup"](spark, docs, SF)
    classes = brute_classes([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert rows(got) == rows(docs.where(docs.doc_id.isin(sorted(set(classes.values())))))


def test_substring_stage_matches_brute_force(spark, docs):
    got = STAGES["substring_dedup"](spark, docs, SF)
    assert got.columns == docs.columns
    old = {r.doc_id: r for r in docs.collect()}
    want = brute_windows(sorted((k, r.text) for k, r in old.items()))
    new = got.collect()
    assert len(new) == len(old)
    for r in new:
        n, gone, digest = want[r.doc_id]
        if gone:
            assert hashlib.sha256(r.text.encode()).hexdigest() == digest and r.n_chars == len(r.text)
        else:
            assert r == old[r.doc_id]


def test_mix_stage_takes_as_often_as_the_sql(spark, docs):
    got = STAGES["source_mix"](spark, docs, SF)
    times = {k: taken // size for k, size, _, _, taken in duck(SF).execute(ORACLE["op7_hash_threshold_mix"]).fetchall()
             if size}
    want = collections.Counter({tuple(r): times.get(r.doc_id, 0) for r in docs.collect()})
    assert rows(got) == +want


def test_stages_on_odd_rows_and_on_nothing(spark, odd, nothing):
    for df in (odd, nothing):
        got = {name: step(spark, df, SF) for name, step in STAGES.items()}
        assert all(got[n].columns == df.columns for n in STAGES if n != "packing")
        for n in ("quality_rules", "near_dedup"):
            assert not rows(got[n]) - rows(df)
        assert got["substring_dedup"].count() == df.count()
        assert {r.doc_id for r in got["source_mix"].collect()} <= {r.doc_id for r in df.collect()}
        assert got["packing"].where("piece = 0").count() == df.count()
    assert all(len(words(r.text)) >= 50 for r in STAGES["quality_rules"](spark, odd, SF).collect())


#: Every result column of a stage's operator, and names used inside.
NAMES = ["kept", "base_failed", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_removed", "kept_text",
         "size", "source_size", "target", "taken", "TIMES", "_key", "_n", "n", "id", "h", "class_id", "s", "piece", "start", "c0",
         "rank_index", "fim"]


@pytest.mark.parametrize("names", [NAMES[:13], NAMES[13:], ["_" + n for n in NAMES[:13]] + ["kept", "times", "n_removed"]])
def test_stages_keep_columns_of_any_name(spark, docs, names):
    some = docs.where("doc_id < 120")
    wide = some.selectExpr("*", *[f"concat('{n}', doc_id) AS `{n}`" for n in names])
    for name, step in STAGES.items():
        got, want = step(spark, wide, SF), step(spark, some, SF)
        if name == "packing":
            assert got.where("piece = 0").count() == want.where("piece = 0").count()
            continue
        assert got.columns == wide.columns
        assert rows(got.select(some.columns)) == rows(want)
        assert all(r[n] == f"{n}{r.doc_id}" for r in got.collect() for n in names)


def test_unlike_texts_under_one_id_both_stay(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(80)) for x in "abc")
    near = a.replace("a40", "zz")
    rows_ = [(1, a), (1, b), (1, near), (2, a), (None, c), (None, b), (3, ""), (3, None), (1, b)]
    df = spark.createDataFrame([(k, t, "en", "s", 0) for k, t in rows_],
                               "doc_id long, text string, lang string, source string, n_chars long")
    kept = STAGES["near_dedup"](spark, df, SF).collect()
    words_ = sorted((r.text or "")[:1] for r in kept)
    assert words_ == ["", "", "a", "b", "c"]
