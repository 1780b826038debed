"""Registered queries ``opN_<name>``: each applies its operator, with production
parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from candlewright.llm import alignment as AL
from candlewright.llm import fill_middle as FM
from candlewright.llm import html_crf as HC
from candlewright.llm import mixing as MX
from candlewright.llm import packing as PK
from candlewright.llm import probminhash as PM
from candlewright.llm import pu_quality as PU
from candlewright.llm import quality_rules as QR
from candlewright.llm import records as RC
from candlewright.llm import scaled_sketch as SK
from candlewright.llm import substring_dedup as SD
from candlewright.llm import toxicity as TX
from candlewright.llm import tree_bpe as TB
from candlewright.llm.textops import read


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """Path of a public tokenizer file."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_vector_best_fit(spark, d):
    return PK.pack_documents(read(spark, d, "documents", ["doc_id", "text"]), vocabulary())


def op4_binary_records(spark, d):
    return RC.read_records(RC.write_records(read(spark, d, "documents", ["doc_id", "text"]), vocabulary()))


def op6_substring_dedup(spark, d):
    docs = read(spark, d, "documents", ["doc_id", "text"])
    return SD.dedup_substrings(docs, 20, digest=True)


def op7_hash_threshold_mix(spark, d):
    docs = read(spark, d, "documents", ["doc_id", "text", "source"])
    return MX.mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken")


def op8_adaptive_quality_rules(spark, d):
    docs = read(spark, d, "documents", ["doc_id", "text", "lang", "source"])
    return QR.judge(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                 "base_failed", "kept")


def op9_probminhash_near_duplicates(spark, d):
    docs = read(spark, d, "documents", ["doc_id", "text"])
    return PM.near_duplicate_classes(docs).select("doc_id", "class_id", "n_links", "n_shingles",
                                                       "weighted")


def op5_scaled_sketch(spark, d):
    return SK.fingerprints(read(spark, d, "documents", ["doc_id", "text"]))


def op10_toxic_segments(spark, d):
    docs = read(spark, d, "documents", ["doc_id", "text"])
    labels = read(spark, d, "labels", ["doc_id", "toxic"]).withColumnRenamed("toxic", "label")
    return TX.score_documents(docs, TX.train(docs, labels))


def op2_pu_quality(spark, d):
    docs = read(spark, d, "documents", ["doc_id", "text"])
    labels = read(spark, d, "labels", ["doc_id", "quality"]).withColumnRenamed("quality", "label")
    return PU.score_documents(docs, PU.train(docs, labels))


def op3_html_crf(spark, d):
    pages = read(spark, d, "pages", ["page_id", "url", "html"])
    return HC.extract(pages, HC.train(pages, read(spark, d, "documents", ["doc_id", "text"])))


def op11_rank_index_fim(spark, d):
    docs = read(spark, d, "documents", ["doc_id", "text"])
    got = FM.fill_in_middle(FM.rank_index(docs)).select("doc_id", "fim.*")
    return got.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                      F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(FM.restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


def op12_token_alignment(spark, d):
    docs = read(spark, d, "documents", ["doc_id", "text"])
    return AL.alignment_digests(docs, vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))


def op13_tree_bpe(spark, d):
    docs = read(spark, d, "documents", ["doc_id", "text"])
    out = TB.decode(TB.encode(docs, vocabulary()), vocabulary())
    return out.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES = {
    "op1_vector_best_fit": op1_vector_best_fit,
    "op2_pu_quality": op2_pu_quality,
    "op3_html_crf": op3_html_crf,
    "op4_binary_records": op4_binary_records,
    "op5_scaled_sketch": op5_scaled_sketch,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_hash_threshold_mix": op7_hash_threshold_mix,
    "op8_adaptive_quality_rules": op8_adaptive_quality_rules,
    "op9_probminhash_near_duplicates": op9_probminhash_near_duplicates,
    "op10_toxic_segments": op10_toxic_segments,
    "op11_rank_index_fim": op11_rank_index_fim,
    "op12_token_alignment": op12_token_alignment,
    "op13_tree_bpe": op13_tree_bpe,
}

ORACLE = {}

#: The mix in SQL: thresholds by a running sum in hash order, which the histograms avoid.
ORACLE["op7_hash_threshold_mix"] = r"""
WITH d AS (
  SELECT doc_id, coalesce('0' || source, '1') AS s,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         CAST('0x' || substr(md5('mix|' || coalesce(doc_id::VARCHAR, '') || '|' || coalesce(text, '')), 1, 15)
              AS BIGINT) AS h
  FROM documents),
p AS (SELECT s, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY s) - 1 AS i FROM d GROUP BY s),
q AS (SELECT *, CASE i % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w, source_size * 2 AS cap,
             sum(source_size) OVER () * 1.5::DOUBLE AS budget FROM p),
r AS (SELECT *, cap::DOUBLE / w <= (budget - coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / w, s
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
             / (sum(w) OVER (ORDER BY cap::DOUBLE / w, s ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE
             AS capped FROM q),
t AS (SELECT s, source_size, CASE WHEN capped THEN cap::DOUBLE ELSE w * (
               (budget - coalesce(sum(cap) FILTER (capped) OVER (), 0)::DOUBLE)
               / (sum(w) FILTER (NOT capped) OVER ())::DOUBLE) END AS target FROM r),
u AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS passes FROM t),
v AS (SELECT d.*, source_size, target, passes, target - passes * source_size AS rest,
             sum(size) OVER (PARTITION BY d.s ORDER BY h RANGE UNBOUNDED PRECEDING) AS upto,
             sum(size) OVER (PARTITION BY d.s, h) AS same
      FROM d JOIN u USING (s))
SELECT doc_id, size, source_size, target,
       (size * (passes + CASE WHEN rest > 0 AND (upto < rest
          OR (upto - same < rest AND (rest - (upto - same)::DOUBLE) * 2 >= same)) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM v
"""

#: Cuts by the list of tokens itself, without an index.
ORACLE["op11_rank_index_fim"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS w FROM documents),
n AS (SELECT *, len(w)::BIGINT AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(w) + 1) AS a,
             CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(w) + 1) AS b,
             CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 AS h3,
             CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 AS h4 FROM d),
f AS (SELECT *, CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 >= 90 THEN 'plain'
                     WHEN h4 < 20 THEN 'spm' ELSE 'psm' END AS form,
             array_to_string(list_slice(w, 1, least(a, b)), '') AS p,
             array_to_string(list_slice(w, least(a, b) + 1, greatest(a, b)), '') AS m,
             array_to_string(list_slice(w, greatest(a, b) + 1, n), '') AS s FROM n)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM f
"""
