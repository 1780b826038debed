"""The corpus pipeline: quality rules, near-duplicates, repeated passages, source mix,
packing. Each stage takes ``(spark, docs, sf_dir)``; its result is written as Parquet
and read back as the next stage's ``docs``. All but the last return the columns of
``documents``. A result column whose name the input already has gets a leading underscore,
so extra columns of any name pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewright.llm.mixing import mix_sources
from candlewright.llm.packing import pack_documents
from candlewright.llm.probminhash import drop_near_duplicates
from candlewright.llm.quality_rules import judge
from candlewright.llm.queries import vocabulary
from candlewright.llm.substring_dedup import dedup_substrings
from candlewright.llm.textops import free_name, stage
from candlewright.session import apply_conf


def _columns(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep."""
    apply_conf(spark)
    return judge(docs, carry_text=True).where(F.col(free_name(docs, "kept"))).select(*_columns(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class: the one with the smallest id."""
    apply_conf(spark)
    return drop_near_duplicates(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document; texts that repeat an earlier 20-word window lose those words (their
    kept words are joined by one space), other texts stay as they are."""
    apply_conf(spark)
    cut = dedup_substrings(docs)
    changed, kept = F.col(free_name(docs, "n_removed")) > 0, F.col(free_name(docs, "kept_text"))
    new = {"text": F.when(changed, kept).otherwise(F.col("text")),
           "n_chars": F.when(changed, F.length(kept).cast("long")).otherwise(F.col("n_chars"))}
    return cut.select(*[new[c].alias(c) if c in new else F.col(f"`{c}`") for c in docs.columns])


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them (0, 1 or 2 times)."""
    apply_conf(spark)
    times = free_name(docs, "times")
    taken = mix_sources(docs).where(F.col(times) > 0)
    return taken.withColumn(times, F.explode(F.sequence(F.lit(1).cast("long"), F.col(times)))).select(
        *_columns(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the training sequences."""
    apply_conf(spark)
    return pack_documents(docs, vocabulary())


STAGES = [("quality_rules", quality_rules), ("near_dedup", near_dedup), ("substring_dedup", substring_dedup),
          ("source_mix", source_mix), ("packing", packing)]

#: SQL has no counterpart of the tokenizer and of the near-duplicate search.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
