"""Labelled rows for training: which may be used, and a bounded sample of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(doc_id: Column) -> Column:
    """crc32(doc_id as text) mod 3 is 1; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def sample(rows: DataFrame, limit: int, *order: str) -> DataFrame:
    """At most ``limit`` rows, the same ones each time: the smallest by a hash of ``order``."""
    return rows.orderBy(F.xxhash64(F.lit("sample"), *order), *order).limit(limit)
