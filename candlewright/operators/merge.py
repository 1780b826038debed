"""Dedup, merge and row filters (D1-D3, D5, D6 rules, W4, F1-F3, F5, F6).

Keep-last / keep-first use ``row_number() == 1`` over the key. Spark plans
this with a partial ``WindowGroupLimit`` before the shuffle, so each task
ships at most one row per key. The window is partitioned by the full key
(``symbol`` plus id or time), never by symbol alone, so one hot symbol still
spreads over every shuffle partition. Keys are named from coarse to fine; the
window takes them from fine to coarse, so its sorts settle most comparisons by
the id or time instead of a symbol and year that most rows of a task share.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(xs) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def union_all(*frames: DataFrame) -> DataFrame:
    """Vertical concat of same-schema frames, matched by column name."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def dedup_keep_last(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """One row per key, the one ranking last by ``order``."""
    w = Window.partitionBy(*reversed(keys)).orderBy(*[c.desc() for c in _cols(order)])
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def dedup_keep_first(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """D3: one row per key, the one ranking first by ``order`` (e.g. file name)."""
    w = Window.partitionBy(*reversed(keys)).orderBy(*[c.asc() for c in _cols(order)])
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def merge_keep_last(existing: DataFrame, new: DataFrame, keys: Sequence[str],
                    order: Sequence = ()) -> DataFrame:
    """Existing ∪ new, unique on ``keys``, new rows win; ties inside one
    side are broken by ``order`` (archive name, line number, ...)."""
    both = existing.withColumn("_seq", F.lit(0)).unionByName(new.withColumn("_seq", F.lit(1)))
    return dedup_keep_last(both, keys, ["_seq", *order]).drop("_seq")


def exclude_month(df: DataFrame, year: int, month: int, time_col: str = "time") -> DataFrame:
    """drop the rows of one calendar month."""
    t = F.col(time_col)
    return df.filter(~((F.year(t) == year) & (F.month(t) == month)))


def replace_month(stored: DataFrame, new_month: DataFrame, year: int, month: int,
                  time_col: str = "time") -> DataFrame:
    """A monthly archive replaces the stored month wholesale."""
    t = F.col(time_col)
    fresh = new_month.filter((F.year(t) == year) & (F.month(t) == month))
    return exclude_month(stored, year, month, time_col).unionByName(fresh)


def time_between(df: DataFrame, start, end, time_col: str = "time") -> DataFrame:
    """inclusive range (pushed to the Parquet scan)."""
    return df.filter(F.col(time_col).between(ts_literal(start), ts_literal(end)))


def time_at_or_before(df: DataFrame, end, time_col: str = "time") -> DataFrame:
    """F2."""
    return df.filter(F.col(time_col) <= ts_literal(end))


def time_half_open(df: DataFrame, start, end, time_col: str = "time") -> DataFrame:
    """``start <= time < end``."""
    t = F.col(time_col)
    return df.filter((t >= ts_literal(start)) & (t < ts_literal(end)))


def in_year(df: DataFrame, year: int, time_col: str = "time") -> DataFrame:
    """F5 (use the ``year`` partition column instead when the table has one)."""
    if "year" in df.columns and time_col == "time":
        return df.filter(F.col("year") == year)
    return df.filter(F.year(time_col) == year)


def ts_literal(v) -> Column:
    if isinstance(v, Column):
        return v
    if isinstance(v, str):
        return F.expr(f"TIMESTAMP_NTZ'{v}'")
    return F.lit(v)
