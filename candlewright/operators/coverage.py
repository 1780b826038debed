"""Coverage and resume points.

All are plain grouped aggregates with map-side partial aggregation; the
inputs shrink to one row per (symbol, year) before any shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewright.functions.timecols import coverage_suffix, micros_to_ntz
from candlewright.schemas import DEFAULT_START_DATE
from candlewright.sources.store import footer_aggregate


def last_dates(df: DataFrame, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """A5: last stored date per dataset."""
    return df.groupBy(*keys).agg(F.max("time").cast("date").alias("last_date"))


def start_dates(symbols: DataFrame, stored: DataFrame | None, start: str | None = None,
                keys: Sequence[str] = ("symbol",), coverage: DataFrame | None = None) -> DataFrame:
    """Explicit start > last stored date + 1 > 2020-01-01, per symbol.

    ``symbols`` holds the requested symbols (one row each); the join side is
    one row per symbol after A5. ``coverage`` (e.g. :func:`coverage_stored`,
    from Parquet footers) replaces the scan of ``stored``.
    """
    if coverage is not None:
        last = coverage.groupBy(*keys).agg(F.max("last_date").alias("last_date"))
    else:
        last = last_dates(stored, keys)
    explicit = F.to_date(F.lit(start)) if start else F.lit(None).cast("date")
    return (symbols.join(last, list(keys), "left")
            .select(*keys, "last_date",
                    F.coalesce(explicit, F.date_add("last_date", 1),
                               F.to_date(F.lit(DEFAULT_START_DATE))).alias("start_date")))


def coverage_by_year(df: DataFrame, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """A6 + P19: per (keys, year) first/last date, rows, complete flag, suffix.

    A year is complete when its last date is Dec 31 of that same year.
    """
    g = df.groupBy(*keys, F.year("time").alias("year")).agg(
        F.min("time").alias("_min"), F.max("time").alias("_max"), F.count(F.lit(1)).alias("rows"))
    return g.select(
        *keys, "year",
        F.col("_min").cast("date").alias("first_date"),
        F.col("_max").cast("date").alias("last_date"),
        "rows",
        ((F.month("_max") == 12) & (F.dayofmonth("_max") == 31) & (F.year("_max") == F.col("year")))
        .alias("complete"),
        coverage_suffix("_max", "year").alias("suffix"),
    )


def rows_per_year(df: DataFrame) -> DataFrame:
    """Row totals per year of an ingest."""
    return df.groupBy(F.year("time").alias("year")).agg(F.count(F.lit(1)).alias("rows"))


def distinct_years(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """A15."""
    return df.select(*keys, F.year("time").alias("year")).distinct()


def time_range(df: DataFrame, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """First and last bar time per output."""
    return df.groupBy(*keys).agg(F.min("time").alias("min_time"), F.max("time").alias("max_time"))


def coverage_stored(spark, path: str, keys: Sequence[str] = ("symbol", "year")) -> DataFrame:
    """A6 for a stored trade table from Parquet footers: ``min``/``max`` of the
    epoch column ``ts`` (a long, unlike ``time``) per partition, so no trade
    row is read. Same columns as :func:`coverage_by_year`."""
    g = footer_aggregate(spark, path, keys, [F.count(F.lit(1)).alias("rows"), F.min("ts").alias("_lo"),
                                             F.max("ts").alias("_hi")])
    g = g.withColumns({"_min": micros_to_ntz("_lo"), "_max": micros_to_ntz("_hi")})
    return g.select(
        *keys,
        F.col("_min").cast("date").alias("first_date"),
        F.col("_max").cast("date").alias("last_date"),
        "rows",
        ((F.month("_max") == 12) & (F.dayofmonth("_max") == 31) & (F.year("_max") == F.col("year")))
        .alias("complete"),
        coverage_suffix("_max", "year").alias("suffix"),
    )
