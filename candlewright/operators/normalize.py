"""Raw archive rows -> canonical tables (P1-P10, S16 rule for bad archives).

Raw frames hold CSV fields (strings or already-typed columns). Every cast is
``try_cast`` so a bad field becomes null instead of failing the job; the
metrics timestamp is the one strict field: a bad value quarantines its whole
archive, as in the reference.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewright.functions.timecols import epoch_to_micros, micros_to_ntz, millis_to_ntz
from candlewright.schemas import AGG_TRADE_COLUMNS, METRIC_MEASURES

METRICS_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


class SchemaError(ValueError):
    pass


def _try(c: str, t: str) -> Column:
    return F.col(c).try_cast(t)


def normalize_trades(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """P3 + P4 + P1 + P2 + P5: canonical ``agg_trades`` rows.

    * ``is_best_match`` is added as false when absent (futures archives);
    * when there is no ``transact_time``, the first column whose name
      contains "time" is taken as it;
    * epochs above 1e15 are microseconds, others milliseconds;
    * ``keep`` lists extra columns to carry (symbol, lineage, ...).
    """
    cols = raw.columns
    df = raw
    if "agg_trade_id" not in cols:
        raise SchemaError("trades need an agg_trade_id column (canonical aggTrades layout)")
    if "is_best_match" not in cols:
        df = df.withColumn("is_best_match", F.lit(False))
    if "transact_time" not in cols:
        src = next((c for c in cols if "time" in c), None)
        if src is None:
            raise SchemaError("no time column in trades")
        df = df.withColumnRenamed(src, "transact_time")
    us = epoch_to_micros(_try("transact_time", "long"))
    typed = {
        "agg_trade_id": _try("agg_trade_id", "long"),
        "time": micros_to_ntz(us),
        "price": _try("price", "double"),
        "quantity": _try("quantity", "double"),
        "first_trade_id": _try("first_trade_id", "long"),
        "last_trade_id": _try("last_trade_id", "long"),
        "is_buyer_maker": _try("is_buyer_maker", "boolean"),
        "is_best_match": _try("is_best_match", "boolean"),
        "ts": us,
    }
    return df.select(*keep, *[typed[c].alias(c) for c in AGG_TRADE_COLUMNS])


def normalize_metrics(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """P6 + P7 + P10: strict ``create_time`` parse, measures repaired to double.

    Rows whose ``create_time`` does not parse keep ``time = null`` and get
    ``_bad = true``; :func:`split_bad_archives` quarantines their archives.
    """
    t = F.try_to_timestamp(F.col("create_time"), F.lit(METRICS_TIME_FORMAT)).cast("timestamp_ntz")
    return raw.select(
        *keep, t.alias("time"), F.col("symbol").cast("string").alias("symbol"),
        *[_try(c, "double").alias(c) for c in METRIC_MEASURES],
        (t.isNull()).alias("_bad"))


def normalize_funding(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``calc_time`` (ms) -> time; interval hours and rate typed."""
    return raw.select(
        *keep, millis_to_ntz(_try("calc_time", "long")).alias("time"),
        _try("funding_interval_hours", "int").alias("funding_interval_hours"),
        _try("last_funding_rate", "double").alias("last_funding_rate"))


def normalize_bvol(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``calc_time`` (ms) -> time; index value typed."""
    return raw.select(
        *keep, millis_to_ntz(_try("calc_time", "long")).alias("time"),
        F.col("symbol").cast("string").alias("symbol"),
        F.col("base_asset").cast("string").alias("base_asset"),
        F.col("quote_asset").cast("string").alias("quote_asset"),
        _try("index_value", "double").alias("index_value"))


def split_bad_archives(df: DataFrame, archive_col: str = "archive",
                       bad: Column | None = None, reason: str = "parse error"):
    """(good rows, quarantine) - an archive with any bad row is dropped
    whole; the quarantine holds one ``(archive, error)`` row per dropped archive.

    The bad-archive list is one row per archive (aggregated map-side), and the
    anti join removes their rows; good archives are never shuffled twice.
    """
    flag = F.col("_bad") if bad is None else bad
    bad_archives = (df.filter(flag).groupBy(archive_col)
                    .agg(F.count(F.lit(1)).alias("bad_rows"))
                    .withColumn("error", F.lit(reason)))
    good = df.join(bad_archives.select(archive_col), [archive_col], "left_anti")
    if "_bad" in good.columns:
        good = good.drop("_bad")
    return good, bad_archives
