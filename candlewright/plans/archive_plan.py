"""Archive planning and selection.

The plan is a DataFrame: symbols x months/days come from ``sequence`` per
symbol (no cross join), already-present files leave by anti join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candlewright.functions import names as N
from candlewright.functions.timecols import days_between, month_complete, month_starts
from candlewright.schemas import ARCHIVE_GRANULARITY, VALID_MARKET_TYPES


class InvalidRequest(ValueError):
    pass


def validity_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(VALID_MARKET_TYPES), "market string, data_type string")


def check_valid(requests: DataFrame) -> DataFrame:
    """rows of ``(market, data_type)`` that are not allowed (empty = all valid)."""
    valid = validity_table(requests.sparkSession)
    return requests.join(valid, ["market", "data_type"], "left_anti")


def supported_intervals(df: DataFrame) -> DataFrame:
    """F8: the exchange has no 1s bars for futures."""
    return df.filter(~((F.col("market") == "future") & (F.col("interval") == "1s")))


def select_symbols(requested: DataFrame, discovered: DataFrame) -> DataFrame:
    """requested ∩ discovered (semi join; both sides are symbol lists)."""
    return requested.select("symbol").distinct().join(discovered.select("symbol"), "symbol", "left_semi")


def archive_plan(starts: DataFrame, data_types: Sequence[str], cutoff, market: str = "future",
                 market_sub: str = "um", present: DataFrame | None = None,
                 unavailable: DataFrame | None = None, base_url: str = N.ARCHIVE_BASE_URL) -> DataFrame:
    """Archives to fetch per (symbol, data type).

    ``starts`` has ``symbol, start_date`` (G6); ``cutoff`` is the first day
    whose archive is not yet published (G5). Monthly archives cover complete
    months; daily archives cover the remaining days before the cutoff, and a
    month with a monthly archive (planned or present) gets no daily ones.
    ``present`` lists file names already in the landing folder;
    ``unavailable`` lists monthly names known to be missing upstream, whose
    days then fall back to daily archives.

    One branch: each (symbol, type) row generates its complete months and
    its uncovered days in one array (a day is covered exactly when its month
    is complete before the cutoff), so ``starts`` is read once.
    """
    cut = F.to_date(F.lit(cutoff)) if isinstance(cutoff, str) else cutoff
    bad = [t for t in data_types if (market, t) not in VALID_MARKET_TYPES]
    if bad:
        raise InvalidRequest(f"{bad} not available on {market}")
    types = F.array(*[F.struct(F.lit(t).alias("data_type"),
                               F.lit(ARCHIVE_GRANULARITY[t][0]).alias("_has_m"),
                               F.lit(ARCHIVE_GRANULARITY[t][1]).alias("_has_d")) for t in data_types])
    base = starts.select("symbol", "start_date", F.inline(types))
    months = F.filter(month_starts("start_date", cut), lambda m: month_complete(m, cut))
    days = days_between("start_date", F.date_sub(cut, 1))
    monthly = F.when(F.col("_has_m"), F.transform(months, lambda m: F.struct(m.alias("date"), F.lit(False).alias("daily"))))
    daily = F.when(F.col("_has_d"), F.transform(
        F.filter(days, lambda d: ~(F.col("_has_m") & month_complete(d, cut))),
        lambda d: F.struct(d.alias("date"), F.lit(True).alias("daily"))))
    empty = F.array().cast("array<struct<date:date,daily:boolean>>")
    plan = base.select("symbol", "data_type", "_has_m",
                       F.inline(F.concat(F.coalesce(monthly, empty), F.coalesce(daily, empty))))
    plan = plan.withColumn("file_name", F.when(
        F.col("daily"), N.daily_archive_name("symbol", "data_type", "date"))
        .otherwise(N.monthly_archive_name("symbol", "data_type", F.year("date"), F.month("date"))))
    if unavailable is not None:
        # a missing monthly archive is dropped and its month falls back to daily archives
        gone = unavailable.select(F.col("file_name").alias("_gone"))
        plan = plan.join(gone, plan.file_name == gone._gone, "left_anti")
        fallback = (base.filter(F.col("_has_m") & F.col("_has_d"))
                    .select("symbol", "data_type", F.explode(days).alias("date"))
                    .withColumn("_m", N.monthly_archive_name("symbol", "data_type", F.year("date"), F.month("date")))
                    .join(gone, F.col("_m") == gone._gone, "left_semi")
                    .select("symbol", "data_type", "date", F.lit(True).alias("daily"),
                            N.daily_archive_name("symbol", "data_type", "date").alias("file_name")))
        plan = plan.select("symbol", "data_type", "date", "daily", "file_name").unionByName(fallback)
    if present is not None:
        plan = plan.join(present.select("file_name"), "file_name", "left_anti")
    return plan.select(
        "symbol", "data_type", "date", "daily", "file_name",
        N.archive_url("symbol", "data_type", F.lit(market), F.lit(market_sub), "file_name", "daily",
                      base_url).alias("url"))


def select_archives(files: DataFrame, start_date=None) -> DataFrame:
    """F4 + J5: which landed archives to convert.

    Drops daily archives before ``start_date``, daily archives of a month
    that has a monthly archive, and monthly archives whose last day is before
    ``start_date``. Without a start only the monthly rule applies. Rows of a kept monthly archive before the start stay (the
    filter is per archive). ``files`` has ``file_name`` (and optionally more).

    One pass: "this month has a monthly archive" is a window flag over
    (symbol, type, month), a group of at most ~32 archives.
    """
    start = F.to_date(F.lit(start_date or "0001-01-01")) if start_date is None or isinstance(start_date, str) else start_date
    p = N.parse_archive_name(F.col("file_name"))
    parsed = (files.withColumns({
        "_sym": p["symbol"], "_type": p["data_type"], "daily": p["daily"],
        "archive_year": p["year"], "_mon": p["month"], "_day": p["day"],
    }).filter(F.col("daily").isNotNull())
      .withColumn("archive_date", F.make_date("archive_year", "_mon", F.coalesce("_day", F.lit(1)))))
    month = Window.partitionBy("_sym", "_type", "archive_year", "_mon")
    has_monthly = F.max((~F.col("daily")).cast("int")).over(month) == 1
    keep = ((F.col("daily") & (F.col("archive_date") >= start) & ~has_monthly)
            | (~F.col("daily") & (F.last_day("archive_date") >= start)))
    return (parsed.withColumn("_keep", keep).filter("_keep")
            .select(*files.columns, "archive_year", "daily", "archive_date"))
