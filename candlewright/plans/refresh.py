"""Incremental refresh (G8, G9): rebuild only what new trades changed.

Stores: trades partitioned by (symbol, year), bars partitioned by (symbol, interval, year).
Every bar width divides a day, so the bars of a day depend on the ticks of that day alone:
a refresh re-aggregates the days that got rows, plus the days a stale or missing bar series
lacks, and replaces just those days in the bar store. Ticks of a day are read again rather
than added to stored sums, because a newer copy of a trade replaces the older one.
"""

from __future__ import annotations

import datetime
import os
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewright.functions import names as N
from candlewright.operators.bars import klines_all_intervals
from candlewright.operators.coverage import coverage_by_year, coverage_stored
from candlewright.operators.merge import ts_literal
from candlewright.schemas import BASE_INTERVALS
from candlewright.sources.store import (PARTITIONS, read_partitions, read_table, replace_partitions, staged,
                                        table_exists, upsert, write_table)
from candlewright.sources.swap import Folder, Swap, recover

BAR_PARTITIONS = ("symbol", "interval", "year")


def bar_coverage(bars: DataFrame) -> DataFrame:
    """Per (symbol, interval, year): last bar date and whether it closes the year."""
    g = bars.groupBy("symbol", "interval", F.year("time").alias("year")).agg(
        F.max("time").cast("date").alias("bar_last_date"))
    return g.withColumn("bar_complete", (F.month("bar_last_date") == 12)
                        & (F.dayofmonth("bar_last_date") == 31))


def _interval_coverage(src: DataFrame, bars: DataFrame | None, intervals: Sequence[str]) -> DataFrame:
    """Source coverage per wanted interval, with the interval's last bar date and two verdicts."""
    want = src.select("*", F.explode(F.array(*[F.lit(i) for i in intervals])).alias("interval"))
    if bars is None:
        cov = want.withColumns({"bar_last_date": F.lit(None).cast("date"),
                                "bar_complete": F.lit(None).cast("boolean")})
    else:
        have = bar_coverage(bars).withColumnsRenamed({c: f"_{c}" for c in ("symbol", "interval", "year")})
        cov = want.join(have, F.col("symbol").eqNullSafe(F.col("_symbol")) & (F.col("interval") == F.col("_interval"))
                        & (F.col("year") == F.col("_year")), "left").drop("_symbol", "_interval", "_year")
    older = ~F.coalesce(F.col("bar_complete"), F.lit(False)) & (F.col("bar_last_date") < F.col("source_last_date"))
    return cov.withColumns({"_missing": F.col("bar_last_date").isNull(), "_older": older})


def stale_partitions(trades: DataFrame | None, bars: DataFrame | None,
                     intervals: Sequence[str] = BASE_INTERVALS, force: bool = False,
                     source_coverage: DataFrame | None = None) -> DataFrame:
    """Per (symbol, year) of the source, whether its bars must be rebuilt.

    An interval never triggers when its output covers the whole year; it
    triggers when missing, or when its output ends before the source's last
    date. One trigger rebuilds all intervals of that (symbol, year).

    ``source_coverage`` (e.g. :func:`coverage_stored`, from Parquet footers)
    replaces the scan of ``trades`` for the source's last dates.
    """
    cov_src = source_coverage if source_coverage is not None else coverage_by_year(trades)
    src = cov_src.select("symbol", "year", F.col("last_date").alias("source_last_date"))
    out = _interval_coverage(src, bars, intervals).groupBy("symbol", "year").agg(
        F.first("source_last_date").alias("source_last_date"),
        F.count_if("_missing").alias("missing_intervals"),
        F.count_if("_older").alias("older_intervals"))
    stale = (F.col("missing_intervals") > 0) | (F.col("older_intervals") > 0)
    if force:
        stale = F.lit(True)
    return out.withColumn("stale", stale)


def stale_days(source_coverage: DataFrame, bars: DataFrame | None, intervals: Sequence[str] = BASE_INTERVALS,
               force: bool = False) -> DataFrame:
    """The (symbol, day) pairs that a stale (symbol, year) lacks: from the last day of its
    shortest series on, or the whole covered year where a series is missing (or ``force``)."""
    src = source_coverage.select("symbol", "year", "first_date", F.col("last_date").alias("source_last_date"))
    lacks = _interval_coverage(src, bars, intervals).groupBy("symbol", "year").agg(
        F.min("first_date").alias("_first"), F.max("source_last_date").alias("_to"),
        F.max("_missing").alias("_missing"), F.min(F.when(F.col("_older"), F.col("bar_last_date"))).alias("_from"))
    start = F.when(F.lit(force) | F.col("_missing"), F.col("_first")).otherwise(F.col("_from"))
    return (lacks.select("symbol", "_to", start.alias("_start")).filter(F.col("_start") <= F.col("_to"))
            .select("symbol", F.explode(F.sequence("_start", "_to")).alias("day")))


def dirty_days(trades: DataFrame) -> DataFrame:
    """The (symbol, day) pairs of an increment."""
    return trades.select("symbol", F.to_date("time").alias("day")).distinct()


def _of_days(df: DataFrame, days: DataFrame, how: str) -> DataFrame:
    """Rows of ``df`` of the given (symbol, day) pairs (``left_semi``) or of others (``left_anti``)."""
    d = days.select(F.col("symbol").alias("_s"), F.col("day").alias("_d"))
    return df.join(d, df["symbol"].eqNullSafe(d["_s"]) & (F.to_date(df["time"]) == d["_d"]), how)


def day_ranges(days: Sequence, most: int = 32) -> list[tuple]:
    """At most ``most`` ranges ``[first, last]`` that cover the days: the smallest gaps are closed."""
    days = sorted(set(days))
    gaps = sorted(((b - a).days, b) for a, b in zip(days, days[1:]) if (b - a).days > 1)
    cuts = sorted(b for _, b in gaps[max(0, len(gaps) - most + 1):])
    starts = days[:1] + cuts
    return [(a, max(x for x in days if b is None or x < b)) for a, b in zip(starts, [*cuts, None])]


def rebuild_days(spark: SparkSession, trades_path: str, bars_path: str, days: DataFrame,
                 intervals: Sequence[str] = BASE_INTERVALS, zero_qty: str = "nan", decimals: int | None = None,
                 exact: bool = False) -> DataFrame | None:
    """Bars of the given (symbol, day) pairs from their ticks, replacing those days in the bar
    store; returns the bar table (None while there is none).

    Only the trade folders of those pairs are opened, and in them the row groups whose times
    meet the days (literal ranges reach the scan; the list of days is bounded by the calendar).
    """
    with staged(days.select("symbol", "day").distinct().withColumn("year", F.year("day")), "dirty_days") as days:
        swap = Swap(spark, trades_path, PARTITIONS)
        folders = swap.touched(days)
        swap.drop()
        ticks = read_partitions(spark, trades_path, folders) if folders else None
        if ticks is not None:
            calendar = [r.day for r in days.select("day").distinct().collect()]
            one = datetime.timedelta(days=1)
            meets = reduce(lambda a, b: a | b, [
                (F.col("time") >= ts_literal(str(a))) & (F.col("time") < ts_literal(str(b + one)))
                for a, b in day_ranges(calendar)])
            todo = _of_days(ticks.filter(meets), days, "left_semi")
            fresh = klines_all_intervals(todo, intervals, zero_qty=zero_qty, decimals=decimals, exact=exact)

            def merge(stored: DataFrame | None, new: DataFrame) -> DataFrame:
                return new if stored is None else _of_days(stored.select(*new.columns), days, "left_anti").unionByName(new)

            replace_partitions(spark, fresh, bars_path, merge, partition_cols=BAR_PARTITIONS, order=("time",))
    return read_table(spark, bars_path) if table_exists(spark, bars_path) else None


def rebuild_stale_bars(spark: SparkSession, trades: DataFrame, bars_path: str,
                       intervals: Sequence[str] = BASE_INTERVALS, force: bool = False,
                       zero_qty: str = "nan", decimals: int | None = None,
                       exact: bool = False, trades_path: str | None = None) -> DataFrame:
    """Re-aggregate bars only for stale (symbol, year) pairs of ``trades`` and
    overwrite those bar partitions; returns the bar table. They are built with
    the cascade (ticks aggregated once); ``exact=True`` takes every interval
    straight from the ticks. With ``trades_path``
    (the stored trade table) the source coverage comes from Parquet footers,
    so deciding what is stale reads no trade rows; only the stale partitions
    are then read (dynamic partition pruning on the semi join)."""
    bars = read_table(spark, bars_path) if table_exists(spark, bars_path) else None
    src_cov = coverage_stored(spark, trades_path) if trades_path else None
    stale = (stale_partitions(trades, bars, intervals, force, source_coverage=src_cov)
             .filter("stale").select("symbol", "year"))
    todo = trades.join(stale, ["symbol", "year"], "left_semi")
    fresh = (klines_all_intervals(todo, intervals, zero_qty=zero_qty, decimals=decimals, exact=exact)
             .withColumn("year", F.year("time")))
    write_table(fresh, bars_path, BAR_PARTITIONS, order=("time",))
    return read_table(spark, bars_path)


MARKS = "_dirty"


def mark_days(days: DataFrame, bars_path: str) -> None:
    """Note (symbol, day) pairs whose bars are to be rebuilt, beside the bar store. Written before
    trades change, so that a run killed in between is caught up by the next one."""
    folder = Folder(days.sparkSession, bars_path).at(MARKS, uuid.uuid4().hex)
    days.select("symbol", "day").coalesce(1).write.parquet(folder)


def rebuild_marked(spark: SparkSession, trades_path: str, bars_path: str, days: DataFrame | None = None,
                   intervals: Sequence[str] = BASE_INTERVALS, zero_qty: str = "nan", decimals: int | None = None,
                   exact: bool = False) -> DataFrame | None:
    """:func:`rebuild_days` of all marked days and ``days``; the marks it read go when the bars are in."""
    bars = Folder(spark, bars_path)
    runs = bars.names(MARKS)
    parts = [spark.read.schema("symbol string, day date").parquet(bars.at(MARKS, r)) for r in runs]
    parts += [days.select("symbol", "day")] if days is not None else []
    out = None
    if parts:
        out = rebuild_days(spark, trades_path, bars_path, reduce(DataFrame.unionByName, parts), intervals, zero_qty,
                           decimals, exact)
    elif table_exists(spark, bars_path):
        out = read_table(spark, bars_path)
    for r in runs:
        bars.remove(MARKS, r)
    return out


def refresh(spark: SparkSession, new_trades: DataFrame, root: str,
            intervals: Sequence[str] = BASE_INTERVALS, force: bool = False,
            keys: Sequence[str] = ("symbol", "year", "agg_trade_id"),
            order: Sequence = (), zero_qty: str = "nan", decimals: int | None = None) -> DataFrame:
    """G9 for one trade store: upsert trades, then rebuild the days they touched and those that
    stale bars lack. The increment is evaluated once. Returns the bar table.
    """
    trades_path, bars_path = os.path.join(root, "aggTrades"), os.path.join(root, "klines")
    lacking = lacking_days(spark, trades_path, bars_path, intervals, force)
    with staged(new_trades, "refresh_new") as new, staged(lacking, "lacking_days") as lacking:
        mark_days(dirty_days(new), bars_path)
        upsert(spark, new, trades_path, keys, order, staged=True)
        return rebuild_marked(spark, trades_path, bars_path, lacking, intervals, zero_qty, decimals)


def lacking_days(spark: SparkSession, trades_path: str, bars_path: str, intervals: Sequence[str] = BASE_INTERVALS,
                 force: bool = False) -> DataFrame:
    """:func:`stale_days` of stored tables (coverage from Parquet footers). Taken before an upsert
    it names what an earlier run left undone, and nothing of the increment."""
    recover(spark, trades_path, PARTITIONS)
    recover(spark, bars_path, BAR_PARTITIONS)
    if not table_exists(spark, trades_path):
        return spark.createDataFrame([], "symbol string, day date")
    bars = read_table(spark, bars_path) if table_exists(spark, bars_path) else None
    return stale_days(coverage_stored(spark, trades_path), bars, intervals, force)


def refresh_bars(spark: SparkSession, trades_path: str, bars_path: str, intervals: Sequence[str] = BASE_INTERVALS,
                 force: bool = False, zero_qty: str = "nan", decimals: int | None = None) -> DataFrame | None:
    """Bars of one trade store brought up to date with its coverage and with all marked days."""
    return rebuild_marked(spark, trades_path, bars_path, lacking_days(spark, trades_path, bars_path, intervals, force),
                          intervals, zero_qty, decimals)


def full_refresh(spark: SparkSession, landings: dict, store_root: str, start_date: str | None = None,
                 intervals: Sequence[str] = BASE_INTERVALS, zero_qty: str = "nan",
                 decimals: int | None = None) -> dict:
    """The whole refresh for a set of landing folders.

    ``landings`` maps ``(market, data_type)`` or ``(market, market_sub, data_type)`` to an archive
    folder (futures without a sub-market are ``um``). Each is converted into its folder below
    ``store_root`` (:func:`candlewright.functions.names.store_folder`), opening only archives that
    its ledger does not know; every trade store then gets the bars of changed days rebuilt, in
    the folder of the same name with ``_kline``. The loop runs over datasets (a handful), never
    over data. Returns ``{key: (table, quarantine)}`` plus the bars as ``(market, [sub,] "klines/<data_type>")``
    and, where a (market, sub) has one trade type, as ``(market, [sub,] "klines")``. All tables have
    the columns ``market`` and ``market_sub``.
    """
    from candlewright.plans.ingest import convert
    out = {}
    for key, landing in landings.items():
        market, sub, data_type = key if len(key) == 3 else (key[0], None, key[1])
        sub = (sub or "um") if market == "future" else None
        store = os.path.join(store_root, N.store_folder(market, sub, data_type))
        if data_type not in ("aggTrades", "trades"):
            table, quarantine, _ = convert(spark, landing, store, data_type, market, start_date)
            out[key] = (with_market(table, market, sub), quarantine)
            continue
        with staged(lacking_days(spark, store, f"{store}_kline", intervals), "lacking_days") as days:
            table, quarantine, _ = convert(spark, landing, store, data_type, market, start_date,
                                           before_upsert=lambda new, path=f"{store}_kline": mark_days(new, path))
            bars = with_market(rebuild_marked(spark, store, f"{store}_kline", days, intervals, zero_qty, decimals),
                               market, sub)
            out[key] = (with_market(table, market, sub), quarantine)
            out[(*key[:-1], f"klines/{data_type}")] = bars
            if sum(k[:-1] == key[:-1] and k[-1] in ("aggTrades", "trades") for k in landings) == 1:
                out[(*key[:-1], "klines")] = bars
    return out


def with_market(df: DataFrame | None, market: str, market_sub: str | None) -> DataFrame | None:
    """A stored table with the market it belongs to."""
    if df is None:
        return None
    return df.withColumns({"market": F.lit(market), "market_sub": F.lit(market_sub).cast("string")})
