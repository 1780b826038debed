"""OHLCV bars from trade ticks.

Bars are tumbling, left-closed, left-labelled, epoch-aligned windows; empty
windows produce no bar. open/close are the first/last trade by
``(time, agg_trade_id)``. Plans stay HashAggregate -> Exchange ->
HashAggregate: the ordered first/last use ``min_by``/``max_by`` on a packed
decimal key, so partial aggregation runs map-side and a hot symbol collapses
to one row per bucket and task before the shuffle.

Two ways to get many intervals:

* ``klines_all_intervals(exact=True)`` - every interval straight from ticks in
  one scan and one shuffle (rows are exploded per interval before the partial
  aggregate, which folds them back down map-side).
* ``cascade`` - the finest bars once from ticks, every coarser width from the
  finest bars (all widths divide a day and are multiples of the finest).
  OHLC and quantities equal the exact path; ``qty_usd`` may differ in the last
  bits because sums are regrouped.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewright.functions.timecols import floor_time, interval_seconds, order_key
from candlewright.schemas import BASE_INTERVALS, INTERVAL_SECONDS

SUM_COLUMNS = ("qty", "qty_usd", "buyer_qty", "seller_qty", "buyer_qty_usd", "seller_qty_usd")
BAR_VALUES = ("open", "high", "low", "close", "qty", "qty_usd", "buyer_qty", "seller_qty",
              "avg_price", "buyer_avg_price", "seller_avg_price")


def enrich_trades(trades: DataFrame) -> DataFrame:
    """Notional and the buyer/seller split.

    ``is_buyer_maker = true`` means the seller was the aggressor, so buyer
    volume sums rows with maker = false. A null maker counts on neither side.
    """
    maker = F.col("is_buyer_maker")
    qty_usd = F.col("price") * F.col("quantity")
    return trades.withColumns({
        "qty_usd": qty_usd,
        "buyer_qty": F.when(~maker, F.col("quantity")).otherwise(F.lit(0.0)),
        "seller_qty": F.when(maker, F.col("quantity")).otherwise(F.lit(0.0)),
        "buyer_qty_usd": F.when(~maker, qty_usd).otherwise(F.lit(0.0)),
        "seller_qty_usd": F.when(maker, qty_usd).otherwise(F.lit(0.0)),
    })


def _sum0(c: str) -> Column:
    # Spark's sum over all-null is null; bars report 0.0
    return F.coalesce(F.sum(c), F.lit(0.0)).alias(c)


def _tick_aggs() -> list[Column]:
    k = F.col("_okey")
    return [
        F.min_by("price", k).alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", k).alias("close"),
        F.coalesce(F.sum("quantity"), F.lit(0.0)).alias("qty"),
        *[_sum0(c) for c in SUM_COLUMNS[1:]],
    ]


def _bar_aggs() -> list[Column]:
    # bar -> coarser bar, ordered by the fine bar's own start ``_t``
    # (unique within a (symbol, interval) series)
    return [
        F.min_by("open", "_t").alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", "_t").alias("close"),
        *[_sum0(c) for c in SUM_COLUMNS],
    ]


def finish_bars(bars: DataFrame, zero_qty: str = "nan", keys: Sequence[str] = ("symbol",),
                extra: Sequence[str] = (), decimals: int | None = None) -> DataFrame:
    """P12 + final projection. ``avg_price`` has no zero guard in the reference
    (0/0 = NaN); ``zero_qty="null"`` gives null instead. Side averages are null
    when that side has no quantity.

    ``decimals`` rounds the summed columns before the averages are taken. With
    prices on a fixed tick this removes summation-order noise, so bars from
    differently grouped inputs (cascade, another engine) agree exactly.
    """
    if zero_qty not in ("nan", "null"):
        raise ValueError("zero_qty must be 'nan' or 'null'")
    zero = F.lit(float("nan")) if zero_qty == "nan" else F.lit(None).cast("double")
    if decimals is not None:
        bars = bars.withColumns({c: F.round(c, decimals) for c in SUM_COLUMNS})
    out = bars.withColumns({
        "avg_price": F.when(F.col("qty") == 0, zero).otherwise(F.col("qty_usd") / F.col("qty")),
        "buyer_avg_price": F.when(F.col("buyer_qty") > 0, F.col("buyer_qty_usd") / F.col("buyer_qty")),
        "seller_avg_price": F.when(F.col("seller_qty") > 0, F.col("seller_qty_usd") / F.col("seller_qty")),
    })
    return out.select(*keys, *extra, "time", *BAR_VALUES)


def _with_order_key(trades: DataFrame) -> DataFrame:
    return enrich_trades(trades).withColumn("_okey", order_key("time", "agg_trade_id"))


def klines(trades: DataFrame, interval: str = "1m", zero_qty: str = "nan",
           keys: Sequence[str] = ("symbol",), decimals: int | None = None) -> DataFrame:
    """A1: OHLCV bars of one width. Output: keys, time, open ... seller_avg_price."""
    secs = interval_seconds(interval)
    g = (_with_order_key(trades)
         .groupBy(*keys, F.window("time", f"{secs} seconds").start.alias("time"))
         .agg(*_tick_aggs()))
    return finish_bars(g, zero_qty, keys, decimals=decimals)


def _interval_table(intervals: Iterable[str]) -> Column:
    return F.array(*[
        F.struct(F.lit(i).alias("interval"), F.lit(interval_seconds(i) * 1_000_000).alias("_w"))
        for i in intervals])


def klines_all_intervals(trades: DataFrame, intervals: Sequence[str] = BASE_INTERVALS,
                         include_1s: bool = False, zero_qty: str = "nan",
                         keys: Sequence[str] = ("symbol",), exact: bool = True,
                         decimals: int | None = None) -> DataFrame:
    """A4: bars for every interval, with an ``interval`` column.

    ``exact=True``: each tick is fanned out once per interval and aggregated
    in one pass (one scan, one exchange; the map-side partial aggregate folds
    the fan-out back to one row per bucket and task). ``exact=False`` uses
    :func:`cascade`.
    """
    ivs = _normalise_intervals(intervals, include_1s)
    if not exact:
        return cascade(trades, ivs, zero_qty=zero_qty, keys=keys, decimals=decimals)
    fanned = (_with_order_key(trades)
              .select("*", F.inline(_interval_table(ivs)))
              .withColumn("time", floor_time("time", F.col("_w"))))
    g = fanned.groupBy(*keys, "interval", "time").agg(*_tick_aggs())
    return finish_bars(g, zero_qty, keys, extra=("interval",), decimals=decimals)


def _normalise_intervals(intervals: Sequence[str], include_1s: bool) -> list[str]:
    ivs = list(dict.fromkeys(intervals))
    if include_1s and "1s" not in ivs:
        ivs = ["1s"] + ivs
    for i in ivs:
        interval_seconds(i)
    return sorted(ivs, key=lambda i: INTERVAL_SECONDS[i])


def cascade(trades: DataFrame, intervals: Sequence[str] = BASE_INTERVALS,
            zero_qty: str = "nan", keys: Sequence[str] = ("symbol",),
            decimals: int | None = None) -> DataFrame:
    """A4(b): finest interval from ticks, the rest from the finest bars.

    Requires every width to be a multiple of the finest and to divide a day
    (true for the fixed interval list), so each coarse bar is exactly the
    union of its fine bars.
    """
    ivs = _normalise_intervals(intervals, False)
    finest = ivs[0]
    fs = INTERVAL_SECONDS[finest]
    for i in ivs[1:]:
        if INTERVAL_SECONDS[i] % fs or 86400 % INTERVAL_SECONDS[i]:
            raise ValueError(f"{i} is not a day-dividing multiple of {finest}")
    base = (_with_order_key(trades)
            .groupBy(*keys, F.window("time", f"{fs} seconds").start.alias("time"))
            .agg(*_tick_aggs()))
    # one branch: every interval (the finest as a pass-through) is regrouped
    # from the fine bars, so the ticks are scanned and shuffled exactly once
    out = (base.select("*", F.col("time").alias("_t"), F.inline(_interval_table(ivs)))
           .withColumn("time", floor_time("_t", F.col("_w")))
           .groupBy(*keys, "interval", "time").agg(*_bar_aggs()))
    return finish_bars(out, zero_qty, keys, extra=("interval",), decimals=decimals)
