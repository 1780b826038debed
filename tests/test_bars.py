import math

from pyspark.sql import functions as F

from candlewright.operators.bars import cascade, klines, klines_all_intervals
from candlewright.operators.quality import bar_expected_counts, missing_bars
from tests.conftest import trades


def test_same_microsecond_sweep_orders_by_id(spark):
    t = "2024-01-01 00:00:01.000001"
    df = trades(spark, [(7, t, 10.0, 1.0, False), (5, t, 11.0, 1.0, False), (6, t, 12.0, 1.0, False)])
    b = klines(df, "1m").collect()[0]
    assert (b.open, b.close, b.high, b.low) == (11.0, 10.0, 12.0, 10.0)


def test_boundary_trade_goes_to_next_bar(spark):
    df = trades(spark, [(1, "2024-01-01 00:00:59.999999", 1.0, 1.0, False),
                        (2, "2024-01-01 00:01:00", 2.0, 1.0, False)])
    rows = sorted(klines(df, "1m").collect(), key=lambda r: r.time)
    assert [r.time.minute for r in rows] == [0, 1]
    assert [r.open for r in rows] == [1.0, 2.0]


def test_zero_quantity_bar(spark):
    df = trades(spark, [(1, "2024-01-01 00:00:10", 5.0, 0.0, False)])
    b = klines(df, "1m").collect()[0]
    assert math.isnan(b.avg_price)
    assert b.buyer_avg_price is None and b.seller_avg_price is None
    b2 = klines(df, "1m", zero_qty="null").collect()[0]
    assert b2.avg_price is None


def test_one_sided_bar(spark):
    df = trades(spark, [(1, "2024-01-01 00:00:10", 5.0, 2.0, True), (2, "2024-01-01 00:00:20", 7.0, 1.0, True)])
    b = klines(df, "1m").collect()[0]
    assert b.buyer_qty == 0.0 and b.buyer_avg_price is None
    assert b.seller_qty == 3.0 and abs(b.seller_avg_price - 17.0 / 3) < 1e-12


def test_null_maker_counts_on_neither_side(spark):
    df = trades(spark, [(1, "2024-01-01 00:00:10", 5.0, 2.0, None)])
    b = klines(df, "1m").collect()[0]
    assert (b.qty, b.buyer_qty, b.seller_qty) == (2.0, 0.0, 0.0)


def test_halt_gives_19_6_3_missing_bars(spark):
    # one trade per minute over a day, except 06:18..06:36 (19 minutes)
    df = (spark.range(0, 1440).filter(~F.col("id").between(6 * 60 + 18, 6 * 60 + 36))
          .select(F.col("id").alias("agg_trade_id"),
                  F.timestamp_add("MINUTE", F.col("id"), F.expr("TIMESTAMP_NTZ'2025-08-29 00:00:00'"))
                  .alias("time"),
                  F.lit(1.0).alias("price"), F.lit(1.0).alias("quantity"), F.lit(False).alias("is_buyer_maker"),
                  F.lit("ETHUSDT").alias("symbol"))
          .filter(F.col("time") >= F.expr("TIMESTAMP_NTZ'2025-08-29 00:00:00'")))
    bars = klines_all_intervals(df, ("1m", "3m", "5m"))
    # restrict the grid to the halt day: only that day has trades, so use the day's missing bars
    miss = missing_bars(bars).filter(F.col("time") >= F.expr("TIMESTAMP_NTZ'2025-08-29 00:00:00'"))
    counts = {r.interval: r["count"] for r in miss.groupBy("interval").count().collect()}
    assert counts == {"1m": 19, "3m": 6, "5m": 3}


def test_cascade_equals_exact(spark):
    rows = [(i, f"2024-01-0{1 + i % 3} {i % 24:02d}:{(7 * i) % 60:02d}:{(13 * i) % 60:02d}",
             float(1 + (i * 37) % 101) / 4, float(i % 5), i % 2 == 0) for i in range(600)]
    df = trades(spark, rows)
    exact = klines_all_intervals(df, decimals=6, zero_qty="null").orderBy("interval", "time").collect()
    casc = cascade(df, decimals=6, zero_qty="null").orderBy("interval", "time").collect()
    assert exact == casc


def test_invariants(spark):
    rows = [(i, f"2024-01-01 {i % 24:02d}:{(11 * i) % 60:02d}:00", float(1 + i % 17), float(i % 3), i % 2 == 0)
            for i in range(300)]
    df = trades(spark, rows)
    bars = klines(df, "1h")
    assert abs(bars.agg(F.sum("qty")).first()[0] - df.agg(F.sum("quantity")).first()[0]) < 1e-9
    assert bars.filter((F.col("low") > F.col("open")) | (F.col("open") > F.col("high"))
                       | (F.col("low") > F.col("close")) | (F.col("close") > F.col("high"))).count() == 0
    assert bars.filter(F.abs(F.col("buyer_qty") + F.col("seller_qty") - F.col("qty")) > 1e-9).count() == 0


def test_bar_plan_has_no_sort_aggregate(spark):
    df = trades(spark, [(1, "2024-01-01 00:00:10", 5.0, 2.0, True)])
    plan = klines(df, "1h")._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan


def test_leap_year_expected_counts(spark):
    df = trades(spark, [(1, "2024-06-01 00:00:00", 1.0, 1.0, False), (2, "2024-12-31 12:00:00", 1.0, 1.0, False)])
    bars = klines_all_intervals(df, ("1d",))
    r = bar_expected_counts(bars).collect()[0]
    assert (r.expected, r.suffix, r["count"]) == (366, "2024", 2)


def test_missing_bars_equals_grid_minus_bars_with_tiny_buckets(spark):
    from candlewright.operators.quality import expected_bar_grid
    rows = [(i, f"2024-03-0{1 + (i * 7) % 3} {(i * 5) % 24:02d}:{(i * 13) % 60:02d}:00", 1.0, 1.0, False)
            for i in range(200)]
    bars = klines_all_intervals(trades(spark, rows), ("1m", "15m", "1h"))
    want = expected_bar_grid(bars).join(bars.select("symbol", "interval", "time"),
                                        ["symbol", "interval", "time"], "left_anti")
    got = missing_bars(bars, slot_bucket=7, expand_chunk=5)
    key = lambda r: (r.interval, r.time)
    assert sorted(map(key, got.collect())) == sorted(map(key, want.collect()))
