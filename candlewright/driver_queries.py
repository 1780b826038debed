"""Driver queries: each is ``(spark, sf_dir) -> DataFrame`` over whole tables.

Every computed double is rounded to 6 places (the oracle does the same) so the
value hash does not depend on summation order. Zero-quantity bars use
``zero_qty="null"`` so the hash does not depend on NaN handling.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewright.fixtures import table, trades_L, trades_O, trades_T
from candlewright.functions import names as N
from candlewright.functions.timecols import day_bounds, ntz_to_micros, ntz_to_millis, parse_datetime
from candlewright.operators.bars import cascade, klines, klines_all_intervals
from candlewright.operators.merge import dedup_keep_last
from candlewright.operators import analytics as AN
from candlewright.operators import compare as CMP
from candlewright.operators import coverage as COV
from candlewright.operators import merge as M
from candlewright.operators import normalize as NZ
from candlewright.operators import quality as QC
from candlewright.plans import archive_plan as AP
from candlewright.plans import refresh as RF
from candlewright.session import shared_dir
from candlewright.sources import archives as AR
from candlewright.sources import payload as PL
from candlewright.sources import store as ST
from candlewright.streaming import bars as SB


def r6(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(F.col(f.name), 6).alias(f.name)
                       if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
                       for f in df.schema.fields])


def L_dedup(spark: SparkSession, d: str) -> DataFrame:
    """Fixture L after D2: per (symbol, id) keep the last row by (time, partkey, suppkey)."""
    return dedup_keep_last(trades_L(spark, d, with_order=True),
                           ["symbol", "agg_trade_id"], ["time", "_p", "_s"])


def q_kline_1h(spark, d):
    return klines(trades_T(spark, d), "1h", zero_qty="null", decimals=6)


def q_kline_1d(spark, d):
    return klines(trades_T(spark, d), "1d", zero_qty="null", decimals=6)


def q_kline_15m(spark, d):
    return klines(trades_T(spark, d), "15m", zero_qty="null", decimals=6)


def q_kline_all_intervals(spark, d):
    return klines_all_intervals(trades_T(spark, d), zero_qty="null", decimals=6)


def q_kline_cascade(spark, d):
    return cascade(trades_T(spark, d), zero_qty="null", decimals=6)


def q_kline_ties_daily(spark, d):
    return klines(L_dedup(spark, d), "1d", zero_qty="null", decimals=6)


def q_dedup_keep_last(spark, d):
    return r6(L_dedup(spark, d).drop("_p", "_s"))


QUERIES = {
    "kline_1h": q_kline_1h,
    "kline_1d": q_kline_1d,
    "kline_15m": q_kline_15m,
    "kline_all_intervals": q_kline_all_intervals,
    "kline_cascade": q_kline_cascade,
    "kline_ties_daily": q_kline_ties_daily,
    "dedup_keep_last": q_dedup_keep_last,
}


# ---------------------------------------------------------------- coverage


TAIL_END = "2024-01-15 12:00:00"
NO_DATA_SYMBOL = "NODATA"


def q_coverage_by_year(spark, d):
    return COV.coverage_by_year(trades_L(spark, d))


def q_rows_per_year(spark, d):
    return COV.rows_per_year(trades_L(spark, d))


def q_last_date_resume(spark, d):
    L = trades_L(spark, d)
    wanted = L.select("symbol").distinct().unionByName(
        spark.range(1).select(F.lit(NO_DATA_SYMBOL).alias("symbol")))
    return COV.start_dates(wanted, L)


def q_year_ranges(spark, d):
    return COV.time_range(trades_L(spark, d).withColumn("year", F.year("time")), ["symbol", "year"])


def q_distinct_years(spark, d):
    return COV.distinct_years(trades_L(spark, d), ["symbol"])


# ---------------------------------------------------------------- trade ids

def q_id_span_check(spark, d):
    return QC.id_span_check(trades_T(spark, d))


def q_id_gaps(spark, d):
    return QC.id_gaps(trades_T(spark, d), bucket=97)


def q_id_check_with_gaps(spark, d):
    return QC.id_check_with_gaps(trades_T(spark, d), bucket=97)


def q_id_gaps_dense(spark, d):
    # the whole orders table as one id sequence
    return QC.id_check_with_gaps(trades_O(spark, d).withColumn("symbol", F.lit("ORDERS")),
                                 keys=["symbol"], bucket=1000)


def q_cross_year_continuity(spark, d):
    return QC.cross_year_continuity(QC.id_span_check(L_dedup(spark, d)))


# ---------------------------------------------------------------- bars checks

def T_bars(spark, d, intervals=None):
    from candlewright.schemas import BASE_INTERVALS
    return klines_all_intervals(trades_T(spark, d), intervals or BASE_INTERVALS,
                                zero_qty="null", decimals=6)


def q_bar_expected_counts(spark, d):
    return QC.bar_expected_counts(T_bars(spark, d))


def q_missing_bars(spark, d):
    return QC.missing_bars(T_bars(spark, d, ("1m", "3m", "5m")))


def q_trades_per_minute(spark, d):
    return QC.trades_per_minute(trades_T(spark, d))


def q_trades_per_minute_window(spark, d):
    return QC.trades_per_minute(trades_T(spark, d), start="2024-01-10 06:15:00",
                                end="2024-01-10 09:40:00")


def L_report(spark, d):
    Ld = L_dedup(spark, d)
    spans = QC.id_span_check(Ld)
    bars = klines_all_intervals(Ld, zero_qty="null", decimals=6)
    return QC.check_report(spans, QC.bar_expected_counts(bars), QC.cross_year_continuity(spans))


def q_check_report(spark, d):
    return L_report(spark, d)


def q_run_counters(spark, d):
    return QC.run_counters(L_report(spark, d))


# ---------------------------------------------------------------- compare

COMPARE_INTERVALS = ("1h", "4h", "1d")


def perturbed_reference(local: DataFrame) -> DataFrame:
    """A reference bar set derived from ``local``: bar index ``i = epoch / width``;
    drop bars with i % 97 == 0, scale close by 1 + 2e-4 when i % 50 == 0, and add
    reference-only bars one width before bars with i % 89 == 0 (qty 0 when i is
    even: phantom bars)."""
    secs = QC.interval_seconds_col(F.col("interval"))
    idx = F.floor(ntz_to_micros("time") / (secs.cast("long") * F.lit(1_000_000)))
    b = local.withColumn("_i", idx)
    kept = (b.filter(F.col("_i") % 97 != 0)
            .withColumn("close", F.when(F.col("_i") % 50 == 0, F.col("close") * F.lit(1 + 2e-4))
                        .otherwise(F.col("close"))))
    extra = (b.filter(F.col("_i") % 89 == 0)
             .select("symbol", "interval",
                     F.timestamp_add("SECOND", -secs, F.col("time")).alias("time"),
                     F.col("close").alias("open"), F.col("close").alias("high"),
                     F.col("close").alias("low"), "close",
                     F.when(F.col("_i") % 2 == 0, F.lit(0.0)).otherwise(F.col("qty")).alias("qty"),
                     F.lit(0.0).alias("qty_usd"))
             .join(local.select("symbol", "interval", "time"), ["symbol", "interval", "time"], "left_anti"))
    return kept.select(*extra.columns).unionByName(extra)


def compare_inputs(spark, d):
    local = T_bars(spark, d, COMPARE_INTERVALS).select(
        "symbol", "interval", "time", "open", "high", "low", "close", "qty", "qty_usd")
    return local, perturbed_reference(local)


def q_compare_summary(spark, d):
    local, ref = compare_inputs(spark, d)
    return CMP.compare_summary(local, ref)


def q_compare_detail_topk(spark, d):
    local, ref = compare_inputs(spark, d)
    return CMP.top_mismatches(CMP.compare_detail(local, ref), k=50)


def q_compare_totals(spark, d):
    local, ref = compare_inputs(spark, d)
    return r6(CMP.compare_totals(CMP.compare_detail(local, ref)))


# ---------------------------------------------------------------- analytics

def q_sma_7_25_99(spark, d):
    bars = T_bars(spark, d, ("1h",))
    return AN.sma(bars, decimals=6).select("symbol", "interval", "time", "close", "SMA7", "SMA25", "SMA99")


def q_last_60_bars(spark, d):
    return AN.last_n_bars(T_bars(spark, d, ("1h",)), n=60).select(
        "symbol", "interval", "time", "open", "high", "low", "close")


def q_recent_bars(spark, d):
    return AN.recent_bars(T_bars(spark, d, ("1h",)), TAIL_END, decimals=6)


# ---------------------------------------------------------------- names

def nation_symbols(spark, d):
    quotes = F.array(*[F.lit(q) for q in ("USDT", "FDUSD", "BTC", "XYZ", "")])
    n = table(spark, d, "nation")
    return n.select(F.concat(F.regexp_replace("n_name", "_", ""),
                             F.element_at(quotes, (F.col("n_nationkey") % 5 + 1).cast("int")))
                    .alias("symbol"), "n_nationkey")


def customer_symbols(spark, d):
    """One symbol per customer: its name without punctuation plus a quote asset
    (or none, or an unknown one) chosen by key; keys 0-2 give bare edge cases."""
    quotes = F.array(*[F.lit(q) for q in ("USDT", "FDUSD", "BTC", "XYZ", "")])
    edge = F.array(F.lit("BTC"), F.lit("ETHFDUSD"), F.lit("USDT"))
    c = table(spark, d, "customer")
    name = F.concat(F.upper(F.regexp_replace("c_name", "[^A-Za-z0-9]", "")),
                    F.element_at(quotes, (F.col("c_custkey") % 5 + 1).cast("int")))
    return c.select(F.when(F.col("c_custkey") < 3, F.element_at(edge, (F.col("c_custkey") + 1).cast("int")))
                    .otherwise(name).alias("symbol"))


def q_symbol_split(spark, d):
    base, quote = N.split_symbol("symbol")
    return customer_symbols(spark, d).select("symbol", base.alias("base"), quote.alias("quote"))


def nation_months(spark, d):
    """(symbol, month) for every month in which a nation's customers ordered."""
    o = table(spark, d, "orders").select("o_custkey", F.trunc(F.col("o_orderdate").cast("date"), "MM").alias("m"))
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    s = nation_symbols(spark, d)
    om = o.join(c, o.o_custkey == c.c_custkey).select(F.col("c_nationkey").alias("n_nationkey"), "m").distinct()
    return om.join(s, "n_nationkey").select("symbol", "m")


def q_archive_names(spark, d):
    g = nation_months(spark, d).withColumns(
        {"data_type": F.lit("aggTrades"), "market": F.lit("future"), "market_sub": F.lit("um")})
    g = g.withColumns({
        "monthly": N.monthly_archive_name("symbol", "data_type", F.year("m"), F.month("m")),
        "daily": N.daily_archive_name("symbol", "data_type", F.last_day("m")),
    })
    p = N.parse_archive_name(F.col("daily"))
    pm = N.parse_archive_name(F.col("monthly"))
    return g.select(
        "symbol", "monthly", "daily",
        N.archive_url("symbol", "data_type", "market", "market_sub", "monthly", F.lit(False)).alias("monthly_url"),
        N.archive_url("symbol", "data_type", F.lit("spot"), "market_sub", "daily", F.lit(True)).alias("daily_url"),
        pm["symbol"].alias("parsed_symbol"), pm["year"].alias("parsed_year"),
        pm["month"].alias("parsed_month"), pm["daily"].alias("monthly_is_daily"),
        p["day"].alias("parsed_day"), N.archive_date(F.col("daily")).alias("daily_date"),
        N.stored_year(N.stored_file_name("symbol", "data_type", F.date_format(F.last_day("m"), "yyyy-MM-dd")))
        .alias("stored_year"))


def q_symbol_union(spark, d):
    from candlewright.sources.store import discover_symbols
    return (discover_symbols(trades_T(spark, d)).unionByName(discover_symbols(trades_L(spark, d)))
            .unionByName(discover_symbols(trades_O(spark, d))).distinct())


QUERIES.update({
    "coverage_by_year": q_coverage_by_year,
    "rows_per_year": q_rows_per_year,
    "last_date_resume": q_last_date_resume,
    "year_ranges": q_year_ranges,
    "distinct_years": q_distinct_years,
    "id_span_check": q_id_span_check,
    "id_gaps": q_id_gaps,
    "id_check_with_gaps": q_id_check_with_gaps,
    "id_gaps_dense": q_id_gaps_dense,
    "cross_year_continuity": q_cross_year_continuity,
    "bar_expected_counts": q_bar_expected_counts,
    "missing_bars": q_missing_bars,
    "trades_per_minute": q_trades_per_minute,
    "trades_per_minute_window": q_trades_per_minute_window,
    "check_report": q_check_report,
    "run_counters": q_run_counters,
    "compare_summary": q_compare_summary,
    "compare_detail_topk": q_compare_detail_topk,
    "compare_totals": q_compare_totals,
    "sma_7_25_99": q_sma_7_25_99,
    "last_60_bars": q_last_60_bars,
    "recent_bars": q_recent_bars,
    "symbol_split": q_symbol_split,
    "archive_names": q_archive_names,
    "symbol_union": q_symbol_union,
})


# ---------------------------------------------------------------- normalisation



def q_epoch_normalize(spark, d):
    T = trades_T(spark, d)
    raw = T.select("symbol", "agg_trade_id", "price", "quantity", "first_trade_id", "last_trade_id",
                   "is_buyer_maker",
                   F.when(F.col("agg_trade_id") % 2 == 0, F.expr("ts div 1000"))
                   .otherwise(F.col("ts")).alias("transact_time"))
    n = NZ.normalize_trades(raw, keep=("symbol",))
    return n.select("symbol", "agg_trade_id", "time", "ts",
                    F.date_format("time", "yyyy-MM-dd").alias("date"), F.year("time").alias("year"))


def raw_metrics(spark, d):
    """Metrics CSV fields (strings) derived from T: one archive per symbol-day;
    ids divisible by 997 carry an impossible month, so their archive fails."""
    T = trades_T(spark, d)
    i = F.col("agg_trade_id")
    num = lambda c: (F.when(i % 7 == 0, F.lit("")).when(i % 11 == 0, F.lit("x"))
                     .otherwise(c.cast("string")))
    return T.select(
        F.concat_ws("-", "symbol", F.lit("metrics"), F.date_format("time", "yyyy-MM-dd")).alias("archive"),
        F.when(i % 997 == 0, F.lit("2025-13-01 00:00:00"))
         .otherwise(F.date_format("time", "yyyy-MM-dd HH:mm:ss")).alias("create_time"),
        "symbol",
        num(F.col("price")).alias("sum_open_interest"),
        num(F.col("quantity")).alias("sum_open_interest_value"),
        num(i).alias("count_toptrader_long_short_ratio"),
        num(F.col("price") / 4).alias("sum_toptrader_long_short_ratio"),
        num(F.col("quantity") + 0.5).alias("count_long_short_ratio"),
        F.lit("0.25").alias("sum_taker_long_short_vol_ratio"))


def q_metrics_repair(spark, d):
    good, _ = NZ.split_bad_archives(NZ.normalize_metrics(raw_metrics(spark, d), keep=("archive",)))
    return good.drop("archive")


def q_metrics_quarantine(spark, d):
    _, bad = NZ.split_bad_archives(NZ.normalize_metrics(raw_metrics(spark, d), keep=("archive",)))
    return bad


def q_schema_repair(spark, d):
    O = trades_O(spark, d)
    raw = O.select("symbol", "agg_trade_id", "price", "quantity", "first_trade_id", "last_trade_id",
                   ntz_to_millis("time").alias("trade_time"), "is_buyer_maker")
    return NZ.normalize_trades(raw, keep=("symbol",))


def q_funding_normalize(spark, d):
    o = table(spark, d, "orders")
    raw = o.select(F.col("o_orderstatus").alias("symbol"),
                   (ntz_to_millis("o_orderdate") + F.col("o_orderkey")).cast("string").alias("calc_time"),
                   F.lit("8").alias("funding_interval_hours"),
                   (F.col("o_totalprice") / 1e6).cast("string").alias("last_funding_rate"))
    return NZ.normalize_funding(raw, keep=("symbol",))


def q_bvol_normalize(spark, d):
    o = table(spark, d, "orders")
    raw = o.select((ntz_to_millis("o_orderdate") + F.col("o_orderkey")).alias("calc_time"),
                   F.concat(F.col("o_orderstatus"), F.lit("BVOLUSDT")).alias("symbol"),
                   F.col("o_orderstatus").alias("base_asset"), F.lit("USDT").alias("quote_asset"),
                   (F.col("o_totalprice") / 1000).cast("string").alias("index_value"))
    return NZ.normalize_bvol(raw)


TIME_BOUNDS = {
    "between": ("2024-01-03T00:00:00", "2024-01-05 12:30"),
    "at_or_before": (None, "2024-01-02T06:00"),
    "half_open": ("2024-01-07", "2024-01-08 00:00:00"),
}


def q_time_filters(spark, d):
    T = trades_T(spark, d).select("symbol", "agg_trade_id", "time")
    b = TIME_BOUNDS
    lo, hi = day_bounds(F.lit("2024-01-10"), F.lit("2024-01-11"))
    parts = [
        M.time_between(T, parse_datetime(F.lit(b["between"][0])), parse_datetime(F.lit(b["between"][1])))
        .withColumn("label", F.lit("between")),
        M.time_at_or_before(T, parse_datetime(F.lit(b["at_or_before"][1]))).withColumn("label", F.lit("at_or_before")),
        M.time_half_open(T, parse_datetime(F.lit(b["half_open"][0])), parse_datetime(F.lit(b["half_open"][1])))
        .withColumn("label", F.lit("half_open")),
        M.time_between(T, lo, hi).withColumn("label", F.lit("days")),
        M.in_year(T, 2024).filter(F.month("time") == 1).filter(F.dayofmonth("time") == 20)
        .withColumn("label", F.lit("year")),
    ]
    return M.union_all(*parts)


# ---------------------------------------------------------------- store

def L_full(spark, d):
    return trades_L(spark, d, with_order=True)


def q_write_read_roundtrip(spark, d):
    path = shared_dir(spark, "roundtrip")
    ST.write_table(L_full(spark, d), path)
    back = ST.read_table(spark, path)
    return back.filter(F.col("year").isin(1996, 1997)).filter(
        F.col("time").between(M.ts_literal("1996-06-01 00:00:00"), M.ts_literal("1997-03-31 00:00:00")))


UPSERT_KEYS = ("symbol", "year", "agg_trade_id")
UPSERT_ORDER = ("time", "_p", "_s")


def q_upsert_year(spark, d):
    path = shared_dir(spark, "upsert")
    L = L_full(spark, d)
    ST.upsert(spark, L.filter(F.col("_p") % 2 == 0), path, UPSERT_KEYS, UPSERT_ORDER)
    return ST.upsert(spark, L.filter(F.col("_p") % 2 == 1), path, UPSERT_KEYS, UPSERT_ORDER)


def q_upsert_increment(spark, d):
    """An increment of two far-apart partitions, one of them without a symbol, that holds
    new and newer rows; written first, so nothing in its plan names its partitions."""
    path, inc = shared_dir(spark, "increment"), shared_dir(spark, "increment_rows")
    L = L_full(spark, d).withColumn("symbol", F.nullif("symbol", F.lit("R")))
    ST.upsert(spark, L.filter(F.col("_p") % 2 == 0), path, UPSERT_KEYS, UPSERT_ORDER)
    early, late = (F.col("symbol").isNull() & (F.year("time") == 1993)), ((F.col("symbol") == "N") & (F.year("time") == 1998))
    (L.filter((early | late) & (F.col("_p") % 3 == 0)).withColumn("price", F.col("price") * 2).write.parquet(inc))
    return ST.upsert(spark, spark.read.parquet(inc), path, UPSERT_KEYS, UPSERT_ORDER)


def q_replace_month_folders(spark, d):
    """D5 in a store with a month column: the month's folders are swapped."""
    path, cols = shared_dir(spark, "month_folders"), ("symbol", "year", "month")
    L = L_full(spark, d)
    ST.write_table(L.filter(F.col("_p") % 2 == 0), path, cols)
    return ST.replace_month_in_store(spark, L.filter((F.col("_p") % 2 == 1)), path, 1998, 3, cols).drop("month")


def q_replace_month(spark, d):
    path = shared_dir(spark, "replace_month")
    L = L_full(spark, d)
    ST.write_table(L.filter(F.col("_p") % 2 == 0), path)
    new = L.filter((F.col("_p") % 2 == 1) & (F.year("time") == 1998) & (F.month("time") == 3))
    return ST.replace_month_in_store(spark, new, path, 1998, 3)


def q_bars_dedup_keep_first(spark, d):
    root = shared_dir(spark, "bars_first")
    bars = klines(L_dedup(spark, d), "1d", zero_qty="null", decimals=6).withColumn("interval", F.lit("1d"))
    parts = ("symbol", "interval", "year")
    ST.write_table(bars.filter(F.dayofmonth("time") % 3 != 0), root + "/src=a", parts, order=("time",))
    ST.write_table(bars.withColumn("close", F.col("close") * 2), root + "/src=b", parts, order=("time",))
    out = ST.load_bars(spark, root, "1996-01-01 00:00:00", "1998-12-31 23:59:59.999")
    return out.drop("src", "year")


# ---------------------------------------------------------------- planning

PLAN_END, PLAN_TODAY = "2024-04-05", "2024-06-01"


def plan_starts(spark, d):
    T = trades_T(spark, d)
    return COV.start_dates(T.select("symbol").distinct(), T)


def present_archives(spark, d):
    """Landing folder contents derived from T: each symbol's January monthly archive."""
    T = trades_T(spark, d)
    return T.select("symbol").distinct().select(
        N.monthly_archive_name("symbol", F.lit("aggTrades"), F.lit(2024), F.lit(1)).alias("file_name"))


def q_archive_plan(spark, d):
    from candlewright.functions.timecols import cutoff_date
    return AP.archive_plan(plan_starts(spark, d), ("aggTrades", "metrics", "fundingRate"),
                           cutoff_date(PLAN_END, PLAN_TODAY), present=present_archives(spark, d))


def q_archive_select(spark, d):
    T = trades_T(spark, d)
    days = T.select("symbol", F.col("time").cast("date").alias("day")).distinct()
    daily = days.select(N.daily_archive_name("symbol", F.lit("aggTrades"), "day").alias("file_name"))
    monthly = (T.filter(F.length("symbol") <= 5).select("symbol").distinct()
               .select(N.monthly_archive_name("symbol", F.lit("aggTrades"), F.lit(2024), F.lit(1))
                       .alias("file_name")))
    early = T.select("symbol").distinct().select(
        N.monthly_archive_name("symbol", F.lit("aggTrades"), F.lit(2023), F.lit(12)).alias("file_name"))
    files = daily.unionByName(monthly).unionByName(early)
    return AP.select_archives(files, "2024-01-05")


def altered_L_bars(spark, d):
    """L bars with two defects: no 4h bars for A in 1999, and N's 2001 bars
    stop at 2001-10-01."""
    bars = klines_all_intervals(L_dedup(spark, d), zero_qty="null", decimals=6)
    drop = ((F.col("symbol") == "A") & (F.year("time") == 1999) & (F.col("interval") == "4h")) | \
           ((F.col("symbol") == "N") & (F.col("time") >= M.ts_literal("2001-10-01 00:00:00")))
    return bars.filter(~drop)


def q_stale_partitions(spark, d):
    return RF.stale_partitions(L_dedup(spark, d), altered_L_bars(spark, d))


def q_refresh_symbol(spark, d):
    root = shared_dir(spark, "refresh")
    opts = dict(intervals=("1h", "1d"), zero_qty="null", decimals=6)
    RF.refresh(spark, trades_T(spark, d), root, **opts)
    # second run: nothing is stale, nothing is rewritten
    bars = RF.refresh(spark, trades_T(spark, d), root, **opts)
    return bars.filter(F.col("interval") == "1h").drop("interval", "year")


QUERIES.update({
    "epoch_normalize": q_epoch_normalize,
    "metrics_repair": q_metrics_repair,
    "metrics_quarantine": q_metrics_quarantine,
    "schema_repair": q_schema_repair,
    "funding_normalize": q_funding_normalize,
    "bvol_normalize": q_bvol_normalize,
    "time_filters": q_time_filters,
    "write_read_roundtrip": q_write_read_roundtrip,
    "upsert_year": q_upsert_year,
    "upsert_increment": q_upsert_increment,
    "replace_month": q_replace_month,
    "replace_month_folders": q_replace_month_folders,
    "bars_dedup_keep_first": q_bars_dedup_keep_first,
    "archive_plan": q_archive_plan,
    "archive_select": q_archive_select,
    "stale_partitions": q_stale_partitions,
    "refresh_symbol": q_refresh_symbol,
})


# ---------------------------------------------------------------- sources and streams



def _write_broken_archives(symbols: DataFrame, root: str) -> DataFrame:
    """Per symbol an empty archive (02-01) and an unreadable one (02-02)."""
    import zipfile

    def write(batches):
        import pandas as pd
        for pdf in batches:
            out = []
            for sym in pdf["symbol"]:
                fs, p = AR._fs_path(f"{root}/{sym}-aggTrades-2024-02-01.zip")
                with fs.open_output_stream(p) as f:
                    zipfile.ZipFile(f, "w").close()
                fs, p = AR._fs_path(f"{root}/{sym}-aggTrades-2024-02-02.zip")
                with fs.open_output_stream(p) as f:
                    f.write(b"this is not a zip archive")
                out.append(sym)
            yield pd.DataFrame({"symbol": out})

    return symbols.mapInPandas(write, "symbol string")


def zip_fixture(spark, d):
    root = shared_dir(spark, "zips")
    T = trades_T(spark, d)
    src = T.select(
        "symbol", F.col("time").cast("date").alias("day"), "agg_trade_id", "price", "quantity",
        "first_trade_id", "last_trade_id",
        F.when(F.dayofmonth("time") < 15, F.expr("ts div 1000")).otherwise(F.col("ts")).alias("transact_time"),
        "is_buyer_maker", (F.length("symbol") <= 5).alias("_h"))
    AR.write_archives(src, root, "aggTrades", AR.FUTURES_TRADE_COLUMNS, header_col="_h").count()
    _write_broken_archives(T.select("symbol").distinct(), root).count()
    return AR.ingest(spark, root, "aggTrades", "future")


def q_zip_ingest(spark, d):
    good, _ = zip_fixture(spark, d)
    from candlewright.schemas import AGG_TRADE_COLUMNS
    return good.select("symbol", *AGG_TRADE_COLUMNS)


def q_zip_quarantine(spark, d):
    _, bad = zip_fixture(spark, d)
    return bad.select("archive", "bad_rows", F.when(F.col("error").startswith("empty"), F.lit("empty"))
                      .otherwise(F.lit("unreadable")).alias("error_kind"))


def q_payload_bars(spark, d):
    root = shared_dir(spark, "payload")
    bars = T_bars(spark, d, ("1h",))
    PL.bars_to_payload(bars, width_ms=F.lit(3_600_000)).write.json(root + "/src=a")
    (PL.bars_to_payload(bars.filter(F.dayofmonth("time") <= 10).withColumn("close", F.col("close") * 2),
                        width_ms=F.lit(3_600_000)).write.json(root + "/src=b"))
    payloads = (spark.read.schema("symbol string, interval string, payload string").json(root)
                .withColumn("_file", F.col("_metadata.file_path")))
    return PL.payload_bars(payloads, order=("_file",))


def q_symbol_list(spark, d):
    path = shared_dir(spark, "symbols")
    T = trades_T(spark, d)
    (T.select("symbol").distinct().agg(F.to_json(F.sort_array(F.collect_list("symbol"))).alias("value"))
     .write.text(path))
    requested = PL.symbol_list(spark, path, literals=("click", "ZZZNOTLISTED"))
    return AP.select_symbols(requested, T.select("symbol").distinct())


def q_stream_bars(spark, d):
    src, out, ck = (shared_dir(spark, n) for n in ("stream_src", "stream_out", "stream_ck"))
    T = trades_T(spark, d)
    k = SB.write_source(T, src, 6, "symbol", "agg_trade_id")
    # one far-later row closes every real window (its own bar is never emitted)
    (T.agg(F.min("symbol").alias("symbol"), (F.max("agg_trade_id") + 1).alias("agg_trade_id"),
           F.timestamp_add("DAY", F.lit(40), F.max("time")).alias("time"))
     .select(*[F.col(c) if c in ("symbol", "agg_trade_id", "time") else F.lit(None).cast(t).alias(c)
               for c, t in T.dtypes])
     .select(*T.columns).write.mode("append").parquet(src))
    stream = SB.read_trade_stream(spark, src, T.schema, max_files=2 * k)
    SB.run_to_parquet(SB.bar_stream(stream, "1h", watermark="31 days", zero_qty="null", decimals=6), out, ck)
    return spark.read.parquet(out)


def q_stream_dedup(spark, d):
    src, out, ck = (shared_dir(spark, n) for n in ("dedup_src", "dedup_out", "dedup_ck"))
    L = trades_L(spark, d)
    # all copies of an id sit in one file, four batches
    k = SB.write_source(L, src, 4, "symbol", "agg_trade_id")
    stream = SB.read_trade_stream(spark, src, L.schema, max_files=k)
    SB.run_to_parquet(SB.dedup_stream(stream, watermark="4000 days"), out, ck)
    return spark.read.parquet(out).select("symbol", "agg_trade_id")


def q_stream_upsert(spark, d):
    store, src, ck = (shared_dir(spark, n) for n in ("sup_store", "sup_src", "sup_ck"))
    L = L_full(spark, d)
    ST.upsert(spark, L.filter(F.col("_p") % 2 == 0), store, UPSERT_KEYS, UPSERT_ORDER)
    # all copies of an id sit in one file, so one micro-batch sees them together
    k = SB.write_source(L.filter(F.col("_p") % 2 == 1), src, 4, "symbol", "agg_trade_id")
    stream = SB.read_trade_stream(spark, src, L.schema, max_files=2 * k)
    SB.upsert_stream(stream, store, UPSERT_KEYS, ck, UPSERT_ORDER)
    return ST.read_table(spark, store)


QUERIES.update({
    "zip_ingest": q_zip_ingest,
    "zip_quarantine": q_zip_quarantine,
    "payload_bars": q_payload_bars,
    "symbol_list": q_symbol_list,
    "stream_bars": q_stream_bars,
    "stream_dedup": q_stream_dedup,
    "stream_upsert": q_stream_upsert,
})


# ---------------------------------------------------------------- file names, interval support

def q_bar_file_names(spark, d):
    """P19 + P17 + P16: per (symbol, interval, year) the bar file name from its
    coverage, parsed back."""
    cov = RF.bar_coverage(T_bars(spark, d))
    suffix = F.when(F.col("bar_complete"), F.col("year").cast("string")) \
        .otherwise(F.date_format("bar_last_date", "yyyy-MM-dd"))
    named = cov.withColumn("file_name", N.kline_file_name("symbol", "interval", suffix))
    p = N.parse_kline_name(F.col("file_name"))
    return named.select("symbol", "interval", "year", "file_name",
                        p["interval"].alias("parsed_interval"), p["year"].alias("parsed_year"),
                        p["md"].alias("parsed_md"), N.stored_year(F.col("file_name")).alias("stored_year"))


def q_supported_bars(spark, d):
    """F8: 1s bars exist only off futures; market derived from the symbol."""
    bars = klines_all_intervals(trades_T(spark, d), ("1s", "1m"), decimals=6, zero_qty="null")
    bars = bars.withColumn("market", F.when(F.length("symbol") <= 5, F.lit("future")).otherwise(F.lit("spot")))
    return AP.supported_intervals(bars).groupBy("symbol", "market", "interval").agg(
        F.count(F.lit(1)).alias("bars"), F.round(F.sum("qty"), 6).alias("qty"))


QUERIES.update({
    "bar_file_names": q_bar_file_names,
    "supported_bars": q_supported_bars,
})


# ---------------------------------------------------------------- archive ingest pipeline

def q_ingest_pipeline(spark, d):
    """T written as daily futures archives (microsecond times), converted from
    2024-01-03 on into a store, twice (the second run merges into the first)."""
    from candlewright.plans.ingest import ingest_archives
    from candlewright.schemas import AGG_TRADE_COLUMNS
    landing, store = shared_dir(spark, "landing"), shared_dir(spark, "store")
    T = trades_T(spark, d)
    src = T.select("symbol", F.col("time").cast("date").alias("day"), "agg_trade_id", "price", "quantity",
                   "first_trade_id", "last_trade_id", F.col("ts").alias("transact_time"), "is_buyer_maker",
                   (F.length("symbol") > 5).alias("_h"))
    AR.write_archives(src, landing, "aggTrades", AR.FUTURES_TRADE_COLUMNS, header_col="_h").count()
    ingest_archives(spark, landing, store, "aggTrades", "future", start_date="2024-01-03")
    table, _ = ingest_archives(spark, landing, store, "aggTrades", "future", start_date="2024-01-03")
    return table.select("symbol", "year", *AGG_TRADE_COLUMNS)


QUERIES["ingest_pipeline"] = q_ingest_pipeline


def q_id_span_footers(spark, d):
    """A7 from Parquet footers: T stored by (symbol, year), spans without reading ids."""
    path = shared_dir(spark, "footers")
    ST.write_table(trades_T(spark, d), path)
    return QC.id_span_check_stored(spark, path)


QUERIES["id_span_footers"] = q_id_span_footers


def q_coverage_footers(spark, d):
    """A6 from Parquet footers: L stored by (symbol, year), coverage from min/max of ts."""
    path = shared_dir(spark, "coverage_footers")
    ST.write_table(trades_L(spark, d), path)
    return COV.coverage_stored(spark, path)


QUERIES["coverage_footers"] = q_coverage_footers
