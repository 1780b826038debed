"""Driver queries of the archive types, of refused archives, and of the checks beside them,
with their DuckDB SQL. Every archive is written from a given table first, by Spark."""

from __future__ import annotations

from pyspark.sql import functions as F

from candlewright.driver_oracle import _METRICS_PARSED, _T_US, ORACLE as CORE_ORACLE, T_SQL, kline_all_sql, kline_sql, tbars
from candlewright.driver_queries import T_bars, raw_metrics
from candlewright.fixtures import table, trades_T
from candlewright.functions.timecols import ntz_to_millis
from candlewright.operators import quality as QC
from candlewright.plans import archive_plan as AP
from candlewright.plans import refresh as RF
from candlewright.schemas import (AGG_TRADE_COLUMNS, DATA_TYPES, MARKETS, RAW_BVOL_COLUMNS, RAW_FUNDING_COLUMNS,
                                  RAW_METRICS_COLUMNS, VALID_MARKET_TYPES)
from candlewright.session import shared_dir
from candlewright.sources import archives as AR
from candlewright.sources import store as ST
from candlewright.streaming import bars as SB


def _written(df, data_type, columns, order, header=True):
    """``df`` (with symbol and day) as archives in a fresh folder."""
    root = shared_dir(df.sparkSession, data_type)
    AR.write_archives(df.withColumn("_h", F.lit(header)), root, data_type, columns, "_h", order).count()
    return root


def q_zip_spot(spark, d):
    """Headerless spot archives."""
    T = trades_T(spark, d).withColumns({
        "day": F.col("time").cast("date"), "transact_time": F.col("ts"), "is_best_match": F.col("agg_trade_id") % 3 == 0})
    root = _written(T, "aggTrades", AR.SPOT_TRADE_COLUMNS, ("agg_trade_id",), header=False)
    good, _ = AR.ingest(spark, root, "aggTrades", "spot")
    return good.select("symbol", *AGG_TRADE_COLUMNS)


def q_zip_metrics(spark, d):
    """Measures repaired, archives with an impossible time refused."""
    raw = raw_metrics(spark, d).withColumn("day", F.to_date(F.substring("archive", -10, 10)))
    root = _written(raw, "metrics", RAW_METRICS_COLUMNS, ("create_time",))
    good, _ = AR.ingest(spark, root, "metrics", "future")
    return good.drop("archive", "row", "archive_year")


def _funding(spark, d):
    return table(spark, d, "orders").select(
        F.col("o_orderstatus").alias("symbol"), F.trunc("o_orderdate", "month").alias("day"), F.col("o_orderkey"),
        (ntz_to_millis("o_orderdate") + F.col("o_orderkey")).alias("calc_time"),
        F.lit("8").alias("funding_interval_hours"), (F.col("o_totalprice") / 1e6).alias("last_funding_rate"))


def q_zip_funding(spark, d):
    """S5."""
    good, _ = AR.ingest(spark, _written(_funding(spark, d), "fundingRate", RAW_FUNDING_COLUMNS, ("o_orderkey",)),
                        "fundingRate", "future")
    return good.drop("archive", "row", "archive_year")


def _bvol(spark, d):
    return table(spark, d, "orders").select(
        F.concat("o_orderstatus", F.lit("BVOLUSDT")).alias("symbol"), F.trunc("o_orderdate", "month").alias("day"),
        F.col("o_orderkey"), (ntz_to_millis("o_orderdate") + F.col("o_orderkey")).alias("calc_time"),
        F.col("o_orderstatus").alias("base_asset"), F.lit("USDT").alias("quote_asset"),
        (F.col("o_totalprice") / 1000).alias("index_value"))


def q_zip_bvol(spark, d):
    """S6."""
    good, _ = AR.ingest(spark, _written(_bvol(spark, d), "BVOLIndex", RAW_BVOL_COLUMNS, ("o_orderkey",)),
                        "BVOLIndex", "option")
    return good.drop("archive", "row", "archive_year")


def q_zip_malformed(spark, d):
    """Rows broken by their keys in every archive type; the first bad line and column of
    every refused archive. Futures trades: empty prices, worded quantities, NaN; funding: worded
    rates and empty hours; vol index: a file without its index column, per symbol F."""
    T = trades_T(spark, d)
    i = F.col("agg_trade_id")
    trades = T.withColumns({
        "day": F.col("time").cast("date"), "transact_time": F.col("ts"),
        "price": F.when(i % 997 == 0, F.lit("")).otherwise(F.col("price").cast("string")),
        "quantity": F.when(i % 499 == 0, F.lit("many")).when(i % 503 == 0, F.lit("NaN"))
                     .otherwise(F.col("quantity").cast("string"))})
    k = F.col("o_orderkey")
    funding = _funding(spark, d).withColumns({
        "funding_interval_hours": F.when(k % 907 == 0, F.lit("")).otherwise(F.col("funding_interval_hours")),
        "last_funding_rate": F.when(k % 911 == 0, F.lit("oops")).otherwise(F.col("last_funding_rate").cast("string"))})
    bvol = _bvol(spark, d)
    roots = {("aggTrades", "future"): _written(trades, "aggTrades", AR.FUTURES_TRADE_COLUMNS, ("agg_trade_id",)),
             ("fundingRate", "future"): _written(funding, "fundingRate", RAW_FUNDING_COLUMNS, ("o_orderkey",))}
    whole = _written(bvol.filter("base_asset <> 'F'"), "BVOLIndex", RAW_BVOL_COLUMNS, ("o_orderkey",))
    short = whole + "/without"
    AR.write_archives(bvol.filter("base_asset = 'F'").withColumn("_h", F.lit(True)), short, "BVOLIndex",
                      RAW_BVOL_COLUMNS[:-1], "_h").count()
    roots["BVOLIndex", "option"] = whole
    bad = [AR.ingest(spark, root, t, m)[1] for (t, m), root in roots.items()]
    out = bad[0].unionByName(bad[1]).unionByName(bad[2])
    return out.select("archive", "bad_rows", "error", "line", "column")


def q_valid_requests(spark, d):
    """the (market, data type) pairs of events that the ingest does not accept."""
    ev = table(spark, d, "events")
    pick = lambda names, c: F.element_at(F.array(*map(F.lit, names)), (F.col(c) % len(names) + 1).cast("int"))
    wanted = ev.select(pick(MARKETS, "user_id").alias("market"), pick(DATA_TYPES, "event_id").alias("data_type"))
    return AP.check_valid(wanted).groupBy("market", "data_type").agg(F.count(F.lit(1)).alias("requests"))


def q_bar_grid(spark, d):
    """Every expected slot of the hourly and daily bars."""
    return QC.expected_bar_grid(T_bars(spark, d, ("1h", "1d")))


# ---------------------------------------------------------------- refreshes

BAR_OPTIONS = dict(intervals=("1h", "1d"), zero_qty="null", decimals=6)


def q_refresh_incremental(spark, d):
    """Twenty days, then the rest with newer copies of some trades of the tenth; bars of the
    changed days are rebuilt from those days' ticks."""
    root = shared_dir(spark, "incremental")
    T = trades_T(spark, d)
    day = F.dayofmonth("time")
    RF.refresh(spark, T.filter(day <= 20), root, **BAR_OPTIONS)
    newer = T.filter((day == 10) & (F.col("agg_trade_id") % 3 == 0)).withColumn("price", F.col("price") + 1)
    return RF.refresh(spark, T.filter(day > 20).unionByName(newer), root, **BAR_OPTIONS).drop("year")


def q_full_refresh_two_markets(spark, d):
    """Daily archives of two futures sub-markets, refreshed after the first half month, after
    the second, and once more with nothing new; the bars of both."""
    T = trades_T(spark, d).withColumns({"day": F.col("time").cast("date"), "transact_time": F.col("ts"),
                                        "_h": F.length("symbol") > 5})
    store = shared_dir(spark, "markets")
    subs = {"um": T.filter("is_buyer_maker"), "cm": T.filter("not is_buyer_maker")}
    landings = {("future", sub, "aggTrades"): shared_dir(spark, f"landing-{sub}") for sub in subs}
    for part in (F.dayofmonth("time") <= 15, F.dayofmonth("time") > 15, None):
        if part is not None:
            for (_, sub, _), root in landings.items():
                AR.write_archives(subs[sub].filter(part), root, "aggTrades", AR.FUTURES_TRADE_COLUMNS, "_h").count()
        out = RF.full_refresh(spark, landings, store, **BAR_OPTIONS)
    um, cm = (out["future", sub, "klines"] for sub in subs)
    return um.unionByName(cm).drop("year")


def q_report_labels(spark, d):
    """The check report of T as it stands in the store of a sub-market."""
    from candlewright.driver_queries import q_check_report
    return QC.label_report(q_check_report(spark, d), "future", "um")


def q_id_span_files(spark, d):
    """A7 per file: T stored by (symbol, year), spans and notes from every file's footer."""
    path = shared_dir(spark, "span_files")
    ST.write_table(trades_T(spark, d), path)
    return QC.id_span_files(spark, path).drop("file_name")


# ---------------------------------------------------------------- streams

def _in_slices(df, path, n=6):
    """``df`` written in ``n`` slices of time, one after the other, so files arrive in order."""
    lo, hi = df.agg(F.min("ts"), F.max("ts")).first()
    step = (hi - lo) // n + 1
    for i in range(n):
        part = df.filter((F.col("ts") >= lo + i * step) & (F.col("ts") < lo + (i + 1) * step))
        part.coalesce(2).write.mode("append").parquet(path)


def q_stream_dedup_last(spark, d):
    """R2: corrected copies ten minutes after every fifth trade replace it; state bound one hour."""
    src, out, ck = (shared_dir(spark, f"last-{n}") for n in ("src", "out", "ck"))
    T = trades_T(spark, d)
    newer = T.filter(F.col("agg_trade_id") % 5 == 0).withColumns({
        "price": F.col("price") + 1, "time": F.timestamp_add("MINUTE", F.lit(10), F.col("time")),
        "ts": F.col("ts") + 600_000_000})
    _in_slices(T.unionByName(newer), src)
    stream = SB.read_trade_stream(spark, src, T.schema, max_files=2)
    SB.run_to_parquet(SB.dedup_last_stream(stream, 3600), out, ck)
    return SB.latest(spark.read.parquet(out))


def q_stream_late_repair(spark, d):
    """Trades in shuffled files under a one-hour watermark: most rows come after their window
    is out; the stream's bars and the repair of marked days equal batch bars."""
    src, ticks, bars, ck1, ck2 = (shared_dir(spark, f"late-{n}") for n in ("src", "ticks", "bars", "ck1", "ck2"))
    T = trades_T(spark, d)
    k = SB.write_source(T, src, 4, "agg_trade_id")
    stream = SB.read_trade_stream(spark, src, T.schema, max_files=2 * k)
    SB.bars_to_store(stream, bars, ck1, "1h", "1 hour", zero_qty="null", decimals=6)
    SB.tick_stream(stream, ticks, bars, ("symbol", "year", "agg_trade_id"), ck2, 3600)
    out = SB.repair(spark, ticks, bars, ("1h",), zero_qty="null", decimals=6)
    return out.drop("interval", "year")


QUERIES = {
    "stream_dedup_last": q_stream_dedup_last,
    "stream_late_repair": q_stream_late_repair,
    "refresh_incremental": q_refresh_incremental,
    "full_refresh_two_markets": q_full_refresh_two_markets,
    "report_labels": q_report_labels,
    "id_span_files": q_id_span_files,
    "zip_spot": q_zip_spot,
    "zip_metrics": q_zip_metrics,
    "zip_funding": q_zip_funding,
    "zip_bvol": q_zip_bvol,
    "zip_malformed": q_zip_malformed,
    "valid_requests": q_valid_requests,
    "bar_grid": q_bar_grid,
}

_PAIRS = ", ".join(f"('{m}', '{t}')" for m, t in VALID_MARKET_TYPES)


def _pick(names, c):
    return f"list_extract([{', '.join(repr(n) for n in names)}], CAST({c} % {len(names)} + 1 AS BIGINT))"


_REPORT = CORE_ORACLE["check_report"]

_NEWER = f"""SELECT * REPLACE (CASE WHEN day(time) = 10 AND agg_trade_id % 3 = 0 THEN price + 1 ELSE price END AS price)
FROM ({T_SQL}) t0"""


def _market_bars(sub: str, maker: str) -> str:
    bars = kline_all_sql(f"SELECT * FROM ({T_SQL}) t0 WHERE {maker} is_buyer_maker", ("1h", "1d"))
    return f"SELECT *, 'future' AS market, '{sub}' AS market_sub FROM ({bars}) {sub}"


ORACLE = {
    "id_span_files": CORE_ORACLE["id_span_footers"],
    "stream_dedup_last": f"""SELECT * REPLACE (CASE WHEN agg_trade_id % 5 = 0 THEN price + 1 ELSE price END AS price,
  CASE WHEN agg_trade_id % 5 = 0 THEN time + INTERVAL 10 MINUTE ELSE time END AS time,
  CASE WHEN agg_trade_id % 5 = 0 THEN ts + 600000000 ELSE ts END AS ts),
  agg_trade_id AS first_trade_id, agg_trade_id AS last_trade_id, false AS is_best_match FROM ({_T_US}) t""",
    "stream_late_repair": kline_sql(T_SQL, "1h"),
    "refresh_incremental": kline_all_sql(_NEWER, ("1h", "1d")),
    "full_refresh_two_markets": f"{_market_bars('um', '')} UNION ALL {_market_bars('cm', 'NOT')}",
    "report_labels": f"""SELECT *, 'future' AS market, 'um' AS market_sub,
  'future/um/aggTrades' || CASE WHEN kind = 'bars' THEN '_kline' ELSE '' END || '/' || symbol || '/' AS folder
FROM ({_REPORT}) r""",
    "zip_spot": f"""SELECT symbol, agg_trade_id, time, price, quantity, agg_trade_id AS first_trade_id,
  agg_trade_id AS last_trade_id, is_buyer_maker, agg_trade_id % 3 = 0 AS is_best_match, ts FROM ({_T_US}) t""",
    "zip_metrics": f"""WITH p AS ({_METRICS_PARSED})
SELECT * EXCLUDE (archive) FROM p WHERE archive NOT IN (SELECT archive FROM p WHERE time IS NULL)""",
    "zip_funding": """SELECT o_orderstatus AS symbol, make_timestamp((epoch_ms(o_orderdate) + o_orderkey) * 1000) AS time,
  CAST(8 AS INTEGER) AS funding_interval_hours, o_totalprice / 1e6 AS last_funding_rate FROM orders""",
    "zip_bvol": """SELECT make_timestamp((epoch_ms(o_orderdate) + o_orderkey) * 1000) AS time,
  o_orderstatus || 'BVOLUSDT' AS symbol, o_orderstatus AS base_asset, 'USDT' AS quote_asset,
  o_totalprice / 1000 AS index_value FROM orders""",
    "zip_malformed": f"""WITH t AS (SELECT symbol || '-aggTrades-' || strftime(time, '%Y-%m-%d') || '.zip' AS archive,
    row_number() OVER (PARTITION BY symbol, CAST(time AS DATE) ORDER BY agg_trade_id) - 1 AS line,
    CASE WHEN agg_trade_id % 997 = 0 THEN 'price' WHEN agg_trade_id % 499 = 0 OR agg_trade_id % 503 = 0 THEN 'quantity' END
      AS col FROM ({T_SQL}) x
  UNION ALL SELECT o_orderstatus || '-fundingRate-' || strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') || '.zip',
    row_number() OVER (PARTITION BY o_orderstatus, date_trunc('month', o_orderdate) ORDER BY o_orderkey) - 1,
    CASE WHEN o_orderkey % 907 = 0 THEN 'funding_interval_hours' WHEN o_orderkey % 911 = 0 THEN 'last_funding_rate' END
  FROM orders)
SELECT archive, count(*) AS bad_rows, 'parse error' AS error, CAST(min(line) AS BIGINT) AS line,
  arg_min(col, line) AS "column" FROM t WHERE col IS NOT NULL GROUP BY archive
UNION ALL SELECT DISTINCT 'FBVOLUSDT-BVOLIndex-' || strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') || '.zip',
  CAST(1 AS BIGINT), 'missing column: index_value', CAST(NULL AS BIGINT), NULL FROM orders WHERE o_orderstatus = 'F'""",
    "valid_requests": f"""SELECT market, data_type, count(*) AS requests
FROM (SELECT {_pick(MARKETS, 'user_id')} AS market, {_pick(DATA_TYPES, 'event_id')} AS data_type FROM events) e
WHERE (market, data_type) NOT IN ({_PAIRS}) GROUP BY market, data_type""",
    "bar_grid": f"""WITH g AS (SELECT symbol, interval, CAST(year(time) AS INTEGER) AS y, CAST(max(time) AS DATE) AS last
  FROM ({tbars(('1h', '1d'))}) b GROUP BY symbol, interval, year(time))
SELECT symbol, interval, unnest(generate_series(make_timestamp(y, 1, 1, 0, 0, 0.0),
  CAST(last + 1 AS TIMESTAMP) - INTERVAL 1 SECOND,
  CASE interval WHEN '1h' THEN INTERVAL 1 HOUR ELSE INTERVAL 1 DAY END)) AS time FROM g""",
}
