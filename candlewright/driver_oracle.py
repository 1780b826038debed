"""DuckDB oracle SQL for the driver queries (same column names and rounding)."""

from __future__ import annotations

from candlewright.fixtures import L_SQL, O_SQL, T_SQL
from candlewright.schemas import BASE_INTERVALS, INTERVAL_SECONDS

EPOCH = "TIMESTAMP '1970-01-01 00:00:00'"


def _bucket(secs: int, col: str = "time") -> str:
    return f"time_bucket(INTERVAL '{secs} seconds', {col}, {EPOCH})"


def _bar_select(keys: str, inner: str) -> str:
    """Sums rounded to 6 places first, averages from the rounded sums."""
    return f"""SELECT {keys}, time, open, high, low, close, qty, qty_usd, buyer_qty, seller_qty,
  qty_usd / nullif(qty, 0) AS avg_price,
  CASE WHEN buyer_qty > 0 THEN buyer_qty_usd / buyer_qty END AS buyer_avg_price,
  CASE WHEN seller_qty > 0 THEN seller_qty_usd / seller_qty END AS seller_avg_price
FROM (SELECT {keys}, bt AS time, open, high, low, close,
  round(qty, 6) AS qty, round(qty_usd, 6) AS qty_usd,
  round(buyer_qty, 6) AS buyer_qty, round(seller_qty, 6) AS seller_qty,
  round(buyer_qty_usd, 6) AS buyer_qty_usd, round(seller_qty_usd, 6) AS seller_qty_usd
  FROM ({inner}) b0) b1"""


_AGGS = """first(price ORDER BY time, agg_trade_id) AS open, max(price) AS high, min(price) AS low,
    last(price ORDER BY time, agg_trade_id) AS close,
    coalesce(sum(quantity), 0.0) AS qty,
    coalesce(sum(price * quantity), 0.0) AS qty_usd,
    coalesce(sum(CASE WHEN NOT is_buyer_maker THEN quantity ELSE 0.0 END), 0.0) AS buyer_qty,
    coalesce(sum(CASE WHEN is_buyer_maker THEN quantity ELSE 0.0 END), 0.0) AS seller_qty,
    coalesce(sum(CASE WHEN NOT is_buyer_maker THEN price * quantity ELSE 0.0 END), 0.0) AS buyer_qty_usd,
    coalesce(sum(CASE WHEN is_buyer_maker THEN price * quantity ELSE 0.0 END), 0.0) AS seller_qty_usd"""


def kline_sql(source: str, interval: str) -> str:
    secs = INTERVAL_SECONDS[interval]
    return _bar_select("symbol", f"""SELECT symbol, {_bucket(secs)} AS bt, {_AGGS}
      FROM ({source}) src GROUP BY symbol, bt""")


def kline_all_sql(source: str, intervals=BASE_INTERVALS) -> str:
    parts = []
    for i in intervals:
        secs = INTERVAL_SECONDS[i]
        parts.append(f"""SELECT symbol, '{i}' AS interval, {_bucket(secs)} AS bt, {_AGGS}
      FROM ({source}) src GROUP BY symbol, bt""")
    return _bar_select("symbol, interval", " UNION ALL ".join(parts))


L_DEDUP_SQL = f"""SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol, agg_trade_id
                               ORDER BY time DESC, _p DESC, _s DESC) AS rn
  FROM ({L_SQL}) l) x WHERE rn = 1"""

L_FULL_SQL = """SELECT l_returnflag AS symbol, l_orderkey * 10 + l_linenumber AS agg_trade_id,
  l_shipdate AS time, l_extendedprice AS price, l_quantity AS quantity,
  l_orderkey AS first_trade_id, l_orderkey AS last_trade_id,
  (l_linestatus = 'F') AS is_buyer_maker, false AS is_best_match,
  epoch_us(l_shipdate) AS ts, l_partkey AS _p, l_suppkey AS _s FROM lineitem"""

L_DEDUP_FULL_SQL = f"""SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol, agg_trade_id
                               ORDER BY time DESC, _p DESC, _s DESC) AS rn
  FROM ({L_FULL_SQL}) l) x WHERE rn = 1"""


ORACLE = {
    "kline_1h": kline_sql(T_SQL, "1h"),
    "kline_1d": kline_sql(T_SQL, "1d"),
    "kline_15m": kline_sql(T_SQL, "15m"),
    "kline_all_intervals": kline_all_sql(T_SQL),
    "kline_cascade": kline_all_sql(T_SQL),
    "kline_ties_daily": kline_sql(L_DEDUP_SQL, "1d"),
    "dedup_keep_last": f"SELECT * EXCLUDE (_p, _s) FROM ({L_DEDUP_FULL_SQL}) z",
}


# ---------------------------------------------------------------- coverage, checks, compare, analytics, names


_SECS_CASE = "CASE interval " + " ".join(
    f"WHEN '{k}' THEN {v}" for k, v in INTERVAL_SECONDS.items()) + " END"


def tbars(intervals=BASE_INTERVALS) -> str:
    return kline_all_sql(T_SQL, intervals)


def _spans(src: str) -> str:
    return f"""SELECT symbol, CAST(year(time) AS INTEGER) AS year, count(*) AS count,
  min(agg_trade_id) AS start_id, max(agg_trade_id) AS end_id,
  max(agg_trade_id) - min(agg_trade_id) + 1 - count(*) AS gap_count, '' AS note
FROM ({src}) t GROUP BY symbol, year(time)"""


def _gaps(src: str) -> str:
    return f"""SELECT symbol, year, id AS prev_id, next_id, next_id - id - 1 AS missing FROM (
  SELECT symbol, year, id, lead(id) OVER (PARTITION BY symbol, year ORDER BY id) AS next_id
  FROM (SELECT DISTINCT symbol, CAST(year(time) AS INTEGER) AS year, agg_trade_id AS id FROM ({src}) t) u) v
WHERE next_id - id > 1"""


def _gap_totals(src: str) -> str:
    return f"""SELECT s.*, coalesce(x.gr, 0) AS gap_ranges, coalesce(x.mi, 0) AS missing_ids
FROM ({_spans(src)}) s LEFT JOIN (
  SELECT symbol, year, count(*) AS gr, CAST(sum(missing) AS BIGINT) AS mi FROM ({_gaps(src)}) g
  GROUP BY symbol, year) x ON s.symbol = x.symbol AND s.year = x.year"""


def _continuity(src: str) -> str:
    return f"""SELECT symbol, prev_year, year, prev_end_id, start_id, start_id - prev_end_id - 1 AS missing
FROM (SELECT symbol, year, start_id, end_id,
        lag(year) OVER (PARTITION BY symbol ORDER BY year) AS prev_year,
        lag(end_id) OVER (PARTITION BY symbol ORDER BY year) AS prev_end_id
      FROM ({_spans(src)}) s) w
WHERE prev_end_id IS NOT NULL AND start_id <> prev_end_id + 1"""


def _expected(bars: str) -> str:
    return f"""SELECT symbol, interval, year, suffix, expected, count, count - expected AS diff,
  CASE WHEN interval = '1s' AND count - expected < 0 THEN 'sparse: seconds without trades' ELSE '' END AS note
FROM (SELECT symbol, interval, year, count,
        CASE WHEN month(last) = 12 AND day(last) = 31 THEN CAST(year AS VARCHAR)
             ELSE strftime(last, '%Y-%m-%d') END AS suffix,
        CAST(CASE WHEN month(last) = 12 AND day(last) = 31
                  THEN CASE WHEN (year % 4 = 0 AND year % 100 <> 0) OR year % 400 = 0 THEN 366 ELSE 365 END
                  ELSE dayofyear(last) END * (86400 // {_SECS_CASE}) AS BIGINT) AS expected
      FROM (SELECT symbol, interval, CAST(year(time) AS INTEGER) AS year, count(*) AS count,
                   CAST(max(time) AS DATE) AS last
            FROM ({bars}) b GROUP BY symbol, interval, year(time)) g) e"""


def _report(src: str) -> str:
    bars = kline_all_sql(src, BASE_INTERVALS)
    return f"""SELECT symbol, 'trades' AS kind, printf('%s_%s_%d.parquet', symbol, 'aggTrades', year) AS name,
  CAST(NULL AS VARCHAR) AS interval, CAST(NULL AS BIGINT) AS interval_seconds, year,
  CAST(NULL AS BIGINT) AS expected, count, CAST(NULL AS BIGINT) AS diff, start_id, end_id, gap_count,
  CAST(NULL AS BIGINT) AS missing, note
FROM ({_spans(src)}) s
UNION ALL
SELECT symbol, 'bars', printf('%s_kline_%s_%s.parquet', symbol, interval, suffix), interval,
  CAST({_SECS_CASE} AS BIGINT), year, expected, count, diff, NULL, NULL, NULL, NULL, note
FROM ({_expected(bars)}) e
UNION ALL
SELECT symbol, 'continuity', printf('%s_%s_%d.parquet', symbol, 'aggTrades', year), NULL, NULL, year,
  NULL, NULL, NULL, prev_end_id, start_id, NULL, missing,
  printf('%d ids missing between %d and %d', missing, prev_end_id, start_id)
FROM ({_continuity(src)}) c"""


def _perturbed() -> str:
    local = f"SELECT symbol, interval, time, open, high, low, close, qty, qty_usd FROM ({tbars(('1h', '4h', '1d'))}) x"
    return f"""local AS ({local}),
b AS (SELECT *, {_SECS_CASE} AS secs, epoch_us(time) // (CAST({_SECS_CASE} AS BIGINT) * 1000000) AS i FROM local),
kept AS (SELECT symbol, interval, time, open, high, low,
           CASE WHEN i % 50 = 0 THEN close * CAST(1.0002 AS DOUBLE) ELSE close END AS close, qty, qty_usd
         FROM b WHERE i % 97 <> 0),
extra AS (SELECT symbol, interval, time - to_seconds(secs) AS time, close AS open, close AS high,
            close AS low, close, CASE WHEN i % 2 = 0 THEN 0.0 ELSE qty END AS qty, 0.0 AS qty_usd
          FROM b WHERE i % 89 = 0),
ref AS (SELECT * FROM kept UNION ALL
        SELECT * FROM extra e WHERE NOT EXISTS (SELECT 1 FROM local l WHERE l.symbol = e.symbol
          AND l.interval = e.interval AND l.time = e.time))"""


def _detail() -> str:
    return f"""WITH {_perturbed()},
d AS (SELECT coalesce(l.symbol, r.symbol) AS symbol, coalesce(l.interval, r.interval) AS interval,
        coalesce(l.time, r.time) AS time,
        l.open AS open_p, r.open AS open_b, l.open - r.open AS open_diff,
        l.high AS high_p, r.high AS high_b, l.high - r.high AS high_diff,
        l.low AS low_p, r.low AS low_b, l.low - r.low AS low_diff,
        l.close AS close_p, r.close AS close_b, l.close - r.close AS close_diff
      FROM local l FULL OUTER JOIN ref r
        ON l.symbol = r.symbol AND l.interval = r.interval AND l.time = r.time),
dd AS (SELECT *, CASE WHEN open_diff IS NOT NULL OR high_diff IS NOT NULL OR low_diff IS NOT NULL
                        OR close_diff IS NOT NULL
                      THEN coalesce(abs(open_diff), 0.0) + coalesce(abs(high_diff), 0.0)
                           + coalesce(abs(low_diff), 0.0) + coalesce(abs(close_diff), 0.0) END AS sum_abs_diff
       FROM d)"""


_SUMMARY = f"""WITH {_perturbed()},
j AS (SELECT coalesce(l.symbol, r.symbol) AS symbol, coalesce(l.interval, r.interval) AS interval,
        l.close AS close_l, r.close AS close_a, l.qty AS qty_l, r.qty AS qty_a,
        l.symbol IS NOT NULL AS in_l, r.symbol IS NOT NULL AS in_r
      FROM local l FULL OUTER JOIN ref r
        ON l.symbol = r.symbol AND l.interval = r.interval AND l.time = r.time),
g AS (SELECT symbol, interval,
        count(*) FILTER (WHERE in_l) AS local_bars, count(*) FILTER (WHERE in_r) AS api_bars,
        count(*) FILTER (WHERE in_l AND in_r) AS matched,
        count(*) FILTER (WHERE in_r AND NOT in_l AND coalesce(qty_a, 0.0) > 0) AS missing_local,
        count(*) FILTER (WHERE in_l AND NOT in_r) AS missing_api,
        max(abs(close_l - close_a)) FILTER (WHERE in_l AND in_r) AS mac,
        max(abs(close_l - close_a) / greatest(abs(close_a), 1e-12)) FILTER (WHERE in_l AND in_r) AS mrc,
        max(abs(qty_l - qty_a)) FILTER (WHERE in_l AND in_r) AS maq,
        max(abs(qty_l - qty_a) / greatest(abs(qty_a), 1e-12)) FILTER (WHERE in_l AND in_r) AS mrq
      FROM j GROUP BY symbol, interval),
h AS (SELECT symbol, interval, local_bars, api_bars, matched, missing_local, missing_api,
        CASE WHEN matched = 0 THEN 0.0 ELSE mac END AS max_abs_close,
        CASE WHEN matched = 0 THEN 0.0 ELSE mrc END AS max_rel_close,
        CASE WHEN matched = 0 THEN 0.0 ELSE maq END AS max_abs_qty,
        CASE WHEN matched = 0 THEN 0.0 ELSE mrq END AS max_rel_qty FROM g)
SELECT *, CASE WHEN local_bars = 0 AND api_bars = 0 THEN 'SKIP'
               WHEN matched = 0 THEN 'FAIL'
               WHEN missing_local > 0 OR missing_api > 0 THEN 'FAIL'
               WHEN max_rel_close <= 1e-4 AND max_rel_qty <= 5e-2 THEN 'PASS'
               WHEN max_rel_close <= 1e-3 THEN 'WARN' ELSE 'FAIL' END AS status
FROM h"""


def _sma_cols() -> str:
    return ", ".join(
        f"CASE WHEN count(close) OVER w{n} = {n} THEN round(sum(close) OVER w{n}, 6) / {float(n)} END AS SMA{n}"
        for n in (7, 25, 99))


_SMA_WINDOWS = "WINDOW " + ", ".join(
    f"w{n} AS (PARTITION BY symbol, interval ORDER BY time ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    for n in (7, 25, 99))

_NATION_SYMBOLS = """SELECT replace(n_name, '_', '') || (['USDT', 'FDUSD', 'BTC', 'XYZ', ''])[n_nationkey % 5 + 1]
  AS symbol, n_nationkey FROM nation"""

_QUOTE_RE = "^(.+)(USDT|USDC|BUSD|FDUSD|TUSD|DAI|BTC|ETH|BNB)$"

_TPM_WINDOW = ("2024-01-10 06:15:00", "2024-01-10 09:40:00")

ORACLE.update({
    "coverage_by_year": f"""SELECT symbol, CAST(year(time) AS INTEGER) AS year,
  CAST(min(time) AS DATE) AS first_date, CAST(max(time) AS DATE) AS last_date, count(*) AS rows,
  (month(max(time)) = 12 AND day(max(time)) = 31) AS complete,
  CASE WHEN month(max(time)) = 12 AND day(max(time)) = 31 THEN CAST(year(max(time)) AS VARCHAR)
       ELSE strftime(max(time), '%Y-%m-%d') END AS suffix
FROM ({L_SQL}) l GROUP BY symbol, year(time)""",
    "rows_per_year": f"SELECT CAST(year(time) AS INTEGER) AS year, count(*) AS rows FROM ({L_SQL}) l GROUP BY year(time)",
    "last_date_resume": f"""WITH l AS ({L_SQL}),
s AS (SELECT DISTINCT symbol FROM l UNION SELECT 'NODATA'),
m AS (SELECT symbol, CAST(max(time) AS DATE) AS last_date FROM l GROUP BY symbol)
SELECT s.symbol, m.last_date, coalesce(CAST(m.last_date + 1 AS DATE), DATE '2020-01-01') AS start_date
FROM s LEFT JOIN m ON s.symbol = m.symbol""",
    "year_ranges": f"""SELECT symbol, CAST(year(time) AS INTEGER) AS year, min(time) AS min_time, max(time) AS max_time
FROM ({L_SQL}) l GROUP BY symbol, year(time)""",
    "distinct_years": f"SELECT DISTINCT symbol, CAST(year(time) AS INTEGER) AS year FROM ({L_SQL}) l",
    "id_span_check": _spans(T_SQL),
    "id_gaps": _gaps(T_SQL),
    "id_check_with_gaps": _gap_totals(T_SQL),
    "id_gaps_dense": f"""WITH o AS (SELECT 'ORDERS' AS symbol, agg_trade_id FROM ({O_SQL}) x),
s AS (SELECT symbol, count(*) AS count, min(agg_trade_id) AS start_id, max(agg_trade_id) AS end_id,
        max(agg_trade_id) - min(agg_trade_id) + 1 - count(*) AS gap_count, '' AS note FROM o GROUP BY symbol),
g AS (SELECT symbol, id, lead(id) OVER (PARTITION BY symbol ORDER BY id) AS next_id
      FROM (SELECT DISTINCT symbol, agg_trade_id AS id FROM o) u)
SELECT s.*, coalesce(x.gr, 0) AS gap_ranges, coalesce(x.mi, 0) AS missing_ids
FROM s LEFT JOIN (SELECT symbol, count(*) AS gr, CAST(sum(next_id - id - 1) AS BIGINT) AS mi
                  FROM g WHERE next_id - id > 1 GROUP BY symbol) x ON s.symbol = x.symbol""",
    "cross_year_continuity": _continuity(L_DEDUP_SQL),
    "bar_expected_counts": _expected(tbars()),
    "missing_bars": f"""WITH b AS ({tbars(('1m', '3m', '5m'))}),
g AS (SELECT symbol, interval, year(time) AS y, CAST(max(time) AS DATE) AS last
      FROM b GROUP BY symbol, interval, year(time)),
grid AS (SELECT symbol, interval, unnest(generate_series(make_timestamp(y, 1, 1, 0, 0, 0),
           CAST(last AS TIMESTAMP) + INTERVAL 1 DAY - INTERVAL 1 SECOND, to_seconds({_SECS_CASE}))) AS time
         FROM g)
SELECT symbol, interval, time FROM grid EXCEPT SELECT symbol, interval, time FROM b""",
    "trades_per_minute": f"""WITH c AS (SELECT symbol, {_bucket(60)} AS t, count(*) AS n FROM ({T_SQL}) x GROUP BY symbol, t),
r AS (SELECT symbol, min(t) AS lo, max(t) AS hi FROM c GROUP BY symbol),
grid AS (SELECT symbol, unnest(generate_series(lo, hi, INTERVAL 1 MINUTE)) AS t FROM r)
SELECT grid.symbol, grid.t AS time, coalesce(c.n, 0) AS n
FROM grid LEFT JOIN c ON grid.symbol = c.symbol AND grid.t = c.t""",
    "trades_per_minute_window": f"""WITH x AS (SELECT * FROM ({T_SQL}) t
  WHERE time >= TIMESTAMP '{_TPM_WINDOW[0]}' AND time < TIMESTAMP '{_TPM_WINDOW[1]}'),
c AS (SELECT symbol, {_bucket(60)} AS t, count(*) AS n FROM x GROUP BY symbol, t),
grid AS (SELECT symbol, unnest(generate_series(TIMESTAMP '{_TPM_WINDOW[0]}',
           TIMESTAMP '{_TPM_WINDOW[1]}' - INTERVAL 1 MINUTE, INTERVAL 1 MINUTE)) AS t
         FROM (SELECT DISTINCT symbol FROM c) s)
SELECT grid.symbol, grid.t AS time, coalesce(c.n, 0) AS n
FROM grid LEFT JOIN c ON grid.symbol = c.symbol AND grid.t = c.t""",
    "check_report": _report(L_DEDUP_SQL),
    "run_counters": f"""SELECT count(*) FILTER (WHERE kind = 'trades') AS trade_checks,
  count(*) FILTER (WHERE kind = 'trades' AND (gap_count <> 0 OR coalesce(note, '') <> '')) AS trade_bad,
  count(*) FILTER (WHERE kind = 'bars') AS bar_checks,
  count(*) FILTER (WHERE kind = 'bars' AND (diff <> 0 OR coalesce(note, '') <> '')
                   AND NOT starts_with(coalesce(note, ''), 'sparse')) AS bar_bad,
  count(*) FILTER (WHERE kind = 'continuity') AS errors
FROM ({_report(L_DEDUP_SQL)}) r""",
    "compare_summary": _SUMMARY,
    "compare_detail_topk": f"""{_detail()}
SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY symbol, interval
                ORDER BY coalesce(sum_abs_diff, 0.0) DESC, time ASC) AS INTEGER) AS rank FROM dd) z
WHERE rank <= 50""",
    "compare_totals": f"""{_detail()}
SELECT symbol, interval, count(*) AS total_rows, count(*) FILTER (WHERE sum_abs_diff IS NULL) AS missing_rows,
  count(*) FILTER (WHERE coalesce(sum_abs_diff, 0.0) > 0) AS diff_rows,
  round(coalesce(sum(0.0 + coalesce(abs(open_diff), 0.0) + coalesce(abs(high_diff), 0.0)
        + coalesce(abs(low_diff), 0.0) + coalesce(abs(close_diff), 0.0)), 0.0), 6) AS total_sum_abs,
  count(*) FILTER (WHERE sum_abs_diff IS NULL) + count(*) FILTER (WHERE coalesce(sum_abs_diff, 0.0) > 0)
    AS mismatched
FROM dd GROUP BY symbol, interval""",
    "sma_7_25_99": f"""SELECT symbol, interval, time, close, {_sma_cols()}
FROM ({tbars(('1h',))}) b {_SMA_WINDOWS}""",
    "last_60_bars": f"""SELECT symbol, interval, time, open, high, low, close FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol, interval ORDER BY time DESC) AS rn
  FROM ({tbars(('1h',))}) b) x WHERE rn <= 60""",
    "recent_bars": f"""WITH w AS (SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY symbol, interval ORDER BY time DESC) AS rn
    FROM ({tbars(('1h',))}) b WHERE time <= TIMESTAMP '2024-01-15 12:00:00') x WHERE rn <= 158),
s AS (SELECT symbol, interval, time, open, high, low, close, rn, {_sma_cols()} FROM w {_SMA_WINDOWS})
SELECT symbol, interval, time, open, high, low, close, SMA7, SMA25, SMA99 FROM s WHERE rn <= 60""",
    "symbol_split": f"""WITH s2 AS (
  SELECT CASE WHEN c_custkey < 3 THEN (['BTC', 'ETHFDUSD', 'USDT'])[c_custkey + 1]
              ELSE upper(regexp_replace(c_name, '[^A-Za-z0-9]', '', 'g'))
                   || (['USDT', 'FDUSD', 'BTC', 'XYZ', ''])[c_custkey % 5 + 1] END AS symbol
  FROM customer),
q AS (SELECT symbol, regexp_extract(symbol, '{_QUOTE_RE}', 2) AS quote FROM s2)
SELECT symbol, CASE WHEN quote = '' THEN symbol ELSE regexp_extract(symbol, '{_QUOTE_RE}', 1) END AS base, quote
FROM q""",
    "archive_names": f"""WITH s AS ({_NATION_SYMBOLS}),
om AS (SELECT DISTINCT c.c_nationkey AS n_nationkey, CAST(date_trunc('month', o.o_orderdate) AS DATE) AS m
       FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
g AS (SELECT s.symbol, om.m, last_day(om.m) AS ld FROM om JOIN s ON om.n_nationkey = s.n_nationkey),
h AS (SELECT symbol, m, ld,
        printf('%s-%s-%04d-%02d.zip', symbol, 'aggTrades', year(m), month(m)) AS monthly,
        printf('%s-%s-%04d-%02d-%02d.zip', symbol, 'aggTrades', year(ld), month(ld), day(ld)) AS daily FROM g)
SELECT symbol, monthly, daily,
  printf('%s/data/%s/%s/%s/%s/%s', 'https://archives.invalid', 'futures/um', 'monthly', 'aggTrades', symbol, monthly)
    AS monthly_url,
  printf('%s/data/%s/%s/%s/%s/%s', 'https://archives.invalid', 'spot', 'daily', 'aggTrades', symbol, daily)
    AS daily_url,
  symbol AS parsed_symbol, CAST(year(m) AS INTEGER) AS parsed_year, CAST(month(m) AS INTEGER) AS parsed_month,
  false AS monthly_is_daily, CAST(day(ld) AS INTEGER) AS parsed_day, ld AS daily_date,
  CAST(year(ld) AS INTEGER) AS stored_year
FROM h""",
    "symbol_union": """SELECT DISTINCT symbol FROM (SELECT event_type AS symbol FROM events
  UNION SELECT l_returnflag FROM lineitem UNION SELECT o_orderstatus FROM orders) s
WHERE NOT starts_with(symbol, '_')""",
})


# ---------------------------------------------------------------- normalisation, store, planning


_T_US = f"SELECT *, epoch_us(time) AS ts FROM ({T_SQL}) t0"

_RAW_METRICS = f"""SELECT symbol || '-metrics-' || strftime(time, '%Y-%m-%d') AS archive,
  CASE WHEN agg_trade_id % 997 = 0 THEN '2025-13-01 00:00:00' ELSE strftime(time, '%Y-%m-%d %H:%M:%S') END
    AS create_time, symbol,
  CASE WHEN agg_trade_id % 7 = 0 THEN '' WHEN agg_trade_id % 11 = 0 THEN 'x' ELSE CAST(price AS VARCHAR) END AS m1,
  CASE WHEN agg_trade_id % 7 = 0 THEN '' WHEN agg_trade_id % 11 = 0 THEN 'x' ELSE CAST(quantity AS VARCHAR) END AS m2,
  CASE WHEN agg_trade_id % 7 = 0 THEN '' WHEN agg_trade_id % 11 = 0 THEN 'x' ELSE CAST(agg_trade_id AS VARCHAR) END
    AS m3,
  CASE WHEN agg_trade_id % 7 = 0 THEN '' WHEN agg_trade_id % 11 = 0 THEN 'x' ELSE CAST(price / 4 AS VARCHAR) END
    AS m4,
  CASE WHEN agg_trade_id % 7 = 0 THEN '' WHEN agg_trade_id % 11 = 0 THEN 'x' ELSE CAST(quantity + 0.5 AS VARCHAR) END
    AS m5,
  '0.25' AS m6
FROM ({T_SQL}) t"""

_METRICS_PARSED = f"""SELECT archive, try_strptime(create_time, '%Y-%m-%d %H:%M:%S') AS time, symbol,
  TRY_CAST(m1 AS DOUBLE) AS sum_open_interest, TRY_CAST(m2 AS DOUBLE) AS sum_open_interest_value,
  TRY_CAST(m3 AS DOUBLE) AS count_toptrader_long_short_ratio, TRY_CAST(m4 AS DOUBLE) AS sum_toptrader_long_short_ratio,
  TRY_CAST(m5 AS DOUBLE) AS count_long_short_ratio, TRY_CAST(m6 AS DOUBLE) AS sum_taker_long_short_vol_ratio
FROM ({_RAW_METRICS}) r"""

_L_YEAR = f"SELECT *, CAST(year(time) AS INTEGER) AS year FROM ({L_FULL_SQL}) l0"

_T_DAILY_BARS = kline_sql(L_DEDUP_SQL, "1d")

_STARTS = f"""SELECT symbol, CAST(CAST(max(time) AS DATE) + 1 AS DATE) AS start_date FROM ({T_SQL}) t GROUP BY symbol"""

_CUTOFF = "CAST(least(DATE '2024-04-05', DATE '2024-06-01') + 1 AS DATE)"


def _plan_sql() -> str:
    url = ("printf('%s/data/%s/%s/%s/%s/%s', 'https://archives.invalid', 'futures/um', "
           "CASE WHEN daily THEN 'daily' ELSE 'monthly' END, data_type, symbol, file_name)")
    return f"""WITH s AS ({_STARTS}),
ms AS (SELECT symbol, CAST(unnest(generate_series(CAST(date_trunc('month', start_date) AS DATE), {_CUTOFF},
               INTERVAL 1 MONTH)) AS DATE) AS date FROM s),
mo AS (SELECT ms.symbol, v.dt AS data_type, ms.date FROM ms, (VALUES ('aggTrades'), ('fundingRate')) v(dt)
       WHERE CAST(ms.date + INTERVAL 1 MONTH AS DATE) <= {_CUTOFF}),
ds AS (SELECT symbol, CAST(unnest(generate_series(start_date, CAST({_CUTOFF} - 1 AS DATE), INTERVAL 1 DAY)) AS DATE)
         AS date FROM s),
da AS (SELECT ds.symbol, v.dt AS data_type, ds.date FROM ds, (VALUES ('aggTrades'), ('metrics')) v(dt)),
da2 AS (SELECT * FROM da WHERE NOT (data_type = 'aggTrades' AND EXISTS (
          SELECT 1 FROM mo WHERE mo.symbol = da.symbol AND mo.data_type = 'aggTrades'
            AND mo.date = CAST(date_trunc('month', da.date) AS DATE)))),
p AS (SELECT symbol, data_type, date, false AS daily,
        printf('%s-%s-%04d-%02d.zip', symbol, data_type, year(date), month(date)) AS file_name FROM mo
      UNION ALL
      SELECT symbol, data_type, date, true AS daily,
        printf('%s-%s-%04d-%02d-%02d.zip', symbol, data_type, year(date), month(date), day(date)) FROM da2),
present AS (SELECT DISTINCT printf('%s-%s-%04d-%02d.zip', symbol, 'aggTrades', 2024, 1) AS file_name FROM ({T_SQL}) t)
SELECT symbol, data_type, date, daily, file_name, {url} AS url FROM p
WHERE file_name NOT IN (SELECT file_name FROM present)"""


def _select_sql() -> str:
    return f"""WITH t AS ({T_SQL}),
files AS (SELECT DISTINCT printf('%s-%s-%04d-%02d-%02d.zip', symbol, 'aggTrades', year(time), month(time), day(time))
            AS file_name, symbol, CAST(time AS DATE) AS d, true AS daily FROM t
          UNION ALL SELECT DISTINCT printf('%s-%s-%04d-%02d.zip', symbol, 'aggTrades', 2024, 1), symbol,
            DATE '2024-01-01', false FROM t WHERE length(symbol) <= 5
          UNION ALL SELECT DISTINCT printf('%s-%s-%04d-%02d.zip', symbol, 'aggTrades', 2023, 12), symbol,
            DATE '2023-12-01', false FROM t)
SELECT file_name, CAST(year(d) AS INTEGER) AS archive_year, daily, d AS archive_date FROM files f
WHERE (daily AND d >= DATE '2024-01-05' AND NOT EXISTS (
         SELECT 1 FROM files m WHERE NOT m.daily AND m.symbol = f.symbol
           AND m.d = CAST(date_trunc('month', f.d) AS DATE)))
   OR (NOT daily AND last_day(d) >= DATE '2024-01-05')"""


def _stale_sql() -> str:
    bars = kline_all_sql(L_DEDUP_SQL)
    ivs = ", ".join(f"'{i}'" for i in BASE_INTERVALS)
    return f"""WITH src AS (SELECT symbol, CAST(year(time) AS INTEGER) AS year, CAST(max(time) AS DATE) AS source_last_date
             FROM ({L_DEDUP_SQL}) l GROUP BY symbol, year(time)),
b AS (SELECT symbol, interval, time FROM ({bars}) x
      WHERE NOT ((symbol = 'A' AND year(time) = 1999 AND interval = '4h')
                 OR (symbol = 'N' AND time >= TIMESTAMP '2001-10-01 00:00:00'))),
bc AS (SELECT symbol, interval, CAST(year(time) AS INTEGER) AS year, CAST(max(time) AS DATE) AS bar_last_date
       FROM b GROUP BY symbol, interval, year(time)),
w AS (SELECT src.*, unnest([{ivs}]) AS interval FROM src),
j AS (SELECT w.*, bc.bar_last_date, (month(bc.bar_last_date) = 12 AND day(bc.bar_last_date) = 31) AS bar_complete
      FROM w LEFT JOIN bc ON w.symbol = bc.symbol AND w.interval = bc.interval AND w.year = bc.year),
g AS (SELECT symbol, year, first(source_last_date) AS source_last_date,
        count(*) FILTER (WHERE bar_last_date IS NULL) AS missing_intervals,
        count(*) FILTER (WHERE NOT coalesce(bar_complete, false) AND bar_last_date < source_last_date)
          AS older_intervals
      FROM j GROUP BY symbol, year)
SELECT *, missing_intervals > 0 OR older_intervals > 0 AS stale FROM g"""


ORACLE.update({
    "epoch_normalize": f"""WITH r AS (SELECT symbol, agg_trade_id,
    CASE WHEN agg_trade_id % 2 = 0 THEN ts // 1000 ELSE ts END AS tt FROM ({_T_US}) t),
u AS (SELECT symbol, agg_trade_id, CASE WHEN tt > 1000000000000000 THEN tt ELSE tt * 1000 END AS us FROM r)
SELECT symbol, agg_trade_id, make_timestamp(us) AS time, us AS ts, strftime(make_timestamp(us), '%Y-%m-%d') AS date,
  CAST(year(make_timestamp(us)) AS INTEGER) AS year FROM u""",
    "metrics_repair": f"""WITH p AS ({_METRICS_PARSED})
SELECT * EXCLUDE (archive) FROM p WHERE archive NOT IN (SELECT archive FROM p WHERE time IS NULL)""",
    "metrics_quarantine": f"""SELECT archive, count(*) AS bad_rows, 'parse error' AS error
FROM ({_METRICS_PARSED}) p WHERE time IS NULL GROUP BY archive""",
    "schema_repair": """SELECT o_orderstatus AS symbol, o_orderkey AS agg_trade_id,
  make_timestamp(epoch_ms(o_orderdate) * 1000) AS time, o_totalprice AS price, CAST(1.0 AS DOUBLE) AS quantity,
  o_orderkey AS first_trade_id, o_orderkey AS last_trade_id, (o_orderkey % 2 = 1) AS is_buyer_maker,
  false AS is_best_match, epoch_ms(o_orderdate) * 1000 AS ts FROM orders""",
    "funding_normalize": """SELECT o_orderstatus AS symbol, make_timestamp((epoch_ms(o_orderdate) + o_orderkey) * 1000) AS time,
  CAST(8 AS INTEGER) AS funding_interval_hours, o_totalprice / 1e6 AS last_funding_rate FROM orders""",
    "bvol_normalize": """SELECT make_timestamp((epoch_ms(o_orderdate) + o_orderkey) * 1000) AS time,
  o_orderstatus || 'BVOLUSDT' AS symbol, o_orderstatus AS base_asset, 'USDT' AS quote_asset,
  o_totalprice / 1000 AS index_value FROM orders""",
    "time_filters": f"""WITH t AS (SELECT symbol, agg_trade_id, time FROM ({T_SQL}) x)
SELECT *, 'between' AS label FROM t WHERE time BETWEEN TIMESTAMP '2024-01-03 00:00:00' AND TIMESTAMP '2024-01-05 12:30:00'
UNION ALL SELECT *, 'at_or_before' FROM t WHERE time <= TIMESTAMP '2024-01-02 06:00:00'
UNION ALL SELECT *, 'half_open' FROM t WHERE time >= TIMESTAMP '2024-01-07 00:00:00' AND time < TIMESTAMP '2024-01-08 00:00:00'
UNION ALL SELECT *, 'days' FROM t WHERE time BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-11 23:59:59.999'
UNION ALL SELECT *, 'year' FROM t WHERE year(time) = 2024 AND month(time) = 1 AND day(time) = 20""",
    "write_read_roundtrip": f"""SELECT * FROM ({_L_YEAR}) l WHERE year IN (1996, 1997)
  AND time BETWEEN TIMESTAMP '1996-06-01 00:00:00' AND TIMESTAMP '1997-03-31 00:00:00'""",
    "upsert_year": f"""SELECT * EXCLUDE (seq, rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol, year, agg_trade_id
                               ORDER BY seq DESC, time DESC, _p DESC, _s DESC) AS rn
  FROM (SELECT *, CASE WHEN _p % 2 = 1 THEN 1 ELSE 0 END AS seq FROM ({_L_YEAR}) l) u) v WHERE rn = 1""",
    "upsert_increment": f"""WITH l AS (SELECT * REPLACE (nullif(symbol, 'R') AS symbol) FROM ({_L_YEAR}) x),
u AS (SELECT *, 0 AS seq FROM l WHERE _p % 2 = 0
      UNION ALL SELECT * REPLACE (price * 2 AS price), 1 FROM l
      WHERE _p % 3 = 0 AND ((symbol IS NULL AND year = 1993) OR (symbol = 'N' AND year = 1998)))
SELECT * EXCLUDE (seq, rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol, year, agg_trade_id
                               ORDER BY seq DESC, time DESC, _p DESC, _s DESC) AS rn FROM u) v WHERE rn = 1""",
    "replace_month": f"""WITH l AS ({_L_YEAR}),
nw AS (SELECT * FROM l WHERE _p % 2 = 1 AND year(time) = 1998 AND month(time) = 3)
SELECT * FROM l WHERE _p % 2 = 0
  AND NOT (year(time) = 1998 AND month(time) = 3 AND symbol IN (SELECT DISTINCT symbol FROM nw))
UNION ALL SELECT * FROM nw""",
    "bars_dedup_keep_first": f"""SELECT symbol, '1d' AS interval, time, open, high, low,
  CASE WHEN day(time) % 3 = 0 THEN close * 2 ELSE close END AS close, qty, qty_usd, buyer_qty, seller_qty,
  avg_price, buyer_avg_price, seller_avg_price
FROM ({_T_DAILY_BARS}) b WHERE time BETWEEN TIMESTAMP '1996-01-01 00:00:00' AND TIMESTAMP '1998-12-31 23:59:59.999'""",
    "archive_plan": _plan_sql(),
    "archive_select": _select_sql(),
    "stale_partitions": _stale_sql(),
    "refresh_symbol": kline_sql(T_SQL, "1h"),
})


# ---------------------------------------------------------------- sources and streams

ORACLE.update({
    "zip_ingest": f"""SELECT symbol, agg_trade_id,
  CASE WHEN day(time) < 15 THEN make_timestamp((ts // 1000) * 1000) ELSE time END AS time,
  price, quantity, agg_trade_id AS first_trade_id, agg_trade_id AS last_trade_id, is_buyer_maker,
  false AS is_best_match, CASE WHEN day(time) < 15 THEN (ts // 1000) * 1000 ELSE ts END AS ts
FROM ({_T_US}) t""",
    "zip_quarantine": f"""SELECT symbol || '-aggTrades-2024-02-01.zip' AS archive, CAST(1 AS BIGINT) AS bad_rows,
  'empty' AS error_kind FROM (SELECT DISTINCT symbol FROM ({T_SQL}) t) s
UNION ALL SELECT symbol || '-aggTrades-2024-02-02.zip', CAST(1 AS BIGINT), 'unreadable'
FROM (SELECT DISTINCT symbol FROM ({T_SQL}) t) s""",
    "payload_bars": f"SELECT symbol, interval, time, open, high, low, close, qty, qty_usd FROM ({tbars(('1h',))}) b",
    "symbol_list": "SELECT DISTINCT event_type AS symbol FROM events",
    "stream_bars": kline_sql(T_SQL, "1h"),
    "stream_dedup": f"SELECT DISTINCT symbol, agg_trade_id FROM ({L_SQL}) l",
    "stream_upsert": ORACLE["upsert_year"],
})


# ---------------------------------------------------------------- file names, interval support

ORACLE.update({
    "bar_file_names": f"""WITH c AS (SELECT symbol, interval, CAST(year(time) AS INTEGER) AS year,
    CAST(max(time) AS DATE) AS last FROM ({tbars()}) b GROUP BY symbol, interval, year(time)),
n AS (SELECT *, month(last) = 12 AND day(last) = 31 AS complete FROM c)
SELECT symbol, interval, year,
  printf('%s_kline_%s_%s.parquet', symbol, interval,
         CASE WHEN complete THEN CAST(year AS VARCHAR) ELSE strftime(last, '%Y-%m-%d') END) AS file_name,
  interval AS parsed_interval, year AS parsed_year,
  CASE WHEN complete THEN NULL ELSE strftime(last, '%m-%d') END AS parsed_md, year AS stored_year
FROM n""",
    "supported_bars": f"""SELECT symbol, market, interval, count(*) AS bars, round(sum(qty), 6) AS qty
FROM (SELECT *, CASE WHEN length(symbol) <= 5 THEN 'future' ELSE 'spot' END AS market
      FROM ({tbars(('1s', '1m'))}) b) x
WHERE NOT (market = 'future' AND interval = '1s')
GROUP BY symbol, market, interval""",
})

ORACLE["ingest_pipeline"] = f"""SELECT symbol, CAST(year(time) AS INTEGER) AS year, agg_trade_id, time, price, quantity,
  agg_trade_id AS first_trade_id, agg_trade_id AS last_trade_id, is_buyer_maker, false AS is_best_match, ts
FROM ({_T_US}) t WHERE time >= TIMESTAMP '2024-01-03 00:00:00'"""

ORACLE["replace_month_folders"] = ORACLE["replace_month"]

ORACLE["id_span_footers"] = _spans(T_SQL)

ORACLE["coverage_footers"] = ORACLE["coverage_by_year"]
