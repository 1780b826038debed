"""Canonical table schemas and domain enumerations.

All times are ``TIMESTAMP_NTZ`` holding UTC wall time.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's (column orders, enums,
# interval widths, quote assets, tolerances).
# ---------------------------------------------------------------------------

MARKETS = ("spot", "future", "option")
MARKET_SUBS = ("um", "cm")
DATA_TYPES = ("aggTrades", "trades", "metrics", "fundingRate", "BVOLIndex")
DATA_TYPE_ALIASES = {"metric": "metrics"}

# bar widths in seconds; 2h and 6h are only understood by the coverage check
INTERVAL_SECONDS = {
    "1s": 1,
    "1m": 60,
    "3m": 180,
    "5m": 300,
    "15m": 900,
    "30m": 1800,
    "1h": 3600,
    "2h": 7200,
    "4h": 14400,
    "6h": 21600,
    "8h": 28800,
    "12h": 43200,
    "1d": 86400,
}
BASE_INTERVALS = ("1m", "3m", "5m", "15m", "30m", "1h", "4h", "8h", "12h", "1d")

QUOTE_ASSETS = ("USDT", "USDC", "BUSD", "FDUSD", "TUSD", "DAI", "BTC", "ETH", "BNB")

REL_TOL_CLOSE = 1e-4
REL_TOL_QTY = 5e-2
WARN_TOL_CLOSE = 1e-3

SMA_PERIODS = (7, 25, 99)
SMA_WINDOW = 60

# epoch values above this are microseconds, at or below it milliseconds
EPOCH_US_THRESHOLD = 1_000_000_000_000_000

DEFAULT_START_DATE = "2020-01-01"

# dedup key per data type
DEDUP_KEY = {
    "aggTrades": "agg_trade_id",
    "trades": "agg_trade_id",
    "metrics": "time",
    "fundingRate": "time",
    "BVOLIndex": "time",
}

# archive granularity per data type: (monthly, daily)
ARCHIVE_GRANULARITY = {
    "aggTrades": (True, True),
    "trades": (True, True),
    "metrics": (False, True),
    "fundingRate": (True, False),
    "BVOLIndex": (False, True),
}

# (market, data type) pairs the ingest accepts
VALID_MARKET_TYPES = (
    ("spot", "aggTrades"),
    ("spot", "trades"),
    ("future", "aggTrades"),
    ("future", "trades"),
    ("future", "metrics"),
    ("future", "fundingRate"),
    ("option", "BVOLIndex"),
)

# ---------------------------------------------------------------------------
# Raw CSV layouts (headerless trades are positional)
# ---------------------------------------------------------------------------

RAW_SPOT_TRADES = T.StructType([
    T.StructField("agg_trade_id", T.LongType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("quantity", T.DoubleType()),
    T.StructField("first_trade_id", T.LongType()),
    T.StructField("last_trade_id", T.LongType()),
    T.StructField("transact_time", T.LongType()),
    T.StructField("is_buyer_maker", T.BooleanType()),
    T.StructField("is_best_match", T.BooleanType()),
])

RAW_FUTURES_TRADES = T.StructType(RAW_SPOT_TRADES.fields[:7])

RAW_METRICS_COLUMNS = (
    "create_time", "symbol", "sum_open_interest", "sum_open_interest_value",
    "count_toptrader_long_short_ratio", "sum_toptrader_long_short_ratio",
    "count_long_short_ratio", "sum_taker_long_short_vol_ratio",
)
METRIC_MEASURES = RAW_METRICS_COLUMNS[2:]

RAW_FUNDING_COLUMNS = ("calc_time", "funding_interval_hours", "last_funding_rate")
RAW_BVOL_COLUMNS = ("calc_time", "symbol", "base_asset", "quote_asset", "index_value")

# Per data type the raw fields a row must have, in column order, with their types; the other
# fields may be empty. "time" is a metrics timestamp. Doubles must be finite.
_REQUIRED_TRADE = (("agg_trade_id", "long"), ("price", "double"), ("quantity", "double"), ("first_trade_id", "long"),
                   ("last_trade_id", "long"), ("transact_time", "long"), ("is_buyer_maker", "boolean"))
REQUIRED_FIELDS = {
    "aggTrades": _REQUIRED_TRADE,
    "trades": _REQUIRED_TRADE,
    "metrics": (("create_time", "time"), ("symbol", "string")),
    "fundingRate": (("calc_time", "long"), ("funding_interval_hours", "int"), ("last_funding_rate", "double")),
    "BVOLIndex": (("calc_time", "long"), ("symbol", "string"), ("base_asset", "string"), ("quote_asset", "string"),
                  ("index_value", "double")),
}
# Fields that may be empty but must parse where they are not.
OPTIONAL_FIELDS = {"aggTrades": (("is_best_match", "boolean"),), "trades": (("is_best_match", "boolean"),)}

EXTERNAL_BAR_FIELDS = (
    "open_time", "open", "high", "low", "close", "volume", "close_time",
    "quote_volume", "trades", "taker_buy_base", "taker_buy_quote", "ignore",
)

# ---------------------------------------------------------------------------
# Canonical tables
# ---------------------------------------------------------------------------

AGG_TRADES = T.StructType([
    T.StructField("agg_trade_id", T.LongType()),
    T.StructField("time", T.TimestampNTZType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("quantity", T.DoubleType()),
    T.StructField("first_trade_id", T.LongType()),
    T.StructField("last_trade_id", T.LongType()),
    T.StructField("is_buyer_maker", T.BooleanType()),
    T.StructField("is_best_match", T.BooleanType()),
    T.StructField("ts", T.LongType()),
])
AGG_TRADE_COLUMNS = tuple(f.name for f in AGG_TRADES.fields)

METRICS = T.StructType(
    [T.StructField("time", T.TimestampNTZType()), T.StructField("symbol", T.StringType())]
    + [T.StructField(c, T.DoubleType()) for c in METRIC_MEASURES]
)

FUNDING_RATE = T.StructType([
    T.StructField("time", T.TimestampNTZType()),
    T.StructField("funding_interval_hours", T.IntegerType()),
    T.StructField("last_funding_rate", T.DoubleType()),
])

BVOL_INDEX = T.StructType([
    T.StructField("time", T.TimestampNTZType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("base_asset", T.StringType()),
    T.StructField("quote_asset", T.StringType()),
    T.StructField("index_value", T.DoubleType()),
])

KLINE_COLUMNS = (
    "symbol", "time", "open", "high", "low", "close", "qty", "qty_usd",
    "buyer_qty", "seller_qty", "avg_price", "buyer_avg_price", "seller_avg_price",
)

REFERENCE_KLINE_COLUMNS = ("time", "open", "high", "low", "close", "qty", "qty_usd")
