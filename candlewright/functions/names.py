"""Name parsing and building as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from candlewright.schemas import INTERVAL_SECONDS, QUOTE_ASSETS

# the archive host is a deployment setting; pass the real one to archive_url
ARCHIVE_BASE_URL = "https://archives.invalid"

# File-name layouts that must equal the reference's
#   archives      SYMBOL-type-YYYY-MM.zip and SYMBOL-type-YYYY-MM-DD.zip
#   stored years  SYMBOL_type_YYYY.parquet and SYMBOL_type_YYYY-MM-DD.parquet
#   bar files     SYMBOL_kline_INTERVAL_YYYY.parquet and SYMBOL_kline_INTERVAL_YYYY-MM-DD.parquet
ARCHIVE_RE = r"^(.+)-([A-Za-z]+)-(\d{4})-(\d{2})(?:-(\d{2}))?\.zip$"
STORED_RE = r"_(\d{4})(?:-(\d{2})-(\d{2}))?\.parquet$"
KLINE_RE = "_kline_(" + "|".join(INTERVAL_SECONDS) + r")_(\d{4})(?:-(\d\d-\d\d))?[.]parquet$"

_QUOTE_RE = "^(.+)(" + "|".join(QUOTE_ASSETS) + ")$"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def split_symbol(symbol) -> tuple[Column, Column]:
    """(base, quote) by known quote suffix; no match -> (symbol, '').

    The base must be non-empty, so a bare quote asset is its own base.
    No listed quote is a suffix of another, so the match is unique.
    """
    s = _c(symbol)
    quote = F.regexp_extract(s, _QUOTE_RE, 2)
    base = F.when(quote == "", s).otherwise(F.regexp_extract(s, _QUOTE_RE, 1))
    return base, quote


def parse_archive_name(name) -> dict[str, Column]:
    """``SYMBOL-type-YYYY-MM[-DD].zip`` -> symbol, data_type, year, month, day, daily."""
    n = _c(name)
    day = F.regexp_extract(n, ARCHIVE_RE, 5)
    ok = n.rlike(ARCHIVE_RE)
    return {
        "symbol": F.when(ok, F.regexp_extract(n, ARCHIVE_RE, 1)),
        "data_type": F.when(ok, F.regexp_extract(n, ARCHIVE_RE, 2)),
        "year": F.when(ok, F.regexp_extract(n, ARCHIVE_RE, 3).cast("int")),
        "month": F.when(ok, F.regexp_extract(n, ARCHIVE_RE, 4).cast("int")),
        "day": F.when(ok & (day != ""), day.cast("int")),
        "daily": F.when(ok, day != ""),
    }


def archive_date(name) -> Column:
    """Date of a daily archive, first day of the month for a monthly one."""
    p = parse_archive_name(name)
    return F.make_date(p["year"], p["month"], F.coalesce(p["day"], F.lit(1)))


def stored_year(name) -> Column:
    """Year of ``..._YYYY.parquet`` or ``..._YYYY-MM-DD.parquet``."""
    n = _c(name)
    return F.when(n.rlike(STORED_RE), F.regexp_extract(n, STORED_RE, 1).cast("int"))


def parse_kline_name(name) -> dict[str, Column]:
    """Bar file name -> interval, year, optional 'MM-DD'."""
    n = _c(name)
    ok = n.rlike(KLINE_RE)
    md = F.regexp_extract(n, KLINE_RE, 3)
    return {
        "interval": F.when(ok, F.regexp_extract(n, KLINE_RE, 1)),
        "year": F.when(ok, F.regexp_extract(n, KLINE_RE, 2).cast("int")),
        "md": F.when(ok & (md != ""), md),
    }


def monthly_archive_name(symbol, data_type, year, month) -> Column:
    """``SYMBOL-type-YYYY-MM.zip``."""
    return F.format_string("%s-%s-%04d-%02d.zip", _c(symbol), _c(data_type), _c(year), _c(month))


def daily_archive_name(symbol, data_type, date) -> Column:
    """``SYMBOL-type-YYYY-MM-DD.zip``."""
    d = _c(date)
    return F.format_string("%s-%s-%04d-%02d-%02d.zip", _c(symbol), _c(data_type),
                           F.year(d), F.month(d), F.dayofmonth(d))


def market_path(market, market_sub) -> Column:
    m = _c(market)
    return (F.when(m == "future", F.concat(F.lit("futures/"), _c(market_sub)))
            .otherwise(m))


def store_folder(market: str, market_sub: str | None, data_type: str) -> str:
    """Folder of a stored data type below the store root. Fixed layout: ``spot/TYPE``,
    ``future/SUB/TYPE`` and, for options, ``future/option/TYPE``."""
    return {"spot": "spot", "option": "future/option"}.get(market, f"future/{market_sub or 'um'}") + "/" + data_type


def archive_url(symbol, data_type, market, market_sub, file_name, daily,
                base_url: str = ARCHIVE_BASE_URL) -> Column:
    """``{base}/data/{market path}/{daily|monthly}/{type}/{SYMBOL}/{file}``."""
    period = F.when(_c(daily), F.lit("daily")).otherwise(F.lit("monthly"))
    return F.format_string("%s/data/%s/%s/%s/%s/%s", F.lit(base_url),
                           market_path(market, market_sub), period, _c(data_type),
                           _c(symbol), _c(file_name))


def stored_file_name(symbol, data_type, suffix) -> Column:
    """``SYMBOL_type_SUFFIX.parquet`` (suffix from P19)."""
    return F.format_string("%s_%s_%s.parquet", _c(symbol), _c(data_type), _c(suffix))


def kline_file_name(symbol, interval, suffix) -> Column:
    return F.format_string("%s_kline_%s_%s.parquet", _c(symbol), _c(interval), _c(suffix))
