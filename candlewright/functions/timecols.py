"""Time column expressions (all JVM-side, codegen friendly).

Times are ``TIMESTAMP_NTZ`` holding UTC. ``timestamp_add`` from the epoch
literal is used instead of ``timestamp_micros`` because the latter yields a
session-zone ``TIMESTAMP`` whose cast to NTZ shifts with the zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from candlewright.schemas import EPOCH_US_THRESHOLD, INTERVAL_SECONDS

# The accepted datetime formats, tried in this order (first match wins)
DATETIME_FORMATS = (
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd HH:mm",
    "yyyy-MM-dd",
)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def epoch_ntz() -> Column:
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")


def epoch_to_micros(epoch) -> Column:
    """Values above 1e15 are microseconds, others milliseconds (x1000)."""
    e = _c(epoch)
    return F.when(e > F.lit(EPOCH_US_THRESHOLD), e).otherwise(e * F.lit(1000))


def micros_to_ntz(us) -> Column:
    """Epoch microseconds -> TIMESTAMP_NTZ."""
    return F.timestamp_add("MICROSECOND", _c(us), epoch_ntz())


def millis_to_ntz(ms) -> Column:
    return F.timestamp_add("MILLISECOND", _c(ms), epoch_ntz())


def ntz_to_micros(ts) -> Column:
    # the session zone is pinned to UTC, so the NTZ -> TIMESTAMP cast keeps the wall time
    return F.unix_micros(_c(ts).cast("timestamp"))


def ntz_to_millis(ts) -> Column:
    return F.unix_millis(_c(ts).cast("timestamp"))


def interval_seconds(interval: str) -> int:
    try:
        return INTERVAL_SECONDS[interval]
    except KeyError:
        raise ValueError(f"unknown interval {interval!r}; known: {sorted(INTERVAL_SECONDS)}")


def floor_time(ts, width_us) -> Column:
    """Left edge of the epoch-aligned bucket of ``width_us`` microseconds.

    ``width_us`` may be a column, so one expression serves many intervals
    (used after exploding rows over an interval list).
    """
    us = ntz_to_micros(ts)
    w = _c(width_us) if not isinstance(width_us, int) else F.lit(width_us)
    return micros_to_ntz(us - F.pmod(us, w))


def order_key(ts, agg_trade_id) -> Column:
    """Packed ``(time, agg_trade_id)`` sort key as ``decimal(38,0)``.

    Ranks exactly like ``struct(time, id)`` for ids in [0, 1e19), but keeps
    ``min_by``/``max_by`` in a HashAggregate (a struct key forces a
    SortAggregate with two sorts).
    """
    us = ntz_to_micros(ts).cast("decimal(18,0)")
    return (us * F.expr("CAST(10000000000000000000 AS DECIMAL(20,0))")
            + _c(agg_trade_id).cast("decimal(20,0)")).cast("decimal(38,0)")


def to_date_string(ts) -> Column:
    """P20: timestamp -> 'yyyy-MM-dd'."""
    return F.date_format(_c(ts), "yyyy-MM-dd")


def coverage_suffix(max_ts, year=None) -> Column:
    """P19: 'YYYY' if the last date is Dec 31 (of ``year`` when given), else 'YYYY-MM-DD'."""
    m = _c(max_ts)
    complete = F.date_format(m, "MM-dd") == F.lit("12-31")
    if year is not None:
        complete = complete & (F.year(m) == _c(year))
    return F.when(complete, F.year(m).cast("string")).otherwise(to_date_string(m))


def parse_datetime(s) -> Column:
    """First of five formats that parses; null when none does."""
    return F.coalesce(*[F.try_to_timestamp(_c(s), F.lit(f)).cast("timestamp_ntz")
                        for f in DATETIME_FORMATS])


def day_bounds(start_date, end_date):
    """Inclusive date range -> [start 00:00:00.000, end 23:59:59.999] as NTZ."""
    s = F.to_date(_c(start_date)).cast("timestamp_ntz")
    e = F.timestamp_add("MILLISECOND", F.lit(86_399_999), F.to_date(_c(end_date)).cast("timestamp_ntz"))
    return s, e


def month_starts(start, end) -> Column:
    """G1: first days of every month from start's month to end, inclusive (array)."""
    s = F.trunc(_c(start), "MM")
    e = _c(end)
    return F.when(s <= e, F.sequence(s, e, F.expr("INTERVAL 1 MONTH"))).otherwise(F.array())


def days_between(start, end) -> Column:
    """Every day from start to end inclusive; empty when start > end."""
    s, e = _c(start), _c(end)
    return F.when(s <= e, F.sequence(s, e, F.expr("INTERVAL 1 DAY"))).otherwise(F.array())


def month_complete(month_day, cutoff) -> Column:
    """The month of ``month_day`` is complete when its next month starts on or before cutoff."""
    return F.add_months(F.trunc(_c(month_day), "MM"), 1) <= _c(cutoff)


def cutoff_date(end_date=None, today=None) -> Column:
    """``min(end, today) + 1 day`` when end is given, else today."""
    t = F.current_date() if today is None else F.to_date(_c(today) if not isinstance(today, str) else F.lit(today))
    if end_date is None:
        return t
    e = F.to_date(F.lit(end_date)) if isinstance(end_date, str) else F.to_date(_c(end_date))
    return F.date_add(F.least(e, t), 1)


def bar_grid(start, end, interval: str) -> Column:
    """Every bar start from ``start`` to ``end`` (inclusive) for ``interval``."""
    secs = interval_seconds(interval)
    return F.sequence(_c(start), _c(end), F.expr(f"INTERVAL {secs} SECONDS"))
