"""Rolling analytics over bars.

SMA is row-based: ``SMA_n`` at a bar is the mean of the last n closes of its
series, null until n bars exist. Series are ``(symbol, interval)``.

A series can be long (years of 1s bars of a hot symbol), so the window never
runs over a whole series in one task: :func:`series_index` numbers the rows
of each series from per-day counts (a tiny table) plus ``row_number`` inside
each day, the rows are cut into fixed-size blocks, and each block also gets
the last ``max(n) - 1`` rows of the block before it (a halo). The rolling
window then runs per block; results equal the single-window form exactly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlewright.functions.timecols import ntz_to_micros
from candlewright.schemas import SMA_PERIODS, SMA_WINDOW

SERIES = ("symbol", "interval")


DEFAULT_BLOCK_ROWS = 1 << 20


def series_index(bars: DataFrame, keys: Sequence[str] = SERIES, chunk_seconds: int = 86400) -> DataFrame:
    """Adds ``_idx``: 0-based position of each bar in its series by time.

    Per (series, day) counts are prefix-summed over days (one row per day),
    then ``row_number`` runs inside each day, so no task sorts more than one
    day of one series.
    """
    chunk = F.floor(ntz_to_micros("time") / F.lit(chunk_seconds * 1_000_000))
    b = bars.withColumn("_c", chunk)
    counts = b.groupBy(*keys, "_c").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(*keys, "_c", F.coalesce(F.sum("_n").over(
        Window.partitionBy(*keys).orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("_off"))
    rn = F.row_number().over(Window.partitionBy(*keys, "_c").orderBy("time"))
    return (b.join(offsets, [*keys, "_c"])
            .withColumn("_idx", F.col("_off") + rn - 1)
            .drop("_c", "_off"))


def sma(bars: DataFrame, periods: Sequence[int] = SMA_PERIODS, keys: Sequence[str] = SERIES,
        value: str = "close", decimals: int | None = None,
        block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Adds ``SMA{n}`` columns. ``decimals`` rounds the window sum before
    dividing (fixed-tick prices: removes summation-order noise)."""
    halo = max(periods) - 1
    if block_rows < halo:
        raise ValueError("block_rows must be at least max(periods) - 1")
    ix = series_index(bars, keys)
    blk = F.floor(F.col("_idx") / F.lit(block_rows))
    in_halo = (F.col("_idx") % F.lit(block_rows)) >= F.lit(block_rows - halo)
    copies = ix.select("*", F.explode(F.when(in_halo, F.array(blk, blk + 1)).otherwise(F.array(blk)))
                       .alias("_blk"))
    base = Window.partitionBy(*keys, "_blk").orderBy("_idx")
    cols = {}
    for n in periods:
        w = base.rowsBetween(-(n - 1), 0)
        s = F.sum(value).over(w)
        if decimals is not None:
            s = F.round(s, decimals)
        cols[f"SMA{n}"] = F.when(F.count(value).over(w) == n, s / F.lit(float(n)))
    return (copies.withColumns(cols).filter(F.col("_blk") == blk)
            .drop("_blk", "_idx"))


def last_n_bars(bars: DataFrame, end=None, n: int = SMA_WINDOW,
                keys: Sequence[str] = SERIES) -> DataFrame:
    """Per series the last ``n`` bars at or before ``end`` (F2).

    ``row_number <= n`` becomes a partial group limit before the shuffle.
    """
    df = bars
    if end is not None:
        df = df.filter(F.col("time") <= (F.expr(f"TIMESTAMP_NTZ'{end}'") if isinstance(end, str) else end))
    w = Window.partitionBy(*keys).orderBy(F.col("time").desc())
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def recent_bars(bars: DataFrame, end: str, n: int = SMA_WINDOW,
                periods: Sequence[int] = SMA_PERIODS, keys: Sequence[str] = SERIES,
                decimals: int | None = None) -> DataFrame:
    """S13 + W1 + T3: the last ``n`` bars at or before ``end`` with their SMAs.

    Takes exactly the ``n + max(periods) - 1`` newest bars per series at or
    before ``end`` (a top-k, planned with a partial limit before the shuffle),
    instead of "the two newest files", so an old ``end`` works and sparse
    series still get full SMA frames.
    """
    need = n + max(periods) - 1
    window = last_n_bars(bars, end, need, keys)
    # need rows per series: a plain rolling window, no block index
    order = Window.partitionBy(*keys).orderBy("time")
    with_sma = window
    for p in periods:
        frame = order.rowsBetween(-(p - 1), 0)
        total = F.sum("close").over(frame)
        total = F.round(total, decimals) if decimals is not None else total
        with_sma = with_sma.withColumn(f"SMA{p}", F.when(F.count("close").over(frame) == p, total / p))
    return last_n_bars(with_sma, None, n, keys).select(
        *keys, "time", "open", "high", "low", "close", *[f"SMA{p}" for p in periods])
