"""Data-quality checks.

Scale notes:

* The id-gap list never sorts a whole (symbol, year) in one task. Ids are cut
  into fixed-width id buckets and exchanged once by bucket; ``lead`` runs inside
  each bucket and the bucket seams are checked on a per-bucket min/max table
  that is tiny and comes from the same exchange.
* Missing bars are found as gaps in the slot-number sequence (like id gaps),
  so only missing slots are generated; the full expected grid (G7) is only
  built by :func:`expected_bar_grid`, in two levels (days, then slots).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewright.functions.names import store_folder
from candlewright.functions.timecols import floor_time, micros_to_ntz, ntz_to_micros
from candlewright.schemas import INTERVAL_SECONDS
from candlewright.sources.store import file_footers, footer_aggregate

DEFAULT_ID_BUCKET = 1 << 22


def interval_seconds_col(interval: Column) -> Column:
    """Width in seconds of an interval label column (null for unknown labels)."""
    m = F.create_map(*[x for k, v in INTERVAL_SECONDS.items() for x in (F.lit(k), F.lit(v))])
    return m[interval]


# ---------------------------------------------------------------- trade ids

def id_span_check(trades: DataFrame, keys: Sequence[str] = ("symbol", "year")) -> DataFrame:
    """Per dataset count, first/last id and ``gap_count``.

    ``gap_count = (last - first + 1) - count`` uses the raw count, as the
    reference does, so duplicates can hide gaps (the gap list does not).
    """
    df = trades if "year" in trades.columns or "year" not in keys else \
        trades.withColumn("year", F.year("time"))
    if "agg_trade_id" not in df.columns:
        # a dataset without ids is reported, not failed
        null = F.lit(None).cast("long")
        return df.select(*keys).distinct().select(
            *keys, F.lit(0).cast("long").alias("count"), null.alias("start_id"), null.alias("end_id"),
            F.lit(0).cast("long").alias("gap_count"), F.lit("dataset has no trade ids").alias("note"))
    g = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("count"),
        F.min("agg_trade_id").alias("start_id"),
        F.max("agg_trade_id").alias("end_id"))
    return g.withColumns({
        "gap_count": F.col("end_id") - F.col("start_id") + 1 - F.col("count"),
        "note": F.lit(""),
    })


def id_span_check_stored(spark, path: str, keys: Sequence[str] = ("symbol", "year")) -> DataFrame:
    """A7 on a stored table from Parquet footers only: no id is read
    (:func:`candlewright.sources.store.footer_aggregate`)."""
    spans = footer_aggregate(spark, path, keys, [
        F.count(F.lit(1)).alias("count"), F.min("agg_trade_id").alias("start_id"),
        F.max("agg_trade_id").alias("end_id")])
    return spans.withColumns({
        "gap_count": F.col("end_id") - F.col("start_id") + 1 - F.col("count"),
        "note": F.lit(""),
    })


def id_span_files(spark, path: str, keys: Sequence[str] = ("symbol", "year")) -> DataFrame:
    """A7 per stored file, from footers: file, row count, first and last id, ``gap_count``, and a
    note for a file that cannot be read, is empty, has no ids or no statistics (its numbers are
    then 0, as the reference reports them). ``keys`` come from the folder names."""
    f = file_footers(spark, path, "agg_trade_id")
    ok = F.col("state") == "ok"
    folder = {k: F.regexp_extract("path", f"/{k}=([^/]*)/", 1) for k in keys}
    parts = [F.when(v != "__HIVE_DEFAULT_PARTITION__", F.url_decode(F.replace(v, F.lit("+"), F.lit("%2B"))))
             .cast("int" if k in ("year", "month") else "string").alias(k) for k, v in folder.items()]
    span = F.col("high") - F.col("low") + 1 - F.col("rows")
    zero = F.lit(0).cast("long")
    return f.select(*parts, F.element_at(F.split("path", "/"), -1).alias("file_name"),
                    F.when(ok, F.col("rows")).otherwise(zero).alias("count"),
                    F.coalesce("low", zero).alias("start_id"), F.coalesce("high", zero).alias("end_id"),
                    F.when(ok, span).otherwise(zero).alias("gap_count"),
                    F.when(ok, F.lit("")).otherwise(F.col("state")).alias("note"))


def id_gaps(trades: DataFrame, keys: Sequence[str] = ("symbol", "year"),
            bucket: int = DEFAULT_ID_BUCKET) -> DataFrame:
    """One row per run of missing ids: ``prev_id``, ``next_id``, ``missing``.

    Exact for any span (no 2^31 limit) and any duplication.
    """
    ids = _bucketed_ids(trades, keys, bucket)
    return _gaps(ids, _bucket_bounds(ids, keys), keys)


def _bucketed_ids(trades: DataFrame, keys: Sequence[str], bucket: int) -> DataFrame:
    """Ids dealt by (keys, id bucket): the one full exchange of ids, which the window and
    the bounds below share."""
    df = trades if "year" in trades.columns or "year" not in keys else \
        trades.withColumn("year", F.year("time"))
    return (df.select(*keys, F.col("agg_trade_id").alias("id"))
            .withColumn("_b", F.floor(F.col("id") / F.lit(bucket)))
            .repartition(*keys, "_b"))


def _bucket_bounds(ids: DataFrame, keys: Sequence[str]) -> DataFrame:
    return ids.groupBy(*keys, "_b").agg(F.count(F.lit(1)).alias("_n"), F.min("id").alias("_lo"),
                                        F.max("id").alias("_hi"))


def _gaps(ids: DataFrame, bounds: DataFrame, keys: Sequence[str]) -> DataFrame:
    # copies of an id are a step of 0 and need no distinct
    inside = (ids.withColumn("next_id", F.lead("id").over(
                  Window.partitionBy(*keys, "_b").orderBy("id")))
              .filter(F.col("next_id") - F.col("id") > 1)
              .select(*keys, F.col("id").alias("prev_id"), "next_id"))
    seams = (bounds.withColumn("next_id", F.lead("_lo").over(
                 Window.partitionBy(*keys).orderBy("_b")))
             .filter(F.col("next_id") - F.col("_hi") > 1)
             .select(*keys, F.col("_hi").alias("prev_id"), "next_id"))
    return (inside.unionByName(seams)
            .withColumn("missing", F.col("next_id") - F.col("prev_id") - 1))


def id_check_with_gaps(trades: DataFrame, keys: Sequence[str] = ("symbol", "year"),
                       bucket: int = DEFAULT_ID_BUCKET) -> DataFrame:
    """A7 with the W2 totals: ``gap_ranges`` and ``missing_ids``.

    Spans come from the per-bucket bounds of the gap search, so the ids are
    exchanged once. The two keyed aggregates are merged by a union and one more
    group-by on the keys (one row per key on each side), not by a join. A
    dataset without ids gets the note of :func:`id_span_check`.
    """
    if "agg_trade_id" not in trades.columns:
        zero = F.lit(0).cast("long")
        return id_span_check(trades, keys).withColumns({"gap_ranges": zero, "missing_ids": zero}).select(
            *keys, "count", "start_id", "end_id", "gap_count", "gap_ranges", "missing_ids", "note")
    ids = _bucketed_ids(trades, keys, bucket)
    bounds = _bucket_bounds(ids, keys)
    spans = (bounds.groupBy(*keys).agg(F.sum("_n").alias("count"), F.min("_lo").alias("start_id"),
                                       F.max("_hi").alias("end_id"))
             .withColumn("gap_count", F.col("end_id") - F.col("start_id") + 1 - F.col("count")))
    totals = _gaps(ids, bounds, keys).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("gap_ranges"), F.sum("missing").alias("missing_ids"))
    span_cols = ["count", "start_id", "end_id", "gap_count"]
    both = (spans.select(*keys, *span_cols, F.lit(None).cast("long").alias("gap_ranges"),
                         F.lit(None).cast("long").alias("missing_ids"))
            .unionByName(totals.select(*keys, *[F.lit(None).cast(spans.schema[c].dataType).alias(c)
                                                for c in span_cols], "gap_ranges", "missing_ids")))
    return (both.groupBy(*keys).agg(*[F.max(c).alias(c) for c in span_cols],
                                    F.coalesce(F.max("gap_ranges"), F.lit(0)).cast("long").alias("gap_ranges"),
                                    F.coalesce(F.max("missing_ids"), F.lit(0)).cast("long").alias("missing_ids"))
            .withColumn("note", F.lit("")))


def cross_year_continuity(spans: DataFrame, keys: Sequence[str] = ("symbol",),
                          order: str = "year") -> DataFrame:
    """Each dataset's first id against the previous one's last id.

    Runs on the A7 output (one row per symbol-year), so the window is tiny.
    Pairs where either side carries a note are skipped.
    """
    w = Window.partitionBy(*keys).orderBy(order)
    return (spans.select(*keys, order, "start_id", "end_id", "note",
                         F.lag(order).over(w).alias("prev_" + order),
                         F.lag("end_id").over(w).alias("prev_end_id"),
                         F.lag("note").over(w).alias("_prev_note"))
            .filter(F.col("prev_end_id").isNotNull()
                    & (F.col("note") == "") & (F.col("_prev_note") == "")
                    & (F.col("start_id") != F.col("prev_end_id") + 1))
            .select(*keys, "prev_" + order, order, "prev_end_id", "start_id",
                    (F.col("start_id") - F.col("prev_end_id") - 1).alias("missing")))


# ---------------------------------------------------------------- bars

def _covered_days(last_date: Column, year: Column, complete: Column) -> Column:
    leap = ((year % 4 == 0) & (year % 100 != 0)) | (year % 400 == 0)
    return F.when(complete, F.when(leap, 366).otherwise(365)).otherwise(F.dayofyear(last_date))


def bar_expected_counts(bars: DataFrame, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """Per (keys, interval, year) actual vs expected bar count.

    Like the bar file name, the covered range ends at the last bar's date
    (a full year when that is Dec 31): ``expected = days * 86400 / width``.
    A 1s shortfall is noted as sparse, not an error.
    """
    g = bars.groupBy(*keys, "interval", F.year("time").alias("year")).agg(
        F.count(F.lit(1)).alias("count"), F.max("time").alias("_max"))
    last = F.col("_max").cast("date")
    complete = (F.month(last) == 12) & (F.dayofmonth(last) == 31)
    days = _covered_days(last, F.col("year"), complete)
    secs = interval_seconds_col(F.col("interval"))
    exp = (days * F.floor(F.lit(86400) / secs)).cast("long")
    out = g.select(
        *keys, "interval", "year",
        F.when(complete, F.col("year").cast("string"))
         .otherwise(F.date_format(last, "yyyy-MM-dd")).alias("suffix"),
        exp.alias("expected"), "count", (F.col("count") - exp).alias("diff"))
    return out.withColumn(
        "note", F.when((F.col("interval") == "1s") & (F.col("diff") < 0),
                       F.lit("sparse: seconds without trades")).otherwise(F.lit("")))


def expected_bar_grid(bars: DataFrame, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """Every bar slot from Jan 1 to the end of the last covered day, per
    (keys, interval, year), generated days first, then slots inside each day."""
    g = bars.groupBy(*keys, "interval", F.year("time").alias("year")).agg(
        F.max("time").cast("date").alias("_last"))
    days = g.select(*keys, "interval",
                    F.explode(F.sequence(F.make_date("year", F.lit(1), F.lit(1)), F.col("_last")))
                    .alias("_day"))
    secs = interval_seconds_col(F.col("interval"))
    days = days.repartition(*keys, "interval", "_day")
    slots = days.select(*keys, "interval", F.explode(
        F.sequence(F.lit(0).cast("long"), F.floor(F.lit(86400) / secs) - 1)).alias("_k"), "_day", secs.alias("_s"))
    return slots.select(*keys, "interval", F.timestamp_add(
        "SECOND", F.col("_k") * F.col("_s"), F.col("_day").cast("timestamp_ntz")).alias("time"))


def missing_bars(bars: DataFrame, keys: Sequence[str] = ("symbol",),
                 slot_bucket: int = 1 << 17, expand_chunk: int = 1 << 16) -> DataFrame:
    """Expected bar slots with no bar (empty windows produce no bar).

    The expected range of a (keys, interval, year) series runs from Jan 1 to
    the end of the last bar's day (as in :func:`bar_expected_counts`). Missing
    bars are the gaps in the sequence of slot numbers ``time / width``:

    * gaps inside a slot bucket come from ``lead`` per (series, bucket);
    * gaps across buckets and the two edges come from one small window over
      per-bucket bounds (one row per bucket);
    * only the missing slots are generated, in chunks spread over tasks.

    Work is proportional to bars + missing bars, not to the full grid (a year
    of 1s slots is 31.5M per series), and no task holds a whole series.
    """
    series = [*keys, "interval", "year"]
    width = interval_seconds_col(F.col("interval")).cast("long") * F.lit(1_000_000)
    b = (bars.select(*keys, "interval", "time", F.year("time").alias("year"))
         .withColumn("_w", width)
         .withColumn("_s", F.floor(ntz_to_micros("time") / F.col("_w")).cast("long"))
         .withColumn("_b", F.floor(F.col("_s") / F.lit(slot_bucket))))
    inside = (b.withColumn("_n", F.lead("_s").over(Window.partitionBy(*series, "_b").orderBy("_s")))
              .filter(F.col("_n") - F.col("_s") > 1)
              .select(*series, "_w", (F.col("_s") + 1).alias("_lo"), (F.col("_n") - 1).alias("_hi")))
    bb = b.groupBy(*series, "_b").agg(F.first("_w").alias("_w"), F.min("_s").alias("_min"),
                                      F.max("_s").alias("_max"), F.max("time").alias("_t"))
    w_all = Window.partitionBy(*series)
    w_ord = w_all.orderBy("_b")
    year_start = ntz_to_micros(F.make_date("year", F.lit(1), F.lit(1)).cast("timestamp_ntz"))
    day_end = ntz_to_micros(F.date_add(F.max("_t").over(w_all).cast("date"), 1).cast("timestamp_ntz"))
    edges = bb.select(
        *series, "_w", "_min", "_max",
        F.lead("_min").over(w_ord).alias("_next"),
        (F.col("_min") == F.min("_min").over(w_all)).alias("_first"),
        (F.col("_max") == F.max("_max").over(w_all)).alias("_last"),
        F.floor(year_start / F.col("_w")).cast("long").alias("_y0"),
        (F.floor(day_end / F.col("_w")).cast("long") - 1).alias("_y1"))
    ranges = F.array(
        F.when(F.col("_next") - F.col("_max") > 1,
               F.struct((F.col("_max") + 1).alias("_lo"), (F.col("_next") - 1).alias("_hi"))),
        F.when(F.col("_first") & (F.col("_min") > F.col("_y0")),
               F.struct(F.col("_y0").alias("_lo"), (F.col("_min") - 1).alias("_hi"))),
        F.when(F.col("_last") & (F.col("_max") < F.col("_y1")),
               F.struct((F.col("_max") + 1).alias("_lo"), F.col("_y1").alias("_hi"))))
    outer = (edges.select(*series, "_w", F.explode(F.filter(ranges, lambda r: r.isNotNull())).alias("_r"))
             .select(*series, "_w", "_r._lo", "_r._hi"))
    gaps = inside.unionByName(outer)
    # expand ranges chunk by chunk so a long gap is generated by many tasks
    c = F.lit(expand_chunk)
    chunks = (gaps.select(*series, "_w", "_lo", "_hi", F.explode(F.sequence(
                  F.floor(F.col("_lo") / c), F.floor(F.col("_hi") / c))).alias("_c"))
              .repartition(*series, "_c"))
    slots = chunks.select(*series, "_w", F.explode(F.sequence(
        F.greatest(F.col("_lo"), F.col("_c") * c), F.least(F.col("_hi"), F.col("_c") * c + c - 1))).alias("_s"))
    return slots.select(*keys, "interval", micros_to_ntz(F.col("_s") * F.col("_w")).alias("time"))


def trades_per_minute(trades: DataFrame, keys: Sequence[str] = ("symbol",),
                      start=None, end=None, chunk: int = 1 << 14) -> DataFrame:
    """A9 + J4: trade count per minute, re-indexed to every minute with 0.

    With ``start``/``end`` the range is ``[start, end)`` (F3); otherwise each
    series spans its own first to last minute. Series without trades in the
    range give no rows.

    One pass over the ticks: per-minute counts, exchanged once by (series, day). A window per
    day finds the gaps between the counts of that day; the seams between days come from one row
    per (series, day). Gaps are generated chunk by chunk (``chunk`` minutes), so neither a hot
    series nor a gap of years lands in one task or one row.
    """
    t = trades
    lo = F.expr(f"TIMESTAMP_NTZ'{start}'") if start is not None else None
    hi = F.expr(f"TIMESTAMP_NTZ'{end}'") if end is not None else None
    if lo is not None:
        t = t.filter(F.col("time") >= lo)
    if hi is not None:
        t = t.filter(F.col("time") < hi)
    minute, day = F.lit(60_000_000), F.lit(1440)
    counts = (t.groupBy(*keys, F.floor(ntz_to_micros("time") / minute).alias("_m"))
              .agg(F.count(F.lit(1)).alias("n")).withColumn("_d", F.floor(F.col("_m") / day))
              .repartition(*keys, "_d"))
    after = F.lead("_m").over(Window.partitionBy(*keys, "_d").orderBy("_m"))
    own = F.array(F.struct("_m", "n"))
    # a gap inside a day has at most 1438 minutes and is written where it is found
    gap = F.when(after > F.col("_m") + 1, F.transform(F.sequence(F.col("_m") + 1, after - 1), lambda m: F.struct(
        m.alias("_m"), F.lit(0).cast("long").alias("n"))))
    filled = counts.withColumn("_rows", F.concat(own, F.coalesce(gap, F.array().cast("array<struct<_m:bigint,n:bigint>>"))))
    # the counts of days are only asked for so that both branches read the same exchange
    days = (counts.groupBy(*keys, "_d").agg(F.min("_m").alias("_first"), F.max("_m").alias("_last"),
                                            F.sum("n").alias("_n")).filter("_n > 0"))
    w = Window.partitionBy(*keys).orderBy("_d")             # one row per day of a series
    to = F.lead("_first").over(w) - 1
    if hi is not None:
        to = F.coalesce(to, F.floor((ntz_to_micros(hi) - 1) / minute))
    since = F.when(F.lag("_last").over(w).isNull(), F.floor(ntz_to_micros(lo) / minute)) if lo is not None \
        else F.lit(None).cast("long")
    span = "array<struct<_lo:bigint,_hi:bigint>>"
    seams = days.withColumns({"_since": since, "_to": to}).select(*keys, F.inline(F.array(
        F.struct(F.col("_since").alias("_lo"), (F.col("_first") - 1).alias("_hi")),
        F.struct((F.col("_last") + 1).alias("_lo"), F.col("_to").alias("_hi"))).cast(span)))
    c = F.lit(chunk)
    chunks = (seams.filter(F.col("_lo") <= F.col("_hi"))
              .select("*", F.explode(F.sequence(F.floor(F.col("_lo") / c), F.floor(F.col("_hi") / c))).alias("_c"))
              .repartition(*keys, "_c"))
    empty = chunks.select(*keys, F.explode(F.sequence(
        F.greatest(F.col("_lo"), F.col("_c") * c), F.least(F.col("_hi"), F.col("_c") * c + c - 1))).alias("_m"),
        F.lit(0).cast("long").alias("n"))
    return filled.select(*keys, F.inline("_rows")).unionByName(empty).select(
        *keys, micros_to_ntz(F.col("_m") * minute).alias("time"), "n")


# ---------------------------------------------------------------- reports

REPORT_COLUMNS = ("symbol", "kind", "name", "interval", "interval_seconds", "year",
                  "expected", "count", "diff", "start_id", "end_id", "gap_count", "missing", "note")


def check_report(id_checks: DataFrame, bar_checks: DataFrame, continuity: DataFrame,
                 dataset: str = "aggTrades") -> DataFrame:
    """S15 + T5 + P23: one result table for the trade-id, bar-count and
    continuity checks, with file labels, ordered by interval width then name."""
    null_l = F.lit(None).cast("long")
    trades = id_checks.select(
        "symbol", F.lit("trades").alias("kind"),
        F.format_string("%s_%s_%d.parquet", F.col("symbol"), F.lit(dataset), F.col("year")).alias("name"),
        F.lit(None).cast("string").alias("interval"), null_l.alias("interval_seconds"), "year",
        null_l.alias("expected"), F.col("count").cast("long").alias("count"), null_l.alias("diff"),
        "start_id", "end_id", "gap_count", null_l.alias("missing"), "note")
    bars = bar_checks.select(
        "symbol", F.lit("bars").alias("kind"),
        F.format_string("%s_kline_%s_%s.parquet", F.col("symbol"), F.col("interval"), F.col("suffix"))
        .alias("name"),
        "interval", interval_seconds_col(F.col("interval")).cast("long").alias("interval_seconds"),
        "year", "expected", F.col("count").cast("long").alias("count"), "diff",
        null_l.alias("start_id"), null_l.alias("end_id"), null_l.alias("gap_count"),
        null_l.alias("missing"), "note")
    errs = continuity.select(
        "symbol", F.lit("continuity").alias("kind"),
        F.format_string("%s_%s_%d.parquet", F.col("symbol"), F.lit(dataset), F.col("year")).alias("name"),
        F.lit(None).cast("string").alias("interval"), null_l.alias("interval_seconds"), "year",
        null_l.alias("expected"), null_l.alias("count"), null_l.alias("diff"),
        F.col("prev_end_id").alias("start_id"), F.col("start_id").alias("end_id"),
        null_l.alias("gap_count"), "missing",
        F.format_string("%d ids missing between %d and %d", F.col("missing"), F.col("prev_end_id"),
                        F.col("start_id")).alias("note"))
    out = trades.unionByName(bars).unionByName(errs)
    return out.orderBy("symbol", F.coalesce("interval_seconds", F.lit(1 << 31)), "name", "kind")


def label_report(report: DataFrame, market: str, market_sub: str | None = None,
                 dataset: str = "aggTrades") -> DataFrame:
    """A check report with ``market``, ``market_sub`` and the ``folder`` of each row's file
    (trades below the data type, bars below the data type's ``_kline`` folder)."""
    base = store_folder(market, market_sub, dataset)
    kind = F.when(F.col("kind") == "bars", F.lit(f"{base}_kline")).otherwise(F.lit(base))
    return report.withColumns({
        "market": F.lit(market), "market_sub": F.lit(market_sub).cast("string"),
        "folder": F.format_string("%s/%s/", kind, F.col("symbol"))})


def run_counters(report: DataFrame) -> DataFrame:
    """Counters over a check run.

    A trade row is bad when ``gap_count != 0`` or it has a note; a bar row
    when ``diff != 0`` or it has a note, unless the note marks a sparse 1s
    series; every continuity row is an error.
    """
    note = F.coalesce(F.col("note"), F.lit(""))
    bad_trade = (F.col("kind") == "trades") & ((F.col("gap_count") != 0) | (note != ""))
    bad_bar = ((F.col("kind") == "bars") & ((F.col("diff") != 0) | (note != ""))
               & ~note.startswith("sparse"))
    return report.agg(
        F.count_if(F.col("kind") == "trades").alias("trade_checks"),
        F.count_if(bad_trade).alias("trade_bad"),
        F.count_if(F.col("kind") == "bars").alias("bar_checks"),
        F.count_if(bad_bar).alias("bar_bad"),
        F.count_if(F.col("kind") == "continuity").alias("errors"),
    )
