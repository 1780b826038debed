"""Structured Streaming versions of the incremental operators.

* R1 :func:`bar_stream` - continuous OHLCV bars; every emitted bar equals the
  batch bar of :func:`candlewright.operators.bars.klines`. Append mode emits a
  window once the watermark passes its end; Spark drops rows of windows that are
  already out. :func:`tick_stream` stores all ticks and marks the days of such rows, and
  :func:`repair` rebuilds them (G8), so stream plus repair equals batch.
* R2 :func:`dedup_stream` - ``dropDuplicatesWithinWatermark``, keeps the *first* copy seen;
  :func:`dedup_last_stream` keeps the *last* by an order column, as the batch merge does,
  and emits a correction whenever a newer copy arrives within the bound.
* R3 :func:`upsert_stream` - each micro-batch is merged into the stored
  table with the batch upsert (D4), so touched partitions only.

``withWatermark`` needs ``TIMESTAMP``, not ``TIMESTAMP_NTZ``: the stream
casts in with the session zone pinned to UTC and casts window starts back.
"""

from __future__ import annotations

import datetime
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery
from pyspark.sql.types import BooleanType, StructField, StructType

from candlewright.functions.timecols import interval_seconds, ntz_to_micros
from candlewright.operators.bars import _tick_aggs, _with_order_key, finish_bars
from candlewright.operators.merge import dedup_keep_last, merge_keep_last
from candlewright.plans.refresh import dirty_days, mark_days, refresh_bars
from candlewright.sources.store import replace_partitions, staged, upsert
from candlewright.sources.swap import Folder


def bar_stream(trades: DataFrame, interval: str = "1h", watermark: str = "1 hour",
               zero_qty: str = "nan", decimals: int | None = None,
               keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """Streaming ``klines`` (same aggregates, same packed order key)."""
    secs = interval_seconds(interval)
    t = _with_order_key(trades).withColumn("_et", F.col("time").cast("timestamp"))
    g = (t.withWatermark("_et", watermark)
         .groupBy(*keys, F.window("_et", f"{secs} seconds").alias("_w"))
         .agg(*_tick_aggs())
         .withColumn("time", F.col("_w.start").cast("timestamp_ntz")).drop("_w"))
    return finish_bars(g, zero_qty, keys, decimals=decimals)


def dedup_stream(trades: DataFrame, watermark: str = "1 hour",
                 keys: Sequence[str] = ("symbol", "agg_trade_id")) -> DataFrame:
    """R2: drop repeated keys seen within the watermark delay."""
    return (trades.withColumn("_et", F.col("time").cast("timestamp"))
            .withWatermark("_et", watermark)
            .dropDuplicatesWithinWatermark(list(keys))
            .drop("_et"))


class _KeepLast(StatefulProcessor):
    """Per (symbol, block of ids): the order value of the newest copy of every id seen, and until
    when it is kept. One read and one write of state per block and batch."""

    def __init__(self, columns: list[str], id_col: str, bound_ms: int):
        self.columns, self.id_col, self.bound = columns, id_col, bound_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "ids array<bigint>, orders array<bigint>, until array<bigint>")

    def _load(self) -> tuple[list[int], list[int], list[int]]:
        return tuple(map(list, self.seen.get())) if self.seen.exists() else ([], [], [])

    def _store(self, entries: dict[int, tuple[int, int]]) -> None:
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        if not entries:
            self.seen.clear()
            return
        ids = list(entries)
        self.seen.update((ids, [entries[i][0] for i in ids], [entries[i][1] for i in ids]))
        self.handle.registerTimer(min(u for _, u in entries.values()))

    def handleInputRows(self, key, rows, timerValues) -> Iterator:
        import pandas as pd
        new = pd.concat(list(rows), ignore_index=True)
        new.columns = self.columns              # Spark gives names with a leading _ by position
        new = new.sort_values("_order", kind="stable")
        new = new.drop_duplicates(self.id_col, keep="last")
        entries = {i: (o, u) for i, o, u in zip(*self._load())}
        known = [entries.get(i) for i in new[self.id_col]]
        keep = [k is None or o >= k[0] for k, o in zip(known, new["_order"])]
        new["is_correction"] = [k is not None for k in known]
        new = new[keep]
        until = new["_et"].astype("datetime64[ms, UTC]" if new["_et"].dt.tz else "datetime64[ms]").astype("int64") + self.bound
        for i, o, u in zip(new[self.id_col].tolist(), new["_order"].tolist(), until.tolist()):
            entries[i] = (o, max(u, entries[i][1]) if i in entries else u)
        self._store(entries)
        yield new.drop(columns=["_order", "_et", "_block"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator:
        now = expiredTimerInfo.getExpiryTimeInMs()
        self._store({i: (o, u) for i, o, u in zip(*self._load()) if u > now})
        return iter([])

    def close(self) -> None:
        pass


def dedup_last_stream(trades: DataFrame, bound_seconds: int = 3600, order: Column | None = None,
                      id_col: str = "agg_trade_id", block: int = 4096) -> DataFrame:
    """R2, newest wins: every first copy of a (symbol, id), and every later copy that ranks at least
    as high by ``order`` (a long; by default the trade's time), the latter with
    ``is_correction``. The last copy emitted of a key is the one the batch merge keeps.

    Copies are compared within ``bound_seconds`` of event time: rows behind the watermark are dropped, and an id
    leaves the state that long after its newest copy. State is kept per block of ids, so a hot
    symbol spreads over its blocks; a block holds at most ``block`` ids.
    """
    rank = order if order is not None else ntz_to_micros("time")
    t = trades.withColumns({"_et": F.col("time").cast("timestamp"), "_order": rank,
                            "_block": F.floor(F.col(id_col) / F.lit(block))})
    schema = StructType([*trades.schema.fields, StructField("is_correction", BooleanType())])
    return (t.withWatermark("_et", f"{bound_seconds} seconds").groupBy("symbol", "_block")
            .transformWithStateInPandas(_KeepLast(t.columns, id_col, bound_seconds * 1000), schema, "Append", "EventTime"))


def latest(corrections: DataFrame, keys: Sequence[str] = ("symbol", "agg_trade_id"),
           order: Column | None = None) -> DataFrame:
    """The rows that stand after all corrections of a stored :func:`dedup_last_stream`."""
    rank = order if order is not None else F.col("time")
    return dedup_keep_last(corrections, keys, [rank, "is_correction"]).drop("is_correction")


#: Rows of a file that a stream reads, about.
ROWS_PER_SOURCE_FILE = 1_000_000


def write_source(df: DataFrame, path: str, files: int, *keys: str) -> int:
    """``df`` as files for :func:`read_trade_stream`: ``files`` of them, or the multiple of it that
    holds each to about :data:`ROWS_PER_SOURCE_FILE` rows; the factor is returned, for ``max_files``.
    So the batches stay as many, and no task writes more as the table grows. Rows equal in ``keys``
    share a file; dealt by another hash than an exchange by the keys uses, so that a batch of some
    files still spreads over all partitions of the stream's state."""
    factor = max(1, -(-df.count() // (files * ROWS_PER_SOURCE_FILE)))
    df.repartition(files * factor, F.xxhash64(*keys)).write.parquet(path)
    return factor


def read_trade_stream(spark: SparkSession, path: str, schema, max_files: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema).format("parquet")
    if max_files:
        r = r.option("maxFilesPerTrigger", str(max_files))
    return r.load(path)


def run_to_parquet(stream: DataFrame, out_path: str, checkpoint: str,
                   mode: str = "append") -> StreamingQuery:
    """Drain everything available (``availableNow``) into a Parquet sink."""
    q = (stream.writeStream.format("parquet").outputMode(mode)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start(out_path))
    q.awaitTermination()
    return q


def drain(stream: DataFrame, each, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Run ``each(batch, number)`` over everything available."""
    q = (stream.writeStream.outputMode(mode).foreachBatch(each).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def bars_to_store(trades: DataFrame, bars_path: str, checkpoint: str, interval: str = "1h",
                  watermark: str = "1 hour", **options) -> StreamingQuery:
    """R1 into the bar store: emitted windows are merged into (symbol, interval, year)."""
    bars = bar_stream(trades, interval, watermark, **options).withColumn("interval", F.lit(interval))

    def each(batch: DataFrame, _: int) -> None:
        replace_partitions(
            batch.sparkSession, batch, bars_path, partition_cols=("symbol", "interval", "year"), order=("time",),
            merge=lambda stored, new: new if stored is None else merge_keep_last(
                stored.select(*new.columns), new, ("symbol", "interval", "time")))

    return drain(bars, each, checkpoint)


def tick_stream(trades: DataFrame, trades_path: str, bars_path: str, keys: Sequence[str], checkpoint: str,
                delay_seconds: int = 3600, order: Sequence = ()) -> StreamingQuery:
    """Ticks into the store by micro-batches; days with rows that a bar stream of the same files
    and a watermark of ``delay_seconds`` may have dropped are marked for :func:`repair`.

    A bar stream's watermark at a row is at most the newest time among the files up to that
    row's batch, less the delay. The newest time seen is kept beside the bar store (one value
    per batch), so the marks also hold after a restart and are never too few.
    """
    def each(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        seen = Folder(spark, bars_path)
        with staged(batch, "ticks") as ticks:
            (ticks.agg(F.max("time").alias("newest")).coalesce(1)
             .write.mode("overwrite").parquet(seen.at("_newest", f"{number:012d}")))
            newest = spark.read.schema("newest timestamp_ntz").parquet(
                *[seen.at("_newest", n) for n in seen.names("_newest")]).agg(F.max("newest")).first()[0]
            if newest is None:
                return
            late = F.col("time") < F.lit(newest - datetime.timedelta(seconds=delay_seconds))
            mark_days(dirty_days(ticks.filter(late)), bars_path)
            upsert(spark, ticks, trades_path, keys, order, staged=True)

    return drain(trades, each, checkpoint)


def repair(spark: SparkSession, trades_path: str, bars_path: str, intervals: Sequence[str], **options) -> DataFrame | None:
    """Bars of all marked days, and of days that the stream has not closed yet, from the stored ticks."""
    return refresh_bars(spark, trades_path, bars_path, intervals, **options)


def upsert_stream(stream: DataFrame, path: str, keys: Sequence[str], checkpoint: str,
                  order: Sequence = ()) -> StreamingQuery:
    """Merge every micro-batch into the stored table (touched partitions only)."""
    def merge(batch: DataFrame, batch_id: int) -> None:
        upsert(batch.sparkSession, batch, path, keys, order)   # stages the batch once; an empty one ends there

    q = (stream.writeStream.foreachBatch(merge)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q
