import datetime as dt

from pyspark.sql import functions as F

from candlewright.operators.bars import klines
from candlewright.session import shared_dir
from candlewright.streaming.bars import bar_stream, read_trade_stream, run_to_parquet


def _rows(spark, minutes, base_id):
    t0 = dt.datetime(2024, 1, 1)
    return spark.createDataFrame(
        [("X", base_id + i, t0 + dt.timedelta(minutes=m), 1.0 + (m % 7), 1.0, m % 2 == 0)
         for i, m in enumerate(minutes)],
        "symbol string, agg_trade_id long, time timestamp_ntz, price double, quantity double, "
        "is_buyer_maker boolean")


def test_late_rows_are_dropped_by_the_stream_and_kept_by_batch(spark):
    src, out, ck = (shared_dir(spark, n) for n in ("t-late-src", "t-late-out", "t-late-ck"))
    first = _rows(spark, range(0, 300), 0)                     # 00:00 .. 04:59
    first.coalesce(1).write.parquet(src)
    stream = read_trade_stream(spark, src, first.schema, max_files=1)
    run_to_parquet(bar_stream(stream, "1h", watermark="30 minutes"), out, ck)
    # the 01:00 bar was emitted once the watermark (04:29) passed 02:00
    second = _rows(spark, [70] + list(range(300, 480)), 1000)  # a late trade at 01:10, then 05:00 .. 07:59
    second.coalesce(1).write.mode("append").parquet(src)
    stream = read_trade_stream(spark, src, first.schema, max_files=1)
    run_to_parquet(bar_stream(stream, "1h", watermark="30 minutes"), out, ck)

    streamed = {r.time.hour: r.qty for r in spark.read.parquet(out).collect()}
    batch = {r.time.hour: r.qty for r in klines(first.unionByName(second), "1h").collect()}
    assert streamed[1] == 60.0 and batch[1] == 61.0          # late row: dropped vs kept
    assert all(streamed[h] == batch[h] for h in streamed if h != 1)
    assert max(streamed) < max(batch)                        # the last windows are still open


def _trade(spark, *rows):
    """(symbol, id, minute, price)"""
    t0 = dt.datetime(2024, 1, 1)
    return spark.createDataFrame([(s, i, t0 + dt.timedelta(minutes=m), p, 1.0, i % 2 == 0) for s, i, m, p in rows],
                                 "symbol string, agg_trade_id long, time timestamp_ntz, price double, quantity double, "
                                 "is_buyer_maker boolean")


def test_newest_copies_win_within_the_bound_and_state_is_released(spark):
    from candlewright.streaming.bars import dedup_last_stream, latest
    src, out, ck = (shared_dir(spark, n) for n in ("t-last-src", "t-last-out", "t-last-ck"))
    batches = [[("X", 1, 0, 1.0), ("X", 1, 5, 2.0), ("X", 2, 1, 1.0), ("Y", 1, 2, 1.0), (None, 1, 2, 8.0)],
               [("X", 1, 3, 9.0), ("X", 2, 30, 3.0), ("Y", 1, 2, 4.0), (None, 1, 4, 9.0)],    # X 1: an older copy, Y 1: a tie
               [("X", 10_000, 300, 1.0)], [("X", 10_001, 301, 1.0)]]
    states, emitted = [], []
    for k, rows in enumerate(batches):
        _trade(spark, *rows).coalesce(1).write.mode("append").parquet(src)
        stream = read_trade_stream(spark, src, _trade(spark).schema, max_files=1)
        q = run_to_parquet(dedup_last_stream(stream, 3600), out, ck)
        states.append(q.lastProgress["stateOperators"][0]["numRowsTotal"])
        emitted.append(spark.read.parquet(out).count())
    got = {(r.symbol, r.agg_trade_id): (r.time.minute, r.price) for r in latest(spark.read.parquet(out)).collect()}
    assert got == {("X", 1): (5, 2.0), ("X", 2): (30, 3.0), ("Y", 1): (2, 4.0), (None, 1): (4, 9.0),
                   ("X", 10_000): (0, 1.0), ("X", 10_001): (1, 1.0)}
    rows = spark.read.parquet(out)
    assert emitted == [4, 7, 8, 9] and rows.where("is_correction").count() == 3
    assert set(rows.columns) == {"symbol", "agg_trade_id", "time", "price", "quantity", "is_buyer_maker", "is_correction"}
    assert max(states[:2]) > states[-1]          # blocks without a live id leave the state


def test_stream_and_repair_equal_batch_on_shuffled_files(spark):
    from candlewright.streaming.bars import bars_to_store, repair, tick_stream
    src, ticks, bars, ck1, ck2 = (shared_dir(spark, f"t-rep-{i}") for i in range(5))
    minutes = [*range(600, 900), *range(0, 300), *range(300, 600), 70, 71]
    parts = [[(s, 1000 * k + i, m, float(m % 13)) for i, m in enumerate(minutes[k::3]) for s in ("X", "Y")] for k in range(3)]
    for p in parts:
        _trade(spark, *p).withColumn("ts", F.unix_micros(F.col("time").cast("timestamp"))).coalesce(1).write.mode("append").parquet(src)
    schema = spark.read.parquet(src).schema

    def run():
        stream = read_trade_stream(spark, src, schema, max_files=1)
        bars_to_store(stream, bars, ck1, "1h", "1 hour")
        tick_stream(stream, ticks, bars, ("symbol", "year", "agg_trade_id"), ck2, 3600)
        out = repair(spark, ticks, bars, ("1h",))
        cols = ["symbol", "time", "open", "high", "low", "close", "qty", "buyer_qty"]
        want = klines(spark.read.schema(schema).parquet(src), "1h").select(cols)
        assert sorted(map(tuple, out.select(cols).collect())) == sorted(map(tuple, want.collect()))
    run()
    # late rows of a closed window, in a later run
    _trade(spark, ("X", 9_999, 5, 99.0)).withColumn("ts", F.lit(1704067500000000)).coalesce(1).write.mode("append").parquet(src)
    run()


def _lineitem(spark, path, n, copies=8):
    """``n`` ids of one flag over two years, one of ``copies`` again with another part, in one file."""
    key, late = F.col("id") % n, F.col("id") >= n
    (spark.range(n + n // copies).select(
        F.lit("N").alias("l_returnflag"), key.alias("l_orderkey"), F.lit(1).alias("l_linenumber"),
        F.timestamp_add("DAY", (key % 700).cast("int"), F.lit(dt.datetime(1996, 1, 1)).cast("timestamp_ntz")).alias("l_shipdate"),
        (key * 2.0 + late.cast("int")).alias("l_extendedprice"), F.lit(1.0).alias("l_quantity"), F.lit("F").alias("l_linestatus"),
        (key * 2 + late.cast("int")).alias("l_partkey"), key.alias("l_suppkey"))
     .coalesce(1).write.parquet(path + "/lineitem.parquet"))


def _source_spy(monkeypatch, SB):
    """(path, max_files) of every stream that a query opens."""
    seen, real = [], SB.read_trade_stream

    def read(spark, path, schema, max_files=None):
        seen.append((path, max_files))
        return real(spark, path, schema, max_files)
    monkeypatch.setattr(SB, "read_trade_stream", read)
    monkeypatch.setattr(SB, "ROWS_PER_SOURCE_FILE", 500, raising=False)
    return seen


def test_a_dedup_stream_of_one_symbol_is_dealt_over_files_and_state(spark, monkeypatch):
    from candlewright import driver_queries as Q
    from candlewright.streaming import bars as SB
    d, seen = shared_dir(spark, "t-one-symbol"), _source_spy(monkeypatch, SB)
    _lineitem(spark, d, 8000)
    got = Q.q_stream_dedup(spark, d)
    assert sorted(tuple(r) for r in got.collect()) == sorted(("N", i * 10 + 1) for i in range(8000))
    (src, max_files), = seen
    rows = spark.read.parquet(src).withColumn("_f", F.input_file_name())
    sizes = [r["count"] for r in rows.groupBy("_f").count().collect()]
    assert sum(sizes) == 9000 and len(sizes) == 20 and max(sizes) < 750       # one file of 9000 before
    assert max_files == 5                                                     # still four batches
    assert rows.groupBy("symbol", "agg_trade_id").agg(F.count_distinct("_f").alias("n")).where("n > 1").isEmpty()
    # one batch's rows meet all partitions of an exchange by the key
    batch = rows.where(F.col("_f").isin([r._f for r in rows.select("_f").distinct().limit(5).collect()]))
    met = batch.groupBy(F.expr("pmod(hash(symbol, agg_trade_id), 20)").alias("p")).count().collect()
    assert len(met) == 20 and max(r["count"] for r in met) < 3 * batch.count() / 20


def test_an_upsert_stream_keeps_two_batches_and_bounds_its_files(spark, monkeypatch):
    from candlewright import driver_queries as Q
    from candlewright.streaming import bars as SB
    d, seen, runs, real = shared_dir(spark, "t-up-src"), _source_spy(monkeypatch, SB), [], SB.upsert
    monkeypatch.setattr(SB, "upsert", lambda *a, **b: runs.append(1) or real(*a, **b))
    _lineitem(spark, d, 8000, copies=1)           # even parts are stored first, every copy has an odd one
    got = {r.agg_trade_id: (r.year, r._p, r.price) for r in Q.q_stream_upsert(spark, d).collect()}
    assert got == {i * 10 + 1: (1996 if i % 700 < 366 else 1997, 2 * i + 1, 2.0 * i + 1) for i in range(8000)}
    (src, max_files), = seen
    sizes = [r["count"] for r in spark.read.parquet(src).groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 8000 and len(sizes) == 16 and max(sizes) < 750       # four files of 2000 before
    assert max_files == 8 and len(runs) == 2
