import datetime as dt

from pyspark.sql import functions as F

from candlewright.functions.names import split_symbol
from candlewright.functions.timecols import days_between, epoch_to_micros, micros_to_ntz
from candlewright.operators.analytics import sma
from candlewright.operators.compare import compare_summary
from candlewright.operators.merge import dedup_keep_first, merge_keep_last
from candlewright.operators.quality import id_gaps, id_span_check
from candlewright.plans.archive_plan import select_archives


def test_epoch_units_and_edge(spark):
    df = spark.createDataFrame([(1704067200000,), (1704067200000000,), (10 ** 15,)], "e long")
    us = df.select(epoch_to_micros("e").alias("us"))
    out = us.limit(2).withColumn("t", micros_to_ntz("us")).collect()
    assert out[0].us == out[1].us == 1704067200000000
    assert out[0].t == out[1].t == dt.datetime(2024, 1, 1)
    assert us.collect()[2].us == 10 ** 18  # exactly 1e15 is read as milliseconds


def test_gap_hidden_by_duplicate(spark):
    df = spark.createDataFrame([("X", 2024, 1), ("X", 2024, 1), ("X", 2024, 3)], "symbol string, year int, agg_trade_id long")
    span = id_span_check(df).collect()[0]
    assert span.gap_count == 0
    gaps = [tuple(r) for r in id_gaps(df, bucket=2).select("prev_id", "next_id", "missing").collect()]
    assert gaps == [(1, 3, 1)]


def test_gap_list_across_buckets(spark):
    ids = [i for i in range(1, 200) if i % 13 not in (0, 1)]
    df = spark.createDataFrame([("X", 2024, i) for i in ids], "symbol string, year int, agg_trade_id long")
    want = sorted((a, b, b - a - 1) for a, b in zip(ids, ids[1:]) if b - a > 1)
    for bucket in (3, 7, 1000):
        got = sorted(tuple(r) for r in id_gaps(df, bucket=bucket).select("prev_id", "next_id", "missing").collect())
        assert got == want


def test_keep_last_and_keep_first(spark):
    old = spark.createDataFrame([("X", 1, "old")], "symbol string, agg_trade_id long, v string")
    new = spark.createDataFrame([("X", 1, "new")], "symbol string, agg_trade_id long, v string")
    assert merge_keep_last(old, new, ["symbol", "agg_trade_id"]).collect()[0].v == "new"
    bars = spark.createDataFrame([("a.parquet", 1, 1.0), ("b.parquet", 1, 2.0)], "file_path string, t long, close double")
    assert dedup_keep_first(bars, ["t"], ["file_path"]).collect()[0].close == 1.0


def test_status_ladder_and_phantom(spark):
    t0 = dt.datetime(2024, 1, 1)
    local = spark.createDataFrame(
        [(s, "1h", t0, 100.0, 10.0) for s in ("P", "W", "F")], "symbol string, interval string, time timestamp_ntz, close double, qty double")
    ref = spark.createDataFrame(
        [("P", "1h", t0, 100.0 * (1 + 5e-5), 10.0), ("W", "1h", t0, 100.0 * (1 + 5e-4), 10.0),
         ("F", "1h", t0, 100.0 * (1 + 2e-3), 10.0),
         ("P", "1h", t0 + dt.timedelta(hours=1), 100.0, 0.0)],  # phantom zero-volume bar
        "symbol string, interval string, time timestamp_ntz, close double, qty double")
    st = {r.symbol: (r.status, r.missing_local) for r in compare_summary(local, ref).collect()}
    assert st == {"P": ("PASS", 0), "W": ("WARN", 0), "F": ("FAIL", 0)}


def test_sma_warmup(spark):
    t0 = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([("X", "1h", t0 + dt.timedelta(hours=i), float(i)) for i in range(8)],
                               "symbol string, interval string, time timestamp_ntz, close double")
    vals = [r.SMA7 for r in sma(df, (7,)).orderBy("time").collect()]
    assert vals[:6] == [None] * 6 and vals[6:] == [3.0, 4.0]


def test_quote_split(spark):
    df = spark.createDataFrame([("ETHFDUSD",), ("XYZ",), ("BTC",), ("BTCUSDT",)], "s string")
    b, q = split_symbol("s")
    got = [tuple(r) for r in df.select(b, q).collect()]
    assert got == [("ETH", "FDUSD"), ("XYZ", ""), ("BTC", ""), ("BTC", "USDT")]


def test_monthly_beats_daily(spark):
    files = spark.createDataFrame([("BTCUSDT-aggTrades-2024-12.zip",), ("BTCUSDT-aggTrades-2024-12-25.zip",),
                                   ("BTCUSDT-aggTrades-2025-01-02.zip",)], "file_name string")
    kept = sorted(r.file_name for r in select_archives(files, "2024-12-01").collect())
    assert kept == ["BTCUSDT-aggTrades-2024-12.zip", "BTCUSDT-aggTrades-2025-01-02.zip"]


def test_start_after_end_yields_nothing(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 3), dt.date(2024, 1, 1))], "s date, e date")
    assert df.select(F.size(days_between("s", "e"))).first()[0] == 0


def test_sma_blocks_equal_single_window(spark):
    from pyspark.sql import Window
    t0 = dt.datetime(2024, 1, 1)
    rows = [("X", "1h", t0 + dt.timedelta(hours=7 * i), float((i * 37) % 101)) for i in range(300)]
    df = spark.createDataFrame(rows, "symbol string, interval string, time timestamp_ntz, close double")
    w = Window.partitionBy("symbol", "interval").orderBy("time").rowsBetween(-6, 0)
    ref = df.withColumn("want", F.when(F.count("close").over(w) == 7, F.sum("close").over(w) / 7.0))
    got = sma(ref, (7,), block_rows=10).orderBy("time").collect()
    assert all((r.SMA7 is None and r.want is None) or abs(r.SMA7 - r.want) < 1e-9 for r in got)
    assert len(got) == 300


def test_merge_is_idempotent(spark):
    rows = [("X", 2024, i % 7, float(i)) for i in range(30)]
    df = spark.createDataFrame(rows, "symbol string, year int, agg_trade_id long, v double")
    once = merge_keep_last(df.limit(0), df, ["symbol", "year", "agg_trade_id"], ["v"])
    twice = merge_keep_last(once, once, ["symbol", "year", "agg_trade_id"], ["v"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    assert once.count() == 7


def test_missing_ids_equal_span_minus_distinct(spark):
    ids = [1, 2, 2, 5, 9, 9, 9, 10, 30]
    df = spark.createDataFrame([("X", 2024, i) for i in ids], "symbol string, year int, agg_trade_id long")
    missing = id_gaps(df, bucket=4).agg(F.sum("missing")).first()[0]
    assert missing == (max(ids) - min(ids) + 1) - len(set(ids))


def test_archive_plan_months_days_and_unavailable_fallback(spark):
    from candlewright.plans.archive_plan import archive_plan
    starts = spark.createDataFrame([("BTCUSDT", dt.date(2024, 1, 30))], "symbol string, start_date date")
    plan = archive_plan(starts, ["aggTrades", "metrics"], "2024-03-03")
    names = sorted(r.file_name for r in plan.collect())
    # monthly Jan, Feb (complete before the cutoff); daily only for March days; metrics daily only
    assert "BTCUSDT-aggTrades-2024-01.zip" in names and "BTCUSDT-aggTrades-2024-02.zip" in names
    assert [n for n in names if n.startswith("BTCUSDT-aggTrades-2024-03")] == [
        "BTCUSDT-aggTrades-2024-03-01.zip", "BTCUSDT-aggTrades-2024-03-02.zip"]
    assert len([n for n in names if "metrics" in n]) == 33  # Jan 30 .. Mar 2
    gone = spark.createDataFrame([("BTCUSDT-aggTrades-2024-02.zip",)], "file_name string")
    plan2 = archive_plan(starts, ["aggTrades"], "2024-03-03", unavailable=gone)
    names2 = sorted(r.file_name for r in plan2.collect())
    assert "BTCUSDT-aggTrades-2024-02.zip" not in names2
    assert len([n for n in names2 if n.startswith("BTCUSDT-aggTrades-2024-02-")]) == 29


def test_symbol_list_and_missing_id_column(spark):
    import pytest
    from candlewright.sources.payload import symbol_list
    d = __import__("tempfile").mkdtemp(prefix="cw-sym-")
    with open(d + "/s.json", "w") as f:
        f.write('["BTCUSDT", " ETHUSDT", "BTCUSDT"]')
    got = sorted(r.symbol for r in symbol_list(spark, d + "/s.json", ["SOLUSDT"]).collect())
    assert got == ["BTCUSDT", "ETHUSDT", "SOLUSDT"]
    with open(d + "/e.json", "w") as f:
        f.write("[]")
    with pytest.raises(ValueError):
        symbol_list(spark, d + "/e.json", require_nonempty=True)
    no_ids = spark.createDataFrame([("X", 2024)], "symbol string, year int")
    r = id_span_check(no_ids).collect()[0]
    assert r.note == "dataset has no trade ids" and r.start_id is None
    from candlewright.operators.quality import id_check_with_gaps
    r = id_check_with_gaps(no_ids).collect()[0]
    assert (r.note, r["count"], r.gap_ranges, r.missing_ids) == ("dataset has no trade ids", 0, 0, 0)


def test_month_partitioned_upsert_rewrites_only_the_touched_month(spark):
    import os
    from candlewright.session import shared_dir
    from candlewright.sources.store import read_table, upsert
    parts = ("symbol", "year", "month")
    keys = ("symbol", "year", "month", "agg_trade_id")
    t0 = dt.datetime(2024, 1, 15)
    old = spark.createDataFrame([("X", i, t0 + dt.timedelta(days=20 * i), 1.0) for i in range(4)],
                                "symbol string, agg_trade_id long, time timestamp_ntz, price double")
    path = shared_dir(spark, "t-month")
    upsert(spark, old, path, keys, ["price"], partition_cols=parts)
    local = path.replace("file:", "")

    def files(m):
        d = os.path.join(local, "symbol=X", "year=2024", f"month={m}")
        return sorted(f for f in os.listdir(d) if f.endswith(".parquet"))

    jan, mar = files(1), files(3)
    new = spark.createDataFrame([("X", 2, t0 + dt.timedelta(days=40), 9.0)],
                                "symbol string, agg_trade_id long, time timestamp_ntz, price double")
    out = upsert(spark, new, path, keys, ["price"], partition_cols=parts)
    assert files(1) == jan                      # January untouched
    assert files(2) != [] and files(3) == mar   # only February was rewritten
    got = {r.agg_trade_id: r.price for r in out.collect()}
    assert got == {0: 1.0, 1: 1.0, 2: 9.0, 3: 1.0}


def test_compare_skip_and_phantom_only_fail(spark):
    t0 = dt.datetime(2024, 1, 1)
    schema = "symbol string, interval string, time timestamp_ntz, close double, qty double"
    local = spark.createDataFrame([("A", "1h", t0, 1.0, 1.0)], schema)
    ref = spark.createDataFrame([("A", "1h", t0, 1.0, 1.0), ("Q", "1h", t0, 5.0, 0.0)], schema)
    pairs = spark.createDataFrame([("A", "1h"), ("Q", "1h"), ("Z", "1h")], "symbol string, interval string")
    st = {r.symbol: (r.status, r.local_bars, r.api_bars, r.missing_local)
          for r in compare_summary(local, ref, pairs=pairs).collect()}
    assert st["A"] == ("PASS", 1, 1, 0)
    assert st["Q"] == ("FAIL", 0, 1, 0)      # only a zero-volume reference bar, nothing local
    assert st["Z"] == ("SKIP", 0, 0, 0)      # requested, empty on both sides


def test_start_dates_from_footer_coverage(spark):
    from candlewright.operators.coverage import coverage_stored, start_dates
    from candlewright.session import shared_dir
    from candlewright.sources.store import write_table
    from candlewright.functions.timecols import ntz_to_micros
    t = spark.createDataFrame([("X", 1, dt.datetime(2023, 12, 31, 23, 0)), ("X", 2, dt.datetime(2024, 3, 5, 1, 2))],
                              "symbol string, agg_trade_id long, time timestamp_ntz")
    t = t.withColumn("ts", ntz_to_micros("time"))
    path = shared_dir(spark, "t-cov")
    write_table(t, path)
    cov = coverage_stored(spark, path)
    assert {(r.year, r.complete, r.suffix) for r in cov.collect()} == {(2023, True, "2023"), (2024, False, "2024-03-05")}
    syms = spark.createDataFrame([("X",), ("Y",)], "symbol string")
    got = {r.symbol: r.start_date for r in start_dates(syms, None, coverage=cov).collect()}
    assert got == {"X": dt.date(2024, 3, 6), "Y": dt.date(2020, 1, 1)}
