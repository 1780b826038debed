"""Incremental bars and resumed refreshes."""

import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from candlewright.operators.bars import klines_all_intervals
from candlewright.plans import ingest as IN
from candlewright.plans import ledger as LG
from candlewright.plans import refresh as RF
from candlewright.session import shared_dir
from candlewright.sources import archives as AR
from candlewright.sources import store as ST
from tests.test_ingest import _zip

SCHEMA = ("symbol string, agg_trade_id long, time timestamp_ntz, price double, quantity double, first_trade_id long, "
          "last_trade_id long, is_buyer_maker boolean, is_best_match boolean, ts long")
IV = ("1m", "1h", "1d")


def trades(spark, *data):
    """(symbol, id, 'YYYY-MM-DD HH:MM', price)"""
    rows = []
    for s, i, t, p in data:
        t = dt.datetime.fromisoformat(t)
        us = int((t - dt.datetime(1970, 1, 1)).total_seconds() * 1_000_000)
        rows.append((s, i, t, p, 1.0, i, i, i % 2 == 0, False, us))
    return spark.createDataFrame(rows, SCHEMA)


def bars_of(df):
    return sorted(((r.symbol or "", r.interval, r.time, r.open, r.high, r.low, r.close, r.qty, r.buyer_qty) for r in df.collect()))


def spy(monkeypatch):
    """(symbol, day) pairs and plan of the ticks that bars are built from."""
    seen, real = [], RF.klines_all_intervals

    def build(todo, *a, **k):
        days = todo.select("symbol", F.to_date("time").alias("d")).distinct().collect()
        seen.append((sorted((r.symbol or "", str(r.d)) for r in days),
                     todo._jdf.queryExecution().executedPlan().toString()))
        return real(todo, *a, **k)
    monkeypatch.setattr(RF, "klines_all_intervals", build)
    return seen


def base_rows():
    return [(s, 100 * d + h, f"2024-{m:02d}-{d:02d} {h:02d}:30", float(d + h)) for s in ("A", "B", None)
            for m in (2, 3) for d in range(1, 8) for h in (1, 9, 17)]


def test_one_new_day_reads_one_day_of_ticks(spark, monkeypatch):
    root = shared_dir(spark, "t-inc")
    base = [(s, i + 10_000 * int(t[6]), t, p) for s, i, t, p in base_rows()]
    RF.refresh(spark, trades(spark, *base), root, IV)
    seen = spy(monkeypatch)
    new = [("A", 50_000, "2024-03-08 10:00", 5.0), ("A", 50_001, "2024-03-08 10:00", 6.0)]
    out = RF.refresh(spark, trades(spark, *new), root, IV)
    [(days, plan)] = seen
    assert days == [("A", "2024-03-08")]
    assert "GreaterThanOrEqual(time,2024-03-08T00:00)" in plan and "LessThan(time,2024-03-09T00:00)" in plan
    assert bars_of(out) == bars_of(klines_all_intervals(trades(spark, *base, *new), IV))


def test_newer_copies_and_late_days_give_a_full_rebuild(spark):
    """Replaced trades must not be counted twice; null symbols and filled holes count too."""
    root = shared_dir(spark, "t-inc2")
    base = [(s, i + 10_000 * int(t[6]), t, p) for s, i, t, p in base_rows()]
    RF.refresh(spark, trades(spark, *base), root, IV)
    newer = [("A", 20_101, "2024-02-01 01:30", 99.0), (None, 30_709, "2024-03-07 09:30", 42.0),
             ("B", 77_000, "2024-02-20 12:00", 1.5), ("C", 1, "2023-12-31 23:59", 3.0)]
    out = RF.refresh(spark, trades(spark, *newer), root, IV)
    key = {(s, i): (s, i, t, p) for s, i, t, p in [*base, *newer]}
    assert bars_of(out) == bars_of(klines_all_intervals(trades(spark, *key.values()), IV))


def test_stale_and_missing_series_are_caught_up(spark, monkeypatch):
    root = shared_dir(spark, "t-stale")
    base = [r for r in base_rows() if r[0] == "A" and r[2] < "2024-03"]
    RF.refresh(spark, trades(spark, *base), root, ("1h", "1d"))
    # trades stored by a refresh that died before its bars
    more = [("A", 9_000 + d, f"2024-02-{d:02d} 05:00", 7.0) for d in (8, 9)]
    ST.upsert(spark, trades(spark, *more), os.path.join(root, "aggTrades"), ("symbol", "year", "agg_trade_id"))
    seen = spy(monkeypatch)
    out = RF.refresh_bars(spark, os.path.join(root, "aggTrades"), os.path.join(root, "klines"), ("1h", "1d"))
    assert [d for _, d in seen[0][0]] == ["2024-02-07", "2024-02-08", "2024-02-09"]
    assert bars_of(out) == bars_of(klines_all_intervals(trades(spark, *base, *more), ("1h", "1d")))
    # a new interval is built for the whole year
    out = RF.refresh_bars(spark, os.path.join(root, "aggTrades"), os.path.join(root, "klines"), IV)
    assert bars_of(out) == bars_of(klines_all_intervals(trades(spark, *base, *more), IV))


def test_day_ranges_cover_every_day_with_few_ranges():
    d0 = dt.date(2024, 1, 1)
    days = [d0 + dt.timedelta(days=i) for i in (0, 1, 2, 10, 11, 40, 100, 101, 300)]
    for most in (1, 2, 3, 5, 32):
        r = RF.day_ranges(days, most)
        assert len(r) == min(most, 5) and all(any(a <= d <= b for a, b in r) for d in days)
    assert RF.day_ranges(days, 2) == [(days[0], days[7]), (days[8], days[8])]
    assert RF.day_ranges([d0]) == [(d0, d0)]


def _day(folder, sym, day, rows):
    ms = int(dt.datetime.fromisoformat(day).timestamp() - dt.datetime(1970, 1, 1).timestamp()) * 1000
    _zip(folder, f"{sym}-aggTrades-{day}.zip", "".join(f"{i},{p},1,{i},{i},{ms + k},true\n" for k, (i, p) in enumerate(rows)))


def _prices(df):
    return {(r.symbol, r.agg_trade_id): r.price for r in df.collect()}


def test_a_second_run_opens_no_archive_and_a_republished_one_is_read_again(spark, monkeypatch):
    land, store = shared_dir(spark, "t-l"), shared_dir(spark, "t-s")
    os.makedirs(land)
    _day(land, "AAA", "2023-12-31", [(1, 1.0)])          # the year counts as complete
    _day(land, "AAA", "2024-01-01", [(2, 2.0)])
    _zip(land, "BAD-aggTrades-2024-01-01.zip", None)
    opened, real = [], AR.ingest

    def ingest(spark, path, data_type, market, selected=None, **k):
        opened.append(sorted(r.file_name[:-4].replace("-aggTrades-", " ") for r in selected.collect()))
        return real(spark, path, data_type, market, selected=selected, **k)
    monkeypatch.setattr(IN, "ingest", ingest)
    run = lambda **k: IN.convert(spark, land, store, "aggTrades", "future", **k)
    table, bad, days = run()
    assert opened == [["AAA 2023-12-31", "AAA 2024-01-01", "BAD 2024-01-01"]] and bad.count() == 1
    assert _prices(table) == {("AAA", 1): 1.0, ("AAA", 2): 2.0} and days.count() == 2
    table, bad, days = run()
    assert len(opened) == 1 and days is None and table.count() == 2
    # republished inside the complete year, and a late archive of an earlier day
    time.sleep(1.1)
    _day(land, "AAA", "2023-12-31", [(1, 7.0)])
    _day(land, "AAA", "2023-06-01", [(0, 5.0)])
    table, _, days = run()
    assert opened[1:] == [["AAA 2023-06-01", "AAA 2023-12-31"]]
    assert _prices(table) == {("AAA", 0): 5.0, ("AAA", 1): 7.0, ("AAA", 2): 2.0}
    assert {str(r.day) for r in days.collect()} == {"2023-06-01", "2023-12-31"}
    status = {r.file_name[:3] + r.file_name[-9:-4]: r.status for r in LG.read_ledger(spark, store).collect()}
    assert status == {"AAA12-31": "ok", "AAA01-01": "ok", "AAA06-01": "ok", "BAD01-01": "bad"}
    run()
    assert len(opened) == 2


def test_a_store_without_ledger_resumes_from_its_coverage(spark, monkeypatch):
    land, store = shared_dir(spark, "t-l2"), shared_dir(spark, "t-s2")
    os.makedirs(land)
    for day, i in (("2024-01-01", 1), ("2024-01-02", 2)):
        _day(land, "AAA", day, [(i, 1.0)])
    IN.ingest_archives(spark, land, store, "aggTrades", "future")
    _day(land, "AAA", "2024-01-03", [(3, 3.0)])
    _day(land, "NEW", "2021-05-05", [(9, 9.0)])
    _day(land, "OLD", "2019-05-05", [(8, 8.0)])            # before the default start
    table, _, days = IN.convert(spark, land, store, "aggTrades", "future")
    assert {(r.symbol, str(r.day)) for r in days.collect()} == {("AAA", "2024-01-03"), ("NEW", "2021-05-05")}
    assert set(_prices(table)) == {("AAA", 1), ("AAA", 2), ("AAA", 3), ("NEW", 9)}


def test_a_refresh_killed_before_its_ledger_converts_again(spark, monkeypatch):
    land, store = shared_dir(spark, "t-l3"), shared_dir(spark, "t-s3")
    os.makedirs(land)

    def killed():
        with monkeypatch.context() as m:
            m.setattr(LG, "record", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt))
            with pytest.raises(KeyboardInterrupt):
                IN.convert(spark, land, store, "aggTrades", "future")

    _day(land, "AAA", "2024-01-01", [(1, 1.0)])
    killed()                                               # the first run ever: the store itself tells what is done
    table, _, days = IN.convert(spark, land, store, "aggTrades", "future")
    assert days is None and _prices(table) == {("AAA", 1): 1.0}
    _day(land, "AAA", "2024-01-02", [(2, 2.0)])
    IN.convert(spark, land, store, "aggTrades", "future")
    _day(land, "AAA", "2023-01-02", [(0, 0.5)])            # then a late archive
    killed()
    table, _, days = IN.convert(spark, land, store, "aggTrades", "future")
    assert _prices(table) == {("AAA", 0): 0.5, ("AAA", 1): 1.0, ("AAA", 2): 2.0}
    # the archive that the first run did not record is converted again as well, with the same result
    assert sorted(str(r.day) for r in days.collect()) == ["2023-01-02", "2024-01-01"]


def test_two_markets_and_other_types_side_by_side(spark):
    lands = {k: shared_dir(spark, "t-m") for k in (("future", "um", "aggTrades"), ("future", "cm", "aggTrades"),
                                                   ("spot", "aggTrades"), ("future", "fundingRate"))}
    for p in lands.values():
        os.makedirs(p)
    _day(lands["future", "um", "aggTrades"], "AAA", "2024-01-01", [(1, 1.0)])
    _day(lands["future", "cm", "aggTrades"], "AAA", "2024-01-01", [(1, 2.0)])
    _zip(lands["spot", "aggTrades"], "AAA-aggTrades-2024-01-01.zip", "1,3.0,1,1,1,1704067200000,true,true\n")
    _zip(lands["future", "fundingRate"], "AAA-fundingRate-2024-01.zip",
         "calc_time,funding_interval_hours,last_funding_rate\n1704067200000,8,0.0001\n")
    root = shared_dir(spark, "t-root")
    for _ in range(2):
        out = RF.full_refresh(spark, lands, root, intervals=("1d",))
    close = {k: [(r.market, r.market_sub, r.close) for r in out[(*k[:-1], "klines")].collect()]
             for k in lands if k[-1] == "aggTrades"}
    assert list(close.values()) == [[("future", "um", 1.0)], [("future", "cm", 2.0)], [("spot", None, 3.0)]]
    assert sorted(os.listdir(root)) == ["future", "spot"] and sorted(os.listdir(f"{root}/future")) == ["cm", "um"]
    assert sorted(os.listdir(f"{root}/future/um")) == ["aggTrades", "aggTrades_kline", "fundingRate"]
    assert out["future", "fundingRate"][0].first().market_sub == "um"
