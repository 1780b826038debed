import io
import os
import tempfile
import zipfile

from pyspark.sql import functions as F

from candlewright.sources.archives import ingest


def _zip(folder, name, text):
    with zipfile.ZipFile(os.path.join(folder, name), "w") as z:
        if text is not None:
            z.writestr(name[:-4] + ".csv", text)


def test_trade_archives_header_sniff_and_quarantine(spark):
    d = tempfile.mkdtemp(prefix="cw-zip-")
    _zip(d, "BTCUSDT-aggTrades-2024-01-01.zip",
         "agg_trade_id,price,quantity,first_trade_id,last_trade_id,transact_time,is_buyer_maker\n"
         "1,10.5,2,1,1,1704067200000,true\n2,11.0,1,2,2,1704067200001,False\n")
    _zip(d, "BTCUSDT-aggTrades-2024-01-02.zip", "3,12.0,1,3,3,1704153600000000,false\n")
    _zip(d, "BTCUSDT-aggTrades-2024-01-03.zip", None)
    with open(os.path.join(d, "BTCUSDT-aggTrades-2024-01-04.zip"), "wb") as f:
        f.write(b"garbage")
    good, bad = ingest(spark, d, "aggTrades", "future")
    rows = sorted(good.collect(), key=lambda r: r.agg_trade_id)
    assert [r.agg_trade_id for r in rows] == [1, 2, 3]
    assert rows[0].is_buyer_maker is True and rows[1].is_buyer_maker is False
    assert rows[0].is_best_match is False and rows[0].symbol == "BTCUSDT"
    assert rows[2].ts == 1704153600000000
    assert sorted(r.archive for r in bad.collect()) == ["BTCUSDT-aggTrades-2024-01-03.zip",
                                                         "BTCUSDT-aggTrades-2024-01-04.zip"]


def test_metrics_bad_time_quarantines_archive_and_bad_ratio_is_null(spark):
    d = tempfile.mkdtemp(prefix="cw-zip-")
    hdr = ("create_time,symbol,sum_open_interest,sum_open_interest_value,count_toptrader_long_short_ratio,"
           "sum_toptrader_long_short_ratio,count_long_short_ratio,sum_taker_long_short_vol_ratio\n")
    _zip(d, "BTCUSDT-metrics-2025-01-01.zip", hdr + "2025-01-01 00:05:00,BTCUSDT,1.5,,x,2,3,4\n")
    _zip(d, "BTCUSDT-metrics-2025-01-02.zip", hdr + "2025-13-01 00:05:00,BTCUSDT,1,1,1,1,1,1\n")
    good, bad = ingest(spark, d, "metrics", "future")
    g = good.collect()
    assert len(g) == 1 and g[0].sum_open_interest == 1.5
    assert g[0].sum_open_interest_value is None and g[0].count_toptrader_long_short_ratio is None
    assert [r.archive for r in bad.collect()] == ["BTCUSDT-metrics-2025-01-02.zip"]


def test_spot_funding_and_vol_index_archives(spark):
    d = tempfile.mkdtemp(prefix="cw-zip-")
    _zip(d, "ETHUSDT-aggTrades-2024-01.zip", "5,2.5,4,5,6,1704067200123,True,True\n")
    good, bad = ingest(spark, d, "aggTrades", "spot")
    r = good.collect()[0]
    assert (r.agg_trade_id, r.price, r.is_buyer_maker, r.is_best_match, r.ts) == (5, 2.5, True, True, 1704067200123000)
    assert r.archive_year == 2024 and bad.count() == 0

    f = tempfile.mkdtemp(prefix="cw-zip-")
    _zip(f, "BTCUSDT-fundingRate-2024-01.zip",
         "calc_time,funding_interval_hours,last_funding_rate\n1704067200000,8,0.0001\n")
    good, _ = ingest(spark, f, "fundingRate", "future")
    r = good.collect()[0]
    assert (r.symbol, r.funding_interval_hours, r.last_funding_rate) == ("BTCUSDT", 8, 0.0001)

    v = tempfile.mkdtemp(prefix="cw-zip-")
    _zip(v, "BTCBVOLUSDT-BVOLIndex-2024-01-01.zip",
         "calc_time,symbol,base_asset,quote_asset,index_value\n1704067200000,BTCBVOLUSDT,BTC,USDT,55.5\n")
    good, _ = ingest(spark, v, "BVOLIndex", "option")
    r = good.collect()[0]
    assert (r.symbol, r.base_asset, r.index_value) == ("BTCBVOLUSDT", "BTC", 55.5)


def test_validity_and_plan_rejects_bad_pairs(spark):
    import pytest
    from candlewright.plans.archive_plan import InvalidRequest, archive_plan, check_valid
    req = spark.createDataFrame([("spot", "metrics"), ("future", "metrics"), ("spot", "BVOLIndex"),
                                 ("option", "BVOLIndex"), ("option", "aggTrades")], "market string, data_type string")
    bad = sorted(tuple(r) for r in check_valid(req).collect())
    assert bad == [("option", "aggTrades"), ("spot", "BVOLIndex"), ("spot", "metrics")]
    starts = spark.createDataFrame([("X", None)], "symbol string, start_date date")
    with pytest.raises(InvalidRequest):
        archive_plan(starts, ["fundingRate"], "2024-01-01", market="spot")


def test_ingest_pipeline_metrics_newest_wins_and_full_refresh(spark):
    from candlewright.plans.ingest import ingest_archives
    from candlewright.plans.refresh import full_refresh
    from candlewright.session import shared_dir
    hdr = ("create_time,symbol,sum_open_interest,sum_open_interest_value,count_toptrader_long_short_ratio,"
           "sum_toptrader_long_short_ratio,count_long_short_ratio,sum_taker_long_short_vol_ratio\n")
    land = tempfile.mkdtemp(prefix="cw-land-")
    _zip(land, "BTCUSDT-metrics-2025-01-01.zip", hdr + "2025-01-01 00:05:00,BTCUSDT,1,1,1,1,1,1\n")
    store = shared_dir(spark, "t-metrics")
    ingest_archives(spark, land, store, "metrics", "future")
    # a re-published archive for the same day replaces the stored row (key: symbol, year, time)
    land2 = tempfile.mkdtemp(prefix="cw-land-")
    _zip(land2, "BTCUSDT-metrics-2025-01-01.zip", hdr + "2025-01-01 00:05:00,BTCUSDT,9,9,9,9,9,9\n")
    table, bad = ingest_archives(spark, land2, store, "metrics", "future")
    rows = table.collect()
    assert len(rows) == 1 and rows[0].sum_open_interest == 9.0 and bad.count() == 0

    trades = tempfile.mkdtemp(prefix="cw-land-")
    _zip(trades, "BTCUSDT-aggTrades-2024-01-01.zip",
         "1,10.0,1,1,1,1704067200000,false\n2,12.0,2,2,2,1704067260000,true\n")
    funding = tempfile.mkdtemp(prefix="cw-land-")
    _zip(funding, "BTCUSDT-fundingRate-2024-01.zip",
         "calc_time,funding_interval_hours,last_funding_rate\n1704067200000,8,0.0001\n")
    out = full_refresh(spark, {("future", "aggTrades"): trades, ("future", "fundingRate"): funding},
                       shared_dir(spark, "t-full"), intervals=("1m", "1h"))
    bars = {(r.interval, r.time.minute): r for r in out[("future", "klines")].collect()}
    assert bars[("1h", 0)].open == 10.0 and bars[("1h", 0)].close == 12.0 and bars[("1h", 0)].qty == 3.0
    assert len(bars) == 3
    assert out[("future", "fundingRate")][0].collect()[0].symbol == "BTCUSDT"


def test_every_declared_rule_refuses_its_archive(spark):
    """Empty and worded fields, short rows and missing columns, per type, with their place."""
    def bad(data_type, market, files):
        d = tempfile.mkdtemp(prefix="cw-zip-")
        for day, text in files.items():
            _zip(d, f"X-{data_type}-2024-01-{day:02d}.zip", text)
        good, q = ingest(spark, d, data_type, market)
        return ({r.archive[-6:-4]: (r.bad_rows, r.error, r.line, r.column) for r in q.collect()},
                {r.archive[-6:-4] for r in good.select("archive").distinct().collect()})

    ok = "1,2.0,3,1,1,1704067200000,true\n"
    got, kept = bad("aggTrades", "future", {
        1: ok, 2: ok + "2,,,2,2,1704067200001,true\n", 3: ok + "2,2.0,1,2,2,1704067200001\n", 4: "1,2.0,3,1,1,1704067200000\n",
        5: ok + ok.replace("2.0", "inf"), 6: ok * 3 + ok.replace("true", "maybe") + ok.replace("1704067200000", "noon"),
        7: "agg_trade_id,price,quantity,first_trade_id,last_trade_id,trade_time,is_buyer_maker\n" + ok,
        8: "agg_trade_id,price,first_trade_id,last_trade_id,transact_time,is_buyer_maker\n1,2.0,1,1,1704067200000,true\n"})
    assert kept == {"01", "07"} and got == {
        "02": (1, "parse error", 1, "price"), "03": (1, "parse error", 1, "is_buyer_maker"),
        "04": (1, "missing column: is_buyer_maker", None, None), "05": (1, "parse error", 1, "price"),
        "06": (2, "parse error", 3, "is_buyer_maker"), "08": (1, "missing column: quantity", None, None)}

    head = "calc_time,funding_interval_hours,last_funding_rate\n"
    got, kept = bad("fundingRate", "future", {
        1: head + "1704067200000,8,0.0001\n", 2: head + "1704067200000,8,0.0001\n1704067200001,8,oops\n",
        3: "calc_time,funding_interval_hours\n1704067200000,8\n", 4: head + ",8,0.1\n", 5: head + "1704067200000,8,nan\n"})
    assert kept == {"01"} and got == {
        "02": (1, "parse error", 1, "last_funding_rate"), "03": (1, "missing column: last_funding_rate", None, None),
        "04": (1, "parse error", 0, "calc_time"), "05": (1, "parse error", 0, "last_funding_rate")}

    head = "calc_time,symbol,base_asset,quote_asset,index_value\n"
    got, kept = bad("BVOLIndex", "option", {
        1: head + "1704067200000,BVOL,B,USDT,55.5\n", 2: head + "1704067200000,BVOL,B,USDT,\n", 3: head + "1704067200000,,B,USDT,5\n"})
    assert kept == {"01"} and {k: v[3] for k, v in got.items()} == {"02": "index_value", "03": "symbol"}

    spot = "5,2.5,4,5,6,1704067200123,True,True\n"
    got, kept = bad("aggTrades", "spot", {1: spot, 2: spot.replace("True,True", "True,"), 3: spot.replace("True,True", "True,eh")})
    assert kept == {"01", "02"} and got == {"03": (1, "parse error", 0, "is_best_match")}
