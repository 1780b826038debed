"""Property check: Spark bars equal a brute-force pandas computation on random trades."""

import datetime as dt
import math

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from candlewright.operators.bars import klines

T0 = dt.datetime(2024, 1, 1)

trade = st.tuples(
    st.integers(min_value=0, max_value=400),          # seconds after T0 (ties are common)
    st.sampled_from([0, 1, 999_999]),                 # microseconds
    st.integers(min_value=1, max_value=5000),         # price in cents
    st.integers(min_value=0, max_value=50),           # quantity
    st.sampled_from([True, False, None]),             # maker
)


def brute(rows, width):
    df = pd.DataFrame(rows, columns=["agg_trade_id", "time", "price", "quantity", "is_buyer_maker"])
    df = df.sort_values(["time", "agg_trade_id"])
    df["bucket"] = df["time"].dt.floor(f"{width}s")
    out = {}
    for b, g in df.groupby("bucket"):
        m = g["is_buyer_maker"]
        buyer = g.loc[m == False, "quantity"].sum()  # noqa: E712
        seller = g.loc[m == True, "quantity"].sum()  # noqa: E712
        out[b.to_pydatetime()] = (g["price"].iloc[0], g["price"].max(), g["price"].min(), g["price"].iloc[-1],
                                  g["quantity"].sum(), buyer, seller)
    return out


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(trade, min_size=1, max_size=40), st.sampled_from([60, 180, 3600]))
def test_bars_match_brute_force(spark, trades, width):
    rows = [(i, T0 + dt.timedelta(seconds=s, microseconds=us), p / 100.0, float(q), mk)
            for i, (s, us, p, q, mk) in enumerate(reversed(trades))]   # ids not in time order
    df = spark.createDataFrame(rows, "agg_trade_id long, time timestamp_ntz, price double, quantity double, "
                                     "is_buyer_maker boolean").selectExpr("'X' AS symbol", "*")
    interval = {60: "1m", 180: "3m", 3600: "1h"}[width]
    got = {r.time: r for r in klines(df, interval).collect()}
    want = brute(rows, width)
    assert set(got) == set(want)
    for t, (o, h, lo, c, q, b, s) in want.items():
        r = got[t]
        assert (r.open, r.high, r.low, r.close) == (o, h, lo, c)
        assert math.isclose(r.qty, q) and math.isclose(r.buyer_qty, b) and math.isclose(r.seller_qty, s)
        if q == 0:
            assert math.isnan(r.avg_price)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(min_value=0, max_value=300), min_size=1, max_size=60),
       st.integers(min_value=1, max_value=50))
def test_id_gaps_match_brute_force(spark, ids, bucket):
    from candlewright.operators.quality import id_gaps
    df = spark.createDataFrame([("X", 2024, i) for i in ids], "symbol string, year int, agg_trade_id long")
    u = sorted(set(ids))
    want = sorted((a, b, b - a - 1) for a, b in zip(u, u[1:]) if b - a > 1)
    got = sorted(tuple(r) for r in id_gaps(df, bucket=bucket).select("prev_id", "next_id", "missing").collect())
    assert got == want


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(trade, min_size=1, max_size=40))
def test_cascade_from_1s_equals_exact(spark, trades):
    from candlewright.operators.bars import cascade, klines_all_intervals
    rows = [(i, T0 + dt.timedelta(seconds=s, microseconds=us), p / 100.0, float(q), mk)
            for i, (s, us, p, q, mk) in enumerate(trades)]
    df = spark.createDataFrame(rows, "agg_trade_id long, time timestamp_ntz, price double, quantity double, "
                                     "is_buyer_maker boolean").selectExpr("'X' AS symbol", "*")
    ivs = ("1s", "1m", "5m", "1h")
    a = sorted(klines_all_intervals(df, ivs, decimals=6, zero_qty="null").collect())
    b = sorted(cascade(df, ivs, decimals=6, zero_qty="null").collect())
    assert a == b
