"""Plan-shape checks for the scale-relevant choices (see README, Design for scale)."""

import re

from pyspark.sql import functions as F

import __spark_entry__ as se

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_keep_last_limits_before_the_shuffle(spark):
    p = se.queries()["dedup_keep_last"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    partial = p.find("WindowGroupLimit")
    assert "Partial" in p and "Final" in p
    # the partial limit sits below (after, in the string) the exchange
    assert p.rfind("Partial") > p.find("Exchange hashpartitioning") > partial


def test_cascade_scans_ticks_once(spark):
    p = _plan(se.queries()["kline_cascade"](spark, SF))
    assert p.count("FileScan") == 1
    assert "SortAggregate" not in p


def test_trades_per_minute_scans_ticks_once(spark):
    df = se.queries()["trades_per_minute"](spark, SF)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # the gaps inside days and the seams read the exchange of the counts' branch; no window per symbol over minutes
    assert final.count("FileScan") == 1 and final.count("ReusedExchange") >= 1


def test_a_gap_of_years_is_filled_by_chunks(spark):
    import datetime as dt
    from candlewright.operators.quality import trades_per_minute
    t = spark.createDataFrame([("X", dt.datetime(2020, 1, 1, 0, 0, 30)), ("X", dt.datetime(2023, 1, 1)),
                               ("X", dt.datetime(2023, 1, 1, 0, 3)), (None, dt.datetime(2023, 1, 1))],
                              "symbol string, time timestamp_ntz")
    got = trades_per_minute(t, chunk=1000).groupBy("symbol").agg(
        F.count("*").alias("rows"), F.sum("n").alias("n"), F.countDistinct("time").alias("times")).collect()
    span = (dt.date(2023, 1, 1) - dt.date(2020, 1, 1)).days * 1440 + 4
    assert {r.symbol: (r.rows, r.n, r.times) for r in got} == {"X": (span, 3, span), None: (1, 1, 1)}


def test_id_check_exchanges_ids_once(spark):
    df = se.queries()["id_check_with_gaps"](spark, SF)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # both gap branches read the exchange of the spans' branch
    assert final.count("FileScan") == 1
    assert final.count("ReusedExchange") == final.count("REPARTITION_BY_COL") - 1 == 2


def test_no_cartesian_products_in_registered_queries(spark):
    bad = []
    for name, fn in se.QUERIES.items():
        if name.startswith(("stream_", "zip_", "ingest_", "upsert", "replace_", "refresh", "write_",
                            "bars_dedup", "payload", "symbol_list")):
            continue  # these write files first; their read-back plans are trivial
        p = fn(spark, SF)._jdf.queryExecution().executedPlan().toString()
        if re.search(r"CartesianProduct|BroadcastNestedLoopJoin", p):
            bad.append(name)
    assert not bad, bad


def test_footer_aggregate_is_pushed_to_parquet(spark):
    from candlewright.driver_queries import trades_T
    from candlewright.session import shared_dir
    from candlewright.sources import store as ST
    path = shared_dir(spark, "plan-footers")
    ST.write_table(trades_T(spark, SF), path)
    v1 = spark.conf.get("spark.sql.sources.useV1SourceList")
    try:
        spark.conf.set("spark.sql.sources.useV1SourceList",
                       ",".join(x for x in v1.split(",") if x != "parquet"))
        spark.conf.set("spark.sql.parquet.aggregatePushdown", "true")
        df = spark.read.parquet(path).groupBy("symbol", "year").agg(
            F.count(F.lit(1)), F.min("agg_trade_id"), F.max("ts"))
        p = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.sources.useV1SourceList", v1)
        spark.conf.unset("spark.sql.parquet.aggregatePushdown")
    assert "PushedAggregation: [COUNT(*), MIN(agg_trade_id), MAX(ts)]" in p
    # and the library helper returns the same numbers as a plain scan
    got = sorted(map(tuple, ST.footer_aggregate(spark, path, ["symbol", "year"],
                                                [F.max("ts").alias("m")]).collect()))
    want = sorted(map(tuple, ST.read_table(spark, path).groupBy("symbol", "year")
                      .agg(F.max("ts").alias("m")).collect()))
    assert got == want


def test_exact_all_intervals_is_one_scan_one_exchange(spark):
    p = _plan(se.queries()["kline_all_intervals"](spark, SF))
    assert p.count("FileScan") == 1
    assert p.count("Exchange hashpartitioning") == 1
    assert "SortAggregate" not in p
