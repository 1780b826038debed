"""Driver tables viewed as market data (the test and bench fixtures).

* ``T`` - ``events`` as trades: microsecond times, sparse bars.
* ``L`` - ``lineitem`` as trades: seven years, heavy time ties, duplicate ids.
* ``O`` - ``orders`` as a dense id sequence.

Each view is a projection over the whole table, so Spark prunes the scan to
the columns used.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewright.functions.timecols import ntz_to_micros

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def trades_T(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_type").alias("symbol"),
        F.col("event_id").alias("agg_trade_id"),
        F.col("ts").alias("time"),
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").cast("double").alias("quantity"),
        F.col("event_id").alias("first_trade_id"),
        F.col("event_id").alias("last_trade_id"),
        (F.col("user_id") % 2 == 1).alias("is_buyer_maker"),
        F.lit(False).alias("is_best_match"),
        ntz_to_micros(F.col("ts")).alias("ts"),
    )


def trades_L(spark: SparkSession, sf_dir: str, with_order: bool = False) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    cols = [
        F.col("l_returnflag").alias("symbol"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("agg_trade_id"),
        F.col("l_shipdate").alias("time"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_orderkey").alias("first_trade_id"),
        F.col("l_orderkey").alias("last_trade_id"),
        (F.col("l_linestatus") == "F").alias("is_buyer_maker"),
        F.lit(False).alias("is_best_match"),
        ntz_to_micros(F.col("l_shipdate")).alias("ts"),
    ]
    if with_order:
        cols += [F.col("l_partkey").alias("_p"), F.col("l_suppkey").alias("_s")]
    return li.select(*cols)


def trades_O(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderstatus").alias("symbol"),
        F.col("o_orderkey").alias("agg_trade_id"),
        F.col("o_orderdate").alias("time"),
        F.col("o_totalprice").alias("price"),
        F.lit(1.0).alias("quantity"),
        F.col("o_orderkey").alias("first_trade_id"),
        F.col("o_orderkey").alias("last_trade_id"),
        (F.col("o_orderkey") % 2 == 1).alias("is_buyer_maker"),
        F.lit(False).alias("is_best_match"),
        ntz_to_micros(F.col("o_orderdate")).alias("ts"),
    )


# SQL twins of the views, for DuckDB oracles
T_SQL = """SELECT event_type AS symbol, event_id AS agg_trade_id, ts AS time, value AS price,
  CAST(json_extract_string(props, '$.k') AS DOUBLE) AS quantity,
  (user_id % 2 = 1) AS is_buyer_maker FROM events"""

L_SQL = """SELECT l_returnflag AS symbol, l_orderkey * 10 + l_linenumber AS agg_trade_id,
  l_shipdate AS time, l_extendedprice AS price, l_quantity AS quantity,
  (l_linestatus = 'F') AS is_buyer_maker, l_partkey AS _p, l_suppkey AS _s FROM lineitem"""

O_SQL = """SELECT o_orderstatus AS symbol, o_orderkey AS agg_trade_id, o_orderdate AS time,
  o_totalprice AS price, CAST(1.0 AS DOUBLE) AS quantity, (o_orderkey % 2 = 1) AS is_buyer_maker FROM orders"""
