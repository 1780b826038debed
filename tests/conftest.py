import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from candlewright.session import get_session
    s = get_session("local[*]", shuffle_partitions=8, extra={
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="cw-test-ckpt-"),
    })
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def trades(spark, rows, with_symbol=True):
    """rows: (id, 'YYYY-MM-DD HH:MM:SS[.ffffff]', price, qty, maker)"""
    from pyspark.sql import functions as F
    df = spark.createDataFrame(rows, "agg_trade_id long, t string, price double, quantity double, "
                                     "is_buyer_maker boolean")
    df = df.withColumn("time", F.to_timestamp_ntz("t")).drop("t")
    if with_symbol:
        df = df.withColumn("symbol", F.lit("X"))
    return df
