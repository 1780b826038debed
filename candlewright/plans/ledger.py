"""Ledger of converted archives: which archives a refresh still has to open.

``<store>/_ledger`` holds one row per archive and conversion: name, length, modification
time, symbol and status (``ok`` or ``bad``). Readers of the store skip the folder. It is
appended after the store's partitions are swapped in, so a refresh that is killed between
the two converts those archives again, which changes nothing (the upsert is idempotent).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewright.operators.coverage import coverage_stored, start_dates
from candlewright.sources.store import read_table, table_exists
from candlewright.sources.swap import Folder

LEDGER = "_ledger"


def read_ledger(spark: SparkSession, store: str) -> DataFrame | None:
    """The latest entry of every archive, or None without a ledger."""
    folder = Folder(spark, store)
    if not folder.exists(LEDGER):
        return None
    entry = F.struct("converted", "length", "modified", "symbol", "status")
    return (spark.read.parquet(folder.at(LEDGER)).groupBy("file_name")
            .agg(F.max(entry).alias("e")).select("file_name", "e.*"))


def stored_starts(spark: SparkSession, store: str, symbols: DataFrame) -> DataFrame:
    """G6 per symbol: the day after its last stored day, else the default start. A trade store
    answers from Parquet footers."""
    if not table_exists(spark, store):
        empty = spark.createDataFrame([], "symbol string, last_date date")
        return start_dates(symbols, None, coverage=empty)
    table = read_table(spark, store)
    if "ts" in table.columns:
        return start_dates(symbols, None, coverage=coverage_stored(spark, store))
    return start_dates(symbols, table)


def pending(spark: SparkSession, files: DataFrame, store: str, explicit_start: bool) -> DataFrame:
    """The archives to convert, of selected ``files`` (``file_name``, ``length``, ``modified``,
    ``symbol``, ``last_day``).

    An archive that the ledger knows with the same length and modification time is done,
    whatever its year; a republished one is converted again. An archive the ledger does not
    know is converted if the ledger knows its symbol (a late archive of any date counts) or,
    where only the store knows it, if it reaches the symbol's resume date.
    """
    ledger = read_ledger(spark, store)
    if ledger is not None:
        files = files.join(ledger.select("file_name", "length", "modified"), ["file_name", "length", "modified"],
                           "left_anti")
    if explicit_start:
        return files
    known = (ledger.select("symbol").distinct() if ledger is not None
             else spark.createDataFrame([], "symbol string")).withColumn("_known", F.lit(True))
    starts = stored_starts(spark, store, files.select("symbol").distinct()).select("symbol", "start_date")
    return (files.join(known, "symbol", "left").join(starts, "symbol", "left")
            .filter(F.col("_known") | (F.col("last_day") >= F.col("start_date"))).drop("_known", "start_date"))


def record(files: DataFrame, quarantine: DataFrame, store: str) -> None:
    """Append converted ``files``; those in the quarantine as ``bad``."""
    bad = quarantine.select(F.col("archive").alias("file_name"), F.lit("bad").alias("status"))
    (files.join(bad, "file_name", "left")
     .select("file_name", "length", "modified", "symbol", F.coalesce("status", F.lit("ok")).alias("status"),
             F.current_timestamp().alias("converted"))
     .coalesce(1).write.mode("append").parquet(Folder(files.sparkSession, store).at(LEDGER)))
