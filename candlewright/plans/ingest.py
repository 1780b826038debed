"""Archive folder -> stored yearly tables (the convert phase, SURVEY 3.1).

select archives (F4) -> unzip on executors (S1-S6) -> normalise (P1-P10) ->
quarantine bad archives (S16) -> newest-wins upsert into (symbol, year)
partitions (D2, D4, S8). One shuffle for the merge, on the full dedup key.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewright.functions import names as N
from candlewright.plans import ledger as LG
from candlewright.plans.archive_plan import InvalidRequest, select_archives
from candlewright.schemas import DEDUP_KEY, VALID_MARKET_TYPES
from candlewright.sources.archives import ingest, list_archives
from candlewright.sources.store import read_table, staged, table_exists, upsert
from candlewright.sources.swap import recover

QUARANTINE = "archive string, bad_rows long, error string, line long, column string"


def ingest_archives(spark: SparkSession, landing: str, store: str, data_type: str = "aggTrades",
                    market: str = "future", start_date: str | None = None,
                    partition_cols: tuple[str, ...] = ("symbol", "year")):
    """Convert the archives in ``landing`` into the table at ``store``.

    Within one run the later archive by name wins (daily files sort after the
    monthly file of the same month), then the later line; stored rows lose to
    any new row with the same key. Returns ``(table, quarantine)``.

    ``partition_cols`` is the store layout; the dedup key is the partition
    columns plus the data type's key (``agg_trade_id`` or ``time``).
    """
    table, quarantine, _ = convert(spark, landing, store, data_type, market, start_date, partition_cols, resume=False)
    return table, quarantine


def convert(spark: SparkSession, landing: str, store: str, data_type: str = "aggTrades", market: str = "future",
            start_date: str | None = None, partition_cols: tuple[str, ...] = ("symbol", "year"),
            resume: bool = True, before_upsert: Callable[[DataFrame], None] | None = None) -> tuple[DataFrame | None, DataFrame, DataFrame | None]:
    """``(table, quarantine, days)``: as :func:`ingest_archives`, and the (symbol, day) pairs that
    got rows (None if nothing was converted).

    With ``resume`` only archives that the store's ledger does not list as they are now are
    opened (:mod:`candlewright.plans.ledger`); a run with nothing to do opens none and writes
    nothing. ``before_upsert`` gets the days first. The table is None while the store has no rows.
    """
    if (market, data_type) not in VALID_MARKET_TYPES:
        raise InvalidRequest(f"{data_type} is not available on {market}")
    recover(spark, store, partition_cols)      # what a killed run stored counts before anything is selected
    files = list_archives(spark, landing)
    name = N.parse_archive_name(F.col("file_name"))
    unnamed = files.filter(name["daily"].isNull()).select(
        F.col("file_name").alias("archive"), F.lit(0).cast("long").alias("bad_rows"),
        F.lit("unrecognised archive name").alias("error"), F.lit(None).cast("long").alias("line"),
        F.lit(None).cast("string").alias("column"))

    def stored() -> DataFrame | None:
        return read_table(spark, store) if table_exists(spark, store) else None

    selected = select_archives(files.select("file_name", "length", "modified"), start_date)
    if resume:
        last = F.when(F.col("daily"), F.col("archive_date")).otherwise(F.last_day("archive_date"))
        selected = selected.select("file_name", "length", "modified", name["symbol"].alias("symbol"),
                                   last.alias("last_day"))
        with staged(LG.pending(spark, selected, store, start_date is not None), "pending") as selected:
            if selected.isEmpty():
                return stored(), unnamed, None
            quarantine, days = _convert(spark, landing, store, data_type, market, partition_cols, selected, before_upsert)
            LG.record(selected, quarantine, store)
    else:
        quarantine, days = _convert(spark, landing, store, data_type, market, partition_cols, selected, before_upsert)
    return stored(), quarantine.unionByName(unnamed), days


def _convert(spark, landing, store, data_type, market, partition_cols, selected, before_upsert):
    rows, quarantine = ingest(spark, landing, data_type, market, selected=selected)
    if "symbol" not in rows.columns:
        rows = rows.withColumn("symbol", F.lit(None).cast("string"))
    rows = rows.drop("archive_year")
    days = rows.select("symbol", F.to_date("time").alias("day")).distinct()
    if before_upsert is not None:
        before_upsert(days)
    upsert(spark, rows, store, (*partition_cols, DEDUP_KEY[data_type]), order=("archive", "row"),
           partition_cols=partition_cols)
    return quarantine, days
