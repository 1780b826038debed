"""Stored tables: Parquet sink and scans (S7, S8, S10-S13), year upsert.

Layout: one table per data type, partitioned by ``symbol`` and ``year``
(path parts of the reference become columns), ZSTD compressed, rows sorted by
``(time, agg_trade_id)`` inside each file.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewright.session import shared_dir
from candlewright.functions.timecols import ntz_to_micros
from candlewright.operators.merge import (dedup_keep_first, dedup_keep_last, merge_keep_last,
                                          replace_month, ts_literal)
from candlewright.sources.swap import Folder, Swap, recover

PARTITIONS = ("symbol", "year")
#: Rows of a stored file, and the time buckets (hours) a partition may be cut into.
ROWS_PER_FILE = 4_000_000
BUCKET_HOURS = (1, 4, 24, 24 * 7, 24 * 31, 24 * 366)


def with_year(df: DataFrame, time_col: str = "time") -> DataFrame:
    """The year partition column comes from the row's own time."""
    return df.withColumn("year", F.year(time_col))


def with_time_parts(df: DataFrame, partition_cols: Sequence[str], time_col: str = "time") -> DataFrame:
    """Add the ``year`` / ``month`` partition columns a layout asks for."""
    if "year" in partition_cols and "year" not in df.columns:
        df = df.withColumn("year", F.year(time_col))
    if "month" in partition_cols and "month" not in df.columns:
        df = df.withColumn("month", F.month(time_col))
    return df


def time_layout(rows: DataFrame, partition_cols: Sequence[str], rows_per_file: int,
                time_col: str = "time") -> DataFrame:
    """Per partition the widest time bucket (``_hours``) of at most ``rows_per_file`` rows,
    and into how many parts (``_parts``) an hour that alone holds more is salted.

    ``rows`` needs the partition columns and the time only. Counts shrink map-side to one row
    per partition and hour.
    """
    hour = F.floor(ntz_to_micros(time_col) / F.lit(3_600_000_000))
    counts = (rows.groupBy(*partition_cols, hour.alias("_h")).agg(F.count(F.lit(1)).alias("_n"))
              .repartition(*partition_cols))          # every step below keeps this partitioning
    size = (counts.select(*partition_cols, "_h", "_n", F.explode(F.array(*map(F.lit, BUCKET_HOURS))).alias("_w"))
            .groupBy(*partition_cols, "_w", F.floor(F.col("_h") / F.col("_w")).alias("_b")).agg(F.sum("_n").alias("_n"))
            .groupBy(*partition_cols, "_w").agg(F.max("_n").alias("_n")))
    return size.groupBy(*partition_cols).agg(
        F.coalesce(F.max(F.when(F.col("_n") <= rows_per_file, F.col("_w"))), F.lit(1)).alias("_hours"),
        F.ceil(F.min("_n") / F.lit(rows_per_file)).alias("_parts"))


def lay_out(df: DataFrame, layout: DataFrame | None, partition_cols: Sequence[str],
            order: Sequence[str], tasks: int | None = None) -> DataFrame:
    """One exchange by (partition, time bucket, salt), sorted inside each task. ``layout``
    (one row per touched partition, a written table) is broadcast only if Spark finds it small;
    without one every partition is one bucket. ``tasks``: into how many tasks whole partitions are
    dealt (None: as the session says)."""
    order = [c for c in order if c in df.columns]
    dealt = () if tasks is None else (tasks,)
    if layout is None:
        return df.repartition(*dealt, *partition_cols).sortWithinPartitions(*partition_cols, *order)
    named = layout.select(*[F.col(c).alias(f"_of_{c}") for c in partition_cols], "_hours", "_parts")
    same = reduce(lambda a, b: a & b, [df[c].eqNullSafe(named[f"_of_{c}"]) for c in partition_cols])
    hour = F.floor(ntz_to_micros(order[0]) / F.lit(3_600_000_000))
    keyed = df.join(named, same).select(
        *df.columns, F.floor(hour / F.col("_hours")).alias("_bucket"),
        F.pmod(F.xxhash64(*order), F.col("_parts")).alias("_salt"))
    return (keyed.repartition(*partition_cols, "_bucket", "_salt")
            .sortWithinPartitions(*partition_cols, *order).drop("_bucket", "_salt"))


def write_tasks(rows: int, files: int, rows_per_file: int, cores: int) -> int | None:
    """Tasks of a write of ``rows`` rows in at least ``files`` files: four for each file, so that few
    files share a task, whatever the session's number of shuffle partitions is. Many small
    partitions share tasks: no more than eight for each core or four for each ``rows_per_file`` rows.
    None, Spark's own choice, if all rows would fit into one file."""
    if rows <= rows_per_file:
        return None
    return 4 * min(files, max(-(-rows // rows_per_file), 2 * cores))


def _write_swap(swap: Swap, df: DataFrame, counted: DataFrame, order: Sequence[str], compression: str,
                rows_per_file: int) -> None:
    """Write the partitions of ``df`` into the run and swap them in. ``counted`` has the partition
    columns and times of (at least) the rows of ``df``."""
    layout = None
    largest, rows, files = (n or 0 for n in counted.groupBy(*swap.cols).count().agg(
        F.max("count"), F.sum("count"), F.sum(F.ceil(F.col("count") / F.lit(rows_per_file)))).first())
    if largest > rows_per_file:
        time_layout(counted, swap.cols, rows_per_file, order[0]).write.parquet(swap.folder("layout"))
        layout = swap.spark.read.parquet(swap.folder("layout"))
    tasks = write_tasks(rows, files, rows_per_file, swap.spark.sparkContext.defaultParallelism)
    (lay_out(df, layout, swap.cols, order, tasks).write
     .option("compression", compression).option("maxRecordsPerFile", rows_per_file)
     .partitionBy(*swap.cols).parquet(swap.folder("data")))
    swap.commit()


def replace_partitions(spark: SparkSession, new: DataFrame, path: str, merge, *,
                       partition_cols: Sequence[str] = PARTITIONS, order: Sequence[str] = ("time", "agg_trade_id"),
                       compression: str = "zstd", read_stored: bool = True, staged: bool = False,
                       rows_per_file: int = ROWS_PER_FILE) -> None:
    """Replace the partitions that ``new`` touches by ``merge(stored rows of them or None, new)``.

    ``new`` is evaluated once (``staged``: it is a written table already); only folders of
    touched partitions are listed and read, null values included; nothing else of the table
    is looked at. The merge is evaluated once, straight into the swap.
    """
    recover(spark, path, partition_cols)
    swap = Swap(spark, path, partition_cols)
    new = with_time_parts(new, partition_cols)
    if not staged:
        new = swap.stage(new)
    stored = None
    if read_stored and table_exists(spark, path):
        stored = read_partitions(spark, path, swap.touched(new))
    counted = new.select(*partition_cols, order[0])
    if stored is not None:
        counted = counted.unionByName(stored.select(*partition_cols, order[0]))
    _write_swap(swap, merge(stored, new), counted, order, compression, rows_per_file)


def write_table(df: DataFrame, path: str, partition_cols: Sequence[str] = PARTITIONS,
                order: Sequence[str] = ("time", "agg_trade_id"), compression: str = "zstd",
                staged: bool = False, rows_per_file: int = ROWS_PER_FILE) -> None:
    """S8 + T1: partitioned, sorted, ZSTD Parquet; replaces the partitions present in ``df``."""
    replace_partitions(df.sparkSession, df, path, lambda _, new: new, partition_cols=partition_cols, order=order,
                       compression=compression, read_stored=False, staged=staged, rows_per_file=rows_per_file)


def read_table(spark: SparkSession, path: str, with_file: bool = False) -> DataFrame:
    """Scan a stored table; partition filters prune directories.

    ``with_file`` adds the file name and path (lineage labels, P23).
    """
    df = spark.read.option("pathGlobFilter", "*.parquet").parquet(path)
    # partition type inference is off (a numeric-looking symbol stays a string)
    for part in ("year", "month"):
        if part in df.columns:
            df = df.withColumn(part, F.col(part).cast("int"))
    if with_file:
        df = df.select("*", F.col("_metadata.file_name").alias("file_name"),
                       F.col("_metadata.file_path").alias("file_path"))
    return df


def table_exists(spark: SparkSession, path: str) -> bool:
    """A table with data: the folder holds a partition folder or data file (entries that are
    not data begin with ``_`` or ``.``)."""
    return bool(Folder(spark, path).names())


@contextmanager
def staged(df: DataFrame, name: str):
    """``df`` written once to the shared folder and read back; the folder goes when the block ends well."""
    spark, path = df.sparkSession, shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    yield spark.read.schema(df.schema).parquet(path)
    parent, _, leaf = path.rpartition("/")
    Folder(spark, parent).remove(leaf)


def read_partitions(spark: SparkSession, path: str, dirs: Sequence[str]) -> DataFrame | None:
    """The stored rows of the given partition folders (those that exist), and of no others."""
    table = Folder(spark, path)
    found = [table.at(d) for d in dirs if table.exists(d)]
    if not found:
        return None
    df = spark.read.option("basePath", path).option("pathGlobFilter", "*.parquet").parquet(*found)
    return df.withColumns({c: F.col(c).cast("int") for c in ("year", "month") if c in df.columns})


def upsert(spark: SparkSession, new: DataFrame, path: str, keys: Sequence[str],
           order: Sequence = (), partition_cols: Sequence[str] = PARTITIONS, staged: bool = False) -> DataFrame:
    """Merge ``new`` into the stored table at ``path``, newest wins.

    Reads and rewrites the touched partitions only (:func:`replace_partitions`), named one by
    one, so far-apart or null partitions bring in nothing between them, and swaps them in by
    renames, so a killed write leaves the old or the new rows (:mod:`candlewright.sources.swap`).

    Among copies in ``new`` the last by ``order`` wins; without an order that is
    (``archive``, ``row``) when ``new`` has them, else all its other columns, so
    the winner never depends on the run.

    With ``partition_cols=("symbol", "year", "month")`` a daily increment
    rewrites one month instead of the whole year (keys should then include
    ``month`` too: re-published archives repeat ids within the same month).
    """
    lineage = tuple(c for c in ("archive", "row") if c in new.columns)

    def merge(stored: DataFrame | None, new: DataFrame) -> DataFrame:
        by = tuple(order) or lineage or tuple(c for c in new.columns if c not in keys)
        if stored is None:
            return dedup_keep_last(new, keys, by)
        return merge_keep_last(stored.select(*new.columns), new, keys, by)

    replace_partitions(spark, new, path, merge, partition_cols=partition_cols, staged=staged)
    return read_table(spark, path) if table_exists(spark, path) else new.limit(0)


def replace_month_in_store(spark: SparkSession, new_month: DataFrame, path: str, year: int, month: int,
                           partition_cols: Sequence[str] = PARTITIONS) -> DataFrame:
    """A monthly archive replaces that month of the stored partitions of its symbols.

    A store with a ``month`` partition column swaps the month folders and reads no stored row;
    a store by year keeps the other months of the touched (symbol, year) partitions.
    """
    t = F.col("time")
    fresh = new_month.filter((F.year(t) == year) & (F.month(t) == month))
    by_month = "month" in partition_cols

    def merge(stored: DataFrame | None, new: DataFrame) -> DataFrame:
        return new if stored is None else replace_month(stored.select(*new.columns), new, year, month)

    replace_partitions(spark, fresh, path, merge, partition_cols=partition_cols, read_stored=not by_month)
    return read_table(spark, path)


def load_bars(spark: SparkSession, path: str, start=None, end=None,
              keys: Sequence[str] = ("symbol", "interval")) -> DataFrame:
    """Bars over a time range from many files; duplicate ``time`` keeps
    the row of the first file by name (F1 + D3)."""
    df = read_table(spark, path, with_file=True)
    if start is not None:
        df = df.filter(F.col("time") >= ts_literal(start))
    if end is not None:
        df = df.filter(F.col("time") <= ts_literal(end))
    return dedup_keep_first(df, [*keys, "time"], ["file_path"]).drop("file_name", "file_path")


def footer_aggregate(spark: SparkSession, path: str, keys: Sequence[str], aggs) -> DataFrame:
    """Grouped ``count``/``min``/``max`` of a stored table from Parquet footers.

    Grouping by partition columns lets the DataSource V2 Parquet reader answer
    the aggregates from row-group statistics (``PushedAggregation``) without
    reading column data. The V2 reader and the pushdown are switched on only
    while the small result (one row per group) is materialised with a
    checkpoint; the session settings are then restored. Only numeric, date
    and boolean columns qualify (not timestamps). If the footers cannot
    answer (files without statistics), an ordinary aggregate over the scan
    gives the same result.
    """
    v1 = spark.conf.get("spark.sql.sources.useV1SourceList", "")
    conf = {"spark.sql.sources.useV1SourceList": ",".join(
                x for x in v1.split(",") if x.strip().lower() != "parquet"),
            "spark.sql.parquet.aggregatePushdown": "true"}
    saved = {k: spark.conf.get(k, None) for k in conf}
    out = None
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        out = spark.read.parquet(path).groupBy(*keys).agg(*aggs).checkpoint(eager=True)
    except Exception as e:
        # only files written without statistics are answered by a scan; anything else is a failure
        if not re.search(r"statistics|No min/max|num nulls", str(e), re.I):
            raise
        out = None
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    if out is None:
        out = spark.read.parquet(path).groupBy(*keys).agg(*aggs)
    for part in ("year", "month"):
        if part in keys:
            out = out.withColumn(part, F.col(part).cast("int"))
    return out


FOOTERS = "path string, rows long, low long, high long, state string"


def file_footers(spark: SparkSession, path: str, column: str, files_per_task: int = 64) -> DataFrame:
    """Per Parquet file of a table: ``rows``, the smallest and largest value of a whole-number
    column by row-group statistics, and a ``state``: ``ok``, ``empty``, ``no column``, ``no statistics``
    or ``unreadable: <error>``. One distributed pass that opens footers only; a broken
    file is a row, not a failure. Only paths are listed (file contents stay unread)."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true")
             .load(path).select("path"))

    def footer(name: str) -> tuple:
        from urllib.parse import quote

        import pyarrow.parquet as pq

        from candlewright.sources.archives import _fs_path
        try:
            fs, p = _fs_path(quote(name, safe=":/"))     # Spark's paths are plain, pyarrow takes URIs
            with fs.open_input_file(p) as f:
                meta = pq.ParquetFile(f).metadata
        except Exception as e:
            return name, 0, None, None, f"unreadable: {type(e).__name__}"
        names = [meta.schema.column(i).path for i in range(meta.num_columns)]
        if column not in names:
            return name, meta.num_rows, None, None, "no column"
        if not meta.num_rows:
            return name, 0, None, None, "empty"
        at = names.index(column)
        stats = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups) if meta.row_group(g).num_rows]
        if any(x is None or not x.has_min_max for x in stats):
            return name, meta.num_rows, None, None, "no statistics"
        return name, meta.num_rows, min(x.min for x in stats), max(x.max for x in stats), "ok"

    def task(batches):
        import pandas as pd
        for b in batches:
            yield pd.DataFrame([footer(p) for p in b["path"]], columns=["path", "rows", "low", "high", "state"]).astype(
                {"rows": "int64", "low": "Int64", "high": "Int64"})

    n = max(1, -(-files.count() // files_per_task))
    return files.repartition(n).mapInPandas(task, FOOTERS)


def discover_symbols(df: DataFrame) -> DataFrame:
    """Symbols present in a stored table, skipping names starting with '_'."""
    return df.select("symbol").distinct().filter(~F.col("symbol").startswith("_"))

