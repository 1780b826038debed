"""Zipped CSV archives (S1-S6, S16) and a writer for the same layout.

Reading: Spark lists the archives (``binaryFile`` with the content column
pruned, so only paths travel), spreads them one per task, and each task opens
its archive through ``pyarrow.fs`` (local, HDFS or object store) and streams
the first CSV entry in bounded chunks through pandas' C parser. Fields leave
Python as strings; typing happens JVM-side with ``try_cast``
(:mod:`candlewright.operators.normalize`). A broken or empty archive yields
one error row; :func:`ingest` quarantines every archive with an error or a
bad value and lets the others through.
"""

from __future__ import annotations

import io
import os
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewright.functions import names as N
from candlewright.operators import normalize as NZ
from candlewright.session import shared_dir
from candlewright.schemas import (OPTIONAL_FIELDS, RAW_BVOL_COLUMNS, RAW_FUNDING_COLUMNS, RAW_FUTURES_TRADES,
                                  RAW_METRICS_COLUMNS, RAW_SPOT_TRADES,
                                  REQUIRED_FIELDS)

CHUNK_ROWS = 200_000

SPOT_TRADE_COLUMNS = tuple(f.name for f in RAW_SPOT_TRADES.fields)
FUTURES_TRADE_COLUMNS = tuple(f.name for f in RAW_FUTURES_TRADES.fields)


#: Compressed archive bytes per reading task.
TASK_BYTES = 32 << 20
def _wrong(c: str, kind: str, required: bool) -> Column:
    """A field that does not parse as its type, is not finite, or is empty where it must not be."""
    text = F.trim(F.coalesce(F.col(c), F.lit("")))
    if kind == "time":
        parsed = F.try_to_timestamp(F.col(c), F.lit(NZ.METRICS_TIME_FORMAT)).isNotNull()
    elif kind == "string":
        parsed = F.lit(True)
    else:
        v = F.col(c).try_cast(kind)
        parsed = v.isNotNull()
        if kind == "double":
            parsed = parsed & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))
    return F.when(text == "", F.lit(required)).otherwise(~parsed)


def field_rules(data_type: str, columns) -> list[tuple[str, Column]]:
    """The declared rules of a data type: ``(column, it is wrong)`` in column order."""
    rules = [(c, _wrong(c, kind, True)) for c, kind in REQUIRED_FIELDS[data_type]]
    return rules + [(c, _wrong(c, kind, False)) for c, kind in OPTIONAL_FIELDS.get(data_type, ()) if c in columns]


def first_wrong(rules: list[tuple[str, Column]]) -> Column:
    """Number of the first broken rule of a row, null if it breaks none."""
    return F.coalesce(*[F.when(bad, F.lit(i)) for i, (_, bad) in enumerate(rules)])


def judge_archives(flagged: DataFrame, rules: list[tuple[str, Column]], keys=("archive",)) -> DataFrame:
    """One row per bad archive: ``bad_rows``, the first bad ``line`` (from 0) and its ``column``,
    and ``error``. ``flagged`` has ``row``, ``error`` and ``_rule``. One aggregate of fixed-width
    buffers over bad rows only; an unreadable archive's single error row joins its text."""
    place = F.col("row") * F.lit(len(rules)) + F.col("_rule")
    bad = (flagged.filter(F.col("error").isNotNull() | F.col("_rule").isNotNull())
           .groupBy(*keys).agg(F.count(F.lit(1)).alias("bad_rows"), F.min(place).alias("_at")))
    errors = flagged.filter(F.col("error").isNotNull()).select(*keys, "error")
    names = F.array(*[F.lit(c) for c, _ in rules])
    line = F.floor(F.col("_at") / F.lit(len(rules)))
    column = F.element_at(names, (F.col("_at") - line * F.lit(len(rules)) + 1).cast("int"))
    return (bad.join(errors, list(keys), "left")
            .select(*keys, "bad_rows", F.coalesce("error", F.lit("parse error")).alias("error"),
                    line.alias("line"), F.when(F.col("_at").isNotNull(), column).alias("column")))


def raw_columns(data_type: str, market: str) -> tuple[str, ...]:
    if data_type in ("aggTrades", "trades"):
        return FUTURES_TRADE_COLUMNS if market == "future" else SPOT_TRADE_COLUMNS
    return {"metrics": RAW_METRICS_COLUMNS, "fundingRate": RAW_FUNDING_COLUMNS,
            "BVOLIndex": RAW_BVOL_COLUMNS}[data_type]


def _raw_schema(cols) -> str:
    return ", ".join([f"`{c}` string" for c in cols] + ["archive string", "row long", "error string"])


def _fs_path(path: str):
    from pyarrow import fs as pafs
    if path.startswith("file:") and not path.startswith("file://"):
        path = "file://" + path[len("file:"):]
    if "://" not in path:
        return pafs.LocalFileSystem(), os.path.abspath(path)
    return pafs.FileSystem.from_uri(path)


class _ArrowSeekable(io.RawIOBase):
    """Seekable file view over a pyarrow input file (zipfile seeks from the end)."""

    def __init__(self, f):
        self._f = f

    def readable(self):
        return True

    def seekable(self):
        return True

    def tell(self):
        return self._f.tell()

    def seek(self, offset, whence=io.SEEK_SET):
        if whence == io.SEEK_END:
            offset += self._f.size()
        elif whence == io.SEEK_CUR:
            offset += self._f.tell()
        return self._f.seek(max(0, offset))

    def readinto(self, b):
        data = self._f.read(len(b))
        n = len(data)
        b[:n] = data
        return n


def _open_input(path: str):
    from pyarrow import fs as pafs
    fs, p = _fs_path(path)
    if isinstance(fs, pafs.LocalFileSystem):
        return open(p, "rb")
    return io.BufferedReader(_ArrowSeekable(fs.open_input_file(p)))


def _always_header(data_type: str) -> bool:
    return data_type in ("metrics", "fundingRate", "BVOLIndex")


def _archive_rows(path: str, cols, data_type: str, chunk_rows: int) -> Iterator[pd.DataFrame]:
    name = path.rsplit("/", 1)[-1]
    needed = [c for c, _ in REQUIRED_FIELDS[data_type]]

    def err(msg):
        return pd.DataFrame({**{c: [None] for c in cols}, "archive": [name], "row": [None], "error": [msg]})

    try:
        with _open_input(path) as raw:
            zf = zipfile.ZipFile(raw)
            entries = zf.infolist()
            if not entries:
                yield err("empty archive")
                return
            with zf.open(entries[0]) as entry:
                buf = io.BufferedReader(entry)
                first = buf.peek(1)[:1]
                has_header = _always_header(data_type) or (first.isalpha() if first else False)
                reader = pd.read_csv(buf, header=0 if has_header else None, dtype=str,
                                     keep_default_na=False, chunksize=chunk_rows)
                start = 0
                for chunk in reader:
                    if has_header:
                        chunk.columns = [str(c).strip() for c in chunk.columns]
                        if "transact_time" in cols and "transact_time" not in chunk.columns:
                            # the first header with "time" in it is the trade time
                            time = next((c for c in chunk.columns if "time" in c), None)
                            chunk = chunk.rename(columns={time: "transact_time"})
                        missing = [c for c in needed if c not in chunk.columns]
                        if missing:
                            yield err(f"missing column: {', '.join(missing)}")
                            return
                        out = pd.DataFrame({c: chunk[c] if c in chunk.columns else None for c in cols})
                    else:
                        width = min(len(cols), chunk.shape[1])
                        missing = [c for c in needed if c in cols[width:]]
                        if missing:
                            yield err(f"missing column: {', '.join(missing)}")
                            return
                        out = pd.DataFrame({c: chunk.iloc[:, i] if i < width else None
                                            for i, c in enumerate(cols)})
                    n = len(out)
                    out["archive"] = name
                    out["row"] = range(start, start + n)
                    out["error"] = None
                    start += n
                    yield out
    except Exception as e:  # a bad archive is reported, the job goes on
        yield err(f"{type(e).__name__}: {e}")


def list_archives(spark: SparkSession, path: str) -> DataFrame:
    """``(path, file_name, length, modified)`` of every ``*.zip`` under ``path`` (content not read)."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", "*.zip")
            .option("recursiveFileLookup", "true").load(path)
            .select("path", F.element_at(F.split("path", "/"), -1).alias("file_name"), "length",
                    F.col("modificationTime").alias("modified")))


def read_archives(spark: SparkSession, path: str, data_type: str = "aggTrades",
                  market: str = "spot", chunk_rows: int = CHUNK_ROWS,
                  selected: DataFrame | None = None) -> DataFrame:
    """Raw string rows of every ``*.zip`` under ``path``.

    Columns: the raw CSV columns for (data type, market), ``archive`` (file
    name), ``row`` (line index in the archive), ``error`` (null when fine).
    Headers are matched by name; headerless trade files (first byte not a
    letter) are positional.
    """
    cols = raw_columns(data_type, market)
    files = list_archives(spark, path)
    if selected is not None:
        files = files.join(selected.select("file_name"), "file_name", "left_semi")
    # tasks follow the archives' bytes (round robin, so no hash group decides the run time)
    size = files.agg(F.sum("length")).first()[0] or 0
    files = files.select("path").repartition(max(spark.sparkContext.defaultParallelism,
                                                 -(-size // TASK_BYTES)))

    def parse(batches):
        for pdf in batches:
            for p in pdf["path"]:
                yield from _archive_rows(p, cols, data_type, chunk_rows)

    return files.mapInPandas(parse, _raw_schema(cols))


def ingest(spark: SparkSession, path: str, data_type: str = "aggTrades", market: str = "spot",
           chunk_rows: int = CHUNK_ROWS, selected: DataFrame | None = None, stage: bool = True):
    """S1-S6 + P1-P10 + S16: (canonical rows, quarantine).

    Rows carry ``symbol`` and ``archive_year`` parsed from the archive name
    (P15) plus ``archive`` and ``row`` lineage, which orders keep-last merges.
    An archive is dropped whole when it cannot be read, lacks a required column, or has a row
    that breaks a declared rule (:data:`candlewright.schemas.REQUIRED_FIELDS`); the quarantine
    has one ``(archive, bad_rows, error, line, column)`` row for it.

    With ``stage`` (default) the typed rows are written once as Parquet under
    the shared folder and everything downstream reads that, so the archives
    are unzipped and parsed exactly once however often the result is used.
    """
    raw = read_archives(spark, path, data_type, market, chunk_rows, selected)
    meta = N.parse_archive_name(F.col("archive"))
    rules = field_rules(data_type, raw.columns)
    raw = raw.withColumns({"_sym": meta["symbol"], "archive_year": meta["year"],
                           "_rule": F.when(F.col("error").isNull(), first_wrong(rules))})
    keep = ("archive", "row", "archive_year", "error", "_rule")
    if data_type in ("aggTrades", "trades"):
        typed = NZ.normalize_trades(raw.withColumnRenamed("_sym", "symbol"), keep=("symbol", *keep))
    elif data_type == "metrics":
        typed = NZ.normalize_metrics(raw, keep=keep).drop("_bad")
    elif data_type == "fundingRate":
        typed = NZ.normalize_funding(raw, keep=keep).withColumn("symbol", meta["symbol"])
    else:
        typed = NZ.normalize_bvol(raw, keep=keep)
    if stage:
        staged = shared_dir(spark, "ingest_stage")
        typed.write.parquet(staged)
        typed = spark.read.parquet(staged)
    bad_archives = judge_archives(typed, rules)
    good = typed.join(bad_archives.select("archive"), "archive", "left_anti").drop("_rule", "error")
    return good, bad_archives


# ---------------------------------------------------------------- writer

def write_archives(df: DataFrame, out_dir: str, data_type: str = "aggTrades",
                   columns: tuple[str, ...] = FUTURES_TRADE_COLUMNS, header_col: str | None = None,
                   order: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` as daily ``SYMBOL-type-YYYY-MM-DD.zip`` archives (one CSV each).

    ``df`` needs ``symbol``, ``day`` (date) and the CSV ``columns`` (cast to
    string as written). Rows are clustered by (symbol, day) and streamed into
    the zip by the task that owns the group, so no group is materialised.
    ``header_col`` (boolean column) asks for a header line per archive; lines follow ``order``.
    Returns ``(archive, rows)`` per written file.
    """
    hdr = F.col(header_col) if header_col else F.lit(False)
    cols = [f"f{i}" for i in range(len(columns))]      # a CSV field may be called symbol too
    by = [f"o{i}" for i in range(len(order))]
    rows = (df.select("symbol", F.col("day").cast("date").alias("day"), hdr.alias("_hdr"),
                      *[F.col(c).cast("string").alias(f) for f, c in zip(cols, columns)],
                      *[F.col(c).alias(o) for o, c in zip(by, order)])
            .repartition("symbol", "day").sortWithinPartitions("symbol", "day", *by).drop(*by))

    def write(batches):
        state = {"key": None, "zf": None, "entry": None, "stream": None, "n": 0, "name": None}

        def close():
            if state["zf"] is not None:
                state["entry"].close()
                state["zf"].close()
                state["stream"].close()
                out = pd.DataFrame({"archive": [state["name"]], "rows": [state["n"]]})
                state.update(zf=None, entry=None, stream=None, n=0)
                return out
            return None

        for pdf in batches:
            for (sym, day), g in pdf.groupby(["symbol", "day"], sort=False):
                if state["key"] != (sym, day):
                    done = close()
                    if done is not None:
                        yield done
                    name = f"{sym}-{data_type}-{pd.Timestamp(day).strftime('%Y-%m-%d')}.zip"
                    fs, p = _fs_path(out_dir.rstrip("/") + "/" + name)
                    fs.create_dir(p.rsplit("/", 1)[0], recursive=True)
                    stream = fs.open_output_stream(p)
                    zf = zipfile.ZipFile(stream, "w", compression=zipfile.ZIP_DEFLATED)
                    entry = zf.open(name[:-4] + ".csv", "w", force_zip64=True)
                    if bool(g["_hdr"].iloc[0]):
                        entry.write((",".join(columns) + "\n").encode())
                    state.update(key=(sym, day), zf=zf, entry=entry, stream=stream, name=name)
                state["entry"].write(g[cols].to_csv(header=False, index=False).encode())
                state["n"] += len(g)
        done = close()
        if done is not None:
            yield done

    return rows.mapInPandas(write, "archive string, rows long")
