"""Partition replacement: what it reads, what a killed write leaves, how files are laid out."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from candlewright.session import shared_dir
from candlewright.sources import store as ST
from candlewright.sources import swap as SW

KEYS = ("symbol", "year", "agg_trade_id")
SCHEMA = "symbol string, agg_trade_id long, time timestamp_ntz, price double"


def rows(spark, *data):
    return spark.createDataFrame([(s, i, dt.datetime(y, 3, 1, i % 24), p) for s, i, y, p in data], SCHEMA)


def content(spark, path):
    return sorted(((r.symbol or "", r.year, r.agg_trade_id, r.price) for r in ST.read_table(spark, path).collect()))


def spy(monkeypatch):
    """Partition folders that a replacement reads."""
    seen, real = [], ST.read_partitions

    def read(spark, path, dirs):
        df = real(spark, path, dirs)
        seen.append(sorted({f.split("/symbol=")[1].rsplit("/", 1)[0] for f in df.inputFiles()}) if df is not None else [])
        return df
    monkeypatch.setattr(ST, "read_partitions", read)
    return seen


def test_null_partitions_keep_their_rows(spark):
    path = shared_dir(spark, "t-null")
    ST.upsert(spark, rows(spark, ("A", 1, 2020, 1.0), (None, 1, 2020, 2.0)), path, KEYS)
    ST.upsert(spark, rows(spark, ("A", 2, 2020, 3.0), (None, 2, 2020, 4.0), (None, 1, 2020, 5.0)), path, KEYS)
    assert content(spark, path) == [("", 2020, 1, 5.0), ("", 2020, 2, 4.0), ("A", 2020, 1, 1.0), ("A", 2020, 2, 3.0)]


def test_far_apart_partitions_read_nothing_between(spark, monkeypatch):
    path = shared_dir(spark, "t-far")
    ST.upsert(spark, rows(spark, *[(s, 1, y, 1.0) for s in ("A", "M", "Z") for y in range(2018, 2023)]), path, KEYS)
    seen = spy(monkeypatch)
    ST.upsert(spark, rows(spark, ("A", 2, 2018, 2.0), ("Z", 2, 2022, 2.0), ("Z", 2, 2030, 2.0)), path, KEYS)
    assert seen == [["A/year=2018", "Z/year=2022"]]
    assert len(content(spark, path)) == 18


def test_micro_batches_and_ingests_read_touched_partitions_only(spark, monkeypatch):
    from candlewright.plans.ingest import ingest_archives
    from candlewright.streaming.bars import read_trade_stream, upsert_stream
    from tests.test_ingest import _zip
    path, src, ck = (shared_dir(spark, n) for n in ("t-mb", "t-mb-src", "t-mb-ck"))
    ST.upsert(spark, rows(spark, *[(s, 1, y, 1.0) for s in ("A", "B") for y in (2020, 2021)]), path, KEYS)
    rows(spark, ("B", 7, 2021, 2.0)).write.parquet(src)
    seen = spy(monkeypatch)
    upsert_stream(read_trade_stream(spark, src, SCHEMA), path, KEYS, ck)
    assert seen == [["B/year=2021"]]

    landing, store = os.path.join(shared_dir(spark, "t-land")), shared_dir(spark, "t-ingest")
    os.makedirs(landing)
    for sym, day, ms in (("AAA", "2023-05-01", 1682899200000), ("BBB", "2024-01-01", 1704067200000)):
        _zip(landing, f"{sym}-aggTrades-{day}.zip", f"1,2.0,1,1,1,{ms},true\n")
    ingest_archives(spark, landing, store, "aggTrades", "future")
    _zip(landing, "BBB-aggTrades-2024-01-02.zip", "2,2.0,1,2,2,1704153600000,true\n")
    seen.clear()
    ingest_archives(spark, landing, store, "aggTrades", "future", start_date="2024-01-02")
    assert seen == [["BBB/year=2024"]]


@pytest.mark.parametrize("stop", range(5))
def test_a_killed_write_leaves_old_or_new(spark, monkeypatch, stop):
    """Stopped at every rename in turn; the next write, or recover, finishes what was complete."""
    path = shared_dir(spark, "t-kill")
    ST.upsert(spark, rows(spark, ("A", 1, 2020, 1.0), ("B", 1, 2020, 1.0), ("C", 1, 2020, 1.0)), path, KEYS)
    real, moves = SW.Folder.move, []

    def move(self, source, target):
        if len(moves) == stop:
            raise KeyboardInterrupt
        moves.append(source)
        real(self, source, target)
    monkeypatch.setattr(SW, "THREADS", 1)
    monkeypatch.setattr(SW.Folder, "move", move)
    with pytest.raises(KeyboardInterrupt):
        ST.upsert(spark, rows(spark, ("A", 1, 2020, 9.0), ("B", 2, 2020, 9.0), ("D", 1, 2020, 9.0)), path, KEYS)
    monkeypatch.setattr(SW.Folder, "move", real)
    if stop == 0:   # nothing moved yet: readers still see the old table
        assert content(spark, path) == [(s, 2020, 1, 1.0) for s in "ABC"]
    assert len(SW.recover(spark, path, ("symbol", "year"))) == 1
    assert content(spark, path) == [("A", 2020, 1, 9.0), ("B", 2020, 1, 1.0), ("B", 2020, 2, 9.0), ("C", 2020, 1, 1.0),
                                    ("D", 2020, 1, 9.0)]
    assert SW.Folder(spark, path).names("_swap") == []


def test_a_write_killed_before_it_is_complete_changes_nothing(spark, monkeypatch):
    path = shared_dir(spark, "t-half")
    ST.upsert(spark, rows(spark, ("A", 1, 2020, 1.0)), path, KEYS)
    monkeypatch.setattr(SW.Swap, "commit", lambda self: (_ for _ in ()).throw(KeyboardInterrupt))
    with pytest.raises(KeyboardInterrupt):
        ST.upsert(spark, rows(spark, ("A", 1, 2020, 9.0)), path, KEYS)
    monkeypatch.undo()
    assert content(spark, path) == [("A", 2020, 1, 1.0)]
    ST.upsert(spark, rows(spark, ("A", 2, 2020, 3.0)), path, KEYS)       # drops the unfinished run
    assert content(spark, path) == [("A", 2020, 1, 1.0), ("A", 2020, 2, 3.0)]
    assert SW.Folder(spark, path).names("_swap") == []


def test_input_is_evaluated_once_and_stages_are_removed(spark):
    path, seen = shared_dir(spark, "t-once"), spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    new = rows(spark, *[("AB"[i % 2], i, 2020 + i % 3, float(i)) for i in range(300)])
    ST.upsert(spark, new.mapInArrow(counted, SCHEMA), path, KEYS)
    assert seen.value == 300
    ST.upsert(spark, new.mapInArrow(counted, SCHEMA), path, KEYS)
    assert seen.value == 600 and len(content(spark, path)) == 300
    ST.write_table(new.mapInArrow(counted, SCHEMA), path)
    assert seen.value == 900 and len(content(spark, path)) == 300
    assert SW.Folder(spark, path).names("_swap") == []


def test_hot_partitions_are_cut_into_files_with_narrow_times(spark):
    path = shared_dir(spark, "t-hot")
    hot = spark.range(20_000).select(
        F.lit("HOT").alias("symbol"), F.col("id").alias("agg_trade_id"),
        F.expr("TIMESTAMP_NTZ'2024-01-01' + make_dt_interval(0, 0, id div 20, 0)").alias("time"), F.rand(1).alias("price"))
    tied = spark.range(5_000).select(   # more rows at one instant than a file may hold
        F.lit("TIED").alias("symbol"), F.col("id").alias("agg_trade_id"),
        F.expr("TIMESTAMP_NTZ'2024-05-05 05:05:05'").alias("time"), F.rand(2).alias("price"))
    cold = rows(spark, ("COLD", 1, 2024, 1.0), (None, 1, 2024, 1.0))
    ST.write_table(hot.unionByName(tied).unionByName(cold), path, rows_per_file=1_500)
    got = ST.read_table(spark, path, with_file=True).groupBy("symbol", "file_path").agg(
        F.count("*").alias("n"), F.min("time").alias("lo"), F.max("time").alias("hi")).collect()
    assert sum(r.n for r in got) == 25_002 and max(r.n for r in got) <= 1_500
    files = sorted((r.lo, r.hi) for r in got if r.symbol == "HOT")
    assert len(files) >= 14 and all(b >= a for (_, a), (b, _) in zip(files, files[1:]))   # no overlap
    assert sum(r.symbol == "TIED" for r in got) >= 4
    layout = ST.time_layout(hot.unionByName(tied).withColumn("year", F.lit(2024)), ("symbol", "year"), 1_500)
    assert {r.symbol: (r["_hours"], r["_parts"]) for r in layout.collect()} == {"HOT": (1, 1), "TIED": (1, 4)}


def test_month_layout_swaps_a_month_without_reading_the_store(spark, monkeypatch):
    cols = ("symbol", "year", "month")
    path = shared_dir(spark, "t-month")
    base = spark.createDataFrame([(s, m, dt.datetime(2024, m, 5), 1.0) for s in ("A", "B", None) for m in (2, 3, 4)], SCHEMA)
    ST.write_table(base, path, cols)
    new = spark.createDataFrame([(s, 100, dt.datetime(2024, m, 9), 2.0) for s in ("A", None) for m in (3, 4)], SCHEMA)
    monkeypatch.setattr(ST, "read_partitions", lambda *a: pytest.fail("reads stored rows"))
    out = ST.replace_month_in_store(spark, new, path, 2024, 3, cols)
    got = sorted((r.symbol or "", r.month, r.agg_trade_id) for r in out.collect())
    assert got == sorted((s, m, 100 if m == 3 and s != "B" else m) for s in ("A", "B", "") for m in (2, 3, 4))


def test_odd_partition_values_and_empty_increments(spark):
    path = shared_dir(spark, "t-odd")
    odd = ["a/b", "x=y", "50%", "ü €", "_hid", ".dot", "sp ace", "A:B"]
    ST.upsert(spark, rows(spark, *[(s, 1, 2020, 1.0) for s in odd]), path, KEYS)
    ST.upsert(spark, rows(spark, *[(s, 2, 2020, 2.0) for s in odd]), path, KEYS)
    assert content(spark, path) == sorted((s, 2020, i, float(i)) for s in odd for i in (1, 2))
    before = content(spark, path)
    ST.upsert(spark, rows(spark, ("A", 1, 2020, 1.0)).limit(0), path, KEYS)
    assert content(spark, path) == before
    assert ST.upsert(spark, rows(spark, ("A", 1, 2020, 1.0)).limit(0), shared_dir(spark, "t-none"), KEYS).count() == 0


def test_footers_note_every_broken_file(spark):
    import pyarrow as pa
    import pyarrow.parquet as pq

    from candlewright.operators.quality import id_span_files
    path = shared_dir(spark, "t-foot")
    ST.write_table(rows(spark, ("A", 5, 2024, 1.0), ("A", 9, 2024, 1.0), ("x=y/50%+", 7, 2024, 1.0), (None, 1, 2024, 1.0)), path)
    ids = pa.table({"agg_trade_id": pa.array([1, 2, 4], pa.int64())})
    broken = {"B": lambda f: open(f, "wb").write(b"not parquet"), "C": lambda f: pq.write_table(ids.slice(0, 0), f),
              "D": lambda f: pq.write_table(ids, f, write_statistics=False),
              "E": lambda f: pq.write_table(ids.rename_columns(["other"]), f), "F": lambda f: pq.write_table(ids, f, row_group_size=1)}
    for s, write in broken.items():
        os.makedirs(f"{path}/symbol={s}/year=2024")
        write(f"{path}/symbol={s}/year=2024/part-0.parquet")
    got = {r.symbol: (r.year, r["count"], r.start_id, r.end_id, r.gap_count, r.note) for r in id_span_files(spark, path).collect()}
    assert got.pop("B")[-1].startswith("unreadable: ")
    assert got == {"A": (2024, 2, 5, 9, 3, ""), "x=y/50%+": (2024, 1, 7, 7, 0, ""), None: (2024, 1, 1, 1, 0, ""),
                   "C": (2024, 0, 0, 0, 0, "empty"), "D": (2024, 0, 0, 0, 0, "no statistics"),
                   "E": (2024, 0, 0, 0, 0, "no column"), "F": (2024, 3, 1, 4, 1, "")}


def test_large_writes_are_dealt_by_their_files_not_by_the_session(spark, monkeypatch):
    """Before, all buckets of a write shared the session's shuffle partitions (8 here)."""
    assert ST.write_tasks(1000, 3, 1000, 4) is None                  # Spark's choice if one file holds all
    assert ST.write_tasks(216_000_000, 70, 4_000_000, 12) == 4 * 54  # by rows
    assert ST.write_tasks(12_000_000, 21, 4_000_000, 12) == 4 * 21   # by files
    assert ST.write_tasks(12_000_000, 9000, 4_000_000, 12) == 4 * 24  # many small partitions share tasks
    seen, real = [], ST.lay_out

    def lay_out(*a):
        out = real(*a)
        seen.append(out._jdf.queryExecution().optimizedPlan().toString())
        return out
    monkeypatch.setattr(ST, "lay_out", lay_out)
    path = shared_dir(spark, "t-dealt")
    df = spark.range(4000).select(F.concat(F.lit("A"), F.col("id") % 40).alias("symbol"), F.col("id").alias("agg_trade_id"), F.timestamp_add(
        "HOUR", F.col("id").cast("int"), F.lit(dt.datetime(2020, 1, 1)).cast("timestamp_ntz")).alias("time"), F.lit(1.0).alias("price"))
    ST.write_table(df, path, rows_per_file=100)
    cores = spark.sparkContext.defaultParallelism
    assert f"], {4 * min(40, max(40, 2 * cores))}\n" in seen[0]      # RepartitionByExpression [...], n
    assert sorted(r.agg_trade_id for r in ST.read_table(spark, path).collect()) == list(range(4000))


def test_dedup_sorts_by_the_finest_key_first(spark):
    from candlewright.operators.merge import dedup_keep_first, dedup_keep_last
    df = rows(spark, ("A", 1, 2020, 1.0), ("A", 1, 2020, 2.0), (None, 1, 2020, 3.0), (None, 1, 2020, 4.0))
    for f, want in ((dedup_keep_last, [2.0, 4.0]), (dedup_keep_first, [1.0, 3.0])):
        out = f(df, ("symbol", "agg_trade_id"), ["price"])
        assert sorted(r.price for r in out.collect()) == want
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Sort [agg_trade_id" in plan and "Sort [symbol" not in plan
