"""Length-delimited binary records of token ids, with a separate offset index.

A shard file is a run of records, each framed as

    length (u64) | masked crc32 of the 8 length bytes (u32) | payload | masked crc32 of the payload (u32)

little-endian. The payload is doc_id (i64), flags (u8: 1 = the id is null, 2 = 32-bit
ids) and the ids (u16 while the vocabulary fits, else u32). A mask rotates a checksum
right by 15 bits and adds a constant, so that a checksum of data that holds checksums
stays useful. The index file beside a shard has one entry per record, ``doc_id (i64),
offset (u64), length (u64), ids (u64)``, so any record is found by one seek: reads in
shuffled order need no scan.

Shards cover ascending id ranges (null first, then id, then a hash of the text), so
reading them in shard order gives the documents in ascending order. Bounds come from
approximate quantiles of the ids alone; texts are tokenized once, where they are read,
and 16-bit ids are shuffled. A writer task names its files by a fresh id and reports
them in a manifest committed by Spark: files of lost or repeated attempts are never
listed.

Defined results. A null or empty text is only ``end_id``. Repeated rows are written
once each. Every read checks lengths and checksums and fails on a damaged file. An
empty table gives an empty manifest and no rows.
"""

from __future__ import annotations

import math
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candlewright.llm.textops import chunks, stage
from candlewright.llm.tokens import encoder
from candlewright.session import shared_dir

SHARD_BYTES = 32 << 20
#: Fixed value: added to a rotated checksum.
MASK_DELTA = 0xA282EAD8
HEAD, PAYLOAD, INDEX = struct.Struct("<QI"), struct.Struct("<qB"), struct.Struct("<qQQQ")
MANIFEST = "shard int, path string, index_path string, n_records long, n_ids long, bytes long"


def masked(data: bytes) -> int:
    c = zlib.crc32(data)
    return ((c >> 15 | c << 17) + MASK_DELTA) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: bytes, wide: bool) -> bytes:
    payload = PAYLOAD.pack(doc_id or 0, (doc_id is None) | wide << 1) + ids
    size = len(payload).to_bytes(8, "little")
    return size + masked(size).to_bytes(4, "little") + payload + masked(payload).to_bytes(4, "little")


def entry(doc_id: int | None, at: int, size: int, n_ids: int) -> bytes:
    return INDEX.pack(doc_id or 0, at, size, n_ids)


def unframe(buf: bytes, at: int) -> tuple[int | None, np.ndarray, int]:
    """(doc_id, ids, end) of the record at ``at``; raises on any damage."""
    if len(buf) - at < 12:
        raise ValueError("truncated record header")
    size, crc = HEAD.unpack_from(buf, at)
    if masked(bytes(buf[at:at + 8])) != crc:
        raise ValueError("damaged record length")
    end = at + 12 + size + 4
    if end > len(buf):
        raise ValueError("truncated record")
    payload = bytes(buf[at + 12:end - 4])
    if masked(payload) != int.from_bytes(buf[end - 4:end], "little"):
        raise ValueError("damaged record")
    doc_id, flags = PAYLOAD.unpack_from(payload)
    ids = np.frombuffer(payload, "<u4" if flags & 2 else "<u2", offset=PAYLOAD.size)
    return (None if flags & 1 else doc_id), ids, end


def _open(path: str):
    return pafs.FileSystem.from_uri(path if ":" in path else "file://" + path)


def _ids(vocab: str, end_id: int, bounds: list[int]):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocab)
        kind = "<u4" if enc.wide else "<u2"
        edges = np.array(bounds, np.int64)
        for b, data, off in chunks(batches, "text"):
            ids, at = enc.encode(data, off)
            end = np.array([end_id], kind)
            raw = [np.concatenate([ids[at[i]:at[i + 1]].astype(kind), end]).tobytes() for i in range(b.num_rows)]
            key = pc.fill_null(b.column("doc_id"), -(1 << 63)).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.searchsorted(edges, key, "left").astype(np.int32)), b.column("doc_id"), b.column("h"),
                 pa.array([enc.wide] * b.num_rows), pa.array(raw, pa.binary())],
                ["shard", "doc_id", "h", "wide", "ids"])
    return task


def _write(folder: str):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def close():
            out.close()
            with fs.open_output_stream(base + ".idx") as f:
                f.write(b"".join(index))
            return pa.RecordBatch.from_pylist([{
                "shard": shard, "path": uri + ".rec", "index_path": uri + ".idx", "n_records": len(index),
                "n_ids": n_ids, "bytes": at}], schema)

        schema = pa.schema([("shard", pa.int32()), ("path", pa.string()), ("index_path", pa.string()),
                            ("n_records", pa.int64()), ("n_ids", pa.int64()), ("bytes", pa.int64())])
        shard, out = None, None
        for b in batches:
            for s, doc_id, wide, ids in zip(*(b.column(c).to_pylist() for c in ("shard", "doc_id", "wide", "ids"))):
                if s != shard:
                    if out is not None:
                        yield close()
                    shard, index, n_ids, at = s, [], 0, 0
                    uri = f"{folder}/shard-{s:08d}-{uuid.uuid4().hex}"
                    fs, base = _open(uri)
                    fs.create_dir(base.rpartition("/")[0], recursive=True)
                    out = fs.open_output_stream(base + ".rec")
                rec = frame(doc_id, ids, wide)
                n = len(ids) // (4 if wide else 2)
                index.append(entry(doc_id, at, len(rec), n))
                out.write(rec)
                at, n_ids = at + len(rec), n_ids + n
        if out is not None:
            yield close()
    return task


def write_records(docs: DataFrame, vocab: str, folder: str | None = None, *, end_id: int = 1,
                  doc_id: str = "doc_id", text: str = "text", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Encode and write ``docs``; the manifest: one row per shard file, by ascending ids."""
    spark = docs.sparkSession
    folder = folder or shared_dir(spark, "records")
    d = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    # about one 2-byte id per 3 bytes of text
    size = d.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, math.ceil(size * 2 / 3 / shard_bytes))
    bounds = []
    if shards > 1:
        q = [i / shards for i in range(1, shards)]
        bounds = sorted(set(d.agg(F.percentile_approx("doc_id", q, 50 * shards)).first()[0] or []))
    ids = (d.withColumn("h", F.xxhash64("text"))
           .mapInArrow(_ids(vocab, end_id, bounds), "shard int, doc_id long, h long, wide boolean, ids binary")
           .repartition(len(bounds) + 1, "shard").sortWithinPartitions("shard", "doc_id", "h"))
    return stage(ids.mapInArrow(_write(folder), MANIFEST), "manifest")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole shard files in their order; memory holds one file."""
    for b in batches:
        for r in b.to_pylist():
            fs, path = _open(r["path"])
            with fs.open_input_stream(path) as f:
                buf = f.read()
            at, start, rows = 0, r["start"], []
            while at < len(buf):
                doc_id, ids, at = unframe(buf, at)
                rows.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                start += len(ids)
            if len(rows) != r["n_records"]:
                raise ValueError(f"{r['path']}: {len(rows)} records, {r['n_records']} written")
            cols = list(zip(*rows))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols],
                                             ["doc_id", "start", "n_tokens", "ids_crc32"])


def read_records(manifest: DataFrame) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before it), ``n_tokens``, ``ids_crc32``
    of every record, read back from the files; one task per shard file."""
    n = max(1, manifest.count())
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    at = manifest.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    return (at.select("path", "n_records", "start").repartition(n)
            .mapInArrow(_read, "doc_id long, start long, n_tokens long, ids_crc32 long"))


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for r in b.to_pylist():
            fs, path = _open(r["index_path"])
            with fs.open_input_stream(path) as f:
                e = list(INDEX.iter_unpack(f.read()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r["path"]] * len(e)), pa.array([x[1] for x in e], pa.int64()),
                 pa.array([x[2] for x in e], pa.int64())], ["path", "at", "size"])


def _seek(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    files: dict[str, pa.NativeFile] = {}
    for b in batches:
        rows = []
        for r in b.to_pylist():
            if r["path"] not in files:
                fs, path = _open(r["path"])
                files[r["path"]] = fs.open_input_file(path)
            doc_id, ids, _ = unframe(files[r["path"]].read_at(r["size"], r["at"]), 0)
            rows.append((r["rank"], doc_id, ids.astype(np.int64)))
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[0] for x in rows], pa.int64()), pa.array([x[1] for x in rows], pa.int64()),
             pa.array([x[2] for x in rows], pa.list_(pa.int64()))], ["rank", "doc_id", "ids"])
    for f in files.values():
        f.close()


def read_shuffled(spark: SparkSession, manifest: DataFrame, seed: int, tasks: int) -> DataFrame:
    """Every record in an order fixed by ``seed`` (column ``rank`` ascending in each of
    ``tasks`` partitions): index entries are shuffled, payloads are read by seeks."""
    e = manifest.select("path", "index_path").mapInArrow(_entries, "path string, at long, size long")
    e = e.withColumn("rank", F.xxhash64(F.lit(seed), "path", "at"))
    return (e.repartition(tasks, "rank").sortWithinPartitions("rank")
            .mapInArrow(_seek, "rank long, doc_id long, ids array<long>"))
