"""Near-duplicates by ProbMinHash, banding and exact verification.

Shingles are ``shingle`` consecutive words. Every shingle is a Poisson process: its hash
drives exponential waiting times at the rate of its weight, and each arrival falls on one
of ``bands * rows`` registers; a register keeps the shingle with the earliest arrival. Two
texts agree in a register with their probability Jaccard. The search uses registers of
weight 1, where this is the Jaccard of the shingle sets that links are verified by, so
repeats inside a text hide no link. Registers of weight ``1 + log2(count)`` give each
link the estimate ``weighted``, which counts repeats and decides nothing. A process stops as soon as its time passes the latest
register (early termination), so most shingles cost one arrival. All texts of a chunk
run together in numpy rounds.

Texts with the same shingle set are one class from the start (a digest; no pairs). Of
each set one representative is banded: ``bands`` keys of ``rows`` registers. In every
bucket each member is paired with one leader only, the member that meets most others
over all its buckets (an original rather than one of its copies); pairs are verified
by the exact Jaccard of their shingle sets (``>= similarity``), and verified pairs give
components. Buckets that still hold several components are finished in blocks:
registers are compared across components inside a task, only pairs whose sizes allow
the similarity, that the registers
estimate within three standard errors of the limit and that their shingle hashes confirm
leave it, and they are verified like the others.
So a group of thousands of copies costs one pair per member, while no link between
different components of a bucket is lost.

Defined results. Rows without words are linked to nothing and are a class each. Texts
of fewer than ``shingle`` words have one shingle, the whole text. Rows with equal
shingle sets are one class; a shared doc_id alone joins nothing. The class id is the smallest
key in the class: the doc_id, or a hash where that is null or shared by different texts.
Extra columns do not matter. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlewright.llm.graph import connected_components
from candlewright.llm.textops import Words, chunks, mix64, roll, stage

#: Members of one bucket compared at a time.
BLOCK = 2048


def shingle_sets(data: np.ndarray, off: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of every document: (document, hash, count), by document and hash."""
    w = Words(data, off)
    h = w.hashes()
    doc = w.doc()
    at = np.arange(len(h))
    full = at[at + k <= w.off[doc + 1]] if len(h) else at
    sh, sdoc = roll(h, k, 0x5411, full), doc[full]
    short = np.flatnonzero((w.n_words > 0) & (w.n_words < k))
    if len(short):  # the whole text is one shingle
        whole = np.zeros(len(short), np.uint64)
        for j in range(k):
            has = w.n_words[short] > j
            whole[has] = mix64(whole[has] * np.uint64(31) + h[w.off[short[has]] + j])
        sh, sdoc = np.concatenate([sh, whole]), np.concatenate([sdoc, short])
    order = np.lexsort([sh, sdoc])
    sh, sdoc = sh[order], sdoc[order]
    first = np.flatnonzero(np.concatenate(([True], (sh[1:] != sh[:-1]) | (sdoc[1:] != sdoc[:-1])))[: len(sh)])
    return sdoc[first], sh[first], np.diff(np.append(first, len(sh)))


def probminhash(doc: np.ndarray, item: np.ndarray, weight: np.ndarray, n_docs: int, m: int) -> np.ndarray:
    """``n_docs x m`` registers: the item with the earliest arrival (0: no items)."""
    least = np.full(n_docs * m, np.inf)
    owner = np.zeros(n_docs * m, np.uint64)
    time = np.zeros(len(item))
    base = mix64(item ^ np.uint64(0x5EED))
    live = np.arange(len(item))
    step = 0
    while len(live):
        step += 1
        r = mix64(base[live] + np.uint64(step * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        u = ((r >> np.uint64(11)).astype(np.float64) + 1.0) / (1 << 53)
        time[live] -= np.log(u) / weight[live]
        slot = doc[live] * m + (mix64(r) % np.uint64(m)).astype(np.int64)
        t = time[live]
        better = t < least[slot]
        s, t, i = slot[better], t[better], item[live][better]
        np.minimum.at(least, s, t)
        won = least[s] == t
        owner[s[won]] = i[won]
        last = least.reshape(n_docs, m).max(axis=1)
        live = live[time[live] < last[doc[live]]]
    return owner.reshape(n_docs, m)


def _sketch(k: int, bands: int, rows: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, data, off in chunks(batches, "text"):
            n = b.num_rows
            doc, item, _ = shingle_sets(data, off, k)
            reg = probminhash(doc, item, np.ones(len(item)), n, bands * rows)
            d1, d2 = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
            np.add.at(d1, doc, mix64(item))
            np.add.at(d2, doc, mix64(item ^ np.uint64(0xD16E57)))
            size = np.bincount(doc, minlength=n)
            key = np.zeros((n, bands), np.uint64)
            for j in range(rows):
                key = mix64(key + reg[:, j::rows]) if j else mix64(reg[:, 0::rows] + np.arange(bands, dtype=np.uint64))
            keys = pa.FixedSizeListArray.from_arrays(pa.array(key.view(np.int64).ravel()), bands).cast(
                pa.list_(pa.int64()))
            low = np.ascontiguousarray(mix64(reg).astype(np.uint8))
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("doc_id"), pa.array(d1.view(np.int64)), pa.array(d2.view(np.int64)),
                 pa.array(size.astype(np.int64)), keys, pa.array([r.tobytes() for r in low], pa.binary())],
                ["id", "doc_id", "d1", "d2", "n_shingles", "keys", "registers"])
    return task


def _sets(k: int, m: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, data, off in chunks(batches, "text"):
            doc, item, count = shingle_sets(data, off, k)
            low = mix64(probminhash(doc, item, 1 + np.log2(count), b.num_rows, m)).astype(np.uint16)
            at = np.searchsorted(doc, np.arange(b.num_rows + 1))
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array([item[s:e].tobytes() for s, e in zip(at[:-1], at[1:])], pa.binary()),
                 pa.array([np.sort((item[s:e] >> np.uint64(32)).astype(np.uint32)).tobytes()
                           for s, e in zip(at[:-1], at[1:])], pa.binary()),
                 pa.array([r.tobytes() for r in low], pa.binary())], ["id", "items", "items32", "weights"])
    return task


def similar(x: np.ndarray, y: np.ndarray, similarity: float) -> bool:
    """Whether two sets (sorted arrays) have at least this Jaccard."""
    small, big = (x, y) if len(x) <= len(y) else (y, x)
    if len(small) < similarity * len(big):
        return False
    at = np.minimum(np.searchsorted(big, small), len(big) - 1)
    both = int((big[at] == small).sum())
    return both >= similarity * (len(x) + len(y) - both)


def _verify(similarity: float):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            keep = []
            for x, y in zip(b.column("x"), b.column("y")):
                keep.append(similar(np.frombuffer(x.as_buffer(), np.uint64),
                                    np.frombuffer(y.as_buffer(), np.uint64), similarity))
            v, w = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint16).reshape(b.num_rows, -1)
                    for c in ("v", "w"))
            yield pa.RecordBatch.from_arrays(
                [b.column("a"), b.column("b"), pa.array((v == w).sum(axis=1) / max(v.shape[1], 1), pa.float64())],
                ["a", "b", "weighted"]).filter(pa.array(keep, pa.bool_()))
    return task


def _rest(limit: float, similarity: float):
    """Similar pairs across components in one block pair: sizes allow the similarity,
    registers agree often enough, and 32-bit shingle hashes confirm it."""
    def pairs(left, right):
        (ids, comp, reg, size, items), (ids2, comp2, reg2, size2, items2) = left, right
        columns = np.ascontiguousarray(reg2.T)
        for lo in range(0, len(ids), 256):
            rows = slice(lo, lo + 256)
            agree = np.zeros((len(ids[rows]), len(ids2)), np.uint16)
            for mine, other in zip(reg[rows].T, columns):
                agree += mine[:, None] == other
            s = size[rows][:, None]
            near = ((agree >= limit * len(columns)) & (comp[rows][:, None] != comp2) & (ids[rows][:, None] != ids2)
                    & (size2 >= similarity * s) & (s >= similarity * size2))
            for i, j in zip(*np.nonzero(near)):
                if similar(items[lo + i], items2[j], similarity):
                    yield min(ids[lo + i], ids2[j]), max(ids[lo + i], ids2[j])

    def task(key, table):
        def side(name):
            t = table.filter(pc.equal(table.column("side"), name))
            reg = np.frombuffer(b"".join(t.column("registers").to_pylist()), np.uint8)
            return (t.column("id").to_numpy(), t.column("comp").to_numpy(),
                    reg.reshape(t.num_rows, -1) if t.num_rows else reg.reshape(0, 0),
                    t.column("n_shingles").to_numpy(),
                    [np.frombuffer(x.as_buffer(), np.uint32) for x in t.column("low")])
        left, right = side(0), side(1)
        if not len(right[0]):
            right = left
        found = sorted(set(pairs(left, right)))
        return pa.table({"a": pa.array([x[0] for x in found], pa.int64()),
                         "b": pa.array([x[1] for x in found], pa.int64())})
    return task


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``docs`` with its columns as ``c0``, ``c1``, ... and the key ``id``: the doc_id, a hash of the
    text where that is null, and a hash of both where rows of one key have different texts."""
    at = {c: F.col(f"c{i}") for i, c in enumerate(docs.columns)}
    inner = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)])
    h = F.xxhash64(F.lit("null id"), at[text])
    inner = inner.withColumns({"id": F.coalesce(at[doc_id].cast("long"), h), "h": h})
    several = inner.groupBy("id").agg(F.min("h").alias("lo"), F.max("h").alias("hi")).where("lo != hi")
    several = stage(several.select(F.col("id").alias("shared")), "shared-ids")
    if several.isEmpty():
        return inner.drop("h")
    version = F.xxhash64(F.lit("version"), "id", "h")
    return (inner.join(several, F.col("id") == F.col("shared"), "left")
            .withColumn("id", F.when(F.col("shared").isNull(), F.col("id")).otherwise(version)).drop("h", "shared"))


def near_duplicate_classes(docs: DataFrame, *, shingle: int = 5, similarity: float = 0.8, bands: int = 20,
                           rows: int = 4, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: ``doc_id``, ``class_id``, ``n_links`` (verified links between
    its shingle set and other sets found in the search), ``weighted`` (the largest estimate of
    the weighted similarity over these links; null without links), ``n_shingles`` and ``id``
    (the row's key: its doc_id, or a hash where that is null or shared by different texts)."""
    at = {c: F.col(f"c{i}") for i, c in enumerate(docs.columns)}
    d = _keyed(docs, doc_id, text).select("id", at[doc_id].cast("long").alias("doc_id"), at[text].alias("text"))
    return _classes(d, shingle, similarity, bands, rows)


def _classes(d: DataFrame, shingle: int, similarity: float, bands: int, rows: int) -> DataFrame:
    """The classes of ``d``: ``id`` (rows that share one have the same text), ``doc_id``, ``text``."""
    sketch = stage(d.mapInArrow(_sketch(shingle, bands, rows), "id long, doc_id long, d1 long, d2 long, "
                                "n_shingles long, keys array<long>, registers binary"), "sketch")
    some = sketch.where("n_shingles > 0")
    # one representative per shingle set; a row's own id may repeat, so ids of sets are theirs
    sets = some.groupBy("d1", "d2").agg(F.min("id").alias("rep"))
    of = some.join(sets, ["d1", "d2"]).where("id = rep")
    reps = stage(of.groupBy("d1", "d2", "rep").agg(F.first("keys").alias("keys"),
                                                    F.first("registers").alias("registers"),
                                                    F.first("n_shingles").alias("n_shingles")), "reps")
    band = reps.select("rep", F.explode("keys").alias("key"))
    size = band.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    member = stage(band.join(size, "key"), "members")
    # the member that meets most others over all its buckets leads: an original before its copies
    hub = member.groupBy("rep").agg(F.sum("n").alias("met"))
    member = member.join(hub, "rep")
    lead = member.groupBy("key").agg(F.max(F.struct("met", (-F.col("rep")).alias("first"))).alias("top"))
    member = stage(member.join(lead.select("key", (-F.col("top.first")).alias("lead")), "key").drop("met"), "buckets")
    wanted = member.select(F.col("rep").alias("id")).distinct()
    # one plan at every size: texts are exchanged, not the ids broadcast
    items = stage(d.select("id", "text").join(wanted.hint("merge"), "id").mapInArrow(
        _sets(shingle, bands * rows), "id long, items binary, items32 binary, weights binary"), "shingle-sets")

    def verified(pairs: DataFrame) -> DataFrame:
        x = items.select(F.col("id").alias("a"), F.col("items").alias("x"), F.col("weights").alias("v"))
        y = items.select(F.col("id").alias("b"), F.col("items").alias("y"), F.col("weights").alias("w"))
        checked = pairs.join(y, "b").join(x, "a").select("a", "b", "x", "y", "v", "w").mapInArrow(
            _verify(similarity), "a long, b long, weighted double")
        # rows that share an id give a pair more than once
        return stage(checked.groupBy("a", "b").agg(F.max("weighted").alias("weighted")), "links")

    links = verified(member.where("rep != lead").select(F.col("lead").alias("a"), F.col("rep").alias("b")).distinct())
    comps = stage(connected_components(links), "components")
    placed = member.join(comps.withColumnRenamed("id", "rep"), "rep", "left").withColumn(
        "comp", F.coalesce("comp", "rep"))
    open_ = placed.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo != hi")
    left = stage(placed.join(open_.select("key"), "key").select("key", "rep", "comp", "n"), "open-buckets")
    if not left.isEmpty():
        m = bands * rows
        limit = similarity - 3 * math.sqrt(similarity * (1 - similarity) / m)
        blocks = F.ceil(F.col("n") / BLOCK).cast("int")
        mine = F.pmod(F.xxhash64("rep"), blocks).cast("int")
        # a member goes to every block pair it is in: (own, other), left unless own is the larger
        spread = left.withColumn("blk", mine).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        spread = spread.select("key", F.col("rep").alias("id"), "comp", F.least("blk", "other").alias("b1"),
                               F.greatest("blk", "other").alias("b2"),
                               F.when(F.col("blk") > F.col("other"), 1).otherwise(0).alias("side"))
        spread = spread.join(reps.select(F.col("rep").alias("id"), "registers", "n_shingles"), "id")
        low = items.withColumnRenamed("items32", "low").select("id", "low")
        spread = spread.join(low.dropDuplicates(["id"]), "id")
        more = stage(spread.groupBy("key", "b1", "b2").applyInArrow(_rest(limit, similarity), "a long, b long").distinct(), "pairs")
        found = verified(more)
        if not found.isEmpty():
            links = stage(links.union(found).groupBy("a", "b").agg(F.max("weighted").alias("weighted")), "links")
            # only the components that the new links join are contracted again
            of = comps.withColumnRenamed("comp", "c")
            ends = found.join(of.withColumnRenamed("id", "a"), "a", "left").select(F.coalesce("c", "a").alias("a"), "b")
            ends = ends.join(of.withColumnRenamed("id", "b"), "b", "left").select("a", F.coalesce("c", "b").alias("b"))
            top = stage(connected_components(ends), "components")
            joined = comps.join(top.select(F.col("id").alias("comp"), F.col("comp").alias("c")), "comp", "left")
            comps = stage(joined.select("id", F.coalesce("c", "comp").alias("comp")).union(top).distinct(), "components")
    degree = links.select(F.explode(F.array("a", "b")).alias("rep"), "weighted").groupBy("rep").agg(
        F.count("*").alias("n_links"), F.max("weighted").alias("weighted"))
    named = sets.join(comps.withColumnRenamed("id", "rep"), "rep", "left").join(degree, "rep", "left").select(
        "d1", "d2", F.coalesce("comp", "rep").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"),
        "weighted")
    linked = some.select("id", "doc_id", "d1", "d2", "n_shingles").join(named, ["d1", "d2"]).select(
        "doc_id", "class_id", "n_links", "weighted", "n_shingles", "id")
    alone = sketch.where("n_shingles = 0").select(
        "doc_id", F.col("id").alias("class_id"), F.lit(0).cast("long").alias("n_links"),
        F.lit(None).cast("double").alias("weighted"), "n_shingles", "id")
    return linked.union(alone)


def drop_near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", shingle: int = 5,
                         similarity: float = 0.8, bands: int = 20, rows: int = 4) -> DataFrame:
    """``docs`` with one row of every class: the one with the smallest key (of rows that
    share it, which have the same text, one by the order of their content)."""
    at = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    keyed = _keyed(docs, doc_id, text)
    d = keyed.select("id", F.col(at[doc_id]).cast("long").alias("doc_id"), F.col(at[text]).alias("text"))
    cls = _classes(d, shingle, similarity, bands, rows)
    kept = keyed.join(cls.where("id = class_id").select("id").distinct(), "id", "left_semi")
    order = Window.partitionBy("id").orderBy(*[F.col(c).cast("string") for n, c in at.items() if n != text])
    return (kept.withColumn("n", F.row_number().over(order)).where("n = 1")
            .select(*[F.col(c).alias(n) for n, c in at.items()]))
