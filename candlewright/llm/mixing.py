"""Mixing sources to target weights with hash-threshold histograms.

A document's size is its number of words. Sources (ascending by code point, null last)
get weights from a repeating pattern; they share ``share`` times all words by weight,
but no target exceeds ``most`` times its source's size, and the excess is reshared by
weight until none is above (solved at once: capped sources are a prefix in order of
size over weight).

Each source takes whole passes of all its documents, and for the rest of its target
the documents whose hash lies below a threshold. Thresholds are found without sorting:
words are summed by source and top 12 hash bits, the bucket where a source's budget
runs out is its boundary bucket, and only that bucket is refined by the next 12 bits,
down to single hash values. Thresholds are nested: a larger budget takes a superset.

Scale. Histograms are sums with map-side combine (at most 4,096 rows per source and
level), so a hot source costs no more than another. Levels read a staged table of one
short row per document. The last step joins the per-source plan, a row per source, which
Spark broadcasts only below its size threshold and splits skewed sources otherwise.

Defined results. Null or empty text has size 0 and takes 0 words. The hash covers id
and text: reruns agree, and rows equal in both are taken alike. The document on the
boundary is taken when that comes nearer to the target (a tie takes it). A source
without words has target 0. Extra columns pass through; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewright.llm.textops import free_name, stage

LEVELS, BITS = 5, 12  # 60 hash bits


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def doc_hash(doc_id: Column, text: Column) -> Column:
    """60 bits of a digest of id and text."""
    whole = F.concat_ws("|", F.lit("mix"), F.coalesce(doc_id.cast("string"), F.lit("")),
                        F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(whole.cast("binary")), 1, 15), 16, 10).cast("long")


def source_key(source: Column) -> Column:
    """Non-null and in order of code points, null last."""
    return F.coalesce(F.concat(F.lit("0"), source), F.lit("1"))


def targets(sizes: DataFrame, share: float, weights: tuple[int, ...], most: int) -> DataFrame:
    """Per source key ``s``: ``source_size``, ``target``. One row per source throughout."""
    per = sizes.groupBy("s").agg(F.sum("size").alias("source_size"))
    everything = Window.partitionBy(F.lit(0))
    w = F.lit(0)
    for i, x in enumerate(weights):
        w = F.when(F.col("i") % len(weights) == i, F.lit(x)).otherwise(w)
    per = (per.withColumn("i", F.row_number().over(everything.orderBy("s")) - 1).withColumn("w", w)
           .withColumn("cap", F.col("source_size") * most)
           .withColumn("budget", F.sum("source_size").over(everything) * F.lit(float(share))))
    order = everything.orderBy((F.col("cap") / F.col("w")).asc(), F.col("s"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("w").over(after)
    per = per.withColumn("capped", F.col("cap") / F.col("w") <= level)
    left = F.col("budget") - F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))).over(everything), F.lit(0))
    open_w = F.sum(F.when(~F.col("capped"), F.col("w"))).over(everything)
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(F.col("w") * (left / open_w))
    return per.select("s", "source_size", target.alias("target"))


def thresholds(sizes: DataFrame, plan: DataFrame) -> DataFrame:
    """``plan`` with ``passes`` (whole passes) and ``below``: documents whose hash is less
    than it are taken once more."""
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    plan = plan.withColumn("passes", whole.cast("long"))
    plan = plan.withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size"))
    at = plan.where("rest > 0").select("s", "rest", F.lit(0).cast("long").alias("prefix"))
    for level in range(1, LEVELS + 1):
        shift = BITS * (LEVELS - level)
        bucket = F.shiftright("h", shift)
        inside = sizes.where("size > 0").join(at, "s").where(F.shiftright(bucket, BITS) == F.col("prefix"))
        # one key of bucket and source: a hot source's partial sums meet bucket by bucket, and
        # only finished buckets are gathered by source
        key = F.concat(F.lpad(bucket.cast("string"), 19, "0"), F.col("s")).alias("key")
        hist = inside.groupBy(key).agg(F.max("rest").alias("rest"), F.sum("size").alias("words"))
        hist = hist.select(F.expr("substring(key, 20)").alias("s"), "rest", "words",
                           F.substring("key", 1, 19).cast("long").alias("bucket"))
        run = Window.partitionBy("s").orderBy("bucket")
        hist = hist.withColumn("upto", F.sum("words").over(run))
        # the one bucket in which the budget runs out
        hist = hist.where((F.col("upto") >= F.col("rest")) & (F.col("upto") - F.col("words") < F.col("rest")))
        at = hist.select("s", (F.col("rest") - (F.col("upto") - F.col("words"))).alias("rest"),
                         F.col("bucket").alias("prefix"), "words")
        if level < LEVELS:
            at = at.drop("words")
    last = at.select("s", (F.col("prefix") + F.when(F.col("rest") * 2 >= F.col("words"), 1).otherwise(0))
                     .alias("below"))
    return (plan.drop("rest").join(last, "s", "left")
            .withColumn("below", F.coalesce("below", F.lit(0).cast("long"))))


def mix_sources(docs: DataFrame, *, share: float = 1.5, weights: tuple[int, ...] = (5, 2, 1), most: int = 2,
                doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target``, ``taken`` (words taken, repeats
    counted) and ``times`` (how often the document is taken). Clashing names get a
    leading underscore."""
    names = [free_name(docs, n) for n in ("size", "source_size", "target", "taken", "times")]
    inner = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)])
    at = {c: F.col(f"c{i}") for i, c in enumerate(docs.columns)}
    inner = inner.withColumns({"size": word_count(at[text]), "s": source_key(at[source]),
                               "h": doc_hash(at[doc_id], at[text])})
    sizes = stage(inner.select("s", "size", "h"), "sizes")
    plan = stage(thresholds(sizes, targets(sizes, share, weights, most)), "mix-plan")
    times = F.col("passes") + F.when(F.col("h") < F.col("below"), 1).otherwise(0)
    out = [F.col("size"), F.col("source_size"), F.col("target"), (times * F.col("size")).alias("taken"),
           times.alias("times")]
    return inner.join(plan, "s").select(
        *[c.alias(n) for n, c in at.items()], *[c.alias(n) for c, n in zip(out, names)])
