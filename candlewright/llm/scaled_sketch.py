"""Document fingerprints by threshold-scaled sketches; DataFrame functions only.

The shingles of a text are its runs of five words (a shorter text is one shingle). A
sketch retains every distinct shingle hash below a fixed fraction (1 / ``scale``) of
the hash space. A text with fewer than ``FEW`` such hashes is short: its sketch is
complete, it retains all hashes. Sketches merge by union (then the same rule); which
kind a sketch is can be read from its hashes. The share of one sketch found in another
estimates the containment of their shingle sets without bias from their sizes, so a
page can be compared with a book.

``likeness`` is the containment of the smaller in the larger, ``jaccard`` the Jaccard
of the two. Two complete sketches compare exactly, two others by their hashes; of a
complete and another one only hashes below the fraction count, and likeness is null
(unknown) where the short text has none there. ``fingerprints`` has the texts at hand:
where either text is short, its results are exact and never unknown. A fingerprint is
the sketch in ascending order, each hash as 16 hexadecimal digits; equal texts have
equal fingerprints.

The next document (ascending id, null first, rows with one id by a hash of their text;
after the last the first) is found on ids alone: range partitions, a lead inside each,
and the seams between them. Texts are exchanged once by document; what travels to the
neighbour is only the prefix it needs, the sketch, and how many hashes of a short text
it holds.

Defined results. Null text is empty: fingerprint '', likeness 1 to another empty text
and 0 to any other. Rows equal in id and text are one document: both get its result. A
single document is its own next. Extra columns do not matter; an empty table gives no
rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewright.llm.textops import stage

SHINGLE, SCALE = 5, 8
#: Hashes below the fraction under which a text is short and its sketch complete.
FEW = 8
NULL_ID = -(1 << 63)


def _below(scale: int) -> Column:
    """The fraction of the signed hash range."""
    return F.lit(-(1 << 63) + ((1 << 64) // scale))


def hashes(text: Column) -> Column:
    """All distinct shingle hashes of a text (signed order), by built-in functions."""
    words = F.filter(F.split(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")

    def shingles(w: Column) -> Column:
        # w: the word hashes, bound once; a text shorter than a shingle gives one
        runs = F.transform(
            F.slice(w, F.lit(1), F.greatest(F.size(w) - (SHINGLE - 1), F.least(F.size(w), F.lit(1)))),
            lambda x, i: F.xxhash64(x, *[F.get(w, i + j) for j in range(1, SHINGLE)]))
        return F.array_sort(F.array_distinct(runs))

    return F.transform(F.array(F.transform(words, lambda x: F.xxhash64(x))), shingles)[0]


def complete(s: Column, scale: int = SCALE) -> Column:
    """Whether a sketch (or all hashes of a text) is that of a short text."""
    return F.coalesce(F.get(s, F.lit(FEW - 1)) >= _below(scale), F.lit(True))


def low(s: Column, scale: int = SCALE) -> Column:
    return F.filter(s, lambda x: x < _below(scale))


def retain(h: Column, scale: int = SCALE) -> Column:
    """The sketch of a text with the hashes ``h``."""
    return F.when(complete(h, scale), h).otherwise(low(h, scale))


def sketch(text: Column, scale: int = SCALE) -> Column:
    """Sorted distinct retained hashes of a text."""
    return F.transform(F.array(hashes(text)), lambda h: retain(h, scale))[0]


def fingerprint(s: Column) -> Column:
    return F.array_join(F.transform(s, lambda x: F.lpad(F.hex(x), 16, "0")), "")


def contained(both: Column, a: Column, b: Column) -> Column:
    """Containment of the smaller set in the larger, from the sizes of the sets and of their
    common part."""
    least = F.least(a, b)
    return F.when(least == 0, F.when(a == b, 1.0).otherwise(0.0)).otherwise(both / least)


def _comparable(a: Column, b: Column, scale: int) -> tuple[Column, Column]:
    unlike = complete(a, scale) != complete(b, scale)
    return tuple(F.when(unlike, low(x, scale)).otherwise(x) for x in (a, b))


def likeness(a: Column, b: Column, scale: int = SCALE) -> Column:
    """Containment of the smaller in the larger, from two sketches (null: unknown)."""
    x, y = _comparable(a, b, scale)
    none = (F.least(F.size(x), F.size(y)) == 0) & (F.least(F.size(a), F.size(b)) > 0)
    return F.when(~none, contained(F.size(F.array_intersect(x, y)), F.size(x), F.size(y)))


def jaccard(a: Column, b: Column, scale: int = SCALE) -> Column:
    a, b = _comparable(a, b, scale)
    both = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - both
    return F.when(union == 0, 1.0).otherwise(both / union)


def successors(keys: DataFrame, tasks: int) -> DataFrame:
    """(``k``, ``h``) -> the next pair ``nk``, ``nh`` in ascending order, cyclic."""
    part = stage(keys.distinct().repartitionByRange(tasks, "k", "h").withColumn("part", F.spark_partition_id()),
                 "id-ranges")
    inside = Window.partitionBy("part").orderBy("k", "h")
    lead = part.withColumn("next", F.lead(F.struct("k", "h")).over(inside))
    first = part.groupBy("part").agg(F.min(F.struct("k", "h")).alias("first"))
    # one row per partition
    seam = Window.orderBy("part")
    every = Window.partitionBy(F.lit(0))
    first = first.select("part", F.coalesce(F.lead("first").over(seam), F.min("first").over(every)).alias("after"))
    out = lead.join(first, "part").withColumn("next", F.coalesce("next", "after"))
    return out.select("k", "h", F.col("next.k").alias("nk"), F.col("next.h").alias("nh"))


def fingerprints(docs: DataFrame, *, scale: int = SCALE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``doc_id``, ``n_chars``, ``edited_sha256``, ``fingerprint``,
    ``edited_fingerprint``, ``near_edited``, ``near_next`` and the Jaccard twins
    ``jaccard_edited``, ``jaccard_next``. The edited text has its last quarter replaced by
    the start of the next document."""
    spark = docs.sparkSession
    body = F.coalesce(F.col(text), F.lit(""))
    # the id is read back from its key, so that both joins below share one exchange of the texts
    d = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(NULL_ID)).alias("k"), F.xxhash64(body).alias("h"),
                    body.alias("text"))
    name = F.when(F.col("k") != NULL_ID, F.col("k")).cast(docs.schema[doc_id].dataType).alias("doc_id")
    short = F.transform(F.array(hashes(F.col("text"))), lambda x: F.when(complete(x, scale), x))[0]
    lengths = stage(d.select("k", "h", F.length("text").alias("n"), short.alias("short")), "lengths")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    after = successors(lengths.select("k", "h"), tasks)
    wants = after.join(lengths.groupBy("k", "h").agg(F.floor(F.max("n") / 4).cast("int").alias("need"),
                                                     F.first("short").alias("short")), ["k", "h"])
    # the neighbour's prefix and sketch, by the document that asks for them
    asked = wants.select(F.col("nk").alias("k"), F.col("nh").alias("h"), F.col("k").alias("ak"),
                         F.col("h").alias("ah"), "need", "short")
    seen = F.transform(F.array(hashes(F.col("text"))), lambda x: F.struct(
        retain(x, scale).alias("sketch"), F.size(x).alias("size"),
        F.when(F.col("short").isNotNull(), F.size(F.array_intersect(x, "short"))).alias("found")))[0]
    given = d.join(asked, ["k", "h"]).select(
        F.col("ak").alias("k"), F.col("ah").alias("h"), F.expr("substring(text, 1, need)").alias("prefix"),
        seen.alias("next"))
    given = given.groupBy("k", "h").agg(F.first("prefix").alias("prefix"), F.first("next").alias("next"))
    n = F.length("text")
    both = d.join(given, ["k", "h"]).select(
        name, "text", n.cast("long").alias("n_chars"), "next",
        F.concat(F.substring("text", F.lit(1), n - F.floor(n / 4).cast("int")), F.col("prefix")).alias("edited"))

    def compare(x: Column) -> Column:
        """``x``: all hashes of the text (``t``) and of the edited one (``e``)."""
        t, e, nxt = x["t"], x["e"], F.col("next")
        s, es, ns = retain(t, scale), retain(e, scale), nxt["sketch"]
        exact = lambda u, v: contained(F.size(F.array_intersect(u, v)), F.size(u), F.size(v))
        return F.struct(
            fingerprint(s).alias("fingerprint"), fingerprint(es).alias("edited_fingerprint"),
            F.when(complete(t, scale) | complete(e, scale), exact(t, e)).otherwise(exact(s, es)).alias("near_edited"),
            F.when(complete(t, scale), contained(nxt["found"], F.size(t), nxt["size"]))
            .when(complete(ns, scale), exact(t, ns)).otherwise(exact(s, ns)).alias("near_next"),
            jaccard(s, es, scale).alias("jaccard_edited"), jaccard(s, ns, scale).alias("jaccard_next"))

    pair = F.struct(hashes(F.col("text")).alias("t"), hashes(F.col("edited")).alias("e"))
    both = both.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                       F.transform(F.array(pair), compare)[0].alias("x"))
    return both.select("doc_id", "n_chars", "edited_sha256", "x.*")
