"""Quality rules with adaptive thresholds from mergeable quantile sketches.

Base measures of a text: words, code points in words, symbols, lines equal to an
earlier line, and words in repeated 3-word windows. Two base rules are fixed (too few
words, too much repetition). All other limits come from the data: per language and
source a sketch of each rate, over documents that pass the base rules, gives its median
and its 20 % and 80 % quantiles. Rates are compared as square roots, which makes the
scatter of a count independent of its mean; a rate is (count + quantum) / units, the
quantum being what one occurrence adds, so that a rate is never 0 and a count of 0 in a
short text says less than in a long one. A document fails where it lies further above
the median than ``spread`` times the distance of the 80 % quantile, and further than
``errors`` standard errors of a count over its own units (word length fails below the
median by the same rule). No limit is a fixed number; less than 20 % of junk in a group
does not move them, and what 20 % of a group's documents have is usual there.

The sketch is a histogram over logarithmic buckets (0.5 % wide, at most about
5,600 buckets): counts add up, so it merges over tasks, and the sketch of a language or
of everything is the sum of its groups' sketches. An estimate from n values counts for
``min(1, n / min_docs)`` and that of its language for the rest; a language leans on all
documents in the same way.

Scale. One pass measures texts where they are read (numpy on whole batches); only
counts by group, measure and bucket are shuffled, with map-side combine, so a hot
source weighs like another. The limits, one row per language and source, join the
documents by size-checked broadcast or a skew-split join.

Defined results. Null text is empty: no words, base_failed. Null language or source is
a group of its own. Rows are judged one by one, repeated rows alike; extra columns pass
through; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewright.llm.textops import Words, chunks, free_name, roll, span_hashes, stage

SYMBOLS = b"#*$%&|<>"
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]
GAMMA = 1.005
#: rate -> (count, units, quantum added to the count, what one occurrence adds, limited below too)
RATES = {"symbol_share": ("n_symbols", "n_words", 1, 1, False),
         "repeat_share": ("n_repeat_words", "n_words", 6, 6, False),     # two windows of three words
         "dup_line_share": ("n_dup_lines", "n_lines", 1, 1, False),
         "word_length": ("word_chars", "n_words", 0, 1, True)}
#: Smallest value told apart by the sketch.
LEAST = 1e-8

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True


def _repeats(key: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a copy exists in the document, an earlier copy exists) per item."""
    order = np.lexsort([np.arange(len(key)), key, doc])
    same = (key[order][1:] == key[order][:-1]) & (doc[order][1:] == doc[order][:-1])
    any_, later = np.zeros(len(key), bool), np.zeros(len(key), bool)
    later[order[1:]] = same
    any_[order[1:]] = same
    any_[order[:-1]] |= same
    return any_, later


def measure(data: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray]:
    """The measures of each document of a chunk."""
    w = Words(data, off)
    n = len(off) - 1
    sums = lambda mask: np.diff(np.concatenate(([0], np.cumsum(mask)))[off])
    solid = np.zeros(len(data) + 1, np.int32)
    solid[w.start] = 1
    solid[w.end] -= 1
    solid = np.cumsum(solid[:-1]).astype(bool)
    doc = w.doc()
    h = w.hashes()
    at = np.arange(len(h))
    at = at[at + 3 <= w.off[doc + 1]] if len(h) else at
    again, _ = _repeats(roll(h, 3, 0x3A, at), doc[at])
    cover = np.zeros(len(h) + 3, np.int64)
    np.add.at(cover, at[again], 1)
    np.add.at(cover, at[again] + 3, -1)
    covered = np.cumsum(cover)[: len(h)] > 0
    # lines: between newlines and document edges
    cut = np.flatnonzero(data == 10)
    start = np.sort(np.concatenate([off[:-1], cut + 1]))
    line_doc = np.sort(np.concatenate([np.arange(n), np.searchsorted(off, cut, "right") - 1]))
    end = np.sort(np.concatenate([cut, off[1:]]))
    has = np.searchsorted(w.start, end) > np.searchsorted(w.start, start)
    start, end, line_doc = start[has], end[has], line_doc[has]
    _, later = _repeats(span_hashes(data, start, end), line_doc)
    count = lambda d: np.bincount(d, minlength=n)[:n]
    return {"n_words": w.n_words, "word_chars": sums(solid & ((data & 0xC0) != 0x80)),
            "n_symbols": sums(_SYMBOL[data]), "n_dup_lines": count(line_doc[later]),
            "n_repeat_words": count(doc[covered]), "n_lines": count(line_doc)}


def _task(keep: list[str], text: str):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, data, off in chunks(batches, text):
            m = measure(data, off)
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in keep] + [pa.array(m[x].astype(np.int64)) for x in MEASURES],
                [*keep, *MEASURES])
    return task


def measures(docs: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``docs`` and the measures; ``docs`` has no column of that name."""
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(m, T.LongType()) for m in MEASURES])
    return docs.select(*{*keep, text}).mapInArrow(_task(keep, text), schema)


def _value(name: str) -> Column:
    count, units, added, _, _ = RATES[name]
    return (F.col(count) + added) / F.greatest(F.col(units), F.lit(1))


def _error(name: str) -> Column:
    """Standard error of the square root of a rate, from the document's own units."""
    _, units, _, quantum, _ = RATES[name]
    return 0.5 * F.sqrt(quantum / F.greatest(F.col(units), F.lit(1)))


def _bucket(v: Column) -> Column:
    return F.greatest(F.lit(1), F.ceil(F.log(F.greatest(v, F.lit(LEAST)) / LEAST) / math.log(GAMMA)).cast("int"))


def _middle(bucket: Column) -> Column:
    return F.lit(LEAST) * F.pow(F.lit(GAMMA), bucket - 0.5)


def limits(measured: DataFrame, lang: str, source: str, *, base: Column, min_docs: int) -> DataFrame:
    """Per group (``g_lang``, ``g_source``, never null) and rate: ``<rate>_mid``, ``_low`` and
    ``_high``, square roots of the median and the 20 % and 80 % quantiles of the rows that do
    not fail ``base`` (null where no row of the table passes)."""
    rows = measured.select(
        F.coalesce(F.concat(F.lit("0"), lang), F.lit("1")).alias("g_lang"),
        F.coalesce(F.concat(F.lit("0"), source), F.lit("1")).alias("g_source"), (~base).cast("long").alias("ok"),
        F.explode(F.array(*[F.struct(F.lit(m).alias("m"), _bucket(_value(m)).alias("bucket")) for m in RATES]))
        .alias("x"))
    # a group of failed rows only has counts of 0 and its parents' limits
    sketch = rows.groupBy("g_lang", "g_source", "x.m", "x.bucket").agg(F.sum("ok").alias("n"))

    # one key per level: its group, its language, everything
    key = F.explode(F.array(F.concat_ws("\x00", F.lit("2"), "g_lang", "g_source"),
                            F.concat_ws("\x00", F.lit("1"), "g_lang"), F.lit("0"))).alias("key")
    merged = sketch.select(key, "m", "bucket", "n").groupBy("key", "m", "bucket").agg(F.sum("n").alias("n"))
    run, whole = Window.partitionBy("key", "m").orderBy("bucket"), Window.partitionBy("key", "m")
    merged = merged.withColumns({"upto": F.sum("n").over(run), "docs": F.sum("n").over(whole)})
    q = lambda p: F.sqrt(F.min(F.when((F.col("n") > 0) & (F.col("upto") >= p * F.col("docs")),
                                      _middle(F.col("bucket")))))
    levels = merged.groupBy("key", "m").agg(q(0.5).alias("mid"), q(0.2).alias("low"), q(0.8).alias("high"),
                                            F.max("docs").alias("docs"))
    groups = sketch.select("g_lang", "g_source").distinct().select("g_lang", "g_source", key)
    at = lambda k: F.max(F.when(F.substring("key", 1, 1) == k, F.struct("mid", "low", "high", "docs")))
    out = groups.join(levels, "key").groupBy("g_lang", "g_source", "m").agg(*[at(k).alias(f"l{k}") for k in "012"])

    def drawn(field: str) -> Column:
        est = F.col("l0")[field]
        for k in ("l1", "l2"):
            w = F.least(F.lit(1.0), F.col(k)["docs"] / max(min_docs, 1))
            est = F.when(w > 0, w * F.col(k)[field] + (1 - w) * est).otherwise(est)
        return est

    out = out.select("g_lang", "g_source", "m", *[drawn(f).alias(f) for f in ("mid", "low", "high")])
    out = out.groupBy("g_lang", "g_source").pivot("m", list(RATES)).agg(F.first(F.struct("mid", "low", "high")))
    return out.select("g_lang", "g_source", *[F.col(m)[f].alias(f"{m}_{f}") for m in RATES for f in ("mid", "low", "high")])


def within(name: str, spread: float, errors: float) -> Column:
    """Whether a row's rate lies inside the limits of its group."""
    value, mid, noise = F.sqrt(_value(name)), F.col(f"{name}_mid"), errors * _error(name)
    ok = value <= mid + F.greatest(spread * (F.col(f"{name}_high") - mid), noise)
    if RATES[name][4]:
        ok = ok & (value >= mid - F.greatest(spread * (mid - F.col(f"{name}_low")), noise))
    return F.coalesce(ok, F.lit(True))


def judge(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
          source: str = "source", min_words: int = 50, repeat_percent: int = 50, spread: float = 8.0,
          errors: float = 3.0, min_docs: int = 200, carry_text: bool = False) -> DataFrame:
    """``docs`` (without the text unless ``carry_text``) with the measures, ``base_failed``
    and ``kept``. Clashing names get a leading underscore."""
    names = {n: free_name(docs, n) for n in [*MEASURES, "base_failed", "kept"]}
    inner = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)])
    at = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    keep = [c for c in inner.columns if carry_text or c != at[text]]
    short = stage(measures(inner, at[text], [at[lang], at[source]] if carry_text else keep), "measures")
    base = (F.col("n_words") < min_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * repeat_percent)
    table = stage(limits(short, at[lang], at[source], base=base, min_docs=min_docs), "quality-limits")
    rows = measures(inner, at[text], keep) if carry_text else short
    rows = rows.withColumns({"g_lang": F.coalesce(F.concat(F.lit("0"), at[lang]), F.lit("1")),
                             "g_source": F.coalesce(F.concat(F.lit("0"), at[source]), F.lit("1"))})
    good = ~base
    for m in RATES:
        good = good & within(m, spread, errors)
    back = {v: c for c, v in at.items()}
    return rows.join(table, ["g_lang", "g_source"]).select(
        *[F.col(c).alias(back[c]) for c in keep], *[F.col(m).alias(names[m]) for m in MEASURES],
        base.alias(names["base_failed"]), good.alias(names["kept"]))
