"""JSON inputs: external bar payloads (S14) and symbol lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewright.functions.timecols import millis_to_ntz
from candlewright.operators.merge import dedup_keep_first
from candlewright.schemas import EXTERNAL_BAR_FIELDS


def payload_bars(payloads: DataFrame, payload_col: str = "payload",
                 keys: Sequence[str] = ("symbol", "interval"), order: Sequence[str] = ()) -> DataFrame:
    """12-field bar arrays -> typed reference bars.

    ``open_time`` (ms) becomes ``time``; ``volume``/``quote_volume`` become
    ``qty``/``qty_usd``; duplicate times keep the first occurrence (by
    ``order`` then position in the payload).
    """
    idx = {n: i for i, n in enumerate(EXTERNAL_BAR_FIELDS)}
    arr = F.from_json(F.col(payload_col), "array<array<string>>")
    rows = payloads.select(*keys, *order, F.posexplode(arr).alias("_pos", "_r"))
    g = lambda n: F.col("_r").getItem(idx[n])
    typed = rows.select(
        *keys, *order, "_pos",
        millis_to_ntz(g("open_time").cast("long")).alias("time"),
        *[g(n).cast("double").alias(n) for n in ("open", "high", "low", "close")],
        g("volume").cast("double").alias("qty"),
        g("quote_volume").cast("double").alias("qty_usd"))
    return dedup_keep_first(typed, [*keys, "time"], [*order, "_pos"]).drop("_pos", *order)


def bars_to_payload(bars: DataFrame, keys: Sequence[str] = ("symbol", "interval"),
                    width_ms=None) -> DataFrame:
    """The inverse, one payload per (keys, day): arrays of 12 strings in
    the external field order (counts and taker fields are not known from
    local bars and are written as "0")."""
    open_ms = F.timestamp_diff("MILLISECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), F.col("time"))
    close_ms = open_ms + (width_ms if width_ms is not None else F.lit(0)) - 1
    s = lambda c: F.col(c).cast("string")
    row = F.array(open_ms.cast("string"), s("open"), s("high"), s("low"), s("close"), s("qty"),
                  close_ms.cast("string"), s("qty_usd"), F.lit("0"), F.lit("0"), F.lit("0"), F.lit("0"))
    return (bars.groupBy(*keys, F.col("time").cast("date").alias("day"))
            .agg(F.to_json(F.array_sort(F.collect_list(F.struct(F.col("time").alias("t"), row.alias("r"))))
                           .getField("r")).alias("payload")))


def symbol_list(spark: SparkSession, json_path: str | None = None,
                literals: Sequence[str] = (), require_nonempty: bool = False) -> DataFrame:
    """Symbols from a JSON array file and/or literals, de-duplicated.

    ``require_nonempty`` raises when the union is empty (one tiny action).
    """
    frames = []
    if json_path:
        text = spark.read.text(json_path, wholetext=True)
        frames.append(text.select(F.explode(F.from_json("value", "array<string>")).alias("symbol")))
    if literals:
        frames.append(spark.createDataFrame([(s,) for s in literals], "symbol string"))
    if not frames:
        raise ValueError("no symbols given")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    out = out.select(F.trim("symbol").alias("symbol")).filter(F.col("symbol") != "").distinct()
    if require_nonempty and out.isEmpty():
        raise ValueError("the symbol list is empty")
    return out
