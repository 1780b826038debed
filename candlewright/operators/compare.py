"""Bar-by-bar comparison of two bar sets.

``local`` and ``ref`` are bar tables keyed by ``(symbol, interval, time)``.
The full outer join shuffles both sides on that key (AQE splits skewed
partitions); every summary below is one grouped aggregate over the joined
rows, so nothing is collected per series.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewright.schemas import REL_TOL_CLOSE, REL_TOL_QTY, WARN_TOL_CLOSE

KEYS = ("symbol", "interval")
PRICE_COLS = ("open", "high", "low", "close")


def compare_join(local: DataFrame, ref: DataFrame, keys: Sequence[str] = KEYS,
                 cols: Sequence[str] = ("open", "high", "low", "close", "qty"),
                 suffixes: tuple[str, str] = ("_l", "_a")) -> DataFrame:
    """Full outer join on ``(keys, time)`` with a side indicator
    ``_merge`` in {both, left_only, right_only}."""
    sl, sr = suffixes
    left = local.select(*keys, "time", *[F.col(c).alias(c + sl) for c in cols],
                        F.lit(True).alias("_in_l"))
    right = ref.select(*keys, "time", *[F.col(c).alias(c + sr) for c in cols],
                       F.lit(True).alias("_in_r"))
    j = left.join(right, [*keys, "time"], "full_outer")
    side = (F.when(F.col("_in_l").isNotNull() & F.col("_in_r").isNotNull(), F.lit("both"))
            .when(F.col("_in_l").isNotNull(), F.lit("left_only"))
            .otherwise(F.lit("right_only")))
    return j.withColumn("_merge", side).drop("_in_l", "_in_r")


def _nan_to_null(c: Column) -> Column:
    # pandas max skips NaN; Spark ranks NaN highest
    return F.nanvl(c, F.lit(None).cast("double"))


def compare_summary(local: DataFrame, ref: DataFrame, keys: Sequence[str] = KEYS,
                    rel_tol_close: float = REL_TOL_CLOSE, rel_tol_qty: float = REL_TOL_QTY,
                    pairs: DataFrame | None = None) -> DataFrame:
    """A10 + A11: per series bar counts, matches, missing on each side, max
    abs/rel diff of close and qty, and the status.

    ``missing_local`` counts only reference bars with qty > 0 (phantom
    zero-volume bars are not missing). ``pairs`` (optional) lists series to
    report even when both sides are empty (status SKIP).
    """
    j = compare_join(local, ref, keys, cols=("close", "qty"))
    both = F.col("_merge") == "both"
    denom_c = F.greatest(F.abs(F.col("close_a")), F.lit(1e-12))
    denom_q = F.greatest(F.abs(F.col("qty_a")), F.lit(1e-12))
    dc = F.abs(F.col("close_l") - F.col("close_a"))
    dq = F.abs(F.col("qty_l") - F.col("qty_a"))
    g = j.groupBy(*keys).agg(
        F.count_if(F.col("_merge") != "right_only").alias("local_bars"),
        F.count_if(F.col("_merge") != "left_only").alias("api_bars"),
        F.count_if(both).alias("matched"),
        F.count_if((F.col("_merge") == "right_only") & (F.coalesce("qty_a", F.lit(0.0)) > 0))
        .alias("missing_local"),
        F.count_if(F.col("_merge") == "left_only").alias("missing_api"),
        F.max(F.when(both, _nan_to_null(dc))).alias("max_abs_close"),
        F.max(F.when(both, _nan_to_null(dc / denom_c))).alias("max_rel_close"),
        F.max(F.when(both, _nan_to_null(dq))).alias("max_abs_qty"),
        F.max(F.when(both, _nan_to_null(dq / denom_q))).alias("max_rel_qty"),
    )
    if pairs is not None:
        g = pairs.select(*keys).join(g, list(keys), "left").fillna(
            0, ["local_bars", "api_bars", "matched", "missing_local", "missing_api"])
    matched = F.col("matched")
    zero_if_unmatched = {c: F.when(matched == 0, F.lit(0.0)).otherwise(F.col(c))
                         for c in ("max_abs_close", "max_rel_close", "max_abs_qty", "max_rel_qty")}
    g = g.withColumns(zero_if_unmatched)
    status = (F.when((F.col("local_bars") == 0) & (F.col("api_bars") == 0), F.lit("SKIP"))
              .when(matched == 0, F.lit("FAIL"))
              .when((F.col("missing_local") > 0) | (F.col("missing_api") > 0), F.lit("FAIL"))
              .when((F.col("max_rel_close") <= rel_tol_close) & (F.col("max_rel_qty") <= rel_tol_qty),
                    F.lit("PASS"))
              .when(F.col("max_rel_close") <= WARN_TOL_CLOSE, F.lit("WARN"))
              .otherwise(F.lit("FAIL")))
    return g.withColumn("status", status)


def compare_detail(local: DataFrame, ref: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Per bar both sides' OHLC, signed diffs and ``sum_abs_diff``
    (null only when all four diffs are null)."""
    j = compare_join(local, ref, keys, cols=PRICE_COLS, suffixes=("_p", "_b"))
    diffs = {f"{c}_diff": F.col(f"{c}_p") - F.col(f"{c}_b") for c in PRICE_COLS}
    j = j.withColumns(diffs)
    absd = [F.abs(F.col(f"{c}_diff")) for c in PRICE_COLS]
    any_present = F.greatest(*[a.isNotNull().cast("int") for a in absd]) == 1
    total = absd[0]
    total = F.coalesce(absd[0], F.lit(0.0))
    for a in absd[1:]:
        total = total + F.coalesce(a, F.lit(0.0))
    j = j.withColumn("sum_abs_diff", F.when(any_present, total))
    out = [*keys, "time"]
    for c in PRICE_COLS:
        out += [f"{c}_p", f"{c}_b", f"{c}_diff"]
    return j.select(*out, "sum_abs_diff")


def compare_totals(detail: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Total rows, missing rows, differing rows, mismatched, total abs diff."""
    total_abs = F.lit(0.0)
    for c in PRICE_COLS:
        total_abs = total_abs + F.coalesce(F.abs(F.col(f"{c}_diff")), F.lit(0.0))
    return detail.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("sum_abs_diff").isNull()).alias("missing_rows"),
        F.count_if(F.coalesce("sum_abs_diff", F.lit(0.0)) > 0).alias("diff_rows"),
        F.coalesce(F.sum(total_abs), F.lit(0.0)).alias("total_sum_abs"),
    ).withColumn("mismatched", F.col("missing_rows") + F.col("diff_rows"))


def top_mismatches(detail: DataFrame, k: int = 50, keys: Sequence[str] = KEYS) -> DataFrame:
    """T4: per series the ``k`` largest mismatches (missing rows count as 0),
    then earliest time. ``row_number <= k`` plans a partial group limit
    before the shuffle, so each task ships at most k rows per series."""
    w = Window.partitionBy(*keys).orderBy(F.coalesce("sum_abs_diff", F.lit(0.0)).desc(), F.col("time").asc())
    return (detail.withColumn("rank", F.row_number().over(w))
            .filter(F.col("rank") <= k))
