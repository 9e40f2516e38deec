"""Aggregates over vector components (V9 mean, V10 median) that stay bounded per group.

``exact_median`` never buffers a whole group: approximate-quantile brackets are narrowed until
few values remain around the middle ranks, and only those are sorted (see its docstring).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MEDIAN_ACCURACY = 10_000          # sketch size of the bracket passes (Spark's usual setting)
MEDIAN_MAX_COLLECT = 100_000      # most values of one group ever gathered into one array
_NARROW_QUANTILES = 1_000


def exact_median(df: DataFrame, group_cols: list[str], value_col: str, out: str = "median",
                 accuracy: int = MEDIAN_ACCURACY, max_collect: int = MEDIAN_MAX_COLLECT,
                 side_sum: str | None = None, side_out: dict | None = None) -> DataFrame:
    """Exact per-group median of ``value_col`` -> ``(*group_cols, out)``; nulls are ignored.

    Any number of groups of any size: the state of the search is a table (a row for each group) that the
    passes join, and no group is ever buffered whole:

    1. one aggregate gives each group's count and a bracket ``[lo, hi]`` around the median ranks
       (``percentile_approx``, rank error <= n/accuracy; everything for groups of at most
       ``max_collect`` values);
    2. while a bracket of a larger group is open, a counting pass gives the values below and inside it,
       those equal to its ends and its next values inwards.  Ends that the ranks are past are dropped,
       so every pass narrows; a missed bracket goes back to the one before it with a wider margin.  A
       second pass over what is inside narrows it by 1,000 quantiles;
    3. a bracket of one or two distinct values gives the median from its counts; the others hold at most
       ``max_collect`` values by then, which are sorted and read at the one or two middle ranks.

    ``side_sum`` names a numeric column of ``df`` that the first pass also sums, into ``side_out["sum"]``.
    """
    side = [F.col(side_sum).alias("_side")] if side_sum else []
    src = df.select(*group_cols, F.col(value_col).cast("double").alias("_x"), *side).where(F.col("_x").isNotNull())
    vals = src.select(*group_cols, "_x")
    x, n, below, inside = F.col("_x"), F.col("_n"), F.col("_below"), F.col("_inside")
    k1, k2 = F.floor((n + 1) / 2), F.floor(n / 2) + 1
    eps = 4.0 / accuracy
    state = src.groupBy(*group_cols).agg(
        F.count(F.lit(1)).alias("_n"), F.percentile_approx("_x", [max(0.0, 0.5 - eps), min(1.0, 0.5 + eps)], accuracy).alias("_b"),
        *([F.sum("_side").alias("_side")] if side_sum else [])).checkpoint(eager=True)
    if side_sum and side_out is not None:
        side_out["sum"] = state.agg(F.sum("_side")).first()[0]
    least, most = F.lit(float("-inf")), F.lit(float("inf"))
    small = n <= max_collect
    # _p*: the bracket before, for a miss; _m: margin in quantiles.
    state = state.select(
        *group_cols, "_n", F.when(small, least).otherwise(F.col("_b")[0]).alias("_lo"), F.when(small, most).otherwise(F.col("_b")[1]).alias("_hi"),
        least.alias("_plo"), most.alias("_phi"), F.lit(3).alias("_m"), F.lit(0).cast("bigint").alias("_below"), n.alias("_inside"))
    closed = [state.where(small).select(*group_cols, "_lo", "_hi", k1.alias("_k1"), k2.alias("_k2"))]
    known: list[DataFrame] = []
    todo = state.where(~small)
    while not todo.isEmpty():
        lo, hi = F.col("_lo"), F.col("_hi")
        within = (x >= lo) & (x <= hi)
        seen = vals.join(todo.select(*group_cols, "_lo", "_hi"), group_cols).groupBy(*group_cols).agg(
            F.count(F.when(x < lo, 1)).alias("_below"), F.count(F.when(within, 1)).alias("_inside"),
            F.count(F.when(x == lo, 1)).alias("_at_lo"), F.count(F.when(x == hi, 1)).alias("_at_hi"),
            F.min(F.when(within & (x > lo), x)).alias("_next"), F.max(F.when(within & (x < hi), x)).alias("_last"))
        now = todo.drop("_below", "_inside").join(seen, group_cols)
        hit = (below < k1) & (k2 <= below + inside)
        # Past the ties at an end: leave them out.
        up, down = hit & (k1 > below + F.col("_at_lo")), hit & (k2 <= below + inside - F.col("_at_hi"))
        now = now.withColumns({
            "_hit": hit, "_two": hit & ((lo == hi) | (F.col("_next") == hi)),
            "_v1": F.when(k1 <= below + F.col("_at_lo"), lo).otherwise(hi), "_v2": F.when(k2 <= below + F.col("_at_lo"), lo).otherwise(hi),
            "_nlo": F.when(up, F.col("_next")).otherwise(lo), "_nhi": F.when(down, F.col("_last")).otherwise(hi),
            "_nbelow": below + F.when(up, F.col("_at_lo")).otherwise(0),
            "_ninside": inside - F.when(up, F.col("_at_lo")).otherwise(0) - F.when(down, F.col("_at_hi")).otherwise(0)}).checkpoint(eager=True)
        known.append(now.where("_two").select(*group_cols, ((F.col("_v1") + F.col("_v2")) / 2.0).alias(out)))
        ends = (F.col("_ninside") <= max_collect) & F.col("_hit") & ~F.col("_two")
        closed.append(now.where(ends).select(*group_cols, F.col("_nlo").alias("_lo"), F.col("_nhi").alias("_hi"),
                                             (k1 - F.col("_nbelow")).alias("_k1"), (k2 - F.col("_nbelow")).alias("_k2")))
        open_ = now.where(~F.col("_two") & ~ends)
        missed = open_.where(~F.col("_hit")).select(
            *group_cols, "_n", F.col("_plo").alias("_lo"), F.col("_phi").alias("_hi"), "_plo", "_phi", (F.col("_m") * 10).alias("_m"), "_below", "_inside")
        held = open_.where("_hit").select(*group_cols, "_n", F.col("_nlo").alias("_lo"), F.col("_nhi").alias("_hi"), "_m",
                                          F.col("_nbelow").alias("_below"), F.col("_ninside").alias("_inside"))
        qs = [i / _NARROW_QUANTILES for i in range(_NARROW_QUANTILES + 1)]
        marks = vals.join(held.select(*group_cols, "_lo", "_hi"), group_cols).where(within).groupBy(*group_cols).agg(
            F.percentile_approx("_x", qs, 10 * _NARROW_QUANTILES).alias("_q"))
        low = F.greatest(F.floor((k1 - below - 1) / inside * _NARROW_QUANTILES) - F.col("_m"), F.lit(0)).cast("int")
        high = F.least(F.ceil((k2 - below) / inside * _NARROW_QUANTILES) + F.col("_m"), F.lit(_NARROW_QUANTILES)).cast("int")
        narrower = held.join(marks, group_cols).select(
            *group_cols, "_n", F.get("_q", low).alias("_lo"), F.get("_q", high).alias("_hi"), F.col("_lo").alias("_plo"), F.col("_hi").alias("_phi"),
            "_m", "_below", "_inside")
        todo = narrower.unionByName(missed).checkpoint(eager=True)
    inner = vals.join(reduce(DataFrame.unionByName, closed), group_cols).where((x >= F.col("_lo")) & (x <= F.col("_hi"))).groupBy(*group_cols).agg(
        F.first("_k1").alias("_k1"), F.first("_k2").alias("_k2"), F.array_sort(F.collect_list("_x")).alias("_in"))
    at = lambda k: F.try_element_at("_in", F.col(k).cast("int"))
    read = inner.select(*group_cols, ((at("_k1") + at("_k2")) / 2.0).alias(out))
    return reduce(DataFrame.unionByName, known, read)


def explode_dims(df: DataFrame, vec_col: str = "v", keep: list[str] | None = None) -> DataFrame:
    """``(*keep, dim INT, x DOUBLE)`` long form of a vector column (0-based ``dim``)."""
    keep = keep or []
    return df.select(*keep, F.posexplode(vec_col).alias("dim", "x"))


def assemble_vectors(long: DataFrame, key_cols: list[str], dim_col: str, value_col: str, out: str) -> DataFrame:
    """Inverse of ``explode_dims``: ``(*key_cols, out ARRAY<DOUBLE>)`` ordered by ``dim``.

    Each group holds exactly ``d`` values, so the collected array is bounded by the dimension.
    """
    return (long.groupBy(*key_cols)
            .agg(F.array_sort(F.collect_list(F.struct(F.col(dim_col).alias("d"), F.col(value_col).alias("x"))))
                 .alias("_s"))
            .select(*key_cols, F.transform("_s", lambda s: s["x"]).alias(out)))


def dim_means(df: DataFrame, group_cols: list[str], vec_col: str = "v") -> DataFrame:
    """V9: per group and dimension, the mean -> ``(*group_cols, dim, mean)``."""
    return (explode_dims(df, vec_col, group_cols).groupBy(*group_cols, "dim")
            .agg(F.avg("x").alias("mean")))


def dim_medians(df: DataFrame, group_cols: list[str], vec_col: str = "v") -> DataFrame:
    """Per group and dimension, the exact median -> ``(*group_cols, dim, median)``."""
    return exact_median(explode_dims(df, vec_col, group_cols), [*group_cols, "dim"], "x", "median")
