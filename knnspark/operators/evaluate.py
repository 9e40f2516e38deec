"""Evaluation of approximate answers against exact ones (M1-M5).

All measures are joins and aggregates over the long result tables ``(qid, rank, id, dist)``;
nothing is collected except the final one-row summary and wall-clock times.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knnspark.session import scratch_path

AF_EPS = 1e-12


def per_query(approx: DataFrame, truth: DataFrame, queries: DataFrame, n: int) -> DataFrame:
    """Per query: ``af`` (M1 term) and ``recall`` (M2 term); 0 when either side is empty."""
    q = queries.select("qid").distinct()
    a1 = approx.where(F.col("rank") == 1).select("qid", F.col("dist").alias("a_dist"))
    t1 = truth.where(F.col("rank") == 1).select("qid", F.col("dist").alias("t_dist"))
    hits = (approx.select("qid", "id").distinct()
            .join(truth.where(F.col("rank") <= n).select("qid", "id"), ["qid", "id"], "left_semi")
            .groupBy("qid").agg(F.count(F.lit(1)).alias("hits")))
    both = F.col("a_dist").isNotNull() & F.col("t_dist").isNotNull()
    return (q.join(a1, "qid", "left").join(t1, "qid", "left").join(hits, "qid", "left")
            .select("qid",
                    F.when(both, F.col("a_dist") / (F.col("t_dist") + F.lit(AF_EPS))).otherwise(0.0).alias("af"),
                    F.when(both, F.coalesce("hits", F.lit(0)) / F.lit(float(n))).otherwise(0.0).alias("recall")))


def summary(approx: DataFrame, truth: DataFrame, queries: DataFrame, n: int, method: str = "approx") -> DataFrame:
    """M1 + M2: one row ``(method, n, average_af, recall_at_n)``; means over *all* queries."""
    return (per_query(approx, truth, queries, n)
            .agg(F.avg("af").alias("average_af"), F.avg("recall").alias("recall_at_n"))
            .select(F.lit(method).alias("method"), F.lit(int(n)).alias("n"), "average_af", "recall_at_n"))


def truth_compare(approx: DataFrame, truth: DataFrame) -> DataFrame:
    """M5: approximate neighbour beside the true distance at the same rank (own distance if the
    truth is shorter) -> ``(qid, rank, id, dist, true_dist)``."""
    t = truth.select("qid", "rank", F.col("dist").alias("t_dist"))
    return (approx.join(t, ["qid", "rank"], "left")
            .select("qid", "rank", "id", "dist", F.coalesce("t_dist", "dist").alias("true_dist")))


def timed(search: Callable[[], DataFrame], name: str) -> tuple[DataFrame, float]:
    """The result of ``search`` as a written table, and the wall seconds from the call to its end.

    The clock runs from before the call: planning a search computes and ships its query side.
    """
    t0 = time.perf_counter()
    df = search()
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    seconds = time.perf_counter() - t0
    return df.sparkSession.read.schema(df.schema).parquet(path), seconds


EVALUATION = ("method string, n int, average_af double, recall_at_n double, qps double, ms_per_query double, "
              "truth_ms_per_query double, search_seconds double")


def throughput(search: Callable[[], DataFrame], exact_search: Callable[[], DataFrame], queries: DataFrame, n: int,
               method: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """M3 + M4 with M1/M2 -> (the ``evaluation`` row, the approximate and the exact result).

    Both searches run once, timed as a whole; their results (N rows a query) are kept as tables for
    everything that reads them later.  Batch engines have no per-query latency; ``ms_per_query`` is wall
    time / queries.
    """
    spark = queries.sparkSession
    nq = queries.count()
    approx, t_approx = timed(search, "neighbors")
    truth, t_truth = timed(exact_search, "truth")
    row = summary(approx, truth, queries, n, method).first()
    evaluation = spark.createDataFrame(
        [(method, int(n), float(row["average_af"] or 0.0), float(row["recall_at_n"] or 0.0), nq / t_approx,
          1000.0 * t_approx / max(nq, 1), 1000.0 * t_truth / max(nq, 1), t_approx)], EVALUATION)
    return evaluation, approx, truth
