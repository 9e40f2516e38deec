"""Result sinks (S7): result tables as Parquet/JSON and the per-query text report.

The report is built with column functions (``format_string``, ``concat_ws``) -- one text row per
query, ordered by a distributed sort -- plus one header row with the run configuration and the
evaluation numbers.  A row holds N neighbours and a bounded run of radius hits: a query with more hits has further
rows, so no row and no task holds all hits of a query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knnspark.operators.exact import RUN_HITS, hit_runs


def write_results(out_dir: str, neighbors: DataFrame, range_hits: DataFrame | None = None,
                  evaluation: DataFrame | None = None, fmt: str = "parquet") -> None:
    out = out_dir.rstrip("/")
    neighbors.write.mode("overwrite").format(fmt).save(f"{out}/neighbors")
    if range_hits is not None:
        range_hits.write.mode("overwrite").format(fmt).save(f"{out}/range_hits")
    if evaluation is not None:
        evaluation.write.mode("overwrite").format(fmt).save(f"{out}/evaluation")


def report_lines(compare: DataFrame, range_hits: DataFrame | None, evaluation: DataFrame,
                 config: dict[str, object], timings: bool = True, run_hits: int = RUN_HITS) -> DataFrame:
    """``(key BIGINT, run INT, value STRING)``: header row (key -1) then a block per query, and a further row for every
    ``run_hits`` radius hits beyond the first.

    The header has the configuration, the quality and (with ``timings``) the execution time.
    ``compare`` is ``(qid, rank, id, dist, true_dist)`` from ``evaluate.truth_compare``.
    """
    cfg = "".join(f"\n  {k} = {v}" for k, v in sorted(config.items()))
    timing = F.format_string(
        "\nspeed: %.4f queries a second, %.4f ms a query (exact %.4f ms), %.3f s in all",
        "qps", "ms_per_query", "truth_ms_per_query", "search_seconds")
    ev = evaluation.select(F.concat(
        F.format_string("method: %s%s\nquality: approximation factor %.6f, recall %.6f", "method", F.lit(cfg), "average_af", "recall_at_n"),
        F.coalesce(timing, F.lit("")) if timings else F.lit("")).alias("value")).select(F.lit(-1).cast("bigint").alias("key"), F.lit(0).alias("run"), "value")
    nb = (compare.groupBy("qid")
          .agg(F.array_sort(F.collect_list(F.struct("rank", F.format_string(
              "  %d. id %d at %.6f (exact: %.6f)",
              "rank", "id", "dist", "true_dist").alias("s")))).alias("_n"))
          .select("qid", F.lit(0).alias("run"), F.concat_ws("\n", F.format_string("query %d", "qid"), F.concat_ws("\n", F.transform("_n", lambda x: x["s"]))).alias("nb")))
    if range_hits is not None:
        rg = (hit_runs(range_hits, run_hits).groupBy("qid", "run")
              .agg(F.array_sort(F.collect_list(F.struct("dist", "id"))).alias("_r"))
              .select("qid", "run", F.concat_ws("\n", F.transform(
                  "_r", lambda x: F.format_string("  within radius: id %d at %.6f", x["id"], x["dist"]))).alias("rg")))
        # Hits of a query without neighbours are not reported, as before; later runs stand alone.
        asked = nb.select("qid")
        nb = nb.join(rg.join(asked, "qid", "left_semi"), ["qid", "run"], "full")
    else:
        nb = nb.withColumn("rg", F.lit(None).cast("string"))
    body = nb.select(F.col("qid").alias("key"), "run", F.concat_ws("\n", "nb", "rg").alias("value"))
    return ev.unionByName(body)


def write_report(path: str, lines: DataFrame) -> None:
    """Text report ordered by query id (a range-partitioned sort, not a single task)."""
    lines.orderBy("key", "run").select("value").write.mode("overwrite").text(path)
