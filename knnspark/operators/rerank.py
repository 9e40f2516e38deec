"""Shared candidate re-ranking: ``(qid, id)`` candidates -> true distance -> top-N / radius.

Used by the stored-index searches (``lsh.search_index``, ``hypercube.search_index``).  The query
side is joined by broadcast after a size check; vectors are fetched by an equi-join on ``id``, so
this path shuffles the base -- the candidate scans in ``operators.scan`` avoid that and are the
default search path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knnspark.functions.distance import distance
from knnspark.operators.exact import top_n
from knnspark.session import DEFAULT_MAX_BROADCAST_BYTES, broadcast_bound


def bounded_broadcast(small: DataFrame, driver_rows: DataFrame, fanout: int, row_bytes: int,
                      max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """Broadcast ``small`` only if ``count(driver_rows) * fanout * row_bytes`` fits the bound.

    ``driver_rows`` is the table ``small`` is derived from (e.g. the queries for a probe table
    with ``fanout`` rows per query).  Otherwise the plain DataFrame is returned and Spark
    shuffles (AQE splits skewed partitions).
    """
    est = driver_rows.count() * max(fanout, 1) * max(row_bytes, 1)
    return F.broadcast(small) if est <= broadcast_bound(max_bytes) else small


def rerank(cands: DataFrame, base: DataFrame, queries: DataFrame, n: int | None = None,
           radius: float | None = None, metric: str = "l2",
           max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """Distances for distinct candidate pairs; top-N when ``n`` is given, else radius hits."""
    from knnspark.sources.vectors import vector_dim

    d = vector_dim(queries, "qv") or 0
    q = bounded_broadcast(queries.select("qid", "qv"), queries, 1, 8 * d + 32, max_bytes)
    pairs = (cands.select("qid", "id").distinct()
             .join(q, "qid")
             .join(base.select("id", "v"), "id")
             .select("qid", "id", distance(F.col("qv"), F.col("v"), metric).alias("dist")))
    if n is not None:
        return top_n(pairs, n)
    return pairs.where(F.col("dist") <= float(radius))
