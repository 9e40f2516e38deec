"""Exact search: kNN join (E1), radius join (E2), both from one pass.

Plan: base scan -> ``mapInArrow`` past the query side's blocks (NumPy, local top-N per task)
-> shuffle of at most ``N`` rows per (query, task) on ``qid`` -> windowed final top-N ordered by
``(dist, id)``.  The base side is never shuffled or replicated.  For L2 the task kernel filters
with one BLAS matrix product and a proven rounding bound, then scores the few survivors from
explicit differences (exact answers at GEMM speed); L1 is filtered by float32 sums with a proven bound.  Queries and base rows meet
in tiles of bounded size, so a task's memory doesn't grow with the number of queries beyond their block and top-N rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from knnspark.functions.distance import arrow_matrix, gemm_error_bound, l1_near, metric_name
from knnspark.operators.blocks import query_side
from knnspark.session import DEFAULT_MAX_BROADCAST_BYTES, scratch_path
from knnspark.sources.vectors import vector_dim

PAIR_SCHEMA = "qid bigint, id bigint, dist double, top boolean, hit boolean"
NEIGHBOR_SCHEMA = "qid bigint, rank int, id bigint, dist double"
RANGE_SCHEMA = "qid bigint, id bigint, dist double"

# Distances held at once inside a task, of so many queries with as many base rows (8 MB of doubles, with a few
# temporaries of that size, whatever the number of queries).
_TASK_ELEMS = 1 << 20
_TILE_QUERIES = 1 << 11


def _pair_batch(qid, ids, dist, top: bool, hit: bool) -> pa.RecordBatch:
    n = len(qid)
    return pa.RecordBatch.from_arrays(
        [pa.array(qid, pa.int64()), pa.array(ids, pa.int64()), pa.array(dist, pa.float64()),
         pa.array(np.full(n, top), pa.bool_()), pa.array(np.full(n, hit), pa.bool_())],
        names=["qid", "id", "dist", "top", "hit"])


def near_distances(Q: np.ndarray, X: np.ndarray, metric: str) -> tuple[np.ndarray, np.ndarray]:
    """All pairs' distances (L2: squared) up to a proven error, and that bound for each pair."""
    if metric == "l1":
        return l1_near(Q, X)
    qn, xn = np.einsum("ij,ij->i", Q, Q), np.einsum("ij,ij->i", X, X)
    return qn[:, None] + xn[None, :] - 2.0 * (Q @ X.T), gemm_error_bound(qn, xn, Q.shape[1])


def _bound(high: np.ndarray, n: int, best: np.ndarray) -> np.ndarray:
    """A bound on each query's N-th best of the chunk and those before: ``best`` of those before where all have one,
    else no more than the N-th of the chunk's upper bounds."""
    if n > high.shape[1] or np.isfinite(best).all():
        return best[:, None]
    return np.minimum(np.partition(high, n - 1, axis=1)[:, n - 1], best)[:, None]


def _scan_kernel(payload, metric: str, n: int, radius: float | None, allowed=None):
    """Exact search with a pre-filter, tile by tile.

    One matrix product (L1: sums in float32) gives every distance up to a proven error bound for the pair.  A
    query's top-N of the task all lie at or below T, the N-th best exact distance of the chunks before (until there is
    one, the N-th best upper bound of the chunk), so only pairs whose lower bound
    isn't above T are scored again from explicit differences, as are those for radius hits.  The
    answer is exactly the one of the direct method.  ``allowed(part, X)``: which pairs of a tile count, if not all.
    """
    from knnspark.operators.scan import GroupTopN, pair_distances

    qids, Q = payload
    power = 1 if metric == "l1" else 2

    def near(part, X, best):
        """Pairs that may be among the top-N, and those that may be hits; with their exact distances."""
        A, err = near_distances(Q[part], X, metric)
        meet = None if allowed is None else allowed(part, X)
        low = A - err

        def score(limit):
            kept = ~(low > limit)  # an overflow proves nothing
            qi, xi = np.nonzero(kept if meet is None else kept & meet)
            return qi, xi, pair_distances(Q[part], X, qi, xi, metric)

        top = hits = None
        if n > 0:
            high = A + err if meet is None else np.where(meet, A + err, np.inf)
            top = score(_bound(high, n, best ** power * (1 + 1e-12)))
        if radius is not None:
            hits = score(radius ** power * (1 + 1e-12))
        return top, hits

    def run(batches):
        nq, d = Q.shape
        state = GroupTopN(n) if n > 0 else None
        step = max(1, _TASK_ELEMS // max(min(nq, _TILE_QUERIES), 1))
        for rb in batches:
            if rb.num_rows == 0:
                continue
            ids_all = rb.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            X_all, _ = arrow_matrix(rb.column(1), d)
            for s in range(0, len(ids_all), step):
                ids, X = ids_all[s:s + step], X_all[s:s + step]
                best = state.worst(nq) if state is not None else np.empty(nq)
                for q0 in range(0, nq, _TILE_QUERIES):
                    part = slice(q0, q0 + _TILE_QUERIES)
                    top, hits = near(part, X, best[part])
                    if top is not None:
                        qi, xi, dist = top
                        state.add(q0 + qi, dist, ids[xi])
                    if hits is not None:
                        qi, xi, dist = hits
                        m = dist <= radius
                        if m.any():
                            yield _pair_batch(qids[q0 + qi[m]], ids[xi[m]], dist[m], False, True)
        if state is not None:
            res = state.result()
            if res is not None:
                qi, dist, ids = res
                yield _pair_batch(qids[qi], ids, dist, True, False)
    return run


def _gemm_kernel(payload, n: int, radius: float | None):
    return _scan_kernel(payload, "l2", n, radius)


def scan_pairs(base: DataFrame, queries: DataFrame, n: int = 0, radius: float | None = None,
               metric: str = "l2", max_block_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """Candidate pairs from a dense scan: per task top-``n`` rows (``top``) and radius hits (``hit``)."""
    from knnspark.operators.scan import run_blocks

    metric = metric_name(metric)
    d = vector_dim(base)
    side = None if d is None else query_side(queries, d, max_block_bytes, keep=n)
    if side is None:
        return base.sparkSession.createDataFrame([], PAIR_SCHEMA)
    src = base.select(F.col("id").cast("bigint"), F.col("v").cast("array<double>"))
    return run_blocks(src, ["id", "v"], side, lambda block: (block.qids, block.Q),
                      lambda payload: _scan_kernel(payload, metric, n, radius), PAIR_SCHEMA, n)


def top_n(pairs: DataFrame, n: int, dist_col: str = "dist") -> DataFrame:
    """Windowed top-N per query by ``(dist, id)``; Spark plans a partial limit before the shuffle."""
    w = Window.partitionBy("qid").orderBy(F.col(dist_col), F.col("id"))
    return (pairs.withColumn("rank", F.row_number().over(w))
            .where(F.col("rank") <= n)
            .select("qid", "rank", "id", F.col(dist_col).alias("dist")))


def _check_n(n: int) -> None:
    if n is None or int(n) <= 0:
        raise ValueError("N must be a positive integer")


def knn(base: DataFrame, queries: DataFrame, n: int, metric: str = "l2",
        max_block_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """The ``n`` nearest base vectors of every query -> ``(qid, rank, id, dist)``."""
    _check_n(n)
    pairs = scan_pairs(base, queries, n=n, radius=None, metric=metric, max_block_bytes=max_block_bytes)
    return top_n(pairs.where("top"), n)


def range_search(base: DataFrame, queries: DataFrame, radius: float, metric: str = "l2",
                 max_block_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """All base vectors with ``dist <= radius`` (inclusive) -> ``(qid, id, dist)``.

    As in the reference, a radius of 0 or less disables the search (empty result).
    """
    spark = base.sparkSession
    if radius is None or radius <= 0:
        return spark.createDataFrame([], RANGE_SCHEMA)
    pairs = scan_pairs(base, queries, n=0, radius=float(radius), metric=metric, max_block_bytes=max_block_bytes)
    return pairs.where("hit").select("qid", "id", "dist")


def knn_and_range(base: DataFrame, queries: DataFrame, n: int, radius: float, metric: str = "l2",
                  max_block_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
                  persist: bool | str = True) -> tuple[DataFrame, DataFrame]:
    """Neighbours and radius hits from one scan of the base (see ``both``)."""
    _check_n(n)
    r = float(radius) if radius is not None and radius > 0 else None
    return both(scan_pairs(base, queries, n=n, radius=r, metric=metric, max_block_bytes=max_block_bytes), n, persist)


# For ``keep`` in ``both``: the hits are counted, not listed.
COUNTS = "counts"


def both(pairs: DataFrame, n: int, keep: bool | str = True) -> tuple[DataFrame, DataFrame]:
    """Neighbours and radius hits of one scan's pairs.

    With ``keep`` the pairs are written to the shared folder once, so that both outputs share the scan
    and no executor's memory is held; without it each output scans again (for streams).  A wide radius has hits for
    each query in proportion to the base; with ``COUNTS`` they are counted as they are found, so that what is written
    are the tasks' top-N rows and ``(qid, hits)``, the second output."""
    if keep == COUNTS:
        return _counted(pairs, n)
    if keep:
        spark, path = pairs.sparkSession, scratch_path(pairs.sparkSession, "pairs")
        pairs.write.parquet(path)
        pairs = spark.read.schema(pairs.schema).parquet(path)
    return top_n(pairs.where("top"), n), pairs.where("hit").select("qid", "id", "dist")


def _counted(pairs: DataFrame, n: int) -> tuple[DataFrame, DataFrame]:
    """``both`` with ``(qid, hits)`` for the hits: those of a query make one row of each task, before the shuffle."""
    spark, path = pairs.sparkSession, scratch_path(pairs.sparkSession, "counted")
    top = [F.when(F.col("top"), F.col(c)).alias(c) for c in ("id", "dist")]
    rows = pairs.select("qid", *top, "top", "hit").groupBy("qid", "id", "dist", "top").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("hit").alias("hits"))
    rows.write.parquet(path)
    rows = spark.read.schema(rows.schema).parquet(path)
    # rows of one id that tie count one by one
    near = rows.where("top").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n")))).select("qid", "id", "dist")
    return top_n(near, n), rows.groupBy("qid").agg(F.sum("hits").alias("hits")).where("hits > 0")


# Radius hits of a query in one row of the nested form.
RUN_HITS = 100_000


def hit_runs(hits: DataFrame, size: int = RUN_HITS) -> DataFrame:
    """``hits`` with ``run``: which run of ``size`` hits of its query, by ``(dist, id)``, a hit is in.

    Hits are range-partitioned and sorted by ``(qid, dist, id)``, so a query of any number of hits is many tasks', each of
    which numbers its own rows one by one; the counts of the tasks before (a table of a row for each query and task) say where its
    numbers begin.  Nothing is gathered for a query."""
    spark = hits.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, "sorted-hits")
    order = ["qid", "dist", "id"]
    placed = hits.select(*order).repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("task", F.spark_partition_id())
    placed.mapInArrow(_number_rows, "qid bigint, dist double, id bigint, task int, place bigint").write.parquet(path)
    placed = spark.read.schema("qid bigint, dist double, id bigint, task int, place bigint").parquet(path)
    counts = placed.groupBy("qid", "task").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("qid").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("qid", "task", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("start"))
    run = F.floor((F.col("start") + F.col("place")) / size).cast("int").alias("run")
    return placed.join(starts, ["qid", "task"]).select("qid", run, "dist", "id")


def _number_rows(batches):
    """``place``: a row's number among those of its query in the task, in the order they come."""
    last, n = None, 0
    for rb in batches:
        qid = rb.column(0).to_numpy(zero_copy_only=False)
        if not len(qid):
            continue
        starts = np.flatnonzero(np.r_[True, qid[1:] != qid[:-1]])
        place = np.arange(len(qid)) - np.repeat(starts, np.diff(np.r_[starts, len(qid)]))
        if last == qid[0]:
            place[:starts[1] if len(starts) > 1 else len(qid)] += n
        last, n = qid[-1], int(place[-1]) + 1
        yield pa.RecordBatch.from_arrays([*rb.columns, pa.array(place)], names=[*rb.schema.names, "place"])


def nested_result(neighbors: DataFrame, hits: DataFrame, run_hits: int = RUN_HITS) -> DataFrame:
    """Nested form ``(qid, run, neighbors, range)`` with ``ARRAY<STRUCT<id, dist>>`` columns.

    Neighbours are ordered by rank, range hits by ``(dist, id)``.  A row holds at most ``run_hits`` hits: a query with
    more has further rows, run by run, with no neighbours in them."""
    nb = (neighbors.groupBy("qid")
          .agg(F.array_sort(F.collect_list(F.struct("rank", "id", "dist"))).alias("_n"))
          .select("qid", F.lit(0).alias("run"), F.transform("_n", lambda s: F.struct(s["id"].alias("id"), s["dist"].alias("dist")))
                  .alias("neighbors")))
    rg = (hit_runs(hits, run_hits).groupBy("qid", "run")
          .agg(F.array_sort(F.collect_list(F.struct("dist", "id"))).alias("_r"))
          .select("qid", "run", F.transform("_r", lambda s: F.struct(s["id"].alias("id"), s["dist"].alias("dist")))
                  .alias("range")))
    empty = F.array().cast("array<struct<id:bigint,dist:double>>")
    return (nb.join(rg, ["qid", "run"], "full")
            .select("qid", "run", F.coalesce("neighbors", empty).alias("neighbors"), F.coalesce("range", empty).alias("range")))
