"""Exact search that skips: a pivot-distance table and the triangle inequality (E1, E2 over a stored base).

Build: a few base vectors are pivots.  Every row gets its distances to them; rows are grouped by nearest pivot,
sorted by the distance to it, and written in folders of about ``block_rows`` rows (``block``), each of several files if
there are fewer blocks than cores to search them.  A small
table holds, for every block and pivot, the least and the largest distance.

For a query at distance a from a pivot, rows whose distances to it lie in [lo, hi] are at least
max(a - hi, lo - a) away.  So the block table rules out blocks before any of their vectors is read: the blocks
that some query needs are found by one scan of that table, and a join with them opens their folders only
(dynamic partition pruning).  Inside a block, rows come sorted, so the same test on the stored distances
rules out stretches of ``STRETCH`` rows, query by query, before their vectors are looked at.

Radius: every query's bound is the radius.  Top-N: the block that a query is nearest to is searched first; the
N-th best distance there bounds the second pass over all blocks.  Both passes read only what their bounds leave.
The bounds have a slack above the rounding errors, so answers are those of the full scan.

The pivots and the bounds of the stretches are all that a task holds beside its queries' block; the block table is a
table, scanned like a base.  On data without structure (all distances alike) nothing can be skipped, and a
search costs the full scan and the pass over the nearest blocks.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knnspark.functions.distance import arrow_matrix, metric_name, not_above, pairwise
from knnspark.operators.blocks import Block, QuerySide, check_broadcast, probed_only, query_side
from knnspark.operators.exact import NEIGHBOR_SCHEMA, PAIR_SCHEMA, RANGE_SCHEMA, near_distances, top_n
from knnspark.operators.scan import GroupTopN, emit_scored, finish_topn, pair_distances, run_blocks
from knnspark.session import scratch_path
from knnspark.sources.vectors import vector_dim

# Rows of a block that are ruled out together.
STRETCH = 256
# Files of an index for each core at least (so few blocks are still many tasks' work), of so many rows at least.
FILES_A_CORE, FILE_ROWS = 4, 1 << 10
# Above the rounding of distances, whatever the summation order.
SLACK = 1e-9
# Queries compared with a stretch at once, and distances or pairs held at once.
_QUERIES = 1 << 12
_ELEMS = 1 << 19


@dataclass
class PivotIndex:
    pivots: np.ndarray      # (P, d)
    metric: str
    path: str               # folder of the two tables
    rows: DataFrame         # (id, v, near, block) in a folder for each block
    blocks: DataFrame       # (block, n, lo ARRAY<DOUBLE>, hi ARRAY<DOUBLE>)

    @property
    def dim(self) -> int:
        return int(self.pivots.shape[1])


def choose_pivots(base: DataFrame, pivots: int, metric: str, seed: int) -> np.ndarray:
    """The first base vectors in md5 order of their ids, spread out: of four times as many, each next pivot is
    the one farthest from those before (ties to the first)."""
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("id").cast("string")))
    rows = base.select("id", "v", key.alias("k")).orderBy("k", "id").limit(4 * pivots).select("v").toArrow()
    X, _ = arrow_matrix(rows.column(0))
    if not len(X):
        return X
    chosen, far = [0], pairwise(X[:1], X, metric)[0]
    while len(chosen) < min(pivots, len(X)) and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, pairwise(X[chosen[-1:]], X, metric)[0])
    return np.ascontiguousarray(X[chosen])


def _near_kernel(pivots: np.ndarray, metric: str):
    def run(batches):
        for rb in batches:
            X, _ = arrow_matrix(rb.column("v"), pivots.shape[1])
            D = pairwise(X, pivots, metric) if len(X) else np.empty((0, len(pivots)))
            own = D.argmin(axis=1) if len(X) else np.empty(0, np.int64)
            offsets = pa.array(np.arange(0, D.size + 1, len(pivots), dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [rb.column("id"), rb.column("v"), pa.ListArray.from_arrays(offsets, pa.array(D.ravel())), pa.array(own, pa.int32()),
                 pa.array(D[np.arange(len(X)), own])], names=["id", "v", "near", "cell", "own"])
    return run


def _files_of_block(n: int, n_blocks: int, cores: int) -> int:
    """Files that a block is written in: a task reads one at least, so one block alone would be one task's."""
    return max(1, min(-(-FILES_A_CORE * cores // n_blocks), n // (n_blocks * FILE_ROWS)))


def build(base: DataFrame, path: str | None = None, pivots: int = 16, block_rows: int = 1 << 18, metric: str = "l2",
          seed: int = 1) -> PivotIndex | None:
    """The pivot index of ``base(id, v)``, written under ``path``; None for an empty base."""
    metric, spark = metric_name(metric), base.sparkSession
    if vector_dim(base) is None:
        return None
    P = choose_pivots(base, pivots, metric, seed)
    check_broadcast(P.nbytes, "pivots")
    path = path or scratch_path(spark, "pivot-index")
    src = base.select(F.col("id").cast("bigint"), F.col("v").cast("array<double>"))
    near = src.mapInArrow(_near_kernel(P, metric), "id bigint, v array<double>, near array<double>, cell int, own double")
    n = base.count()
    n_blocks = max(1, -(-n // block_rows))
    files = _files_of_block(n, n_blocks, spark.sparkContext.defaultParallelism)
    placed = near.repartitionByRange(n_blocks * files, "cell", "own", "id").withColumn("block", F.floor(F.spark_partition_id() / files).cast("int"))
    (placed.sortWithinPartitions("block", "cell", "own", "id").select("id", "v", "near", "block")
     .write.mode("overwrite").partitionBy("block").parquet(f"{path}/rows"))
    rows = spark.read.schema(_ROWS).parquet(f"{path}/rows")
    ends = [f(F.get("near", F.lit(k))).alias(f"{name}{k}") for name, f in (("lo", F.min), ("hi", F.max)) for k in range(len(P))]
    sizes = rows.select("block", "near").groupBy("block").agg(F.count(F.lit(1)).alias("n"), *ends)
    sizes.select("block", "n", *(F.array(*(f"{name}{k}" for k in range(len(P)))).alias(name) for name in ("lo", "hi"))).write.mode(
        "overwrite").parquet(f"{path}/blocks")
    spark.createDataFrame([(k, p.tolist()) for k, p in enumerate(P)], "k int, p array<double>").write.mode("overwrite").parquet(f"{path}/pivots")
    return PivotIndex(P, metric, path, rows, spark.read.parquet(f"{path}/blocks"))


_ROWS = "id bigint, v array<double>, near array<double>, block int"


def load(spark, path: str, metric: str) -> PivotIndex:
    """An index that ``build`` or ``save`` has written under ``path``."""
    pivots = spark.read.parquet(f"{path}/pivots").orderBy("k").collect()
    return PivotIndex(np.array([r["p"] for r in pivots], dtype=np.float64), metric_name(metric), path,
                      spark.read.schema(_ROWS).parquet(f"{path}/rows"), spark.read.parquet(f"{path}/blocks"))


def save(index: PivotIndex, path: str) -> None:
    """The index's tables copied to ``path``."""
    spark = index.rows.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    own = F.array_min("near")
    order = ["block", F.array_position("near", own), own, "id"]
    index.rows.repartitionByRange(n, *order).sortWithinPartitions(*order).write.mode("overwrite").partitionBy("block").parquet(f"{path}/rows")
    for name in ("blocks", "pivots"):
        spark.read.parquet(f"{index.path}/{name}").write.mode("overwrite").parquet(f"{path}/{name}")


def _lists(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _least(A: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """(queries, ranges): least possible distance of rows whose pivot distances lie in the ranges, less the slack."""
    out = np.full((len(A), len(lo)), -np.inf)
    for k in range(A.shape[1]):
        a = A[:, k, None]
        np.maximum(out, np.maximum(a - hi[None, :, k], lo[None, :, k] - a) - SLACK * (a + hi[None, :, k]), out=out)
    return out


def _payload(index: PivotIndex, radius: float | None):
    """A block of queries with their pivot distances and bounds (the radius, or the column ``bound``)."""
    P, metric = index.pivots, index.metric

    def make(block: Block):
        bound = block.extra["bound"] if "bound" in block.extra else np.full(len(block.qids), np.inf if radius is None else radius)
        return block.qids, block.Q, pairwise(block.Q, P, metric), bound, block.extra.get("home")
    return make


def _slices(batches, nq: int):
    """Rows of the block table, few enough at once for a (queries x blocks) matrix."""
    step = max(1, _ELEMS // max(nq, 1))
    for rb in batches:
        for at in range(0, rb.num_rows, step):
            yield rb.slice(at, step)


def _needed_kernel(payload):
    """Blocks that some query needs."""
    qids, _, A, bound, _ = payload

    def run(batches):
        for rb in _slices(batches, len(qids)):
            low = _least(A, _lists(rb.column("lo"), A.shape[1]), _lists(rb.column("hi"), A.shape[1]))
            wanted = (low <= bound[:, None]).any(axis=0)
            yield pa.RecordBatch.from_arrays([rb.column("block").filter(pa.array(wanted)).cast(pa.int32())], names=["block"])
    return run


def _home_kernel(payload):
    """Each query's nearest block of the task's: ``(qid, low, most, block)`` by least possible distance, then by the
    largest, then number."""
    qids, _, A, _, _ = payload

    def run(batches):
        low, most = np.full(len(qids), np.inf), np.full(len(qids), np.inf)
        block = np.full(len(qids), -1, np.int32)
        for rb in _slices(batches, len(qids)):
            lo, hi = _lists(rb.column("lo"), A.shape[1]), _lists(rb.column("hi"), A.shape[1])
            least = np.maximum(_least(A, lo, hi), 0)
            for j, number in enumerate(rb.column("block").to_pylist()):
                far = np.min(A + hi[j], axis=1)
                better = (least[:, j] < low) | ((least[:, j] == low) & ((far < most) | ((far == most) & (number < block))))
                low[better], most[better], block[better] = least[better, j], far[better], number
        met = block >= 0
        if met.any():
            yield pa.RecordBatch.from_arrays([pa.array(qids[met]), pa.array(low[met]), pa.array(most[met]), pa.array(block[met])],
                                             names=["qid", "low", "most", "block"])
    return run


def _score(Q: np.ndarray, X: np.ndarray, bound: np.ndarray, metric: str, n: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Pairs within their query's bound, their distances, and the bounds.  Distances with a proven error narrow first.

    With ``n``, the N-th best of a query's upper bounds in ``X`` bounds its N-th best row: the bounds come back
    tightened, so no task scores all of its first rows."""
    near, err = near_distances(Q, X, metric)
    power, low = 1 if metric == "l1" else 2, near - err
    qi, xi = not_above(low, (bound ** power * (1 + 1e-12))[:, None])
    if n:
        many = np.flatnonzero(np.bincount(qi, minlength=len(Q)) >= n)  # fewer within the bound can't tighten it
        if len(many):
            high = np.maximum(np.partition(near[many] + err[many], n - 1, axis=1)[:, n - 1], 0.0)
            bound = bound.copy()
            bound[many] = np.fmin(bound[many], high ** (1 / power) * (1 + SLACK))
            kept = ~(low[qi, xi] > (bound ** power * (1 + 1e-12))[qi])
            qi, xi = qi[kept], xi[kept]
    dist = pair_distances(Q, X, qi, xi, metric)
    keep = dist <= bound[qi]
    return qi[keep], xi[keep], dist[keep], bound


def _scan_kernel(metric: str, n: int, hits: bool):
    """Rows within the queries' bounds: radius hits, or the local top-N.  A query with a home block only meets that."""
    def kernel(payload):
        qids, Q, A, bound, home = payload

        def run(batches):
            state = GroupTopN(n) if n else None
            limit = bound.copy()
            for rb in batches:
                if rb.num_rows == 0:
                    continue
                ids, block = rb.column("id").to_numpy(), rb.column("block").to_numpy()
                near = _lists(rb.column("near"), A.shape[1])
                # Stretches of sorted rows; none goes over the end of a block.
                starts = np.concatenate([np.arange(s, e, STRETCH) for s, e in _even(block)])
                ends = np.append(starts[1:], len(ids))
                lo, hi = np.minimum.reduceat(near, starts), np.maximum.reduceat(near, starts)
                X = None
                for q0 in range(0, len(qids), _QUERIES):
                    part = slice(q0, q0 + _QUERIES)
                    low = _least(A[part], lo, hi)
                    held, size = [], 0
                    for k, (at, end) in enumerate(zip(starts, ends)):
                        meets = low[:, k] <= limit[part]
                        who = q0 + np.flatnonzero(meets if home is None else meets & (home[part] == block[at]))
                        if not len(who):
                            continue
                        if X is None:
                            X, _ = arrow_matrix(rb.column("v"), Q.shape[1])
                        qi, xi, dist, limit[who] = _score(Q[who], X[at:end], limit[who], metric, n)
                        held.append((who[qi], ids[at + xi], dist))
                        size += len(qi)
                        if size > _ELEMS:
                            yield from emit_scored(state, qids, *map(np.concatenate, zip(*held)), np.inf if hits else None)
                            held, size = [], 0
                    if held:
                        yield from emit_scored(state, qids, *map(np.concatenate, zip(*held)), np.inf if hits else None)
                if state is not None:
                    limit = np.fmin(limit, state.worst(len(qids)))
            yield from finish_topn(state, qids)
        return run
    return kernel


def _even(block: np.ndarray) -> list[tuple[int, int]]:
    """Start and end of the rows of each block."""
    edges = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(block)]
    return list(zip(edges, edges[1:]))


def _needed_rows(index: PivotIndex, side: QuerySide, radius: float | None) -> DataFrame:
    """The rows of the blocks that some query needs."""
    found = run_blocks(index.blocks, ["block", "lo", "hi"], side, _payload(index, radius), _needed_kernel, "block int")
    return probed_only(index.rows, found, ["block"])


def _rows_within(index: PivotIndex, side: QuerySide, radius: float | None, n: int) -> DataFrame:
    return run_blocks(_needed_rows(index, side, radius), ["id", "v", "near", "block"], side, _payload(index, radius),
                      _scan_kernel(index.metric, n, radius is not None), PAIR_SCHEMA, n)


def range_search(index: PivotIndex | None, queries: DataFrame, radius: float) -> DataFrame:
    """All rows with ``dist <= radius`` -> ``(qid, id, dist)``; a radius of 0 or less gives none."""
    side = query_side(queries, index.dim) if index is not None and radius is not None and radius > 0 else None
    if side is None:
        return queries.sparkSession.createDataFrame([], RANGE_SCHEMA)
    return _rows_within(index, side, float(radius), 0).where("hit").select("qid", "id", "dist")


def bounds(index: PivotIndex, side: QuerySide, n: int) -> DataFrame:
    """``(qid, bound)``: the distance of each query's N-th best row in the block it is nearest to; infinite
    if that has fewer rows."""
    session = index.blocks.sparkSession
    near = run_blocks(index.blocks, ["block", "lo", "hi"], side, _payload(index, None), _home_kernel,
                      "qid bigint, low double, most double, block int")
    home = near.groupBy("qid").agg(F.min_by("block", F.struct("low", "most", "block")).alias("home"))
    with_home = query_side(side.frame(session).join(home, "qid"), index.dim, extra=("home",))
    rows = probed_only(index.rows, with_home.frame(session).select(F.col("home").alias("block")), ["block"])
    first = run_blocks(rows, ["id", "v", "near", "block"], with_home, _payload(index, None), _scan_kernel(index.metric, n, False), PAIR_SCHEMA, n)
    found = top_n(first.where("top"), n).groupBy("qid").agg(F.max("dist").alias("worst"), F.count(F.lit(1)).alias("n"))
    # A little above the N-th distance: the second pass finds the same rows whatever the rounding.
    return found.select("qid", F.when(F.col("n") >= n, F.col("worst") * (1 + SLACK)).otherwise(F.lit(float("inf"))).alias("bound"))


def knn(index: PivotIndex | None, queries: DataFrame, n: int) -> DataFrame:
    """The ``n`` nearest rows of every query -> ``(qid, rank, id, dist)``."""
    if n is None or int(n) <= 0:
        raise ValueError("N must be a positive integer")
    side = query_side(queries, index.dim) if index is not None else None
    if side is None:
        return queries.sparkSession.createDataFrame([], NEIGHBOR_SCHEMA)
    session = index.blocks.sparkSession
    bounded = side.frame(session).join(bounds(index, side, n), "qid")
    return top_n(_rows_within(index, query_side(bounded, index.dim, extra=("bound",)), None, n).where("top"), n)
