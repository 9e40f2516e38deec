"""IVFFlat (I1-I4): coarse probe -> list scan -> top-N / radius.

Inverted lists are the table ``(cid, id, v)``.  Search is one candidate scan (``operators.scan``): each task
streams the queries in blocks of bounded size, finds their probed cells, matches its rows' cells to them and
scores only those pairs.  Lists written with ``partitionBy("cid")`` are joined with the probed cells, so Spark
reads only those partitions (dynamic partition pruning);
without stored lists the cell of every base row is computed in the scan (K8), so the lists are
never materialised or shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from knnspark.functions.distance import arrow_matrix, metric_name
from knnspark.operators import cluster
from knnspark.operators.exact import NEIGHBOR_SCHEMA, RANGE_SCHEMA, both, top_n
from knnspark.operators.blocks import Block, check_broadcast, probed_only, query_side
from knnspark.operators.scan import PAIR_SCHEMA, GroupTopN, emit_scored, finish_topn, match_chunks, pair_distances, run_blocks
from knnspark.session import DEFAULT_MAX_BROADCAST_BYTES


@dataclass
class IVFFlatIndex:
    cids: np.ndarray
    C: np.ndarray
    lists: DataFrame          # (cid, id, v)
    metric: str = "l2"
    base: DataFrame | None = None
    stored: bool = False      # lists read back from a cid-partitioned table

    def centroids(self, spark) -> DataFrame:
        """The centroid table."""
        return cluster.centroids_frame(spark, self.cids, self.C)


def build_ivfflat(base: DataFrame, centroids=None, params: cluster.KMediansParams | None = None) -> IVFFlatIndex:
    """K8 + K9: train (or take) centroids, assign every base vector, form the lists."""
    params = params or cluster.KMediansParams()
    metric = metric_name(params.metric)
    if centroids is None:
        cids, C, _ = cluster.kmedians_fit(base, params)
    else:
        cids, C = centroids if isinstance(centroids, tuple) else cluster.centroid_matrix(centroids)
    lists = cluster.assign(base, (cids, C), metric, carry=("v",)).select("cid", "id", "v")
    return IVFFlatIndex(cids, C, lists, metric, base.select("id", "v"))


def write_lists(index: IVFFlatIndex, path: str, partitions: int | None = None) -> DataFrame:
    """Persist the inverted lists partitioned by ``cid``; searches then read only probed cells.

    Rows are range-partitioned on ``(cid, id)`` first: each task writes one or a few cells, and a
    cell holding a large share of the base is split over several tasks instead of one.
    """
    lists = index.lists
    n = partitions or int(lists.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lists.repartitionByRange(n, "cid", "id").write.mode("overwrite").partitionBy("cid").parquet(path)
    spark = index.lists.sparkSession
    index.lists = spark.read.parquet(path).select("cid", "id", "v")
    index.stored = True
    return index.lists


def probes(index: IVFFlatIndex, queries: DataFrame, nprobe: int) -> DataFrame:
    """``(qid, prank, cid, cdist, qv)``; ``nprobe`` <= 0 gives no probes (flat rule)."""
    return cluster.nearest_probes(queries, (index.cids, index.C), nprobe, index.metric)


def _payload(cids: np.ndarray, C: np.ndarray, nprobe: int, metric: str):
    """What a scan needs of a block of queries: who probes which cell, by cell."""
    def make(block: Block):
        _, cells = cluster.nearest_centroids(block.Q, cids, C, metric, min(nprobe, len(cids)))
        order = np.argsort(cells.ravel(), kind="stable")
        return block.qids, block.Q, cells.ravel()[order].astype(np.int64), order // cells.shape[1], cids, C
    return make


def _scan_kernel(metric: str, n: int, radius: float | None, has_cid: bool):
    def kernel(payload):
        def run(batches):
            qids, Q, cells, owners, cids, C = payload
            d = Q.shape[1]
            state = GroupTopN(n) if n else None
            for rb in batches:
                if rb.num_rows == 0:
                    continue
                names = rb.schema.names
                sub = rb
                ids = sub.column(names.index("id")).to_numpy(zero_copy_only=False).astype(np.int64)
                X, _ = arrow_matrix(sub.column(names.index("v")), d)
                if has_cid:
                    cell = sub.column(names.index("cid")).to_numpy(zero_copy_only=False).astype(np.int64)
                else:
                    cell = cluster.nearest_cid(X, cids, C, metric)          # K8 on the fly
                for rows, pos in match_chunks(cells, cell):
                    q = owners[pos]
                    dist = pair_distances(Q, X, q, rows, metric)
                    yield from emit_scored(state, qids, q, ids[rows], dist, radius)
            yield from finish_topn(state, qids)
        return run
    return kernel


def _scan(index: IVFFlatIndex, queries: DataFrame, nprobe: int, n: int, radius: float | None,
          max_bytes: int) -> DataFrame | None:
    """Every point of the probed lists scored against its queries, in one pass."""
    if nprobe <= 0 or len(index.cids) == 0:
        return None
    side = query_side(queries, index.C.shape[1], max_bytes, keep=n)
    if side is None:
        return None
    check_broadcast(index.C.nbytes, "centroid matrix")
    payload = _payload(index.cids, index.C, nprobe, index.metric)
    if index.stored:
        probed = cluster.nearest_probes(side.frame(queries.sparkSession), (index.cids, index.C), nprobe, index.metric, carry=())
        return run_blocks(probed_only(index.lists, probed, ["cid"], max_bytes), ["cid", "id", "v"], side, payload,
                          _scan_kernel(index.metric, n, radius, True), PAIR_SCHEMA, n)
    source = index.base if index.base is not None else index.lists
    return run_blocks(source, ["id", "v"], side, payload, _scan_kernel(index.metric, n, radius, False), PAIR_SCHEMA, n)


def search(index: IVFFlatIndex, queries: DataFrame, n: int, nprobe: int,
           max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """Top-N of the probed lists by ``(dist, id)`` -> ``(qid, rank, id, dist)``."""
    if n <= 0:
        raise ValueError("N must be a positive integer")
    pairs = _scan(index, queries, nprobe, n, None, max_bytes)
    if pairs is None:
        return queries.sparkSession.createDataFrame([], NEIGHBOR_SCHEMA)
    return top_n(pairs.where("top"), n)


def search_and_range(index: IVFFlatIndex, queries: DataFrame, n: int, radius: float, nprobe: int,
                     keep: bool | str = True) -> tuple[DataFrame, DataFrame]:
    """I3 + I4 from one scan."""
    pairs = _scan(index, queries, nprobe, n, float(radius), DEFAULT_MAX_BROADCAST_BYTES)
    return both(pairs if pairs is not None else queries.sparkSession.createDataFrame([], PAIR_SCHEMA), n, keep)


def range_search(index: IVFFlatIndex, queries: DataFrame, radius: float, nprobe: int,
                 max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """I4: every candidate with ``dist <= radius`` (all of them, not only the first N; D4)."""
    if radius is None or radius <= 0:
        return queries.sparkSession.createDataFrame([], RANGE_SCHEMA)
    pairs = _scan(index, queries, nprobe, 0, float(radius), max_bytes)
    if pairs is None:
        return queries.sparkSession.createDataFrame([], RANGE_SCHEMA)
    return pairs.where("hit").select("qid", "id", "dist")
