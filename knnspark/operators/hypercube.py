"""Hypercube search (H1-H9): random projections to a vertex code, Hamming multi-probe.

Vertex codes are computed on Arrow batches (NumPy ``X @ P.T`` and the splitmix coin flip).
The probe sequence of a query is its code XOR a fixed list of masks ordered by
``(popcount, ascending bit tuple)`` -- the order in which a breadth-first walk that flips bits in
ascending order reaches the vertices -- so probing is one equi-join of the base codes with the
queries' ``(prank, code)``, done inside one candidate scan of the base (``operators.scan``).  The candidate cap keeps the first ``M`` points in ``(prank, id)`` order:
each task keeps its local first ``M`` per query, and a ``row_number`` window over the <= M rows
per (query, task) finishes the cap before the top-N window.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from knnspark.functions.distance import arrow_matrix, metric_name, usable_rows
from knnspark.functions.hashing import cube_codes
from knnspark.operators.exact import NEIGHBOR_SCHEMA, RANGE_SCHEMA, both, top_n
from knnspark.operators.blocks import Block, check_broadcast, probed_only, query_side
from knnspark.operators.scan import (ORDERED_SCHEMA, PAIR_SCHEMA, GroupTopN, emit_scored, finish_topn, match_chunks,
                                     pair_distances, run_blocks)
from knnspark.session import DEFAULT_MAX_BROADCAST_BYTES


@dataclass
class CubeParams:
    kproj: int = 14
    w: float = 4.0
    max_candidates: int = 10     # 0 = no cap
    probes: int = 2
    seed: int = 1
    metric: str = "l2"

    def __post_init__(self):
        # H1 parameter rules.
        self.kproj = min(32, max(1, int(self.kproj)))
        self.max_candidates = max(0, int(self.max_candidates))
        self.probes = max(1, int(self.probes))
        self.w = float(self.w) if self.w > 0 else 4.0
        self.metric = metric_name(self.metric)
        if self.metric != "l2":
            import warnings

            warnings.warn("hypercube random projections assume the L2 metric", stacklevel=2)


@dataclass
class CubeModel:
    params: CubeParams
    P: np.ndarray        # (kproj, d) Gaussian projections
    t: np.ndarray        # (kproj,) offsets in [0, w)

    @property
    def dim(self) -> int:
        return int(self.P.shape[1])


def draw_cube(params: CubeParams, dim: int) -> CubeModel:
    """H2: projections ``N(0, 1)`` and offsets ``U[0, w)`` from a seeded generator."""
    if dim <= 0:
        raise ValueError("vectors have zero dimension")
    check_broadcast(8 * params.kproj * dim, "hypercube projections")
    rng = np.random.default_rng(params.seed)
    P = rng.standard_normal((params.kproj, dim))
    t = rng.uniform(0.0, params.w, size=params.kproj)
    return CubeModel(params, P, t)


def params_table(spark, model: CubeModel) -> DataFrame:
    """``cube_params(i, p ARRAY<DOUBLE>, t DOUBLE)``."""
    rows = [(i, [float(x) for x in model.P[i]], float(model.t[i])) for i in range(model.params.kproj)]
    return spark.createDataFrame(rows, "i int, p array<double>, t double")


def probe_masks(kproj: int, probes: int) -> list[int]:
    """H6: the first ``probes`` XOR masks in breadth-first order (popcount, then bit tuple)."""
    def gen():
        for r in range(kproj + 1):
            for bits in combinations(range(kproj), r):
                yield sum(1 << b for b in bits)
    return list(islice(gen(), probes))


def masks_table(spark, model: CubeModel) -> DataFrame:
    masks = probe_masks(model.params.kproj, model.params.probes)
    return spark.createDataFrame([(i + 1, m) for i, m in enumerate(masks)], "prank int, mask bigint")


def _code_kernel(P, t, w, seed, vec_col, out_cols, strict):
    d = P.shape[1]

    def run(batches):
        for rb in batches:
            if rb.num_rows == 0:
                continue
            ok = np.arange(rb.num_rows) if strict else usable_rows(rb.column(vec_col), d)
            if len(ok) == 0:
                continue
            sub = rb.take(pa.array(ok)) if len(ok) != rb.num_rows else rb
            X, _ = arrow_matrix(sub.column(vec_col), d)
            codes = cube_codes(X, P, t, w, seed)
            yield pa.RecordBatch.from_arrays([sub.column(c) for c in out_cols] + [pa.array(codes, pa.int64())],
                                             names=list(out_cols) + ["code"])
    return run


def with_codes(model: CubeModel, df: DataFrame, vec_col: str, keep: tuple[str, ...], strict: bool = True) -> DataFrame:
    """H3 + H5: ``(*keep, code BIGINT)``.  A bad vector raises; without ``strict`` (queries) it has no vertex."""
    p = model.params
    fields = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    schema = ", ".join(f"{c} {fields[c]}" for c in keep) + ", code bigint"
    cols = list(dict.fromkeys([*keep, vec_col]))
    return df.select(*cols).mapInArrow(_code_kernel(model.P, model.t, p.w, p.seed, vec_col, keep, strict), schema)


def build_index(model: CubeModel, base: DataFrame) -> DataFrame:
    """``cube_index(code, id)``."""
    return with_codes(model, base, "v", ("id",)).select("code", "id")


def query_probes(model: CubeModel, queries: DataFrame, with_vectors: bool = False) -> DataFrame:
    """H6: ``(qid, prank, code[, qv])`` -- each query's vertex XOR each mask."""
    masks = probe_masks(model.params.kproj, model.params.probes)
    keep = ("qid", "qv") if with_vectors else ("qid",)
    qc = with_codes(model, queries, "qv", keep, strict=False)
    arr = F.array(*[F.lit(m).cast("bigint") for m in masks])
    out = qc.select(*keep, F.col("code").alias("_c"), F.posexplode(arr).alias("_p", "_m"))
    return out.select("qid", (F.col("_p") + 1).cast("int").alias("prank"),
                      F.col("_c").bitwiseXOR(F.col("_m")).alias("code"), *(["qv"] if with_vectors else []))


def _cap(pairs: DataFrame, m: int) -> DataFrame:
    """H7: the first ``m`` points per query in ``(prank, id)`` order (no cap when ``m`` is 0)."""
    if m <= 0:
        return pairs
    w = Window.partitionBy("qid").orderBy("prank", "id")
    return pairs.withColumn("_k", F.row_number().over(w)).where(F.col("_k") <= m).drop("_k")


def candidates(model: CubeModel, index: DataFrame, queries: DataFrame,
               max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """Candidates from a stored index -> ``(qid, id, prank)`` after the cap.

    The index is scanned once past the queries' vertices; each task keeps its first ``max_candidates`` rows of a query, so
    no more than those are shuffled (without a cap, nothing is)."""
    cap = model.params.max_candidates
    codes = with_codes(model, queries.where("qid IS NOT NULL"), "qv", ("qid",), strict=False)
    side = query_side(codes.withColumn("qv", F.array().cast("array<double>")), 0, max_bytes, ("code",), cap, unique=False)
    if side is None:
        return index.sparkSession.createDataFrame([], "qid bigint, id bigint, prank int")
    pairs = run_blocks(index, ["id", "code"], side, _code_payload(model), _candidate_kernel(cap), "qid bigint, id bigint, prank int", cap)
    return _cap(pairs, cap)


def _code_payload(model: CubeModel):
    """The probes of a block of queries of known vertices, sorted by code."""
    masks = np.array(probe_masks(model.params.kproj, model.params.probes), dtype=np.int64)

    def make(block: Block):
        codes = (block.extra["code"][:, None] ^ masks[None, :]).ravel()
        order = np.argsort(codes, kind="stable")
        return block.qids, codes[order], order // len(masks), (order % len(masks) + 1).astype(np.int32)
    return make


def _candidate_kernel(cap: int):
    def batch(qids, prank, ids, null):
        return pa.RecordBatch.from_arrays([pa.array(qids), pa.array(ids, mask=null), pa.array(prank.astype(np.int32))], names=["qid", "id", "prank"])

    def kernel(payload):
        qids, pcodes, powner, prank = payload

        def run(batches):
            state = GroupTopN(cap) if cap > 0 else None
            for rb in batches:
                null = rb.column(0).is_null().to_numpy(zero_copy_only=False)
                # Null ids come first in an order.
                ids = rb.column(0).fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False).astype(np.int64)
                for rows, pos in match_chunks(pcodes, rb.column(1).to_numpy(zero_copy_only=False)):
                    if state is None:
                        yield batch(qids[powner[pos]], prank[pos], ids[rows], null[rows])
                    else:
                        state.add(powner[pos], prank[pos], ids[rows], null[rows])
            kept = state.result() if state is not None else None
            if kept is not None:
                yield batch(qids[kept[0]], *kept[1:])
        return run
    return kernel


def _payload(model: CubeModel):
    """What a scan needs of a block of queries: their probes, sorted by code (those before the column ``upto``, if given)."""
    p, P, t = model.params, model.P, model.t
    masks = np.array(probe_masks(p.kproj, p.probes), dtype=np.int64)

    def make(block: Block):
        codes = (cube_codes(block.Q, P, t, p.w, p.seed)[:, None] ^ masks[None, :]).ravel()
        owner, prank = np.divmod(np.arange(len(codes)), len(masks))
        if "upto" in block.extra:
            kept = prank < block.extra["upto"][owner]
            codes, owner, prank = codes[kept], owner[kept], prank[kept]
        order = np.argsort(codes, kind="stable")
        return block.qids, block.Q, codes[order], owner[order], prank[order] + 1
    return make


def _scan_kernel(model: CubeModel, n: int, radius: float | None, stored: bool = False):
    p = model.params
    P, t, d, cap = model.P, model.t, model.dim, p.max_candidates

    def kernel(payload):
        def run(batches):
            qids, Q, pcodes, powner, prank = payload
            state = GroupTopN(cap) if cap > 0 else (GroupTopN(n) if n else None)
            for rb in batches:
                if rb.num_rows == 0:
                    continue
                sub = rb
                ids = sub.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
                X, _ = arrow_matrix(sub.column(1), d)
                codes = sub.column(2).to_numpy(zero_copy_only=False) if stored else cube_codes(X, P, t, p.w, p.seed)
                for rows, pos in match_chunks(pcodes, codes):
                    q, pr = powner[pos], prank[pos]
                    if cap > 0:
                        # H7 locally: the first ``cap`` points per query in (prank, id) order; the
                        # global first ``cap`` are among the union of the local ones.
                        loc = GroupTopN(cap)
                        loc.add(q, pr, ids[rows], rows)
                        q, pr, _, rows = loc.result()
                        dist = pair_distances(Q, X, q, rows, p.metric)
                        state.add(q, pr, ids[rows], dist)
                    else:
                        dist = pair_distances(Q, X, q, rows, p.metric)
                        yield from emit_scored(state, qids, q, ids[rows], dist, radius)
            if cap > 0:
                res = state.result()
                if res is not None:
                    q, pr, ids, dist = res
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(qids[q], pa.int64()), pa.array(ids, pa.int64()), pa.array(pr, pa.int32()),
                         pa.array(dist, pa.float64())], names=["qid", "id", "prank", "dist"])
            else:
                yield from finish_topn(state, qids)
        return run
    return kernel


# Folders of vertices in the stored lists.
LIST_PARTS = 64


def _part(code: str = "code"):
    return F.pmod(F.col(code), F.lit(LIST_PARTS)).cast("int").alias("part")


def vertex_sizes(lists: DataFrame) -> DataFrame:
    """``(code, n)``: the number of points of every filled vertex."""
    return lists.groupBy("code").agg(F.count(F.lit(1)).alias("n"))


def planned_probes(model: CubeModel, queries: DataFrame, sizes: DataFrame) -> DataFrame:
    """H7 planned from the vertex sizes: ``(qid, prank, code)`` of the probes that a capped search examines, which
    are those before whom fewer than the cap's points lie."""
    before = Window.partitionBy("qid").orderBy("prank").rowsBetween(Window.unboundedPreceding, -1)
    probes = query_probes(model, queries).join(sizes, "code", "left")
    seen = F.coalesce(F.sum(F.coalesce("n", F.lit(0))).over(before), F.lit(0))
    return probes.withColumn("_s", seen).where(F.col("_s") < model.params.max_candidates).select("qid", "prank", "code")


def _scan(model: CubeModel, base: DataFrame, queries: DataFrame, n: int, radius: float | None,
          max_bytes: int, lists: DataFrame | None = None, sizes: DataFrame | None = None) -> DataFrame | None:
    schema = ORDERED_SCHEMA if model.params.max_candidates > 0 else PAIR_SCHEMA
    keep = model.params.max_candidates if model.params.max_candidates > 0 else n
    side = query_side(queries, model.dim, max_bytes, keep=keep)
    if side is None:
        return None
    if lists is None:
        return run_blocks(base, ["id", "v"], side, _payload(model), _scan_kernel(model, n, radius), schema, keep)
    frame = side.frame(base.sparkSession)
    if sizes is not None and model.params.max_candidates > 0:
        planned = planned_probes(model, frame, sizes)
        upto = frame.join(planned.groupBy("qid").agg(F.max("prank").alias("upto")), "qid")
        side = query_side(upto, model.dim, max_bytes, extra=("upto",), keep=keep)
        probed = planned_probes(model, side.frame(base.sparkSession), sizes).select(_part())
    else:
        probed = query_probes(model, frame).select(_part())
    return run_blocks(probed_only(lists, probed, ["part"], max_bytes), ["id", "v", "code"], side, _payload(model),
                      _scan_kernel(model, n, radius, True), schema, keep)


def write_lists(model: CubeModel, base: DataFrame, path: str) -> DataFrame:
    """H5 with the vectors: ``cube_lists(part, code, id, v)``, a folder for each part of the vertices, so that a search
    opens the probed vertices' folders only.  A large vertex is many tasks' rows."""
    spark = base.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = with_codes(model, base, "v", ("id", "v")).select(_part(), "code", "id", "v").repartitionByRange(n, "part", "code", "id")
    rows.sortWithinPartitions("part", "code").write.mode("overwrite").partitionBy("part").parquet(path)
    return spark.read.parquet(path)


def write_sizes(lists: DataFrame, path: str) -> DataFrame:
    """The vertex sizes of stored lists as a table, for capped searches."""
    vertex_sizes(lists).write.mode("overwrite").parquet(path)
    return lists.sparkSession.read.parquet(path)


def search(model: CubeModel, base: DataFrame, queries: DataFrame, n: int,
           max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES, lists: DataFrame | None = None, sizes: DataFrame | None = None) -> DataFrame:
    """H8: top-N of the examined points by ``(dist, id)``.

    ``lists`` (from ``write_lists``): only the probed vertices are read, not the base; with their ``sizes`` a capped
    search reads those only that it reaches before the cap."""
    if n <= 0:
        raise ValueError("N must be a positive integer")
    pairs = _scan(model, base, queries, n, None, max_bytes, lists, sizes)
    if pairs is None:
        return queries.sparkSession.createDataFrame([], NEIGHBOR_SCHEMA)
    if model.params.max_candidates > 0:
        return top_n(_cap(pairs, model.params.max_candidates), n)
    return top_n(pairs.where("top"), n)


def search_and_range(model: CubeModel, base: DataFrame, queries: DataFrame, n: int, radius: float, keep: bool | str = True,
                     lists: DataFrame | None = None, sizes: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """H8 + H9 from one scan."""
    pairs = _scan(model, base, queries, n, float(radius), DEFAULT_MAX_BROADCAST_BYTES, lists, sizes)
    if pairs is None:
        pairs = queries.sparkSession.createDataFrame([], PAIR_SCHEMA)
    elif model.params.max_candidates > 0:  # what is examined is the same for both
        pairs = _cap(pairs, model.params.max_candidates).select(
            "qid", "id", "dist", F.lit(True).alias("top"), (F.col("dist") <= float(radius)).alias("hit"))
    return both(pairs, n, keep)


def range_search(model: CubeModel, base: DataFrame, queries: DataFrame, radius: float,
                 max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES, lists: DataFrame | None = None, sizes: DataFrame | None = None) -> DataFrame:
    """H9: examined points with ``dist <= radius``.

    ``lists`` and ``sizes``: as in ``search``."""
    if radius is None or radius <= 0:
        return queries.sparkSession.createDataFrame([], RANGE_SCHEMA)
    pairs = _scan(model, base, queries, 0, float(radius), max_bytes, lists, sizes)
    if pairs is None:
        return queries.sparkSession.createDataFrame([], RANGE_SCHEMA)
    if model.params.max_candidates > 0:
        return _cap(pairs, model.params.max_candidates).where(F.col("dist") <= float(radius)).select("qid", "id", "dist")
    return pairs.where("hit").select("qid", "id", "dist")


def search_index(model: CubeModel, index: DataFrame, base: DataFrame, queries: DataFrame, n: int,
                 max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """H6-H8 over a stored ``cube_index(code, id)``: capped candidates, then the shared re-rank."""
    from knnspark.operators.rerank import rerank

    return rerank(candidates(model, index, queries, max_bytes), base, queries, n=n, metric=model.params.metric,
                  max_bytes=max_bytes)
