"""Method surface (U1) and the evaluate-a-method job (M6).

    index = build("ivfflat", base, IVFFlatConfig(k=10, nprobe=3))
    neighbors, hits = search(index, queries, n=5, radius=1.2)
    run = evaluate("ivfflat", base, queries, n=5, radius=1.2, config=IVFFlatConfig(...))

An index is a small Python object holding driver-side parameters (hash offsets, projections,
centroids, codebooks -- all bounded by ``k``, ``d`` and ``2^nbits``) plus DataFrames; search
results are the long tables ``neighbors(qid, rank, id, dist)`` and ``range_hits(qid, id, dist)``.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knnspark.functions.distance import metric_name
from knnspark.operators import cluster, evaluate as M, exact, hypercube, ivfflat, lsh, pivot, pq
from knnspark.sources.vectors import vector_dim

METHODS = ("brute", "lsh", "hypercube", "ivfflat", "ivfpq")


@dataclass
class BruteConfig:
    metric: str = "l2"
    pivots: int = 0          # above 0: a pivot index is built, and exact searches skip what it rules out
    block_rows: int = 1 << 18


@dataclass
class IVFFlatConfig:
    k: int = 50
    nprobe: int = 5
    metric: str = "l2"
    seed: int = 1
    train_size: int | None = None
    max_iter: int = 50


@dataclass
class IVFPQConfig:
    k: int = 50
    nprobe: int = 5
    m: int = 16
    nbits: int = 8
    metric: str = "l2"
    seed: int = 1
    train_size: int | None = None
    max_iter: int = 50
    train_iters: int = 20


@dataclass
class Index:
    method: str
    base: DataFrame
    metric: str
    model: Any = None
    config: Any = field(default=None, repr=False)
    lists: DataFrame | None = field(default=None, repr=False)  # stored vectors by bucket or vertex
    sizes: DataFrame | None = field(default=None, repr=False)  # points of each vertex (hypercube)


def _default_config(method: str):
    return {"brute": BruteConfig, "lsh": lsh.LSHParams, "hypercube": hypercube.CubeParams,
            "ivfflat": IVFFlatConfig, "ivfpq": IVFPQConfig}[method]()


def build(method: str, base: DataFrame, config=None, centroids=None) -> Index:
    """Build an index over ``base(id, v)``.  Unknown method names raise (no silent fallback)."""
    method = method.lower()
    if method not in METHODS:
        raise ValueError(f"unknown method {method!r}; choose one of {METHODS}")
    config = config or _default_config(method)
    metric = metric_name(getattr(config, "metric", "l2"))
    if method == "brute":
        model = pivot.build(base, None, config.pivots, config.block_rows, metric) if config.pivots > 0 else None
        return Index(method, base, metric, model, config)
    d = vector_dim(base)
    if method == "lsh":
        return Index(method, base, metric, lsh.draw_lsh(config, d or 0), config)
    if method == "hypercube":
        return Index(method, base, metric, hypercube.draw_cube(config, d or 1), config)
    if method == "ivfflat":
        kp = cluster.KMediansParams(k=config.k, metric=metric, seed=config.seed, train_size=config.train_size,
                                    max_iter=config.max_iter)
        return Index(method, base, metric, ivfflat.build_ivfflat(base, centroids, kp), config)
    kp = cluster.KMediansParams(k=config.k, metric=metric, seed=config.seed, train_size=config.train_size,
                                max_iter=config.max_iter)
    pp = pq.PQParams(m=config.m, nbits=config.nbits, nprobe=config.nprobe, seed=config.seed, metric=metric,
                     train_iters=config.train_iters, coarse=kp)
    return Index(method, base, metric, pq.build_ivfpq(base, pp, centroids), config)


def search(index: Index, queries: DataFrame, n: int, radius: float | None = None,
           persist: bool | str = True) -> tuple[DataFrame, DataFrame | None]:
    """Top-``n`` neighbours and, when ``radius > 0``, radius hits of every query, from one scan.

    ``persist=False`` writes nothing between them: each output scans again (for long-running callers such
    as streams).  ``persist=exact.COUNTS`` gives ``(qid, hits)``, the number of hits, for the hits."""
    base, m = index.base, index.model
    want_range = radius is not None and radius > 0
    if index.method == "brute" and m is not None:
        hits = pivot.range_search(m, queries, radius) if want_range else None
        if hits is not None and persist == exact.COUNTS:
            hits = hits.groupBy("qid").agg(F.count(F.lit(1)).alias("hits"))
        return pivot.knn(m, queries, n), hits
    if index.method == "brute":
        if want_range:
            return exact.knn_and_range(base, queries, n, radius, index.metric, persist=persist)
        return exact.knn(base, queries, n, index.metric), None
    if index.method in ("lsh", "hypercube"):
        buckets = lsh if index.method == "lsh" else hypercube
        stored = {"lists": index.lists} | ({"sizes": index.sizes} if index.method == "hypercube" else {})
        if want_range:
            return buckets.search_and_range(m, base, queries, n, radius, persist, **stored)
        return buckets.search(m, base, queries, n, **stored), None
    if index.method == "ivfflat":
        nprobe = index.config.nprobe
        if want_range:
            return ivfflat.search_and_range(m, queries, n, radius, nprobe, persist)
        return ivfflat.search(m, queries, n, nprobe), None
    if want_range:
        return pq.search_and_range(m, base, queries, n, radius, persist)
    return pq.search(m, base, queries, n), None


@dataclass
class EvaluationRun:
    neighbors: DataFrame
    range_hits: DataFrame | None  # None as well where only their numbers are kept
    truth: DataFrame
    compare: DataFrame
    evaluation: DataFrame
    hit_counts: DataFrame | None = None  # (qid, hits)


def evaluate(method: str, base: DataFrame, queries: DataFrame, n: int, radius: float | None = None,
             config=None, centroids=None, keep_hits: bool = True) -> EvaluationRun:
    """M6: build, exact truth, approximate run, timed metrics (M1-M5).

    The evaluation row also carries the run configuration as a JSON ``config`` column (D17).  Without ``keep_hits`` the
    run finds all radius hits as well, but keeps their number for each query only: under a wide radius they are a share
    of all (query, row) pairs."""
    import dataclasses
    import json

    index = build(method, base, config, centroids)
    found: dict[str, DataFrame | None] = {}

    def approximate() -> DataFrame:
        neighbors, found["hits"] = search(index, queries, n, radius, persist=True if keep_hits else exact.COUNTS)
        return neighbors

    row, neighbors, truth = M.throughput(approximate, lambda: exact.knn(base, queries, n, index.metric), queries, n, method)
    hits = found["hits"]
    counts = hits if hits is None or not keep_hits else hits.groupBy("qid").agg(F.count(F.lit(1)).alias("hits"))
    cfg = dataclasses.asdict(index.config) if dataclasses.is_dataclass(index.config) else {}
    cfg.update({"method": method, "N": n, "R": radius})
    evaluation = row.withColumn("config", F.lit(json.dumps(cfg, sort_keys=True)))
    return EvaluationRun(neighbors, hits if keep_hits else None, truth, M.truth_compare(neighbors, truth), evaluation, counts)


# --------------------------------------------------------------------------- persistence
#
# An index is saved as the tables of FIXTURES §4 plus a small JSON file of its configuration:
#   brute:     with pivots, pivot_index: pivots(k, p), rows(id, v, near, block) partitioned by block, blocks(block, n, lo, hi)
#   lsh:       lsh_params(t, j, s, r), lsh_lists(slot, t, bucket, id, v) partitioned by slot, sorted by bucket
#   hypercube: cube_params(i, p, t), probe_masks(prank, mask), cube_lists(part, code, id, v) partitioned by part, sorted
#              by code, cube_sizes(code, n)
#   ivfflat:   centroids(cid, c), ivf_lists(cid, id, v) partitioned by cid
#   ivfpq:     centroids(cid, c), codebooks(m, h, cw), pq_blocks(cid, n, ids, codes) partitioned by cid


def save(index: Index, path: str) -> None:
    """Write an index as plain tables under ``path`` (a shared folder on a cluster)."""
    import dataclasses
    import json

    spark = index.base.sparkSession
    out = path.rstrip("/")
    cfg = dataclasses.asdict(index.config) if dataclasses.is_dataclass(index.config) else {}
    if index.method == "brute" and index.model is None:
        cfg["pivots"] = 0  # an empty base has no pivots
    meta = {"method": index.method, "metric": index.metric, "config": cfg}
    spark.createDataFrame([(json.dumps(meta),)], "meta string").write.mode("overwrite").text(f"{out}/meta")
    m = index.model
    if index.method == "brute" and m is not None:
        pivot.save(m, f"{out}/pivot_index")
    elif index.method == "lsh":
        lsh.params_table(spark, m).write.mode("overwrite").parquet(f"{out}/lsh_params")
        index.lists = lsh.write_lists(m, index.base, f"{out}/lsh_lists")
    elif index.method == "hypercube":
        hypercube.params_table(spark, m).write.mode("overwrite").parquet(f"{out}/cube_params")
        hypercube.masks_table(spark, m).write.mode("overwrite").parquet(f"{out}/probe_masks")
        index.lists = hypercube.write_lists(m, index.base, f"{out}/cube_lists")
        index.sizes = hypercube.write_sizes(index.lists, f"{out}/cube_sizes")
    elif index.method == "ivfflat":
        m.centroids(spark).write.mode("overwrite").parquet(f"{out}/centroids")
        ivfflat.write_lists(m, f"{out}/ivf_lists")
    elif index.method == "ivfpq":
        cluster.centroids_frame(spark, m.cids, m.C).write.mode("overwrite").parquet(f"{out}/centroids")
        pq.codebook_table(spark, m).write.mode("overwrite").parquet(f"{out}/codebooks")
        pq.write_blocks(m, f"{out}/pq_blocks")


def load(spark, path: str, base: DataFrame) -> Index:
    """Read an index written by ``save``; ``base`` is the vector table it was built over."""
    import json

    import numpy as np

    src = path.rstrip("/")
    meta = json.loads(spark.read.text(f"{src}/meta").first()[0])
    method, metric, cfg = meta["method"], meta["metric"], meta["config"]
    if method == "brute":
        config = BruteConfig(**cfg)
        return Index(method, base, metric, pivot.load(spark, f"{src}/pivot_index", metric) if config.pivots > 0 else None, config)
    if method == "lsh":
        params = lsh.LSHParams(**cfg)
        rows = spark.read.parquet(f"{src}/lsh_params").orderBy("t", "j").collect()
        offsets = np.array([r["s"] for r in rows], dtype=np.float64).reshape(params.L, params.k, -1)
        model = lsh.LSHModel(params, offsets, list(rows[0]["r"]))
        return Index(method, base, metric, model, params, spark.read.parquet(f"{src}/lsh_lists"))
    if method == "hypercube":
        params = hypercube.CubeParams(**cfg)
        rows = spark.read.parquet(f"{src}/cube_params").orderBy("i").collect()
        P = np.array([r["p"] for r in rows], dtype=np.float64)
        t = np.array([r["t"] for r in rows], dtype=np.float64)
        return Index(method, base, metric, hypercube.CubeModel(params, P, t), params, spark.read.parquet(f"{src}/cube_lists"),
                     spark.read.parquet(f"{src}/cube_sizes"))
    cids, C = cluster.centroid_matrix(spark.read.parquet(f"{src}/centroids"))
    if method == "ivfflat":
        config = IVFFlatConfig(**cfg)
        lists = spark.read.parquet(f"{src}/ivf_lists").select("cid", "id", "v")
        idx = ivfflat.IVFFlatIndex(cids, C, lists, metric, base.select("id", "v"), stored=True)
        return Index(method, base, metric, idx, config)
    config = IVFPQConfig(**cfg)
    books = spark.read.parquet(f"{src}/codebooks").orderBy("m", "h").collect()
    cb = np.array([r["cw"] for r in books], dtype=np.float64).reshape(config.m, 1 << config.nbits, -1)
    pp = pq.PQParams(m=config.m, nbits=config.nbits, nprobe=config.nprobe, seed=config.seed, metric=metric,
                     train_iters=config.train_iters)
    return Index(method, base, metric, pq.PQIndex(pp, cids, C, cb, pq.read_blocks(spark, f"{src}/pq_blocks")), config)
