"""Coarse clustering shared by IVFFlat and IVFPQ.

Centroid tables are ``(cid INT, c ARRAY<DOUBLE>)``.  A centroid table is the only state that
passes through the driver (``k x d`` values, size-checked); point tables stay distributed.
Assignment is a narrow ``mapInArrow`` pass with the centroid matrix in the task closure.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knnspark.functions.distance import arrow_matrix, metric_name, pairwise, smallest_k, smallest_k_l2, usable_rows
from knnspark.functions.hashing import md5_uniform
from knnspark.functions.stats import assemble_vectors, exact_median, explode_dims
from knnspark.operators.blocks import CHUNK_BYTES, check_broadcast, chunks, shared_batches
from knnspark.session import DEFAULT_MAX_BROADCAST_BYTES, StateTable, broadcast_bound, scratch_path
from knnspark.sources.vectors import vector_dim

CENTROID_SCHEMA = "cid int, c array<double>"

# --------------------------------------------------------------------------- centroid tables


def centroid_matrix(centroids: DataFrame, max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """Collect a centroid table (size checked by one aggregate first) -> ``(cids, C)`` by ``cid``."""
    stats = centroids.agg(F.count(F.lit(1)).alias("k"), F.max(F.size("c")).alias("d")).first()
    k = int(stats["k"])
    if k == 0:
        return np.empty(0, dtype=np.int32), np.empty((0, 0))
    check_broadcast(k * (8 * int(stats["d"]) + 16), "centroid table", max_bytes)
    tbl = centroids.select(F.col("cid").cast("int"), F.col("c").cast("array<double>")).toArrow()
    cids = tbl.column(0).to_numpy()
    C, _ = arrow_matrix(tbl.column(1))
    order = np.argsort(cids, kind="stable")
    return cids[order].astype(np.int32), np.ascontiguousarray(C[order])


def long_to_matrix(long: DataFrame, key: str = "cid", dim: str = "dim", value: str = "m",
                   max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """Collect a long ``(key, dim, value)`` table as ``(keys, matrix)`` in one job.

    Each row holds three scalars, so ``limit(max_bytes // 32 + 1)`` bounds what reaches the
    driver; more rows than that raise instead of being collected.
    """
    cap = max(1, broadcast_bound(max_bytes) // 32)
    tbl = long.select(F.col(key).cast("int"), F.col(dim).cast("int"), F.col(value).cast("double")).limit(cap + 1).toArrow()
    if tbl.num_rows > cap:
        raise MemoryError("centroid table exceeds the broadcast bound")
    if tbl.num_rows == 0:
        return np.empty(0, dtype=np.int32), np.empty((0, 0))
    k = tbl.column(0).to_numpy()
    j = tbl.column(1).to_numpy()
    x = tbl.column(2).to_numpy(zero_copy_only=False)
    keys, row = np.unique(k, return_inverse=True)
    M = np.full((len(keys), int(j.max()) + 1), np.nan)
    M[row, j] = x
    if np.isnan(M).any():
        raise ValueError("incomplete centroid table")
    return keys.astype(np.int32), M


def label_median_matrix(base: DataFrame, label_col: str = "label") -> tuple[np.ndarray, np.ndarray]:
    """``label_medians`` collected straight from the long median table (one job after the bracket)."""
    med = exact_median(explode_dims(base, "v", [label_col]), [label_col, "dim"], "x", "m")
    return long_to_matrix(med, label_col, "dim", "m")


def centroids_frame(spark, cids: np.ndarray, C: np.ndarray) -> DataFrame:
    rows = [(int(c), [float(x) for x in row]) for c, row in zip(cids, C)]
    return spark.createDataFrame(rows, CENTROID_SCHEMA)


def label_medians(base: DataFrame, label_col: str = "label") -> DataFrame:
    """One k-medians update (K6) with labels as the assignment: per label, per dimension median."""
    med = exact_median(explode_dims(base, "v", [label_col]), [label_col, "dim"], "x", "m")
    return (assemble_vectors(med, [label_col], "dim", "m", "c")
            .select(F.col(label_col).cast("int").alias("cid"), "c"))


# --------------------------------------------------------------------------- nearest centroids


def nearest_centroids(X: np.ndarray, cids: np.ndarray, C: np.ndarray, metric: str,
                      k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` nearest centroids of every row by exact ``(dist, cid)``: ``(dist, cid)`` matrices.

    L2 goes through the GEMM pre-filter (same answer, matrix-product speed)."""
    if metric == "l2":
        return smallest_k_l2(X, C, cids, k)
    D = pairwise(X, C, metric)
    return smallest_k(D, np.broadcast_to(cids.astype(np.int64), D.shape), k)


def nearest_cid(X: np.ndarray, cids: np.ndarray, C: np.ndarray, metric: str) -> np.ndarray:
    """K3 on a batch: the nearest centroid's id, lowest id on ties."""
    return nearest_centroids(X, cids, C, metric, 1)[1][:, 0]


def _nearest_kernel(cids, C, k, metric, key_col, vec_col, carry, long):
    check_broadcast(C.nbytes, "centroid matrix")        # shipped to every task with the closure
    d = C.shape[1]

    def run(batches):
        for rb in batches:
            if rb.num_rows == 0:
                continue
            # Points with a bad vector raise (S6); queries with one get no probe.
            ok = usable_rows(rb.column(vec_col), d) if long else np.arange(rb.num_rows)
            if len(ok) == 0:
                continue
            sub = rb.take(pa.array(ok)) if len(ok) != rb.num_rows else rb
            X, _ = arrow_matrix(sub.column(vec_col), d)
            kk = min(k, C.shape[0])
            dist, cid = nearest_centroids(X, cids, C, metric, kk)
            keys = sub.column(key_col)
            if long:
                rows = np.repeat(np.arange(sub.num_rows), kk)
                arrays = [keys.take(pa.array(rows)), pa.array(np.tile(np.arange(1, kk + 1), sub.num_rows), pa.int32()),
                          pa.array(cid.ravel(), pa.int32()), pa.array(dist.ravel(), pa.float64())]
                names = [key_col, "prank", "cid", "cdist"]
                arrays += [sub.column(c).take(pa.array(rows)) for c in carry]
            else:
                arrays = [keys, pa.array(cid[:, 0], pa.int32()), pa.array(dist[:, 0], pa.float64())]
                if kk > 1:
                    arrays += [pa.array(cid[:, 1], pa.int32()), pa.array(dist[:, 1], pa.float64())]
                else:
                    arrays += [pa.nulls(sub.num_rows, pa.int32()), pa.nulls(sub.num_rows, pa.float64())]
                names = [key_col, "cid", "dist", "cid2", "dist2"]
                arrays += [sub.column(c) for c in carry]
            names += list(carry)
            yield pa.RecordBatch.from_arrays(arrays, names=names)
    return run


def _carry_schema(df: DataFrame, carry: list[str]) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields if f.name in carry)


def assign(points: DataFrame, centroids, metric: str = "l2", key_col: str = "id", vec_col: str = "v",
           carry: tuple[str, ...] = ()) -> DataFrame:
    """K3 + K4: nearest and second nearest centroid of every point (lowest cid on ties).

    -> ``(key, cid, dist, cid2, dist2, *carry)``; ``cid2``/``dist2`` are null with one centroid.
    """
    metric = metric_name(metric)
    cids, C = centroids if isinstance(centroids, tuple) else centroid_matrix(centroids)
    carry = [c for c in carry if c != key_col]
    key_t = points.schema[key_col].dataType.simpleString()
    schema = f"{key_col} {key_t}, cid int, dist double, cid2 int, dist2 double"
    if carry:
        schema += ", " + _carry_schema(points, carry)
    if len(cids) == 0:
        return points.sparkSession.createDataFrame([], schema)
    return points.select(key_col, vec_col, *[c for c in carry if c != vec_col]).mapInArrow(
        _nearest_kernel(cids, C, 2, metric, key_col, vec_col, carry, long=False), schema)


def nearest_probes(queries: DataFrame, centroids, nprobe: int, metric: str = "l2", key_col: str = "qid",
                   vec_col: str = "qv", carry: tuple[str, ...] = ("qv",)) -> DataFrame:
    """The ``min(nprobe, k)`` nearest centroids of every query -> ``(qid, prank, cid, cdist, *carry)``."""
    metric = metric_name(metric)
    cids, C = centroids if isinstance(centroids, tuple) else centroid_matrix(centroids)
    carry = list(carry)
    key_t = queries.schema[key_col].dataType.simpleString()
    schema = f"{key_col} {key_t}, prank int, cid int, cdist double"
    if carry:
        schema += ", " + _carry_schema(queries, carry)
    if len(cids) == 0 or nprobe <= 0:
        return queries.sparkSession.createDataFrame([], schema)
    cols = [key_col] + ([vec_col] if vec_col not in carry else []) + carry
    return queries.select(*cols).mapInArrow(
        _nearest_kernel(cids, C, nprobe, metric, key_col, vec_col, carry, long=True), schema)


# --------------------------------------------------------------------------- quality scores


def silhouette_fast(assigned: DataFrame) -> DataFrame:
    """Simplified silhouette from own / nearest other centroid distances.

    -> ``(cid, n, silhouette)`` per cluster plus one row with ``cid`` NULL for the overall mean.
    With a single centroid the other distance is +inf in effect, giving 1.
    """
    a, b = F.col("dist"), F.col("dist2")
    s = (F.when(b.isNull(), F.lit(1.0))
         .when(F.greatest(a, b) > 0, (b - a) / F.greatest(a, b))
         .otherwise(F.lit(0.0)))
    return (assigned.withColumn("s", s).rollup("cid")
            .agg(F.count(F.lit(1)).cast("bigint").alias("n"), F.avg("s").alias("silhouette")))


# Asking points of a cluster, and members of it, that are compared at once.
SILHOUETTE_BLOCK = 2048


def _asked_kernel(members: str, dim: int, metric: str, block: int):
    """For every asking point (c, id, other, v), the sum and number of its distances to the members of cluster
    ``c`` (not to itself): the cluster's members are streamed past a block of the points that ask about it."""
    def run(batches):
        for chunk in chunks(batches, CHUNK_BYTES):
            asks = pa.Table.from_batches(chunk)
            cluster, ids = asks.column("c").to_numpy(), asks.column("id").to_numpy()
            for c in np.unique(cluster).tolist():
                at = np.flatnonzero(cluster == c)
                for lo in range(0, len(at), block):
                    rows = at[lo:lo + block]
                    X, _ = arrow_matrix(asks.column("v").take(pa.array(rows)), dim)
                    total, n = np.zeros(len(rows)), np.zeros(len(rows), np.int64)
                    for held in shared_batches(f"{members}/cid={c}", ["id", "v"], block):
                        Y, _ = arrow_matrix(held.column(1), dim)
                        same = ids[rows][:, None] == held.column(0).to_numpy()[None, :]
                        D = pairwise(X, Y, metric)
                        D[same] = 0.0
                        total += D.sum(axis=1)
                        n += (~same).sum(axis=1)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[rows]), asks.column("other").take(pa.array(rows)).combine_chunks(), pa.array(total), pa.array(n)],
                        names=["id", "other", "total", "n"])
    return run


def silhouette_full(points: DataFrame, assigned: DataFrame, metric: str = "l2", block: int = SILHOUETTE_BLOCK) -> DataFrame:
    """Silhouette with ``a`` = mean distance to the other members of the own cluster and
    ``b`` = mean distance to the members of the second-nearest centroid's cluster.

    Singletons and points whose second cluster is empty score 0 (D12).  The work is quadratic
    within clusters, as in the reference, but neither shuffle nor disk is: the members are written once, in a folder
    for each cluster, and every point is shuffled twice, as it asks about two clusters.  A task owns some asking points,
    sorted by cluster, and streams that cluster's folder past each block of them; a cluster with most of the points is
    many tasks' asking points.  -> ``(cid, n, silhouette)`` per cluster plus the overall row with ``cid`` NULL.
    """
    metric, spark = metric_name(metric), assigned.sparkSession
    if "v" in assigned.columns:          # assignment computed with carry=("v",): no join with the base
        table = assigned.select("id", "v", "cid", "cid2")
    else:
        table = points.select("id", "v").join(assigned.select("id", "cid", "cid2"), "id")
    path, n = scratch_path(spark, "silhouette-members"), int(spark.conf.get("spark.sql.shuffle.partitions"))
    table.repartitionByRange(n, "cid", "id").write.partitionBy("cid").parquet(path)
    table = spark.read.schema("id bigint, v array<double>, cid2 int, cid int").parquet(path)
    dim = vector_dim(table) or 0
    about = F.array(F.struct(F.col("cid").alias("c"), F.lit(0).alias("other")), F.struct(F.col("cid2").alias("c"), F.lit(1).alias("other")))
    asks = table.select("id", "v", F.explode(about).alias("a")).select("a.c", "id", "a.other", "v").where(F.col("c").isNotNull())
    dealt = asks.repartitionByRange(n, "c", "id").sortWithinPartitions("c", "id")
    sums = (dealt.mapInArrow(_asked_kernel(path, dim, metric, block), "id bigint, other int, total double, n bigint")
            .groupBy("id").agg(*(F.sum(F.when(F.col("other") == k, F.col(c))).alias(f"{p}{x}")
                                 for k, x in ((0, "a"), (1, "b")) for c, p in (("total", "s"), ("n", "n")))))
    a = F.col("sa") / F.when(F.col("na") > 0, F.col("na"))
    b = F.col("sb") / F.when(F.col("nb") > 0, F.col("nb"))
    s = (F.when((F.coalesce("na", F.lit(0)) == 0) | (F.coalesce("nb", F.lit(0)) == 0), F.lit(0.0))
         .when(F.greatest(a, b) > 0, (b - a) / F.greatest(a, b)).otherwise(F.lit(0.0)))
    per_point = table.select("id", "cid").join(sums, "id", "left").withColumn("s", s)
    return (per_point.rollup("cid")
            .agg(F.count(F.lit(1)).cast("bigint").alias("n"), F.avg("s").alias("silhouette")))


def cluster_sizes(assigned: DataFrame) -> DataFrame:
    """K11 in relational form: ``(cid, n, min_id, max_id)``; membership itself is ``(cid, id)``."""
    return assigned.groupBy("cid").agg(F.count(F.lit(1)).cast("bigint").alias("n"),
                                       F.min("id").alias("min_id"), F.max("id").alias("max_id"))


# --------------------------------------------------------------------------- training (K1, K2, K5-K7)


@dataclass
class KMediansParams:
    k: int = 10
    metric: str = "l2"
    seed: int = 1
    train_size: int | None = None   # None -> floor(sqrt(n)) as in the reference
    max_iter: int = 50
    tol_changes: int = 1            # stop when at most this many sample points change cluster


def training_sample(points: DataFrame, size: int, seed: int = 1, total: int | None = None) -> DataFrame:
    """K1: the ``size`` points that come first in ``(md5(seed:id), id)`` order.

    The md5 order is uniform, so a filter ``u < t`` with ``t`` a little above ``size / n`` keeps
    slightly more than ``size`` rows; the exact first ``size`` are then taken from that small set.
    This avoids a global top-k that would funnel every partition's candidates into one task; the
    sample is a filter, so it keeps the partitions of ``points``.
    ``t`` is raised until the filter keeps enough rows (expected once).
    """
    size = int(size)
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("id").cast("string")))
    u = md5_uniform(F.concat_ws(":", F.lit(str(seed)), F.col("id").cast("string")))
    keyed = points.withColumn("_k", key).withColumn("_u", u)
    n = total if total is not None else points.count()
    if size <= 0 or n == 0:
        return points.limit(0)
    t = min(1.0, 1.2 * size / n + 8.0 * np.sqrt(size) / n + 1e-9)
    while True:
        kept = keyed.where(F.col("_u") < F.lit(t)) if t < 1.0 else keyed
        if t >= 1.0 or kept.count() >= size:
            break
        t = min(1.0, t * 2.0)
    k, i = _nth_key(kept, size, float(t))
    return kept.where((F.col("_k") < k) | ((F.col("_k") == k) & (F.col("id") <= i))).drop("_k", "_u")


# Rows whose keys are sorted to find one of them.
_FEW_KEYS = 10_000


def _nth_key(keyed: DataFrame, n: int, top: float) -> tuple[str, int]:
    """The ``(_k, id)`` of the n-th row (1-based) in order of them, or of the last row if there are fewer.

    ``_u`` is the key's beginning as a number from 0 to ``top``.  Counts of 1,024 ranges of it (one aggregate, a row for
    each) narrow it down to the range that holds the row, until that has few rows; those are sorted."""
    low, high, rows = 0.0, min(top, 1.0), keyed.select("_k", "id", "_u")
    while True:
        width = (high - low) / 1024
        at = F.least(F.floor((F.col("_u") - F.lit(low)) / F.lit(width)), F.lit(1023)).cast("int").alias("at")
        counts = sorted(rows.groupBy(at).agg(F.count(F.lit(1)).alias("n")).collect())
        before = 0
        for at_, here in counts:
            if before + here >= n or at_ == counts[-1][0]:
                break
            before += here
        # Range bounds as the aggregate saw them: rows are chosen by the same expression.
        rows, n = rows.where(at == at_), min(n - before, here)
        if here <= _FEW_KEYS or width < 1e-15:
            last = rows.select(F.struct("_k", "id").alias("o")).orderBy("o").offset(n - 1).limit(1).collect()[0]["o"]
            return last["_k"], last["id"]
        low, high = low + at_ * width, low + (at_ + 1) * width


# Rounds of seeding after which the points' distances are written.
SEED_STATE_ROUNDS = 8


def _nearer_kernel(C: np.ndarray, metric: str):
    """Distances ``d`` to the nearest centre so far (null: none yet), brought up to date with new centres."""
    def run(batches):
        for rb in batches:
            if rb.num_rows == 0:
                continue
            X, _ = arrow_matrix(rb.column("v"), C.shape[1])
            d = rb.column("d").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([rb.column("id"), rb.column("v"), pa.array(np.fmin(d, pairwise(X, C, metric).min(axis=1)))],
                                             names=["id", "v", "d"])
    return run


def kmeanspp_seeds(sample: DataFrame, k: int, metric: str = "l2", seed: int = 1,
                   with_ids: bool = False, state_rounds: int = SEED_STATE_ROUNDS) -> tuple[np.ndarray, ...]:
    """K2: k-means++ seeding; stops early when all remaining distances are 0.

    A draw is an exponential race: argmin ``-ln(u)/d^2`` over the points with d > 0, with ``d`` the metric distance to
    the nearest centre so far and ``u`` from md5, so a draw is a plain aggregate (no global window) and reproducible.
    ``d`` is a running minimum: a round compares the points with the centres since the state table was written, which
    happens every ``state_rounds`` rounds, and never with all of them.

    Returns ``(cids, C)`` -- plus the chosen points' ids with ``with_ids`` -- where seed ``r``
    gets cid ``r`` (0-based).
    """
    metric = metric_name(metric)
    ids: list[int] = []
    rows: list[np.ndarray] = []
    state, written = sample.select("id", "v", F.lit(None).cast("double").alias("d")), 0
    for r in range(int(k)):
        now = state
        if len(rows) > written:
            now = state.mapInArrow(_nearer_kernel(np.vstack(rows[written:]), metric), "id bigint, v array<double>, d double")
            if len(rows) - written >= state_rounds:
                state = now = now.checkpoint(eager=True)
                written = len(rows)
        u = md5_uniform(F.concat_ws(":", F.lit(str(seed)), F.lit(str(r)), F.col("id").cast("string")))
        key = F.when(F.col("d").isNull(), -F.log(u)).when(F.col("d") > 0, -F.log(u) / (F.col("d") * F.col("d")))
        scored = now.select("id", "v", key.alias("key")).where(F.col("key").isNotNull())
        best = scored.agg(F.min_by(F.struct("id", "v"), F.struct("key", "id")).alias("b")).first()["b"]
        if best is None:
            break
        ids.append(int(best["id"]))
        rows.append(np.asarray(best["v"], dtype=np.float64))
    C = np.vstack(rows) if rows else np.empty((0, 0))
    cids = np.arange(len(rows), dtype=np.int32)
    return (cids, C, np.array(ids, dtype=np.int64)) if with_ids else (cids, C)


LLOYD_STATE = "id bigint, v array<double>, cid int, u double, l double, changed int, compared int"
# Above the rounding of distances and of their sums.
_SLACK = 1e-9


def moves(before: np.ndarray, after: np.ndarray, metric: str) -> np.ndarray:
    """How far each centroid went."""
    d = after - before
    return np.abs(d).sum(axis=1) if metric == "l1" else np.sqrt(np.einsum("ij,ij->i", d, d))


def moved_bounds(u: np.ndarray, l: np.ndarray, own: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Upper bound on the distance to the own centre (a row number) and lower bound on those to the others, after the
    centres moved: the own one's move comes on top, the largest move of another goes off."""
    order = np.argsort(-move, kind="stable")
    most = np.where(own == order[0], move[order[1]] if len(move) > 1 else 0.0, move[order[0]])
    return u + move[own], l - most


def _lloyd_kernel(cids: np.ndarray, C: np.ndarray, before: np.ndarray | None, metric: str):
    """Assignment with its bounds: ``u`` at least the distance to the own centroid, ``l`` at most that to any other.

    With a state (``before``: the centroids it was made under) only points whose moved bounds cross are compared
    with all centroids again, after their own distance was computed anew; ``changed`` and ``compared`` (the number of
    centroids a point was compared with) say what happened."""
    check_broadcast(2 * C.nbytes, "centroid matrix")

    def run(batches):
        for rb in batches:
            if rb.num_rows == 0:
                continue
            X, _ = arrow_matrix(rb.column("v"), C.shape[1])
            n = len(X)
            if before is None:
                old, row = np.zeros(n, np.int64), np.zeros(n, np.int64)
                u, l, compared = np.full(n, np.inf), np.full(n, -np.inf), np.zeros(n, np.int64)
            else:
                old = rb.column("cid").to_numpy().astype(np.int64)
                row = np.searchsorted(cids, old)
                u, l = moved_bounds(rb.column("u").to_numpy(), rb.column("l").to_numpy(), row, moves(before, C, metric))
                compared = np.zeros(n, np.int64)
                near = np.flatnonzero(~(u * (1 + _SLACK) < l))
                d = X[near] - C[row[near]]
                u[near] = np.abs(d).sum(axis=1) if metric == "l1" else np.sqrt(np.einsum("ij,ij->i", d, d))
                compared[near] = 1
            cid = old.copy()
            at = np.flatnonzero(~(u * (1 + _SLACK) < l))
            if len(at):
                dist, found = nearest_centroids(X[at], cids, C, metric, min(2, len(cids)))
                cid[at], u[at], compared[at] = found[:, 0], dist[:, 0], len(cids)
                l[at] = dist[:, 1] if dist.shape[1] > 1 else np.inf
            yield pa.RecordBatch.from_arrays(
                [rb.column("id"), rb.column("v"), pa.array(cid, pa.int32()), pa.array(u), pa.array(l),
                 pa.array((cid != old).astype(np.int32)), pa.array(compared, pa.int32())],
                names=["id", "v", "cid", "u", "l", "changed", "compared"])
    return run


def lloyd_assign(points: DataFrame, cids, C, metric: str, before: np.ndarray | None = None) -> DataFrame:
    """K5: the state ``(id, v, cid, u, l, changed, compared)`` of ``points(id, v)``, or of the state made under the
    centroids ``before``.  ``changed`` is against that state's cluster, at first against cluster 0 as in the reference."""
    cols = ["id", "v"] if before is None else ["id", "v", "cid", "u", "l"]
    return points.select(*cols).mapInArrow(_lloyd_kernel(np.asarray(cids), C, before, metric), LLOYD_STATE)


def kmedians_step(sample: DataFrame, cids, C, metric: str, prev: tuple | None = None):
    """K5 + K6: assign, count changes against the assignment under ``prev`` centroids (initially
    cluster 0, as in the reference), median update.

    ``sample`` is ``(id, v)``, or the state that ``lloyd_assign`` made under ``prev``.  Empty clusters keep their old
    centroid (D8).  Returns (state, changes, new (cids, C)).
    """
    if prev is not None and "u" not in sample.columns:
        sample = lloyd_assign(sample, *prev, metric)
    cur = lloyd_assign(sample, cids, C, metric, None if prev is None else prev[1])
    return (cur, *_median_update(cur, cids, C))


def _median_update(state: DataFrame, cids, C) -> tuple[int, tuple[np.ndarray, np.ndarray]]:
    """K6: the number of changes in a state, and its clusters' medians."""
    # the change count rides on the median's first pass (counted once per point: dimension 0)
    long = explode_dims(state.select("v", "cid", "changed"), "v", ["cid", "changed"])
    long = long.withColumn("changed", F.when(F.col("dim") == 0, F.col("changed")).otherwise(0))
    sums: dict = {}
    med = exact_median(long, ["cid", "dim"], "x", "m", side_sum="changed", side_out=sums)
    changes = int(sums["sum"] or 0)
    ncids, nC = long_to_matrix(med, "cid", "dim", "m")
    C2 = C.copy()
    pos = {int(c): i for i, c in enumerate(cids)}
    for c, row in zip(ncids, nC):
        C2[pos[int(c)]] = row
    return changes, (cids, C2)


def kmedians_fit(points: DataFrame, params: KMediansParams) -> tuple[np.ndarray, np.ndarray, int]:
    """K1 -> K2 -> Lloyd loop (K5, K6) until changes <= tol or ``max_iter``.  Returns (cids, C, iters).

    The sample is written once to the shared checkpoint folder (reliable ``checkpoint``).  Every round writes one state
    table (the points with their cluster and bounds) from the one before, which then goes: a round's plan is that
    table plus literal centroids, so lineage does not grow, every point is assigned once a round, and only those whose
    bounds cross are compared with all centroids.  Only ``k x d`` centroid values
    go through the driver per iteration.
    """
    metric = metric_name(params.metric)
    total = points.count()
    n = params.train_size
    if n is None:
        n = max(1, int(np.floor(np.sqrt(total))))
    sample = training_sample(points.select("id", "v"), n, params.seed, total).checkpoint(eager=True)
    cids, C = kmeanspp_seeds(sample, params.k, metric, params.seed)
    if len(cids) == 0:
        return cids, C, 0
    table, state, before, it = StateTable(points.sparkSession, "lloyd-state"), sample, None, 0
    while it < params.max_iter:
        state = table.put(lloyd_assign(state, cids, C, metric, before))
        before = C
        changes, (cids, C) = _median_update(state, cids, C)
        it += 1
        if changes <= params.tol_changes:
            break
    table.drop()
    return cids, C, it
