"""IVFPQ (P1-P8): coarse cells + product-quantised residuals, asymmetric distance search.

Build
  P1  residual training set ``(id, r)``: assignment pass, ``v - c(v)``, one row a point; part ``m`` is a slice of ``r``.
  P2  codebook seeding: k-means++ per part by an exponential race keyed by ``m`` -- one job per
      round trains all M sub-spaces together.
  P3  Lloyd with mean updates per part (<= ``train_iters`` rounds, a part stops when no point
      changes); an empty centre takes a random point of its part (md5 order).  Each round is one
      aggregation over the parts; only the ``M x 2^nbits x d/M`` codebook goes through the driver.
  P4  encoding: one narrow pass -> ``pq_blocks(cid, n, ids, codes)``, a row for some points of a cell with their codes
      part by part (``pq_codes`` has a row a point).

Search
  P5  lookup tables per probed ``(qid, cid)``: squared L2 from each residual part to each code word.
  P6  ADC: one candidate scan of the codes table (``operators.scan``) past the queries' blocks; the codes
      table is streamed, never shuffled.
  P7  queries with no candidate at all fall back to an exact scan (``left_anti`` + exact kNN).
  P8  top-N / radius on the approximate distance.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knnspark.functions.distance import arrow_matrix, metric_name, pairwise
from knnspark.functions.hashing import md5_uniform
from knnspark.operators import cluster, exact
from knnspark.operators.blocks import Block, check_broadcast, probed_only, query_side
from knnspark.operators.exact import RANGE_SCHEMA, top_n
from knnspark.operators.scan import PAIR_SCHEMA, GroupTopN, emit_scored, finish_topn, run_blocks
from knnspark.operators.rerank import rerank
from knnspark.session import DEFAULT_MAX_BROADCAST_BYTES, StateTable, scratch_path


@dataclass
class PQParams:
    m: int = 16                  # sub-vectors
    nbits: int = 8               # bits per code (1..8, D10)
    nprobe: int = 5
    seed: int = 1
    metric: str = "l2"           # coarse stage and fallback only; codebooks are always L2
    train_iters: int = 20
    codebook_train_size: int | None = None   # None: all residuals (reference); else an md5 sample of points
    coarse: cluster.KMediansParams = field(default_factory=lambda: cluster.KMediansParams(k=50))

    def __post_init__(self):
        if self.m <= 0:
            raise ValueError("sub-vector count M must be positive")
        if not 1 <= self.nbits <= 8:
            raise ValueError("nbits must be in 1..8")
        self.metric = metric_name(self.metric)
        self.nprobe = max(1, int(self.nprobe))      # PQ forces at least one probe

    @property
    def ksub(self) -> int:
        return 1 << self.nbits


@dataclass
class PQIndex:
    params: PQParams
    cids: np.ndarray
    C: np.ndarray                 # coarse centroids (k x d)
    codebooks: np.ndarray         # (M, 2^nbits, d/M)
    blocks: DataFrame             # (cid, n, ids, codes): some points of a cell a row
    filled: list[int] | None = None

    @property
    def codes(self) -> DataFrame:
        """``(cid, id, codes)``, a row a point."""
        return code_rows(self.blocks, self.codebooks.shape[0])

    def filled_cells(self) -> list[int]:
        """The cells that hold a point (k at most); the codes are read for it once."""
        if self.filled is None:
            self.filled = sorted(r["cid"] for r in self.blocks.select("cid").distinct().collect())
        return self.filled

    @property
    def dim(self) -> int:
        return int(self.C.shape[1])


# --------------------------------------------------------------------------- P1


def residuals(points: DataFrame, cids, C, metric: str) -> DataFrame:
    """``(id, r ARRAY<DOUBLE>)``: the residual to the nearest coarse centroid, one row a point; its parts are
    consecutive slices of it."""
    check_broadcast(C.nbytes, "centroid matrix")

    def run(batches):
        for rb in batches:
            if rb.num_rows:
                X, _ = arrow_matrix(rb.column("v"), C.shape[1])
                cid = cluster.nearest_cid(X, cids, C, metric)
                yield _rows_batch(rb.column("id"), r=X - C[np.searchsorted(cids, cid)])

    return points.select("id", "v").mapInArrow(run, "id bigint, r array<double>")


# --------------------------------------------------------------------------- P2 / P3


def _rows_batch(ids: pa.Array, **matrices: np.ndarray) -> pa.RecordBatch:
    """A batch of ids and, for each matrix, a list column with its rows."""
    lists = [pa.ListArray.from_arrays(pa.array(np.arange(0, m.size + 1, m.shape[1], dtype=np.int32)), pa.array(m.ravel())) for m in matrices.values()]
    return pa.RecordBatch.from_arrays([ids, *lists], names=["id", *matrices])


# Rounds of codebook seeding after which the parts' distances are written.
SEED_STATE_ROUNDS = 8


def _distances(rb: pa.RecordBatch, M: int, ds: int, new: dict[int, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Residuals of a batch, and each part's squared distance to its nearest code word so far: the stored
    minimum (not a number: none yet), brought up to date with the words chosen since."""
    R, _ = arrow_matrix(rb.column("r"), M * ds)
    d2 = rb.column("d2").flatten().to_numpy(zero_copy_only=False).reshape(len(R), M).copy()
    for m, words in new.items():
        d2[:, m] = np.fmin(d2[:, m], pairwise(R[:, m * ds:(m + 1) * ds], words, "l2", squared=True).min(axis=1))
    return R, d2


def _race_kernel(M: int, ds: int, active: list[int], new: dict[int, np.ndarray]):
    """One k-means++ round: per part, the task's point with the smallest race key ``-ln(u)/d2`` (``u`` a column
    with a uniform for every part); only those winners leave the task."""
    def run(batches):
        best: dict[int, tuple[float, int, np.ndarray]] = {}
        for rb in batches:
            if rb.num_rows == 0:
                continue
            ids = rb.column("id").to_numpy(zero_copy_only=False)
            R, d2 = _distances(rb, M, ds, new)
            u = rb.column("u").flatten().to_numpy(zero_copy_only=False).reshape(len(R), M)
            for m in active:
                d = d2[:, m]
                rows = np.flatnonzero(~(d <= 0))
                if not len(rows):
                    continue
                key = -np.log(u[rows, m]) / np.where(np.isnan(d[rows]), 1.0, d[rows])
                k = np.lexsort((ids[rows], key))[0]
                won = (float(key[k]), int(ids[rows[k]]))
                if m not in best or won < best[m][:2]:
                    best[m] = (*won, R[rows[k], m * ds:(m + 1) * ds].copy())
        if best:
            rows = np.stack([b[2] for b in best.values()])
            subs = pa.ListArray.from_arrays(pa.array(np.arange(0, rows.size + 1, ds, dtype=np.int32)), pa.array(rows.ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(list(best), pa.int32()), pa.array([b[1] for b in best.values()], pa.int64()),
                                              pa.array([b[0] for b in best.values()]), subs], names=["m", "id", "key", "sub"])
    return run


def seed_codebooks(points: DataFrame, M: int, ksub: int, ds: int, seed: int, state_rounds: int = SEED_STATE_ROUNDS) -> dict[int, np.ndarray]:
    """K-means++ per part of ``points(id, r)``; a part stops early when every remaining distance is 0.

    Round ``k`` picks, for every part still seeding, ``argmin -ln(u)/d2`` with ``u`` from
    ``md5(seed:m:k:id)``: each task keeps its winner per part and one small aggregation
    per round finishes the choice for all parts.  ``d2`` is a running minimum: a round compares the parts with the words
    chosen since the state table was written, which happens every ``state_rounds`` rounds, and never with all.
    """
    books: dict[int, list[np.ndarray]] = {m: [] for m in range(M)}
    active, written = set(range(M)), 0
    state = points.select("id", "r", F.array_repeat(F.lit(float("nan")), M).alias("d2"))
    for k in range(ksub):
        if not active:
            break
        new = {m: np.vstack(b[written:]) for m, b in books.items() if len(b) > written}
        if k - written >= state_rounds:
            def update(batches, new=new):
                for rb in batches:
                    if rb.num_rows:
                        R, d2 = _distances(rb, M, ds, new)
                        yield _rows_batch(rb.column("id"), r=R, d2=d2)
            state = state.mapInArrow(update, "id bigint, r array<double>, d2 array<double>").checkpoint(eager=True)
            written, new = k, {}
        u = F.transform(F.sequence(F.lit(0), F.lit(M - 1)), lambda m: md5_uniform(
            F.concat_ws(":", F.lit(str(seed)), m.cast("string"), F.lit(str(k)), F.col("id").cast("string"))))
        picks = (state.select("id", "r", "d2", u.alias("u"))
                 .mapInArrow(_race_kernel(M, ds, sorted(active), new), "m int, id bigint, key double, sub array<double>")
                 .groupBy("m").agg(F.min_by(F.col("sub"), F.struct("key", "id")).alias("sub"))
                 .collect())
        for row in picks:
            books[int(row["m"])].append(np.asarray(row["sub"], dtype=np.float64))
        active &= {int(row["m"]) for row in picks}   # parts with no positive distance stop seeding
    return {m: np.vstack(b) if b else np.zeros((0, ds)) for m, b in books.items()}


def _pad(book: np.ndarray, ksub: int, ds: int) -> np.ndarray:
    """Missing centres are copies of the real ones, ``i % actual``."""
    if len(book) == 0:
        return np.zeros((ksub, ds))
    if len(book) >= ksub:
        return book[:ksub]
    idx = np.arange(ksub) % len(book)
    return book[idx].copy()


# Lloyd rounds of the codebooks after which the parts' words and bounds are written.
LLOYD_STATE_ROUNDS = 4


def _words(X: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest word of each row (lowest number on ties), its distance, and the distance to the next."""
    d2 = pairwise(X, book, "l2", squared=True)
    h = np.argmin(d2, axis=1)
    at = np.arange(len(h))
    u = np.sqrt(d2[at, h])
    d2[at, h] = np.inf
    return h, u, np.sqrt(d2.min(axis=1))


def _same_word(u: np.ndarray, l: np.ndarray, h: np.ndarray, at_state: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Whether a row's word is still ``h``, by its bounds of the state and the words' moves since."""
    up, low = cluster.moved_bounds(u, l, h, cluster.moves(at_state, book, "l2"))
    return up * (1 + 1e-9) < low


def _assign_kernel(prev: list | None, cur: list, active: list[int], ds: int, at_state: list | None = None):
    """One Lloyd round of a task: nearest code word (lowest index on ties) of every part under the current
    codebooks, whether it differs from the one under the previous codebooks, and per
    (part, code word, dimension) sums -- only those leave the task.

    With a state (columns ``h, u, l``, made under ``at_state``) only parts whose bounds cross under either of the two codebooks
    are compared with words; ``cmp`` counts those comparisons."""
    def run(batches):
        sums = {m: np.zeros((len(cur[m]), ds)) for m in active}
        count, change = ({m: np.zeros(len(cur[m]), np.int64) for m in active} for _ in range(2))
        compared = dict.fromkeys(active, 0)
        for rb in batches:
            if rb.num_rows == 0:
                continue
            R, _ = arrow_matrix(rb.column("r"), len(cur) * ds)
            if at_state is not None:
                H, U, L = (rb.column(c).flatten().to_numpy(zero_copy_only=False).reshape(len(R), -1) for c in ("h", "u", "l"))
            for m in active:
                X, k = R[:, m * ds:(m + 1) * ds], len(cur[m])
                if at_state is None:
                    doubt, h, old = np.arange(len(X)), np.zeros(len(X), np.int64), np.full(len(X), -1)
                else:
                    h = H[:, m].astype(np.int64)
                    sure = _same_word(U[:, m], L[:, m], h, at_state[m], cur[m]) & _same_word(U[:, m], L[:, m], h, at_state[m], prev[m])
                    doubt, old = np.flatnonzero(~sure), h.copy()
                if len(doubt):
                    compared[m] += len(doubt) * k * (1 if prev is None else 2)
                    h[doubt] = _words(X[doubt], cur[m])[0]
                    if prev is not None:
                        old[doubt] = _words(X[doubt], prev[m])[0]
                count[m] += np.bincount(h, minlength=k)
                change[m] += np.bincount(h[h != old], minlength=k)
                for j in range(ds):
                    sums[m][:, j] += np.bincount(h, weights=X[:, j], minlength=k)
        rows = [(m, h, j, sums[m][h, j], count[m][h], *((change[m][h], compared[m] if h == used[0] else 0) if j == 0 else (0, 0)))
                for m in active for used in [np.flatnonzero(count[m]).tolist()] for h in used for j in range(ds)]
        if rows:
            kinds = (pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["m", "h", "dim", "s", "c", "ch", "cmp"])
    return run


def _word_state(points: DataFrame, books: list, ds: int) -> DataFrame:
    """``(id, r, h, u, l)``: each part's word, its distance, and the distance to the next word."""
    def run(batches):
        for rb in batches:
            if rb.num_rows:
                R, _ = arrow_matrix(rb.column("r"), len(books) * ds)
                found = [_words(R[:, m * ds:(m + 1) * ds], b) for m, b in enumerate(books)]
                h, u, l = (np.stack([f[k] for f in found], axis=1) for k in range(3))
                yield _rows_batch(rb.column("id"), r=R, h=h.astype(np.int16), u=u, l=l)
    return points.select("id", "r").mapInArrow(run, "id bigint, r array<double>, h array<smallint>, u array<double>, l array<double>")


def train_codebooks(points: DataFrame, M: int, ksub: int, ds: int, seed: int, iters: int, state_rounds: int = LLOYD_STATE_ROUNDS,
                    compared: list[int] | None = None) -> np.ndarray:
    """P2 + P3: ``(M, ksub, ds)`` codebooks from the residuals ``(id, r)``.

    Every ``state_rounds`` rounds the parts' words are written with bounds; the rounds after that compare only
    parts whose bounds cross as the words move on.  ``compared`` gets the comparisons of each round.

    Part ``m`` runs k-means with ``min(ksub, points)`` centres; seeds missing after an early stop
    are copies (D11).  A part stops when an assignment round changes nothing; otherwise its
    centres become the member means and empty centres take a random point of the part.
    """
    kact = [min(ksub, points.count())] * M
    seeds = seed_codebooks(points, M, ksub, ds, seed)
    cur = [_pad(seeds[mm], kact[mm], ds) if kact[mm] else np.zeros((0, ds)) for mm in range(M)]
    check_broadcast(8 * M * ksub * ds, "PQ codebooks")
    active = {mm for mm in range(M) if kact[mm] > 0}
    prev = at_state = None
    table, state = StateTable(points.sparkSession, "codebook-state"), points.select("r")
    schema = "m int, h int, dim int, s double, c bigint, ch bigint, cmp bigint"
    for it in range(iters):
        if not active:
            break
        if it % state_rounds == state_rounds - 1 and ksub > 1:
            state, at_state = table.put(_word_state(points, prev, ds)).select("r", "h", "u", "l"), prev
        stats = (state.mapInArrow(_assign_kernel(prev, cur, sorted(active), ds, at_state), schema)
                 .groupBy("m", "h", "dim")
                 .agg((F.sum("s") / F.sum("c")).alias("mean"), F.sum("ch").alias("ch"), F.sum("cmp").alias("cmp"))
                 .collect())
        if compared is not None:
            compared.append(sum(int(r["cmp"]) for r in stats))
        changes = {mm: 0 for mm in active}
        means = {mm: cur[mm].copy() for mm in active}
        seen = set()
        for row in stats:
            mm, h, dim = int(row["m"]), int(row["h"]), int(row["dim"])
            if dim == 0:
                changes[mm] += int(row["ch"])
            means[mm][h, dim] = float(row["mean"])
            seen.add((mm, h))
        updating = {mm for mm in active if changes[mm] > 0}
        empties = [(mm, h) for mm in sorted(updating) for h in range(kact[mm]) if (mm, h) not in seen]
        if empties:
            for (mm, h), vec in _random_points(points, empties, ds, seed, it).items():
                means[mm][h] = vec
        prev = [c.copy() for c in cur]
        for mm in updating:
            cur[mm] = means[mm]
        active = updating
    table.drop()
    return np.stack([_pad(cur[mm], ksub, ds) for mm in range(M)])


def _random_points(points: DataFrame, empties: list[tuple[int, int]], ds: int, seed: int, it: int) -> dict:
    """An empty centre ``(m, h)`` takes the point of part ``m`` with the smallest md5 key."""
    each = F.array(*(F.struct(F.lit(m).alias("m"), F.lit(h).alias("h")) for m, h in empties))
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.lit("empty"), F.lit(str(it)), F.col("e.m").cast("string"),
                            F.col("e.h").cast("string"), F.col("id").cast("string")))
    rows = (points.select("id", "r", F.explode(each).alias("e")).groupBy("e.m", "e.h")
            .agg(F.min_by("r", F.struct(key.alias("k"), F.col("id"))).alias("r")).collect())
    return {(int(r["m"]), int(r["h"])): np.asarray(r["r"][r["m"] * ds:(r["m"] + 1) * ds], dtype=np.float64) for r in rows}


# --------------------------------------------------------------------------- P4


# Points of a stored block of codes.
BLOCK_POINTS = 4096
BLOCKS = "cid int, n int, ids binary, codes binary"


def _encoded(rb: pa.RecordBatch, cids, C, books: np.ndarray, metric: str) -> tuple[np.ndarray, np.ndarray]:
    """Cell and codes (points, M) of a batch's points."""
    M, _, ds = books.shape
    X, _ = arrow_matrix(rb.column("v"), C.shape[1])
    cid = cluster.nearest_cid(X, cids, C, metric).astype(np.int32)
    R = X - C[np.searchsorted(cids, cid)]
    codes = np.empty((len(X), M), dtype=np.uint8)
    for m in range(M):
        codes[:, m] = np.argmin(pairwise(R[:, m * ds:(m + 1) * ds], books[m], "l2", squared=True), axis=1)
    return cid, codes


def _blocks_of(cid: np.ndarray, ids: np.ndarray, codes: np.ndarray) -> pa.RecordBatch:
    """One row for up to ``BLOCK_POINTS`` points of a cell: their ids, and their codes part by part."""
    order = np.argsort(cid, kind="stable")
    cid, ids, codes = cid[order], ids[order], codes[order]
    edges = np.concatenate([[0], np.flatnonzero(np.diff(cid)) + 1, [len(cid)]])
    cuts = [(s, min(s + BLOCK_POINTS, b)) for a, b in zip(edges, edges[1:]) for s in range(a, b, BLOCK_POINTS)]
    return pa.RecordBatch.from_arrays(
        [pa.array([int(cid[a]) for a, _ in cuts], pa.int32()), pa.array([b - a for a, b in cuts], pa.int32()),
         pa.array([ids[a:b].astype("<i8").tobytes() for a, b in cuts], pa.binary()),
         pa.array([np.ascontiguousarray(codes[a:b].T).tobytes() for a, b in cuts], pa.binary())], names=["cid", "n", "ids", "codes"])


def encode(points: DataFrame, cids, C, books: np.ndarray, metric: str) -> DataFrame:
    """``pq_codes(cid, id, codes ARRAY<SMALLINT>)``."""
    return code_rows(encode_blocks(points, cids, C, books, metric), books.shape[0])


def encode_blocks(points: DataFrame, cids, C, books: np.ndarray, metric: str) -> DataFrame:
    """P4 in blocks: ``pq_blocks(cid, n, ids, codes)``, a row for some points of a cell with their ids (64 bits each) and
    codes (a byte each, part by part).  A search looks up a part's codes of a whole block at once."""
    check_broadcast(C.nbytes + books.nbytes, "centroids and codebooks")

    def run(batches):
        for rb in batches:
            if rb.num_rows:
                cid, codes = _encoded(rb, cids, C, books, metric)
                yield _blocks_of(cid, rb.column("id").to_numpy(zero_copy_only=False).astype(np.int64), codes)

    return points.select("id", "v").mapInArrow(run, BLOCKS)


def code_rows(blocks: DataFrame, M: int) -> DataFrame:
    """``(cid, id, codes)`` of the points of blocks."""
    def run(batches):
        for rb in batches:
            for cid, n, ids, codes in zip(*(c.to_pylist() for c in rb.columns)):
                rows = np.frombuffer(codes, np.uint8).reshape(M, n).T.astype(np.int16)
                offsets = pa.array(np.arange(0, n * M + 1, M, dtype=np.int32))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, cid), pa.int32()), pa.array(np.frombuffer(ids, "<i8")),
                                                  pa.ListArray.from_arrays(offsets, pa.array(rows.ravel()))], names=["cid", "id", "codes"])
    return blocks.select("cid", "n", "ids", "codes").mapInArrow(run, "cid int, id bigint, codes array<smallint>")


def write_blocks(index: "PQIndex", path: str) -> DataFrame:
    """P4 stored: the blocks in a folder for each cell, large ones made of the tasks' small ones.  A cell with a large share of
    the points is many tasks' blocks, as rows are dealt by cell and a number of their own."""
    spark, M = index.blocks.sparkSession, index.codebooks.shape[0]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches):
        held, points, of = [], 0, None
        for rb in batches:
            for cid, k, ids, codes in zip(*(c.to_pylist() for c in rb.columns)):
                if held and (cid != of or points + k > BLOCK_POINTS):
                    yield joined(of, held)
                    held, points = [], 0
                held.append((np.frombuffer(ids, "<i8"), np.frombuffer(codes, np.uint8).reshape(M, k)))
                points, of = points + k, cid
        if held:
            yield joined(of, held)

    def joined(cid, held):
        ids, codes = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held], axis=1).T
        return _blocks_of(np.full(len(ids), cid, np.int32), ids, codes)

    dealt = index.blocks.select("cid", "n", "ids", "codes").repartitionByRange(n, "cid", F.xxhash64("ids")).sortWithinPartitions("cid")
    dealt.mapInArrow(run, BLOCKS).write.mode("overwrite").partitionBy("cid").parquet(path)
    index.blocks = read_blocks(spark, path)
    return index.blocks


def read_blocks(spark, path: str) -> DataFrame:
    return spark.read.schema("n int, ids binary, codes binary, cid int").parquet(path).select("cid", "n", "ids", "codes")


def build_ivfpq(base: DataFrame, params: PQParams, centroids=None) -> PQIndex:
    """Coarse centroids (given or k-medians), residual codebooks, and the codes table."""
    metric = params.metric
    if centroids is None:
        cp = params.coarse
        cp = cluster.KMediansParams(k=cp.k, metric=metric, seed=params.seed, train_size=cp.train_size,
                                    max_iter=cp.max_iter, tol_changes=cp.tol_changes)
        cids, C, _ = cluster.kmedians_fit(base, cp)
    else:
        cids, C = centroids if isinstance(centroids, tuple) else cluster.centroid_matrix(centroids)
    d = C.shape[1]
    if d % params.m:
        raise ValueError("vector dimension must be divisible by M")
    ds = d // params.m
    train = base
    if params.codebook_train_size is not None:
        # Bounded training set for very large bases: every seeding round and Lloyd round is a
        # pass over the residual parts, so this caps build cost; encoding still covers all points.
        train = cluster.training_sample(base.select("id", "v"), params.codebook_train_size, params.seed)
    books = train_codebooks(residuals(train, cids, C, metric).checkpoint(eager=True), params.m, params.ksub, ds, params.seed, params.train_iters)
    return PQIndex(params, cids, C, books, encode_blocks(base, cids, C, books, metric))


def codebook_table(spark, index: PQIndex) -> DataFrame:
    """``codebooks(m, h, cw ARRAY<DOUBLE>)``."""
    M, ksub, _ = index.codebooks.shape
    rows = [(mm, h, [float(x) for x in index.codebooks[mm, h]]) for mm in range(M) for h in range(ksub)]
    return spark.createDataFrame(rows, "m int, h int, cw array<double>")


# --------------------------------------------------------------------------- P5 - P8


def _lut_kernel(cids, C, books):
    check_broadcast(C.nbytes + books.nbytes, "centroids and codebooks")
    M, ksub, ds = books.shape

    def run(batches):
        for rb in batches:
            if rb.num_rows == 0:
                continue
            Q, _ = arrow_matrix(rb.column("qv"), C.shape[1])
            cid = rb.column("cid").to_numpy(zero_copy_only=False)
            R = Q - C[np.searchsorted(cids, cid)]
            lut = np.empty((len(Q), M * ksub))
            for mm in range(M):
                lut[:, mm * ksub:(mm + 1) * ksub] = pairwise(R[:, mm * ds:(mm + 1) * ds], books[mm], "l2", squared=True)
            offsets = pa.array(np.arange(0, (len(Q) + 1) * M * ksub, M * ksub, dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [rb.column("qid"), rb.column("cid"), pa.ListArray.from_arrays(offsets, pa.array(lut.ravel()))],
                names=["qid", "cid", "lut"])
    return run


def lookup_tables(index: PQIndex, queries: DataFrame) -> DataFrame:
    """P5: ``(qid, cid, lut ARRAY<DOUBLE>)`` with ``lut[m * 2^nbits + h]`` = squared L2."""
    pr = cluster.nearest_probes(queries, (index.cids, index.C), index.params.nprobe, index.params.metric)
    return pr.select("qid", "cid", "qv").mapInArrow(_lut_kernel(index.cids, index.C, index.codebooks),
                                                    "qid bigint, cid int, lut array<double>")


def _adc_payload(index: PQIndex):
    """What a scan needs of a block of queries: each query once, probes by cell, centroids and codebooks."""
    cids, C, books, p = index.cids, index.C, index.codebooks, index.params

    def make(block: Block):
        _, cells = cluster.nearest_centroids(block.Q, cids, C, p.metric, min(p.nprobe, len(cids)))
        order = np.argsort(cells.ravel(), kind="stable")
        return block.qids, block.Q, cells.ravel()[order].astype(np.int64), order // cells.shape[1], cids, C, books
    return make


# Tables of recently met cells that a task keeps (a cell's table: 8 x M x 2^nbits bytes a probing query).
_TABLE_BYTES = 64 << 20


class _CellTables:
    """P5 inside the task: the tables of the queries that probe a cell, built when the cell is met.

    Where a pair of parts has no more than ``_PAIR_WORDS`` words, its table has the sums of both, and a point is
    half as many look-ups."""

    def __init__(self, payload):
        self.qids, self.Q, self.cells, self.owners, self.cids, self.C, self.books = payload
        self.held: dict[tuple[int, int], np.ndarray] = {}
        M, ksub, _ = self.books.shape
        self.paired = M % 2 == 0 and ksub * ksub <= _PAIR_WORDS
        self.words = ksub * ksub if self.paired else ksub
        self.parts = M // 2 if self.paired else M
        self.step = max(1, _TABLE_BYTES // 4 // (8 * self.parts * self.words))

    def of(self, cell: int):
        """(queries, their tables (parts, queries, words)) in pieces of bounded size."""
        low, high = np.searchsorted(self.cells, [cell, cell + 1])
        M, ksub, ds = self.books.shape
        for at in range(low, high, self.step):
            owners = self.owners[at:min(at + self.step, high)]
            table = self.held.get((cell, at))
            if table is None:
                R = self.Q[owners] - self.C[np.searchsorted(self.cids, cell)]
                table = np.stack([pairwise(R[:, m * ds:(m + 1) * ds], self.books[m], "l2", squared=True) for m in range(M)])
                if self.paired:
                    table = (table[::2, :, :, None] + table[1::2, :, None, :]).reshape(self.parts, len(owners), self.words)
                if sum(t.nbytes for t in self.held.values()) + table.nbytes > _TABLE_BYTES:
                    self.held.clear()
                self.held[cell, at] = table
            yield owners, table

    def codes(self, stored: bytes, n: int) -> np.ndarray:
        """(parts, points) look-up numbers of a block."""
        codes = np.frombuffer(stored, np.uint8).reshape(-1, n)
        if not self.paired:
            return codes
        return codes[::2].astype(np.uint16) * np.uint16(self.books.shape[1]) + codes[1::2]


_PAIR_WORDS = 4096


def _adc_kernel(n: int, radius: float | None):
    def kernel(payload):
        def run(batches):
            tables = _CellTables(payload)
            qids = tables.qids
            state = GroupTopN(n) if n else None
            best = np.full(len(qids), np.inf)  # squared distance that a query's next neighbour is not above
            for rb in batches:
                for cell, points, stored, codes in zip(*(c.to_pylist() for c in rb.columns)):
                    ids, codes = np.frombuffer(stored, "<i8"), tables.codes(codes, points)
                    for owners, table in tables.of(cell):
                        step = max(1, (1 << 20) // points)
                        for at in range(0, len(owners), step):
                            who = owners[at:at + step]
                            d2 = np.take(table[0, at:at + step], codes[0], axis=1)
                            for m in range(1, tables.parts):
                                d2 += np.take(table[m, at:at + step], codes[m], axis=1)
                            if radius is not None:
                                qi, r = np.nonzero(d2 <= radius * radius * (1 + 1e-12))
                                yield from emit_scored(None, qids, who[qi], ids[r], np.sqrt(d2[qi, r]), radius)
                            if state is not None:
                                if points > n:  # the block's own n-th distance bounds what can be a neighbour
                                    best[who] = np.fmin(best[who], np.partition(d2, n - 1, axis=1)[:, n - 1])
                                qi, r = np.nonzero(d2 <= best[who, None] * (1 + 1e-12))
                                state.add(who[qi], np.sqrt(d2[qi, r]), ids[r])
            yield from finish_topn(state, qids)
        return run
    return kernel


def adc_scan(index: PQIndex, queries: DataFrame, n: int, radius: float | None,
             max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame | None:
    """P5 + P6: every task streams the queries in blocks of bounded size (vectors, not tables) past the codes
    it has read, builds a cell's tables when it meets the cell, scores every point with
    ``sqrt(sum_m lut[m][code_m])`` and keeps a local top-N (or the radius hits)."""
    p = index.params
    check_broadcast(index.C.nbytes + index.codebooks.nbytes, "centroids and codebooks")
    side = query_side(queries, index.dim, max_bytes, keep=n) if len(index.cids) and p.nprobe > 0 else None
    if side is None:
        return None
    # only probed cells are read (partition pruning when the codes are stored by cid)
    probed = cluster.nearest_probes(side.frame(queries.sparkSession), (index.cids, index.C), p.nprobe, p.metric, carry=())
    return run_blocks(probed_only(index.blocks, probed, ["cid"], max_bytes), ["cid", "n", "ids", "codes"], side, _adc_payload(index),
                      _adc_kernel(n, radius), PAIR_SCHEMA, n)


def _lonely(index: PQIndex, queries: DataFrame) -> DataFrame:
    """Queries whose probed cells are all empty; they get an exact answer with the run's metric.

    "No candidate" is decided from the probes and the index's filled cells, found once, not from the
    candidate pairs themselves.
    """
    probes = cluster.nearest_probes(queries, (index.cids, index.C), index.params.nprobe, index.params.metric,
                                    carry=())
    served = probes.where(F.col("cid").isin(index.filled_cells())).select("qid").distinct()
    return queries.where(F.size("qv") == index.dim).join(served, "qid", "left_anti")


def search_and_range(index: PQIndex, base: DataFrame, queries: DataFrame, n: int, radius: float,
                     keep: bool | str = True) -> tuple[DataFrame, DataFrame]:
    """P8 with both outputs from one scan of the codes (and one of the base for fallback queries)."""
    pairs = adc_scan(index, queries, n, float(radius))
    rest = exact.scan_pairs(base, _lonely(index, queries), n=n, radius=float(radius), metric=index.params.metric)
    return exact.both(rest if pairs is None else pairs.unionByName(rest), n, keep)


def search(index: PQIndex, base: DataFrame, queries: DataFrame, n: int,
           max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES, refine: int = 0) -> DataFrame:
    """Top-N by approximate distance (ties by id) -> ``(qid, rank, id, dist)``.

    ``refine``: the ``refine`` approximately nearest points of a query are ranked again by their true distance;
    only their vectors are fetched, by a join on ``id`` with the written candidates (broadcast if they are few)."""
    if n <= 0 or 0 < refine < n:
        raise ValueError("N must be a positive integer, and not above refine")
    pairs = adc_scan(index, queries, max(n, refine), None, max_bytes)
    fallback = exact.knn(base, _lonely(index, queries), n, index.params.metric)
    if pairs is None:
        return fallback
    if not refine:
        return top_n(pairs.where("top"), n).unionByName(fallback)
    path = scratch_path(base.sparkSession, "refined")
    top_n(pairs.where("top"), refine).select("qid", "id").write.parquet(path)
    cands = base.sparkSession.read.schema("qid bigint, id bigint").parquet(path)
    return rerank(cands, base, queries, n, metric=index.params.metric, max_bytes=max_bytes).unionByName(fallback)


def range_search(index: PQIndex, base: DataFrame, queries: DataFrame, radius: float,
                 max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """Candidates with approximate ``dist <= radius``; fallback queries use the exact distance."""
    if radius is None or radius <= 0:
        return queries.sparkSession.createDataFrame([], RANGE_SCHEMA)
    pairs = adc_scan(index, queries, 0, float(radius), max_bytes)
    fallback = exact.range_search(base, _lonely(index, queries), radius, index.params.metric)
    return fallback if pairs is None else pairs.where("hit").select("qid", "id", "dist").unionByName(fallback)
