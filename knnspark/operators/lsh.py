"""LSH by grid hashing (L1-L7): bucket equi-join, de-duplicated candidates, exact re-rank.

Build (L1, L4): hash parameters are drawn on the driver (``L x k x d`` offsets, bounded by the
dimension, not the data); the index ``(t, bucket, id)`` is one narrow ``mapInArrow`` pass that
hashes Arrow batches with NumPy and emits one row per table.  ``LSHModel.bucket_columns`` gives
the same buckets as plain columns for use inside other projections.

Search (L5-L7) is one candidate scan of the base (``operators.scan``): each base task streams the queries
in blocks of bounded size, hashes them and its rows, matches
them to the query buckets table by table, scores each distinct (query, point) pair once (D3) and
keeps a local top-N, so only <= N rows per query and task are shuffled.  Where queries share buckets with a large part of
the base, whole tiles are scored instead, with the same answers.  ``candidates`` and
``search_index`` give the same answers from a stored ``lsh_index`` table, its buckets brought together by id.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knnspark.functions.distance import arrow_matrix, metric_name, usable_rows
from knnspark.functions.hashing import LSH_TABLE_SIZE, lsh_amplify, lsh_buckets_np, lsh_coefficients, lsh_hash
from knnspark.operators.exact import NEIGHBOR_SCHEMA, RANGE_SCHEMA, both, top_n
from knnspark.operators.exact import _scan_kernel as exact_kernel
from knnspark.operators.blocks import Block, check_broadcast, probed_only, query_side
from knnspark.operators.scan import PAIR_SCHEMA, GroupTopN, emit_scored, finish_topn, match_chunks, pair_distances, run_blocks
from knnspark.session import DEFAULT_MAX_BROADCAST_BYTES


@dataclass
class LSHParams:
    k: int = 4                  # hashes per table
    L: int = 5                  # tables
    w: float = 4.0              # cell width
    seed: int = 1
    table_size: int | None = LSH_TABLE_SIZE   # None keeps the full amplified key (D2)
    metric: str = "l2"

    def __post_init__(self):
        if self.k < 1 or self.L < 1:
            raise ValueError("k and L must be >= 1")
        if self.w <= 0:
            raise ValueError("w must be positive")
        self.metric = metric_name(self.metric)


@dataclass
class LSHModel:
    params: LSHParams
    offsets: np.ndarray          # (L, k, d) real offsets in [0, w) (D1)
    coef: list[int] = field(default_factory=list)

    @property
    def dim(self) -> int:
        return int(self.offsets.shape[2])

    def bucket_columns(self, vec_col: str = "v") -> list:
        p = self.params
        v = f"`{vec_col}`"
        cols = []
        for t in range(p.L):
            hs = [lsh_hash(v, list(self.offsets[t, j]), self.coef, p.w) for j in range(p.k)]
            cols.append(lsh_amplify(hs, p.k, p.table_size))
        return cols


def draw_lsh(params: LSHParams, dim: int) -> LSHModel:
    """L1: offsets ``s ~ U[0, w)`` from a seeded generator; coefficients from the fixed rule."""
    check_broadcast(8 * params.L * params.k * max(dim, 1), "LSH parameters")
    rng = np.random.default_rng(params.seed)
    offsets = rng.uniform(0.0, params.w, size=(params.L, params.k, dim))
    return LSHModel(params, offsets, lsh_coefficients(dim))


def params_table(spark, model: LSHModel) -> DataFrame:
    """``lsh_params(t, j, s ARRAY<DOUBLE>, r ARRAY<INT>)``."""
    rows = [(t, j, [float(x) for x in model.offsets[t, j]], [int(c) for c in model.coef])
            for t in range(model.params.L) for j in range(model.params.k)]
    return spark.createDataFrame(rows, "t int, j int, s array<double>, r array<int>")


def _bucket_kernel(model: "LSHModel", key: str, vec: str, carry: list[str], strict: bool):
    p = model.params
    offsets, coef, d = model.offsets, np.asarray(model.coef, dtype=np.int64), model.dim

    def run(batches):
        for rb in batches:
            if rb.num_rows == 0:
                continue
            ok = np.arange(rb.num_rows) if strict else usable_rows(rb.column(vec), d)
            if len(ok) == 0:
                continue
            sub = rb.take(pa.array(ok)) if len(ok) != rb.num_rows else rb
            X, _ = arrow_matrix(sub.column(vec), d)
            B = lsh_buckets_np(X, offsets, coef, p.w, p.k, p.table_size)     # (n, L)
            n = len(X)
            rows = pa.array(np.repeat(np.arange(n), p.L))
            arrays = [sub.column(key).take(rows)] + [sub.column(c).take(rows) for c in carry]
            arrays += [pa.array(np.tile(np.arange(p.L, dtype=np.int32), n)), pa.array(B.ravel(), pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=[key, *carry, "t", "bucket"])
    return run


def with_buckets(model: LSHModel, df: DataFrame, key: str, vec: str, carry: tuple[str, ...] = (),
                 strict: bool = True) -> DataFrame:
    """L2-L4 as one narrow pass: ``(key, *carry, t, bucket)``, one row per table.

    A bad vector raises; without ``strict`` (queries) it has no bucket."""
    fields = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    carry = [c for c in carry if c != key]
    schema = ", ".join(f"{c} {fields[c]}" for c in [key, *carry]) + ", t int, bucket bigint"
    cols = list(dict.fromkeys([key, vec, *carry]))
    return df.select(*cols).mapInArrow(_bucket_kernel(model, key, vec, carry, strict), schema)


# Folders of each table's buckets in the stored lists.
LIST_PARTS = 16


def _slot():
    """One folder column for table and part of its buckets, so that pruning is by both at once."""
    return (F.col("t") * LIST_PARTS + F.pmod(F.col("bucket"), F.lit(LIST_PARTS))).cast("int").alias("slot")


def build_index(model: LSHModel, base: DataFrame) -> DataFrame:
    """L4: ``lsh_index(t, bucket, id)``."""
    return with_buckets(model, base, "id", "v").select("t", "bucket", "id")


def query_buckets(model: LSHModel, queries: DataFrame, with_vectors: bool = True) -> DataFrame:
    carry = ("qv",) if with_vectors else ()
    return with_buckets(model, queries, "qid", "qv", carry, strict=False)


def write_index(model: LSHModel, base: DataFrame, path: str) -> DataFrame:
    """L4 with ids only: ``lsh_index(slot, t, bucket, id)``, a folder for each table and part of its buckets.  The vectors
    stay in the base, once; ``search_index`` fetches those of the candidates."""
    spark = base.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = build_index(model, base).select(_slot(), "t", "bucket", "id").repartitionByRange(n, "slot", "bucket", "id")
    rows.sortWithinPartitions("slot", "bucket").write.mode("overwrite").partitionBy("slot").parquet(path)
    return spark.read.parquet(path)


def _entries(rows: DataFrame, key: str) -> DataFrame:
    """``(key, entries)``: all tables and buckets of every key, each as one number, dealt by key.  The number of tasks is
    given, as what follows compares their rows with all queries."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    entry = F.col("t").cast("bigint") * (1 << 40) + F.col("bucket")
    return rows.repartition(n, key).groupBy(key).agg(F.collect_set(entry).alias("entries"))


def _probed(model: LSHModel, index: DataFrame, queries: DataFrame, max_bytes: int) -> DataFrame:
    """``(id, entries)`` of an index; of one in folders (``write_index``) only those of probed buckets are opened."""
    if "slot" in index.columns:
        index = probed_only(index, query_buckets(model, queries, False).select(_slot()), ["slot"], max_bytes)
    return _entries(index, "id")


def _entry_payload(block: Block):
    """A block's queries by entry."""
    lists = block.extra["entries"]
    keys, owners = lists.flatten().to_numpy(), np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy())
    order = np.argsort(keys, kind="stable")
    return block.qids, block.Q, keys[order], owners[order]


def _sharing(keys: np.ndarray, owners: np.ndarray, nq: int, lists: pa.Array, limit: int = 1 << 18):
    """(row, query) pairs that share an entry, each once, in pieces of about ``limit`` shared entries."""
    entries, size = lists.flatten().to_numpy(), pc.list_value_length(lists).to_numpy().astype(np.int64)
    ends = np.cumsum(size)
    lo, hi = np.searchsorted(keys, entries, "left"), np.searchsorted(keys, entries, "right")
    upto = np.concatenate([[0], np.cumsum(hi - lo)])[ends]  # shared entries of the rows up to each
    row = 0
    while row < len(size):
        before = upto[row - 1] if row else 0
        end = max(row + 1, int(np.searchsorted(upto, before + limit, "right")))
        a, b = ends[row] - size[row], ends[end - 1]
        count = hi[a:b] - lo[a:b]
        of = np.repeat(np.repeat(np.arange(end - row), size[row:end]), count)
        at = np.repeat(lo[a:b] - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
        if (end - row) * nq <= 16 * len(at):  # dense: marked in a matrix, else sorted
            met = np.zeros((end - row, nq), bool)
            met[of, owners[at]] = True
            r, q = np.nonzero(met)
        else:
            r, q = np.divmod(np.unique(of * nq + owners[at]), nq)
        yield row + r, q
        row = end


def candidates(model: LSHModel, index: DataFrame, queries: DataFrame,
               max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """L5 from a stored index: distinct ``(qid, id)`` sharing a bucket in at least one table.  Of an index in folders
    (``write_index``) only those of probed buckets are opened.

    All buckets of an id are brought together, and of a query; a pair is found once, where its id is, and never shuffled."""
    found = _entries(query_buckets(model, queries.where("qid IS NOT NULL"), False), "qid")
    side = query_side(found.withColumn("qv", F.array().cast("array<double>")), 0, max_bytes // 4, ("entries",))
    if side is None:
        return index.sparkSession.createDataFrame([], "qid bigint, id bigint")

    def kernel(payload):
        qids, _, keys, owners = payload

        def run(batches):
            for rb in batches:
                for rows, q in _sharing(keys, owners, len(qids), rb.column(1)):
                    yield pa.RecordBatch.from_arrays([pa.array(qids[q]), rb.column(0).take(pa.array(rows))], names=["qid", "id"])
        return run

    return run_blocks(_probed(model, index, queries, max_bytes), ["id", "entries"], side, _entry_payload, kernel, "qid bigint, id bigint")


def _payload(model: LSHModel):
    """What a scan needs of a block of queries: their buckets, sorted table by table."""
    p, offsets, coef = model.params, model.offsets, np.asarray(model.coef, dtype=np.int64)

    def make(block: Block):
        QB = lsh_buckets_np(block.Q, offsets, coef, p.w, p.k, p.table_size)
        if _density(QB) > _DENSE:
            return block.qids, block.Q, None, None, QB
        order = [np.argsort(QB[:, t], kind="stable") for t in range(p.L)]
        return block.qids, block.Q, [QB[o, t] for t, o in enumerate(order)], order, QB
    return make


# Share of all pairs above which whole tiles are scored at once.
_DENSE = 1 / 32


def _density(QB: np.ndarray) -> float:
    """The share of a block's pairs of queries that meet in a bucket, table by table: what to expect of the base's rows."""
    counts = (np.unique(b, return_counts=True)[1] / max(len(b), 1) for b in QB.T)
    return sum(float(c @ c) for c in counts)


def _scan_kernel(model: LSHModel, n: int, radius: float | None, stored: bool = False):
    """``stored``: rows are those of one table each (column ``t``), else of all tables."""
    p = model.params
    offsets, coef, d = model.offsets, np.asarray(model.coef, dtype=np.int64), model.dim

    def share(QB, X):
        """Which queries and rows share a bucket."""
        B = lsh_buckets_np(X, offsets, coef, p.w, p.k, p.table_size)
        met = QB[:, 0, None] == B[None, :, 0]
        for t in range(1, p.L):
            met |= QB[:, t, None] == B[None, :, t]
        return met

    def kernel(payload):
        def run(batches):
            qids, Q, keys, owners, QB = payload
            if keys is None and not stored:
                yield from exact_kernel((qids, Q), p.metric, n, radius, lambda part, X: share(QB[part], X))(batches)
                return
            if keys is None:
                owners = [np.argsort(QB[:, t], kind="stable") for t in range(p.L)]
                keys = [QB[o, t] for t, o in enumerate(owners)]
            state = GroupTopN(n) if n else None
            for rb in batches:
                if rb.num_rows == 0:
                    continue
                sub = rb
                ids = sub.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
                X, _ = arrow_matrix(sub.column(1), d)
                B = lsh_buckets_np(X, offsets, coef, p.w, p.k, p.table_size)
                own = sub.column(2).to_numpy(zero_copy_only=False) if stored else None
                for t in range(p.L):
                    here = np.arange(len(ids)) if own is None else np.flatnonzero(own == t)
                    for r, pos in match_chunks(keys[t], B[here, t]):
                        r, q = here[r], owners[t][pos]
                        if t:
                            # a pair found in several tables is scored once, in its first table (D3)
                            first = ~(B[r, :t] == QB[q, :t]).any(axis=1)
                            r, q = r[first], q[first]
                        if len(r) == 0:
                            continue
                        dist = pair_distances(Q, X, q, r, p.metric)
                        yield from emit_scored(state, qids, q, ids[r], dist, radius)
            yield from finish_topn(state, qids)
        return run
    return kernel


def _scan(model: LSHModel, base: DataFrame, queries: DataFrame, n: int, radius: float | None,
          max_bytes: int, lists: DataFrame | None = None) -> DataFrame | None:
    side = query_side(queries, model.dim, max_bytes, keep=n)
    if side is None:
        return None
    if lists is None:
        return run_blocks(base, ["id", "v"], side, _payload(model), _scan_kernel(model, n, radius), PAIR_SCHEMA, n)
    probed = query_buckets(model, side.frame(base.sparkSession), False).select(_slot())
    return run_blocks(probed_only(lists, probed, ["slot"], max_bytes), ["id", "v", "t"], side, _payload(model),
                      _scan_kernel(model, n, radius, True), PAIR_SCHEMA, n)


def write_lists(model: LSHModel, base: DataFrame, path: str) -> DataFrame:
    """L4 with the vectors: ``lsh_lists(slot, t, bucket, id, v)``, a folder for each table and part of its buckets, so
    that a search opens the probed buckets' folders only.  A large bucket is many tasks' rows."""
    spark = base.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = with_buckets(model, base, "id", "v", ("v",)).select(_slot(), "t", "bucket", "id", "v")
    rows.repartitionByRange(n, "slot", "bucket", "id").sortWithinPartitions("slot", "bucket").write.mode(
        "overwrite").partitionBy("slot").parquet(path)
    return spark.read.parquet(path)


def search(model: LSHModel, base: DataFrame, queries: DataFrame, n: int,
           max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES, lists: DataFrame | None = None) -> DataFrame:
    """L5 + L6: top-N distinct candidates by ``(dist, id)``; fewer when there are fewer.

    ``lists`` (from ``write_lists``): only the probed buckets are read, not the base."""
    if n <= 0:
        raise ValueError("N must be a positive integer")
    pairs = _scan(model, base, queries, n, None, max_bytes, lists)
    if pairs is None:
        return queries.sparkSession.createDataFrame([], NEIGHBOR_SCHEMA)
    return top_n(pairs.where("top"), n)


def search_and_range(model: LSHModel, base: DataFrame, queries: DataFrame, n: int, radius: float, keep: bool | str = True,
                     lists: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """L6 + L7 from one scan."""
    pairs = _scan(model, base, queries, n, float(radius), DEFAULT_MAX_BROADCAST_BYTES, lists)
    return both(pairs if pairs is not None else queries.sparkSession.createDataFrame([], PAIR_SCHEMA), n, keep)


def range_search(model: LSHModel, base: DataFrame, queries: DataFrame, radius: float,
                 max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES, lists: DataFrame | None = None) -> DataFrame:
    """Every distinct candidate with ``dist <= radius`` (not only the first N; D4).

    ``lists`` (from ``write_lists``): only the probed buckets are read, not the base."""
    if radius is None or radius <= 0:
        return queries.sparkSession.createDataFrame([], RANGE_SCHEMA)
    pairs = _scan(model, base, queries, 0, float(radius), max_bytes, lists)
    if pairs is None:
        return queries.sparkSession.createDataFrame([], RANGE_SCHEMA)
    return pairs.where("hit").select("qid", "id", "dist")


def search_index(model: LSHModel, index: DataFrame, base: DataFrame, queries: DataFrame, n: int,
                 max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """L5 + L6 over a stored ``lsh_index``: candidates by the buckets of the index, their vectors fetched by an equi-join on
    ``id``.

    A vector is shuffled once, with all its buckets, however many queries it is a candidate of; its candidate pairs are
    scored where it is, as in ``search``."""
    if n <= 0:
        raise ValueError("N must be a positive integer")
    found = _entries(query_buckets(model, queries, False), "qid")
    side = query_side(queries.select("qid", "qv").join(found, "qid"), model.dim, max_bytes, ("entries",), n, unique=False)
    if side is None:
        return queries.sparkSession.createDataFrame([], NEIGHBOR_SCHEMA)
    rows = _probed(model, index, queries, max_bytes)
    tasks = int(base.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    vectors = base.select(F.col("id").cast("bigint"), F.col("v").cast("array<double>")).repartition(tasks, "id")
    metric, d = model.params.metric, model.dim

    def kernel(payload):
        qids, Q, keys, owners = payload

        def run(batches):
            state = GroupTopN(n)
            for rb in batches:
                if rb.num_rows == 0:
                    continue
                ids = rb.column(0).to_numpy()
                X, _ = arrow_matrix(rb.column(1), d)
                for r, q in _sharing(keys, owners, len(qids), rb.column(2)):
                    state.add(q, pair_distances(Q, X, q, r, metric), ids[r])
            yield from finish_topn(state, qids)
        return run

    pairs = run_blocks(rows.join(vectors, "id"), ["id", "v", "entries"], side, _entry_payload, kernel, PAIR_SCHEMA)
    return top_n(pairs.where("top"), n)
