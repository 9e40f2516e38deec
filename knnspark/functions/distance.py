"""Vector scalar functions (V1-V8, V11) as Spark columns, plus NumPy batch kernels.

Column forms stay inside the JVM and serve projections over bounded inputs.  The NumPy kernels
run inside ``mapInArrow`` tasks on Arrow batches and serve the dense scans (exact search,
centroid assignment, candidate scoring) where a query block or a centroid table is shipped to
every task.  Distances are scored from explicit differences; for L2 a matrix product with a
proven rounding bound first narrows the candidates (``smallest_k_l2``), so answers are exact.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

_METRIC_NAMES = {"l1": "l1", "manhattan": "l1", "l2": "l2", "euclidean": "l2"}


def metric_name(metric: str) -> str:
    """Normalise a metric name; unknown names are rejected instead of silently meaning L2."""
    key = str(metric).strip().lower()
    if key not in _METRIC_NAMES:
        raise ValueError(f"unknown metric {metric!r}; use 'l1'/'manhattan' or 'l2'/'euclidean'")
    return _METRIC_NAMES[key]


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def l1_distance(a, b) -> Column:
    """V1: sum of absolute differences."""
    return F.aggregate(F.zip_with(_col(a), _col(b), lambda x, y: F.abs(x - y)),
                       F.lit(0.0).cast("double"), lambda s, x: s + x)


def squared_l2(a, b) -> Column:
    """V4: sum of squared differences (no square root)."""
    return F.aggregate(F.zip_with(_col(a), _col(b), lambda x, y: (x - y) * (x - y)),
                       F.lit(0.0).cast("double"), lambda s, x: s + x)


def l2_distance(a, b) -> Column:
    """V2: Euclidean distance."""
    return F.sqrt(squared_l2(a, b))


def distance(a, b, metric: str = "l2") -> Column:
    """V3: distance column for the chosen metric."""
    return l1_distance(a, b) if metric_name(metric) == "l1" else l2_distance(a, b)


def dot(a, b) -> Column:
    """V7: dot product."""
    return F.aggregate(F.zip_with(_col(a), _col(b), lambda x, y: x * y),
                       F.lit(0.0).cast("double"), lambda s, x: s + x)


def residual(v, c) -> Column:
    """V5: element-wise difference ``v - c``."""
    return F.zip_with(_col(v), _col(c), lambda x, y: x - y)


def subvectors(v, m: int, sub_dim: int) -> Column:
    """V6: split a vector into ``m`` consecutive parts of ``sub_dim`` values."""
    vc = _col(v)
    return F.transform(F.sequence(F.lit(0), F.lit(m - 1)),
                       lambda i: F.slice(vc, i * sub_dim + 1, sub_dim))


def cell(x, offset, w: float) -> Column:
    """V8: grid cell ``floor((x + offset) / w)`` as BIGINT."""
    return F.floor((_col(x) + offset) / F.lit(float(w))).cast("bigint")


# --------------------------------------------------------------------------- NumPy kernels

# Elements per temporary difference tensor; keeps one (rows x queries x dim) block near 32 MB.
_BLOCK_ELEMS = 1 << 22


def pairwise(Q: np.ndarray, X: np.ndarray, metric: str = "l2", squared: bool = False) -> np.ndarray:
    """Distances between every row of ``Q`` (nq x d) and ``X`` (nx x d) -> (nq x nx).

    Computed from explicit differences (no ``|a|^2 + |b|^2 - 2ab`` expansion, whose
    cancellation changes low digits) in blocks of bounded size.
    """
    metric = metric_name(metric)
    nq, d = Q.shape
    nx = X.shape[0]
    out = np.empty((nq, nx), dtype=np.float64)
    if nq == 0 or nx == 0:
        return out
    step = max(1, _BLOCK_ELEMS // max(1, nx * max(d, 1)))
    for s in range(0, nq, step):
        diff = Q[s:s + step, None, :] - X[None, :, :]
        if metric == "l1":
            out[s:s + step] = np.abs(diff).sum(axis=2)
        else:
            sq = np.einsum("ijk,ijk->ij", diff, diff)
            out[s:s + step] = sq if squared else np.sqrt(sq)
    return out


def arrow_matrix(col, dim: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Turn an Arrow list<double> column into an (n x d) matrix plus per-row lengths.

    The rule for bad vectors, in every method and metric: a null vector, one of another length, or
    one with a null, NaN or infinite element raises, with the number of such rows in the batch.
    (``usable_rows`` is the query side's rule: such queries get an empty answer.)
    """
    import pyarrow as pa
    import pyarrow.compute as pc

    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    lengths = pc.fill_null(pc.list_value_length(col), -1).to_numpy(zero_copy_only=False)
    n = len(col)
    if n == 0:
        return np.empty((0, dim or 0)), lengths
    d = dim if dim is not None else int(lengths.max())
    if not np.all(lengths == d):
        raise ValueError(f"{int((lengths == -1).sum())} null vectors and {int(((lengths != d) & (lengths != -1)).sum())} "
                         f"of another length than {d} among {n} rows")
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    X = flat.reshape(n, d)
    if not np.isfinite(flat).all():
        raise ValueError(f"{int((~np.isfinite(X)).any(axis=1).sum())} of {n} vectors hold a null, NaN or infinite element")
    return X, lengths


def usable_rows(col, dim: int) -> np.ndarray:
    """Positions of the vectors of length ``dim`` whose elements are all finite."""
    import pyarrow as pa
    import pyarrow.compute as pc

    lengths = pc.fill_null(pc.list_value_length(col), -1).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(lengths == dim)
    if len(rows) == 0 or dim == 0:
        return rows
    flat = col.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return rows[np.isfinite(flat.reshape(len(rows), dim)).all(axis=1)]


def smallest_k(dist: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row, the ``k`` lexicographically smallest ``(dist, id)`` pairs, sorted.

    ``dist`` and ``ids`` are (rows x m) matrices.  Returns (rows x min(k, m)) matrices.
    """
    rows, m = dist.shape
    k = min(k, m)
    if k == 0:
        return dist[:, :0], ids[:, :0]
    if k < m:
        part = np.argpartition(dist, k - 1, axis=1)
        thr = np.take_along_axis(dist, part[:, k - 1:k], axis=1)
        pick = part[:, :k]
        # Rows with ties at the k-th distance need an exact (dist, id) choice.
        ties = (dist <= thr).sum(axis=1) > k
        d_sel = np.take_along_axis(dist, pick, axis=1)
        i_sel = np.take_along_axis(ids, pick, axis=1)
        for r in np.nonzero(ties)[0]:
            cand = np.nonzero(dist[r] <= thr[r, 0])[0]
            order = np.lexsort((ids[r, cand], dist[r, cand]))[:k]
            d_sel[r] = dist[r, cand[order]]
            i_sel[r] = ids[r, cand[order]]
    else:
        d_sel, i_sel = dist, ids
    order = np.lexsort((i_sel, d_sel), axis=1)
    return np.take_along_axis(d_sel, order, axis=1), np.take_along_axis(i_sel, order, axis=1)


def gemm_error_bound(rn: np.ndarray, cn: np.ndarray, d: int) -> np.ndarray:
    """Bound on the rounding error of ``|r|^2 + |c|^2 - 2 r.c`` in float64, for each pair and
    whatever the summation order of the matrix product: about ``d * eps`` times the magnitudes
    involved.  A pair's bound depends on its own two vectors only."""
    eps = np.finfo(np.float64).eps
    return 4.0 * (d + 2) * eps * (rn[:, None] + cn[None, :]) + 1e-300


# Elements of a float32 tile that stays in a core's cache.
_L1_TILE, _L1_WIDTH = 1 << 15, 1 << 9


def l1_near(Q: np.ndarray, X: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """L1 distances of all pairs in float32, and a bound on their error, whatever the summation order.

    They are sums of the larger elements, ``sum |q - x| = 2 sum max(q, x) - sum q - sum x``, dimension by dimension, so no
    difference tensor is made.  A pair's bound depends on its own two vectors only; rounding to float32 is part of it."""
    nq, d = Q.shape
    larger = np.empty((nq, len(X)))
    with np.errstate(over="ignore"):
        QT, XT = np.ascontiguousarray(Q.T, dtype=np.float32), np.ascontiguousarray(X.T, dtype=np.float32)
    height = max(1, _L1_TILE // max(1, min(len(X), _L1_WIDTH)))
    with np.errstate(over="ignore", invalid="ignore"):
        for x0 in range(0, len(X), _L1_WIDTH):
            for q0 in range(0, nq, height):
                a, b = QT[:, q0:q0 + height, None], XT[:, None, x0:x0 + _L1_WIDTH]
                total = np.zeros((a.shape[1], b.shape[2]), np.float32)
                one = np.empty_like(total)
                for k in range(d):
                    np.maximum(a[k], b[k], out=one)
                    total += one
                larger[q0:q0 + height, x0:x0 + _L1_WIDTH] = total
        larger *= 2
        larger -= Q.sum(axis=1)[:, None]
        larger -= X.sum(axis=1)[None, :]
    eps = float(np.finfo(np.float32).eps)
    err = 2.0 * (d + 2) * eps * (np.abs(Q).sum(axis=1)[:, None] + np.abs(X).sum(axis=1)[None, :]) + 1e-30
    return larger, err


def not_above(low: np.ndarray, threshold) -> tuple[np.ndarray, np.ndarray]:
    """Pairs whose lower bound isn't proven to exceed the threshold (an overflow proves nothing)."""
    return np.nonzero(~(low > threshold))


def smallest_k_l2(X: np.ndarray, C: np.ndarray, keys: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row of ``X``, the ``k`` smallest exact ``(L2 distance, key)`` pairs over the rows of ``C``.

    Same answer as ``smallest_k(pairwise(X, C), keys, k)``: a matrix product bounds every
    squared distance within a proven error, and only entries that can still be among the k
    smallest are scored again from explicit differences.
    """
    n, d = X.shape
    m = C.shape[0]
    k = min(k, m)
    if n == 0 or k == 0:
        return np.empty((n, k)), np.empty((n, k), dtype=np.int64)
    xn = np.einsum("ij,ij->i", X, X)
    cn = np.einsum("ij,ij->i", C, C)
    A = xn[:, None] + cn[None, :] - 2.0 * (X @ C.T)
    err = gemm_error_bound(xn, cn, d)
    t = np.partition(A + err, k - 1, axis=1)[:, k - 1:k]
    ri, ci = not_above(A - err, t)
    diff = X[ri] - C[ci]
    dist = np.sqrt(np.einsum("ij,ij->i", diff, diff))
    kv = np.asarray(keys, dtype=np.int64)[ci]
    order = np.lexsort((kv, dist, ri))
    ri, dist, kv = ri[order], dist[order], kv[order]
    first = np.r_[True, ri[1:] != ri[:-1]]
    start = np.maximum.accumulate(np.where(first, np.arange(len(ri)), 0))
    keep = (np.arange(len(ri)) - start) < k
    return dist[keep].reshape(n, k), kv[keep].reshape(n, k)
