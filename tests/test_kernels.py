"""Kernel building blocks against brute force (no Spark)."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from knnspark.functions.distance import pairwise, smallest_k
from knnspark.functions.hashing import lsh_buckets_np, lsh_coefficients
from knnspark.operators.scan import GroupTopN, match, pair_distances


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 6), st.integers(1, 40), st.integers(1, 8), st.integers(0, 2**31 - 1))
def test_smallest_k_is_lexicographic(rows, cols, k, seed):
    rng = np.random.default_rng(seed)
    dist = rng.integers(0, 4, size=(rows, cols)).astype(float)    # many ties
    ids = np.stack([rng.permutation(1000)[:cols] for _ in range(rows)])
    d, i = smallest_k(dist, ids, k)
    for r in range(rows):
        want = sorted(zip(dist[r], ids[r]))[:k]
        assert list(zip(d[r], i[r])) == want


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 5), st.integers(0, 300), st.integers(1, 7), st.integers(0, 2**31 - 1))
def test_group_topn_matches_sort(groups, n_rows, n, seed):
    rng = np.random.default_rng(seed)
    g = rng.integers(0, groups, n_rows)
    d = rng.integers(0, 5, n_rows).astype(float)
    ids = rng.permutation(10 * n_rows + 1)[:n_rows]
    state = GroupTopN(n)
    for s in range(0, n_rows, 37):
        state.add(g[s:s + 37], d[s:s + 37], ids[s:s + 37])
    res = state.result()
    got = [] if res is None else sorted(zip(*res))
    want = []
    for gg in range(groups):
        m = g == gg
        want += [(gg, dd, ii) for dd, ii in sorted(zip(d[m], ids[m]))[:n]]
    assert got == sorted(want)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 9), max_size=30), st.lists(st.integers(0, 9), max_size=30))
def test_match_is_equi_join(left, right):
    sk = np.sort(np.array(right, dtype=np.int64))
    rows, pos = match(sk, np.array(left, dtype=np.int64))
    got = sorted((int(r), int(sk[p])) for r, p in zip(rows, pos))
    want = sorted((i, a) for i, a in enumerate(left) for b in right if a == b)
    assert got == want


def test_pair_distances_and_pairwise_agree():
    rng = np.random.default_rng(0)
    Q, X = rng.normal(size=(7, 5)), rng.normal(size=(11, 5))
    full = pairwise(Q, X, "l2")
    qi, ri = np.meshgrid(np.arange(7), np.arange(11), indexing="ij")
    assert np.allclose(pair_distances(Q, X, qi.ravel(), ri.ravel(), "l2"), full.ravel(), rtol=0, atol=1e-12)
    assert np.allclose(pairwise(Q, X, "l1"), np.abs(Q[:, None] - X[None]).sum(-1))


def test_lsh_numpy_hash_matches_definition():
    rng = np.random.default_rng(3)
    d, L, k, w = 6, 2, 3, 0.7
    X = rng.normal(size=(20, d))
    S = rng.uniform(0, w, size=(L, k, d))
    coef = lsh_coefficients(d)
    got = lsh_buckets_np(X, S, np.array(coef), w, k)
    for i in range(20):
        for t in range(L):
            g = 0
            for j in range(k):
                a = [int(np.floor((X[i, q] - S[t, j, q]) / w)) for q in range(d)]
                h = sum(((a[d - 1 - q] % 256) * coef[q]) % 256 for q in range(d)) % 256
                g = ((g << (32 // k)) | h) & 0xFFFFFFFF
            assert got[i, t] == g % 256


def _run_exact_kernel(Q, X, ids, n, radius, metric="l2"):
    import pyarrow as pa

    from knnspark.operators.exact import _scan_kernel

    qids = np.arange(100, 100 + len(Q), dtype=np.int64)
    batches = []
    for s in range(0, len(X), 7):
        xs = X[s:s + 7]
        offs = pa.array(np.arange(0, (len(xs) + 1) * X.shape[1], X.shape[1], dtype=np.int32))
        batches.append(pa.RecordBatch.from_arrays(
            [pa.array(ids[s:s + 7]), pa.ListArray.from_arrays(offs, pa.array(xs.ravel()))], names=["id", "v"]))
    out = list(_scan_kernel((qids, Q), metric, n, radius)(iter(batches)))
    rows = [r for b in out for r in zip(*[b.column(i).to_pylist() for i in range(5)])]
    return qids, rows


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 6), st.integers(1, 60), st.integers(1, 6), st.integers(0, 2**31 - 1), st.booleans())
def test_gemm_filter_is_exact(nq, nx, n, seed, dup):
    rng = np.random.default_rng(seed)
    d = 5
    X = rng.integers(-3, 4, size=(nx, d)).astype(float) * 0.5   # many exact ties
    if dup:
        X[::2] = X[0]
    Q = rng.integers(-3, 4, size=(nq, d)).astype(float) * 0.5
    ids = rng.permutation(10 * nx)[:nx].astype(np.int64)
    radius = 1.5
    qids, rows = _run_exact_kernel(Q, X, ids, n, radius)
    D = np.sqrt(((Q[:, None] - X[None]) ** 2).sum(-1))
    top = sorted((q, i, round(dd, 12)) for q, i, dd, t, h in rows if t)
    want = []
    for a in range(nq):
        order = np.lexsort((ids, D[a]))[:n]
        want += [(int(qids[a]), int(ids[j]), round(float(D[a, j]), 12)) for j in order]
    # a task's local top-n is exact per task; here one task sees everything
    assert sorted((q, i) for q, i, _ in top) == sorted((q, i) for q, i, _ in want)
    hits = sorted((q, i) for q, i, dd, t, h in rows if h)
    assert hits == sorted((int(qids[a]), int(ids[j])) for a in range(nq) for j in range(nx) if D[a, j] <= radius)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 30), st.integers(1, 12), st.integers(1, 4), st.integers(0, 2**31 - 1))
def test_smallest_k_l2_equals_direct(n, m, k, seed):
    from knnspark.functions.distance import smallest_k_l2

    rng = np.random.default_rng(seed)
    X = rng.integers(-2, 3, size=(n, 4)).astype(float)
    C = rng.integers(-2, 3, size=(m, 4)).astype(float)         # duplicate centroids and ties
    keys = rng.permutation(100)[:m].astype(np.int64)
    d1, k1 = smallest_k_l2(X, C, keys, k)
    d2, k2 = smallest_k(pairwise(X, C, "l2"), np.broadcast_to(keys, (n, m)), k)
    assert np.array_equal(k1, k2)
    assert np.allclose(d1, d2, rtol=0, atol=1e-12)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=40), st.lists(st.integers(0, 4), max_size=40), st.integers(1, 7))
def test_match_chunks_cover_the_join_within_limit(left, right, limit):
    from knnspark.operators.scan import match_chunks

    sk = np.sort(np.array(right, dtype=np.int64))
    keys = np.array(left, dtype=np.int64)
    got = []
    for rows, pos in match_chunks(sk, keys, limit):
        assert len(rows) <= limit
        got += [(int(r), int(p)) for r, p in zip(rows, pos)]
    rows, pos = match(sk, keys)
    assert sorted(got) == sorted(zip(rows.tolist(), pos.tolist()))
