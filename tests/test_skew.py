"""A third of the base on one key: one vector repeated, so one LSH bucket, hypercube vertex,
IVF cell and median group is hot.  Results must stay exact against NumPy brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from knnspark.functions.hashing import lsh_buckets_np
from knnspark.functions.stats import dim_medians
from knnspark.operators import cluster, exact, hypercube, ivfflat, lsh

N = 5


@pytest.fixture(scope="module")
def skewed(spark, split, np_split):
    base, queries = split
    ids, X, qids, Q = np_split
    hot = X[0]
    # every third base row (by id order) takes the first row's vector
    hot_ids = set(ids[::3].tolist())
    hot_arr = F.array(*[F.lit(float(x)) for x in hot])
    sk = base.withColumn("v", F.when(F.col("id").isin(list(map(int, hot_ids))), hot_arr).otherwise(F.col("v")))
    Xs = X.copy()
    Xs[np.isin(ids, list(hot_ids))] = hot
    return sk.repartition(6), queries, ids, Xs, qids, Q


def brute(qids, Q, ids, X, cand=None):
    out = []
    for i, q in enumerate(qids):
        m = np.ones(len(ids), bool) if cand is None else cand[i]
        d = np.sqrt(((X[m] - Q[i]) ** 2).sum(1))
        order = np.lexsort((ids[m], d))[:N]
        out += [(int(q), r + 1, int(ids[m][j]), round(float(d[j]), 9)) for r, j in enumerate(order)]
    return sorted(out)


def rows(df):
    return sorted((r["qid"], r["rank"], r["id"], round(r["dist"], 9)) for r in df.collect())


def test_exact_with_hot_vector(skewed):
    base, queries, ids, X, qids, Q = skewed
    assert rows(exact.knn(base, queries, N)) == brute(qids, Q, ids, X)


def test_lsh_with_hot_bucket(skewed):
    base, queries, ids, X, qids, Q = skewed
    model = lsh.draw_lsh(lsh.LSHParams(k=4, L=5, w=4.0, seed=1), 64)
    coef = np.array(model.coef)
    B = lsh_buckets_np(X, model.offsets, coef, 4.0, 4)
    QB = lsh_buckets_np(Q, model.offsets, coef, 4.0, 4)
    cand = (QB[:, None, :] == B[None, :, :]).any(axis=2)
    assert rows(lsh.search(model, base, queries, N)) == brute(qids, Q, ids, X, cand)


def test_ivf_with_hot_cell(skewed):
    base, queries, ids, X, qids, Q = skewed
    cids, C = cluster.label_median_matrix(base.withColumn("label", (F.col("id") % 7).cast("int")))
    index = ivfflat.build_ivfflat(base, (cids, C))
    cell = cids[np.argmin(((X[:, None] - C[None]) ** 2).sum(-1), axis=1)]
    qd = np.sqrt(((Q[:, None] - C[None]) ** 2).sum(-1))
    probes = [set(cids[np.lexsort((cids, qd[i]))[:2]].tolist()) for i in range(len(qids))]
    cand = np.array([[c in probes[i] for c in cell] for i in range(len(qids))])
    assert rows(ivfflat.search(index, queries, N, 2)) == brute(qids, Q, ids, X, cand)


def test_cube_with_hot_vertex(skewed):
    base, queries, ids, X, qids, Q = skewed
    model = hypercube.draw_cube(hypercube.CubeParams(kproj=5, w=4.0, max_candidates=0, probes=32), 64)
    assert rows(hypercube.search(model, base, queries, N)) == brute(qids, Q, ids, X)


def test_median_with_hot_group(spark, skewed):
    base, _, ids, X, _, _ = skewed
    got = {(r["dim"]): r["median"] for r in dim_medians(base.withColumn("g", F.lit(1)), ["g"]).collect()}
    want = np.median(X, axis=0)
    assert all(abs(got[j] - want[j]) < 1e-12 for j in range(64))


def test_lsh_full_keys_many_hashes(skewed):
    """table_size=None with k > 4: the k hashes are chained into one 64-bit key."""
    base, queries, ids, X, qids, Q = skewed
    model = lsh.draw_lsh(lsh.LSHParams(k=6, L=3, w=8.0, seed=4, table_size=None), 64)
    coef = np.array(model.coef)
    B = lsh_buckets_np(X, model.offsets, coef, 8.0, 6, None)
    QB = lsh_buckets_np(Q, model.offsets, coef, 8.0, 6, None)
    cand = (QB[:, None, :] == B[None, :, :]).any(axis=2)
    assert rows(lsh.search(model, base, queries, N)) == brute(qids, Q, ids, X, cand)
