"""Searches whose memory and shuffles don't grow with the number of (query, row) pairs."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from knnspark.functions.distance import l1_near, pairwise
from knnspark.operators import blocks, exact, hypercube, lsh


def _batches(X, size=1000, first=0):
    for a in range(0, len(X), size):
        x = X[a:a + size]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(first + a, first + a + len(x))), pa.array(x.tolist())], names=["id", "v"])


@pytest.mark.parametrize("metric, n, radius", [("l2", 5, None), ("l1", 5, None), ("l2", 0, 0.5), ("l1", 0, 0.5)])
def test_task_memory_is_bounded_for_many_queries(metric, n, radius):
    rng = np.random.default_rng(1)
    Q, batches = rng.standard_normal((6000, 8)), list(_batches(rng.standard_normal((3000, 8))))
    tracemalloc.start()
    for _ in exact._scan_kernel((np.arange(len(Q)), Q), metric, n, radius)(iter(batches)):
        pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100 << 20


@pytest.mark.parametrize("scale", [1e-30, 1.0, 1e30, 1e300])
def test_l1_bound_holds(scale):
    rng = np.random.default_rng(2)
    Q, X = rng.standard_normal((40, 33)) * scale, rng.standard_normal((1100, 33)) * scale
    near, err = l1_near(Q, X)
    true = pairwise(Q, X, "l1")
    assert not (near - err > true).any() and not (near + err < true).any()


def test_kept_rows_bound_a_block_of_queries(spark):
    queries = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(50)], "qid long, qv array<double>")
    assert blocks.query_side(queries, 2).block_rows > blocks.KEPT_ROWS // 200
    assert blocks.query_side(queries, 2, keep=200).block_rows == blocks.KEPT_ROWS // 200


def _tables(spark, n=400, d=6):
    rng = np.random.default_rng(3)
    X = rng.standard_normal((n, d)).tolist()
    base = spark.createDataFrame([(i, X[i]) for i in range(n)], "id long, v array<double>")
    return X, base, spark.createDataFrame([(i, X[i]) for i in range(0, n, 20)], "qid long, qv array<double>")


def test_index_search_shuffles_no_pairs(spark, tmp_path):
    X, base, queries = _tables(spark)
    model = lsh.draw_lsh(lsh.LSHParams(k=2, L=3, w=4.0), 6)
    index = lsh.write_index(model, base, str(tmp_path / "index"))
    plan = lsh.candidates(model, index, queries)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(qid" not in plan
    found = lsh.search_index(model, index, base, queries, 5)
    vectors = [line for line in found._jdf.queryExecution().executedPlan().toString().splitlines() if "qv" in line]
    assert vectors == []
    rows = lambda df: sorted((r.qid, r.rank, r.id, round(r.dist, 9)) for r in df.collect())
    assert rows(found) == rows(lsh.search(model, base, queries, 5))


def test_index_search_with_repeated_ids(spark, tmp_path):
    """All rows of an id are compared with all rows of a query id if they share a bucket anywhere."""
    X, base, queries = _tables(spark, 200)
    base = base.unionAll(spark.createDataFrame([(3, X[150]), (3, X[3]), (None, X[7])], "id long, v array<double>"))
    queries = queries.unionAll(spark.createDataFrame([(20, X[60]), (40, X[40])], "qid long, qv array<double>"))
    model = lsh.draw_lsh(lsh.LSHParams(k=2, L=2, w=3.0), 6)
    index = lsh.write_index(model, base, str(tmp_path / "index"))
    of_base, of_query = {}, {}
    for rows, out in ((lsh.build_index(model, base), of_base), (lsh.query_buckets(model, queries, False), of_query)):
        for r in rows.collect():
            out.setdefault(r[0] if "qid" in rows.columns else r.id, set()).add((r.t, r.bucket))
    pairs = {(q, i) for q in of_query for i in of_base if of_query[q] & of_base[i]}
    assert sorted(map(str, pairs)) == sorted(str(tuple(r)) for r in lsh.candidates(model, index, queries).collect())
    want = {}
    for q in queries.collect():
        for b in base.collect():
            if b.id is not None and (q.qid, b.id) in pairs:
                want.setdefault(q.qid, []).append((round(float(np.linalg.norm(np.array(q.qv) - b.v)), 9), b.id))
    got = {}
    for r in lsh.search_index(model, index, base, queries, 4).collect():
        got.setdefault(r.qid, []).append((round(r.dist, 9), r.id))
    assert {q: sorted(v) for q, v in got.items()} == {q: sorted(v)[:4] for q, v in want.items()}


def test_cube_candidates_are_capped_where_they_are_found(spark):
    X, base, queries = _tables(spark)
    queries = queries.unionAll(queries.where("qid = 40"))
    for cap in (7, 0):
        model = hypercube.draw_cube(hypercube.CubeParams(kproj=3, w=4.0, max_candidates=cap, probes=3), 6)
        index = hypercube.build_index(model, base)
        found = hypercube.candidates(model, index, queries)
        assert "Join" not in found._jdf.queryExecution().executedPlan().toString()
        pairs = index.join(hypercube.query_probes(model, queries), "code").select("qid", "id", "prank")
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, hypercube._cap(pairs, cap).collect()))


@pytest.mark.parametrize("metric", ["l2", "l1"])
def test_dense_buckets_give_the_same_answers(metric, monkeypatch):
    rng = np.random.default_rng(4)
    X = np.round(rng.standard_normal((900, 5)), 1)  # ties
    model = lsh.draw_lsh(lsh.LSHParams(k=1, L=3, w=4.0, metric=metric), 5)
    block = blocks.Block(np.arange(0, 900, 9), X[::9], {})
    def run(dense, n, radius):
        monkeypatch.setattr(lsh, "_DENSE", -1.0 if dense else 9.0)
        made = lsh._payload(model)(block)
        assert (made[2] is None) == dense
        out = lsh._scan_kernel(model, n, radius)(made)(_batches(X, 70))
        return sorted(tuple(r.values()) for b in out for r in b.to_pylist())
    for n, radius in ((4, None), (0, 1.5), (3, 1.5)):
        assert run(True, n, radius) == run(False, n, radius) != []


def test_pairs_sharing_entries_are_found_once():
    rng = np.random.default_rng(5)
    rows = [sorted(set(rng.integers(0, 30, rng.integers(0, 5)).tolist())) for _ in range(60)]
    queries = [sorted(set(rng.integers(0, 30, 4).tolist())) for _ in range(25)]
    block = blocks.Block(np.arange(25), np.zeros((25, 0)), {"entries": pa.array(queries, pa.list_(pa.int64()))})
    _, _, keys, owners = lsh._entry_payload(block)
    want = sorted((i, j) for i, r in enumerate(rows) for j, q in enumerate(queries) if set(r) & set(q))
    for limit in (1, 7, 1 << 18):
        got = [(int(a), int(b)) for r, q in lsh._sharing(keys, owners, 25, pa.array(rows, pa.list_(pa.int64())), limit) for a, b in zip(r, q)]
        assert sorted(got) == want
