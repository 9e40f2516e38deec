"""Exact search that skips: same answers as the scan, fewer blocks read on clustered data."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from knnspark.functions.distance import pairwise
from knnspark.operators import exact, pivot
from tests.test_query_side import rows, selected_folders

N = 5


def clustered(n=6000, d=16, clusters=40, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, d)) * 10
    X = centres[rng.integers(clusters, size=n)] + rng.normal(size=(n, d)) * 0.3
    X[100:160] = X[100]  # copies: ties
    return X, centres


@pytest.fixture(scope="module")
def data(spark):
    X, centres = clustered()
    rng = np.random.default_rng(2)
    Q = centres[:6] + rng.normal(size=(6, X.shape[1])) * 0.2
    base = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(X)], "id long, v array<double>").repartition(4)
    queries = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate([*Q, X[100]])], "qid long, qv array<double>")
    return base.cache(), queries


@pytest.mark.parametrize("metric,radius", [("l2", 1.5), ("l1", 5.0)])
@pytest.mark.parametrize("block_rows", [100, 1 << 18])
def test_clustered_data_same_answers(data, metric, radius, block_rows):
    base, queries = data
    index = pivot.build(base, block_rows=block_rows, metric=metric)
    assert rows(pivot.knn(index, queries, N)) == rows(exact.knn(base, queries, N, metric))
    assert rows(pivot.range_search(index, queries, radius)) == rows(exact.range_search(base, queries, radius, metric))


def test_few_blocks_are_read(spark, data):
    base, queries = data
    index = pivot.build(base, block_rows=100)
    n = index.blocks.count()
    one = queries.where("qid = 0")
    assert n >= 50
    assert 0 < selected_folders(pivot.range_search(index, one, 1.5)) <= n // 5
    assert 0 < selected_folders(pivot.knn(index, one, N)) <= n // 5


def test_unstructured_data_and_many_neighbours(spark, split):
    base, queries = split
    index = pivot.build(base, block_rows=64)
    for n in (1, N, 70, 1000):
        assert rows(pivot.knn(index, queries, n)) == rows(exact.knn(base, queries, n))
    assert rows(pivot.range_search(index, queries, 1.25)) == rows(exact.range_search(base, queries, 1.25))


def test_blocks_of_queries_and_awkward_input(spark, data):
    base, queries = data
    index = pivot.build(base, block_rows=500)
    spark.conf.set("knnspark.broadcast.maxBytes", "400")
    try:
        several = rows(pivot.knn(index, queries, N)), rows(pivot.range_search(index, queries, 1.5))
    finally:
        spark.conf.unset("knnspark.broadcast.maxBytes")
    assert several == (rows(exact.knn(base, queries, N)), rows(exact.range_search(base, queries, 1.5)))
    assert pivot.build(base.limit(0)) is None
    assert pivot.knn(None, queries, N).count() == 0 and pivot.range_search(index, queries, 0).count() == 0
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(50)], "id long, v array<double>")
    q = spark.createDataFrame([(1, [1.0, 2.0]), (2, [0.0, 0.0]), (3, None)], "qid long, qv array<double>")
    index = pivot.build(same, block_rows=10)
    assert rows(pivot.knn(index, q, 3)) == rows(exact.knn(same, q, 3))
    with pytest.raises(ValueError):
        pivot.knn(index, q, 0)


def test_one_block_is_many_tasks_work(spark):
    """Fewer blocks than cores: their rows are still spread over files, so that no task has a whole block."""
    rng = np.random.default_rng(3)
    X = rng.standard_normal((12000, 4))
    base = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(X)], "id long, v array<double>")
    index = pivot.build(base, block_rows=1 << 16)
    sizes = [r["count"] for r in index.rows.groupBy("block", F.input_file_name().alias("f")).count().collect()]
    assert index.blocks.count() == 1 and sum(sizes) == len(X) and len(sizes) >= 4 and max(sizes) <= len(X) // 2


@pytest.mark.parametrize("metric", ["l2", "l1"])
def test_first_rows_of_a_task_are_not_all_scored(metric, monkeypatch):
    rng = np.random.default_rng(4)
    X, Q = np.round(rng.standard_normal((2000, 8)), 1), np.round(rng.standard_normal((50, 8)), 1)  # ties
    near = pairwise(X, X[:3], metric)
    lists = lambda A: pa.array(A.tolist(), pa.list_(pa.float64()))
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(2000)), lists(X), lists(near), pa.array(np.zeros(2000, np.int32))],
                                       names=["id", "v", "near", "block"])
    scored = []
    true = pivot.pair_distances
    monkeypatch.setattr(pivot, "pair_distances", lambda q, x, qi, xi, m: (scored.append(len(qi)), true(q, x, qi, xi, m))[1])
    payload = (np.arange(50), Q, pairwise(Q, X[:3], metric), np.full(50, np.inf), None)
    out = [r for b in pivot._scan_kernel(metric, 5, False)(payload)(iter([batch])) for r in b.to_pylist()]
    D = pairwise(Q, X, metric)
    want = {(q, int(i)) for q in range(50) for i in np.lexsort((np.arange(2000), D[q]))[:5]}
    assert {(r["qid"], r["id"]) for r in out} == want
    assert sum(scored) < Q.shape[0] * len(X) // 10
