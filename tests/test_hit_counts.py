"""Radius hits that are counted as they are found: the same numbers, and nothing written in proportion to them."""

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from knnspark.operators import exact, hypercube, lsh
from knnspark.plans import api, registry


def rows(df):
    return sorted(map(tuple, df.collect()))


@pytest.fixture(scope="module")
def table(tmp_path_factory):
    """600 unit vectors of 64 dimensions; a folder as the queries read it."""
    rng = np.random.default_rng(5)
    X = rng.normal(size=(600, 64))
    X /= np.linalg.norm(X, axis=1, keepdims=True)
    at = tmp_path_factory.mktemp("rows")
    pq.write_table(pa.table({"vec_id": pa.array(range(600), pa.int64()), "embedding": pa.array(list(X.astype(np.float32)), pa.list_(pa.float32())),
                             "label": pa.array([i % 10 for i in range(600)], pa.int32())}), at / "embeddings.parquet")
    return str(at)


@pytest.mark.parametrize("name", ["evaluate_lsh", "evaluate_cube"])
def test_evaluation_writes_no_table_of_hits(spark, table, monkeypatch, name):
    made = []
    given = exact.scratch_path
    monkeypatch.setattr(exact, "scratch_path", lambda s, what: made.append(given(s, what)) or made[-1])
    row = registry.QUERIES[name](spark, table).first()
    assert len(made) == 1
    written = spark.read.parquet(made[0]).count()
    queries, tasks = 30, 8
    assert row["n_hits"] > 0 and written <= queries * (tasks * registry.N + 1 + (registry.CUBE_CAP if name == "evaluate_cube" else 0))
    if name == "evaluate_lsh":
        assert row["n_hits"] > 5 * written


@pytest.mark.parametrize("method,config", [
    ("brute", None),
    ("brute", api.BruteConfig(pivots=8, block_rows=100)),
    ("lsh", None),
    ("hypercube", None),
    ("hypercube", hypercube.CubeParams(kproj=5, max_candidates=40, probes=8)),
    ("ivfflat", api.IVFFlatConfig(k=10, nprobe=3, max_iter=3)),
    ("ivfpq", api.IVFPQConfig(k=10, nprobe=3, m=16, nbits=3, max_iter=2, train_iters=2)),
])
def test_counts_are_the_hits_of_each_query(split, method, config):
    base, queries = split
    index = api.build(method, base, config)
    near, hits = api.search(index, queries, 5, 1.3)
    counted = api.search(index, queries, 5, 1.3, persist=exact.COUNTS)
    assert rows(counted[0]) == rows(near)
    assert rows(counted[1]) == rows(hits.groupBy("qid").count()) != []


def test_counts_with_repeated_rows_and_without_hits(spark, split):
    base, queries = split
    twice = base.unionByName(base.where("id % 3 = 0"))  # rows of one id tie
    model = lsh.draw_lsh(lsh.LSHParams(seed=3), 64)
    near, hits = lsh.search_and_range(model, twice, queries, 5, 1.3)
    counted = lsh.search_and_range(model, twice, queries, 5, 1.3, exact.COUNTS)
    assert rows(counted[0]) == rows(near) and rows(counted[1]) == rows(hits.groupBy("qid").count())
    assert near.count() > near.select("qid", "id").distinct().count()
    near, none = lsh.search_and_range(model, base, queries, 5, 1e-9, exact.COUNTS)
    assert none.count() == 0 and near.count() == 5 * queries.count()
    assert [df.count() for df in lsh.search_and_range(model, base.limit(0), queries, 5, 1.3, exact.COUNTS)] == [0, 0]


@pytest.mark.parametrize("keep", [True, False])
def test_evaluation_with_and_without_the_hits(split, keep):
    base, queries = split
    run = api.evaluate("lsh", base, queries, n=5, radius=1.3, keep_hits=keep)
    want = api.search(api.build("lsh", base), queries, 5, 1.3)[1]
    assert (run.range_hits is not None) == keep
    assert rows(run.hit_counts) == rows(want.groupBy("qid").count())
    assert api.evaluate("lsh", base, queries.limit(3), n=5, keep_hits=keep).hit_counts is None
