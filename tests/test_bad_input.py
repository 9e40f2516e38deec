"""Bad base vectors, second writes, and file headers: the same rule everywhere."""

import numpy as np
import pytest

from knnspark.functions.distance import gemm_error_bound, not_above
from knnspark.operators import cluster, exact
from knnspark.plans import api
from knnspark.sources import binary

D = 16
CONFIGS = {"brute": None, "lsh": None, "hypercube": None, "ivfflat": api.IVFFlatConfig(k=4, nprobe=2, max_iter=2),
           "ivfpq": api.IVFPQConfig(k=4, nprobe=2, m=4, nbits=2, max_iter=2, train_iters=2)}
BAD = {"nan": [float("nan")] + [0.0] * (D - 1), "infinite": [float("inf")] * D, "null": None, "null element": [None] * D, "short": [1.0] * (D - 1)}


@pytest.fixture(scope="module")
def vectors():
    return np.random.default_rng(3).standard_normal((200, D))


def _base(spark, X, extra=()):
    rows = [(k, x.astype(float).tolist()) for k, x in enumerate(X)] + [(10_000 + k, v) for k, v in enumerate(extra)]
    return spark.createDataFrame(rows, "id bigint, v array<double>").coalesce(1)


def _queries(spark, X):
    return spark.createDataFrame([(k, x.tolist()) for k, x in enumerate(X)], "qid bigint, qv array<double>")


@pytest.mark.parametrize("method", CONFIGS)
@pytest.mark.parametrize("kind", BAD)
def test_a_bad_base_vector_raises_in_every_method(spark, vectors, method, kind):
    clean = _base(spark, vectors)
    base = clean.unionAll(_base(spark, vectors[:0], [BAD[kind]]))
    cents = cluster.centroids_frame(spark, np.arange(4, dtype=np.int32), vectors[:4])
    with pytest.raises(Exception, match="vectors"):
        index = api.build(method, base, CONFIGS[method], cents if method.startswith("ivf") else None)
        api.search(index, _queries(spark, vectors[:5]), 3)[0].collect()


@pytest.mark.parametrize("kind", BAD)
def test_l1_and_assignment_raise_too(spark, vectors, kind):
    base = _base(spark, vectors, [BAD[kind]])
    with pytest.raises(Exception, match="vectors"):
        exact.knn(base, _queries(spark, vectors[:5]), 3, "l1").collect()
    with pytest.raises(Exception, match="vectors"):
        cluster.assign(base, (np.arange(4, dtype=np.int32), vectors[:4])).collect()


def test_a_bad_query_has_an_empty_answer(spark, vectors):
    rows = [(0, vectors[0].tolist())] + [(1 + k, v) for k, v in enumerate(BAD.values())]
    queries = spark.createDataFrame(rows, "qid bigint, qv array<double>")
    for method in ("brute", "lsh", "hypercube"):
        index = api.build(method, _base(spark, vectors), CONFIGS[method])
        assert {r.qid for r in api.search(index, queries, 3)[0].collect()} == {0}


def test_a_huge_row_does_not_hide_its_neighbours(spark, vectors):
    """Each pair has its own rounding bound: a row of 1e200 overflows its square only."""
    X = np.concatenate([vectors, np.full((1, D), 1e200)])
    got = exact.knn(_base(spark, X), _queries(spark, vectors[:20]), 4).collect()
    want = np.argsort(((vectors[:20, None] - vectors[None]) ** 2).sum(axis=2), axis=1, kind="stable")[:, :4]
    assert sorted((r.qid, r["rank"], r.id) for r in got) == sorted((q, k + 1, int(i)) for q, row in enumerate(want) for k, i in enumerate(row))


def test_the_bound_is_of_the_pair():
    err = gemm_error_bound(np.array([1.0, 4.0]), np.array([1.0, 1e30]), 8)
    assert err.shape == (2, 2) and err[0, 0] < 1e-12 < err[0, 1]
    assert [x.tolist() for x in not_above(np.array([[1.0, 3.0, np.nan]]), np.array([[2.0]]))] == [[0, 0], [0, 2]]


def test_running_threshold_keeps_exact_answers(spark, vectors, monkeypatch):
    """Many small chunks and cuts: what earlier chunks prove must not lose a later neighbour."""
    from knnspark.operators import scan

    monkeypatch.setattr(scan, "_PAIR_BUFFER", 64)
    monkeypatch.setattr(exact, "_TASK_ELEMS", 128)
    X = np.round(np.random.default_rng(5).standard_normal((700, 3)), 1)  # many ties
    Q = X[:8]
    run = exact._gemm_kernel((np.arange(8), Q), 6, None)
    import pyarrow as pa

    batches = [pa.RecordBatch.from_arrays([pa.array(np.arange(a, a + 50)), pa.array(X[a:a + 50].tolist())], names=["id", "v"]) for a in range(0, 700, 50)]
    got = sorted((q, d, i) for b in run(iter(batches)) for q, i, d in zip(*(b.column(k).to_pylist() for k in range(3))))
    dist = np.sqrt(((Q[:, None] - X[None]) ** 2).sum(axis=2))
    want = sorted((q, dist[q, i], i) for q in range(8) for i in np.lexsort((np.arange(700), dist[q]))[:6])
    assert [(q, i) for q, _, i in got] == [(q, i) for q, _, i in want]


@pytest.mark.parametrize("kind", ["fvecs", "idx", "text"])
def test_overwrite_leaves_no_old_part(spark, tmp_path, kind):
    X = np.arange(450 * 4).reshape(450, 4) % 256
    binary.write_vectors(_base(spark, X), str(tmp_path), kind, partitions=8)
    binary.write_vectors(_base(spark, X[:100]), str(tmp_path), kind, partitions=2)
    rows = binary.read_vectors(spark, str(tmp_path), kind).orderBy("id").collect()
    assert [r.id for r in rows] == list(range(100)) and [r.v for r in rows] == X[:100].astype(float).tolist()
    binary.write_vectors(_base(spark, X[:0]), str(tmp_path), kind, partitions=2)
    assert binary.read_vectors(spark, str(tmp_path), kind).collect() == []


def test_idx_refuses_values_it_cannot_hold(spark, tmp_path):
    with pytest.raises(Exception, match="0 to 255"):
        binary.write_vectors(_base(spark, np.array([[0.0, 300.0]])), str(tmp_path), "idx", partitions=1)


@pytest.mark.parametrize("body", ["10 2\n1 2\n3 4\n", "1 2\n1 2\n3 4\n", "2 3\n1 2\n3 4\n", "1 2\n3 4 5\n", "no header\n1 2\n"])
def test_text_header_must_hold(spark, tmp_path, body):
    (tmp_path / "x.txt").write_text(body)
    with pytest.raises(Exception, match="declares|header|first line"):
        binary.read_vectors(spark, str(tmp_path / "x.txt"), "text").collect()


def test_training_sample_keeps_its_partitions(spark, vectors):
    base = _base(spark, np.concatenate([vectors] * 5)).repartition(16)
    sample = cluster.training_sample(base, 300, 1)
    assert sample.count() == 300
    assert sum(1 for n in sample.rdd.mapPartitions(lambda it: [sum(1 for _ in it)]).collect() if n) > 8


def test_full_silhouette_in_blocks_equals_one_block(spark, vectors):
    cents = (np.arange(3, dtype=np.int32), vectors[:3])
    assigned = cluster.assign(_base(spark, vectors), cents, carry=("v",))
    order = lambda df: sorted((r.cid is None, r.cid, r.n, round(r.silhouette, 9)) for r in df.collect())
    assert order(cluster.silhouette_full(None, assigned, block=13)) == order(cluster.silhouette_full(None, assigned))


@pytest.mark.parametrize("method", CONFIGS)
def test_a_repeated_query_id_raises(spark, vectors, method):
    cents = cluster.centroids_frame(spark, np.arange(4, dtype=np.int32), vectors[:4])
    index = api.build(method, _base(spark, vectors), CONFIGS[method], cents if method.startswith("ivf") else None)
    queries = _queries(spark, vectors[:5]).unionAll(_queries(spark, vectors[9:10]))
    with pytest.raises(Exception, match="repeat"):
        api.search(index, queries, 3)[0].collect()


def test_medians_of_any_number_of_groups(spark):
    from pyspark.sql import functions as F

    from knnspark.functions.stats import exact_median

    df = spark.range(0, 420_000, 1, 8).select((F.col("id") % 210_000).alias("g"), F.col("id").cast("double").alias("x"))
    got = exact_median(df, ["g"], "x").agg(F.count("*"), F.sum((F.col("median") != F.col("g") + 105_000).cast("int"))).first()
    assert tuple(got) == (210_000, 0)


def test_medians_between_two_runs_of_one_value(spark):
    """Large groups whose middle ranks lie on, between and beside long runs."""
    from knnspark.functions.stats import exact_median

    groups = {0: [1.0] * 500 + [2.0] * 500, 1: [1.0] * 501 + [2.0] * 499, 2: [1.0] * 499 + [1.5, 1.6] + [2.0] * 499,
              3: list(np.random.default_rng(1).standard_normal(3000)), 4: [float("-1e300")] * 400 + list(range(700)), 5: [3.0] * 999}
    df = spark.createDataFrame([(g, float(v)) for g, values in groups.items() for v in values], "g int, x double").repartition(5)
    got = {r.g: r.median for r in exact_median(df, ["g"], "x", accuracy=20, max_collect=50).collect()}
    assert got == {g: float(np.median(v)) for g, v in groups.items()}
