"""Edge cases."""

import struct

import numpy as np
import pytest

from knnspark.functions.distance import metric_name
from knnspark.operators import cluster, exact, hypercube, ivfflat, lsh, pq
from knnspark.plans import api
from knnspark.sources import binary
from knnspark.sources.vectors import check_uniform_dim, validate_vectors

SCHEMA_B = "id bigint, v array<double>"
SCHEMA_Q = "qid bigint, qv array<double>"


def test_n_greater_than_candidates(spark):
    base = spark.createDataFrame([(0, [0.0, 0.0]), (1, [1.0, 0.0])], SCHEMA_B)
    q = spark.createDataFrame([(7, [0.0, 0.1])], SCHEMA_Q)
    assert [r["id"] for r in exact.knn(base, q, 10).orderBy("rank").collect()] == [0, 1]


def test_empty_base_and_empty_queries(spark, split):
    base, queries = split
    empty_b = spark.createDataFrame([], SCHEMA_B)
    empty_q = spark.createDataFrame([], SCHEMA_Q)
    assert exact.knn(empty_b, queries, 3).count() == 0
    assert exact.knn(base, empty_q, 3).count() == 0
    assert exact.range_search(base, empty_q, 1.0).count() == 0


def test_wrong_length_query_gets_no_rows(spark, split):
    base, _ = split
    q = spark.createDataFrame([(1, [0.0] * 64), (2, [0.0] * 3)], SCHEMA_Q)
    got = exact.knn(base, q, 2)
    assert sorted({r["qid"] for r in got.collect()}) == [1]
    idx = ivfflat.build_ivfflat(base, cluster.label_medians(base))
    assert sorted({r["qid"] for r in ivfflat.search(idx, q, 2, 2).collect()}) == [1]


def test_radius_zero_disables_range(split):
    base, queries = split
    assert exact.range_search(base, queries, 0.0).count() == 0
    assert exact.range_search(base, queries, -1.0).count() == 0


def test_n_must_be_positive(split):
    base, queries = split
    with pytest.raises(ValueError):
        exact.knn(base, queries, 0)


def test_unknown_metric_and_method(split):
    with pytest.raises(ValueError):
        metric_name("cosine")
    with pytest.raises(ValueError):
        api.build("dummy", split[0])


def test_duplicate_vectors_tie_on_id(spark):
    base = spark.createDataFrame([(5, [1.0, 1.0]), (2, [1.0, 1.0]), (9, [1.0, 1.0]), (1, [3.0, 3.0])], SCHEMA_B)
    q = spark.createDataFrame([(0, [0.0, 0.0])], SCHEMA_Q)
    assert [r["id"] for r in exact.knn(base, q, 2).orderBy("rank").collect()] == [2, 5]


def test_all_points_equal_seeding_stops_early(spark):
    pts = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(9)], SCHEMA_B)
    cids, C = cluster.kmeanspp_seeds(pts, 4, "l2", 1)
    assert len(cids) == 1


def test_k_greater_than_sample(spark):
    pts = spark.createDataFrame([(i, [float(i), 0.0]) for i in range(4)], SCHEMA_B)
    cids, C, _ = cluster.kmedians_fit(pts, cluster.KMediansParams(k=10, train_size=3, max_iter=3))
    assert len(cids) == 3          # actual k = distinct training points (D7)


def test_singleton_and_empty_clusters(spark):
    pts = spark.createDataFrame([(0, [0.0]), (1, [0.1]), (2, [10.0])], "id bigint, v array<double>")
    cids, C = np.array([0, 1, 2], dtype=np.int32), np.array([[0.0], [10.0], [100.0]])
    a = cluster.assign(pts, (cids, C))
    full = {r["cid"]: r["silhouette"] for r in cluster.silhouette_full(pts, a).collect()}
    assert full[1] == 0.0            # singleton
    _, changes, (c2, C2) = cluster.kmedians_step(pts, cids, C, "l2")
    assert C2[2, 0] == 100.0         # empty cluster keeps its centroid (D8)
    assert C2[0, 0] == pytest.approx(0.05)


def test_pq_parameter_checks(split):
    with pytest.raises(ValueError):
        pq.PQParams(nbits=0)
    with pytest.raises(ValueError):
        pq.PQParams(nbits=9)
    base, _ = split
    with pytest.raises(ValueError):
        pq.build_ivfpq(base, pq.PQParams(m=7, nbits=2), cluster.label_medians(base))


def test_cube_parameter_rules():
    p = hypercube.CubeParams(kproj=40, max_candidates=-3, probes=0, w=-1)
    assert (p.kproj, p.max_candidates, p.probes, p.w) == (32, 0, 1, 4.0)


def test_lsh_empty_bucket_gives_fewer_rows(spark):
    base = spark.createDataFrame([(0, [0.0, 0.0])], SCHEMA_B)
    q = spark.createDataFrame([(1, [50.0, 50.0])], SCHEMA_Q)
    model = lsh.draw_lsh(lsh.LSHParams(k=1, L=1, w=1.0, seed=2, table_size=None), 2)
    assert lsh.search(model, base, q, 3).count() == 0


def test_validate_and_ragged(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0]), (2, None)], SCHEMA_B)
    row = validate_vectors(df, "v", expected_dim=2).first()
    assert (row["n_rows"], row["n_null"], row["min_dim"], row["max_dim"], row["n_wrong_dim"]) == (3, 1, 1, 2, 1)
    with pytest.raises(ValueError):
        check_uniform_dim(df.where("v IS NOT NULL"))


def test_truncated_fvecs_and_bad_idx_magic(spark, tmp_path):
    good = tmp_path / "a.fvecs"
    rec = struct.pack("<i", 2) + struct.pack("<2f", 1.0, 2.0)
    good.write_bytes(rec * 3 + rec[:5])
    with pytest.raises(Exception):
        binary.read_vectors(spark, str(good), "fvecs").collect()
    bad = tmp_path / "b.idx"
    bad.write_bytes(struct.pack(">IIII", 0x801, 1, 2, 2) + bytes(4))
    with pytest.raises(Exception):
        binary.read_vectors(spark, str(bad), "idx").collect()


def test_fvecs_and_idx_roundtrip_with_splits(spark, tmp_path):
    rng = np.random.default_rng(1)
    X = rng.random((37, 6)).astype(np.float32)
    p = tmp_path / "x.fvecs"
    p.write_bytes(b"".join(struct.pack("<i", 6) + row.tobytes() for row in X))
    got = binary.read_vectors(spark, str(p), "fvecs", split_bytes=100).orderBy("id").collect()
    assert [r["id"] for r in got] == list(range(37))
    assert np.array_equal(np.array([r["v"] for r in got]), X.astype(np.float64))
    img = rng.integers(0, 256, size=(11, 3, 4), dtype=np.uint8)
    q = tmp_path / "x.idx"
    q.write_bytes(struct.pack(">IIII", 0x803, 11, 3, 4) + img.tobytes())
    got = binary.read_vectors(spark, str(q), "idx", split_bytes=30).orderBy("id").collect()
    assert np.array_equal(np.array([r["v"] for r in got]), img.reshape(11, 12).astype(np.float64))


def test_dataset_type_aliases(spark, tmp_path):
    p = tmp_path / "a.fvecs"
    p.write_bytes(struct.pack("<i", 2) + struct.pack("<2f", 1.0, 2.0))
    assert [list(r["v"]) for r in binary.read_vectors(spark, str(p), "sift").collect()] == [[1.0, 2.0]]
    q = tmp_path / "a.idx"
    q.write_bytes(struct.pack(">IIII", 0x803, 1, 1, 2) + bytes([7, 9]))
    assert [list(r["v"]) for r in binary.read_vectors(spark, str(q), "MNIST").collect()] == [[7.0, 9.0]]
    with pytest.raises(Exception):
        binary.read_vectors(spark, str(q), "demo").collect()


def test_cube_warns_for_l1():
    with pytest.warns(UserWarning):
        hypercube.CubeParams(metric="l1")
