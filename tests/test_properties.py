"""Properties from SURVEY §5: approximate methods collapse to exact search at their limits,
results are invariant to partitioning, and evaluation measures stay in range."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from knnspark.operators import cluster, evaluate as M, exact, hypercube, ivfflat, lsh, pq

N = 5


def rows(df):
    return sorted((r["qid"], r["rank"], r["id"], round(r["dist"], 9)) for r in df.collect())


@pytest.fixture(scope="module")
def truth(split):
    base, queries = split
    return exact.knn(base, queries, N).cache()


def test_exact_matches_numpy(split, np_split, truth):
    ids, X, qids, Q = np_split
    D = np.sqrt(((Q[:, None, :] - X[None, :, :]) ** 2).sum(-1))
    want = []
    for i, q in enumerate(qids):
        order = np.lexsort((ids, D[i]))[:N]
        want += [(int(q), r + 1, int(ids[j]), round(float(D[i, j]), 9)) for r, j in enumerate(order)]
    assert rows(truth) == sorted(want)


def test_distances_non_decreasing(truth):
    for r in truth.groupBy("qid").agg(F.array_sort(F.collect_list(F.struct("rank", "dist"))).alias("a")).collect():
        d = [x["dist"] for x in r["a"]]
        assert d == sorted(d)


def test_ivfflat_all_probes_is_exact(split, truth):
    base, queries = split
    cents = cluster.label_medians(base)
    index = ivfflat.build_ivfflat(base, cents)
    assert rows(ivfflat.search(index, queries, N, nprobe=len(index.cids))) == rows(truth)


def test_cube_all_vertices_no_cap_is_exact(split, truth):
    base, queries = split
    params = hypercube.CubeParams(kproj=4, w=4.0, max_candidates=0, probes=16, seed=3)
    model = hypercube.draw_cube(params, 64)
    assert rows(hypercube.search(model, base, queries, N)) == rows(truth)


def test_lsh_single_bucket_is_exact(split, truth):
    base, queries = split
    model = lsh.draw_lsh(lsh.LSHParams(k=2, L=2, w=1e6, seed=5), 64)
    assert rows(lsh.search(model, base, queries, N)) == rows(truth)


def test_approx_radius_subset_of_exact(split):
    base, queries = split
    full = {(r["qid"], r["id"]) for r in exact.range_search(base, queries, 1.2).collect()}
    model = lsh.draw_lsh(lsh.LSHParams(k=4, L=5, w=4.0, seed=1), 64)
    got = {(r["qid"], r["id"]) for r in lsh.range_search(model, base, queries, 1.2).collect()}
    assert got <= full
    cube = hypercube.draw_cube(hypercube.CubeParams(kproj=7, max_candidates=0, probes=8), 64)
    assert {(r["qid"], r["id"]) for r in hypercube.range_search(cube, base, queries, 1.2).collect()} <= full


def test_recall_and_af_ranges(split, truth):
    base, queries = split
    index = ivfflat.build_ivfflat(base, cluster.label_medians(base))
    approx = ivfflat.search(index, queries, N, 3)
    row = M.summary(approx, truth, queries, N).first()
    assert 0.0 <= row["recall_at_n"] <= 1.0
    assert row["average_af"] >= 1.0 - 1e-12       # true distances, no zero truth distance


def test_partitioning_invariance(split, truth):
    base, queries = split
    for n in (1, 7, 32):
        assert rows(exact.knn(base.repartition(n), queries.repartition(3), N)) == rows(truth)


def test_same_seed_same_index(split):
    base, _ = split
    a = lsh.draw_lsh(lsh.LSHParams(seed=9), 64)
    b = lsh.draw_lsh(lsh.LSHParams(seed=9), 64)
    assert np.array_equal(a.offsets, b.offsets)
    ia = sorted(tuple(r) for r in lsh.build_index(a, base).collect())
    ib = sorted(tuple(r) for r in lsh.build_index(b, base.repartition(5)).collect())
    assert ia == ib


def test_probe_masks_are_bfs_order():
    # breadth-first walk flipping bits in ascending order, for comparison
    for k in (1, 4, 7):
        start, seen, order, queue = 0, {0}, [], [0]
        while queue:
            cur = queue.pop(0)
            order.append(cur)
            for b in range(k):
                nb = cur ^ (1 << b)
                if nb not in seen:
                    seen.add(nb)
                    queue.append(nb)
        assert hypercube.probe_masks(k, 1 << k) == order


def test_silhouette_fast_matches_numpy(split, np_split):
    base, _ = split
    ids, X, _, _ = np_split
    cids, C = cluster.centroid_matrix(cluster.label_medians(base))
    D = np.sqrt(((X[:, None, :] - C[None, :, :]) ** 2).sum(-1))
    srt = np.sort(D, axis=1)
    a, b = srt[:, 0], srt[:, 1]
    s = np.where(np.maximum(a, b) > 0, (b - a) / np.maximum(a, b), 0.0)
    got = cluster.silhouette_fast(cluster.assign(base, (cids, C))).where("cid IS NULL").first()["silhouette"]
    assert abs(got - s.mean()) < 1e-9


def test_exact_median_matches_numpy(spark):
    from knnspark.functions.stats import exact_median

    rng = np.random.default_rng(0)
    data = [(g, float(x)) for g in range(4) for x in rng.normal(size=101 + 2 * g)]
    data += [(9, 1.0), (9, 1.0), (9, 3.0), (9, 7.0)]
    df = spark.createDataFrame(data, "g int, x double")
    got = {r["g"]: r["median"] for r in exact_median(df, ["g"], "x").collect()}
    for g in set(k for k, _ in data):
        assert abs(got[g] - float(np.median([x for k, x in data if k == g]))) < 1e-12


def test_pq_fallback_for_queries_without_candidates(spark, split):
    """A query whose probed cells are all empty gets the exact answer."""
    base, queries = split
    cents = cluster.label_medians(base)
    cids, C = cluster.centroid_matrix(cents)
    # Extra centroids placed on the query vectors themselves own no base point (queries are
    # not in the base set), so with nprobe=1 those queries see only empty cells.
    qrows = queries.orderBy("qid").limit(3).collect()
    extra_ids = np.arange(100, 100 + len(qrows), dtype=np.int32)
    C2 = np.vstack([C, np.array([r["qv"] for r in qrows])])
    cids2 = np.concatenate([cids, extra_ids])
    params = pq.PQParams(m=16, nbits=2, nprobe=1, train_iters=2)
    index = pq.build_ivfpq(base, params, (cids2, C2))
    lonely = queries.where(F.col("qid").isin([r["qid"] for r in qrows]))
    got = rows(pq.search(index, base, lonely, N))
    assert got == rows(exact.knn(base, lonely, N))


def test_stored_index_paths_match_fused_scans(spark, split, tmp_path):
    base, queries = split
    lm = lsh.draw_lsh(lsh.LSHParams(k=4, L=5, w=4.0, seed=1), 64)
    idx = lsh.build_index(lm, base)
    assert rows(lsh.search_index(lm, idx, base, queries, N)) == rows(lsh.search(lm, base, queries, N))
    cm = hypercube.draw_cube(hypercube.CubeParams(kproj=7, max_candidates=50, probes=8), 64)
    cidx = hypercube.build_index(cm, base)
    assert rows(hypercube.search_index(cm, cidx, base, queries, N)) == rows(hypercube.search(cm, base, queries, N))
    # IVF lists written partitioned by cid give the same answer (and prune to probed cells)
    index = ivfflat.build_ivfflat(base, cluster.label_medians(base))
    want = rows(ivfflat.search(index, queries, N, 3))
    ivfflat.write_lists(index, str(tmp_path / "lists"))
    assert rows(ivfflat.search(index, queries, N, 3)) == want


def test_pq_codebook_sample_option(split):
    base, queries = split
    params = pq.PQParams(m=16, nbits=3, nprobe=3, train_iters=3, codebook_train_size=100)
    index = pq.build_ivfpq(base, params, cluster.label_medians(base))
    assert index.codebooks.shape == (16, 8, 4)
    assert index.codes.count() == base.count()


def test_scan_partitions_setting_keeps_results(spark, split, truth):
    base, queries = split
    spark.conf.set("knnspark.scan.partitions", "2")
    try:
        assert rows(exact.knn(base.repartition(9), queries, N)) == rows(truth)
        model = lsh.draw_lsh(lsh.LSHParams(k=2, L=2, w=1e6, seed=5), 64)
        assert rows(lsh.search(model, base.repartition(9), queries, N)) == rows(truth)
    finally:
        spark.conf.unset("knnspark.scan.partitions")


def test_exact_median_large_and_duplicate_groups(spark):
    """Groups above the collect limit go through counting / narrowing passes; a group whose
    middle is a long run of one value is answered without collecting it."""
    from knnspark.functions.stats import exact_median

    rng = np.random.default_rng(7)
    big = rng.normal(size=5001)
    dup = np.concatenate([np.full(3000, 2.5), rng.normal(size=1000), rng.normal(size=1000) + 9])
    even = rng.normal(size=4000)
    data = [(0, float(x)) for x in big] + [(1, float(x)) for x in dup] + [(2, float(x)) for x in even]
    df = spark.createDataFrame(data, "g int, x double").repartition(5)
    for acc in (10_000, 20):            # 20: a wide first bracket forces narrowing passes
        got = {r["g"]: r["median"] for r in exact_median(df, ["g"], "x", accuracy=acc, max_collect=300).collect()}
        assert got[0] == float(np.median(big))
        assert got[1] == float(np.median(dup))
        assert got[2] == float(np.median(even))


def test_small_broadcast_bound_splits_query_blocks(spark, split, truth):
    """A tiny bound forces several query blocks (several passes); answers do not change."""
    base, queries = split
    index = ivfflat.build_ivfflat(base, cluster.label_median_matrix(base))
    spark.conf.set("knnspark.broadcast.maxBytes", str(8 * 1024))
    try:
        assert rows(exact.knn(base, queries, N)) == rows(truth)
        model = lsh.draw_lsh(lsh.LSHParams(k=2, L=2, w=1e6, seed=5), 64)
        assert rows(lsh.search(model, base, queries, N)) == rows(truth)
        assert rows(ivfflat.search(index, queries, N, 10)) == rows(truth)
    finally:
        spark.conf.unset("knnspark.broadcast.maxBytes")


def test_scan_sized_by_shuffle_budget(spark, split, truth):
    """With a tiny shuffle-row budget the scan is coalesced to 2x parallelism; same answers."""
    from knnspark.session import scan_source

    base, queries = split
    many = base.repartition(40)
    spark.conf.set("knnspark.scan.maxShuffleRows", "10")
    try:
        assert scan_source(many, 1000).rdd.getNumPartitions() == 2 * spark.sparkContext.defaultParallelism
        assert rows(exact.knn(many, queries, N)) == rows(truth)
    finally:
        spark.conf.unset("knnspark.scan.maxShuffleRows")
    assert scan_source(many, 1000).rdd.getNumPartitions() == 40


@pytest.mark.parametrize("size", [1, 7, 21, 200, 449, 450, 451, 1000])
def test_training_sample_equals_global_md5_order(split, size):
    from pyspark.sql import functions as F

    base, _ = split
    got = sorted(r["id"] for r in cluster.training_sample(base.select("id", "v"), size, 3).collect())
    key = F.md5(F.concat_ws(":", F.lit("3"), F.col("id").cast("string")))
    want = sorted(r["id"] for r in base.orderBy(key, "id").limit(size).collect())
    assert got == want


def test_kmedians_change_count(split):
    """The change count carried by the median pass equals a direct count."""
    from pyspark.sql import functions as F

    base, _ = split
    sample = cluster.training_sample(base.select("id", "v"), 60, 1)
    cids, C = cluster.kmeanspp_seeds(sample, 5, "l2", 1)
    a0, ch0, (cids1, C1) = cluster.kmedians_step(sample, cids, C, "l2")
    assert ch0 == a0.where(F.col("cid") != 0).count()
    a1, ch1, _ = cluster.kmedians_step(sample, cids1, C1, "l2", prev=(cids, C))
    old = cluster.assign(sample, (cids, C)).select("id", F.col("cid").alias("old"))
    new = cluster.assign(sample, (cids1, C1)).select("id", "cid")
    assert ch1 == new.join(old, "id").where(F.col("cid") != F.col("old")).count()


def test_l1_metric_through_every_method(split):
    """At their exact limits the approximate methods equal exact L1 search too."""
    base, queries = split
    want = rows(exact.knn(base, queries, N, "l1"))
    cids, C = cluster.label_median_matrix(base)
    index = ivfflat.build_ivfflat(base, (cids, C), cluster.KMediansParams(metric="l1"))
    assert rows(ivfflat.search(index, queries, N, nprobe=len(cids))) == want
    model = lsh.draw_lsh(lsh.LSHParams(k=2, L=2, w=1e6, seed=5, metric="l1"), 64)
    assert rows(lsh.search(model, base, queries, N)) == want
    import warnings
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        cube = hypercube.draw_cube(hypercube.CubeParams(kproj=3, max_candidates=0, probes=8, metric="l1"), 64)
    assert rows(hypercube.search(cube, base, queries, N)) == want
