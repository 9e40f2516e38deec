"""Ranks and runs that no task, row or driver gathers: n-th keys, text row numbers, hits in runs, silhouettes, seeding."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from knnspark.operators import cluster, exact, pq
from knnspark.sources import binary, sink
from tests.test_query_side import rows


@pytest.mark.parametrize("few", [10_000, 3])
@pytest.mark.parametrize("size", [1, 2, 100, 449, 450])
def test_nth_key_by_counts(split, monkeypatch, few, size):
    monkeypatch.setattr(cluster, "_FEW_KEYS", few)
    base, _ = split
    got = sorted(r["id"] for r in cluster.training_sample(base.select("id", "v"), size, 3).collect())
    key = F.md5(F.concat_ws(":", F.lit("3"), F.col("id").cast("string")))
    assert got == sorted(r["id"] for r in base.orderBy(key, "id").limit(size).collect())


def test_text_rows_get_ids_over_all_ranges(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(binary, "_RANGE_BLOCK", 3)
    rng = np.random.default_rng(0)
    X = rng.normal(size=(300, 5)).round(3)
    for name, part in (("a", X[:120]), ("b", X[120:121]), ("c", X[121:])):
        body = "".join(" ".join(map(repr, r)) + "\n" for r in part.tolist())
        (tmp_path / f"{name}.txt").write_text(f"{len(part)} 5\n{body}")
    got = {r["id"]: r["v"] for r in binary.read_vectors(spark, str(tmp_path), "text", split_bytes=200).collect()}
    assert got == {k: v for k, v in enumerate(X.tolist())}
    (tmp_path / "b.txt").write_text("1 5\n1 2 3\n")
    with pytest.raises(Exception, match="3 numbers; its header says 5"):
        binary.read_vectors(spark, str(tmp_path), "text").collect()
    (tmp_path / "b.txt").write_text("2 5\n1 2 3 4 5\n")
    with pytest.raises(ValueError, match="declares 2 rows; it holds 1"):
        binary.read_vectors(spark, str(tmp_path), "text")


def _hits(spark):
    rng = np.random.default_rng(1)
    data = [(1, i, float(rng.integers(50))) for i in range(2000)] + [(2, 5, 1.0)] + [(3, i, 0.5) for i in range(10)]
    return spark.createDataFrame(data, "qid long, id long, dist double").repartition(6), data


@pytest.mark.parametrize("size", [7, 10, 100_000])
def test_hits_are_cut_into_runs(spark, size):
    hits, data = _hits(spark)
    want = []
    for q in (1, 2, 3):
        mine = sorted((d, i) for p, i, d in data if p == q)
        want += [(q, k // size, d, i) for k, (d, i) in enumerate(mine)]
    assert rows(exact.hit_runs(hits, size)) == sorted(want)


def test_nested_rows_and_report_hold_a_run_each(spark):
    hits, data = _hits(spark)
    neighbors = spark.createDataFrame([(1, 1, 7, 0.1), (1, 2, 9, 0.2), (4, 1, 2, 0.3)], "qid long, rank int, id long, dist double")
    nested = sorted(exact.nested_result(neighbors, hits, 100).collect(), key=lambda r: (r["qid"], r["run"]))
    assert max(len(r["range"]) for r in nested) == 100
    assert [[x["id"] for x in r["neighbors"]] for r in nested if r["run"] == 0] == [[7, 9], [], [], [2]]
    together = [(x["dist"], x["id"]) for r in nested if r["qid"] == 1 for x in r["range"]]
    assert together == sorted((d, i) for q, i, d in data if q == 1)
    compare = neighbors.withColumn("true_dist", F.col("dist"))
    row = spark.createDataFrame([("lsh", 2, 1.0, 0.5, 1.0, 1.0, 1.0, 1.0)], "method string, n int, average_af double, recall_at_n double, "
                                "qps double, ms_per_query double, truth_ms_per_query double, search_seconds double")
    lines = {(r["key"], r["run"]): r["value"] for r in sink.report_lines(compare, hits, row, {}, False, 100).collect()}
    assert set(lines) == {(-1, 0), (4, 0), *((1, k) for k in range(20))}
    assert lines[1, 0].startswith("query 1\n  1. id 7") and lines[1, 0].count("within radius") == 100 == lines[1, 19].count("within radius")
    assert lines[4, 0] == "query 4\n  1. id 2 at 0.300000 (exact: 0.300000)"


@pytest.mark.parametrize("metric", ["l2", "l1"])
def test_silhouette_streams_members_past_blocks(spark, split, np_split, metric, monkeypatch):
    monkeypatch.setattr(cluster, "CHUNK_BYTES", 20_000)
    base, _ = split
    ids, X, _, _ = np_split
    assigned = cluster.assign(base, cluster.label_median_matrix(base), metric, carry=("v",))
    got = {r["cid"]: (r["n"], round(r["silhouette"], 9)) for r in cluster.silhouette_full(base, assigned, metric, block=37).collect()}
    rows_ = {r["id"]: (r["cid"], r["cid2"]) for r in assigned.collect()}
    own, second = (np.array([rows_[i][k] for i in ids.tolist()]) for k in (0, 1))
    D = np.abs(X[:, None] - X[None]).sum(2) if metric == "l1" else np.sqrt(((X[:, None] - X[None]) ** 2).sum(2))
    scores = []
    for k in range(len(ids)):
        mine, other = own == own[k], own == second[k]
        if mine.sum() < 2 or not other.any():
            scores.append(0.0)
            continue
        a, b = D[k][mine].sum() / (mine.sum() - 1), D[k][other].mean()
        scores.append((b - a) / max(a, b))
    scores = np.array(scores)
    want = {int(c): (int((own == c).sum()), round(float(scores[own == c].mean()), 9)) for c in np.unique(own)}
    assert got == want | {None: (len(ids), round(float(scores.mean()), 9))}


def test_seeding_is_the_same_however_often_its_state_is_written(spark, split):
    base, _ = split
    sample = base.where("id < 150").select("id", "v").repartition(3)
    once = cluster.kmeanspp_seeds(sample, 12, "l2", 4, with_ids=True, state_rounds=100)
    for every in (1, 5):
        again = cluster.kmeanspp_seeds(sample, 12, "l2", 4, with_ids=True, state_rounds=every)
        assert (again[2] == once[2]).all() and (again[1] == once[1]).all()
    few = cluster.kmeanspp_seeds(spark.createDataFrame([(1, [0.0]), (2, [1.0]), (3, [1.0])], "id long, v array<double>"), 5)
    assert len(few[0]) == 2


def test_codebook_seeding_is_the_same_however_often_its_state_is_written(spark, split):
    base, _ = split
    points = base.where("id < 200").select("id", F.col("v").alias("r"))
    once = pq.seed_codebooks(points, 4, 9, 16, 2, state_rounds=100)
    for every in (1, 4):
        again = pq.seed_codebooks(points, 4, 9, 16, 2, state_rounds=every)
        assert all((again[m] == once[m]).all() for m in range(4))


def test_seeding_compares_with_new_centres_only(spark, split, monkeypatch):
    """Distances a point and round do not grow with the number of centres."""
    base, _ = split
    seen = []
    kernel = cluster._nearer_kernel
    monkeypatch.setattr(cluster, "_nearer_kernel", lambda C, metric: seen.append(len(C)) or kernel(C, metric))
    cluster.kmeanspp_seeds(base.select("id", "v"), 20, state_rounds=4)
    assert max(seen) == 4


@pytest.mark.parametrize("metric", ["l2", "l1"])
def test_bounds_never_change_an_assignment(spark, split, metric):
    base, _ = split
    sample = base.select("id", "v")
    cids, C = cluster.kmeanspp_seeds(sample, 7, metric, 3)
    rng = np.random.default_rng(0)
    state, before, compared = sample, None, []
    for scale in (0.3, 0.1, 0.02, 0.002, 0.0):
        state = cluster.lloyd_assign(state, cids, C, metric, before).checkpoint(eager=True)
        want = {r["id"]: r["cid"] for r in cluster.assign(sample, (cids, C), metric).collect()}
        assert {r["id"]: r["cid"] for r in state.collect()} == want
        compared.append(state.agg(F.sum("compared")).first()[0])
        before, C = C, C + rng.normal(size=C.shape) * scale / 8
    assert compared[0] == 450 * 7 and compared[-1] < 0.5 * compared[0] and sorted(compared[2:], reverse=True) == compared[2:]


def test_later_codebook_rounds_compare_fewer_words(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(8, 12)) * 5
    R = centres[np.arange(1500) % 8] + rng.normal(size=(1500, 12)) * 0.3
    points = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(R)], "id long, r array<double>").repartition(3).cache()
    plain, bounded = [], []
    want = pq.train_codebooks(points, 3, 8, 4, 1, 12, state_rounds=100, compared=plain)
    got = pq.train_codebooks(points, 3, 8, 4, 1, 12, state_rounds=2, compared=bounded)
    assert np.allclose(got, want, atol=1e-12) and len(plain) == len(bounded)
    assert sum(bounded) < 0.7 * sum(plain) and bounded[-1] < 0.5 * plain[-1]
    points.unpersist()
