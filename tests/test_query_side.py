"""The query side stays in Spark: blocks, one reading of the base, nothing collected, run-time filters."""

import pyarrow as pa
import pytest
from pyspark.sql import DataFrame, functions as F

from knnspark.operators import blocks, cluster, exact, hypercube, ivfflat, lsh
from knnspark.session import scratch_scope

N = 5


def rows(df):
    return sorted(map(tuple, df.collect()))


@pytest.fixture()
def small_blocks(spark):
    spark.conf.set("knnspark.broadcast.maxBytes", str(6 * 1024))  # ten queries a block
    yield
    spark.conf.unset("knnspark.broadcast.maxBytes")


def test_blocks_hold_every_query_once(spark, split, small_blocks):
    _, queries = split
    side = blocks.query_side(queries.repartition(7), 64)
    got = list(side.stream())
    assert len(got) == side.blocks > 2 and all(len(b.qids) == side.block_rows for b in got[:-1])
    assert sorted(q for b in got for q in b.qids) == sorted(r["qid"] for r in queries.select("qid").collect())
    vectors = {r["qid"]: r["qv"] for r in queries.collect()}
    assert all(vectors[q] == v.tolist() for b in got for q, v in zip(b.qids.tolist(), b.Q))


def test_answers_do_not_depend_on_the_blocks(spark, split):
    base, queries = split
    index = ivfflat.build_ivfflat(base, cluster.label_median_matrix(base))
    model = lsh.draw_lsh(lsh.LSHParams(seed=3), 64)
    cube = hypercube.draw_cube(hypercube.CubeParams(kproj=5, max_candidates=30, probes=4), 64)
    searches = [lambda: exact.knn(base, queries, N), lambda: exact.knn(base, queries, N, "l1"), lambda: exact.range_search(base, queries, 1.25),
                lambda: lsh.search(model, base, queries, N), lambda: hypercube.search(cube, base, queries, N),
                lambda: ivfflat.search(index, queries, N, 3)]
    once = [rows(s()) for s in searches]
    spark.conf.set("knnspark.broadcast.maxBytes", str(6 * 1024))
    try:
        assert [rows(s()) for s in searches] == once
    finally:
        spark.conf.unset("knnspark.broadcast.maxBytes")


def test_chunks_keep_every_batch():
    batches = [pa.RecordBatch.from_pydict({"x": list(range(k))}) for k in (5, 50, 1, 0, 70)]
    got = list(blocks.chunks(iter(batches), 100))
    assert [b.num_rows for c in got for b in c] == [5, 50, 1, 0, 70] and len(got) > 1


def _counted(monkeypatch):
    """Rows and bytes that reach the driver from here on."""
    seen = []
    for name in ("toArrow", "toPandas"):
        f = getattr(DataFrame, name)
        monkeypatch.setattr(DataFrame, name, lambda self, f=f: seen.append(len(out := f(self))) or out)
    f = DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect", lambda self: seen.append(len(out := f(self))) or out)
    return seen


@pytest.mark.parametrize("times", [1, 100])
def test_driver_gets_the_same_for_a_hundred_times_the_queries(spark, split, monkeypatch, times):
    base, queries = split
    many = queries.select(F.explode(F.sequence(F.lit(0), F.lit(times - 1))).alias("k"), "qid", "qv").select(
        (F.col("qid") * 1000 + F.col("k")).alias("qid"), "qv")
    index = ivfflat.build_ivfflat(base, cluster.label_median_matrix(base))
    model = lsh.draw_lsh(lsh.LSHParams(seed=3), 64)
    cube = hypercube.draw_cube(hypercube.CubeParams(kproj=5, max_candidates=0, probes=4), 64)
    spark.conf.set("knnspark.broadcast.maxBytes", str(64 * 1024))
    seen = _counted(monkeypatch)
    try:
        for make in (lambda: exact.knn(base, many, 1), lambda: lsh.search(model, base, many, 1),
                     lambda: hypercube.search(cube, base, many, 1), lambda: ivfflat.search(index, many, 1, 2)):
            seen.clear()
            plan = make()._jdf.queryExecution().executedPlan().toString()
            assert sum(seen) <= 2  # the dimension and the number of queries
            assert plan.count("MapInArrow") == 1  # one reading of the base, however many blocks
            assert len(plan) < 10_000
    finally:
        spark.conf.unset("knnspark.broadcast.maxBytes")


def selected_folders(df) -> int:
    """Partition folders that the scan of ``df``'s final plan opened."""
    df.collect()
    plan, found = df._jdf.queryExecution().executedPlan(), []

    def walk(node):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if name.endswith("QueryStage"):
            return walk(node.plan())
        metrics = node.metrics()
        if "Scan parquet" in name and metrics.contains("numPartitions"):
            found.append(int(metrics.apply("numPartitions").value()))
        children = node.children()
        for k in range(children.size()):
            walk(children.apply(k))

    walk(plan)
    return max(found)


def test_stored_lists_open_only_probed_folders(spark, split, tmp_path):
    base, queries = split
    one = queries.orderBy("qid").limit(1)
    index = ivfflat.build_ivfflat(base, cluster.label_median_matrix(base))
    ivfflat.write_lists(index, str(tmp_path / "ivf"))
    found = ivfflat.search(index, one, N, 2)
    assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString()
    assert selected_folders(found) == 2
    model = lsh.draw_lsh(lsh.LSHParams(k=4, L=5, w=0.5, seed=3), 64)
    lists = lsh.write_lists(model, base, str(tmp_path / "lsh"))
    assert selected_folders(lsh.search(model, base, one, N, lists=lists)) <= 5
    cube = hypercube.draw_cube(hypercube.CubeParams(kproj=7, max_candidates=0, probes=3), 64)
    lists = hypercube.write_lists(cube, base, str(tmp_path / "cube"))
    assert selected_folders(hypercube.search(cube, base, one, N, lists=lists)) <= 3


def test_index_of_ids_opens_only_probed_folders(spark, split, tmp_path):
    base, queries = split
    model = lsh.draw_lsh(lsh.LSHParams(k=4, L=5, w=0.5, seed=3), 64)
    index = lsh.write_index(model, base, str(tmp_path / "ids"))
    assert "v" not in index.columns
    near = lambda df: sorted((r["qid"], r["rank"], r["id"], round(r["dist"], 9)) for r in df.collect())
    assert near(lsh.search_index(model, index, base, queries, N)) == near(lsh.search(model, base, queries, N))
    assert selected_folders(lsh.candidates(model, index, queries.orderBy("qid").limit(1))) <= 5


def test_capped_search_reads_the_probes_before_the_cap(spark, split, tmp_path):
    base, queries = split
    base = base.unionByName(base.where("id % 3 = 1").withColumn("id", F.col("id") + 10_000))
    for cap in (1, 7, 40, 5000):
        cube = hypercube.draw_cube(hypercube.CubeParams(kproj=7, w=0.3, max_candidates=cap, probes=40), 64)
        lists = hypercube.write_lists(cube, base, str(tmp_path / f"lists{cap}"))
        sizes = hypercube.write_sizes(lists, str(tmp_path / f"sizes{cap}"))
        want = rows(hypercube.search(cube, base, queries, N))
        assert rows(hypercube.search(cube, base, queries, N, lists=lists, sizes=sizes)) == want
        assert rows(hypercube.range_search(cube, base, queries, 1.25, lists=lists, sizes=sizes)) == rows(hypercube.range_search(cube, base, queries, 1.25))
        one = queries.orderBy("qid").limit(1)
        folders = selected_folders(hypercube.search(cube, base, one, N, lists=lists, sizes=sizes))
        planned = hypercube.planned_probes(cube, one, sizes).count()
        assert folders <= planned and (planned == 40 if cap == 5000 else True)
        if cap == 1:
            assert folders < selected_folders(hypercube.search(cube, base, one, N, lists=lists))


def test_radius_search_over_stored_lists_equals_the_scan(spark, split, tmp_path):
    base, queries = split
    model = lsh.draw_lsh(lsh.LSHParams(seed=3), 64)
    lists = lsh.write_lists(model, base, str(tmp_path / "lsh"))
    assert rows(lsh.range_search(model, base, queries, 1.25, lists=lists)) == rows(lsh.range_search(model, base, queries, 1.25))
    for cap in (0, 20):
        cube = hypercube.draw_cube(hypercube.CubeParams(kproj=5, max_candidates=cap, probes=4), 64)
        lists = hypercube.write_lists(cube, base, str(tmp_path / f"cube{cap}"))
        assert rows(hypercube.range_search(cube, base, queries, 1.25, lists=lists)) == rows(hypercube.range_search(cube, base, queries, 1.25))


def test_refined_pq_is_exact_where_every_point_is_a_candidate(spark, split):
    from knnspark.operators import pq

    base, queries = split
    cents = cluster.label_median_matrix(base)
    index = pq.build_ivfpq(base, pq.PQParams(m=8, nbits=2, nprobe=len(cents[0]), train_iters=2), cents)
    near = lambda df: sorted((r["qid"], r["rank"], r["id"], round(r["dist"], 9)) for r in df.collect())
    want = near(exact.knn(base, queries, N))
    assert near(pq.search(index, base, queries, N, refine=450)) == want != near(pq.search(index, base, queries, N))
    some = near(pq.search(index, base, queries, N, refine=60))
    assert len(set((q, i) for q, _, i, _ in some) & set((q, i) for q, _, i, _ in want)) > 0.3 * len(want)
    with pytest.raises(ValueError):
        pq.search(index, base, queries, N, refine=2)


def test_repeated_ids_raise_and_no_valid_query_gives_no_rows(spark, split):
    base, queries = split
    with pytest.raises(ValueError, match="repeat the id"):
        exact.knn(base, queries.unionAll(queries.limit(3)), N)
    bad = spark.createDataFrame([(1, [1.0]), (2, None), (3, [float("nan")] * 64), (4, [None] * 64)], "qid long, qv array<double>")
    assert exact.knn(base, bad, N).count() == 0


def test_scope_deletes_what_was_written_in_it(spark, split):
    import os

    base, queries = split
    with scratch_scope(spark):
        side = blocks.query_side(queries, 64)
        path = side.path.replace("file:", "")
        assert os.path.isdir(path)
    assert not os.path.isdir(path)
