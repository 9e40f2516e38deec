"""Method surface (U1), evaluate-a-method job (M6) and sinks."""

import json

import pytest

from knnspark.operators import cluster
from knnspark.plans import api
from knnspark.sources import sink


@pytest.mark.parametrize("method,config", [
    ("brute", None),
    ("lsh", None),
    ("hypercube", None),
    ("ivfflat", api.IVFFlatConfig(k=10, nprobe=3, max_iter=3)),
    ("ivfpq", api.IVFPQConfig(k=10, nprobe=3, m=16, nbits=3, max_iter=2, train_iters=2)),
])
def test_every_method_runs_and_evaluates(split, method, config):
    base, queries = split
    run = api.evaluate(method, base, queries, n=5, radius=1.2, config=config)
    row = run.evaluation.first()
    assert row["method"] == method and row["n"] == 5
    assert json.loads(row["config"])["method"] == method
    assert 0.0 <= row["recall_at_n"] <= 1.0 and row["qps"] > 0
    if method == "brute":
        assert row["recall_at_n"] == 1.0 and abs(row["average_af"] - 1.0) < 1e-9
    assert run.neighbors.count() <= 5 * queries.count()


def test_report_and_result_tables(spark, split, tmp_path):
    base, queries = split
    run = api.evaluate("ivfflat", base, queries, n=3, radius=1.2,
                       config=api.IVFFlatConfig(nprobe=3), centroids=cluster.label_medians(base))
    sink.write_results(str(tmp_path / "res"), run.neighbors, run.range_hits, run.evaluation, fmt="json")
    assert spark.read.json(str(tmp_path / "res" / "neighbors")).count() == run.neighbors.count()
    lines = sink.report_lines(run.compare, run.range_hits, run.evaluation, {"Algorithm": "ivfflat", "N": 3})
    sink.write_report(str(tmp_path / "report"), lines)
    text = "\n".join(r["value"] for r in spark.read.text(str(tmp_path / "report")).collect())
    assert text.startswith("method: ivfflat\n  Algorithm = ivfflat\n  N = 3\nquality: ")
    assert "queries a second" in text and " s in all" in text
    assert text.count("\nquery ") == queries.count()
    assert "  3. id " in text and "(exact: " in text


@pytest.mark.parametrize("method,config", [
    ("brute", api.BruteConfig(pivots=8, block_rows=100)),
    ("lsh", None),
    ("hypercube", None),
    ("ivfflat", api.IVFFlatConfig(k=10, nprobe=3, max_iter=3)),
    ("ivfpq", api.IVFPQConfig(k=10, nprobe=3, m=16, nbits=3, max_iter=2, train_iters=2)),
])
def test_save_and_load_give_same_answers(spark, split, tmp_path, method, config):
    base, queries = split
    index = api.build(method, base, config)
    rows = lambda df: sorted(map(tuple, df.collect()))
    want, hits = (rows(df) for df in api.search(index, queries, 5, 1.2))
    assert rows(api.search(index, queries, 5)[0]) == want  # one scan for both, or for the neighbours alone
    assert [rows(df) for df in api.search(index, queries, 5, 1.2, persist=False)] == [want, hits]
    api.save(index, str(tmp_path / method))
    again = api.load(spark, str(tmp_path / method), base)
    found = api.search(again, queries, 5)[0]
    assert rows(found) == want
    assert [rows(df) for df in api.search(again, queries, 5, 1.2)] == [want, hits]
    # A stored index is read by probed block, cell, bucket or vertex: the filter reaches the scan at run time.
    plan = api.search(again, queries.where("qid < 20"), 5)[0]._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan, plan[-3000:]


def test_capped_cube_gives_both_outputs_from_what_it_examined(split):
    from knnspark.operators import hypercube

    base, queries = split
    model = hypercube.draw_cube(hypercube.CubeParams(kproj=5, probes=4, max_candidates=40), 64)
    near, hits = hypercube.search_and_range(model, base, queries, 5, 1.3)
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(near) == rows(hypercube.search(model, base, queries, 5))
    assert rows(hits) == rows(hypercube.range_search(model, base, queries, 1.3))


def test_pivot_index_of_an_empty_base(spark, split, tmp_path):
    base, queries = split
    index = api.build("brute", base.limit(0), api.BruteConfig(pivots=4))
    assert api.search(index, queries, 3)[0].count() == 0
    api.save(index, str(tmp_path / "empty"))
    assert api.search(api.load(spark, str(tmp_path / "empty"), base.limit(0)), queries, 3)[0].count() == 0
