"""Streamed queries give the same answers as the batch search."""

from pyspark.sql import functions as F

from knnspark.operators import cluster
from knnspark.plans import api
from knnspark.streaming import search as S


def test_stream_matches_batch(spark, split, tmp_path):
    base, queries = split
    src = str(tmp_path / "queries")
    # queries arrive as several files
    queries.repartition(4, "qid").write.parquet(src)
    index = api.build("ivfflat", base, api.IVFFlatConfig(nprobe=3), centroids=cluster.label_medians(base))
    q = S.start_search(index, S.query_stream(spark, src, max_files_per_trigger=1), 5, str(tmp_path / "out"),
                       radius=1.2, checkpoint=str(tmp_path / "ckpt"))
    q.awaitTermination(300)
    got = sorted(tuple(r) for r in S.read_results(spark, str(tmp_path / "out")).select(
        "qid", "rank", "id", F.round("dist", 9)).collect())
    nb, hits = api.search(index, queries, 5, 1.2)
    want = sorted(tuple(r) for r in nb.select("qid", "rank", "id", F.round("dist", 9)).collect())
    assert got == want
    got_h = sorted(tuple(r) for r in S.read_results(spark, str(tmp_path / "out"), "range_hits").select("qid", "id").collect())
    assert got_h == sorted(tuple(r) for r in hits.select("qid", "id").collect())


def test_stream_with_exact_search_caches_nothing(spark, split, tmp_path):
    """Exact search with a radius per micro-batch, without persisting a pair set per batch."""
    base, queries = split
    src = str(tmp_path / "q")
    queries.repartition(3, "qid").write.parquet(src)
    index = api.build("brute", base)
    q = S.start_search(index, S.query_stream(spark, src, max_files_per_trigger=1), 3, str(tmp_path / "o"),
                       radius=1.2, checkpoint=str(tmp_path / "c"))
    q.awaitTermination(300)
    assert S.read_results(spark, str(tmp_path / "o")).count() == 3 * queries.count()
