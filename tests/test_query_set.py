"""Searches whose query set is every tenth row, against all rows."""

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from knnspark.plans import registry

NAMES = ["knn_l2", "knn_l1", "range_l2", "range_l1", "knn_nested", "ivf_probes", "ivfflat_knn", "ivfflat_range", "lsh_knn",
         "cube_candidates", "cube_knn", "cube_knn_capped", "cube_range", "ivfflat_trained_knn", "ivf_stored_knn",
         "lsh_stored_knn", "cube_stored_knn"]


@pytest.fixture(scope="module")
def table(tmp_path_factory):
    """121 vectors of 64 dimensions; a folder as the queries read it."""
    X = np.random.default_rng(7).normal(size=(121, 64))
    X /= np.linalg.norm(X, axis=1, keepdims=True)
    at = tmp_path_factory.mktemp("rows")
    pq.write_table(pa.table({"vec_id": pa.array(range(121), pa.int64()), "embedding": pa.array(list(X.astype(np.float32)), pa.list_(pa.float32())),
                             "label": pa.array([i % 10 for i in range(121)], pa.int32())}), at / "embeddings.parquet")
    return str(at)


@pytest.mark.parametrize("name", NAMES)
def test_every_tenth_row_is_a_query_against_all_rows(spark, table, name):
    found = registry.QUERIES[name](spark, table)
    assert {r["qid"] for r in found.select("qid").distinct().collect()} == set(range(0, 121, 10))
    if "id" in found.columns:  # a query's own row is in the base too
        assert found.where("qid = id").count() == 13
