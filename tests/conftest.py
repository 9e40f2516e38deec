import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from knnspark.session import get_spark

    s = get_spark(master="local[*]", shuffle_partitions=8)
    yield s


@pytest.fixture(scope="session")
def split(spark):
    """Every tenth vector as queries, the others as base: no query's own row is in the base."""
    from knnspark.sources.vectors import as_queries, whole_table

    rows = whole_table(spark, SF_SMALL)
    return rows.where("id % 10 <> 0"), as_queries(rows.where("id % 10 = 0"))


@pytest.fixture(scope="session")
def np_split():
    """The same split as NumPy arrays, for brute-force checks."""
    import numpy as np
    import pyarrow.parquet as pq

    t = pq.read_table(f"{SF_SMALL}/embeddings.parquet").to_pydict()
    ids = np.array(t["vec_id"], dtype=np.int64)
    X = np.array(t["embedding"], dtype=np.float32).astype(np.float64)
    q = ids % 10 == 0
    return ids[~q], X[~q], ids[q], X[q]
