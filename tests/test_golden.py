"""Golden kNN / radius answers on the 10 x 3 sample (FIXTURES.md §2)."""

import pytest

from knnspark.operators import exact
from knnspark.sources import binary

# Fixed test input: the sample base and query vectors (ids are row positions).
BASE = [(1, 2, 3), (4, 5, 6), (7, 8, 9), (2, 3, 4), (8, 2, 5), (0, 0, 1), (6, 4, 2), (4.5, 5.5, 6.5), (3, 3, 3),
        (9, 9, 9)]
QUERIES = [(1, 2, 3), (4, 5, 6), (0, 0, 1), (2, 2, 2), (7, 8, 9), (5, 5, 5), (6, 4, 2)]

L2_TOP3 = {0: [(0, 0.0), (3, 1.732051), (8, 2.236068)], 1: [(1, 0.0), (7, 0.866025), (3, 3.464102)],
           2: [(5, 0.0), (0, 3.0), (3, 4.690416)], 3: [(0, 1.414214), (8, 1.732051), (3, 2.236068)],
           4: [(2, 0.0), (9, 2.236068), (7, 4.330127)], 5: [(1, 1.414214), (7, 1.658312), (6, 3.316625)],
           6: [(6, 0.0), (8, 3.316625), (4, 4.123106)]}
L1_TOP3 = {0: [(0, 0.0), (3, 3.0), (8, 3.0)], 1: [(1, 0.0), (7, 1.5), (3, 6.0)], 2: [(5, 0.0), (0, 5.0), (3, 8.0)],
           3: [(0, 2.0), (3, 3.0), (8, 3.0)], 4: [(2, 0.0), (9, 3.0), (7, 7.5)], 5: [(1, 2.0), (7, 2.5), (6, 5.0)],
           6: [(6, 0.0), (8, 5.0), (1, 7.0)]}
L2_R2 = {0: [0, 3], 1: [1, 7], 2: [5], 3: [0, 8], 4: [2], 5: [1, 7], 6: [6]}
L1_R2 = {0: [0], 1: [1, 7], 2: [5], 3: [0], 4: [2], 5: [1], 6: [6]}


@pytest.fixture(scope="module")
def sample(spark):
    base = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(BASE)], "id bigint, v array<double>")
    qs = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(QUERIES)],
                               "qid bigint, qv array<double>")
    return base, qs


def _by_query(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r["qid"], r["rank"])):
        out.setdefault(r["qid"], []).append((r["id"], round(r["dist"], 6)))
    return out


@pytest.mark.parametrize("metric,expected", [("l2", L2_TOP3), ("l1", L1_TOP3)])
def test_knn_golden(sample, metric, expected):
    base, qs = sample
    assert _by_query(exact.knn(base, qs, 3, metric).collect()) == expected


@pytest.mark.parametrize("metric,expected", [("l2", L2_R2), ("l1", L1_R2)])
def test_radius_golden_inclusive(sample, metric, expected):
    base, qs = sample
    got = {}
    for r in exact.range_search(base, qs, 2.0, metric).collect():
        got.setdefault(r["qid"], []).append(r["id"])
    assert {k: sorted(v) for k, v in got.items()} == expected


def test_combined_pass_matches_separate(sample):
    base, qs = sample
    nb, hits = exact.knn_and_range(base, qs, 3, 2.0, "l2")
    assert _by_query(nb.collect()) == L2_TOP3
    assert sorted((r["qid"], r["id"]) for r in hits.collect()) == sorted(
        (q, i) for q, ids in L2_R2.items() for i in ids)


def test_text_ingest_of_sample(spark, tmp_path):
    path = tmp_path / "sample_input.dat"
    path.write_text("10 3\n" + "\n".join(" ".join(str(x) for x in v) for v in BASE) + "\n")
    got = binary.read_vectors(spark, str(path), "text", split_bytes=7).orderBy("id").collect()
    assert [r["id"] for r in got] == list(range(10))
    assert [tuple(r["v"]) for r in got] == [tuple(float(x) for x in v) for v in BASE]
