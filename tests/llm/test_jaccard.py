import random

import numpy as np

from knnspark.llm import jaccard
from knnspark.llm.components import components
from tests.llm.helpers import AWKWARD, DOCS, EXTRA, docs_df, jaccard_classes, shingle_set

RNG = random.Random(4)
VOCABULARY = ["".join(RNG.choices("abcdefghij", k=6)) for _ in range(900)]


def _family(n, base_words, edits):
    base = RNG.choices(VOCABULARY, k=base_words)
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(RNG.randint(0, edits)):
            w[RNG.randrange(len(w))] = RNG.choice(VOCABULARY)
        out.append(" ".join(w))
    return out


def _rows():
    texts = [t for f in range(6) for t in _family(9, 150, 4)] + [" ".join(RNG.choices(VOCABULARY, k=80)) for _ in range(60)]
    line = " ".join(RNG.choices(VOCABULARY, k=30))
    texts += [line + " " + " ".join(RNG.choices(VOCABULARY, k=60)) for _ in range(80)]  # one passage that many share
    texts += [texts[0]] * 40  # copies
    return [(100 + k, t) for k, t in enumerate(texts)] + AWKWARD


def _check(df, rows):
    got = sorted((r.doc_id is None, r.doc_id, r.class_id, r.n_links) for r in df.collect())
    want = sorted((d is None, d, c, n) for (d, _), (c, n) in zip(rows, jaccard_classes(rows)))
    assert got == want


def test_classes_and_links_equal_brute_force(spark):
    rows = _rows()
    _check(jaccard.join(docs_df(spark, rows, EXTRA)), rows)


def test_large_buckets_are_split_led_and_blocked(spark, monkeypatch):
    """With tiny limits, every path of the search is taken: splitting, leaders, blocks, block pairs."""
    monkeypatch.setattr(jaccard, "LIMIT", 4)
    monkeypatch.setattr(jaccard, "BLOCK", 7)
    rows = [(k, t) for k, t in enumerate(_family(60, 200, 6) + _family(30, 60, 3))]
    _check(jaccard.join(docs_df(spark, rows)), rows)


def test_keep_one_keeps_the_smallest_id_of_each_class(spark):
    rows = _rows()
    kept = jaccard.keep_one(docs_df(spark, rows, ["lang"]))
    assert kept.columns == ["doc_id", "text", "lang"]
    found = [r.doc_id for r in kept.collect()]
    classes = jaccard_classes(rows)
    assert sorted(x for x in found if x is not None) == sorted({c for c, _ in classes if c is not None})
    assert found.count(None) == 1  # the row without an id has no near copy


def test_empty_table(spark):
    empty = spark.createDataFrame([], DOCS)
    assert jaccard.join(empty).collect() == []
    assert jaccard.keep_one(empty).collect() == []


def test_sketches_estimate_the_similarity():
    shingler = jaccard.Shingler.get()
    a, b = _family(2, 400, 12)
    x, y = shingle_set(a), shingle_set(b)
    assert len(shingler.shingles(a)) == len(x)
    true = len(x & y) / len(x | y)
    sa, sb = (shingler.sketch(shingler.shingles(t)) for t in (a, b))
    assert abs((sa == sb).mean() - true) < 0.15


def test_runs_reach_the_recall():
    n = jaccard.runs_for(0.9999, 0.8)
    assert (1 - 0.8**3) ** n <= 1e-4 < (1 - 0.8**3) ** (n - 2)


def test_components_of_chains_stars_and_loops(spark):
    edges = [(k, k + 1) for k in range(0, 60)] + [(100, k) for k in range(101, 140)] + [(200, 201), (201, 202), (202, 200)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(61)}, **{k: 100 for k in range(100, 140)}, 200: 200, 201: 200, 202: 200}


def test_word_hashes_do_not_depend_on_the_place():
    hasher = jaccard.WordHasher.get()
    assert np.array_equal(hasher.words("one two  three"), hasher.words("x! ONE-two;\nthree")[1:])
    assert len(set(hasher.words(" ".join(VOCABULARY)).tolist())) == len(set(VOCABULARY))
