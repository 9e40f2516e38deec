"""Small tables for the text operators' tests, and brute-force versions."""

import re

DOCS = "doc_id long, text string"
AWKWARD = [
    (1, None), (2, ""), (3, " \n\t "), (None, "no id but words enough to make a shingle or two here"), (4, "!!! ??? ..."),
    (5, "same words in a row, the same words in a row, the same words"), (5, "same words in a row, the same words in a row, the same words"),
    (6, "x"), (7, "é ü ñ  – “quoted” İstanbul ſ K 数据 \U0001f600 end"), (8, "long " * 30_000 + "end"),
]
#: Names that the operators use inside, as extra columns of the input.
EXTRA = ["key", "kinds", "hash", "pos", "block", "size", "path", "label", "length", "item_id", "spans", "score", "lang", "n_chars"]


def docs_df(spark, rows, extra=()):
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    from pyspark.sql import functions as F
    return df.withColumns({c: F.lit(f"extra {c}") for c in extra}) if extra else df


def words(text):
    return re.findall(r"\w+", (text or "").lower())


def shingle_set(text, n=5):
    w = words(text)
    n = min(n, len(w))
    return frozenset(tuple(w[k:k + n]) for k in range(len(w) - n + 1)) if w else frozenset()


def jaccard_classes(rows, similarity=0.8):
    """[(class_id, n_links)] for each row of (doc_id, text), by comparing all pairs."""
    sets = [shingle_set(t) for _, t in rows]
    parent, links = list(range(len(rows))), [0] * len(rows)

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a in range(len(rows)):
        for b in range(a + 1, len(rows)):
            same = (rows[a][1] or "") == (rows[b][1] or "")
            union = len(sets[a] | sets[b])
            if same or union and len(sets[a] & sets[b]) >= similarity * union:
                links[a] += 1
                links[b] += 1
                parent[max(root(a), root(b))] = min(root(a), root(b))
    ids = {}
    for k, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            ids[root(k)] = min(ids.get(root(k), doc_id), doc_id)
    return [(ids.get(root(k)), links[k]) for k in range(len(rows))]
