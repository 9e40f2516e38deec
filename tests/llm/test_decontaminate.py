import itertools
import random
import re

import pytest

from knnspark.llm import decontaminate
from tests.llm.helpers import AWKWARD, DOCS, EXTRA, docs_df

RNG = random.Random(9)
W = ["".join(RNG.choices("klmnoprstuvé", k=5)) for _ in range(700)]
ITEMS = [(k, " ".join(RNG.choices(W, k=n))) for k, n in enumerate([15, 18, 25, 40, 59, 200, 6, 8])] + [(50, None), (51, ""), (52, "two words"), (53, "a b c d e")]


def _noise(n):
    return " ".join(RNG.choices(W, k=n))


def _substituted(text, n):
    w = text.split()
    for k in RNG.sample(range(len(w)), n):
        w[k] = "changed"
    return " ".join(w)


def _rows():
    rows, dirty = [], {}
    for k, (item, text) in enumerate(ITEMS[:8]):
        rows.append((100 + k, f"{_noise(50)} {text.upper()}; {_noise(50)}"))
        dirty[100 + k] = item
    for k, (item, text) in enumerate(ITEMS[:5]):
        rows.append((200 + k, f"{_noise(20)} {_substituted(text, 2)} {_noise(9)}"))
        dirty[200 + k] = item
    rows.append((300, _noise(30) + " " + " ".join(ITEMS[5][1].split()[60:90]) + " " + _noise(30)))  # part of a long item
    dirty[300] = 5
    rows += [(400 + k, _noise(120)) for k in range(40)]
    rows.append((500, _noise(20) + " " + " ".join(ITEMS[3][1].split()[:7]) + " " + _noise(20)))  # too little of an item
    rows.append((501, "a b c d f"))  # four of five words: 0.8 of the item
    dirty[501] = 53
    rows.append((502, "a b c x f"))
    return rows, dirty


def test_items_are_found_and_clean_texts_left_alone(spark):
    rows, dirty = _rows()
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = decontaminate.find(docs_df(spark, rows + AWKWARD, EXTRA), bench).collect()
    assert {r.doc_id: r.item_id for r in got} == dirty
    exact = {r.doc_id: r for r in got}
    assert exact[103].score == exact[103].matched == 40 and exact[103].doc_start == 50
    assert exact[203].matched == 38


def test_hits_equal_brute_force_alignment(spark):
    """Every document and item on every diagonal, without seeds."""
    rows, _ = _rows()
    got = {(r.doc_id, r.item_id) for r in decontaminate.find(docs_df(spark, rows), spark.createDataFrame(ITEMS, "item_id long, text string")).collect()}
    words = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    want = set()
    for doc_id, text in rows:
        d = words(text)
        for item, t in ITEMS:
            i = words(t)
            if len(i) < decontaminate.SHORTEST:
                continue
            for diagonal in range(-len(i) + 1, len(d)):
                same = [d[diagonal + k] == i[k] for k in range(max(0, -diagonal), min(len(i), len(d) - diagonal))]
                run = best = 0
                for s in same:
                    run = max(0, run + (1 if s else -3))
                    best = max(best, run)
                if best >= 10 or sum(same) >= 0.75 * len(i):
                    want.add((doc_id, item))
    assert got == want


def test_no_substitution_hides_an_item():
    """Every pattern of a quarter of the words, of every item length that the proof rests on."""
    for n in range(decontaminate.SHORTEST, 25):
        seeds = decontaminate.LONG if n >= decontaminate.LENGTHY else decontaminate.SHORT
        windows = [sum(1 << (p + o) for o in s) for s in seeds for p in range(n - s[-1])]
        for changed in itertools.combinations(range(n), n // 4):
            bits = sum(1 << k for k in changed)
            assert any(not bits & w for w in windows), (n, changed)


@pytest.mark.parametrize("n,every", [(10, 5), (12, 4), (16, 4), (20, 4), (59, 4), (400, 4), (400, 5), (1000, 4)])
def test_items_at_the_edge_are_scored_whole(spark, n, every):
    item = [f"w{k}" for k in range(n)]
    changed = ["x" if k % every == every - 1 else w for k, w in enumerate(item)]
    rows = [(1, " ".join(["a"] * 7 + item + ["b"] * 5)), (2, " ".join(["a"] * 3 + changed + ["b"])), (3, " ".join(changed)),
            (4, " ".join(item[n // 10:])), (5, " ".join(["a"] * 4 + item[:n - n // 10]))]
    bench = spark.createDataFrame([(9, " ".join(item))], "item_id long, text string")
    got = {r.doc_id: (r.matched, r.item_words, r.doc_start) for r in decontaminate.find(docs_df(spark, rows), bench).collect()}
    left = n - n // every
    assert got == {1: (n, n, 7), 2: (left, n, 3), 3: (left, n, 0), 4: (n - n // 10, n, 0), 5: (n - n // 10, n, 4)}


def test_blocks_of_a_large_benchmark_give_the_same(spark):
    rows, _ = _rows()
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    whole = sorted(map(tuple, decontaminate.find(docs_df(spark, rows), bench).collect()))
    assert sorted(map(tuple, decontaminate.find(docs_df(spark, rows), bench, max_windows=300).collect())) == whole


def test_clean_keeps_other_rows_and_columns(spark):
    rows, dirty = _rows()
    rows = rows + AWKWARD + [(103, "other text of the same id")]
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    kept = decontaminate.clean(docs_df(spark, rows, ["item_id", "hash"]), bench)
    assert kept.columns == ["doc_id", "text", "item_id", "hash"]
    left = sorted((r.doc_id is None, r.doc_id, r.text) for r in kept.select("doc_id", "text").collect() if r.text is not None)
    want = sorted((d is None, d, t) for d, t in rows if t is not None and (d not in dirty or t.startswith("other")))
    assert left == want


def test_no_python_in_the_plan_and_empty_tables(spark):
    rows, _ = _rows()
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    plan = decontaminate.find(docs_df(spark, rows), bench)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    assert decontaminate.find(spark.createDataFrame([], DOCS), bench).collect() == []
    assert decontaminate.find(docs_df(spark, rows), spark.createDataFrame([], "item_id long, text string")).collect() == []
