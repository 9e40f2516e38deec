"""Vector codes: brute force with Python integers, bounds, awkward rows."""

import hashlib
import math

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from knnspark.llm import codes, registry

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, parts=16, entries=64, rounds=2):
    kept = [(i, [math.floor(256 * x) for x in np.array(v, np.float32).astype(float)], lab) for i, v, lab in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0))
    dim = len(kept[0][1]) // parts
    book = [[r[1][p * dim:(p + 1) * dim] for r in kept[:entries]] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book[p]))

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for _, v, _ in kept:
                x = v[p * dim:(p + 1) * dim]
                groups.setdefault(nearest(p, x)[1], []).append(x)
            for k, xs in groups.items():
                book[p][k] = [sum(c) // len(xs) for c in zip(*xs)]
    out, per_label = [], {}
    for i, v, lab in kept:
        got = [nearest(p, v[p * dim:(p + 1) * dim]) for p in range(parts)]
        error = sum(d for d, _ in got)
        per_label[lab] = per_label.get(lab, 0) + error
        out.append((i, "".join(f"{k:02x}" for _, k in got), error, lab))
    digest = hashlib.sha256(",".join(str(c) for p in book for e in p for c in e).encode()).hexdigest()
    return sorted((i, c, e, per_label[lab], digest) for i, c, e, lab in out)


def ran(spark, rows, **params):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3).selectExpr("*", "1 as ints", "'x' as code", "2 as near", "3 as error")
    found, books = codes.compress(df, **params)
    if books is None:
        assert found.count() == 0
        return []
    return sorted((r["vec_id"], r["code"], r["error"], r["label_error"], books.sha256) for r in codes.with_label_error(found).collect())


def rows_of(n, dim=32, seed=0, copies=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim)) * rng.choice([0.1, 1.0], size=(n, 1))
    rows = [(i, [float(c) for c in x[i]], [None, 1, 2][i % 3]) for i in range(n)]
    return rows + [(n + k, rows[3][1], 1) for k in range(copies)]


@pytest.mark.parametrize("params", [{}, {"rounds": 4}, {"b": 1, "least": 1}, {"b": 64}, {"entries": 5, "rounds": 3}])
def test_matches_brute_force(spark, params):
    rows = rows_of(400, copies=60)
    own = {k: v for k, v in params.items() if k in ("entries", "rounds")}
    assert ran(spark, rows, **params) == brute(rows, **own)


def test_awkward_rows(spark):
    rows = rows_of(90, seed=1, copies=3) + [(500, None, 1), (501, [math.nan] * 32, None), (502, [math.inf] + [0.0] * 31, 2),
                                            (503, [None] + [0.0] * 31, 2), (504, [0.0] * 32, 2), (505, [0.0] * 32, 2), (506, [-0.001] * 32, None)]
    assert ran(spark, rows) == brute(rows)
    few = rows_of(5, seed=2)
    assert ran(spark, few) == brute(few)
    repeated = [few[0]] * 4 + few
    assert ran(spark, repeated) == brute(repeated)
    assert ran(spark, []) == []
    assert ran(spark, [(1, None, 1)]) == []


def test_bad_lengths_and_sizes_raise(spark):
    for rows in ([(1, [0.5] * 32, 1), (2, [0.5] * 16, 1)], [(1, [0.5] * 30, 1)], [(1, [], 1)], [(1, [3e30] * 32, 1)]):
        with pytest.raises(ValueError):
            codes.compress(spark.createDataFrame(rows, SCHEMA))


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10_000), st.integers(1, 9), st.integers(0, 40))
def test_bounds_never_change_an_assignment(seed, b, step):
    rng = np.random.default_rng(seed)
    x, entries = rng.integers(-20, 20, (60, 3)), rng.integers(-20, 20, (9, 3))
    was = codes.Bounds.of(codes.squared(x, entries), b)
    for _ in range(3):
        now = entries + rng.integers(-step, step + 1, entries.shape)
        move = codes.moved(entries[None], now[None])[0]
        near, low, outer = codes._State.store([was], 200.0, 9)
        scale = 200.0 / codes._FULL
        was = codes.Bounds(near[:, 0], low[:, 0] * scale, outer[:, 0] * scale if b < 9 else np.full(60, np.inf))
        best, d2, was, _ = codes.reassign(x, now, was.shifted(move))
        full = codes.squared(x, now)
        assert (best == full.argmin(axis=1)).all() and (d2 == full.min(axis=1)).all()
        exact = np.sqrt(full)
        assert (np.take_along_axis(exact, was.near.astype(int), 1) >= was.low - 1e-9).all()
        out = np.ones(full.shape, bool)
        np.put_along_axis(out, was.near.astype(int), False, 1)
        assert (np.where(out, exact, np.inf).min(axis=1) >= was.outer - 1e-9).all()
        entries = now


def test_later_rounds_compare_fewer_entries_and_lists_adapt(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(64, 32)) * 4
    x = centres[np.arange(2000) % 64] + rng.normal(size=(2000, 32)) * 0.05
    df = spark.createDataFrame([(i, [float(c) for c in v], 0) for i, v in enumerate(x)], SCHEMA)
    kept = codes.integers(df)
    books = codes.first_entries(kept, 16, 64)
    state = codes.written(codes.assign_all(kept, books, 8), "t")
    after = codes.updated(state, books)
    again = codes.written(codes.assign_again(state, books, after, 2, 8), "t")
    assert again.agg({"in_doubt": "avg"}).first()[0] < 0.2 * 16 * 64
    assert again.selectExpr("max(length(near)) as n").first()["n"] < 16 * 8


def test_query_on_the_table(spark):
    got = registry.op11_vector_codes(spark, "/root/testdata/sf0.001").collect()
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert sorted((r["vec_id"], r["code"], r["error"], r["label_error"], r["codebooks_sha256"]) for r in got) == brute(rows)
