"""Periodic runs: brute force over all periods, tiles, stitching, awkward rows."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from knnspark.llm import periodic, registry
from tests.llm.helpers import AWKWARD, EXTRA, docs_df

SPLIT = re.compile("[^\x20\x09-\x0d]+")


def brute(words):
    """All runs by comparing words q apart for every q."""
    found = {}
    for q in range(1, len(words) // 3 + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if length >= max(24, 3 * q):
                found.setdefault((i, length), q)
            i = j
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    drop = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in drop)


def row(doc_id, words):
    runs = brute(words)
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else None
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(collapsed(words, runs)))


def local(words):
    """The operator's steps without Spark."""
    numbers = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int32)
    fragments = set()
    for octave, c in periodic.boundaries(ids):
        lo = max(0, c - periodic.step_of(octave))
        fragments |= set(periodic.solve_tile(octave, c, lo, ids[lo:c + periodic.step_of(octave) + (2 << octave)]))
    runs, by_period = [], {}
    for q, s, e in sorted(fragments):
        spans = by_period.setdefault(q, [])
        if spans and s <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], e)
        else:
            spans.append([s, e])
    for q, spans in by_period.items():
        runs += [(s, e - s + q, q) for s, e in spans if e - s + q >= max(24, 3 * q)]
    return sorted(runs, key=lambda r: (r[0], r[2]))


PART = st.tuples(st.lists(st.sampled_from("ab"), min_size=1, max_size=40), st.integers(1, 30), st.integers(0, 3))


@settings(max_examples=400, deadline=None)
@given(st.lists(PART, max_size=4), st.integers(0, 20))
def test_tiles_find_every_run(parts, noise):
    rng = random.Random(noise)
    words = [rng.choice("abcdefgh") for _ in range(noise)]
    for unit, times, tail in parts:
        words += unit * times + unit[:tail] + [rng.choice("xyz")] * (times % 2)
    assert local(words) == brute(words)


@pytest.mark.parametrize("seed", range(30))
def test_long_periods_match_brute_force(seed):
    rng = random.Random(seed)
    words = [str(rng.randrange(1 if seed % 7 == 0 else 2 + seed * 50)) for _ in range(rng.randrange(10, 900))]
    unit = [str(rng.randrange(3 + seed)) for _ in range(rng.randrange(1, 400))]
    at = rng.randrange(len(words) + 1)
    words[at:at] = (unit * 6)[:int(len(unit) * rng.uniform(2.5, 6))]
    assert local(words) == brute(words)


def tabled(spark, rows, extra=()):
    got = periodic.digest(periodic.detect(docs_df(spark, rows, extra))).collect()
    return sorted(map(tuple, got), key=repr)


def test_awkward_rows_match_brute_force(spark):
    rng = random.Random(3)
    rows = [r for r in AWKWARD if r[0] != 8] + [(8, "long " * 2_000 + "end"), (9, "a\x0bb\x0cc " * 50), (10, "x y z  " * 40)]
    rows += [(11, None), (None, "p q r " * 30), (12, " ".join(rng.choice("ab") for _ in range(400)))]
    rows += [(13, "one two three four " * 9)] * 3
    assert tabled(spark, rows, EXTRA + ["words", "key", "period"]) == sorted((row(i, SPLIT.findall(t or "")) for i, t in rows), key=repr)
    assert tabled(spark, []) == []


def test_very_long_run_is_stitched_over_many_tiles(spark):
    unit = [f"w{k}" for k in range(701)]
    words = ["start"] + unit * 40 + unit[:100] + ["end"]
    (got,) = periodic.detect(docs_df(spark, [(1, " ".join(words))])).collect()
    assert [tuple(r) for r in got["runs"]] == [(1, 701 * 40 + 100, 701)]
    assert got["collapsed"] == " ".join(["start", *unit, "end"])


def test_z_function():
    rng = random.Random(1)
    for _ in range(200):
        s = [rng.randrange(2) for _ in range(rng.randrange(40))]
        want = [next((k for k in range(len(s) - i) if s[k] != s[i + k]), len(s) - i) for i in range(len(s))]
        assert periodic.z_function(s) == want


def edited(doc_id, text):
    words = SPLIT.findall(text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def test_query_matches_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    want = sorted((row(r["doc_id"], edited(*r)) for r in docs if len(r["text"] or "") < 20_000), key=repr)
    short = {r["doc_id"] for r in docs if len(r["text"] or "") < 20_000}
    got = registry.op12_periodic_runs(spark, "/root/testdata/sf0.001").collect()
    assert len(got) == len(docs)
    assert sorted((tuple(r) for r in got if r["doc_id"] in short), key=repr) == want
    assert sum(r[1] > 0 for r in want) > 10
