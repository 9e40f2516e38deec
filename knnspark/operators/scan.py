"""Candidate scans: one vectorised pass over the base for the bucket methods.

The query side of a search is a table in the shared folder (``operators.blocks``).  Every base task
streams it in blocks of bounded size and

1. computes the block's keys (hash buckets, vertex codes, probed cells) and its rows' keys on the Arrow batch,
2. matches them with a sort + ``searchsorted`` equi-join,
3. scores the candidate pairs with NumPy (gathered differences, no pair table in Spark),
4. keeps a local top-N per query (or the radius hits, or the first ``M`` by probe order),

so the only shuffle is at most N rows per (query, task) on ``qid``.  The base is never shuffled
or replicated and no vector crosses a shuffle; a hot bucket or cell is split across all scan tasks.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from knnspark.operators.blocks import QuerySide
from knnspark.session import scan_source

PAIR_SCHEMA = "qid bigint, id bigint, dist double, top boolean, hit boolean"
ORDERED_SCHEMA = "qid bigint, id bigint, prank int, dist double"

# Candidate pairs buffered in a task before they are cut back to the top-N per query.
_PAIR_BUFFER = 1 << 18
# Pairs scored at once (bounds the gathered difference block).
_PAIR_CHUNK = 1 << 13


def match(sorted_keys: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equi-join of ``keys`` (rows) with ``sorted_keys``: returns (row index, position) pairs."""
    lo = np.searchsorted(sorted_keys, keys, "left")
    hi = np.searchsorted(sorted_keys, keys, "right")
    cnt = hi - lo
    total = int(cnt.sum())
    if total == 0:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    rows = np.repeat(np.arange(len(keys)), cnt)
    start = np.repeat(lo - (np.cumsum(cnt) - cnt), cnt)
    return rows, start + np.arange(total)


def match_chunks(sorted_keys: np.ndarray, keys: np.ndarray, limit: int = _PAIR_BUFFER):
    """``match`` in pieces of at most ``limit`` pairs, so a hot key (many queries on one bucket
    or cell) never materialises rows x queries pairs at once; one row with more matches than
    ``limit`` is itself split."""
    lo = np.searchsorted(sorted_keys, keys, "left")
    hi = np.searchsorted(sorted_keys, keys, "right")
    cnt = hi - lo
    cum = np.cumsum(cnt)
    n = len(keys)
    r0 = 0
    while r0 < n:
        before = int(cum[r0 - 1]) if r0 else 0
        r1 = int(np.searchsorted(cum, before + limit, "right"))
        if r1 == r0:                      # a single row above the limit
            for s in range(int(lo[r0]), int(hi[r0]), limit):
                e = min(s + limit, int(hi[r0]))
                yield np.full(e - s, r0), np.arange(s, e)
            r0 += 1
            continue
        c = cnt[r0:r1]
        total = int(c.sum())
        if total:
            rows = np.repeat(np.arange(r0, r1), c)
            start = np.repeat(lo[r0:r1] - (np.cumsum(c) - c), c)
            yield rows, start + np.arange(total)
        r0 = r1


def pair_distances(Q: np.ndarray, X: np.ndarray, qi: np.ndarray, ri: np.ndarray, metric: str) -> np.ndarray:
    """Distances of the pairs ``(Q[qi], X[ri])`` from explicit differences, in bounded chunks."""
    out = np.empty(len(qi))
    for s in range(0, len(qi), _PAIR_CHUNK):
        diff = Q[qi[s:s + _PAIR_CHUNK]] - X[ri[s:s + _PAIR_CHUNK]]
        if metric == "l1":
            out[s:s + _PAIR_CHUNK] = np.abs(diff).sum(axis=1)
        else:
            out[s:s + _PAIR_CHUNK] = np.sqrt(np.einsum("ij,ij->i", diff, diff))
    return out


class GroupTopN:
    """Per group (query index), the ``n`` smallest rows by a composite key; exact on ties.

    After a cut, rows whose first key is above the group's ``n``-th one are dropped as they come."""

    def __init__(self, n: int):
        self.n = n
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.kept = 0             # rows left by the last cut: the next one waits for as many new ones
        self.size = 0
        self.limit = np.empty(0)  # the n-th best first key of each group as of the last cut

    def add(self, group: np.ndarray, *cols: np.ndarray) -> None:
        """``cols`` are sort keys in priority order followed by payload columns."""
        if len(group) and len(self.limit):
            near = ~(cols[0] > self.worst(int(group.max()) + 1)[group])
            group, cols = group[near], tuple(c[near] for c in cols)
        if len(group) == 0:
            return
        self.parts.append((group, *cols))
        self.size += len(group)
        if self.size > max(_PAIR_BUFFER, 2 * self.kept):
            self.parts = [self._reduce()]
            g, key = self.parts[0][:2]
            self.size = self.kept = len(g)
            last = np.flatnonzero(np.r_[g[1:] != g[:-1], True])
            full = np.diff(np.r_[-1, last]) >= self.n
            self.limit = np.full(int(g.max(initial=-1)) + 1, np.inf)
            self.limit[g[last[full]]] = key[last[full]]

    def _reduce(self, nkeys: int = 2) -> tuple[np.ndarray, ...]:
        cols = [np.concatenate(c) for c in zip(*self.parts)]
        group = cols[0]
        keys = cols[1:1 + nkeys]
        order = np.lexsort(tuple(reversed(keys)) + (group,))
        cols = [c[order] for c in cols]
        g = cols[0]
        first = np.r_[True, g[1:] != g[:-1]]
        start = np.maximum.accumulate(np.where(first, np.arange(len(g)), 0))
        keep = (np.arange(len(g)) - start) < self.n
        return tuple(c[keep] for c in cols)

    def worst(self, groups: int) -> np.ndarray:
        """The ``n``-th best first key of each group as of the last cut (infinite where there are fewer)."""
        if groups <= len(self.limit):
            return self.limit[:groups]
        return np.concatenate([self.limit, np.full(groups - len(self.limit), np.inf)])

    def result(self, nkeys: int = 2) -> tuple[np.ndarray, ...] | None:
        if not self.parts:
            return None
        return self._reduce(nkeys)


def pair_batch(qid, ids, dist, top: bool, hit: bool) -> pa.RecordBatch:
    n = len(qid)
    return pa.RecordBatch.from_arrays(
        [pa.array(qid, pa.int64()), pa.array(ids, pa.int64()), pa.array(dist, pa.float64()),
         pa.array(np.full(n, top), pa.bool_()), pa.array(np.full(n, hit), pa.bool_())],
        names=["qid", "id", "dist", "top", "hit"])


def emit_scored(state: GroupTopN | None, qids: np.ndarray, qi: np.ndarray, ids: np.ndarray, dist: np.ndarray,
                radius: float | None):
    """Feed scored pairs to the top-N state and yield radius hits right away."""
    if state is not None:
        state.add(qi, dist, ids)
    if radius is not None:
        m = dist <= radius
        if m.any():
            yield pair_batch(qids[qi[m]], ids[m], dist[m], False, True)


def finish_topn(state: GroupTopN | None, qids: np.ndarray):
    if state is None:
        return
    res = state.result()
    if res is not None:
        qi, dist, ids = res
        yield pair_batch(qids[qi], ids, dist, True, False)


def run_blocks(base: DataFrame, cols: list[str], side: QuerySide, payload: Callable, kernel: Callable, schema: str,
               keep_per_query: int = 0) -> DataFrame:
    """One ``mapInArrow`` scan of ``base[cols]`` past all blocks of the query side.

    ``payload(block)`` is what ``kernel`` needs of a block, made in the task.  ``keep_per_query`` (N, or M for a
    capped scan) sizes the scan's task count for the top-N shuffle."""
    def run(batches):
        yield from side.scan(batches, lambda block: kernel(payload(block)))

    return scan_source(base.select(*cols), side.rows * keep_per_query or None).mapInArrow(run, schema)
