"""Document fingerprints from closed syncmers.

A k-mer of code points is a closed syncmer when the smallest hash among its inner s-mers lies at its
first or last place.  Whether it is chosen depends on its own characters alone, so the same passage
gives the same anchors wherever it stands, and an edit only changes the anchors that overlap it.  On
average 2 of (k - s + 1) k-mers are chosen, and at least one in every window of that many.

A fingerprint keeps every anchor, also each place of a repeated one, as base64 of little-endian uint32 pairs
(hash, position) by position, so it grows with the text.  Two fingerprints are compared by the longest
chain of anchors that both have, with positions that rise in both texts.  The likeness is its length over the number of
anchors that either has (a hash that occurs m and n times counts max(m, n)).

Defined results: null and empty texts have the fingerprint "" (two of them are alike 1, one and a
non-empty text 0); a text shorter than k has one anchor, the hash of all of it; equal texts have equal
fingerprints; every code point of a text is read.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from knnspark.llm.common import pieces, written

K, S = 24, 8
_B = np.uint64(0x9E3779B97F4A7C15)  # odd multiplier of the rolling hashes (2^64 over the golden ratio)


def _power(n: int) -> np.uint64:
    return np.uint64(pow(int(_B), n, 1 << 64))


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(29))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _runs(h: np.ndarray, have: int, n: int) -> np.ndarray:
    """Polynomial hashes of ``n`` code points from those of ``have`` (n is have times a power of two)."""
    while have < n:
        h = h[:len(h) - have] * _power(have) + h[have:]
        have *= 2
    return h


def _least(h: np.ndarray, n: int) -> np.ndarray:
    """Smallest of every ``n`` neighbours."""
    have = 1
    while have < n:
        step = min(have, n - have)
        h = np.minimum(h[:len(h) - step], h[step:])
        have += step
    return h


def syncmers(codes: np.ndarray, k: int = K, s: int = S) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (uint32) and positions of the closed syncmers of an array of code points.  ``k`` must be
    three times ``s``, and ``s`` a power of two."""
    if len(codes) < k:
        if not len(codes):
            return np.zeros(0, np.uint32), np.zeros(0, np.uint32)
        whole = hashlib.blake2b(codes.astype("<u4").tobytes(), digest_size=4).digest()
        return np.frombuffer(whole, "<u4"), np.zeros(1, np.uint32)
    small = _runs(codes.astype(np.uint64) + np.uint64(1), 1, s)
    order = (_mix(small) >> np.uint64(32)).astype(np.uint32)
    last = k - s
    least = _least(order, last + 1)
    n = len(least)
    at = np.flatnonzero((order[:n] == least) | (order[last:last + n] == least))
    whole = (small[at] * _power(s) + small[at + s]) * _power(s) + small[at + 2 * s]
    return (_mix(whole) >> np.uint64(32)).astype(np.uint32), at.astype(np.uint32)


def anchors(text: str) -> np.ndarray:
    """Rows (hash, position) of all anchors, by position."""
    hashes, at = syncmers(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4"))
    return np.stack([hashes, at], axis=1).astype("<u4")


def to_text(found: np.ndarray) -> str:
    return base64.b64encode(found.tobytes()).decode()


def from_text(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), "<u4").reshape(-1, 2)


def _rising(values: list[int]) -> int:
    """Length of the longest rising chain."""
    chain: list[int] = []
    for v in values:
        k = bisect_left(chain, v)
        chain[k:k + 1] = [v]
    return len(chain)


def _common(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, with a bit for each element of ``b`` (a number of machine words at a time,
    so that texts of one repeated passage don't need their pairs of places)."""
    start = next((k for k, (v, w) in enumerate(zip(a, b)) if v != w), min(len(a), len(b)))
    a, b = a[start:], b[start:]
    places: dict[int, list[int]] = {}
    for k, v in enumerate(b):
        places.setdefault(v, []).append(k)
    often = {v: sum(1 << k for k in at) for v, at in places.items() if len(at) > 64}  # the masks of rarer ones are made anew
    full = row = (1 << len(b)) - 1
    for v in a:
        mask = often.get(v)
        if mask is None:
            mask = 0
            for k in places.get(v, ()):
                mask |= 1 << k
        hit = row & mask
        row = (row + hit | row - hit) & full
    return start + len(b) - row.bit_count()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of the anchors of both that match in rising order of position (0 to 1)."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    kinds, which, n = np.unique(np.concatenate([a[:, 0], b[:, 0]]), return_inverse=True, return_counts=True)
    in_a = np.bincount(which[:len(a)], minlength=len(kinds))
    in_b = n - in_a
    shared = np.minimum(in_a, in_b)
    if not shared.any():
        return 0.0
    left, right = (w[shared[w] > 0] for w in (which[:len(a)], which[len(a):]))
    if len(left) == len(right) == np.count_nonzero(shared):  # no hash is repeated: the places in b, in a's order
        place = np.empty(len(kinds), np.int64)
        place[right] = np.arange(len(right))
        chain = _rising(place[left].tolist())
    else:
        chain = _common(left.tolist(), right.tolist())
    return chain / int(np.maximum(in_a, in_b).sum())


def edited(text: str, following: str) -> str:
    """``text`` with its last third (rounded down) replaced by as much of ``following``'s beginning."""
    n = len(text) // 3
    return text[:len(text) - n] + following[:n]


def _blocks(ids: DataFrame, n: int) -> list[int]:
    """Up to n - 1 bounds that cut the non-null ids into about equal ranges (a sketch's quantiles)."""
    found = ids.agg(F.percentile_approx("doc_id", [k / n for k in range(1, n)], 10 * n).alias("q")).first()["q"] if n > 1 else None
    return sorted(set(found or []), reverse=True)


def in_order(docs: DataFrame, blocks: int) -> DataFrame:
    """(block, doc_id, text, copy): documents in ranges of descending id, each range closed with a copy
    of the row that follows it; the last range's is the first row of all.  Sorted inside the ranges.

    Equal ids are ordered by text; null ids come last.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    bounds = _blocks(rows.select("doc_id"), blocks)
    # Block 0 has the largest ids.  Ids equal to a bound open the block of that bound.
    bound_list = F.array(*(F.lit(b).cast("long") for b in bounds)) if bounds else F.array().cast("array<bigint>")
    block = F.size(F.filter(bound_list, lambda b: b > F.col("doc_id")))
    rows = rows.withColumn("block", F.coalesce(F.when(F.col("doc_id").isNotNull(), block), F.lit(len(bounds) + 1)))
    heads = rows.groupBy("block").agg(F.max("doc_id").alias("head"))
    # A row for each block (bounded by ``blocks``): which block's end its first row is copied to.
    first = written(heads, "fingerprint-heads").orderBy("block").collect()
    copy_to = {r["block"]: (first[k - 1]["block"], r["head"]) for k, r in enumerate(first)}
    copies = docs.sparkSession.createDataFrame([(b, to, head) for b, (to, head) in copy_to.items()], "b int, to int, head long")
    joined = rows.join(F.broadcast(copies), (rows["block"] == F.col("b")) & rows["doc_id"].eqNullSafe(F.col("head")), "left")
    own, lent = (F.struct(F.col(c).cast("int").alias("block"), F.lit(k).alias("copy")) for k, c in enumerate(("block", "to")))
    places = F.when(F.col("to").isNull(), F.array(own)).otherwise(F.array(own, lent))
    every = joined.select("doc_id", "text", F.explode(places).alias("at")).select("at.block", "doc_id", "text", "at.copy")
    # Several ranges a task, so that tasks are of about one size; each range stays in one task.
    parts = max(1, -(-len(copy_to) // 4))
    return every.repartition(parts, "block").sortWithinPartitions("block", "copy", F.desc_nulls_last("doc_id"), "text")


def fingerprints(docs: DataFrame, blocks: int | None = None) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)."""
    spark = docs.sparkSession
    blocks = blocks or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the row before, with its anchors: it waits for the row that follows it
        for batch in pieces(batches, 256):
            out = []
            for block, doc_id, text, copy in zip(*(c.to_pylist() for c in batch.columns)):
                found = anchors(text)
                if held is not None and held[0] == block:
                    _, last_id, last, last_found = held
                    changed = edited(last, text)
                    changed_found = anchors(changed)
                    out.append((last_id, len(last), hashlib.sha256(changed.encode()).hexdigest(), to_text(last_found),
                                to_text(changed_found), likeness(last_found, changed_found), likeness(last_found, found)))
                held = None if copy else (block, doc_id, text, found)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return in_order(docs, blocks).mapInArrow(run, schema)
