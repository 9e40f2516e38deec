"""Runs of periodic words, found by scale-tiled distribution.

A run is a stretch of words that repeats with period q (words q apart are equal), is as long as it can
be, and has no smaller period; it counts if it has at least ``least`` words and three periods.  Where words q
apart are equal, there is a stretch of matching positions, q shorter than the run.

Periods are handled by octave: octave k has the periods from 2^k below 2^(k+1).  A counted run of the octave
has at least S = max(16, 2^(k+1)) matching positions in a row, so one of them is a multiple of S.
Every document is exploded into overlapping tiles, one around each such boundary, that reach S words to
both sides and one octave further to the right.  A tile is solved on its own: two Z-functions, of the words
from the boundary and of the reversed words before it, give for every period of the octave how far
its matches reach to the right and to the left.  What ends inside the tile is a whole stretch; what
reaches the tile's edge is a fragment that the next boundary's tile continues.  A period is left out if the words
from the boundary repeat with a proper divisor of it, as that divisor's octave finds the same run.
Fragments are shuffled by document and period and stitched where they touch or overlap.

Tiles that cannot hold a stretch are never made: a stretch of S positions leaves 2^k (8 at least) equal
words on one side of the boundary, and hashes of windows of that many words, built by doubling, are compared first.  A
hash can only make a tile too many.  Words are numbered by their first place in the document, so tiles hold
integers and comparisons are exact.

One pass over the texts writes documents and fragments into the shared folder; texts without tiles are
finished there, and only the others are joined with their runs.

Defined results: null and empty texts have no words and no runs; each row is a document of its own,
also with a repeated or null id; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from knnspark.llm.common import written
from knnspark.llm.words import mix

LEAST = 24  # words of a run
TIMES = 3   # periods of a run
_STEP = 16  # smallest distance of boundaries; LEAST less the periods under 8 is above it
_EMPTY = "[^ \\t-\\r]+"
WORDS = re.compile(_EMPTY)

MADE = "key long, doc_id long, n_words long, text string, tiled boolean, octave int, boundary int, first int, words binary"
SOLVED = "key long, doc_id long, n_words long, text string, tiled boolean, period int, start int, stop int"
RUNS = "array<struct<start:long,length:long,period:long>>"
DOCUMENT = f"doc_id long, n_words long, runs {RUNS}, collapsed string"


def z_function(s: list[int]) -> list[int]:
    """For each position, how many words from there equal the first ones."""
    n = len(s)
    z = [0] * n
    if n:
        z[0] = n
    left = right = 0
    for i in range(1, n):
        k = 0
        if i < right:
            k = z[i - left]
            if k < right - i:
                z[i] = k
                continue
            k = right - i
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def step_of(octave: int) -> int:
    return max(_STEP, 2 << octave)


def boundaries(ids: np.ndarray) -> Iterator[tuple[int, int]]:
    """(octave, boundary) of every tile that may hold a stretch: a window of max(8, 2^octave) words beside
    the boundary has the hash of the one a period of the octave further."""
    n = len(ids)
    if n < LEAST:
        return
    width, octave = 1, 0
    hashes = mix(ids.astype(np.uint64) + np.uint64(1))
    while TIMES << octave <= n:
        while width < max(_STEP // 2, 1 << octave):
            hashes = mix(hashes[:len(hashes) - width] * np.uint64(3) + hashes[width:])
            width *= 2
        step = step_of(octave)
        at = np.arange(0, n, step)
        q = np.arange(1 << octave, 2 << octave)
        hit = np.zeros(len(at), bool)
        rows = max(1, (1 << 20) // len(q))
        for lo in range(0, len(at), rows):
            c = at[lo:lo + rows, None]
            for before in (0, width):
                here, there = c - before, c - before + q
                ok = (here >= 0) & (there < len(hashes))
                same = hashes[np.clip(here, 0, len(hashes) - 1)] == hashes[np.clip(there, 0, len(hashes) - 1)]
                hit[lo:lo + rows] |= (ok & same).any(axis=1)
        for c in at[hit]:
            yield octave, int(c)
        octave += 1


def tiles(docs: DataFrame) -> DataFrame:
    """A row for each document, and one for each of its tiles (``octave`` not null) with its words' numbers
    from ``first`` on.  The text of a document's row is its words, joined by one space."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                rows = []
                for key, doc_id, text in zip(*(batch.column(k).to_pylist() for k in range(3))):
                    words = WORDS.findall(text or "")
                    numbers: dict[str, int] = {}
                    ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int32)
                    found = list(boundaries(ids)) if len(numbers) < len(words) else []
                    rows.append((key, doc_id, len(words), " ".join(words), bool(found), None, None, None, None))
                    for octave, c in found:
                        lo, hi = max(0, c - step_of(octave)), c + step_of(octave) + (2 << octave)
                        rows.append((key, None, None, None, None, octave, c, lo, ids[lo:hi].tobytes()))
                    if len(rows) >= 4096:
                        yield _batch(rows, MADE)
                        rows = []
                if rows:
                    yield _batch(rows, MADE)

    keyed = docs.select(F.monotonically_increasing_id().alias("key"), F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return keyed.mapInArrow(run, MADE)


_ARROW = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, _ARROW[k]) for c, (_, k) in zip(zip(*rows), fields)], names=[f for f, _ in fields])


def _primes(q: int) -> list[int]:
    out, p = [], 2
    while p * p <= q:
        if q % p == 0:
            out.append(p)
            while q % p == 0:
                q //= p
        p += 1
    return out + [q] * (q > 1)


def solve_tile(octave: int, boundary: int, first: int, ids: np.ndarray) -> list[tuple[int, int, int]]:
    """(period, start, stop) of the stretches of matching positions around one boundary, cut at S to both
    sides, that are long enough or reach a cut."""
    step, c = step_of(octave), boundary - first
    # Without a word before, or within a step to the right, the stretch ends of itself.
    words = ids.tolist()
    right = z_function(words[c:])
    back = words[:c][::-1]
    longest = 2 << octave
    # Reversed words from each place up to an octave after the boundary, against those before the boundary.
    beyond = words[:c + longest][::-1]
    left = z_function([*back, -1, *beyond])[len(back) + 1:]
    out = []
    for q in range(1 << octave, longest):
        if c + q > len(words):
            break
        r = min(right[q], step) if c + q < len(words) else 0
        at = len(beyond) - (c + q)  # of the word before boundary + q, in the reversed words
        before = min(left[at], step) if c and at >= 0 else 0
        need = max(LEAST - q, (TIMES - 1) * q)
        if r + before < need and r < step and before < step:
            continue
        if any(right[q // p] >= q - q // p for p in _primes(q)):
            continue  # a divisor's octave has it
        out.append((q, boundary - before, boundary + r))
    return out


def solve(made: DataFrame) -> DataFrame:
    """Tiles replaced by their fragments; documents' rows pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                if r["octave"] is None:
                    rows.append((r["key"], r["doc_id"], r["n_words"], r["text"], r["tiled"], None, None, None))
                else:
                    found = solve_tile(r["octave"], r["boundary"], r["first"], np.frombuffer(r["words"], np.int32))
                    rows += [(r["key"], None, None, None, None, *f) for f in found]
            if rows:
                yield _batch(rows, SOLVED)

    return made.mapInArrow(run, SOLVED)


def stitch(fragments: DataFrame) -> DataFrame:
    """(key, start, length, period) of whole runs, from fragments that touch or overlap."""
    by = Window.partitionBy("key", "period").orderBy("start", "stop")
    before = F.max("stop").over(by.rowsBetween(Window.unboundedPreceding, -1))
    islands = (fragments.select("key", "period", "start", "stop").distinct()
               .withColumn("new", F.when(F.col("start") <= before, 0).otherwise(1))
               .withColumn("island", F.sum("new").over(by.rowsBetween(Window.unboundedPreceding, 0))))
    whole = islands.groupBy("key", "period", "island").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    length = F.col("stop") - F.col("start") + F.col("period")
    runs = whole.select("key", F.col("start").cast("long"), length.cast("long").alias("length"), F.col("period").cast("long"))
    return runs.where((F.col("length") >= LEAST) & (F.col("length") >= TIMES * F.col("period")))


def detect(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every row of (doc_id, text): its runs by start, then period,
    and its words, joined by one space, without those that a run holds after its first period."""
    solved = written(solve(tiles(docs)), "periodic")
    runs = stitch(solved.where("period is not null"))
    found = runs.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))
    found = found.select("key", F.transform("runs", lambda r: F.struct(r["start"], r["length"], r["period"])).alias("runs"))
    texts = solved.where("n_words is not null")
    done = texts.where("not tiled").select("doc_id", "n_words", F.array().cast(RUNS).alias("runs"), F.col("text").alias("collapsed"))
    rest = texts.where("tiled").select("key", "doc_id", "n_words", "text").join(found, "key", "left").drop("key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, runs in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                if runs:
                    words = np.array(text.split(" "), object)
                    dropped = np.zeros(len(words) + 1, np.int64)
                    for r in runs:
                        dropped[r["start"] + r["period"]] += 1
                        dropped[r["start"] + r["length"]] -= 1
                    text = " ".join(words[np.cumsum(dropped[:-1]) == 0])
                out.append(text)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(3), pa.array(out, pa.string())],
                                             names=["doc_id", "n_words", "runs", "collapsed"])

    rest = rest.withColumn("runs", F.coalesce("runs", F.array().cast(RUNS)))
    return done.unionByName(rest.select("doc_id", "n_words", "text", "runs").mapInArrow(run, DOCUMENT))


def strongest(runs: Column) -> Column:
    """The run with the greatest length/period, compared exactly; ties to the smallest start, then period."""
    def better(best: Column, r: Column) -> Column:
        more = r["length"] * best["period"] - best["length"] * r["period"]
        return F.when(best.isNull() | (more > 0), r).otherwise(best)  # runs come by start, then period
    return F.aggregate(runs, F.lit(None).cast("struct<start:long,length:long,period:long>"), better)


def digest(found: DataFrame) -> DataFrame:
    """One row a document with its strongest run and digests of its runs and of the collapsed text."""
    lines = F.concat_ws("", F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))))
    best = found.withColumn("best", strongest(F.col("runs")))
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def repeated_tail(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with a periodic tail in about every tenth document: h is the CRC-32 of the
    id in decimal, g = h div 10; where h mod 10 is 0 and there are n > 0 words, each word from a = g mod n on becomes the
    word (its distance from a) mod p after a, with p = 1 + (n - a) div (3 + g mod 8)."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.filter(F.split("text", "[ \\t-\\r]+"), lambda w: w != "")
    edited = docs.select("doc_id", "text", h.alias("h")).select(
        "doc_id", "text", F.expr("h div 10").alias("g"), F.when(F.expr("h % 10 = 0"), words).alias("w"))
    edited = edited.select("*", F.when(F.size("w") > 0, F.expr("g % size(w)")).alias("a"))
    edited = edited.select("*", F.expr("1 + (size(w) - a) div (3 + g % 8)").alias("p"))
    changed = F.expr("array_join(transform(w, (x, i) -> if(i < a, x, get(w, cast(a + (i - a) % p as int)))), ' ')")
    return edited.select("doc_id", F.when(F.col("p").isNotNull(), changed).otherwise(F.col("text")).alias("text"))
