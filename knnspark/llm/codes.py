"""Vector code compression: product codes learned with Drake-Hamerly adaptive bounds.

A vector's components become integers, floor(``scale`` x), and are cut into ``parts`` equal parts; each part
position has a codebook of ``entries`` integer entries.  A round assigns every part to the nearest
entry (squared distance, ties to the lower index) and replaces every entry by the componentwise floored mean
of its parts.  All decisions are made on integers, so codes, errors and codebooks are exact.

The first assignment compares every part with all entries and writes, for each part, its ``b`` closest
entries, ordered, with a lower bound on the distance to each, and one outer bound below the distance to all
others.  When the codebooks have moved, each lower bound shrinks by its entry's move and the outer bound
by the largest move of an entry.  The exact distance to the assigned entry is compared with the bounds: where it is below
all of them, the part stays; where only listed entries are in doubt, those are verified in integers; where the outer
bound is in doubt, all entries are.  Tighter lists follow from the verified distances, and every batch of
rows adapts ``b`` to the number of entries that were in doubt.  Bounds are stored as 16-bit fractions of the
largest possible distance, rounded down, so rounding costs some checks and never a result.

Every round writes one table of state (integers, codes, bounds; a row a vector) into the shared folder, which
the next reads: a lost executor repeats only its own part of a round.  Only the codebooks (``parts`` x ``entries``)
and their sums pass through the driver; their size is fixed by parameters.

Defined results: rows whose vector is null or holds null or non-finite components are dropped; vectors of
different lengths, of a length that is no multiple of ``parts``, or with integers beyond +-2^28 raise; fewer rows than ``entries``
give as many entries as rows; equal ids are ordered by their vectors, null ids come last; repeated rows count each; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from knnspark.llm.common import written

LIMIT = 1 << 28  # squares of differences of two such integers, summed over a part, fit 64 bits
_ROWS = 1024     # rows compared with a codebook at once
_FULL = 65535    # largest stored bound

STATE = "vec_id long, label {label}, ints binary, codes binary, near binary, bounds binary, outer binary, in_doubt int"
CODES = "vec_id long, label {label}, code string, error long"


@dataclass
class Books:
    """Codebooks of all part positions: ``entries[p, e, position in part]``, and the largest distance that
    the stored bounds can express."""

    entries: np.ndarray
    reach: float
    kind: str  # integer type of the stored components

    @property
    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def integers(df: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, label, ints, size, top): kept rows, their integers (little-endian 64-bit), number and largest
    magnitude of them (None where it is beyond the limit)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(2)
            size = np.diff(vectors.offsets.to_numpy())
            values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            whole = vectors.is_valid().to_numpy(zero_copy_only=False)
            size = np.where(whole, size, 0)
            ends = np.cumsum(size)
            bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
            keep = np.flatnonzero(whole & (bad[ends] == bad[ends - size]))
            with np.errstate(over="ignore", invalid="ignore"):
                scaled = np.floor(values * scale)
            top = [float(np.abs(scaled[e - n:e]).max(initial=0)) for n, e in zip(size[keep], ends[keep])]
            ints = np.where(np.abs(scaled) <= LIMIT, scaled, 0).astype("<i8")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(keep)), batch.column(1).take(pa.array(keep)),
                 pa.array([ints[e - n:e].tobytes() for n, e in zip(size[keep], ends[keep])], pa.binary()),
                 pa.array(size[keep], pa.int32()), pa.array(top, pa.float64())],
                names=["vec_id", "label", "ints", "size", "top"])

    label = dict(df.dtypes)["label"]
    read = df.select(F.col("vec_id").cast("bigint"), "label", F.col("embedding").cast("array<double>").alias("embedding"))
    return read.mapInArrow(run, f"vec_id long, label {label}, ints binary, size int, top double")


def _matrix(column: pa.Array, kind: str) -> np.ndarray:
    """Fixed-length binaries as a matrix with a row each."""
    column = column.cast(pa.large_binary())
    flat = b"".join(column.to_pylist())
    return np.frombuffer(flat, kind).reshape(len(column), -1)


def _binaries(matrix: np.ndarray) -> pa.Array:
    rows = np.ascontiguousarray(matrix).reshape(len(matrix), -1)
    return pa.array([r.tobytes() for r in rows], pa.binary())


def first_entries(kept: DataFrame, parts: int, entries: int) -> Books | None:
    """Codebooks from the vectors of the smallest ids; None for an empty table."""
    found = kept.agg(F.min("size").alias("least"), F.max("size").alias("most"), F.max("top").alias("top")).first()
    if found["least"] is None:
        return None
    if found["least"] != found["most"]:
        raise ValueError(f"vectors of {found['least']} to {found['most']} components")
    if found["least"] == 0 or found["least"] % parts:
        raise ValueError(f"{found['least']} components cannot be cut into {parts} equal parts")
    if found["top"] > LIMIT:
        raise ValueError(f"a component is {found['top']} as an integer, beyond {LIMIT}")
    rows = kept.orderBy(F.col("vec_id").asc_nulls_last(), "ints").limit(entries).select("ints").collect()
    start = np.array([np.frombuffer(r["ints"], "<i8") for r in rows])
    dim = start.shape[1] // parts
    kind = "<i2" if found["top"] < 1 << 15 else "<i4"
    # Entries stay between the components' least and largest values, so no distance is above this.
    reach = 2.0 * (found["top"] + 1) * np.sqrt(dim) * 1.001
    return Books(start.reshape(len(rows), parts, dim).transpose(1, 0, 2).copy(), reach, kind)


def _index(entries: int) -> str:
    """Integer type of stored entry numbers."""
    return "<u1" if entries <= 256 else "<u2"


def squared(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of rows ``x`` to all entries of one codebook, in 64-bit integers."""
    out = np.zeros((len(x), len(entries)), np.int64)
    for j in range(x.shape[1]):
        d = x[:, j, None] - entries[None, :, j]
        out += d * d
    return out


def moved(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """How far each entry went, rounded up."""
    d = (after - before).astype(np.int64)
    return np.sqrt((d * d).sum(axis=2)) * (1 + 1e-9)


class Bounds:
    """Lists and bounds of the rows of one part position: ``near`` (ordered entries), ``low`` (a lower bound
    for each), ``outer`` (one for all others)."""

    def __init__(self, near: np.ndarray, low: np.ndarray, outer: np.ndarray):
        self.near, self.low, self.outer = near, low, outer

    @classmethod
    def of(cls, d2: np.ndarray, b: int) -> "Bounds":
        """From the exact distances to all entries; the stable sort gives ties to the lower index."""
        order = np.argsort(d2, axis=1, kind="stable")
        dist = np.sqrt(np.take_along_axis(d2, order[:, :b + 1], 1))
        outer = dist[:, b] if d2.shape[1] > b else np.full(len(d2), np.inf)
        return cls(order[:, :b], dist[:, :b], outer)

    def shifted(self, moves: np.ndarray) -> "Bounds":
        return Bounds(self.near, np.maximum(self.low - moves[self.near], 0),
                      np.maximum(self.outer - moves.max(initial=0), 0))

    def cut(self, b: int) -> "Bounds":
        """Only the first ``b`` entries: the outer bound covers the others then."""
        if b >= self.near.shape[1]:
            return self
        return Bounds(self.near[:, :b], self.low[:, :b], np.minimum(self.outer, self.low[:, b:].min(axis=1)))


def reassign(x: np.ndarray, entries: np.ndarray, was: Bounds) -> tuple[np.ndarray, np.ndarray, Bounds, np.ndarray]:
    """Nearest entry and squared distance of each row under moved entries, with ``was`` already shifted;
    the bounds that follow, and how many entries were in doubt."""
    n, b = was.near.shape
    rows = np.arange(n)
    diff = x - entries[was.near[:, 0]]
    d2 = (diff * diff).sum(axis=1)
    # A listed entry whose bound is not above this distance may be as near, or nearer.
    edge = np.sqrt(d2) * (1 + 1e-9)
    doubt = was.low <= edge[:, None]
    doubt[:, 0] = False
    every = was.outer <= edge
    in_doubt = 1 + np.where(every, len(entries) - 1, doubt.sum(axis=1))
    low = was.low.copy()
    low[:, 0] = np.sqrt(d2)
    best, best_d2 = was.near[:, 0].astype(np.int64), d2.copy()
    for j in range(1, b):
        at = np.flatnonzero(doubt[:, j] & ~every)
        if not len(at):
            continue
        entry = was.near[at, j].astype(np.int64)
        diff = x[at] - entries[entry]
        d = (diff * diff).sum(axis=1)
        low[at, j] = np.sqrt(d)
        closer = (d < best_d2[at]) | ((d == best_d2[at]) & (entry < best[at]))
        best[at[closer]], best_d2[at[closer]] = entry[closer], d[closer]
    near, outer = was.near.astype(np.int64), was.outer.copy()
    whole = np.flatnonzero(every)
    if len(whole):
        all_d2 = squared(x[whole], entries)
        fresh = Bounds.of(all_d2, b)
        near[whole], low[whole], outer[whole] = fresh.near, fresh.low, fresh.outer
        best[whole] = fresh.near[:, 0]
        best_d2[whole] = all_d2[np.arange(len(whole)), best[whole]]
    # The assigned entry first, the others by their bound.
    rank = np.where(near == best[:, None], -1.0, low)
    order = np.argsort(rank, axis=1, kind="stable")
    return best, best_d2, Bounds(np.take_along_axis(near, order, 1), np.take_along_axis(low, order, 1), outer), in_doubt


class _State:
    """Bounds of all part positions of some rows, as stored and back."""

    @staticmethod
    def store(each: list[Bounds], reach: float, entries: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        def down(v: np.ndarray) -> np.ndarray:
            return np.floor(np.minimum(v, reach) * ((1 - 1e-9) * _FULL / reach)).astype("<u2")
        return (np.stack([e.near for e in each], 1).astype(_index(entries)), down(np.stack([e.low for e in each], 1)),
                down(np.stack([e.outer for e in each], 1)))

    @staticmethod
    def load(batch: pa.RecordBatch, parts: int, reach: float, entries: int) -> list[Bounds]:
        near = _matrix(batch.column("near"), _index(entries)).reshape(batch.num_rows, parts, -1)
        low = _matrix(batch.column("bounds"), "<u2").reshape(near.shape) * (reach / _FULL)
        outer = _matrix(batch.column("outer"), "<u2") * (reach / _FULL)
        if near.shape[2] >= entries:
            outer = np.full(outer.shape, np.inf)  # no entry is outside the lists
        return [Bounds(near[:, p], low[:, p], outer[:, p]) for p in range(parts)]


def _same_width(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``_ROWS`` rows with lists of one length (each writing batch has its own)."""
    for batch in batches:
        width = np.array([len(v) for v in batch.column("near").to_pylist()])
        cuts = np.flatnonzero(np.diff(width)) + 1
        for start, end in zip([0, *cuts], [*cuts, len(width)]):
            for at in range(start, end, _ROWS):
                yield batch.slice(at, min(_ROWS, end - at))


def _parts(ints: np.ndarray, parts: int) -> np.ndarray:
    return ints.astype(np.int64).reshape(len(ints), parts, -1)


def assign_all(kept: DataFrame, books: Books, b: int) -> DataFrame:
    """The first round's state: every part compared with every entry."""
    bc, label = kept.sparkSession.sparkContext.broadcast(books), dict(kept.dtypes)["label"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = bc.value
        parts, entries, _ = books.entries.shape
        for whole in batches:
            for at in range(0, whole.num_rows, _ROWS):
                batch = whole.slice(at, _ROWS)
                ints = _matrix(batch.column("ints"), "<i8")
                x = _parts(ints, parts)
                each = [Bounds.of(squared(x[:, p], books.entries[p]), min(b, entries)) for p in range(parts)]
                yield _state_batch(batch, ints.astype(books.kind), each, books, np.full(len(x), entries))

    return kept.mapInArrow(run, STATE.format(label=label))


def _state_batch(batch: pa.RecordBatch, ints: np.ndarray, each: list[Bounds], books: Books, in_doubt: np.ndarray) -> pa.RecordBatch:
    near, low, outer = _State.store(each, books.reach, books.entries.shape[1])
    return pa.RecordBatch.from_arrays(
        [batch.column("vec_id"), batch.column("label"), _binaries(ints), _binaries(near[:, :, 0]), _binaries(near),
         _binaries(low), _binaries(outer), pa.array(in_doubt, pa.int32())],
        names=["vec_id", "label", "ints", "codes", "near", "bounds", "outer", "in_doubt"])


def assign_again(state: DataFrame, before: Books, after: Books, least: int, most: int) -> DataFrame:
    """The next round's state from the last one's and the entries' moves.

    ``b`` of the new lists is the number of entries in doubt that nine tenths of a batch's parts do not
    pass, between ``least`` and ``most``."""
    bc, label = state.sparkSession.sparkContext.broadcast((after, moved(before.entries, after.entries))), dict(state.dtypes)["label"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books, moves = bc.value
        parts, entries, _ = books.entries.shape
        for batch in _same_width(batches):
            ints = _matrix(batch.column("ints"), books.kind)
            x, each, doubts = _parts(ints, parts), [], []
            for p, was in enumerate(_State.load(batch, parts, books.reach, entries)):
                _, _, now, in_doubt = reassign(x[:, p], books.entries[p], was.shifted(moves[p]))
                each.append(now)
                doubts.append(in_doubt)
            b = int(np.clip(np.quantile(np.stack(doubts), 0.9, method="higher"), least, most))
            yield _state_batch(batch, ints, [e.cut(b) for e in each], books, np.stack(doubts, 1).sum(axis=1))

    return state.mapInArrow(run, STATE.format(label=label))


def updated(state: DataFrame, books: Books) -> Books:
    """Entries replaced by the floored means of their parts; unused ones stay.  Tasks send one row for each
    used entry, which Spark adds up."""
    parts, entries, dim = books.entries.shape
    kind, index = books.kind, _index(entries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((parts, entries, dim), np.int64), np.zeros((parts, entries), np.int64)
        for batch in batches:
            x = _parts(_matrix(batch.column("ints"), kind), parts)
            codes = _matrix(batch.column("codes"), index)
            for p in range(parts):
                np.add.at(sums[p], codes[:, p], x[:, p])
                counts[p] += np.bincount(codes[:, p], minlength=entries)
        at, entry = np.nonzero(counts)
        if len(at):
            yield pa.RecordBatch.from_arrays(
                [pa.array(at, pa.int32()), pa.array(entry, pa.int32()), pa.array(counts[at, entry]),
                 *(pa.array(sums[at, entry, j]) for j in range(dim))], names=["part", "entry", "n", *(f"s{j}" for j in range(dim))])

    each = ", ".join(f"s{j} long" for j in range(dim))
    sent = state.select("ints", "codes").mapInArrow(run, f"part int, entry int, n long, {each}")
    total = sent.groupBy("part", "entry").agg(F.sum("n").alias("n"), *(F.sum(f"s{j}").alias(f"s{j}") for j in range(dim)))
    new = books.entries.copy()
    for r in total.collect():  # parts x entries rows at most
        new[r["part"], r["entry"]] = [r[f"s{j}"] // r["n"] for j in range(dim)]
    return Books(new, books.reach, books.kind)


def encoded(state: DataFrame, before: Books, after: Books) -> DataFrame:
    """(vec_id, label, code, error): the last assignment, not written as state."""
    bc, label = state.sparkSession.sparkContext.broadcast((after, moved(before.entries, after.entries))), dict(state.dtypes)["label"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books, moves = bc.value
        parts, entries, _ = books.entries.shape
        digits = np.array([f"{e:0{max(2, len(f'{entries - 1:x}'))}x}" for e in range(entries)])
        for batch in _same_width(batches):
            x = _parts(_matrix(batch.column("ints"), books.kind), parts)
            code, error = [], np.zeros(len(x), np.int64)
            for p, was in enumerate(_State.load(batch, parts, books.reach, entries)):
                best, d2, _, _ = reassign(x[:, p], books.entries[p], was.shifted(moves[p]))
                code.append(digits[best])
                error += d2
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(["".join(c) for c in zip(*code)], pa.string()), pa.array(error)],
                names=["vec_id", "label", "code", "error"])

    return state.mapInArrow(run, CODES.format(label=label))


def compress(df: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256, b: int = 8,
             least: int = 2, most: int = 8) -> tuple[DataFrame, Books | None]:
    """(vec_id, label, code, error) of every kept row of (vec_id, embedding, label), written, and the final codebooks.

    ``b`` is the first round's number of listed entries, an eighth of ``entries`` by default."""
    if rounds < 1 or entries < 1 or entries > _FULL:
        raise ValueError("rounds and entries must be at least 1, entries below 65536")
    kept = integers(df, scale)
    books = first_entries(kept, parts, entries)
    if books is None:
        return df.sparkSession.createDataFrame([], CODES.format(label=dict(df.dtypes)["label"])), None
    state = written(assign_all(kept, books, b), "codes-state")
    for k in range(rounds):
        before, books = books, updated(state, books)
        if k < rounds - 1:
            state = written(assign_again(state, before, books, least, most), "codes-state")
    return written(encoded(state, before, books), "codes"), books


def with_label_error(codes: DataFrame) -> DataFrame:
    """``codes`` with ``label_error``: the error summed over the rows of an equal label (nulls together).

    The labels' sums are written first, so that Spark knows their size and broadcasts them only if small."""
    sums = written(codes.groupBy(F.col("label").alias("__label")).agg(F.sum("error").alias("label_error")), "label-error")
    return codes.join(sums, codes["label"].eqNullSafe(sums["__label"])).drop("__label")
