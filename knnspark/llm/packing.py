"""First-fit-decreasing packing of token sequences with a tournament tree of bin capacities.

Every document is encoded whole, closed with an end id, and cut into pieces of at most ``capacity``
tokens.  Each document has at most one piece shorter than a sequence; it goes to a random group of
documents of bounded size, as do full pieces on their own.  Within a group, the longest first, each piece is
put into the first sequence that still has room.  A tournament tree over the sequences' free room
(each node holds the larger of its two children) finds that sequence in O(log n).  Groups are packed
independently, so they run in parallel, and only ids, lengths and checksums are shuffled (token ids
too, if they are asked for).

Defined results: a null text is empty (only the end id is packed); an empty table gives no rows;
repeated rows, repeated or null ids are packed row by row; ties in length go by document id, then
start; other columns are ignored.  The random group of a piece is a hash of the piece and of how many equal ones
its task had before, so a task that runs again gives the same rows and groups, in whatever order it reads them.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from knnspark.llm.common import text_pieces
from knnspark.llm.encoder import BatchEncoder
from knnspark.llm.words import mix

SEQUENCE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class Tournament:
    """Free room of up to ``n`` bins; ``place(size)`` gives the first bin with room and its fill."""

    def __init__(self, n: int, capacity: int):
        self.capacity = capacity
        self.leaves = 1 << max(0, (max(n, 1) - 1).bit_length())
        self.room = [capacity] * (2 * self.leaves)

    def place(self, size: int) -> tuple[int, int]:
        room, at = self.room, 1
        if size > room[1]:
            raise ValueError("no bin has room")
        while at < self.leaves:
            at *= 2
            if room[at] < size:
                at += 1
        left = room[at]
        room[at] = left - size
        bin_ = at - self.leaves
        while at > 1:
            at //= 2
            a, b = room[2 * at], room[2 * at + 1]
            best = a if a > b else b
            if room[at] == best:
                break
            room[at] = best
        return bin_, self.capacity - left


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length; ``lengths`` must already be in packing order (descending)."""
    tree = Tournament(len(lengths), capacity)
    placed = [tree.place(int(n)) for n in lengths]
    out = np.array(placed, dtype=np.int64).reshape(-1, 2)
    return out[:, 0], out[:, 1]


def cut(docs: DataFrame, tokenizer: str, ranks: str | None, capacity: int, end_id: int, groups: int, seed: int,
        keep_ids: bool) -> DataFrame:
    """Pieces of every document: (group, doc_id, start, length, ids_crc32, doc_tokens[, ids])."""
    schema = "grp long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids binary" * keep_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = BatchEncoder.at(tokenizer, ranks)
        start_seed = mix(np.array([seed * 1_000_003 + TaskContext.get().partitionId()], np.uint64))
        seen: Counter = Counter()  # pieces of the task by their hash
        for batch in text_pieces(batches, 1):
            ids, ends = encoder.encode(batch.column(1).fill_null(""))
            ids = np.insert(ids, ends, end_id).astype("<u4")
            ends = ends + np.arange(1, len(ends) + 1)
            starts = np.concatenate([[0], ends[:-1]])
            total = ends - starts
            n_pieces = -(-total // capacity)
            doc = np.repeat(np.arange(len(total)), n_pieces)
            nth = np.arange(len(doc)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)
            start = nth * capacity
            length = np.minimum(total[doc] - start, capacity)
            data = memoryview(ids.tobytes())
            at = ((starts[doc] + start) * 4).tolist()
            cuts = [data[a:a + 4 * n] for a, n in zip(at, length.tolist())]
            crc = np.array([zlib.crc32(c) for c in cuts], np.int64)
            doc_id = batch.column(0).cast(pa.int64()).take(pa.array(doc))
            piece = mix(doc_id.fill_null(-1).to_numpy().view(np.uint64) + start_seed)
            piece = mix(piece + (crc.astype(np.uint64) << np.uint64(32)) + start.astype(np.uint64))
            before = []
            for h in piece.tolist():
                before.append(seen[h])
                seen[h] += 1
            grp = mix(piece + np.array(before, np.uint64)) % np.uint64(groups)
            cols = [pa.array(grp.astype(np.int64)), doc_id, pa.array(start), pa.array(length), pa.array(crc), pa.array(total[doc])]
            names = ["grp", "doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            if keep_ids:
                cols.append(pa.array([bytes(c) for c in cuts], pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def pack(docs: DataFrame, tokenizer: str, ranks: str | None = None, capacity: int = 2048, end_id: int = 1,
         group_docs: int = 8192, seed: int = 7, keep_ids: bool = False) -> DataFrame:
    """Place of every piece of every document: (doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset[, ids]).  ``group_docs`` is the mean number of documents in a random group."""
    groups = max(1, -(-docs.count() // group_docs))
    cuts = cut(docs, tokenizer, ranks, capacity, end_id, groups, seed, keep_ids)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "doc_id", "start", "ids_crc32"], ascending=[False, True, True, True])
        length = pdf["length"].to_numpy()
        full = int((length == capacity).sum())  # they fill a sequence each
        bins, offset = first_fit_decreasing(length[full:], capacity)
        local = np.concatenate([np.arange(full), full + bins])
        out = pdf.drop(columns="grp")
        out["sequence_id"] = (pdf["grp"].to_numpy() << 32) + local
        out["offset"] = np.concatenate([np.zeros(full, np.int64), offset])
        return out

    schema = SEQUENCE + ", ids binary" if keep_ids else SEQUENCE
    names = [c.split()[0] for c in schema.split(", ")]
    keep = [n for n in names if n not in ("sequence_id", "offset")]
    return cuts.select("grp", *keep).groupBy("grp").applyInPandas(lambda p: run(p)[names], schema)


def padding(placed: DataFrame, capacity: int = 2048) -> DataFrame:
    """One row: sequences, tokens, and padding (to ``capacity``, none at a power of two)."""
    fill = placed.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    power = F.col("n").bitwiseAND(F.col("n") - 1) == 0
    return fill.agg(F.count("*").alias("sequences"), F.sum("n").alias("tokens"),
                    F.sum(F.when(power, 0).otherwise(capacity - F.col("n"))).alias("padding"))
