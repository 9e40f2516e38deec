"""The query side of a search: a table in the shared folder that base tasks stream block by block.

A search compares base rows with queries.  The valid queries are written once as ``(qid, qv, ...)`` into the
shared folder; the driver knows the folder, the number of rows and how many of them make a block, and
holds no query.  Every base task reads the blocks itself: one block (the common case) is read once a worker and
the base rows are streamed past it; of several, each is read for every chunk of buffered base rows.
Either way the base is read once, no (base x query) pair table is materialised, and the base is never shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from knnspark.functions.distance import arrow_matrix
from knnspark.session import DEFAULT_MAX_BROADCAST_BYTES, broadcast_bound, scratch_path

# Rows that a block's queries keep in a task at most (top-N, or the first M), so that its state doesn't grow with the queries.
KEPT_ROWS = 1 << 20

# Base rows buffered while the blocks are streamed past them (only with more than one block).
CHUNK_BYTES = 64 << 20

#: The last single block that this worker has read: (path, block).
_last: tuple[str, "Block"] | None = None


@dataclass
class Block:
    """Some queries: ids, vectors, and the other columns of the side (lists stay Arrow)."""

    qids: np.ndarray
    Q: np.ndarray
    extra: dict[str, np.ndarray | pa.Array]


def shared_files(uri: str) -> tuple["object", list[str]]:
    """File system and data files, in order of their names, of a table in the shared folder."""
    from pyarrow import fs

    store, root = fs.FileSystem.from_uri(re.sub(r"^(file:)?/(?!/)", "file:///", uri))
    at = store.get_file_info(root)
    if at.type != fs.FileType.Directory:
        return store, []
    found = (f.path for f in store.get_file_info(fs.FileSelector(root, recursive=True)) if f.is_file)
    return store, sorted(p for p in found if p.endswith(".parquet") and not p.rsplit("/", 1)[1].startswith(("_", ".")))


def shared_batches(uri: str, columns: list[str], rows: int) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``rows`` rows of a table in the shared folder, file by file; one is held."""
    import pyarrow.parquet as pq

    store, files = shared_files(uri)
    for path in files:
        with store.open_input_file(path) as f:
            yield from pq.ParquetFile(f).iter_batches(batch_size=rows, columns=columns)


@dataclass(frozen=True)
class QuerySide:
    path: str
    rows: int
    dim: int
    block_rows: int
    extra: tuple[str, ...] = ()

    @property
    def blocks(self) -> int:
        return -(-self.rows // self.block_rows)

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path)

    def stream(self) -> Iterator[Block]:
        """The blocks, each of ``block_rows`` queries but the last; no more than one is held."""
        names = ["qid", "qv", *self.extra]
        held, n = [], 0
        for batch in shared_batches(self.path, names, min(self.block_rows, 1 << 14)):
            while n + batch.num_rows >= self.block_rows:
                first = self.block_rows - n
                yield self._block([*held, batch.slice(0, first)], names)
                held, n, batch = [], 0, batch.slice(first)
            if batch.num_rows:
                held.append(batch)
                n += batch.num_rows
        if n:
            yield self._block(held, names)

    def _block(self, batches: list[pa.RecordBatch], names: list[str]) -> Block:
        table = pa.Table.from_batches(batches).select(names)
        Q, _ = arrow_matrix(table.column("qv"), self.dim)
        return Block(table.column("qid").to_numpy().astype(np.int64), np.ascontiguousarray(Q),
                     {c: _values(table.column(c)) for c in self.extra})

    def scan(self, batches: Iterator[pa.RecordBatch],
             solve: Callable[[Block], Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]]) -> Iterator[pa.RecordBatch]:
        """``solve(block)(base batches)`` for every block, over one reading of the base batches."""
        global _last
        if self.blocks == 1:
            if _last is None or _last[0] != self.path:
                _last = (self.path, next(self.stream()))
            yield from solve(_last[1])(batches)
            return
        for chunk in chunks(batches, CHUNK_BYTES):
            for block in self.stream():
                yield from solve(block)(iter(chunk))


def _values(column: pa.ChunkedArray) -> np.ndarray | pa.Array:
    return column.combine_chunks() if pa.types.is_list(column.type) else column.to_numpy()


def chunks(batches: Iterator[pa.RecordBatch], max_bytes: int) -> Iterator[list[pa.RecordBatch]]:
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= max_bytes:
            yield held
            held, size = [], 0
    if held:
        yield held


def valid_queries(queries: DataFrame, dim: int, extra: tuple[str, ...] = ()) -> DataFrame:
    """``(qid, qv, *extra)`` of the queries of length ``dim`` whose elements are all finite (the others get
    an empty answer, D18)."""
    bad = F.exists("qv", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (queries.where((F.size("qv") == dim) & ~F.coalesce(bad, F.lit(False)))
            .select(F.col("qid").cast("bigint"), F.col("qv").cast("array<double>"), *extra))


def query_side(queries: DataFrame, dim: int, max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
               extra: tuple[str, ...] = (), keep: int = 0, unique: bool = True) -> QuerySide | None:
    """The valid queries, written into the shared folder; None if there are none.

    ``max_bytes`` bounds a block, whatever the number of queries, and so does ``keep``, the rows that a task keeps for each
    of them.  Repeated ids raise, as their answers would be mixed up, unless that is wanted (``unique``).  Two numbers
    come back to the driver."""
    spark, path = queries.sparkSession, scratch_path(queries.sparkSession, "queries")
    valid = valid_queries(queries, dim, extra)
    valid.hint("rebalance").write.parquet(path)  # files of a fair size, however many tasks the queries came from
    ids = spark.read.schema(valid.schema).parquet(path).groupBy("qid").agg(F.count(F.lit(1)).alias("n"))
    found = ids.agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("ids")).first()
    if not found["rows"]:
        return None
    if unique and found["rows"] != found["ids"]:
        raise ValueError(f"{found['rows'] - found['ids']} query rows repeat the id of another")
    row_bytes = 8 * max(dim, 1) + 48 + 8 * len(extra)
    block_rows = broadcast_bound(max_bytes) // row_bytes
    if keep:
        block_rows = min(block_rows, KEPT_ROWS // keep)
    return QuerySide(path, int(found["rows"]), dim, max(1, block_rows), extra)


def check_broadcast(nbytes: int, what: str, max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> None:
    max_bytes = broadcast_bound(max_bytes)
    if nbytes > max_bytes:
        raise MemoryError(f"{what} is {nbytes} bytes, above the broadcast bound of {max_bytes}")


def probed_only(lists: DataFrame, probed: DataFrame, on: list[str], max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """``lists`` without the rows whose ``on`` columns aren't among the probed ones.

    A join that Spark turns into a run-time filter: where ``on`` are partition columns, the folders of other
    keys are never opened (dynamic partition pruning), and the plan has one size for any number of queries.  The
    keys are counted first; too many to broadcast would prune little and are not joined (every scan matches
    its rows to the queries' keys anyway)."""
    keys = probed.select(*on).distinct()
    path = scratch_path(lists.sparkSession, "probed")
    keys.hint("rebalance").write.parquet(path)
    keys = lists.sparkSession.read.schema(keys.schema).parquet(path)
    if keys.count() * 16 * len(on) > broadcast_bound(max_bytes):
        return lists
    # The comparison tells the optimizer that the keys are a selection, which dynamic pruning asks for.
    return lists.join(F.broadcast(keys.where(F.col(on[0]) >= -(1 << 31))), on, "left_semi")
