"""Helpers shared by the text operators: table access, written intermediates, batch access."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from knnspark.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's Parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet into the shared checkpoint folder and read again.

    Cuts the lineage with a copy every executor can read, and gives Spark the exact size, so that a
    later join broadcasts it only when it is below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, *names: str) -> list[str]:
    """``names`` with two underscores before them, and as many after them as keep them apart from ``df``'s columns."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        name = f"__{name}"
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def pieces(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut to at most ``rows`` rows, so that a task holds few Python texts at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def text_pieces(batches: Iterator[pa.RecordBatch], column: int, size: int = 1 << 20, rows: int = 4096) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut to at most ``rows`` rows whose texts in ``column`` have at most ``size`` bytes together (a
    longer text is alone), so that what a task makes of them is bounded whatever the texts' lengths."""
    for batch in pieces(batches, rows):
        ends = np.cumsum(pc.binary_length(batch.column(column)).fill_null(0).to_numpy().astype(np.int64))
        at = done = 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(ends, done + size, "right")))
            yield batch.slice(at, end - at)
            at, done = end, int(ends[end - 1])


def whole_groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of complete groups, with each group's start and the end of the last.

    The rows must be sorted by the first ``keys`` integer columns.  A group that goes on in the next
    batch is held back; no more than one batch and one group are held.
    """
    held: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        now = pa.Table.from_batches([batch])
        now = now if held is None else pa.concat_tables([held, now])
        change = np.zeros(now.num_rows - 1, bool)
        for k in range(keys):
            column = now.column(k).to_numpy()
            change |= column[1:] != column[:-1]
        starts = np.concatenate([[0], np.flatnonzero(change) + 1])
        if len(starts) > 1:
            yield now.slice(0, starts[-1]), starts
        held = now.slice(starts[-1])
    if held is not None:
        yield held, np.array([0, held.num_rows])
