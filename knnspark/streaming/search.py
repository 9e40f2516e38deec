"""Query streams against a static index (E3 over micro-batches).

The reference answers a batch of queries; here the same search runs on every micro-batch of a
query stream.  The index (base table plus driver-side parameters) is static; each micro-batch is
an ordinary DataFrame handed to ``plans.api.search`` inside ``foreachBatch``.  Results are written
under ``<sink>/batch_id=<n>`` in overwrite mode, so a batch replayed after a failure replaces its
own output instead of duplicating it (exactly-once together with the stream checkpoint).
No state is kept between batches: every query is answered independently, as in the reference.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from knnspark.plans import api
from knnspark.session import scratch_scope


def query_stream(spark, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A stream of query vectors ``(qid, qv)`` from parquet files arriving in ``path``."""
    reader = spark.readStream.schema("qid bigint, qv array<double>")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(path)


def start_search(index: api.Index, queries: DataFrame, n: int, sink: str, radius: float | None = None,
                 checkpoint: str | None = None, available_now: bool = True) -> StreamingQuery:
    """Answer every micro-batch of ``queries`` with ``index``; returns the running query.

    The stream's progress is kept beside its results unless ``checkpoint`` names another folder, so a
    stream that is started again with the same sink goes on where it stopped."""
    checkpoint = checkpoint or f"{sink.rstrip('/')}/_checkpoint"

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        with scratch_scope(batch.sparkSession):  # the batch's query table goes when its results are written
            neighbors, hits = api.search(index, batch, n, radius, persist=False)   # nothing cached per batch
            out = f"{sink.rstrip('/')}/neighbors/batch_id={batch_id}"
            neighbors.write.mode("overwrite").parquet(out)
            if hits is not None:
                hits.write.mode("overwrite").parquet(f"{sink.rstrip('/')}/range_hits/batch_id={batch_id}")

    writer = queries.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()


def read_results(spark, sink: str, what: str = "neighbors") -> DataFrame:
    return spark.read.parquet(f"{sink.rstrip('/')}/{what}").drop("batch_id")
