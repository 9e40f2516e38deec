"""Exact token counts: a histogram of documents by encoded length, read through suffix sums.

Each task encodes its documents and counts them by length; the counts are summed by length, so the
shuffle carries at most one row for each length and batch.  Suffix and prefix sums over the
histogram then answer totals, quantiles and truncated totals for any context limit without reading
the documents again.  The sums go by blocks of lengths: block totals first (a few rows), then sums
inside each block, so no task holds more than one block.  The counts are written to the shared folder
first, as the sums read them twice.

Defined results: a null text counts as empty (length 0); an empty table gives an empty histogram;
repeated rows count each time; ids and other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from knnspark.llm.common import text_pieces, written
from knnspark.llm.encoder import BatchEncoder

BLOCK = 4096


def length_counts(docs: DataFrame, tokenizer: str, ranks: str | None = None) -> DataFrame:
    """(length, docs): how many documents have each encoded length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = BatchEncoder.at(tokenizer, ranks)
        for batch in text_pieces(batches, 0):
            _, ends = encoder.encode(batch.column(0).fill_null(""))
            length, n = np.unique(np.diff(ends, prepend=0), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(length, pa.int64()), pa.array(n, pa.int64())], names=["length", "docs"])

    counted = docs.select("text").mapInArrow(run, "length long, docs long")
    return counted.groupBy("length").agg(F.sum("docs").alias("docs"))


def histogram(docs: DataFrame, tokenizer: str, ranks: str | None = None) -> DataFrame:
    """One row for each length that occurs, with what a context limit of that length means:

    ``docs`` of exactly that length, ``docs_within`` and ``tokens_within`` of at most it (prefix
    sums), ``docs_over`` and ``tokens_over`` of more (suffix sums), ``truncated_total`` (tokens left
    when every document is cut at it) and ``quantile`` (the share of documents within it).
    """
    counts = written(length_counts(docs, tokenizer, ranks), "length-counts").withColumn("block", F.floor(F.col("length") / BLOCK)) \
        .withColumn("tokens", F.col("length") * F.col("docs"))
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    blocks = counts.groupBy("block").agg(F.sum("docs").alias("d"), F.sum("tokens").alias("t")).select(
        "block", *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in "dt"),
        *(F.sum(c).over(everything).alias(f"{c}_all") for c in "dt"))
    inside = Window.partitionBy("block").orderBy("length")
    joined = counts.join(blocks, "block")
    within = joined.select(
        "length", "docs", "tokens", "d_all", "t_all",
        (F.col("d_before") + F.sum("docs").over(inside)).alias("docs_within"),
        (F.col("t_before") + F.sum("tokens").over(inside)).alias("tokens_within"))
    over = F.col("d_all") - F.col("docs_within")
    return within.select(
        "length", "docs", "tokens", "docs_within", "tokens_within", over.alias("docs_over"),
        (F.col("t_all") - F.col("tokens_within")).alias("tokens_over"),
        (F.col("tokens_within") + F.col("length") * over).alias("truncated_total"),
        (F.col("docs_within") / F.col("d_all")).alias("quantile"))


def at_limits(hist: DataFrame, limits: list[int]) -> DataFrame:
    """(context_limit, docs_over, truncated_total) for any limits, from the histogram alone."""
    spark = hist.sparkSession
    wanted = spark.createDataFrame([(int(n),) for n in limits], "context_limit long")
    cut = F.least("length", "context_limit")
    return hist.join(F.broadcast(wanted)).groupBy("context_limit").agg(
        F.sum(F.when(F.col("length") > F.col("context_limit"), F.col("docs")).otherwise(0)).alias("docs_over"),
        F.sum(cut * F.col("docs")).alias("truncated_total"))
