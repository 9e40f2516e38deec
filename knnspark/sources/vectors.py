"""Canonical vector tables.

Base sets are ``(id BIGINT, v ARRAY<DOUBLE>, ...)``; query sets are ``(qid BIGINT, qv ARRAY<DOUBLE>)``.
Ids are explicit columns, never positions or ``monotonically_increasing_id``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet")


def canonical(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
              keep: tuple[str, ...] = ("label",)) -> DataFrame:
    """``(id BIGINT, v ARRAY<DOUBLE>, *keep)`` from any id/vector table."""
    cols = [F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).cast("array<double>").alias("v")]
    cols += [F.col(c) for c in keep if c in df.columns]
    return df.select(*cols)


def as_queries(df: DataFrame, id_col: str = "id", vec_col: str = "v") -> DataFrame:
    """Rename a vector table to the query-side names ``(qid, qv)``."""
    return df.select(F.col(id_col).cast("bigint").alias("qid"), F.col(vec_col).cast("array<double>").alias("qv"))


# Query set of the driver's ``embeddings`` table (FIXTURES.md §1): the rows whose id is divisible by 20, or in the
# searches that FIXTURES names by 10, are the queries, and all rows are the base set.  So a query's own row is in the
# base, and is its nearest neighbour in a search; evaluations leave it out (``others``).
QUERY_EVERY = 20
TENTH = 10


def fixture_split(spark: SparkSession, sf_dir: str, every: int = QUERY_EVERY) -> tuple[DataFrame, DataFrame]:
    emb = read_embeddings(spark, sf_dir)
    return canonical(emb), as_queries(canonical(emb.where(F.col("vec_id") % every == 0), keep=()))


def others(neighbors: DataFrame, n: int) -> DataFrame:
    """The first ``n`` neighbours beside the query's own row, of a search for ``n + 1``."""
    w = Window.partitionBy("qid").orderBy("rank")
    left = neighbors.where(F.col("id") != F.col("qid")).withColumn("rank", F.row_number().over(w))
    return left.where(F.col("rank") <= n).select("qid", "rank", "id", "dist")


def whole_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of ``embeddings`` as a base set."""
    return canonical(read_embeddings(spark, sf_dir))


def vector_dim(df: DataFrame, vec_col: str = "v") -> int | None:
    """Dimension taken from one row (reads a single row group, not the table)."""
    row = df.select(F.size(vec_col).alias("d")).where(F.col("d") >= 0).first()
    return None if row is None else int(row["d"])


def validate_vectors(df: DataFrame, vec_col: str = "v", expected_dim: int | None = None) -> DataFrame:
    """One aggregate pass -> rows, null vectors, min/max length, rows of a wrong length.

    The reference asserts equal lengths; here the report is data and the caller decides.
    """
    size = F.size(vec_col)
    exp = F.lit(expected_dim) if expected_dim is not None else None
    aggs = [
        F.count(F.lit(1)).cast("bigint").alias("n_rows"),
        F.sum(F.when(F.col(vec_col).isNull(), 1).otherwise(0)).cast("bigint").alias("n_null"),
        F.min(F.when(F.col(vec_col).isNotNull(), size)).cast("int").alias("min_dim"),
        F.max(F.when(F.col(vec_col).isNotNull(), size)).cast("int").alias("max_dim"),
        F.sum(F.when(F.exists(vec_col, lambda x: x.isNull() | F.isnan(x)), 1).otherwise(0))
        .cast("bigint").alias("n_bad_values"),
    ]
    if exp is not None:
        aggs.append(F.sum(F.when(F.col(vec_col).isNotNull() & (size != exp), 1).otherwise(0))
                    .cast("bigint").alias("n_wrong_dim"))
    return df.agg(*aggs)


def check_uniform_dim(df: DataFrame, vec_col: str = "v") -> int:
    """Raise unless every vector has the same length; returns that length (0 for an empty set)."""
    row = validate_vectors(df, vec_col).first()
    if row is None or row["n_rows"] == 0:
        return 0
    if row["n_null"]:
        raise ValueError(f"{row['n_null']} null vectors")
    if row["min_dim"] != row["max_dim"]:
        raise ValueError(f"inconsistent vector dimensionality: {row['min_dim']}..{row['max_dim']}")
    return int(row["min_dim"])
