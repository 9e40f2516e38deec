"""Corpus cleaning pipeline over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes every stage's result as
Parquet into the shared folder and reads it again as the next stage's docs.  All stages but the last
return the columns of ``docs``, whatever their names (the stages' own columns take names that ``docs`` doesn't have),
and change none of them but ``text`` (secrets).  Null and empty texts go in the first stage (they have no language);
an empty table passes every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from knnspark.llm import decontaminate, jaccard, langid, packing, registry, secrets
from knnspark.llm.common import table, unused, written
from knnspark.session import prepare

#: Least share of the predicted language.
LEAST_SCORE = 0.5
#: Least share of a text's letters in known words and n-grams, whatever its length.  Up to 1,500 held-out
#: texts each of sf0.01 and sf0.1 have 0.91 or more, their first six words 0.73; random letters 0.07 at most, other scripts 0.
LEAST_FAMILIAR = 0.5


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: rows without a recognisable language go, and so do texts of unfamiliar words."""
    prepare(spark)
    model = langid.learn(langid.learned_from(docs))
    language, score, familiar = unused(docs, "language", "score", "familiar")
    found = langid.identify(docs, model, familiar, (language, score))
    sure = (found[language] != langid.UNKNOWN) & (found[score] >= LEAST_SCORE)
    return found.where(sure & (found[familiar] >= LEAST_FAMILIAR)).select(*docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: of each group of near duplicates, the row with the smallest id stays."""
    prepare(spark)
    return jaccard.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: rows that hold a benchmark item go."""
    prepare(spark)
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def masked_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secret scans: every character of a secret is replaced by an asterisk; no row goes."""
    prepare(spark)
    (spans,) = unused(docs, "spans")
    return secrets.mask(secrets.scan(docs, spans=spans), spans=spans).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing: the place of every piece of every document in training sequences."""
    prepare(spark)
    return packing.pack(docs, registry.TOKENIZER, registry.RANKS)


STAGES = [
    ("language_id", known_language),
    ("near_duplicates", one_of_each),
    ("decontamination", without_benchmark),
    ("secrets", masked_secrets),
    ("packing", packed),
]

#: Language models, sketches and tokenizers aren't SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
