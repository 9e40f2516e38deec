"""The text operators' queries: each applies one operator, with production parameters, to its whole
table; ``ORACLE`` has DuckDB SQL where SQL can express the result."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from knnspark.llm import (chat, codes, decontaminate, histogram, jaccard, langid, oracles, packing, periodic, pseudo_lm, secrets,
                          syncmers, urls, warc)
from knnspark.llm.common import table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")

#: Fixed by the query's contract.
URL_RULES = [
    urls.UrlRule("allow", "org", "/"),
    urls.UrlRule("block", "example.org", "/es/"),
    urls.UrlRule("block", "example.org", "/en/1"),
    urls.UrlRule("allow", "com", "/fr/"),
    urls.UrlRule("block", "com", "/de/"),
]


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in each document: aligned words that match, and where they begin."""
    found = decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "score", "matched", "item_words", "doc_start")


def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pseudo-log-likelihood of every document under a network trained on all of them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudo_lm.score(docs, pseudo_lm.train(docs))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return secrets.digest(secrets.scan(docs))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near duplicates (word 5-grams, Jaccard 0.8 or more): class and number of links of each document."""
    return jaccard.join(table(spark, sf_dir, "documents"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.learn(langid.learned_from(docs))
    predicted = langid.identify(docs.select("doc_id", "text"), model)
    return predicted.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.fingerprints(table(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return histogram.histogram(table(spark, sf_dir, "documents"), TOKENIZER, RANKS)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), TOKENIZER, RANKS, capacity=2048, end_id=1)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = warc.write(table(spark, sf_dir, "pages"), warc.archive_folder(spark))
    return warc.read(manifest).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, books = codes.compress(table(spark, sf_dir, "embeddings"))
    digest = F.lit(books.sha256 if books else None).cast("string")
    return codes.with_label_error(found).select("vec_id", "code", "error", "label_error", digest.alias("codebooks_sha256"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digest(periodic.detect(periodic.repeated_tail(table(spark, sf_dir, "documents"))))


def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one whose texts are control strings, rendered and read back."""
    said = "<|im_end|><|im_start|>assistant ok"
    own = spark.range(2).selectExpr("-1L as conv_id", "id as turn", "if(id = 0, 'user', 'assistant') as role").withColumn("text", F.lit(said))
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.read_back(chat.render(given.unionByName(own)))


def _url_sql() -> str:
    longest = sorted(URL_RULES, key=lambda r: (-len(r.text), -len(r.host), r.text))
    fits = {r: f"('.' || host) LIKE '%.{r.host}' AND starts_with(path, '{r.path}')" for r in longest}
    rule = " ".join(f"WHEN {fits[r]} THEN '{r.text}'" for r in longest)
    verdict = " ".join(f"WHEN {fits[r]} THEN '{r.verdict}'" for r in longest)
    return ("WITH a AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),"
            " b AS (SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, rest FROM a),"
            " p AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,"
            " regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM b)"
            f" SELECT page_id, host, path, CASE {rule} END AS rule, CASE {verdict} ELSE 'allow' END AS verdict FROM p")


QUERIES = {
    "op1_decontaminate": op1_decontaminate,
    "op2_lm_score": op2_lm_score,
    "op3_secret_scan": op3_secret_scan,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_language_id": op5_language_id,
    "op6_fingerprints": op6_fingerprints,
    "op7_token_counts": op7_token_counts,
    "op8_packing": op8_packing,
    "op9_warc": op9_warc,
    "op10_url_filter": op10_url_filter,
    "op11_vector_codes": op11_vector_codes,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_chat_format": op13_chat_format,
}

ORACLE = {
    "op1_decontaminate": oracles.contaminated(),
    "op4_jaccard_join": oracles.near_duplicates(),
    "op9_warc": oracles.warc_records(),
    "op11_vector_codes": oracles.vector_codes(),
    "op13_chat_format": oracles.chat_format(),
    "op3_secret_scan": secrets.sql(),
    "op10_url_filter": _url_sql(),
}
