"""The pipeline's stages on planted documents, and the registered queries."""

import random
import subprocess
import sys
from pathlib import Path

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from knnspark.llm import registry
from knnspark.llm.common import written
from knnspark.session import scratch_path
from tests.llm.helpers import docs_df, jaccard_classes
from tests.llm.test_secrets import brute
from tests.llm.test_tokens import _check_packing

RNG = random.Random(12)
EN = ["the", "of", "and", "cat", "house", "river", "stone", "under", "walks", "green", "seven", "paper", "light", "window", "early", "winter"]
FR = ["le", "la", "et", "chat", "maison", "rivière", "pierre", "sous", "marche", "vert", "sept", "papier", "lumière", "fenêtre", "tôt", "hiver"]


def _prose(words, n):
    return " ".join(RNG.choice(words) + RNG.choice(["", "", "s", "ly"]) for _ in range(n))


@pytest.fixture(scope="module")
def planted(spark):
    items = [(k, _prose(EN, 30)) for k in range(3)]
    rows = [(k, _prose(EN if k % 2 else FR, 60)) for k in range(40)]
    rows += [(100, rows[5][1]), (101, rows[5][1] + " one more"), (102, rows[5][1])]  # copies of 5
    rows += [(110, _prose(EN, 20) + " " + items[1][1] + " " + _prose(EN, 20))]  # a benchmark passage
    rows += [(120, _prose(EN, 30) + ' token = "0123456789abcdef0123456789abcdef" ' + _prose(EN, 30))]
    rows += [(130, None), (131, ""), (132, "12345 ### 678"), (133, " ")]  # no language
    rows += [(7, rows[7][1])]  # a repeated row
    folder = scratch_path(spark, "planted")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs = docs_df(spark, rows).withColumns({"lang": F.when(F.col("doc_id") % 2 == 1, "en").otherwise("fr"), "source": F.lit("s"), "n_chars": F.length("text"),
                                            "key": F.lit(1), "hash": F.lit("x"), "score": F.lit(7.5), "spans": F.lit("s"), "lang_pred": F.lit("l"),
                                            **{f"__{c}": F.lit(c) for c in ("kinds", "key", "score", "familiar", "language", "spans", "id", "text", "k1", "h1")}})
    docs.write.parquet(f"{folder}/documents.parquet")
    return folder, rows


def test_each_stage_does_its_whole_job(spark, planted):
    folder, rows = planted
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, results = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, folder), f"test-{name}")
        results[name] = docs
        assert name == "packing" or docs.columns == columns
        if name != "packing":  # the input's own columns come out as they were
            assert docs.select("score", "spans", "lang_pred", "__kinds", "__id").distinct().collect() == [(7.5, "s", "l", "kinds", "id")]
    ids = {name: sorted(r.doc_id for r in df.select("doc_id").collect()) for name, df in results.items()}
    spoken = [(d, t) for d, t in rows if d not in (130, 131, 132, 133)]
    assert ids["language_id"] == sorted(d for d, _ in spoken)
    kept = sorted({c for c, _ in jaccard_classes(spoken)})
    assert ids["near_duplicates"] == kept and {100, 101, 102} & set(kept) == set()
    assert ids["decontamination"] == [d for d in kept if d != 110] == ids["secrets"]
    texts = dict(rows)
    masked = {r.doc_id: r.text for r in results["secrets"].select("doc_id", "text").collect()}
    assert not any(brute(t) for t in masked.values()) and len(masked[120]) == len(texts[120])
    assert all(masked[d] == texts[d] for d in masked if d != 120)
    _check_packing(list(masked.items()), results["packing"].collect(), 2048)
    again = corpus_pipeline.run(spark, folder)
    assert again.columns == results["packing"].columns and again.count() == results["packing"].count()


def test_junk_and_unlearned_scripts_go(spark, planted):
    folder, rows = planted
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rng = random.Random(3)
    cyrillic = "Этот документ написан на языке которому никто не учил " * 5
    chinese = "这是 一个 中文 文档 没有 人 教过 这种 语言 " * 5
    letters = " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(3, 10))) for _ in range(80))
    junk = spark.createDataFrame([(200, cyrillic), (201, chinese), (202, letters), (203, "Привет"), (204, "the cat under the green stone")], "doc_id long, text string")
    mixed = docs.unionByName(junk, allowMissingColumns=True)
    kept = {r.doc_id for r in corpus_pipeline.known_language(spark, mixed, folder).select("doc_id").collect()}
    assert kept == {d for d, _ in rows if d not in (130, 131, 132, 133)} | {204}


def test_empty_table_passes_every_stage(spark, planted):
    folder, _ = planted
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, folder), "test-empty")
        assert docs.count() == 0


def test_one_query_for_each_operator_and_the_pipeline():
    names = set(entry.queries())
    assert {n.split("_")[0] for n in registry.QUERIES} == {f"op{k}" for k in range(1, 14)}
    assert set(registry.QUERIES) | {"pipeline"} <= names and set(registry.ORACLE) <= set(registry.QUERIES)
    assert corpus_pipeline.ORACLE_SQL is None


def test_the_entry_hides_no_other_missing_module():
    code = "import sys; sys.modules['public_tokenizers'] = None; sys.path.insert(0, '.')\nimport __spark_entry__"
    root = Path(entry.__file__).resolve().parent
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=120)
    assert done.returncode != 0 and "public_tokenizers" in done.stderr
