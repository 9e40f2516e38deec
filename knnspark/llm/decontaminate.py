"""Benchmark decontamination by spaced seeds, in DataFrame functions only.

A text is a list of word hashes (lower-cased runs of letters and digits).  A spaced seed looks at a
few of the positions of a window and ignores the others, so a window still hashes alike when ignored
words were substituted.  Every window of every text is hashed under each of a few fixed seeds, and
joined with the windows of the benchmark.  A hit names a diagonal: the benchmark item laid beside the
text so that the windows meet.  Of neighbouring hits of a seed on a diagonal the first is kept, and the whole
item is scored on it word by word: a match counts 1, a substitution takes
``penalty``, and the best run of the alignment is kept.  An item is found in a text if that run
reaches ``min_score``, or if ``min_share`` of the whole item's words match.

The seeds are chosen so that no substitution hides an item: whichever quarter of the words of an item of ten to
24 words (rounded down) is substituted, a seed of ``LONG`` hits, and a longer item can be cut into stretches of ten to
24 words, one of which has no more than its quarter.  ``SHORT`` does the same for items of five to nine words.
(``tests/llm/test_decontaminate.py`` tries all patterns.)

Windows are made and hashed inside one generated-code stage (no row holds a whole text's windows), and
join a broadcast of the benchmark's windows.  That broadcast is bounded by ``max_windows``: a larger
benchmark is joined in blocks of its windows, one pass over the texts each.

Defined results: null and empty texts have no words and no hits; null ids are kept as null and
repeated rows or ids give one row for each (doc_id, text, item); items of fewer than ``SHORTEST``
words are too short to tell and are not looked for; an item that sticks out of the text's ends is scored on
the words that meet; empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from knnspark.llm.common import unused, written

#: Looked-at positions of each seed: of items of at least ``LENGTHY`` words, and of shorter ones.
LONG = ((0, 1, 2, 4), (0, 1, 6, 8))
SHORT = ((0, 1, 2), (0, 1, 3))
SEEDS = (*LONG, *SHORT)
LENGTHY = 10
SHORTEST = 5
_LET = "__words"


def word_hashes(text: Column) -> Column:
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def seeds_for(least: int, most: int) -> list[int]:
    """Numbers of the seeds that items of ``least`` to ``most`` words need."""
    return [k for k, seed in enumerate(SEEDS) if (most >= LENGTHY if seed in LONG else least < LENGTHY)]


def _hash(k: int, start: Column) -> Column:
    return F.xxhash64(F.lit(k), *(F.get(_LET, start + o) for o in SEEDS[k]))


def _windows(df: DataFrame, seeds: list[int], item: bool = False) -> DataFrame:
    """``df`` (with words in ``__words``) times (pos, hash): every window under every seed.  Items are only
    hashed under the seeds of their length."""
    n = F.size(_LET)
    span = {k: SEEDS[k][-1] + 1 for k in seeds}
    starts = F.when(n >= min(span.values()), F.sequence(F.lit(0), n - min(span.values())))
    # The outer form keeps Catalyst from inferring a filter on the generator's input, which would
    # split and hash every text twice.
    rows = df.select("*", F.explode_outer(starts).alias("pos")).where(F.col("pos").isNotNull())

    def of(k: int, value: Column) -> Column:
        fits = F.col("pos") + span[k] <= n
        if item:
            fits = fits & ((n >= LENGTHY) if SEEDS[k] in LONG else (n < LENGTHY))
        return F.when(fits, value)

    if item:  # with the seed, and the hash of the window before under the same one
        each = F.array(*(of(k, F.struct(F.lit(k).alias("seed"), _hash(k, F.col("pos")).alias("hash"),
                                        F.when(F.col("pos") > 0, _hash(k, F.col("pos") - 1)).alias("before"))) for k in seeds))
        return rows.select("*", F.explode_outer(each).alias("w")).where(F.col("w").isNotNull()).select("*", "w.*").drop("w")
    return rows.select("*", F.explode_outer(F.array(*(of(k, _hash(k, F.col("pos"))) for k in seeds))).alias("hash")).where(F.col("hash").isNotNull())


def find(docs: DataFrame, benchmark: DataFrame, min_score: int = 10, min_share: float = 0.75, penalty: int = 3,
         max_windows: int = 1_000_000) -> DataFrame:
    """(doc_id, text_key, item_id, score, matched, item_words, doc_start) of every item found in a text."""
    items = written(benchmark.select("item_id", word_hashes(F.col("text")).alias("item")).where(F.size("item") >= SHORTEST),
                    "benchmark-words")
    sizes = items.agg(F.min(F.size("item")).alias("least"), F.max(F.size("item")).alias("most"), F.sum(F.size("item")).alias("words")).first()
    seeds = seeds_for(sizes["least"] or SHORTEST, sizes["most"] or SHORTEST)
    n_windows = (sizes["words"] or 0) * len(LONG)
    blocks = max(1, -(-n_windows // max_windows))
    windows = _windows(items.withColumnRenamed("item", _LET), seeds, item=True)
    windows = written(windows.select("item_id", F.size(_LET).alias("item_words"), F.col("pos").alias("item_pos"), "seed", "hash", "before"),
                      "benchmark-windows")
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_key"), word_hashes(F.col("text")).alias(_LET))
    made = _windows(texts, seeds)
    found = None
    for b in range(blocks):
        part = windows.where(F.pmod("hash", F.lit(blocks)) == b) if blocks > 1 else windows
        hits = made.join(F.broadcast(part), "hash")
        found = hits if found is None else found.unionAll(hits)
    return _verified(found, items, seeds, min_score, min_share, penalty, blocks)


def _verified(hits: DataFrame, items: DataFrame, seeds: list[int], min_score: int, min_share: float, penalty: int, blocks: int) -> DataFrame:
    # A hit whose neighbour to the left is a hit of the same seed on the same diagonal adds nothing.
    left = F.coalesce(*(F.when(F.col("seed") == k, _hash(k, F.col("pos") - 1)) for k in seeds))
    first = hits.where((F.col("pos") == 0) | F.col("before").isNull() | (left != F.col("before")))
    diagonal = F.col("pos") - F.col("item_pos")
    doc_start, item_start = F.greatest(diagonal, F.lit(0)), F.greatest(-diagonal, F.lit(0))
    aligned = first.select("doc_id", "text_key", "item_id", doc_start.alias("doc_start"), item_start.alias("item_start"),
                           F.slice(_LET, doc_start + 1, F.col("item_words") - item_start).alias("there"))
    joined = aligned.join(F.broadcast(items) if blocks == 1 else items, "item_id")
    same = F.zip_with("there", F.slice("item", F.col("item_start") + 1, F.size("there")), lambda a, b: a == b)
    zero = F.struct(F.lit(0).alias("run"), F.lit(0).alias("best"), F.lit(0).alias("n"))

    def step(acc: Column, x: Column) -> Column:
        hit = F.coalesce(x, F.lit(False))
        run = F.greatest(acc["run"] + F.when(hit, 1).otherwise(-penalty), F.lit(0))
        return F.struct(run.alias("run"), F.greatest(acc["best"], run).alias("best"), (acc["n"] + hit.cast("int")).alias("n"))

    scored = joined.select("doc_id", "text_key", "item_id", "doc_start", F.size("item").alias("item_words"),
                           F.aggregate(same, zero, step).alias("s"))
    kept = scored.where((F.col("s.best") >= min_score) | (F.col("s.n") >= min_share * F.col("item_words")))
    return kept.groupBy("doc_id", "text_key", "item_id").agg(
        F.max("s.best").alias("score"), F.max("s.n").alias("matched"), F.max("item_words").alias("item_words"),
        F.min("doc_start").alias("doc_start"))


def clean(docs: DataFrame, benchmark: DataFrame, **params) -> DataFrame:
    """``docs`` without the rows in which an item was found (rows with the same id and text go together)."""
    doc_id, text = unused(docs, "id", "text")
    dirty = written(find(docs, benchmark, **params).select(F.col("doc_id").alias(doc_id), F.col("text_key").alias(text)).distinct(),
                    "contaminated")
    same = docs["doc_id"].eqNullSafe(dirty[doc_id]) & (F.xxhash64(docs["text"]) == dirty[text])
    return docs.join(dirty, same, "left_anti")
