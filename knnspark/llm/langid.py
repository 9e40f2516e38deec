"""Language identification by words first, then by shorter and shorter character n-grams.

Learning: from labelled documents (of each language a random sample of about ``max_docs``, or all if there are
fewer, so a rare language is learned alike at every size; whole texts), Spark counts words by language and, from those counts, character n-grams of one to four characters of the
words between boundary marks.  The most frequent ``max_words`` words and ``max_grams`` n-grams are kept;
they bound the model.

Prediction: a known word adds the logarithm of its smoothed frequency in each language.  An unseen
word is read end by end: at each of its characters the longest known n-gram that ends there gives its
log frequency, and the mean over the characters stands for the word.  The language with the largest
sum (plus the log share of each language in all labelled documents) wins; the score is its share after the exponential.

Defined results: a null text, or one without a letter, is ``und`` with score 0; so is every text if
nothing could be learned.  Rows without a language are never learned from.  Ties go to the language
first in order of its text.  Repeated rows, null and repeated ids are predicted row by row; whole texts
are read; other columns are never inputs of a prediction.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, StringType, StructType

from knnspark.llm.common import pieces, written

UNKNOWN = "und"
ORDERS = (4, 3, 2, 1)
_WORD = re.compile(r"[^\W\d_]+")  # numbers that aren't decimal digits are still in it
_SMOOTH = 0.1


def words_of(text: str) -> list[str]:
    """Lower-cased runs of letters."""
    found = _WORD.findall(text.lower())
    if all(map(str.isalpha, found)):
        return found
    return [w for run in found for w in ([run] if run.isalpha() else "".join(c if c.isalpha() else " " for c in run).split())]


def grams_of(word: str) -> Iterator[str]:
    marked = f"<{word}>"
    for n in ORDERS:
        for k in range(len(marked) - n + 1):
            yield marked[k:k + n]


@dataclass
class Model:
    """Log frequencies: a row for each word and n-gram, a column for each language."""

    languages: list[str]
    prior: np.ndarray
    words: list[str]
    word_rows: np.ndarray
    grams: list[str]
    gram_rows: np.ndarray
    memory: int = 200_000
    _ready: bool = field(default=False, repr=False)

    def _prepare(self) -> None:
        if not self._ready:
            self._word = {w: k for k, w in enumerate(self.words)}
            self._gram = {g: k for k, g in enumerate(self.grams)}
            self._unseen: dict[str, np.ndarray] = {}
            self._share: dict[str, float] = {}
            self._ready = True

    def unseen(self, word: str) -> np.ndarray:
        """Mean log frequency of the longest known n-grams that end at each character of a word."""
        found = self._unseen.get(word)
        if found is None:
            marked, rows, get = f"<{word}>", [], self._gram.get
            for end in range(2, len(marked) + 1):
                for n in ORDERS:
                    k = get(marked[end - n:end]) if n <= end else None
                    if k is not None:
                        rows.append(k)
                        break
            found = self.gram_rows[rows].mean(axis=0) if rows else np.zeros(len(self.languages), np.float32)
            if len(self._unseen) < self.memory:
                self._unseen[word] = found
        return found

    def familiar(self, text: str | None) -> float:
        """Share of a text's letters in known words; of an unseen word, the share of its longest n-grams that are known.

        It doesn't depend on a text's length: near 1 in learned languages, near 0 in other scripts and junk.
        """
        self._prepare()
        n, letters, known = ORDERS[0], 0, 0.0
        for word, times in Counter(words_of(text or "")).items():
            letters += times * len(word)
            if word in self._word:
                known += times * len(word)
            elif len(word) > 1:
                share = self._share.get(word)
                if share is None:
                    marked = f"<{word}>"
                    ends = range(n, len(marked) + 1)
                    share = sum(marked[end - n:end] in self._gram for end in ends) / len(ends)
                    if len(self._share) < self.memory:
                        self._share[word] = share
                known += times * len(word) * share
        return known / letters if letters else 0.0

    def predict(self, text: str | None) -> tuple[str, float]:
        self._prepare()
        counts = Counter(words_of(text or ""))
        if not counts or not self.languages:
            return UNKNOWN, 0.0
        get = self._word.get
        known = [(k, n) for k, n in ((get(w), n) for w, n in counts.items()) if k is not None]
        total = self.prior.astype(np.float64)
        if known:
            at, n = np.array(known).T
            total = total + n @ self.word_rows[at].astype(np.float64)
        if len(known) < len(counts):
            others = [w for w in counts if w not in self._word]
            total = total + np.array([counts[w] for w in others], float) @ np.stack([self.unseen(w) for w in others])
        best = int(np.argmax(total))
        return self.languages[best], float(1 / np.exp(total - total[best]).sum())


def _table_of(counts: DataFrame, languages: list[str], limit: int, least: int, by_length: bool) -> tuple[list[str], np.ndarray]:
    """Units (those counted most, ``limit`` at most) and their smoothed log frequency in each language.

    Totals are over all units; only the kept rows go to the driver.
    """
    totals = {(r["lang"], r["size"]): (r["n"], r["units"]) for r in counts.groupBy("lang", "size").agg(
        F.sum("n").alias("n"), F.count("*").alias("units")).collect()}
    wide = counts.groupBy("unit").pivot("lang", languages).agg(F.sum("n")).na.fill(0)
    every = sum((F.col(f"`{c}`") for c in languages), F.lit(0))
    rows = wide.withColumn("__all", every).where(F.col("__all") >= least).orderBy(F.desc("__all"), "unit").limit(limit).drop("__all").toPandas()
    units = rows["unit"].tolist()
    n = rows[languages].to_numpy(dtype=float).reshape(len(units), len(languages))
    seen = [[totals.get((c, len(u) if by_length else 0), (0, 0)) for c in languages] for u in units]
    base = np.array([[n + _SMOOTH * max(1, kinds) for n, kinds in row] for row in seen]).reshape(n.shape)
    return units, np.log((n + _SMOOTH) / base).astype(np.float32)


def learn(labelled: DataFrame, max_docs: int = 5_000, max_words: int = 150_000, max_grams: int = 60_000, seed: int = 11) -> Model:
    """A model from the text and lang of ``labelled`` (rows without either are left out)."""
    rows = labelled.select("text", "lang").where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    shares = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if any(n > max_docs for n in shares.values()):
        rows = rows.sampleBy("lang", {c: min(1.0, max_docs / n) for c, n in shares.items()}, seed)

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 2048):
            found: dict[str, Counter] = {}
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found.setdefault(lang, Counter()).update(words_of(text))
            for lang, counts in found.items():
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(counts), pa.string()), pa.array(list(counts), pa.string()),
                                                  pa.array(list(counts.values()), pa.int64())], names=["lang", "unit", "n"])

    def count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 8192):
            found: Counter = Counter()
            for lang, word, n in zip(*(c.to_pylist() for c in batch.columns)):
                for g in grams_of(word):
                    found[lang, g] += n
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in found], pa.string()), pa.array([k[1] for k in found], pa.string()),
                                              pa.array(list(found.values()), pa.int64())], names=["lang", "unit", "n"])

    kind = "lang string, unit string, n long"
    words = rows.mapInArrow(count_words, kind).groupBy("lang", "unit").agg(F.sum("n").alias("n"))
    words = written(words, "language-words")
    grams = words.mapInArrow(count_grams, kind).groupBy("lang", "unit").agg(F.sum("n").alias("n"))
    languages = sorted(shares)
    if not languages:
        empty = np.zeros((0, 0), np.float32)
        return Model([], np.zeros(0), [], empty, [], empty)
    prior = np.log(np.array([shares[c] for c in languages]) / sum(shares.values()))
    known, word_rows = _table_of(words.withColumn("size", F.lit(0)), languages, max_words, 2, False)
    short, gram_rows = _table_of(grams.withColumn("size", F.char_length("unit")), languages, max_grams, 3, True)
    return Model(languages, prior, known, word_rows, short, gram_rows)


def held_out(folds: int = 5) -> Column:
    """Whether crc32 of the document id's text is divisible by ``folds`` (a null id isn't held out)."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == 0, F.lit(False))


def learned_from(docs: DataFrame, folds: int = 5) -> DataFrame:
    """The rows outside the held-out fold (rows with a null id are in neither part)."""
    return docs.where(F.col("doc_id").isNotNull() & ~held_out(folds))


def identify(docs: DataFrame, model: Model, familiar: str | None = None, names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """All columns of ``docs``, the predicted language and its score in columns of the given ``names`` (columns of
    these names are replaced), and ``Model.familiar`` of the text in a column named ``familiar`` if that is given."""
    kept = docs.drop(*names, *([familiar] if familiar else []))
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    at = kept.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 1024):
            texts = batch.column(at).to_pylist()
            found = [shipped.value.predict(t) for t in texts]
            more = [pa.array([shipped.value.familiar(t) for t in texts], pa.float64())] if familiar else []
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()), *more],
                names=[*batch.schema.names, *names, *([familiar] if familiar else [])])

    schema = StructType(list(kept.schema.fields)).add(names[0], StringType()).add(names[1], DoubleType())
    return kept.mapInArrow(run, schema.add(familiar, DoubleType()) if familiar else schema)
