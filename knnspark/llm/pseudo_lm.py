"""Masked pseudo-likelihood scores from a bidirectional window network, trained in NumPy.

Spark counts every word of all documents into a table, which grows with the corpus.  The network sees
the ``SIDE`` words on each side of a masked word (embeddings of the frequent words, of their endings for the
others, a boundary mark outside the text), and one hidden layer predicts the word in three steps: a
softmax over groups of classes, one over the classes of the word's group, and the word's share of its class in
the corpus.  The most frequent words are classes of their own; the others are classed by their last two
letters, which tell the language and form that a context asks for.  A class keeps half a count for every word in it and for
all words that the corpus doesn't have, so the probabilities of a masked word sum to 1.  A document's score is the
sum of the conditional log-probabilities of its words.

Words are numbered once, three bytes each, in a table.  Training is data-parallel: in each of ``rounds`` rounds, every task starts from the same weights and
takes gradient steps on windows of all of its documents (every ``stride``-th word, another offset each
round; by default as many as rounds, so every word is a target once), and the weights are averaged, weighted by
windows, on Spark in groups of ``FAN`` tasks, level by level.  What the rounds gather grows with the number of tasks,
thus with the input; the driver holds one set of weights and the ``KNOWN`` most frequent words at most.

Scoring is one pass over the texts.  Shares of the frequent words are at hand in the task; the other words leave it as
(document, word, times) and are joined with the table of counts.

Defined results: null and empty texts, and texts without words, have 0 words, log_prob 0 and no mean;
repeated rows, null and repeated ids are scored row by row; an empty table gives no rows; whole texts
are read; other columns are ignored.  Weights depend on how the documents are partitioned.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from knnspark.llm.common import pieces, written
from knnspark.llm.words import WordHasher

KNOWN, INPUT_WORDS, ENDINGS = 1 << 16, 4096, 1024
SINGLE, GROUP, CLASSES = 128, 16, 256  # classes of one word, classes of a group, classes in all
SIDE, DIM, HIDDEN = 2, 8, 24
INPUTS, EDGE, WIDTH, GROUPS = INPUT_WORDS + ENDINGS + 1, INPUT_WORDS + ENDINGS, 2 * SIDE, CLASSES // GROUP
SHAPES = {"embed": (INPUTS, DIM), "mid": (WIDTH * DIM, HIDDEN), "mid_bias": (HIDDEN,), "top": (HIDDEN, GROUPS), "top_bias": (GROUPS,),
          "low": (GROUPS, HIDDEN, GROUP), "low_bias": (GROUPS, GROUP)}
HALF = 0.5     # count that every word, and all unseen ones of a class together, have besides
FAN = 64       # tasks whose weights are added in one group
_SLOTS = 22    # bits of the table that finds known words
_BUFFER = 1 << 21  # words counted together before they leave a task


@dataclass
class Vocabulary:
    """The most frequent words by rank (hash, count), and the mass and number of words of every class."""

    hashes: np.ndarray
    counts: np.ndarray
    endings: np.ndarray
    mass: np.ndarray
    kinds: np.ndarray
    least: int = 1  # words counted less often are not among the known ones
    _slots: np.ndarray | None = field(default=None, repr=False)

    def known(self, hashes: np.ndarray) -> np.ndarray:
        """Rank of each word, or -1.  (Of words that meet in a slot, the most frequent is known.)"""
        if not len(self.hashes):
            return np.full(len(hashes), -1, np.int32)
        shift = np.uint64(64 - _SLOTS)
        if self._slots is None:
            self._slots = np.full(1 << _SLOTS, -1, np.int32)
            self._slots[(self.hashes >> shift).astype(np.int64)[::-1]] = np.arange(len(self.hashes), dtype=np.int32)[::-1]
        rank = self._slots[(hashes >> shift).astype(np.int64)]
        return np.where((rank >= 0) & (self.hashes[rank] == hashes), rank, np.int32(-1))

    def classes(self, rank: np.ndarray, endings: np.ndarray) -> np.ndarray:
        return np.where((rank >= 0) & (rank < SINGLE), rank, SINGLE + endings % (CLASSES - SINGLE)).astype(np.uint8)

    def inputs(self, rank: np.ndarray, endings: np.ndarray) -> np.ndarray:
        return np.where((rank >= 0) & (rank < INPUT_WORDS), rank, INPUT_WORDS + endings % ENDINGS).astype(np.int16)

    def log_total(self) -> np.ndarray:
        """Log of each class's mass, with half a count for each of its words and for the unseen."""
        return np.log(self.mass + HALF * (self.kinds + 1.0))

    def log_shares(self) -> np.ndarray:
        """Log share of each known word in its class."""
        of = self.classes(np.arange(len(self.hashes)), self.endings)
        return (np.log(self.counts + HALF) - self.log_total()[of]).astype(np.float32)


def count_words(docs: DataFrame) -> DataFrame:
    """(word, ending, n): how often each word (by 64 bits of hash) occurs in all documents; written."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def counted() -> pa.RecordBatch:
            hashes, endings = (np.concatenate([h[k] for h in held]) for k in range(2))
            which, words = pd.factorize(hashes)
            ending = np.zeros(len(words), np.int32)
            ending[which] = endings
            return pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(ending), pa.array(np.bincount(which, minlength=len(words)))],
                                              names=["word", "ending", "n"])

        for batch in pieces(batches, 256):
            for text in batch.column(0).to_pylist():
                if text:
                    held.append(WordHasher.get().words_and_endings(text))
                    n += len(held[-1][0])
                    if n >= _BUFFER:
                        yield counted()
                        held, n = [], 0
        if n:
            yield counted()

    counts = docs.select("text").mapInArrow(run, "word long, ending int, n long")
    return written(counts.groupBy("word").agg(F.min("ending").alias("ending"), F.sum("n").alias("n")), "word-counts")


def vocabulary_of(counts: DataFrame, known: int = KNOWN) -> Vocabulary:
    """The known words are those above the least count that ``known`` words at most reach; equal counts are in or out
    together.  A row for each different count, each class and each known word goes to the driver."""
    sizes = sorted(((r["n"], r["words"]) for r in counts.groupBy("n").agg(F.count("*").alias("words")).collect()), reverse=True)
    total, least = 0, None
    for n, words in sizes:
        total += words
        if total > known:
            break
        least = n
    if least is None:
        least = sizes[0][0] + 1 if sizes else 1
    top = counts.where(F.col("n") >= least).toPandas().sort_values(["n", "word"], ascending=[False, True])
    hashes, endings, n = top["word"].to_numpy(np.int64).view(np.uint64), top["ending"].to_numpy(np.int32), top["n"].to_numpy(np.int64)
    mass, kinds = np.zeros(CLASSES), np.zeros(CLASSES)
    of = (F.lit(SINGLE) + F.col("ending") % (CLASSES - SINGLE)).alias("class")
    for r in counts.groupBy(of).agg(F.sum("n").alias("n"), F.count("*").alias("words")).collect():
        mass[r["class"]], kinds[r["class"]] = r["n"], r["words"]
    own = SINGLE + endings[:SINGLE] % (CLASSES - SINGLE)
    np.subtract.at(mass, own, n[:SINGLE])
    np.subtract.at(kinds, own, 1)
    mass[:len(n[:SINGLE])], kinds[:len(n[:SINGLE])] = n[:SINGLE], 1
    return Vocabulary(hashes, n, endings, mass, kinds, least)


def start_weights(vocabulary: Vocabulary, seed: int = 5) -> dict[str, np.ndarray]:
    """Small random weights; the output biases are each group's and class's log share of the corpus."""
    rng = np.random.default_rng(seed)
    weights = {k: (rng.standard_normal(s) * (0.3 if k == "embed" else WIDTH * DIM if k == "mid" else HIDDEN) ** (1 if k == "embed" else -0.5))
               .astype(np.float32) for k, s in SHAPES.items()}
    mass = (vocabulary.mass + HALF * (vocabulary.kinds + 1)).reshape(GROUPS, GROUP)
    weights["mid_bias"][:] = 0
    weights["top"] *= 0.1
    weights["low"] *= 0.1
    weights["top_bias"][:] = np.log(mass.sum(axis=1) / mass.sum())
    weights["low_bias"][:] = np.log(mass / mass.sum(axis=1, keepdims=True))
    return weights


def windows(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(padded input rows of all texts, places of their words in it).

    ``SIDE`` boundary marks stand before, between and after the texts, so every word has its window.
    """
    counts = np.array([len(t) for t in texts], np.int64)
    total = int(counts.sum())
    at = np.arange(total) + SIDE * (1 + np.repeat(np.arange(len(texts)), counts))
    rows = np.full(total + SIDE * (len(texts) + 1), EDGE, np.int16)
    if total:
        rows[at] = np.concatenate(texts)
    return rows, at


_OFFSETS = np.array([o for o in range(-SIDE, SIDE + 1) if o])


def _turned(logits: np.ndarray) -> np.ndarray:
    """(16 x rows): ``logits`` less the largest of their row.  Reductions over 16 numbers, row by row, take several times as long."""
    turned = np.ascontiguousarray(logits.T)
    turned -= turned.max(axis=0)
    return turned


def _total(turned: np.ndarray) -> np.ndarray:
    """Sums of the columns of 16 numbers, in pairs."""
    while len(turned) > 1:
        half = len(turned) // 2
        turned = turned[:half] + turned[half:] if half == GROUP // 2 else turned[::2] + turned[1::2]
    return turned[0]


def _softmax(logits: np.ndarray) -> np.ndarray:
    turned = _turned(logits)
    np.exp(turned, out=turned)
    turned /= _total(turned)
    return np.ascontiguousarray(turned.T)


def _low_logits(w: dict[str, np.ndarray], h: np.ndarray, cell: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """Logits within each row's own group, ``cell % GROUPS``, and (group, first row, end) of the cells that occur; rows go by cell."""
    cuts = np.searchsorted(cell, np.arange(int(cell[-1]) + 2)).tolist()
    spans = [(c % GROUPS, a, b) for c, (a, b) in enumerate(zip(cuts, cuts[1:])) if a < b]
    logits = np.empty((len(h), GROUP), h.dtype)
    for g, a, b in spans:
        np.matmul(h[a:b], w["low"][g], out=logits[a:b])
    logits += np.take(w["low_bias"], cell % GROUPS, axis=0)
    return logits, spans


def gradients(w: dict[str, np.ndarray], x: np.ndarray, y: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
    """Gradients of the mean negative log-probability of classes ``y`` after contexts ``x``: by name, and of the
    ``embed`` rows that occur.  A class's group alone is computed, so rows go by class."""
    order = np.argsort(y, kind="stable")
    x, y = x[order], y[order]
    n, group, of = len(y), y // GROUP, y % GROUP
    e = np.take(w["embed"], x, axis=0).reshape(n, WIDTH * DIM)
    h = e @ w["mid"]
    h += w["mid_bias"]
    np.maximum(h, 0, out=h)
    scale = h.dtype.type(1 / n)
    top = _softmax(h @ w["top"] + w["top_bias"])
    top[np.arange(n), group] -= 1
    top *= scale
    back = top @ w["top"].T
    low, low_bias = np.zeros_like(w["low"]), np.zeros_like(w["low_bias"])
    logits, spans = _low_logits(w, h, group)
    own = _softmax(logits)
    own[np.arange(n), of] -= 1
    own *= scale
    for g, a, b in spans:
        delta = own[a:b]
        low[g], low_bias[g] = h[a:b].T @ delta, delta.sum(axis=0)
        back[a:b] += delta @ w["low"][g].T
    back *= h > 0
    flat, each = x.ravel(), (back @ w["mid"].T).reshape(n * WIDTH, DIM)
    by_row = np.argsort(flat, kind="stable")
    ranked = flat[by_row]
    first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    dense = {"top": h.T @ top, "top_bias": top.sum(axis=0), "low": low, "low_bias": low_bias, "mid": e.T @ back, "mid_bias": back.sum(axis=0)}
    return dense, ranked[first], np.add.reduceat(np.take(each, by_row, axis=0), first, axis=0)


class Trainer:
    """Adagrad on minibatches of windows; a row of ``embed`` has one step size."""

    def __init__(self, weights: dict[str, np.ndarray], rate: float, batch: int):
        self.w = {k: v.copy() for k, v in weights.items()}
        self.sums = {k: np.full(v.shape[:1] if k == "embed" else v.shape, 1e-2, np.float32) for k, v in weights.items()}
        self.rate, self.batch, self.seen = rate, batch, 0

    def learn(self, contexts: np.ndarray, targets: np.ndarray) -> None:
        for low in range(0, len(targets), self.batch):
            dense, rows, embed = gradients(self.w, contexts[low:low + self.batch], targets[low:low + self.batch])
            for name, grad in dense.items():
                s = self.sums[name]
                s += grad * grad
                self.w[name] -= self.rate * grad / np.sqrt(s)
            s = self.sums["embed"][rows] + np.einsum("ij,ij->i", embed, embed) / DIM
            self.sums["embed"][rows] = s
            self.w["embed"][rows] -= embed * (self.rate / np.sqrt(s))[:, None]
            self.seen += len(targets[low:low + self.batch])


class Scorer:
    """Log-probabilities of classes; the products of embeddings and each place's weights are made once."""

    CHUNK, PRODUCT = 1 << 12, 1 << 10  # words at once, and in one product, whose layers stay in a core's cache

    def __init__(self, weights: dict[str, np.ndarray]):
        mid = weights["mid"].reshape(WIDTH, DIM, HIDDEN)
        self.tables = [np.ascontiguousarray(weights["embed"] @ mid[k]) for k in range(WIDTH)]
        self.w = weights

    def log_probs(self, texts: list[np.ndarray], classes: np.ndarray) -> np.ndarray:
        """Of the class of each word of all texts (input rows), in order."""
        rows, at = windows(texts)
        out = np.empty(len(at), np.float32)
        for low in range(0, len(at), self.CHUNK):
            target = classes[low:low + self.CHUNK]
            key = (np.arange(len(target)) // self.PRODUCT * CLASSES + target).astype(np.uint16)
            order = np.argsort(key, kind="stable")
            here, cell, of = at[low:low + self.CHUNK][order], key[order] // GROUP, key[order] % GROUP
            h = np.take(self.tables[0], rows[here + _OFFSETS[0]], axis=0)
            for table, o in zip(self.tables[1:], _OFFSETS[1:]):
                h += np.take(table, rows[here + o], axis=0)
            h += self.w["mid_bias"]
            np.maximum(h, 0, out=h)
            top = np.concatenate([h[a:a + self.PRODUCT] @ self.w["top"] for a in range(0, len(h), self.PRODUCT)])
            found = self._own(top + self.w["top_bias"], cell % GROUPS)
            found += self._own(_low_logits(self.w, h, cell)[0], of)
            out[low + order] = found
        return out

    @staticmethod
    def _own(logits: np.ndarray, target: np.ndarray) -> np.ndarray:
        turned = _turned(logits)
        own = turned[target, np.arange(len(target))]
        return own - np.log(_total(np.exp(turned, out=turned)))


_PART = 1 << 14


def _flat(weights: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([weights[k].ravel() for k in SHAPES])


def _shaped(flat: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k, shape in SHAPES.items():
        n = int(np.prod(shape))
        out[k] = flat[at:at + n].reshape(shape).astype(np.float32)
        at += n
    return out


def numbered(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(inputs, classes) of every document with words: two bytes and one for each of them."""
    shipped = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shipped.value
        for batch in pieces(batches, 1024):
            found = [f for t in batch.column(0).to_pylist() if t and len((f := WordHasher.get().words_and_endings(t))[0])]
            if found:
                hashes, endings = (np.concatenate([f[k] for f in found]) for k in range(2))
                rank, ends = vocabulary.known(hashes), np.cumsum([len(f[0]) for f in found])[:-1]
                cols = (np.split(a, ends) for a in (vocabulary.inputs(rank, endings), vocabulary.classes(rank, endings)))
                yield pa.RecordBatch.from_arrays([pa.array([a.tobytes() for a in c], pa.binary()) for c in cols], names=["inputs", "classes"])

    return docs.select("text").mapInArrow(run, "inputs binary, classes binary")


def train_round(rows: DataFrame, weights: dict[str, np.ndarray], stride: int, offset: int, rate: float, batch: int) -> dict[str, np.ndarray]:
    """Weights after every task's steps on its documents (``numbered``), averaged by windows."""
    shipped = rows.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer = Trainer(shipped.value, rate, batch)
        task = TaskContext.get().partitionId()
        order = np.random.default_rng([task, offset])
        for piece in pieces(batches, 1024):
            padded, at = windows([np.frombuffer(b, np.int16) for b in piece.column(0).to_pylist()])
            classes = np.frombuffer(b"".join(piece.column(1).to_pylist()), np.uint8)
            picked = order.permutation(np.arange(offset, len(at), stride))
            if len(picked):
                trainer.learn(padded[at[picked][:, None] + _OFFSETS], classes[picked])
        if trainer.seen:
            flat = _flat(trainer.w).astype(np.float64) * trainer.seen
            cuts = range(0, len(flat), _PART)
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(cuts)), pa.int32()), pa.array([task // FAN] * len(cuts), pa.int32()),
                 pa.array([float(trainer.seen)] * len(cuts)), pa.array([flat[c:c + _PART].tobytes() for c in cuts], pa.binary())],
                names=["part", "salt", "windows", "sums"])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(b, "<f8") for b in pdf["sums"]], axis=0).tobytes()
        return pd.DataFrame({"part": pdf["part"].iloc[:1], "salt": pdf["salt"].iloc[:1] // FAN, "windows": [pdf["windows"].sum()], "sums": [total]})

    kind = "part int, salt int, windows double, sums binary"
    sums = rows.select("inputs", "classes").mapInArrow(run, kind)
    for _ in range(max(1, math.ceil(math.log(max(2, rows.rdd.getNumPartitions()), FAN)))):  # FAN tasks a group, then FAN of those
        sums = sums.groupBy("part", "salt").applyInPandas(add, kind)
    found = sorted(sums.collect(), key=lambda r: r["part"])  # one set of weights
    if not found:
        return weights
    return _shaped(np.concatenate([np.frombuffer(r["sums"], "<f8") / r["windows"] for r in found]))


@dataclass
class Model:
    weights: dict[str, np.ndarray]
    vocabulary: Vocabulary
    counts: DataFrame  # (word, ending, n)


def train(docs: DataFrame, rounds: int = 2, stride: int = 2, rate: float = 0.3, batch: int = 1024) -> Model:
    counts = count_words(docs)
    vocabulary = vocabulary_of(counts)
    weights, rows = start_weights(vocabulary), written(numbered(docs, vocabulary), "numbered-words")
    for k in range(rounds):
        weights = train_round(rows, weights, stride, k * stride // rounds, rate, batch)
    return Model(weights, vocabulary, counts)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, n_words, log_prob, mean_log_prob) of every row."""
    shipped = docs.sparkSession.sparkContext.broadcast((model.weights, model.vocabulary))
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, vocabulary = shipped.value
        scorer, shares, totals = Scorer(weights), vocabulary.log_shares(), vocabulary.log_total()
        for batch in pieces(batches, 512):
            found = [WordHasher.get().words_and_endings(t or "") for t in batch.column(2).to_pylist()]
            n = np.array([len(h) for h, _ in found], np.int64)
            hashes, endings = (np.concatenate([f[k] for f in found]) for k in range(2))
            rank = vocabulary.known(hashes)
            classes, inputs = vocabulary.classes(rank, endings), vocabulary.inputs(rank, endings)
            ends = np.cumsum(n)
            log_p = scorer.log_probs(np.split(inputs, ends[:-1]), classes).astype(np.float64)
            # A word that isn't at hand: its class's mass here, its own count by the join.
            rare = rank < 0
            log_p += np.where(rare, -totals[classes], shares[rank] if len(shares) else 0.0)
            sums = np.concatenate([[0.0], np.cumsum(log_p)])
            doc, at = np.repeat(np.arange(len(n)), n)[rare], hashes[rare].view(np.int64)
            order = np.lexsort((at, doc))
            doc, at = doc[order], at[order]
            first = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (at[1:] != at[:-1])]) if len(doc) else np.zeros(0, np.int64)
            times = np.diff(np.r_[first, len(doc)])
            key, none = batch.column(0), pa.nulls(len(first), pa.int64())
            yield pa.RecordBatch.from_arrays([key, batch.column(1), pa.array(n), pa.array(sums[ends] - sums[ends - n]), pa.nulls(len(n), pa.int64()),
                                              pa.nulls(len(n), pa.int64())], names=["key", "doc_id", "n_words", "log_prob", "word", "times"])
            if len(first):
                yield pa.RecordBatch.from_arrays([key.take(pa.array(doc[first])), pa.nulls(len(first), batch.column(1).type), none,
                                                  pa.nulls(len(first), pa.float64()), pa.array(at[first]), pa.array(times)],
                                                 names=["key", "doc_id", "n_words", "log_prob", "word", "times"])

    keyed = docs.select(F.monotonically_increasing_id().alias("key"), "doc_id", "text")
    made = written(keyed.mapInArrow(run, f"key long, doc_id {id_type}, n_words long, log_prob double, word long, times long"), "scored")
    others = model.counts.where(F.col("n") <= _largest_rare(model.vocabulary)).select("word", "n")
    rare = made.where("word IS NOT NULL").select("key", "word", "times").join(others, "word", "left")
    added = rare.groupBy("key").agg(F.sum(F.col("times") * F.log(F.coalesce("n", F.lit(0)) + F.lit(HALF))).alias("added"))
    rows = made.where("n_words IS NOT NULL").select("key", "doc_id", "n_words", "log_prob").join(added, "key", "left")
    total = F.col("log_prob") + F.coalesce("added", F.lit(0.0))
    return rows.select("doc_id", "n_words", total.alias("log_prob"), F.when(F.col("n_words") > 0, total / F.col("n_words")).alias("mean_log_prob"))


def _largest_rare(vocabulary: Vocabulary) -> int:
    """The largest count of a word that tasks don't have at hand: below the least known count, but for words that lost their slot."""
    lost = vocabulary.known(vocabulary.hashes) < 0
    return int(max(vocabulary.least - 1, vocabulary.counts[lost].max(initial=0)))
