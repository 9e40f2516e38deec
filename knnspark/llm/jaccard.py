"""Join of near duplicates by the Jaccard similarity of word 5-grams: chosen-path search, exact links.

1. Every text becomes its set of shingles (hashes of ``words`` neighbouring words), embedded as ``T``
   MinHash tokens, two sets sharing each with a chance of their similarity.  Its sketch keeps 8 bits of
   each.  Equal texts are one node from here on, with their number.
2. Chosen paths: at the root of each run, some of the T places are sampled, and for each another ``ROOT`` - 1;
   a node goes down one branch for each, named by these places and its whole tokens there.  Sets that share the
   sampled tokens meet in a bucket (taking the first ``ROOT`` levels at once keeps sets apart that share no more than
   a common passage, and no node is written for the levels between).  A bucket with no more than ``PAIRS`` pairs of different labels to compare (and ``ROWS`` nodes) is brute-forced on the
   sketches.  In a larger one, the nodes close to its smallest node (the leader) are joined to it and take its label.
   The first ``ALONE`` runs go one before the other; each component of what they have joined has one label from there on, as
   equal labels mean connected nodes: a bucket with one label is done, as its nodes are connected (a family of near copies ends here, with
   a row a node).  Other large buckets are split again the same way, with places sampled anew for each
   bucket; what is still large after ``DEPTH`` levels is brute-forced block by block.  Runs are repeated
   until a pair at the threshold has met with a chance of ``recall``, even if its buckets go down
   ``DEPTH`` levels.
3. Pairs whose sketches agree (with four standard deviations to spare) connect candidate
   components.  Inside each component, all pairs are compared exactly on whole sets, in blocks of
   about ``BLOCK`` nodes and ``BLOCK_SHINGLES`` shingles; blocks give each node's sum of links and a spanning forest, never a row
   for a pair.  So a pair that the search missed is still found if its component is.
4. The components of the exact links are the classes.

Result: a row for each document with class_id (the smallest document id of its class) and n_links (how
many other documents are at least as similar as the threshold, copies included).

Defined results: null text is empty; a text without words has no shingles and is only linked to equal
texts; a text of fewer than five words is one shingle; words are lower-cased runs of letters, digits
and underscores; repeated rows and repeated ids count as documents; null ids are never a class_id unless
the whole class has none; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from knnspark.llm.common import pieces, unused, whole_groups, written
from knnspark.llm.components import components
from knnspark.llm.words import BASE, WordHasher, mix

WORDS, SIMILARITY = 5, 0.8
T, LIMIT, ROOT, DEPTH, ALONE, RECALL = 128, 1024, 2, 3, 1, 0.9999
PAIRS, ROWS = LIMIT * LIMIT, 16 * LIMIT  # of a small bucket at most: pairs to compare, nodes
BLOCK, BLOCK_SHINGLES = 1024, 1 << 22


class Shingler:
    """Shingle sets and sketches; one for each Python worker."""

    _one: "Shingler | None" = None

    def __init__(self):
        self.words = WordHasher.get().words
        rng = np.random.default_rng(20)
        self.a = (rng.integers(0, 1 << 32, T, dtype=np.uint32) | np.uint32(1))[:, None]
        self.b = rng.integers(0, 1 << 32, T, dtype=np.uint32)[:, None]

    @classmethod
    def get(cls) -> "Shingler":
        cls._one = cls._one or cls()
        return cls._one

    def shingles(self, text: str, n: int = WORDS) -> np.ndarray:
        """Sorted distinct shingle hashes."""
        words = self.words(text)
        if not len(words):
            return words
        n = min(n, len(words))
        out = np.zeros(len(words) - n + 1, np.uint64)
        for k in range(n):
            out = out * np.uint64(BASE) + words[k:len(words) - n + 1 + k]
        return np.unique(mix(out))

    def tokens(self, shingles: np.ndarray) -> np.ndarray:
        """T MinHash tokens of 32 bits."""
        least = np.full(T, 0xFFFFFFFF, np.uint32)
        x = (shingles >> np.uint64(32)).astype(np.uint32)
        for at in range(0, len(x), 2048):
            np.minimum(least, (self.a * x[None, at:at + 2048] + self.b).min(axis=1), out=least)
        return (mix(least.astype(np.uint64)) >> np.uint64(32)).astype(np.uint32)

    def sketch(self, shingles: np.ndarray) -> np.ndarray:
        """8 bits of each token."""
        return (self.tokens(shingles) & np.uint32(0xFF)).astype(np.uint8)


def keyed(docs: DataFrame) -> DataFrame:
    """(k1, k2, doc_id, text): 128 bits of hash name equal texts."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.xxhash64(text).alias("k1"), F.xxhash64(text, F.lit(1)).alias("k2"), "doc_id", text.alias("text"))


def sketched(docs: DataFrame, runs: int, similarity: float) -> DataFrame:
    """(k1, k2, doc_id, n, sketch, paths) of every row: n is the number of distinct shingles, paths are
    the branches of all runs' roots, run by run."""
    roots = [(r, place) for r in range(1, 1 + runs) for place in sampled_places(r, similarity)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler.get()
        for batch in pieces(batches, 1024):
            sets = [shingler.shingles(t) for t in batch.column(3).to_pylist()]
            tokens = np.stack([shingler.tokens(s) for s in sets]) if sets else np.zeros((0, T), np.uint32)
            paths = np.stack([_root_path(r, int(place), tokens) for r, place in roots], axis=1)
            offsets = pa.array(np.arange(0, paths.size + 1, len(roots), dtype=np.int32))
            sketches = (tokens & np.uint32(0xFF)).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array([len(s) for s in sets], pa.int32()), pa.array([s.tobytes() for s in sketches], pa.binary()),
                 pa.ListArray.from_arrays(offsets, pa.array(paths.ravel()))], names=["k1", "k2", "doc_id", "n", "sketch", "paths"])

    return keyed(docs).mapInArrow(run, "k1 long, k2 long, doc_id long, n int, sketch binary, paths array<bigint>")


def runs_for(recall: float, similarity: float, depth: int = DEPTH) -> int:
    """Runs after which a pair at the threshold has met: at each level at least one place is sampled, and
    the pair shares its token with a chance of ``similarity``."""
    return math.ceil(math.log(1 - recall) / math.log(1 - similarity**depth))


def sampled_places(node: int, similarity: float) -> np.ndarray:
    """The places that a node of the search tree splits on: each with a chance of 1 / (similarity * T)."""
    rng = np.random.default_rng(node & 0xFFFFFFFFFFFFFFFF)
    places = np.flatnonzero(rng.random(T) < 1 / (similarity * T))
    return places if len(places) else rng.integers(T, size=1)


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), np.uint8).reshape(len(values), T)


def _branch(node: int, place: int, tokens: np.ndarray) -> np.ndarray:
    seed = np.uint64(((node & 0xFFFFFFFFFFFFFFFF) * BASE + place + 1) & 0xFFFFFFFFFFFFFFFF)
    return mix(mix(np.full(len(tokens), seed)) + tokens.astype(np.uint64)).view(np.int64)


def _root_path(run: int, place: int, tokens: np.ndarray) -> np.ndarray:
    """The path of each row (T tokens) that begins at ``place`` and goes through ``ROOT`` places."""
    path = _branch(run, place, tokens[:, place])
    others = [k for k in range(T) if k != place]
    for k in np.random.default_rng([run, place]).choice(others, ROOT - 1, replace=False):
        path = mix(path.view(np.uint64) + mix(tokens[:, k].astype(np.uint64) + np.uint64(BASE))).view(np.int64)
    return path


def _paths(rows: DataFrame) -> DataFrame:
    """(path, k1, k2, label): the branch of each row's node at the one place sampled for its bucket, by the
    sketch's 8 bits of the token.

    ``rows``: (path, k1, k2, label, sketch).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 8192):
            sketches, nodes = _matrix(batch.column(4)), batch.column(0).to_numpy()
            rest = [c.to_numpy() for c in batch.columns[1:4]]
            for node in np.unique(nodes).tolist():
                which = nodes == node
                place = int(np.random.default_rng(node & 0xFFFFFFFFFFFFFFFF).integers(T))
                path = _branch(node, place, sketches[which, place])
                yield pa.RecordBatch.from_arrays([pa.array(path), *(pa.array(c[which]) for c in rest)],
                                                 names=["path", "k1", "k2", "label"])

    return rows.select("path", "k1", "k2", "label", "sketch").mapInArrow(run, "path long, k1 long, k2 long, label long")


def _least_agreement(similarity: float) -> int:
    """Places in which two sketches agree at least, four standard deviations under the expected number."""
    return math.floor((similarity - 4 * math.sqrt(similarity * (1 - similarity) / T)) * T)


def _led(large: DataFrame, similarity: float) -> DataFrame:
    """``large`` (path, k1, k2, label, sketch, size) with (b1, b2) the leader of the bucket where the node
    is close to it and isn't yet connected to it, and the leader's label then."""
    leaders = large.groupBy("path").agg(F.min(F.struct("k1", "k2", "label", "sketch")).alias("lead"))
    joined = large.join(leaders, "path").select("path", "k1", "k2", "label", "sketch", "size", F.col("lead.k1").alias("b1"),
                                                F.col("lead.k2").alias("b2"), F.col("lead.label").alias("l"), F.col("lead.sketch").alias("s"))
    least = _least_agreement(similarity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 4096):
            label, theirs = batch.column(3).to_numpy(), batch.column(8).to_numpy()
            close = (_matrix(batch.column(4)) == _matrix(batch.column(9))).sum(axis=1) >= least
            close &= label != theirs
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(np.where(close, theirs, label)), *batch.columns[4:6],
                 *(pa.array(batch.column(k).to_numpy(), mask=~close) for k in (6, 7))],
                names=["path", "k1", "k2", "label", "sketch", "size", "b1", "b2"])

    return joined.mapInArrow(run, "path long, k1 long, k2 long, label long, sketch binary, size long, b1 long, b2 long")


class Forest:
    """Union-find over the rows of one group."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def root(self, a: int) -> int:
        parent = self.parent
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    def link(self, pairs: np.ndarray) -> None:
        for a, b in pairs.tolist():
            x, y = self.root(a), self.root(b)
            if x != y:
                self.parent[max(x, y)] = min(x, y)

    def stars(self) -> list[tuple[int, int]]:
        """(row, first row of its tree) for all other rows of a tree."""
        return [(a, r) for a in range(len(self.parent)) if (r := self.root(a)) != a]


def _close(left: np.ndarray, right: np.ndarray, least: int) -> np.ndarray:
    """Pairs of rows (left, len(left) + right) whose sketches agree in ``least`` places."""
    found = []
    for k in range(len(left)):
        hits = np.flatnonzero((right == left[k]).sum(axis=1) >= least)
        if len(hits):
            found.append(np.stack([np.full(len(hits), k), hits + len(left)], axis=1))
    return np.concatenate(found) if found else np.zeros((0, 2), np.int64)


def _across(sketches: np.ndarray, which: np.ndarray, most: int, least: int) -> np.ndarray:
    """Pairs of different labels (numbers ``which``) that have rows whose sketches agree in ``least`` places.  Rows of
    the commonest label, ``most``, are only compared with those of others."""
    found = []
    for k in np.flatnonzero(which != most).tolist():
        other = which[(which != which[k]) & ((sketches == sketches[k]).sum(axis=1) >= least)]
        if len(other):
            found.append(np.stack([np.full(len(other), which[k]), other], axis=1))
    return np.concatenate(found) if found else np.zeros((0, 2), np.int64)


def _bucket_edges(members: DataFrame, similarity: float) -> DataFrame:
    """Candidate edges inside groups: ``members`` (path, part, side, k1, k2, label, sketch); the sides of a
    part are compared with each other, or side 0 with itself if it has no side 1.  Nodes of one label
    are connected already, so only nodes of different labels are compared, and there is an edge for each label that joins another."""
    least = _least_agreement(similarity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, starts in whole_groups(batches, 2):
            side = rows.column(2).to_numpy()
            keys = np.stack([rows.column(3).to_numpy(), rows.column(4).to_numpy()], axis=1)
            label, sketches = rows.column(5).to_numpy(), _matrix(rows.column(6))
            out = []
            for start, end in zip(starts[:-1], starts[1:]):
                if end - start < 2:
                    continue
                split = start + int((side[start:end] == 0).sum())
                _, first, which, counts = np.unique(label[start:end], return_index=True, return_inverse=True, return_counts=True)
                if split < end:
                    pairs = which[_close(sketches[start:split], sketches[split:end], least)]
                    pairs = pairs[pairs[:, 0] != pairs[:, 1]]
                else:
                    pairs = _across(sketches[start:end], which, int(counts.argmax()), least)
                forest = Forest(len(first))
                forest.link(np.unique(pairs, axis=0))
                out += [(start + first[a], start + first[b]) for a, b in forest.stars()]
            if out:
                at = np.array(out)
                cols = [keys[at[:, 0], 0], keys[at[:, 0], 1], keys[at[:, 1], 0], keys[at[:, 1], 1]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["a1", "a2", "b1", "b2"])

    dealt = members.select("path", "part", "side", "k1", "k2", "label", "sketch").repartition("path", "part") \
        .sortWithinPartitions("path", "part", "side", "k1", "k2")
    return dealt.mapInArrow(run, "a1 long, a2 long, b1 long, b2 long")


def _in_blocks(df: DataFrame, block: str, blocks: str) -> DataFrame:
    """Rows once for each pair of blocks that theirs is in: columns part and side."""
    other = F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))
    low, high = F.least(block, "__other"), F.greatest(block, "__other")
    return df.withColumn("__other", other).withColumn("part", (low * F.col(blocks) + high).cast("long")) \
        .withColumn("side", (F.col(block) > low).cast("int")).drop("__other")


def candidate_edges(nodes: DataFrame, similarity: float, runs: int) -> DataFrame:
    """(a, b): pairs of nodes that connect every bucket's pairs of close sketches.

    ``nodes``: (k1, k2, sketch, paths), one row a node.
    """
    def still_open(rows: DataFrame) -> DataFrame:
        # A bucket's size, and the pairs in it that are of different labels, which are those left to compare.
        counts = rows.groupBy("path", "label").agg(F.count("*").alias("n"))
        sizes = counts.groupBy("path").agg(F.sum("n").alias("size"), F.sum(F.col("n") * F.col("n")).alias("same"))
        left = ((F.col("size") * F.col("size") - F.col("same")) / 2).cast("long").alias("pairs")
        return rows.drop("size", "pairs").join(sizes.select("path", "size", left).where("pairs > 0"), "path")

    found: list[DataFrame] = []

    def descend(paths: DataFrame, name: str) -> None:
        """Collects the edges of all buckets below ``paths``."""
        for level in range(ROOT, DEPTH + 1):
            members = written(still_open(paths).join(nodes.select("k1", "k2", "sketch"), ["k1", "k2"]), f"paths-{name}-{level}")
            is_small = (F.col("pairs") <= PAIRS) & (F.col("size") <= ROWS)
            small = members.where(is_small)
            found.append(_bucket_edges(small.withColumns({"part": F.lit(0).cast("long"), "side": F.lit(0)}), similarity))
            large = members.where(~is_small)
            if large.isEmpty():
                return
            rows = written(_led(large, similarity), f"led-{name}-{level}")
            found.append(rows.where("b1 IS NOT NULL").select(F.col("k1").alias("a1"), F.col("k2").alias("a2"), "b1", "b2"))
            rows = still_open(rows)  # what the leader joined to one label is done
            if level == DEPTH:
                break
            paths = written(_paths(rows), f"down-{name}-{level}")  # read twice: for the sizes and the rows
        dense = rows.withColumn("blocks", F.ceil(F.col("size") / LIMIT)).withColumn("block", F.pmod(F.xxhash64("k2"), F.col("blocks")))
        found.append(_bucket_edges(_in_blocks(dense, "block", "blocks"), similarity))

    labels, low = None, 0
    for k, high in enumerate(_stages(runs, similarity)):
        own = nodes.select("k1", "k2", F.slice("paths", low + 1, high - low).alias("paths"), F.col("k1").alias("label"))
        if labels is not None:
            own = own.join(labels, ["k1", "k2"], "left").withColumn("label", F.coalesce("new", "label"))
        descend(own.select(F.explode("paths").alias("path"), "k1", "k2", "label"), str(k))
        low = high
        if k < ALONE:
            found = [written(reduce(DataFrame.unionAll, found).distinct(), f"edges-{k}")]
            # What is connected by now, over any number of edges, has one label in the runs that follow.
            labels = components(_edges(found[0]), f"labels-{k}").select("node.k1", "node.k2", F.col("root.k1").alias("new"))
    return _edges(reduce(DataFrame.unionAll, found))


def _stages(runs: int, similarity: float) -> list[int]:
    """Ends of the paths of each of the first ``ALONE`` runs, and of all."""
    ends = np.cumsum([len(sampled_places(r, similarity)) for r in range(1, 1 + runs)]).tolist()
    return [*ends[:ALONE], *ends[ALONE:][-1:]]


def _edges(pairs: DataFrame) -> DataFrame:
    """(a, b) of (a1, a2, b1, b2)."""
    return pairs.select(F.struct(F.col("a1").alias("k1"), F.col("a2").alias("k2")).alias("a"),
                        F.struct(F.col("b1").alias("k1"), F.col("b2").alias("k2")).alias("b"))


def _intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs of sorted sets."""
    n = len(sets)
    if n == 2:
        both = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return np.array([[len(sets[0]), both], [both, len(sets[1])]])
    tokens, at, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(n), [len(s) for s in sets])
    shared = counts > 1
    place = np.cumsum(shared) - 1
    use = shared[at]
    row, column = row[use], place[at[use]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out = np.zeros((n, n), np.float32)
    total, width = int(shared.sum()), max(256, (1 << 22) // n)
    for low in range(0, total, width):
        a, b = np.searchsorted(column, [low, low + width])
        dense = np.zeros((n, min(width, total - low)), np.float32)
        dense[row[a:b], column[a:b] - low] = 1
        out += dense @ dense.T
    return out.astype(np.int64)


def exact_links(sets: DataFrame, similarity: float) -> DataFrame:
    """(k1, k2, links, b1, b2): sums of linked documents for nodes, and edges (b1, b2 not null).

    ``sets``: (root, part, side, k1, k2, size, shingles) with sizes in documents.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, starts in whole_groups(batches, 3):
            side, size = rows.column(3).to_numpy(), rows.column(6).to_numpy()
            k1, k2 = rows.column(4).to_numpy(), rows.column(5).to_numpy()
            for start, end in zip(starts[:-1], starts[1:]):
                keys = np.stack([k1[start:end], k2[start:end]], axis=1)
                _, one = np.unique(keys, axis=0, return_index=True)  # a document that is there twice is one node
                one = start + np.sort(one)
                if len(one) < 2:
                    continue
                sets_ = [np.frombuffer(rows.column(7)[int(k)].as_py(), "<u8") for k in one]
                both = _intersections(sets_)
                n = np.array([len(s) for s in sets_])
                linked = both >= similarity * (n[:, None] + n[None, :] - both) - 1e-9
                np.fill_diagonal(linked, False)
                s = side[one]
                if s.any():
                    linked &= s[:, None] != s[None, :]
                links = linked @ size[one]
                forest = Forest(len(one))
                forest.link(np.argwhere(np.triu(linked)))
                # A row for each node with a link: its sum, and the first node of its tree if that is another.
                some = np.flatnonzero(links)
                root = np.array([forest.root(int(a)) for a in some], dtype=np.int64)
                other = one[root]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(k1[one[some]]), pa.array(k2[one[some]]), pa.array(links[some]),
                     *(pa.array(k[other], mask=root == some) for k in (k1, k2))], names=["k1", "k2", "links", "b1", "b2"])

    dealt = sets.select("r1", "r2", "part", "side", "k1", "k2", "size", "shingles").repartition("r1", "r2", "part") \
        .sortWithinPartitions("r1", "r2", "part", "side", "k1", "k2")
    return dealt.mapInArrow(run, "k1 long, k2 long, links long, b1 long, b2 long")


def _with_sets(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """``chosen`` (k1, k2, rep_id, ...) with ``shingles``, from the one document that stands for the node."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler.get()
        for batch in pieces(batches, 1024):
            sets = [shingler.shingles(t).astype("<u8").tobytes() for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(sets, pa.binary())], names=[*batch.schema.names[1:], "shingles"])

    own = [c for c in chosen.columns if c != "rep_id"]
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in chosen.schema if f.name != "rep_id")
    texts = keyed(docs).alias("t").join(
        chosen.alias("c").hint("shuffle_hash"),
        (F.col("t.k1") == F.col("c.k1")) & (F.col("t.k2") == F.col("c.k2")) & F.col("t.doc_id").eqNullSafe(F.col("c.rep_id")))
    return texts.select("t.text", *(F.col(f"c.{c}") for c in own)).mapInArrow(run, kinds + ", shingles binary")


def classes(docs: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """(k1, k2, doc_id, class_id, class_key, n_links) of every row; (k1, k2) names the row's text."""
    runs = runs_for(recall, similarity)
    rows = written(sketched(docs, runs, similarity), "shingle-sketches")
    nodes = written(rows.groupBy("k1", "k2").agg(F.count("*").alias("size"), F.min("doc_id").alias("rep_id"), F.first("n").alias("n"),
                                                 F.first("sketch").alias("sketch"), F.first("paths").alias("paths")), "shingle-nodes")
    edges = candidate_edges(nodes.where("n > 0").select("k1", "k2", "sketch", "paths"), similarity, runs)
    groups = components(edges, "near-candidates").select(
        F.col("root.k1").alias("r1"), F.col("root.k2").alias("r2"), F.col("node.k1").alias("k1"), F.col("node.k2").alias("k2"))
    members = groups.join(nodes.select("k1", "k2", "size", "rep_id", "n"), ["k1", "k2"])
    blocks = F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n") / BLOCK_SHINGLES)).alias("blocks")
    chosen = written(members.join(members.groupBy("r1", "r2").agg(blocks), ["r1", "r2"]).drop("n"), "near-chosen")
    sets = _with_sets(docs, chosen).withColumn("block", F.pmod(F.xxhash64("k2"), F.col("blocks")))
    found = written(exact_links(_in_blocks(sets, "block", "blocks"), similarity), "near-links")
    links = found.groupBy("k1", "k2").agg(F.sum("links").alias("links"))
    key = lambda a, b: F.struct(F.col(a).alias("k1"), F.col(b).alias("k2"))
    exact = components(found.where(F.col("b1").isNotNull()).select(key("k1", "k2").alias("a"), key("b1", "b2").alias("b")), "near-classes")
    rooted = exact.select(F.col("node.k1").alias("k1"), F.col("node.k2").alias("k2"), "root").join(nodes.select("k1", "k2", "rep_id"), ["k1", "k2"])
    ids = rooted.groupBy("root").agg(F.min("rep_id").alias("class_id"), F.min(F.struct(F.col("rep_id").isNull(), "rep_id", "k1", "k2")).alias("best"))
    linked = rooted.join(ids, "root").join(links, ["k1", "k2"]).select("k1", "k2", "class_id", key("best.k1", "best.k2").alias("class_key"), "links")
    info = nodes.select("k1", "k2", "size", "rep_id").join(linked, ["k1", "k2"], "left").select(
        "k1", "k2", F.when(F.col("class_key").isNull(), F.col("rep_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("class_key", key("k1", "k2")).alias("class_key"), (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"))
    return rows.select("k1", "k2", "doc_id").join(written(info, "near-info"), ["k1", "k2"])


def join(docs: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """(doc_id, class_id, n_links) of every row."""
    return classes(docs, similarity, recall).select("doc_id", "class_id", "n_links")


def keep_one(docs: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """One row of each class: that with the smallest id (then the smallest text hash), once if repeated."""
    found = classes(docs, similarity, recall)
    own = F.struct(F.col("k1"), F.col("k2")) == F.col("class_key")
    k1, k2, doc_id, h1, h2 = unused(docs, "k1", "k2", "id", "h1", "h2")
    kept = written(found.where(own).groupBy("k1", "k2").agg(F.min("doc_id").alias(doc_id)).withColumnsRenamed({"k1": k1, "k2": k2}), "near-kept")
    text = F.coalesce("text", F.lit(""))
    keyed_docs = docs.withColumns({h1: F.xxhash64(text), h2: F.xxhash64(text, F.lit(1))})
    same = (F.col(h1) == F.col(k1)) & (F.col(h2) == F.col(k2)) & F.col("doc_id").eqNullSafe(F.col(doc_id))
    return keyed_docs.join(kept, same).dropDuplicates([k1, k2]).select(*docs.columns)
