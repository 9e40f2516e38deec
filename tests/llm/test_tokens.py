"""The batch encoder, exact token counts and packing."""

import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from tokenizers import Tokenizer

from knnspark.llm import histogram, packing
from knnspark.llm.encoder import BatchEncoder
from knnspark.llm.registry import RANKS, TOKENIZER
from tests.llm.helpers import AWKWARD, DOCS, EXTRA, docs_df

ODD = ["", " ", "  ", "a", " a", "a ", "a  b", "a \n b\n", "x\ty <|endoftext|> z", "é ü ñ  ", "\n\n a'll don't 12 345", "　 x  y\u2028 z", "one two one two",
       "\x1c a\x85b c", "tab\t then", "we're  it's", "数据 数据", "a" * 5000 + " b", "\U0001f600 \U0001f600\u200d"]
LIBRARY = Tokenizer.from_file(TOKENIZER)


def ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("ranks", [RANKS, None])
def test_encoder_gives_the_librarys_ids(ranks):
    encoder = BatchEncoder(TOKENIZER, ranks)
    rng = np.random.default_rng(0)
    alphabet = list("ab é\n\t .'x1  ")
    texts = ODD + ["".join(rng.choice(alphabet, size=n)) for n in rng.integers(0, 60, 400)]
    for part in (texts, texts[:1], []):
        got, ends = encoder.encode(pa.array(part, pa.string()))
        starts = [0, *ends[:-1]] if len(ends) else []
        assert [got[a:b].tolist() for a, b in zip(starts, ends)] == [ids(t) for t in part]


def test_a_wrong_rank_file_raises():
    with pytest.raises((ValueError, KeyError)):
        BatchEncoder(TOKENIZER, public_tokenizers.path("byte_bpe_multi_50k.tiktoken")).encode(pa.array(["some ordinary words here"]))


@pytest.mark.parametrize("operator", ["packing", "histogram"])
def test_texts_are_encoded_in_pieces_of_bounded_size(monkeypatch, operator):
    texts = [" ".join(f"w{k}x{n}" for n in range(400)) for k in range(1500)] + [None, "", "long " * 300_000, "", "a b"] + ["short text"] * 500
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)][operator == "histogram":],
                                       names=["doc_id", "text"][operator == "histogram":])
    docs = SimpleNamespace(mapInArrow=lambda run, schema: run)
    docs.select = lambda *_: docs
    sizes, encode = [], BatchEncoder.encode

    def spied(self, part):
        sizes.append((len(part), sum(len(t.as_py().encode()) for t in part)))
        return encode(self, part)

    monkeypatch.setattr(BatchEncoder, "encode", spied)
    monkeypatch.setattr(packing, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    if operator == "packing":
        run = packing.cut(docs, TOKENIZER, RANKS, 2048, 1, 1, 7, False)
    else:
        docs.groupBy = lambda *_: SimpleNamespace(agg=lambda *_: docs.run)
        docs.mapInArrow = lambda run, schema: setattr(docs, "run", run) or docs
        monkeypatch.setattr(histogram, "F", SimpleNamespace(sum=lambda _: SimpleNamespace(alias=lambda _: None)))
        run = histogram.length_counts(docs, TOKENIZER, RANKS)
    out = pa.Table.from_batches(run(iter([batch])))
    assert sum(n for n, _ in sizes) == len(texts)
    assert all(size <= 1 << 20 or n == 1 for n, size in sizes)
    assert len(sizes) < 12  # short texts still go together
    lengths = [len(ids(t)) for t in texts]
    if operator == "packing":
        first = out.filter(pc.equal(out["start"], 0))
        assert first["doc_id"].to_pylist() == list(range(len(texts)))
        assert first["doc_tokens"].to_pylist() == [n + 1 for n in lengths]
    else:
        found = Counter()
        for n, docs_ in zip(out["length"].to_pylist(), out["docs"].to_pylist()):
            found[n] += docs_
        assert found == Counter(lengths)


ROWS = [(100 + k, t) for k, t in enumerate(ODD)] + [(200 + k, "word " * (37 * k)) for k in range(120)] + AWKWARD


def test_histogram_equals_brute_force(spark):
    hist = histogram.histogram(docs_df(spark, ROWS, EXTRA), TOKENIZER, RANKS)
    lengths = sorted(len(ids(t)) for _, t in ROWS)
    total = sum(lengths)
    rows = {r.length: r for r in hist.collect()}
    assert {n: r.docs for n, r in rows.items()} == Counter(lengths)
    for n, r in rows.items():
        within = [x for x in lengths if x <= n]
        assert (r.docs_within, r.tokens_within, r.docs_over, r.tokens_over) == (len(within), sum(within), len(lengths) - len(within), total - sum(within))
        assert r.truncated_total == sum(min(x, n) for x in lengths)
        assert r.quantile == len(within) / len(lengths)
    at = {r.context_limit: r for r in histogram.at_limits(hist, [1, 100, 2048, 10**6]).collect()}
    for n, r in at.items():
        assert (r.docs_over, r.truncated_total) == (sum(x > n for x in lengths), sum(min(x, n) for x in lengths))


def test_tournament_is_first_fit():
    rng = np.random.default_rng(1)
    sizes = np.sort(rng.integers(1, 101, 500))[::-1]
    bins, offsets = packing.first_fit_decreasing(sizes, 100)
    room: list[int] = []
    for size, b, o in zip(sizes, bins, offsets):
        first = next((k for k, r in enumerate(room) if r >= size), len(room))
        if first == len(room):
            room.append(100)
        assert (b, o) == (first, 100 - room[first])
        room[first] -= size


def _check_packing(rows, found, capacity, end_id=1):
    want = Counter()
    for doc_id, text in rows:
        all_ids = np.array([*ids(text), end_id], "<u4")
        for start in range(0, len(all_ids), capacity):
            piece = all_ids[start:start + capacity]
            want[doc_id, start, len(piece), zlib.crc32(piece.tobytes()), len(all_ids)] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in found) == want
    sequences = {}
    for r in found:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    return sequences


@pytest.mark.parametrize("group_docs", [8192, 20])
def test_every_id_is_in_one_piece_and_sequences_have_no_gap(spark, group_docs):
    found = packing.pack(docs_df(spark, ROWS, EXTRA), TOKENIZER, RANKS, capacity=256, group_docs=group_docs).collect()
    sequences = _check_packing(ROWS, found, 256)
    filled = sum(n for pieces in sequences.values() for _, n in pieces)
    assert filled >= (0.98 if group_docs > 100 else 0.85) * 256 * len(sequences)


def test_kept_ids_are_the_pieces(spark):
    found = packing.pack(docs_df(spark, ROWS[:30]), TOKENIZER, RANKS, capacity=64, keep_ids=True).collect()
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in found)


def test_padding_and_empty_tables(spark):
    placed = spark.createDataFrame([(1, 100), (1, 28), (2, 256), (3, 7)], "sequence_id long, length long")
    assert tuple(packing.padding(placed, 256).first()) == (3, 391, 249)
    empty = spark.createDataFrame([], DOCS)
    assert packing.pack(empty, TOKENIZER, RANKS).collect() == []
    assert histogram.histogram(empty, TOKENIZER, RANKS).collect() == []
