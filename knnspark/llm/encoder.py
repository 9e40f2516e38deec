"""Token ids of whole texts by a public tokenizer file, batch by batch.

A byte-level BPE with the usual pre-tokenizer never joins characters across a single space that has a
non-space on both sides: the space starts the next pre-token.  So the ids of a text are the ids of
its chunks between such spaces, each encoded alone with its leading space.  Arrow splits a batch of
texts and finds its distinct chunks, each distinct chunk is encoded once, and NumPy puts the ids of
every text together.

Chunks go through the same vocabulary held as merge ranks, whose encoder is about five times faster
than the tokenizer library's; each worker first compares the two on some chunks and raises if an id
differs.  Texts that hold a special token's string, and all texts when there is no rank file, are
encoded by the tokenizer library itself.  The tests compare the result with the library's own ids.
"""

from __future__ import annotations

import base64
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


_SPACE = r"[\s\p{Z}\x{0b}\x{1c}-\x{1f}\x{85}]"


def _ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, ... of each run, one run after another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


class BatchEncoder:
    """Encodes Arrow string arrays; one instance per Python worker and tokenizer file."""

    _instances: dict[tuple, "BatchEncoder"] = {}

    def __init__(self, path: str, ranks_path: str | None = None, compare: int = 1_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.to_compare = compare
        self.ranked = None
        if ranks_path:
            import public_tokenizers
            import tiktoken

            with open(ranks_path, "rb") as f:
                ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
            self.newline = ranks[b"\n"]
            self.ranked = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                            special_tokens={})

    @classmethod
    def at(cls, path: str, ranks_path: str | None = None) -> "BatchEncoder":
        key = (path, ranks_path)
        if key not in cls._instances:
            cls._instances[key] = cls(path, ranks_path)
        return cls._instances[key]

    def _library(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _chunks(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of " " + chunk for each chunk, flat, with the start and number of each chunk's ids, and
        which chunks are empty or have white space at an end.

        Chunks without white space go through the encoder together, one a line: the line break before
        a space is a token of its own, which no such chunk holds, so it tells them apart.
        """
        starts, counts = np.zeros(len(chunks), np.int64), np.zeros(len(chunks), np.int64)
        spaced = pc.or_(pc.match_substring_regex(chunks, _SPACE), pc.equal(pc.binary_length(chunks), 0))
        odd = spaced.to_numpy(zero_copy_only=False)
        at = np.flatnonzero(~odd)
        ids = np.zeros(0, np.uint32)
        if len(at):
            lines = pa.ListArray.from_arrays([0, len(at)], chunks.filter(pc.invert(spaced)).cast(pa.string()))
            together = pc.binary_join(lines, "\n ")[0].as_py()
            ids = np.array(self.ranked.encode_ordinary(" " + together), dtype=np.uint32)
            cuts = np.flatnonzero(ids == self.newline)
            starts[at] = np.concatenate([[0], cuts + 1])
            counts[at] = np.concatenate([cuts, [len(ids)]]) - starts[at]
        rest = chunks.filter(spaced).to_pylist()
        bad = odd.copy()
        bad[odd] = [not c or c[0].isspace() or c[-1].isspace() for c in rest]
        more = [self.ranked.encode_ordinary(" " + c) for c in rest]
        if more:
            counts[odd] = [len(m) for m in more]
            starts[odd] = len(ids) + np.cumsum(counts[odd]) - counts[odd]
            ids = np.concatenate([ids, np.array([i for m in more for i in m], dtype=np.uint32)])
        if self.to_compare > 0:
            some = [k for k in range(min(self.to_compare, len(chunks))) if not any(s in chunks[k].as_py() for s in self.special)]
            self.to_compare -= len(some)
            own = [ids[starts[k]:starts[k] + counts[k]].tolist() for k in some]
            if self._library([" " + chunks[k].as_py() for k in some]) != own:
                raise ValueError("the rank file does not give the tokenizer's ids")
        return ids, starts, counts, bad

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a string array without nulls, and each text's end in them: the tokenizer's own
        ids with ``add_special_tokens=False``."""
        n = len(texts)
        if n == 0:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        texts = texts.cast(pa.large_string())
        alone = np.zeros(n, bool)
        if self.ranked is None:
            alone[:] = True
        else:
            for s in self.special:
                alone |= pc.match_substring(texts, s).to_numpy(zero_copy_only=False)
        split = pc.split_pattern(texts, " ")
        offsets = split.offsets.to_numpy() - split.offsets[0].as_py()
        coded = split.flatten().dictionary_encode()
        chunks, which = coded.dictionary, coded.indices.to_numpy()
        if self.ranked is None:
            ids, starts, counts, bad = np.zeros(0, np.uint32), *np.zeros((2, len(chunks)), np.int64), np.zeros(len(chunks), bool)
        else:
            ids, starts, counts, bad = self._chunks(chunks)
        # A chunk that is empty, or has white space at an end, has no single inner space beside it: its
        # text is encoded whole.  First chunks have no space before them.  The ids of both follow.
        row = np.repeat(np.arange(n), np.diff(offsets))
        whole = alone.copy()
        whole[row[bad[which]]] = True
        first = offsets[:-1]
        heads = chunks.take(pa.array(which[first])).to_pylist()
        for k in np.flatnonzero(whole):
            heads[k] = texts[k].as_py()
        by_library = dict(zip(np.flatnonzero(alone).tolist(), self._library([heads[k] for k in np.flatnonzero(alone)])))
        own = [by_library[k] if k in by_library else self.ranked.encode_ordinary(t) for k, t in enumerate(heads)]
        own_counts = np.fromiter(map(len, own), np.int64, n)
        all_ids = np.concatenate([ids, np.fromiter(chain.from_iterable(own), np.uint32)])
        start, length = starts[which], counts[which]
        length[whole[row]] = 0
        start[first] = len(ids) + np.cumsum(own_counts) - own_counts
        length[first] = own_counts
        ends = np.add.reduceat(length, first) if len(length) else np.zeros(n, np.int64)
        return all_ids[_ragged(start, length)], np.cumsum(ends)
