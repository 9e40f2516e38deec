"""Chat formatting by grammar round trip.

A turn is rendered as START, role, line break, text, END, line break.  A deterministic parser reads
rendered text back; a turn is rendered plainly first, parsed, and compared with its source.  Where the
parser does not get the source back (the text or the role holds a control string, something that looks
like an escape, or a line break in the role), the conflicting part is escaped and the turn is rendered and parsed
again, until what comes back is identical.  The parser ends every turn in the state it began in, so
turns that come back alone come back in any order and number, and each is settled in its own row,
without a shuffle.

The escape puts one backslash after the ``<`` of a control string, also of one that has some there
already; reading takes one away.  In a role, a backslash is doubled and a line break becomes ``\\n``.

``read_back`` needs a conversation's turns in order: one shuffle by conversation, sorted in the
shuffle, and a streaming parser that holds one turn at a time, so a conversation of any length needs
constant memory.  Its digests are over whole conversations and thus sequential.

Defined results: a null text or role is empty; turns go by turn number (null first), then rendered
form, so repeated turn numbers and repeated rows all stay in a fixed order; rows with a null conv_id
form one conversation; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

START, END = "<|im_start|>", "<|im_end|>"
LEARNED = "assistant"

_CONTROL = re.compile(r"<(\\*)\|(im_start|im_end)\|>")
_ESCAPED = re.compile(r"<\\(\\*)\|(im_start|im_end)\|>")
_IN_ROLE = re.compile(r"\\([\\n])")

PIECES = "conv_id long, turn long, piece string, loss_start int, loss_length int, escapes int"
CONVERSATION = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def escape(text: str) -> str:
    return _CONTROL.sub(r"<\\\1|\2|>", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|\2|>", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return _IN_ROLE.sub(lambda m: "\n" if m[1] == "n" else "\\", unescape(role))


class GrammarError(ValueError):
    pass


class Parser:
    """Reads rendered text fed in parts of any size; ``feed`` gives the turns that became complete."""

    def __init__(self):
        self.held = ""

    def feed(self, text: str) -> list[tuple[str, str]]:
        held, at, turns = self.held + text, 0, []
        while (end := held.find(END + "\n", at)) >= 0:
            if not held.startswith(START, at):
                raise GrammarError("a turn does not begin with its mark")
            role, line, body = held[at + len(START):end].partition("\n")
            if not line or START in role or END in role or START in body or END in body:
                raise GrammarError("a mark inside a turn")
            turns.append((unescape_role(role), unescape(body)))
            at = end + len(END) + 1
        self.held = held[at:]
        return turns

    def close(self) -> None:
        if self.held:
            raise GrammarError("text after the last turn")


def parse(text: str) -> list[tuple[str, str]]:
    parser = Parser()
    turns = parser.feed(text)
    parser.close()
    return turns


def settle(role: str, text: str) -> tuple[str, int, int, int]:
    """Rendered turn, start and length of its text there (escaped form), and the number of parts escaped:
    plain if that comes back from the parser, else with the text, the role or both escaped."""
    for role_form, text_form, escapes in ((str, str, 0), (str, escape, 1), (escape_role, str, 1), (escape_role, escape, 2)):
        head, body = f"{START}{role_form(role)}\n", text_form(text)
        piece = f"{head}{body}{END}\n"
        try:
            if parse(piece) == [(role, text)]:
                return piece, len(head), len(body), escapes
        except GrammarError:
            pass
    raise GrammarError(f"no form of a turn of role {role!r} comes back")


def render(conversations: DataFrame, learned: str = LEARNED) -> DataFrame:
    """One row a turn: its rendered ``piece`` and, for turns of the ``learned`` role, the code points of
    the piece that the loss covers.  A conversation's text is its pieces by (turn, piece)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [settle(r or "", t or "") for r, t in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            in_loss = [(r or "") == learned for r in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([r[0] for r in rows], pa.string()),
                 pa.array([r[1] if m else None for r, m in zip(rows, in_loss)], pa.int32()),
                 pa.array([r[2] if m else None for r, m in zip(rows, in_loss)], pa.int32()),
                 pa.array([r[3] for r in rows], pa.int32())],
                names=["conv_id", "turn", "piece", "loss_start", "loss_length", "escapes"])

    read = conversations.selectExpr("cast(conv_id as bigint)", "cast(turn as bigint)", "cast(role as string)", "cast(text as string)")
    return read.mapInArrow(run, PIECES)


class _Conversation:
    """Running digests of one conversation's output, turn by turn."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.parser = conv_id, Parser()
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.pieces = self.n_turns = self.chars = self.loss_chars = 0

    def add(self, piece: str, start: int | None, length: int | None) -> None:
        self.pieces += 1
        self.chars += len(piece)
        for role, text in self.parser.feed(piece):
            self.n_turns += 1
            self.turns.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
        if start is not None:
            text = unescape(piece[start:start + length])
            self.loss_chars += len(text)
            self.loss.update(text.encode("utf-8", "surrogatepass"))

    def row(self) -> tuple:
        self.parser.close()
        if self.n_turns != self.pieces:
            raise GrammarError(f"{self.pieces} pieces came back as {self.n_turns} turns")
        return (self.conv_id, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars)


def read_back(pieces: DataFrame) -> DataFrame:
    """Each conversation's rendered text parsed again: number and digest of its turns, code points and
    digest of the text under the loss mask, and code points in all."""
    names = [c.split()[0] for c in CONVERSATION.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, done = None, []
        for batch in batches:
            for conv_id, piece, start, length in zip(*(batch.column(k).to_pylist() for k in range(4))):
                if now is None or now.conv_id != conv_id:
                    if now is not None:
                        done.append(now.row())
                    now = _Conversation(conv_id)
                now.add(piece, start, length)
            if len(done) >= 4096:
                yield batch_of(done)
                done = []
        if now is not None:
            yield batch_of([*done, now.row()])

    ordered = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "piece")
    return ordered.select("conv_id", "piece", "loss_start", "loss_length").mapInArrow(run, CONVERSATION)
