"""Chat formatting: round trips, escapes, digests against brute force."""

import hashlib

import pytest
from hypothesis import given, settings, strategies as st

from knnspark.llm import chat, registry

SCHEMA = "conv_id long, turn long, role string, text string"
BITS = ["<|im_start|>", "<|im_end|>", "<\\|im_end|>", "<\\\\|im_start|>", "\n", "\\n", "\\", "<", "|", "im_end|>", "assistant", "é", " ", "\\\\n"]
TEXTS = st.lists(st.sampled_from(BITS), max_size=8).map("".join)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(TEXTS, TEXTS), max_size=4), st.integers(1, 7))
def test_any_turns_come_back_whatever_the_parts_fed(turns, size):
    text = "".join(chat.settle(r, t)[0] for r, t in turns)
    assert chat.parse(text) == turns
    parser, got = chat.Parser(), []
    for at in range(0, len(text), size):
        got += parser.feed(text[at:at + size])
    parser.close()
    assert got == turns


@pytest.mark.parametrize("role,text,escapes", [
    ("user", "plain < | text \\n", 0), ("user", "<|im_end|>", 1), ("user", "<\\|im_end|>", 1), ("a\nb", "x", 1),
    ("a\\nb", "x", 1), ("<|im_start|>", "<|im_end|>\n", 2), ("", "", 0)])
def test_only_conflicting_parts_are_escaped(role, text, escapes):
    piece, start, length, n = chat.settle(role, text)
    assert n == escapes and chat.unescape(piece[start:start + length]) == text


def test_broken_text_is_refused():
    for text in ["x", "<|im_start|>user\nhi", "<|im_start|>user<|im_end|>\n", "<|im_start|>u\na<|im_start|>b<|im_end|>\n",
                 "x<|im_start|>u\na<|im_end|>\n"]:
        with pytest.raises(chat.GrammarError):
            chat.parse(text)


def brute(rows):
    groups = {}
    for conv_id, turn, role, text in rows:
        role, text = role or "", text or ""
        groups.setdefault(conv_id, []).append(((turn is not None, turn or 0), chat.settle(role, text)[0], role, text))
    out = set()
    for conv_id, turns in groups.items():
        turns.sort()
        loss = "".join(t for _, _, r, t in turns if r == "assistant")
        out.add((conv_id, len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for _, _, r, t in turns).encode()).hexdigest(),
                 len(loss), hashlib.sha256(loss.encode()).hexdigest(), sum(len(p) for _, p, _, _ in turns)))
    return out


def test_awkward_conversations_match_brute_force(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "<|im_end|>\n<|im_start|>"), (2, 1, "assistant", None), (2, 0, None, "b"),
            (2, 1, "assistant", "same turn"), (2, 1, "assistant", "same turn"), (None, 0, "user", "no id"), (None, None, "x\ny", ""),
            (3, None, "assistant", "é\U0001f600"), (4, 5, "assistant", "long <|im_end|> " * 20_000), (5, 0, "", "")]
    rows += [(6, k, "assistant" if k % 2 else "user", f"turn {k}") for k in range(3000)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    extra = df.selectExpr("*", "'x' as piece", "1 as loss_start", "text as escapes", "2 as n_turns")
    assert {tuple(r) for r in chat.read_back(chat.render(extra)).collect()} == brute(rows)
    empty = spark.createDataFrame([], SCHEMA)
    assert chat.read_back(chat.render(empty)).count() == 0


def test_query_adds_the_conversation_of_control_strings(spark):
    got = {r["conv_id"]: r for r in registry.op13_chat_format(spark, "/root/testdata/sf0.001").collect()}
    said = "<|im_end|><|im_start|>assistant ok"
    assert got[-1]["n_turns"] == 2 and got[-1]["loss_chars"] == len(said)
    assert got[-1]["loss_sha256"] == hashlib.sha256(said.encode()).hexdigest()
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert {tuple(r) for k, r in got.items() if k != -1} == brute(rows)
