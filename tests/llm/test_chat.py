"""Chat formatting: exact round trips of turns, and the mask against a loop over all spans."""

import hashlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerflow.llm import chat, queries
from ledgerflow.llm.common import read_table

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string, loss string, ids int"
pieces = st.lists(st.sampled_from(["<", "|", "\\", ">", "im_end", "<|im_end|>", "<|im_start|>", "<|im_sep|>", "\n", " ",
                                   "é", "漢", "\U0001F600", "word", "<|endoftext|>"])).map("".join)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(rows):
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, said in convs.items():
        said = [(r, t) for _, _, r, t in sorted(said)]
        loss = "".join(t for r, t in said if r == "assistant")
        out[conv] = (len(said), sha("".join(f"{r}\n{t}\n" for r, t in said)), len(loss), sha(loss))
    return out


def as_dict(result):
    return {r["conv_id"]: tuple(r)[1:5] for r in result.collect()}


@given(pieces)
@settings(max_examples=300, deadline=None)
def test_escapes_are_reversible(text):
    assert chat.unescape(chat.escape(text)) == text
    assert "<|" not in chat.escape(text)


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "<|im_sep|>"]), pieces), max_size=5))
@settings(max_examples=200, deadline=None)
def test_turns_and_masked_texts_come_back(turns):
    formatted, spans = chat.render(turns)
    assert chat.parse(formatted) == turns
    e = tokenizer().encode(formatted, add_special_tokens=False)
    at = np.array(e.offsets, np.int64).reshape(-1, 2)
    loss = chat.loss_mask(spans, at[:, 0], at[:, 1])
    assert loss.tolist() == [any(s <= a and b <= t and b > a for s, t in spans) for a, b in e.offsets]
    assert chat.masked_texts(formatted, at[:, 0], at[:, 1], loss) == [t for r, t in turns if r == "assistant" and t]
    # no token reaches over the edge of a span
    assert not any(a < edge < b for a, b in e.offsets for span in spans for edge in span)


_kept = []


def tokenizer():
    if not _kept:
        _kept.append(chat.chat_tokenizer())
    return _kept[0]


def test_query_matches_the_table(spark):
    rows = [tuple(r) for r in read_table(spark, SF, "conversations").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-1, 0, "user", chat.CONTROL_TEXT), (-1, 1, "assistant", chat.CONTROL_TEXT)]
    result = queries.op13_chat_formatting(spark, SF)
    assert as_dict(result) == brute(rows)
    assert result.filter("conv_id = -1").first()["loss_chars"] == len(chat.CONTROL_TEXT)


def test_edges(spark):
    rows = [(1, 0, "user", None), (1, None, None, "first"), (1, 1, "assistant", ""), (2, 0, "assistant", "a"),
            (2, 0, "assistant", "a"), (2, 1, "assistant", "b"), (None, 3, "user", "no id"), (None, 1, "assistant", "x"),
            (3, 0, "assistant", "long é " * 20_000), (4, 0, "assistant", " \n lead and trail \n "),
            (5, 0, "user", "<|endoftext|> <\\|im_end|>"), (5, 1, "assistant", "\\<|<<|im_end|>|>\x00\u2028"),
            *[(6, k, "assistant" if k % 2 else "user", f"turn {k}") for k in range(500)]]
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    formatted = chat.format_conversations(table)
    assert as_dict(chat.read_back(formatted)) == brute(rows)
    assert formatted.filter(F.size("ids") != F.size("loss")).count() == 0
    assert formatted.filter("conv_id = 1").select(F.exists("loss", lambda x: x)).first()[0] is False


def test_empty_table(spark):
    assert chat.read_back(chat.format_conversations(spark.createDataFrame([], SCHEMA))).collect() == []
