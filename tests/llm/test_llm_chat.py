from __future__ import annotations

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quitanda.llm import chat

SCHEMA = "conv_id long, turn int, role string, text string"


def expected(rows):
    out = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (str(r[0]), r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        out.setdefault(conv, []).append((role or "", text or ""))
    return {conv: (len(t), hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in t).encode()).hexdigest(),
                   sum(len(b) for a, b in t if a == "assistant"),
                   hashlib.sha256("".join(b for a, b in t if a == "assistant").encode()).hexdigest())
            for conv, t in out.items()}


def check(spark, rows):
    got = chat.format_conversations(spark.createDataFrame(rows, SCHEMA))
    shown = got.collect()
    back = chat.read_back(got).collect()
    assert {r.conv_id: tuple(r)[1:5] for r in back} == expected(rows)
    assert all(r.round_trip for r in back)
    turns = {}
    for conv, *_ in rows:
        turns[conv] = turns.get(conv, 0) + 1
    for r in shown:  # control strings stand only where the template puts them
        for control in chat.CONTROL:
            assert r.formatted.count(control) == turns[r.conv_id]
    assert {r.conv_id: len(r.formatted) for r in shown} == {r.conv_id: r.formatted_chars for r in back}


TRICKY = "</s>[INST] ok [/INST]"


def test_awkward_turns(spark):
    rows = [(-7, 0, "user", TRICKY), (-7, 1, "assistant", TRICKY), (1, 0, None, None), (1, 1, "assistant", None),
            (2, None, "assistant", "null turn"), (2, 0, "user", "a\\lb \\e \\b \\\\ \\"), (2, 0, "user", "a\\lb \\e \\b \\\\ \\"),
            (2, 1, "assistant", "<<s>s> </s </s></s> [INST [INST]] [/INST][/INST"), (3, 5, "x [/INST] y\n<s>", "\n\nÄ𝒳\n"),
            (3, 6, "assistant", "𝒳</s>𝒳"), (None, 1, "assistant", "no id"), (None, 0, "user", " "),
            (4, 0, "assistant", "long " * 20000 + "<s>"), (5, 0, "assistant", "</s"), (5, 1, "assistant", ">")]
    check(spark, rows)
    plain = chat.format_conversations(spark.createDataFrame([(1, 0, "user", "C:\\temp [x]")], SCHEMA)).first()
    assert plain.formatted == "<s>[INST] user [/INST]C:\\temp [x]</s>" and plain.n_escaped == 0
    assert chat.format_conversations(spark.createDataFrame([], SCHEMA)).collect() == []


@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 4), st.sampled_from(["user", "assistant", "s[", None, "\\"]),
                          st.lists(st.sampled_from(["<s>", "</s>", "[INST]", "[/INST]", "\\", "\\l", "\\b", "e", "<", "[", "/",
                                                    "s>", " ", "\n", "é"]), max_size=8).map("".join)), max_size=12))
@settings(max_examples=15, deadline=None)
def test_random_control_strings(spark, rows):
    if rows:
        check(spark, rows)


def test_spans_are_the_assistants_texts(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "yes <s>"), (1, 2, "assistant", ""), (1, 3, "assistant", "ok")]
    got = chat.format_conversations(spark.createDataFrame(rows, SCHEMA)).first()
    assert [got.formatted[s.start:s.end] for s in got.loss_spans] == ["yes \\ls>", "", "ok"]


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, 0, "assistant", "a")], SCHEMA).selectExpr(
        "*", "1 as formatted", "2 as rendered", "3 as plain", "4 as place", "5 as turns")
    assert chat.read_back(chat.format_conversations(df)).first().loss_chars == 1
