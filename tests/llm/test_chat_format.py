"""Chat formatting against a plain renderer and parser, with texts made of control strings."""

from __future__ import annotations

import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clickloom.llm import chat_format

SCHEMA = "conv_id long, turn long, role string, text string"
CONTROL = ["[INST]", "[/INST]", "</s>", "<s>", "[SYS]", "[/SYS]", "[ROLE]", "[/ROLE]", "[:]"]
PARTS = [*CONTROL, "[~INST]", "<~/s>", "[~~:]", "~", "[", "<", "/", "INST]", "s>", ":]", " ", "a", "é🙂", "\n", "\\", "$1"]


def plain_read(formatted: str) -> list[tuple[str, str]]:
    """Character by character, by the grammar in the module's docstring."""
    turns, at = [], 0
    closings = {"[INST] ": ("user", " [/INST]"), "[SYS] ": ("system", " [/SYS]"), "[ROLE] ": (None, "[/ROLE]"), " ": ("assistant", "</s>")}
    one_less = lambda s: re.sub(r"([\[<])~(~*)(/?(?:INST|SYS|ROLE)\]|:\]|/?s>)", r"\1\2\3", s)
    while at < len(formatted):
        opening = next(o for o in closings if formatted.startswith(o, at))
        role, closing = closings[opening]
        end = formatted.index(closing, at + len(opening))
        body = formatted[at + len(opening) : end]
        assert not any(c in body for c in CONTROL if c != "[:]")
        if role is None:
            role, body = body.split("[:]", 1)
        assert "[:]" not in body
        turns.append((one_less(role), one_less(body)))
        at = end + len(closing)
    return turns


def check(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    source = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        source.setdefault(conv, []).append((role or "", text or ""))
    formatted = chat_format.format_conversations(df)
    back = {r.conv_id: r for r in chat_format.read_back(formatted).collect()}
    assert set(back) == set(source)
    for conv, turns in source.items():
        r = back[conv]
        assert plain_read(r.formatted) == turns == [tuple(t) for t in r.turns]
        # The mask covers the assistant's texts and nothing else.
        at, trained = 0, []
        for m in r.loss_mask:
            if m.loss or m.tail:
                trained.append(r.formatted[at + m.lead : at + m.lead + m.loss])
            at += m.lead + m.loss + m.tail
        assert at == len(r.formatted)
        assert [re.sub(r"([\[<])~(~*)(/?(?:INST|SYS|ROLE)\]|:\]|/?s>)", r"\1\2\3", t) for t in trained] == r.loss_texts == [t for role, t in turns if role == "assistant"]
    for r in chat_format.digests(df).collect():
        turns = source[r.conv_id]
        assert r.n_turns == len(turns) and r.formatted_chars == len(back[r.conv_id].formatted)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        loss = "".join(b for a, b in turns if a == "assistant")
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return back


def test_plain_conversations_are_rendered_once(spark):
    back = check(spark, [(1, 0, "system", "Be brief."), (1, 1, "user", "Hi"), (1, 2, "assistant", "Hello"), (2, 0, "tool", "x = [1, 2]")])
    assert back[1].formatted == "[SYS] Be brief. [/SYS][INST] Hi [/INST] Hello</s>"
    assert back[2].formatted == "[ROLE] tool[:]x = [1, 2][/ROLE]"
    assert {r.rounds for r in back.values()} == {1}


def test_only_conflicting_texts_are_escaped(spark):
    back = check(spark, [(1, 0, "user", "</s>[INST] ok [/INST]"), (1, 1, "assistant", "<b> [0] ~"), (1, 2, "assistant", "[~INST]")])
    assert back[1].formatted == "[INST] <~/s>[~INST] ok [~/INST] [/INST] <b> [0] ~</s> [~~INST]</s>"
    assert back[1].rounds == 2


def test_awkward_rows(spark):
    rows = [
        (None, 0, "user", "no id"), (1, None, "assistant", "first"), (1, 0, None, None), (1, 0, "user", "tie"), (1, 0, "user", "tie"),
        (1, 0, "assistant", "tie"), (2, 5, "assistant", None), (3, 0, "x[:]y </s>", "[:]"), (4, 1, "assistant", "long [INST] " * 60_000),
        (4, 0, "user", "x" * 2_000_000), (5, 0, "user", "ends with [/INST"), (5, 1, "assistant", "<"), (6, -3, "", " "), (6, -2, "Assistant", ""),
    ]
    check(spark, rows)


def test_other_columns_and_empty_tables(spark):
    df = spark.createDataFrame([(1, 0, "user", "a")], SCHEMA).withColumns({c: F.lit("mine") for c in ("formatted", "turns", "source", "same", "conflict", "rounds")})
    assert [r.formatted for r in chat_format.format_conversations(df).collect()] == ["[INST] a [/INST]"]
    assert chat_format.digests(spark.createDataFrame([], SCHEMA)).count() == 0


@settings(max_examples=12, deadline=None)
@given(st.lists(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "[:]", "", "</s>~"]), st.lists(st.sampled_from(PARTS), max_size=6)), max_size=5), min_size=1, max_size=25))
def test_any_texts_come_back(spark, conversations):
    rows = [(c, t, role, "".join(parts)) for c, turns in enumerate(conversations) for t, (role, parts) in enumerate(turns)]
    if rows:
        check(spark, rows)


def test_escaping_is_undone_exactly(spark):
    df = spark.createDataFrame([(a + b + c,) for a in PARTS for b in PARTS for c in PARTS], "t string")
    escaped = df.withColumn("e", chat_format.escape(F.col("t")))
    assert escaped.filter(chat_format.unescape(F.col("e")) != F.col("t")).count() == 0
    assert escaped.filter(F.col("e").rlike("|".join(re.escape(c) for c in CONTROL))).count() == 0


def test_plan_has_no_python(spark):
    plan = chat_format.digests(spark.range(3).selectExpr("id conv_id", "id turn", "'user' role", "'a' text"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "InArrow" not in plan
