import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyforge.llm import chat

EVENTS = "conv_id bigint, seq bigint, kind string, message bigint, role string, text string"
TURNS = "conv_id bigint, turn bigint, role string, text string, start string, log int"
SAID = "</s>[INST] ok [/INST]"


def folded(events):
    """The fold, event by event."""
    out = {}
    for conv in {e[0] for e in events}:
        messages = {}
        order = sorted((e for e in events if e[0] == conv), key=lambda e: (e[1], e[2], e[4] or "", e[5] or ""))
        for _, _, kind, message, role, text in order:
            if kind in ("edit", "regenerate"):
                messages = {m: v for m, v in messages.items() if m <= message}
            old_role, old = messages.get(message, (None, ""))
            kept = old if kind == "delta" else ""
            messages[message] = (role or old_role, kept + (text or ""))
        out |= {(conv, m): (r or "", t) for m, (r, t) in messages.items()}
    return out


def fold(spark, events):
    rows = chat.fold(spark.createDataFrame(events, EVENTS)).collect()
    assert len(rows) == len({(r.conv_id, r.message) for r in rows})
    return {(r.conv_id, r.message): (r.role, r.text) for r in rows}


def test_fold_of_a_log(spark):
    events = [
        (1, 1, "message", 0, "user", "hi"),
        (1, 2, "message", 1, "assistant", ""),
        (1, 3, "delta", 1, None, "he"),
        (1, 5, "delta", 1, None, "lo"),
        (1, 4, "delta", 1, None, "l"),
        (1, 6, "message", 2, "user", "more"),
        (1, 7, "regenerate", 1, None, None),
        (1, 8, "delta", 1, None, "good day"),
        (1, 9, "edit", 0, None, "hello"),
        (1, 10, "message", 1, "assistant", "yes"),
        (2, 1, "delta", 0, "user", "never started"),
        (2, 2, "message", 1, None, None),
        (3, 1, "message", 0, "user", "a"),
        (3, 2, "message", 1, "assistant", "b"),
        (3, 3, "regenerate", 0, None, None),
    ]
    found = fold(spark, events)
    assert found == folded(events)
    assert found[1, 1] == ("assistant", "yes") and (1, 2) not in found and (3, 1) not in found


@settings(max_examples=15, deadline=None)
@given(
    st.lists(
        st.tuples(
            st.integers(1, 2),
            st.sampled_from(["message", "delta", "edit", "regenerate"]),
            st.integers(0, 3),
            st.sampled_from(["user", "assistant", None]),
            st.sampled_from(["a", "bc", "", None]),
        ),
        max_size=25,
    )
)
def test_fold_equals_event_by_event(spark, events):
    rows = [(c, seq, kind, m, role, text) for seq, (c, kind, m, role, text) in enumerate(events)]
    assert fold(spark, rows) == folded(rows)


TEXTS = [SAID, "", "\\", "\\<s>", "<\\s>", "<<s>s>", "a\nb", "﻿x", "😀 </s> ]", "[/INST]", " [/INST]x", "$1 \\1", "</s></s>"]


def read(spark, turns):
    return chat.read_back(chat.render(chat.fold(chat.turn_events(spark.createDataFrame(turns, TURNS)))))


def test_round_trip_of_control_strings(spark):
    turns = [(1, i, "assistant" if i % 2 else t, t, "x", 1) for i, t in enumerate(TEXTS * 2)]
    row = read(spark, turns).first()
    assert [(t.role, t.text) for t in row.turns] == [(r, t) for _, _, r, t, _, _ in turns]
    assert list(row.learned) == [t for _, _, r, t, _, _ in turns if r == "assistant"]


def test_escaped_texts_hold_no_control_string(spark):
    rows = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    for row in rows.select("text", chat.escape(rows.text).alias("safe")).collect():
        assert not any(c in row.safe for c in chat.CONTROL)


def test_digests_and_special_rows(spark):
    turns = [
        (1, 1, "assistant", "b", "x", 1),
        (1, 0, "user", None, "x", 1),
        (1, 0, "user", None, "x", 1),
        (2, None, None, "t", "x", 1),
        (None, 0, "assistant", SAID, "x", 1),
    ]
    found = {r.conv_id: r for r in chat.digests(read(spark, turns)).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert found[1].n_turns == 3 and found[1].turns_sha256 == sha("user\n\nuser\n\nassistant\nb\n")
    assert found[1].loss_chars == 1 and found[1].loss_sha256 == sha("b")
    assert found[2].turns_sha256 == sha("\nt\n") and found[2].loss_sha256 == sha("")
    assert found[None].loss_sha256 == sha(SAID) and found[None].loss_chars == len(SAID)
    assert chat.digests(read(spark, [])).collect() == []


def test_long_conversation(spark):
    turns = [(7, i, ("user", "assistant")[i % 2], "é" * (i % 50), "x", 1) for i in range(3000)]
    row = chat.digests(read(spark, turns)).first()
    learned = "".join(t[3] for t in turns if t[2] == "assistant")
    assert row.n_turns == 3000 and row.loss_sha256 == hashlib.sha256(learned.encode()).hexdigest()


@pytest.mark.parametrize("step", [chat.turn_events])
def test_runs_in_the_jvm(spark, step):
    frame = spark.sql("SELECT 1L AS conv_id, 0L AS turn, 'user' AS role, 'x' AS text")
    done = chat.digests(chat.read_back(chat.render(chat.fold(step(frame)))))
    plan = done._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
