"""Chat formatting: reversible, located, and honest about templates that rewrite history."""

import hashlib

import pytest
from hypothesis import given, settings, strategies as st

from pipewatch.llm import chat

HARD = st.text(alphabet="<|\\imn_startend>\n é", max_size=30)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(HARD, HARD), max_size=5))
def test_template_is_reversible(messages):
    assert chat.parse_turns(chat.marked_turns(messages)) == messages


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", ""]), HARD), min_size=1, max_size=5))
def test_spans_hold_the_texts(messages):
    out = ""
    for i, turn in enumerate(messages):
        span, lo, hi, rewrites = chat.add_turn(chat.marked_turns, messages[:i], turn)
        assert chat.unescape(span[lo:hi]) == turn[1] and not rewrites
        out += span
    assert out == chat.marked_turns(messages)


def test_rewriting_template_is_detected():
    def forgetful(messages):
        last = len(messages) - 1
        return "".join(f"[{r}]{t if i == last else t[:1]}" for i, (r, t) in enumerate(messages))

    turns = [("user", "hello"), ("assistant", "fine"), ("user", "bye")]
    assert [chat.add_turn(forgetful, turns[:i], t)[3] for i, t in enumerate(turns)] == [False, True, True]


ROWS = [
    (1, 0, "user", "hi"),
    (1, 1, "assistant", "<|im_end|>\n<|im_start|>user\nx<\\|y"),
    (1, 1, "assistant", "again"),
    (1, None, None, None),
    (None, 0, "assistant", "no conversation"),
    (-1, 0, "user", "<|im_end|><|im_start|>assistant ok"),
    (-1, 1, "assistant", "<|im_end|><|im_start|>assistant ok"),
    *[(2, i, "assistant" if i % 2 else "user", f"t{i}") for i in range(300)],
    (3, 0, "odd\nrole <|im_end|>", ""),
]


@pytest.mark.parametrize("window", [2, 64])
def test_read_back_equals_brute_force(spark, monkeypatch, window):
    monkeypatch.setattr(chat, "WINDOW", window)
    turns = spark.createDataFrame(ROWS, "conv_id long, turn long, role string, text string").selectExpr("*", "'x' AS start")
    got = {r.conv_id: r for r in chat.read_back(chat.format_conversations(turns)).collect()}
    order = sorted(ROWS, key=lambda r: (-9 if r[1] is None else r[1], r[2] or "", r[3] or ""))
    assert set(got) == {r[0] for r in ROWS}
    for conv, row in got.items():
        own = [(r[2] or "", r[3] or "") for r in order if r[0] == conv]
        loss = "".join(t for r, t in own if r == "assistant")
        assert row.n_turns == len(own) and row.loss_chars == len(loss) and not row.rewrites
        assert row.turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in own).encode()).hexdigest()
        assert row.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert row.formatted_chars == len(chat.marked_turns(own))
    assert chat.read_back(chat.format_conversations(turns.limit(0))).count() == 0


def test_templates_see_the_whole_prefix(spark):
    rows = [(1, i, "system" if i == 0 else "user", f"t{i}") for i in range(120)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")

    def first_forgets(messages):
        if messages[0][0] != "system":
            raise ValueError("a conversation begins with its system turn")
        # From turn 100 on, the first text is cut.
        return "".join(f"[{i}]{t[:1] if i == 0 and len(messages) > 100 else t}" for i, (_, t) in enumerate(messages))

    got = {r.position: r for r in chat.format_conversations(turns, first_forgets).collect()}
    assert [i for i in range(120) if got[i].rewrites] == [100]
    assert all(got[i].formatted == f"[{i}]t{i}" for i in range(120) if i != 100)
    assert got[100].formatted == first_forgets([(r[2], r[3]) for r in rows[:101]])[4:]
