"""Spans, masks and read-back of formatted conversations."""

import random

from burstwatch.llm import chat

BITS = ["<s>", "</s>", "[INST]", "[/INST]", "[ROLE]", "\\", "\\\\", "a", " ", "\n", "<", "/s>", "é", "\ue000", ""]


def some_turns(rng):
    say = lambda: "".join(rng.choice(BITS) for _ in range(rng.randint(0, 8)))
    return [(rng.choice(["user", "assistant", "system", "", "x[ROLE]<s>"]), say()) for _ in range(rng.randint(0, 5))]


def test_escaping_is_reversible_and_leaves_no_control_string():
    rng = random.Random(1)
    for _ in range(2000):
        text = "".join(rng.choice(BITS) for _ in range(10))
        assert chat.unescape(chat.escape(text)) == text
        assert not any(c in chat.escape(text) for c in chat.CONTROLS)


def test_any_conversation():
    rng = random.Random(2)
    for _ in range(2000):
        turns = some_turns(rng)
        found = chat.render(turns, chat.instruct_template)
        assert found.rewritten_at is None
        assert chat.read_back(found.formatted) == turns
        assert [chat.unescape(found.formatted[a:b]) for a, b in found.texts] == [t for _, t in turns]
        assert "".join(found.formatted[a:b] for a, b in found.spans) == found.formatted


def test_templates_that_rewrite_history_are_found():
    def forgetful(turns):  # drops what earlier assistant turns said, as some reasoning formats do
        last = len(turns) - 1
        return "".join(f"<{r}>{t if r != 'assistant' or i == last else ''}" for i, (r, t) in enumerate(turns))

    turns = [("user", "q"), ("assistant", "long answer"), ("user", "more")]
    assert chat.render(turns, forgetful).rewritten_at == 2
    assert chat.render(turns[:2], forgetful).rewritten_at is None
    counting = lambda turns: f"{len(turns)}:" + "".join(t for _, t in turns)
    assert chat.render(turns, counting).rewritten_at == 0


def test_operator(spark):
    rows = [
        (1, 1, "assistant", "b", 0), (1, 0, "user", "a", 0), (2, 0, None, None, 0), (None, 0, "user", "x", 0), (None, 0, "user", "x", 0),
        (3, None, "system", "s", 0), (3, 0, "assistant", "</s>", 0), (3, 0, "assistant", "<s>", 0),
    ]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted int")
    found = {r.conv_id: r for r in chat.format_conversations(table).collect()}
    assert {k: r.n_turns for k, r in found.items()} == {1: 2, 2: 1, None: 2, 3: 3}
    assert chat.read_back(found[1].formatted) == [("user", "a"), ("assistant", "b")]
    assert chat.read_back(found[2].formatted) == [("", "")]
    assert chat.read_back(found[3].formatted) == [("system", "s"), ("assistant", "</s>"), ("assistant", "<s>")]
    masked = ["".join(chat.unescape(found[k].formatted[s.start : s.end]) for s in found[k].loss_spans) for k in (1, 3)]
    assert masked == ["b", "</s><s>"]
    assert chat.digests(chat.format_conversations(table.limit(0))).collect() == []


def test_a_long_conversation(spark):
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", f"text {i}") for i in range(300)]
    found = chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).first()
    assert chat.read_back(found.formatted) == [(r, t) for _, _, r, t in rows]
