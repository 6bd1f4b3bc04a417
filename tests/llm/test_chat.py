"""Templates and conversations: round trips, masks, folding, odd rows."""

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pulsegrain.llm import chat


def render(template, messages):
    return list(chat.compile_template(template).pieces(iter(messages)))


def test_folding_leaves_text_only():
    nodes = chat.fold(chat.parse("a{{ 'b' ~ 1 | upper }}{% if 1 == 2 %}x{% elif 'q' in 'aqa' %}{{ ' t ' | trim }}{% else %}z{% endif %}{{ none }}c"))
    assert nodes == [chat.Text("ab1tc")]


def test_expressions_and_markers():
    template = "{% set tail = '!' %}{% for m in messages %}{% if loop.first and not m.role == 'x' %}<{% endif %}{% generation %}{{ m.text ~ tail }}{% endgeneration %};{% endfor %}end"
    pieces = render(template, [{"role": "u", "text": "é"}, {"role": "x", "text": ""}])
    assert pieces == [("<é!;", [(1, 3)]), ("!;", [(0, 1)]), ("end", [])]


@pytest.mark.parametrize("bad", [
    "{% for m in messages %}", "{% endif %}", "{{ a b }}", "{{ m.text | nothing }}", "{{ open('x') }}", "{% for a in b %}{% endfor %}",
    "{{ (1 }}", "{% if x %}{% for m in messages %}{% endfor %}{% endif %}", "{{ m.__class__.mro() }}", "{{ 'a }}",
])
def test_templates_that_are_refused(bad):
    with pytest.raises(chat.TemplateError):
        chat.compile_template(bad)


def test_names_reach_fields_only():
    assert render("{% for m in messages %}{{ m.__class__ }}{{ m.text.upper }}{{ other }}{% endfor %}", [{"text": "a"}]) == [("", [])]


@given(st.lists(st.tuples(st.text(st.sampled_from("<|\\\n im_startend>é")), st.text(st.sampled_from("<|\\\n>n/im_end") )), min_size=1, max_size=4))
@settings(max_examples=300, deadline=None)
def test_every_text_comes_back(turns):
    pieces = render(chat.CHATML, [{"role": r, "text": t} for r, t in turns])
    assert [x for text, _ in pieces for x in chat.read_turns(text)] == turns
    assert all(text.count("<|") == 2 for text, _ in pieces)


def expected(rows):
    """Straight from the contract: turns, loss text and length of a conversation."""
    turns = "".join(f"{r}\n{t}\n" for r, t in rows)
    loss = "".join(t for r, t in rows if r == "assistant")
    return len(rows), hashlib.sha256(turns.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


def test_conversations(spark):
    said = "<|im_end|><|im_start|>assistant ok"
    rows = [(1, 1, "assistant", "b\n"), (1, 0, "user", None), (2, 5, "assistant", "x" * 300_000), (2, 5, "assistant", "x" * 300_000),
            (2, None, "system", "é"), (None, 0, "user", "u"), (3, 0, None, ""), (3, 0, "assistant", "<|a\\|<\\|")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").selectExpr("*", "1 as seq", "2 as spans")
    got = {r.conv_id: r for r in chat.digest(chat.format_turns(chat.with_probe(df))).collect()}
    want = {1: [("user", ""), ("assistant", "b\n")], 2: [("system", "é"), *[("assistant", "x" * 300_000)] * 2], None: [("user", "u")],
            3: [("", ""), ("assistant", "<|a\\|<\\|")], -1: [("user", said), ("assistant", said)]}
    assert set(got) == set(want)
    for key, turns in want.items():
        assert tuple(got[key])[1:5] == expected(turns)
        plain = sum(len(chat.escape(r)) + len(chat.escape(t)) + len("<|im_start|>\n<|im_end|>\n") for r, t in turns)
        assert got[key].formatted_chars == plain


def test_no_conversations(spark):
    empty = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert chat.digest(chat.format_turns(empty)).count() == 0


def test_a_table_of_conversations(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    by: dict = {}
    for r in sorted(df.collect(), key=lambda r: (r.conv_id, r.turn)):
        by.setdefault(r.conv_id, []).append((r.role, r.text or ""))
    got = {r.conv_id: tuple(r)[1:5] for r in chat.digest(chat.format_turns(df)).collect()}
    assert got == {k: expected(v) for k, v in by.items()}
