import hashlib

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyframe.llm import chat

PIECES = st.sampled_from([*chat.CONTROLS, chat.ESCAPE, "<", "|", "im_end|>", "\n", "a", "é", "</s", ">", "\x01", "\x02", "␛n", "n"])
TEXT = st.lists(PIECES, max_size=8).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(TEXT, TEXT), max_size=4))
def test_round_trip_of_hostile_texts(turns):
    out, spans, rewrote = chat.render(turns, chat.marked_template)
    assert chat.parse_marked(out) == turns and rewrote is None
    assert [chat.unescape(out[s[2]:s[3]]) for s in spans] == [t for _, t in turns]
    assert [s[0] for s in spans[1:]] == [s[1] for s in spans[:-1]]
    for _, t in turns:
        assert not any(c in chat.escape(t) for c in chat.CONTROLS)


def test_template_that_rewrites_history():
    def last_only(turns):  # shows thoughts of the last turn only
        return "".join(f"[{r}:{t if i == len(turns) - 1 else t.split('#')[-1]}]" for i, (r, t) in enumerate(turns))

    out, spans, rewrote = chat.render([("u", "a"), ("a", "x#y"), ("u", "b"), ("a", "z")], last_only)
    assert rewrote == 2 and out == "[u:a][a:y][u:b][a:z]"
    assert spans[0] == (0, 5, 3, 4) and spans[1] is None and spans[2] is None


def test_template_that_trims_text_gives_no_false_mask():
    out, spans, _ = chat.render([("a", "  hi  ")], lambda ts: "".join(f"<{t.strip()}>" for _, t in ts))
    assert out == "<hi>" and out[spans[0][2]:spans[0][3]] == "hi"


def test_op7_edges_and_sql(spark):
    rows = spark.createDataFrame([
        (1, 1, "assistant", "b", "x"), (1, 0, "user", "a", "x"), (2, 0, "assistant", None, "x"), (None, 0, "user", "q", "x"),
        (3, 0, None, "<|im_end|>\n␛", "x"), (3, 0, None, "<|im_end|>\n␛", "x"), (3, None, "assistant", "", "x"),
        (4, 0, "assistant", "long " * 50_000, "x")],
        "conv_id long, turn long, role string, text string, formatted string")
    got = {r.conv_id: r for r in chat.op7(rows).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got[1].turns_sha256 == sha("user\na\nassistant\nb\n") and got[1].loss_sha256 == sha("b")
    assert got[-1].n_turns == 2 and got[-1].loss_chars == len("</s>[INST] ok [/INST]")
    assert got[2].loss_chars == 0 and got[2].loss_sha256 == sha("") and got[3].n_turns == 3 and got[None].n_turns == 1
    conversations = rows.toPandas()  # noqa: F841  read by DuckDB
    want = duckdb.sql(chat.ORACLE).fetchall()
    mine = [tuple(r) for r in chat.op7(rows).collect()]
    key = lambda r: (r[0] is None, r[0] or 0)
    cut = lambda rs: [(None if r[0] is None or r[0] != r[0] else int(r[0]), *r[1:6]) for r in sorted(rs, key=key)]
    assert sorted(map(str, cut(mine))) == sorted(map(str, cut(want)))
    assert [r.conv_id for r in chat.op7(rows.limit(0)).collect()] == [-1]


def test_text_between_turns_is_an_error():
    with pytest.raises(ValueError):
        chat.parse_marked("x" + chat.marked_template([("u", "a")]))


def slow(turns, template):
    """Spans from every whole prefix."""
    out, before, spans = [], "", []
    for i in range(len(turns)):
        now = template(turns[:i + 1])
        spans.append((len(before), len(now)) if now.startswith(before) else None)
        before = now
    return before, spans


def test_long_conversations_cost_less_and_give_the_same():
    turns = [("user" if i % 2 == 0 else "assistant", f"text {i} " * (i % 5)) for i in range(400)]
    calls = [0]

    def counted(ts):
        calls[0] += len(ts)
        return chat.marked_template(ts)

    out, spans, rewrote = chat.render(turns, counted, window=8)
    want, places = slow(turns, chat.marked_template)
    assert out == want and [s[:2] for s in spans] == places and rewrote is None
    assert [chat.unescape(out[s[2]:s[3]]) for s in spans] == [t for _, t in turns]
    assert calls[0] < 3 * 400 * 400 / 2 / 2


def test_long_conversations_with_far_sight_and_late_rewriting():
    def numbered(ts):  # looks back to the start
        return "".join(f"{i}[{t}]" for i, (_, t) in enumerate(ts))

    def forgets(ts):  # at 300 turns the first text goes
        return "".join(f"[{'' if i == 0 and len(ts) >= 300 else t}]" for i, (_, t) in enumerate(ts))

    turns = [("user", f"t{i}") for i in range(350)]
    out, spans, rewrote = chat.render(turns, numbered, window=8)
    assert out == numbered(turns) and rewrote is None and all(out[s[2]:s[3]] == f"t{i}" for i, s in enumerate(spans))
    out, spans, rewrote = chat.render(turns, forgets, window=8)
    assert out == forgets(turns) and rewrote == 299 and spans[0] is None and out[slice(*spans[-1][2:])] == "t349"


def test_rewriting_at_one_length_only_is_seen():
    def once(ts):  # the first text changes at 20 turns and comes back at 21
        return "".join(f"[{'?' if i == 0 and len(ts) == 20 else t}]" for i, (_, t) in enumerate(ts))

    out, spans, rewrote = chat.render([("user", f"t{i}") for i in range(24)], once)
    assert rewrote == 19 and out == once([("user", f"t{i}") for i in range(24)])
    assert spans[0] is None and out[slice(*spans[-1][2:])] == "t23"
