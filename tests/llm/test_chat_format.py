from __future__ import annotations

import hypothesis.strategies as st
from hypothesis import HealthCheck, given, settings

from ebbtide.llm.chat_format import Template, chat_format, read_back

SCHEMA = "conv_id long, turn long, role string, text string, formatted string"


def formatted(spark, rows):
    return chat_format(spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA))


def test_segments_and_flags(spark):
    row = formatted(spark, [(1, 0, "user", "hi"), (1, 1, "assistant", "a </turn>")]).collect()[0]
    assert "".join(s["text"] for s in row["segments"]) == row["formatted"]
    assert [s["loss"] for s in row["segments"]] == [False, False, False, False, True, False]
    assert row["formatted"].count("</turn>") == 2 and row["valid"]


def test_state_machine(spark):
    orders = {
        1: (["user", "assistant"], None),
        2: (["system", "user", "assistant", "user", "assistant"], None),
        3: (["assistant", "user"], 0),
        4: (["user", "user", "assistant"], 1),
        5: (["user"], 1),
        6: (["user", "tool", "assistant"], 1),
        7: ([None, "user", "assistant"], 0),
    }
    rows = [(c, t, role, "x") for c, (roles, _) in orders.items() for t, role in enumerate(roles)]
    got = {r["conv_id"]: r["error_turn"] for r in formatted(spark, rows).collect()}
    assert got == {c: error for c, (_, error) in orders.items()}


texts = st.one_of(
    st.none(),
    st.text(max_size=12),
    st.lists(st.sampled_from(["\\", "### ", "User: ", "Assistant: ", "</turn>", "\n", ">: ", "### Role <", "1", "a", "é"]), max_size=8).map("".join),
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 4), st.sampled_from(["user", "assistant", "", "a>: b", "</turn>", None]), texts), max_size=30))
def test_round_trip(spark, turns):
    turns = [(c, r, t if t is None else t.encode("utf-8", "replace").decode()) for c, r, t in turns]
    rows = [(c, i, r, t) for i, (c, r, t) in enumerate(turns)]
    back = {r["conv_id"]: r for r in read_back(formatted(spark, rows)).collect()}
    assert set(back) == {c for c, *_ in turns}
    for conv, row in back.items():
        own = [(r or "", t or "") for c, r, t in turns if c == conv]
        assert [(t["role"], t["text"]) for t in row["turns"]] == own
        assert row["loss_text"] == "".join(t for r, t in own if r == "assistant")


def test_long_repeated_empty(spark):
    rows = [(1, 0, "user", "x" * 300_000), (1, 0, "user", "x" * 300_000), (None, None, None, None)]
    back = {r["conv_id"]: len(r["turns"]) for r in read_back(formatted(spark, rows)).collect()}
    assert back == {1: 2, None: 1}
    assert formatted(spark, []).count() == 0


def test_other_templates(spark):
    own = Template(marks={"user": "<u>", "assistant": "<a>"}, close="<end>", other_open="<r:", other_close=">", loss=("user",))
    df = spark.createDataFrame([(1, 0, "user", "<u><end>\\"), (1, 1, "tool", "<r:x>")], "conv_id long, turn long, role string, text string")
    row = read_back(chat_format(df, own), own).collect()[0]
    assert [tuple(t) for t in row["turns"]] == [("user", "<u><end>\\"), ("tool", "<r:x>")]
    assert row["loss_text"] == "<u><end>\\"
