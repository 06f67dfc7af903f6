"""Chat formatting: exact round trip."""

import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tadkit.llm.chat import escape_text, format_chats, parse_turns, read_back, unescape_text
from tadkit.llm.queries import ORACLE, op4_format_chats
from tadkit.plans.verify import compare, duck

SMALL = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"
PIECES = st.lists(st.sampled_from(["### ", "</turn>", "\\", "\n", "a", ":", "<", "#", " ", "é", "assistant"]), max_size=8).map("".join)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_against_sql(spark):
    st_ = compare(spark, duck(SMALL), "op4", op4_format_chats, ORACLE["op4_format_chats"], SMALL)
    assert st_["status"].startswith("ok"), st_


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(PIECES, PIECES), min_size=1, max_size=12))
def test_round_trip(spark, turns):
    rows = [(i // 3, i, r, t) for i, (r, t) in enumerate(turns)]
    got = {r.conv_id: r for r in read_back(format_chats(spark.createDataFrame(rows, SCHEMA))).collect()}
    for c in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == c]
        loss = "".join(t for _, _, r, t in own if r == "assistant")
        assert got[c].n_turns == len(own) and got[c].turns_sha256 == sha("".join(f"{r}\n{t}\n" for _, _, r, t in own))
        assert got[c].loss_sha256 == sha(loss) and got[c].loss_chars == len(loss)


def test_edge_cases(spark):
    rows = [(None, 1, None, None), (1, None, "user", "b"), (1, 0, "assistant", "x" * 200_000), (1, 0, "assistant", "x" * 200_000), (2, 0, "assistant", "")]
    d = spark.createDataFrame([(*r, "k") for r in rows], SCHEMA + ", out string")
    got = {r.conv_id: r for r in read_back(format_chats(d)).collect()}
    assert {k: (v.n_turns, v.loss_chars) for k, v in got.items()} == {None: (1, 0), 1: (3, 400_000), 2: (1, 0)}
    assert format_chats(d.limit(0)).collect() == []


def test_plain_texts_are_not_escaped(spark):
    out = format_chats(spark.createDataFrame([(1, 0, "user", "a \\ b ###")], SCHEMA)).first().formatted
    assert out == "### user: a \\ b ###\n</turn>\n"


def test_broken_grammar_gives_null(spark):
    d = spark.createDataFrame([("### user: a\n</turn>\n### user b\n</turn>\n",)], "f string")
    turns = d.select(parse_turns(F.col("f")).alias("t")).first().t
    assert [t.text for t in turns] == ["a", None]


def test_escape_inverts(spark):
    d = spark.createDataFrame([(r"\\### </turn>\</turn>### ",)], "t string")
    assert d.select(unescape_text(escape_text(F.col("t"))).alias("u")).first().u == r"\\### </turn>\</turn>### "
