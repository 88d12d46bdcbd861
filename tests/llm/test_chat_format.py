"""op6: exact round trip, budgets, each target once."""

import hashlib

from contentflow.llm.chat_format import escape, format_conversations, read_turns, render, unescape
from contentflow.llm.queries import QUERIES
from contentflow.llm.tokens import vocabulary_path

ODD = "\\### Assistant: </turn> ok"


def plain(rows):
    """The contract's columns, from the rows alone."""
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        all_ = hashlib.sha256("".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in turns).encode()).hexdigest()
        loss = "".join(r[3] or "" for r in turns if r[2] == "assistant")
        out[conv] = (len(turns), all_, len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def got(df):
    return {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in df.collect()}


def test_whole_table(spark):
    d = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-7, 0, "user", ODD), (-7, 1, "assistant", ODD)]
    df = QUERIES["op6_chat_format"](spark, d)
    assert got(df) == plain(rows)
    assert all(r["formatted_chars"] >= r["loss_chars"] for r in df.collect())


ROWS = [(1, 0, "system", "Be <brief>."), *[(1, t, ("user", "assistant")[t % 2 == 0], f"word{t} " * (t % 9 + 1)) for t in range(1, 120)],
        (2, 0, "assistant", None), (2, None, None, "\\<>\\\\"), (2, 0, "assistant", None), (2, 3, "system", "late"),
        (3, 0, "user", "long " * 3000), (3, 1, "assistant", "é\U0001F600\n</turn>\n<turn user>" * 50), (None, 1, "assistant", "no id"),
        (4, 0, "system", "only"), (5, 0, "we<ird>\\role", "x")]


def test_windows(spark):
    from contentflow.llm.chat_format import conversation_digests
    df = spark.createDataFrame(ROWS, "conv_id long, turn long, role string, text string").repartition(4)
    windows = format_conversations(df, vocabulary_path(), budget=64, history=20).collect()
    assert got(conversation_digests(format_conversations(df, vocabulary_path(), budget=64, history=20))) == plain(ROWS)
    one = sorted((w for w in windows if w["conv_id"] == 1), key=lambda w: w["window"])
    assert len(one) > 5
    for w in one:
        turns = read_turns(w["text"])
        assert turns[0] == ("system", "Be <brief>.")
        assert w["n_tokens"] <= 64 or (w["over"] and len(turns) - w["known"] == 1)
        assert "".join(render(*t)[0] for t in turns) == w["text"]
    assert any(w["known"] > 1 for w in one)
    assert [w["over"] for w in windows if w["conv_id"] == 3] == [True, True]


def test_escaping():
    for text in ("", ODD, "\\", "\\\\<", "<turn user>x</turn>\n", "a\\<b>\n"):
        assert unescape(escape(text)) == text
        assert read_turns(render("r", text)[0] * 2) == [("r", text)] * 2


def test_empty(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert format_conversations(df, vocabulary_path()).collect() == []
