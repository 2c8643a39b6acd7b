"""Operator 2: round trips and the loss mask against plain code."""
from pyspark.sql import functions as F

from acct_health.llm import chat

ODD = [None, "", "\\", "\\\\", "a\\</turn>", "</turn>\n### user: x", "</part></part>", "###", "\\###\\", "#", "<", "é😀\n\nx", "### assistant: </turn> ok", "a" * 300]


def turns(spark):
    rows = [(1, i, ["user", "assistant"][i % 2], t) for i, t in enumerate(ODD)]
    rows += [(2, i, "assistant", t) for i, t in enumerate(ODD)]  # one block
    rows += [(3, 0, "sys:tem #<\\", "x"), (3, 0, "sys:tem #<\\", "x"), (3, None, None, None), (None, 5, "user", "y"), (4, 9, "", "")]
    return spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, formatted string").repartition(3)


def test_round_trip(spark):
    rows = turns(spark)
    want = {}
    for r in rows.collect():
        want.setdefault(r["conv_id"], []).append((-1 if r["turn"] is None else r["turn"], r["role"] or "", r["text"] or ""))
    got = chat.read_back(chat.formatted(rows)).collect()
    assert len(got) == len(want)
    for r in got:
        given = [x[1:] for x in sorted(want[r["conv_id"]])]
        assert [tuple(t) for t in r["turns"]] == given
        assert r["loss"] == "".join(t for role, t in given if role == "assistant")
        assert r["n_blocks"] == sum(i == 0 or given[i - 1][0] != x[0] for i, x in enumerate(given))
        assert len(r["loss_spans"]) == sum(role == "assistant" for role, _ in given)


def test_empty_and_plan(spark):
    rows = chat.formatted(turns(spark).where("false"))
    assert rows.count() == 0
    plan = chat.read_back(chat.formatted(turns(spark)))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))
