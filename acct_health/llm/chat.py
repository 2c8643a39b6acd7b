r"""Chat formatting in DataFrame expressions only (operator 2).

A conversation's turns are collected as structs and sorted by turn (ties by role, then text);
adjacent turns of one role are merged into a block by an array aggregation. A block reads

    ### role: text</part>text</turn>

with a line feed after it; ``</part>`` stands between the texts of merged turns, so each turn can be
read back. Inside texts a backslash and each of the control strings ``###``, ``</turn>`` and
``</part>`` gets a backslash before it, in roles every backslash, colon, # and <. The loss mask is a
list of spans of the formatted text, in code points, one for each turn of the learned role.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acct_health.llm.common import read_table, written

CONTROL = r"(\\|###|</turn>|</part>)"
LEARNED = "assistant"
BLOCK = r"(?s)### ((?:[^\\:]++|\\.)*+): ((?:[^\\<]++|\\.|<(?!/turn>))*+)</turn>\n"
PART = r"(?s)((?:[^\\<]++|\\.|<(?!/part>))*+)</part>"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"\\$1")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"\\" + CONTROL, "$1")


def _merge(blocks: Column, turn: Column) -> Column:
    """One step of the aggregation: the turn joins the last block if that has its role, else begins one."""
    last = F.try_element_at(blocks, F.lit(-1))
    joined = F.struct(last["role"].alias("role"), F.concat(last["texts"], F.array(turn["text"])).alias("texts"))
    fresh = F.struct(turn["role"].alias("role"), F.array(turn["text"]).alias("texts"))
    return F.when((F.size(blocks) > 0) & (last["role"] == turn["role"]),
                  F.concat(F.slice(blocks, F.lit(1), F.size(blocks) - 1), F.array(joined))).otherwise(F.concat(blocks, F.array(fresh)))


def formatted(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
              learned: str = LEARNED) -> DataFrame:
    """(conv_id, n_blocks, formatted, loss_spans) of each conversation.

    Null texts and null roles are empty. Rows with a null conv_id are one conversation; a null turn comes first;
    rows that repeat are turns like any other. An empty table gives no rows. Further columns are not
    looked at. A conversation becomes one value, so it must fit into a row.
    """
    rows = turns.select(F.col(conv).alias("conv_id"), F.struct(
        F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text")).alias("t"))
    kept = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    none = F.array().cast("array<struct<role:string,texts:array<string>>>")
    blocks = kept.select("conv_id", F.aggregate("turns", none, _merge).alias("blocks"))

    def pieces(block):
        """Per turn what stands before its text, its escaped text and what stands after it."""
        head = F.concat(F.lit("### "), F.regexp_replace(block["role"], r"([\\:#<])", r"\\$1"), F.lit(": "))
        return F.transform(block["texts"], lambda t, i: F.struct(
            F.when(i == 0, head).otherwise("").alias("head"), escaped(t).alias("text"),
            F.when(i == F.size(block["texts"]) - 1, "</turn>\n").otherwise("</part>").alias("tail"),
            (block["role"] == learned).alias("loss")))

    laid = blocks.select("conv_id", F.size("blocks").cast("long").alias("n_blocks"), F.flatten(F.transform("blocks", pieces)).alias("pieces"))

    def span(acc, p):
        start = acc["at"] + F.length(p["head"])
        end = start + F.length(p["text"])
        here = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct((end + F.length(p["tail"])).alias("at"), F.when(p["loss"], F.concat(acc["spans"], here)).otherwise(acc["spans"]).alias("spans"))

    first = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))
    return laid.select("conv_id", "n_blocks",
                       F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["text"], p["tail"])), "").alias("formatted"),
                       F.aggregate("pieces", first, span)["spans"].alias("loss_spans"))


def read_back(rows: DataFrame) -> DataFrame:
    """``rows`` of ``formatted`` with turns (array<struct<role, text>>) and loss (the text under the mask), from the output alone."""
    taken = rows.withColumns({"__roles": F.regexp_extract_all("formatted", F.lit(BLOCK), F.lit(1)),
                              "__bodies": F.regexp_extract_all("formatted", F.lit(BLOCK), F.lit(2))})

    def parts(x):
        role = F.regexp_replace(x["role"], r"(?s)\\(.)", "$1")
        texts = F.regexp_extract_all(F.concat(x["body"], F.lit("</part>")), F.lit(PART), F.lit(1))
        return F.transform(texts, lambda t: F.struct(role.alias("role"), unescaped(t).alias("text")))

    turns = F.flatten(F.transform(F.arrays_zip(F.col("__roles").alias("role"), F.col("__bodies").alias("body")), parts))
    under = F.transform("loss_spans", lambda s: unescaped(F.substring(F.col("formatted"), s["start"] + 1, s["end"] - s["start"])))
    return taken.withColumns({"turns": turns, "loss": F.array_join(under, "")}).drop("__roles", "__bodies")


ODD = r"\### Assistant: </turn> ok"


def op2_chat(spark, sf_dir: str) -> DataFrame:
    """All conversations and conversation -7, formatted, written, and read back."""
    given = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(ODD).alias("text"))
    back = read_back(written(formatted(given.unionByName(odd)), "chat"))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
                       F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"), "n_blocks")


OP2_SQL = r"""
WITH t AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL
    SELECT -7, i, CASE i WHEN 0 THEN 'user' ELSE 'assistant' END, '\### Assistant: </turn> ok' FROM range(2) r(i)
), n AS (
    SELECT *, lag(role) OVER w IS DISTINCT FROM role AS opens, lead(role) OVER w IS DISTINCT FROM role AS closes
    FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length(regexp_replace(text, '(\\|###|</turn>|</part>)', '\\\1', 'g'))
           + CASE WHEN opens THEN 6 + length(regexp_replace(role, '([\\:#<])', '\\\1', 'g')) ELSE 0 END
           + CASE WHEN closes THEN 8 ELSE 7 END)::BIGINT AS formatted_chars,
       count(*) FILTER (opens) AS n_blocks
FROM n GROUP BY conv_id
"""
