"""Chat formatting by prefix-target expansion, in DataFrame functions.

Every assistant turn becomes an example of its own: all turns before it as context, and its text alone under
the loss mask. Turns after the last assistant turn (or all, where there is none) come in one more example
without a target, so that no turn is lost. A turn is written ``<|start|>role<|message|>text<|end|>``; in
roles and texts a backslash is doubled and one is put behind each ``<`` and ``[``, so neither these marks nor
those of other templates (``</s>``, ``[INST]``) can appear in them, and the way back is unique.

The expansion repeats a conversation's turns once for each of its replies: that is the method. A
conversation is one unit of context and is gathered as one row.

Nulls and empties: null roles and texts are empty; rows with a null conv_id are one conversation; null turns
come first; ties in turn go by role, then text; repeated rows are turns of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

START, MESSAGE, END = "<|start|>", "<|message|>", "<|end|>"
TURN = r"(?s)<\|start\|>(.*?)<\|message\|>(.*?)<\|end\|>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[\\])", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[\\])\\", "$1")


def _render(role: Column, text: Column) -> Column:
    return F.concat(F.lit(START), role, F.lit(MESSAGE), text, F.lit(END))


def expand(conversations: DataFrame, trained: str = "assistant") -> DataFrame:
    """(conv_id, example int, text, mask_start int, mask_end int): formatted examples in order.

    The loss mask is [mask_start, mask_end) in code points of ``text``; both null in one without a target.
    """
    clean = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    turns = clean.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    plain = turns.select("conv_id", F.transform("turns", lambda t: F.struct((t["role"] == trained).alias("target"), escape(t["role"]).alias("role"), escape(t["text"]).alias("text"))).alias("turns"))
    at = F.filter(F.sequence(F.lit(1), F.size("turns")), lambda i: F.element_at("turns", i)["target"] | (i == F.size("turns")))
    each = plain.select("conv_id", "turns", F.posexplode(at).alias("example", "upto"))
    last = F.element_at("turns", F.col("upto"))
    context = F.array_join(F.transform(F.slice("turns", F.lit(1), F.col("upto") - 1), lambda t: _render(t["role"], t["text"])), "")
    rows = each.select("conv_id", "example", context.alias("context"), last.alias("last"))
    begin = F.length("context") + F.length("last.role") + len(START) + len(MESSAGE)
    return rows.select(
        "conv_id",
        "example",
        F.concat("context", _render(F.col("last.role"), F.col("last.text"))).alias("text"),
        F.when(F.col("last.target"), begin).alias("mask_start"),
        F.when(F.col("last.target"), begin + F.length("last.text")).alias("mask_end"),
    )


def read_back(examples: DataFrame) -> DataFrame:
    """(conv_id, turns array<struct<role, text>>, loss string, formatted_chars long), from the examples alone."""
    loss = unescape(F.coalesce(F.expr("substring(text, mask_start + 1, mask_end - mask_start)"), F.lit("")))
    found = examples.groupBy("conv_id").agg(
        F.max_by("text", "example").alias("longest"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("example", loss.alias("loss")))), lambda x: x["loss"]), "").alias("loss"),
        F.sum(F.length("text").cast("long")).alias("formatted_chars"),
    )
    part = lambda n: F.regexp_extract_all("longest", F.lit(TURN), F.lit(n))
    turns = F.transform(F.arrays_zip(part(1).alias("role"), part(2).alias("text")), lambda t: F.struct(unescape(t["role"]).alias("role"), unescape(t["text"]).alias("text")))
    return found.select("conv_id", turns.alias("turns"), "loss", "formatted_chars")


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    text = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
    back = read_back(expand(given.unionByName(more)))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss"), 256).alias("loss_sha256"),
        "formatted_chars",
    )


SQL = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, length(role) + length(text) + length(regexp_replace(role || text, '[^<\[\\]', '', 'g')) + length('<|start|><|message|><|end|>') AS chars,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS k, count(*) OVER (PARTITION BY conv_id) AS n FROM c),
s AS (SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY k) AS upto FROM e)
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(upto) FILTER (role = 'assistant' OR k = n) AS BIGINT) AS formatted_chars
FROM s GROUP BY conv_id
"""

QUERIES = {"op2_chat_format": op2_chat_format}
ORACLES = {"op2_chat_format": SQL}
