"""Chat formatting: multi-party perspective rotation.

Every participant of a conversation sees it once as the assistant: their own turns become assistant turns and are
learned from, all others become turns of named users and are masked; system turns stay system turns. A row is one
rendered turn of one perspective, so that a conversation of any length is never gathered in one place; the turns of
(conv_id, perspective) in their order are the rendered dialogue, and learn_from/learn_to are its loss mask.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import read

# The markers of a turn, as in the public ChatML layout.
START, END = "<|im_start|>", "<|im_end|>"
NOBODY = "unknown"


def rotate(
    conversations: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    system: str = "system",
) -> DataFrame:
    """conv_id, perspective, turn, chat_role, name, rendered, learn_from, learn_to (characters of rendered; end exclusive).

    The only join is with the distinct participants of each conversation, which are pre-aggregated; a conversation with
    very many turns is a skewed key of a join that Spark may split. Defined results: a null role speaks as "unknown"; a
    null text is empty; markers inside texts and names are broken up, so that no text can forge a turn; line ends in
    names become spaces; a conversation of system turns only has no participant and no rows; rows without conv_id are
    one conversation; repeated rows and turns that tie are rendered as often as they stand; very long texts are rendered whole; turns may
    be null and keep their value; other columns are ignored; an empty table gives no rows.
    """

    def safe(column):
        return F.replace(column, F.lit("<|"), F.lit("< |"))

    turns = conversations.select(
        F.col(conv_col).alias("conv_id"),
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit(NOBODY)).alias("speaker"),
        safe(F.coalesce(F.col(text_col), F.lit(""))).alias("body"),
    )
    people = turns.where(F.col("speaker") != system).select(F.col("conv_id").alias("conv"), F.col("speaker").alias("perspective")).distinct()
    both = turns.join(people, F.col("conv_id").eqNullSafe(F.col("conv")))
    own = F.col("speaker") == F.col("perspective")
    role = F.when(F.col("speaker") == system, F.lit("system")).when(own, F.lit("assistant")).otherwise(F.lit("user"))
    name = F.when((F.col("speaker") != system) & ~own, F.regexp_replace(safe(F.col("speaker")), "[\r\n]", " "))
    both = both.withColumns({"chat_role": role, "name": name})
    both = both.withColumn("head", F.concat(F.lit(START), "chat_role", F.coalesce(F.concat(F.lit(" name="), "name"), F.lit("")), F.lit("\n")))
    learned = F.col("chat_role") == "assistant"
    return both.select(
        "conv_id",
        "perspective",
        "turn",
        "chat_role",
        "name",
        F.concat("head", "body", F.lit(END + "\n")).alias("rendered"),
        F.when(learned, F.length("head")).otherwise(0).cast("long").alias("learn_from"),
        F.when(learned, F.length("head") + F.length("body") + len(END)).otherwise(0).cast("long").alias("learn_to"),
    )


def op7_chat(spark, sf_dir: str) -> DataFrame:
    return rotate(read(spark, sf_dir, "conversations"))


OP7_SQL = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, 'unknown') AS speaker, replace(coalesce(text, ''), '<|', '< |') AS body FROM conversations),
p AS (SELECT DISTINCT conv_id AS conv, speaker AS perspective FROM t WHERE speaker <> 'system'),
b AS (
  SELECT *, CASE WHEN speaker = 'system' THEN 'system' WHEN speaker = perspective THEN 'assistant' ELSE 'user' END AS chat_role,
    CASE WHEN speaker <> 'system' AND speaker <> perspective THEN regexp_replace(replace(speaker, '<|', '< |'), '[\r\n]', ' ', 'g') END AS name
  FROM t JOIN p ON t.conv_id IS NOT DISTINCT FROM p.conv),
h AS (SELECT *, '<|im_start|>' || chat_role || coalesce(' name=' || name, '') || chr(10) AS head FROM b)
SELECT conv_id, perspective, turn, chat_role, name, head || body || '<|im_end|>' || chr(10) AS rendered,
  (CASE WHEN chat_role = 'assistant' THEN length(head) ELSE 0 END)::BIGINT AS learn_from,
  (CASE WHEN chat_role = 'assistant' THEN length(head) + length(body) + 10 ELSE 0 END)::BIGINT AS learn_to
FROM h
"""
