"""Multi-party perspective rotation of dialogues.

For every participant of a conversation, the dialogue is rendered with that speaker as the assistant, all others as
named users, and a mask of the places (code points, end exclusive) of the assistant's words. System turns stay system
turns and are no participant. Turns are in the order of (turn, name, text). A rendering covers PART_TURNS
consecutive turn numbers, so a long conversation is rendered in parts, each a group of its own. A part is as large as the rows of its turn
numbers: it is bounded where they do not repeat, not where one number, or none, stands on very many rows. Participants meet the parts in a plain
join, whose hot conversations adaptive execution splits.

Cases: a null role is the participant "unknown", a null text is empty, a null turn comes first in a part of its
own (-1), a null conv_id is a conversation. Repeated rows are rendered each. A part in which a participant is silent
is still rendered, with an empty mask. Conversations of system turns only give no row. An empty table gives an empty result; very long texts are rendered whole. The marker "<|" in texts
and names is written "< |". Other columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PART_TURNS = 512


def rotate(turns: DataFrame, part_turns: int = PART_TURNS) -> DataFrame:
    """conv_id, part, participant, n_turns, text, mask of every participant's view; turns: conv_id, turn, role, text."""
    safe = lambda c, missing: F.replace(F.coalesce(F.col(c).cast("string"), F.lit(missing)), F.lit("<|"), F.lit("< |"))
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), safe("role", "unknown").alias("name"), safe("text", "").alias("text"))
    rows = rows.withColumn("part", F.coalesce(F.floor(F.col("turn") / part_turns), F.lit(-1)).cast("long"))
    people = rows.where("name != 'system'").select(F.col("conv_id").alias("c"), F.col("name").alias("participant")).distinct()
    parts = rows.groupBy("conv_id", "part").agg(F.sort_array(F.collect_list(F.struct("turn", "name", "text"))).alias("turns"))
    views = parts.join(people, F.col("conv_id").eqNullSafe(F.col("c")))
    who = F.col("participant")

    def piece(t):
        head = F.when(t["name"] == who, F.lit("<|assistant|>\n")).when(t["name"] == "system", F.lit("<|system|>\n")).otherwise(F.concat(F.lit('<|user name="'), t["name"], F.lit('"|>\n')))
        return F.struct(head.alias("head"), t["text"].alias("text"), (t["name"] == who).alias("mine"))

    def step(done, p):
        start = done["at"] + F.length(p["head"])
        end = start + F.length(p["text"])
        span = F.when(p["mine"], F.array(F.concat_ws(":", start.cast("string"), end.cast("string")))).otherwise(F.array().cast("array<string>"))
        return F.struct((end + 1).alias("at"), F.concat(done["spans"], span).alias("spans"))

    views = views.select("conv_id", "part", "participant", F.transform("turns", piece).alias("pieces"))
    mask = F.aggregate("pieces", F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans")), step, lambda done: F.array_join(done["spans"], ","))
    text = F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["text"], F.lit("\n"))), "")
    return views.select("conv_id", "part", "participant", F.size("pieces").cast("long").alias("n_turns"), text.alias("text"), mask.alias("mask"))


def op7_chat(spark, sf_dir: str) -> DataFrame:
    return rotate(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


OP7_SQL = """
WITH t AS (SELECT conv_id, turn, replace(coalesce(role, 'unknown'), '<|', '< |') AS name, replace(coalesce(text, ''), '<|', '< |') AS text, CAST(coalesce(floor(turn / 512), -1) AS BIGINT) AS part FROM conversations),
p AS (SELECT DISTINCT conv_id, name AS participant FROM t WHERE name <> 'system'),
s AS (SELECT t.*, participant, CASE WHEN name = participant THEN '<|assistant|>' WHEN name = 'system' THEN '<|system|>' ELSE '<|user name="' || name || '"|>' END || chr(10) AS head FROM t JOIN p ON t.conv_id IS NOT DISTINCT FROM p.conv_id),
o AS (SELECT *, coalesce(sum(length(head) + length(text) + 1) OVER (PARTITION BY conv_id, part, participant ORDER BY turn NULLS FIRST, name, text ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(head) AS pos FROM s)
SELECT conv_id, part, participant, count(*) AS n_turns, string_agg(head || text || chr(10), '' ORDER BY turn NULLS FIRST, name, text) AS text,
coalesce(string_agg(CASE WHEN name = participant THEN CAST(CAST(pos AS BIGINT) AS VARCHAR) || ':' || CAST(CAST(pos + length(text) AS BIGINT) AS VARCHAR) END, ',' ORDER BY turn NULLS FIRST, name, text), '') AS mask
FROM o GROUP BY conv_id, part, participant
"""
