"""Chat formatting by multi-party perspective rotation, in DataFrame functions only.

For every participant of a dialogue (every role but `system`), the dialogue is rendered once more with that speaker as
the assistant, the others as named users, and a mask over the speaker's own words. A rendering is a sequence of parts of
`PART` turns, so that a dialogue of any length is spread over tasks; its parts, put together in order, are the rendering,
and the mask counts code points from its beginning, whatever the parts.

Nulls: a null role is the participant `unknown`; a null text is empty; a null conv_id is a conversation of its own; a
null turn comes first. Turns that tie are ordered by role and text; repeated rows are each rendered. A conversation with
system turns only has no rendering. Further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import numbered

PART = 256


def perspectives(conversations: DataFrame, part: int = PART) -> DataFrame:
    """conv_id, perspective, part, n_turns, rendered, mask (code point spans `from-to`, end excluded, joined by commas)."""
    c = F.col
    key = F.coalesce(c("conv_id").cast("string"), F.lit("null")).alias("conv")
    turns = conversations.select(key, "conv_id", "turn", F.coalesce("role", F.lit("unknown")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    turns, _ = numbered(turns, [c("conv"), c("turn").asc_nulls_first(), c("role"), c("text")], "turns")
    first = turns.groupBy("conv").agg(F.min("idx").alias("first"))
    views = turns.where("role != 'system'").select("conv", c("role").alias("perspective")).distinct().join(first, "conv")
    seen = turns.join(views, "conv").withColumn("at", c("idx") - c("first"))
    own = c("role") == c("perspective")
    head = F.when(own, F.lit("<|im_start|>assistant\n")).when(c("role") == "system", F.lit("<|im_start|>system\n")).otherwise(F.concat(F.lit("<|im_start|>user name="), c("role"), F.lit("\n")))
    tail = "<|im_end|>\n"
    keys = ["conv", "conv_id", "perspective", "part"]
    turn = seen.withColumn("part", F.floor(c("at") / part).cast("long")).withColumn("head", head).withColumn("own", own)
    turn = turn.withColumn("chars", F.char_length("head") + F.char_length("text") + F.lit(len(tail)))
    # Offsets: of the turn in its part, `part` rows at most a window; of the part in its dialogue, one narrow row a part.
    inside = Window.partitionBy(*keys).orderBy("at")
    placed = turn.withColumn("from", F.sum("chars").over(inside) - c("chars"))
    mine = F.when(c("own"), F.struct((c("from") + F.char_length("head")).alias("a"), (F.char_length("text") + F.lit(len(tail) - 1)).alias("n")))
    piece = F.struct("at", F.concat("head", "text", F.lit(tail)).alias("said"), mine.alias("mine"))
    grouped = placed.groupBy(*keys).agg(F.array_sort(F.collect_list(piece)).alias("p"), F.sum("chars").alias("chars"))
    sizes = turn.groupBy("conv", "perspective", "part").agg(F.sum("chars").alias("chars"))
    before = Window.partitionBy("conv", "perspective").orderBy("part")
    starts = sizes.select("conv", "perspective", "part", (F.sum("chars").over(before) - c("chars")).alias("begin"))
    whole = grouped.drop("chars").join(starts, ["conv", "perspective", "part"])
    span = lambda x: F.when(x["mine"].isNotNull(), let_span(c("begin") + x["mine"]["a"], x["mine"]["n"]))
    return whole.select(
        "conv_id", "perspective", "part", F.size("p").cast("long").alias("n_turns"),
        F.array_join(F.transform("p", lambda x: x["said"]), "").alias("rendered"),
        F.array_join(F.array_compact(F.transform("p", span)), ",").alias("mask"),
    )


def let_span(a, n):
    """`from-to`: the text and the end mark that the speaker learns to write."""
    return F.concat(a.cast("string"), F.lit("-"), (a + n).cast("string"))


ORACLE = """
WITH t AS (
  SELECT conv_id, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, 'unknown'), coalesce(text, '')) - 1 AS pos
  FROM conversations),
v AS (SELECT DISTINCT conv_id, role AS perspective FROM t WHERE role <> 'system'),
s AS (
  SELECT t.conv_id, v.perspective, t.pos // 256 AS part, t.pos, t.text, t.role = v.perspective AS own,
         CASE WHEN t.role = v.perspective THEN '<|im_start|>assistant' || chr(10) WHEN t.role = 'system' THEN '<|im_start|>system' || chr(10)
              ELSE '<|im_start|>user name=' || t.role || chr(10) END AS head
  FROM t JOIN v ON t.conv_id IS NOT DISTINCT FROM v.conv_id),
o AS (
  SELECT *, coalesce(sum(length(head) + length(text) + 11) OVER (PARTITION BY conv_id, perspective ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT + length(head) AS a
  FROM s)
SELECT conv_id, perspective, part::BIGINT AS part, count(*) AS n_turns,
       string_agg(head || text || '<|im_end|>' || chr(10), '' ORDER BY pos) AS rendered,
       coalesce(string_agg(CASE WHEN own THEN a::VARCHAR || '-' || (a + length(text) + 10)::VARCHAR END, ',' ORDER BY pos), '') AS mask
FROM o GROUP BY conv_id, perspective, part
"""
