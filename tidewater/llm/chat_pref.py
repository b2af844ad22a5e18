"""Preference formatting: the longest common turn prefix of a chosen and a rejected conversation is rendered once
as the prompt, what differs as two completions with masks of what is trained on.

DataFrame functions only. A conversation's turns are one row, as the training record that comes of them is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.pii import _sums

TRAINED = "assistant"
END = "<|end|>"


def conversations(turns: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """(id, turns): turns as an array of (turn, role, text) in order; ties by role, then text; nulls count as empty.

    Rows without an id belong to no conversation.
    """
    rows = turns.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("t"))
    return rows.groupBy("id").agg(F.array_sort(F.collect_list("t")).alias("turns"))


def common_turns(a: Column, b: Column) -> Column:
    """How many first turns of both have the same role and text."""
    n = F.least(F.size(a), F.size(b))
    same = lambda i: (F.get(a, i)["role"] == F.get(b, i)["role"]) & (F.get(a, i)["text"] == F.get(b, i)["text"])
    count = F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), lambda k, i: F.when((k == i) & same(i), k + 1).otherwise(k))
    return F.when(n > 0, count).otherwise(0)


def _head(t: Column) -> Column:
    return F.concat(F.lit("<|"), t["role"], F.lit("|>\n"))


def _turn(t: Column) -> Column:
    return F.concat(_head(t), t["text"], F.lit(END + "\n"))


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, _turn), "")


def mask(turns: Column) -> Column:
    """(start, end) code points of the rendered turns that are trained on: a trained role's text and its end mark."""
    ends = _sums(F.transform(turns, lambda t: F.length(_turn(t))))
    spans = F.transform(F.arrays_zip(turns.alias("t"), ends.alias("e")), lambda z: F.struct(
        z["t"]["role"].alias("role"), (z["e"] - 1 - len(END) - F.length(z["t"]["text"])).alias("start"), (z["e"] - 1).alias("end")))
    kept = F.transform(F.filter(spans, lambda s: s["role"] == TRAINED), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
    return F.when(F.size(turns) > 0, kept).otherwise(F.array().cast("array<struct<start:int,end:int>>"))


def format_pairs(pairs: DataFrame) -> DataFrame:
    """From (pair_id, chosen, rejected) as arrays of turns: pair_id, n_prompt_turns, prompt, chosen, rejected, both masks.

    Equal conversations have all turns in the prompt and empty completions; an empty side has an empty completion.
    """
    d = pairs.withColumn("_n", common_turns(F.col("chosen"), F.col("rejected")))
    rest = lambda c: F.slice(F.col(c), F.col("_n") + 1, F.size(c))
    d = d.select("pair_id", "_n", F.slice("chosen", 1, F.col("_n")).alias("_prompt"),
                 F.when(F.size("chosen") > 0, rest("chosen")).otherwise(F.col("chosen")).alias("_c"),
                 F.when(F.size("rejected") > 0, rest("rejected")).otherwise(F.col("rejected")).alias("_r"))
    return d.select("pair_id", F.col("_n").cast("long").alias("n_prompt_turns"), render(F.col("_prompt")).alias("prompt"),
                    render(F.col("_c")).alias("chosen"), render(F.col("_r")).alias("rejected"),
                    mask(F.col("_c")).alias("chosen_mask"), mask(F.col("_r")).alias("rejected_mask"))


def swapped_replies(turns: DataFrame) -> DataFrame:
    """Pairs from plain conversations: rejected has the last assistant turn's text from the conversation with the next id.

    Conversations without an assistant turn give no pair; where the next one has none, the text is empty.
    """
    last = F.expr("array_max(filter(sequence(0, size(turns) - 1), i -> turns[i].role = 'assistant'))")
    convs = conversations(turns).withColumn("at", last).where("at IS NOT NULL")
    replies = convs.select((F.col("id") - 1).alias("id"), F.get("turns", F.col("at"))["text"].alias("reply"))
    both = convs.join(replies, "id", "left").withColumn("reply", F.coalesce("reply", F.lit("")))
    other = F.transform("turns", lambda t, i: F.struct(t["turn"].alias("turn"), t["role"].alias("role"),
                                                       F.when(i == F.col("at"), F.col("reply")).otherwise(t["text"]).alias("text")))
    return both.select(F.col("id").alias("pair_id"), F.col("turns").alias("chosen"), other.alias("rejected"))


def preferences(turns: DataFrame) -> DataFrame:
    """``format_pairs`` over ``swapped_replies``, masks as text (start:end, comma-joined)."""
    listed = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",")
    return format_pairs(swapped_replies(turns)).withColumns({c: listed(c) for c in ("chosen_mask", "rejected_mask")})


PREFERENCES_SQL = f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY turn, role, text) AS a FROM t GROUP BY conv_id),
k AS (SELECT conv_id, a, list_max(list_filter(range(1, len(a) + 1), lambda i: a[i].role = 'assistant')) AS k FROM c),
p AS (SELECT k.conv_id, k.a, k.k, coalesce(n.a[n.k].text, '') AS reply FROM k LEFT JOIN k AS n ON n.conv_id = k.conv_id + 1 AND n.k IS NOT NULL
  WHERE k.k IS NOT NULL),
q AS (SELECT conv_id, a, CASE WHEN a[k].text = reply THEN len(a) ELSE k - 1 END AS n,
  list_transform(range(1, len(a) + 1), lambda i: {{'role': a[i].role, 'text': CASE WHEN i = k THEN reply ELSE a[i].text END}}) AS b FROM p),
r AS (SELECT conv_id, n, a[1:n] AS p, a[n + 1:len(a)] AS c, b[n + 1:len(b)] AS r FROM q),
s AS (SELECT conv_id, n, {', '.join(f"list_transform({x}, lambda x: '<|' || x.role || '|>' || chr(10) || x.text || '{END}' || chr(10)) AS {x}t, list_transform({x}, lambda x: x.role) AS {x}r, list_transform({x}, lambda x: length(x.text)) AS {x}l" for x in 'pcr')} FROM r)
SELECT conv_id AS pair_id, n AS n_prompt_turns, coalesce(array_to_string(pt, ''), '') AS prompt, coalesce(array_to_string(ct, ''), '') AS chosen,
  coalesce(array_to_string(rt, ''), '') AS rejected,
  {', '.join(f"coalesce(array_to_string(list_transform(list_filter(range(1, len({x}t) + 1), lambda i: {x}r[i] = 'assistant'), lambda i: CAST(length(array_to_string({x}t[1:i], '')) - {len(END) + 1} - {x}l[i] AS VARCHAR) || ':' || CAST(length(array_to_string({x}t[1:i], '')) - 1 AS VARCHAR)), ','), '') AS {name}_mask" for x, name in (('c', 'chosen'), ('r', 'rejected')))}
FROM s"""
