"""Quality rules as a bitmask ledger: every rule is evaluated once, its failure is a bit, and what it measured
is kept. Policies are versioned masks over the bits; ablations follow from counts of the bit patterns.

DataFrame functions only. Words are runs of characters other than space and \\x09-\\x0D.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """``failed`` is SQL over the measurements; the rule's place in RULES is its bit."""

    name: str
    failed: str


RULES = (
    Rule("few_words", "n_words < 50"),
    Rule("repeat_words", "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", "100 * n_symbols > 30 * n_words"),
    Rule("dup_lines", "n_lines >= 4 AND 100 * n_dup_lines > 50 * n_lines"),
    Rule("word_length", "n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 30 * n_words)"),
    Rule("capitals", "n_words > 0 AND 100 * n_upper > 50 * word_chars"),
    Rule("exclamations", "100 * n_exclaim > 50 * n_words"),
)

#: Policy versions: names of the rules that reject.
POLICIES = {
    "base": ("few_words", "repeat_words"),
    "v1": ("few_words", "repeat_words", "symbols", "dup_lines"),
    "v2": tuple(r.name for r in RULES),
}
POLICY = "v2"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper", "n_exclaim")


def mask(policy: str, rules=RULES, policies=POLICIES) -> int:
    return sum(1 << i for i, r in enumerate(rules) if r.name in policies[policy])


def _count(text: Column, chars: str) -> Column:
    """How many characters of ``chars`` a text has."""
    return (F.length(text) - F.length(F.translate(text, chars, ""))).cast("long")


def words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(F.length(trimmed) > 0, F.split(trimmed, SPACE)).otherwise(F.array().cast("array<string>"))


def _windows(ws: Column) -> Column:
    """xxhash64 of each window of three words."""
    last = F.size(ws) - 2
    return F.when(last > 0, F.transform(F.sequence(F.lit(0), last - 1), lambda i: F.xxhash64(F.get(ws, i), F.get(ws, i + 1), F.get(ws, i + 2)))
                  ).otherwise(F.array().cast("array<bigint>"))


def _covered(places: Column) -> Column:
    """Words covered by windows of three that start at the given sorted places."""
    start = F.struct(F.lit(-3).alias("at"), F.lit(0).cast("long").alias("n"))
    step = lambda acc, p: F.struct(p.alias("at"), (acc.n + F.least(F.lit(3), p - acc.at)).alias("n"))
    return F.aggregate(places, start, step, lambda acc: acc.n)


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id and MEASURES over the whole text; null counts as empty."""
    d = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    d = d.select(id_col, "_text", words(F.col("_text")).alias("_words"),
                 F.filter(F.split("_text", "\n"), lambda x: F.length(F.btrim(x, F.lit(SPACES))) > 0).alias("_lines"))
    d = d.withColumn("_grams", _windows(F.col("_words")))
    counted = d.select(
        id_col, "_grams",
        F.size("_words").cast("long").alias("n_words"),
        F.aggregate("_words", F.lit(0).cast("long"), lambda n, w: n + F.length(w)).alias("word_chars"),
        _count(F.col("_text"), SYMBOLS).alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.length(F.regexp_replace("_text", "[^A-Z]+", "")).cast("long").alias("n_upper"),
        F.length(F.regexp_replace("_text", "[^!]+", "")).cast("long").alias("n_exclaim"))
    # windows are sorted with their places only where some window occurs twice
    twice = F.size(F.array_distinct("_grams")) < F.size("_grams")
    pairs = F.array_sort(F.transform("_grams", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    counted = counted.withColumn("_sorted", F.when(twice, pairs))
    near = lambda x, k: F.coalesce(F.get("_sorted", k - 1)["g"] == x.g, F.lit(False)) | F.coalesce(F.get("_sorted", k + 1)["g"] == x.g, F.lit(False))
    places = F.array_sort(F.transform(F.filter("_sorted", near), lambda x: x.i))
    return counted.withColumn("n_repeat_words", F.coalesce(_covered(places), F.lit(0).cast("long"))).select(id_col, *MEASURES)


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules=RULES) -> DataFrame:
    """Per document: id, MEASURES and ``fail_bits``, the rules that it fails."""
    bits = reduce(lambda a, b: a.bitwiseOR(b), [F.when(F.expr(r.failed), F.lit(1 << i)).otherwise(F.lit(0)) for i, r in enumerate(rules)])
    return measure(docs, id_col, text_col).withColumn("fail_bits", bits.cast("long"))


def passes(policy: str = POLICY) -> Column:
    return F.col("fail_bits").bitwiseAND(F.lit(mask(policy)).cast("long")) == 0


def ablation(marked: DataFrame, rules=RULES, policies=POLICIES) -> DataFrame:
    """(policy, rule, n_kept, n_failed, n_only): rows that the policy keeps, rows that fail the rule, and rows
    that only this rule rejects, from one count for each bit pattern.
    """
    patterns = marked.groupBy("fail_bits").agg(F.count(F.lit(1)).alias("n"))
    plan = [F.struct(F.lit(p).alias("policy"), F.lit(r.name).alias("rule"), F.lit(mask(p, rules, policies)).cast("long").alias("mask"),
                     F.lit(1 << i).cast("long").alias("bit")) for p in policies for i, r in enumerate(rules) if r.name in policies[p]]
    rows = patterns.select("fail_bits", "n", F.explode(F.array(*plan)).alias("p"))
    rejected = F.col("fail_bits").bitwiseAND(F.col("p.mask"))
    total = lambda c: F.sum(F.when(c, F.col("n")).otherwise(F.lit(0)))
    return rows.groupBy("p.policy", "p.rule").agg(
        total(rejected == 0).alias("n_kept"), total(F.col("fail_bits").bitwiseAND(F.col("p.bit")) != 0).alias("n_failed"),
        total(rejected == F.col("p.bit")).alias("n_only"))


def judge(docs: DataFrame, policy: str = POLICY) -> DataFrame:
    """Per document: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, fail_bits, ...

    Null and empty texts have no words and fail the base; repeated rows repeat; an empty table gives
    no rows; other columns are not read.
    """
    first = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return ledger(docs).select(*first, (~passes("base")).alias("base_failed"), (passes("base") & passes(policy)).alias("kept"),
                               "fail_bits", "n_lines", "n_upper", "n_exclaim")


def judge_sql() -> str:
    """DuckDB SQL for ``judge`` over ``documents`` with the default policy."""
    bits = " + ".join(f"CASE WHEN {r.failed} THEN {1 << i} ELSE 0 END" for i, r in enumerate(RULES))
    space = r"[\x20\x09-\x0D]"
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT rid, list_filter(regexp_split_to_array(text, '{space}+'), lambda x: x <> '') AS ws FROM d),
spot AS (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM w),
g AS (SELECT rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g FROM spot),
twice AS (SELECT rid, g FROM g GROUP BY rid, g HAVING count(*) > 1),
covered AS (SELECT rid, count(DISTINCT i + o) AS n FROM (SELECT g.rid, g.i, unnest([0, 1, 2]) AS o FROM g JOIN twice USING (rid, g)) GROUP BY rid),
lines AS (SELECT rid, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
m AS (SELECT doc_id, len(ws) AS n_words, length(regexp_replace(text, '{space}+', '', 'g')) AS word_chars,
  length(text) - length(translate(text, '{SYMBOLS}', '')) AS n_symbols, len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
  coalesce(covered.n, 0) AS n_repeat_words, length(regexp_replace(text, '[^A-Z]+', '', 'g')) AS n_upper,
  length(regexp_replace(text, '[^!]+', '', 'g')) AS n_exclaim
  FROM d JOIN w USING (rid) JOIN lines USING (rid) LEFT JOIN covered USING (rid)),
b AS (SELECT *, {bits} AS fail_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (fail_bits & {mask('base')}) <> 0 AS base_failed,
  (fail_bits & {mask('base') | mask(POLICY)}) = 0 AS kept, CAST(fail_bits AS BIGINT) AS fail_bits, n_lines, n_upper, n_exclaim
FROM b"""
