"""URL filters: pattern rules are indexed by their rarest literal token; the tokens of a url fetch the
candidate rules, and only those run their regular expressions.

Host rules (a host with its subdomains and a path prefix) come first: the longest that fits decides.
Where none fits, a url that any pattern rule matches is blocked, else allowed.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Verdict, host and path of the base rules.
HOST_RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)


@dataclass(frozen=True)
class PatternRule:
    """A regular expression over the lower-cased url and the literal tokens that any match must contain."""

    rule_id: str
    tokens: tuple[str, ...]
    pattern: str


#: Default patterns: each token stands between characters other than a-z and 0-9 in every url that matches.
PATTERNS = (
    PatternRule("tracking", ("utm", "source"), r"[?&]utm_source=[^&#]*"),
    PatternRule("session", ("sessionid",), r"[?&;]sessionid=[0-9a-f]{8,}"),
    PatternRule("adserver", ("ads",), r"^[a-z]+://ads\.[^/?#]+"),
    PatternRule("adclick", ("ad", "click"), r"/ad/click(?:[/?#]|$)"),
    PatternRule("login", ("login",), r"/login(?:[/?#]|$)"),
    PatternRule("cart", ("cart", "checkout"), r"/cart/checkout(?:[/?#]|$)"),
    PatternRule("calendar", ("calendar",), r"/calendar/[0-9]{4}/[0-9]{2}(?:[/?#]|$)"),
    PatternRule("print", ("print", "1"), r"[?&]print=1(?:[&#]|$)"),
    PatternRule("feed", ("feed", "xml"), r"/feed\.xml(?:[?#]|$)"),
    PatternRule("executable", ("exe",), r"\.exe(?:[?#]|$)"),
)

TOKEN = re.compile("[a-z0-9]+")


def lower_az(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host(url: Column) -> Column:
    return F.coalesce(lower_az(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def url_tokens(url: Column) -> Column:
    """Distinct runs of a-z and 0-9 of the lower-cased url; null has none."""
    return F.coalesce(F.array_distinct(F.regexp_extract_all(lower_az(url), F.lit("([a-z0-9]+)"), 1)), F.array().cast("array<string>"))


def host_verdict(h: Column, p: Column, rules=HOST_RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest host rule that fits, else nulls."""
    rule = verdict = F.lit(None).cast("string")
    for word, name, prefix in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1:])):
        fits = ((h == name) | h.endswith("." + name)) & p.startswith(prefix)
        rule, verdict = F.when(fits, name + prefix).otherwise(rule), F.when(fits, word).otherwise(verdict)
    return rule, verdict


def rule_index(urls: DataFrame, rules=PATTERNS) -> list[tuple[str, str, str]]:
    """(token, rule_id, pattern): each rule under that of its tokens which the fewest urls contain.

    Counts the rules' tokens over all urls; the result has one row for each rule.
    """
    wanted = sorted({t for r in rules for t in r.tokens})
    seen = urls.select(F.explode(url_tokens(F.col("url"))).alias("token")).where(F.col("token").isin(wanted))
    n = {r.token: r["count"] for r in seen.groupBy("token").count().collect()}  # one row for each rule token at most
    return [(min(r.tokens, key=lambda t: (n.get(t, 0), t)), r.rule_id, r.pattern) for r in rules]


def pattern_matches(urls: DataFrame, index: list[tuple[str, str, str]]) -> DataFrame:
    """(url, rule_ids) for distinct urls that match: tokens are joined with the index, candidates run their pattern."""
    spark = urls.sparkSession
    rules = spark.createDataFrame(index, "token string, rule_id string, pattern string")
    tokens = urls.select("url", F.explode(url_tokens(F.col("url"))).alias("token"))
    # one row a rule: the rule list is a parameter of fixed size
    candidates = tokens.join(F.broadcast(rules), "token")
    hits = candidates.where(F.regexp_like(lower_az(F.col("url")), F.col("pattern")))
    return hits.groupBy("url").agg(F.array_sort(F.collect_set("rule_id")).alias("rule_ids"))


def judge(pages: DataFrame, host_rules=HOST_RULES, patterns=PATTERNS, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Per page: id, host, path, rule, verdict, pattern_rules.

    A null url, or one without ``://``, has an empty host and path and no host rule. Repeated urls
    are judged once and joined back, so a frequent url costs no more than its rows; other columns are not read.
    """
    rows = pages.select(F.col(id_col).alias("_id"), F.col(url_col).cast("string").alias("url"))
    distinct = rows.where(F.col("url").isNotNull()).distinct()
    hits = pattern_matches(distinct, rule_index(distinct, patterns))
    h, p = host(F.col("url")), path(F.col("url"))
    rule, verdict = host_verdict(F.col("host"), F.col("path"), host_rules)
    method = F.when(F.size("rule_ids") > 0, "block").otherwise("allow")
    return (rows.join(hits, "url", "left").withColumns({"host": h, "path": p})
            .select(F.col("_id").alias(id_col), "host", "path", rule.alias("rule"), F.coalesce(verdict, method).alias("verdict"),
                    F.coalesce(F.array_join("rule_ids", ","), F.lit("")).alias("pattern_rules")))


def judge_sql() -> str:
    """DuckDB SQL for ``judge`` over ``pages`` with the default rules."""
    lower = "translate(url, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    rules = sorted(HOST_RULES, key=lambda r: -len(r[1] + r[2]))
    fits = [f"((host = '{n}' OR ends_with(host, '.{n}')) AND starts_with(path, '{p}'))" for _, n, p in rules]
    rule = " ".join(f"WHEN {f} THEN '{n}{p}'" for f, (_, n, p) in zip(fits, rules))
    base = " ".join(f"WHEN {f} THEN '{w}'" for f, (w, _, _) in zip(fits, rules))
    hit = [f"CASE WHEN regexp_matches({lower}, '{r.pattern}') THEN '{r.rule_id}' END" for r in sorted(PATTERNS, key=lambda r: r.rule_id)]
    return f"""
WITH parts AS (
  SELECT page_id, url,
    coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path,
    concat_ws(',', {', '.join(hit)}) AS pattern_rules
  FROM pages)
SELECT page_id, host, path, CASE {rule} END AS rule,
  CASE {base} WHEN pattern_rules <> '' THEN 'block' ELSE 'allow' END AS verdict, pattern_rules
FROM parts"""
