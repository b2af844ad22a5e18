"""Queries for the scalar text functions (T1-T23) and the text filters.

Inputs are whole ``documents`` / ``conversations`` / ``pages`` tables; the
markers the reference looks for (boilerplate, 'Key: value' lines, numbered
answers) are appended by the same expression on both sides.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.functions import text as T
from tidewater.functions.vocab import english_stop_words
from tidewater.operators import filters
from tidewater.operators.text_ops import lexicon_from_words, preprocess_article, preprocess_words
from tidewater.plans.registry import query
from tidewater.plans.views import ARTICLES_SQL, articles
from tidewater.sources.tables import scan_table

WS = f"[{T.PY_SPACE}]"


def s_strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def s_clean(x: str) -> str:
    y = f"regexp_replace({x}, '[^\\x{{00}}-\\x{{7F}}]+', ' ', 'g')"
    y = f"regexp_replace({y}, '[\\r\\n\\t]+', ' ', 'g')"
    y = f"regexp_replace({y}, '{WS}+', ' ', 'g')"
    return f"trim({y})"


def s_list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def docs(spark, sf_dir):
    return scan_table(spark, sf_dir, "documents")


# ---------------------------------------------------------------- T1
@query("clean_text", sql=f"SELECT doc_id, {s_clean('text')} AS cleaned FROM documents")
def q_clean_text(spark, sf_dir):
    """T1 over every document text."""
    return docs(spark, sf_dir).select("doc_id", T.clean_text("text").alias("cleaned"))


# ---------------------------------------------------------------- T2 / T3
BOILER = "text || '... more (Reporting by ' || source || ') (Editing x) Join the gCaptain club'"


def s_cut(x: str, marker: str) -> str:
    return s_strip(f"split_part({x}, '{marker}', 1)")


def s_trim_boilerplate(link: str, d: str, markers) -> str:
    g = d
    for m in markers:
        g = s_cut(g, m)
    cut = f"split_part({d}, '...', 1)"
    # drop from the last '.' when one is present
    last = f"(length({cut}) - length(split_part({cut}, '.', -1)) - 1)"
    loadstar = f"CASE WHEN strpos({cut}, '.') > 0 THEN {s_strip(f'left({cut}, {last})')} ELSE {cut} END"
    return (f"CASE WHEN contains({link}, 'gcaptain') THEN {g} "
            f"WHEN contains({link}, 'loadstar') THEN {loadstar} ELSE {d} END")


@query("trim_boilerplate", sql=f"""
SELECT _id, {s_trim_boilerplate('link', 'd', T.GCAPTAIN_MARKERS)} AS trimmed
FROM (SELECT a._id, a.link, {BOILER.replace('text', 'a.description').replace('source', 'a.state')} AS d
      FROM ({ARTICLES_SQL}) a)
""")
def q_trim_boilerplate(spark, sf_dir):
    """Site rules on the article link, markers appended to every text."""
    a = articles(spark, sf_dir).withColumn("d", F.concat(
        F.col("description"), F.lit("... more (Reporting by "), F.col("state"),
        F.lit(") (Editing x) Join the gCaptain club")))
    return a.select("_id", T.trim_boilerplate(F.col("link"), F.col("d")).alias("trimmed"))


def s_trim_v1(link: str, d: str) -> str:
    g = d
    for m in T.GCAPTAIN_MARKERS_V1:
        g = s_cut(g, m)
    return f"CASE WHEN contains({link}, 'gcaptain') THEN {g} ELSE {d} END"


@query("trim_boilerplate_v1", sql=f"""
SELECT _id, {s_trim_v1('link', 'd')} AS trimmed
FROM (SELECT a._id, a.link, {BOILER.replace('text', 'a.description').replace('source', 'a.state')} AS d
      FROM ({ARTICLES_SQL}) a)
""")
def q_trim_boilerplate_v1(spark, sf_dir):
    """The earlier marker list."""
    a = articles(spark, sf_dir).withColumn("d", F.concat(
        F.col("description"), F.lit("... more (Reporting by "), F.col("state"),
        F.lit(") (Editing x) Join the gCaptain club")))
    return a.select("_id", T.trim_boilerplate_v1(F.col("link"), F.col("d")).alias("trimmed"))


# ---------------------------------------------------------------- T4 / T5 / T6
STOP = english_stop_words()


def s_split_words(x: str) -> str:
    s = s_strip(x)
    return f"CASE WHEN {s} = '' THEN []::VARCHAR[] ELSE regexp_split_to_array({s}, '{WS}+') END"


@query("drop_stop_words", sql=f"""
SELECT doc_id, array_to_string(list_filter({s_split_words('text')}, lambda w: NOT list_contains({s_list(STOP)}, lower(w))), ' ')
       AS filtered FROM documents
""")
def q_drop_stop_words(spark, sf_dir):
    """T4 with MLlib's English stop list."""
    return docs(spark, sf_dir).select("doc_id", T.drop_stop_words_text("text", STOP).alias("filtered"))


RULES = [("s", ""), ("ses", "s"), ("ves", "f"), ("xes", "x"), ("zes", "z"),
         ("ches", "ch"), ("shes", "sh"), ("men", "man"), ("ies", "y")]


def _candidates_sql(w: str) -> str:
    parts = [f"{w}"] + [f"CASE WHEN suffix({w}, '{s}') THEN left({w}, length({w}) - {len(s)}) || '{r}' END"
                        for s, r in RULES]
    return "[" + ", ".join(parts) + "]"


def _preprocess_ctes(texts: str) -> str:
    """CTEs over ``texts`` (key, text): ``pre`` has the text of each key without stop words and with lemmas."""
    return f"""lex AS (SELECT DISTINCT lower(w) AS surface FROM benchmark,
             unnest(regexp_extract_all(text, '\\p{{L}}+')) AS t(w)),
toks AS (SELECT key, list_filter({s_split_words('text')}, lambda w: NOT list_contains({s_list(STOP)}, lower(w))) AS tk
         FROM {texts}),
occ AS (SELECT key, generate_subscripts(tk, 1) AS pos, unnest(tk) AS tok FROM toks),
cand AS (SELECT key, pos, tok, generate_subscripts(c, 1) AS ci, unnest(c) AS form
         FROM (SELECT *, {_candidates_sql('tok')} AS c FROM occ)),
best AS (SELECT key, pos, tok,
                arg_min(lex.surface, (length(lex.surface), ci)) FILTER (WHERE lex.surface IS NOT NULL) AS lemma
         FROM cand LEFT JOIN lex ON cand.form = lex.surface GROUP BY key, pos, tok),
joined AS (SELECT key, string_agg(coalesce(lemma, tok), ' ' ORDER BY pos) AS pre FROM best GROUP BY key),
pre AS (SELECT t.key, CASE WHEN t.text IS NOT NULL THEN coalesce(j.pre, '') END AS pre FROM {texts} t LEFT JOIN joined j ON t.key = j.key)"""


PREPROCESS_SQL = f"""
WITH texts AS (SELECT doc_id AS key, text FROM documents), {_preprocess_ctes('texts')}
SELECT key AS doc_id, pre AS preprocessed FROM pre
"""


def benchmark_lexicon(spark, sf_dir):
    """The words of the benchmark in lower case, each its own lemma."""
    return lexicon_from_words(scan_table(spark, sf_dir, "benchmark").select(
        F.explode(F.regexp_extract_all(F.col("text"), F.lit(r"\p{L}+"), 0)).alias("w"))
        .select(F.lower("w").alias("word")))


@query("preprocess_words", sql=PREPROCESS_SQL)
def q_preprocess_words(spark, sf_dir):
    """T6 = T4 + T5: stop words dropped, tokens lemmatised against a lexicon of benchmark words."""
    d = docs(spark, sf_dir).select("doc_id", "text")
    return preprocess_words(d, "doc_id", "text", STOP, benchmark_lexicon(spark, sf_dir), "preprocessed").select("doc_id", "preprocessed")


# ---------------------------------------------------------------- T8 / T9
@query("combine_text", sql="""
SELECT conv_id, turn, coalesce(replace(text, chr(10), ' '), '') || ' ' || coalesce(role, '') AS combined
FROM conversations
""")
def q_combine_text(spark, sf_dir):
    """Whole text of each turn + ' ' + role."""
    c = scan_table(spark, sf_dir, "conversations")
    return c.select("conv_id", "turn",
                    T.combine_text(F.translate("text", "\n", " "), F.col("role")).alias("combined"))


@query("null_out_placeholders", sql=f"""
SELECT doc_id, CASE WHEN regexp_matches(h, '{T.PLACEHOLDER_PATTERN}') THEN NULL ELSE h END AS port
FROM (SELECT doc_id, replace(text, chr(10), ' ') AS h FROM documents)
""")
def q_null_out_placeholders(spark, sf_dir):
    """T9 on every document's whole text."""
    d = docs(spark, sf_dir).select("doc_id", F.translate("text", "\n", " ").alias("h"))
    return d.select("doc_id", T.null_out_placeholders("h").alias("port"))


# ---------------------------------------------------------------- T10 / T11
def kv_spark():
    return F.concat(F.lit("Disruption event: "), F.translate("text", "\n", " "),
                    F.lit("\nPort Affected: "), F.col("source"), F.lit("\nDate:\n"),
                    F.lit("Port Affected:  "), F.col("lang"), F.lit(" \n 1. Disruption event: x"))
KV_SQL = ("'Disruption event: ' || replace(text, chr(10), ' ') || chr(10) || 'Port Affected: ' || source"
          " || chr(10) || 'Date:' || chr(10) || 'Port Affected:  ' || lang || ' ' || chr(10) || ' 1. Disruption event: x'")


def s_kv_entries(x: str) -> str:
    lines = f"string_split({s_strip(x)}, chr(10))"
    return (f"list_transform(list_filter({lines}, lambda l: strpos(l, ': ') > 0), "
            f"lambda l: {{'key': {s_strip('split_part(l, chr(58) || chr(32), 1)')}, "
            f"'value': {s_strip('substr(l, strpos(l, chr(58) || chr(32)) + 2)')}}})")


def s_kv_get(entries: str, key: str) -> str:
    return f"(list_filter({entries}, lambda e: e.key = '{key}'))[-1].value"


@query("parse_key_values", sql=f"""
SELECT doc_id, coalesce({s_kv_get('ents', 'Disruption event')}, '') AS summary,
       coalesce({s_kv_get('ents', 'Port Affected')}, '') AS extracted_affected_port,
       {s_kv_get('ents', 'Date')} AS extracted_date,
       len(list_distinct(list_transform(ents, lambda x: x.key))) AS n_keys
FROM (SELECT doc_id, {s_kv_entries(KV_SQL)} AS ents FROM documents)
""")
def q_parse_key_values(spark, sf_dir):
    """T10 + T11: 'Key: value' answer -> map (last duplicate wins) -> projected fields."""
    d = docs(spark, sf_dir).select("doc_id", T.key_value_entries(kv_spark()).alias("ents"))
    d = d.select("doc_id", T.last_wins_map("ents").alias("m"))
    return d.select("doc_id", *T.project_extraction(F.col("m")), F.size("m").cast("long").alias("n_keys"))


# ---------------------------------------------------------------- T12 / F10
def block_spark():
    return F.concat(F.lit(" "), F.col("doc_id").cast("string"), F.lit("\nDisruption event:  "),
                       F.regexp_replace(F.col("text"), "Date:|Port Affected:", ""),
                       F.lit("\n"), F.when(F.col("lang") != "de", F.lit("Port Affected: ")).otherwise(F.lit("")),
                       F.col("source"), F.lit("\nDate: \n"), F.col("lang"), F.lit("\n"))
BLOCK_SQL = ("' ' || CAST(doc_id AS VARCHAR) || chr(10) || 'Disruption event:  ' || "
             "regexp_replace(text, 'Date:|Port Affected:', '', 'g') || chr(10) || "
             "CASE WHEN lang <> 'de' THEN 'Port Affected: ' ELSE '' END || source || chr(10) || 'Date: ' || "
             "chr(10) || lang || chr(10)")


def s_after(x: str, marker: str) -> str:
    return f"substr({x}, strpos({x}, '{marker}') + {len(marker)})"


@query("extract_block_fields", sql=f"""
SELECT regexp_extract(b, '[^{T.PY_SPACE}]+') AS _id,
       {s_strip(f"split_part({s_after('b', 'Disruption event:')}, 'Port Affected:', 1)")} AS event,
       {s_strip(f"split_part({s_after('b', 'Port Affected:')}, 'Date:', 1)")} AS port_affected,
       {s_strip(f"regexp_extract(b, 'Date:{WS}*(.*)', 1)")} AS date
FROM (SELECT {BLOCK_SQL} AS b FROM documents)
WHERE regexp_matches(b, '[^{T.PY_SPACE}]') AND contains(b, 'Disruption event:') AND contains(b, 'Port Affected:')
  AND contains(b, 'Date:')
""")
def q_extract_block_fields(spark, sf_dir):
    """T12 + F10: fields of 'id:' blocks; blocks without a port label are dropped."""
    b = docs(spark, sf_dir).select(block_spark().alias("block"))
    return filters.drop_unmatched_extractions(b).select(*T.extract_block_fields(F.col("block")))


# ---------------------------------------------------------------- T13 / T14
def section_spark():
    return F.concat(F.lit("Disruption event: **"), F.translate("text", "\n", " "),
                         F.lit("**\nPort Affected: ## "), F.col("source"), F.lit("\nDate: "), F.col("lang"),
                         F.when(F.col("n_chars") % 2 == 0, F.lit("\nFinal Classification: **Port Closure** x **"))
                         .otherwise(F.lit("")))
SECTION_SQL = ("'Disruption event: **' || replace(text, chr(10), ' ') || '**' || chr(10) || "
               "'Port Affected: ## ' || source || chr(10) || 'Date: ' || lang || "
               "CASE WHEN n_chars % 2 = 0 THEN chr(10) || 'Final Classification: **Port Closure** x **' ELSE '' END")


def s_strip_markup(x: str) -> str:
    return s_strip(f"regexp_replace(coalesce({x}, ''), '[#*]+', '', 'g')")


@query("extract_section_fields", sql=f"""
WITH s AS (SELECT doc_id, {SECTION_SQL} AS sec FROM documents),
f AS (SELECT doc_id,
   CASE WHEN regexp_matches(sec, 'Disruption event:{WS}*(.*)\\n') THEN {s_strip(f"regexp_extract(sec, 'Disruption event:{WS}*(.*)\\n', 1)")} END AS e,
   CASE WHEN regexp_matches(sec, 'Port Affected:') THEN {s_strip(f"regexp_extract(sec, 'Port Affected:{WS}*(.*)', 1)")} END AS p,
   CASE WHEN regexp_matches(sec, 'Date:') THEN {s_strip(f"regexp_extract(sec, 'Date:{WS}*(.*)', 1)")} END AS d,
   CASE WHEN regexp_matches(sec, 'Final Classification:{WS}*\\*\\*(.*)\\*\\*')
        THEN {s_strip(f"regexp_extract(sec, 'Final Classification:{WS}*\\*\\*(.*)\\*\\*', 1)")} END AS c
   FROM s)
SELECT doc_id, {s_strip_markup('e')} AS disruption_event, {s_strip_markup('p')} AS port_affected,
       {s_strip_markup('d')} AS date, {s_strip_markup('c')} AS final_classification FROM f
""")
def q_extract_section_fields(spark, sf_dir):
    """T13 + T14: numbered-answer sections -> fields with markup removed."""
    d = docs(spark, sf_dir).select("doc_id", section_spark().alias("sec"))
    f = d.select("doc_id", *T.extract_section_fields(F.col("sec")))
    return f.select("doc_id", *[T.strip_markup(c).alias(c) for c in
                                ["disruption_event", "port_affected", "date", "final_classification"]])


# ---------------------------------------------------------------- T15
def label_line_spark():
    return F.concat(F.col("doc_id").cast("string"), F.lit(". "), F.translate("text", "\n", " "),
                            F.lit(" Port "), F.element_at(F.array(
                                *[F.lit(x) for x in ["Strike", "Closure Port Attack", "Delays", "Seizure and None"]]),
                                (F.pmod("n_chars", F.lit(4)) + 1).cast("int")))
LABEL_LINE_SQL = ("CAST(doc_id AS VARCHAR) || '. ' || replace(text, chr(10), ' ') || "
                  "' Port ' || (['Strike', 'Closure Port Attack', 'Delays', 'Seizure and None'])[n_chars % 4 + 1]")


def s_first_label(x: str) -> str:
    out = "''"
    for lab in reversed(T.PORT_LABELS):
        out = f"CASE WHEN contains({x}, '{lab}') THEN '{lab}' ELSE {out} END"
    return out


@query("first_label", sql=f"""
SELECT doc_id, {s_first_label('line')} AS risk_type FROM (SELECT doc_id, {LABEL_LINE_SQL} AS line FROM documents)
""")
def q_first_label(spark, sf_dir):
    """First port label contained in each numbered answer line."""
    d = docs(spark, sf_dir).select("doc_id", label_line_spark().alias("line"))
    return d.select("doc_id", T.first_label("line").alias("risk_type"))


# ---------------------------------------------------------------- T16 / T17
@query("normalise_category", sql=f"""
SELECT doc_id, regexp_replace(split_part({s_strip('text')}, chr(10), 1), '[^A-Za-z0-9{T.PY_SPACE}:]', '', 'g')
       AS category FROM documents
""")
def q_normalise_category(spark, sf_dir):
    """T16 on every document text (first line, restricted character set)."""
    return docs(spark, sf_dir).select("doc_id", T.normalise_category("text").alias("category"))


@query("split_name_description", sql="""
SELECT doc_id,
  CASE WHEN len(p) = 2 THEN p[1] END AS category,
  CASE WHEN len(p) = 2 THEN p[2] END AS description,
  CASE WHEN len(p) <> 2 THEN 'expected ''name: description'', got ' || CAST(len(p) AS VARCHAR) || ' parts' END AS error
FROM (SELECT doc_id, string_split(CASE WHEN n_chars % 3 = 0 THEN replace(text, chr(10), ' ')
        ELSE replace(text, chr(10), ' ') || ': ' || source END, ': ') AS p FROM documents)
""")
def q_split_name_description(spark, sf_dir):
    """T17: 'Name: description' answers; answers without the separator become error rows."""
    line = F.when(F.col("n_chars") % 3 == 0, F.translate("text", "\n", " ")) \
        .otherwise(F.concat(F.translate("text", "\n", " "), F.lit(": "), F.col("source")))
    return docs(spark, sf_dir).select("doc_id", *T.split_name_description(line))


# ---------------------------------------------------------------- T19 / T20
@query("severity_text", sql=f"""
SELECT _id, concat_ws(' | ', {s_strip("coalesce(headline, '')")}, {s_strip("coalesce(main_risk, '')")},
                      substr({s_strip("coalesce(description, '')")}, 1, 200)) AS severity_input
FROM ({ARTICLES_SQL})
""")
def q_severity_text(spark, sf_dir):
    """The zero-shot input text for every article."""
    a = articles(spark, sf_dir)
    return a.select("_id", T.severity_text("headline", "main_risk", "description").alias("severity_input"))


def s_severity_level(x: str) -> str:
    out = "1"
    for i, lab in reversed(list(enumerate(T.SEVERITY_LABELS, 1))):
        out = f"CASE WHEN split_part({x}, ' -', 1) = '{lab.split(' -')[0]}' THEN {i} ELSE {out} END"
    return out


SEV_CHOICES = T.SEVERITY_LABELS + ["Unknown Severity - none"]


@query("severity_level", sql=f"""
SELECT doc_id, label, {s_severity_level('label')} AS severity_level
FROM (SELECT doc_id, ({s_list(SEV_CHOICES)})[n_chars % 6 + 1] AS label FROM documents)
""")
def q_severity_level(spark, sf_dir):
    """Predicted label -> level 1..5, unknown -> 1."""
    lab = F.element_at(F.array(*[F.lit(x) for x in SEV_CHOICES]), (F.pmod("n_chars", F.lit(6)) + 1).cast("int"))
    d = docs(spark, sf_dir).select("doc_id", lab.alias("label"))
    return d.select("doc_id", "label", T.severity_level("label").alias("severity_level"))


# ---------------------------------------------------------------- T21 / T22 / T23
def s_trigram_text(x: str) -> str:
    return f"regexp_replace(lower({x}), '[^\\p{{L}}\\p{{N}}_]+', '', 'g')"


def s_trigrams(s: str) -> str:
    """Trigrams of an already-normalised column ``s``."""
    return (f"CASE WHEN length({s}) >= 3 THEN list_transform(range(1, length({s}) - 1), "
            f"lambda i: substr({s}, i, 3)) ELSE []::VARCHAR[] END")


@query("char_trigrams", sql=f"""
SELECT doc_id, len(g) AS n_trigrams, len(list_distinct(g)) AS n_distinct, array_to_string(g, '|') AS trigrams
FROM (SELECT doc_id, {s_trigrams('s')} AS g FROM (SELECT doc_id, {s_trigram_text('text')} AS s FROM documents))
""")
def q_char_trigrams(spark, sf_dir):
    """T21 over whole texts."""
    g = docs(spark, sf_dir).select("doc_id", T.char_trigrams("text").alias("g"))
    return g.select("doc_id", F.size("g").cast("long").alias("n_trigrams"),
                    F.size(F.array_distinct("g")).cast("long").alias("n_distinct"),
                    F.array_join("g", "|").alias("trigrams"))


@query("tokenize", sql=f"""
SELECT doc_id, len(t) AS n_tokens, array_to_string(t, ' ') AS tokens,
       array_to_string(regexp_extract_all(text, '\\p{{L}}+'), ' ') AS alpha
FROM (SELECT doc_id, text, regexp_extract_all(lower(text), '{T.WORD_OR_PUNCT}') AS t FROM documents)
""")
def q_tokenize(spark, sf_dir):
    """word/punctuation tokens (lower-cased) and the alphabetic-only variant."""
    d = docs(spark, sf_dir).select("doc_id", "text", T.tokenize("text").alias("t"))
    return d.select("doc_id", F.size("t").cast("long").alias("n_tokens"), F.array_join("t", " ").alias("tokens"),
                    F.array_join(T.alpha_tokens("text"), " ").alias("alpha"))


@query("word_ngrams", sql=f"""
SELECT doc_id, len(g) AS n_grams, array_to_string(g, '|') AS grams FROM (
  SELECT doc_id, list_concat(t, CASE WHEN len(t) >= 2 THEN
     list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]) ELSE []::VARCHAR[] END) AS g
  FROM (SELECT doc_id, regexp_extract_all(text, '\\p{{L}}+') AS t FROM documents))
""")
def q_word_ngrams(spark, sf_dir):
    """1- and 2-word phrases over alphabetic tokens."""
    t = docs(spark, sf_dir).select("doc_id", T.alpha_tokens("text").alias("t"))
    g = t.select("doc_id", T.word_ngrams(F.col("t"), 2).alias("g"))
    return g.select("doc_id", F.size("g").cast("long").alias("n_grams"), F.array_join("g", "|").alias("grams"))


# ---------------------------------------------------------------- F2 / F4 / F9
@query("keep_article_urls", sql="""
SELECT page_id, url FROM pages WHERE contains(url, 'article') AND NOT contains(url, 'editorial')
""")
def q_keep_article_urls(spark, sf_dir):
    """F2 on page urls."""
    return filters.keep_article_urls(scan_table(spark, sf_dir, "pages").select("page_id", "url"))


@query("drop_flagged", sql=f"""
SELECT _id FROM ({ARTICLES_SQL}) WHERE NOT coalesce(is_editorial, false)
""")
def q_drop_flagged(spark, sf_dir):
    """articles without a true editorial flag (absent flag = keep)."""
    return filters.drop_flagged(articles(spark, sf_dir), ["is_editorial"]).select("_id")


@query("split_new_seen", sql=f"""
SELECT _id, 'seen' AS part FROM ({ARTICLES_SQL}) WHERE NOT coalesce(is_new, false) AND coalesce(is_unique, false)
UNION ALL
SELECT _id, 'new' FROM ({ARTICLES_SQL}) WHERE coalesce(is_new, false)
""")
def q_split_new_seen(spark, sf_dir):
    """seen (not new, unique) and new articles."""
    seen, new = filters.split_new_seen(articles(spark, sf_dir))
    return seen.select("_id", F.lit("seen").alias("part")).unionByName(new.select("_id", F.lit("new").alias("part")))


@query("drop_incomplete", sql="""
SELECT event_id, user_id, props FROM events WHERE event_id IS NOT NULL AND user_id IS NOT NULL AND props IS NOT NULL
""")
def q_drop_incomplete(spark, sf_dir):
    """records lacking a declared key are dropped."""
    e = scan_table(spark, sf_dir, "events").select("event_id", "user_id", "props")
    return filters.drop_incomplete(e, ["event_id", "user_id", "props"])


# ---------------------------------------------------------------- T7 / T18


@query("preprocess_article", sql=f"""
WITH a AS ({ARTICLES_SQL}),
texts AS (SELECT _id || ' d' AS key, {s_trim_boilerplate('link', 'description', T.GCAPTAIN_MARKERS)} AS text FROM a
          UNION ALL SELECT _id || ' h', headline FROM a),
{_preprocess_ctes('texts')}
SELECT a._id, d.pre AS description, h.pre AS headline
FROM a JOIN pre d ON d.key = a._id || ' d' JOIN pre h ON h.key = a._id || ' h'
""")
def q_preprocess_article(spark, sf_dir):
    """Boilerplate trim, stop words and lemmas on the description, stop words and lemmas on the headline."""
    a = articles(spark, sf_dir).select("_id", "link", "description", "headline")
    return preprocess_article(a, "_id", STOP, benchmark_lexicon(spark, sf_dir)).select("_id", "description", "headline")
