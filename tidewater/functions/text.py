"""Scalar text functions (Column -> Column), all JVM-side expressions.

Character classes are written out because ``\\s`` and ``\\W`` mean different
things in Python, Java and RE2; the classes below reproduce Python's meaning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Character classes (Java regex syntax; RE2 accepts the same \x{..} escapes).
# Python's str.isspace(): ASCII \t-\r, \x1c-\x1f, space, plus the Unicode spaces.
PY_SPACE = (r"\x{09}-\x{0D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
            r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}")
PY_WS = f"[{PY_SPACE}]"
# The same set for Java regexes, built on Character.isWhitespace (one predicate instead of many
# ranges): Java's whitespace plus the four characters Python adds (NEL and the no-break spaces).
J_SPACE = r"\p{javaWhitespace}\x{85}\x{A0}\x{2007}\x{202F}"
J_WS = f"[{J_SPACE}]"
# The same characters as a plain string (for btrim / translate, which need no regex).
PY_SPACE_CHARS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(chr(c) for c in range(0x2000, 0x200B))
                  + "\u2028\u2029\u202f\u205f\u3000")
# Python's \w for str patterns: letters, digits/numbers, underscore.
PY_NON_WORD = r"[^\p{L}\p{N}_]"

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
# Boilerplate markers cut from gCaptain articles, in the order they are applied.
GCAPTAIN_MARKERS = [
    "(Reporting",
    "(Editing",
    "(reporting",
    "(editing",
    "Join the members that receive our newsletter",
    "Join the gCaptain",
]
# Earlier cleaning variant: fewer markers.
GCAPTAIN_MARKERS_V1 = [
    "(Reporting",
    "(Editing",
    "Join the members that receive our newsletter",
]
# Port risk labels, checked in this order; "None" is checked last.
PORT_LABELS = [
    "Port Acquisition",
    "Port Attack",
    "Port Closure",
    "Port Collision",
    "Port Congestion",
    "Port Contamination",
    "Port Corruption",
    "Port Delay",
    "Port Detention",
    "Port Disruption",
    "Port Hijacking",
    "Port Infiltration",
    "Port Piracy",
    "Port Seizure",
    "Port Strike",
    "None",
]
# Severity candidate labels (level 1..5) used by the zero-shot scorer.
SEVERITY_LABELS = [
    "Low Severity - Minor impact, no injuries, minor cleanup.",
    "Moderate Severity - Noticeable impact, non-critical injuries, moderate cleanup.",
    "High Severity - Substantial impact, critical injuries, or multi-hour disruptions.",
    "Critical Severity - Severe incident, major injuries, significant cleanup.",
    "Catastrophic Severity - Extreme impact, fatalities, severe long-term consequences.",
]
# Placeholder pattern that nulls a whole extracted port cell.
PLACEHOLDER_PATTERN = "N/A|not|Not|None"
# ---------------------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c) -> Column:
    """Python ``str.strip()``: remove leading/trailing Unicode whitespace (character trim, no regex)."""
    return F.btrim(_c(c), F.lit(PY_SPACE_CHARS))


def clean_text(c) -> Column:
    """Non-ASCII runs -> space; CR/LF/TAB runs -> space; whitespace runs -> one space; trim."""
    x = F.regexp_replace(_c(c), r"[^\x{00}-\x{7F}]+", " ")
    x = F.regexp_replace(x, r"[\r\n\t]+", " ")
    # only ASCII is left, so Python's \s is the ASCII whitespace set here
    x = F.regexp_replace(x, r"[\x{09}-\x{0D}\x{1C}-\x{20}]+", " ")
    return F.trim(x)


def cut_at_markers(c, markers: Sequence[str]) -> Column:
    """Keep the text before the first occurrence of each marker in turn, stripping after each."""
    x = _c(c)
    for m in markers:
        x = py_strip(F.substring_index(x, m, 1))
    return x


def _drop_last_sentence(c: Column) -> Column:
    # '.'.join(parts[:-1]).strip() when a '.' is present, otherwise unchanged.
    tail = F.substring_index(c, ".", -1)
    head = F.substring(c, F.lit(1), F.length(c) - F.length(tail) - F.lit(1))
    return F.when(F.instr(c, ".") > 0, py_strip(head)).otherwise(c)


def trim_boilerplate(link, description, markers: Sequence[str] = GCAPTAIN_MARKERS) -> Column:
    """Site-specific boilerplate removal, chosen by the article link."""
    link, d = _c(link), _c(description)
    loadstar = _drop_last_sentence(F.substring_index(d, "...", 1))
    return (F.when(link.contains("gcaptain"), cut_at_markers(d, markers))
            .when(link.contains("loadstar"), loadstar)
            .otherwise(d))


def trim_boilerplate_v1(link, description) -> Column:
    """The earlier variant with the shorter marker list (gCaptain only)."""
    link, d = _c(link), _c(description)
    return F.when(link.contains("gcaptain"), cut_at_markers(d, GCAPTAIN_MARKERS_V1)).otherwise(d)


def split_words(c) -> Column:
    """Python ``str.split()``: whitespace runs, no empty tokens.

    The class is Java's whitespace predicate plus the characters Python adds.
    """
    s = py_strip(_c(c))
    return F.when(s == "", F.array().cast("array<string>")).otherwise(F.split(s, f"{J_WS}+"))


def drop_stop_words(c, stop_words: Sequence[str]) -> Column:
    """T4 on a token array: drop tokens whose lower case is a stop word, keep the case of the rest."""
    stop = sorted(set(stop_words))
    # IN over a literal list becomes a hash-set lookup (InSet) in the optimizer
    return F.filter(_c(c), lambda w: ~F.lower(w).isin(stop)) if stop else _c(c)


def drop_stop_words_text(c, stop_words: Sequence[str]) -> Column:
    """T4 on text: tokens rejoined by one space; null passes through."""
    return F.array_join(drop_stop_words(split_words(c), stop_words), " ")


def lemma_candidates(w) -> Column:
    """Surface forms a noun lemmatiser tries for ``w``: the word, then suffix-rule stems."""
    w = _c(w)
    rules = [("s", ""), ("ses", "s"), ("ves", "f"), ("xes", "x"), ("zes", "z"),
             ("ches", "ch"), ("shes", "sh"), ("men", "man"), ("ies", "y")]
    forms = [w]
    for suf, rep in rules:
        stem = F.substring(w, F.lit(1), F.length(w) - F.lit(len(suf)))
        forms.append(F.when(w.endswith(suf), F.concat(stem, F.lit(rep))))
    return F.array(*forms)


def lemmatize_with_map(tokens, lexicon: dict[str, str]) -> Column:
    """T5 with a small literal lexicon {surface: lemma}; unknown words stay unchanged.

    Among the word itself and its suffix-rule stems that the lexicon knows, the
    shortest lemma wins. For large lexicons use ``operators.text_ops.lemmatize``.
    """
    m = F.create_map(*[x for k, v in sorted(lexicon.items()) for x in (F.lit(k), F.lit(v))])

    def one(w):
        looked = F.transform(lemma_candidates(w), lambda f, i: F.struct(
            F.length(F.element_at(m, f)).alias("n"), i.alias("i"), F.element_at(m, f).alias("v")))
        best = F.array_min(F.filter(looked, lambda x: x["v"].isNotNull()))
        return F.coalesce(best["v"], w)

    return F.transform(_c(tokens), one)


def combine_text(a, b) -> Column:
    """Event + ' ' + port, nulls as ''."""
    return F.concat(F.coalesce(_c(a), F.lit("")), F.lit(" "), F.coalesce(_c(b), F.lit("")))


def null_out_placeholders(c, pattern: str = PLACEHOLDER_PATTERN) -> Column:
    """The whole cell becomes null if it contains a placeholder anywhere."""
    c = _c(c)
    return F.when(c.rlike(pattern), F.lit(None).cast("string")).otherwise(c)


def key_value_entries(c) -> Column:
    """Lines of ``c`` holding ': ' as (key, value) structs, split once, both sides stripped."""
    lines = F.split(py_strip(_c(c)), "\n")
    kv = F.filter(lines, lambda l: F.instr(l, ": ") > 0)
    return F.transform(kv, lambda l: F.struct(
        py_strip(F.substring_index(l, ": ", 1)).alias("key"),
        py_strip(F.substring(l, F.instr(l, ": ") + 2, F.lit(1 << 30))).alias("value")))


def last_wins_map(e) -> Column:
    """Map from (key, value) entries where a later duplicate key wins.

    ``e`` should be a column reference: lambda bodies re-evaluate expressions.
    """
    e = _c(e)
    last = F.filter(e, lambda x, i: ~F.exists(F.slice(e, i + 2, F.size(e) + 1),
                                              lambda y: y["key"] == x["key"]))
    return F.map_from_entries(last)


def parse_key_values(c) -> Column:
    """Map of 'Key: value' lines; a later duplicate key wins (small texts; see last_wins_map)."""
    return last_wins_map(key_value_entries(c))


def project_extraction(m) -> list[Column]:
    """Summary / port default '' ; date default null."""
    m = _c(m)
    return [
        F.coalesce(F.element_at(m, F.lit("Disruption event")), F.lit("")).alias("summary"),
        F.coalesce(F.element_at(m, F.lit("Port Affected")), F.lit("")).alias("extracted_affected_port"),
        F.element_at(m, F.lit("Date")).alias("extracted_date"),
    ]


def _group1_or_null(c: Column, pattern: str) -> Column:
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, 1))


def extract_block_fields(block) -> list[Column]:
    """Id / event / port / date from an 'id:' block; null where a pattern does not match.

    (?d) makes '.' and '$' treat only '\\n' as a line end, as Python does.
    """
    b = _c(block)
    ev = f"(?sd)Disruption event:{J_WS}*(.*?)(?=Port Affected:|$)"
    port = f"(?sd)Port Affected:{J_WS}*(.*?)(?=Date:|$)"
    date = f"(?d)Date:{J_WS}*(.*)"
    return [
        py_strip(_group1_or_null(b, f"([^{J_SPACE}]+)")).alias("_id"),
        py_strip(_group1_or_null(b, ev)).alias("event"),
        py_strip(_group1_or_null(b, port)).alias("port_affected"),
        py_strip(_group1_or_null(b, date)).alias("date"),
    ]


def block_is_complete(block) -> Column:
    """all four block patterns match."""
    b = _c(block)
    return (b.rlike(f"[^{J_SPACE}]") & b.contains("Disruption event:") & b.contains("Port Affected:")
            & b.contains("Date:"))


def extract_section_fields(section) -> list[Column]:
    """Event (needs a newline after it), port, date, final classification; null if absent."""
    s = _c(section)
    return [
        py_strip(_group1_or_null(s, f"(?d)Disruption event:{J_WS}*(.*)\n")).alias("disruption_event"),
        py_strip(_group1_or_null(s, f"(?d)Port Affected:{J_WS}*(.*)")).alias("port_affected"),
        py_strip(_group1_or_null(s, f"(?d)Date:{J_WS}*(.*)")).alias("date"),
        py_strip(_group1_or_null(s, f"(?d)Final Classification:{J_WS}*\\*\\*(.*)\\*\\*")).alias("final_classification"),
    ]


def strip_markup(c) -> Column:
    """Remove runs of '#' and '*', strip, null -> ''."""
    return py_strip(F.regexp_replace(F.coalesce(_c(c), F.lit("")), r"[#*]+", ""))


def first_label(c, labels: Sequence[str] = PORT_LABELS) -> Column:
    """The first label (in list order) contained in the line, else ''."""
    c = _c(c)
    out = F.lit("")
    for lab in reversed(labels):
        out = F.when(c.contains(lab), F.lit(lab)).otherwise(out)
    return out


def normalise_category(c) -> Column:
    """First line of the stripped text, keeping only letters, digits, whitespace and ':'."""
    first = F.substring_index(py_strip(_c(c)), "\n", 1)
    return F.regexp_replace(first, f"[^A-Za-z0-9{J_SPACE}:]", "")


def split_name_description(c) -> list[Column]:
    """T17: 'Name: description' -> (category, description, error); exactly two parts or an error."""
    parts = F.split(_c(c), ": ")
    ok = F.size(parts) == 2
    return [
        F.when(ok, parts[0]).alias("category"),
        F.when(ok, parts[1]).alias("description"),
        F.when(~ok, F.concat(F.lit("expected 'name: description', got "),
                             F.size(parts).cast("string"), F.lit(" parts"))).alias("error"),
    ]


def severity_text(headline, main_risk, description) -> Column:
    """T19: 'headline | main_risk | first 200 chars of description', each stripped, null -> ''."""
    def clean(x):
        return py_strip(F.coalesce(_c(x).cast("string"), F.lit("")))
    return F.concat_ws(" | ", clean(headline), clean(main_risk), F.substring(clean(description), 1, 200))


def severity_level(label) -> Column:
    """Text before ' -' mapped to 1..5; unknown -> 1."""
    m = F.create_map(*[x for i, lab in enumerate(SEVERITY_LABELS, 1)
                       for x in (F.lit(lab.split(" -")[0]), F.lit(i))])
    return F.coalesce(F.element_at(m, F.substring_index(_c(label), " -", 1)), F.lit(1))


def parse_level(c) -> Column:
    """Model text -> int (null when not a number)."""
    return py_strip(_c(c)).try_cast("int")


def trigram_text(c) -> Column:
    """Lower-cased text with every non-word character removed (the trigram source)."""
    return F.regexp_replace(F.lower(_c(c)), f"{PY_NON_WORD}+", "")


def char_trigrams(c) -> Column:
    """Lower, drop non-word characters, every 3-character substring (empty if shorter).

    One regex pass: a zero-width lookahead captures the overlapping windows.
    """
    return F.regexp_extract_all(trigram_text(c), F.lit("(?=(.{3}))"), 1)


WORD_OR_PUNCT = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_" + PY_SPACE + "]"  # shared with the RE2 oracle


def tokenize(c) -> Column:
    """Lower-cased word and punctuation tokens."""
    return F.regexp_extract_all(F.lower(_c(c)), F.lit(WORD_OR_PUNCT), 0)


def alpha_tokens(c) -> Column:
    """T22 variant: alphabetic-only tokens, case kept."""
    return F.regexp_extract_all(_c(c), F.lit(r"\p{L}+"), 0)


def word_ngrams(tokens, n_max: int = 2) -> Column:
    """All 1..n_max-word phrases of a token array, in order.

    Pass a column reference (not an expression): lambda bodies re-evaluate it per element.
    """
    t = _c(tokens)
    out = t
    if n_max >= 2:  # bigrams as one zip of the array with itself shifted by one
        pairs = F.zip_with(F.slice(t, 1, F.greatest(F.size(t) - 1, F.lit(0))),
                           F.slice(t, 2, F.greatest(F.size(t) - 1, F.lit(0))),
                           lambda a, b: F.concat(a, F.lit(" "), b))
        out = F.concat(out, F.when(F.size(t) >= 2, pairs).otherwise(F.array().cast("array<string>")))
    for n in range(3, n_max + 1):
        grams = F.when(F.size(t) >= n, F.transform(
            F.sequence(F.lit(1), F.size(t) - (n - 1)),
            lambda i: F.array_join(F.slice(t, i, n), " "))).otherwise(F.array().cast("array<string>"))
        out = F.concat(out, grams)
    return out
