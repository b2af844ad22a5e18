"""Personal data: formats that are certain, and candidates that boosted trees judge.

High-recall generators propose overlapping spans. Gradient-boosted trees score a span from its format
and its context; the certain formats of all documents are the labels. A threshold for each
generator, calibrated on held-out candidates, selects the spans that are added. Everything runs as
expressions over the text: matches come from ``regexp_extract_all``, their places from the pieces that
``split`` leaves between them, and the trees are nested CASE expressions.

Patterns are possessive and anchored so that each is linear in the text and none recurses.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.util import store

# Kinds in their order. The patterns match what the published formats match after their
# checks: a card is a maximal chain of 12 to 19 digits, so the count is part of the pattern.
LOCAL = "[A-Za-z0-9._%+-]"
KINDS = ("email", "ip", "card", "phone", "likely")
PATTERNS = {
    "email": rf"(?:(?<!{LOCAL})|\G){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for a pattern to be tried.
NEEDS = {"email": "@", "ip": ".", "phone": "+"}
#: Generators of candidates: wide spans that may hold personal data.
GENERATORS = {
    "at": r"(?<!\S)[^\s@]{1,64}+@\S{1,255}+",
    "digits": r"(?<![0-9])[+(]?[0-9][0-9\x20()./-]{6,40}[0-9]",
    "dotted": r"(?<![0-9.])[0-9]{1,4}+(?:\.[0-9]{1,4}+){2,7}+",
    "named": r"(?i)\b(?:phone|tel|mobile|mail|ssn|iban|passport|account|card)\b[\x20:#=]{1,4}+[A-Za-z0-9@+][A-Za-z0-9@+._-]{3,64}+",
}
GENERATOR_NEEDS = {"at": "@"}
OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"

#: Distinct feature rows that one task of the fit holds.
FEATURE_ROWS = 200_000
PRECISION = 0.95
#: Elements of an array, and characters of a text, that are handled as one cell.
CELL, TEXT_CELL = 256, 4096


def _sums(sizes: Column) -> Column:
    """Running sums of an array, in cells of 256 so that long arrays aren't copied for each element."""
    add = lambda acc, x: F.struct((acc.at + x).alias("at"), F.array_append(acc.out, acc.at + x).alias("out"))
    none = F.array().cast("array<int>")
    run = lambda start, part: F.aggregate(part, F.struct(start.alias("at"), none.alias("out")), add, lambda acc: acc.out)
    zero = F.lit(0)
    cells = F.transform(F.sequence(zero, F.floor((F.size(sizes) - 1) / CELL).cast("int")), lambda k: F.slice(sizes, k * CELL + 1, F.lit(CELL)))
    totals = run(zero, F.transform(cells, lambda c: F.aggregate(c, zero, lambda a, x: a + x)))
    return F.flatten(F.transform(cells, lambda c, k: run(F.when(k == 0, zero).otherwise(F.get(totals, k - 1)), c)))


def _scan(name: str, op: Callable[[Column, Column], Column], zero: int) -> Column:
    """Running totals of a column of integers under ``op``, in cells of 256 so that long arrays aren't copied for each element.

    The column must exist by name: an expression in its place would be evaluated once for each cell.
    """
    values, none, zero = F.col(name), F.array().cast("array<int>"), F.lit(zero)
    step = lambda acc, x: F.struct(op(acc.at, x).alias("at"), F.array_append(acc.out, op(acc.at, x)).alias("out"))
    run = lambda start, part: F.aggregate(part, F.struct(start.alias("at"), none.alias("out")), step, lambda acc: acc.out)
    cells = F.transform(F.sequence(F.lit(0), F.floor((F.size(values) - 1) / CELL).cast("int")), lambda k: F.slice(values, k * CELL + 1, F.lit(CELL)))
    before = F.concat(F.array(zero), run(zero, F.transform(cells, lambda c: F.aggregate(c, zero, op))))
    each = F.filter(F.arrays_zip(cells.alias("cell"), before.alias("start")), lambda z: z["cell"].isNotNull())
    return F.when(F.size(values) > 0, F.flatten(F.transform(each, lambda z: run(z["start"], z["cell"])))).otherwise(none)


def _found(text: Column, pattern: str, needs: str | None) -> Column:
    """The matches and the pieces between them; null where there are none."""
    m = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    p = F.split(text, pattern, -1)
    if needs:
        m = F.when(F.contains(text, F.lit(needs)), m)
    return F.when(F.size(m) > 0, F.struct(m.alias("m"), p.alias("p")))


def _sizes(found: Column) -> Column:
    """From the end of one match to the end of the next, in code points."""
    m, p = found["m"], found["p"]
    return F.coalesce(F.transform(m, lambda x, i: F.length(x) + F.length(F.get(p, i))), F.array().cast("array<int>"))


def _placed(found: Column, sizes: str) -> Column:
    """(start, end, value, left, after) of every match in code points, with up to 24 and 4 characters around it."""
    m, p = found["m"], found["p"]
    rows = F.transform(F.arrays_zip(m.alias("value"), _scan(sizes, lambda a, x: a + x, 0).alias("end")), lambda z, i: F.struct(
        (z["end"] - F.length(z["value"])).alias("start"), z["end"].alias("end"), z["value"].alias("value"),
        F.right(F.get(p, i), F.lit(24)).alias("left"), F.left(F.get(p, i + 1), F.lit(4)).alias("after")))
    return F.coalesce(F.when(found.isNotNull(), rows), F.array().cast("array<struct<start:int,end:int,value:string,left:string,after:string>>"))


def luhn(value: Column) -> Column:
    """True for digits (others are skipped) whose Luhn sum is a multiple of 10."""
    digits = F.reverse(F.regexp_replace(value, "[^0-9]", ""))
    each = F.transform(F.split(digits, ""), lambda d, i: F.when(i % 2 == 0, d.try_cast("int")).otherwise(
        d.try_cast("int") * 2 - F.when(d.try_cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(F.filter(each, lambda d: d.isNotNull()), F.lit(0), lambda a, d: a + d) % 10 == 0


def n_digits(value: Column) -> Column:
    return F.length(F.regexp_replace(value, "[^0-9]", ""))


CHECKS: dict[str, Callable[[Column], Column]] = {
    "ip": lambda v: v.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$"),
    "card": luhn,
    "phone": lambda v: n_digits(v).between(9, 15),
}


def _with_matches(docs: DataFrame, patterns: dict, needs: dict, prefix: str) -> DataFrame:
    """Adds one array column of placed matches for each pattern; matches are taken once, in a step of their own."""
    found = docs.withColumns({f"_{prefix}{k}": _found(F.col("_text"), p, needs.get(k)) for k, p in patterns.items()})
    sized = found.withColumns({f"_n_{prefix}{k}": _sizes(F.col(f"_{prefix}{k}")) for k in patterns})
    return sized.withColumns({f"_{prefix}{k}": _placed(F.col(f"_{prefix}{k}"), f"_n_{prefix}{k}") for k in patterns}).drop(*(f"_n_{prefix}{k}" for k in patterns))


#: Format and context of a candidate; its generator's number comes before them.
FEATURES: dict[str, Callable[[Column], Column]] = {
    "length": lambda x: F.length(x["value"]),
    "digits": lambda x: n_digits(x["value"]),
    "letters": lambda x: F.length(F.regexp_replace(x["value"], "[^A-Za-z]", "")),
    "dots": lambda x: F.length(F.regexp_replace(x["value"], "[^.]", "")),
    "separators": lambda x: F.length(F.regexp_replace(x["value"], "[^ ()/-]", "")),
    "plus": lambda x: F.startswith(x["value"], F.lit("+")).cast("int"),
    "at": lambda x: F.contains(x["value"], F.lit("@")).cast("int"),
    "groups": lambda x: F.size(F.split(x["value"], "[^A-Za-z0-9]+")),
    "longest_group": lambda x: F.array_max(F.transform(F.split(x["value"], "[^0-9]+"), lambda g: F.length(g))),
    "left_space": lambda x: x["left"].rlike(r"(?:^|\s)$").cast("int"),
    "left_letter": lambda x: x["left"].rlike(r"\p{L}$").cast("int"),
    "left_digit": lambda x: x["left"].rlike(r"[0-9.]$").cast("int"),
    "left_word": lambda x: x["left"].rlike(r"(?i)\b(?:phone|tel|call|mobile|mail|card|ip|address|account|contact|ssn|iban)\b").cast("int"),
    "after_space": lambda x: x["after"].rlike(r"^(?:\s|$|[.,;:!?)]\s?)").cast("int"),
    "after_letter": lambda x: x["after"].rlike(r"^\p{L}").cast("int"),
}


def _certain(place: int, kind: str) -> Column:
    matches = F.col(f"_m_{kind}")
    if kind in CHECKS:
        matches = F.filter(matches, lambda x: CHECKS[kind](x["value"]))
    return F.transform(matches, lambda x: F.struct(x["start"].alias("start"), F.lit(place).alias("kind"), x["end"].alias("end")))


def _proposed(place: int, generator: str) -> Column:
    def candidate(x):
        features = F.array(F.lit(float(place)), *(f(x).cast("double") for f in FEATURES.values()))
        return F.struct(F.lit(place).alias("generator"), x["start"].alias("start"), x["end"].alias("end"),
                        F.xxhash64(x["value"], x["left"]).alias("h"), features.alias("f"))

    return F.transform(f"_g_{generator}", candidate)


def with_base(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds ``_text`` (null as empty) and ``_base``: (start, kind, end) of the certain formats, by start, then kind."""
    d = _with_matches(docs.withColumn("_text", F.coalesce(F.col(text_col).cast("string"), F.lit(""))), PATTERNS, NEEDS, "m_")
    parts = [_certain(i, kind) for i, kind in enumerate(PATTERNS)]
    return d.withColumn("_base", F.array_sort(F.concat(*parts))).drop(*(f"_m_{k}" for k in PATTERNS))


#: Below every position and its negative.
_LEAST = -(2**31) + 1


def _with_met(df: DataFrame, own: tuple, base: tuple, order: tuple[int, int]) -> DataFrame:
    """Adds ``_proposed`` zipped with ``met``: the largest base value at or before each candidate's place.

    ``own`` gives a candidate's place; ``base`` a base span's place and value; ``order`` says which comes first at one
    place. One sort of both sides and one running maximum, whatever their number.
    """
    row = lambda at, rank, v, i: F.struct(at.cast("int").alias("at"), F.lit(rank).alias("rank"), v.cast("int").alias("v"), i.cast("int").alias("i"))
    events = F.concat(F.transform("_base", lambda b: row(base[0](b), order[1], base[1](b), F.lit(-1))),
                      F.transform("_proposed", lambda x, i: row(own(x), order[0], F.lit(_LEAST), i)))
    d = df.withColumn("_events", F.sort_array(events))
    d = d.withColumn("_values", F.transform("_events", lambda e: e["v"]))
    d = d.withColumn("_met", F.arrays_zip(F.col("_events").alias("e"), _scan("_values", lambda a, v: F.greatest(a, v), _LEAST).alias("met")))
    mine = F.sort_array(F.transform(F.filter("_met", lambda z: z["e"]["i"] >= 0), lambda z: F.struct(z["e"]["i"].alias("i"), z["met"].alias("met"))))
    zipped = F.arrays_zip(F.col("_proposed").alias("x"), F.transform(mine, lambda z: z["met"]).alias("met"))
    return d.withColumn("_proposed", zipped).drop("_events", "_values", "_met")


def with_free(marked: DataFrame) -> DataFrame:
    """Leaves in ``_proposed`` only the candidates that no certain span overlaps: none begins before their end and ends after their start."""
    d = _with_met(marked, lambda x: x["end"], (lambda b: b["start"], lambda b: b["end"]), (0, 1))
    return d.withColumn("_proposed", F.transform(F.filter("_proposed", lambda z: z["met"] <= z["x"]["start"]), lambda z: z["x"]))


def with_labels(marked: DataFrame) -> DataFrame:
    """Makes ``_proposed`` (x, label): 1 if the candidate holds a certain span, the first that begins at or after its start to end."""
    d = _with_met(marked, lambda x: -x["start"], (lambda b: -b["start"], lambda b: -b["end"]), (1, 0))
    return d.withColumn("_proposed", F.transform("_proposed", lambda z: F.struct(z["x"].alias("x"), (z["met"] >= -z["x"]["end"]).cast("double").alias("label"))))


def with_candidates(marked: DataFrame) -> DataFrame:
    """Adds ``_proposed``: the generators' spans (generator, start, end, hash, features), overlapping ones included."""
    d = _with_matches(marked, GENERATORS, GENERATOR_NEEDS, "g_")
    parts = [_proposed(i, g) for i, g in enumerate(GENERATORS)]
    return d.withColumn("_proposed", F.concat(*parts)).drop(*(f"_g_{g}" for g in GENERATORS))


@dataclass(frozen=True)
class Trees:
    """Boosted trees as nested (feature, threshold, left, right) or leaf values, with weights; thresholds by generator."""

    trees: tuple
    weights: tuple[float, ...]
    thresholds: tuple[float, ...]


def _node(node):
    if node.getClass().getSimpleName() == "LeafNode":
        return float(node.prediction())
    split = node.split()
    return int(split.featureIndex()), float(split.threshold()), _node(node.leftChild()), _node(node.rightChild())


def _tree(node) -> str:
    if not isinstance(node, tuple):
        return f"{node!r}D"
    at, threshold, left, right = node
    return f"CASE WHEN x.f[{at}] <= {threshold!r}D THEN {_tree(left)} ELSE {_tree(right)} END"


def score_sql(model: Trees) -> str:
    """SQL for the probability that a candidate ``x`` is personal data."""
    margin = " + ".join(f"{w!r}D * {_tree(t)}" for w, t in zip(model.weights, model.trees))
    return f"1 / (1 + exp(-2 * ({margin})))"


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_docs: int | None = None, precision: float = PRECISION,
        trees: int = 6, depth: int = 3, sample_spans: int | None = None) -> Trees | None:
    """Trees from the candidates of all documents; on request of at most ``sample_spans`` of at most ``sample_docs`` documents, chosen by hashes.

    Documents of equal id and text are one. A candidate's label is 1 if it holds a certain format. Half the candidates fit the
    trees, the others set each generator's threshold: the least at which ``precision`` of the candidates above hold
    one; a generator that never reaches it adds nothing. Candidates of equal features are one row with their number as its weight.
    None where candidates of either label lack.
    """
    rows = docs.select(F.col(text_col).cast("string").alias("_t"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("_pick"))
    if sample_docs is not None:
        last = rows.select("_pick").distinct().orderBy("_pick").limit(sample_docs).agg(F.max("_pick")).first()[0]
        if last is None:
            return None
        rows = rows.where(F.col("_pick") <= F.lit(last))
    marked = with_labels(with_candidates(with_base(rows, "_t")))
    # the outer form: else the optimizer repeats the whole expression in a filter for empty arrays
    each = marked.select("_pick", F.explode_outer("_proposed").alias("z")).where("z IS NOT NULL")
    spans = store(each.select("_pick", F.col("z.x.start").alias("start"), F.col("z.x.end").alias("end"), "z.x.f", "z.label",
                              F.col("z.x.generator").alias("g"), F.col("z.x.h").alias("h")), "spans")
    spans = spans.dropDuplicates(["_pick", "start", "end", "g"])  # a document that repeats gives the same spans
    if sample_spans is not None:
        spans = spans.orderBy("h", "g", "label", "f").limit(sample_spans)
    held = (F.pmod(F.col("h"), F.lit(2)) == 0).alias("held")
    equal = spans.groupBy("f", "label", "g", held).agg(F.count(F.lit(1)).cast("double").alias("n")).persist()
    parts = equal.count() // FEATURE_ROWS + 1
    order = ("f", "g", "label", "held")
    table = (equal.coalesce(1) if parts == 1 else equal.repartition(parts, *order)).sortWithinPartitions(*order) \
        .select(array_to_vector("f").alias("features"), "label", "g", "held", "n").persist()
    try:
        known = {(r.held, r.label): r["count"] for r in table.groupBy("held", "label").count().collect()}  # four rows
        if not all(known.get((h, y)) for h in (True, False) for y in (0.0, 1.0)):
            return None
        fitted = GBTClassifier(maxIter=trees, maxDepth=depth, seed=1, cacheNodeIds=False, weightCol="n").fit(table.where(~F.col("held")))
        judged = fitted.transform(table.where("held"))
        bins = judged.select("g", F.floor(vector_to_array("probability")[1] * 100).cast("int").alias("bin"), "label", "n")
        counts = bins.groupBy("g", "bin").agg(F.sum(F.col("label") * F.col("n")).alias("yes"), F.sum("n").alias("n")).collect()  # at most 4 * 101 rows
    finally:
        table.unpersist()
        equal.unpersist()
    thresholds = []
    for g in range(len(GENERATORS)):
        best = 2.0
        for t in range(100, 49, -1):
            above = [r for r in counts if r.g == g and r.bin >= t]
            n = sum(r.n for r in above)
            if n >= 20 and sum(r.yes for r in above) >= precision * n:
                best = t / 100
        thresholds.append(best)
    return Trees(tuple(_node(t._call_java("rootNode")) for t in fitted.trees), tuple(fitted.treeWeights), tuple(thresholds))


def with_spans(docs: DataFrame, model: Trees | None, text_col: str = "text") -> DataFrame:
    """Adds ``_text``, ``_base`` and ``_spans``: the certain spans and those that the trees select outside them."""
    marked = with_base(docs, text_col)
    if model is None or min(model.thresholds) > 1:
        return marked.withColumn("_spans", F.col("_base"))
    free = with_free(with_candidates(marked))
    limits = ", ".join(f"{t!r}D" for t in model.thresholds)
    chosen = F.expr(f"filter(_proposed, x -> {score_sql(model)} >= array({limits})[x.generator])")
    added = F.transform(chosen, lambda x: F.struct(x["start"].alias("start"), F.lit(len(PATTERNS)).alias("kind"), x["end"].alias("end")))
    return free.withColumn("_spans", F.array_sort(F.concat("_base", F.array_distinct(added)))).drop("_proposed")


def _listed(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, n_email, n_ip, n_card, n_phone, base_sha256, n_likely, spans.

    Null and empty texts have no spans; repeated rows repeat; an empty table gives no rows; other columns
    are not read. A long text's spans are sorted and merged in its row, in time n log n in their number.
    """
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_t"))
    d = with_spans(rows, fit(rows, "_id", "_t"), "_t")
    count = lambda k: F.size(F.filter("_spans", lambda x: x["kind"] == k)).cast("long")
    return d.select(F.col("_id").alias(id_col), *(count(i).alias(f"n_{k}") for i, k in enumerate(KINDS[:4])),
                    F.sha2(_listed(F.col("_base")).cast("binary"), 256).alias("base_sha256"), count(4).alias("n_likely"), _listed(F.col("_spans")).alias("spans"))


def redact(docs: DataFrame, model: Trees | None, text_col: str = "text") -> DataFrame:
    """``docs`` with every span of the text replaced by its kind in brackets; overlapping spans go as one, by the first."""
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    d = with_spans(docs.select(whole.alias("_row"), F.col(text_col).alias("_t")), model, "_t")
    names = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS))
    # the text in cells, so that a gap between spans is cut without a walk from the text's start
    cut = F.transform(F.sequence(F.lit(0), F.floor(F.length("_text") / TEXT_CELL).cast("int")), lambda k: F.substr(F.col("_text"), k * TEXT_CELL + 1, F.lit(TEXT_CELL)))
    d = d.withColumns({"_cells": cut, "_ends": F.transform("_spans", lambda x: x["end"])})

    def gap(start, end):
        first, last = ((c / TEXT_CELL).cast("int") for c in (start, end))
        head, tail = F.get(F.col("_cells"), first), F.get(F.col("_cells"), last)
        at, to = start - first * TEXT_CELL, end - last * TEXT_CELL
        between = F.array_join(F.slice(F.col("_cells"), first + 2, last - first - 1), "")
        return F.when(first == last, F.substr(head, at + 1, F.greatest(to - at, F.lit(0)))).otherwise(F.concat(F.substr(head, at + 1), between, F.substr(tail, F.lit(1), to)))

    before = F.concat(F.array(F.lit(0)), _scan("_ends", lambda a, x: F.greatest(a, x), 0))
    parts = F.transform(F.arrays_zip(F.col("_spans").alias("x"), before.alias("at")), lambda z: F.when(z["x"].isNull(), gap(z["at"], F.length("_text"))).when(
        z["x"]["start"] >= z["at"], F.concat(gap(z["at"], z["x"]["start"]), F.get(names, z["x"]["kind"]))).otherwise(""))
    done = F.array_join(parts, "")
    new = F.when(F.size("_spans") > 0, done).otherwise(F.col("_t"))
    return d.select(*((new if c == text_col else F.col("_row").getField(c)).alias(c) for c in docs.columns))
