import hashlib
import random
import re

import pytest

from tidewater.llm import pii


def luhn(d):
    return sum((int(c) if i % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4)) for i, c in enumerate(reversed(d))) % 10 == 0


def brute(t):
    t = t or ""
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m[0])
        if 12 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out)


def name(spans):
    return ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in spans)


CASES = ["", None, "no data", "é 🙂 a.b@c.de x", "a@b.c%d@e.f..g@h.i", "@@a@b", "x@y", "a.@b-.c", "1.2.3.4.5.6.7.8", "256.1.1.1 1.2.3.04 0255.0.0.1",
         "4111 1111 1111 1111", "4111-1111-1111-1111 4111 1111 1111 1112", "4111  1111 11111111 4111111111111111", "1 2 3 4 5 6 7 8 9 0 1 2 3",
         "4111111111111111-", "+1 (555) 123-4567 +12 +1234567890123456 +1 ( ", "++1 555 1234567", "99999999999999999999999.1.1.1",
         "1 " * 20_000, "9" * 50_000, "a.b" * 20_000, "a@b.cc " * 3_000, "+1" * 5000, "é" * 100 + "8.8.8.8" + "ü" * 9 + "4111111111111111\n+49 30 1234567"]


def mixed(n=250):
    rng = random.Random(9)
    bits = [lambda: f"u{rng.randrange(99)}@mail{rng.randrange(9)}.example.com", lambda: ".".join(str(rng.randrange(300)) for _ in range(rng.randrange(3, 6))),
            lambda: "".join(rng.choice("0123456789 -") for _ in range(rng.randrange(5, 30))), lambda: f"+1 ({rng.randrange(100, 999)}) 555-{rng.randrange(1000, 9999)}",
            lambda: rng.choice(["word", "été", "call", "mail", "@", ".", "12", "v1.2.3", "1,000,000"])]
    return ["".join(rng.choice(bits)() + rng.choice([" ", "", "\n", ", "]) for _ in range(rng.randrange(1, 25))) for _ in range(n)]


def test_base_equals_brute_force(spark):
    texts = CASES + mixed()
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)] + [(None, CASES[3], "x", 1), (3, CASES[3], "x", 1)],
                               "doc_id long, text string, spans string, _id int")
    rows = pii.personal_data(df).collect()
    assert len(rows) == len(texts) + 2
    for r in rows:
        if r.doc_id is not None:
            want = brute(texts[r.doc_id])
            assert [r[f"n_{k}"] for k in pii.KINDS[:4]] == [sum(x[1] == i for x in want) for i in range(4)], texts[r.doc_id]
            assert r.base_sha256 == hashlib.sha256(name(want).encode()).hexdigest()
            assert ",".join(x for x in r.spans.split(",") if not x.startswith("likely")) == name(want)
            assert r.spans.count("likely") == r.n_likely
    assert pii.personal_data(df.limit(0)).count() == 0


def test_trees_as_expressions_give_the_library_scores(spark):
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(i, t) for i, t in enumerate(mixed(200))], "doc_id long, text string")
    x = pii.with_candidates(pii.with_base(df)).select(F.explode_outer("_proposed").alias("x")).where("x IS NOT NULL")
    table = x.select("x", array_to_vector("x.f").alias("features"), (F.col("x.f")[2] > 8).cast("double").alias("label"))
    fitted = GBTClassifier(maxIter=3, maxDepth=3, seed=1).fit(table)
    model = pii.Trees(tuple(pii._node(t._call_java("rootNode")) for t in fitted.trees), tuple(fitted.treeWeights), (0.5,) * 4)
    rows = fitted.transform(table).select(vector_to_array("probability")[1].alias("p"), F.expr(pii.score_sql(model)).alias("q")).collect()
    assert len(rows) > 100 and all(abs(r.p - r.q) < 1e-9 for r in rows)


def test_added_spans_lie_outside_the_base_and_redaction_takes_all(spark):
    texts = CASES[:18] + mixed(150)
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, _spans string")
    model = pii.fit(df)
    assert model is not None
    rows = {r.doc_id: r.spans for r in pii.personal_data(df).collect()}
    red = {r.doc_id: r.text for r in pii.redact(df.drop("_spans"), model).collect()}
    for i, t in enumerate(texts):
        spans = sorted((int(a), pii.KINDS.index(k), int(b)) for k, a, b in (x.split(":") for x in rows[i].split(",") if x))
        base = [x for x in spans if x[1] < 4]
        assert all(b[0] >= x[2] or x[0] >= b[2] for x in spans if x[1] == 4 for b in base)
        out, at = "", 0
        for a, k, b in spans:
            if a >= at:
                out += (t or "")[at:a] + f"[{pii.KINDS[k].upper()}]"
            at = max(at, b)
        assert red[i] == (out + t[at:] if spans else t)


@pytest.mark.parametrize("value,ok", [("4111111111111111", True), ("4111 1111-1111 1112", False), ("0", True)])
def test_luhn(spark, value, ok):
    assert spark.createDataFrame([(value,)], "v string").select(pii.luhn(pii.F.col("v"))).first()[0] == ok
