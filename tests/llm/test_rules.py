import random
import re

from tidewater.llm import rule_ledger as r


def brute(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen = {}
    for i in range(len(w) - 2):
        seen.setdefault(tuple(w[i:i + 3]), []).append(i)
    covered = {i + k for v in seen.values() if len(v) > 1 for i in v for k in range(3)}
    m = {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(t.count(c) for c in "#*$%&|<>"),
         "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered)}
    return m | {"base_failed": len(w) < 50 or 100 * len(covered) > 50 * len(w)}


def texts():
    rng = random.Random(5)
    some = ["", None, " \t\n", "one", "a b c a b c", "x " * 500, "a b\x0bc\x0cd\re  f", "\n\nsame\nsame \nsame\n", "é ü 東京 🙂 # | <>",
            "a b  c", "w" * 100_000, "a b " * 40_000]
    words = ["red", "blue", "green", "stone", "river", "and", "#x", "été"]
    return some + [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 400))) for _ in range(60)]


def test_base_equals_brute_force(spark):
    ts = texts()
    df = spark.createDataFrame([(i, t, 1, "z") for i, t in enumerate(ts)] + [(None, "a b", 1, "z"), (4, ts[4], 2, "y")],
                               "doc_id long, text string, n_words int, _text string")
    out = r.judge(df).collect()
    assert len(out) == len(ts) + 2
    for row in out:
        if row.doc_id is not None:
            want = brute(ts[row.doc_id])
            assert {k: row[k] for k in want} == want, ts[row.doc_id]
            assert not (row.kept and row.base_failed)
    assert r.judge(df.limit(0)).count() == 0


def test_policies_and_ablation_from_bits(spark):
    clean = " ".join(f"word{i} stone" for i in range(60))
    docs = [clean, clean.upper() + "!", " ".join(f"w{i}<>" for i in range(60)), "short text", " | ".join(["A!"] * 60), ""]
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    marked = r.ledger(df)
    bits = {x.doc_id: x.fail_bits for x in marked.collect()}
    names = lambda b: {rule.name for i, rule in enumerate(r.RULES) if b >> i & 1}
    assert names(bits[0]) == set() and names(bits[1]) == {"capitals"} and names(bits[2]) == {"symbols"} and names(bits[3]) == {"few_words"}
    got = {(x.policy, x.rule): (x.n_kept, x.n_failed, x.n_only) for x in r.ablation(marked).collect()}
    for p, rules in r.POLICIES.items():
        m = r.mask(p)
        for i, rule in enumerate(r.RULES):
            if rule.name in rules:
                assert got[p, rule.name] == (sum(not b & m for b in bits.values()), sum(b >> i & 1 for b in bits.values()),
                                             sum(b & m == 1 << i for b in bits.values()))
