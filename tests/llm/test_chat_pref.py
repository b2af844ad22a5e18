from tidewater.llm import chat_pref as c


def brute(a, b):
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1

    def side(turns):
        out, spans = "", []
        for role, text in turns:
            head = f"<|{role}|>\n"
            if role == "assistant":
                spans.append((len(out) + len(head), len(out) + len(head) + len(text) + len(c.END)))
            out += head + text + c.END + "\n"
        return out, spans

    (p, _), (x, mx), (y, my) = side(a[:n]), side(a[n:]), side(b[n:])
    return n, p, x, y, mx, my


PAIRS = [
    ([], []), ([("user", "hi")], []), ([("user", "hi"), ("assistant", "yo")], [("user", "hi"), ("assistant", "yo")]),
    ([("user", "hi"), ("assistant", "é🙂")], [("user", "hi"), ("assistant", "no"), ("user", "x"), ("assistant", "")]),
    ([("system", "s"), ("user", "a")], [("user", "s"), ("user", "a")]), ([("assistant", "t" * 50_000)], [("assistant", "u")]),
    ([(r, str(i)) for i in range(300) for r in ("user", "assistant")], [(r, str(i)) for i in range(299) for r in ("user", "assistant")]),
]


def test_pairs_equal_brute_force(spark):
    turns = lambda v: [(i, r, t) for i, (r, t) in enumerate(v)]
    kind = "array<struct<turn:int,role:string,text:string>>"
    df = spark.createDataFrame([(i, turns(a), turns(b), "x") for i, (a, b) in enumerate(PAIRS)], f"pair_id int, chosen {kind}, rejected {kind}, _n string")
    for r in c.format_pairs(df).collect():
        a, b = PAIRS[r.pair_id]
        assert (r.n_prompt_turns, r.prompt, r.chosen, r.rejected, [tuple(s) for s in r.chosen_mask], [tuple(s) for s in r.rejected_mask]) == brute(a, b)


def test_swapped_replies(spark):
    rows = [(1, 1, "assistant", "one"), (1, 0, "user", "q"), (2, 0, "user", None), (2, 1, "assistant", "two"), (2, 2, "user", "more"),
            (3, 0, "user", "alone"), (4, 0, None, "odd"), (4, 1, "assistant", "four"), (None, 0, "assistant", "none"), (5, 0, "assistant", "four"),
            (5, 0, "assistant", "four")]
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], "conv_id long, turn int, role string, text string, at int, reply string")
    got = {r.pair_id: r for r in c.preferences(df).collect()}
    assert set(got) == {1, 2, 4, 5}
    assert (got[1].n_prompt_turns, got[1].chosen, got[1].rejected) == (1, "<|assistant|>\none<|end|>\n", "<|assistant|>\ntwo<|end|>\n")
    assert got[1].chosen_mask == "14:24" and got[2].n_prompt_turns == 1 and got[2].rejected.startswith("<|assistant|>\n<|end|>")
    assert got[4].n_prompt_turns == 2 and got[4].chosen == got[4].rejected == got[4].chosen_mask == ""
    assert c.preferences(df.limit(0)).count() == 0
