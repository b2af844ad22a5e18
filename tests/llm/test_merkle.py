import hashlib
import random
import zlib

import duckdb
import pytest

from tidewater.llm import merkle as mk


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def climb(nodes, marks):
    """The root of a list of digests and, for each of the marked places, its siblings as (before, after), lowest first."""
    sides = {m: [] for m in marks}
    at = {m: m for m in marks}
    while len(nodes) > 1:
        for m in marks:
            lo = at[m] // 3 * 3
            sides[m].append((nodes[lo:at[m]], nodes[at[m] + 1:lo + 3]))
            at[m] //= 3
        nodes = [h(*nodes[i:i + 3]) for i in range(0, len(nodes), 3)]
    return nodes[0], sides


def plain(rows):
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append(r)
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    subs, inner = [], {}
    for s in order:
        by[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        root, sides = climb([leaf(r) for r in by[s]], range(len(by[s])))
        subs.append(root)
        inner[s] = sides
    root, outer = climb(subs, range(len(subs)))
    out = []
    for k, s in enumerate(order):
        for i, r in enumerate(by[s]):
            steps = inner[s][i] + outer[k]
            sent = r
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None:
                sent = (*r[:4], r[4].replace("\n", ""))
            x = leaf(sent)
            for a, b in steps:
                x = h(*a, x, *b)
            out.append((r[0], leaf(r), subs[k], root, h(*(d for a, b in steps for d in a + b)), x, x == root))
    return out


def corpus():
    rng = random.Random(4)
    rows = [(i, f"s{i % 7}" if i % 3 else "hot", rng.choice(["en", "de", None]), i * 7, "\n".join("ab" * rng.randint(0, 5) for _ in range(rng.randint(0, 4)))) for i in range(1800)]
    rows += [(None, "hot", None, None, None), (None, "hot", None, None, "a\nb"), (7, None, "en", 1, "x\ny"), (8, None, "en", 1, ""), (9, "", None, 3, "empty source\n"),
             (2**60 + 1, "é", "fr", 2, "ü\n"), (5000, "one", "en", 5, "alone\n"), (5001, "~", "en", 5, "tilde"), (5002, "=", "en", 5, "equals"), (4, "hot", "en", 9, "twice\n"), (4, "hot", "en", 9, "twice\n")]
    return rows


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def test_equals_plain_trees_and_sql(spark, tmp_path):
    rows = corpus()
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", leaf string, idx int").repartition(5)
    out = mk.manifest(docs)
    assert out.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"] and out.dtypes[0][1] == "bigint"
    key = lambda rows: sorted(map(str, rows))
    got = key(tuple(r) for r in out.collect())
    want = key(plain(rows))
    assert got == want
    assert any(not r[-1] for r in plain(rows)) and any(r[-1] for r in plain(rows))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert key(con.execute(mk.manifest_sql()).fetchall()) == want


def test_three_segments_and_repeated_subtrees(spark, monkeypatch):
    monkeypatch.setattr(mk, "LEVELS", 2)
    monkeypatch.setattr(mk, "BOTTOM", 9)
    rows = [(None, "copies", "en", 1, "same")] * 400 + [(i, f"s{i}", "en", 1, f"t\n{i}") for i in range(120)] + [(i, "big", "en", 1, f"u\n{i}") for i in range(200, 330)]
    out = mk.manifest(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(str(tuple(r)) for r in out) == sorted(map(str, plain(rows)))


@pytest.mark.parametrize("rows", [[], [(1, "a", "en", 3, "x\ny")], [(None, None, None, None, None)]])
def test_tiny_tables(spark, rows):
    out = mk.manifest(spark.createDataFrame(rows, SCHEMA))
    assert [tuple(r) for r in out.collect()] == (plain(rows) if rows else []) and out.dtypes[0] == ("doc_id", "bigint")


def test_a_changed_row_does_not_verify():
    path = [{"left": "a", "right": "b"}, {"left": "", "right": "c"}]
    assert mk.fold("x", path) == h("a", h("x", "c"), "b") and mk.fold("y", path) != mk.fold("x", path)
    assert mk.proof(path) == h("c", "a", "b") and mk.proof([]) == h()
