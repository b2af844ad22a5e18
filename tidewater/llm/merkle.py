"""Merkle manifest of a dataset as a content-addressed DAG.

A row's leaf is the digest of its fields. Rows are sorted by ranges of (source, id) and ranked within their
source; every three consecutive digests have a parent until one is left, the source's subroot, and subroots
in the order of their sources have the root in the same way. Records map a digest to its children; those
of six levels below a node lie together as that node's segment (at most 364 records), stored once for
equal digests. All rows request their proof at once: requests descend from the root by the base-3 digits of
their rank, one segment a step, and those below one node travel as one row until they part. A step
collects the children not selected; read backwards, the collected pieces are the proof.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.util import store

FANOUT = 3
#: Levels of a segment, and the nodes at its bottom.
LEVELS = 6
BOTTOM = FANOUT ** LEVELS

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: What a step of a descent collects: the children left and right of the selected one, as joined digests.
_STEP = "array<struct<left:string,right:string>>"


def digest(parts: Iterable[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _field(c: Column) -> Column:
    s = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf_of(text: str = "text") -> Column:
    """Digest of a row's fields, each by its length, so that no two rows of different fields agree."""
    return F.sha2(F.concat(*(_field(F.col(text if c == "text" else c)) for c in FIELDS)).cast("binary"), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """Per row: id, source, leaf, and ``sent``, the leaf as it is after tampering (null where nothing is done).

    Rows whose id has an even CRC-32 lose the line ends of their text; rows without an id are never touched.
    """
    even = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(2)) == 0
    d = docs.select(*FIELDS).withColumn("_text", F.replace("text", F.lit("\n"), F.lit("")))
    return d.select(F.col("doc_id").alias("id"), "source", leaf_of().alias("leaf"), F.when(even, leaf_of("_text")).alias("sent"))


def ranked(rows: DataFrame, group: str | None, *order: Column) -> DataFrame:
    """The rows with ``idx``, their rank from 0 on in the order within their group, and ``n``, the group's size.

    Sorted by ranges, so that a large group is split; groups are told apart by ``group`` (all rows: None), which comes first in the order.
    """
    n = max(rows.rdd.getNumPartitions(), 1)
    keys = [group] if group else []
    dealt = rows.withColumn("_uid", F.monotonically_increasing_id())
    dealt = dealt.repartitionByRange(n, *order, "_uid").sortWithinPartitions(*order, "_uid")
    # the number of a row in its partition; ranks follow from where its group begins there
    dealt = store(dealt.withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()).drop("_uid"), "sorted")
    counts = dealt.groupBy(*keys, "_part").agg(F.min("_at").alias("_low"), F.count(F.lit(1)).alias("_c"))
    before = Window.partitionBy(*keys or [F.lit(0)]).orderBy("_part")
    starts = counts.withColumn("_first", F.sum("_c").over(before) - F.col("_c"))
    starts = starts.withColumn("n", F.sum("_c").over(Window.partitionBy(*keys or [F.lit(0)])))
    out = dealt.join(store(starts.drop("_c"), "starts"), [*keys, "_part"])
    return out.withColumn("idx", F.col("_first") + F.col("_at") - F.col("_low")).drop("_part", "_at", "_low", "_first")


def grow(digests: list[str], levels: int) -> tuple[str, list[dict]]:
    """The node ``levels`` above consecutive digests, and the records (digest, children) on the way, the top last."""
    records = {}
    for _ in range(levels):
        parents = []
        for i in range(0, len(digests), FANOUT):
            children = digests[i:i + FANOUT]
            parents.append(digest(children))
            records[parents[-1]] = children
        digests = parents
    return digests[0], [{"digest": d, "children": c} for d, c in records.items()]


def height(n: int) -> int:
    """Levels above ``n`` nodes until one remains."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FANOUT), levels + 1
    return levels


def build(nodes: DataFrame) -> list[DataFrame]:
    """Segments from the bottom up over nodes (g, idx, digest, n): each table has (g, idx, digest, n, levels, records).

    A segment's ``idx`` counts the segments of its height in ``g``, ``n`` says how many there are. A group is in
    as many tables as its height asks for, in one at least; where n is 1, ``digest`` is its root.
    """
    def segment(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("idx")
        n = int(rows["n"].iloc[0])
        levels = min(LEVELS, height(n))
        top, records = grow(rows["digest"].tolist(), levels)
        return pd.DataFrame({"g": rows["g"].iloc[:1].tolist(), "idx": [int(rows["idx"].iloc[0]) // BOTTOM], "digest": [top], "n": [-(-n // BOTTOM)], "levels": [levels], "records": [records]})

    kind = "g string, idx long, digest string, n long, levels int, records array<struct<digest:string,children:array<string>>>"
    out = []
    while True:
        made = nodes.groupBy("g", F.floor(F.col("idx") / BOTTOM).alias("block")).applyInPandas(segment, kind)
        out.append(store(made, "segments"))
        nodes = out[-1].where("n > 1").select("g", "idx", "digest", "n")
        if nodes.isEmpty():
            return out


def steps_down(records: dict[str, list[str]], top: str, place: int, levels: int) -> tuple[str, list[dict]]:
    """The node at ``place`` of a segment's bottom and the steps from its top: each digit of the rank selects a child."""
    steps = []
    for level in range(levels - 1, -1, -1):
        children = records[top]
        k = place // FANOUT ** level % FANOUT
        steps.append({"left": "".join(children[:k]), "right": "".join(children[k + 1:])})
        top = children[k]
    return top, steps


def _bottoms(wanted: DataFrame, segments: DataFrame) -> DataFrame:
    """Requests (g, idx, digest, path) at segments' tops moved to all nodes of the segments' bottoms: (g, idx, digest, path)."""
    records = segments.select("digest", "levels", "records").dropDuplicates(["digest"])
    both = wanted.join(records, "digest")

    def down(rows: Iterable[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        for frame in rows:
            for r in frame.itertuples(index=False):
                table = {x["digest"]: list(x["children"]) for x in r.records}
                out, level = [(r.digest, 0, [])], 0
                while level < r.levels:
                    level += 1
                    nxt = []
                    for d, i, steps in out:
                        children = table[d]
                        nxt += [(c, FANOUT * i + k, [*steps, {"left": "".join(children[:k]), "right": "".join(children[k + 1:])}]) for k, c in enumerate(children)]
                    out = nxt
                path = [dict(left=s["left"], right=s["right"]) for s in r.path]
                yield pd.DataFrame({"g": [r.g] * len(out), "idx": [BOTTOM * r.idx + i for _, i, _ in out], "digest": [d for d, _, _ in out], "path": [path + s for _, _, s in out]})

    return both.select("g", "idx", "digest", "path", "levels", "records").mapInPandas(down, f"g string, idx long, digest string, path {_STEP}")


def descend(tops: DataFrame, segments: list[DataFrame]) -> DataFrame:
    """Requests (g, digest, path) at the roots of groups, moved to the lowest segments' tops: (g, idx, digest, path)."""
    wanted = None
    for k in range(len(segments) - 1, -1, -1):
        # roots of the groups that are no higher than this
        here = segments[k].where("n = 1").select("g", "idx").join(tops, "g").select("g", "idx", "digest", "path")
        wanted = here if wanted is None else wanted.unionByName(here)
        if k:
            wanted = store(_bottoms(wanted, segments[k]), "descended")
    return store(wanted, "descended")


def fold(leaf: str, steps: list[dict]) -> str:
    """The root that a leaf and its steps from the root down give."""
    for s in reversed(steps):
        leaf = digest((s["left"], leaf, s["right"]))
    return leaf


def proof(steps: list[dict]) -> str:
    """Digest of all siblings from the leaf's level up to the root, left to right."""
    return digest(x for s in reversed(steps) for x in (s["left"], s["right"]))


def manifest(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    Needs the columns doc_id, source, lang, n_chars and text; others are not read. Rows of a source ascend by id, those
    without one first, equal ids by leaf, so repeated rows are leaves side by side with equal values but proofs of their own.
    A null source is a group of its own before all others. A null field is ``-`` and differs from an empty one; a
    row without an id isn't tampered with. Texts are digested whole. An empty table gives no rows.
    """
    spark, kind = docs.sparkSession, docs.schema["doc_id"].dataType.simpleString()
    own = docs.select(*FIELDS)
    rows = store(leaves(own).withColumn("g", F.coalesce(F.concat(F.lit("="), "source"), F.lit("~"))), "leaves")
    order = (F.col("source").isNotNull(), F.col("source"), F.col("id"), F.col("leaf"))
    rows = store(ranked(rows, "g", *order).select("g", "source", "id", "idx", "n", "leaf", "sent"), "ranked")
    trees = build(rows.select("g", "idx", F.col("leaf").alias("digest"), "n"))
    roots = trees[0].where("n = 1").select("g", "digest")
    for t in trees[1:]:
        roots = roots.unionByName(t.where("n = 1").select("g", "digest"))
    names = roots.select("g", "digest", (F.col("g") != "~").alias("named"))
    names = store(ranked(names, None, F.col("named"), F.col("g")), "subroots")
    if names.isEmpty():
        return spark.createDataFrame([], f"doc_id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
    forest = build(names.select(F.lit("").alias("g"), "idx", "digest", "n"))
    root = forest[-1].where("n = 1").first()["digest"]
    none = F.array().cast(_STEP)
    start = spark.createDataFrame([("", root)], "g string, digest string").withColumn("path", none)
    # from the root to the subroots, each of which is the request of a whole source
    at = _bottoms(descend(start, forest), forest[0]).select("idx", "path")
    tops = store(names.join(at, "idx").select("g", "digest", "path"), "tops")
    wanted = descend(tops, trees)
    records = trees[0].select("digest", "levels", "records").dropDuplicates(["digest"])
    above = height(names.count())

    def answer(key, asked: pd.DataFrame, top: pd.DataFrame) -> pd.DataFrame:
        r = next(top.itertuples(index=False))
        table = {x["digest"]: list(x["children"]) for x in r.records}
        subroot = fold(r.digest, r.path[above:])
        out = {"doc_id": asked["id"], "leaf": asked["leaf"], "proof_sha256": [], "folded_root": []}
        for idx, leaf, sent in asked[["idx", "leaf", "sent"]].itertuples(index=False):
            found, steps = steps_down(table, r.digest, idx % BOTTOM, r.levels)
            if found != leaf:
                raise ValueError("the records don't lead to the row's leaf")
            path = [*r.path, *steps]
            out["proof_sha256"].append(proof(path))
            out["folded_root"].append(fold(sent or leaf, path))
        return pd.DataFrame(out).assign(subroot=subroot)

    asked = rows.select("g", F.floor(F.col("idx") / BOTTOM).alias("block"), F.col("id").cast("string").alias("id"), "idx", "leaf", "sent").groupBy("g", "block")
    top = wanted.join(records, "digest").select("g", F.col("idx").alias("block"), "digest", "path", "levels", "records").groupBy("g", "block")
    done = asked.cogroup(top).applyInPandas(answer, "doc_id string, leaf string, subroot string, proof_sha256 string, folded_root string")
    return done.select(F.col("doc_id").cast(kind).alias("doc_id"), "leaf", "subroot", F.lit(root).alias("root"), "proof_sha256", "folded_root", (F.col("folded_root") == root).alias("verified"))


def _grown_sql(name: str, base: str) -> str:
    """CTEs over a base (g, idx, h, n): ``name`` has all levels, ``name``_s the siblings left and right of each node below a root."""
    beside = "OVER (PARTITION BY g, lvl, idx // 3 ORDER BY idx ROWS BETWEEN"
    return f"""{name} AS (SELECT g, 0 AS lvl, idx, h, n FROM {base}
  UNION ALL SELECT g, lvl + 1, idx // 3, sha256(string_agg(h, '' ORDER BY idx)), (any_value(n) + 2) // 3 FROM {name} WHERE n > 1 GROUP BY g, lvl, idx // 3),
{name}_s AS (SELECT g, lvl, idx, coalesce(string_agg(h, '') {beside} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
  coalesce(string_agg(h, '') {beside} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name} WHERE n > 1)"""


def manifest_sql() -> str:
    """DuckDB SQL for ``manifest`` over ``documents``."""
    field = lambda e: f"coalesce(strlen(CAST({e} AS VARCHAR)) || ':' || CAST({e} AS VARCHAR), '-')"
    leaf = lambda text: f"sha256({' || '.join(field(text if c == 'text' else c) for c in FIELDS)})"
    bits = "list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)"
    crc = f"xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))), lambda a, b: {bits}), 4294967295)"
    walk = lambda name, base, tree: f"""{name} AS (SELECT rid, g, 0 AS lvl, idx, x, p FROM {base}
  UNION ALL SELECT w.rid, w.g, w.lvl + 1, w.idx // 3, sha256(s.l || w.x || s.r), w.p || s.l || s.r FROM {name} w JOIN {tree}_s s USING (g, lvl, idx)),
{name}_top AS (SELECT rid, arg_max(x, lvl) AS x, arg_max(p, lvl) AS p FROM {name} GROUP BY rid)"""
    return f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce('=' || source, '~') AS g, {leaf('text')} AS leaf,
  CASE WHEN doc_id IS NOT NULL AND {crc} % 2 = 0 THEN {leaf("replace(text, chr(10), '')")} END AS sent FROM documents),
o AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY g) AS n FROM d),
base AS (SELECT g, idx, leaf AS h, n FROM o),
{_grown_sql('tree', 'base')},
sub AS (SELECT g, h FROM tree WHERE n = 1),
forest_base AS (SELECT '' AS g, row_number() OVER (ORDER BY g <> '~', g) - 1 AS idx, h, count(*) OVER () AS n, g AS own FROM sub),
{_grown_sql('forest', 'forest_base')},
asked AS (SELECT rid, g, idx, coalesce(sent, leaf) AS x, '' AS p FROM o),
{walk('low', 'asked', 'tree')},
between_trees AS (SELECT o.rid, '' AS g, f.idx, t.x, t.p FROM o JOIN low_top t USING (rid) JOIN forest_base f ON f.own = o.g),
{walk('high', 'between_trees', 'forest')},
root AS (SELECT h AS root FROM forest WHERE n = 1)
SELECT o.doc_id, o.leaf, sub.h AS subroot, root.root, sha256(t.p) AS proof_sha256, t.x AS folded_root, t.x = root.root AS verified
FROM o JOIN high_top t USING (rid) JOIN sub USING (g) CROSS JOIN root"""
