"""Benchmark decontamination over a distributed positional inverted index.

The index stores postings (term, document, position) of training tokens. Each test phrase fetches the
lists of its rarest terms; the lists are intersected with their offsets taken off, rarest first, and
what survives is compared word by word. DataFrame functions only.

Words are runs of a-z, 0-9 and characters from U+0080 on, after lower-casing A-Z. A phrase is 13
consecutive words of an item, or all words of a shorter item.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.url_rules import lower_az
from tidewater.llm.util import row_key, store

WINDOW = 13
#: Lists that are intersected for each phrase.
RAREST = 3
#: Rows of the test side (terms or phrases) up to which it is broadcast; beyond, joins shuffle both sides.
BROADCAST_ROWS = 200_000

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Array of the words of a text; null has none."""
    parts = F.split(F.coalesce(text, F.lit("")), NOT_WORD)
    return parts


def tokenized(rows: DataFrame, *keep: str, text_col: str = "text") -> DataFrame:
    """``keep`` columns and ``words``; what lies before the first and after the last word is cut off."""
    d = rows.select(*keep, words(lower_az(F.col(text_col))).alias("_parts"))
    head = F.when(F.get("_parts", F.lit(0)) == "", 1).otherwise(0)
    tail = F.when((F.size("_parts") > 1) & (F.element_at("_parts", -1) == ""), 1).otherwise(0)
    return d.select(*keep, F.slice("_parts", head + 1, F.size("_parts") - head - tail).alias("words"))


def phrases(items: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(phrase, len, ws, items): the distinct windows of all items, with the ids (as text) of the items that have them.

    Items without an id have phrases too, but no place among the ids.
    """
    t = tokenized(items.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("text")), "item")
    t = t.where(F.size("words") > 0)
    last = F.greatest(F.size("words") - window, F.lit(0))
    w = t.select("item", F.explode(F.transform(F.sequence(F.lit(0), last), lambda i: F.slice("words", i + 1, F.lit(window)))).alias("ws"))
    grouped = w.groupBy("ws").agg(F.collect_set("item").alias("items"))
    return grouped.select(F.unhex(F.md5(F.array_join("ws", " ").cast("binary"))).alias("phrase"), F.size("ws").alias("len"), "ws", "items")


def _small(df: DataFrame) -> DataFrame:
    """``df`` marked for broadcast if it has at most BROADCAST_ROWS rows, else as it is."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def term_counts(docs: DataFrame, terms: DataFrame, text_col: str = "text") -> DataFrame:
    """(term, n): occurrences over all documents of each of the terms; 0 where there are none."""
    tokens = tokenized(docs, text_col=text_col).select(F.explode_outer("words").alias("term"))
    seen = tokens.join(_small(terms.select("term")), "term").groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    return terms.select("term").join(seen, "term", "left").select("term", F.coalesce("n", F.lit(0).cast("long")).alias("n"))


def postings(docs: DataFrame, terms: DataFrame, key_col: str = "key", text_col: str = "text") -> DataFrame:
    """The index's rows (term, key, at) for the given terms over all documents."""
    tokens = tokenized(docs, key_col, text_col=text_col).select(F.col(key_col).alias("key"), F.posexplode_outer("words").alias("at", "term"))
    return tokens.join(_small(terms.select("term").distinct()), "term").select("term", "key", "at")


def rarest_terms(tests: DataFrame, counts: DataFrame, n: int = RAREST) -> DataFrame:
    """(phrase, len, picks): the first place of each phrase's ``n`` rarest terms as (n, term, offset), rarest first."""
    terms = tests.select("phrase", "len", F.posexplode("ws").alias("offset", "term"))
    first = terms.groupBy("phrase", "len", "term").agg(F.min("offset").alias("offset"))
    ranked = first.join(counts, "term").groupBy("phrase", "len").agg(F.array_sort(F.collect_list(F.struct("n", "term", "offset"))).alias("picks"))
    return ranked.select("phrase", "len", F.slice("picks", 1, n).alias("picks"))


def phrase_matches(index: DataFrame, lists: DataFrame) -> DataFrame:
    """(key, phrase, len, start): where all the fetched lists agree after taking their offsets off."""
    found = None
    for i in range(RAREST):
        one = lists.where(F.size("picks") > i).select("phrase", "len", F.get("picks", F.lit(i))["term"].alias("term"), F.get("picks", F.lit(i))["offset"].alias("offset"))
        if found is None:
            starts = index.join(_small(one), "term").select("key", "phrase", "len", (F.col("at") - F.col("offset")).alias("start"))
            found = starts.where("start >= 0")
            continue
        rest = lists.where(F.size("picks") <= i).select("phrase")
        probe = found.join(_small(one.drop("len")), "phrase").withColumn("at", F.col("start") + F.col("offset"))
        kept = probe.join(index, ["key", "term", "at"], "left_semi").select("key", "phrase", "len", "start")
        found = kept.unionByName(found.join(_small(rest), "phrase", "left_semi"))
    return found.distinct()


def exact(matches: DataFrame, docs: DataFrame, tests: DataFrame, key_col: str = "key", text_col: str = "text") -> DataFrame:
    """Those matches whose words all equal the phrase's: (key, phrase, len, start)."""
    grouped = matches.groupBy("key").agg(F.collect_list(F.struct("start", "len", "phrase")).alias("m"))
    rows = tokenized(docs.select(F.col(key_col).alias("key"), F.col(text_col).alias("text")).join(grouped, "key"), "key", "m").distinct()
    cut = F.transform("m", lambda m: F.struct(m.start.alias("start"), m.phrase.alias("phrase"), F.slice("words", m.start + 1, m["len"]).alias("ws")))
    seen = rows.select("key", F.explode(cut).alias("m")).select("key", "m.*")
    return seen.join(_small(tests.select("phrase", "len", "ws")), ["phrase", "ws"]).select("key", "phrase", "len", "start")


def proximity_matches(index: DataFrame, pairs: DataFrame, within: int) -> DataFrame:
    """(pair, key, at_a, at_b) where both terms of a pair (pair, term_a, term_b) stand at most ``within`` words apart.

    Positions meet in cells of ``within`` words and the cells beside them, so the join is an equality.
    """
    a = index.join(pairs.select("pair", F.col("term_a").alias("term")), "term").select("pair", "key", F.col("at").alias("at_a"))
    b = index.join(pairs.select("pair", F.col("term_b").alias("term")), "term").select("pair", "key", F.col("at").alias("at_b"))
    size = max(within, 1)
    cell = lambda c: F.floor(F.col(c) / size).cast("int")
    near = a.withColumn("cell", F.explode(F.array(cell("at_a") - 1, cell("at_a"), cell("at_a") + 1)))
    return near.join(b.withColumn("cell", cell("at_b")), ["pair", "key", "cell"]).where(F.abs(F.col("at_a") - F.col("at_b")) <= within).drop("cell")


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """Per document: id, n_words, n_hit, n_items, items_sha256, contaminated.

    Null, empty and wordless texts have no words and no hits, and so have wordless items. Passages of items without
    an id are hits like others; such items can't be named and so don't count among n_items. Rows that repeat an
    id are judged by their own text, items that repeat an id are one item in the list. A text's words are one row's array,
    however long. Other columns are not read; an empty table gives no rows.
    """
    return judged(docs, items, id_col, text_col, item_col).drop("key")


def judged(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """``contamination`` with each row's key, ``row_key`` of its id and text."""
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("text")).withColumn("key", row_key("_id", "text"))
    tests = store(phrases(items, item_col), "phrases")
    counts = store(term_counts(rows, tests.select(F.explode("ws").alias("term")).distinct()), "term-counts")
    lists = store(rarest_terms(tests, counts), "lists")
    index = store(postings(rows, lists.select(F.explode("picks.term").alias("term"))), "postings")
    matches = store(phrase_matches(index, lists), "matches")
    sure = store(exact(matches, rows, tests), "phrases-found")
    hit = sure.select("key", F.explode(F.sequence("start", F.col("start") + F.col("len") - 1)).alias("at")).distinct()
    hits = hit.groupBy("key").agg(F.count(F.lit(1)).alias("n_hit"))
    named = sure.select("key", "phrase").distinct().join(_small(tests.select("phrase", F.explode("items").alias("item"))), "phrase")
    per = hits.join(named.groupBy("key").agg(F.array_sort(F.collect_set("item")).alias("found")), "key", "left")
    sized = tokenized(rows, "_id", "key").select("_id", "key", F.size("words").cast("long").alias("n_words"))
    out = sized.join(per, "key", "left").withColumn("n_hit", F.coalesce("n_hit", F.lit(0).cast("long")))
    found = F.coalesce("found", F.array().cast("array<string>"))
    return out.select("key", F.col("_id").alias(id_col), "n_words", "n_hit", F.size(found).cast("long").alias("n_items"),
                      F.sha2(F.array_join(found, ",").cast("binary"), 256).alias("items_sha256"),
                      ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"))


def contamination_sql() -> str:
    """DuckDB SQL for ``contamination`` over ``documents`` and ``benchmark``."""
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    ws = rf"list_filter(regexp_split_to_array({lower}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {ws} AS ws FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {ws} AS ws FROM benchmark),
spot AS (SELECT item, ws, unnest(range(1, greatest(len(ws) - {WINDOW - 1}, 1) + 1)) AS i FROM b WHERE len(ws) > 0),
win AS (SELECT DISTINCT item, least(len(ws), {WINDOW}) AS n, array_to_string(ws[i:i + {WINDOW - 1}], ' ') AS g FROM spot),
sizes AS (SELECT DISTINCT n FROM win),
pos AS (SELECT rid, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d, sizes WHERE len(ws) >= n),
m AS (SELECT p.rid, p.i, p.n, win.item FROM (SELECT rid, i, n, array_to_string(ws[i:i + n - 1], ' ') AS g FROM pos) p JOIN win USING (n, g)),
h AS (SELECT rid, count(DISTINCT k) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS k FROM m) GROUP BY rid),
it AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT rid, item FROM m WHERE item IS NOT NULL) GROUP BY rid)
SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN h USING (rid) LEFT JOIN it USING (rid)"""
