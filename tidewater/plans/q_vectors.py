"""Queries for vector operators and similarity dedup."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.functions import text as T
from tidewater.functions.vocab import english_stop_words
from tidewater.llm.util import store
from tidewater.operators import dedup, minhash, report, similarity
from tidewater.operators.ranking import with_ordinal
from tidewater.plans.registry import query
from tidewater.plans.q_text import WS, s_list, s_strip
from tidewater.sources.tables import scan_table

STOP = english_stop_words()


def emb(spark, sf_dir):
    return scan_table(spark, sf_dir, "embeddings")


# ------------------------------------------------------------------ J5 cosine pairs
@query("cosine_pairs", sql="""
SELECT a.vec_id AS i_key, b.vec_id AS j_key, round(list_cosine_similarity(a.embedding, b.embedding), 5) AS sim
FROM embeddings a JOIN embeddings b ON a.vec_id < b.vec_id
WHERE list_cosine_similarity(a.embedding, b.embedding) > 0.4
""")
def q_cosine_pairs(spark, sf_dir):
    """J5 exact: embedding pairs with cosine > 0.4 (block-pair matrix products)."""
    p = similarity.cosine_pairs(emb(spark, sf_dir), "vec_id", "embedding", 0.4, order="vec_id")
    return p.select("i_key", "j_key", F.round("sim", 5).alias("sim"))


# ------------------------------------------------------------------ J7 nearest
CENTROIDS_SQL = """
c AS (SELECT label, list(m ORDER BY idx) AS centroid FROM (
        SELECT label, idx, avg(x) AS m FROM (
          SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS idx FROM embeddings)
        GROUP BY label, idx) GROUP BY label)
"""


@query("nearest", sql=f"""
WITH {CENTROIDS_SQL},
d AS (SELECT CAST(c.label AS BIGINT) AS q_key, e.vec_id AS c_key,
             list_sum(list_transform(list_zip(c.centroid, e.embedding), lambda p: (p[1] - p[2]) * (p[1] - p[2])))
             AS dist FROM c, embeddings e)
SELECT q_key, c_key, round(dist, 4) AS distance, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY q_key ORDER BY dist, c_key) AS rank FROM d) WHERE rank <= 5
""")
def q_nearest(spark, sf_dir):
    """The 5 nearest embeddings (squared L2) to each label centroid."""
    e = emb(spark, sf_dir)
    cent = similarity.centroids(e, "label", "embedding")
    nn = similarity.nearest(cent, "label", "centroid", e, "vec_id", "embedding", k=5)
    return nn.select("q_key", "c_key", F.round("distance", 4).alias("distance"), F.col("rank").cast("long"))


# ------------------------------------------------------------------ J4 / A1 word vectors
def word_vectors(spark, sf_dir):
    """Word-vector table: alphabetic document words ranked by frequency <-> embeddings by vec_id."""
    words = scan_table(spark, sf_dir, "documents").select(
        F.explode(T.alpha_tokens("text")).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("cnt"))
    ranked = with_ordinal(words, [F.col("cnt").desc(), F.col("token")], "rank", start=0)
    return ranked.join(emb(spark, sf_dir).select(F.col("vec_id").alias("rank"), F.col("embedding").alias("vector")),
                       "rank").select("token", "vector")


WORDS_SQL = """
wv AS (SELECT w.token, e.embedding AS vector FROM (
         SELECT token, row_number() OVER (ORDER BY cnt DESC, token) - 1 AS rank FROM (
           SELECT token, count(*) AS cnt FROM (SELECT unnest(regexp_extract_all(text, '\\p{L}+')) AS token FROM documents)
           GROUP BY token)) w JOIN embeddings e ON e.vec_id = w.rank)
"""


def text_tokens(spark, sf_dir):
    d = scan_table(spark, sf_dir, "documents").select("doc_id", "source", F.col("text").alias("h"))
    return d.withColumn("toks", T.drop_stop_words(T.split_words(F.col("h")), STOP))


def s_tokens_sql() -> str:
    s = s_strip("text")
    return (f"list_filter(CASE WHEN {s} = '' THEN []::VARCHAR[] ELSE regexp_split_to_array({s}, '{WS}+') END, "
            f"lambda w: NOT list_contains({s_list(STOP)}, lower(w)))")


MEAN_SQL = f"""
tk AS (SELECT doc_id, source, {s_tokens_sql()} AS toks FROM documents),
occ AS (SELECT doc_id, unnest(toks) AS token FROM tk),
mv AS (SELECT doc_id, list(m ORDER BY idx) AS mean_vec FROM (
         SELECT doc_id, idx, avg(x) AS m FROM (
           SELECT occ.doc_id, unnest(wv.vector) AS x, generate_subscripts(wv.vector, 1) AS idx
           FROM occ JOIN wv ON occ.token = wv.token) GROUP BY doc_id, idx) GROUP BY doc_id),
vecs AS (SELECT tk.doc_id, tk.source,
                coalesce(mv.mean_vec, list_transform(range(64), lambda i: 0.0)) AS mean_vec
         FROM tk LEFT JOIN mv ON tk.doc_id = mv.doc_id)
"""


def doc_vectors(spark, sf_dir):
    return similarity.mean_vector(text_tokens(spark, sf_dir), "doc_id", "toks", word_vectors(spark, sf_dir), 64)


@query("mean_vector", sql=f"""
WITH {WORDS_SQL}, {MEAN_SQL}
SELECT doc_id, list_transform(mean_vec, lambda x: round(x, 4) + 0.0) AS mean_vec FROM vecs
""")
def q_mean_vector(spark, sf_dir):
    """J4 + A1: mean word vector of each whole text (stop words dropped; unknown words skipped)."""
    v = doc_vectors(spark, sf_dir)
    return v.select("doc_id", F.transform("mean_vec", lambda x: F.round(x.cast("double"), 4)).alias("mean_vec"))


# ------------------------------------------------------------------ D1 / D2 greedy dedup
def greedy_sql(edges_cte: str, ids_sql: str, seed_kept: str = "[]::BIGINT[]") -> str:
    """Sequential greedy over ordered ids as a recursive CTE (the oracle form of D1/D2)."""
    return f"""
WITH RECURSIVE {edges_cte},
ids AS MATERIALIZED (SELECT id, row_number() OVER (ORDER BY id) AS rn FROM ({ids_sql})),
nb AS MATERIALIZED (SELECT j, list(i) AS l FROM e GROUP BY j),
steps AS MATERIALIZED (SELECT ids.rn, ids.id, coalesce(nb.l, []::BIGINT[]) AS l FROM ids LEFT JOIN nb ON nb.j = ids.id),
g(rn, kept) AS (
  SELECT 0, {seed_kept}
  UNION ALL
  SELECT g.rn + 1, CASE WHEN len(list_intersect(g.kept, s.l)) > 0 THEN g.kept ELSE list_append(g.kept, s.id) END
  FROM g JOIN steps s ON s.rn = g.rn + 1)
"""


EMB_EDGES = """e AS (SELECT a.vec_id AS i, b.vec_id AS j FROM embeddings a JOIN embeddings b ON a.vec_id < b.vec_id
                     WHERE list_cosine_similarity(a.embedding, b.embedding) > 0.4)"""


@query("dedup_greedy", sql=greedy_sql(EMB_EDGES, "SELECT vec_id AS id FROM embeddings") + """
SELECT unnest(kept) AS vec_id FROM g WHERE rn = (SELECT count(*) FROM embeddings)
""")
def q_dedup_greedy(spark, sf_dir):
    """Embeddings in vec_id order; a kept row removes later rows with cosine > 0.4."""
    kept = dedup.dedup_greedy(emb(spark, sf_dir), "vec_id", "embedding", 0.4, order="vec_id")
    return kept.select("vec_id")


D2_EDGES = """e AS (SELECT a.vec_id AS i, b.vec_id AS j FROM embeddings a JOIN embeddings b
                      ON a.vec_id <> b.vec_id AND (a.label < 3 OR a.vec_id < b.vec_id)
                    WHERE b.label >= 3 AND list_cosine_similarity(a.embedding, b.embedding) > 0.4)"""


@query("dedup_incremental", sql=greedy_sql(
    D2_EDGES, "SELECT vec_id AS id FROM embeddings WHERE label >= 3",
    seed_kept="(SELECT list(vec_id) FROM embeddings WHERE label < 3)") + """
SELECT vec_id, list_contains((SELECT kept FROM g WHERE rn = (SELECT count(*) FROM embeddings WHERE label >= 3)), vec_id)
       AS is_unique, false AS is_new
FROM embeddings WHERE label >= 3
""")
def q_dedup_incremental(spark, sf_dir):
    """Labels 0-2 are the kept (seen) rows, the rest arrive new and are checked in vec_id order."""
    e = emb(spark, sf_dir)
    seen, new = e.where(F.col("label") < 3), e.where(F.col("label") >= 3)
    out = dedup.dedup_incremental(seen, new, "vec_id", "embedding", 0.4, order="vec_id")
    return out.select("vec_id", "is_unique", "is_new")


JACCARD_CTE = r"""
s AS (SELECT doc_id, regexp_replace(lower(text), '[^\p{L}\p{N}_]+', '', 'g') AS t FROM documents),
tg AS (SELECT doc_id, CASE WHEN length(t) >= 3 THEN list_distinct(list_transform(range(1, length(t) - 1),
        lambda i: substr(t, i, 3))) ELSE []::VARCHAR[] END AS gs FROM s),
p AS (SELECT a.doc_id AS i_key, b.doc_id AS j_key, len(list_intersect(a.gs, b.gs)) AS inter,
             len(a.gs) AS na, len(b.gs) AS nb
      FROM tg a JOIN tg b ON a.doc_id < b.doc_id
      WHERE len(a.gs) > 0 AND len(b.gs) >= 0.9 * len(a.gs) AND len(a.gs) >= 0.9 * len(b.gs))"""
JACCARD_SQL = "WITH" + JACCARD_CTE + """
SELECT i_key, j_key, round(inter / (na + nb - inter), 5) AS sim FROM p WHERE inter / (na + nb - inter) >= 0.9
"""


# ------------------------------------------------------------------ J6 / D3 Jaccard
@query("jaccard_pairs_exact", sql=JACCARD_SQL)
def q_jaccard_pairs_exact(spark, sf_dir):
    """J6 exact: whole-text trigram-set Jaccard >= 0.9 by prefix filtering."""
    p = minhash.jaccard_pairs_exact(scan_table(spark, sf_dir, "documents"), "doc_id", "text", 0.9)
    return p.select("i_key", "j_key", F.round("sim", 5).alias("sim"))


@query("jaccard_pairs_minhash", sql=JACCARD_SQL)
def q_jaccard_pairs_minhash(spark, sf_dir):
    """MinHash (128) banding 16 x 8, true Jaccard >= 0.9, whole texts."""
    p = minhash.jaccard_pairs(scan_table(spark, sf_dir, "documents"), "doc_id", "text", 0.9)
    return p.select("i_key", "j_key", F.round("sim", 5).alias("sim"))


@query("dedup_minhash", sql=greedy_sql(JACCARD_CTE.strip() + """,
e AS (SELECT i_key AS i, j_key AS j FROM p WHERE inter / (na + nb - inter) >= 0.9)""", "SELECT doc_id AS id FROM documents") + """
SELECT d.doc_id, d.source FROM documents d
WHERE list_contains((SELECT kept FROM g WHERE rn = (SELECT count(*) FROM documents)), d.doc_id)
""")
def q_dedup_minhash(spark, sf_dir):
    """D3: greedy in doc_id order over verified MinHash edges (Jaccard >= 0.9); kept documents."""
    d = scan_table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return dedup.dedup_minhash(d, "doc_id", "text", 0.9).select("doc_id", "source")


FLAGSHIP_EDGES = f"""{WORDS_SQL.strip()}, {MEAN_SQL.strip()},
e AS (SELECT a.doc_id AS i, b.doc_id AS j FROM vecs a JOIN vecs b ON a.doc_id < b.doc_id
      WHERE list_sum(list_transform(a.mean_vec, lambda x: x * x)) > 0
        AND list_sum(list_transform(b.mean_vec, lambda x: x * x)) > 0
        AND list_cosine_similarity(a.mean_vec, b.mean_vec) > 0.9)"""


@query("flagship_dedup_by_source", sql=greedy_sql(FLAGSHIP_EDGES, "SELECT doc_id AS id FROM documents") + """
SELECT d.source, count(*) AS count FROM documents d
WHERE list_contains((SELECT kept FROM g WHERE rn = (SELECT count(*) FROM documents)), d.doc_id)
GROUP BY d.source
""")
def q_flagship(spark, sf_dir):
    """Flagship: mean vectors of whole texts -> greedy dedup (cosine > 0.9, doc_id order) -> kept per source."""
    v = store(doc_vectors(spark, sf_dir).select("doc_id", "source", "mean_vec"), "document-vectors")  # the dedup carries whole rows
    kept = dedup.dedup_greedy(v, "doc_id", "mean_vec", 0.9, order="doc_id")
    return report.value_counts(kept, "source")
