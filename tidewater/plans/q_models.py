"""Queries for clustering, k selection and model scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.functions import text as T
from tidewater.functions.vocab import english_stop_words
from tidewater.operators import clustering, dedup, discovery, scoring, similarity
from tidewater.plans.q_keys import _others_assignment
from tidewater.plans.q_text import s_list, s_strip
from tidewater.plans.q_vectors import CENTROIDS_SQL, EMB_EDGES, greedy_sql
from tidewater.plans.registry import query
from tidewater.plans.views import ARTICLES_SQL, articles
from tidewater.schemas import SEED_CATEGORIES
from tidewater.sources.tables import scan_table

K_RANGE = list(range(2, 10))


def emb(spark, sf_dir):
    return scan_table(spark, sf_dir, "embeddings")


# ------------------------------------------------------------------ M4 silhouette
SIL_SQL = """
WITH p AS (SELECT a.vec_id AS key, a.{c} AS ca, b.{c} AS cb,
                  sqrt(list_sum(list_transform(list_zip(a.embedding, b.embedding),
                       lambda q: (q[1] - q[2]) * (q[1] - q[2])))) AS d
           FROM {src} a JOIN {src} b ON a.vec_id <> b.vec_id {same_k}),
per AS (SELECT key, ca, cb, avg(d) AS m FROM p GROUP BY key, ca, cb),
s AS (SELECT key, max(CASE WHEN ca = cb THEN m END) AS a, min(CASE WHEN ca <> cb THEN m END) AS b FROM per GROUP BY key)
"""


@query("silhouette", sql=SIL_SQL.format(c="label", src="embeddings", same_k="") + """
SELECT round(avg(CASE WHEN a IS NULL OR b IS NULL THEN 0.0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette
FROM (SELECT e.vec_id AS key, s.a, s.b FROM embeddings e LEFT JOIN s ON s.key = e.vec_id)
""")
def q_silhouette(spark, sf_dir):
    """M4: mean Euclidean silhouette of the embeddings under their label as the assignment."""
    per = clustering.silhouette_per_row(emb(spark, sf_dir), "vec_id", "embedding", "label")
    return per.agg(F.round(F.avg("silhouette"), 6).alias("silhouette"))


# ------------------------------------------------------------------ M3 metrics under given assignments
def given_assignments(spark, sf_dir):
    """Each embedding for every k in 2..9 with cluster = label mod k (a fixed assignment rule)."""
    e = emb(spark, sf_dir)
    ks = F.array(*[F.lit(k).cast("long") for k in K_RANGE])
    return e.select("vec_id", "embedding", "label", F.explode(ks).alias("k")) \
        .withColumn("cluster", F.pmod("label", F.col("k")))


GIVEN_CTE = """
g AS (SELECT e.vec_id, e.embedding, k, e.label % k AS cluster FROM embeddings e, range(2, 10) t(k)),
dims AS (SELECT k, cluster, idx, sum(x) AS sx, sum(x * x) AS sxx, count(*) AS n FROM (
           SELECT k, cluster, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS idx FROM g)
         GROUP BY k, cluster, idx),
inert AS (SELECT k, sum(sxx) - sum(sx * sx / n) AS inertia FROM dims GROUP BY k),
pd AS (SELECT a.k, a.vec_id AS key, a.cluster AS ca, b.cluster AS cb,
              sqrt(list_sum(list_transform(list_zip(a.embedding, b.embedding),
                   lambda q: (q[1] - q[2]) * (q[1] - q[2])))) AS d
       FROM g a JOIN g b ON a.k = b.k AND a.vec_id <> b.vec_id WHERE a.k > 2),
per AS (SELECT k, key, ca, cb, avg(d) AS m FROM pd GROUP BY ALL),
s AS (SELECT k, key, max(CASE WHEN ca = cb THEN m END) AS a, min(CASE WHEN ca <> cb THEN m END) AS b
      FROM per GROUP BY k, key),
sil AS (SELECT k, avg(CASE WHEN a IS NULL OR b IS NULL THEN 0.0 ELSE (b - a) / greatest(a, b) END) AS silhouette
        FROM s GROUP BY k),
metrics AS (SELECT inert.k, inert.inertia, coalesce(sil.silhouette, 0.0) AS silhouette
            FROM inert LEFT JOIN sil ON inert.k = sil.k)
"""


def metrics_given(spark, sf_dir):
    """(k, inertia, silhouette) for k = 2..9 under cluster = label mod k; silhouette 0 at k = 2."""
    g = given_assignments(spark, sf_dir)
    inert = clustering.inertia_given(g, "embedding", "k", "cluster").groupBy("k").agg(F.sum("inertia").alias("inertia"))
    given = {k: F.pmod(F.col("label"), F.lit(k)) for k in K_RANGE if k > 2}
    per = clustering.silhouettes_per_row(emb(spark, sf_dir), "vec_id", "embedding", given, "k")
    sil = per.groupBy("k").agg(F.avg("silhouette").alias("silhouette"))
    return inert.join(sil, "k", "left").select("k", "inertia", F.coalesce("silhouette", F.lit(0.0)).alias("silhouette"))


@query("k_metrics", sql="WITH " + GIVEN_CTE + """
SELECT k, round(inertia, 3) AS inertia, round(silhouette, 6) AS silhouette FROM metrics
""")
def q_k_metrics(spark, sf_dir):
    """M3/M4 metrics (inertia, silhouette) for k = 2..9 under the assignment label mod k."""
    m = metrics_given(spark, sf_dir)
    return m.select("k", F.round("inertia", 3).alias("inertia"), F.round("silhouette", 6).alias("silhouette"))


KNEE_SQL = """
kd AS (SELECT k AS x, inertia AS y, row_number() OVER (ORDER BY k) - 1 AS i, count(*) OVER () AS n FROM metrics),
kn AS (SELECT *, (x - min(x) OVER ()) / (max(x) OVER () - min(x) OVER ()) AS xn,
              (y - min(y) OVER ()) / (max(y) OVER () - min(y) OVER ()) AS yn FROM kd),
ky AS (SELECT *, (max(yn) OVER () - yn) - xn AS yd FROM kn),
kx AS (SELECT *, coalesce(lag(yd) OVER (ORDER BY x), yd) AS pv, coalesce(lead(yd) OVER (ORDER BY x), yd) AS nx,
              lead(yd) OVER (ORDER BY x) AS next_yd FROM ky),
km AS (SELECT *, yd >= pv AND yd >= nx AS is_max, yd <= pv AND yd <= nx AS is_min FROM kx),
kr AS (SELECT *, max(CASE WHEN is_max THEN i END) OVER (ORDER BY x ROWS UNBOUNDED PRECEDING) AS last_max,
              max(CASE WHEN is_min THEN i END) OVER (ORDER BY x ROWS UNBOUNDED PRECEDING) AS last_min FROM km),
kt AS (SELECT i AS tmax_i, x AS knee_x, yd - 1.0 / (n - 1) AS tmx FROM km WHERE is_max),
kh AS (SELECT kr.i, kt.knee_x FROM kr JOIN kt ON kt.tmax_i = kr.last_max
       WHERE kr.xn < 1.0 AND kr.next_yd IS NOT NULL
         AND kr.next_yd < CASE WHEN coalesce(kr.last_min, -1) >= kr.last_max THEN 0.0 ELSE kt.tmx END),
knee AS (SELECT arg_min(knee_x, i) AS knee FROM kh)
"""


@query("knee", sql="WITH " + GIVEN_CTE + "," + KNEE_SQL + "SELECT knee FROM knee")
def q_knee(spark, sf_dir):
    """M5: Kneedle elbow of the inertia curve over k = 2..9."""
    return clustering.knee(metrics_given(spark, sf_dir))


@query("choose_k", sql="WITH " + GIVEN_CTE + "," + KNEE_SQL + """
, best AS (SELECT arg_min(k, (-silhouette, k)) AS best_silhouette_k FROM metrics)
SELECT CAST(knee AS BIGINT) AS elbow_k, CAST(best_silhouette_k AS BIGINT) AS best_silhouette_k,
       CAST(round_even((knee + best_silhouette_k) / 2.0, 0) AS BIGINT) AS optimal_k
FROM knee, best
""")
def q_choose_k(spark, sf_dir):
    """M6: elbow, best silhouette and their half-even mean ('both')."""
    return clustering.choose_k(metrics_given(spark, sf_dir), "both")


@query("kmeans_assign")
def q_kmeans_assign(spark, sf_dir):
    """M2: k-means (k = 10, seed 42) cluster of every embedding."""
    _, pred = clustering.kmeans(emb(spark, sf_dir), "embedding", 10, seed=42)
    return pred.select("vec_id", "cluster")


@query("k_sweep")
def q_k_sweep(spark, sf_dir):
    """M3: k-means inertia and estimated silhouette with its margin for k = 2..9 (silhouette 0 at k = 2)."""
    metrics, _ = clustering.k_sweep(emb(spark, sf_dir), "vec_id", "embedding", K_RANGE, seed=42)
    return metrics


# ------------------------------------------------------------------ scoring


@query("top_phrases", sql="""
WITH t AS (SELECT doc_id, list_filter(string_split(lower(array_to_string(regexp_extract_all(text, '\\p{L}+'), ' ')), ' '),
                                      lambda w: w <> '') AS w FROM documents),
g AS (SELECT doc_id, unnest(list_concat(w, CASE WHEN len(w) >= 2 THEN
        list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) ELSE []::VARCHAR[] END)) AS phrase FROM t),
tf AS (SELECT doc_id, phrase, count(*) AS tf FROM g GROUP BY ALL),
df AS (SELECT phrase, count(*) AS df FROM tf GROUP BY phrase),
sc AS (SELECT tf.doc_id, tf.phrase, tf.tf * ln(((SELECT count(DISTINCT doc_id) FROM documents) + 1) / (df.df + 1)) AS score
       FROM tf JOIN df USING (phrase))
SELECT doc_id, rank, phrase, round(score, 6) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, phrase) AS rank FROM sc) WHERE rank <= 10
""")
def q_top_phrases(spark, sf_dir):
    """Ten best 1-2 word phrases per document by TF-IDF."""
    d = scan_table(spark, sf_dir, "documents").select("doc_id", "text")
    p = scoring.top_phrases(d, "doc_id", "text", 10)
    return p.select("doc_id", F.col("rank").cast("long"), "phrase", F.round("score", 6).alias("score"))


def _sev_sql() -> str:
    labs = ", ".join("'" + x + "'" for x in T.SEVERITY_LABELS)
    h, m, d = (s_strip(f"coalesce({c}, '')") for c in ("headline", "main_risk", "description"))
    txt = f"concat_ws(' | ', {h}, {m}, substr({d}, 1, 200))"
    return f"""
WITH a AS (SELECT _id, {txt} AS txt FROM ({ARTICLES_SQL}) WHERE coalesce(is_unique, false)),
l AS (SELECT unnest([{labs}]) AS label, generate_subscripts([{labs}], 1) AS i),
s AS (SELECT a._id, l.i, l.label,
             len(list_intersect(list_distinct(regexp_extract_all(lower(a.txt), '\\p{{L}}+')),
                                list_distinct(regexp_extract_all(lower(l.label), '\\p{{L}}+'))))
             / len(list_distinct(regexp_extract_all(lower(l.label), '\\p{{L}}+'))) AS score
      FROM a, l)
SELECT _id, i AS severity_level, label AS severity_label, round(score, 6) AS confidence FROM (
  SELECT *, row_number() OVER (PARTITION BY _id ORDER BY score DESC, i) AS rn FROM s) WHERE rn = 1
"""


@query("classify_severity", sql=_sev_sql())
def q_classify_severity(spark, sf_dir):
    """M10 zero-shot (J9 + T19 + T20) with the word-overlap scorer over unique articles."""
    r = scoring.classify_severity(articles(spark, sf_dir), "_id", "zero-shot")
    return r.select("_id", F.col("severity_level").cast("long").alias("severity_level"), "severity_label",
                    F.round("confidence", 6).alias("confidence"))


@query("write_severity", sql=f"""
SELECT a._id, a.main_risk, s.severity_level, s.severity_label, s.confidence
FROM ({ARTICLES_SQL}) a LEFT JOIN ({_sev_sql()}) s ON s._id = a._id
""")
def q_write_severity(spark, sf_dir):
    """M10 + K3: severity, label and confidence written to every unique article, the others untouched."""
    r = scoring.write_severity(articles(spark, sf_dir), "_id", model="zero-shot")
    return r.select("_id", "main_risk", F.col("severity_level").cast("long").alias("severity_level"), "severity_label", F.round("confidence", 6).alias("confidence"))


@query("analyze_new_incident", sql=f"""
WITH {CENTROIDS_SQL},
d AS (SELECT c.label AS q_key, e.vec_id AS c_key, e.label AS category,
             list_sum(list_transform(list_zip(c.centroid, e.embedding), lambda p: (p[1] - p[2]) * (p[1] - p[2])))
             AS dist FROM c, embeddings e),
nn AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY q_key ORDER BY dist, c_key) AS rank FROM d)
       WHERE rank <= 5),
v AS (SELECT q_key, category, count(*) AS votes FROM nn GROUP BY ALL)
SELECT CAST(q_key AS BIGINT) AS q_key, arg_min(category, (-votes, category)) AS suggested_category
FROM v GROUP BY q_key
""")
def q_analyze_new_incident(spark, sf_dir):
    """M9: for each label centroid as a new incident, the majority label of its 5 nearest embeddings."""
    e = scan_table(spark, sf_dir, "embeddings")
    cent = similarity.centroids(e, "label", "embedding")
    return scoring.analyze_new_incident(cent, "label", "centroid", e, "vec_id", "embedding", "label", k=5)


def seed_catalogue(spark):
    from tidewater.operators.upsert import seed_categories
    return seed_categories(spark)


# ------------------------------------------------------------------ M7, K2, K4, A9 on given clusters
TERMS_SQL = f"""
a AS MATERIALIZED ({ARTICLES_SQL}),
asg AS (SELECT _id, CAST(substr(state, 4) AS INTEGER) % 5 AS cluster FROM a WHERE main_risk = 'Others'),
o AS MATERIALIZED (SELECT asg._id, asg.cluster, a.description FROM asg JOIN a USING (_id)),
hits AS (SELECT cluster, unnest(list_filter(list_transform(regexp_extract_all(description, '\\p{{L}}+'), lambda w: lower(w)),
                                            lambda w: length(w) >= 3 AND NOT list_contains({s_list(english_stop_words())}, w))) AS term FROM o),
tf AS MATERIALIZED (SELECT cluster, term, count(*) AS tf FROM hits GROUP BY ALL),
words AS (SELECT cluster, sum(tf) AS words FROM tf GROUP BY cluster),
f AS (SELECT term, sum(tf) AS f FROM tf GROUP BY term),
scored AS (SELECT tf.cluster, term, tf.tf / words.words * ln(1.0::DOUBLE + (SELECT sum(words) / count(*) FROM words) / f.f) AS score
           FROM tf JOIN f USING (term) JOIN words ON words.cluster = tf.cluster),
terms AS MATERIALIZED (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY score DESC, term) AS rank FROM scored) WHERE rank <= 5)
"""
NAMES_SQL = TERMS_SQL + """,
listed AS (SELECT cluster, list(term ORDER BY rank) AS t FROM terms GROUP BY cluster),
named AS (SELECT s.cluster, s.size,
                 coalesce(array_to_string(list_transform(t[1:3], lambda w: upper(w[1]) || w[2:]), ', '), 'Unnamed ' || CAST(s.cluster AS VARCHAR)) AS n,
                 coalesce('Reports on ' || array_to_string(t, ', ') || '.', 'Reports without words.') AS description
          FROM (SELECT cluster, count(*) AS size FROM o WHERE cluster IS NOT NULL GROUP BY cluster) s LEFT JOIN listed USING (cluster)),
cats AS MATERIALIZED (SELECT cluster, size, CASE WHEN k = 1 THEN n ELSE n || ' (' || CAST(k AS VARCHAR) || ')' END AS category, description
                      FROM (SELECT *, row_number() OVER (PARTITION BY n ORDER BY cluster) AS k FROM named))
"""


def _others(spark, sf_dir):
    """The articles, the given clusters of the 'Others' ones (source number mod 5), and these with their whole texts."""
    a = articles(spark, sf_dir).select("_id", "description", "main_risk", "state")
    asg = _others_assignment(a)
    return a, asg, asg.join(a.select("_id", "description"), "_id")


def _applied(spark, sf_dir):
    a, asg, rows = _others(spark, sf_dir)
    cats = discovery.named_clusters(rows, "cluster", "description", "_id", 20, english_stop_words())
    return discovery.apply_categories(a.select("_id", "main_risk"), asg, cats, seed_catalogue(spark))


@query("cluster_terms", sql="WITH " + TERMS_SQL + "SELECT cluster, rank, term, round(score, 9) AS score FROM terms")
def q_cluster_terms(spark, sf_dir):
    """M7: the five words that set each given cluster of 'Others' articles apart, over whole texts."""
    t = discovery.cluster_terms(_others(spark, sf_dir)[2], "cluster", "description", 5, english_stop_words())
    return t.select("cluster", F.col("rank").cast("long"), "term", F.round("score", 9).alias("score"))


@query("discovered_catalogue", sql="WITH " + NAMES_SQL + """
SELECT 'discovered-' || CAST(cluster AS VARCHAR) AS _id, category, description, 'discovered' AS origin FROM cats
UNION ALL """ + " UNION ALL ".join("SELECT '{}', '{}', '{}', 'seed'".format(i, c, d) for i, c, d in SEED_CATEGORIES))
def q_discovered_catalogue(spark, sf_dir):
    """M7 + K2: the named clusters appended to the seed catalogue."""
    return _applied(spark, sf_dir).catalogue


@query("discovered_update", sql="WITH " + NAMES_SQL + """
SELECT a._id, a.main_risk, coalesce(cats.category, a.main_risk) AS final_risk FROM a LEFT JOIN asg USING (_id) LEFT JOIN cats USING (cluster)
""")
def q_discovered_update(spark, sf_dir):
    """M7 + K5 + K4: every article's final risk, 'Others' ones named by their cluster's words."""
    return _applied(spark, sf_dir).table


@query("discovered_analysis", sql="WITH " + NAMES_SQL + """,
firsts AS (SELECT cluster, array_to_string(list(description ORDER BY rk), chr(10)) AS e FROM (
             SELECT cluster, description, row_number() OVER (PARTITION BY cluster ORDER BY _id) AS rk FROM o) WHERE rk <= 3 GROUP BY cluster)
SELECT category, size AS number_of_incidents, e AS example_incidents FROM cats JOIN firsts USING (cluster)
""")
def q_discovered_analysis(spark, sf_dir):
    """M7 + A9: the named clusters with their sizes and first three whole texts."""
    return _applied(spark, sf_dir).analysis


@query("discover_categories")
def q_discover_categories(spark, sf_dir):
    """M7: whole texts of the 'Others' articles encoded, k chosen by silhouette over 2..9, clusters named by the words that set them apart."""
    a = articles(spark, sf_dir).select("_id", F.col("description").alias("summary"), "main_risk") \
        .withColumn("_id", F.col("_id").cast("long"))
    cats, _ = scoring.discover_categories(a, "_id", "summary", seed_catalogue(spark), range(2, 10),
                                          "silhouette", minimum_samples=20, stop_words=english_stop_words())
    return cats.select("cluster", "size", "category", "description")


@query("lda_topics")
def q_lda_topics(spark, sf_dir):
    """5 topics x 10 words over all documents."""
    return scoring.lda_topics(scan_table(spark, sf_dir, "documents"), "text", k=5, words=10)


@query("encode")
def q_encode(spark, sf_dir):
    """M1: document texts encoded with the injected (default: hashed trigram) encoder."""
    d = scan_table(spark, sf_dir, "documents").select("doc_id", "text")
    return scoring.encode(d, "text").select("doc_id", "embedding")


@query("dedup_word2vec")
def q_dedup_word2vec(spark, sf_dir):
    """Word2Vec (100 dims, window 5) fitted on all documents; greedy dedup on document vectors."""
    d = scan_table(spark, sf_dir, "documents").select("doc_id", "text")
    return scoring.dedup_word2vec(d, "doc_id", "text", 0.9).select("doc_id")


@query("dedup_against_words", sql=f"""
WITH {CENTROIDS_SQL},
hit AS (SELECT DISTINCT e.vec_id FROM embeddings e, c
        WHERE list_sum(list_transform(list_zip(e.embedding, c.centroid), lambda p: p[1] * p[2]))
              / (sqrt(list_sum(list_transform(e.embedding, lambda x: x * x))) * sqrt(list_sum(list_transform(c.centroid, lambda x: x * x)))) > 0.3)
SELECT vec_id FROM embeddings ANTI JOIN hit USING (vec_id)
""")
def q_dedup_against_words(spark, sf_dir):
    """D4's search on given vectors: embeddings stay unless some label's centroid has a cosine above 0.3 to them."""
    e = emb(spark, sf_dir)
    cent = similarity.centroids(e, "label", "embedding")
    return dedup.dedup_against(e.select("vec_id", "embedding"), "vec_id", "embedding", cent, "centroid", 0.3).select("vec_id")




# ------------------------------------------------------------------ T18 render_prompt, D5 flag_deduplicated


def _seed_catalogue_text() -> str:
    return "\n".join(sorted(f"\t- {c}: {d}" for _, c, d in SEED_CATEGORIES))


@query("render_prompt", sql=f"""
SELECT _id, 'Text:' || chr(10) || description || chr(10) || chr(10) ||
       'Risk categories, each with its meaning:' || chr(10) ||
       '{_seed_catalogue_text().replace(chr(9), "' || chr(9) || '").replace(chr(10), "' || chr(10) || '")}' ||
       chr(10) || 'Answer with the name of the one category that fits best.' AS prompt
FROM ({ARTICLES_SQL}) WHERE main_risk = '' AND coalesce(is_unique, false)
""")
def q_render_prompt(spark, sf_dir):
    """Classification prompts with the whole text of every pending article, catalogue rendered as sorted bullets."""
    a = articles(spark, sf_dir)
    from tidewater.operators import filters as _f
    p = _f.pending_category(a).select(
        "_id", scoring.category_prompt(F.col("description"), scoring.catalogue_literal(seed_catalogue(spark)))
        .alias("prompt"))
    return p


@query("flag_deduplicated", sql=greedy_sql(EMB_EDGES, "SELECT vec_id AS id FROM embeddings") + """
SELECT vec_id, CASE WHEN list_contains((SELECT kept FROM g WHERE rn = (SELECT count(*) FROM embeddings)), vec_id)
                    THEN true END AS is_deduplicated
FROM embeddings
""")
def q_flag_deduplicated(spark, sf_dir):
    """Rows kept by the greedy dedup get is_deduplicated = true in the source table."""
    e = emb(spark, sf_dir)
    kept = dedup.dedup_greedy(e, "vec_id", "embedding", 0.4, order="vec_id")
    return dedup.flag_deduplicated(e.select("vec_id"), kept.select("vec_id"), key="vec_id")
