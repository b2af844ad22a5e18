"""Batch model scoring with injected models.

Models (LLMs, encoders, zero-shot classifiers) are user-supplied Python
callables applied per Arrow batch with ``mapInPandas``; a failing row becomes
data (``Error occurred`` + the error text), never a failed job. Prompts are
built with Column expressions, parsing of answers reuses the text functions,
and the write-back is a keyed update (K3).

Generators have no default: the caller brings one. The default encoder hashes character trigrams.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.clustering import LDA
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as St

from tidewater.functions import text as T
from tidewater.llm.util import store
from tidewater.operators import clustering, discovery, filters, joins, report, topics, upsert
from tidewater.operators.ranking import top_n_per_group
from tidewater.operators.similarity import nearest
from tidewater.session import cut_lineage

ERROR_TEXT = "Error occurred"


# ----------------------------------------------------------------------------- models
def hashed_trigram_encoder(dim: int = 64) -> Callable[[Sequence[str]], np.ndarray]:
    """Default encoder: character-trigram counts hashed into ``dim`` buckets, L2-normalised; under three characters a zero vector."""
    factor = np.uint64(0x9E3779B97F4A7C15)

    def enc(texts: Sequence[str]) -> np.ndarray:
        out = np.zeros((len(texts), dim))
        for r, t in enumerate(texts):
            c = np.frombuffer((t or "").lower().encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
            if len(c) > 2:
                h = (c[:-2] << np.uint64(42) | c[1:-1] << np.uint64(21) | c[2:]) * factor  # a trigram is 63 bits; products wrap
                out[r] = np.bincount((h >> np.uint64(32)).astype(np.int64) % dim, minlength=dim)
        n = np.linalg.norm(out, axis=1, keepdims=True)
        return np.divide(out, n, out=np.zeros_like(out), where=n > 0)
    return enc


# ----------------------------------------------------------------------------- M1 / M12 / U3
def encode(df: DataFrame, text: str, fn: Callable[[Sequence[str]], np.ndarray] | None = None, out: str = "embedding", batch_size: int = 32,
           load: Callable[[], Callable[[Sequence[str]], np.ndarray]] | None = None) -> DataFrame:
    """M1: texts -> vectors, ``batch_size`` texts a call. The encoder is ``fn`` or what ``load`` returns, called once a task.

    A null text is encoded as an empty one. A call's rows go on at once, so a task holds few vectors and copies of texts.
    """
    load = load or (lambda: fn or hashed_trigram_encoder())
    cols = df.columns
    schema = St.StructType(list(df.schema.fields) + [St.StructField(out, St.ArrayType(St.DoubleType()))])

    def run(it):
        model = load()
        for batch in it:
            for s in range(0, batch.num_rows, batch_size):
                part = batch.slice(s, batch_size)
                vecs = np.asarray(model([t or "" for t in part.column(text).to_pylist()]), dtype=np.float64)
                flat, ends = pa.array(vecs.ravel()), pa.array(np.arange(len(vecs) + 1, dtype=np.int32) * vecs.shape[1])
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in cols), pa.ListArray.from_arrays(ends, flat)], [*cols, out])

    return df.mapInArrow(run, schema)


def infer_batches(df: DataFrame, prompt: str, load: Callable[[], Callable[[list[str]], Sequence[str]]], out: str = "response",
                  batch_size: int = 32) -> DataFrame:
    """Prompts -> answers, ``batch_size`` prompts a call; ``load`` builds the model once a task.

    Where a call fails or answers another number of texts, its prompts are asked one by one, so only the row at
    fault gets 'Error occurred' and the error text. A model that can't be loaded fails the task.
    """
    cols = df.columns
    schema = St.StructType(list(df.schema.fields) + [St.StructField(out, St.StringType()), St.StructField(f"{out}_error", St.StringType())])

    def ask(model, prompts):
        try:
            got = list(model(prompts))
            if len(got) != len(prompts):
                raise ValueError(f"{len(got)} answers to {len(prompts)} prompts")
            return [(str(g), None) for g in got]
        except Exception as e:  # noqa: BLE001 - a row's error is data
            if len(prompts) == 1:
                return [(ERROR_TEXT, f"{type(e).__name__}: {e}")]
            return [a for p in prompts for a in ask(model, [p])]

    def run(it):
        model = load()
        for pdf in it:
            prompts = pdf[prompt].tolist()
            answers = [a for s in range(0, len(prompts), batch_size) for a in ask(model, prompts[s:s + batch_size])]
            yield pdf[cols].assign(**{out: [a for a, _ in answers], f"{out}_error": [e for _, e in answers]})

    return df.mapInPandas(run, schema)


def infer_batch(df: DataFrame, prompt: str, fn: Callable[[str], str], out: str = "response") -> DataFrame:
    """M12 with a model of one prompt: on exception the row gets 'Error occurred' and the error text."""
    return infer_batches(df, prompt, lambda: lambda prompts: [fn(p) for p in prompts], out, batch_size=1)


# ----------------------------------------------------------------------------- T18 prompts
def catalogue_string(categories: DataFrame) -> DataFrame:
    """A7 over the catalogue: one row with the bullet text."""
    return report.catalogue_text(categories, "category", "description")


def catalogue_literal(categories: DataFrame) -> Column:
    """The catalogue text as a scalar for every prompt (read once, not once per row).

    The catalogue is the small category dimension (seed + discovered rows).
    """
    row = catalogue_string(categories).first()
    return F.lit(row["catalogue"] if row else "")


def category_prompt(article: Column, catalogue: Column, new: bool = False) -> Column:
    """Classification prompt; ``new`` asks for a fresh category for many articles."""
    if new:
        head, body = "Texts of one group:\n", F.concat(F.lit("- "), F.array_join(article, "\n- "))
        task = "\n\nCategories in use, each with its meaning:\n"
        tail = ("\nFind a category that isn't in use and fits the whole group. Answer in one line, 'name: meaning'; "
                "the name is short and does without the word 'maritime'.")
    else:
        head, body = "Text:\n", article
        task = "\n\nRisk categories, each with its meaning:\n"
        tail = "\nAnswer with the name of the one category that fits best."
    return F.concat(F.lit(head), body, F.lit(task), catalogue, F.lit(tail))


def summary_prompt(headline: Column, description: Column) -> Column:
    """Extraction prompt (event in 30 words, port, date, in a fixed 'Key: value' format)."""
    return F.concat(F.lit("Extract from the article the disruption event (30 words or less), the affected "
                          "port and the date, using exactly:\nDisruption event:\nPort Affected:\nDate:\n\n"
                          "Headline: '"), headline, F.lit("'\nContent: '"), description, F.lit("'"))


def severity_prompt(headline: Column, description: Column, main_risk: Column, port: Column) -> Column:
    """Generative severity prompt; the model answers one number 1-5."""
    return F.concat(F.lit("How severe is this incident, from 1 (least) to 5 (most)? Answer with the digit alone.\nTitle: "),
                    headline, F.lit("\nText: "), description, F.lit("\nRisk: "), main_risk, F.lit("\nPort: "), port,
                    F.lit("\nSeverity:"))


# ----------------------------------------------------------------------------- M14 / M11 / M10
def summarise(df: DataFrame, fn: Callable[[str], str]) -> DataFrame:
    """Prompt -> model -> 'Key: value' answer -> summary / port / date."""
    p = df.withColumn("_prompt", summary_prompt(F.col("headline"), F.col("description")))
    r = infer_batch(p, "_prompt", fn).withColumn("_kv", T.key_value_entries(F.col("response")))
    r = r.withColumn("_m", T.last_wins_map("_kv"))
    return r.select(*df.columns, *T.project_extraction(F.col("_m")), "response_error")


def classify_category(df: DataFrame, catalogue: DataFrame, fn: Callable[[str], str], key: str = "_id",
                      text: str = "summary") -> DataFrame:
    """Pending rows (F7) -> prompt with the catalogue -> model -> T16 -> set main_risk and final_risk (K3)."""
    pending = filters.pending_category(df)
    p = pending.withColumn("_prompt", category_prompt(F.col(text), catalogue_literal(catalogue)))
    r = infer_batch(p, "_prompt", fn).withColumn("main_risk", T.normalise_category(F.col("response")))
    updates = r.select(key, "main_risk", F.col("main_risk").alias("final_risk"))
    return upsert.update_fields_by_key(df, updates, key)


def word_overlap_score(text: Column, label: Column) -> Column:
    """Default zero-shot scorer: share of the label's distinct words found in the text."""
    lw = F.array_distinct(F.regexp_extract_all(F.lower(label), F.lit(r"\p{L}+"), 0))
    tw = F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}+"), 0))
    return F.size(F.array_intersect(tw, lw)) / F.size(lw)


def classify_severity(df: DataFrame, key: str = "_id", model: str = "zero-shot",
                      scorer=word_overlap_score, fn: Callable[[str], str] | None = None) -> DataFrame:
    """Unique articles -> (severity_level, severity_label, confidence).

    zero-shot: T19 input text scored against the five labels (J9), level by T20;
    generative: T18 prompt -> ``fn`` -> integer (confidence null). Another model, or no ``fn`` there -> ValueError.
    """
    u = df.where(F.coalesce(F.col("is_unique"), F.lit(False))) if "is_unique" in df.columns else df
    if model == "zero-shot":
        x = u.withColumn("_txt", T.severity_text("headline", "main_risk", "description"))
        best = joins.label_scores(x, T.SEVERITY_LABELS, scorer, key, "_txt")
        return best.select(key, T.severity_level(F.col("best_label")).alias("severity_level"),
                           F.col("best_label").alias("severity_label"), F.col("score").alias("confidence"))
    if model in ("gemini", "generative"):
        if fn is None:
            raise ValueError("the generative model needs fn")
        port = F.coalesce(F.col("extracted_affected_port"), F.lit("")) if "extracted_affected_port" in u.columns \
            else F.lit("")
        p = u.withColumn("_prompt", severity_prompt(F.col("headline"), F.col("description"),
                                                    F.col("main_risk"), port))
        r = infer_batch(p, "_prompt", fn)
        lvl = T.parse_level(F.col("response"))
        return r.select(key, lvl.alias("severity_level"), T.py_strip(F.col("response")).alias("severity_label"),
                        F.lit(None).cast("double").alias("confidence"))
    raise ValueError(f"unknown severity model {model!r}")


def write_severity(df: DataFrame, key: str = "_id", **model) -> DataFrame:
    """M10 with its write-back (K3): the rows of ``df`` with severity_level, severity_label and confidence.

    Rows that aren't unique keep their values, or null where the fields are new. Keys are unique; a row without a key isn't scored.
    """
    return upsert.update_fields_by_key(df, classify_severity(df.where(F.col(key).isNotNull()), key, **model), key)


# ----------------------------------------------------------------------------- M13
def prompt_grid(df: DataFrame, text_cols: dict[str, str], prompts: dict[str, str],
                models: dict[str, Callable[[str], str]]) -> DataFrame:
    """The same classification over model x text variant x prompt style, one inference pass.

    Variants are a literal array exploded per row (no join); each row's model is
    looked up by name inside the task.
    """
    variants = [F.struct(F.lit(m).alias("model"), F.lit(t).alias("text_variant"), F.lit(p).alias("prompt_style"),
                         F.concat(F.lit(prompts[p]), F.col(c)).alias("prompt"))
                for m in models for t, c in text_cols.items() for p in prompts]
    grid = df.select("*", F.explode(F.array(*variants)).alias("_v")).select("*", "_v.*").drop("_v")

    def dispatch(prompt: str) -> str:
        name, _, body = prompt.partition("\x00")
        return models[name](body)

    g = grid.withColumn("_p", F.concat(F.col("model"), F.lit("\x00"), F.col("prompt")))
    return infer_batch(g, "_p", dispatch).drop("_p")


# ----------------------------------------------------------------------------- A11 / M15
#: Phrases that bound a document's n-th best score, in multiples of n: the most frequent, and the first 2-word ones by the alphabet.
MOST_FREQUENT, FIRST_PAIRS = 2, 3


def _phrase_counts(words: list) -> Counter:
    counts = Counter(words)
    counts.update([f"{a} {b}" for a, b in zip(words, words[1:])])  # a word has no blank, so none is a pair
    return counts


def _lists(batch: pa.RecordBatch, rows: int = 512):
    """(row, words) of each row of a batch; a word is made once per ``rows`` rows, not once per occurrence."""
    for s in range(0, batch.num_rows, rows):
        words = batch.column("words").slice(s, rows)
        flat = words.flatten().dictionary_encode()
        found = np.array(flat.dictionary.to_pylist(), dtype=object)[flat.indices.to_numpy()].tolist()
        end = 0
        for i, n in enumerate(pc.list_value_length(words).fill_null(0).to_pylist(), s):
            yield i, found[end:end + n]
            end += n


def _emitted(docs: DataFrame, choose: Callable, *given: str) -> DataFrame:
    """(key, phrase, tf) of the 1- and 2-word phrases that ``choose(counts, *given values)`` takes of each row (key, words, given)."""
    kind = docs.schema["key"].dataType

    def emit(batches):
        for batch in batches:
            at, phrases, counts = [], [], []
            rows = lambda: pa.RecordBatch.from_arrays([batch.column("key").take(pa.array(at, pa.int64())), pa.array(phrases, pa.string()), pa.array(counts, pa.int64())],
                                                      ["key", "phrase", "tf"])
            for i, words in _lists(batch):
                chosen = list(choose(_phrase_counts(words), *(batch.column(c)[i].as_py() for c in given)))
                at.extend([i] * len(chosen))
                phrases.extend([phrase for phrase, _ in chosen])
                counts.extend([tf for _, tf in chosen])
                if len(at) > 20_000:
                    yield rows()
                    at, phrases, counts = [], [], []
            yield rows()

    return docs.select("key", "words", *given).mapInArrow(emit, St.StructType([St.StructField("key", kind), St.StructField("phrase", St.StringType()), St.StructField("tf", St.LongType())]))


def _not_beaten(n_docs: int) -> Callable:
    """Of a document's phrases those that may be better than its bound, the n-th best of some of its phrases: at best a phrase is in no other document."""
    best = math.log((n_docs + 1) / 2)

    def choose(counts, score, tf, df, phrase):
        if score is None:
            return counts.items()
        # a phrase as frequent as the bound, itself in no other document, has the same score at best: the alphabet decides
        return [(p, c) for p, c in counts.items() if c * best >= score - 1e-9 * (1 + score) and not (df == 1 and c == tf and p > phrase)]
    return choose


def candidate_phrases(docs: DataFrame, dfreq: DataFrame, n_docs: int, n: int) -> DataFrame:
    """(key, phrase, tf) of rows (key, words), keys unique: all phrases that may be among a document's n best.

    Some phrases are scored first; what can't reach the n-th best of them goes.
    """
    def some(counts):
        return dict(heapq.nsmallest(MOST_FREQUENT * n, counts.items(), key=lambda x: (-x[1], x[0]))
                    + heapq.nsmallest(FIRST_PAIRS * n, (x for x in counts.items() if " " in x[0]))).items()

    first = _emitted(docs, some)
    nth = top_n_per_group(_scored(first, dfreq, n_docs), ["key"], [F.col("score").desc(), F.col("phrase")], n).where(F.col("rank") == n)
    bound = nth.select(F.col("key").alias("_k"), "score", F.col("tf").alias("bound_tf"), F.col("df").alias("bound_df"), F.col("phrase").alias("bound"))
    return _emitted(docs.join(bound, F.col("key").eqNullSafe(F.col("_k")), "left"), _not_beaten(n_docs), "score", "bound_tf", "bound_df", "bound")


def _scored(tf: DataFrame, dfreq: DataFrame, n_docs: int) -> DataFrame:
    """With df and score; ``dfreq`` has the phrases of more than one document."""
    return tf.join(dfreq, "phrase", "left").withColumn("df", F.coalesce("df", F.lit(1).cast("long"))) \
        .withColumn("score", F.col("tf") * F.log((F.lit(n_docs) + 1) / (F.col("df") + 1)))


def top_phrases(df: DataFrame, key: str, text: str, n: int = 10, stop_words: Sequence[str] = ()) -> DataFrame:
    """Best n 1- and 2-word phrases per document by TF-IDF (idf = ln((N+1)/(df+1)), MLlib's form).

    Phrases are counted where a text is read. Document frequencies are a partial aggregation; only phrases that
    may be among a document's n best are joined to them. Rows that share a key are one document.
    """
    toks = df.select(F.col(key).alias("key"), F.lower(F.array_join(T.alpha_tokens(F.col(text)), " ")).alias("_t"))
    toks = toks.select("key", F.split(F.col("_t"), " ").alias("words")) \
        .withColumn("words", F.filter("words", lambda w: (w != "") & ~F.array_contains(
            F.array(*[F.lit(s) for s in stop_words]) if stop_words else F.array().cast("array<string>"), w)))
    keys = df.groupBy(F.col(key).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    n_docs, n_shared = keys.agg(F.count(F.lit(1)), F.count_if(F.col("_n") > 1)).first()
    shared = keys.where("_n > 1").select("_k")
    same = F.col("key").eqNullSafe(F.col("_k"))
    single = toks.join(shared, same, "left_anti") if n_shared else toks
    grams = toks.join(shared, same, "left_semi").select("key", F.explode(T.word_ngrams(F.col("words"), 2)).alias("phrase"))
    together = cut_lineage(grams.groupBy("key", "phrase").agg(F.count(F.lit(1)).alias("tf"))) if n_shared else None
    each = _emitted(single, lambda counts: counts.items()).select("phrase")
    if together is not None:
        each = each.unionByName(together.select("phrase"))
    dfreq = store(each.groupBy("phrase").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "phrases")
    tf = candidate_phrases(single, dfreq, n_docs, n)
    if together is not None:
        tf = tf.unionByName(together)
    ranked = top_n_per_group(_scored(tf, dfreq, n_docs), ["key"], [F.col("score").desc(), F.col("phrase")], n)
    return ranked.select(F.col("key").alias(key), "rank", "phrase", "score")


#: Weights of words in topics that may lie on the driver.
DRIVER_NUMBERS = 1 << 20


def lda_topics(df: DataFrame, text: str, k: int = 5, words: int = 10, seed: int = 42,
               max_iter: int = 20) -> DataFrame:
    """K topics x ``words`` top words over alphabetic tokens (CountVectorizer + MLlib LDA).

    MLlib keeps the vocabulary and the topics' weights on the driver; where these are many, the same steps are made without (``topics``).
    """
    toks = df.select(T.alpha_tokens(F.col(text)).alias("tokens"))
    n = toks.select(F.explode("tokens").alias("t")).agg(F.count_distinct("t")).first()[0]  # every word is in the vocabulary
    if n * k > DRIVER_NUMBERS:
        return topics.topic_words(toks, "tokens", k, words, seed, max_iter)
    cv = CountVectorizer(inputCol="tokens", outputCol="tf", vocabSize=max(1, n)).fit(toks)
    lda = LDA(k=k, seed=seed, maxIter=max_iter, featuresCol="tf").fit(cv.transform(toks))
    ranked = lda.describeTopics(words).select("topic", F.posexplode("termIndices").alias("rank", "term_index"))
    named = sorted({r.term_index for r in ranked.select("term_index").collect()})  # k x words at most
    terms = cv.vocabulary
    vocab = df.sparkSession.createDataFrame([(i, terms[i]) for i in named], "term_index long, term string")
    return ranked.join(F.broadcast(vocab), "term_index").select("topic", "rank", "term").orderBy("topic", "rank")


# ----------------------------------------------------------------------------- D4
def dedup_word2vec(df: DataFrame, key: str, text: str, threshold: float = 0.9, order: str | None = None, vector_size: int = 100,
                   window: int = 5, min_count: int = 1, seed: int = 42, against: str = "documents", partitions: int | None = None) -> DataFrame:
    """D4 re-aimed: one Word2Vec fit on the corpus in ``partitions`` shares (else the session's parallelism, more where the corpus
    is large), document = mean word vector.

    ``against`` documents: greedy dedup of the document vectors (D1). ``against`` words: a document goes if any word
    vector has a cosine > threshold to its own; the most frequent words are tried first. A text without a known word stays.
    Null texts are empty; each row is decided by itself.
    """
    from tidewater.operators import dedup
    from tidewater.operators.word_vectors import word_vectors
    if against not in ("documents", "words"):
        raise ValueError(f"against is documents or words, not {against!r}")
    rows = store(df.withColumn("_doc", F.monotonically_increasing_id()), "word2vec-rows")
    toks = rows.select("_doc", F.coalesce(T.tokenize(F.col(text)), F.array().cast("array<string>")).alias("_tokens"))
    words, means = word_vectors(toks, "_doc", "_tokens", vector_size, window, min_count, seed, partitions)
    # only the rows' places are decided, in the order of the rows: by order, key, place in the input
    places = rows.select("_doc", F.struct(F.col(order or key), F.col(key), "_doc").alias("_order"))
    vecs = places.join(means.select(F.col("doc").alias("_doc"), F.col("vector").alias("_vec")), "_doc")
    if against == "documents":
        flagged = dedup.dedup_greedy(vecs, "_doc", "_vec", threshold, order="_order", keep_flag=True)
    else:
        flagged = dedup.dedup_against(vecs, "_doc", "_vec", words, "vector", threshold, first=[F.col("n").desc(), F.col("word")], order="_order", keep_flag=True)
    return rows.join(flagged.where("not is_unique").select("_doc"), "_doc", "left_anti").drop("_doc")


# ----------------------------------------------------------------------------- M7 / M8 / M9
def generate_category(samples: DataFrame, catalogue: DataFrame, fn: Callable[[str], str], cluster: str = "cluster") -> DataFrame:
    """M8: per cluster, its sample texts -> new-category prompt -> model -> (category, description, error)."""
    p = samples.withColumn("_prompt", category_prompt(F.col("sample_texts"), catalogue_literal(catalogue),
                                                      new=True))
    r = infer_batch(p, "_prompt", fn)
    return r.select(cluster, "size", "sample_texts", *T.split_name_description(T.normalise_category("response")))


def discover_categories(df: DataFrame, key: str, text: str, catalogue: DataFrame,
                        k_range: Sequence[int] = range(2, 10), method: str = "silhouette",
                        samples_per_cluster: int = 20, minimum_samples: int = 500,
                        encoder=None, fn: Callable[[str], str] | None = None, order: str | None = None,
                        stop_words: Sequence[str] = ()):
    """M7: Others rows (F8) -> encode (M1) -> k sweep (M3) -> choose k (M6) -> clusters (M2, from the
    sweep, no refit) -> first texts per cluster (A8) -> names: by ``fn`` (M8), else by the words that set each cluster apart.

    Returns (categories frame, assignment frame (key, cluster)); ``discovery.apply_categories`` takes both on. Keys are unique.
    """
    others = filters.others_with_minimum(df, minimum_samples)
    extra = [order] if order and order != key else []
    enc = cut_lineage(encode(others.select(key, text, *extra), text, encoder, "embedding"))
    metrics, fits = clustering.k_sweep(enc, key, "embedding", k_range)
    k = clustering.chosen_k(metrics, method)
    assign = cut_lineage(fits[k][1].select(key, "cluster").join(enc.select(key, text, *extra), key))
    if fn:
        cats = generate_category(report.cluster_summary(assign, "cluster", text, order or key, samples_per_cluster), catalogue, fn)
    else:
        cats = discovery.named_clusters(assign, "cluster", text, order or key, samples_per_cluster, stop_words)
    return cats, assign.select(key, "cluster")


def analyze_new_incident(incidents: DataFrame, q_key: str, q_vec: str, corpus: DataFrame, c_key: str,
                         c_vec: str, category: str, k: int = 5) -> DataFrame:
    """M9: the k nearest known incidents per new incident and their majority category (ties: smallest)."""
    nn = nearest(incidents, q_key, q_vec, corpus, c_key, c_vec, k)
    lab = nn.join(corpus.select(F.col(c_key).alias("c_key"), F.col(category).alias("category")), "c_key")
    votes = lab.groupBy("q_key", "category").agg(F.count(F.lit(1)).alias("votes"))
    best = votes.groupBy("q_key").agg(F.min_by("category", F.struct(-F.col("votes"), F.col("category")))
                                      .alias("suggested_category"))
    return best
