"""Text operators that need a join or an explode (T5-T7 with a lexicon table)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions import text as T


def lemma_table(tokens: DataFrame, lexicon: DataFrame, tok: str = "tok") -> DataFrame:
    """(tok, lemma) for every distinct token whose lemma differs from the token.

    Works on the vocabulary, not on occurrences: each distinct token's candidate
    forms (the word and its suffix-rule stems) are joined to the lexicon and the
    shortest known lemma wins (earlier candidate on ties).
    """
    vocab = tokens.select(F.col(tok)).where(F.col(tok).isNotNull()).distinct()
    cand = vocab.select(tok, F.posexplode(T.lemma_candidates(F.col(tok))).alias("ci", "form")) \
        .where(F.col("form").isNotNull())
    lex = lexicon.select(F.col("surface").alias("form"), F.col("lemma"))
    hit = cand.join(lex, "form")
    best = hit.groupBy(tok).agg(F.min_by("lemma", F.struct(F.length("lemma"), F.col("ci"))).alias("lemma"))
    return best.where(F.col("lemma") != F.col(tok))


def lemmatize(df: DataFrame, key: str, tokens: str, lexicon: DataFrame, out: str = "lemmas") -> DataFrame:
    """T5 with a lexicon table (surface, lemma) of any size; unknown words stay unchanged.

    The lemma of a token depends on the token only, so it is computed once per
    distinct token (``lemma_table``). Only occurrences whose token changes are joined and gathered, as
    (position, lemma) per row; the row's own tokens fill the rest.
    """
    occ = df.select(key, F.posexplode(tokens).alias("pos", "tok"))
    hits = occ.join(lemma_table(occ.select("tok"), lexicon), "tok")
    changed = hits.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("pos", "lemma"))).alias("_changed"))
    joined = df.join(changed, key, "left")
    swapped = F.transform(F.col(tokens), lambda w, i: F.coalesce(F.try_element_at("_changed", i), w))
    return joined.withColumn(out, F.when(F.col("_changed").isNotNull(), swapped).otherwise(F.col(tokens))).drop("_changed")


def lexicon_from_words(words: DataFrame, col: str = "word") -> DataFrame:
    """A lemma lexicon where every listed word is its own lemma."""
    w = words.select(F.col(col).alias("surface")).where(F.col("surface").isNotNull()).distinct()
    return w.withColumn("lemma", F.col("surface"))


def preprocess_words(df: DataFrame, key: str, text: str, stop_words: Sequence[str],
                     lexicon: DataFrame | None, out: str) -> DataFrame:
    """Stop words dropped, then lemmatised, rejoined by one space; null passes through."""
    toks = df.withColumn("_toks", T.drop_stop_words(T.split_words(F.col(text)), stop_words))
    if lexicon is not None:
        toks = lemmatize(toks, key, "_toks", lexicon, out="_lem").drop("_toks") \
            .withColumnRenamed("_lem", "_toks")
    return toks.withColumn(out, F.when(F.col(text).isNotNull(), F.array_join("_toks", " "))).drop("_toks")


def preprocess_article(df: DataFrame, key: str, stop_words: Sequence[str], lexicon: DataFrame | None,
                       link: str = "link", description: str = "description",
                       headline: str = "headline") -> DataFrame:
    """Boilerplate trim + T6 on the description, T6 on the headline."""
    d = df.withColumn(description, T.trim_boilerplate(F.col(link), F.col(description)))
    d = preprocess_words(d, key, description, stop_words, lexicon, "_pd")
    d = preprocess_words(d, key, headline, stop_words, lexicon, "_ph")
    return d.withColumn(description, F.col("_pd")).withColumn(headline, F.col("_ph")).drop("_pd", "_ph")
