"""Vocabulary parameters. The default English stop list is MLlib's own (shipped in the Spark jars)."""

from __future__ import annotations

import functools
import glob
import os
import zipfile


@functools.lru_cache(maxsize=None)
def english_stop_words() -> tuple[str, ...]:
    """MLlib's default English stop words (``StopWordsRemover.loadDefaultStopWords('english')``)."""
    import pyspark
    jars = glob.glob(os.path.join(os.path.dirname(pyspark.__file__), "jars", "spark-mllib_*.jar"))
    for j in jars:
        with zipfile.ZipFile(j) as z:
            name = "org/apache/spark/ml/feature/stopwords/english.txt"
            if name in z.namelist():
                return tuple(z.read(name).decode("utf-8").split())
    from pyspark.ml.feature import StopWordsRemover  # needs an active session
    return tuple(StopWordsRemover.loadDefaultStopWords("english"))
