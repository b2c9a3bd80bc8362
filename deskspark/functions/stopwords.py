"""English stop-word list, read from the MLlib jar (no JVM needed).

The list is Spark's own default English list (``StopWordsRemover``), so the
Spark operators and the DuckDB oracle share exactly one list.
"""

from __future__ import annotations

import functools
import glob
import os
import zipfile

_RESOURCE = "org/apache/spark/ml/feature/stopwords/english.txt"


@functools.lru_cache(maxsize=None)
def english() -> tuple[str, ...]:
    import pyspark

    jars = glob.glob(os.path.join(os.path.dirname(pyspark.__file__), "jars", "spark-mllib_*.jar"))
    for jar in jars:
        with zipfile.ZipFile(jar) as z:
            if _RESOURCE in z.namelist():
                text = z.read(_RESOURCE).decode("utf-8")
                return tuple(w.strip() for w in text.splitlines() if w.strip())
    from pyspark.ml.feature import StopWordsRemover  # needs a running JVM

    return tuple(StopWordsRemover.loadDefaultStopWords("english"))


def sql_list() -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in english())
