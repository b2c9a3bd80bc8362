"""TF-IDF queries T1-T6 on the training split."""

from __future__ import annotations

from pyspark.sql import functions as F

from deskspark.config import DEFAULT
from deskspark.functions import stopwords
from deskspark.operators import tfidf as T
from deskspark.plans import register
from deskspark.plans.prepare_q import PREP, SPLIT, prepared_split

_STOP = stopwords.sql_list()


def tfidf_sql_ctes(stop: bool = True, ngram_max: int = DEFAULT.ngram_max, min_df: int = DEFAULT.min_df,
                   max_df: float = DEFAULT.max_df, max_features: int = DEFAULT.max_features,
                   with_label: bool = False) -> str:
    toks = r"regexp_extract_all(lower(document_clean), '\b\w\w+\b')"
    if stop:
        toks = f"list_filter({toks}, lambda t: NOT list_contains([{_STOP}], t))"
    lab = ", topic_group" if with_label else ""
    grams = ["SELECT doc_id{lab}, unnest(toks) AS term FROM tok".format(lab=lab)]
    for n in range(2, ngram_max + 1):
        parts = " || ' ' || ".join(f"toks[i + {j}]" for j in range(n))
        grams.append(f"SELECT doc_id{lab}, unnest(list_transform(range(1, len(toks) - {n - 2}), lambda i: {parts})) "
                     f"FROM tok")
    return f"""
tr AS (SELECT doc_id, topic_group, document_clean FROM sp WHERE split = 'train'),
tok AS (SELECT doc_id, topic_group, {toks} AS toks FROM tr),
ng AS ({" UNION ALL ".join(grams)}),
dt AS (SELECT doc_id{lab}, term, CAST(count(*) AS BIGINT) AS tf FROM ng GROUP BY ALL),
st AS (SELECT term, CAST(count(*) AS BIGINT) AS df, CAST(sum(tf) AS BIGINT) AS cf FROM dt GROUP BY term),
nd AS (SELECT count(*) AS n FROM tr),
vf AS (SELECT * FROM st WHERE df >= {min_df} AND df <= CAST({max_df} AS DOUBLE) * (SELECT n FROM nd)),
vocab AS (SELECT term, df, cf, ln((1 + (SELECT n FROM nd)) / (1 + df)) + 1 AS idf
          FROM (SELECT * FROM vf ORDER BY cf DESC, term LIMIT {max_features})),
wt AS (SELECT dt.*, dt.tf * vocab.idf AS w FROM dt JOIN vocab USING (term)),
tw AS (SELECT wt.* EXCLUDE (w), w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS tfidf FROM wt)"""


def train_docs(spark, sf_dir):
    return prepared_split(spark, sf_dir, reuse=True).filter(F.col("split") == "train")


@register("analyzer_terms", f"""
WITH {PREP}, {SPLIT}, {tfidf_sql_ctes()}
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_terms, CAST(count(DISTINCT term) AS BIGINT) AS n_distinct
FROM ng GROUP BY doc_id""")
def analyzer_terms(spark, sf_dir):
    """Analyzer output size per training document (unigrams + bigrams)."""
    a = T.analyze(train_docs(spark, sf_dir))
    a = a.filter(F.size("terms") > 0)
    return a.select("doc_id", F.size("terms").cast("long").alias("n_terms"),
                    F.size(F.array_distinct("terms")).cast("long").alias("n_distinct"))


@register("ngram_counts", f"""
WITH {PREP}, {SPLIT}, {tfidf_sql_ctes(ngram_max=3)}
SELECT CAST(len(string_split(term, ' ')) AS BIGINT) AS n, CAST(count(DISTINCT term) AS BIGINT) AS distinct_terms,
       CAST(count(*) AS BIGINT) AS occurrences FROM ng GROUP BY 1""")
def ngram_counts(spark, sf_dir):
    """The search space's widest n-gram range (1, 3)."""
    terms = T.term_stats(T.analyze(train_docs(spark, sf_dir), ngram_max=3))
    return terms.groupBy(F.size(F.split("term", " ")).cast("long").alias("n")).agg(
        F.count(F.lit(1)).alias("distinct_terms"), F.sum("cf").alias("occurrences"))


@register("tfidf_vocabulary", f"""
WITH {PREP}, {SPLIT}, {tfidf_sql_ctes()}
SELECT term, df, cf, round(idf, 6) AS idf FROM vocab""")
def tfidf_vocabulary(spark, sf_dir):
    """T3 (+ idf of T4)."""
    return T.fit(train_docs(spark, sf_dir)).select("term", "df", "cf", F.round("idf", 6).alias("idf"))


@register("tfidf_weights", f"""
WITH {PREP}, {SPLIT}, {tfidf_sql_ctes()}
SELECT doc_id, term, tf, round(tfidf, 6) AS tfidf FROM tw""")
def tfidf_weights(spark, sf_dir):
    """T4: unit-normalised TF-IDF of every (training document, term)."""
    docs = T.analyzed(train_docs(spark, sf_dir))
    w = T.transform(docs, T.fit(docs))
    return w.select("doc_id", "term", "tf", F.round("tfidf", 6).alias("tfidf"))


@register("feature_count", f"""
WITH {PREP}, {SPLIT}, {tfidf_sql_ctes()} SELECT CAST(count(*) AS BIGINT) AS n_features FROM vocab""")
def feature_count(spark, sf_dir):
    """T5."""
    return T.fit(train_docs(spark, sf_dir)).agg(F.count(F.lit(1)).alias("n_features"))


@register("top_terms_per_class", f"""
WITH {PREP}, {SPLIT}, {tfidf_sql_ctes(stop=False, with_label=True)},
nc AS (SELECT topic_group, count(*) AS nc FROM tr GROUP BY 1),
sc AS (SELECT topic_group, term, sum(tfidf) / nc AS score FROM tw JOIN nc USING (topic_group) GROUP BY topic_group, term, nc),
rt AS (SELECT *, row_number() OVER (PARTITION BY topic_group ORDER BY score DESC, term) AS rank FROM sc)
SELECT topic_group, CAST(rank AS BIGINT) AS rank, term, round(score, 6) AS score FROM rt WHERE rank <= 10""")
def top_terms_per_class(spark, sf_dir):
    """T6."""
    return T.top_terms_per_class(train_docs(spark, sf_dir))
