"""Profiling queries E1-E14."""

from __future__ import annotations

from pyspark.sql import functions as F

from deskspark.operators import profile as E
from deskspark.plans import register
from deskspark.plans.prepare_q import PREP, SPLIT, train_rows
from deskspark.plans.sqlparts import describe_sql, raw_len_sql, train_features_ctes, words_sql
from deskspark.sources.tables import tickets

RAW = "raw AS (SELECT doc_id, text AS document, lang AS topic_group FROM documents)"
TRAIN_FEATS = f"{PREP}, {SPLIT}, {train_features_ctes()}"


@register("dataset_profile", f"""
WITH {RAW}
SELECT CAST(count(*) AS BIGINT) AS total_samples, CAST(3 AS BIGINT) AS n_columns,
       CAST(sum((doc_id IS NULL)::INT + (document IS NULL)::INT + (topic_group IS NULL)::INT) AS BIGINT)
         AS missing_cells,
       CAST(count(DISTINCT topic_group) AS BIGINT) AS unique_categories,
       round(avg({raw_len_sql('document')}), 6) AS len_mean,
       round(quantile_cont({raw_len_sql('document')}, 0.5), 6) AS len_median,
       round(stddev_samp({raw_len_sql('document')}), 6) AS len_std,
       min({raw_len_sql('document')}) AS len_min, max({raw_len_sql('document')}) AS len_max FROM raw""")
def dataset_profile(spark, sf_dir):
    """E1."""
    return E.dataset_profile(tickets(spark, sf_dir))


@register("head_rows", f"""
WITH {RAW} SELECT doc_id, document, topic_group FROM raw ORDER BY doc_id LIMIT 5""")
def head_rows(spark, sf_dir):
    """The first five tickets."""
    return E.head(tickets(spark, sf_dir))


@register("missing_values", f"""
WITH {RAW}
SELECT 'doc_id' AS column_name, CAST(count(*) - count(doc_id) AS BIGINT) AS n_missing FROM raw
UNION ALL SELECT 'document', CAST(count(*) - count(document) AS BIGINT) FROM raw
UNION ALL SELECT 'topic_group', CAST(count(*) - count(topic_group) AS BIGINT) FROM raw""")
def missing_values(spark, sf_dir):
    """E3."""
    return E.missing_values(tickets(spark, sf_dir))


@register("distinct_categories", f"""
WITH {RAW} SELECT CAST(count(DISTINCT topic_group) AS BIGINT) AS unique_categories FROM raw""")
def distinct_categories(spark, sf_dir):
    """E4."""
    return E.distinct_categories(tickets(spark, sf_dir))


@register("category_counts", f"""
WITH {RAW} SELECT topic_group, CAST(count(*) AS BIGINT) AS n FROM raw
WHERE topic_group IS NOT NULL GROUP BY topic_group""")
def category_counts(spark, sf_dir):
    """E5 on the raw table."""
    return E.category_counts(tickets(spark, sf_dir))


@register("length_stats", f"""
WITH {RAW}
SELECT round(avg({raw_len_sql('document')}), 6) AS mean, round(quantile_cont({raw_len_sql('document')}, 0.5), 6) AS median,
       round(stddev_samp({raw_len_sql('document')}), 6) AS std,
       min({raw_len_sql('document')}) AS min, max({raw_len_sql('document')}) AS max FROM raw""")
def length_stats(spark, sf_dir):
    """E6."""
    return E.length_stats(tickets(spark, sf_dir))


_LONG = f"""
lv AS (SELECT 'chars' AS feature, CAST({raw_len_sql('document')} AS DOUBLE) AS v FROM raw
       UNION ALL SELECT 'words', CAST(coalesce(len({words_sql('document')}), 1) AS DOUBLE) FROM raw)"""


@register("describe_lengths", f"""
WITH {RAW}, {_LONG}
SELECT feature, {describe_sql('v')} FROM lv GROUP BY feature""")
def describe_lengths(spark, sf_dir):
    """E7."""
    return E.describe_lengths(tickets(spark, sf_dir))


@register("samples_per_category", f"""
WITH {RAW},
cats AS (SELECT topic_group, row_number() OVER (ORDER BY min(doc_id)) AS category_rank
         FROM raw GROUP BY topic_group),
rs AS (SELECT *, row_number() OVER (PARTITION BY topic_group ORDER BY doc_id) AS sample_rank FROM raw)
SELECT CAST(c.category_rank AS BIGINT) AS category_rank, rs.topic_group, CAST(rs.sample_rank AS BIGINT) AS sample_rank,
       rs.doc_id, substring(rs.document, 1, 100) AS snippet
FROM rs JOIN cats c USING (topic_group) WHERE c.category_rank <= 3 AND rs.sample_rank <= 2""")
def samples_per_category(spark, sf_dir):
    """E8."""
    return E.samples_per_category(tickets(spark, sf_dir))


@register("length_histogram", f"""
WITH {RAW},
lv AS (SELECT 'chars' AS feature, CAST({raw_len_sql('document')} AS DOUBLE) AS v FROM raw
       UNION ALL SELECT 'words', CAST(len({words_sql('document')}) AS DOUBLE) FROM raw),
rg AS (SELECT feature, min(v) AS lo, max(v) AS hi FROM lv GROUP BY feature),
bn AS (SELECT lv.feature, CAST(CASE WHEN hi = lo THEN 0 ELSE least(49, floor((v - lo) * 50 / (hi - lo))) END AS BIGINT) AS bin
       FROM lv JOIN rg USING (feature)),
ct AS (SELECT feature, bin, CAST(count(*) AS BIGINT) AS n FROM bn GROUP BY ALL),
gr AS (SELECT feature, lo, hi, CAST(unnest(range(0, 50)) AS BIGINT) AS bin FROM rg)
SELECT gr.feature, gr.bin, round(lo + gr.bin * (hi - lo) / 50, 6) AS bin_lo,
       round(lo + (gr.bin + 1) * (hi - lo) / 50, 6) AS bin_hi, coalesce(ct.n, 0) AS n
FROM gr LEFT JOIN ct ON gr.feature = ct.feature AND gr.bin = ct.bin""")
def length_histogram(spark, sf_dir):
    """E9."""
    return E.length_histogram(tickets(spark, sf_dir))


@register("mean_length_by_category", f"""
WITH {RAW} SELECT topic_group, round(avg(length(document)), 6) AS mean_chars FROM raw GROUP BY topic_group""")
def mean_length_by_category(spark, sf_dir):
    """E10."""
    return E.mean_length_by_category(tickets(spark, sf_dir))


@register("text_features", f"""
WITH {TRAIN_FEATS}
SELECT doc_id, word_count, char_count, round(avg_word_length, 6) AS avg_word_length, unique_words,
       round(unique_ratio, 6) AS unique_ratio FROM tf""")
def text_features(spark, sf_dir):
    """E11 on the training split."""
    f = E.text_features(train_rows(spark, sf_dir))
    return f.select("doc_id", "word_count", "char_count", E.r6(F.col("avg_word_length")).alias("avg_word_length"),
                    "unique_words", E.r6(F.col("unique_ratio")).alias("unique_ratio"))


@register("features_by_class", f"""
WITH {TRAIN_FEATS}
SELECT topic_group, feature, {describe_sql('v')} FROM tl GROUP BY topic_group, feature""")
def features_by_class(spark, sf_dir):
    """E12."""
    return E.features_by_class(E.text_features(train_rows(spark, sf_dir)))


@register("boxplot_stats", f"""
WITH {TRAIN_FEATS},
qs AS (SELECT topic_group, feature, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median,
              quantile_cont(v, 0.75) AS q3 FROM tl GROUP BY ALL),
fz AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lo_f, q3 + 1.5 * (q3 - q1) AS hi_f FROM qs)
SELECT fz.topic_group, fz.feature, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
       round(iqr, 6) AS iqr,
       round(min(CASE WHEN v >= lo_f AND v <= hi_f THEN v END), 6) AS whisker_lo,
       round(max(CASE WHEN v >= lo_f AND v <= hi_f THEN v END), 6) AS whisker_hi,
       CAST(count(*) FILTER (WHERE NOT (v >= lo_f AND v <= hi_f)) AS BIGINT) AS n_outliers
FROM tl JOIN fz ON tl.topic_group = fz.topic_group AND tl.feature = fz.feature
GROUP BY fz.topic_group, fz.feature, q1, median, q3, iqr""")
def boxplot_stats(spark, sf_dir):
    """E13."""
    return E.boxplot_stats(E.text_features(train_rows(spark, sf_dir)))


@register("class_weights", f"""
WITH {PREP}, {SPLIT},
c AS (SELECT topic_encoded, CAST(count(*) AS BIGINT) AS n FROM sp WHERE split = 'train' GROUP BY 1)
SELECT topic_encoded, n, round(sum(n) OVER () / (count(*) OVER () * n), 6) AS weight FROM c""")
def class_weights(spark, sf_dir):
    """E14 on the training split."""
    return E.class_weights(train_rows(spark, sf_dir))
