"""PII, language and routing queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from deskspark.config import DEFAULT
from deskspark.functions.text import word_count
from deskspark.operators import langid, pii
from deskspark.operators import routing as R
from deskspark.plans import register
from deskspark.plans.prepare_q import PREP, SPLIT, prepared_split
from deskspark.plans.sqlparts import nb_ctes, pii_scrub_ctes, words_sql
from deskspark.sources.tables import table, version

DOC_PII = pii_scrub_ctes("documents", "doc_id")


def _doc_pii(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.types(pii.scrub(pii.detect(docs)))


@register("pii_detection", f"""
WITH {DOC_PII}
SELECT doc_id, array_to_string(details, ' | ') AS pii_details, len(details) > 0 AS pii_detected,
       CAST(c0 + c1 + c2 + c3 + c4 + c5 + c6 AS BIGINT) AS n_occurrences FROM pd""")
def pii_detection(spark, sf_dir):
    """G1 over every document (whole texts)."""
    d = pii.detect(table(spark, sf_dir, "documents").select("doc_id", "text"))
    total = sum((F.col(f"_pii{i}") for i in range(1, 7)), F.col("_pii0"))
    return d.select("doc_id", F.array_join("pii_details", " | ").alias("pii_details"), "pii_detected",
                    total.alias("n_occurrences"))


@register("pii_scrub", f"WITH {DOC_PII} SELECT doc_id, scrubbed AS scrubbed_text FROM ps")
def pii_scrub(spark, sf_dir):
    """G2."""
    return _doc_pii(spark, sf_dir).select("doc_id", "scrubbed_text")


@register("has_pii", f"""
WITH {DOC_PII} SELECT doc_id, (c0 + c1 + c2 + c3 + c4 + c5 + c6) > 0 AS has_pii FROM pc""")
def has_pii(spark, sf_dir):
    """G3."""
    return pii.has_pii(table(spark, sf_dir, "documents")).select("doc_id", "has_pii")


@register("pii_types", f"""
WITH {DOC_PII}
SELECT doc_id, array_to_string(list_transform(details, lambda s: lower(regexp_extract(s, '\\[(\\w+)\\]:', 1))), ',')
       AS pii_types FROM pd WHERE len(details) > 0""")
def pii_types(spark, sf_dir):
    """One lower-case type per hit pattern."""
    d = _doc_pii(spark, sf_dir).filter(F.size("pii_details") > 0)
    return d.select("doc_id", F.array_join("pii_types", ",").alias("pii_types"))


_FITTED: dict = {}


def fitted_langid(spark, sf_dir):
    """G5 model, trained on the training split of the prepared tickets;
    fitted once per session and data folder and shared by the queries
    that score with it (as one loaded model serves every request)."""
    key = version(spark, sf_dir)
    if key not in _FITTED:
        train = prepared_split(spark, sf_dir, reuse=True).filter(F.col("split") == "train")
        _FITTED[key] = langid.fit(train, text="document", label="topic_group")
    return _FITTED[key]


TRAIN_SRC = "(SELECT topic_group AS label, document AS text FROM sp WHERE split = 'train')"
TEST_SRC = "(SELECT doc_id, document AS text FROM sp WHERE split = 'test')"


@register("language_detection", f"""
WITH {PREP}, {SPLIT}, {nb_ctes(TRAIN_SRC, TEST_SRC, "doc_id")}
SELECT doc_id, language FROM nbp""")
def language_detection(spark, sf_dir):
    """Detected language of every test-split ticket."""
    test = prepared_split(spark, sf_dir).filter(F.col("split") == "test")
    return langid.predict(fitted_langid(spark, sf_dir), test, "document").select("doc_id", "language")


def requests(spark, sf_dir):
    """User turns of ``conversations`` act as agent requests."""
    return table(spark, sf_dir, "conversations").filter(F.col("role") == "user").select("conv_id", "turn", "text")


@register("word_count_rule", f"""
SELECT conv_id, turn, CAST(len({words_sql('text')}) AS BIGINT) AS word_count,
       len({words_sql('text')}) > {DEFAULT.route_max_words} AS over_limit
FROM conversations WHERE role = 'user'""")
def word_count_rule(spark, sf_dir):
    """G6."""
    r = requests(spark, sf_dir).withColumn("word_count", word_count(F.col("text")))
    return r.select("conv_id", "turn", "word_count", (F.col("word_count") > DEFAULT.route_max_words).alias("over_limit"))


REQ_PII = pii_scrub_ctes("(SELECT * FROM conversations WHERE role = 'user')", "conv_id, turn")
ROUTE_CTES = f"""{PREP}, {SPLIT}, {REQ_PII},
{nb_ctes(TRAIN_SRC, "(SELECT conv_id, turn, scrubbed AS text FROM ps)", "conv_id, turn")},
rt AS (SELECT ps.conv_id, ps.turn, ps.text, ps.scrubbed, nbp.language,
              CAST(len({words_sql('ps.scrubbed')}) AS BIGINT) AS word_count,
              {DEFAULT.complexity_fallback} AS complexity
       FROM ps JOIN nbp ON ps.conv_id = nbp.conv_id AND ps.turn = nbp.turn),
rm AS (SELECT *, CASE WHEN language <> 'en' THEN 'distilbert'
                      WHEN word_count > {DEFAULT.route_max_words} THEN 'distilbert'
                      WHEN complexity > {DEFAULT.complexity_threshold} THEN 'distilbert'
                      ELSE 'tfidf' END AS model_used FROM rt)"""


def routed(spark, sf_dir):
    return R.route(requests(spark, sf_dir), fitted_langid(spark, sf_dir))


@register("route_choice", f"""
WITH {ROUTE_CTES}
SELECT conv_id, turn, language, word_count, complexity, model_used, language || '_routing' AS reason,
       CASE WHEN model_used = 'tfidf' THEN '{DEFAULT.tfidf_url}' ELSE '{DEFAULT.transformer_url}' END || '/predict'
         AS url FROM rm""")
def route_choice(spark, sf_dir):
    """G7 + G8 (fallback complexity) + G9 explanation."""
    r = routed(spark, sf_dir)
    return r.select("conv_id", "turn", "language", "word_count", "complexity", "model_used", "reason",
                    F.col("routing_explanation.url").alias("url"))


@register("downstream_rejection", f"""
WITH {ROUTE_CTES}
SELECT conv_id, turn, model_used,
       CAST(CASE WHEN NOT (text IS NOT NULL AND length(text) BETWEEN {DEFAULT.request_min_chars}
                           AND {DEFAULT.request_max_chars}
                           AND trim(regexp_replace(text, '^\\s+|\\s+$', '', 'g')) <> '') THEN 422
                 WHEN NOT (length(scrubbed) >= {DEFAULT.request_min_chars}
                           AND length(scrubbed) <= CASE WHEN model_used = 'distilbert'
                                                        THEN {DEFAULT.transformer_max_chars}
                                                        ELSE {DEFAULT.request_max_chars} END
                           AND regexp_replace(scrubbed, '^\\s+|\\s+$', '', 'g') <> '') THEN 500
                 ELSE 200 END AS INTEGER) AS status
FROM rm""")
def downstream_rejection(spark, sf_dir):
    """Status code per request."""
    return routed(spark, sf_dir).select("conv_id", "turn", "model_used", "status")
