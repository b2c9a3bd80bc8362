"""Evaluation queries V1-V7 on the trigram model's predictions."""

from __future__ import annotations

from pyspark.sql import functions as F

from deskspark.operators import evaluate as V
from deskspark.operators import langid
from deskspark.operators.common import materialize
from deskspark.plans import register
from deskspark.plans.prepare_q import PREP, SPLIT, prepared_split
from deskspark.plans.request_q import TRAIN_SRC, fitted_langid
from deskspark.plans.sqlparts import nb_ctes
from deskspark.sources.tables import version

#: Confusion cells ``cf`` and per-class measures ``pcf`` of test predictions ``te``(doc_id, y, p).
CLASS_CTES = """
cls AS (SELECT DISTINCT c FROM (SELECT y AS c FROM te UNION ALL SELECT p FROM te)),
cf AS (SELECT a.c AS actual, b.c AS predicted, CAST(count(te.doc_id) AS BIGINT) AS n
       FROM cls a CROSS JOIN cls b LEFT JOIN te ON te.y = a.c AND te.p = b.c GROUP BY ALL),
pcl AS (SELECT actual AS class, sum(n) FILTER (WHERE actual = predicted) AS tp, sum(n) AS support FROM cf GROUP BY 1),
pcp AS (SELECT predicted AS class, sum(n) AS n_pred FROM cf GROUP BY 1),
pc AS (SELECT class, coalesce(CASE WHEN n_pred > 0 THEN tp / n_pred END, 0.0) AS precision,
              coalesce(CASE WHEN support > 0 THEN tp / support END, 0.0) AS recall, support
       FROM pcl JOIN pcp USING (class)),
pcf AS (SELECT *, coalesce(CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) END, 0.0)
                  AS f1 FROM pc)"""

ALL_SRC = "(SELECT doc_id, document AS text FROM sp)"
PRED = f"""{PREP}, {SPLIT}, {nb_ctes(TRAIN_SRC, ALL_SRC, "doc_id")},
pr AS (SELECT sp.doc_id, sp.split, sp.topic_group AS y, nbp.language AS p FROM sp JOIN nbp USING (doc_id)),
te AS (SELECT * FROM pr WHERE split = 'test'),
{CLASS_CTES}"""


_SCORED: dict = {}


def predictions(spark, sf_dir, text="document"):
    """``(doc_id, split, y, p)`` for every prepared ticket, written once per session."""
    key = (version(spark, sf_dir), text)
    if key in _SCORED:
        return _SCORED[key]
    sp = prepared_split(spark, sf_dir, reuse=True)
    pr = langid.predict(fitted_langid(spark, sf_dir), sp, text, out="p", with_probabilities=True)
    pr = pr.select("doc_id", "split", F.col("topic_group").alias("y"), "p", "confidence", "probabilities")
    return _SCORED.setdefault(key, materialize(pr))


def _test(spark, sf_dir):
    return predictions(spark, sf_dir).filter(F.col("split") == "test")


@register("eval_accuracy", f"""
WITH {PRED}
SELECT split, round(avg(CASE WHEN y = p THEN 1.0 ELSE 0.0 END), 6) AS accuracy, CAST(count(*) AS BIGINT) AS n
FROM pr GROUP BY split""")
def eval_accuracy(spark, sf_dir):
    """V1: train and test accuracy."""
    return V.accuracy(predictions(spark, sf_dir), by=["split"])


@register("confusion_matrix", f"WITH {PRED} SELECT actual, predicted, n FROM cf")
def confusion_matrix(spark, sf_dir):
    """V4 on the test split."""
    return V.confusion(_test(spark, sf_dir))


@register("eval_per_class", f"""
WITH {PRED}
SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
       CAST(support AS BIGINT) AS support FROM pcf""")
def eval_per_class(spark, sf_dir):
    """V2."""
    pc = V.per_class(V.confusion(_test(spark, sf_dir)))
    return pc.select("class", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support")


@register("eval_averages", f"""
WITH {PRED},
ag AS (SELECT avg(precision) AS mp, avg(recall) AS mr, avg(f1) AS mf,
              sum(precision * support) / sum(support) AS wp, sum(recall * support) / sum(support) AS wr,
              sum(f1 * support) / sum(support) AS wf, sum(recall * support) / sum(support) AS mi,
              CAST(sum(support) AS BIGINT) AS support FROM pcf)
SELECT 'macro' AS average, round(mp, 6) AS precision, round(mr, 6) AS recall, round(mf, 6) AS f1, support FROM ag
UNION ALL SELECT 'weighted', round(wp, 6), round(wr, 6), round(wf, 6), support FROM ag
UNION ALL SELECT 'micro', round(mi, 6), round(mi, 6), round(mi, 6), support FROM ag""")
def eval_averages(spark, sf_dir):
    """V3."""
    return V.averages(V.per_class(V.confusion(_test(spark, sf_dir))))


@register("confused_pairs", f"""
WITH {PRED}
SELECT actual, predicted, round(pct, 6) AS pct FROM
  (SELECT *, n / sum(n) OVER (PARTITION BY actual) * 100 AS pct FROM cf) WHERE pct > 5""")
def confused_pairs(spark, sf_dir):
    """V5."""
    return V.confused_pairs(V.confusion(_test(spark, sf_dir)))


CLEAN_SRC = "(SELECT doc_id, document_clean AS text FROM sp)"


@register("model_comparison", f"""
WITH {PRED}, {nb_ctes(TRAIN_SRC, CLEAN_SRC, "doc_id").replace("nb", "mb")},
b AS (SELECT * FROM mbp),
j AS (SELECT te.doc_id, te.y, te.p AS pa, b.language AS pb FROM te JOIN b USING (doc_id))
SELECT CAST(count(*) AS BIGINT) AS n, round(avg((y = pa)::INT), 6) AS accuracy_a,
       round(avg((y = pb)::INT), 6) AS accuracy_b, round(avg((y = pb)::INT) - avg((y = pa)::INT), 6) AS accuracy_delta,
       round(avg((pa = pb)::INT), 6) AS agreement, CAST(count(*) FILTER (WHERE pa <> pb) AS BIGINT) AS n_disagree
FROM j""")
def model_comparison(spark, sf_dir):
    """V6: the trigram model on raw text (a) vs on cleaned text (b), test split."""
    sp = prepared_split(spark, sf_dir, reuse=True)
    fitted = fitted_langid(spark, sf_dir)
    test = sp.filter(F.col("split") == "test")
    a = langid.predict(fitted, test, "document", out="p").select("doc_id", F.col("topic_group").alias("y"), "p")
    b = langid.predict(fitted, test, "document_clean", out="p").select("doc_id", "p")
    return V.compare_models(a, b)


@register("quality_gates", f"""
WITH {PRED},
sm AS (SELECT doc_id, sum(exp(score - mx)) AS z FROM (SELECT *, max(score) OVER (PARTITION BY doc_id) AS mx FROM nbs)
       GROUP BY doc_id),
ps AS (SELECT doc_id, sum(exp(score - mx) / z) AS p_sum
       FROM (SELECT *, max(score) OVER (PARTITION BY doc_id) AS mx FROM nbs) JOIN sm USING (doc_id) GROUP BY doc_id),
te2 AS (SELECT te.*, 1.0 / sm.z AS confidence, p_sum FROM te LEFT JOIN sm USING (doc_id) LEFT JOIN ps USING (doc_id))
SELECT CAST(count(*) AS BIGINT) AS n, avg((y = p)::INT) > 0 AS accuracy_positive,
       CAST(count(*) FILTER (WHERE confidence IS NULL OR confidence < 0 OR confidence > 1) AS BIGINT) AS bad_confidence,
       CAST(count(*) FILTER (WHERE p_sum IS NULL OR abs(p_sum - 1) > 0.01) AS BIGINT) AS bad_probability_sum FROM te2""")
def quality_gates(spark, sf_dir):
    """V7 on the test split."""
    return V.quality_gates(_test(spark, sf_dir))
