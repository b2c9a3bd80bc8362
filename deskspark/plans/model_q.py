"""Model queries M1-M5 (rows-only checks except M4)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from deskspark.config import DEFAULT
from deskspark.operators import model as M
from deskspark.plans import register
from deskspark.plans.prepare_q import prepared_split, written_train
from deskspark.session import ensure_checkpoint_dir
from deskspark.sources import sinks
from deskspark.sources.tables import table


def _splits(spark, sf_dir):
    sp = prepared_split(spark, sf_dir, reuse=True)
    return sp.filter(F.col("split") == "train"), sp.filter(F.col("split") == "test"), sp


def _labels(sp):
    """Class names by code (one row per class; the model has a weight per class and feature anyway)."""
    rows = sp.select("topic_encoded", "topic_group").distinct().orderBy("topic_encoded").collect()
    return [r["topic_group"] for r in rows]


@register("calibrated_predictions")
def calibrated_predictions(spark, sf_dir):
    """M2 + M3: 3-fold sigmoid-calibrated SVM; class, confidence and the
    probability list (descending) for every test ticket."""
    train, test, sp = _splits(spark, sf_dir)
    fitted = M.fit_calibrated(train)
    return M.predict_calibrated(fitted, test, _labels(sp)).select(
        "doc_id", "predicted_class", "confidence", "probabilities")


@register("logit_softmax", """
WITH l AS (SELECT vec_id, label, list_transform(embedding, lambda v: CAST(v AS DOUBLE)) AS l FROM embeddings)
SELECT vec_id, label, CAST(list_position(l, list_max(l)) - 1 AS INTEGER) AS predicted,
       round(1.0 / list_sum(list_transform(l, lambda v: exp(v - list_max(l)))), 6) AS confidence FROM l""")
def logit_softmax(spark, sf_dir):
    """M4: the embedding column read as logits."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", "label", F.col("embedding").alias("logits"))
    s = M.softmax_logits(e)
    return s.select("vec_id", "label", "predicted", F.round("confidence", 6).alias("confidence"))


@register("cv_weighted_f1")
def cv_weighted_f1(spark, sf_dir):
    """M5: 5-fold cross-validated weighted F1 of the default configuration."""
    train = written_train(spark, sf_dir)
    score = M.cv_weighted_f1(train)
    return train.agg(F.count(F.lit(1)).alias("n_train")).withColumn("cv_f1_weighted", F.lit(score))


@register("hyper_search")
def hyper_search(spark, sf_dir):
    """M6 + S9 + M7: a seeded search of six trials, each scored by three outer and two inner folds; its runs are logged and the best one
    is read back from the log."""
    train = written_train(spark, sf_dir)
    runs = M.search(train, trials=6, params=DEFAULT.with_(cv_folds=3, calibration_folds=2), together=6)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/deskspark-tables/search-{uuid.uuid4().hex}"
    log = spark.createDataFrame([(f"trial-{r['trial']}", k, float(v)) for r in runs for k, v in r.items()], "run_id string, key string, value double")
    log = sinks.append_runs(spark, log, path).groupBy("run_id").pivot("key", list(runs[0])).agg(F.first("value"))
    return M.best_run(log)
