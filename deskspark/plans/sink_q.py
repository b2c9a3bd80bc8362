"""Sinks written and read back (S3-S6, S8, S9) and run selection (M7, M8) over a run log derived from ``events``."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from deskspark.operators import model as M
from deskspark.operators import profile as E
from deskspark.plans import REGISTRY, evaluate_q, profile_q, register  # noqa: F401 - their queries are read back here
from deskspark.plans.monitor_q import EV, ev
from deskspark.plans.prepare_q import PREP, SPLIT, label_dictionary, prepared_split
from deskspark.session import ensure_checkpoint_dir
from deskspark.sources import sinks
from deskspark.sources.tables import tickets


def _folder(spark, name):
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/deskspark-sinks/{name}-{uuid.uuid4().hex}"


@register("split_sink", f"WITH {PREP}, {SPLIT} SELECT doc_id, topic_encoded, topic_group FROM sp WHERE split = 'test'")
def split_sink(spark, sf_dir):
    """S3 + S6: the split written by partition, the test part read back."""
    path = _folder(spark, "split")
    sinks.write_splits(prepared_split(spark, sf_dir).select("doc_id", "topic_encoded", "topic_group", "split"), path)
    return sinks.read_prepared(spark, path, "test").drop("split")


@register("stats_sink", REGISTRY["dataset_profile"][1])
def stats_sink(spark, sf_dir):
    """The statistics written as JSON and read back."""
    path, stats = _folder(spark, "stats"), E.dataset_profile(tickets(spark, sf_dir))
    sinks.write_stats(stats, path)
    return spark.read.schema(stats.schema).json(path)


@register("label_sink", REGISTRY["label_dictionary"][1])
def label_sink(spark, sf_dir):
    """The label dictionary written and read back."""
    path = _folder(spark, "labels")
    sinks.write_labels(label_dictionary(spark, sf_dir), path)
    return spark.read.parquet(path)


@register("report_sink", REGISTRY["eval_per_class"][1])
def report_sink(spark, sf_dir):
    """One JSON row with the report of every class (as many as there are classes), read back by class."""
    path, classes = _folder(spark, "report"), REGISTRY["eval_per_class"][0](spark, sf_dir)
    report = classes.agg(F.collect_list(F.struct(*classes.columns)).alias("classes"))
    sinks.write_stats(report, path)
    return spark.read.schema(report.schema).json(path).select(F.inline("classes"))


LOG = f"""{EV},
lg AS (SELECT service AS run_id, CAST(day(ts) AS INT) AS epoch, round(avg(latency), 6) AS loss, round(avg(confidence), 6) AS score
       FROM ev WHERE NOT is_error GROUP BY ALL)"""


def run_log(spark, sf_dir):
    """A run log: a service is a run, a day of the month an epoch; mean latency is the loss, mean confidence the score."""
    ok = ev(spark, sf_dir).filter(~F.col("is_error"))
    return ok.groupBy(F.col("service").alias("run_id"), F.dayofmonth("ts").alias("epoch")).agg(
        F.round(F.avg("latency"), 6).alias("loss"), F.round(F.avg("confidence"), 6).alias("score"))


@register("run_log_sink", f"WITH {LOG} SELECT run_id, CAST(epoch AS VARCHAR) AS key, score AS value FROM lg")
def run_log_sink(spark, sf_dir):
    """The first half of the log, then all of it: keys that a run has already are skipped."""
    path = _folder(spark, "runs")
    log = run_log(spark, sf_dir).select("run_id", "epoch", F.col("epoch").cast("string").alias("key"), F.col("score").alias("value"))
    sinks.append_runs(spark, log.filter("epoch <= 15").drop("epoch"), path)
    return sinks.append_runs(spark, log.drop("epoch"), path)


@register("best_run", f"""
WITH {LOG}
(SELECT 'score' AS by, * FROM lg ORDER BY score DESC LIMIT 1) UNION ALL (SELECT 'loss', * FROM lg ORDER BY loss LIMIT 1)""")
def best_run(spark, sf_dir):
    """M7: the epoch of the greatest score and the epoch of the least loss."""
    log, by = run_log(spark, sf_dir), lambda name: F.lit(name).alias("by")
    return (M.best_run(log).select(by("score"), "*")
            .unionByName(M.best_run(log, "loss", minimize=True).select(by("loss"), "*")))


@register("early_stop", f"""
WITH {LOG},
im AS (SELECT *, coalesce(score > max(score) OVER (PARTITION BY run_id ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                          + 0.0001, true) AS improved FROM lg),
gr AS (SELECT *, sum(improved::INT) OVER (PARTITION BY run_id ORDER BY epoch) AS g FROM im),
ng AS (SELECT *, row_number() OVER (PARTITION BY run_id, g ORDER BY epoch) - 1 AS no_gain_run FROM gr)
SELECT run_id, epoch, score, loss, improved, CAST(no_gain_run AS INT) AS no_gain_run, no_gain_run >= 5 AS stop_here FROM ng""")
def early_stop(spark, sf_dir):
    """M8 on the score of every run."""
    return M.early_stop(run_log(spark, sf_dir), "score", by=["run_id"])
