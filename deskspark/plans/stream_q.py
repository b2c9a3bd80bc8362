"""Streaming queries: file-stream replays whose output must equal batch."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from deskspark.plans import REGISTRY, register
from deskspark.plans.monitor_q import AT, DISTRIBUTION, EV, GAUGES, STEP, WINDOW_END, alerts_sql, detections
from deskspark.plans.request_q import fitted_langid
from deskspark.plans.svm_q import served
from deskspark.session import ensure_checkpoint_dir
from deskspark.sources.sinks import publish_model
from deskspark.sources.tables import table
from deskspark.streaming import monitor as SM
from deskspark.streaming import requests as SR


def _events(spark, sf_dir):
    return SM.metric_stream(SM.file_stream(spark, f"{sf_dir.rstrip('/')}/events.parquet"))


@register("stream_class_counts_5m", f"""
WITH {EV}
SELECT time_bucket(INTERVAL '5 minutes', ts) AS window_start, service, class_name, CAST(count(*) AS BIGINT) AS n
FROM ev WHERE NOT is_error GROUP BY ALL""")
def stream_class_counts_5m(spark, sf_dir):
    """O2 per 5-minute event-time window, computed by a streaming job."""
    return SM.run_available(SM.class_counts(_events(spark, sf_dir)), mode="complete", name="class-counts")


@register("stream_request_rate_5m", f"""
WITH {EV}
SELECT time_bucket(INTERVAL '5 minutes', ts) AS window_start, service, CAST(count(*) AS BIGINT) AS n,
       round(count(*) / 300, 6) AS rate FROM ev GROUP BY ALL""")
def stream_request_rate_5m(spark, sf_dir):
    """O11 by a streaming job."""
    return SM.run_available(SM.request_rate(_events(spark, sf_dir)), mode="complete", name="rate")


@register("stream_confidence_histogram", f"""
WITH {EV} {" UNION ALL ".join(
    [f"SELECT service, '{b}' AS le, CAST(count(*) FILTER (WHERE confidence <= {b}) AS BIGINT) AS n, "
     f"round(sum(confidence), 6) AS obs_sum, CAST(count(confidence) AS BIGINT) AS obs_count FROM ev "
     f"WHERE NOT is_error GROUP BY service" for b in SM.O.CONFIDENCE_BUCKETS]
    + ["SELECT service, '+Inf', CAST(count(confidence) AS BIGINT), round(sum(confidence), 6), "
       "CAST(count(confidence) AS BIGINT) FROM ev WHERE NOT is_error GROUP BY service"])}""")
def stream_confidence_histogram(spark, sf_dir):
    """O3 as a running streaming aggregate."""
    return SM.run_available(SM.confidence_histogram(_events(spark, sf_dir)), mode="complete", name="hist")


@register("stream_latency_quantiles")
def stream_latency_quantiles(spark, sf_dir):
    """O8 per hour with approx_percentile (approximate: rows-only check)."""
    return SM.run_available(SM.latency_quantiles(_events(spark, sf_dir)), mode="complete", name="quantiles")


@register("stream_latency_ranks", f"""
WITH {EV}
SELECT time_bucket(INTERVAL '1 day', ts) AS window_start, service, CAST(count(*) AS BIGINT) AS n, true AS p95_within, true AS p99_within
FROM ev WHERE NOT is_error GROUP BY ALL""")
def stream_latency_ranks(spark, sf_dir):
    """O8 by a streaming job with a quantile sketch as state: whether the true rank of each reported quantile is within the stated error."""
    found = SM.run_available(SM.latency_sketches(_events(spark, sf_dir), "1 day"), mode="complete", name="sketches")
    errors = SM.rank_errors(found, SM.O.metric_events(table(spark, sf_dir, "events")), "1 day")
    within = [(F.col(f"{p}_error") <= SM.RANK_ERROR).alias(f"{p}_within") for p in ("p95", "p99")]
    return errors.select("window_start", "service", "n", *within)


@register("stream_error_rate_alerts", f"""
WITH {EV},
per AS (SELECT service, {AT} AS t, count(*) FILTER (WHERE is_error) AS e, count(*) FILTER (WHERE NOT is_error) AS s
        FROM ev GROUP BY ALL HAVING {AT} <= (SELECT max(ts) - INTERVAL {SM.WATERMARK} FROM ev)),
gg AS (SELECT service, t,
              coalesce(lead(t) OVER (PARTITION BY service ORDER BY t), (SELECT max(t) FROM per) + INTERVAL '{STEP} seconds') AS until,
              CASE WHEN sum(s) OVER w <> 0 THEN sum(e) OVER w * 100.0 / sum(s) OVER w END AS error_rate
       FROM per WINDOW w AS (PARTITION BY service ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
{alerts_sql('gg', 'service', SM.ERROR_RATE_RULES)}
SELECT * FROM al""")
def stream_error_rate_alerts(spark, sf_dir):
    """O18 by a streaming job, over the evaluation steps that the watermark has passed."""
    return SM.error_rate_alerts(_events(spark, sf_dir))


#: The events that the watermark has passed at the end of the source: those whose window ends before it.
PASSED = EV.replace("ev AS", "ev0 AS") + f""",
ev AS (SELECT * FROM ev0 WHERE {{at}} <= (SELECT max(ts) - INTERVAL {SM.WATERMARK} FROM ev0))"""


@register("stream_latency_alerts", f"""
WITH {GAUGES.replace(EV, PASSED.format(at=AT))}, {alerts_sql('gg', 'service', SM.O.THRESHOLD_ALERTS)}
SELECT * FROM al""")
def stream_latency_alerts(spark, sf_dir):
    """O16 + O18 by a streaming job: latency (rolling buffer) and error-rate alerts over the steps that the watermark has passed."""
    return SM.stream_alerts(_events(spark, sf_dir), SM.O.THRESHOLD_ALERTS)


@register("stream_source_silence", f"""
WITH {PASSED.format(at="time_bucket(INTERVAL '1 minute', ts) + INTERVAL '1 minute'")},
sq AS (SELECT service, ts AS silence_start, lead(ts) OVER (PARTITION BY service ORDER BY ts) AS nxt FROM ev),
se AS (SELECT service, silence_start, coalesce(nxt, (SELECT max(ts) FROM ev)) AS silence_end, nxt IS NULL AS ongoing FROM sq)
SELECT service, silence_start, silence_end, round(date_diff('microsecond', silence_start, silence_end) / 1e6, 6) AS gap_seconds, ongoing
FROM se WHERE date_diff('microsecond', silence_start, silence_end) / 1e6 > 60""")
def stream_source_silence(spark, sf_dir):
    """O19 by a streaming job."""
    return SM.source_silence(_events(spark, sf_dir))


@register("stream_distribution_alerts", f"""
WITH {PASSED.format(at=WINDOW_END)}, {DISTRIBUTION}
SELECT alert, active_from, active_until, firing_from, value FROM al""")
def stream_distribution_alerts(spark, sf_dir):
    """O17 + O18 by a streaming job, over the rate windows that the watermark has passed."""
    return SM.distribution_alerts(_events(spark, sf_dir), detections(spark, sf_dir))


def _published(spark, sf_dir):
    """The classifier of these tables, published as version 1 of a folder of its own."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/deskspark-models/{uuid.uuid4().hex}"
    publish_model(spark, *served(spark, sf_dir), folder)
    return folder


def _request_stream(spark, sf_dir):
    """User turns as requests, named by conversation and turn.  They carry no time, so theirs is that of their arrival."""
    conv = SM.file_stream(spark, f"{sf_dir.rstrip('/')}/conversations.parquet").filter(F.col("role") == "user")
    return conv.select(F.concat("conv_id", F.lit("-"), "turn").alias("request_id"), F.current_timestamp().alias("ts"), "conv_id", "turn", "text")


@register("stream_request_scoring")
def stream_request_scoring(spark, sf_dir):
    """G10 over a request file stream, scored micro-batch by micro-batch."""
    return SR.serve(SR.once(_request_stream(spark, sf_dir)), fitted_langid(spark, sf_dir), _published(spark, sf_dir))


@register("stream_request_classes", f"""
SELECT conv_id || '-' || turn AS request_id, 1::INTEGER AS model_version, conv_id, turn, predicted_class, model_used, pii_detected
FROM ({REGISTRY["request_classes"][1]})""")
def stream_request_classes(spark, sf_dir):
    """S10 + S7 + G10: every request is sent twice, answered once, and names the model's version."""
    twice = _request_stream(spark, sf_dir).unionByName(_request_stream(spark, sf_dir))
    answers = SR.serve(SR.once(twice), fitted_langid(spark, sf_dir), _published(spark, sf_dir))
    return answers.select("request_id", "model_version", "conv_id", "turn", "predicted_class", "model_used", "pii_detected")
