"""Monitoring queries O1-O21 over ``events`` (and documents / requests)."""

from __future__ import annotations

from pyspark.sql import functions as F

from deskspark.config import DEFAULT
from deskspark.operators import langid
from deskspark.operators import monitor as O
from deskspark.operators import pii
from deskspark.plans import register
from deskspark.plans.request_q import ROUTE_CTES, TRAIN_SRC, fitted_langid, routed
from deskspark.plans.prepare_q import PREP, SPLIT
from deskspark.plans.sqlparts import nb_ctes, pii_scrub_ctes
from deskspark.sources.tables import table

EV = """ev AS (SELECT event_id, ts, ['tfidf', 'transformer', 'agent'][user_id % 3 + 1] AS service,
       event_type AS class_name, value / 1000 AS latency, event_type = 'error' AS is_error,
       CAST(json_extract(props, '$.k') AS DOUBLE) / 100 AS confidence,
       CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status FROM events)"""


def ev(spark, sf_dir):
    return O.metric_events(table(spark, sf_dir, "events"))


@register("request_counter", f"""
WITH {EV} SELECT service, '/predict' AS endpoint, status, CAST(count(*) AS BIGINT) AS n FROM ev GROUP BY ALL""")
def request_counter(spark, sf_dir):
    """O1."""
    return O.request_counter(ev(spark, sf_dir))


@register("predictions_by_class", f"""
WITH {EV} SELECT service, class_name, CAST(count(*) AS BIGINT) AS n FROM ev WHERE NOT is_error GROUP BY ALL""")
def predictions_by_class(spark, sf_dir):
    """O2."""
    return O.predictions_by_class(ev(spark, sf_dir))


def _hist_sql(value: str, bounds, where: str, by: str = "service") -> str:
    rows = [f"SELECT {by}, '{b}' AS le, CAST(count(*) FILTER (WHERE {value} <= {b}) AS BIGINT) AS n, "
            f"round(sum({value}), 6) AS obs_sum, CAST(count({value}) AS BIGINT) AS obs_count FROM ev {where} GROUP BY {by}"
            for b in bounds]
    rows.append(f"SELECT {by}, '+Inf', CAST(count({value}) AS BIGINT), round(sum({value}), 6), "
                f"CAST(count({value}) AS BIGINT) FROM ev {where} GROUP BY {by}")
    return " UNION ALL ".join(rows)


@register("confidence_histogram", f"""
WITH {EV} {_hist_sql('confidence', O.CONFIDENCE_BUCKETS, 'WHERE NOT is_error')}""")
def confidence_histogram(spark, sf_dir):
    """O3."""
    return O.cumulative_histogram(ev(spark, sf_dir).filter(~F.col("is_error")), "confidence", O.CONFIDENCE_BUCKETS)


LAT_HIST = _hist_sql('latency', O.LATENCY_BUCKETS, 'WHERE NOT is_error')


@register("latency_histogram", f"WITH {EV} {LAT_HIST}")
def latency_histogram(spark, sf_dir):
    """Per model (service)."""
    return O.cumulative_histogram(ev(spark, sf_dir).filter(~F.col("is_error")), "latency", O.LATENCY_BUCKETS)


@register("request_counter_labels", f"""
WITH {EV}
SELECT service, '/predict' AS endpoint, CASE WHEN service <> 'agent' THEN 'POST' END AS method,
       CASE WHEN service = 'agent' THEN CASE WHEN event_id % 2 = 0 THEN 'tfidf' ELSE 'distilbert' END END AS model_used,
       status, CAST(count(*) AS BIGINT) AS n FROM ev GROUP BY ALL""")
def request_counter_labels(spark, sf_dir):
    """O1 by method and model.  The agent's even requests stand for the ones it sends to the tfidf service."""
    return O.labelled_requests(ev(spark, sf_dir))


@register("request_duration_histogram", f"WITH {EV} {_hist_sql('latency', O.DURATION_BUCKETS, '')}")
def request_duration_histogram(spark, sf_dir):
    """Duration of all requests per service, in the default buckets."""
    return O.cumulative_histogram(ev(spark, sf_dir), "latency", O.DURATION_BUCKETS)


@register("request_duration_p95_5m", f"""
WITH {EV.replace("ev AS (SELECT", "ev AS (SELECT time_bucket(INTERVAL '5 minutes', ts) AS window_start,")},
h AS ({_hist_sql('latency', O.DURATION_BUCKETS, '', 'window_start, service')}),
hb AS (SELECT window_start, service, n, CASE WHEN le = '+Inf' THEN 'inf'::DOUBLE ELSE CAST(le AS DOUBLE) END AS ub FROM h),
hl AS (SELECT *, coalesce(lag(ub) OVER (PARTITION BY window_start, service ORDER BY ub), 0.0) AS lb,
              coalesce(lag(n) OVER (PARTITION BY window_start, service ORDER BY ub), 0) AS prev,
              max(n) OVER (PARTITION BY window_start, service) AS total FROM hb),
hit AS (SELECT *, 0.95 * total AS rk FROM hl WHERE n >= 0.95 * total AND total > 0
        QUALIFY row_number() OVER (PARTITION BY window_start, service ORDER BY ub) = 1)
SELECT window_start, service, round(CASE WHEN ub = 'inf'::DOUBLE THEN lb
                           ELSE lb + (ub - lb) * (CASE WHEN n - prev <> 0 THEN (rk - prev) / (n - prev) END) END, 6) AS q95
FROM hit""")
def request_duration_p95_5m(spark, sf_dir):
    """O14 on the dashboard's own rate: the 0.95 quantile of each 5 minutes' buckets."""
    e = ev(spark, sf_dir).withColumn("window_start", F.window("ts", DEFAULT.rate_window).start)
    by = ("window_start", "service")
    return O.histogram_quantile(O.cumulative_histogram(e, "latency", O.DURATION_BUCKETS, by=by), by=by)


@register("pii_by_type", f"""
WITH {pii_scrub_ctes("documents", "doc_id")},
ty AS (SELECT unnest(list_transform(details, lambda s: lower(regexp_extract(s, '\\[(\\w+)\\]:', 1)))) AS pii_type
       FROM pd)
SELECT pii_type, CAST(count(*) AS BIGINT) AS n FROM ty GROUP BY pii_type""")
def pii_by_type(spark, sf_dir):
    """One count per type per text (documents as the text stream)."""
    d = pii.types(pii.detect(table(spark, sf_dir, "documents").select("doc_id", "text")))
    return d.select(F.explode("pii_types").alias("pii_type")).groupBy("pii_type").agg(F.count(F.lit(1)).alias("n"))


@register("routing_by_model", f"""
WITH {ROUTE_CTES}
SELECT model_used, language || '_routing' AS reason, CAST(count(*) AS BIGINT) AS n FROM rm GROUP BY ALL""")
def routing_by_model(spark, sf_dir):
    """O6."""
    return routed(spark, sf_dir).groupBy("model_used", "reason").agg(F.count(F.lit(1)).alias("n"))


@register("errors_by_type", f"""
WITH {EV} SELECT service, class_name AS error_type, CAST(count(*) AS BIGINT) AS n FROM ev WHERE is_error GROUP BY ALL""")
def errors_by_type(spark, sf_dir):
    """O7."""
    e = ev(spark, sf_dir).filter("is_error")
    return e.groupBy("service", F.col("class_name").alias("error_type")).agg(F.count(F.lit(1)).alias("n"))


@register("latency_percentiles", f"""
WITH {EV}
SELECT service, round(quantile_cont(latency, 0.95), 6) AS p95_latency, round(quantile_cont(latency, 0.99), 6) AS p99_latency
FROM ev WHERE NOT is_error GROUP BY service""")
def latency_percentiles(spark, sf_dir):
    """O8."""
    return O.latency_percentiles(ev(spark, sf_dir).filter(~F.col("is_error")))


@register("error_rate", f"""
WITH {EV}
SELECT service, CAST(count(*) FILTER (WHERE is_error) AS BIGINT) AS errors,
       CAST(count(*) FILTER (WHERE NOT is_error) AS BIGINT) AS successes,
       round(CASE WHEN count(*) FILTER (WHERE NOT is_error) > 0
             THEN count(*) FILTER (WHERE is_error) * 100.0 / count(*) FILTER (WHERE NOT is_error) END, 6) AS error_rate
FROM ev GROUP BY service""")
def error_rate(spark, sf_dir):
    """O9."""
    return O.error_rate(ev(spark, sf_dir))


BUF = f"""{EV},
ok AS (SELECT service, ts, latency, row_number() OVER (PARTITION BY service ORDER BY ts, event_id) AS rn
       FROM ev WHERE NOT is_error),
sz AS (SELECT *, CASE WHEN rn <= 1001 THEN rn ELSE 501 + (rn - 1002) % 501 END AS buffer_size FROM ok),
buf AS (SELECT a.service, CAST(a.rn AS BIGINT) AS rn, a.ts, CAST(a.buffer_size AS BIGINT) AS buffer_size,
               round(quantile_cont(b.latency, 0.95), 9) AS p95_latency, round(quantile_cont(b.latency, 0.99), 9) AS p99_latency
        FROM sz a JOIN ok b ON a.service = b.service AND b.rn BETWEEN a.rn - a.buffer_size + 1 AND a.rn
        GROUP BY a.service, a.rn, a.ts, a.buffer_size)"""


@register("rolling_latency_buffer", f"WITH {BUF} SELECT * FROM buf")
def rolling_latency_buffer(spark, sf_dir):
    """O10."""
    return O.rolling_buffer(ev(spark, sf_dir))


@register("request_rate_5m", f"""
WITH {EV}
SELECT time_bucket(INTERVAL '5 minutes', ts) AS window_start, service, CAST(count(*) AS BIGINT) AS n,
       round(count(*) / 300, 6) AS rate FROM ev GROUP BY ALL""")
def request_rate_5m(spark, sf_dir):
    """O11."""
    return O.windowed_rate(ev(spark, sf_dir))


@register("success_rate_5m", f"""
WITH {EV}
SELECT time_bucket(INTERVAL '5 minutes', ts) AS window_start,
       round(100.0 * count(*) FILTER (WHERE status = 200) / count(*), 6) AS success_rate FROM ev GROUP BY ALL""")
def success_rate_5m(spark, sf_dir):
    """O12."""
    return O.success_rate(ev(spark, sf_dir))


@register("volume_by_model_5m", f"""
WITH {EV}
SELECT time_bucket(INTERVAL '5 minutes', ts) AS window_start, service AS model_used, CAST(count(*) AS BIGINT) AS n,
       round(count(*) / 300, 6) AS rate FROM ev WHERE NOT is_error GROUP BY ALL""")
def volume_by_model_5m(spark, sf_dir):
    """Successful requests per model."""
    e = ev(spark, sf_dir).withColumnRenamed("service", "model_used")
    return O.windowed_rate(e, by=("model_used",), cond=~F.col("is_error"))


@register("latency_p95_from_histogram", f"""
WITH {EV}, h AS ({LAT_HIST}),
hb AS (SELECT service, n, CASE WHEN le = '+Inf' THEN 'inf'::DOUBLE ELSE CAST(le AS DOUBLE) END AS ub FROM h),
hl AS (SELECT *, coalesce(lag(ub) OVER (PARTITION BY service ORDER BY ub), 0.0) AS lb,
              coalesce(lag(n) OVER (PARTITION BY service ORDER BY ub), 0) AS prev,
              max(n) OVER (PARTITION BY service) AS total FROM hb),
hit AS (SELECT *, 0.95 * total AS rk FROM hl WHERE n >= 0.95 * total AND total > 0
        QUALIFY row_number() OVER (PARTITION BY service ORDER BY ub) = 1)
SELECT service, round(CASE WHEN ub = 'inf'::DOUBLE THEN lb
                           ELSE lb + (ub - lb) * (CASE WHEN n - prev <> 0 THEN (rk - prev) / (n - prev) END) END, 6) AS q95
FROM hit""")
def latency_p95_from_histogram(spark, sf_dir):
    """histogram_quantile(0.95) over the O4 buckets."""
    return O.histogram_quantile(latency_histogram(spark, sf_dir))


@register("throughput_hourly", f"""
WITH {EV}
SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, service, CAST(count(*) AS BIGINT) AS n,
       round(count(*) / 3600, 6) AS rate FROM ev GROUP BY ALL""")
def throughput_hourly(spark, sf_dir):
    """Requests per second per service, hourly."""
    return O.windowed_rate(ev(spark, sf_dir), width="1 hour", seconds=3600)


def alerts_sql(gauge_cte: str, by: str, rules) -> str:
    conds = []
    for name, metric, op, thr, for_s in rules:
        conds.append(f"SELECT {by}, t, until, '{name}' AS alert, CAST({metric} AS DOUBLE) AS value, {for_s} AS for_s "
                     f"FROM {gauge_cte} WHERE CAST({metric} AS DOUBLE) {op} {thr}")
    return f"""
cd AS ({" UNION ALL ".join(conds)}),
br AS (SELECT *, CASE WHEN lag(until) OVER (PARTITION BY {by}, alert ORDER BY t) >= t THEN 0 ELSE 1 END AS brk FROM cd),
il AS (SELECT *, sum(brk) OVER (PARTITION BY {by}, alert ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
                 AS isl FROM br),
pe AS (SELECT {by}, alert, min(t) AS active_from, max(until) AS active_until, round(arg_min(value, t), 6) AS value, max(for_s) AS for_s
       FROM il GROUP BY {by}, alert, isl),
al AS (SELECT {by}, alert, active_from, active_until,
              CASE WHEN epoch(active_until - active_from) - {STEP} >= for_s THEN active_from + to_seconds(for_s) END AS firing_from,
              value FROM pe)"""


STEP = DEFAULT.alert_step_seconds
AT = f"time_bucket(INTERVAL '{STEP} seconds', ts) + INTERVAL '{STEP} seconds'"
GAUGES = f"""{BUF},
per AS (SELECT service, {AT} AS t, count(*) FILTER (WHERE is_error) AS e,
               count(*) FILTER (WHERE NOT is_error) AS s FROM ev GROUP BY ALL),
lst AS (SELECT service, {AT} AS t, arg_max(p95_latency, rn) AS p95, arg_max(p99_latency, rn) AS p99 FROM buf GROUP BY ALL),
gg AS (SELECT service, t,
              coalesce(lead(t) OVER (PARTITION BY service ORDER BY t), (SELECT max(t) FROM per) + INTERVAL '{STEP} seconds') AS until,
              CASE WHEN sum(s) OVER w <> 0 THEN sum(e) OVER w * 100.0 / sum(s) OVER w END AS error_rate,
              last_value(p95 IGNORE NULLS) OVER w AS p95_latency, last_value(p99 IGNORE NULLS) OVER w AS p99_latency
       FROM per LEFT JOIN lst USING (service, t)
       WINDOW w AS (PARTITION BY service ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""


@register("threshold_alerts", f"""
WITH {GAUGES}, {alerts_sql('gg', 'service', O.THRESHOLD_ALERTS)}
SELECT * FROM al""")
def threshold_alerts(spark, sf_dir):
    """O16 + O18: periods of the latency and error-rate alerts per service, at the rules' evaluation interval."""
    e = ev(spark, sf_dir)
    return O.threshold_alerts(O.service_gauges(e, O.rolling_buffer(e)))


WINDOW_END = "time_bucket(INTERVAL '5 minutes', ts) + INTERVAL '5 minutes'"
DISTRIBUTION = f"""{pii_scrub_ctes("documents", "doc_id")},
bk AS (SELECT {WINDOW_END} AS t, * FROM ev),
dg AS (SELECT t, quantile_cont(confidence, 0.25) AS confidence_p25, CAST(count(DISTINCT class_name) AS DOUBLE) AS n_classes
       FROM bk WHERE NOT is_error GROUP BY t),
pg AS (SELECT t, sum(len(details)) / 300 AS pii_rate FROM bk JOIN pd ON event_id = doc_id GROUP BY t),
dga AS (SELECT 'all' AS grp, t, t + INTERVAL '5 minutes' AS until, confidence_p25, n_classes, pii_rate FROM dg FULL JOIN pg USING (t)),
{alerts_sql('dga', 'grp', O.DISTRIBUTION_ALERTS)}"""


def detections(spark, sf_dir):
    """PII types found per request: a request event carries the text of the document with its number."""
    found = pii.types(pii.detect(table(spark, sf_dir, "documents").select("doc_id", "text")))
    return found.select(F.col("doc_id").alias("event_id"), F.size("pii_types").alias("n"))


@register("distribution_alerts", f"""
WITH {EV}, {DISTRIBUTION}
SELECT alert, active_from, active_until, firing_from, value FROM al""")
def distribution_alerts(spark, sf_dir):
    """O17 + O18."""
    e = ev(spark, sf_dir)
    return O.distribution_alerts(e, e.select("event_id", "ts").join(detections(spark, sf_dir), "event_id"))


@register("source_silence", f"""
WITH {EV},
sq AS (SELECT service, ts AS silence_start, lead(ts) OVER (PARTITION BY service ORDER BY ts) AS nxt FROM ev),
se AS (SELECT service, silence_start, coalesce(nxt, (SELECT max(ts) FROM ev)) AS silence_end, nxt IS NULL AS ongoing FROM sq)
SELECT service, silence_start, silence_end, round(date_diff('microsecond', silence_start, silence_end) / 1e6, 6) AS gap_seconds,
       ongoing
FROM se WHERE date_diff('microsecond', silence_start, silence_end) / 1e6 > 60""")
def source_silence(spark, sf_dir):
    """O19."""
    return O.source_silence(ev(spark, sf_dir))


@register("consistency_check", f"""
WITH {PREP}, {SPLIT}, {nb_ctes(TRAIN_SRC, "(SELECT doc_id, text FROM documents)", "doc_id")},
pt AS (SELECT d.text, nbp.language AS p FROM documents d JOIN nbp USING (doc_id)),
g AS (SELECT text, count(*) AS n, count(DISTINCT p) AS k FROM pt GROUP BY text HAVING count(*) > 1)
SELECT CAST(count(*) AS BIGINT) AS repeated_texts, CAST(count(*) FILTER (WHERE k = 1) AS BIGINT) AS consistent,
       round(CASE WHEN count(*) > 0 THEN count(*) FILTER (WHERE k = 1) * 100.0 / count(*) END, 6) AS consistency_pct FROM g""")
def consistency_check(spark, sf_dir):
    """Repeated document texts must get one predicted class."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    pred = langid.predict(fitted_langid(spark, sf_dir), docs, "text", out="p")
    return O.consistency(pred)


@register("sla_check", f"""
WITH {EV}, sla(service, sla_s) AS (VALUES {", ".join(f"('{s}', {v})" for s, v in O.SLA_SECONDS)})
SELECT service, sla_s, CAST(count(*) AS BIGINT) AS n, CAST(count(*) FILTER (WHERE latency > sla_s) AS BIGINT) AS over_sla,
       CAST(count(*) FILTER (WHERE latency > sla_s * {O.SLA_WARN_FACTOR}) AS BIGINT) AS warnings,
       round(avg(CASE WHEN latency <= sla_s THEN 1.0 ELSE 0.0 END) * 100, 6) AS within_sla_pct
FROM ev JOIN sla USING (service) WHERE NOT is_error GROUP BY ALL""")
def sla_check(spark, sf_dir):
    """O21."""
    return O.sla_check(ev(spark, sf_dir))
