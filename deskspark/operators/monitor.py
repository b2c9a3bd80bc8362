"""Operational metrics over an event table (O1-O21): counters, cumulative
histograms, exact percentiles, the rolling latency buffer, windowed rates,
histogram quantiles, threshold alerts with ``for`` durations, source
silence, consistency and SLA checks."""

from __future__ import annotations

import sys
from bisect import insort

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deskspark.config import DEFAULT, Params
from deskspark.operators.common import exact_percentiles, exact_row_number

# executors need not be able to import the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# ---------------------------------------------------------------------------
# Histogram bucket bounds and service-level targets.
# ---------------------------------------------------------------------------
CONFIDENCE_BUCKETS = (0.5, 0.6, 0.7, 0.8, 0.9, 0.95, 0.99, 1.0)
LATENCY_BUCKETS = (0.001, 0.005, 0.01, 0.05, 0.1, 0.5, 1.0)
DURATION_BUCKETS = (0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0)
SERVICES = ("tfidf", "transformer", "agent")
SLA_SECONDS = (("tfidf", 0.1), ("transformer", 0.5), ("agent", 0.15))
SLA_WARN_FACTOR = 1.5
# alert name, metric, comparison, threshold, for (seconds)
THRESHOLD_ALERTS = (
    ("HighLatencyP95", "p95_latency", ">", 0.5, 120),
    ("HighLatencyP99", "p99_latency", ">", 1.0, 120),
    ("HighErrorRate", "error_rate", ">", 5.0, 120),
    ("CriticalErrorRate", "error_rate", ">", 20.0, 60),
)
DISTRIBUTION_ALERTS = (
    ("LowConfidencePredictions", "confidence_p25", "<", 0.6, 300),
    ("ClassImbalance", "n_classes", "<", 5.0, 600),
    ("HighPIIDetected", "pii_rate", ">", 10.0, 120),
)


def metric_events(events: DataFrame) -> DataFrame:
    """Driver binding of ``events`` to request metrics."""
    svc = F.element_at(F.array(*[F.lit(s) for s in SERVICES]), (F.col("user_id") % 3 + 1).cast("int"))
    err = F.col("event_type") == "error"
    return events.select(
        "event_id", "ts", svc.alias("service"), F.col("event_type").alias("class_name"),
        (F.col("value") / 1000).alias("latency"), err.alias("is_error"),
        (F.get_json_object("props", "$.k").cast("double") / 100).alias("confidence"),
        F.when(err, 500).otherwise(200).alias("status"))


def request_counter(ev: DataFrame, endpoint: str = "/predict") -> DataFrame:
    """O1."""
    return ev.groupBy("service", F.lit(endpoint).alias("endpoint"), "status").agg(F.count(F.lit(1)).alias("n"))


def labelled_requests(ev: DataFrame, endpoint: str = "/predict", method: str = "POST") -> DataFrame:
    """O1 with the labels of each service: the method for the predicting services, the chosen model for the agent."""
    agent = F.col("service") == "agent"
    model = F.when(agent, F.when(F.col("event_id") % 2 == 0, F.lit("tfidf")).otherwise(F.lit("distilbert")))
    return ev.groupBy("service", F.lit(endpoint).alias("endpoint"), F.when(~agent, F.lit(method)).alias("method"), model.alias("model_used"),
                      "status").agg(F.count(F.lit(1)).alias("n"))


def predictions_by_class(ev: DataFrame) -> DataFrame:
    """O2: successful predictions by class and service."""
    return ev.filter(~F.col("is_error")).groupBy("service", "class_name").agg(F.count(F.lit(1)).alias("n"))


def cumulative_histogram(ev: DataFrame, value: str, bounds, by=("service",)) -> DataFrame:
    """Prometheus-style cumulative buckets (``le``), plus the
    observation sum and count - one aggregate, map-side combined."""
    aggs = [F.count_if(F.col(value) <= b).alias(f"_le{i}") for i, b in enumerate(bounds)]
    aggs += [F.count(F.col(value)).alias("_inf"), F.sum(value).alias("_sum")]
    a = ev.groupBy(*by).agg(*aggs)
    cells = [F.struct(F.lit(str(b)).alias("le"), F.col(f"_le{i}").alias("n")) for i, b in enumerate(bounds)]
    cells.append(F.struct(F.lit("+Inf").alias("le"), F.col("_inf").alias("n")))
    return a.select(*by, F.inline(F.array(*cells)), F.round("_sum", 6).alias("obs_sum"),
                    F.col("_inf").alias("obs_count"))


def latency_percentiles(ev: DataFrame, by=("service",)) -> DataFrame:
    """Exact linear-interpolated P95 / P99."""
    return exact_percentiles(ev, list(by), "latency", [0.95, 0.99]).select(
        *by, F.round("_q0", 6).alias("p95_latency"), F.round("_q1", 6).alias("p99_latency"))


def error_rate(ev: DataFrame, by=("service",)) -> DataFrame:
    """Errors / successes * 100 (the denominator counts successes only)."""
    return ev.groupBy(*by).agg(F.count_if("is_error").alias("errors"), F.count_if(~F.col("is_error")).alias("successes")) \
        .withColumn("error_rate", F.round(F.try_divide(F.col("errors") * 100.0, F.col("successes")), 6))


def rolling_buffer(ev: DataFrame, params: Params = DEFAULT, bucket: str = "1 second") -> DataFrame:
    """P95 / P99 after every prediction over the in-memory buffer that
    keeps everything up to ``trim_above + 1`` rows and is then cut to the
    last ``keep`` rows.

    Between two trims the buffer starts at a fixed row, so each "epoch" of
    ``keep + 1`` rows is one window partition with a growing frame; the
    ``keep`` rows carried over from the previous epoch are copied into it
    (each row lives in at most two partitions) and the epoch's values are
    kept in order while it grows.  Partitions are
    ``(service, epoch)``, at most ``trim_above + 1 + keep`` rows each, so a
    hot service is spread over many tasks.
    """
    ok = ev.filter(~F.col("is_error"))
    return buffer_values(exact_row_number(ok, ["service"], ["ts", "event_id"], F.window("ts", bucket).start), params)


def buffer_size(rn: Column, params: Params = DEFAULT) -> Column:
    """Rows in the buffer after prediction number ``rn`` of a service."""
    first, cyc = params.buffer_trim_above + 1, params.buffer_keep + 1
    return F.when(rn <= first, rn).otherwise(F.lit(cyc) + (rn - first - 1) % cyc)


def buffer_values(x: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """:func:`rolling_buffer` of numbered predictions (service, rn, ts, latency).  Numbers may begin anywhere: the values are right
    from the first row on whose whole buffer is there."""
    keep, first = params.buffer_keep, params.buffer_trim_above + 1
    cyc, rn = keep + 1, F.col("rn")
    epoch = F.when(rn <= first, F.lit(0)).otherwise(F.lit(1) + F.floor((rn - first - 1) / cyc)).cast("long")
    x = x.withColumn("_epoch", epoch)
    nxt = F.lit(first + 1) + F.col("_epoch") * cyc
    own = x.withColumn("_own", F.lit(True))
    carry = x.filter(rn >= nxt - keep).withColumn("_epoch", F.col("_epoch") + 1).withColumn("_own", F.lit(False))
    both = own.unionByName(carry).select("service", "_epoch", "rn", "ts", "latency", "_own")
    return both.groupBy("service", "_epoch").applyInArrow(
        growing_percentiles(first, cyc), f"service string, rn long, ts {dict(both.dtypes)['ts']}, buffer_size long, p95_latency double, p99_latency double")


def growing_percentiles(first: int, cyc: int):
    """Over one epoch: P95 and P99 of the rows so far at each own row, from an array kept in order (a binary search and one
    insertion a row)."""
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("rn")
        held, out, kept = [], ([], []), []
        for i, (x, own) in enumerate(zip(table["latency"].to_pylist(), table["_own"].to_pylist(), strict=True)):
            if x is not None:
                insort(held, x)
            if own:
                kept.append(i)
                for q, found in zip((0.95, 0.99), out, strict=True):
                    at = q * (len(held) - 1)
                    lo = int(at)
                    found.append(round(held[lo] + (held[min(lo + 1, len(held) - 1)] - held[lo]) * (at - lo), 9) if held else None)
        own = table.take(pa.array(kept, pa.int64()))
        rn = own["rn"].to_numpy()
        size = np.where(rn <= first, rn, cyc + (rn - first - 1) % cyc)
        return pa.table([own["service"], own["rn"], own["ts"], pa.array(size), pa.array(out[0], pa.float64()), pa.array(out[1], pa.float64())],
                        names=["service", "rn", "ts", "buffer_size", "p95_latency", "p99_latency"])

    return run


def windowed_rate(ev: DataFrame, width: str = DEFAULT.rate_window, seconds: int = 300, by=("service",),
                  cond: Column | None = None) -> DataFrame:
    """Events per second in tumbling event-time windows."""
    x = ev if cond is None else ev.filter(cond)
    g = x.groupBy(F.window("ts", width).start.alias("window_start"), *by)
    return g.agg(F.count(F.lit(1)).alias("n")).withColumn("rate", F.round(F.col("n") / seconds, 6))


def success_rate(ev: DataFrame, width: str = DEFAULT.rate_window) -> DataFrame:
    """100 * rate(status 200) / rate(all) per window."""
    g = ev.groupBy(F.window("ts", width).start.alias("window_start"))
    return g.agg(F.round(100.0 * F.count_if(F.col("status") == 200) / F.count(F.lit(1)), 6).alias("success_rate"))


def histogram_quantile(hist: DataFrame, q: float = 0.95, by=("service",)) -> DataFrame:
    """Quantile from cumulative buckets, linear inside the bucket that
    holds rank ``q * count``; the +Inf bucket returns the largest finite
    bound; an empty histogram gives null."""
    h = hist.withColumn("_ub", F.when(F.col("le") == "+Inf", F.lit(float("inf"))).otherwise(F.col("le").cast("double")))
    w = Window.partitionBy(*by).orderBy("_ub")
    h = (h.withColumn("_lb", F.coalesce(F.lag("_ub").over(w), F.lit(0.0)))
         .withColumn("_prev", F.coalesce(F.lag("n").over(w), F.lit(0)))
         .withColumn("_total", F.max("n").over(Window.partitionBy(*by)))
         .withColumn("_rank", F.lit(q) * F.col("_total")))
    hit = h.filter((F.col("n") >= F.col("_rank")) & (F.col("_total") > 0))
    first = hit.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") == 1)
    val = F.when(F.col("_ub") == float("inf"), F.col("_lb")).otherwise(
        F.col("_lb") + (F.col("_ub") - F.col("_lb")) *
        F.try_divide(F.col("_rank") - F.col("_prev"), F.col("n") - F.col("_prev")))
    return first.select(*by, F.round(val, 6).alias(f"q{int(q * 100)}"))


def _evaluated(params: Params) -> Column:
    """The first evaluation of the alert rules that sees an event: the end of its evaluation step."""
    return F.window("ts", f"{params.alert_step_seconds} seconds").end.alias("t")


def service_gauges(ev: DataFrame, buffer: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Gauge values seen by the alert rules: cumulative error rate and the
    rolling-buffer percentiles.  One row per service and evaluation at which
    they may have changed, valid from ``t`` until the next change (a gauge
    holds until it is set again), so no grid of evaluations is made."""
    per = ev.groupBy("service", _evaluated(params)).agg(
        F.count_if("is_error").alias("_e"), F.count_if(~F.col("is_error")).alias("_s"))
    last = buffer.groupBy("service", _evaluated(params)).agg(
        F.max_by(F.struct("p95_latency", "p99_latency"), F.col("rn")).alias("_b"))
    w = Window.partitionBy("service").orderBy("t")
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    end = F.timestamp_add("SECOND", F.lit(params.alert_step_seconds), per.select(F.max("t")).scalar())
    g = (per.join(last, ["service", "t"], "left")
         .withColumn("_ce", F.sum("_e").over(run)).withColumn("_cs", F.sum("_s").over(run))
         .withColumn("_lb", F.last("_b", ignorenulls=True).over(run)).withColumn("_next", F.lead("t").over(w)))
    return g.select("service", "t", F.coalesce("_next", end).alias("until"),
                    F.try_divide(F.col("_ce") * 100.0, F.col("_cs")).alias("error_rate"),
                    F.col("_lb.p95_latency").alias("p95_latency"), F.col("_lb.p99_latency").alias("p99_latency"))


def periods(cond: DataFrame, by: list[str]) -> DataFrame:
    """``by + (alert, active_from, active_until, value, for_s)``: the runs of active values without a break."""
    w = Window.partitionBy(*by, "alert").orderBy("t")
    x = cond.filter("active").withColumn("_new", F.when(F.lag("until").over(w) >= F.col("t"), 0).otherwise(1))
    x = x.withColumn("_period", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return x.groupBy(*by, "alert", "_period").agg(
        F.min("t").alias("active_from"), F.max("until").alias("active_until"),
        F.round(F.min_by("value", "t"), 6).alias("value"), F.max("for_s").alias("for_s")).drop("_period")


def with_firing(found: DataFrame, by: list[str], step_seconds: int) -> DataFrame:
    held = F.timestamp_diff("SECOND", F.col("active_from"), F.col("active_until")) - step_seconds
    firing = F.when(held >= F.col("for_s"), F.timestamp_add("SECOND", F.col("for_s"), F.col("active_from")))
    return found.select(*by, "alert", "active_from", "active_until", firing.alias("firing_from"), "value")


def alert_periods(cond: DataFrame, by: list[str], step_seconds: int) -> DataFrame:
    """The periods in which an alert's condition holds without a break.

    Input: ``by + (t, until, alert, value, active, for_s)``, a gauge value valid from ``t`` until ``until``.  A
    period ends with an inactive value and also where no value is valid.  The alert is *pending* from ``active_from``
    and *firing* from ``firing_from``, the evaluation at which it has held for ``for_s`` seconds (null if it never
    does); ``active_until`` is the first evaluation at which it doesn't hold, or the end of the observed range."""
    return with_firing(periods(cond, by), by, step_seconds)


def conditions(g: DataFrame, by: list[str], rules) -> DataFrame:
    cells = []
    for name, metric, op, thr, for_s in rules:
        v = F.col(metric).cast("double")
        active = (v > thr) if op == ">" else (v < thr)
        cells.append(F.struct(F.lit(name).alias("alert"), v.alias("value"),
                              F.coalesce(active, F.lit(False)).alias("active"), F.lit(for_s).alias("for_s")))
    return g.select(*by, "t", "until", F.inline(F.array(*cells)))


def threshold_alerts(gauges: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Periods of the latency and error-rate alerts per service."""
    return alert_periods(conditions(gauges, ["service"], THRESHOLD_ALERTS), ["service"], params.alert_step_seconds)


def distribution_gauges(ev: DataFrame, detections: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Per rate window: 25th-percentile confidence, number of predicted classes and PII detections per second
    (``detections``: ts, n).  A value is known at the window's end and valid for one window's length; a
    window without events has none."""
    width, seconds = params.rate_window, params.rate_window_seconds
    t = F.window("ts", width).end.alias("t")
    ok = ev.filter(~F.col("is_error")).withColumn("t", t)
    p25 = exact_percentiles(ok, ["t"], "confidence", [0.25]).withColumnRenamed("_q0", "confidence_p25")
    classes = ok.groupBy("t").agg(F.count_distinct("class_name").cast("double").alias("n_classes"))
    rate = detections.groupBy(t).agg((F.sum("n") / seconds).alias("pii_rate"))
    g = classes.join(p25, "t", "left").join(rate, "t", "full")
    return g.withColumn("until", F.timestamp_add("SECOND", F.lit(seconds), F.col("t")))


def distribution_alerts(ev: DataFrame, detections: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Low 25th-percentile confidence, too few predicted classes, high rate of PII detections."""
    g = distribution_gauges(ev, detections, params).withColumn("_all", F.lit("all"))
    return alert_periods(conditions(g, ["_all"], DISTRIBUTION_ALERTS), ["_all"], params.alert_step_seconds).drop("_all")


def source_silence(ev: DataFrame, gap_seconds: int = 60) -> DataFrame:
    """Gaps longer than ``gap_seconds`` between consecutive events of a
    service, and (``ongoing``) from its last event to the last event of all.
    A gap that long always crosses a minute boundary, so the
    scan is reduced to per-(service, minute) min/max first; the ordered
    window then runs over that small table, never over a service's rows."""
    per = ev.groupBy("service", F.window("ts", "1 minute").start.alias("_m")).agg(
        F.min("ts").alias("_first"), F.max("ts").alias("silence_start"))
    w = Window.partitionBy("service").orderBy("_m")
    x = per.withColumn("_next", F.lead("_first").over(w))
    x = x.withColumn("silence_end", F.coalesce("_next", ev.select(F.max("ts")).scalar()))
    gap = F.timestamp_diff("MICROSECOND", F.col("silence_start"), F.col("silence_end")) / 1e6
    return (x.withColumn("gap_seconds", F.round(gap, 6)).filter(F.col("gap_seconds") > gap_seconds)
            .select("service", "silence_start", "silence_end", "gap_seconds", F.isnull("_next").alias("ongoing")))


def consistency(pred: DataFrame, text: str = "text", p: str = "p") -> DataFrame:
    """Identical texts must get one class."""
    # keyed by a 32-byte digest of the text, not the text itself
    g = pred.groupBy(F.sha2(F.col(text), 256)).agg(F.count(F.lit(1)).alias("_n"), F.count_distinct(p).alias("_k"))
    g = g.filter(F.col("_n") > 1)
    return g.agg(F.count(F.lit(1)).alias("repeated_texts"), F.count_if(F.col("_k") == 1).alias("consistent"),
                 F.round(F.try_divide(F.count_if(F.col("_k") == 1) * 100.0, F.count(F.lit(1))), 6)
                 .alias("consistency_pct"))


def sla_check(ev: DataFrame) -> DataFrame:
    """Latency against the per-service SLA; warning above 1.5x."""
    sla = ev.sparkSession.createDataFrame(list(SLA_SECONDS), "service string, sla_s double")
    j = ev.filter(~F.col("is_error")).join(F.broadcast(sla), "service")  # 3 literal rows
    return j.groupBy("service", "sla_s").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("latency") > F.col("sla_s")).alias("over_sla"),
        F.count_if(F.col("latency") > F.col("sla_s") * SLA_WARN_FACTOR).alias("warnings"),
        F.round(F.avg((F.col("latency") <= F.col("sla_s")).cast("double")) * 100, 6).alias("within_sla_pct"))
