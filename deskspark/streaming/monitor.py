"""Monitoring aggregates over an event stream.

Sources are file streams (``readStream`` over Parquet); the metric columns
come from the same ``metric_events`` binding as the batch queries.  The
windowed aggregates use an event-time watermark, so their state is
dropped once a window can no longer change (append mode in production).
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from deskspark.config import DEFAULT, Params
from deskspark.operators import monitor as O
from deskspark.operators.common import exact_row_number
from deskspark.session import ensure_checkpoint_dir

WATERMARK = "10 minutes"


def _epoch_ntz() -> Column:
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")


def as_instant(c: Column) -> Column:
    """timestamp_ntz -> TIMESTAMP at the same UTC wall-clock (no session
    time-zone involved); watermarks need a TIMESTAMP column."""
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", _epoch_ntz(), c))


def as_ntz(c: Column) -> Column:
    return F.timestamp_add("MICROSECOND", F.unix_micros(c), _epoch_ntz())


def file_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Parquet file stream with the schema of what is already there.  The
    source takes folders and globs: a single-file table is named by a glob
    that only its own name matches."""
    r = spark.readStream.schema(spark.read.parquet(path).schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    if path.endswith(".parquet"):
        folder, name = path.rsplit("/", 1)
        r = r.option("basePath", folder)
        path = f"{folder}/{name[:-1]}[t]"
    return r.parquet(path)


def metric_stream(events: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    ev = O.metric_events(events).withColumn("ts", as_instant(F.col("ts")))
    return ev.withWatermark("ts", watermark)


def class_counts(ev: DataFrame, width: str = "5 minutes") -> DataFrame:
    """O2 per event-time window."""
    ok = ev.filter(~F.col("is_error"))
    g = ok.groupBy(F.window("ts", width).alias("w"), "service", "class_name")
    return g.agg(F.count(F.lit(1)).alias("n")).select(as_ntz(F.col("w.start")).alias("window_start"),
                                                     "service", "class_name", "n")


def request_rate(ev: DataFrame, width: str = "5 minutes", seconds: int = 300) -> DataFrame:
    """O11 per event-time window."""
    g = ev.groupBy(F.window("ts", width).alias("w"), "service")
    return g.agg(F.count(F.lit(1)).alias("n")).select(
        as_ntz(F.col("w.start")).alias("window_start"), "service", "n", F.round(F.col("n") / seconds, 6).alias("rate"))


def confidence_histogram(ev: DataFrame) -> DataFrame:
    """O3 as a running aggregate per service."""
    return O.cumulative_histogram(ev.filter(~F.col("is_error")), "confidence", O.CONFIDENCE_BUCKETS)


def latency_quantiles(ev: DataFrame, width: str = "1 hour", accuracy: int = 10000) -> DataFrame:
    """O8 per window with ``approx_percentile`` (bounded state, labelled as
    approximate)."""
    g = ev.filter(~F.col("is_error")).groupBy(F.window("ts", width).alias("w"), "service")
    q = F.percentile_approx("latency", [0.95, 0.99], accuracy)
    return g.agg(q.alias("_q")).select(as_ntz(F.col("w.start")).alias("window_start"), "service",
                                       F.col("_q")[0].alias("p95_latency_approx"),
                                       F.col("_q")[1].alias("p99_latency_approx"))


#: A KLL sketch of this size has a rank error under 0.003 with a probability of 0.99; ``RANK_ERROR`` is what is promised.
KLL_SIZE, RANK_ERROR = 2048, 0.01


def latency_sketches(ev: DataFrame, width: str = "1 hour") -> DataFrame:
    """O8 per window with a mergeable sketch as state, of a size that does not depend on the rows: P95 and P99 whose ranks are off by
    ``RANK_ERROR`` at most."""
    g = ev.filter(~F.col("is_error")).groupBy(F.window("ts", width).alias("w"), "service")
    found = g.agg(F.count("latency").alias("n"), F.kll_sketch_agg_double("latency", KLL_SIZE).alias("_k"))
    at = lambda q: F.kll_sketch_get_quantile_double("_k", F.lit(q))
    return found.select(as_ntz(F.col("w.start")).alias("window_start"), "service", "n", at(0.95).alias("p95_latency"), at(0.99).alias("p99_latency"))


def rank_errors(quantiles: DataFrame, ev: DataFrame, width: str = "1 hour") -> DataFrame:
    """By how much the true ranks of reported quantiles (window_start, service, n, p95_latency, p99_latency) miss 0.95 and 0.99 in the batch of
    all events: p95_error and p99_error, 0 where the rank lies between those of the next smaller and next larger value."""
    rows = ev.filter(~F.col("is_error")).select(F.window("ts", width).start.alias("window_start"), "service", "latency")
    x = rows.join(quantiles, ["window_start", "service"])
    parts = [f(F.col("latency"), F.col(c)).alias(f"{k}{i}") for i, c in enumerate(("p95_latency", "p99_latency"))
             for k, f in (("below", lambda a, b: F.count_if(a < b)), ("upto", lambda a, b: F.count_if(a <= b)))]
    miss = [F.greatest(F.col(f"below{i}") / F.col("n") - q, q - F.col(f"upto{i}") / F.col("n"), F.lit(0.0)).alias(c)
            for i, (q, c) in enumerate(((0.95, "p95_error"), (0.99, "p99_error")))]
    return x.groupBy("window_start", "service", "n").agg(*parts).select("window_start", "service", "n", *miss)


ERROR_RATE_RULES = [r for r in O.THRESHOLD_ALERTS if r[1] == "error_rate"]


def _open() -> Column:
    """The end of a period that has not ended."""
    return F.expr("TIMESTAMP_NTZ'9999-12-31 00:00:00'")


def evaluation_steps(ev: DataFrame, params: Params = DEFAULT, latencies: bool = False) -> DataFrame:
    """Errors and successes per service and evaluation step, on demand with the step's predictions; append mode gives each step
    once, when the watermark has passed it."""
    step = F.window("ts", f"{params.alert_step_seconds} seconds").alias("w")
    more = [F.collect_list(F.when(~F.col("is_error"), F.struct("ts", "event_id", "latency"))).alias("ok")] if latencies else []
    g = ev.groupBy(step, "service").agg(F.count_if("is_error").alias("e"), F.count_if(~F.col("is_error")).alias("s"), *more)
    return g.select("service", as_ntz(F.col("w.end")).alias("t"), "e", "s", *["ok"] * latencies)


def _buffered(steps: DataFrame, counts: DataFrame | None, held: DataFrame | None, params: Params):
    """P95 and P99 of the rolling buffer at the end of each step (service, t, ok), and the rows in the buffer after the last one.
    ``counts`` has the number of earlier predictions (service, s), ``held`` those still in the buffer (service, rn, ts, latency)."""
    fresh = steps.select("service", "t", F.inline("ok"))
    x = exact_row_number(fresh, ["service"], ["ts", "event_id"], F.col("t")).select("service", "t", "rn", "ts", "latency")
    if counts is not None:
        x = x.join(counts.select("service", F.col("s").alias("_s")), "service", "left").withColumn("rn", F.col("rn") + F.coalesce("_s", F.lit(0))).drop("_s")
    rows = x.withColumn("t", F.col("t")) if held is None else x.unionByName(held.withColumn("t", F.lit(None).cast("timestamp_ntz")))
    rows = rows.persist()
    values = O.buffer_values(rows.select("service", "rn", "ts", "latency"), params).join(x.select("service", "rn", "t"), ["service", "rn"])
    last = values.groupBy("service", "t").agg(F.max_by(F.struct("p95_latency", "p99_latency"), "rn").alias("b")).select("service", "t", "b.*")
    ends = rows.groupBy("service").agg(F.max("rn").alias("_n"))
    kept = rows.join(ends, "service").filter(F.col("rn") > F.col("_n") - O.buffer_size(F.col("_n"), params)).select("service", "rn", "ts", "latency")
    return last, kept, rows


def _advance(steps: DataFrame, counts: DataFrame | None, open_: DataFrame | None, rules):
    """One micro-batch of evaluation steps (service, t, e, s, p95_latency, p99_latency) after the state (``counts``: the same columns,
    up to its last step; ``open_``: the periods not ended).  Returns the new counts and all periods, those not ended with
    ``active_until`` = ``_open()``."""
    rows = steps if counts is None else steps.unionByName(counts)
    w = Window.partitionBy("service").orderBy("t")
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    gauges = [F.last(c, ignorenulls=True).over(run).alias(c) for c in ("p95_latency", "p99_latency")]
    g = rows.select("service", "t", F.coalesce(F.lead("t").over(w), _open()).alias("until"),
                    F.try_divide(F.sum("e").over(run) * 100.0, F.sum("s").over(run)).alias("error_rate"), *gauges)
    found = O.periods(O.conditions(g, ["service"], rules), ["service"])
    if counts is not None:
        # a period that starts with the state's own row goes on from before
        before = open_.join(counts.select("service", F.col("t").alias("_t")), "service").select(
            "service", "alert", F.col("_t").alias("active_from"), F.col("active_from").alias("_from"), F.col("value").alias("_value"))
        found = found.join(before, ["service", "alert", "active_from"], "left").select(
            "service", "alert", F.coalesce("_from", "active_from").alias("active_from"), "active_until",
            F.when(F.col("_from").isNull(), F.col("value")).otherwise(F.col("_value")).alias("value"), "for_s")
    held = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col("t"))).alias(c) for c in ("p95_latency", "p99_latency")]
    return rows.groupBy("service").agg(F.max("t").alias("t"), F.sum("e").alias("e"), F.sum("s").alias("s"), *held), found


def _epoch_tables(ev: DataFrame, name: str, base: str | None):
    """Folder of a stream's tables, and the path of one of them in one epoch: a replayed epoch overwrites its own."""
    base = base or ensure_checkpoint_dir(ev.sparkSession).rstrip("/") + f"/deskspark-streams/{name}-{uuid.uuid4().hex}"
    return base, lambda table, epoch: f"{base}/{table}/epoch={epoch}"


def _run(steps: DataFrame, sink, base: str) -> int | None:
    """Run the stream to the end of its source; the last epoch, if there was any."""
    q = (steps.writeStream.outputMode("append").trigger(availableNow=True)
         .option("checkpointLocation", f"{base}/_checkpoint").foreachBatch(sink).start())
    q.awaitTermination()
    return q.lastProgress["batchId"] if q.lastProgress else None


def stream_alerts(ev: DataFrame, rules, params: Params = DEFAULT, name: str = "alerts", base: str | None = None) -> DataFrame:
    """O16 + O18 on a stream: the periods of the alerts of ``rules``, equal to the batch query's over the steps that the
    watermark has passed, however the files fall into micro-batches.

    The state is written per epoch: one row of counts per service, its periods not yet ended and, for latency rules, the
    rows in its buffer (at most ``buffer_trim_above + 1``).  New predictions are numbered on from there and fall into the batch query's own epochs
    of the buffer, so a busy service is spread over tasks here too.  A stream started again on the same ``base`` folder goes on
    where it ended."""
    spark, latencies = ev.sparkSession, any(r[1] != "error_rate" for r in rules)
    base, part = _epoch_tables(ev, name, base)

    def sink(batch: DataFrame, epoch: int):
        s = batch.sparkSession
        counts = open_ = held = buffered = None
        if epoch:
            counts, open_ = (s.read.parquet(part(x, epoch - 1)) for x in ("counts", "open"))
            held = s.read.parquet(part("held", epoch - 1)) if latencies else None
        steps = batch.persist()
        if latencies:
            last, kept, buffered = _buffered(steps, counts, held, params)
            kept.write.mode("overwrite").parquet(part("held", epoch))
            rows = steps.drop("ok").join(last, ["service", "t"], "left")
        else:
            rows = steps.withColumns({c: F.lit(None).cast("double") for c in ("p95_latency", "p99_latency")})
        counts, found = _advance(rows, counts, open_, rules)
        counts.write.mode("overwrite").parquet(part("counts", epoch))
        found.filter(F.col("active_until") == _open()).write.mode("overwrite").parquet(part("open", epoch))
        found.filter(F.col("active_until") < _open()).write.mode("overwrite").parquet(part("ended", epoch))
        for x in (steps, buffered):
            if x is not None:
                x.unpersist()

    last = _run(evaluation_steps(ev, params, latencies), sink, base)
    if last is None:
        return spark.createDataFrame([], "service string, alert string, active_from timestamp_ntz, active_until timestamp_ntz, firing_from timestamp_ntz, value double")
    end = F.timestamp_add("SECOND", F.lit(params.alert_step_seconds),
                          spark.read.parquet(part("counts", last)).select(F.max("t")).scalar())
    still = spark.read.parquet(part("open", last)).withColumn("active_until", end)
    ended = spark.read.parquet(f"{base}/ended").drop("epoch")
    return O.with_firing(ended.unionByName(still), ["service"], params.alert_step_seconds)


def error_rate_alerts(ev: DataFrame, params: Params = DEFAULT, name: str = "alerts") -> DataFrame:
    """O18 on a stream: the error-rate alerts alone, without a buffer of latencies."""
    return stream_alerts(ev, ERROR_RATE_RULES, params, name)


def source_silence(ev: DataFrame, gap_seconds: int = 60, width: str = "1 minute", name: str = "silence", base: str | None = None) -> DataFrame:
    """O19 on a stream: the gaps of the batch query over the minutes that the watermark has passed, those still going on included.

    A minute of a service is one row; the state is the last event per service.  A service with nothing new is looked at in every
    micro-batch all the same, so its silence is reported (table ``silent`` of the epoch) once the others have moved on by the gap."""
    spark = ev.sparkSession
    base, part = _epoch_tables(ev, name, base)
    minutes = ev.groupBy(F.window("ts", width).alias("w"), "service").agg(F.min("ts").alias("first"), F.max("ts").alias("last"))
    minutes = minutes.select("service", as_ntz(F.col("first")).alias("first"), as_ntz(F.col("last")).alias("last"))
    seconds = lambda a, b: F.round(F.timestamp_diff("MICROSECOND", a, b) / 1e6, 6)

    def gaps(rows: DataFrame) -> DataFrame:
        w = Window.partitionBy("service").orderBy("first")
        return rows.select("service", F.col("last").alias("silence_start"), F.lead("first").over(w).alias("silence_end"))

    def going_on(seen: DataFrame) -> DataFrame:
        end = seen.select(F.max("last").alias("silence_end"))  # one row
        return (seen.select("service", F.col("last").alias("silence_start")).crossJoin(F.broadcast(end))
                .withColumn("gap_seconds", seconds(F.col("silence_start"), F.col("silence_end"))).filter(F.col("gap_seconds") > gap_seconds))

    def sink(batch: DataFrame, epoch: int):
        s = batch.sparkSession
        rows = batch.persist()
        if epoch:
            rows = rows.unionByName(s.read.parquet(part("seen", epoch - 1)))
        ended = gaps(rows).filter("silence_end IS NOT NULL").withColumn("gap_seconds", seconds(F.col("silence_start"), F.col("silence_end")))
        ended.filter(F.col("gap_seconds") > gap_seconds).write.mode("overwrite").parquet(part("ended", epoch))
        seen = rows.groupBy("service").agg(F.max("first").alias("first"), F.max("last").alias("last"))
        seen.write.mode("overwrite").parquet(part("seen", epoch))
        going_on(s.read.parquet(part("seen", epoch))).write.mode("overwrite").parquet(part("silent", epoch))
        batch.unpersist()

    last = _run(minutes, sink, base)
    if last is None:
        return spark.createDataFrame([], "service string, silence_start timestamp_ntz, silence_end timestamp_ntz, gap_seconds double, ongoing boolean")
    ended = spark.read.parquet(f"{base}/ended").drop("epoch").withColumn("ongoing", F.lit(False))
    return ended.unionByName(spark.read.parquet(part("silent", last)).withColumn("ongoing", F.lit(True)))


def distribution_gauges(ev: DataFrame, detections: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """The batch query's gauges per rate window, once the watermark has passed it.  ``detections`` (event_id, n) is a table of what was found
    in the requests.  A window's state: its distinct confidences (their exact percentile, null without predictions) and classes, and a sum."""
    found = detections.groupBy("event_id").agg(F.sum("n").alias("_n"))
    ok = ~F.col("is_error")
    g = ev.join(found, "event_id", "left").groupBy(F.window("ts", params.rate_window).alias("w")).agg(
        F.percentile(F.when(ok, F.col("confidence")), F.lit(0.25)).alias("confidence_p25"), F.count_if(ok).alias("_ok"),
        F.size(F.collect_set(F.when(ok, F.col("class_name")))).cast("double").alias("_classes"),
        (F.sum("_n") / params.rate_window_seconds).alias("pii_rate"))
    t, seconds = as_ntz(F.col("w.end")), F.lit(params.rate_window_seconds)
    return g.select(t.alias("t"), F.timestamp_add("SECOND", seconds, t).alias("until"), "confidence_p25",
                    F.when(F.col("_ok") > 0, F.col("_classes")).alias("n_classes"), "pii_rate")


def distribution_alerts(ev: DataFrame, detections: DataFrame, rules=O.DISTRIBUTION_ALERTS, params: Params = DEFAULT, name: str = "distribution",
                        base: str | None = None) -> DataFrame:
    """O17 on a stream: the periods of the batch query over the rate windows that the watermark has passed.

    The stream writes one row per window, by epoch (a replayed epoch overwrites its own); the periods are found over these rows, 288 a day,
    so they don't depend on the micro-batches.  A stream started again on the same ``base`` folder adds to them."""
    spark = ev.sparkSession
    base = base or ensure_checkpoint_dir(spark).rstrip("/") + f"/deskspark-streams/{name}-{uuid.uuid4().hex}"
    writer = distribution_gauges(ev, detections, params).writeStream.outputMode("append")
    g = run_epochs(writer, lambda batch, epoch: batch, base, spark).withColumn("_all", F.lit("all"))
    return O.alert_periods(O.conditions(g, ["_all"], rules), ["_all"], params.alert_step_seconds).drop("_all")


def run_available(df: DataFrame, mode: str = "append", name: str = "stream") -> DataFrame:
    """Process everything currently in the source (``availableNow``) into a
    Parquet table under the checkpoint folder and return that table."""
    base = ensure_checkpoint_dir(df.sparkSession).rstrip("/") + f"/deskspark-streams/{name}-{uuid.uuid4().hex}"
    return run_epochs(df.writeStream.outputMode(mode), lambda batch, epoch: batch, base, df.sparkSession, last_only=mode == "complete")


def epoch_sink(transform, base: str):
    """A ``foreachBatch`` function that writes ``transform(batch, epoch)`` to a folder of the epoch: a replayed epoch replaces its output."""
    def sink(batch: DataFrame, epoch: int):
        transform(batch, epoch).write.mode("overwrite").parquet(f"{base}/table/epoch={epoch}")
    return sink


def run_epochs(writer, transform, base: str, spark: SparkSession, last_only: bool = False) -> DataFrame:
    """Run the stream to the end of its source; all epochs' rows, or those of the last one (complete mode)."""
    q = (writer.trigger(availableNow=True).option("checkpointLocation", f"{base}/_checkpoint")
         .foreachBatch(epoch_sink(transform, base)).start())
    q.awaitTermination()
    table = spark.read.parquet(f"{base}/table")
    if last_only:
        table = table.filter(F.col("epoch") == table.select(F.max("epoch")).scalar())
    return table.drop("epoch")
