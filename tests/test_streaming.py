"""Streaming results against batch, and request-scoring invariants."""

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import __spark_entry__ as entry
from deskspark.config import DEFAULT
from deskspark.operators import langid
from deskspark.operators import monitor as O
from deskspark.operators.linear import Fit
from deskspark.sources import sinks
from deskspark.sources.tables import table
from deskspark.streaming import monitor as SM
from deskspark.streaming import requests as SR
from tests.conftest import SF001


def test_stream_alerts_do_not_depend_on_the_micro_batches(spark, tmp_path):
    """The events in one file, and in seven files by time, one per micro-batch: the same periods as in batch."""
    ev = table(spark, SF001, "events")
    end = ev.agg(F.max("ts")).first()[0]
    cut = F.ntile(7).over(Window.orderBy("ts", "event_id"))
    for i in range(1, 8):
        ev.withColumn("k", cut).filter(F.col("k") == i).drop("k").coalesce(1).write.mode("append").parquet(str(tmp_path / "parts"))
    one = SM.error_rate_alerts(SM.metric_stream(SM.file_stream(spark, f"{SF001}/events.parquet")))
    many = SM.error_rate_alerts(SM.metric_stream(SM.file_stream(spark, str(tmp_path / "parts"), max_files=1)))
    m = O.metric_events(ev)
    passed = m.filter(F.window("ts", "10 seconds").end <= F.lit(end) - F.expr("INTERVAL 10 MINUTES"))
    no_buffer = passed.select("service", "ts", F.lit(1).alias("rn"), F.lit(None).cast("double").alias("p95_latency"),
                              F.lit(None).cast("double").alias("p99_latency"))
    batch = O.threshold_alerts(O.service_gauges(passed, no_buffer))
    rows = lambda df: sorted(tuple(map(str, r)) for r in df.select(sorted(df.columns)).collect())
    assert rows(one) == rows(batch) and rows(many) == rows(batch)
    assert any(r["firing_from"] for r in one.collect())


def test_latency_alerts_and_silence_for_any_micro_batches_and_after_a_restart(spark, tmp_path):
    """One file; seven micro-batches; and four files, a stop, then three more: the same periods and gaps as in batch."""
    ev = table(spark, SF001, "events")
    end = ev.agg(F.max("ts")).first()[0]
    cut = F.ntile(7).over(Window.orderBy("ts", "event_id"))
    numbered = ev.withColumn("k", cut)

    def files(folder, ks):
        for i in ks:
            numbered.filter(F.col("k") == i).drop("k").coalesce(1).write.mode("append").parquet(str(tmp_path / folder))
        return str(tmp_path / folder)

    small = DEFAULT.with_(buffer_trim_above=60, buffer_keep=25)
    rules = [(n, m, op, {"p95_latency": 0.3, "p99_latency": 0.4}.get(m, thr), s) for n, m, op, thr, s in O.THRESHOLD_ALERTS]
    rows = lambda df: sorted(tuple(map(str, r)) for r in df.select(sorted(df.columns)).collect())
    m = O.metric_events(ev)
    late = F.lit(end) - F.expr("INTERVAL 10 MINUTES")
    passed = m.filter(F.window("ts", "10 seconds").end <= late)
    gauges = O.service_gauges(passed, O.rolling_buffer(passed, small), small)
    alerts = rows(O.alert_periods(O.conditions(gauges, ["service"], rules), ["service"], small.alert_step_seconds))
    gaps = rows(O.source_silence(m.filter(F.window("ts", "1 minute").end <= late)))
    assert len(alerts) > 3 and len(gaps) > 3
    seven = files("seven", range(1, 8))

    def stream(path, base=None):
        ev = SM.metric_stream(SM.file_stream(spark, path, max_files=1))
        return (rows(SM.stream_alerts(ev, rules, small, base=base and base + "/alerts")), rows(SM.source_silence(ev, base=base and base + "/silence")))

    assert stream(seven) == (alerts, gaps)
    base = str(tmp_path / "state")
    stream(files("late", range(1, 5)), base)
    assert stream(files("late", range(5, 8)), base) == (alerts, gaps)


def test_distribution_alerts_for_any_micro_batches_and_after_a_restart(spark, tmp_path):
    """One micro-batch, and five with a stop and a new start after the third: the periods of the batch query."""
    ev = table(spark, SF001, "events")
    end = ev.agg(F.max("ts")).first()[0]
    numbered = ev.withColumn("k", F.ntile(5).over(Window.orderBy("ts", "event_id"))).persist()
    found = ev.select("event_id", (F.col("event_id") % 4 * 400).alias("n")).filter("event_id % 3 = 0")
    found = found.unionByName(found.filter("event_id % 2 = 0"))
    rows = lambda df: sorted(tuple(map(str, r)) for r in df.select(sorted(df.columns)).collect())
    passed = O.metric_events(ev).filter(F.window("ts", "5 minutes").end <= F.lit(end) - F.expr("INTERVAL 10 MINUTES"))
    batch = rows(O.distribution_alerts(passed, passed.select("event_id", "ts").join(found, "event_id")))
    assert len(batch) > 3 and len({r[2] for r in batch}) > 1

    def stream(path, base=None):
        return rows(SM.distribution_alerts(SM.metric_stream(SM.file_stream(spark, path, max_files=1)), found, base=base))

    assert stream(f"{SF001}/events.parquet") == batch
    parts, base = str(tmp_path / "parts"), str(tmp_path / "base")
    for ks in ((1, 2, 3), (4, 5)):
        for k in ks:
            numbered.filter(F.col("k") == k).drop("k").coalesce(1).write.mode("append").parquet(parts)
        last = stream(parts, base)
    assert last == batch


def test_sketch_quantiles_of_one_large_group(spark):
    """30,000 rows in one window: the sketch is approximate there and its ranks stay within the stated error."""
    rows = spark.range(30_000).select(F.lit(False).alias("is_error"), F.lit("a").alias("service"), F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:01'").alias("ts"),
                                      (F.pmod(F.xxhash64("id"), F.lit(1 << 40)) / 7).alias("latency"))
    found = SM.latency_sketches(rows.withColumn("ts", SM.as_instant(F.col("ts"))))
    r = SM.rank_errors(found, rows).first()
    assert r["n"] == 30_000 and r["p95_error"] <= SM.RANK_ERROR and r["p99_error"] <= SM.RANK_ERROR
    wrong = found.withColumn("p95_latency", F.col("p99_latency"))
    assert SM.rank_errors(wrong, rows).first()["p95_error"] > SM.RANK_ERROR


def test_replayed_epoch_leaves_no_duplicates(spark, tmp_path):
    sink = SM.epoch_sink(lambda b, epoch: b, str(tmp_path))
    for epoch in (0, 1, 1):
        sink(spark.range(epoch * 10, epoch * 10 + 5), epoch)
    got = spark.read.parquet(str(tmp_path / "table"))
    assert sorted(r["id"] for r in got.collect()) == [0, 1, 2, 3, 4, 10, 11, 12, 13, 14]


def test_file_stream_takes_the_named_table_alone(spark, tmp_path):
    spark.range(3).coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    spark.range(50).coalesce(1).write.parquet(str(tmp_path / "events_old.parquet"))
    assert SM.run_available(SM.file_stream(spark, str(tmp_path / "events.parquet"))).count() == 3


def test_request_scoring_probabilities(spark):
    rows = entry.queries()["request_scoring"](spark, SF001).collect()
    assert rows
    for r in rows:
        probs = [p["prob"] for p in r["prediction_details"]["probabilities"]]
        assert abs(sum(probs) - 1) < 1e-9 and probs == sorted(probs, reverse=True)
        assert r["confidence"] == pytest.approx(probs[0])
        assert r["predicted_class"] == r["prediction_details"]["probabilities"][0]["label"]
        assert r["model_used"] in ("tfidf", "distilbert")


def test_stream_scoring_equals_batch(spark):
    s = entry.queries()["stream_request_scoring"](spark, SF001)
    b = entry.queries()["request_scoring"](spark, SF001)
    key = ["conv_id", "turn", "predicted_class", "model_used"]
    assert sorted(tuple(r) for r in s.select(*key).collect()) == sorted(tuple(r) for r in b.select(*key).collect())


REQUEST = "request_id string, ts timestamp, conv_id long, turn long, text string"


def _requests(spark, folder, ids, minute=0):
    """A file of requests by id, which arrive as one micro-batch."""
    rows = [(None if i is None else f"r{i}", i or 0, f"request number {i} about the printer") for i in ids]
    x = spark.createDataFrame(rows, "request_id string, conv_id long, text string")
    at = F.timestamp_seconds(F.lit(1_700_000_000 + 60 * minute))
    x.select("request_id", at.alias("ts"), "conv_id", F.lit(0).cast("long").alias("turn"), "text").coalesce(1).write.mode("append").parquet(folder)


def test_repeated_requests_pass_once(spark, tmp_path):
    """Repetitions in a file, in a later file and after a restart; requests without an id all pass; nothing at all from an empty file."""
    src, base = str(tmp_path / "src"), str(tmp_path / "base")

    def passed():
        stream = SR.once(spark.readStream.schema(REQUEST).option("maxFilesPerTrigger", 1).parquet(src))
        return sorted(r["request_id"] for r in SM.run_epochs(stream.writeStream, lambda b, e: b, base, spark).collect())

    for ids, minute in (([1, 2, 2, 2], 0), ([2, 3, None, None], 1), ([], 1)):
        _requests(spark, src, ids, minute)
    first = passed()
    assert first[:3] == ["r1", "r2", "r3"] and len(set(first)) == 5 and all(i.startswith("unnamed-") for i in first[3:])
    _requests(spark, src, [1, 4, 3], 2)
    assert [i for i in passed() if i.startswith("r")] == ["r1", "r2", "r3", "r4"]


def test_version_swapped_while_the_stream_runs(spark, tmp_path):
    """Version 2 answers from the epoch after its publication on; an unfinished version answers nothing; a replayed epoch keeps its version."""
    models, src, base = (str(tmp_path / x) for x in ("models", "src", "base"))
    fits = [Fit(["printer", "request"], [1.0, 1.0], np.array([[1.0, 0, 0], [-1.0, 0, 0]]), np.array([[1.0, 0.0], [1.0, 0.0]]))]
    train = spark.createDataFrame([("the printer is on fire", "en"), ("l imprimante est en feu", "fr")], "document string, topic_group string")
    fitted = langid.fit(train, text="document", label="topic_group")

    def serve():
        stream = SR.once(spark.readStream.schema(REQUEST).parquet(src))
        return {r["request_id"]: (r["model_version"], r["predicted_class"]) for r in SR.serve(stream, fitted, models, base=base).collect()}

    with pytest.raises(FileNotFoundError):
        sinks.newest_model(spark, models)
    assert sinks.publish_model(spark, fits, ["a", "b"], models) == 1
    _requests(spark, src, [1, 2])
    assert serve() == {"r1": (1, "a"), "r2": (1, "a")}
    assert sinks.publish_model(spark, fits, ["c", "d"], models) == 2
    sinks.save_calibrated(spark, fits, f"{models}/version=3/fits")
    _requests(spark, src, [2, 3])
    assert serve() == {"r1": (1, "a"), "r2": (1, "a"), "r3": (2, "c")}
    assert sinks.publish_model(spark, fits, ["e", "f"], models) == 4
    assert sinks.chosen_once(spark, f"{base}/versions/epoch=0", lambda: 4) == 1
