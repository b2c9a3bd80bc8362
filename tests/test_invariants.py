"""Plan helpers against brute force, and invariants of the preparation."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from deskspark.operators import common as C
from deskspark.operators import prepare as P
from deskspark.plans import prepare_q
from tests.conftest import SF001


def test_quota_split_matches_row_number(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "lang")
    keyed = docs.withColumn("k", C.order_key("doc_id", "7"))
    quota = keyed.groupBy("lang").agg(F.floor(F.count(F.lit(1)) * 3 / 10).cast("long").alias("quota"))
    got = C.quota_split(keyed, ["lang"], "k", "doc_id", quota, "first", hex_digits=1)
    w = Window.partitionBy("lang").orderBy("k", "doc_id")
    brute = keyed.join(quota, "lang").withColumn("first", F.row_number().over(w) <= F.col("quota"))
    a = {(r["doc_id"], r["first"]) for r in got.select("doc_id", "first").collect()}
    b = {(r["doc_id"], r["first"]) for r in brute.select("doc_id", "first").collect()}
    assert a == b and len(a) == docs.count()


def test_exact_row_number_matches_window(spark):
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    got = C.exact_row_number(ev, ["event_type"], ["ts", "event_id"], F.window("ts", "1 hour").start)
    w = Window.partitionBy("event_type").orderBy("ts", "event_id")
    brute = ev.withColumn("rn", F.row_number().over(w).cast("long"))
    assert ({tuple(r) for r in got.select("event_id", "rn").collect()} ==
            {tuple(r) for r in brute.select("event_id", "rn").collect()})


def test_split_disjoint_complete_and_sized(spark):
    sp = prepare_q.prepared_split(spark, SF001)
    n = sp.count()
    assert sp.select("doc_id").distinct().count() == n
    n_test = sp.filter(F.col("split") == "test").count()
    assert n_test == -(-n * 2 // 10)


def test_funnel_stages_sum(spark):
    f = prepare_q.row_funnel(spark, SF001).first()
    assert (f["removed_missing"] + f["removed_short"] + f["removed_duplicates"] + f["final_samples"]
            == f["total_samples"])
    assert f["train_samples"] + f["test_samples"] == f["final_samples"]


def test_dedup_keeps_first(spark):
    df = spark.createDataFrame([(3, "Same text here!", "a"), (1, "same TEXT here", "b"), (2, "other text x", "a")],
                               "doc_id long, document string, topic_group string")
    out = P.dedup_first(P.with_clean_text(df))
    assert sorted((r["doc_id"], r["topic_group"]) for r in out.collect()) == [(1, "b"), (2, "a")]


def test_required_columns(spark):
    import pytest

    from deskspark.sources.tables import require_columns

    with pytest.raises(ValueError):
        require_columns(spark.createDataFrame([("x",)], "Document string"))


def test_exact_percentiles_match_numpy(spark):
    import numpy as np

    from deskspark.operators.common import exact_percentiles

    rng = np.random.default_rng(3)
    groups = {"hot": rng.lognormal(size=60_000), "ties": rng.integers(0, 3, 500).astype(float), "two": np.array([1.0, 5.0]),
              "one": np.array([2.5]), None: rng.normal(size=37)}
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs] + [("two", None), ("none", None)]
    qs = [0.0, 0.25, 0.5, 0.95, 0.99, 1.0]
    got = {r["g"]: r for r in exact_percentiles(spark.createDataFrame(rows, "g string, v double"), ["g"], "v", qs, 1000).collect()}
    assert got.keys() == groups.keys()
    for g, vs in groups.items():
        assert [got[g][f"_q{i}"] for i in range(len(qs))] == [__import__("pytest").approx(x) for x in np.quantile(vs, qs)]


def _alert_periods(spark, rows):
    import datetime as dt

    from deskspark.operators import monitor as O

    t0 = dt.datetime(2024, 1, 1)
    at = lambda s: t0 + dt.timedelta(seconds=s)
    cond = spark.createDataFrame([("a", at(f), at(u), "A", 1.0, on, 120) for f, u, on in rows],
                                 "service string, t timestamp_ntz, until timestamp_ntz, alert string, value double, active boolean, for_s int")
    sec = lambda x: None if x is None else int((x - t0).total_seconds())
    return sorted((sec(r["active_from"]), sec(r["active_until"]), sec(r["firing_from"]))
                  for r in O.alert_periods(cond, ["service"], 10).collect())


def test_alert_fires_within_the_hour(spark):
    assert _alert_periods(spark, [(0, 60, True), (60, 200, True), (200, 230, False), (230, 300, True)]) == [(0, 200, 120), (230, 300, None)]


def test_alert_needs_the_evaluation_at_for(spark):
    assert _alert_periods(spark, [(0, 120, True)]) == [(0, 120, None)]
    assert _alert_periods(spark, [(0, 130, True)]) == [(0, 130, 120)]


def test_outage_breaks_an_alert(spark):
    assert _alert_periods(spark, [(0, 100, True), (18000, 18100, True)]) == [(0, 100, None), (18000, 18100, None)]


def test_high_pii_rate_fires(spark):
    import datetime as dt

    from deskspark.operators import monitor as O

    t0 = dt.datetime(2024, 1, 1)
    ev = spark.createDataFrame([(t0, False, 0.9, "a")], "ts timestamp_ntz, is_error boolean, confidence double, class_name string")
    found = spark.createDataFrame([(t0 + dt.timedelta(seconds=s), 3001) for s in (0, 310)], "ts timestamp_ntz, n int")
    got = {r["alert"]: r for r in O.distribution_alerts(ev, found).collect()}
    assert (got["HighPIIDetected"]["firing_from"] - t0).total_seconds() == 300 + 120
    assert got["HighPIIDetected"]["active_until"] - t0 == dt.timedelta(seconds=900)


def test_source_still_silent_is_reported(spark):
    import datetime as dt

    from deskspark.operators import monitor as O

    t0 = dt.datetime(2024, 1, 1)
    rows = [("a", t0), ("b", t0), ("b", t0 + dt.timedelta(seconds=50)), ("b", t0 + dt.timedelta(seconds=100))]
    got = O.source_silence(spark.createDataFrame(rows, "service string, ts timestamp_ntz")).collect()
    assert [(r["service"], r["gap_seconds"], r["ongoing"]) for r in got] == [("a", 100.0, True)]
