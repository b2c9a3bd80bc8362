"""Model helpers (M1-M9) and sinks (S3-S9) on the sf0.001 fixture."""

import math

import pytest
from pyspark.sql import functions as F

from deskspark.config import DEFAULT
from deskspark.operators import model as M
from deskspark.plans import prepare_q
from deskspark.sources import sinks
from tests.conftest import SF001


@pytest.fixture(scope="module")
def split(spark):
    sp = prepare_q.prepared_split(spark, SF001, reuse=True)
    return sp.filter(F.col("split") == "train"), sp.filter(F.col("split") == "test")


def test_calibrated_probabilities_and_roundtrip(spark, split, tmp_path):
    train, test = split
    fitted = M.fit_calibrated(train)
    pred = M.predict_calibrated(fitted, test)
    rows = pred.collect()
    assert len(rows) == test.count()
    for r in rows:
        probs = [p["prob"] for p in r["probabilities"]]
        assert abs(sum(probs) - 1) < 1e-9
        assert probs == sorted(probs, reverse=True)
        assert 0 <= r["confidence"] <= 1 and r["confidence"] == probs[0]
    sinks.save_calibrated(spark, fitted, str(tmp_path / "model"))
    again = M.predict_calibrated(sinks.load_calibrated(spark, str(tmp_path / "model")), test)
    a = {r["doc_id"]: r["predicted_class"] for r in rows}
    b = {r["doc_id"]: r["predicted_class"] for r in again.collect()}
    assert a == b


def test_softmax_rows(spark):
    df = spark.createDataFrame([(1, [1.0, 3.0, 2.0]), (2, [0.0, 0.0])], "id long, logits array<double>")
    r = {x["id"]: x for x in M.softmax_logits(df).collect()}
    assert r[1]["predicted"] == 1 and r[2]["predicted"] == 0
    assert sum(r[1]["probs"]) == pytest.approx(1.0)
    assert r[1]["confidence"] == pytest.approx(math.exp(3) / (math.exp(1) + math.exp(3) + math.exp(2)))


def test_search_space_is_seeded():
    a, b = M.search_space(5, 42), M.search_space(5, 42)
    assert a == b and len(a) == 5
    for p in a:
        assert 3000 <= p["max_features"] <= 7000 and 1 <= p["ngram_max"] <= 3 and 0.1 <= p["svm_c"] <= 10


def test_search_equals_cross_validation(spark, split):
    """Trials fitted together on shared statistics score what each scores alone."""
    small = DEFAULT.with_(cv_folds=2, calibration_folds=2, svm_tol=1e-5)
    runs = M.search(split[0], trials=3, params=small, together=2)
    assert [r["trial"] for r in runs] == [0, 1, 2]
    for r in (runs[0], runs[2]):
        own = small.with_(**{k: r[k] for k in ("max_features", "ngram_max", "min_df", "max_df", "svm_c")})
        assert r["score"] == pytest.approx(M.cv_weighted_f1(split[0], own), abs=1e-9)


def test_best_run_and_early_stop(spark):
    runs = spark.createDataFrame([(0, 0.80, 0.5), (1, 0.85, 0.4), (2, 0.83, 0.3)], "trial int, score double, loss double")
    assert M.best_run(runs).first()["trial"] == 1
    assert M.best_run(runs, "loss", minimize=True).first()["trial"] == 2
    log = spark.createDataFrame([(e, f) for e, f in enumerate([0.5, 0.6, 0.6, 0.6, 0.6, 0.6, 0.6, 0.61])],
                                "epoch int, f1 double")
    stops = [r["epoch"] for r in M.early_stop(log).filter("stop_here").orderBy("epoch").collect()]
    assert stops[0] == 6


def test_external_scorer(spark):
    df = spark.createDataFrame([(1, "a b c"), (2, "d")], "id long, text string")

    def fn(pdf):
        return pdf.assign(n=pdf["text"].str.split().str.len())[["id", "n"]]

    out = {r["id"]: r["n"] for r in M.score_external(df, fn, "id long, n long").collect()}
    assert out == {1: 3, 2: 1}


def test_sinks(spark, split, tmp_path):
    train, test = split
    sp = train.unionByName(test)
    sinks.write_splits(sp, str(tmp_path / "prep"))
    assert sinks.read_prepared(spark, str(tmp_path / "prep"), "test").count() == test.count()
    runs = spark.createDataFrame([("r1", "acc", 0.9), ("r1", "f1", 0.8)], "run_id string, key string, value double")
    sinks.append_runs(spark, runs, str(tmp_path / "runs"))
    again = spark.createDataFrame([("r1", "acc", 0.1), ("r2", "acc", 0.7)], "run_id string, key string, value double")
    log = sinks.append_runs(spark, again, str(tmp_path / "runs"))
    assert log.count() == 3 and log.filter("run_id = 'r1' AND key = 'acc'").first()["value"] == 0.9
    rep = sinks.write_report(spark, {"model_type": "svm", "metrics": {"accuracy": 0.5}, "classes": ["a"]},
                             str(tmp_path / "report"))
    assert rep.first()["metrics"]["accuracy"] == 0.5
