"""V2 / V3 applied to the published confusion matrices must reproduce the
published classification reports (an independent check of the evaluation
operators)."""

import pytest

from deskspark.operators import evaluate as V

# ---------------------------------------------------------------------------
# Published 8-class confusion matrices (rows = actual) and the
# published macro / weighted averages and accuracy for each model.
# ---------------------------------------------------------------------------
CLASSES = ["Access", "Administrative rights", "HR Support", "Hardware", "Internal Project",
           "Miscellaneous", "Purchase", "Storage"]
TFIDF_MATRIX = [
    [1268, 7, 30, 77, 6, 32, 1, 4],
    [8, 244, 12, 75, 1, 11, 1, 0],
    [26, 5, 1893, 178, 14, 59, 0, 8],
    [67, 31, 113, 2393, 9, 86, 13, 11],
    [4, 0, 24, 27, 360, 9, 0, 0],
    [28, 4, 82, 132, 7, 1147, 3, 9],
    [3, 4, 5, 32, 1, 7, 439, 2],
    [3, 2, 23, 32, 0, 11, 0, 484],
]
TRANSFORMER_MATRIX = [
    [1323, 5, 24, 47, 3, 17, 1, 5],
    [7, 275, 9, 48, 1, 10, 1, 1],
    [37, 4, 1941, 106, 13, 67, 3, 12],
    [81, 38, 123, 2318, 16, 102, 18, 27],
    [8, 2, 17, 12, 369, 14, 1, 1],
    [39, 8, 50, 75, 5, 1217, 3, 15],
    [1, 4, 4, 25, 3, 6, 448, 2],
    [4, 3, 22, 23, 0, 11, 0, 492],
]
PUBLISHED = {
    "tfidf": {"accuracy": 0.8600397198703877,
              "macro": (0.8805299703532856, 0.8441112449763041, 0.8610289943264098),
              "weighted": (0.8617029962273084, 0.8600397198703877, 0.8600840974402792)},
    "transformer": {"accuracy": 0.8762412459496185,
                    "macro": (0.8781689522630973, 0.8721838812660634, 0.8749641879290327),
                    "weighted": (0.8763524022734023, 0.8762412459496185, 0.8761135273229805)},
}


def _confusion(spark, m):
    rows = [(CLASSES[i], CLASSES[j], m[i][j]) for i in range(8) for j in range(8)]
    return spark.createDataFrame(rows, "actual string, predicted string, n long")


@pytest.mark.parametrize("name,matrix", [("tfidf", TFIDF_MATRIX), ("transformer", TRANSFORMER_MATRIX)])
def test_published_reports(spark, name, matrix):
    conf = _confusion(spark, matrix)
    avg = {r["average"]: r for r in V.averages(V.per_class(conf)).collect()}
    exp = PUBLISHED[name]
    for kind in ("macro", "weighted"):
        got = (avg[kind]["precision"], avg[kind]["recall"], avg[kind]["f1"])
        assert got == pytest.approx(exp[kind], abs=1e-6)
    assert avg["micro"]["precision"] == pytest.approx(exp["accuracy"], abs=1e-6)
    assert avg["macro"]["support"] == 9567


def test_confused_pairs_row_normalised(spark):
    conf = _confusion(spark, TFIDF_MATRIX)
    pairs = {(r["actual"], r["predicted"]): r["pct"] for r in V.confused_pairs(conf).collect()}
    assert pairs[("Administrative rights", "Hardware")] == pytest.approx(75 / 352 * 100, abs=1e-6)
    assert all(v > 5 for v in pairs.values())


def test_zero_division_gives_zero(spark):
    pred = spark.createDataFrame([("a", "a"), ("a", "a"), ("b", "a")], "y string, p string")
    pc = {r["class"]: r for r in V.per_class(V.confusion(pred)).collect()}
    assert pc["b"]["precision"] == 0.0 and pc["b"]["recall"] == 0.0 and pc["b"]["f1"] == 0.0
