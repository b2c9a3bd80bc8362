"""The steps that were changed to grow with the input alone: what they send, hold and count, against plain definitions."""

import collections
import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from deskspark.config import DEFAULT
from deskspark.functions import text as X
from deskspark.operators import langid, linear
from deskspark.operators import model as M
from deskspark.operators import tfidf as T

ODD = ["a@ b", "@x y", "@@x y", "x@y@z q", "www. www.x http:/ https://a b http://", "abc-12 abcdefg-1 é-12 _ab-1 a-1b a-1-2",
       "123456 a123456 123456_ 12345 1234567-8", "-123456-", "123456.789012 x", "６123456 12345６", "a b c\x1cd\x0be", "École straße œuvre",
       "", None, "   ", "a\x85b", "foo--bar 1234567", "İstanbul KK", "tab\t123456\n123456 9", "x_y Zz z"]


def test_cleaning_equals_its_steps_in_order(spark):
    docs = spark.createDataFrame([(t,) for t in ODD], "t string")
    plain = F.lower(X._transliterated(F.coalesce(F.col("t"), F.lit(""))))
    for r in docs.select("t", X.clean_text(F.col("t")).alias("a"), X._cleaned(plain).alias("b")).collect():
        assert r["a"] == r["b"], r["t"]
    terms = T.analyze(docs.filter("t IS NOT NULL"), "t", stop_words=False, ngram_max=1)
    for r in terms.withColumn("all", F.regexp_extract_all(X._transliterated(F.lower("t")), F.lit(T.TOKEN), 0)).collect():
        assert r["terms"] == r["all"], r["t"]


def test_a_long_token_is_cleaned_in_linear_time(spark):
    """A token of 300,000 characters without the end of an address; from every character on it was read to its end."""
    docs = spark.createDataFrame([("x" * 300_000 + "@ ends",)], "t string")
    assert docs.select(F.length(X.clean_text(F.col("t")))).first()[0] == 300_005


def test_partial_counts_add_up(spark, monkeypatch):
    monkeypatch.setattr(T, "COUNT_TERMS", 7)
    lists = [["a", "b", "a"], [], None, ["a b", "c"] * 5, ["b"], ["a"] * 20]
    docs = spark.createDataFrame([(i % 2, t) for i, t in enumerate(lists)], "group int, terms array<string>")
    want = collections.defaultdict(lambda: [0, 0])
    for i, t in enumerate(lists):
        for term, n in collections.Counter(t or []).items():
            want[term, i % 2][0] += 1
            want[term, i % 2][1] += n
    found = T.partial_stats(docs, "group").groupBy("term", "group").agg(F.sum("df"), F.sum("cf")).collect()
    assert {(r[0], r[1]): [r[2], r[3]] for r in found} == want


def test_trigram_sums_in_pieces_equal_the_definition(spark, monkeypatch):
    monkeypatch.setattr(langid, "SLICE_BYTES", 5)
    texts = ["abc abc", "", None, "ßÿé ab", "x", "zzzzzz", "abc"]
    docs = spark.createDataFrame([(t, "l" if i % 2 else "m") for i, t in enumerate(texts)], "document string, topic_group string")
    fitted = langid.fit(docs)
    plain = {r["document"]: r["n"] for r in docs.withColumn("n", langid.normalized("document")).collect()}
    grams = {t: [n[i:i + 3] for i in range(len(n) - 2)] if n is not None else None for t, n in plain.items()}
    counts = collections.Counter((g, l) for t, l in docs.collect() for g in grams[t] or [])
    assert set(fitted.grams) == {g for g, _ in counts}
    for r in docs.withColumn("s", langid.gram_sums(langid.normalized("document"), fitted)).collect():
        known = [fitted.grams.index(g) for g in grams[r["document"]] or []]
        if not known:
            assert r["s"] is None
        else:
            assert r["s"] == pytest.approx(list(fitted.priors + fitted.weights[known].sum(0)))


def test_slices_hold_few_terms():
    column = pa.array([["a"] * 4, None, [], ["b"] * 9, ["c"], ["d"]], pa.list_(pa.string()))
    parts = [(begin, part.to_pylist()) for begin, part in linear.slices(column, 5)]
    assert [p for _, part in parts for p in part] == column.to_pylist()
    assert [begin for begin, _ in parts] == [0, 3, 4]


def _rows(spark, n):
    rnd, words = random.Random(3), ["red", "green", "blue", "wide", "tall"]
    rows = [(i % 2, i % 3, [rnd.choice(words[i % 2:3 + i % 2 * 2]) for _ in range(4)]) for i in range(n)]
    return spark.createDataFrame(rows, "label int, group int, terms array<string>").repartition(40)


def test_solver_partitions_do_not_grow_with_the_rows(spark):
    """A job sends a partial sum per partition; they are as many as cores, and rows are kept once for all fits."""
    docs = _rows(spark, 400)
    shared = linear.union([["red", "wide"], ["blue", "red"]], [[1.0, 2.0], [1.5, 1.0]])
    rdd = linear.blocks(docs, shared)
    assert rdd.getNumPartitions() == max(spark.sparkContext.defaultParallelism, 2)
    assert rdd.map(lambda b: len(b.label)).sum() == 400
    rdd.unpersist()


def test_solver_finds_the_optimum_of_every_fit(spark):
    """Gradients at the weights, from dense matrices of the definition."""
    docs, train = _rows(spark, 60), [{0, 1}, {1, 2}]
    params = DEFAULT.with_(min_df=1, max_df=1.0, svm_tol=1e-4)
    fits = M.fit_together(docs, train, None, params)
    rows = docs.collect()
    for fit, groups in zip(fits, train):
        own = [r for r in rows if r["group"] in groups]
        assert fit.vocabulary == sorted({t for r in own for t in r["terms"]})
        tf = np.array([[r["terms"].count(t) for t in fit.vocabulary] for r in own], float)
        idf = np.log((1 + len(own)) / (1 + (tf > 0).sum(0))) + 1
        x = tf * idf
        x = np.hstack([x / np.sqrt((x * x).sum(1, keepdims=True)), np.ones((len(own), 1))])
        for j, w in enumerate(fit.coef):
            y = np.array([1.0 if r["label"] == j else -1.0 for r in own])
            gradient = w - 2 * params.svm_c * x.T @ (y * np.maximum(1 - y * (x @ w), 0))
            first = 2 * params.svm_c * x.T @ y
            assert np.linalg.norm(gradient) <= 1.01e-4 * np.linalg.norm(first) and math.isfinite(w.sum())
