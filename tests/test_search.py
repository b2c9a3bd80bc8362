"""M6: the search's rows are scores of fits alone, and its statistics the plain counts."""

import collections

import numpy as np
import pyarrow as pa
import pytest

from deskspark.config import DEFAULT
from deskspark.operators import linear
from deskspark.operators import model as M
from deskspark.operators import tfidf as T
from deskspark.plans import prepare_q
from tests.conftest import SF001

WORDS = ["printer", "paper", "toner", "network", "router", "cable", "invoice", "payment", "refund"]


@pytest.fixture(scope="module")
def tickets(spark):
    """Three classes with words of their own, each text also with one of another class."""
    rows = [(i, " ".join(WORDS[3 * (i % 3) + (i // 3 + j) % 3] for j in range(4)) + " " + WORDS[(i * 5) % 9], i % 3) for i in range(90)]
    return spark.createDataFrame(rows, "doc_id long, document_clean string, topic_encoded int")


SMALL = DEFAULT.with_(cv_folds=2, calibration_folds=2)


def test_failed_trial_fails_the_search(tickets, monkeypatch):
    """A trial that can't be fitted has no score; the search must not go on to name a best run."""
    whole = M.cv_scores

    def failing(docs, trials, stats=None):
        if any(p.svm_c == bad for p in trials):
            raise OSError("no space left on device")
        return whole(docs, trials, stats)

    bad = M.search_space(2, SMALL.seed)[1]["svm_c"]
    monkeypatch.setattr(M, "cv_scores", failing)
    with pytest.raises(OSError, match="no space"):
        M.search(tickets, trials=2, params=SMALL, together=2)


def test_batch_that_fails_is_tried_trial_by_trial(tickets, monkeypatch):
    whole = M.cv_scores

    def failing(docs, trials, stats=None):
        if len(trials) > 1:
            raise MemoryError("too many at once")
        return whole(docs, trials, stats)

    together = M.search(tickets, trials=2, params=SMALL, together=2)
    monkeypatch.setattr(M, "cv_scores", failing)
    alone = M.search(tickets, trials=2, params=SMALL, together=2)
    assert [r["score"] for r in alone] == pytest.approx([r["score"] for r in together]) and min(r["score"] for r in alone) > 0


ODD = [["a", "b", "a", "b", "c"], [], None, ["x"], ["b", "c", "a", "b"] * 3, ["a", "ünï", "a"], ["c"], ["x", "y", "z", "w"], ["a", None, "b", "c"]]


def _plain(lists, low, high):
    """Per group and n-gram the documents and occurrences, by definition."""
    grams = lambda t, n: [" ".join(t[i:i + n]) for i in range(len(t) - n + 1) if None not in t[i:i + n]]
    out = collections.defaultdict(lambda: [0, 0])
    for i, t in enumerate(lists):
        for g, c in collections.Counter(x for n in range(low, high + 1) for x in grams(t or [], n)).items():
            out[g, i % 3][0] += 1
            out[g, i % 3][1] += c
    return out


@pytest.mark.parametrize("sample", [2, 1000])
@pytest.mark.parametrize("buckets", [3, 1 << 12])
def test_pruned_counts_give_every_vocabulary(spark, monkeypatch, buckets, sample):
    """What a fit chooses from the pruned counts is what it chooses from all of them, whatever the sample and the buckets."""
    monkeypatch.setattr(linear, "SLICE_TERMS", 9)
    monkeypatch.setattr(T, "STRIDE", 1 << 10)
    lists = ODD * 5 + [["r%d" % i, "s%d" % i, "r%d" % i] for i in range(40)]
    docs = spark.createDataFrame([(i % 3, t) for i, t in enumerate(lists)], "group int, tokens array<string>").repartition(5)
    rows_in = collections.Counter(i % 3 for i in range(len(lists)))
    fits = [({0, 1}, DEFAULT.with_(max_features=3, min_df=2)), ({1, 2}, DEFAULT.with_(max_features=4, ngram_max=3, min_df=1, max_df=1.0)),
            ({0, 2}, DEFAULT.with_(max_features=2, ngram_max=1, max_df=0.6))]
    found = T.group_counts(docs, rows_in, fits, buckets, sample)
    own, want = {r["term"]: r.asDict() for r in found.collect()}, _plain(lists, 1, 3)
    for t, r in own.items():
        assert [r[f"{c}{g}"] for g in range(3) for c in ("df", "cf")] == [x for g in range(3) for x in want.get((t, g), [0, 0])], t
        assert r["words"] == len(t.split(" "))
    whole = spark.createDataFrame([(t, len(t.split(" ")), *(x for g in range(3) for x in want.get((t, g), [0, 0]))) for t in {t for t, _ in want}],
                                  "term string, words int, df0 long, cf0 long, df1 long, cf1 long, df2 long, cf2 long")
    train, each = [g for g, _ in fits], [p for _, p in fits]
    assert M.vocabularies(found, rows_in, train, each) == M.vocabularies(whole, rows_in, train, each)
    if buckets > 3 and sample > len(lists):  # a sample of two may have no candidates, and then nothing is left out
        assert len(own) < len({t for t, _ in want}) / 2  # terms that no fit can choose aren't sent


def test_entries_from_tokens_equal_those_from_terms():
    words = sorted({"a", "b", "a b", "b a b", "c a", "ünï a", "x y z", "z w", "a b a b c"})
    tokens = pa.array(ODD, pa.list_(pa.string()))
    grams = [[" ".join(t[i:i + n]) for n in range(1, 6) for i in range(len(t) - n + 1) if None not in t[i:i + n]] if t else t for t in ODD]
    rank = np.arange(len(ODD))[::-1].copy()
    got = linear.gram_entries(tokens, linear.book(words, False), len(words), rank)
    want = linear.counted_entries(pa.array(grams, pa.list_(pa.string())), pa.array(words), rank)
    for a, b in zip(got, want):
        assert a.tolist() == b.tolist()
    assert len(linear.gram_entries(pa.array([[], None], pa.list_(pa.string())), linear.book([], False), 1, np.arange(2))[0]) == 0


@pytest.mark.parametrize("entries", [1, 1 << 18])
def test_sums_of_blocks_equal_dense_ones(spark, monkeypatch, entries):
    """By row and by place, of one column and of two, also for rows without a known term; rows are put together by group."""
    monkeypatch.setattr(linear, "BLOCK_ENTRIES", entries)
    lists = [["a", "b", "a"], [], None, ["none"], ["b"] * 300, ["c", "a"]] * 4
    docs = spark.createDataFrame([(i % 2, i % 3, t) for i, t in enumerate(lists)], "label int, group int, tokens array<string>")
    shared = linear.union([["a", "a b", "b"], ["b", "b b", "c"]], [[1.0, 2.0, 1.5], [1.0, 3.0, 0.5]])
    rdd = linear.blocks(docs, shared)
    found, width = rdd.collect(), len(shared.words)
    rdd.unpersist()
    assert sorted((b.group, l) for b in found for l in b.label) == sorted((i % 3, i % 2) for i in range(len(lists)))
    rnd = np.random.default_rng(0)
    for b in found:
        dense = np.zeros((len(b.counts), width))
        dense[np.repeat(np.arange(len(b.counts)), b.counts), b.place] = b.tf
        x, y = rnd.normal(size=(2, width)), rnd.normal(size=(2, len(dense)))
        e = linear.Entries(b)
        for n in (1, 2):
            assert np.allclose(linear.apart(e.by_row(linear.paired(list(x[:n])))), dense @ x[:n].T)
            out = linear.paired(list(np.zeros((n, width))))
            e.add_by_place(out, linear.paired(list(y[:n])))
            assert np.allclose(linear.apart(out), dense.T @ y[:n].T)
    if entries > 1:
        assert len(found) <= 3 * rdd.getNumPartitions()


def test_certificate_equals_dense_gradients(spark, tickets):
    """Gradients and counts of the joins against dense matrices of the definition, at weights that are not optimal; one row has no known term."""
    odd = tickets.unionByName(spark.createDataFrame([(90, "nothing known", 0), (91, "", 1)], tickets.schema))
    params = DEFAULT.with_(calibration_folds=2)
    docs = M.fold_rows(odd, params)
    fits = [f._replace(coef=f.coef + 0.1) for f in M.fit_calibrated(odd, params, docs=docs)]
    found = {(r["fit"], r["class"]): r for r in M.certificate(odd, fits, params).collect()}
    rows = docs.collect()
    assert len(rows) == 92 and len(found) == 6
    for i, fit in enumerate(fits):
        x = np.zeros((len(rows), len(fit.vocabulary) + 1))
        for r, own in zip(rows, x):
            t = r["tokens"]
            grams = t + [" ".join(p) for p in zip(t, t[1:])]
            own[:-1] = [grams.count(w) for w in fit.vocabulary] * np.array(fit.idf)
            own[:-1] /= np.linalg.norm(own[:-1]) or 1
            own[-1] = 1
        inside = np.array([r["group"] != i for r in rows])
        for j, w in enumerate(fit.coef):
            y, m = np.array([1.0 if r["label"] == j else -1.0 for r in rows]), x @ w
            gradient = w - 2 * params.svm_c * x[inside].T @ (y * np.maximum(1 - y * m, 0))[inside]
            got, pos, held = found[i, j], (y[~inside] > 0).sum(), (~inside).sum()
            assert (got["n_train"], got["n_held"], got["n_own"]) == (inside.sum(), held, (y[inside] > 0).sum())
            assert got["gradient"] == pytest.approx(np.linalg.norm(gradient))
            assert got["first_gradient"] == pytest.approx(np.linalg.norm(2 * params.svm_c * x[inside].T @ y[inside]))
            a, b = fit.platt[j]
            over = 1 / (1 + np.exp(-(a * m + b))) - np.where(y > 0, (pos + 1) / (pos + 2), 1 / (held - pos + 2))
            assert got["sigmoid_a"] == pytest.approx((over * m)[~inside].sum()) and got["sigmoid_b"] == pytest.approx(over[~inside].sum())


def test_training_rows_are_those_of_the_split(spark, monkeypatch):
    """Written alone or read from the written split, and without the raw texts, which no classifier reads."""
    monkeypatch.setattr(prepare_q, "_WRITTEN", {})
    own = prepare_q.written_train(spark, SF001)
    assert own.columns == ["doc_id", "document_clean", "topic_encoded"]
    split = prepare_q.prepared_split(spark, SF001, reuse=True).filter("split = 'train'")
    again = prepare_q.written_train(spark, SF001)
    assert "document" in again.columns
    rows = [sorted(tuple(r) for r in x.select(own.columns).collect()) for x in (own, split, again)]
    assert rows[0] == rows[1] == rows[2] and rows[0]
