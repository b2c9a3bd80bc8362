"""The pruned count of frequent terms against the count of all terms."""

import random

import pytest

from deskspark.operators import tfidf as T

SCHEMA = "doc_id long, terms array<string>"


def _chosen(stats, n, *bounds):
    return [tuple(r) for r in T.vocabulary(stats, n, *bounds).collect()]


@pytest.mark.parametrize("bounds", [(3, 0.5, 20), (2, 1.0, 7), (1, 1.0, 100_000)])
@pytest.mark.parametrize("sizes", [(1 << 17, 1_000), (64, 3)])
def test_pruned_vocabulary_is_the_whole_one(spark, bounds, sizes):
    """Few buckets, a sample of three documents, equal counts at the cut, a word in every document, repeated rows and empty ones."""
    rnd = random.Random(5)
    rows = [(i, ["every"] + [f"w{min(int(rnd.paretovariate(0.7)), 300)}" for _ in range(rnd.randrange(12))]) for i in range(200)]
    rows += [(200, []), (201, None), (7, rows[7][1]), (7, rows[7][1])]
    docs = spark.createDataFrame(rows, SCHEMA)
    stats = T.frequent_stats(docs, len(rows), *bounds, *sizes)
    whole = T.term_stats(docs)
    assert _chosen(stats, len(rows), *bounds) == _chosen(whole, len(rows), *bounds)
    assert not stats.exceptAll(whole).count()


def test_pruning_leaves_rare_terms_out(spark):
    """5,000 words that occur twice don't reach the count by term where 10 occur in every document."""
    rows = [(i, [f"common{j}" for j in range(10)] + [f"rare{(i * 50 + j) % 5000}" for j in range(50)]) for i in range(200)]
    docs = spark.createDataFrame(rows, SCHEMA)
    stats = T.frequent_stats(docs, len(rows), 1, 1.0, 10, sample_docs=5)
    assert T.term_stats(docs).count() == 5010 and 10 <= stats.count() <= 100
    assert {r["term"] for r in T.vocabulary(stats, len(rows), 1, 1.0, 10).collect()} == {f"common{j}" for j in range(10)}


def test_vocabulary_of_no_documents(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert T.fit(docs).count() == 0
