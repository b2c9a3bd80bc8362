"""TF-IDF features in long form ``(doc_id, term, tf, tfidf)``.

Plan shape: tokens, n-grams and the term counts of a document are built
in-row (a document is one row).  Frequencies are counted by hash bucket
first; only terms that can still be among the ``max_features`` most frequent
are shuffled by term (:func:`frequent_stats`).  The vocabulary has at most
``max_features`` terms, so it goes to the tasks whole; weights and norms are
computed in-row and exploded last.
"""

from __future__ import annotations

import functools
import sys
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deskspark.config import DEFAULT, Params
from deskspark.functions import stopwords
from deskspark.functions.text import is_ascii, transliterate
from deskspark.operators import linear
from deskspark.operators.common import bind, materialize

# executors need not be able to import the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

TOKEN = r"(?U)\b\w\w+\b"
#: The same tokens of an ASCII text: a run of word characters ends at a boundary anyway.
ASCII_TOKEN = r"\w\w+"


def analyze(df: DataFrame, text: str = "document_clean", stop_words: bool = True,
            ngram_min: int = 1, ngram_max: int = 2, out: str = "terms", strip_accents: bool = True) -> DataFrame:
    """T1 + T2: lower-case tokens of two or more word characters with their
    accents stripped, English stop words removed, then every n-gram for n in
    [ngram_min, ngram_max] (so a bigram may span a removed stop word)."""
    x = tokens(df, text, stop_words, strip_accents)
    t = F.col("_tok")
    grams: list[Column] = []
    for n in range(ngram_min, ngram_max + 1):
        if n == 1:
            grams.append(t)
            continue
        # n shifted slices zipped together: linear, and no lambda refers to
        # an outer column (which the optimiser could inline per element)
        m = F.size(t) - n + 1
        g = F.slice(t, 1, m)
        for j in range(1, n):
            g = F.zip_with(g, F.slice(t, j + 1, m), lambda a, b: F.concat(a, F.lit(" "), b))
        grams.append(F.when(F.size(t) >= n, g).otherwise(F.array().cast("array<string>")))
    return x.withColumn(out, F.concat(*grams) if len(grams) > 1 else grams[0]).drop("_tok")


def tokens(df: DataFrame, text: str = "document_clean", stop_words: bool = True, strip_accents: bool = True, out: str = "_tok") -> DataFrame:
    """The tokens that the n-grams of :func:`analyze` are made of."""
    def found(t):
        plain = transliterate(t) if strip_accents else t
        return F.when(is_ascii(t), F.regexp_extract_all(t, F.lit(ASCII_TOKEN), 0)).otherwise(F.regexp_extract_all(plain, F.lit(TOKEN), 0))

    x = df.withColumn(out, bind(F.lower(F.col(text)), found))
    if stop_words:
        rem = StopWordsRemover(inputCol=out, outputCol=f"{out}2", stopWords=list(stopwords.english()),
                               caseSensitive=True)
        x = rem.transform(x).drop(out).withColumnRenamed(f"{out}2", out)
    return x


def counted(terms: Column) -> Column:
    """The distinct terms of an array with their counts, ``array<struct<term, tf>>`` in term order: the runs of the sorted
    array, linear after the sort."""
    none = F.lit(None).cast("string")

    def starts(s):
        before = F.concat(F.array(none), F.slice(s, 1, F.greatest(F.size(s) - 1, F.lit(0))))
        first = F.zip_with(s, before, lambda t, b: F.when(~t.eqNullSafe(b), t))
        return F.struct(F.size(s).alias("n"), F.filter(F.transform(first, lambda t, i: F.struct(t.alias("term"), i.alias("at"))),
                                                       lambda z: z["term"].isNotNull()).alias("first"))

    def runs(x):
        ends = F.slice(F.concat(x["first"]["at"], F.array(x["n"])), 2, F.size(x["first"]))
        return F.zip_with(x["first"], ends, lambda z, e: F.struct(z["term"].alias("term"), (e - z["at"]).cast("long").alias("tf")))

    return bind(bind(F.array_sort(terms), starts), runs)


#: Terms that are counted together in a task before they go on by term.
COUNT_TERMS = 2 << 20


def partial_stats(docs: DataFrame, group: str | None = None) -> DataFrame:
    """``(term, df, cf)``, by ``group`` (an integer column) if named: document and corpus counts of some rows at a time, a term in several
    rows of the result.  Counted over the rows' ``terms`` by Arrow kernels in the tasks, so far fewer rows go on than there are terms."""
    name = group or "group"

    def count(batches):
        for whole in batches:
            for begin, terms in linear.slices(whole.column(1), COUNT_TERMS):
                own = whole.column(0).slice(begin, len(terms)).to_numpy(zero_copy_only=False)
                coded = terms.flatten().dictionary_encode()
                row = np.repeat(np.arange(len(terms)), pc.list_value_length(terms).fill_null(0).to_numpy(zero_copy_only=False))
                place, some = coded.indices.fill_null(0).to_numpy(zero_copy_only=False), coded.indices.is_valid().to_numpy(zero_copy_only=False)
                width = max(len(coded.dictionary), 1)
                key, tf = np.unique(row[some] * width + place[some], return_counts=True)
                row, place = key // width, key % width
                for g in np.unique(own):
                    mine = own[row] == g
                    df = np.bincount(place[mine], minlength=width)
                    at = np.flatnonzero(df)
                    cf = np.bincount(place[mine], tf[mine], width)[at].astype(np.int64)
                    yield pa.RecordBatch.from_arrays([coded.dictionary.take(pa.array(at)), pa.array(np.full(len(at), g, np.int32)), pa.array(df[at]), pa.array(cf)],
                                                     names=["term", name, "df", "cf"])

    rows = docs.select((F.col(group) if group else F.lit(0)).cast("int").alias(name), "terms")
    found = rows.mapInArrow(count, f"term string, {name} int, df long, cf long")
    return found if group else found.drop(name)


def term_stats(docs: DataFrame) -> DataFrame:
    """``(term, df, cf)``: document and corpus frequency of every term, one shuffle by term."""
    return partial_stats(docs).groupBy("term").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf"))


#: Hash buckets of the first counting pass, and about how many documents name its candidates.  Neither changes a result.
BUCKETS, SAMPLE_DOCS = 1 << 17, 1_000


def sampled(sample_docs: int, n_docs: int) -> float:
    return min(1.0, sample_docs / max(n_docs, 1))


def _eligible(stats: DataFrame, n_docs, min_df: int, max_df: float) -> DataFrame:
    return stats.filter((F.col("df") >= min_df) & (F.col("df") <= F.lit(float(max_df)) * n_docs))


def frequent_stats(docs: DataFrame, n_docs: int, min_df: int = DEFAULT.min_df, max_df: float = DEFAULT.max_df,
                   max_features: int = DEFAULT.max_features, buckets: int = BUCKETS, sample_docs: int = SAMPLE_DOCS,
                   some: DataFrame | None = None) -> DataFrame:
    """The rows of :func:`term_stats` that :func:`vocabulary` can choose from, exact, without a shuffle of every distinct term.

    A sample of documents names ``2 * max_features`` candidates.  One pass counts the candidates by term and all other terms by hash
    bucket, so a task sends at most ``buckets`` rows and the candidates.  The ``max_features``-th best eligible candidate
    is a floor that no chosen term lies below; a bucket under the floor, or in fewer than ``min_df`` documents, holds no chosen term.
    A second pass counts the terms of the other buckets.  Equal counts at the floor stay in, so ties are settled as ever.  A poor sample
    lowers the floor and lets more terms through, but loses none.  The terms are counted and written in parts once (:func:`partial_stats`);
    both passes read those.  ``some``: a sample of the documents, if the caller has one that costs less than sampling ``docs``."""
    counts = materialize(partial_stats(docs).withColumn("_h", F.xxhash64("term")))
    sums = [F.sum("df").alias("df"), F.sum("cf").alias("cf")]
    some = docs.sample(sampled(sample_docs, n_docs), seed=0) if some is None else some
    named = partial_stats(some).groupBy("term").agg(F.sum("cf").alias("cf")).orderBy(F.desc("cf"), F.asc("term")).limit(2 * max_features)
    # candidates go by their hashes, 8 bytes each; a term that shares one is counted by term as well
    named = F.broadcast(materialize(named.select(F.xxhash64("term").alias("_h")).distinct()))
    bucket = F.pmod(F.col("_h"), F.lit(buckets))
    flagged = counts.join(named.withColumn("_named", F.lit(True)), "_h", "left")
    first = materialize(flagged.select(F.when(F.col("_named"), F.col("term")).alias("term"), F.when(F.col("_named").isNull(), bucket).alias("bucket"), "df", "cf")
                        .groupBy("term", "bucket").agg(*sums))
    exact = first.filter("term IS NOT NULL").select("term", "df", "cf")
    best = _eligible(exact, F.lit(n_docs), min_df, max_df).orderBy(F.desc("cf")).limit(max_features)
    n_best, floor = best.agg(F.count(F.lit(1)), F.min("cf")).first()
    floor = floor if floor and n_best == max_features else 0
    heavy = first.filter(F.col("term").isNull() & (F.col("cf") >= floor) & (F.col("df") >= min_df)).select("bucket")  # at most ``buckets`` rows
    rest = counts.withColumn("bucket", bucket).join(F.broadcast(heavy), "bucket", "left_semi").join(named, "_h", "left_anti")
    return exact.unionByName(rest.groupBy("term").agg(*sums))


#: Hash buckets of :func:`group_counts`, whose sums every task holds, and distinct terms that a task counts before it sends them.
GRAM_BUCKETS, HELD_TERMS = 1 << 20, 1 << 20


class Grams:
    """The n-grams of some rows' tokens as numbers: nothing is joined to a string before it is counted."""

    def __init__(self, tokens: pa.Array, buckets: int):
        coded = tokens.flatten().dictionary_encode()
        self.words, self.buckets = coded.dictionary, buckets
        self.row = np.repeat(np.arange(len(tokens)), pc.list_value_length(tokens).fill_null(0).to_numpy(zero_copy_only=False))
        self.code = coded.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        # a place more for the null token, which no n-gram holds
        self.hash = np.array([*(zlib.crc32(w.encode()) for w in self.words.to_pylist()), 0], np.uint64)[self.code]

    def at(self, n: int) -> np.ndarray:
        """Where the n-grams begin among the tokens."""
        last = max(len(self.row) - n + 1, 0)
        whole = self.row[:last] == self.row[n - 1:n - 1 + last]
        for j in range(n):
            whole &= self.code[j:j + last] >= 0
        return np.flatnonzero(whole)

    def bucket(self, n: int, at: np.ndarray) -> np.ndarray:
        mixed = np.full(len(at), n, np.uint64)
        for j in range(n):
            mixed = (mixed ^ self.hash[at + j]) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
        return (mixed % np.uint64(self.buckets)).astype(np.int64)

    def counts(self, n: int, heavy: np.ndarray, group: np.ndarray, groups: int):
        """``(terms, counts)`` of the n-grams in buckets that ``heavy`` marks and whose tokens are in such buckets: per group the
        documents and then the occurrences of each."""
        at = self.at(n)
        for j in range(n if n > 1 else 0):
            at = at[heavy[self.bucket(1, at + j)]]
        at = at[heavy[self.bucket(n, at)]]
        coded = pa.array(self.code[at]).dictionary_encode()
        for j in range(1, n):
            key = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64) * len(self.words) + self.code[at + j]
            coded = pa.array(key).dictionary_encode()
        place, width = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), max(len(coded.dictionary), 1)
        one = np.zeros(len(coded.dictionary), np.int64)  # a place of each
        one[place] = at
        parts = [self.words.take(pa.array(self.code[one + j])) for j in range(n)]
        key, tf = np.unique(self.row[at] * width + place, return_counts=True)
        cell = group[key // width] * width + key % width
        found = np.stack([np.bincount(cell, minlength=groups * width), np.bincount(cell, tf, groups * width).astype(np.int64)])
        return (pc.binary_join_element_wise(*parts, " ") if n > 1 else parts[0]), found.reshape(2 * groups, width).T[:len(one)]


class Held:
    """Terms with their counts, added up over the rows of a task."""

    def __init__(self, width: int):
        self.place, self.sums, self.width = {}, np.zeros((0, width), np.int64), width

    def add(self, terms: pa.Array, counts: np.ndarray) -> None:
        at = np.array([self.place.setdefault(t, len(self.place)) for t in terms.to_pylist()], np.intp)
        if len(self.place) > len(self.sums):
            self.sums = np.concatenate([self.sums, np.zeros((2 * len(self.place) - len(self.sums), self.width), np.int64)])
        self.sums[at] += counts

    def take(self) -> tuple[pa.Array, np.ndarray]:
        out = pa.array(list(self.place), pa.string()), self.sums[:len(self.place)]
        self.__init__(self.width)
        return out


def _token_pieces(batches, groups: list[int], buckets: int, most: int = linear.SLICE_TERMS):
    """(n-grams, place of each row's group in ``groups``) of some rows (group, tokens) at a time."""
    for whole in batches:
        for begin, tokens in linear.slices(whole.column(1), most):
            own = whole.column(0).slice(begin, len(tokens)).to_numpy(zero_copy_only=False)
            yield Grams(tokens, buckets), np.searchsorted(groups, own)


def gram_counts(rows: DataFrame, low: int, high: int, heavy: dict[int, np.ndarray] | None, groups: list[int], buckets: int) -> DataFrame:
    """``(term, df<group>, cf<group>, ...)`` of the n-grams of ``rows`` (group, tokens), added up by task: of those in the buckets that
    ``heavy`` marks by n, or of all."""
    names = [f"{name}{g}" for name in ("df", "cf") for g in groups]
    marks = rows.sparkSession.sparkContext.broadcast({n: np.packbits(h) for n, h in heavy.items()}) if heavy else None

    def count(batches):
        own = {n: np.unpackbits(marks.value[n], count=buckets).view(bool) if marks else np.ones(buckets, bool) for n in range(low, high + 1)}
        held = Held(len(names))
        for grams, group in _token_pieces(batches, groups, buckets):
            for n in own:
                held.add(*grams.counts(n, own[n], group, len(groups)))
            if len(held.place) > HELD_TERMS:
                yield from sent(held)
        yield from sent(held)

    def sent(held):
        terms, sums = held.take()
        for i in range(0, len(terms), 1 << 16):
            yield pa.RecordBatch.from_arrays([terms.slice(i, 1 << 16), *(pa.array(c[i:i + (1 << 16)].copy()) for c in sums.T)], names=["term", *names])

    return rows.mapInArrow(count, ", ".join(["term string", *(f"{name} long" for name in names)]))


def group_counts(docs: DataFrame, rows_in: dict[int, int], fits: list[tuple[set[int], Params]], buckets: int | None = None,
                 sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """``(term, df<group>, cf<group>, ...)`` of every n-gram of ``docs`` (group, tokens) that one of ``fits``, a training set of groups
    and its parameters, can choose (:func:`vocabulary`): exact, and without writing or shuffling the others.

    A sample of the rows names candidates by n.  One pass counts these by group, and the occurrences of all n-grams by hash bucket.  From the
    candidates' counts each fit has a floor, its ``max_features``-th best eligible one, below which it chooses nothing.  An n-gram is no
    more frequent than its bucket, nor than any of its tokens; a second pass counts those that can still reach the
    lowest floor of a fit that has n in its range.  Equal counts at the floor stay in.  A poor sample lowers floors and lets more
    through, but loses none.  Both passes have as many tasks as there are cores, for a task sends all its sums."""
    spark, groups, buckets = docs.sparkSession, sorted(rows_in), buckets or GRAM_BUCKETS
    low, high, most = min(p.ngram_min for _, p in fits), max(p.ngram_max for _, p in fits), max(p.max_features for _, p in fits)
    rows = docs.select(F.col("group").cast("int").alias("group"), "tokens")
    cores = max(spark.sparkContext.defaultParallelism, 2)
    total = sum((F.col(f"cf{g}") for g in groups), F.lit(0))
    words = F.size(F.split("term", " "))
    some = gram_counts(rows.sample(sampled(sample_docs, sum(rows_in.values())), seed=0), low, high, None, groups, buckets)
    some = some.groupBy("term").agg(F.sum(total).alias("cf")).withColumn("n", words)
    some = functools.reduce(DataFrame.union, [some.filter(F.col("n") == n).orderBy(F.desc("cf"), "term").limit(2 * most) for n in range(low, high + 1)])
    named = [r["term"] for r in some.select("term").collect()]  # at most 2 * max_features terms per n

    def first(batches):
        known, sums, held = pa.array(candidates.value, pa.string()), np.zeros(buckets, np.int64), Held(2 * len(groups))
        marks = marked(candidates.value, low, high, buckets)
        for grams, group in _token_pieces(batches, groups, buckets):
            for n in {1, *range(low, high + 1)}:
                sums += np.bincount(grams.bucket(n, grams.at(n)), minlength=buckets)
            for n, mark in marks.items():
                terms, counts = grams.counts(n, mark, group, len(groups))
                mine = pc.is_in(terms, value_set=known).to_numpy(zero_copy_only=False)
                held.add(terms.filter(pa.array(mine)), counts[mine])
        terms, counts = held.take()
        keys = [*(f"\t{i}" for i in range(0, buckets, STRIDE)), *terms.to_pylist()]  # no token has a tab
        cells = [*(sums[i:i + STRIDE].tobytes() for i in range(0, buckets, STRIDE)), *(c.tobytes() for c in counts)]
        for i in range(0, len(keys), 1 << 12):
            yield pa.RecordBatch.from_arrays([pa.array(keys[i:i + (1 << 12)]), pa.array(cells[i:i + (1 << 12)], pa.binary())], names=["key", "sums"])

    candidates = spark.sparkContext.broadcast(named)
    found = (rows.coalesce(cores).mapInArrow(first, "key string, sums binary").rdd.map(lambda r: (r[0], np.frombuffer(bytes(r[1]), np.int64)))
             .reduceByKey(lambda a, b: a + b, cores).collectAsMap())  # a sum per bucket and the candidates
    sums = np.concatenate([found.pop(f"\t{i}") for i in range(0, buckets, STRIDE)]) if found else np.zeros(buckets, np.int64)
    counts = np.array([found[t] for t in named if t in found]).reshape(-1, 2, len(groups))
    size = np.array([len(t.split(" ")) for t in named if t in found])
    floor = {n: [] for n in range(low, high + 1)}
    for inside, p in fits:
        own = [i for i, g in enumerate(groups) if g in inside]
        df, cf = counts[:, 0, own].sum(1), counts[:, 1, own].sum(1)
        good = np.sort(cf[(df >= p.min_df) & (df <= float(p.max_df) * sum(rows_in[groups[i]] for i in own)) & (size >= p.ngram_min) & (size <= p.ngram_max)])
        for n in range(p.ngram_min, p.ngram_max + 1):
            floor[n].append(max(good[-p.max_features] if len(good) >= p.max_features else 0, p.min_df, 1))
    heavy = {n: sums >= min(f) if f else np.zeros(buckets, bool) for n, f in floor.items()}
    exact = gram_counts(rows.coalesce(cores), low, high, heavy, groups, buckets)
    return exact.groupBy("term").agg(*[F.sum(c).alias(c) for c in exact.columns[1:]]).withColumn("words", words)


#: Buckets whose sums travel together.
STRIDE = 1 << 16


def marked(terms: list[str], low: int, high: int, buckets: int) -> dict[int, np.ndarray]:
    """By n the buckets of the terms of n tokens and of these tokens."""
    out = {n: np.zeros(buckets, bool) for n in range(low, high + 1)}
    for n, mark in out.items():
        split = [w for t in terms if len(w := t.split(" ")) == n]
        grams = Grams(pa.array(split, pa.list_(pa.string())), buckets)
        mark[grams.bucket(n, grams.at(n))] = True
        mark[grams.bucket(1, grams.at(1))] = True
    return out


def vocabulary(stats: DataFrame, n_docs: Column | int, min_df: int = DEFAULT.min_df,
               max_df: float = DEFAULT.max_df, max_features: int = DEFAULT.max_features) -> DataFrame:
    """Document frequency within [min_df, max_df * n_docs], then the
    ``max_features`` terms of highest corpus frequency (ties: term asc).
    Adds the smoothed idf ``ln((1 + n) / (1 + df)) + 1`` (T4)."""
    n = F.lit(n_docs) if isinstance(n_docs, int) else n_docs
    keep = _eligible(stats, n, min_df, max_df)
    keep = keep.orderBy(F.desc("cf"), F.asc("term")).limit(max_features)
    return keep.withColumn("idf", F.log((F.lit(1) + n) / (F.lit(1) + F.col("df"))) + 1)


def analyzed(docs: DataFrame, params: Params = DEFAULT, text: str = "document_clean", stop_words: bool = True, keys=("doc_id",)) -> DataFrame:
    """T1 + T2 written once: ``keys`` and ``terms``, for a fit and a transform of the same rows."""
    return materialize(analyze(docs, text, stop_words, params.ngram_min, params.ngram_max).select(*keys, "terms"))


def fit(docs: DataFrame, params: Params = DEFAULT, text: str = "document_clean", stop_words: bool = True) -> DataFrame:
    """The vocabulary of a corpus; rows that have ``terms`` already are not analysed again."""
    terms = lambda x: x if "terms" in x.columns else analyze(x.select(text), text, stop_words, params.ngram_min, params.ngram_max)
    n, bounds = docs.count(), (params.min_df, params.max_df, params.max_features)
    some = terms(docs.sample(sampled(SAMPLE_DOCS, n), seed=0))
    return vocabulary(frequent_stats(terms(docs), n, *bounds, some=some), n, *bounds)


def transform(docs: DataFrame, vocab: DataFrame, params: Params = DEFAULT, text: str = "document_clean",
              stop_words: bool = True, keys=("doc_id",)) -> DataFrame:
    """T4: ``keys + (term, tf, tfidf)``, tf * idf scaled to unit L2 norm per document.  Works row by row: repeated
    keys stay apart.  Rows that have ``terms`` already are not analysed again."""
    rows = vocab.select("term", "idf").orderBy("term").collect()  # at most max_features rows
    a = docs if "terms" in docs.columns else analyze(docs, text, stop_words, params.ngram_min, params.ngram_max)
    w = linear.tfidf_column(F.col("terms"), [r["term"] for r in rows], [r["idf"] for r in rows])
    return a.select(*keys, w.alias("_w")).select(*keys, F.inline("_w"))


def top_terms_per_class(docs: DataFrame, params: Params = DEFAULT, k: int = DEFAULT.top_terms,
                        label: str = "topic_group", text: str = "document_clean") -> DataFrame:
    """Per class, the ``k`` terms with the largest mean TF-IDF over all
    the class's documents (vectoriser without a stop list).  The
    ``row_number() <= k`` filter is planned as a window group-limit."""
    docs = analyzed(docs, params, text, False, (label,))
    w = transform(docs, fit(docs, params), params, keys=(label,))
    n_class = docs.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    sums = w.groupBy(label, "term").agg(F.sum("tfidf").alias("_s"))
    score = sums.join(n_class, label).withColumn("score", F.col("_s") / F.col("_n"))
    rk = Window.partitionBy(label).orderBy(F.desc("score"), F.asc("term"))
    return (score.withColumn("rank", F.row_number().over(rk)).filter(F.col("rank") <= k)
            .select(label, F.col("rank").cast("long"), "term", F.round("score", 6).alias("score")))
