"""Model training, calibration, scoring and tuning (M1-M9).

* M1  TF-IDF features + one-vs-rest linear SVM (squared hinge, intercept in
      the norm), all classes in the same jobs (``linear.squared_hinge``).
* M2  3-fold sigmoid calibration of the whole pipeline: vocabulary, idf and
      SVM of a fold come from the other folds, the sigmoids from the fold
      itself.  Folds are stratified.  The fits of all folds run together:
      one job per solver iteration for every (fold, class).
* M3  argmax / confidence / probabilities sorted descending, in-row.
* M4  softmax over a logits array column.
* M5  k-fold cross-validated weighted F1 of the calibrated pipeline, all
      (outer fold, inner fold, class) fits together.
* M6  seeded random search over the vectoriser and SVM parameters.
* M7  best run, M8 early-stopping rule, M9 external batch scorer hook.
"""

from __future__ import annotations

import contextlib
import functools
import itertools
import logging
import math
import random

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deskspark.config import DEFAULT, Params
from deskspark.operators import linear
from deskspark.operators import tfidf as T
from deskspark.operators.common import exact_row_number, materialize, release


# --------------------------------------------------------------------------- features

def analyzed(df: DataFrame, params: Params = DEFAULT, text: str = "document_clean") -> DataFrame:
    """Adds ``terms`` (T1 + T2)."""
    return T.analyze(df, text, True, params.ngram_min, params.ngram_max)


def group_stats(docs: DataFrame, train: list[set[int]], params: list[Params]) -> tuple[DataFrame, dict[int, int]]:
    """Document and corpus counts by ``group`` (``df0, cf0, df1, ...``) of every term that one of the fits can choose, and the rows of
    each group: all that the vocabularies of these fits need.  Rows with ``terms`` in place of ``tokens`` have all their terms counted."""
    rows_in = {r["group"]: r["n"] for r in docs.groupBy("group").agg(F.count(F.lit(1)).alias("n")).collect()}
    if "tokens" in docs.columns:
        return materialize(T.group_counts(docs, rows_in, list(zip(train, params)))), rows_in
    per = [F.sum(F.when(F.col("group") == g, F.col(name))).alias(f"{name}{g}") for g in sorted(rows_in) for name in ("df", "cf")]
    return materialize(T.partial_stats(docs, "group").groupBy("term").agg(*per).na.fill(0).withColumn("words", F.size(F.split("term", " ")))), rows_in


def vocabularies(stats: DataFrame, rows_in: dict[int, int], train: list[set[int]], params: list[Params]):
    """Per fit the terms and idf of its own training set (a set of ``group`` values) under its own parameters: T3 for all fits from
    the counts by group.  Returns ``([terms], [idf])``, each list of at most ``max_features`` entries."""
    parts = []
    for fit, (groups, p) in enumerate(zip(train, params)):
        inside = sorted(groups & set(rows_in))
        if not inside:
            continue
        add = lambda name: functools.reduce(lambda a, b: a + b, [F.col(f"{name}{g}") for g in inside])  # noqa: E731, B023
        own = stats.filter(F.col("words").between(p.ngram_min, p.ngram_max))
        of = own.select("term", add("df").alias("df"), add("cf").alias("cf")).filter("df > 0")
        kept = T.vocabulary(of, sum(rows_in[g] for g in inside), p.min_df, p.max_df, p.max_features)
        parts.append(kept.select(F.lit(fit).alias("fit"), "term", "idf"))
    rows = functools.reduce(DataFrame.union, parts).collect() if parts else []  # at most max_features rows per set
    terms, idfs = [[] for _ in train], [[] for _ in train]
    for r in sorted(rows, key=lambda r: (r["fit"], r["term"])):
        terms[r["fit"]].append(r["term"])
        idfs[r["fit"]].append(float(r["idf"]))
    return terms, idfs


def stratified_groups(df: DataFrame, label: str, id_col: str, seed: int, groups: int) -> DataFrame:
    """Adds ``group``: the rows of a class are dealt in turn over ``groups`` in the order of a seeded hash of their id."""
    key = F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f"-fold-{seed}")))
    x = df.withColumn("_k", key)
    x = exact_row_number(x, [label], ["_k", id_col], F.conv(F.substring("_k", 1, 4), 16, 10).cast("int"), out="_rn")
    return x.withColumn("group", ((F.col("_rn") - 1) % groups).cast("int")).drop("_k", "_rn")


@contextlib.contextmanager
def _solved(docs: DataFrame, train: list[set[int]], held: list[set[int]] | None, each: list[Params], stats):
    """The fits of :func:`fit_together` as ``(rows, vocabularies' union, terms, idfs, weights, sigmoids)`` while the rows are kept."""
    k = int(docs.agg(F.max("label")).first()[0] or 0) + 1
    terms, idfs = vocabularies(*(stats or group_stats(docs, train, each)), train, each)
    shared = linear.union(terms, idfs)
    rows = linear.blocks(docs, shared)
    try:
        coef = linear.squared_hinge(rows, shared, train, k, [p.svm_c for p in each], each[0].svm_max_iter, each[0].svm_tol)
        platt = linear.sigmoids(rows, shared, held, coef, each[0].platt_tol) if held else [None] * len(train)
        yield rows, shared, terms, idfs, coef, platt
    finally:
        rows.unpersist()
        del rows
        release(docs.sparkSession.sparkContext)


def fit_together(docs: DataFrame, train: list[set[int]], held: list[set[int]] | None, params: Params | list[Params], stats=None) -> list[linear.Fit]:
    """One fitted pipeline per training set over ``docs`` (label, group, and tokens or terms), calibrated on ``held``.  ``params`` may
    differ by fit; ``terms`` must then have the n-grams of the widest range.  ``stats``: :func:`group_stats` of ``docs``, if known."""
    each = params if isinstance(params, list) else [params] * len(train)
    with _solved(docs, train, held, each, stats) as (_, _, terms, idfs, coef, platt):
        # a shorter vocabulary leaves places without weight before the intercept
        cut = [np.delete(c, np.s_[len(t):coef.shape[2] - 1], axis=1) for c, t in zip(coef, terms)]
        return [linear.Fit(t, i, c, p) for t, i, c, p in zip(terms, idfs, cut, platt)]


def _training(train: DataFrame, label: str, group: Column | None = None) -> DataFrame:
    """T1 written once: the n-grams are many times as large, and are made of the tokens in the tasks that count them."""
    x = T.tokens(train, out="tokens").withColumn("label", F.col(label).cast("int")).withColumn("row", F.monotonically_increasing_id())
    docs = materialize((x if group is None else x.withColumn("group", group)).select("row", "label", "group", "tokens"), "zstd")
    release(train.sparkSession.sparkContext)
    return docs


# --------------------------------------------------------------------------- M1

def train_svm(train: DataFrame, params: Params = DEFAULT, label: str = "topic_encoded") -> list[linear.Fit]:
    """M1: the uncalibrated pipeline fitted on all rows."""
    return fit_together(_training(train, label, F.lit(0)), [{0}], None, params)


def predict_class(fits: list[linear.Fit], df: DataFrame, params: Params = DEFAULT, out: str = "prediction") -> DataFrame:
    """The class with the greatest margin or probability (the first on ties), scored in-row."""
    x = analyzed(df, params).withColumn("_s", linear.scores(F.col("terms"), fits))
    return x.withColumn(out, (F.array_position("_s", F.array_max("_s")) - 1).cast("int")).drop("_s", "terms")


# --------------------------------------------------------------------------- M2

def fold_rows(train: DataFrame, params: Params = DEFAULT, label: str = "topic_encoded", id_col: str = "doc_id") -> DataFrame:
    """The rows of M2 (row, label, group, tokens), written once; ``group`` is the fold in which a row is held."""
    return _training(stratified_groups(train, label, id_col, params.seed, params.calibration_folds), label)


def fit_calibrated(train: DataFrame, params: Params = DEFAULT, label: str = "topic_encoded",
                   id_col: str = "doc_id", docs: DataFrame | None = None) -> list[linear.Fit]:
    """M2: one calibrated pipeline per fold.  ``docs``: :func:`fold_rows` of ``train``, if known."""
    folds = range(params.calibration_folds)
    docs = fold_rows(train, params, label, id_col) if docs is None else docs
    return fit_together(docs, [set(folds) - {f} for f in folds], [{f} for f in folds], params)


def weight_table(fits: list[linear.Fit], spark) -> DataFrame:
    """The fitted weights as a table (fit, class, term, idf, weight); the intercept has a null term.  At most fits x classes x
    ``max_features`` rows, which the driver holds anyway."""
    rows = [(i, c, t, idf, float(w)) for i, f in enumerate(fits) for c, own in enumerate(f.coef)
            for t, idf, w in zip([*f.vocabulary, None], [*map(float, f.idf), 1.0], own)]
    return spark.createDataFrame(rows, "fit int, class int, term string, idf double, weight double")


def certificate(train: DataFrame, fits: list[linear.Fit], params: Params = DEFAULT, label: str = "topic_encoded", id_col: str = "doc_id",
                docs: DataFrame | None = None) -> DataFrame:
    """How far :func:`fit_calibrated`'s weights are from optimal, recomputed from the rows by joins with the weight table: per fit
    and class n_train, n_own (of the class), n_held, ``first_gradient`` and ``gradient`` (norms of the squared hinge's gradient
    at zero and at the weights) and the two gradient sums ``sigmoid_a``, ``sigmoid_b`` of the sigmoid on the held fold.
    ``docs``: :func:`fold_rows` of ``train``, if known.

    All classes go side by side, and the entries of a row are made twice (for its margins, and for the gradient once these are
    known), so neither is an entry written nor shuffled: sums by row and by term leave the tasks."""
    spark, classes = train.sparkSession, range(len(fits[0].coef))
    docs = fold_rows(train, params, label, id_col) if docs is None else docs
    weights = materialize(weight_table(fits, spark))
    wide = weights.groupBy("fit", "term").agg(*[F.sum(F.when(F.col("class") == c, F.col("weight"))).alias(f"w{c}") for c in classes])
    wide = materialize(wide)

    def entries(rows: DataFrame, *keep) -> DataFrame:
        """T4 of every fold in-row, one row of the result per row and fold."""
        of = F.explode(F.array(*[F.struct(F.lit(i).alias("fit"), linear.tfidf_column(F.col("tokens"), f.vocabulary, list(map(float, f.idf)), True).alias("w"))
                                 for i, f in enumerate(fits)]))
        return rows.select(*keep, of.alias("x")).select(*keep, "x.fit", "x.w")

    keys = ["fit", "row", "label", "group"]
    x = entries(docs, *keys[1:]).select(*keys, F.inline_outer("w")).select(*keys, "term", F.col("tfidf").alias("v"))
    sums = x.join(F.broadcast(wide.filter("term IS NOT NULL")), ["fit", "term"], "left").groupBy(*keys).agg(
        *[F.coalesce(F.sum(F.col("v") * F.col(f"w{c}")), F.lit(0.0)).alias(f"s{c}") for c in classes])
    sums = sums.join(F.broadcast(wide.filter("term IS NULL").drop("term")), "fit")
    rows = materialize(sums.select(*keys, F.array(*[F.col(f"s{c}") + F.col(f"w{c}") for c in classes]).alias("m")))
    signed = lambda c: F.when(F.col("label") == c, 1.0).otherwise(-1.0)
    margins = rows.select(*keys, F.posexplode("m").alias("class", "m")).withColumn("sign", signed(F.col("class")))
    pull = lambda sign, m: 2 * params.svm_c * sign * F.greatest(1 - sign * m, F.lit(0.0))
    slopes = rows.filter("group <> fit").select(
        "row", "fit", *[pull(signed(F.lit(c)), F.col("m")[c]).alias(f"now{c}") for c in classes], *[pull(signed(F.lit(c)), F.lit(0.0)).alias(f"then{c}") for c in classes])
    names = slopes.columns[2:]
    of_row = slopes.groupBy("row").agg(F.collect_list(F.struct("fit", *names)).alias("slopes"))  # a place per fold
    pulled = entries(docs.join(of_row, "row"), "slopes").withColumn("own", F.filter("slopes", lambda z: z["fit"] == F.col("fit"))).filter(F.size("own") > 0)
    pulled = pulled.select("fit", F.col("own")[0].alias("own"), F.inline("w")).select("fit", "term", F.col("tfidf").alias("v"), "own")
    per = pulled.groupBy("fit", "term").agg(*[F.sum(F.col("v") * F.col("own")[n]).alias(n) for n in names])
    per = per.unionByName(slopes.groupBy("fit").agg(*[F.sum(n).alias(n) for n in names]).withColumn("term", F.lit(None).cast("string")))
    per = per.select("fit", "term", F.inline(F.array(*[F.struct(F.lit(c).alias("class"), F.col(f"now{c}").alias("now"), F.col(f"then{c}").alias("then")) for c in classes])))
    at = weights.join(per.withColumnsRenamed({"fit": "f", "class": "c", "term": "t"}),
                      (F.col("fit") == F.col("f")) & (F.col("class") == F.col("c")) & F.col("term").eqNullSafe(F.col("t")), "left")
    gradient = F.col("weight") - F.coalesce("now", F.lit(0.0))
    hinge = at.groupBy("fit", "class").agg(F.sqrt(F.sum(gradient * gradient)).alias("gradient"), F.sqrt(F.sum(F.coalesce(F.col("then") * F.col("then"), F.lit(0.0)))).alias("first_gradient"))
    counts = margins.groupBy("fit", "class").agg(F.count_if(F.col("group") != F.col("fit")).alias("n_train"), F.count_if(F.col("group") == F.col("fit")).alias("n_held"),
                                                 F.count_if((F.col("group") != F.col("fit")) & (F.col("sign") > 0)).alias("n_own"),
                                                 F.count_if((F.col("group") == F.col("fit")) & (F.col("sign") > 0)).alias("pos"))
    platt = spark.createDataFrame([(i, c, float(a), float(b)) for i, f in enumerate(fits) for c, (a, b) in enumerate(f.platt)], "fit int, class int, a double, b double")
    held = margins.filter("group = fit").join(F.broadcast(platt), ["fit", "class"]).join(counts.select("fit", "class", "pos", "n_held"), ["fit", "class"])
    goal = F.when(F.col("sign") > 0, (F.col("pos") + 1) / (F.col("pos") + 2)).otherwise(1 / (F.col("n_held") - F.col("pos") + 2))
    over = 1 / (1 + F.exp(-(F.col("a") * F.col("m") + F.col("b")))) - goal
    sigmoid = held.groupBy("fit", "class").agg(F.sum(over * F.col("m")).alias("sigmoid_a"), F.sum(over).alias("sigmoid_b"))
    return counts.drop("pos").join(hinge, ["fit", "class"]).join(sigmoid, ["fit", "class"])


def predict_calibrated(fits: list[linear.Fit], df: DataFrame, labels: list[str] | None = None, params: Params = DEFAULT,
                       keep=("doc_id",)) -> DataFrame:
    """M2 + M3: per fold ``sigmoid(a * margin + b)`` per class, normalised, then
    averaged over folds; class = argmax, confidence = max probability,
    ``probabilities`` = array of ``(label, prob)`` sorted descending.  In-row:
    no join, no shuffle."""
    x = analyzed(df, params)
    x = x.select(*keep, linear.scores(F.col("terms"), fits).alias("_prob"))
    return probabilities_table(x, "_prob", labels or [str(i) for i in range(len(fits[0].coef))])


def probabilities_table(df: DataFrame, prob: str, labels: list[str]) -> DataFrame:
    """M3 from a probability array column."""
    names = F.array(*[F.lit(l) for l in labels])
    pairs = F.arrays_zip(names.alias("label"), F.col(prob).alias("prob"))
    srt = F.array_sort(pairs, lambda a, b: F.when(a["prob"] > b["prob"], -1).when(a["prob"] < b["prob"], 1)
                       .otherwise(F.when(a["label"] < b["label"], -1).otherwise(1)))
    return (df.withColumn("probabilities", srt)
            .withColumn("predicted_class", F.col("probabilities")[0]["label"])
            .withColumn("confidence", F.col("probabilities")[0]["prob"]).drop(prob))


# --------------------------------------------------------------------------- M4

def softmax_logits(df: DataFrame, logits: str = "logits") -> DataFrame:
    """M4: softmax, argmax (first index on ties) and its probability."""
    x = df.withColumn("_l", F.transform(F.col(logits), lambda v: v.cast("double")))
    x = x.withColumn("_mx", F.array_max("_l"))
    x = x.withColumn("_e", F.transform("_l", lambda v: F.exp(v - F.col("_mx"))))
    x = x.withColumn("_z", F.aggregate("_e", F.lit(0.0), lambda a, v: a + v))
    x = x.withColumn("probs", F.transform("_e", lambda v: v / F.col("_z")))
    x = x.withColumn("predicted", (F.array_position("_l", F.col("_mx")) - 1).cast("int"))
    x = x.withColumn("confidence", F.lit(1.0) / F.col("_z"))
    return x.drop("_l", "_mx", "_e", "_z")


# --------------------------------------------------------------------------- M5 / M6

def cv_weighted_f1(train: DataFrame, params: Params = DEFAULT, label: str = "topic_encoded",
                   id_col: str = "doc_id") -> float:
    """M5: mean weighted F1 over ``cv_folds`` stratified outer folds.  Per outer fold the calibrated pipeline (vocabulary
    included) is fitted on the other rows; the fits of all outer and inner folds run together."""
    return cv_scores(_cv_rows(train, params, label, id_col), [params])[0]


def _cv_rows(train: DataFrame, params: Params, label: str, id_col: str) -> DataFrame:
    return _training(stratified_groups(train, label, id_col, params.seed, params.cv_folds * params.calibration_folds), label)


def _cv_sets(params: Params):
    """(outer, inner) fold pairs with their group, and per pair the groups of its training set and those held for its sigmoids."""
    pairs = [(g, h) for g in range(params.cv_folds) for h in range(params.calibration_folds)]
    code = {pair: i for i, pair in enumerate(pairs)}
    train = [{code[p] for p in pairs if p[0] != g and p[1] != h} for g, h in pairs]
    held = [{code[p] for p in pairs if p[0] != g and p[1] == h} for g, h in pairs]
    return pairs, code, train, held


def cv_scores(docs: DataFrame, trials: list[Params], stats=None) -> list[float]:
    """M5 of several parameter sets over the same rows (label, group, tokens), all their fits in the same jobs."""
    outer, inner = trials[0].cv_folds, trials[0].calibration_folds
    pairs, code, train, held = _cv_sets(trials[0])
    each = [p for p in trials for _ in pairs]
    asked = [({code[g, h] for h in range(inner)}, [t * len(pairs) + code[g, h] for h in range(inner)])
             for t, g in itertools.product(range(len(trials)), range(outer))]
    with _solved(docs, train * len(trials), held * len(trials), each, stats) as (rows, shared, _, _, coef, platt):
        counts = linear.confusions(rows, shared, coef, platt, asked)
    support, hits, named = counts.sum(2), np.diagonal(counts, axis1=1, axis2=2), counts.sum(1)
    f1 = (support * 2 * hits / np.maximum(support + named, 1)).sum(1) / np.maximum(support.sum(1), 1)
    return [float(x) for x in f1.reshape(len(trials), outer).mean(1)]


def search_space(trials: int, seed: int = DEFAULT.seed):
    """M6: seeded random parameter sets (random search in place of TPE)."""
    rng = random.Random(seed)
    out = []
    for _ in range(trials):
        out.append({"max_features": rng.randrange(3000, 7001, 500), "ngram_max": rng.randint(1, 3),
                    "min_df": rng.randint(1, 5), "max_df": round(0.6 + 0.05 * rng.randint(0, 6), 2),
                    "svm_c": math.exp(rng.uniform(math.log(0.1), math.log(10.0)))})
    return out


def search(train: DataFrame, trials: int = DEFAULT.search_trials, params: Params = DEFAULT, label: str = "topic_encoded",
           id_col: str = "doc_id", together: int = 3) -> list[dict]:
    """M6: score every parameter set with M5; returns run rows.

    Rows are analysed once and one table of counts by term and group gives the vocabularies of all trials.  ``together`` trials are fitted by the same jobs; if such a batch fails, each of its trials is tried alone, and one that
    fails alone fails the search: no score stands in for a trial that has none."""
    sets = search_space(trials, params.seed)
    each = [params.with_(**p) for p in sets]
    docs = _cv_rows(train, params, label, id_col)
    sets_ = _cv_sets(params)[2]
    stats = group_stats(docs, sets_ * trials, [p for p in each for _ in sets_])
    release(train.sparkSession.sparkContext)
    scores = []
    for begin in range(0, trials, together):
        batch = each[begin:begin + together]
        try:
            scores += cv_scores(docs, batch, stats)
        except Exception:  # noqa: BLE001
            logging.getLogger(__name__).exception("trials from %d failed together", begin)
            scores += [cv_scores(docs, [p], stats)[0] for p in batch]
    return [{"trial": i, **p, "score": s} for i, (p, s) in enumerate(zip(sets, scores))]


# --------------------------------------------------------------------------- M7 / M8 / M9

def best_run(runs: DataFrame, score: str = "score", minimize: bool = False) -> DataFrame:
    """M7: the run with the best score (``min_by`` when minimising, e.g. loss)."""
    pick = F.min_by if minimize else F.max_by
    return runs.agg(pick(F.struct(*runs.columns), F.col(score)).alias("best")).select("best.*")


def early_stop(log: DataFrame, metric: str = "f1", order: str = "epoch", patience: int = 5,
               min_delta: float = 1e-4, by: list[str] | None = None) -> DataFrame:
    """M8: per run, the first evaluation after which ``patience`` evaluations
    in a row brought no gain above ``min_delta`` over the best so far."""
    by = by or []
    w = Window.partitionBy(*by).orderBy(order)
    best_before = F.max(metric).over(w.rowsBetween(Window.unboundedPreceding, -1))
    x = log.withColumn("improved", F.coalesce(F.col(metric) > best_before + min_delta, F.lit(True)))
    x = x.withColumn("_grp", F.sum(F.col("improved").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    x = x.withColumn("no_gain_run", F.row_number().over(Window.partitionBy(*by, "_grp").orderBy(order)) - 1)
    return x.withColumn("stop_here", F.col("no_gain_run") >= patience).drop("_grp")


def score_external(df: DataFrame, fn, schema: str) -> DataFrame:
    """M9: apply an external batch model (pandas in, pandas out) to Arrow
    batches of each partition."""
    def run(batches):
        for pdf in batches:
            yield fn(pdf)
    return df.mapInPandas(run, schema=schema)
