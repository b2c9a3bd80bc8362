"""The trained classifier checked and evaluated: M1-M3 through V1-V7 and G10.

The oracle solves the training problems on its own: the squared hinge by gradient steps of the shorter Barzilai-Borwein length
until the gradient is below 1e-7, the sigmoids by Newton steps of a bounded length.  Half the squared norm makes the problems strongly convex, so
the optimum is unique and both sides must name the same classes; ``svm_certificate`` proves how near to it the library's weights are.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from deskspark.config import DEFAULT
from deskspark.functions import stopwords
from deskspark.functions.text import transliterate_sql
from deskspark.operators import evaluate as V
from deskspark.operators import langid
from deskspark.operators import model as M
from deskspark.operators import prepare as P
from deskspark.operators import routing as R
from deskspark.operators.common import materialize
from deskspark.plans import register
from deskspark.plans.evaluate_q import CLASS_CTES
from deskspark.plans.model_q import _labels, _splits
from deskspark.plans.prepare_q import PREP, SPLIT, prepared, written_train
from deskspark.plans.request_q import REQ_PII, ROUTE_CTES, TRAIN_SRC, fitted_langid, requests
from deskspark.plans.sqlparts import md5_key, nb_ctes
from deskspark.sources.tables import version

_STOP = stopwords.sql_list()


def _terms(src: str, out: str, keys: str) -> str:
    """``out``(keys, term, tf) from ``src``(keys, text)."""
    toks = f"list_filter(regexp_extract_all({transliterate_sql('lower(text)')}, '\\b\\w\\w+\\b'), lambda t: NOT list_contains([{_STOP}], t))"
    return f"""
{out}_k AS MATERIALIZED (SELECT {keys}, {toks} AS toks FROM {src}),
{out} AS MATERIALIZED (SELECT {keys}, term, CAST(count(*) AS DOUBLE) AS tf FROM (
  SELECT {keys}, unnest(toks) AS term FROM {out}_k
  UNION ALL SELECT {keys}, unnest(list_transform(range(1, len(toks)), lambda i: toks[i] || ' ' || toks[i + 1])) FROM {out}_k) GROUP BY ALL)"""


def _entries(terms: str, out: str, keys: str) -> str:
    """``out``(fit, keys, j, v): unit-length features under every fit's vocabulary, place 0 the intercept."""
    return f"""
{out} AS MATERIALIZED (SELECT fit, {keys}, j, v / sqrt(sum(v * v) OVER (PARTITION BY fit, {keys})) AS v
  FROM (SELECT fit, {keys}, j, tf * idf AS v FROM {terms} JOIN vo USING (term))
  UNION ALL SELECT fit, {keys}, 0, 1.0 FROM {terms}_k CROSS JOIN fits)"""


def svm_ctes(folds: int, src: str = "(SELECT doc_id, document_clean AS text FROM sp)", keys: str = "doc_id") -> str:
    """``mt``(fit, keys, c, m): margins of the rows of ``src``(keys, text) under the SVMs fitted on the training split, without
    one fold each (``folds`` > 0) or whole; and ``pt``(keys, c, p), the calibrated probabilities (``folds`` > 0)."""
    out = f"""
fits AS (SELECT unnest({f"range({folds})" if folds else "[0]"}) AS fit),
trn AS MATERIALIZED (SELECT doc_id, topic_encoded AS y, document_clean AS text, (row_number() OVER (PARTITION BY topic_encoded
       ORDER BY {md5_key('doc_id', f'fold-{DEFAULT.seed}')}, doc_id) - 1) % {max(folds, 1)} AS grp FROM sp WHERE split = 'train'),
cl_ AS (SELECT DISTINCT y AS c FROM trn),{_terms('trn', 'dt', 'doc_id')},
ft AS MATERIALIZED (SELECT fit, doc_id, y, {"fit = grp" if folds else "false"} AS held FROM fits CROSS JOIN trn),
vo AS MATERIALIZED (SELECT fit, row_number() OVER (PARTITION BY fit ORDER BY cf DESC, term) AS j, term, ln((1 + n) / (1 + df)) + 1 AS idf
  FROM (SELECT fit, term, count(*) AS df, sum(tf) AS cf FROM dt JOIN ft USING (doc_id) WHERE NOT held GROUP BY ALL)
  JOIN (SELECT fit, count(*) AS n FROM ft WHERE NOT held GROUP BY fit) USING (fit)
  WHERE df >= {DEFAULT.min_df} AND df <= {DEFAULT.max_df}::DOUBLE * n QUALIFY j <= {DEFAULT.max_features}),{_entries('dt', 'xa', 'doc_id')},
x AS MATERIALIZED (SELECT xa.*, y FROM xa JOIN ft USING (fit, doc_id) WHERE NOT held),
bb AS (SELECT 0 AS it, fit, j, c, 0.0::DOUBLE AS w, NULL::DOUBLE AS dw, NULL::DOUBLE AS g FROM (SELECT DISTINCT fit, j FROM x) CROSS JOIN cl_
  UNION ALL
  (WITH m AS (SELECT x.fit, doc_id, c, y, sum(v * w) AS m FROM x JOIN bb USING (fit, j) GROUP BY ALL),
   r AS (SELECT fit, doc_id, c, {2 * DEFAULT.svm_c} * CASE WHEN y = c THEN greatest(0.0, 1 - m) ELSE -greatest(0.0, 1 + m) END AS r FROM m),
   h AS (SELECT x.fit, j, c, sum(v * r) AS h FROM x JOIN r USING (fit, doc_id) WHERE r <> 0 GROUP BY ALL),
   n AS (SELECT bb.*, w - coalesce(h, 0) AS gn FROM bb LEFT JOIN h USING (fit, j, c)),
   a AS (SELECT fit, c, coalesce(sum(dw * (gn - g)) / nullif(sum((gn - g) * (gn - g)), 0), 0.0003) AS a, sum(gn * gn) AS size FROM n GROUP BY ALL)
   SELECT it + 1, fit, j, c, w - a * gn, -a * gn, gn FROM n JOIN a USING (fit, c) WHERE it < 2000 AND (SELECT max(size) FROM a) > 1e-14)),
sol AS MATERIALIZED (SELECT fit, j, c, w FROM bb WHERE it = (SELECT max(it) FROM bb)),{_terms(src, 'tt', keys)},{_entries('tt', 'xt', keys)},
mt AS MATERIALIZED (SELECT xt.fit, {keys}, c, sum(v * w) AS m FROM xt JOIN sol USING (fit, j) GROUP BY ALL)"""
    if not folds:
        return out
    return out + f""",
mh AS MATERIALIZED (SELECT fit, c, y = c AS own, m, CASE WHEN y = c THEN (pos + 1) / (pos + 2) ELSE 1 / (n - pos + 2) END AS t, pos, n FROM (
  SELECT *, CAST(sum((y = c)::INT) OVER (PARTITION BY fit, c) AS DOUBLE) AS pos, CAST(count(*) OVER (PARTITION BY fit, c) AS DOUBLE) AS n FROM (
    SELECT xa.fit, doc_id, c, y, sum(v * w) AS m FROM xa JOIN ft USING (fit, doc_id) JOIN sol USING (fit, j) WHERE held GROUP BY ALL))),
nt AS (SELECT 0 AS it, fit, c, 0.0::DOUBLE AS a, ln((max(pos) + 1) / (max(n) - max(pos) + 1)) AS b FROM mh GROUP BY ALL
  UNION ALL
  (WITH e AS (SELECT mh.*, a, b, 1 / (1 + exp(-(a * m + b))) AS p, it FROM mh JOIN nt USING (fit, c)),
   s AS (SELECT it, fit, c, a, b, sum((p - t) * m) AS ga, sum(p - t) AS gb, sum(p * (1 - p) * m * m) + 1e-9 AS haa,
                sum(p * (1 - p) * m) AS hab, sum(p * (1 - p)) + 1e-9 AS hbb FROM e GROUP BY ALL),
   d AS (SELECT it, fit, c, a, b, (hab * gb - hbb * ga) / (haa * hbb - hab * hab) AS da, (hab * ga - haa * gb) / (haa * hbb - hab * hab) AS db FROM s)
   SELECT it + 1, fit, c, a + da * least(1.0, 0.5 / greatest(abs(da), abs(db), 1e-300)), b + db * least(1.0, 0.5 / greatest(abs(da), abs(db), 1e-300))
   FROM d WHERE it < 80)),
pp AS (SELECT mt.fit, {keys}, c, 1 / (1 + exp(-(a * m + b))) AS p FROM mt JOIN (SELECT * FROM nt WHERE it = 80) USING (fit, c)),
pt AS MATERIALIZED (SELECT {keys}, c, avg(p) AS p FROM (SELECT {keys}, c, p / sum(p) OVER (PARTITION BY fit, {keys}) AS p FROM pp) GROUP BY ALL)"""


def best_class(src: str, score: str, keys: str = "doc_id") -> str:
    """(keys, topic_encoded, topic_group): the class of the greatest score, the first on ties."""
    return (f"(SELECT {keys}, topic_encoded, topic_group FROM {src} JOIN lab ON topic_encoded = c "
            f"QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {score} DESC, c) = 1)")


CALIBRATED = f"{PREP}, {SPLIT}, {svm_ctes(DEFAULT.calibration_folds)}"


@register("model_training", f"""
WITH RECURSIVE {PREP}, {SPLIT}, {svm_ctes(0)}
SELECT b.doc_id, sp.topic_group, b.topic_encoded AS predicted_encoded, b.topic_group AS predicted_class
FROM {best_class("mt", "m")} b JOIN sp USING (doc_id) WHERE split = 'test'""")
def model_training(spark, sf_dir):
    """M1: TF-IDF + one-vs-rest linear SVM fitted on the training split; test-split predictions decoded to class names."""
    train, test, sp = _splits(spark, sf_dir)
    pred = M.predict_class(M.train_svm(train), test)
    out = pred.select("doc_id", "topic_group", F.col("prediction").alias("predicted_encoded"))
    return P.label_decode(out, P.label_dictionary(sp))


@register("svm_certificate", f"""
WITH {PREP}, {SPLIT},
fits AS (SELECT unnest(range({DEFAULT.calibration_folds})) AS fold),
trn AS (SELECT doc_id, topic_encoded AS y, (row_number() OVER (PARTITION BY topic_encoded
        ORDER BY {md5_key('doc_id', f'fold-{DEFAULT.seed}')}, doc_id) - 1) % {DEFAULT.calibration_folds} AS grp FROM sp WHERE split = 'train')
SELECT CAST(fold AS INTEGER) AS fold, lab.topic_group AS class, CAST(count(*) FILTER (WHERE grp <> fold) AS BIGINT) AS n_train,
       CAST(count(*) FILTER (WHERE grp <> fold AND y = lab.topic_encoded) AS BIGINT) AS n_own,
       CAST(count(*) FILTER (WHERE grp = fold) AS BIGINT) AS n_held, true AS margin_optimal, true AS sigmoid_optimal
FROM trn CROSS JOIN fits CROSS JOIN lab GROUP BY fold, lab.topic_group""")
def svm_certificate(spark, sf_dir):
    """M1 + M2 proved: gradients at the fitted weights, recomputed from rows by joins.  The margins' problem is 1-strongly convex,
    so its weights are no farther from the optimum than the gradient is long."""
    train = written_train(spark, sf_dir)
    names = spark.createDataFrame(list(enumerate(_labels(prepared(spark, sf_dir)))), "code int, class string")  # a row per class
    docs = M.fold_rows(train)
    found = M.certificate(train, M.fit_calibrated(train, docs=docs), docs=docs)
    near = F.col("gradient") <= DEFAULT.svm_tol * F.col("first_gradient") * (1 + 1e-6)
    flat = F.greatest(F.abs("sigmoid_a"), F.abs("sigmoid_b")) <= DEFAULT.platt_tol * F.col("n_held") * (1 + 1e-6)
    return found.join(names, found["class"] == names["code"]).select(
        F.col("fit").alias("fold"), names["class"], "n_train", "n_own", "n_held", near.alias("margin_optimal"), flat.alias("sigmoid_optimal"))


_SCORED: dict = {}


def predictions(spark, sf_dir):
    """``(doc_id, split, y, p, confidence, probabilities)`` of the calibrated classifier for every prepared ticket, written once per session."""
    key = version(spark, sf_dir)
    if key not in _SCORED:
        train, _, sp = _splits(spark, sf_dir)
        scored = M.predict_calibrated(M.fit_calibrated(train), sp, _labels(sp), keep=("doc_id", "split", "topic_group"))
        _SCORED[key] = materialize(scored.withColumnsRenamed({"topic_group": "y", "predicted_class": "p"}))
    return _SCORED[key]


def _test(spark, sf_dir):
    return predictions(spark, sf_dir).filter(F.col("split") == "test")


PRED = f"""{CALIBRATED},
pr AS MATERIALIZED (SELECT sp.doc_id, sp.split, sp.topic_group AS y, b.topic_group AS p FROM sp JOIN {best_class("pt", "p")} b USING (doc_id)),
te AS (SELECT * FROM pr WHERE split = 'test'), {CLASS_CTES}"""


@register("calibrated_classes", f"WITH RECURSIVE {PRED} SELECT doc_id, split, y, p FROM pr")
def calibrated_classes(spark, sf_dir):
    """M2 + M3: the class that the calibrated classifier names for every prepared ticket."""
    return predictions(spark, sf_dir).select("doc_id", "split", "y", "p")


@register("svm_accuracy", f"""
WITH RECURSIVE {PRED}
SELECT split, round(avg(CASE WHEN y = p THEN 1.0 ELSE 0.0 END), 6) AS accuracy, CAST(count(*) AS BIGINT) AS n FROM pr GROUP BY split""")
def svm_accuracy(spark, sf_dir):
    """V1 of the calibrated classifier."""
    return V.accuracy(predictions(spark, sf_dir), by=["split"])


@register("svm_confusion_matrix", f"WITH RECURSIVE {PRED} SELECT actual, predicted, n FROM cf")
def svm_confusion_matrix(spark, sf_dir):
    """V4."""
    return V.confusion(_test(spark, sf_dir))


@register("svm_per_class", f"""
WITH RECURSIVE {PRED}
SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM pcf""")
def svm_per_class(spark, sf_dir):
    """V2."""
    pc = V.per_class(V.confusion(_test(spark, sf_dir)))
    return pc.select("class", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support")


@register("svm_averages", f"""
WITH RECURSIVE {PRED},
ag AS (SELECT avg(precision) AS mp, avg(recall) AS mr, avg(f1) AS mf, sum(precision * support) / sum(support) AS wp,
              sum(recall * support) / sum(support) AS wr, sum(f1 * support) / sum(support) AS wf, CAST(sum(support) AS BIGINT) AS support FROM pcf)
SELECT 'macro' AS average, round(mp, 6) AS precision, round(mr, 6) AS recall, round(mf, 6) AS f1, support FROM ag
UNION ALL SELECT 'weighted', round(wp, 6), round(wr, 6), round(wf, 6), support FROM ag
UNION ALL SELECT 'micro', round(wr, 6), round(wr, 6), round(wr, 6), support FROM ag""")
def svm_averages(spark, sf_dir):
    """V3."""
    return V.averages(V.per_class(V.confusion(_test(spark, sf_dir))))


@register("svm_confused_pairs", f"""
WITH RECURSIVE {PRED}
SELECT actual, predicted, round(pct, 6) AS pct FROM (SELECT *, n / sum(n) OVER (PARTITION BY actual) * 100 AS pct FROM cf) WHERE pct > 5""")
def svm_confused_pairs(spark, sf_dir):
    """V5."""
    return V.confused_pairs(V.confusion(_test(spark, sf_dir)))


@register("svm_against_trigrams", f"""
WITH RECURSIVE {PRED}, {nb_ctes(TRAIN_SRC, "(SELECT doc_id, document AS text FROM sp WHERE split = 'test')", "doc_id")},
j AS (SELECT te.y, te.p AS pa, language AS pb FROM te JOIN nbp USING (doc_id))
SELECT CAST(count(*) AS BIGINT) AS n, round(avg((y = pa)::INT), 6) AS accuracy_a, round(avg((y = pb)::INT), 6) AS accuracy_b,
       round(avg((y = pb)::INT) - avg((y = pa)::INT), 6) AS accuracy_delta, round(avg((pa = pb)::INT), 6) AS agreement,
       CAST(count(*) FILTER (WHERE pa <> pb) AS BIGINT) AS n_disagree FROM j""")
def svm_against_trigrams(spark, sf_dir):
    """V6: two models, the calibrated classifier (a) and the trigram model (b), on the test split."""
    test = _splits(spark, sf_dir)[1]
    b = langid.predict(fitted_langid(spark, sf_dir), test, "document", out="p").select("doc_id", "p")
    return V.compare_models(_test(spark, sf_dir).select("doc_id", "y", "p"), b)


@register("svm_quality_gates", f"""
WITH RECURSIVE {PRED}
SELECT CAST(count(*) AS BIGINT) AS n, avg((y = p)::INT) > 0 AS accuracy_positive,
       (SELECT count(*) FROM (SELECT max(pt.p) AS q FROM pt JOIN te USING (doc_id) GROUP BY doc_id) WHERE q < 0 OR q > 1 OR q IS NULL) AS bad_confidence,
       (SELECT count(*) FROM (SELECT sum(pt.p) AS q FROM pt JOIN te USING (doc_id) GROUP BY doc_id) WHERE abs(q - 1) > 1e-6) AS bad_probability_sum FROM te""")
def svm_quality_gates(spark, sf_dir):
    """V7."""
    return V.quality_gates(_test(spark, sf_dir))


_SERVED: dict = {}


def served(spark, sf_dir):
    """The calibrated classifier that answers requests, fitted once per session and data folder, and its class names."""
    key = version(spark, sf_dir)
    if key not in _SERVED:
        train, _, sp = _splits(spark, sf_dir)
        _SERVED[key] = (M.fit_calibrated(train), _labels(sp))
    return _SERVED[key]


def answered(spark, sf_dir):
    fits, labels = served(spark, sf_dir)
    return R.answer(R.route(requests(spark, sf_dir), fitted_langid(spark, sf_dir)), fits, labels)


@register("request_scoring")
def request_scoring(spark, sf_dir):
    """Validate -> scrub -> route -> predict -> response rows, answered by the calibrated classifier (M3)."""
    return answered(spark, sf_dir).select("conv_id", "turn", "predicted_class", "confidence", "model_used", "pii_detected", "pii_details",
                                          "routing_explanation", "prediction_details")


@register("request_classes", f"""
WITH RECURSIVE {ROUTE_CTES}, {svm_ctes(DEFAULT.calibration_folds, "(SELECT conv_id, turn, scrubbed AS text FROM rm)", "conv_id, turn")},
ok AS (SELECT * FROM rm WHERE text IS NOT NULL AND length(text) BETWEEN {DEFAULT.request_min_chars} AND {DEFAULT.request_max_chars}
         AND trim(regexp_replace(text, '^\\s+|\\s+$', '', 'g')) <> '' AND length(scrubbed) >= {DEFAULT.request_min_chars}
         AND length(scrubbed) <= CASE WHEN model_used = 'distilbert' THEN {DEFAULT.transformer_max_chars} ELSE {DEFAULT.request_max_chars} END
         AND regexp_replace(scrubbed, '^\\s+|\\s+$', '', 'g') <> '')
SELECT conv_id, turn, b.topic_group AS predicted_class, model_used, len(pd.details) > 0 AS pii_detected
FROM ok JOIN {best_class("pt", "p", "conv_id, turn")} b USING (conv_id, turn) JOIN pd USING (conv_id, turn)""")
def request_classes(spark, sf_dir):
    """G10 by its answers: class, chosen model and whether personal data were found, per request that succeeds."""
    return answered(spark, sf_dir).select("conv_id", "turn", "predicted_class", "model_used", "pii_detected")
