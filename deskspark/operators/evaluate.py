"""Classification evaluation from a predictions table ``(y, p)`` (V1-V7).

Everything after the confusion table works on at most k*k rows (k =
number of classes), so the expensive part is one group-by over the
predictions, with map-side partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _r(c):
    return F.round(c, 6)


def accuracy(pred: DataFrame, y: str = "y", p: str = "p", by: list[str] | None = None) -> DataFrame:
    """V1: share of rows with ``y = p`` (optionally per ``by`` group)."""
    acc = _r(F.avg((F.col(y) == F.col(p)).cast("double"))).alias("accuracy")
    n = F.count(F.lit(1)).alias("n")
    return pred.groupBy(*(by or [])).agg(acc, n)


def confusion(pred: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """V4: ``(actual, predicted, n)`` for every pair of classes seen in
    either column (zero cells included)."""
    counts = pred.groupBy(F.col(y).alias("actual"), F.col(p).alias("predicted")).agg(F.count(F.lit(1)).alias("n"))
    # classes x classes counted pairs at most
    classes = counts.select(F.explode(F.array("actual", "predicted")).alias("c")).agg(
        F.array_sort(F.collect_set("c")).alias("cs"))
    grid = (classes.select(F.explode("cs").alias("actual"), "cs")
            .select("actual", F.explode("cs").alias("predicted")))
    return (grid.join(counts, ["actual", "predicted"], "left")
            .select("actual", "predicted", F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n")))


def per_class(conf: DataFrame) -> DataFrame:
    """V2: precision, recall, F1 and support per class; 0 on a zero
    denominator.  Row sums, column sums and the diagonal come from one
    group-by over the exploded confusion cells."""
    cells = conf.select(F.inline(F.array(
        F.struct(F.col("actual").alias("cls"), F.lit(True).alias("is_actual"), F.col("n"),
                 (F.col("actual") == F.col("predicted")).alias("diag")),
        F.struct(F.col("predicted").alias("cls"), F.lit(False).alias("is_actual"), F.col("n"),
                 F.lit(False).alias("diag")))))
    s = cells.groupBy("cls").agg(
        F.sum(F.when(F.col("is_actual"), F.col("n")).otherwise(0)).alias("support"),
        F.sum(F.when(~F.col("is_actual"), F.col("n")).otherwise(0)).alias("n_pred"),
        F.sum(F.when(F.col("diag"), F.col("n")).otherwise(0)).alias("tp"))
    prec = F.coalesce(F.try_divide(F.col("tp"), F.col("n_pred")), F.lit(0.0))
    rec = F.coalesce(F.try_divide(F.col("tp"), F.col("support")), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * prec * rec, prec + rec), F.lit(0.0))
    return s.select(F.col("cls").alias("class"), prec.alias("precision"), rec.alias("recall"),
                    f1.alias("f1"), F.col("support").cast("long").alias("support"))


def averages(pc: DataFrame) -> DataFrame:
    """V3: macro, weighted and micro averages over the V2 table."""
    tot = F.sum("support")
    w = lambda c: F.sum(F.col(c) * F.col("support")) / tot
    micro = F.sum(F.col("recall") * F.col("support")) / tot  # pooled tp / n
    agg = pc.agg(F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
                 w("precision").alias("wp"), w("recall").alias("wr"), w("f1").alias("wf"),
                 micro.alias("mi"), tot.cast("long").alias("support"))
    def row(name, pr, rc, f1):
        return F.struct(F.lit(name).alias("average"), _r(F.col(pr)).alias("precision"),
                        _r(F.col(rc)).alias("recall"), _r(F.col(f1)).alias("f1"), F.col("support"))
    return agg.select(F.inline(F.array(row("macro", "mp", "mr", "mf"), row("weighted", "wp", "wr", "wf"),
                                       row("micro", "mi", "mi", "mi"))))


def confused_pairs(conf: DataFrame, threshold_pct: float = 5.0) -> DataFrame:
    """V5: row-normalised cells above ``threshold_pct`` (diagonal included)."""
    pct = F.col("n") / F.sum("n").over(Window.partitionBy("actual")) * 100
    return (conf.withColumn("pct", pct).filter(F.col("pct") > threshold_pct)
            .select("actual", "predicted", _r(F.col("pct")).alias("pct")))


def compare_models(a: DataFrame, b: DataFrame, key: str = "doc_id", y: str = "y") -> DataFrame:
    """V6: two prediction sets on the same rows -> accuracy of each, delta,
    agreement rate and disagreement count (one join on the row key)."""
    j = a.select(key, y, F.col("p").alias("pa")).join(b.select(key, F.col("p").alias("pb")), key)
    agg = j.agg(F.count(F.lit(1)).alias("n"),
                F.avg((F.col(y) == F.col("pa")).cast("double")).alias("acc_a"),
                F.avg((F.col(y) == F.col("pb")).cast("double")).alias("acc_b"),
                F.avg((F.col("pa") == F.col("pb")).cast("double")).alias("agreement"),
                F.count_if(F.col("pa") != F.col("pb")).alias("n_disagree"))
    return agg.select("n", _r(F.col("acc_a")).alias("accuracy_a"), _r(F.col("acc_b")).alias("accuracy_b"),
                      _r(F.col("acc_b") - F.col("acc_a")).alias("accuracy_delta"),
                      _r(F.col("agreement")).alias("agreement"), "n_disagree")


def quality_gates(pred: DataFrame, y: str = "y", p: str = "p", tol: float = 1e-6) -> DataFrame:
    """V7: accuracy > 0, confidence within [0, 1], probabilities summing
    to 1 - counted as violations (``probabilities`` is an array of
    ``struct(label, prob)``)."""
    psum = F.aggregate("probabilities", F.lit(0.0), lambda acc, s: acc + s["prob"])
    return pred.agg(
        F.count(F.lit(1)).alias("n"),
        (F.avg((F.col(y) == F.col(p)).cast("double")) > 0).alias("accuracy_positive"),
        F.count_if((F.col("confidence") < 0) | (F.col("confidence") > 1) | F.col("confidence").isNull())
        .alias("bad_confidence"),
        F.count_if(F.abs(psum - 1.0) > tol).alias("bad_probability_sum"))
