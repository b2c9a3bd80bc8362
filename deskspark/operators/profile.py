"""Dataset profiling and exploratory statistics (single aggregates, group-bys,
exact percentiles, equal-width histograms, box-plot statistics)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deskspark.functions.text import words
from deskspark.operators.common import exact_percentiles, materialize

FEATURES = ("word_count", "char_count", "avg_word_length", "unique_ratio")


def raw_length(c: Column) -> Column:
    """Character length of the text as a string; a null prints as 'nan' (3)."""
    return F.coalesce(F.length(c), F.lit(3)).cast("long")


def raw_words(c: Column) -> Column:
    return F.coalesce(F.size(words(c)), F.lit(1)).cast("long")


def r6(c: Column) -> Column:
    return F.round(c, 6)


def dataset_profile(df: DataFrame, text: str = "document", topic: str = "topic_group") -> DataFrame:
    """Sample count, column count, missing cells, distinct categories,
    length statistics - one aggregate pass."""
    n_missing = sum((F.col(c).isNull().cast("long") for c in df.columns), F.lit(0))
    ln = raw_length(F.col(text))
    return df.agg(
        F.count(F.lit(1)).alias("total_samples"),
        F.lit(len(df.columns)).cast("long").alias("n_columns"),
        F.sum(n_missing).cast("long").alias("missing_cells"),
        F.count_distinct(topic).alias("unique_categories"),
        r6(F.avg(ln)).alias("len_mean"),
        r6(F.percentile(ln, 0.5)).alias("len_median"),
        r6(F.stddev_samp(ln)).alias("len_std"),
        F.min(ln).alias("len_min"),
        F.max(ln).alias("len_max"))


def head(df: DataFrame, n: int = 5, order: str = "doc_id") -> DataFrame:
    """First rows in id order (the limit is the feature)."""
    return df.orderBy(order).limit(n)


def missing_values(df: DataFrame) -> DataFrame:
    """Null count per column, long form."""
    cells = [F.struct(F.lit(c).alias("column_name"),
                      F.count_if(F.col(c).isNull()).alias("n_missing")) for c in df.columns]
    return df.agg(F.array(*cells).alias("_m")).select(F.inline("_m"))


def distinct_categories(df: DataFrame, topic: str = "topic_group") -> DataFrame:
    """Number of distinct non-null categories."""
    return df.agg(F.count_distinct(topic).alias("unique_categories"))


def category_counts(df: DataFrame, topic: str = "topic_group") -> DataFrame:
    """E5: rows per category (sort with ``orderBy(desc('n'), topic)``)."""
    return df.filter(F.col(topic).isNotNull()).groupBy(topic).agg(F.count(F.lit(1)).alias("n"))


def length_stats(df: DataFrame, text: str = "document") -> DataFrame:
    """Mean, median, sample std, min, max of text length."""
    ln = raw_length(F.col(text))
    return df.agg(r6(F.avg(ln)).alias("mean"), r6(F.percentile(ln, 0.5)).alias("median"),
                  r6(F.stddev_samp(ln)).alias("std"), F.min(ln).alias("min"), F.max(ln).alias("max"))


QUARTILES = [0.25, 0.5, 0.75]


def _quartiles(col: Column) -> Column:
    """Exact linear-interpolated quartiles of an integer column of few distinct values (lengths)."""
    return F.percentile(col, F.array(*map(F.lit, QUARTILES)))


def _moments(col: Column):
    return [F.count(col).alias("count"), r6(F.avg(col)).alias("mean"), r6(F.stddev_samp(col)).alias("std"),
            r6(F.min(col).cast("double")).alias("min"), r6(F.max(col).cast("double")).alias("max")]


def _describe(col: Column):
    qs = _quartiles(col)
    return [*_moments(col), r6(qs[0]).alias("q25"), r6(qs[1]).alias("q50"), r6(qs[2]).alias("q75")]


def describe_lengths(df: DataFrame, text: str = "document") -> DataFrame:
    """describe() of characters and words, one row per feature."""
    long = df.select(F.inline(F.array(
        F.struct(F.lit("chars").alias("feature"), raw_length(F.col(text)).cast("double").alias("v")),
        F.struct(F.lit("words").alias("feature"), raw_words(F.col(text)).cast("double").alias("v")))))
    return long.groupBy("feature").agg(*_describe(F.col("v")))


def samples_per_category(df: DataFrame, n_categories: int = 3, per: int = 2, width: int = 100,
                         topic: str = "topic_group", text: str = "document", order: str = "doc_id") -> DataFrame:
    """``per`` rows from each of the first ``n_categories`` categories in
    file order, text cut to ``width`` characters.  The per-category
    ``row_number() <= per`` is planned as a window group-limit, so every
    task keeps only ``per`` rows per category before the shuffle."""
    firsts = (df.groupBy(topic).agg(F.min(order).alias("_first"))
              .withColumn("_cat_rank", F.row_number().over(Window.orderBy("_first")))
              .filter(F.col("_cat_rank") <= n_categories).select(topic, "_cat_rank"))
    w = Window.partitionBy(topic).orderBy(order)
    top = df.withColumn("sample_rank", F.row_number().over(w)).filter(F.col("sample_rank") <= per)
    return (top.join(F.broadcast(firsts), topic)  # at most n_categories rows
            .select(F.col("_cat_rank").cast("long").alias("category_rank"), topic,
                    F.col("sample_rank").cast("long"), order,
                    F.substring(F.col(text), 1, width).alias("snippet")))


def length_histogram(df: DataFrame, bins: int = 50, text: str = "document") -> DataFrame:
    """Equal-width histogram of characters and words (last bin closed)."""
    # the texts are read and split once: range and bins come from the written lengths
    sizes = materialize(df.select(raw_length(F.col(text)).cast("double").alias("chars"), F.size(words(F.col(text))).cast("double").alias("words")))
    long = sizes.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("v")) for c in ("chars", "words")])))
    rng = long.groupBy("feature").agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    width = (F.col("hi") - F.col("lo")) / bins
    idx = F.when(F.col("hi") == F.col("lo"), F.lit(0)).otherwise(
        F.least(F.lit(bins - 1), F.floor((F.col("v") - F.col("lo")) * bins / (F.col("hi") - F.col("lo")))))
    # two rows per feature: broadcast is bounded by construction
    counts = (long.join(F.broadcast(rng), "feature").withColumn("bin", idx.cast("long"))
              .groupBy("feature", "bin").agg(F.count(F.lit(1)).alias("n")))
    grid = rng.select("feature", "lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return (grid.withColumn("bin", F.col("bin").cast("long"))
            .join(counts, ["feature", "bin"], "left")
            .select("feature", "bin",
                    r6(F.col("lo") + F.col("bin") * width).alias("bin_lo"),
                    r6(F.col("lo") + (F.col("bin") + 1) * width).alias("bin_hi"),
                    F.coalesce(F.col("n"), F.lit(0)).alias("n")))


def mean_length_by_category(df: DataFrame, text: str = "document", topic: str = "topic_group") -> DataFrame:
    """Mean text length per category (ascending when sorted)."""
    return df.groupBy(topic).agg(r6(F.avg(F.length(text))).alias("mean_chars"))


def text_features(df: DataFrame, col: str = "document_clean") -> DataFrame:
    """Word count, characters, mean word length, unique words, unique
    ratio (0 for an empty text) - all in-row, no shuffle."""
    w = words(F.col(col))
    wc = F.size(w)
    chars_in_words = F.aggregate(w, F.lit(0), lambda acc, x: acc + F.length(x))
    uniq = F.size(F.array_distinct(w))
    return (df.withColumn("word_count", wc.cast("long"))
            .withColumn("char_count", F.length(col).cast("long"))
            .withColumn("avg_word_length", F.when(wc > 0, chars_in_words / wc).otherwise(F.lit(0.0)))
            .withColumn("unique_words", uniq.cast("long"))
            .withColumn("unique_ratio", F.when(wc > 0, uniq / wc).otherwise(F.lit(0.0))))


def _features_long(df: DataFrame, topic: str) -> DataFrame:
    return df.select(topic, F.inline(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("v")) for f in FEATURES])))


def features_by_class(df: DataFrame, topic: str = "topic_group") -> DataFrame:
    """describe() of the four E11 features per class."""
    long = _features_long(df, topic)
    qs = exact_percentiles(long, [topic, "feature"], "v", QUARTILES).select(
        F.col(topic).alias("_t"), F.col("feature").alias("_f"), r6(F.col("_q0")).alias("q25"), r6(F.col("_q1")).alias("q50"),
        r6(F.col("_q2")).alias("q75"))
    base = long.groupBy(topic, "feature").agg(*_moments(F.col("v")))
    return base.join(qs, F.col(topic).eqNullSafe(F.col("_t")) & (F.col("feature") == F.col("_f")), "left").drop("_t", "_f")


def boxplot_stats(df: DataFrame, topic: str = "topic_group", k: float = 1.5) -> DataFrame:
    """Quartiles, 1.5 IQR whiskers and outlier count per class/feature."""
    long = _features_long(df, topic)
    qs = exact_percentiles(long, [topic, "feature"], "v", QUARTILES).withColumnsRenamed({"_q0": "q1", "_q1": "median", "_q2": "q3"})
    qs = (qs.withColumn("iqr", F.col("q3") - F.col("q1"))
          .withColumn("lo_fence", F.col("q1") - k * F.col("iqr"))
          .withColumn("hi_fence", F.col("q3") + k * F.col("iqr")))
    j = long.join(qs, [topic, "feature"])
    inside = (F.col("v") >= F.col("lo_fence")) & (F.col("v") <= F.col("hi_fence"))
    agg = j.groupBy(topic, "feature", "q1", "median", "q3", "iqr").agg(
        F.min(F.when(inside, F.col("v"))).alias("whisker_lo"),
        F.max(F.when(inside, F.col("v"))).alias("whisker_hi"),
        F.count_if(~inside).alias("n_outliers"))
    return agg.select(topic, "feature", *[r6(F.col(c)).alias(c) for c in
                                          ("q1", "median", "q3", "iqr", "whisker_lo", "whisker_hi")],
                      "n_outliers")


def class_weights(df: DataFrame, label: str = "topic_encoded") -> DataFrame:
    """Balanced weights ``N / (k * n_c)``."""
    c = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    allw = Window.partitionBy()
    return c.withColumn("weight", r6(F.sum("n").over(allw) / (F.count(F.lit(1)).over(allw) * F.col("n"))))
