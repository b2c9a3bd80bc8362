"""Batch preparation: null drop, cleaning, length filter, first-row dedup,
optional stop-word removal, label encoding and exact reproducible splits."""

from __future__ import annotations

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from deskspark.config import DEFAULT, Params
from deskspark.functions import stopwords
from deskspark.functions.text import clean_text
from deskspark.operators.common import checked_broadcast, materialize, order_key, quota_split, release

REQUIRED = ("document", "topic_group")


def drop_incomplete(df: DataFrame, cols=REQUIRED) -> DataFrame:
    """Drop rows where a required column is null."""
    return df.dropna(subset=list(cols))


def with_clean_text(df: DataFrame, src: str = "document", dst: str = "document_clean",
                    remove_accents: bool = True) -> DataFrame:
    """Add the normalised text column."""
    return df.withColumn(dst, clean_text(F.col(src), remove_accents))


def min_length(df: DataFrame, n: int = DEFAULT.min_text_length, col: str = "document_clean") -> DataFrame:
    """Keep cleaned texts with at least ``n`` characters."""
    return df.filter(F.length(col) >= n)


def dedup_first(df: DataFrame, key: str = "document_clean", order: str = "doc_id",
                min_len: int | None = None) -> DataFrame:
    """One row per ``key``, the one with the smallest ``order``.

    Expressed as ``min(struct(order, ...))`` per key, a partial aggregate:
    each map task keeps one row per key before the shuffle, so a key that
    holds a third of the table sends one row per task, not a third of the
    table, to its reducer.

    ``min_len`` fuses P3: the length depends only on the key, so groups
    are dropped on an aggregate output.  A row filter would be pushed below
    the projection by the optimiser and evaluate the cleaning expression a
    second time; the aggregate output cannot be pushed down.

    The group key is ``sha2(key, 256)``: 32 bytes to sort and hash instead
    of a whole text (the text itself travels in the payload).
    """
    payload = [order] + [c for c in df.columns if c != order]
    aggs = [F.min(F.struct(*payload)).alias("_first")]
    if min_len is not None:
        aggs.append(F.max(F.length(key)).alias("_len"))
    first = df.groupBy(F.sha2(F.col(key), 256).alias("_k")).agg(*aggs)
    if min_len is not None:
        first = first.filter(F.col("_len") >= min_len)
    return first.select(*[F.col(f"_first.{c}").alias(c) for c in payload])


def remove_stopwords(df: DataFrame, col: str = "document_clean", words=None) -> DataFrame:
    """P5: whitespace tokens minus English stop words, re-joined by space.
    Uses MLlib's in-row ``StopWordsRemover`` (hash-set lookup, no shuffle)."""
    words = list(words or stopwords.english())
    tmp = df.withColumn("_tok", F.split(F.col(col), " "))
    rem = StopWordsRemover(inputCol="_tok", outputCol="_kept", stopWords=words, caseSensitive=True)
    out = rem.transform(tmp)
    return out.withColumn(col, F.array_join(F.filter("_kept", lambda t: t != ""), " ")).drop("_tok", "_kept")


def label_dictionary(df: DataFrame, col: str = "topic_group") -> DataFrame:
    """P6 fit: ascending distinct classes -> code 0..k-1 (k-row table)."""
    classes = df.select(F.col(col).cast("string").alias(col)).distinct()
    return classes.select((F.dense_rank().over(Window.orderBy(col)) - 1).cast("int").alias("topic_encoded"),
                          col)


def label_encode(df: DataFrame, labels: DataFrame, params: Params = DEFAULT,
                 col: str = "topic_group") -> DataFrame:
    """P6 transform: attach ``topic_encoded`` via a size-checked broadcast."""
    small = checked_broadcast(labels, params.broadcast_max_rows)
    return df.withColumn(col, F.col(col).cast("string")).join(small, col)


def label_decode(df: DataFrame, labels: DataFrame, code: str = "predicted_encoded",
                 out: str = "predicted_class", params: Params = DEFAULT) -> DataFrame:
    """Code -> class name."""
    small = checked_broadcast(labels.select(F.col("topic_encoded").alias(code),
                                            F.col("topic_group").alias(out)), params.broadcast_max_rows)
    return df.join(small, code, "left")


def class_counts(df: DataFrame, label: str = "topic_encoded") -> DataFrame:
    """Per-class counts plus the stratification gate (every class >= 2)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("can_stratify", F.min("n").over(Window.partitionBy()) >= 2)


def _stratified_quotas(counts: DataFrame, label: str, fraction: str) -> DataFrame:
    """Per-class test quota: floor share of ``ceil(fraction * n)`` plus one
    extra for the largest remainders (ties by class code)."""
    allw = Window.partitionBy()
    q = (counts.withColumn("_tot", F.sum("n").over(allw))
         .withColumn("_nt", F.expr(f"CAST(ceil(_tot * {fraction}) AS BIGINT)"))
         .withColumn("_base", F.expr("(n * _nt) div _tot"))
         .withColumn("_rem", F.expr("(n * _nt) % _tot")))
    q = q.withColumn("_left", F.col("_nt") - F.sum("_base").over(allw))
    q = q.withColumn("_rk", F.row_number().over(Window.orderBy(F.desc("_rem"), F.col(label))))
    return q.select(label, (F.col("_base") + (F.col("_rk") <= F.col("_left")).cast("long")).alias("quota"))


def split(df: DataFrame, params: Params = DEFAULT, label: str = "topic_encoded",
          id_col: str = "doc_id", fraction: str | None = None, salt: str = "",
          stratify: bool | None = None, out: str = "split",
          names: tuple[str, str] = ("test", "train")) -> DataFrame:
    """Exact reproducible split.  Rows are ordered by
    ``md5("<id>-<seed><salt>")``; per class (or globally when a class has
    fewer than two rows) the first ``quota`` rows go to ``names[0]``."""
    fraction = fraction or params.test_fraction
    keyed = df.withColumn("_key", order_key(id_col, f"{params.seed}{salt}"))
    if label:
        counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    else:
        counts = df.agg(F.count(F.lit(1)).alias("n"))
    if stratify is None:
        stratify = counts.agg(F.min("n")).first()[0] >= 2 if label else False
    if stratify:
        quota = _stratified_quotas(counts, label, fraction)
        by = [label]
    else:
        quota = counts.agg(F.expr(f"CAST(ceil(sum(n) * {fraction}) AS BIGINT)").alias("quota"))
        by = []
    flagged = quota_split(keyed, by, "_key", id_col, quota, "_first",
                          params.split_bucket_hex_digits, params.broadcast_max_rows)
    return flagged.withColumn(out, F.when(F.col("_first"), names[0]).otherwise(names[1])).drop("_first", "_key")


def train_validation_split(train: DataFrame, params: Params = DEFAULT, id_col: str = "doc_id") -> DataFrame:
    """Train -> train / validation, not stratified, its own order."""
    return split(train, params, label=None, id_col=id_col, fraction=params.validation_fraction,
                 salt="-validation", stratify=False, names=("validation", "train"))


def prepared_tickets(raw: DataFrame, params: Params = DEFAULT, write: bool = True) -> DataFrame:
    """P1-P6 chained: the prepared ticket table.

    With ``write=True`` the cleaned, de-duplicated table is written once to
    the checkpoint folder: label fitting, the split's count passes and the
    downstream jobs then scan it instead of re-running the regex cleaning.
    """
    df = drop_incomplete(raw)
    df = with_clean_text(df)
    df = dedup_first(df, min_len=params.min_text_length)  # P3 + P4 in one aggregate
    if params.remove_stopwords:
        df = remove_stopwords(df)
    if write:
        df = materialize(df, "zstd")
        release(raw.sparkSession.sparkContext)
    labels = label_dictionary(df)
    return label_encode(df, labels, params)


def row_funnel(raw: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """Rows removed at every stage and the final / train / test sizes,
    in one conditional aggregate plus one distinct count."""
    x = raw.withColumn("_ok", F.col("document").isNotNull() & F.col("topic_group").isNotNull())
    x = x.withColumn("_clean", F.when(F.col("_ok"), clean_text(F.col("document"))))
    x = x.withColumn("_long", F.col("_ok") & (F.length("_clean") >= params.min_text_length))
    agg = x.agg(
        F.count(F.lit(1)).alias("total_samples"),
        F.count_if(~F.col("_ok")).alias("removed_missing"),
        F.count_if(F.col("_ok") & ~F.col("_long")).alias("removed_short"),
        F.count_if(F.col("_long")).alias("_kept"),
        F.count_distinct(F.when(F.col("_long"), F.sha2(F.col("_clean"), 256))).alias("final_samples"))
    frac = params.test_fraction
    return agg.select(
        "total_samples", "removed_missing", "removed_short",
        (F.col("_kept") - F.col("final_samples")).alias("removed_duplicates"),
        "final_samples",
        (F.col("final_samples") - F.expr(f"CAST(ceil(final_samples * {frac}) AS BIGINT)")).alias("train_samples"),
        F.expr(f"CAST(ceil(final_samples * {frac}) AS BIGINT)").alias("test_samples"))


def validate_requests(df: DataFrame, text: str = "text", params: Params = DEFAULT) -> DataFrame:
    """Request validation for the agent / TF-IDF (10..5000 chars) and
    the transformer (10..512) endpoints.  Length is tested on the raw value,
    blank values are rejected, accepted values are stripped."""
    n = F.length(F.col(text))
    blank = F.trim(F.regexp_replace(F.col(text), r"(?U)^\s+|\s+$", "")) == ""
    ok = lambda lo, hi: F.col(text).isNotNull() & (n >= lo) & (n <= hi) & ~blank
    return (df.withColumn("n_chars", n.cast("long"))
            .withColumn("agent_ok", ok(params.request_min_chars, params.request_max_chars))
            .withColumn("transformer_ok", ok(params.request_min_chars, params.transformer_max_chars))
            .withColumn("text_stripped", F.regexp_replace(F.col(text), r"(?U)^\s+|\s+$", "")))
