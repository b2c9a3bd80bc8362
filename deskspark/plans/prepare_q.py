"""Preparation queries: S1, P1-P13 and the flagship category distribution."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from deskspark.config import DEFAULT
from deskspark.functions import stopwords
from deskspark.operators import prepare as P
from deskspark.operators.common import materialize
from deskspark.plans import register
from deskspark.plans.sqlparts import md5_key, prepared_ctes, split_ctes
from deskspark.functions.text import clean_text_sql
from deskspark.session import ensure_checkpoint_dir
from deskspark.sources.tables import read_ticket_csv, table, tickets, version

PREP = prepared_ctes()
SPLIT = split_ctes()


_WRITTEN: dict = {}


def prepared(spark, sf_dir, params=DEFAULT, topic="lang"):
    """Prepared tickets (P1-P6).  The cleaned table is the output of the
    preparation stage: it is written once per session and data folder and
    later queries scan the written copy (like the processed files that the
    training and analysis stages read)."""
    key = (version(spark, sf_dir), params, topic)
    if key not in _WRITTEN:
        _WRITTEN[key] = P.prepared_tickets(tickets(spark, sf_dir, topic), params, write=True)
    return _WRITTEN[key]


def prepared_split(spark, sf_dir, params=DEFAULT, reuse=False, topic="lang"):
    """Prepared tickets with their split.  ``reuse=True`` writes the table
    to the checkpoint folder once per session, for plans that run several jobs on it."""
    sp = P.split(prepared(spark, sf_dir, params, topic), params)
    if not reuse:
        return sp
    key = ("split", version(spark, sf_dir), params, topic)
    if key not in _WRITTEN:
        _WRITTEN[key] = materialize(sp, "zstd")
    return _WRITTEN[key]


def train_rows(spark, sf_dir, params=DEFAULT):
    return prepared_split(spark, sf_dir, params).filter(F.col("split") == "train")


def written_train(spark, sf_dir, params=DEFAULT):
    """The training rows as a classifier reads them (doc_id, document_clean, topic_encoded), written once per session: less than half
    of the split, which is read instead where it has been written."""
    state = version(spark, sf_dir)
    if ("split", state, params, "lang") in _WRITTEN:
        return _WRITTEN["split", state, params, "lang"].filter(F.col("split") == "train")
    if ("train", state, params) not in _WRITTEN:
        _WRITTEN["train", state, params] = materialize(train_rows(spark, sf_dir, params).select("doc_id", "document_clean", "topic_encoded"), "zstd")
    return _WRITTEN["train", state, params]


@register("category_distribution", f"""
WITH {PREP}, {SPLIT}
SELECT split, topic_group, topic_encoded, CAST(count(*) AS BIGINT) AS n
FROM sp GROUP BY split, topic_group, topic_encoded""")
def category_distribution(spark, sf_dir):
    """Flagship: prepared tickets -> stratified split -> class counts per split."""
    sp = prepared_split(spark, sf_dir)
    return sp.groupBy("split", "topic_group", "topic_encoded").agg(F.count(F.lit(1)).alias("n"))


@register("category_distribution_by_source", f"""
WITH {prepared_ctes(topic="source")}, {SPLIT}
SELECT split, topic_group, topic_encoded, CAST(count(*) AS BIGINT) AS n
FROM sp GROUP BY split, topic_group, topic_encoded""")
def category_distribution_by_source(spark, sf_dir):
    """The flagship with the 20-class ``source`` label."""
    sp = prepared_split(spark, sf_dir, topic="source")
    return sp.groupBy("split", "topic_group", "topic_encoded").agg(F.count(F.lit(1)).alias("n"))


@register("ticket_scan", "SELECT doc_id, text AS document, lang AS topic_group FROM documents")
def ticket_scan(spark, sf_dir):
    """Ticket rows bound to the documents table."""
    return tickets(spark, sf_dir)


@register("ticket_csv_scan", """
SELECT sha256(text) AS digest, lang AS topic_group, CAST(count(*) AS BIGINT) AS n, CAST(0 AS BIGINT) AS n_corrupt FROM documents GROUP BY ALL""")
def ticket_csv_scan(spark, sf_dir):
    """All documents written as quoted multi-line CSV and read back by several tasks per file."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/deskspark-tables/csv-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents").select(F.col("text").alias("Document"), F.col("lang").alias("Topic_group"))
    docs.write.option("header", True).option("escape", '"').option("quoteAll", True).option("lineSep", "\n").csv(path)
    rows = read_ticket_csv(spark, path, corrupt=True)
    return rows.groupBy(F.sha2("document", 256).alias("digest"), "topic_group").agg(
        F.count(F.lit(1)).alias("n"), F.count("_corrupt_record").alias("n_corrupt"))


@register("drop_incomplete", """
SELECT doc_id, lang AS topic_group FROM documents WHERE text IS NOT NULL AND lang IS NOT NULL""")
def drop_incomplete(spark, sf_dir):
    """P1."""
    return P.drop_incomplete(tickets(spark, sf_dir)).select("doc_id", "topic_group")


@register("clean_text", f"SELECT doc_id, {clean_text_sql('text')} AS document_clean FROM documents")
def clean_text_q(spark, sf_dir):
    """Cleaned text of every document."""
    return P.with_clean_text(tickets(spark, sf_dir)).select("doc_id", "document_clean")


@register("min_length_filter", f"""
WITH {PREP} SELECT doc_id, document_clean FROM lf""")
def min_length_filter(spark, sf_dir):
    """P3."""
    df = P.with_clean_text(P.drop_incomplete(tickets(spark, sf_dir)))
    return P.min_length(df).select("doc_id", "document_clean")


@register("dedup_first", f"""
WITH {PREP} SELECT doc_id, document_clean FROM dd""")
def dedup_first(spark, sf_dir):
    """First row per cleaned text."""
    df = P.with_clean_text(P.drop_incomplete(tickets(spark, sf_dir)))
    return P.dedup_first(df, min_len=DEFAULT.min_text_length).select("doc_id", "document_clean")


_STOP = stopwords.sql_list()


@register("stopword_removal", f"""
WITH {PREP}
SELECT doc_id, array_to_string(list_filter(string_split(document_clean, ' '),
       lambda t: t <> '' AND NOT list_contains([{_STOP}], t)), ' ') AS document_clean FROM dd""")
def stopword_removal(spark, sf_dir):
    """P5: prepared text with English stop words removed."""
    df = P.dedup_first(P.with_clean_text(P.drop_incomplete(tickets(spark, sf_dir))), min_len=DEFAULT.min_text_length)
    return P.remove_stopwords(df).select("doc_id", "document_clean")


@register("label_dictionary", f"WITH {PREP} SELECT topic_encoded, topic_group FROM lab")
def label_dictionary(spark, sf_dir):
    """P6 fit."""
    df = P.dedup_first(P.with_clean_text(P.drop_incomplete(tickets(spark, sf_dir))), min_len=DEFAULT.min_text_length)
    return P.label_dictionary(df)


@register("label_roundtrip", f"""
WITH {PREP}
SELECT e.doc_id, e.topic_encoded, l.topic_group AS topic_decoded
FROM enc e LEFT JOIN lab l ON e.topic_encoded = l.topic_encoded""")
def label_roundtrip(spark, sf_dir):
    """P6 transform + P7 decode."""
    df = P.dedup_first(P.with_clean_text(P.drop_incomplete(tickets(spark, sf_dir))), min_len=DEFAULT.min_text_length)
    labels = P.label_dictionary(df)
    enc = P.label_encode(df, labels)
    dec = P.label_decode(enc.withColumn("code", F.col("topic_encoded")), labels, code="code",
                         out="topic_decoded")
    return dec.select("doc_id", "topic_encoded", "topic_decoded")


@register("class_counts", f"""
WITH {PREP}
SELECT topic_encoded, CAST(count(*) AS BIGINT) AS n, min(count(*)) OVER () >= 2 AS can_stratify
FROM enc GROUP BY topic_encoded""")
def class_counts(spark, sf_dir):
    """P8."""
    return P.class_counts(prepared(spark, sf_dir))


@register("stratified_split", f"WITH {PREP}, {SPLIT} SELECT doc_id, topic_encoded, split FROM sp")
def stratified_split(spark, sf_dir):
    """P9."""
    return prepared_split(spark, sf_dir).select("doc_id", "topic_encoded", "split")


@register("unstratified_split", f"""
WITH {PREP},
nt AS (SELECT CAST(ceil(count(*) * {DEFAULT.test_fraction}) AS BIGINT) AS q FROM enc),
rk AS (SELECT doc_id, row_number() OVER (ORDER BY {md5_key('doc_id', str(DEFAULT.seed))}, doc_id) AS r FROM enc)
SELECT doc_id, CASE WHEN r <= (SELECT q FROM nt) THEN 'test' ELSE 'train' END AS split FROM rk""")
def unstratified_split(spark, sf_dir):
    """P10: the branch taken when a class has fewer than two rows."""
    return P.split(prepared(spark, sf_dir), stratify=False).select("doc_id", "split")


@register("train_validation_split", f"""
WITH {PREP}, {SPLIT},
tr AS (SELECT doc_id FROM sp WHERE split = 'train'),
nv AS (SELECT CAST(ceil(count(*) * {DEFAULT.validation_fraction}) AS BIGINT) AS q FROM tr),
rv AS (SELECT doc_id, row_number() OVER (ORDER BY {md5_key('doc_id', str(DEFAULT.seed) + '-validation')}, doc_id) AS r
       FROM tr)
SELECT doc_id, CASE WHEN r <= (SELECT q FROM nv) THEN 'validation' ELSE 'train' END AS split FROM rv""")
def train_validation_split(spark, sf_dir):
    """P11."""
    tr = train_rows(spark, sf_dir).drop("split")
    return P.train_validation_split(tr).select("doc_id", "split")


@register("row_funnel", f"""
WITH {PREP}
SELECT (SELECT CAST(count(*) AS BIGINT) FROM raw) AS total_samples,
       (SELECT CAST(count(*) AS BIGINT) FROM raw) - (SELECT CAST(count(*) AS BIGINT) FROM nn) AS removed_missing,
       (SELECT CAST(count(*) AS BIGINT) FROM nn) - (SELECT CAST(count(*) AS BIGINT) FROM lf) AS removed_short,
       (SELECT CAST(count(*) AS BIGINT) FROM lf) - (SELECT CAST(count(*) AS BIGINT) FROM dd) AS removed_duplicates,
       (SELECT CAST(count(*) AS BIGINT) FROM dd) AS final_samples,
       (SELECT CAST(count(*) AS BIGINT) FROM dd)
         - CAST(ceil((SELECT count(*) FROM dd) * {DEFAULT.test_fraction}) AS BIGINT) AS train_samples,
       CAST(ceil((SELECT count(*) FROM dd) * {DEFAULT.test_fraction}) AS BIGINT) AS test_samples""")
def row_funnel(spark, sf_dir):
    """P12."""
    return P.row_funnel(tickets(spark, sf_dir))


@register("request_validation", f"""
SELECT conv_id, turn, CAST(length(text) AS BIGINT) AS n_chars,
       (text IS NOT NULL AND length(text) BETWEEN {DEFAULT.request_min_chars} AND {DEFAULT.request_max_chars}
        AND trim(regexp_replace(text, '^\\s+|\\s+$', '', 'g')) <> '') AS agent_ok,
       (text IS NOT NULL AND length(text) BETWEEN {DEFAULT.request_min_chars} AND {DEFAULT.transformer_max_chars}
        AND trim(regexp_replace(text, '^\\s+|\\s+$', '', 'g')) <> '') AS transformer_ok
FROM conversations WHERE role = 'user'""")
def request_validation(spark, sf_dir):
    """User turns as requests, checked for both endpoints."""
    conv = table(spark, sf_dir, "conversations").filter(F.col("role") == "user")
    return P.validate_requests(conv).select("conv_id", "turn", "n_chars", "agent_ok", "transformer_ok")
