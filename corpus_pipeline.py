"""Corpus pipeline: five stages over ``documents``, all but the last written as Parquet and read again as the next one's input.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; all but the last return the columns of
documents.  Every stage keeps the rules of its operator for nulls, ties, repeated rows, empty tables and clashing names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deskspark.llm import cotrain, decontam, mixing, near_dup, secret_scan
from deskspark.llm.common import read, word_count
from deskspark.operators.common import materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier rejects go."""
    return cotrain.drop_low_quality(docs, read(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, similarity 0.8) stays."""
    return near_dup.drop_near_dups(docs, k=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a verbatim passage of the benchmark go."""
    return decontam.decontaminate(docs, read(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the text; every document stays."""
    return secret_scan.redact_secrets(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with size, source_size, target, copies and taken (under other names where documents has
    such columns).  A document that is taken twice is one row with 2 copies: who reads the mix repeats it."""
    out = mixing.mix(docs, word_count(F.col("text")), carry=docs.columns)
    return out.filter(F.col(out.columns[-2]) > 0)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("mixture", mixture),
]

#: A trained classifier and components can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
