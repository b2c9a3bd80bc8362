"""PII detection and scrubbing over a text column (G1-G4), all native regex."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskspark.functions import pii
from deskspark.operators.common import bind


def detect(df: DataFrame, text: str = "text") -> DataFrame:
    """G1 + G3: per-pattern counts on the original text, the
    ``"[TAG]: n occurrence(s)"`` list and ``pii_detected``."""
    counts = pii.pattern_counts(F.col(text))
    out = df
    for i, c in enumerate(counts):
        out = out.withColumn(f"_pii{i}", c)
    cols = [F.col(f"_pii{i}") for i in range(len(counts))]
    out = out.withColumn("pii_details", pii.details(cols))
    out = out.withColumn("pii_detected", F.size("pii_details") > 0)
    return out


def scrub(df: DataFrame, text: str = "text", out: str = "scrubbed_text") -> DataFrame:
    """Replace, in pattern order, on the progressively scrubbed text, but
    only patterns that occur in the original (needs ``detect`` first)."""
    done = F.col(text)
    for i, (tag, pat) in enumerate(pii.PII_PATTERNS):
        # each step names the one before it once, so that a pushed-down copy doesn't double with every pattern
        done = bind(done, _step(pii.flagged(pat), tag, F.col(f"_pii{i}")))
    return df.withColumn(out, done)


def _step(pattern: str, tag: str, hits: Column):
    return lambda t: F.when(hits > 0, F.regexp_replace(t, pattern, tag)).otherwise(t)


def types(df: DataFrame, details: str = "pii_details", out: str = "pii_types") -> DataFrame:
    """Lower-cased tag per hit pattern."""
    return df.withColumn(out, pii.types_from_details(F.col(details)))


def drop_counts(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith("_pii")])


def has_pii(df: DataFrame, text: str = "text", out: str = "has_pii") -> DataFrame:
    """G3 on its own (short-circuit OR of pattern matches)."""
    return df.withColumn(out, pii.has_pii(F.col(text)))
