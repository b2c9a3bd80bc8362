"""Personal-data patterns and the expressions built on them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# PII patterns in evaluation order, with their replacement tag.
# Matching is case-insensitive.  Two patterns share the PHONE tag.
# ---------------------------------------------------------------------------
PII_PATTERNS = (
    ("[EMAIL]", r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b"),
    ("[PHONE]", r"\b\d{3}[-.]?\d{3}[-.]?\d{4}\b"),
    ("[PHONE]", r"\b\+\d{1,3}[-.\s]?\(?\d{1,4}\)?[-.\s]?\d{1,4}[-.\s]?\d{1,9}\b"),
    ("[CREDIT_CARD]", r"\b\d{4}[-\s]?\d{4}[-\s]?\d{4}[-\s]?\d{4}\b"),
    ("[SSN]", r"\b\d{3}-\d{2}-\d{4}\b"),
    ("[IP_ADDRESS]", r"\b\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}\b"),
    ("[URL]", r"https?://[^\s]+"),
)


def flagged(pattern: str) -> str:
    """Case-insensitive, with the Unicode meaning of ``\\s``, ``\\d``, ``\\w`` and ``\\b``."""
    return "(?iU)" + pattern


def pattern_counts(text: Column) -> list[Column]:
    """Occurrences of each pattern in the original text (one column each)."""
    return [F.regexp_count(text, F.lit(flagged(p))).cast("long") for _, p in PII_PATTERNS]


def details(counts: list[Column]) -> Column:
    """``["[EMAIL]: 2 occurrence(s)", ...]`` for every pattern that hit."""
    items = F.array(*[
        F.struct(F.lit(tag).alias("tag"), n.alias("n")) for (tag, _), n in zip(PII_PATTERNS, counts)
    ])
    hits = F.filter(items, lambda s: s["n"] > 0)
    return F.transform(hits, lambda s: F.concat(s["tag"], F.lit(": "), s["n"].cast("string"),
                                                F.lit(" occurrence(s)")))


def has_pii(text: Column) -> Column:
    found = F.lit(False)
    for _, p in PII_PATTERNS:
        found = found | F.regexp_like(text, F.lit(flagged(p)))
    return F.coalesce(found, F.lit(False))


def types_from_details(det: Column) -> Column:
    """Lower-cased tag per hit pattern (``email``, ``phone``...)."""
    return F.transform(det, lambda s: F.lower(F.regexp_extract(s, r"\[(\w+)\]:", 1)))
