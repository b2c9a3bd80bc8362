"""Cleaning cases (P2) evaluated by Spark on literal rows."""

import pytest
from pyspark.sql import functions as F

from deskspark.functions.text import clean_text, transliterate

CASES = [
    ("Hello World! This is a TEST.", "hello world this is a test"),
    ("Too        many     spaces", "too many spaces"),
    ("", ""),
    (None, ""),
    ("Café Straße Œuvre naïve", "cafe strasse oeuvre naive"),
    ("See INC-12345 now", "see now"),
    ("order 1234567 and 12345 kept", "order and 12345 kept"),
    ("visit https://x.org/a?b=1 or www.site.com today", "visit or today"),
]


@pytest.mark.parametrize("raw,expected", CASES)
def test_clean_cases(spark, raw, expected):
    df = spark.createDataFrame([(raw,)], "t string")
    assert df.select(clean_text(F.col("t")).alias("c")).first()["c"] == expected


def test_special_characters_removed(spark):
    df = spark.createDataFrame([("Email: user@example.com & Phone: 123-456-7890",)], "t string")
    out = df.select(clean_text(F.col("t")).alias("c")).first()["c"]
    assert "@" not in out and "&" not in out and "-" not in out
    assert out == "email phone 123 456 7890"


def test_transliteration_is_ascii(spark):
    import unicodedata

    letters = "".join(chr(c) for c in range(0xC0, 0x180) if unicodedata.category(chr(c)).startswith("L"))
    df = spark.createDataFrame([(letters,)], "t string")
    out = df.select(transliterate(F.col("t")).alias("c")).first()["c"]
    assert out.isascii()
