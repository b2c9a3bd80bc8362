"""PII (G1-G4) and routing (G6-G9, G11) on literal requests."""

from pyspark.sql import functions as F

from deskspark.config import DEFAULT
from deskspark.operators import pii
from deskspark.operators import routing as R


def _pii(spark, text):
    df = spark.createDataFrame([(1, text)], "id long, text string")
    return pii.types(pii.scrub(pii.detect(df))).first()


def test_email_and_phone(spark):
    r = _pii(spark, "Contact john.doe@example.com or call 555-123-4567")
    assert r["pii_details"] == ["[EMAIL]: 1 occurrence(s)", "[PHONE]: 1 occurrence(s)"]
    assert r["scrubbed_text"] == "Contact [EMAIL] or call [PHONE]"
    assert r["pii_types"] == ["email", "phone"]
    assert r["pii_detected"]


def test_url_with_ip_reports_both_and_becomes_url(spark):
    r = _pii(spark, "see http://10.0.0.1/x now")
    assert r["pii_types"] == ["ip_address", "url"]
    assert r["scrubbed_text"] == "see [URL] now"


def test_international_phone_needs_word_boundary(spark):
    assert _pii(spark, "call tel+33 612345678")["pii_types"] == ["phone"]
    assert _pii(spark, "call tel +33 612345678")["pii_types"] == []


def test_ssn_card_counts(spark):
    r = _pii(spark, "ssn 123-45-6789 card 4111 1111 1111 1111 and 4111-1111-1111-1111")
    assert "[SSN]: 1 occurrence(s)" in r["pii_details"]
    assert "[CREDIT_CARD]: 2 occurrence(s)" in r["pii_details"]


def test_no_pii(spark):
    r = _pii(spark, "printer not working again")
    assert r["pii_details"] == [] and not r["pii_detected"]


def test_has_pii(spark):
    df = spark.createDataFrame([("a@b.com",), ("nothing here",)], "text string")
    assert [x["has_pii"] for x in pii.has_pii(df).collect()] == [True, False]


LONG = ("My laptop started overheating after the latest update and now the fan runs loudly all day "
        "while the battery drains in under an hour even with every background application closed and the "
        "screen brightness reduced so I cannot work away from my desk today")


def _route(spark, rows):
    df = spark.createDataFrame(rows, "lang string, text string, cx string")
    x = df.withColumn("wc", F.size(F.split(F.trim("text"), r"\s+")))
    return [r["m"] for r in x.select(R.choose_model(F.col("lang"), F.col("wc"),
                                                    R.normalize_complexity(F.col("cx"))).alias("m")).collect()]


def test_route_rules(spark):
    assert len(LONG.split()) == 44
    rows = [("en", "This printer not working", None), ("en", LONG, None), ("fr", "imprimante en panne", None),
            ("en", "This printer not working", "0.9"), ("en", "This printer not working", "oops")]
    assert _route(spark, rows) == ["tfidf", "distilbert", "distilbert", "distilbert", "tfidf"]


def test_complexity_normalisation(spark):
    df = spark.createDataFrame([("0.7",), ("1.5",), ("-2",), ("abc",), (None,), (" 0.25 ",)], "x string")
    got = [r["c"] for r in df.select(R.normalize_complexity(F.col("x")).alias("c")).collect()]
    assert got == [0.7, 1.0, 0.0, 0.5, 0.5, 0.25]


def test_downstream_status(spark):
    df = spark.createDataFrame([(True, "distilbert", "x" * 600), (True, "tfidf", "x" * 600),
                                (False, "tfidf", "short")], "ok boolean, m string, t string")
    got = [r["s"] for r in df.select(R.downstream_status(F.col("ok"), F.col("m"), F.col("t"), DEFAULT)
                                     .alias("s")).collect()]
    assert got == [500, 200, 422]


def test_unicode_spaces_digits_and_neighbours(spark):
    """Values as Python's ``re`` gives them."""
    assert _pii(spark, "http://10.0.0.1/x\u00a0bonjour")["scrubbed_text"] == "[URL]\u00a0bonjour"
    assert _pii(spark, "Telé555-123-4567")["pii_types"] == []
    assert _pii(spark, "ssn ١٢٣-45-6789")["pii_types"] == ["ssn"]
    from deskspark.functions.text import word_count

    df = spark.createDataFrame([("prix\u00a0:\u00a05 euros",)], "text string")
    assert df.select(word_count(F.col("text")).alias("n")).first()["n"] == 4


def test_filter_on_route_does_not_repeat_the_text_work(spark):
    from deskspark.operators import langid

    train = spark.createDataFrame([("the printer is broken", "en"), ("imprimante en panne", "fr")],
                                  "document string, topic_group string")
    df = spark.createDataFrame([(1, "the printer is broken again"), (1, "imprimante toujours en panne"), (2, None)],
                               "request_id long, text string")
    routed = R.route(df, langid.fit(train)).filter("status = 200")
    plan = routed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "Exchange" not in plan and "Join" not in plan
    assert sorted(r["language"] for r in routed.collect()) == ["en", "fr"]
