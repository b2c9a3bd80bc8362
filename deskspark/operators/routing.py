"""Routing and the end-to-end request path (G6-G11) as column logic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskspark.config import DEFAULT, Params
from deskspark.functions.text import word_count
from deskspark.operators import langid, linear, model, pii
from deskspark.operators import prepare as P


def normalize_complexity(raw: Column, params: Params = DEFAULT) -> Column:
    """Parse a model's text answer as a number, clamp to [0, 1], and
    fall back to 0.5 when it does not parse."""
    x = F.expr("try_cast(NULL AS DOUBLE)") if raw is None else F.trim(raw.cast("string")).try_cast("double")
    # greatest / least skip nulls in Spark, so test for the unparsable case first
    return F.when(x.isNull() | F.isnan(x), F.lit(params.complexity_fallback)).otherwise(
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), x)))


def choose_model(lang: Column, n_words: Column, complexity: Column, params: Params = DEFAULT) -> Column:
    """Non-English -> distilbert; > 40 words -> distilbert; complexity
    above the threshold -> distilbert; otherwise tfidf."""
    return (F.when(lang != "en", "distilbert")
            .when(n_words > params.route_max_words, "distilbert")
            .when(complexity > params.complexity_threshold, "distilbert")
            .otherwise("tfidf"))


def explanation(lang: Column, model: Column, params: Params = DEFAULT) -> Column:
    """``{language, model_chosen, url}``."""
    url = F.when(model == "tfidf", F.lit(params.tfidf_url)).otherwise(F.lit(params.transformer_url))
    return F.struct(lang.alias("language"), model.alias("model_chosen"),
                    F.concat(url, F.lit("/predict")).alias("url"))


def downstream_status(agent_ok: Column, model: Column, text: Column, params: Params = DEFAULT) -> Column:
    """422 when the agent rejects the request; 500 when the chosen
    service rejects the scrubbed text (the agent reports any downstream
    failure as an internal error); 200 otherwise."""
    n = F.length(text)
    limit = F.when(model == "distilbert", params.transformer_max_chars).otherwise(params.request_max_chars)
    blank = F.regexp_replace(text, r"(?U)^\s+|\s+$", "") == ""
    ok = (n >= params.request_min_chars) & (n <= limit) & ~blank
    return F.when(~agent_ok, 422).when(~ok, 500).otherwise(200)


def route(df: DataFrame, fitted_langid, text: str = "text",
          complexity: Column | None = None, params: Params = DEFAULT,
          with_probabilities: bool = False) -> DataFrame:
    """Validate, scrub, detect language, count words, choose the model.
    ``with_probabilities`` keeps the language model's class probabilities
    (used when that model is also the ticket classifier)."""
    x = P.validate_requests(df, text, params)
    x = pii.types(pii.scrub(pii.detect(x, text), text))
    x = langid.predict(fitted_langid, x, "scrubbed_text", out="language", with_probabilities=with_probabilities)
    x = x.withColumn("word_count", word_count(F.col("scrubbed_text")))
    x = x.withColumn("complexity", normalize_complexity(complexity, params))
    x = x.withColumn("model_used", choose_model(F.col("language"), F.col("word_count"), F.col("complexity"), params))
    x = x.withColumn("routing_explanation", explanation(F.col("language"), F.col("model_used"), params))
    x = x.withColumn("reason", F.concat(F.col("language"), F.lit("_routing")))
    x = x.withColumn("status", downstream_status(F.col("agent_ok"), F.col("model_used"), F.col("scrubbed_text"),
                                                 params).cast("int"))
    return pii.drop_counts(x)


def answer(routed: DataFrame, fits, labels: list[str], params: Params = DEFAULT) -> DataFrame:
    """Response columns for the requests that succeeded (status 200), answered by the calibrated classifier ``fits``
    from the scrubbed text.  Scored in-row: no join, so requests may share an id."""
    ok = routed.filter(F.col("status") == 200)
    x = model.analyzed(ok, params, "scrubbed_text").withColumn("_prob", linear.scores(F.col("terms"), fits)).drop("terms")
    return (model.probabilities_table(x, "_prob", labels)
            .withColumn("prediction_details", F.struct("predicted_class", "confidence", "probabilities")))
