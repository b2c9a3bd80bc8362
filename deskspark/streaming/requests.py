"""G10 on a request stream: every micro-batch goes through the same batch
function (validate -> scrub -> route -> predict -> respond)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskspark.operators import routing as R
from deskspark.session import ensure_checkpoint_dir
from deskspark.sources import sinks
from deskspark.streaming.monitor import run_epochs

#: How long after a request its repetitions are recognised; the state holds the ids of this time alone.
REPEATS_WITHIN = "10 minutes"


def once(requests: DataFrame, ts: str = "ts", within: str = REPEATS_WITHIN) -> DataFrame:
    """Each ``request_id`` once, within a micro-batch and across them, if its repetitions come ``within`` the watermark.
    ``ts`` is the time of the request (TIMESTAMP).  A null id names no request, so such rows are all kept: they get an id of their own."""
    own = F.coalesce(F.col("request_id"), F.concat(F.lit("unnamed-"), F.expr("uuid()")))
    return requests.withColumn("request_id", own).withWatermark(ts, within).dropDuplicatesWithinWatermark(["request_id"])


def score_batch(batch: DataFrame, fitted, fits, labels: list[str]) -> DataFrame:
    """Responses of one micro-batch: routed by the language model ``fitted``, answered by the calibrated classifier ``fits``."""
    carried = [c for c in ("request_id", "model_version") if c in batch.columns]
    return R.answer(R.route(batch, fitted), fits, labels).select(
        *carried, "conv_id", "turn", "predicted_class", "confidence", "model_used", "pii_detected",
        "pii_details", F.to_json("routing_explanation").alias("routing_explanation"), "status")


def serve(requests: DataFrame, fitted, models: str, name: str = "responses", base: str | None = None) -> DataFrame:
    """Run the request stream to completion (``availableNow``); responses are written per epoch to a Parquet table that is returned.

    ``models`` is a folder of classifiers written by :func:`deskspark.sources.sinks.publish_model`.  An epoch is answered by the newest
    complete version at its start, named in ``model_version``; the choice is written before the responses, so a replayed epoch
    is answered by the same version.  A stream started again on the same ``base`` goes on where it ended."""
    spark = requests.sparkSession
    base = base or ensure_checkpoint_dir(spark).rstrip("/") + f"/deskspark-streams/{name}-{uuid.uuid4().hex}"
    loaded: dict = {}

    def transform(batch: DataFrame, epoch: int) -> DataFrame:
        s = batch.sparkSession
        chosen = sinks.chosen_once(s, f"{base}/versions/epoch={epoch}", lambda: sinks.newest_model(s, models))
        if chosen not in loaded:
            loaded.clear()
            loaded[chosen] = sinks.load_model(s, models, chosen)
        return score_batch(batch.withColumn("model_version", F.lit(chosen)), fitted, *loaded[chosen])

    return run_epochs(requests.writeStream, transform, base, spark)
