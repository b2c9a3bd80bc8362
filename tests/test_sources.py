"""Ticket CSV scan with the default-file fallback."""

import csv
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deskspark.sources.tables import csv_records, read_csv, read_ticket_csv, resolve_ticket_csv


def _write(spark, rows, path):
    spark.createDataFrame(rows, "Document string, Topic_group string").coalesce(1) \
        .write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def test_first_csv_when_default_missing(spark, tmp_path):
    d = tmp_path / "raw"
    _write(spark, [("Printer broken,\n again", "Hardware"), (None, "Access")], str(d))
    path = resolve_ticket_csv(spark, str(d))
    assert path.endswith(".csv")
    df = read_ticket_csv(spark, path)
    rows = sorted(df.collect(), key=lambda r: r["doc_id"])
    assert df.columns == ["doc_id", "document", "topic_group"]
    assert rows[0]["document"] == "Printer broken,\n again" and rows[1]["document"] is None


def test_no_csv_raises(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    with pytest.raises(FileNotFoundError):
        resolve_ticket_csv(spark, str(tmp_path / "empty"))


def test_missing_column_raises(spark, tmp_path):
    d = tmp_path / "bad"
    spark.createDataFrame([("x",)], "Document string").write.option("header", True).csv(str(d))
    with pytest.raises(ValueError):
        read_ticket_csv(spark, str(d))


def test_csv_in_several_tasks_equals_one_task(spark, tmp_path):
    """Quotes, commas and line ends in fields; two files; splits that begin inside quoted fields."""
    rng = random.Random(3)
    words = ["plain", 'say ""', '"quoted"', "a,b", "line\nend", "\n\n", "\r\nx", "é", "", ",", '"', "tail\r"]
    for name, order in (("a", ["Document", "Topic_group", "n"]), ("b", ["n", "Topic_group", "Document"])):
        with open(tmp_path / f"{name}.csv", "w", newline="", encoding="utf-8") as f:
            out = csv.writer(f, lineterminator="\n")
            out.writerow(order)
            for i in range(4000):
                row = {"Document": " ".join(rng.choices(words, k=rng.randint(1, 8))) + f" #{i}", "Topic_group": rng.choice(["x", "y,z", 'q"r']), "n": i}
                out.writerow([row[c] for c in order])
    schema = T.StructType([T.StructField("Document", T.StringType()), T.StructField("Topic_group", T.StringType()), T.StructField("n", T.IntegerType())])
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "16384")
    spark.conf.set("spark.sql.files.openCostInBytes", "1024")
    try:
        records = csv_records(spark, str(tmp_path / "*.csv"))
        assert spark.read.text(str(tmp_path / "a.csv")).rdd.getNumPartitions() > 5 and records.count() == 8002
        got = sorted((r["n"], r["Document"], r["Topic_group"]) for r in read_csv(spark, str(tmp_path / "*.csv"), schema).filter("_corrupt_record IS NULL").collect())
    finally:
        spark.conf.set(key, before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    one = []
    for name in "ab":
        x = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(str(tmp_path / f"{name}.csv"))
        one += [(int(r["n"]), r["Document"], r["Topic_group"]) for r in x.collect()]
    assert got == sorted(one)


def test_broken_lines_are_kept_beside_the_rows(spark, tmp_path):
    (tmp_path / "t.csv").write_text('Topic_group,Document\r\na,"two\r\nlines"\r\nonly one\r\n\r\nb,c,too many\r\nd,"end"')
    got = {r["doc_id"]: (r["document"], r["topic_group"], r["_corrupt_record"]) for r in read_ticket_csv(spark, str(tmp_path / "t.csv"), corrupt=True).collect()}
    assert got[0] == ("two\r\nlines", "a", None) and got[max(got)] == ("end", "d", None)
    assert sorted(x[2] for x in got.values() if x[2]) == ["b,c,too many", "only one"] and len(got) == 4
    (tmp_path / "e.csv").write_text("Document,Topic_group\n")
    assert read_ticket_csv(spark, str(tmp_path / "e.csv")).count() == 0


def test_run_log_survives_retries_and_two_writers(spark, tmp_path):
    from deskspark.sources import sinks

    path, row = str(tmp_path / "log"), "run_id string, key string, value double"
    a = spark.createDataFrame([("r", "x", 1.0), ("r", "y", 2.0)], row)
    sinks.append_runs(spark, a, path)
    sinks.append_runs(spark, a.withColumn("value", F.col("value") + 10), path)  # a retried job
    # another writer whose attempt began first and was never finished, and one that was
    a.withColumn("value", F.lit(-1.0)).write.parquet(path + "/attempt=" + "0" * 20 + "-dead")
    (tmp_path / "log" / ("attempt=" + "0" * 20 + "-dead") / "_SUCCESS").unlink()
    spark.createDataFrame([("r", "x", 7.0), ("s", "x", 8.0)], row).write.parquet(path + "/attempt=" + "9" * 20 + "-late")
    assert sorted(tuple(r) for r in sinks.read_runs(spark, path).collect()) == [("r", "x", 1.0), ("r", "y", 2.0), ("s", "x", 8.0)]


def test_results_kept_for_reuse_follow_the_table(spark, tmp_path):
    from deskspark.plans import prepare_q

    path, row = str(tmp_path / "documents.parquet"), "doc_id long, text string, lang string, source string"
    spark.createDataFrame([(i, f"printer number {i} is broken", "en", "s") for i in range(4)], row).write.parquet(path)
    assert prepare_q.prepared(spark, str(tmp_path)).count() == 4
    spark.createDataFrame([(9, "screen does not turn on", "en", "s")], row).write.mode("append").parquet(path)
    assert prepare_q.prepared(spark, str(tmp_path)).count() == 5
