"""Table scans over the driver data and the ticket CSV format."""

from __future__ import annotations

import csv
import io

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deskspark.operators.common import materialize

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations")

REQUIRED_TICKET_COLUMNS = ("Document", "Topic_group")

TICKET_CSV_SCHEMA = T.StructType([
    T.StructField("Document", T.StringType(), True),
    T.StructField("Topic_group", T.StringType(), True),
])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def version(spark: SparkSession, sf_dir: str, name: str = "documents") -> tuple:
    """What tells one state of a table from another within a session: folder, files, lengths and times of change.  Results kept for
    reuse are filed under it, so a table that changes is read again."""
    _, fs, path = _fs_paths(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")
    files = sorted((s.getPath().toString(), s.getLen(), s.getModificationTime()) for s in fs.listStatus(path))
    return (spark.sparkContext.applicationId, sf_dir.rstrip("/"), *files)


def require_columns(df: DataFrame, required=REQUIRED_TICKET_COLUMNS) -> DataFrame:
    """Fail fast (before any job runs) when a required column is missing."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing column: {missing[0]}")
    return df


def tickets(spark: SparkSession, sf_dir: str, topic: str = "lang") -> DataFrame:
    """Raw ticket table bound to ``documents``: the label is ``lang``
    (4 classes) or ``source`` (20 classes)."""
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.col("text").alias("document"), F.col(topic).alias("topic_group"))


def _fs_paths(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return jvm, fs, p


def resolve_ticket_csv(spark: SparkSession, directory: str,
                       default_name: str = "service_tickets.csv") -> str:
    """Default file if present, else the first ``*.csv`` in the folder."""
    jvm, fs, d = _fs_paths(spark, directory)
    default = jvm.org.apache.hadoop.fs.Path(d, default_name)
    if fs.exists(default):
        return default.toString()
    found = fs.globStatus(jvm.org.apache.hadoop.fs.Path(d, "*.csv"))
    if found is None or len(found) == 0:
        raise FileNotFoundError(f"no CSV file in {directory}")
    return sorted(s.getPath().toString() for s in found)[0]


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """``(file, record, text)``: the records of quoted CSV files, line ends inside quotes kept, numbered from 0 per file.

    Files are scanned line by line by as many tasks as they have splits.  A line begins a record where an even number of quotes
    stands before it in its file: the quotes are counted per split, a running sum over the splits (one row each) gives each its
    parity, and lines are only put in order within a split.  A quote must be doubled inside a field and may not stand in a bare one;
    one that is never closed makes the rest of its file one record."""
    meta = F.col("_metadata")
    lines = (spark.read.option("lineSep", "\n").text(path).select(
        F.col("value"), meta["file_path"].alias("file"), meta["file_block_start"].alias("block"), F.monotonically_increasing_id().alias("at"))
        .withColumn("quotes", F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))))
    lines = materialize(lines)
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = lines.groupBy("file", "block").agg(F.sum("quotes").alias("n"))
    blocks = blocks.select("file", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("odd"))
    inside = Window.partitionBy("file", "block").orderBy("at")
    lines = lines.join(blocks, ["file", "block"])
    lines = lines.withColumn("starts", ((F.col("odd") + F.sum("quotes").over(inside) - F.col("quotes")) % 2 == 0).cast("long"))
    lines = materialize(lines.withColumn("nth", F.sum("starts").over(inside)).drop("odd", "quotes"))
    begun = lines.groupBy("file", "block").agg(F.sum("starts").alias("n"))
    begun = begun.select("file", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    lines = lines.join(begun, ["file", "block"]).withColumn("record", F.col("earlier") + F.col("nth") - 1)
    parts = F.array_sort(F.collect_list(F.struct("block", "at", "value")))  # the lines of one record
    joined = F.array_join(F.transform(parts, lambda x: x["value"]), "\n")
    return lines.groupBy("file", "record").agg(F.regexp_replace(joined, "\r$", "").alias("text"))


def read_csv(spark: SparkSession, path: str, schema: T.StructType, corrupt: str = "_corrupt_record") -> DataFrame:
    """CSV files with a header under a declared schema, several tasks per file: ``file, record``, the columns of ``schema`` by
    their names in the header, and ``corrupt``, the text of a record with too few or too many fields or one that does not fit its type.

    Raises ``ValueError`` for a file whose header lacks a column; empty lines are no records."""
    records = materialize(csv_records(spark, path).filter(F.col("text") != ""))
    options = {"escape": '"', "columnNameOfCorruptRecord": corrupt, "mode": "PERMISSIVE"}
    heads = {}
    for r in records.filter("record = 0").collect():  # a row per file
        names = next(csv.reader(io.StringIO(r["text"].lstrip("\ufeff"))))
        missing = [f.name for f in schema.fields if f.name not in names]
        if missing:
            raise ValueError(f"missing column: {missing[0]}")
        heads.setdefault(tuple(names), []).append(r["file"])
    out, kinds = None, {f.name: f.dataType for f in schema.fields}
    for names, files in heads.items():  # one branch per order of columns
        full = T.StructType([T.StructField(n, kinds.get(n, T.StringType())) for n in names] + [T.StructField(corrupt, T.StringType())])
        own = records.filter((F.col("record") > 0) & F.col("file").isin(files)).withColumn("row", F.from_csv("text", full.simpleString()[7:-1].replace(":", " "), options))
        own = own.select("file", "record", *[F.col("row")[n].alias(n) for n in kinds], F.col("row")[corrupt].alias(corrupt))
        out = own if out is None else out.unionByName(own)
    if out is None:
        return records.select("file", "record", *[F.lit(None).cast(k).alias(n) for n, k in kinds.items()], F.lit(None).cast("string").alias(corrupt))
    return out


def read_ticket_csv(spark: SparkSession, path: str, corrupt: bool = False) -> DataFrame:
    """The ticket CSV (header, quoted multi-line fields): doc_id, document, topic_group, and ``_corrupt_record`` if asked for.  ``doc_id``
    follows file order (number of the file in the high bits, record within it below)."""
    raw = read_csv(spark, path, TICKET_CSV_SCHEMA)
    files = raw.select("file").distinct()
    files = files.select("file", (F.row_number().over(Window.orderBy("file")) - 1).cast("long").alias("nth"))  # a row per file
    return raw.join(F.broadcast(files), "file").select((F.shiftleft("nth", 40) + F.col("record") - 1).alias("doc_id"), F.col("Document").alias("document"),
                                          F.col("Topic_group").alias("topic_group"), *["_corrupt_record"] * corrupt)
