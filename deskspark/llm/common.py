"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from contextlib import contextmanager
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
#: A word of the white-space kind: everything but space, tab, LF, VT, FF, CR.
WORD = r"[^\x20\x09-\x0D]+"

#: Text handled at once inside a Python task; bounds the memory of token lists.
SLICE_BYTES = 4 << 20


def ship(module: str) -> None:
    """Send this module's functions to the executors by value, so that they need not be able to import the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


ship(__name__)


def shared(spark: SparkSession, value):
    """Broadcast the attributes of ``value`` (arrays, lists, dicts) without its class."""
    return spark.sparkContext.broadcast(SimpleNamespace(**vars(value)))


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = 2000) -> None:
    """At most ``rows`` texts in an Arrow batch: a batch lies in direct memory beside the heap and once more in the worker.
    A smaller setting of the session stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))


@contextmanager
def batches_of(spark: SparkSession, rows: int = 2000):
    """As :func:`small_batches` for the jobs inside the block; the session's own setting comes back after it."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    own = spark.conf.get(key)
    small_batches(spark, rows)
    try:
        yield
    finally:
        spark.conf.set(key, own)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, UPPER, LOWER)


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once per row and bind it in ``body`` (a lambda).  Without this the optimizer may inline an
    expensive expression into a lambda body, where it would run again for every element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def slices(batches: Iterator[pa.RecordBatch], text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that the texts of each piece hold about ``limit`` bytes (one longer text is a piece alone)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(batch.schema.get_field_index(text))
        sizes = np.fromiter((len(x) if x is not None else 0 for x in
                             (column.cast(pa.binary()) if pa.types.is_string(column.type) else column.cast(pa.large_binary())).to_pylist()),
                            np.int64, batch.num_rows)
        begin, total = 0, 0
        for i, n in enumerate(sizes.tolist()):
            if total and total + n > limit:
                yield batch.slice(begin, i - begin)
                begin, total = i, 0
            total += n
        yield batch.slice(begin)


def raw_texts(batch: pa.RecordBatch, text: str) -> list[bytes]:
    """The texts as UTF-8 bytes; null counts as empty."""
    column = batch.column(batch.schema.get_field_index(text))
    kind = pa.binary() if pa.types.is_string(column.type) else pa.large_binary()
    return [x or b"" for x in column.cast(kind).to_pylist()]


class Ids(dict):
    """Words numbered in order of first appearance."""

    def __missing__(self, word):
        number = self[word] = len(self)
        return number


def coded_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """White-space words of all texts (A-Z lower-cased) as numbers, their end offset by text, and the distinct words."""
    ids, parts, ends, total = Ids(), [], np.zeros(len(texts), np.int64), 0
    for i, text in enumerate(texts):
        words = text.lower().split()
        parts.append(np.fromiter(map(ids.__getitem__, words), np.int32, len(words)))
        total += len(words)
        ends[i] = total
    return (np.concatenate(parts) if parts else np.zeros(0, np.int32)), ends, list(ids)


def require(df: DataFrame, *columns: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing column: {', '.join(missing)}")


def fresh(df: DataFrame, *wanted: str) -> list[str]:
    """Working names that clash with no column of ``df``."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out
