"""Language identification as a Spark job - a character-trigram naive
Bayes model trained by counting in the tasks and a group-by, and applied in-row."""

from __future__ import annotations

import math
import sys
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deskspark.operators import linear

# executors need not be able to import the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed alphabet: ASCII and Latin-1 lower-case letters; every other run of
# characters becomes one space.  This bounds the trigram space to 60**3,
# which is what makes the model safe to broadcast.
NON_LETTERS = r"[^a-z\x{00df}-\x{00ff}]+"


def normalized(col: str):
    return F.concat(F.lit(" "), F.regexp_replace(F.lower(F.col(col)), NON_LETTERS, " "), F.lit(" "))


class Fitted(NamedTuple):
    """Trigrams, their log weights (trigram, label), labels and log priors."""
    grams: list[str]
    weights: np.ndarray
    labels: list[str]
    priors: np.ndarray


#: The alphabet in order, and the number of its trigrams.  In UTF-8 a letter beyond ASCII is the byte C3 and one of its own.
ALPHABET = " " + "".join(map(chr, [*range(0x61, 0x7B), *range(0xDF, 0x100)]))
CODES = len(ALPHABET) ** 3
#: Bytes that one step of a task works on at a time.
SLICE_BYTES = 1 << 20

_LEAD = 0xC3
_LETTER = np.zeros(256, np.int32)
_LETTER[[c.encode()[-1] for c in ALPHABET]] = np.arange(len(ALPHABET))


def trigrams(column: pa.Array):
    """(first row, rows, row, code) for pieces of a column of :func:`normalized` texts: the row within the piece and the number of every
    trigram, by its letters' places in the alphabet."""
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    if not len(column):
        return
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    begin = 0
    while begin < len(column):
        stop = max(int(np.searchsorted(ends, ends[begin] + SLICE_BYTES, "right")) - 1, begin + 1)
        raw = data[ends[begin]:ends[stop]]
        letter = _LETTER[raw[raw != _LEAD]]
        row = np.repeat(np.arange(stop - begin), np.diff(ends[begin:stop + 1]))[raw != _LEAD]
        code = (letter[:-2] * len(ALPHABET) + letter[1:-1]) * len(ALPHABET) + letter[2:]
        within = row[:-2] == row[2:]
        yield begin, stop - begin, row[:-2][within], code[within]
        begin = stop


def gram_of(code: int) -> str:
    n = len(ALPHABET)
    return ALPHABET[code // n // n] + ALPHABET[code // n % n] + ALPHABET[code % n]


def code_of(gram: str) -> int:
    a, b, c = map(ALPHABET.index, gram)
    return (a * len(ALPHABET) + b) * len(ALPHABET) + c


def fit(train: DataFrame, text: str = "document", label: str = "topic_group", alpha: float = 1.0,
        max_model_bytes: int = 256 << 20) -> Fitted:
    """Counts per (trigram, label).  The model is 8 bytes per trigram and label and goes to the tasks whole; one above
    ``max_model_bytes`` raises ``ValueError`` before it is collected."""
    def count(batches):
        for whole in batches:
            for begin, rows, row, code in trigrams(whole.column(1)):
                own = whole.column(0).slice(begin, rows).dictionary_encode("encode")
                key, n = np.unique(own.indices.to_numpy(zero_copy_only=False).astype(np.int64)[row] * CODES + code, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array((key % CODES).astype(np.int32)), own.dictionary.take(pa.array(key // CODES)), pa.array(n)],
                                                 names=["gram", label, "c"])

    kinds = T.StructType([T.StructField("gram", T.IntegerType()), T.StructField(label, train.schema[label].dataType), T.StructField("c", T.LongType())])
    parts = train.select(label, normalized(text)).mapInArrow(count, kinds)
    # at most 60**3 x labels rows: persisted because it feeds three actions
    counts = parts.groupBy("gram", label).agg(F.sum("c").alias("c")).persist(StorageLevel.MEMORY_AND_DISK)
    priors = train.groupBy(label).agg(F.count(F.lit(1)).alias("n_docs"))
    totals = counts.groupBy(label).agg(F.sum("c").alias("t"))
    vocab = counts.select("gram").distinct().count()
    n_labels = priors.count()
    if 8 * vocab * n_labels > max_model_bytes:
        raise ValueError(f"a model of {vocab} trigrams and {n_labels} labels is above {max_model_bytes} bytes")
    meta = priors.join(totals, label, "left").orderBy(label).collect()
    n_docs = sum(r["n_docs"] for r in meta)
    labels = [(r[label], math.log(r["n_docs"] / n_docs), math.log((r["t"] or 0) + alpha * vocab)) for r in meta]
    index = {name: i for i, (name, _, _) in enumerate(labels)}
    rows = counts.toArrow()  # columns, at most 60**3 x labels rows: bounded by the check above
    counts.unpersist()
    gram, own = (rows[c].combine_chunks().dictionary_encode() for c in ("gram", label))
    names = [gram_of(c) for c in gram.dictionary.to_pylist()]
    grams = sorted(names)
    rank = {g: i for i, g in enumerate(grams)}
    place = np.array([rank[g] for g in names], int)[gram.indices.to_numpy()]
    column = np.array([index[x] for x in own.dictionary.to_pylist()], int)[own.indices.to_numpy()]
    weights = np.full((len(grams), len(labels)), math.log(alpha))
    weights[place, column] = np.log(rows["c"].to_numpy() + alpha)
    weights -= np.array([d for _, _, d in labels])
    return Fitted(grams, weights, [n for n, _, _ in labels], np.array([p for _, p, _ in labels]))


def gram_sums(text: Column, fitted: Fitted) -> Column:
    """Per :func:`normalized` text the log priors plus the weights of its known trigrams; null where none is known.  The texts alone go to
    Python, and some at a time are cut into trigrams there, so a task's memory doesn't follow the length of the texts."""
    codes = np.array([code_of(g) for g in fitted.grams], int)
    known = np.zeros(CODES, bool)
    known[codes] = True
    weights = np.zeros((len(fitted.labels), CODES))
    weights[:, codes] = fitted.weights.T

    @F.arrow_udf("array<double>")
    def sums(column: pa.Array) -> pa.Array:
        parts, some = [np.zeros((0, len(weights)))], [np.zeros(0, bool)]
        for _, rows, row, code in trigrams(column):
            parts.append(np.stack([np.bincount(row, w[code], rows) for w in weights], axis=1) + fitted.priors)
            some.append(np.bincount(row, known[code], rows) > 0)
        return pc.if_else(pa.array(np.concatenate(some)), linear.lists(np.concatenate(parts)), pa.scalar(None, pa.list_(pa.float64())))

    return sums.asNondeterministic()(text)


def predict(fitted: Fitted, df: DataFrame, text: str, out: str = "language",
            with_probabilities: bool = False) -> DataFrame:
    """Argmax over labels of ``log prior + sum log P(gram | label)`` with
    Laplace smoothing; unseen trigrams are ignored.  Ties go to the first
    label in ascending order.  Empty and null texts get ``unknown``.

    Every row is scored by itself (an Arrow UDF over its trigrams), so
    nothing is shuffled and rows may share an id."""
    x = df.withColumn("_s", gram_sums(normalized(text), fitted))
    best, names = F.array_max("_s"), F.array(*[F.lit(n) for n in fitted.labels])
    x = x.withColumn(out, F.coalesce(F.get(names, F.array_position("_s", best).cast("int") - 1), F.lit("unknown")))
    if with_probabilities:
        # softmax over the label scores, listed by descending probability
        ex = F.transform("_s", lambda s: F.exp(s - best))
        x = x.withColumn("_e", ex).withColumn("_z", F.aggregate("_e", F.lit(0.0), lambda a, e: a + e))
        probs = F.zip_with(names, "_e", lambda n, e: F.struct(n.alias("label"), (e / F.col("_z")).alias("prob")))
        probs = F.array_sort(probs, lambda a, b: F.when(a["prob"] > b["prob"], -1)
                             .when(a["prob"] < b["prob"], 1)
                             .otherwise(F.when(a["label"] < b["label"], -1).otherwise(1)))
        x = x.withColumn("probabilities", F.when(F.col("_s").isNotNull(), probs))
        x = x.withColumn("confidence", F.lit(1.0) / F.col("_z")).drop("_e", "_z")
    return x.drop("_s")
