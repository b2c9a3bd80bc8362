"""Target-distribution importance resampling (hashed n-gram features) with Arrow kernels.

1. Counting pass: per slice of texts ascii_lower, split_pattern_regex, list_flatten and dictionary_encode give word indices;
   shifted index arrays form the n-grams, the distinct index tuples alone are joined to strings and hashed by CRC-32.  A task
   adds its counts up in one array of ``buckets`` longs and emits that at its end, so the shuffle has at most ``buckets`` rows
   a task, whatever the texts.
2. The gains, one integer per bucket, are a broadcast of ``buckets`` longs, the only thing that comes to the driver.
3. Scoring pass: take maps each feature to its bucket's gain, a segment reduction adds them up per document, and seeded Gumbel
   noise makes the largest scores a sample without replacement.
4. The draw is a range-partitioned sort of narrow rows (scores only), numbered per partition and shifted by the partition's
   offset: no task ranks more than its range, equal scores included.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from deskspark.llm.common import read, require, shared, ship, slices, batches_of
from deskspark.operators.common import materialize

ship(__name__)

#: What separates words: ASCII other than digits and lower-case letters.
SPLIT = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Indices of all words in order, the row of each, and the distinct words."""
    lists = pc.split_pattern_regex(pc.ascii_lower(column.fill_null("")), pattern=SPLIT)
    coded = pc.list_flatten(lists).dictionary_encode()
    index, row = coded.indices.to_numpy(zero_copy_only=False), pc.list_parent_indices(lists).to_numpy(zero_copy_only=False)
    known = coded.dictionary.to_pylist()
    if "" in known:  # at either end of a text
        full = index != known.index("")
        index, row = index[full], row[full]
    return index.astype(np.int64), row.astype(np.int64), known


def features(column: pa.Array, n: int, buckets: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each length 1 to ``n`` the bucket of every run of words and the row that it is in."""
    index, row, names = words(column)
    first = index
    out, code, names_of = [], index, names
    for length in range(1, n + 1):
        if length > 1:
            # a run is the run one word shorter at the same place, and the word after it
            whole = row[:len(code) - 1] == row[length - 1:] if len(code) > 1 else np.zeros(0, bool)
            pair = code[:-1][whole] * len(names) + first[length - 1:][whole] if len(code) > 1 else np.zeros(0, np.int64)
            distinct, short = np.unique(pair, return_inverse=True)
            names_of = [f"{names_of[p // len(names)]} {names[p % len(names)]}" for p in distinct.tolist()]
            code = np.zeros(len(whole), np.int64)
            code[whole] = short
        else:
            whole = np.ones(len(code), bool)
        place = np.fromiter((zlib.crc32(x.encode()) % buckets for x in names_of), np.int64, len(names_of))
        out.append((place[code[whole]] if len(names_of) else np.zeros(0, np.int64), row[:len(whole)][whole]))
    return out


def _count(n, buckets):
    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in slices(batches, "text"):
            for place, _ in features(batch.column(0), n, buckets):
                total += np.bincount(place, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["bucket", "n"])
    return run


def bucket_counts(texts: DataFrame, n: int, buckets: int) -> np.ndarray:
    """How many features of the column ``text`` fall in each bucket."""
    found = texts.select("text").mapInArrow(_count(n, buckets), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(buckets, np.int64)
    for r in found:
        out[r.bucket] = r.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """1000 times the log of the smoothed frequency ratio of target and source, rounded down, by bucket."""
    k, s_all, t_all = len(source), int(source.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log(float((t + 1) * (s_all + k)) / float((s + 1) * (t_all + k))))
                     for s, t in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def noise(seed: int, id) -> int:
    """Gumbel noise times 1000, rounded down, from the digest of seed and id; a null id is the empty text."""
    h = int(hashlib.sha256(f"{seed}:{'' if id is None else id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def _score(model, seed):
    def run(batches):
        m = model.value
        for batch in slices(batches, "text"):
            rows = batch.num_rows
            weight, count, n_words = np.zeros(rows, np.int64), np.zeros(rows, np.int64), None
            for place, row in features(batch.column(1), m.n, len(m.gain)):
                own = np.bincount(row, minlength=rows)
                n_words = own if n_words is None else n_words
                count += own
                begin = np.flatnonzero(np.diff(row, prepend=-1))  # rows come in order: a segment per document with features
                if len(begin):
                    weight[row[begin]] += np.add.reduceat(m.gain.take(place), begin)
            more = np.fromiter((noise(seed, x) for x in batch.column(0).to_pylist()), np.int64, rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, (n_words, count, weight, weight + more))],
                                             names=["id", "n_words", "n_features", "weight", "score"])
    return run


def resample(docs: DataFrame, target: DataFrame, id: str = "doc_id", text: str = "text", target_text: str = "text", n: int = 2,
             buckets: int = 10_000, percent: int = 10, least_words: int = 20, seed: int = 2024) -> DataFrame:
    """One row per row of ``docs``: ``id``, n_words, n_features, weight, score and rank.

    The rows with ``least_words`` words or more are drawn by score until ``percent`` in a hundred of them are; rank is the place in
    that order, null for the others.  ``n`` is the longest run of words that is a feature.  Equal scores: smaller id first, then
    fewer features, smaller weight; rows equal in all of these take neighbouring ranks.  A null or empty text has no words; a null
    id counts as the empty text for the noise and comes last among equals; repeated rows are drawn one by one; an empty target gives
    the smoothed ratio alone; an empty table gives an empty result; other columns are not looked at; whole texts are read."""
    require(docs, id, text)
    require(target, target_text)
    spark = docs.sparkSession
    narrow = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    kind = dict(narrow.dtypes)["id"]
    with batches_of(spark):
        model = SimpleNamespace(n=n, gain=gains(bucket_counts(narrow, n, buckets), bucket_counts(target.select(F.col(target_text).alias("text")), n, buckets)))
        rows = materialize(narrow.mapInArrow(_score(shared(spark, model), seed), f"id {kind}, n_words long, n_features long, weight long, score long")
                           .withColumn("long_enough", F.col("n_words") >= least_words).withColumn("at", F.monotonically_increasing_id()))
    # "at" keeps equal rows apart, so that a third of all rows being equal doesn't make one range
    ordered = materialize(rows.sort(F.desc("long_enough"), F.desc("score"), F.asc_nulls_last("id"), "n_features", "weight", "at")
                          .drop("at").withColumn("at", F.monotonically_increasing_id()))
    part = F.shiftright("at", 33)
    sizes = ordered.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("rows"), F.count_if("long_enough").alias("fit"))
    # one row per partition of the sort
    before = sizes.select("part", (F.sum("rows").over(Window.orderBy("part")) - F.col("rows")).alias("before"),
                          F.floor(F.sum("fit").over(Window.partitionBy()) * percent / 100).alias("draw"))
    numbered = ordered.withColumn("part", part).join(F.broadcast(before), "part").withColumn(
        "place", F.col("before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) + 1)
    drawn = F.col("long_enough") & (F.col("place") <= F.col("draw"))
    return numbered.select(F.col("id").alias(id), "n_words", "n_features", "weight", "score", F.when(drawn, F.col("place")).alias("rank"))


def op13_importance_resampling(spark, sf_dir):
    docs, target = read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")
    return resample(docs, target, n=1).select("doc_id", "n_features", "weight", "score", "rank")


#: CRC-32 of a text's UTF-8 bytes, bit by bit (DuckDB has no such function); ``hex`` must be the text's bytes as hexadecimal digits.
CRC_SQL = """xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], range(4 * length({hex}))), lambda a, i:
  CASE WHEN i % 8 = 0
       THEN xor(xor(a, CAST('0x' || substr({hex}, 2 * (i // 8) + 1, 2) AS BIGINT)) >> 1,
                (xor(a, CAST('0x' || substr({hex}, 2 * (i // 8) + 1, 2) AS BIGINT)) & 1) * 3988292384)
       ELSE xor(a >> 1, (a & 1) * 3988292384) END))"""

SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
w AS (SELECT r, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS f FROM d),
v AS (SELECT unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS f FROM benchmark),
h AS (SELECT f, hex(encode(f)) AS x FROM (SELECT f FROM w UNION SELECT f FROM v)),
b AS (SELECT f, {CRC_SQL.format(hex="x")} % 10000 AS b FROM h),
s AS (SELECT b, count(*) AS n FROM w JOIN b USING (f) GROUP BY b),
t AS (SELECT b, count(*) AS n FROM v JOIN b USING (f) GROUP BY b),
g AS (SELECT b, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT count(*) FROM w) + 10000)::DOUBLE
                                / ((coalesce(s.n, 0) + 1)::DOUBLE * ((SELECT count(*) FROM v) + 10000)::DOUBLE)))::BIGINT AS gain
      FROM s FULL JOIN t USING (b)),
p AS (SELECT r, count(*) AS n, sum(gain) AS weight FROM w JOIN b USING (f) JOIN g USING (b) GROUP BY r),
e AS (SELECT r, doc_id, coalesce(n, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
             coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8) AS BIGINT) + 0.5::DOUBLE)
                                                     / 4294967296)))::BIGINT AS score
      FROM d LEFT JOIN p USING (r)),
k AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n_features, weight) AS rank FROM e WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= (SELECT floor(10 * count(*) / 100) FROM k) THEN rank END::BIGINT AS rank
FROM e LEFT JOIN k USING (r)
"""
