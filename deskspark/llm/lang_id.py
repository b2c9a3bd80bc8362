"""Language ID by word-first backoff.

Known words are scored by their log frequency in each language.  An unseen word falls back to its character n-grams: the
longest order at which the model knows any of them scores it, down to single characters.

Counts come from all training texts: words per language are counted in the tasks and summed by word in a shuffle; the
n-grams are counted over the distinct words of each language.  No count is dropped: the most frequent words and n-grams
are broadcast, up to a bound that only decides which way a lookup goes, and all others are joined with the full tables.
Every distinct word of the table gets its scores once, so a text needs a join only for the words beyond the broadcast,
counted per document.
"""

from __future__ import annotations

from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskspark.llm.common import Ids, read, require, shared, ship, slices
from deskspark.operators.common import materialize

ship(__name__)

ORDERS = (4, 3, 2, 1)
COUNTER_MAX = 300_000
_LETTERS = bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
_TABLE = bytes(b if b in _LETTERS else 0x20 for b in range(256))


def letter_words(text: str | None) -> list[bytes]:
    """Lower-cased runs of letters a-z and characters beyond ASCII."""
    return (text or "").lower().encode().translate(_TABLE).split()


def has_letter(text: str | None, words: list[bytes]) -> bool:
    return bool(words) and any(c.isalpha() for c in text)


def grams(word: str, order: int) -> list[str]:
    marked = f"^{word}$" if order > 1 else word
    return [marked[i:i + order] for i in range(len(marked) - order + 1)]


def _flush(counts: Counter):
    langs, keys = zip(*counts, strict=True) if counts else ((), ())
    out = pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(keys, pa.binary()).cast(pa.string()),
                                      pa.array(counts.values(), pa.int64())], names=["lang", "term", "n"])
    counts.clear()
    return out


def _word_rows(batches):
    by_lang: dict[str, Counter] = {}
    for batch in slices(batches, "text"):
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            by_lang.setdefault(lang, Counter()).update(letter_words(text))
        if sum(map(len, by_lang.values())) > COUNTER_MAX:
            yield _flush(Counter({(k, w): n for k, c in by_lang.items() for w, n in c.items()}))
            by_lang.clear()
    yield _flush(Counter({(k, w): n for k, c in by_lang.items() for w, n in c.items()}))


def _gram_rows(names):
    def run(batches):
        counts: Counter = Counter()
        for batch in batches:
            for word, by in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = [x for x, n in zip(names, by, strict=True) if n]
                for order in ORDERS:
                    for g in grams(word, order):
                        for lang in own:
                            counts[lang, g.encode()] += 1
            if len(counts) > COUNTER_MAX:
                yield _flush(counts)
        yield _flush(counts)
    return run


_SCHEMA = "lang string, term string, n long"


def _by_term(rows: DataFrame, names: list[str]) -> DataFrame:
    """(term, total, n): the count over all rows and the counts by language."""
    own = [F.coalesce(F.sum(F.when(F.col("lang") == x, F.col("n"))), F.lit(0)) for x in names]
    return rows.groupBy("term").agg(F.sum("n").alias("total"), F.array(*own).cast("array<long>").alias("n"))


def _log(totals, terms):
    """Smoothed log frequencies by language."""
    return F.array(*[F.log((F.col("n")[i] + 0.5) / (t + 0.5 * F.greatest(terms, F.lit(1)))).cast("float") for i, t in enumerate(totals)]).alias("scores")


def _cut(terms: DataFrame, most: int) -> int:
    """Least total that at most ``most`` terms reach (from a histogram of log counts)."""
    rows = terms.groupBy(F.floor(F.log2(F.col("total").cast("double")) * 16).cast("int").alias("s")).agg(
        F.count(F.lit(1)).alias("k"), F.min("total").alias("c")).toPandas()
    seen, cut = 0, 1 << 62
    for row in rows.sort_values("s", ascending=False).itertuples():
        seen += row.k
        if seen > most:
            break
        cut = int(row.c)
    return cut


def _table(rows: DataFrame, width: int):
    """Terms and a matrix of their scores."""
    found = rows.select("term", "scores").toPandas()
    scores = np.array(found["scores"].tolist(), np.float32).reshape(len(found), width)
    return {t.encode(): i for i, t in enumerate(found["term"])}, scores


def _look_up(model):
    def run(batches):
        m = model.value
        for batch in batches:
            out = []
            for word in batch.column(0).to_pylist():
                for order in ORDERS:
                    known, own = m.grams[order], grams(word, order)
                    at = [known.get(g.encode(), -1) for g in own]
                    rest = [] if m.whole[order] else [g for g, i in zip(own, at, strict=True) if i < 0]
                    at = [i for i in at if i >= 0]
                    if at or rest:
                        out.append((word, order, len(at), m.gram_scores[order][at].sum(0, dtype=np.float64), rest))
                    if at:
                        break
            kinds = (pa.string(), pa.int32(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.string()))
            columns = zip(*out, strict=True) if out else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)],
                                             names=["term", "order", "k", "sums", "rest"])
    return run


def backoff(words: DataFrame, counted: DataFrame, names: list[str], max_grams: int) -> DataFrame:
    """(term, scores) of ``words`` (term): the mean score of the longest n-grams that ``counted`` (term, total, n) has; words
    without any get no row."""
    order, width = F.length("term"), range(len(names))
    sums = {r["o"]: r for r in counted.groupBy(order.alias("o")).agg(
        F.count(F.lit(1)).alias("distinct"), F.sum(F.size(F.filter("n", lambda x: x > 0))).alias("terms"),
        F.array(*[F.sum(F.col("n")[i]) for i in width]).alias("totals")).collect()}
    model, known = SimpleNamespace(grams={}, gram_scores={}, whole={}), None
    for o in ORDERS:
        own = counted.filter(order == o)
        r = sums.get(o)
        scored = own.select("term", "total", _log([float(x) for x in r["totals"]] if r else [0.0] * len(names), F.lit(r["terms"] if r else 0)))
        cut = _cut(own, max_grams * 4 // max(4, len(names)))
        model.grams[o], model.gram_scores[o] = _table(scored.filter(F.col("total") >= cut), len(names))
        model.whole[o] = len(model.grams[o]) == (r["distinct"] if r else 0)
        if not model.whole[o]:
            rare = scored.filter(F.col("total") < cut).select(F.col("term").alias("gram"), "scores")
            known = rare if known is None else known.union(rare)
    found = words.select("term").mapInArrow(_look_up(shared(words.sparkSession, model)), "term string, order int, k long, sums array<double>, rest array<string>")
    if known is not None:
        found = materialize(found)
        more = (found.select("term", "order", F.explode("rest").alias("gram")).join(known, "gram")
                .select("term", "order", F.lit(1).cast("long").alias("k"), F.col("scores").cast("array<double>").alias("sums")))
        found = (found.drop("rest").union(more).groupBy("term", "order")
                 .agg(F.sum("k").alias("k"), F.array(*[F.sum(F.col("sums")[i]) for i in width]).alias("sums")).filter("k > 0")
                 .groupBy("term").agg(F.max_by(F.struct("k", "sums"), "order").alias("x")).select("term", "x.*"))
    return found.select("term", F.transform("sums", lambda x: x / F.col("k")).cast("array<float>").alias("scores"))


def scored_words(docs: DataFrame, names: list[str], max_grams: int) -> DataFrame:
    """(term, total, scores) of every distinct word of ``docs`` (lang, text), lang being null in rows that are not learned from;
    words without a known n-gram have zeros."""
    words = materialize(_by_term(docs.select("lang", "text").mapInArrow(_word_rows, _SCHEMA), names))
    learned = F.exists("n", lambda x: x > 0)
    own = words.filter(learned)
    size = own.agg(F.count(F.lit(1)).alias("k"), *[F.coalesce(F.sum(F.col("n")[i]), F.lit(0)).alias(f"t{i}") for i in range(len(names))]).first()
    counted = materialize(_by_term(own.select("term", "n").mapInArrow(_gram_rows(names), _SCHEMA), names))
    seen = own.select("term", "total", _log([float(size[f"t{i}"]) for i in range(len(names))], F.lit(size["k"])))
    unseen = words.filter(~learned).select("term", "total")
    zeros = F.array(*[F.lit(0.0) for _ in names]).cast("array<float>")
    scored = unseen.join(backoff(unseen, counted, names, max_grams), "term", "left").select("term", "total", F.coalesce("scores", zeros).alias("scores"))
    return materialize(seen.union(scored))


def _sum_up(model):
    def run(batches):
        m = model.value
        for batch in slices(batches, "text"):
            ids, parts, lettered = Ids(), [], []
            for text in batch.column(batch.schema.get_field_index("text")).to_pylist():
                own = letter_words(text)
                lettered.append(has_letter(text, own))
                parts.append(np.fromiter(map(ids.__getitem__, own), np.int64, len(own)))
            distinct = [w.decode() for w in ids]
            at = np.fromiter((m.words.get(w, -1) for w in ids), np.int64, len(ids))
            scores = np.zeros((len(ids), m.scores.shape[1]), np.float32)
            scores[at >= 0] = m.scores[at[at >= 0]]
            sums, rest, times = [], [], []
            for own in parts:
                sums.append(scores[own].sum(0, dtype=np.float64))
                who, n = np.unique(own[at[own] < 0], return_counts=True)
                rest.append([distinct[i] for i in who.tolist()])
                times.append(n)
            keep = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays([
                *[batch.column(batch.schema.get_field_index(n)) for n in keep], pa.array(lettered, pa.bool_()), pa.array(sums, pa.list_(pa.float64())),
                pa.array(rest, pa.list_(pa.string())), pa.array(times, pa.list_(pa.int64()))], names=[*keep, "lettered", "sums", "rest", "times"])
    return run


def language_id(docs: DataFrame, held_out, id: str = "doc_id", text: str = "text", lang: str = "lang", max_words: int = 200_000,
                max_grams: int = 50_000) -> DataFrame:
    """One row per row of ``docs``: id, held_out, lang_pred and score (posterior of the predicted language, equal priors),
    learned from rows that are not held out and have a language.  ``max_words`` and ``max_grams`` bound what is broadcast,
    not what is known: the result doesn't depend on them.

    A null text, a text without letters or an empty training set gives "und" with score 0; equal scores go to the first
    language in order; repeated rows count as often as they occur; an empty table gives an empty result; other columns
    are not looked at."""
    require(docs, id, text, lang)
    narrow = docs.select(F.col(id).alias("id"), held_out.alias("held_out"), F.col(text).alias("text"))
    labelled = docs.select(F.when(~held_out, F.col(lang)).alias("lang"), F.col(text).alias("text"))
    names = sorted(labelled.select("lang").distinct().dropna().toPandas()["lang"])
    if not names:
        return narrow.select(F.col("id").alias(id), "held_out", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    words = scored_words(labelled, names, max_grams)
    # the matrix is dense: the bound is on entries
    cut = _cut(words, max_words * 4 // max(4, len(names)))
    table, scores = _table(words.filter(F.col("total") >= cut), len(names))
    kind = dict(narrow.dtypes)["id"]
    summed = materialize(narrow.mapInArrow(
        _sum_up(shared(docs.sparkSession, SimpleNamespace(words=table, scores=scores))),
        f"id {kind}, held_out boolean, lettered boolean, sums array<double>, rest array<string>, times array<long>")
        .withColumn("row", F.monotonically_increasing_id()))
    rest = summed.select("row", F.explode(F.arrays_zip("rest", "times")).alias("x")).select("row", F.col("x.rest").alias("term"), F.col("x.times").alias("times"))
    more = (rest.join(words.filter(F.col("total") < cut).select("term", "scores"), "term").groupBy("row")
            .agg(F.array(*[F.sum(F.col("times") * F.col("scores")[i].cast("double")) for i in range(len(names))]).alias("more")))
    # scores are single and sums double: the order of a sum doesn't show
    both = F.when(F.col("more").isNull(), F.col("sums")).otherwise(F.zip_with("sums", "more", lambda x, y: x + y))
    out = summed.join(more, "row", "left").select("id", "held_out", "lettered", both.alias("sums")).withColumn("most", F.array_max("sums"))
    best = F.element_at(F.array(*[F.lit(x) for x in names]), F.array_position("sums", F.col("most")).cast("int"))
    chance = 1 / F.aggregate("sums", F.lit(0.0), lambda total, x: total + F.exp(x - F.col("most")))
    return out.select(F.col("id").alias(id), "held_out", F.when(F.col("lettered"), best).otherwise("und").alias("lang_pred"),
                      F.when(F.col("lettered"), chance).otherwise(0.0).alias("score"))


def op4_language_id(spark, sf_dir):
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 3 == 1
    return language_id(read(spark, sf_dir, "documents"), held_out)
