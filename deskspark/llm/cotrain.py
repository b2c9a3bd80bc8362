"""Quality classifier by co-training.

Two views of a document: its text (hashed words and symbol runs, share of repeated words) and its metadata (source, language,
size and layout).  A logistic regression per view is fitted on the labelled rows; over some rounds each view labels the
rows of an unlabelled pool about which it is sure, and these join the other view's training set.  The views are calibrated
and combined on labelled rows that neither view was fitted on.

The first fit uses a bounded sample of the labelled rows (``max_labelled``, those with the smallest hash of doc_id) and runs as one
task.  The rounds use every unlabelled document: its features are written once, and each solver step is a pass over them
that sums the losses and gradients of both views per task and adds the sums up through a tree.  The driver holds the weights
and the held-out rows' scores; the weights score every document in one pass without a shuffle.
"""

from __future__ import annotations

from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskspark.llm.common import Ids, batches_of, fresh, raw_texts, read, require, shared, ship, slices, small_batches
from deskspark.operators.common import materialize

ship(__name__)

TEXT_BITS, META_BITS = 18, 12
_LETTERS = bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
_SPACES = b" \t\n\r\x0b\x0c"
_TO_WORDS = bytes(b if b in _LETTERS else 0x20 for b in range(256))
_TO_MARKS = bytes(0x20 if b in _LETTERS or b in _SPACES else b for b in range(256))


def text_view(texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per text the hashed places and values: 1 for each distinct word or symbol run, place 0 has the share of repeated
    words of more than three bytes, the last place the intercept."""
    ids, rows = Ids(), []
    for text in texts:
        low = text.lower()
        words = low.translate(_TO_WORDS).split()
        long = [w for w in words if len(w) > 3]
        own = set(words)
        repeated = 1 - len({*long}) / len(long) if long else 0.0
        own.update(low.translate(_TO_MARKS).split())
        rows.append((np.fromiter(map(ids.__getitem__, own), np.int64, len(own)), repeated))
    size = 1 << TEXT_BITS
    place = np.fromiter((1 + xxhash.xxh64_intdigest(w) % (size - 2) for w in ids), np.int64, len(ids))
    out = []
    for own, repeated in rows:
        at = np.unique(place[own])
        out.append((np.concatenate([[0], at, [size - 1]]), np.concatenate([[repeated], np.ones(len(at)), [1.0]])))
    return out


def meta_view(text: bytes, values: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed places of the metadata values, then size and layout; the last place is the intercept."""
    size, n = 1 << META_BITS, max(len(text), 1)
    lines = text.count(b"\n") + 1
    upper = len(text) - len(text.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    digits = len(text) - len(text.translate(None, b"0123456789"))
    marks = len(text) - len(text.translate(None, b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"))
    numbers = [np.log1p(len(text)) / 4, np.log1p(lines) / 2, np.log1p(n / lines) / 4, 4 * upper / n, 4 * digits / n, 4 * marks / n]
    named = [8 + xxhash.xxh64_intdigest(f"{i}={v}") % (size - 9) for i, v in enumerate(values)]
    return np.array([*range(len(numbers)), *named, size - 1]), np.array([*numbers, *[1.0] * len(named), 1.0])


class Rows:
    """Sparse rows from two Arrow list columns (places and values), without Python objects.  Without values all are 1, but for
    the first place of each row, which has ``first``."""

    def __init__(self, places: pa.ListArray, values: pa.ListArray | None, size: int, first: np.ndarray | None = None):
        self.at, self.lengths, self.size = places.flatten().to_numpy(zero_copy_only=False), pc.list_value_length(places).to_numpy(zero_copy_only=False), size
        self.begin = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        self.value = np.ones(len(self.at)) if values is None else values.flatten().to_numpy(zero_copy_only=False)
        if first is not None:
            self.value[self.begin] = first

    def dot(self, w):
        return np.add.reduceat(self.value * w[self.at], self.begin)

    def back(self, r):
        return np.bincount(self.at, self.value * np.repeat(r, self.lengths), self.size)


def minimise(value, w: np.ndarray, steps: int) -> np.ndarray:
    """Limited-memory BFGS from ``w``; ``value`` returns loss and gradient."""
    pairs = []
    loss, grad = value(w)
    for _ in range(steps):
        q, alphas = grad.copy(), []
        for s, d, rho in reversed(pairs):
            alphas.append(rho * (s @ q))
            q -= alphas[-1] * d
        q *= (pairs[-1][0] @ pairs[-1][1]) / (pairs[-1][1] @ pairs[-1][1]) if pairs else 1.0
        for (s, d, rho), a in zip(pairs, reversed(alphas), strict=True):
            q += s * (a - rho * (d @ q))
        step, slope = 1.0, grad @ q
        while True:
            new = w - step * q
            new_loss, new_grad = value(new)
            if new_loss <= loss - 1e-4 * step * slope or step < 1e-8:
                break
            step /= 2
        s, d = new - w, new_grad - grad
        if new_loss > loss - 1e-9:
            break
        w, loss, grad = new, new_loss, new_grad
        if s @ d > 1e-12:
            pairs = [*pairs[-9:], (s, d, 1 / (s @ d))]
    return w


def losses(rows, y: np.ndarray, w: np.ndarray) -> tuple[float, np.ndarray]:
    """Sum of the logistic losses and its gradient."""
    z = rows.dot(w)
    return (np.logaddexp(0, z) - y * z).sum(), rows.back(1 / (1 + np.exp(-z)) - y)


def penalised(loss: float, grad: np.ndarray, n: float, w: np.ndarray, penalty: float) -> tuple[float, np.ndarray]:
    """Mean loss with an L2 penalty on all weights but the last."""
    scale = np.append(np.full(len(w) - 1, penalty), 0.0)
    return loss / n + (scale * w * w).sum() / 2, grad / n + scale * w


def logistic(rows, y: np.ndarray, penalty: float, steps: int) -> np.ndarray:
    return minimise(lambda w: penalised(*losses(rows, y, w), len(y), w, penalty), np.zeros(rows.size), steps)


class Dense:
    """Dense rows with an intercept, for the calibration."""

    def __init__(self, *columns):
        self.x = np.stack([*columns, np.ones(len(columns[0]))], axis=1)
        self.size = self.x.shape[1]

    def dot(self, w):
        return self.x @ w

    def back(self, r):
        return r @ self.x


def views(batch: pa.RecordBatch) -> tuple[Rows, Rows]:
    """Text and metadata rows of a batch of the feature table."""
    t, first, m, v = (batch.column(batch.schema.get_field_index(c)) for c in ("t", "first", "m", "mv"))
    return Rows(t, None, 1 << TEXT_BITS, first.to_numpy(zero_copy_only=False)), Rows(m, v, 1 << META_BITS)


def _fit(batches, penalty, steps):
    """The first weights of both views, from the labelled rows alone."""
    batches = [b for b in batches if b.num_rows]
    if not batches:
        return
    # ids are distinct: the fit does not depend on the order of arrival
    batch = pa.Table.from_batches(batches).sort_by("doc_id").combine_chunks().to_batches()[0]
    bad = batch.column(batch.schema.get_field_index("bad")).to_numpy(zero_copy_only=False)
    yield pa.RecordBatch.from_arrays([pa.array([logistic(rows, bad, penalty, steps).tobytes()], pa.binary()) for rows in views(batch)], names=["t", "m"])


def lists(rows, part: int, kind) -> pa.ListArray:
    ends = np.cumsum([0, *[len(r[part]) for r in rows]]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([r[part] for r in rows]).astype(kind)))


def _features(batches):
    for batch in slices(batches, "text"):
        texts = raw_texts(batch, "text")
        t, m = text_view(texts), [meta_view(x, v) for x, v in zip(texts, batch.column(1).to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), lists(t, 0, np.int32), pa.array([r[1][0] for r in t]), lists(m, 0, np.int32), lists(m, 1, float)],
                                         names=["doc_id", "t", "first", "m", "mv"])


def _pass(now, teacher, sure):
    """One row per task: loss, rows and gradient of each view at the weights ``now``.  Rows without a label count for a view where
    the other view's ``teacher`` weights are sure of them."""
    def run(batches):
        w, old = now.value, teacher.value
        total = [[0.0, 0.0, np.zeros(1 << TEXT_BITS)], [0.0, 0.0, np.zeros(1 << META_BITS)]]
        for batch in batches:
            if not batch.num_rows:
                continue
            bad = batch.column(batch.schema.get_field_index("bad")).to_numpy(zero_copy_only=False)
            known, rows = ~np.isnan(bad), views(batch)
            told = [1 / (1 + np.exp(-r.dot(o))) for r, o in zip(rows, (old.t, old.m), strict=True)]
            for view, (r, coef) in enumerate(zip(rows, (w.t, w.m), strict=True)):
                p = told[1 - view]
                use = known | (p >= sure) | (p <= 1 - sure)
                y = np.where(known, np.nan_to_num(bad), p >= 0.5)
                z = r.dot(coef)
                total[view][0] += ((np.logaddexp(0, z) - y * z) * use).sum()
                total[view][1] += use.sum()
                total[view][2] += r.back((1 / (1 + np.exp(-z)) - y) * use)
        yield pa.RecordBatch.from_arrays([pa.array([np.concatenate([np.append(x[2], x[:2]) for x in total]).tobytes()], pa.binary())], names=["sums"])
    return run


def exchange(rows: DataFrame, t: np.ndarray, m: np.ndarray, sure: float, penalty: float, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """One round: both views go on from their weights ``t`` and ``m`` with what the other view is sure of among ``rows``."""
    spark = rows.sparkSession
    teacher = shared(spark, SimpleNamespace(t=t, m=m))

    def value(w):
        now = shared(spark, SimpleNamespace(t=w[:1 << TEXT_BITS], m=w[1 << TEXT_BITS:]))
        sums = (rows.mapInArrow(_pass(now, teacher, sure), "sums binary").rdd.map(lambda r: np.frombuffer(r[0]))
                .treeReduce(lambda a, b: a + b, depth=2))
        now.destroy()
        split = (1 << TEXT_BITS) + 2
        parts = [penalised(x[-2], x[:-2], max(x[-1], 1.0), w[own], penalty)
                 for x, own in ((sums[:split], np.s_[:1 << TEXT_BITS]), (sums[split:], np.s_[1 << TEXT_BITS:]))]
        return sum(p[0] for p in parts), np.concatenate([p[1] for p in parts])

    w = minimise(value, np.concatenate([t, m]), steps)
    teacher.destroy()
    return w[:1 << TEXT_BITS], w[1 << TEXT_BITS:]


def _logits(model):
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                z = [r.dot(w) for r, w in zip(views(batch), (model.value.t, model.value.m), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index("bad")), *map(pa.array, z)], names=["bad", "zt", "zm"])
    return run


def learn(docs: DataFrame, labels: DataFrame, meta: list[str], max_labelled: int, rounds: int, sure: float, penalty: float, steps: int, round_steps: int):
    """The weights, or None if the labelled rows (or those held for calibration) have one class only.  ``docs``: doc_id, values, text."""
    spark = docs.sparkSession
    bad = F.when((F.col("quality") == 0) | (F.coalesce(F.col("toxic"), F.lit(0)) == 1), 1.0).otherwise(0.0)
    known = materialize(labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.max(bad).alias("bad")))
    seeded = lambda seed: F.xxhash64(F.lit(seed), F.col("doc_id").cast("string"))
    present = known.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    picked = materialize(present.orderBy(seeded("label"), "doc_id").limit(max_labelled).select("doc_id", F.lit(True).alias("picked")))
    told = known.join(F.broadcast(picked), "doc_id", "left")  # at most max_labelled rows
    kind = dict(docs.dtypes)["doc_id"]
    with batches_of(spark):
        features = docs.select("doc_id", "values", "text").mapInArrow(_features, f"doc_id {kind}, t array<int>, first double, m array<int>, mv array<double>")
        rows = materialize(features.join(told, "doc_id", "left").filter("bad IS NULL OR picked"))
        held = F.pmod(seeded("fold"), F.lit(4)) == 0
        sample = materialize(rows.filter("bad IS NOT NULL").dropDuplicates(["doc_id"]).withColumn("held", held))
        if any({r[0] for r in sample.filter(F.col("held") == h).select("bad").distinct().collect()} != {0.0, 1.0} for h in (False, True)):
            return None
        train = sample.filter("NOT held").drop("held")
        first = train.coalesce(1).mapInArrow(lambda b: _fit(b, penalty, steps), "t binary, m binary").first()  # at most max_labelled rows
        t, m = np.frombuffer(first.t), np.frombuffer(first.m)
        taught = train.unionByName(rows.filter("bad IS NULL"))
        for _ in range(rounds):
            t, m = exchange(taught, t, m, sure, penalty, round_steps)
        model = SimpleNamespace(t=t, m=m)
        out = sample.filter("held").mapInArrow(_logits(shared(spark, model)), "bad double, zt double, zm double").orderBy("zt", "zm", "bad").collect()
    y, zt, zm = (np.array(x) for x in zip(*out, strict=True))
    for name, columns in (("ct", (zt,)), ("cm", (zm,)), ("c", (zt, zm))):
        setattr(model, name, logistic(Dense(*columns), y, 1e-4, 100))
    return model


def values(meta: list[str]):
    return F.array(*[F.col(c).cast("string") for c in meta]).cast("array<string>").alias("values")


def _score(model, text):
    def run(batches):
        m = model.value
        for batch in slices(batches, text):
            texts, width = raw_texts(batch, text), batch.num_columns - 2
            zt = np.array([(m.t[a] * v).sum() for a, v in text_view(texts)])
            zm = np.array([(m.m[a] * v).sum() for a, v in (meta_view(x, v) for x, v in zip(texts, batch.column(width + 1).to_pylist(), strict=True))])
            logits = [m.ct[0] * zt + m.ct[1], m.cm[0] * zm + m.cm[1], m.c[0] * zt + m.c[1] * zm + m.c[2]]
            yield pa.RecordBatch.from_arrays([*batch.columns[:width], *[pa.array(1 / (1 + np.exp(-z))) for z in logits]],
                                             names=[*batch.schema.names[:width], "p_text", "p_meta", "p_bad"])
    return run


def score_documents(docs: DataFrame, labels: DataFrame, keep: list[str] | None = None, meta: tuple[str, ...] = ("source", "lang"),
                    max_labelled: int = 10_000, rounds: int = 2, sure: float = 0.95, penalty: float = 3e-4, steps: int = 40,
                    round_steps: int = 4, threshold: float = 0.5) -> DataFrame:
    """The columns ``keep`` (default doc_id) of every row of ``docs`` with p_text, p_meta, p_bad (chance of low quality or
    toxicity) and kept (these get other names where ``keep`` has them).

    A null text has no words and is scored by its metadata; a null source or language is a value of its own; labels with
    a null id or quality are ignored, several labels of an id count as bad if one is; repeated rows score alike, and without a label each
    takes part in the rounds; an empty
    table gives an empty result; without labels of both classes all probabilities are 0 and every row is kept."""
    require(docs, "doc_id", "text")
    small_batches(docs.sparkSession)
    keep, meta = keep or ["doc_id"], [c for c in meta if c in docs.columns]
    narrow = docs.select("doc_id", values(meta), F.col("text").cast("string").alias("text"))
    model = learn(narrow, labels.select("doc_id", "quality", "toxic"), meta, max_labelled, rounds, sure, penalty, steps, round_steps)
    out = fresh(docs.select(*keep), "p_text", "p_meta", "p_bad", "kept")
    if model is None:
        return docs.select(*keep, *[F.lit(0.0).alias(c) for c in out[:3]], F.lit(True).alias(out[3]))
    inside = [f"k{i}" for i in range(len(keep))]
    x = docs.select(*[F.col(c).alias(n) for c, n in zip(keep, inside, strict=True)], F.col("text").alias("text"), values(meta))
    kinds = dict(x.dtypes)
    scored = x.mapInArrow(_score(shared(docs.sparkSession, model), "text"), ", ".join(f"{n} {kinds[n]}" for n in inside) + ", p_text double, p_meta double, p_bad double")
    return scored.select(*[F.col(n).alias(c) for c, n in zip(keep, inside, strict=True)],
                         *[F.col(n).alias(o) for n, o in zip(("p_text", "p_meta", "p_bad"), out, strict=False)], (F.col("p_bad") < threshold).alias(out[3]))


def drop_low_quality(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows the classifier rejects; same columns."""
    out = score_documents(docs, labels, docs.columns, **options)
    return out.filter(F.col(out.columns[-1])).select(*docs.columns)


def op8_cotrain_quality(spark, sf_dir):
    return score_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
