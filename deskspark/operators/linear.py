"""Linear models over term lists: in-row scoring, and one solver for many (training set, class) problems at once.

Terms arrive as ``array<string>`` columns.  Scoring is an Arrow UDF of that column alone, so the other columns never leave
the JVM and no row is shuffled or joined back by its id.  The UDFs are declared non-deterministic, which keeps a later
filter on the score from being pushed below (where text and score would be computed a second time).  Training keeps sparse blocks of rows in a persisted RDD;
every iteration is one job that sums the losses and gradients of all problems, and the driver holds the weights only
(problems x features, both parameters).
"""

from __future__ import annotations

import functools
import logging
import sys
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskspark.operators.common import release

# executors need not be able to import the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Terms that one step of a task works on at a time.
SLICE_TERMS = 1 << 20
#: Entries and rows up to which the rows of a group are put together in a block.
BLOCK_ENTRIES, BLOCK_ROWS = 1 << 18, 1 << 15

#: Rounds of the solver whose partial sums may lie on disk at a time.
RELEASE_ROUNDS = 32


class Block(NamedTuple):
    """Some rows of one group: per row its number of entries, label and, per fit, the inverse norm of its features; per entry the
    place in the union of the vocabularies and the term's count.  The entries come a second time by place, for sums by place without
    a scatter: the places that occur, how many entries each has, and per entry its row and count."""
    group: int
    counts: np.ndarray
    label: np.ndarray
    scale: np.ndarray
    place: np.ndarray
    tf: np.ndarray
    places: np.ndarray
    each: np.ndarray
    row: np.ndarray
    tf_by_place: np.ndarray


class Union(NamedTuple):
    """The terms of several vocabularies, and per vocabulary the places of its terms in them with their idf."""
    words: list[str]
    at: list[np.ndarray]
    idf: list[np.ndarray]

    def spread(self, fit: int, weights: np.ndarray) -> np.ndarray:
        """Weights of a fit's own terms, times idf, over all terms."""
        out = np.zeros(len(self.words))
        out[self.at[fit]] = self.idf[fit] * weights[:len(self.at[fit])]
        return out


def union(vocabularies: list[list[str]], idfs: list[list[float]]) -> Union:
    """The commonest terms come first, so that most entries of a row read weights that lie together."""
    rarest = {}
    for v, i in zip(vocabularies, idfs):
        rarest |= {w: max(x, rarest.get(w, 0.0)) for w, x in zip(v, i)}
    words = sorted(rarest, key=lambda w: (rarest[w], w))
    place = {w: i for i, w in enumerate(words)}
    return Union(words, [np.array([place[w] for w in v], np.intp) for v in vocabularies], [np.array(i, float) for i in idfs])


def slices(terms: pa.Array, most: int = SLICE_TERMS):
    """(first row, rows) of a list array in pieces of at most ``most`` terms, or of one row."""
    ends = np.cumsum(pc.list_value_length(terms).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    begin = 0
    while begin < len(terms):
        past = ends[begin - 1] if begin else 0
        stop = max(int(np.searchsorted(ends, past + most, "right")), begin + 1)
        yield begin, terms.slice(begin, stop - begin)
        begin = stop


def row_sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of ``counts`` values."""
    out, some = np.zeros(len(counts)), counts > 0
    if some.any():
        out[some] = np.add.reduceat(values, (np.cumsum(counts) - counts)[some])
    return out


def inverse(norm: np.ndarray) -> np.ndarray:
    return np.where(norm > 0, 1 / np.where(norm > 0, norm, 1), 0.0)


def known_terms(terms: pa.Array, vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, place in the vocabulary) of every occurrence of a known term; a null list has none."""
    place = pc.index_in(terms.flatten(), value_set=vocabulary)
    row = np.repeat(np.arange(len(terms)), pc.list_value_length(terms).fill_null(0).to_numpy(zero_copy_only=False))
    known = place.is_valid().to_numpy(zero_copy_only=False)
    return row[known], place.fill_null(0).to_numpy(zero_copy_only=False)[known].astype(np.int64)


def counted_entries(terms: pa.Array, vocabulary: pa.Array, rank: np.ndarray | None = None):
    """(row, place, tf) of the known terms, sorted by row (its ``rank``, if given) and place."""
    row, place = known_terms(terms, vocabulary)
    width = max(len(vocabulary), 1)
    key, tf = np.unique((row if rank is None else rank[row]) * width + place, return_counts=True)
    return key // width, key % width, tf


class Book(NamedTuple):
    """Terms as numbers: the tokens that they are made of, and by n the first n tokens of terms, each as the number of the first n - 1
    and the next token in one key, with the place of the term that ends there or -1."""
    tokens: pa.Array
    keys: list[pa.Array]
    places: list[np.ndarray]


def book(words: list[str], whole: bool) -> Book:
    """``whole``: every term is one token, whatever it holds."""
    parts = [[w] if whole else w.split(" ") for w in words]
    tokens = sorted(set().union(*parts))
    code, keys, places = {t: i for i, t in enumerate(tokens)}, [], []
    for i, part in enumerate(parts):
        begun = 0
        for n, t in enumerate(part):
            if n == len(keys):
                keys.append({})
                places.append([])
            begun = keys[n].setdefault(begun * len(tokens) + code[t], len(keys[n]))
            if begun == len(places[n]):
                places[n].append(-1)
        places[len(part) - 1][begun] = i
    return Book(pa.array(tokens, pa.string()), [pa.array(list(k), pa.int64()) for k in keys], [np.array(p, np.int64) for p in places])


def gram_entries(tokens: pa.Array, known: Book, width: int, rank: np.ndarray):
    """:func:`counted_entries` of the n-grams of the rows' tokens."""
    code = pc.index_in(tokens.flatten(), value_set=known.tokens).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(tokens)), pc.list_value_length(tokens).fill_null(0).to_numpy(zero_copy_only=False))
    found, at = [np.zeros(0, np.int64)], np.flatnonzero(code >= 0)
    begun = np.zeros(len(at), np.int64)
    for n, (keys, places) in enumerate(zip(known.keys, known.places)):
        if n:  # one token more, of the same row
            on = np.minimum(at + n, len(code) - 1)
            inside = (at + n < len(code)) & (code[on] >= 0) & (row[on] == row[at])
            at, begun = at[inside], begun[inside]
        begun = pc.index_in(pa.array(begun * len(known.tokens) + code[at + n]), value_set=keys).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        at, begun = at[begun >= 0], begun[begun >= 0]
        place = places[begun]
        found.append(rank[row[at[place >= 0]]] * width + place[place >= 0])
    key, tf = np.unique(np.concatenate(found), return_counts=True)
    return key // width, key % width, tf


def lists(matrix: np.ndarray) -> pa.Array:
    """The rows of a matrix as an array of lists."""
    rows, width = matrix.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * width), pa.array(matrix.reshape(-1)))


def tfidf_column(terms: Column, vocabulary: list[str], idf: list[float], grams: bool = False) -> Column:
    """array<struct<term, tf, tfidf>> of the known terms of each row, tf * idf at unit norm, sorted by term.  ``grams``: the
    column has the rows' tokens, and their n-grams are the terms."""
    words, factors = pa.array(vocabulary, pa.string()), np.array(idf, float)
    known = book(vocabulary, False) if grams else None

    @F.arrow_udf("array<struct<term:string,tf:bigint,tfidf:double>>")
    def weighted(column: pa.Array) -> pa.Array:
        parts = [piece(part) for _, part in slices(column)]
        return pa.concat_arrays(parts) if parts else piece(column)

    def piece(column: pa.Array) -> pa.Array:
        row, place, tf = gram_entries(column, known, max(len(words), 1), np.arange(len(column))) if grams else counted_entries(column, words)
        value = tf * factors[place]
        value /= np.sqrt(np.bincount(row, value * value, len(column)))[row]
        ends = np.searchsorted(row, np.arange(len(column) + 1)).astype(np.int32)
        items = pa.StructArray.from_arrays([words.take(pa.array(place)), pa.array(tf.astype(np.int64)), pa.array(value)],
                                           names=["term", "tf", "tfidf"])
        return pa.ListArray.from_arrays(pa.array(ends), items)

    return weighted.asNondeterministic()(terms)


# --------------------------------------------------------------------------- training

def blocks(docs: DataFrame, shared: Union):
    """The rows (label, group, and tokens or terms) of ``docs`` as a persisted RDD of blocks, every row once whatever the number of fits.  Blocks
    are dealt over as many partitions as there are cores: a job sends one partial sum per partition, so their number
    must not grow with the rows."""
    fits, width, column = range(len(shared.at)), max(len(shared.words), 1), "tokens" if "tokens" in docs.columns else "terms"
    known = docs.sparkSession.sparkContext.broadcast(
        (book(shared.words, column == "terms"), [shared.spread(f, np.ones(len(shared.at[f]))) for f in fits]))
    small = np.uint16 if width <= 1 << 16 else np.int32

    def pack(batches):
        vocabulary, idfs = known.value
        for whole in batches:
            for begin, terms in slices(whole.column(2)):
                label, group = (whole.column(i).slice(begin, len(terms)).to_numpy(zero_copy_only=False).astype(np.int32) for i in range(2))
                order = np.argsort(group, kind="stable")
                rank = np.empty(len(order), np.int64)
                rank[order] = np.arange(len(order))
                row, place, tf = gram_entries(terms, vocabulary, width, rank)
                counts = np.bincount(row, minlength=len(order))
                scale = np.array([inverse(np.sqrt(row_sums((tf * idf[place]) ** 2, counts))) for idf in idfs])
                ends, label, group = np.concatenate([[0], np.cumsum(counts)]), label[order], group[order]
                for g in np.unique(group):
                    a, b = np.searchsorted(group, [g, g + 1])
                    cells = [counts[a:b].astype(np.int32), label[a:b], scale[:, a:b], place[ends[a]:ends[b]].astype(small), tf[ends[a]:ends[b]].astype(np.int32)]
                    yield pa.RecordBatch.from_arrays([pa.array([g], pa.int32()), *[pa.array([c.tobytes()], pa.binary()) for c in cells]],
                                                     names=["group", "counts", "label", "scale", "place", "tf"])

    def read(r):
        counts, label, scale, place, tf = (np.frombuffer(bytes(c), t) for c, t in zip(r[1:], (np.int32, np.int32, np.float64, small, np.int32)))
        return counts, label, scale.reshape(len(fits), -1), place, tf

    def joined(part):
        """Rows come in small pieces; those of a group go into one block until it is large enough."""
        open_ = {}
        for r in part:
            own = open_.setdefault(r[0], [])
            own.append(read(r))
            if sum(len(x[3]) for x in own) >= BLOCK_ENTRIES or sum(len(x[0]) for x in own) >= BLOCK_ROWS:
                yield block(r[0], open_.pop(r[0]))
        for group, own in open_.items():
            yield block(group, own)

    def block(group, own):
        counts, label, scale, place, tf = (np.concatenate(x, axis=-1) for x in zip(*own))
        tf = tf.astype(np.min_scalar_type(tf.max(initial=0)))
        order = np.argsort(place, kind="stable")
        places, each = np.unique(place[order], return_counts=True)
        row = np.repeat(np.arange(len(counts)), counts)[order].astype(np.min_scalar_type(max(len(counts) - 1, 0)))
        return Block(group, counts, label, scale, place, tf, places, each, row, tf[order])

    packed = docs.select("label", "group", column).mapInArrow(
        pack, "group int, counts binary, label binary, scale binary, place binary, tf binary")
    return packed.rdd.repartition(max(docs.sparkSession.sparkContext.defaultParallelism, 2)).mapPartitions(joined).persist(StorageLevel.MEMORY_AND_DISK)


def _total(rdd, shape, add):
    """Sum of what ``add(sums, block)`` puts into a small array of ``shape``; the driver adds one array per partition."""
    def of(part):
        sums = np.zeros(shape)
        for block in part:
            add(sums, block)
        yield sums

    return rdd.mapPartitions(of).reduce(lambda a, b: a + b)


def paired(columns: list[np.ndarray]) -> np.ndarray:
    """One or two columns as one array, two as complex numbers: numpy moves and sums both in one step."""
    return np.stack(columns, -1).view(complex)[..., 0] if len(columns) == 2 else columns[0]


def apart(values: np.ndarray) -> np.ndarray:
    """(row, column) of :func:`paired`."""
    return values.view(float).reshape(len(values), -1)


class Entries:
    """A block's entries as the solver reads them, converted once per job: sums by row and by place of one or two columns at a time."""

    def __init__(self, b: Block):
        self.block, self.place, self.tf = b, b.place.astype(np.intp), {1: b.tf.astype(float)}
        self.some = b.counts > 0
        self.begin = (np.cumsum(b.counts) - b.counts)[self.some]

    @functools.cached_property
    def by_place(self):
        b = self.block
        return b.places.astype(np.intp), b.row.astype(np.intp), {1: b.tf_by_place.astype(float)}, np.cumsum(b.each) - b.each

    @staticmethod
    def times(values: np.ndarray, tf: dict) -> np.ndarray:
        width = values.itemsize // 8
        if width not in tf:
            tf[width] = np.repeat(tf[1], width)
        flat = values.view(float)
        flat *= tf[width]
        return values

    def by_row(self, spread: np.ndarray) -> np.ndarray:
        out = np.zeros(len(self.some), spread.dtype)
        if len(self.begin):
            out[self.some] = np.add.reduceat(self.times(spread.take(self.place), self.tf), self.begin)
        return out

    def add_by_place(self, out: np.ndarray, values: np.ndarray) -> None:
        places, row, tf, begin = self.by_place
        if len(begin):
            out[places] += np.add.reduceat(self.times(values.take(row), tf), begin)

    def margins(self, fit: int, spread: np.ndarray, intercepts: np.ndarray) -> np.ndarray:
        """(row, column): margins under the weights of one or two classes."""
        return apart(self.by_row(spread)) * self.block.scale[fit][:, None] + intercepts


def twos(items) -> list[tuple]:
    items = [int(i) for i in items]
    return [tuple(items[i:i + 2]) for i in range(0, len(items), 2)]


def squared_hinge(rdd, shared: Union, train: list[set[int]], k: int, costs: list[float], max_iter: int, tol: float) -> np.ndarray:
    """Weights (fit, class, place) of the one-vs-rest linear SVMs, one per fit and class: the fit's cost times the squared hinge
    losses of the fit's training groups plus half the squared norm, intercept included.  Limited-memory BFGS with a step
    of its own per problem, all evaluated by the same job.  A problem ends at ``tol`` of its first gradient; those that
    have not ended after ``max_iter`` rounds are logged."""
    fits, context, parts = len(train), rdd.context, rdd.getNumPartitions()
    sizes = [len(a) for a in shared.at]
    width, known = max(sizes), context.broadcast(shared)

    def job(w, need):
        """Per problem that ``need`` names the sums over its rows: the slopes by place and of the intercept, and the loss.  Partial sums
        are added up by problem in the tasks; the driver gets each sum once."""
        now = context.broadcast(w)

        def of(part):
            union_, spreads, sums = known.value, {}, {}
            for b in part:
                entries = None
                for fit in (f for f in range(fits) if need[f].any() and b.group in train[f]):
                    entries = entries or Entries(b)
                    for pair in twos(np.flatnonzero(need[fit])):
                        own = now.value[fit, list(pair)]
                        if (fit, pair) not in spreads:
                            spreads[fit, pair] = paired([union_.spread(fit, w) for w in own])
                            sums[fit, pair] = np.zeros(len(union_.words), spreads[fit, pair].dtype), np.zeros((2, len(pair)))
                        out, rest = sums[fit, pair]
                        y = np.where(b.label[:, None] == np.array(pair), 1.0, -1.0)
                        short = np.maximum(1.0 - y * entries.margins(fit, spreads[fit, pair], own[:, -1]), 0.0)
                        slope = -2.0 * costs[fit] * y * short
                        entries.add_by_place(out, paired(list((slope * b.scale[fit][:, None]).T)))
                        rest += slope.sum(0), costs[fit] * (short * short).sum(0)
            for (fit, pair), (out, rest) in sums.items():
                for i, j in enumerate(pair):
                    yield (fit, j), np.concatenate([apart(out)[union_.at[fit], i] * union_.idf[fit], rest[:, i]])

        found = rdd.mapPartitions(of).reduceByKey(lambda a, b: a + b, min(parts, fits * k)).collectAsMap()
        now.destroy()
        sums = np.zeros((fits, k, width + 2))
        for (fit, j), own in found.items():
            sums[fit, j, :sizes[fit]], sums[fit, j, width:] = own[:-2], own[-2:]
        return sums

    def evaluate(w, need, loss=0.0, grad=0.0):
        """Losses and gradients of the problems that ``need`` them; the others keep theirs."""
        sums = job(w, need)
        return (np.where(need, sums[..., -1] + 0.5 * (w * w).sum(-1), loss),
                np.where(need[..., None], sums[..., :-1] + w, grad))

    dot = lambda a, b: (a * b).sum(-1)
    w = np.zeros((fits, k, width + 1))
    loss, grad = evaluate(w, np.ones((fits, k), bool))
    goal, past = tol * np.sqrt(dot(grad, grad)), []
    for round_ in range(1, max_iter + 1):
        if not round_ % RELEASE_ROUNDS:
            release(context)
        open_ = np.sqrt(dot(grad, grad)) > goal
        if not open_.any():
            return w
        step = -grad
        used = []
        for s, y, r in reversed(past):
            a = r * dot(s, step)
            used.append(a)
            step = step - a[..., None] * y
        if past:
            s, y, r = past[-1]
            step = step * np.where(r > 0, dot(s, y) / np.maximum(dot(y, y), 1e-300), 1.0)[..., None]
        else:
            step = step / np.maximum(np.sqrt(dot(grad, grad)), 1.0)[..., None]
        for (s, y, r), a in zip(past, reversed(used)):
            step = step + (a - r * dot(y, step))[..., None] * s
        slope = dot(step, grad)
        uphill = slope >= 0
        step = np.where(uphill[..., None], -grad, step)
        slope = np.where(uphill, -dot(grad, grad), slope)
        size = np.where(open_, 1.0, 0.0)
        need, new_loss, new_grad = open_, loss, grad
        for _try in range(30):
            new = w + size[..., None] * step
            new_loss, new_grad = evaluate(new, need, new_loss, new_grad)
            need = new_loss > loss + 1e-4 * size * slope + 1e-12 * np.abs(loss)
            if not need.any():
                break
            size = np.where(need, size / 2, size)
        else:
            size = np.where(need, 0.0, size)
            new = w + size[..., None] * step
            new_loss, new_grad = np.where(need, loss, new_loss), np.where(need[..., None], grad, new_grad)
        s, y = new - w, new_grad - grad
        curve = dot(s, y)
        past = [*past[-9:], (s, y, np.where(curve > 1e-12, 1.0 / np.maximum(curve, 1e-300), 0.0))]
        if not (size > 0).any():
            break
        w, loss, grad = new, new_loss, new_grad
    left = int((np.sqrt(dot(grad, grad)) > goal).sum())
    if left:
        logging.getLogger(__name__).warning("%d of %d problems short of tolerance %g", left, fits * k, tol)
    return w


def sigmoids(rdd, shared: Union, held: list[set[int]], coef: np.ndarray, tol: float, max_iter: int = 100) -> np.ndarray:
    """(fit, class, [a, b]): Platt's sigmoid 1 / (1 + exp(-(a * margin + b))) with soft targets, fitted on the held groups
    of every fit by damped Newton steps; one job of five sums per problem and step."""
    fits, k = coef.shape[:2]
    weights = rdd.context.broadcast((shared, coef))

    def of(part):
        for b in part:
            entries = Entries(b)
            for fit in (f for f in range(fits) if b.group in held[f]):
                yield fit, class_margins(entries, *weights.value, fit), b.label

    margins = rdd.mapPartitions(of).persist(StorageLevel.MEMORY_AND_DISK)

    def tally(sums, b):
        fit, m, label = b
        sums[fit, :, 0] += np.bincount(label, minlength=k)[:k]
        sums[fit, :, 1] += len(label)

    counts = _total(margins, (fits, k, 2), tally)
    high = (counts[..., 0] + 1) / (counts[..., 0] + 2)
    low = 1 / (counts[..., 1] - counts[..., 0] + 2)

    def evaluate(ab):
        def add(sums, b):
            fit, m, label = b
            z = m * ab[fit, :, 0] + ab[fit, :, 1]
            t = np.where(label[:, None] == np.arange(k), high[fit], low[fit])
            p = np.exp(-np.logaddexp(0, -z))
            v = p * (1 - p)
            for i, x in enumerate((np.logaddexp(0, z) - t * z, (p - t) * m, p - t, v * m * m, v * m, v)):
                sums[fit, :, i] += x.sum(0)

        return _total(margins, (fits, k, 6), add)

    ab = np.stack([np.zeros((fits, k)), np.log((counts[..., 0] + 1) / (counts[..., 1] - counts[..., 0] + 1))], -1)
    sums = evaluate(ab)
    for _ in range(max_iter):
        loss, ga, gb, haa, hab, hbb = np.moveaxis(sums, -1, 0)
        haa, hbb = haa + 1e-9, hbb + 1e-9
        det = haa * hbb - hab * hab
        step = -np.stack([(hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det], -1)
        size = np.where(np.maximum(np.abs(ga), np.abs(gb)) > tol * np.maximum(counts[..., 1], 1), 1.0, 0.0)
        if not size.any():
            break
        for _try in range(30):
            new = ab + size[..., None] * step
            sums = evaluate(new)
            worse = sums[..., 0] > loss + 1e-10 * np.abs(loss)
            if not worse.any():
                break
            size = np.where(worse, size / 2, size)
        ab = new
    else:
        logging.getLogger(__name__).warning("calibration stopped after %d steps", max_iter)
    margins.unpersist()
    weights.destroy()
    return ab


def class_margins(entries: Entries, shared: Union, coef: np.ndarray, fit: int) -> np.ndarray:
    """Margins (row, class) of a block under one fit."""
    own = coef[fit]
    return np.concatenate([entries.margins(fit, paired([shared.spread(fit, own[j]) for j in pair]), own[list(pair), -1])
                           for pair in twos(range(len(own)))], axis=1)


def confusions(rdd, shared: Union, coef: np.ndarray, platt, asked: list[tuple[set[int], list[int]]]) -> np.ndarray:
    """Per (groups, fits) of ``asked`` the counts (label, predicted class) of the rows in these groups, under the probabilities
    averaged over these fits (the first class on ties)."""
    k, weights = coef.shape[1], rdd.context.broadcast((shared, coef, platt))

    def add(sums, b):
        union_, w, sigmoid = weights.value
        entries = Entries(b)
        for i, (groups, own) in enumerate(asked):
            if b.group in groups:
                p = sum(probabilities(class_margins(entries, union_, w, f), sigmoid[f]) for f in own) / len(own)
                sums[i] += np.bincount(b.label * k + p.argmax(1), minlength=k * k).reshape(k, k)

    found = _total(rdd, (len(asked), k, k), add)
    weights.destroy()
    return found


class Fit(NamedTuple):
    """One fitted pipeline: vocabulary with idf, weights (class, place + intercept), sigmoids (class, [a, b]) or None."""
    vocabulary: list[str]
    idf: list[float]
    coef: np.ndarray
    platt: np.ndarray | None


def probabilities(m: np.ndarray, platt) -> np.ndarray:
    """Calibrated probabilities (row, class) of margins, which stay margins without sigmoids."""
    if platt is None:
        return m
    p = np.exp(-np.logaddexp(0, -(m * platt[:, 0] + platt[:, 1])))
    total = p.sum(1, keepdims=True)
    return np.where(total > 0, p / np.where(total > 0, total, 1), 1.0 / p.shape[1])


def scores(terms: Column, fits: list[Fit]) -> Column:
    """array<double>: calibrated probabilities averaged over ``fits``, or the margins of a fit without sigmoids."""
    shared = union([f.vocabulary for f in fits], [f.idf for f in fits])
    words, each = pa.array(shared.words, pa.string()), range(len(fits))
    held = [(shared.spread(i, np.ones(len(shared.at[i]))), [(shared.spread(i, c), c[-1]) for c in f.coef], f.platt) for i, f in zip(each, fits)]

    @F.arrow_udf("array<double>")
    def score(column: pa.Array) -> pa.Array:
        parts = [piece(part) for _, part in slices(column)]
        return lists(np.concatenate(parts) if parts else np.zeros((0, len(held[0][1]))))

    def piece(column: pa.Array) -> np.ndarray:
        row, place, tf = counted_entries(column, words)
        counts, total = np.bincount(row, minlength=len(column)), 0
        for idf, classes, platt in held:
            scale = inverse(np.sqrt(row_sums((tf * idf[place]) ** 2, counts)))
            total = total + probabilities(np.stack([row_sums(w[place] * tf, counts) * scale + c for w, c in classes], axis=1), platt)
        return total / len(held)

    return score.asNondeterministic()(terms)
