"""LM scoring with a hidden Markov language model.

The symbols of the model are all words with ``own_count`` training tokens or more, one per word class for all other words (a class is a
hash of the last two characters) and the end of the text.  So the symbols grow with the corpus, up to ``symbols`` of them: the
emissions, one number per symbol and state, go to the tasks whole.  A word of a class has probability (c + 1) / (N_b + V_b + 1)
within it, c being its count, N_b and V_b the class's tokens and distinct words.  The probabilities of the words seen in training
and of one unseen word per class add up to one; every unseen word of a class has that same share, as in the base score.

1. Words are counted over all training texts (partial counts in the tasks, one shuffle by word).
2. Texts are written once as symbol sequences.  Counts of frequent words come from a broadcast table of at most ``known``
   entries, those of all other words from a shuffled join.
3. Baum-Welch: each round one pass; forward-backward in the tasks over segments of at most ``SEGMENT`` tokens, expected
   counts summed per partition and then by symbol in a shuffle.
4. Scaled forward recursion over every whole text gives its exact likelihood.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskspark.llm.common import coded_words, raw_texts, read, require, shared, ship, slices
from deskspark.operators.common import materialize

ship(__name__)

SEGMENT, CHUNK, CLASSES, COUNTER_MAX = 256, 1 << 18, 64, 300_000


def _count_rows(batches):
    counts: Counter = Counter()

    def flush():
        out = pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.binary()).cast(pa.string()),
                                          pa.array(counts.values(), pa.int64())], names=["word", "c"])
        counts.clear()
        return out

    for batch in slices(batches, "text"):
        for text in raw_texts(batch, "text"):
            counts.update(text.lower().split())
            counts[b""] += 1  # the end of the text
        if len(counts) > COUNTER_MAX:
            yield flush()
    yield flush()


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, c) over all texts; the end of the text is the empty word."""
    return texts.select("text").mapInArrow(_count_rows, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


def _cut(counts: DataFrame, most: int):
    """Condition for at most ``most`` words, the most frequent ones: whole counts as far as they go, and of the words with the last
    count those with a small hash.  Histograms of logarithms, of the counts in one step and of hashes in turn, each of bounded size."""
    c, h = F.col("c"), F.floor(F.crc32("word") / (1 << 20)).cast("int")
    step = F.floor(F.log2(c.cast("double")) * 64).cast("int")
    words, left, where, tied = counts.filter("word <> ''"), most, F.lit(False), F.lit(True)
    for key, rising in ((step, False), (c, False), (h, True)):
        rows = words.groupBy(key.alias("s")).agg(F.count(F.lit(1)).alias("n")).toPandas().sort_values("s", ascending=rising)
        over = rows[rows["n"].cumsum() > left]
        if over.empty:
            return where | tied
        cut = int(over.iloc[0]["s"])
        first = key < cut if rising else key > cut
        left -= int(rows["n"][rows["s"] < cut if rising else rows["s"] > cut].sum())
        where, tied, words = where | (tied & first), tied & (key == cut), words.filter(key == cut)
    return where


class Lexicon:
    """Frequent words by hash with their counts; those marked ``own`` are symbols of their own."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, own: np.ndarray, end_count: int, class_tokens, class_words):
        order = np.argsort(hashes)
        self.hashes, self.counts, own = hashes[order], counts[order], own[order]
        self.symbol = np.where(own, np.cumsum(own) - 1, -1)
        self.n_own = int(own.sum())
        self.end, self.end_count = self.n_own + CLASSES, end_count
        self.n_symbols = self.end + 1
        self.class_log = np.log10(np.asarray(class_tokens, float) + np.asarray(class_words, float) + 1)
        self.unigram = np.zeros(self.n_symbols)
        self.unigram[:self.n_own] = self.counts[self.symbol >= 0]
        self.unigram[self.n_own:self.end], self.unigram[self.end] = class_tokens, end_count


def look_up(lex, words: list[bytes]):
    """Symbol and count (-1: not in the table) of distinct words."""
    h = np.fromiter((xxhash.xxh64_intdigest(w) for w in words), np.uint64, len(words))
    at = np.minimum(np.searchsorted(lex.hashes, h), max(len(lex.hashes) - 1, 0))
    found = lex.hashes[at] == h if len(lex.hashes) else np.zeros(len(h), bool)
    count = np.where(found, lex.counts[at] if len(lex.hashes) else 0, -1)
    symbol = np.where(found, lex.symbol[at] if len(lex.hashes) else -1, -1)
    for i in np.flatnonzero(symbol < 0).tolist():
        symbol[i] = lex.n_own + word_class(words[i])
    return symbol.astype(np.uint16), count


def word_class(word: bytes) -> int:
    return zlib.crc32(word.decode()[-2:].encode()) % CLASSES


def _hash_rows(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays([
            pa.array(np.array([xxhash.xxh64_intdigest(w) for w in raw_texts(batch, "word")], np.uint64).view(np.int64)),
            *[batch.column(batch.schema.get_field_index(c)) for c in ("c", "own")]], names=["h", "c", "own"])


def lexicon(counts: DataFrame, symbols: int, own_count: int, known: int):
    """The lexicon, the condition for a word to be in its table, N and V."""
    if symbols + CLASSES + 1 > 1 << 16 or symbols > known:
        raise ValueError(f"{symbols} symbols: they must fit 16 bits and the table of {known} known words")
    own, inside = _cut(counts, symbols) & (F.col("c") >= own_count), _cut(counts, known)
    table = (counts.filter((F.col("word") != "") & inside).select("word", "c", own.alias("own"))
             .mapInArrow(_hash_rows, "h long, c long, own boolean").toPandas())
    total = counts.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v"), F.sum(F.expr("IF(word = '', c, 0)")).alias("e")).first()
    rest = (counts.filter((F.col("word") != "") & ~own).groupBy((F.crc32(F.expr("right(word, 2)")) % CLASSES).alias("k"))
            .agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).toPandas())
    tokens, words = np.zeros(CLASSES), np.zeros(CLASSES)
    tokens[rest["k"].to_numpy(int)], words[rest["k"].to_numpy(int)] = rest["n"], rest["v"]
    lex = Lexicon(table["h"].to_numpy(np.int64).view(np.uint64), table["c"].to_numpy(np.int64), table["own"].to_numpy(bool), total["e"] or 0, tokens, words)
    return lex, inside, total["n"] or 0, total["v"]


def _encode(lex):
    def run(batches):
        for batch in slices(batches, "text"):
            ids, ends, distinct = coded_words(raw_texts(batch, "text"))
            symbol, count = look_up(lex.value, distinct)
            logs, known = np.log10(np.maximum(count, 0) + 1.0), count > 0
            classed = symbol >= lex.value.n_own
            columns, begin = ([], [], [], [], [], []), 0
            log_end = math.log10(lex.value.end_count + 1)
            for end in ends.tolist():
                own = ids[begin:end]
                row = (len(own) + 1, int(known[own].sum()) + (lex.value.end_count > 0), float(logs[own].sum()) + log_end,
                       float(logs[own][classed[own]].sum()), np.append(symbol[own], np.uint16(lex.value.end)).astype(np.uint16).tobytes(),
                       [distinct[i].decode() for i in own[count[own] < 0].tolist()])
                for c, x in zip(columns, row, strict=True):
                    c.append(x)
                begin = end
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary(), pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]],
                                             names=["doc_id", "held_out", "n_tokens", "n_known", "logs", "class_logs", "symbols", "rare"])
    return run


class Model:
    def __init__(self, start, move, emit):
        self.start, self.move, self.emit = start, move, emit  # (2, K): texts, later segments; (K, K); (K, M)

    @staticmethod
    def first(unigram: np.ndarray, states: int, seed: int) -> Model:
        rng = np.random.default_rng(seed)
        emit = (unigram + 0.5) * rng.gamma(1.0, 1.0, (states, len(unigram)))
        move = np.full((states, states), 0.2 / states) + 0.8 * np.eye(states)
        return Model(np.full((2, states), 1 / states), move, emit / emit.sum(1, keepdims=True))


def _by_time(sequences: list[np.ndarray]):
    """Sequences (longest first) laid out by time: flat symbols, row counts and offsets by time."""
    lengths = np.array([len(s) for s in sequences])
    flat = np.concatenate(sequences).astype(np.int64)
    begins = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    alive = np.searchsorted(-lengths, -np.arange(1, lengths[0] + 1), "right")
    at = np.concatenate([begins[:n] + t for t, n in enumerate(alive.tolist())])
    return flat[at], alive, np.concatenate([[0], np.cumsum(alive)])


def forward(model: Model, emitted: np.ndarray, alive, offset, kinds: np.ndarray):
    """Scaled forward variables and scales, by time."""
    alpha, scale = np.empty_like(emitted), np.empty(len(emitted))
    before = None
    for t, n in enumerate(alive.tolist()):
        now = (model.start[kinds] if t == 0 else before[:n] @ model.move) * emitted[offset[t]:offset[t + 1]]
        total = now.sum(1)
        now /= total[:, None]
        alpha[offset[t]:offset[t + 1]], scale[offset[t]:offset[t + 1]] = now, total
        before = now
    return alpha, scale


def expected(model: Model, sequences: list[np.ndarray], kinds: list[int]):
    """Expected counts of starts, moves and emissions of some sequences (one E step)."""
    order = sorted(range(len(sequences)), key=lambda i: -len(sequences[i]))
    flat, alive, offset = _by_time([sequences[i] for i in order])
    kinds = np.array([kinds[i] for i in order])
    emitted = model.emit.T[flat]
    alpha, scale = forward(model, emitted, alive, offset, kinds)
    beta, ahead = np.ones_like(alpha), emitted / scale[:, None]
    for t in range(len(alive) - 2, -1, -1):
        n = alive[t + 1]
        nxt = slice(offset[t + 1], offset[t + 1] + n)
        ahead[nxt] *= beta[nxt]
        beta[offset[t]:offset[t] + n] = ahead[nxt] @ model.move.T
    prior = np.concatenate([offset[t] + np.arange(n) for t, n in enumerate(alive[1:].tolist())]) if len(alive) > 1 else np.zeros(0, int)
    moves = (alpha[prior].T @ ahead[alive[0]:]) * model.move
    weight = alpha * beta
    starts = np.stack([weight[:alive[0]][kinds == k].sum(0) for k in (0, 1)])
    emits = np.stack([np.bincount(flat, weight[:, k], model.emit.shape[1]) for k in range(weight.shape[1])])
    return starts, moves, emits, float(np.log10(scale).sum())


def _e_step(model):
    def run(batches):
        m = model.value
        k, size = m.emit.shape
        total = [np.zeros((2, k)), np.zeros((k, k)), np.zeros((k, size))]
        likelihood, pending, kinds, tokens = 0.0, [], [], 0

        def done():
            nonlocal likelihood, pending, kinds, tokens
            *parts, ll = expected(m, pending, kinds)
            for a, b in zip(total, parts, strict=True):
                a += b
            likelihood, pending, kinds, tokens = likelihood + ll, [], [], 0

        for batch in batches:
            for raw in batch.column(0).to_pylist():
                own = np.frombuffer(raw, np.uint16)
                for p in range(0, len(own), SEGMENT):
                    pending.append(own[p:p + SEGMENT])
                    kinds.append(int(p > 0))
                tokens += len(own)
                if tokens >= CHUNK:
                    done()
        if pending:
            done()
        rows = np.concatenate([total[2].T, total[1], total[0], np.full((1, k), likelihood)])
        used = np.flatnonzero(rows.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), *[pa.array(rows[used, j]) for j in range(k)]],
                                         names=["at", *[f"s{j}" for j in range(k)]])
    return run


def baum_welch(symbols: DataFrame, unigram: np.ndarray, states: int, rounds: int, seed: int) -> Model:
    """``symbols``: one binary column of sequences."""
    model, size = Model.first(unigram, states, seed), len(unigram)
    names = [f"s{j}" for j in range(states)]
    for _ in range(rounds):
        current = shared(symbols.sparkSession, model)
        sums = (symbols.mapInArrow(_e_step(current), "at int, " + ", ".join(f"{n} double" for n in names))
                .groupBy("at").agg(*[F.sum(n).alias(n) for n in names]).toPandas())
        rows = np.zeros((size + states + 3, states))
        rows[sums["at"].to_numpy(int)] = sums[names].to_numpy(float)
        emit, move, start = rows[:size].T + 0.01, rows[size:size + states] + 0.01, rows[size + states:size + states + 2] + 0.01
        model = Model(*[x / x.sum(1, keepdims=True) for x in (start, move, emit)])
    return model


def log10_likelihoods(model: Model, sequences: list[np.ndarray]) -> np.ndarray:
    """Exact log10 probability of each whole sequence; texts of like length run together.  Only the last forward variables and the
    running logarithms are kept, so a text costs its symbols and no more, however long it is."""
    out, order, emit = np.zeros(len(sequences)), sorted(range(len(sequences)), key=lambda i: -len(sequences[i])), np.ascontiguousarray(model.emit.T)
    begin = 0
    while begin < len(order):
        end, tokens = begin, 0
        while end < len(order) and tokens < CHUNK:
            tokens += len(sequences[order[end]])
            end += 1
        group = order[begin:end]
        flat, alive, offset = _by_time([sequences[i] for i in group])
        logs, before = np.zeros(len(group)), None
        for t, n in enumerate(alive.tolist()):
            before = (np.repeat(model.start[:1], n, 0) if t == 0 else before[:n] @ model.move) * emit[flat[offset[t]:offset[t + 1]]]
            total = before.sum(1)
            before /= total[:, None]
            logs[:n] += np.log10(total)
        out[group] = logs
        begin = end
    return out


def _score(model, lex):
    def run(batches):
        for batch in batches:
            own = [np.frombuffer(x, np.uint16) for x in batch.column(batch.schema.get_field_index("symbols")).to_pylist()]
            if not own:
                continue
            first, last, cost = lex.value.n_own, lex.value.end, lex.value.class_log
            inside = np.array([cost[s[(s >= first) & (s < last)] - first].sum() for s in own])
            score = log10_likelihoods(model.value, own) - inside
            keep = [n for n in batch.schema.names if n != "symbols"]
            yield pa.RecordBatch.from_arrays([*[batch.column(batch.schema.get_field_index(n)) for n in keep], pa.array(score)],
                                             names=[*keep, "hmm"])
    return run


def hmm_scores(docs: DataFrame, held_out, id: str = "doc_id", text: str = "text", states: int = 8, rounds: int = 5,
               symbols: int = 60_000, own_count: int = 32, known: int = 1 << 18, seed: int = 7) -> DataFrame:
    """One row per row of ``docs``: id, held_out, n_tokens, n_known, train_tokens, base_score and score, learned from the
    rows where ``held_out`` is false.

    A null text is empty: its one token is the end.  Repeated rows count as often as they occur and score alike; a table
    without training rows gives counts of 0 and base_score 0; an empty table an empty result; other columns are not
    looked at.  Training cuts texts into segments, scoring does not."""
    require(docs, id, text)
    narrow = docs.select(F.col(id).alias("doc_id"), held_out.alias("held_out"), F.col(text).alias("text"))
    counts = materialize(word_counts(narrow.filter("NOT held_out")))
    lex, inside, n, v = lexicon(counts, symbols, own_count, known)
    spark = docs.sparkSession
    known_words = shared(spark, lex)
    kind = dict(narrow.dtypes)["doc_id"]
    encoded = materialize(narrow.mapInArrow(
        _encode(known_words), f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, logs double, class_logs double, "
        "symbols binary, rare array<string>").withColumn("row", F.monotonically_increasing_id()))
    model = shared(spark, baum_welch(encoded.filter("NOT held_out").select("symbols"), lex.unigram, states, rounds, seed))
    scored = encoded.drop("rare").mapInArrow(
        _score(model, known_words), f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, logs double, class_logs double, row long, hmm double")
    # counts of the words that are not in the table
    rare = encoded.select("row", F.explode("rare").alias("word")).groupBy("row", "word").agg(F.count(F.lit(1)).alias("times"))
    seen = rare.join(counts.filter(~inside), "word").groupBy("row").agg(
        F.sum("times").alias("more"), F.sum(F.col("times") * F.log10(F.col("c") + 1.0)).alias("more_logs"))
    out = scored.join(seen, "row", "left")
    extra, more = F.coalesce("more_logs", F.lit(0.0)), F.coalesce("more", F.lit(0))
    return out.select(F.col("doc_id").alias(id), "held_out", "n_tokens", (F.col("n_known") + more).alias("n_known"),
                      F.lit(n).cast("long").alias("train_tokens"),
                      (F.col("logs") + extra - F.col("n_tokens") * F.lit(math.log10(n + v + 1))).alias("base_score"),
                      (F.col("hmm") + F.col("class_logs") + extra).alias("score"))


def op2_hmm_score(spark, sf_dir):
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 7 == 2
    return hmm_scores(read(spark, sf_dir, "documents"), held_out)
