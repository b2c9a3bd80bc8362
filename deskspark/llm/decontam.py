"""Benchmark decontamination with suffix arrays over shards of the training text.

Every Arrow slice of the documents is a shard.  Its words are numbered by the benchmark's vocabulary; a word that the
benchmark never uses cuts the text, because no verbatim match can cross it, and runs shorter than the shortest window
are left out.  The suffix array of what remains is built by prefix doubling; every benchmark suffix is binary-searched in
it, which gives its longest verbatim match, and the interval of each window gives all locations.

A document lies whole in one shard, so nothing is shuffled.  The benchmark is read in blocks of at most ``block_chars``
characters; each block is broadcast and the documents pass through all of them in one narrow chain.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deskspark.llm.common import LOWER, UPPER, fresh, raw_texts, read, require, shared, ship, slices, small_batches

ship(__name__)

WINDOW = 10
BLOCK_CHARS = 8 << 20
_KEEP = bytes(range(0x30, 0x3A)) + LOWER.encode() + bytes(range(0x80, 0x100))
_TABLE = bytes(b if b in _KEEP else (b + 32 if chr(b) in UPPER else 0x20) for b in range(256))

STATE = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
    T.StructField("spans", T.ArrayType(T.IntegerType())), T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField("longest", T.LongType()), T.StructField("longest_item", T.StringType()),
    T.StructField("longest_at", T.LongType())])
_ARROW_STATE = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("spans", pa.list_(pa.int32())),
                          ("items", pa.list_(pa.string())), ("longest", pa.int64()), ("longest_item", pa.string()),
                          ("longest_at", pa.int64())])


def words(text: bytes) -> list[bytes]:
    """Words of digits, letters a-z (A-Z lower-cased) and everything beyond ASCII."""
    return text.translate(_TABLE).split()


class Block:
    """The suffixes and windows of some benchmark items, as numbers."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        self.names: list[str] = []
        self.vocabulary: dict[bytes, int] = {}
        flat, starts, lengths, owner, seen = [], [], [], [], {}
        self.window_start, self.window_len, self.window_items = [], [], []
        for name, text in items:
            own = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words(text)]
            if not own:
                continue
            item, begin, size = len(self.names), len(flat), min(window, len(own))
            self.names.append(name)
            flat += [*own, 0]
            for p in range(len(own) - size + 1):
                starts.append(begin + p)
                lengths.append(len(own) - p)
                owner.append(item)
                at = seen.setdefault(tuple(own[p:p + size]), len(self.window_start))
                if at == len(self.window_start):
                    self.window_start.append(begin + p)
                    self.window_len.append(size)
                    self.window_items.append({item})
                self.window_items[at].add(item)
        self.text = np.array(flat or [0], np.int32)
        self.starts, self.lengths, self.owner = (np.array(x, np.int64) for x in (starts, lengths, owner))
        self.window_start, self.window_len = (np.array(x, np.int64) for x in (self.window_start, self.window_len))
        self.shortest = int(self.window_len.min()) if len(self.window_len) else 0
        self.deepest = int(self.lengths.max()) if len(self.lengths) else 0


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Starts of the suffixes at non-zero words in order, by prefix doubling up to ``depth`` words."""
    rank, step = text.astype(np.int64), 1
    while step < min(depth, len(rank)):
        after = np.zeros_like(rank)
        after[:-step] = rank[step:]
        rank = np.unique(rank * (rank.max() + 1) + after, return_inverse=True)[1].astype(np.int64)
        step *= 2
    order = np.argsort(rank, kind="stable")
    return order[text[order] > 0]


def common_words(query: np.ndarray, starts, lengths, text: np.ndarray, at) -> np.ndarray:
    """Length of the common prefix of query[starts:][:lengths] and text[at:], elementwise."""
    found, active, depth = np.zeros(len(starts), np.int64), np.arange(len(starts)), 0
    while len(active):
        active = active[lengths[active] > depth]
        inside = at[active] + depth < len(text)
        active = active[inside]
        active = active[query[starts[active] + depth] == text[at[active] + depth]]
        depth += 1
        found[active] = depth
    return found


def bound(query, starts, lengths, text, order, upper: bool) -> np.ndarray:
    """Binary search: first place in ``order`` whose suffix is not below (``upper``: is above) the query prefix."""
    low, high = np.zeros(len(starts), np.int64), np.full(len(starts), len(order), np.int64)
    padded = np.append(text, 0)
    while len(active := np.flatnonzero(low < high)):
        middle = (low[active] + high[active]) // 2
        at, s, n = order[middle], starts[active], lengths[active]
        same = common_words(query, s, n, text, at)
        whole = same >= n
        below = padded[np.minimum(at + same, len(text))] < query[np.minimum(s + same, len(query) - 1)]
        right = np.where(whole, upper, below)
        low[active[right]] = middle[right] + 1
        high[active[~right]] = middle[~right]
    return low


def scan_shard(texts: list[bytes], block: Block) -> list[dict]:
    """Hits of one block in a shard: per text n_words, spans (begin, end, ... in words), items, longest match."""
    get, parts, sizes = block.vocabulary.get, [], []
    for text in texts:
        own = words(text)
        parts.append(np.fromiter(map(get, own, repeat(0)), np.int32, len(own)))
        parts.append(np.zeros(1, np.int32))
        sizes.append(len(own))
    out = [{"n_words": n, "spans": [], "items": set(), "longest": 0, "longest_item": None, "longest_at": None} for n in sizes]
    if not block.shortest or not parts:
        return out
    full = np.concatenate(parts)
    begins = np.concatenate([[0], np.cumsum(np.array(sizes) + 1)[:-1]])
    # runs of benchmark words that are long enough, each followed by one cut
    known = np.concatenate([[0], (full > 0).astype(np.int8), [0]])
    edge = np.diff(known)
    run_from, run_to = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    long_enough = run_to - run_from >= block.shortest
    run_from, run_to = run_from[long_enough], run_to[long_enough]
    if not len(run_from):
        return out
    lengths = run_to - run_from + 1
    shift = np.repeat(run_from - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths)
    origin = np.arange(lengths.sum()) + shift
    text = full[origin]
    order = suffix_array(text, block.deepest)
    # longest verbatim match of every benchmark suffix: its neighbours in the suffix array
    place = bound(block.text, block.starts, block.lengths, text, order, False)
    for near in (place - 1, place):
        ok = np.flatnonzero((near >= 0) & (near < len(order)))
        at = order[near[ok]]
        n = common_words(block.text, block.starts[ok], block.lengths[ok], text, at)
        ok, at, n = ok[n >= block.shortest], at[n >= block.shortest], n[n >= block.shortest]
        docs = np.searchsorted(begins, origin[at], "right") - 1
        for q, p, d, size in zip(ok.tolist(), origin[at].tolist(), docs.tolist(), n.tolist(), strict=True):
            if size > out[d]["longest"]:
                out[d].update(longest=size, longest_item=block.names[block.owner[q]], longest_at=p - int(begins[d]))
    # all locations of every window
    low = bound(block.text, block.window_start, block.window_len, text, order, False)
    high = bound(block.text, block.window_start, block.window_len, text, order, True)
    cover = np.zeros(len(full) + 1, np.int32)
    for w in np.flatnonzero(high > low).tolist():
        at = origin[order[low[w]:high[w]]]
        np.add.at(cover, at, 1)
        np.add.at(cover, at + block.window_len[w], -1)
        for d in np.unique(np.searchsorted(begins, at, "right") - 1).tolist():
            out[d]["items"].update(block.window_items[w])
            if not out[d]["longest"]:
                out[d].update(longest=int(block.window_len[w]), longest_item=block.names[min(block.window_items[w])],
                              longest_at=int(at[(at >= begins[d])][0] - begins[d]) if len(at) == 1 else None)
    edge = np.diff(np.concatenate([[0], (np.cumsum(cover) > 0).astype(np.int8)]))
    for b, e in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True):
        d = int(np.searchsorted(begins, b, "right")) - 1
        out[d]["spans"] += [b - int(begins[d]), e - int(begins[d])]
    for x in out:
        x["items"] = {block.names[i] for i in x["items"]}
    return out


def _united(spans: list[int]) -> list[int]:
    out: list[int] = []
    for b, e in sorted(zip(spans[::2], spans[1::2], strict=True)):
        if out and b <= out[-1]:
            out[-1] = max(out[-1], e)
        else:
            out += [b, e]
    return out


def benchmark_blocks(benchmark: DataFrame, window: int, block_chars: int) -> Iterator[Block]:
    """The items in blocks; the driver holds one block at a time."""
    items, size = [], 0
    rows = benchmark.select(F.col("item_id").cast("string").alias("i"), F.col("text").alias("t")).filter("t IS NOT NULL")
    for row in rows.toLocalIterator():
        items.append((row["i"] or "", row["t"].encode()))
        size += len(row["t"])
        if size >= block_chars:
            yield Block(items, window)
            items, size = [], 0
    yield Block(items, window)


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_chars: int = BLOCK_CHARS,
         text: str = "text", out: str | None = None) -> tuple[DataFrame, str]:
    """Add to ``docs`` a struct column (its name is returned): n_words, n_hit, spans, items, longest, longest_item and
    longest_at (in words).  A shard gives each benchmark suffix one place of its longest match; a document that has only
    further places of it gets the length of its window and, if it is the only one, the place.

    A null text has no words; a null item id counts as the empty name; items that share an id are one item; repeated
    rows are scanned alike; an empty benchmark hits nothing; all columns of ``docs`` are kept, whatever their names."""
    require(docs, text)
    require(benchmark, "item_id", "text")
    (state,) = [out] if out else fresh(docs, "_scan")
    schema = T.StructType([*docs.schema.fields, T.StructField(state, STATE)])
    spark = docs.sparkSession
    small_batches(spark)
    width = len(docs.columns)

    def step(block, first):
        def run(batches):
            for batch in slices(batches, text):
                found = scan_shard(raw_texts(batch, text), block.value)
                old = [None] * len(found) if first else batch.column(width).to_pylist()
                for x, before in zip(found, old, strict=True):
                    if before:
                        x["spans"] += before["spans"]
                        x["items"] |= set(before["items"])
                        if before["longest"] > x["longest"]:
                            x.update({k: before[k] for k in ("longest", "longest_item", "longest_at")})
                    x["spans"] = _united(x["spans"])
                    x["n_hit"] = sum(x["spans"][1::2]) - sum(x["spans"][::2])
                    x["items"] = sorted(x["items"])
                yield pa.RecordBatch.from_arrays([*batch.columns[:width], pa.array(found, _ARROW_STATE)],
                                                 names=[*batch.schema.names[:width], state])
        return run

    result = docs
    for k, block in enumerate(benchmark_blocks(benchmark, window, block_chars)):
        result = result.mapInArrow(step(shared(spark, block), k == 0), schema)
    return result, state


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows that hold a benchmark window; same columns.  Nulls and the rest as in :func:`scan`."""
    scanned, state = scan(docs, benchmark, **options)
    return scanned.filter(F.col(state)["n_hit"] == 0).drop(state)


def op1_decontamination(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    scanned, state = scan(docs, read(spark, sf_dir, "benchmark"))
    s = F.col(state)
    return scanned.select("doc_id", s["n_words"].alias("n_words"), s["n_hit"].alias("n_hit"),
                          F.size(s["items"]).cast("long").alias("n_items"),
                          F.sha2(F.array_join(s["items"], ","), 256).alias("items_sha256"),
                          (s["n_hit"] > 0).alias("contaminated"))


SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
             regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item,
             regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
b2 AS (SELECT item, w, least(len(w), {WINDOW}) AS k FROM b WHERE len(w) > 0),
b3 AS (SELECT item, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM b2),
bw AS (SELECT DISTINCT item, k, array_to_string(w[p:p + k - 1], ' ') AS g FROM b3),
d2 AS (SELECT r, k, w, unnest(range(1, len(w) - k + 2)) AS p FROM d, (SELECT DISTINCT k FROM bw)),
hit AS (SELECT r, p, bw.k, item FROM d2 JOIN bw ON d2.k = bw.k AND array_to_string(d2.w[p:p + d2.k - 1], ' ') = g),
pos AS (SELECT DISTINCT r, unnest(range(p, p + k)) AS q FROM hit),
n AS (SELECT r, count(*) AS n_hit FROM pos GROUP BY r),
i AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hit GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN n USING (r) LEFT JOIN i USING (r)
"""
