"""Nearest neighbours by multi-index hashing: learned rotated binary codes, cut into substrings that are each indexed.

1. Equal vectors become one row with their smallest ids, so a vector that a third of the rows share is searched once.
2. Codes.  Vectors are centred and get one more component, sqrt(M^2 - |x|^2) with M the largest norm; a query gets 0 there.
   The angle between query and vector then orders vectors as the inner product does, whatever their norms.  Rotations are
   learned by iterative quantisation on a bounded sample (``sample`` rows) from several random starts; their signs make up
   ``bits`` bits.
3. Radius.  The k-th best inner product among the sampled vectors is a lower bound on a query's k-th best of all.  The Hamming
   distance that pairs of this angle stay under (quantile ``sure``, measured on the sample's own neighbours) is the query's
   radius r; a first round with a radius of less than one bit a substring raises the bound, so r shrinks where neighbours
   are close.
4. Pigeonhole: codes within r differ by at most floor(r / m) in one of their m substrings.  A cell is a substring's number
   and its first few bits; each row is filed under one cell per substring, large cells are cut into pieces of about
   ``cell_rows``.  A query goes to the cells that can hold such a substring.  One shuffle brings rows and queries together,
   sorted so that a task holds the index of one piece and lets the queries stream past: buckets of equal substrings within
   reach are opened, the whole codes in them compared, each pair counted at its first substring within reach alone, and the
   vectors of the rest ranked in double precision.  A task returns at most k + 1 vectors a query and piece.
5. The pieces' lists are merged per query by a ranked window, and equal vectors get their ids back.

Only the sample, the rotations and the row counts of the cells (at most ``2**12`` a substring) come to the driver.
"""

from __future__ import annotations

from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deskspark.llm.common import read, require, shared, ship
from deskspark.operators.common import materialize

ship(__name__)

SUB = 32
#: Cells go by at most so many first bits of a substring.
MOST_TOP = 12
#: Pairs of query and code looked at at once inside a task.
PAIRS = 1 << 19


def usable(vector: Column) -> Column:
    """Whether a vector takes part: not null, not zero, every component a finite number."""
    x = vector.cast("array<double>")
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    return F.coalesce(fine & F.exists(x, lambda v: v != 0), F.lit(False))


def matrix(column: pa.Array, d: int) -> np.ndarray:
    """Rows of a list column; shorter ones end in zeros."""
    out, lengths = np.zeros((len(column), d)), column.value_lengths().to_numpy(zero_copy_only=False)
    out[np.arange(d) < lengths[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def centred(x: np.ndarray, m) -> np.ndarray:
    """Vectors as the index sees them: centred, and the component that makes their norms equal."""
    y = x - m.mean
    return np.concatenate([y, np.sqrt(np.maximum(m.norm ** 2 - (y * y).sum(axis=1), 0))[:, None]], axis=1)


def signs(y: np.ndarray, m) -> np.ndarray:
    """Codes as rows of 32-bit substrings."""
    return words(np.packbits(y @ m.turn > 0, axis=1).tobytes(), len(y))


def words(raw: bytes, rows: int) -> np.ndarray:
    return np.frombuffer(raw, ">u4").astype(np.uint32).reshape(rows, -1)


def packed(codes: np.ndarray) -> pa.Array:
    return pa.array([c.tobytes() for c in codes.astype(">u4")], pa.binary())


def queries_seen(x: np.ndarray) -> np.ndarray:
    return np.pad(x, ((0, 0), (0, 1)))


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def rotations(y: np.ndarray, bits: int, steps: int, seed: int) -> np.ndarray:
    """Directions (one column a bit): principal axes turned by iterative quantisation, from as many random starts as needed."""
    rng, d = np.random.default_rng(seed), y.shape[1]
    axes = np.linalg.eigh(y.T @ y)[1][:, ::-1][:, :min(d, bits)]
    low, parts = y @ axes, []
    while sum(p.shape[1] for p in parts) < bits:
        r = np.linalg.qr(rng.standard_normal((low.shape[1],) * 2))[0]
        for _ in range(steps):
            u, _, v = np.linalg.svd(np.sign(low @ r).T @ low)
            r = (u @ v).T
        parts.append(axes @ r)
    return np.concatenate(parts, axis=1)[:, :bits]


def fit(x: np.ndarray, norm: float, mean: np.ndarray, k: int, bits: int, sure: float, steps: int, seed: int):
    """The model from the sampled vectors: rotations, the sample itself and the calibrated width of the radius."""
    m = SimpleNamespace(mean=mean, norm=norm, k=k, bits=bits)
    y = centred(x, m)
    m.turn = rotations(y, bits, steps, seed)
    m.sample = x
    # distances of the sample's own neighbours, in standard deviations above what the angle alone lets expect
    asks = x[:512]
    score = asks @ x.T
    np.fill_diagonal(score, -np.inf)
    near = np.argsort(-score, axis=1, kind="stable")[:, :k]
    differ = distance(signs(queries_seen(asks), m)[:, None], signs(y, m)[near]).sum(axis=2)
    p = share(np.take_along_axis(score, near, 1), asks, m)
    above = (differ - bits * p) / np.sqrt(bits * p * (1 - p) + 1)
    m.width = float(np.quantile(above, sure)) if above.size else 0.0
    return m


def share(score: np.ndarray, asks: np.ndarray, m) -> np.ndarray:
    """Expected share of differing bits for inner products ``score`` with the rows of ``asks``."""
    lengths = np.maximum(np.sqrt((asks * asks).sum(axis=1)), 1e-300)[:, None]
    cosine = (score - (asks @ m.mean)[:, None]) / lengths / max(m.norm, 1e-300)
    return np.arccos(np.clip(cosine, -1, 1)) / np.pi


def radius(bound: np.ndarray, asks: np.ndarray, m) -> np.ndarray:
    """Hamming radius of each query for a lower bound on its k-th best inner product; all bits where there is none."""
    known = np.isfinite(bound)
    p = share(np.where(known, bound, 0)[:, None], asks, m)[:, 0]
    r = np.floor(m.bits * p + m.width * np.sqrt(m.bits * p * (1 - p) + 1))
    return np.where(known, np.clip(r, 0, m.bits), m.bits).astype(np.int32)


def _encode(model, d):
    def run(batches):
        m = model.value
        for b in batches:
            codes = signs(centred(matrix(b.column(1), d), m), m)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), packed(codes)], names=["rep", "vec", "code"])
    return run


def _ask(model, d):
    """Queries with code, bound and radius from the sample."""
    def run(batches):
        m = model.value
        place = {v.tobytes(): i for i, v in enumerate(m.sample)}
        for whole in batches:
            for begin in range(0, whole.num_rows, 256):
                b = whole.slice(begin, 256)
                x = matrix(b.column(1), d)
                score = x @ m.sample.T
                for i, v in enumerate(x):  # the vector itself is no candidate
                    if (own := place.get(v.tobytes())) is not None:
                        score[i, own] = -np.inf
                bound = -np.partition(-score, m.k - 1, axis=1)[:, m.k - 1] if score.shape[1] >= m.k else np.full(len(x), -np.inf)
                bound -= 1e-12 * np.sqrt((x * x).sum(axis=1)) * (m.norm + np.sqrt((m.mean ** 2).sum()))  # for rounding
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), packed(signs(queries_seen(x), m)), pa.array(bound), pa.array(radius(bound, x, m))],
                                                 names=["rep", "vec", "code", "bound", "r"])
    return run


def _narrow(model, d):
    """Queries with the radius for a raised bound."""
    def run(batches):
        m = model.value
        for b in batches:
            bound = b.column(3).to_numpy(zero_copy_only=False)
            r = np.minimum(radius(bound, matrix(b.column(1), d), m), b.column(4).to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(r)], names=b.schema.names)
    return run


def _route(pieces, top):
    """(cell piece, query) for the cells that can hold a substring within reach of the query's."""
    def run(batches):
        n = pieces.value.n  # substring x first bits -> pieces
        for b in batches:
            codes = words(b"".join(b.column(2).to_pylist()), b.num_rows)
            reach = b.column(4).to_numpy(zero_copy_only=False) // n.shape[0]
            heads = np.arange(n.shape[1], dtype=np.uint32)
            for begin in range(0, b.num_rows, max(1, PAIRS // n.size)):
                own = slice(begin, begin + max(1, PAIRS // n.size))
                close = distance((codes[own] >> np.uint32(SUB - top) if top else np.zeros_like(codes[own]))[:, :, None], heads) <= reach[own, None, None]
                q, j, head = np.nonzero(close & (n > 0))
                often = n[j, head]
                q, j, head = (np.repeat(a, often) for a in (q, j, head))
                piece = np.arange(len(q)) - np.repeat(np.cumsum(often) - often, often)
                rows = pa.array(q + begin)
                yield pa.RecordBatch.from_arrays([pa.array(((j.astype(np.int64) << MOST_TOP | head) << 32) | piece), pa.array(np.ones(len(q), np.int32)),
                                                  *(b.column(i).take(rows) for i in (0, 1, 2, 3, 4))], names=["unit", "kind", "rep", "vec", "code", "bound", "r"])
    return run


class Piece:
    """The index of one piece of a cell: rows sorted by their substring ``j``, the distinct substrings and where they begin."""

    def __init__(self, j: int, reps: np.ndarray, vectors: np.ndarray, codes: np.ndarray):
        order = np.argsort(codes[:, j], kind="stable")
        self.j, self.reps, self.vectors, self.codes = j, reps[order], vectors[order], codes[order]
        self.bucket, self.begin = np.unique(self.codes[:, j], return_index=True)
        self.size = np.diff(np.append(self.begin, len(order)))

    def probe(self, asks: np.ndarray, codes: np.ndarray, bound: np.ndarray, r: np.ndarray, k: int):
        """(query, rows, scores) of the best k rows within the radius of each query and not under its bound."""
        reach = r // codes.shape[1]
        for first in range(0, len(asks), max(1, PAIRS // len(self.reps))):
            at = slice(first, first + max(1, PAIRS // len(self.reps)))
            q, bucket = np.nonzero(distance(codes[at, self.j, None], self.bucket) <= reach[at, None])
            often = self.size[bucket]
            q, row = np.repeat(q, often) + first, np.arange(often.sum()) - np.repeat(np.cumsum(often) - often - self.begin[bucket], often)
            apart = distance(codes[q], self.codes[row])
            within = (apart.sum(axis=1) <= r[q]) & ~(apart[:, :self.j] <= reach[q, None]).any(axis=1)
            q, row = q[within], row[within]
            score = np.concatenate([(asks[q[i:i + 4096]] * self.vectors[row[i:i + 4096]]).sum(axis=1) for i in range(0, len(q), 4096)] or [np.zeros(0)])
            good = score >= bound[q]
            q, row, score = q[good], row[good], score[good]
            order = np.lexsort((self.reps[row], -score, q))
            q, row, score = q[order], row[order], score[order]
            ends = np.flatnonzero(np.diff(q, append=-1)) + 1
            for begin, end in zip(np.append(0, ends)[:-1], ends, strict=True):
                end = min(end, begin + k)
                yield q[begin], row[begin:end], score[begin:end]


def _search(d, k):
    """Rows of a partition come sorted by unit, index rows before queries."""
    def run(batches):
        unit, held, piece = None, [], None

        for b in batches:
            units, kinds = b.column(0).to_numpy(), b.column(1).to_numpy()
            cuts = np.flatnonzero((np.diff(units) != 0) | (np.diff(kinds) != 0)) + 1
            for begin, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(units)], strict=True):
                part = b.slice(begin, end - begin)
                if not part.num_rows:
                    continue
                if units[begin] != unit:
                    unit, held, piece = units[begin], [], None
                reps, x = part.column(2).to_numpy(), matrix(part.column(3), d)
                codes = words(b"".join(part.column(4).to_pylist()), len(reps))
                if kinds[begin] == 0:
                    held.append((reps, x, codes))
                    continue
                if not held:
                    continue
                piece = piece or Piece(int(unit) >> 32 + MOST_TOP, *map(np.concatenate, zip(*held, strict=True)))
                found = list(piece.probe(x, codes, part.column(5).to_numpy(), part.column(6).to_numpy(), k))
                if found:
                    ends = np.cumsum([0, *[len(rows) for _, rows, _ in found]]).astype(np.int32)
                    near = [pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([f[i] for f in found]))) for i in (1, 2)]
                    rows = pa.ListArray.from_arrays(near[0].offsets, pa.array(piece.reps[near[0].values.to_numpy()]))
                    yield pa.RecordBatch.from_arrays([pa.array(reps[[f[0] for f in found]]), rows, near[1]], names=["ask", "reps", "scores"])
    return run


def best(found: DataFrame, by: str, id: str, k: int) -> DataFrame:
    """The k highest scores of each group, smaller ids first among equals, ranked from 1."""
    order = Window.partitionBy(by).orderBy(F.desc("score"), F.col(id))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(rows: DataFrame, queries: Column, id: str = "vec_id", vector: str = "embedding", k: int = 20, bits: int = 256, sample: int = 4096,
           sure: float = 0.98, cell_rows: int = 16_384, steps: int = 8, seed: int = 12) -> DataFrame:
    """For each row for which ``queries`` holds its ``k`` nearest other rows by inner product: query_id, rank, vec_id and score.

    The codes are fitted on at most ``sample`` distinct vectors (fewer where these would pass 32 MB); every row is indexed.
    Vectors that are null, zero or hold null or non-finite components take no part, nor do rows without an id.  Shorter vectors
    count as ending in zeros.  Ties go to the smaller id.  Rows equal in id and vector are one row; an id with several vectors
    is searched and found with each.  A query with fewer than ``k`` others gets all of them; an empty table gives an empty
    result; other columns are not looked at."""
    require(rows, id, vector)
    spark = rows.sparkSession
    # 0.0 and -0.0 are one number
    valid = materialize(rows.filter(usable(F.col(vector)) & F.col(id).isNotNull()).select(
        F.col(id).cast("long").alias("id"), F.transform(F.col(vector).cast("array<double>"), lambda v: v + F.lit(0.0)).alias("vec"),
        F.coalesce(queries, F.lit(False)).alias("asks")))
    d = valid.agg(F.max(F.size("vec"))).first()[0]
    if d is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    width = F.size("vec")
    valid = valid.withColumn("vec", F.when(width < d, F.concat("vec", F.array_repeat(F.lit(0.0), d - width))).otherwise(F.col("vec")))
    # a vector's k + 1 smallest ids: one may be the query's own; numbered by the smallest, so that ties go by it
    valid = materialize(valid.groupBy("id", "vec").agg(F.max("asks").alias("asks")))
    few = valid.withColumn("n", F.row_number().over(Window.partitionBy("vec").orderBy("id"))).filter(F.col("n") <= k + 1)
    reps = materialize(few.groupBy("vec").agg(F.array_sort(F.collect_list("id")).alias("ids")).sort(F.col("ids")[0], "vec")
                       .withColumn("rep", F.monotonically_increasing_id()))
    asked = materialize(valid.filter("asks").join(reps.select("vec", "rep"), "vec").select("id", "rep"))
    asks = reps.join(asked.select("rep").distinct(), "rep", "left_semi").select("rep", "vec")

    n = min(sample, max(k + 1, (32 << 20) // (8 * d)))
    some = np.array([r.vec for r in reps.orderBy(F.xxhash64("vec"), "rep").limit(n).select("vec").collect()], float).reshape(-1, d)
    mean = some.mean(axis=0)
    away = F.aggregate(F.zip_with("vec", F.array(*map(F.lit, mean.tolist())), lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v)
    norm = float(np.sqrt(reps.agg(F.max(away)).first()[0]))
    model = shared(spark, fit(some, norm, mean, k, bits, sure, steps, seed))

    codes = materialize(reps.select("rep", "vec").mapInArrow(_encode(model, d), "rep long, vec array<double>, code binary"))
    asked_codes = "rep long, vec array<double>, code binary, bound double, r int"
    asks = materialize(asks.mapInArrow(_ask(model, d), asked_codes))
    m, total = bits // SUB, codes.count()
    top = min(MOST_TOP, int(np.ceil(np.log2(max(total / cell_rows, 1)))))
    heads = F.array(*[F.shiftright(F.conv(F.hex(F.substring("code", 4 * j + 1, 4)), 16, 10).cast("long"), SUB - top) for j in range(m)])
    filed = codes.select("rep", "vec", "code", F.posexplode(heads).alias("j", "head"))
    sizes = np.zeros((m, 1 << top), np.int64)
    for r in filed.groupBy("j", "head").count().collect():
        sizes[r["j"], r["head"]] = r["count"]
    number = -(-sizes // cell_rows)
    pieces = shared(spark, SimpleNamespace(n=number))
    cells = spark.createDataFrame([(int(j), int(h), int(number[j, h])) for j, h in zip(*np.nonzero(number), strict=True)], "j int, head long, pieces long")
    cell = F.shiftleft(F.col("j").cast("long"), MOST_TOP).bitwiseOR(F.col("head"))
    unit = F.shiftleft(cell, 32).bitwiseOR(F.pmod(F.xxhash64("rep"), F.col("pieces")))
    filed = filed.join(F.broadcast(cells), ["j", "head"]).select(  # at most m * 2**MOST_TOP cells
        unit.alias("unit"), F.lit(0).alias("kind"), "rep", "vec", "code", F.lit(0.0).alias("bound"), F.lit(0).alias("r"))

    def probe(wanted: DataFrame) -> DataFrame:
        both = filed.unionByName(wanted.mapInArrow(_route(pieces, top), f"unit long, kind int, {asked_codes}"))
        met = both.repartition("unit").sortWithinPartitions("unit", "kind").mapInArrow(_search(d, k + 1), "ask long, reps array<long>, scores array<double>")
        each = met.select("ask", F.inline(F.arrays_zip("reps", "scores"))).withColumnsRenamed({"reps": "rep", "scores": "score"})
        return best(each, "ask", "rep", k + 1)

    # first round: exact substrings only
    quick = probe(asks.withColumn("r", F.least("r", F.lit(m - 1)))).filter(F.col("rank") == k + 1)
    raised = materialize(quick.select(F.col("ask").alias("rep"), F.col("score").alias("more")))
    asks = asks.join(raised, "rep", "left").select("rep", "vec", "code", F.greatest("bound", F.coalesce("more", "bound")).alias("bound"), "r")
    asks = materialize(asks.mapInArrow(_narrow(model, d), asked_codes))
    found = materialize(probe(asks).select("ask", "rep", "score"))
    # queries whose radius held too few are asked again with all bits as radius
    enough = found.filter("ask <> rep").groupBy("ask").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= k).select(F.col("ask").alias("rep"))
    rest = materialize(asks.filter(F.col("r") < bits).join(enough, "rep", "left_anti").withColumn("r", F.lit(bits)))
    if not rest.isEmpty():
        more = materialize(probe(rest).select("ask", "rep", "score"))
        found = found.join(more.select("ask").distinct(), "ask", "left_anti").unionByName(more)

    named = found.join(reps.select("rep", "ids"), "rep").select("ask", F.explode("ids").alias("near"), "score")
    named = best(named, "ask", "near", k + 1).drop("rank")
    pairs = asked.join(named.withColumnRenamed("ask", "rep"), "rep").filter("near <> id").select("id", "near", "score")
    return best(pairs, "id", "near", k).select(F.col("id").alias("query_id"), F.col("rank").cast("int").alias("rank"),
                                               F.col("near").alias("vec_id"), "score")


def op12_hamming_index(spark, sf_dir):
    return search(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
