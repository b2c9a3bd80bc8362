"""Shared plan fragments: guarded broadcast, exact quota split, lineage cuts."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deskspark.functions.text import bind  # noqa: F401
from deskspark.session import ensure_checkpoint_dir


def checked_broadcast(df: DataFrame, max_rows: int, max_bytes: int = 64 << 20) -> DataFrame:
    """Broadcast a derived table only after proving it is small.

    The table is written once (:func:`materialize`), its rows are counted up to
    ``max_rows + 1`` together with their bytes, and it gets a broadcast hint only
    under both bounds; otherwise the join stays a shuffle join that AQE
    may still re-plan at run time.
    """
    df = materialize(df)
    n, size = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.sum(F.octet_length(F.to_json(F.struct(*df.columns))))).first()
    return F.broadcast(df) if n <= max_rows and (size or 0) <= max_bytes else df


def materialize(df: DataFrame, codec: str | None = None) -> DataFrame:
    """Cut lineage by writing the table once as Parquet under the session's
    shared checkpoint folder and reading it back (never a local checkpoint).

    The plan runs once; later jobs scan Parquet with column pruning and
    filter pushdown; a lost executor re-reads files instead of recomputing
    the upstream plan.  ``codec`` replaces the session's compression, for
    tables of whole texts.
    """
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/deskspark-tables/{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path, compression=codec)
    return spark.read.parquet(path)


def release(context) -> None:
    """Shuffle files stay on disk until the driver's JVM happens to collect the plans that wrote them; this lets those of plans that
    nothing refers to any more go now."""
    context._jvm.System.gc()


def order_key(id_col: str, seed: int) -> Column:
    """Deterministic pseudo-random order: md5 of ``"<id>-<seed>"`` (hex).
    The same function exists in DuckDB, so splits can be reproduced."""
    return F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f"-{seed}")))


def quota_split(df: DataFrame, by: list[str], key: str, tie: str, quota: DataFrame,
                flag: str, hex_digits: int = 4, max_broadcast_rows: int = 1_000_000) -> DataFrame:
    """Mark the ``quota`` first rows of every ``by`` group in ``(key, tie)``
    order with ``flag = true``, exactly, without a global or per-group sort.

    Rows are bucketed by the first ``hex_digits`` hex characters of ``key``
    (order-preserving).  A small ``(group, bucket) -> count`` table with
    running offsets tells, per group, which buckets lie wholly inside the
    quota and which single bucket straddles it; only that bucket is ranked
    with a window.  Hot groups are therefore cut into 16**hex_digits pieces
    and nothing is ranked in one task.
    """
    grp = list(by)
    x = df
    if not grp:
        x = x.withColumn("_g", F.lit(0))
        quota = quota.withColumn("_g", F.lit(0))
        grp = ["_g"]
    x = x.withColumn("_b", F.conv(F.substring(F.col(key), 1, hex_digits), 16, 10).cast("int"))
    counts = x.groupBy(*grp, "_b").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*grp).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    counts = counts.join(quota.select(*grp, F.col("quota").alias("_q")), grp)
    inside = (F.col("_off") < F.col("_q")) & (F.col("_off") + F.col("_n") > F.col("_q"))
    bounds = counts.groupBy(*grp).agg(
        F.max(F.when(F.col("_off") + F.col("_n") <= F.col("_q"), F.col("_b"))).alias("_full_to"),
        F.min(F.when(inside, F.col("_b"))).alias("_bnd"),
        F.min(F.when(inside, F.col("_q") - F.col("_off"))).alias("_resid"))
    bounds = checked_broadcast(bounds, max_broadcast_rows)
    y = x.join(bounds, grp, "left")
    decided = (y.filter(F.col("_bnd").isNull() | (F.col("_b") != F.col("_bnd")))
               .withColumn(flag, F.coalesce(F.col("_b") <= F.col("_full_to"), F.lit(False))))
    wr = Window.partitionBy(*grp, "_b").orderBy(F.col(key), F.col(tie))
    boundary = (y.filter(F.col("_b") == F.col("_bnd"))
                .withColumn(flag, F.row_number().over(wr) <= F.col("_resid")))
    out = decided.unionByName(boundary)
    drop = ["_b", "_full_to", "_bnd", "_resid"] + (["_g"] if not by else [])
    return out.drop(*drop)


def exact_row_number(df: DataFrame, by: list[str], order: list[str], bucket: Column,
                     out: str = "rn") -> DataFrame:
    """``row_number() over (partition by by order by order)`` without
    ranking a whole group in one task.

    ``bucket`` must be monotone in ``order`` (e.g. the minute of a
    timestamp).  Rows are numbered inside ``(group, bucket)`` and shifted by
    the running count of the earlier buckets, taken from a small
    ``(group, bucket) -> count`` table.  The join and the window share the
    ``(group, bucket)`` partitioning, so the rows shuffle once.
    """
    x = df.withColumn("_b", bucket)
    cnt = x.groupBy(*by, "_b").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    off = cnt.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0))).drop("_n")
    y = x.join(off, [*by, "_b"])
    w2 = Window.partitionBy(*by, "_b").orderBy(*order)
    return y.withColumn(out, (F.row_number().over(w2) + F.col("_off")).cast("long")).drop("_b", "_off")


#: Parts of a rank's bracket that are ranked apart.
PARTS = 1024


def exact_percentiles(df: DataFrame, by: list[str], value: str, qs: list[float], accuracy: int = 10000) -> DataFrame:
    """Exact linear-interpolated percentiles ``_q0, _q1, ...`` of ``value`` per group, nulls left out, without a buffer
    that grows with the number of distinct values.

    ``percentile_approx`` (a bounded sketch) brackets each rank within ``2 / accuracy``; the rows below a bracket are
    counted, and only the distinct values inside it are ranked, in ``PARTS`` parts of equal width each by itself and shifted by the
    counts of the parts before.  So no task ranks the bracket of a large group.  The next value on either side covers a rank that
    falls just outside, as in small groups."""
    x = df.select(*by, F.col(value).cast("double").alias("_v")).filter("_v IS NOT NULL")
    eps = 2 / accuracy
    ends = [e for q in qs for e in (max(q - eps, 0.0), min(q + eps, 1.0))]
    keys = [f"_k{j}" for j in range(len(by))]

    def joined(left, right, *more):
        right = right.withColumnsRenamed(dict(zip(by, keys)) | {c: f"_r{c}" for c in more})
        same = [F.col(c).eqNullSafe(F.col(k)) for c, k in zip(by, keys)] + [F.col(c) == F.col(f"_r{c}") for c in more]
        return left.join(right, same).drop(*keys, *[f"_r{c}" for c in more])

    y = joined(x, x.groupBy(*by).agg(F.percentile_approx("_v", ends, accuracy).alias("_e")))
    v, each = F.col("_v"), range(len(qs))
    lo, hi = [F.col("_e")[2 * i] for i in each], [F.col("_e")[2 * i + 1] for i in each]
    around = F.array(*[F.struct(F.count_if(v < lo[i]).alias("below"), F.max(F.when(v < lo[i], v)).alias("prev"),
                                F.min(F.when(v > hi[i], v)).alias("next"), F.lit(qs[i]).alias("q")) for i in each])
    totals = y.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"), around.alias("_around"))
    part = [F.when(hi[i] > lo[i], F.floor((v - lo[i]) / (hi[i] - lo[i]) * PARTS)).otherwise(0).cast("int") for i in each]
    within = F.filter(F.array(*[F.when(v.between(lo[i], hi[i]), F.struct(F.lit(i).alias("_i"), part[i].alias("_b"))) for i in each]),
                      lambda x: x.isNotNull())
    inside = y.select(*by, "_v", F.inline(within)).groupBy(*by, "_i", "_b", "_v").agg(F.count(F.lit(1)).alias("_c"))
    parts = inside.groupBy(*by, "_i", "_b").agg(F.sum("_c").alias("_n_part"))
    before = F.sum("_n_part").over(Window.partitionBy(*by, "_i").orderBy("_b")) - F.col("_n_part")
    inside = joined(inside, parts.select(*by, "_i", "_b", before.alias("_before")), "_i", "_b")
    w = Window.partitionBy(*by, "_i", "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    a = F.col("_a")
    z = (joined(inside.withColumn("_upto", F.col("_before") + F.sum("_c").over(w)), totals).withColumn("_a", F.element_at("_around", F.col("_i") + 1))
         .withColumn("_pos", a["q"] * (F.col("_n") - 1)))

    def at(rank):
        found = F.coalesce(F.min(F.when(a["below"] + F.col("_upto") > rank, v)), F.first(a["next"]))
        return F.when(F.first(rank) < F.first(a["below"]), F.first(a["prev"])).otherwise(found)

    z = z.groupBy(*by, "_i").agg(at(F.floor("_pos")).alias("_lo"), at(F.ceil("_pos")).alias("_hi"),
                                 F.first(F.col("_pos") - F.floor("_pos")).alias("_part"))
    val = F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_part")
    return z.groupBy(*by).agg(*[F.max(F.when(F.col("_i") == i, val)).alias(f"_q{i}") for i in each])
