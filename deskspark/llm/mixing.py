"""Mixing sources to target weights: capped water-filling over the sources, then seeded whole and fractional repetitions.

1. One pass over the documents gives (size, source, hash); sizes are summed by source with map-side combine, so a hot
   source is no problem.
2. The water level is found on the one-row-per-source table: every source above its cap (``max_epochs`` times its size)
   is clamped and the rest is shared again by weight until none is above.  This is a Newton iteration on a concave
   piecewise-linear function: it rises monotonically and ends after finitely many rounds, each one small aggregate.
3. A source with target e x its size takes every document floor(e) times and the fractional rest once more for the
   documents with the smallest seeded hash of id and text, cut where their running size meets the rest.  The running size comes
   from two levels of 4,096 hash buckets per source, and inside the bucket of the cut from one row per distinct hash; of the equal rows
   on which the cut falls, as many are taken as come nearest.  No source is ever sorted or ranked in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deskspark.llm.common import fresh, read, require, word_count
from deskspark.operators.common import materialize

FAN = 4096


def ranked_sources(sizes: DataFrame, source: str) -> DataFrame:
    """Add the 0-based rank ``rank`` of each source by code point, null last, without a one-task sort: rows are
    range-partitioned and numbered within their partition, then shifted by the partition's offset."""
    ordered = materialize(sizes.sort(F.col(source).asc_nulls_last()).withColumn("_at", F.monotonically_increasing_id()))
    part, within = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    counts = ordered.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.withColumn("_off", F.coalesce(F.sum("_n").over(
        Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return (ordered.withColumn("_part", part).withColumn("_within", within)
            .join(offsets, "_part").withColumn("rank", F.col("_off") + F.col("_within"))
            .drop("_part", "_within", "_off", "_n", "_at"))


def water_fill(sources: DataFrame, share: float, max_epochs: float) -> DataFrame:
    """``sources`` has (size, weight); adds ``target``: min(max_epochs * size, level * weight), the targets adding up to
    ``share`` of all sizes (or to all caps if these are less)."""
    cap = F.col("size") * F.lit(float(max_epochs))
    first = sources.agg(F.sum("size").alias("s"), F.sum("weight").alias("w")).first()
    if not first["w"] or not first["s"]:
        return sources.withColumn("target", F.lit(0.0))
    budget, level, clamped = share * first["s"], share * first["s"] / first["w"], -1
    while True:
        above = cap <= F.col("weight") * F.lit(level)
        now = sources.agg(F.sum(above.cast("long")).alias("n"), F.sum(F.when(above, cap)).alias("cap"),
                          F.sum(F.when(~above, F.col("weight"))).alias("w")).first()
        if now["n"] == clamped or not now["w"]:
            return sources.withColumn("target", F.when(above, cap).otherwise(F.col("weight") * F.lit(level)))
        clamped, level = now["n"], (budget - (now["cap"] or 0.0)) / now["w"]


def numbered(rows: DataFrame, by: str, at: str, out: str) -> DataFrame:
    """``rows`` with their number from 1 within ``by`` in the order of ``at`` (a monotonically increasing id): numbered per partition
    of the id and shifted by the counts of the partitions before."""
    part = F.shiftright(at, 33)
    rows = rows.withColumn("part", part)
    counts = rows.groupBy(by, "part").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.select(F.col(by).alias("of3"), F.col("part").alias("p3"),
                           (F.sum("n").over(Window.partitionBy(by).orderBy("part")) - F.col("n")).alias("off"))
    local = F.row_number().over(Window.partitionBy(by, "part").orderBy(at))
    return (rows.withColumn(out, local).join(counts, rows[by].eqNullSafe(counts["of3"]) & (F.col("part") == F.col("p3")))
            .withColumn(out, F.col(out) + F.col("off")).drop("part", "of3", "p3", "off"))


def mix(df: DataFrame, size: Column, source: str = "source", key: str = "doc_id", text: str = "text", weights: tuple[int, ...] = (3, 1, 2),
        share: float = 1.5, max_epochs: float = 2.0, seed: int = 17, carry: list[str] | None = None) -> DataFrame:
    """Mix the rows of ``df``.

    Returns the columns ``carry`` (default: ``key``) with size, source_size, target, copies and taken (= size * copies); these
    get other names where ``carry`` has them.  Rows equal in ``key`` and ``text`` take the same place in the order; where the cut falls among
    them, as many are taken as come nearest to the target.  A null size counts as 0; a null source is a source of its own, ranked
    last; a null key or text is hashed as the empty text; an empty table gives an empty result; sources of size 0 get target 0; columns
    outside ``carry`` are not looked at.  The result depends on the rows and the seed alone, but for which of equal rows is taken."""
    require(df, source, key, text)
    carry = [key] if carry is None else carry
    names = {c: f"c{i}" for i, c in enumerate(carry)}
    filled = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = materialize(df.select(
        *[F.col(c).alias(n) for c, n in names.items()], F.col(source).alias("src"),
        F.coalesce(size, F.lit(0)).cast("long").alias("size"), F.md5(F.concat(filled(key), F.lit(f"-{seed}-"), filled(text))).alias("d"))
        .withColumn("h", F.conv(F.substring("d", 1, 6), 16, 10).cast("int")).withColumn("at", F.monotonically_increasing_id()))
    sources = ranked_sources(rows.groupBy("src").agg(F.sum("size").alias("size")), "src")
    kinds = F.array(*[F.lit(float(w)) for w in weights])
    sources = sources.withColumn("weight", F.element_at(kinds, (F.col("rank") % len(weights) + 1).cast("int"))).drop("rank")
    sources = materialize(sources)
    filled_up = materialize(water_fill(sources, share, max_epochs).withColumn(
        "whole", F.when(F.col("size") > 0, F.floor(F.col("target") / F.col("size"))).otherwise(F.lit(0)).cast("long"))
        .withColumn("rest", F.col("target") - F.col("whole") * F.col("size")).withColumnRenamed("size", "source_size"))

    def cut(parts: DataFrame, need: DataFrame) -> DataFrame:
        """(src, b, left): the part ``b`` of ``parts`` (src, b, n) in which the running size passes ``left`` of ``need`` (src, left),
        and what is left when it begins."""
        need = need.select(F.col("src").alias("of"), "left")
        upto = F.sum("n").over(Window.partitionBy("src").orderBy("b").rowsBetween(Window.unboundedPreceding, 0))
        parts = parts.withColumn("upto", upto)
        passed = parts.join(need, parts["src"].eqNullSafe(need["of"])).filter(F.col("upto") > F.col("left"))
        return passed.groupBy("src").agg(F.min(F.struct("b", (F.col("left") - F.col("upto") + F.col("n")).alias("left"))).alias("m")).select("src", "m.b", "m.left")

    def inside(place: DataFrame, where) -> DataFrame:
        place = place.select(F.col("src").alias("of"), F.col("b").alias("of_b"))
        return rows.join(place, rows["src"].eqNullSafe(place["of"]) & (where == place["of_b"]))

    coarse = materialize(cut(rows.groupBy("src", F.expr(f"h div {FAN}").alias("b")).agg(F.sum("size").alias("n")),
                             filled_up.filter("rest > 0").select("src", F.col("rest").alias("left"))))
    fine = materialize(cut(inside(coarse, F.expr(f"h div {FAN}")).groupBy("src", F.col("h").alias("b")).agg(F.sum("size").alias("n")), coarse))
    last = materialize(cut(inside(fine, F.col("h")).groupBy("src", F.col("d").alias("b")).agg(F.sum("size").alias("n")), fine))

    def named(place: DataFrame, of: str, **columns) -> DataFrame:
        return place.select(F.col("src").alias(of), *[F.col(c).alias(n) for n, c in columns.items()])

    def matched(left: DataFrame, right: DataFrame, of: str) -> DataFrame:
        return left.join(right, left["src"].eqNullSafe(right[of]), "left").drop(of)

    plan = matched(matched(filled_up, named(fine, "of1", limit="b"), "of1"), named(last, "of2", tie="b", left="left"), "of2")
    plan = materialize(plan.select(F.col("src").alias("of"), "source_size", "target", "whole", "tie", "left",
                                   F.when(F.col("rest") <= 0, F.lit(0)).otherwise(F.coalesce("limit", F.lit(FAN * FAN))).alias("limit")))
    out = rows.join(plan, rows["src"].eqNullSafe(plan["of"]))
    tied = (F.col("h") == F.col("limit")) & F.coalesce(F.col("d") == F.col("tie"), F.lit(False))
    before = (F.col("h") < F.col("limit")) | ((F.col("h") == F.col("limit")) & F.coalesce(F.col("d") < F.col("tie"), F.lit(False)))
    equal = numbered(out.filter(tied), "src", "at", "number")
    once = F.coalesce(F.col("number") <= F.floor(F.col("left") / F.col("size") + 0.5), F.lit(False))
    both = out.filter(~tied).withColumn("more", before).unionByName(equal.withColumn("more", once).drop("number"))
    copies = F.col("whole") + F.col("more").cast("long")
    return both.select(*[F.col(n).alias(c) for c, n in names.items()], *[c.alias(n) for c, n in zip(
        (F.col("size"), F.col("source_size"), F.col("target"), copies, F.col("size") * copies),
        fresh(df.select(*carry), "size", "source_size", "target", "copies", "taken"), strict=True)])


def mix_documents(docs: DataFrame) -> DataFrame:
    """The mix of a documents table by its words, see :func:`mix`."""
    return mix(docs, word_count(F.col("text")))


def op5_source_mix(spark, sf_dir):
    return mix_documents(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


SQL = r"""
WITH RECURSIVE d0 AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '') || '-17-' || coalesce(text, '')) AS dg FROM documents),
d AS (SELECT *, CAST('0x' || substr(dg, 1, 6) AS INT) AS h, row_number() OVER (PARTITION BY source, dg) AS k FROM d0),
s0 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
s AS (SELECT *, CASE (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3
                  WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS w,
             source_size * 2.0::DOUBLE AS cap FROM s0),
lv AS (
  SELECT 0 AS it, (SELECT 1.5::DOUBLE * sum(source_size) / sum(w) FROM s) AS level
  UNION ALL
  SELECT it + 1, (SELECT CASE WHEN sum(CASE WHEN cap > w * level THEN w END) IS NULL THEN level
                         ELSE (1.5::DOUBLE * sum(source_size) - sum(CASE WHEN cap <= w * level THEN cap ELSE 0 END))
                              / sum(CASE WHEN cap > w * level THEN w END) END FROM s)
  FROM lv WHERE it < 40),
f AS (SELECT source, source_size, least(cap, w * (SELECT max(level) FROM lv)) AS target FROM s),
g AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM f),
r AS (SELECT *, target - whole * source_size AS rest FROM g),
u AS (SELECT d.*, coalesce(sum(size) OVER (PARTITION BY source ORDER BY dg RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW EXCLUDE GROUP), 0) AS before FROM d)
SELECT doc_id, size, source_size, target,
       CAST(size * (whole + CASE WHEN rest > 0 AND size > 0 AND k <= floor((rest - before) / size + 0.5) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM u JOIN r ON u.source IS NOT DISTINCT FROM r.source
"""
