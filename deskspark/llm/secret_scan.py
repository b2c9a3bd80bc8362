"""Secret scans: credential parts found by patterns and linked by an interval join, DataFrame functions only.

1. One pass over the texts keeps, per kind, the lengths of the matches and of the gaps between them; positions are their
   running sums.  Strong kinds (assign, access, hex) stand alone.  Weak kinds (identifier, opaque, endpoint) are reported
   only when complementary parts occur within ``scope`` code points.
2. The interval join: parts are put in every bin, as wide as the scope, that they cover.  A part has its partners in the
   bins that it covers widened by the scope on both sides; the least begin and the greatest end of each class per bin
   decide whether the gap to one is within the scope.  So a bin gives one row, whatever the number of parts in it: no
   pairs are made, no key grows with the corpus, and a part gives rows in proportion to its length.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from deskspark.llm.common import fresh, read, require
from deskspark.operators.common import materialize

#: Fixed values of the base kinds, in report order: pattern, group whose length counts, least length.
BASE = {
    "assign": (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]{24,}", 0, 24),
}
#: Weak kinds: names and patterns.
WEAK = {
    "identifier": (r"""(?i:access_?key(?:_?id)?|client_?id|account|user(?:_?name)?|login)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.@=-]+""", 0, 1),
    "opaque": (r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])(?=[0-9+/_-]*[A-Za-z])[A-Za-z0-9+/_-]{16,}", 0, 16),
    "endpoint": (r"""(?i:https?|ftp|ssh|jdbc:[a-z]+|mongodb|redis|amqp)://[^\x00-\x20"'<>]+""", 0, 8),
}
KINDS = BASE | WEAK
ORDER = {k: i for i, k in enumerate(KINDS)}
#: What a part is to others: what it stands for in a credential.
CLASS = {"assign": "secret", "hex": "secret", "opaque": "secret", "access": "id", "identifier": "id", "endpoint": "place"}
SCOPE = 200


def with_parts(docs: DataFrame, text: str, out: str) -> DataFrame:
    """Add the column ``out``: per kind an array of (gap before, length, counted length) of its matches."""
    t = F.col(text)

    def measured(pattern, group):
        sized = [F.transform(F.split(t, pattern, -1), F.length), F.transform(F.regexp_extract_all(t, F.lit(pattern), F.lit(0)), F.length),
                 F.transform(F.regexp_extract_all(t, F.lit(pattern), F.lit(group)), F.length)]
        # zip pads: the last gap has no match behind it
        return F.when(t.rlike(pattern), F.arrays_zip(*[c.alias(n) for c, n in zip(sized, ("gap", "size", "counted"), strict=True)]))

    parts = F.struct(*[measured(p, g).alias(k) for k, (p, g, _) in KINDS.items()])
    return docs.withColumn(out, parts)


def any_part(parts: str):
    cond = F.lit(False)
    for k in KINDS:
        cond = cond | F.col(parts)[k].isNotNull()
    return cond


def part_rows(rows: DataFrame, row: str, parts: str) -> DataFrame:
    """(row, kind, begin, end) of the matches that are long enough; positions in code points."""
    each = None
    for kind, (_, _, least) in KINDS.items():
        one = rows.select(F.col(row).alias("row"), F.lit(kind).alias("kind"), F.lit(least).alias("least"),
                          F.posexplode(F.col(parts)[kind]).alias("i", "m"))
        each = one if each is None else each.union(one)
    each = each.filter("m.size IS NOT NULL").select("row", "kind", "least", "i", "m.*")
    upto = F.sum(F.col("gap") + F.col("size")).over(Window.partitionBy("row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0))
    return (each.withColumn("end", upto).filter("counted >= least")
            .select("row", "kind", (F.col("end") - F.col("size")).cast("long").alias("begin"), F.col("end").cast("long").alias("end")))


def linked(parts: DataFrame, scope: int) -> DataFrame:
    """The weak parts (row, kind, begin, end) that have complementary parts at a gap of at most ``scope``.

    opaque: needs an id and does not lie in a base span's place; identifier: needs a secret (base or opaque); endpoint:
    needs both."""
    what = F.coalesce(*[F.when(F.col("kind") == k, F.lit(c)) for k, c in CLASS.items()])
    placed = parts.withColumn("class", what)
    bins = (placed.filter("class <> 'place'").withColumn("bin", F.explode(F.expr(f"sequence(begin div {scope}, end div {scope})")))
            .groupBy("row", "bin", F.col("class").alias("partner")).agg(F.min("begin").alias("least"), F.max("end").alias("most")))
    reach = F.expr(f"sequence(greatest(begin - {scope}, 0) div {scope}, (end + {scope}) div {scope})")
    weak = placed.filter(F.col("kind").isin(*WEAK)).withColumn("bin", F.explode(reach))
    # a part of a shared bin can miss one bound only in the first bin and the other only in the last: both hold for one part
    near = (F.col("most") >= F.col("begin") - scope) & (F.col("least") <= F.col("end") + scope)
    hits = (weak.join(bins, ["row", "bin"]).filter(near & (F.col("partner") != F.col("class")))
            .groupBy("row", "kind", "begin", "end").agg(F.count_distinct("partner").alias("kinds")))
    return hits.filter((F.col("kind") != "endpoint") | (F.col("kinds") == 2)).drop("kinds")


def found_spans(parts: DataFrame, scope: int) -> DataFrame:
    """Base spans and linked weak spans; an opaque string inside or across a base span is that span."""
    parts = materialize(parts)
    base = parts.filter(F.col("kind").isin(*BASE))
    # of overlapping parts only the first kind in report order stays: intervals of one row, in order of their begin
    w = Window.partitionBy("row").orderBy("begin", F.col("rank")).rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy("row").orderBy("begin", F.col("rank")).rowsBetween(1, Window.unboundedFollowing)
    rank = F.coalesce(*[F.when(F.col("kind") == k, F.lit(i)) for k, i in ORDER.items()])
    strong = F.col("kind").isin(*BASE)
    lone = (parts.withColumn("rank", rank)
            .withColumn("taken", F.max(F.when(strong, F.col("end"))).over(w)).withColumn("next", F.min(F.when(strong, F.col("begin"))).over(after))
            .filter(strong | ((F.coalesce("taken", F.lit(-1)) <= F.col("begin")) & (F.coalesce("next", F.col("end")) >= F.col("end"))))
            .select("row", "kind", "begin", "end"))
    return base.union(linked(lone, scope))


def joined(kinds: list[str] | None = None):
    """Aggregate: kind:begin:end by begin, then kind as listed, comma-joined."""
    rank = F.coalesce(*[F.when(F.col("kind") == k, F.lit(i)) for k, i in ORDER.items()])
    entry = F.struct("begin", rank.alias("rank"), "end", "kind")
    if kinds:
        entry = F.when(F.col("kind").isin(*kinds), entry)
    return F.array_join(F.transform(F.array_sort(F.collect_list(entry)), lambda x: F.concat_ws(
        ":", x["kind"], x["begin"].cast("string"), x["end"].cast("string"))), ",")


def secret_scan(docs: DataFrame, id: str = "doc_id", text: str = "text", scope: int = SCOPE) -> DataFrame:
    """One row per row of ``docs``: id, n_assign, n_access, n_hex, base_sha256, spans (all spans, linked ones included) and
    n_linked.

    A null text is empty; an empty table gives an empty result; repeated rows are scanned each for itself; equal begins
    are ordered by kind as listed; other columns are not looked at; whole texts of any length are read."""
    require(docs, id, text)
    rows = materialize(with_parts(docs.select(F.col(id).alias("id"), F.col(text).alias("text")), "text", "parts")
                       .select("id", "parts", F.monotonically_increasing_id().alias("row")))
    spans = found_spans(part_rows(rows.filter(any_part("parts")), "row", "parts"), scope)
    sums = spans.groupBy("row").agg(
        *[F.count(F.when(F.col("kind") == k, 1)).alias(f"n_{k}") for k in BASE], joined(list(BASE)).alias("base"), joined().alias("spans"),
        F.count(F.when(F.col("kind").isin(*WEAK), 1)).alias("n_linked"))
    out = rows.select("id", "row").join(sums, "row", "left")
    zero, none = F.lit(0), F.lit("")
    return out.select(F.col("id").alias(id), *[F.coalesce(f"n_{k}", zero).cast("long").alias(f"n_{k}") for k in BASE],
                      F.sha2(F.coalesce("base", none), 256).alias("base_sha256"), F.coalesce("spans", none).alias("spans"),
                      F.coalesce("n_linked", zero).cast("long").alias("n_linked"))


def redact_secrets(docs: DataFrame, text: str = "text", scope: int = SCOPE, mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span found (base and linked, overlapping ones as one) replaced by ``mask``; same rows and columns.

    Texts without any part pass unjoined; null texts stay null; the rest as in :func:`secret_scan`."""
    require(docs, text)
    parts, row, pieces = fresh(docs, "_parts", "_row", "_pieces")
    marked = materialize(with_parts(docs, text, parts).withColumn(row, F.monotonically_increasing_id()))
    has = any_part(parts)
    spans = found_spans(part_rows(marked.filter(has), row, parts), scope)
    before = F.max("end").over(Window.partitionBy("row").orderBy("begin", "end").rowsBetween(Window.unboundedPreceding, -1))
    cuts = (spans.withColumn("before", F.coalesce(before, F.lit(0))).filter("end > before")
            .groupBy("row").agg(F.array_sort(F.collect_list(F.struct("begin", "before", "end"))).alias(pieces)).withColumnRenamed("row", row))
    t, cut = F.col(text), F.col(pieces)

    def piece(x):
        fresh_start = x["begin"] >= x["before"]
        kept = F.substring(t, (x["before"] + 1).cast("int"), F.greatest(x["begin"] - x["before"], F.lit(0)).cast("int"))
        return F.when(fresh_start, F.concat(kept, F.lit(mask))).otherwise(F.lit(""))

    tail = F.substring(t, (F.array_max(F.transform(cut, lambda x: x["end"])) + 1).cast("int"), F.length(t))
    masked = marked.filter(has).join(cuts, row, "left").withColumn(
        text, F.when(cut.isNull(), t).otherwise(F.concat(F.array_join(F.transform(cut, piece), ""), tail)))
    return masked.select(*docs.columns).union(marked.filter(~has).select(*docs.columns))


def op3_secret_scan(spark, sf_dir):
    return secret_scan(read(spark, sf_dir, "documents"))
