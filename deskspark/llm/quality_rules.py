"""Quality rules: text statistics and learned decision lists, DataFrame functions only.

Statistics come from one pass over the whole texts (kept as a narrow table).  A decision list is learned by sequential
covering on a bounded sample of labelled rows: grow a conjunction of thresholds by information gain on two thirds of
the sample, prune it on the other third, drop what it covers, repeat.  The list is emitted as one ordered CASE
expression, so scoring is a projection.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskspark.llm.common import WORD, let, read, require
from deskspark.operators.common import materialize

WINDOW = 8
SYMBOLS = "[#*$%&|<>]"


def repeated_words(words: Column, k: int = WINDOW) -> Column:
    """Number of words inside windows of ``k`` words that occur at least twice.

    Windows are hashed, sorted as (hash, position) and compared with their neighbours; the covered words are the sum of
    the gaps, each at most ``k``: n log n for any text."""
    def covered(positions):
        gaps = F.transform(positions, lambda p, i: F.least(F.lit(k), F.coalesce(F.get(positions, i + 1) - p, F.lit(k))))
        return F.aggregate(gaps, F.lit(0), lambda a, x: a + x)

    def twice(s):
        def known(x, i):
            return F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(
                F.get(s, i + 1)["h"] == x["h"], F.lit(False))
        return let(F.array_sort(F.transform(F.filter(s, known), lambda x: x["p"])), covered)

    def windows(h):
        pairs = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(pairs, twice))

    def hashed(w):
        return let(F.transform(F.sequence(F.lit(1), F.size(w) - (k - 1)), lambda i: F.xxhash64(F.slice(w, i, k))), windows)

    return let(words, lambda w: F.when(F.size(w) < k + 1, F.lit(0)).otherwise(hashed(w)))


def dup_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))


def with_stats(df: DataFrame, text: str = "text") -> DataFrame:
    """Replace ``text`` by its statistics; a null text has no words.  The word array is bound once per row."""
    t = F.coalesce(F.col(text), F.lit(""))
    words = F.regexp_extract_all(t, F.lit(WORD), F.lit(0))
    by_words = let(words, lambda w: F.struct(F.size(w).alias("n_words"), F.length(F.array_join(w, "")).alias("word_chars"),
                                             repeated_words(w).alias("n_repeat_words")))
    return df.withColumn("_w", by_words).withColumns({
        "n_words": F.col("_w.n_words").cast("long"), "word_chars": F.col("_w.word_chars").cast("long"),
        "n_symbols": F.regexp_count(t, F.lit(SYMBOLS)).cast("long"), "n_dup_lines": dup_lines(t).cast("long"),
        "n_repeat_words": F.col("_w.n_repeat_words").cast("long"),
        "n_lines": F.regexp_count(t, F.lit(r"[^\x20\x09-\x0D][^\n]*")).cast("long"),
        "n_upper": F.regexp_count(t, F.lit("[A-Z]")).cast("long"), "n_marks": F.regexp_count(t, F.lit("[!?]")).cast("long"),
        "n_pipes": F.regexp_count(t, F.lit("[|]")).cast("long"),
    }).drop("_w")


def features() -> dict[str, Column]:
    """Ratios on which rules set thresholds; a denominator of 0 counts as 1."""
    def over(a, b):
        return F.col(a) / F.greatest(F.col(b), F.lit(1))
    return {"n_words": F.col("n_words").cast("double"), "mean_word": over("word_chars", "n_words"),
            "symbol_share": (F.col("n_symbols") - F.col("n_pipes")) / F.greatest("word_chars", F.lit(1)),
            "upper_share": over("n_upper", "word_chars"), "mark_share": over("n_marks", "n_words"),
            "pipe_share": over("n_pipes", "n_words"),
            "dup_line_share": over("n_dup_lines", "n_lines"), "repeat_share": over("n_repeat_words", "n_words")}


@dataclass(frozen=True)
class Literal:
    feature: str
    above: bool
    threshold: float

    def column(self, cols: dict[str, Column]) -> Column:
        c = cols[self.feature]
        return c > self.threshold if self.above else c <= self.threshold


def _holds(rule, cols):
    out = F.lit(True)
    for literal in rule:
        out = out & literal.column(cols)
    return out


def learn(rows: DataFrame, names: list[str], bins: int = 32, max_rules: int = 8, max_literals: int = 3,
          min_precision: float = 0.9, min_cover: int = 5) -> list[tuple[Literal, ...]]:
    """Decision list for ``bad`` (0/1) over the feature columns ``names`` of a bounded table with a boolean ``grow``.

    Each step is one aggregate: per feature and candidate threshold the numbers of bad and good rows at or under it.
    Ties go to the first feature in ``names`` and the lowest threshold.  Without bad rows the list is empty."""
    cols = {n: F.col(n) for n in names}
    cuts = rows.agg(*[F.percentile_approx(n, [i / bins for i in range(1, bins)], 100_000).alias(n) for n in names]).first()
    cuts = {n: sorted(set(cuts[n] or [])) for n in names}
    left, rules = rows, []

    def tally(part, conditions):
        sums = []
        for c in conditions:
            sums += [F.sum(F.when(c, F.col("bad"))), F.sum(F.when(c, 1 - F.col("bad")))]
        values = part.agg(*[s.alias(f"s{i}") for i, s in enumerate(sums)]).first()
        flat = [v or 0 for v in values]
        return list(zip(flat[::2], flat[1::2], strict=True))

    options = [(n, t) for n in names for t in cuts[n]]
    while options and len(rules) < max_rules:
        rule: tuple[Literal, ...] = ()
        part = left.filter("grow")
        while len(rule) < max_literals:
            covered = part.filter(_holds(rule, cols))
            # counts at or under each threshold by feature bin, then running sums: one shuffle of few rows
            counts = tally(covered, [F.lit(True)] + [cols[n] <= t for n, t in options])
            (p0, n0), best, gain = counts[0], None, 0.0
            if not p0 or not n0:
                break
            for (name, t), (p, n) in zip(options, counts[1:], strict=True):
                for above, q, m in ((False, p, n), (True, p0 - p, n0 - n)):
                    if q >= min_cover:
                        g = q * (math.log2(q / (q + m)) - math.log2(p0 / (p0 + n0)))
                        if g > gain + 1e-9:
                            best, gain = Literal(name, above, float(t)), g
            if best is None:
                break
            rule += (best,)
        if not rule:
            break
        held = left.filter("NOT grow")
        scored = tally(held, [_holds(rule[:k], cols) for k in range(1, len(rule) + 1)])
        value = [(p - n) / (p + n) if p + n else -1.0 for p, n in scored]
        keep = value.index(max(value)) + 1
        p, n = scored[keep - 1]
        rule = rule[:keep]
        if p < min_cover or p < min_precision * (p + n):
            break
        rules.append(rule)
        left = left.filter(~_holds(rule, cols))
    return rules


def decision(rules: list[tuple[Literal, ...]], cols: dict[str, Column]) -> Column:
    """The list as one ordered conditional: number of the first rule that holds, 0 if none does."""
    out = F.lit(0)
    for i, rule in reversed(list(enumerate(rules, 1))):
        out = F.when(_holds(rule, cols), F.lit(i)).otherwise(out)
    return out


def quality_rules(docs: DataFrame, labels: DataFrame, max_labelled: int = 20_000, **options) -> DataFrame:
    """One row per document: its statistics, ``base_failed``, ``rule`` (first learned rule that rejects it, else 0) and
    ``kept``.

    The list is fitted on at most ``max_labelled`` labelled rows (those with the smallest hash of doc_id).  A null or
    empty text has no words and fails the base rule; labels with a null id or quality are ignored; repeated documents
    are judged alike; an empty table gives an empty result; other columns of ``docs`` are not looked at."""
    require(docs, "doc_id", "text")
    stats = materialize(with_stats(docs.select("doc_id", "text")).drop("text"))
    cols = features()
    picked = (labels.select("doc_id", "quality").filter("doc_id IS NOT NULL AND quality IS NOT NULL")
              .groupBy("doc_id").agg(F.min("quality").alias("quality"))
              .orderBy(F.xxhash64(F.col("doc_id").cast("string")), "doc_id").limit(max_labelled))
    sample = stats.join(F.broadcast(picked), "doc_id").select(
        *[c.alias(n) for n, c in cols.items()], (F.col("quality") == 0).cast("int").alias("bad"),
        (F.pmod(F.xxhash64(F.lit("grow"), F.col("doc_id").cast("string")), F.lit(3)) > 0).alias("grow"))
    sample = materialize(sample.coalesce(4))
    rules = learn(sample, list(cols), **options)
    failed = (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)
    out = stats.withColumn("base_failed", failed).withColumn("rule", decision(rules, cols))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))


def op10_quality_rules(spark, sf_dir):
    out = quality_rules(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "rule", "kept")
