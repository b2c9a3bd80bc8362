"""PII: base patterns and bootstrapped contextual extraction.

1. One pass over the texts finds the base spans (email, ip, card, phone) and the candidate tokens: whole strings with several
   digits or an @ that no base span covers.  Each stands in up to three lexical patterns: the two words before it, the word
   before it and the word after it; the ends of a text count as words.  Base spans are the seed instances of their patterns.
2. The words of every pattern with enough instances to matter are counted in all texts (a second pass; a bitmap of fixed size
   tells the tasks which words to count).  Places where the words stand without a candidate are the evidence against a pattern;
   instances not seen before are none.
3. Pattern-instance graph, one row per edge.  Scores go back and forth until no more instances are found: a pattern's confidence
   is the share of its accepted instances' places in these and the places against it, if ``min_seeds`` distinct accepted
   instances vouch for it; an instance's score is the noisy-or of its patterns' confidences (seeds stay 1), and
   from ``min_confidence`` on it is accepted and counts for its other patterns in the next round.  Every step is an
   aggregate by pattern or instance with partial sums in the tasks.
4. Every place of an accepted instance that no base span covers is reported as a ``context`` span.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect_left, bisect_right
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskspark.llm.common import Ids, batches_of, read, require, shared, ship, slices
from deskspark.operators.common import materialize

ship(__name__)

KINDS = ("email", "ip", "card", "phone")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TOKEN = re.compile(r"[A-Za-z0-9+(][A-Za-z0-9@._+()/-]{4,}")
_WORDS = re.compile(r"[^\W\d_]+")
#: Stand for the ends of a text.
START, END = "^", "$"
#: Bits of the bitmap of words to count.
BITS = 1 << 20


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of local@domain.  Each @ is looked at once, so a long run of letters costs no more than its length."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > last and _LOCAL.match(text[begin - 1]):
            begin -= 1
        m = _DOMAIN.match(text, at + 1) if begin < at else None
        if m:
            out.append((begin, m.end()))
            last = m.end()
        at = text.find("@", max(at + 1, last))
    return out


def dotted_quads(text: str) -> list[tuple[tuple[int, int], list[str]]]:
    """Leftmost matches of four digit runs joined by dots, with their runs.  Chains of runs are cut by fours, so each character is looked at once."""
    out = []
    for m in _DOTTED.finditer(text):
        runs, at = m.group().split("."), m.start()
        for i in range(0, len(runs) - 3, 4):
            four = runs[i:i + 4]
            end = at + sum(map(len, four)) + 3
            out.append(((at, end), four))
            at = end + 1
    return out


def base_spans(text: str) -> list[list[tuple[int, int]]]:
    """Spans by kind in the order of ``KINDS``."""
    def digits(m):
        return "".join(c for c in m.group() if c.isdigit())

    ip = [span for span, parts in dotted_quads(text) if all(len(x.lstrip("0")) <= 3 and int(x[-3:]) <= 255 for x in parts)] if "." in text else []
    card = [m.span() for m in _CARD.finditer(text) if m.end() - m.start() >= 13 and 13 <= len(d := digits(m)) <= 19 and luhn(d)]
    phone = [m.span() for m in _PHONE.finditer(text) if 9 <= len(digits(m)) <= 15] if "+" in text else []
    return [emails(text) if "@" in text else [], ip, card, phone]


def contexts(words: list[str], starts: list[int], ends: list[int], begin: int, end: int) -> list[str]:
    """Patterns of the place begin:end: ``2 a b`` (two words before), ``1 b`` (word before) and ``3 c`` (word after)."""
    i, j = bisect_right(ends, begin), bisect_left(starts, end)
    one = words[i - 1] if i else START
    out = [f"1 {one}", f"3 {words[j] if j < len(words) else END}"]
    return [f"2 {words[i - 2] if i > 1 else START} {one}", *out] if i else out


def candidates(text: str, taken: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Whole tokens with four digits or an @ that overlap none of the spans ``taken`` (sorted)."""
    out, i = [], 0
    for m in _TOKEN.finditer(text):
        token = m.group().rstrip("(./-")
        b, e = m.start(), m.start() + len(token)
        while i < len(taken) and taken[i][1] <= b:
            i += 1
        if ("@" in token or sum(map(token.count, "0123456789")) >= 4) and not (i < len(taken) and taken[i][0] < e):
            out.append((b, e))
    return out


def _instance(text: str) -> str:
    """What stands for an identifier: itself, or its digest where it is long."""
    return text if len(text) <= 64 else "sha256 " + hashlib.sha256(text.encode()).hexdigest()


def _scan(batches):
    for batch in slices(batches, "text"):
        rows = []
        for text in batch.column(batch.schema.get_field_index("text")).to_pylist():
            text = text or ""
            spans = base_spans(text)
            listed = [f"{k}:{b}:{e}" for k, own in zip(KINDS, spans, strict=True) for b, e in own]
            # kinds may overlap; of these the longest, then the first counts for the graph
            seeds = disjoint([s for own in spans for s in own])
            found = [(b, e, True) for b, e in seeds] + [(b, e, False) for b, e in candidates(text, merged(s for own in spans for s in own))]
            graph = []
            if found:
                placed = [(m.group().lower(), *m.span()) for m in _WORDS.finditer(text)]
                words, starts, ends = (list(x) for x in zip(*placed, strict=True)) if placed else ([], [], [])
                graph = [{"patterns": contexts(words, starts, ends, b, e), "instance": _instance(text[b:e]), "seed": seed, "begin": b, "end": e}
                         for b, e, seed in found]
            rows.append((*map(len, spans), ",".join(listed), graph))
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
        kind = pa.list_(pa.struct([("patterns", pa.list_(pa.string())), ("instance", pa.string()), ("seed", pa.bool_()), ("begin", pa.int64()), ("end", pa.int64())]))
        yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, pa.int64()) for c in columns[:4]], pa.array(columns[4], pa.string()),
                                          pa.array(columns[5], kind)], names=["id", *[f"n_{k}" for k in KINDS], "base", "graph"])


def disjoint(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """In order, of each run of overlapping spans the longest (the first among equals) and what does not touch it."""
    out = []
    for b, e in sorted(spans, key=lambda s: (s[0], -s[1])):
        if out and b < out[-1][1]:
            if e - b > out[-1][1] - out[-1][0] and (len(out) < 2 or out[-2][1] <= b):
                out[-1] = (b, e)
        else:
            out.append((b, e))
    return out


def _count(wanted):
    """Rows (pattern, n): in how many places the words of patterns in the bitmap stand."""
    def run(batches):
        bits = wanted.value.bits

        def is_set(x):
            h = zlib.crc32(x.encode()) % BITS
            return bits[h >> 3] >> (h & 7) & 1

        for batch in slices(batches, "text"):
            ids, parts = Ids(), []
            for text in batch.column(batch.schema.get_field_index("text")).to_pylist():
                own = [START, *_WORDS.findall(text or ""), END]
                parts.append(np.fromiter(map(ids.__getitem__, own), np.int64, len(own)))
            lower = Ids()
            code = np.fromiter((lower[x.lower()] for x in ids), np.int64, len(ids))[np.concatenate(parts)]
            names, total = list(lower), Counter()
            for i, n in enumerate(np.bincount(code, minlength=len(names)).tolist()):
                for pattern in (f"1 {names[i]}", f"3 {names[i]}"):
                    if is_set(pattern):
                        total[pattern] += n
            first, second = (np.fromiter((is_set(f"{k} {x}") for x in names), bool, len(names)) for k in ("first", "second"))
            pair = first[code[:-1]] & second[code[1:]]
            found, often = np.unique(code[:-1][pair] * len(names) + code[1:][pair], return_counts=True)
            for x, n in zip(found.tolist(), often.tolist(), strict=True):
                pattern = f"2 {names[x // len(names)]} {names[x % len(names)]}"
                if is_set(pattern):
                    total[pattern] += n
            yield pa.RecordBatch.from_pydict({"pattern": pa.array(list(total), pa.string()), "n": pa.array(list(total.values()), pa.int64())})
    return run


def merged(spans) -> list[tuple[int, int]]:
    """The union of spans, in order."""
    out = []
    for b, e in sorted(spans):
        if out and b < out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((b, e))
    return out


def places(docs: DataFrame, patterns: DataFrame) -> DataFrame:
    """(pattern, places): in how many places of all texts (column ``text``) the words of each of ``patterns`` (pattern) stand."""
    spark = docs.sparkSession
    word = F.split("pattern", " ")
    held = F.when(word[0] == "2", F.array("pattern", F.concat(F.lit("first "), word[1]), F.concat(F.lit("second "), word[2]))).otherwise(F.array("pattern"))
    hashed = patterns.select(F.explode(held).alias("x")).select((F.crc32("x") % BITS).alias("h"))
    # at most BITS / 32,768 rows of 4 kB
    found = hashed.groupBy((F.col("h") / 32768).cast("int").alias("part")).agg(F.bitmap_construct_agg((F.col("h") % 32768).cast("long")).alias("bits")).collect()
    bits = bytearray(BITS // 8)
    for r in found:
        bits[r.part * 4096:(r.part + 1) * 4096] = r.bits
    counted = docs.select("text").mapInArrow(_count(shared(spark, SimpleNamespace(bits=bytes(bits)))), "pattern string, n long")
    counted = counted.groupBy("pattern").agg(F.sum("n").alias("places"))
    return patterns.join(counted, "pattern", "left").select("pattern", F.coalesce("places", F.lit(0)).alias("places"))


def accepted_instances(edges: DataFrame, places: DataFrame, rounds: int, min_seeds: int, min_confidence: float) -> DataFrame:
    """(instance, score) of the accepted instances without the seeds.

    ``edges`` (pattern, instance, seed, n places), each pair once, ``places`` (pattern, places)."""
    scores = edges.groupBy("instance").agg(F.max("seed").cast("double").alias("score"))
    against = F.greatest(F.first("places") - F.sum("n"), F.lit(0))
    known, count = F.col("score") >= min_confidence, 0
    for _ in range(rounds):
        held = edges.join(scores, "instance").join(places, "pattern").groupBy("pattern").agg(
            F.count_if(known).alias("vouch"), F.coalesce(F.sum(F.when(known, F.col("n") * F.col("score"))), F.lit(0.0)).alias("pro"), against.alias("contra"))
        held = held.filter(F.col("vouch") >= min_seeds).select("pattern", (F.col("pro") / (F.col("pro") + F.col("contra"))).alias("confidence"))
        miss = F.sum(F.log1p(-F.least(F.coalesce("confidence", F.lit(0.0)), F.lit(0.999999))))
        scores = materialize(edges.join(held, "pattern", "left").groupBy("instance").agg(
            F.when(F.max("seed"), 1.0).otherwise(1 - F.exp(miss)).alias("score"), F.max("seed").alias("seed")))
        now = scores.filter(known).count()
        if now == count:
            break
        count = now
    return scores.filter(known & ~F.col("seed")).select("instance", "score")


def pii_scan(docs: DataFrame, id: str = "doc_id", text: str = "text", rounds: int = 8, min_seeds: int = 3, min_confidence: float = 0.7) -> DataFrame:
    """One row per row of ``docs``: id, n_email, n_ip, n_card, n_phone, base_sha256, spans (kind:begin:end, base kinds first,
    then ``context``) and n_context.

    A null text is empty; a table without seeds has base spans only; a text that repeats counts for its patterns and against them each time, its identifiers
    are one instance each; an empty table gives an empty result; other columns are not looked at; texts of any length are read whole, and
    so are tokens.  Equal scores need no order: every instance from ``min_confidence`` on is accepted."""
    require(docs, id, text)
    narrow = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    kind = dict(narrow.dtypes)["id"]
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    graph = "array<struct<patterns array<string>, instance string, seed boolean, begin long, end long>>"
    with batches_of(docs.sparkSession):
        rows = materialize(narrow.mapInArrow(_scan, f"id {kind}, {counts}, base string, graph {graph}").withColumn("row", F.monotonically_increasing_id()))
        each = rows.select("row", F.inline("graph"))
        edges = materialize(each.select(F.explode("patterns").alias("pattern"), "instance", "seed").groupBy("pattern", "instance")
                            .agg(F.max("seed").alias("seed"), F.count(F.lit(1)).alias("n")))
        # a pattern can be vouched for only by so many instances
        enough = materialize(edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("m")).filter(F.col("m") >= min_seeds).select("pattern"))
        edges = materialize(edges.join(enough, "pattern"))
        found = accepted_instances(edges, materialize(places(narrow, enough)), rounds, min_seeds, min_confidence)
    context = (each.filter("NOT seed").join(found, "instance").groupBy("row")
               .agg(F.array_sort(F.collect_list(F.struct("begin", "end"))).alias("context")))
    out = rows.drop("graph").join(context, "row", "left")
    more = F.transform(F.coalesce("context", F.array()), lambda x: F.concat(F.lit("context:"), x["begin"].cast("string"), F.lit(":"), x["end"].cast("string")))
    spans = F.array_join(F.filter(F.concat(F.array("base"), more), lambda x: x != ""), ",")
    return out.select(F.col("id").alias(id), *[F.col(f"n_{k}") for k in KINDS], F.sha2("base", 256).alias("base_sha256"), spans.alias("spans"),
                      F.greatest(F.size("context"), F.lit(0)).cast("long").alias("n_context"))


def op9_pii_bootstrap(spark, sf_dir):
    return pii_scan(read(spark, sf_dir, "documents"))
