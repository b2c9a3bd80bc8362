"""Prefix trie, Hamming index and importance resampling against brute force on small fixtures."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from deskspark.llm import hamming_index, importance, prefix_trie
from tests.oracle_harness import compare, duck

SF = "/root/testdata/sf0.001"
TURNS = "conv_id long, turn long, role string, text string, pos long, key string, n long, id long, depth long, size long"


def turns(spark, rows):
    """Turns with extra columns whose names clash with working names."""
    return spark.createDataFrame([(*r, 7, "k", 1, 2, 3, 4) for r in rows], TURNS)


def nodes_by_hand(paths):
    """The trie of id -> list of (role, text) by definition."""
    members = {}
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members.setdefault(tuple(path[:d]), set()).add(c)
    kids = {p: [q for q in members if len(q) == len(p) + 1 and q[:len(p)] == p] for p in members}
    out = set()
    for p, own in members.items():
        below = [q for q in members if q[:len(p)] == p]
        ends = ",".join(str(c) for c in sorted(c for c in own if len(paths[c]) == len(p)))
        out.add((min(own), len(p), min(members[p[:-1]]) if p else None, len(own), len(kids[p]), sum(not kids[q] for q in below),
                 sum((len(members[q]) - 1) * len(q[-1][1]) for q in below if q), hashlib.sha256(ends.encode()).hexdigest()))
    return out


def rebuilt_by_hand(rows):
    own = {}
    for c, t, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append(((t is not None, t or 0), prefix_trie_digest(role, text), (role or "", text or "")))
    paths = {c: [x[2] for x in sorted(v, key=lambda x: x[:2])] for c, v in own.items()}
    h = {c: zlib.crc32(str(c).encode()) % 6 for c in paths}
    return {c: paths.get(c - c % 100, [])[:h[c]] + paths[c][h[c]:] for c in paths}


def prefix_trie_digest(role, text):
    return hashlib.sha256(f"{len(role or '')}:{role or ''}{text or ''}".encode()).hexdigest()[:32]


def some_turns(seed=1):
    rng, rows = random.Random(seed), []
    common = [("user", "hi é"), ("assistant", "hello there"), ("user", "and so on"), (None, None)] * 12
    for c in [0, 1, 2, 3, 5, 7, 100, 101, 102, 140, 155, 199, 250, 251, 305, 317]:
        n = rng.choice([1, 2, 3, 9, 20, 45])
        cut = rng.randint(0, n)
        for t in range(n):
            rows.append((c, t if t else None, *(common[t] if t < cut else (rng.choice("ab"), rng.choice(["x", "yy", ""])))))
    rows += [(7, 3, "u", "tie"), (7, 3, "u", "tie"), (None, 1, "u", "lost"), (400, 0, "u", "z" * 100_000)]
    rows += [(c, t, *common[t]) for c in range(500, 560) for t in range(20)]
    return rows


@pytest.mark.parametrize(("block", "fan"), [(8, 16), (2, 2), (3, 4)])
def test_trie_equals_definition(spark, block, fan):
    rows = some_turns()
    paths = prefix_trie.numbered(turns(spark, rows))
    got = prefix_trie.trie(prefix_trie.rebuilt(paths), paths.select("id"), block, fan).drop("last_turn").collect()
    want = nodes_by_hand(rebuilt_by_hand(rows))
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_trie_of_no_turns(spark):
    assert prefix_trie.conversation_trie(turns(spark, [])).count() == 0
    # conversation 7 has one turn, and takes more from a first conversation that does not exist
    one = turns(spark, [(c, 0, "u", "t") for c in range(1, 60)])
    paths = prefix_trie.numbered(one)
    got = prefix_trie.trie(prefix_trie.rebuilt(paths), paths.select("id")).drop("last_turn").collect()
    assert {tuple(r) for r in got} == nodes_by_hand({c: [("u", "t")][zlib.crc32(str(c).encode()) % 6:] for c in range(1, 60)})
    bare = prefix_trie.trie(paths.limit(0), paths.select("id")).collect()
    assert [(r.conv_id, r.depth, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens) for r in bare] == [(1, 0, 59, 0, 1, 0)]


def test_long_runs_of_ends(spark):
    ids = spark.range(10_000).select(F.lit("k").alias("key"), "id").unionByName(spark.createDataFrame([("l", 5)], "key string, id long"))
    got = {r["key"]: r.ends for r in prefix_trie.ordered_digest(ids).collect()}
    assert got == {"k": hashlib.sha256(",".join(map(str, range(10_000))).encode()).hexdigest(), "l": hashlib.sha256(b"5").hexdigest()}


VECTORS = "vec_id long, embedding array<float>, rep long, code string, id long, vec int, score double"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v if v is None else [x if x is None else float(x) for x in v], 1, "c", 2, 3, 0.5) for i, v in rows], VECTORS)


def nearest_by_hand(rows, k, asks):
    good = sorted({(i, tuple(float(np.float32(x)) for x in v)) for i, v in rows
                   if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)})
    out = set()
    for q, x in good:
        if asks(q):
            near = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in good if i != q)[:k]
            out |= {(q, rank, i, round(-s, 9)) for rank, (s, i) in enumerate(near, 1)}
    return out


def test_index_on_odd_vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.standard_normal(6).tolist()) for i in range(60)]
    rows += [(100 + i, rows[20][1]) for i in range(40)]  # copies, two of them queries
    rows += [(201, None), (220, [0.0] * 6), (203, [1.0, None, 0, 0, 0, 0]), (240, [float("nan")] + [1.0] * 5), (205, [float("inf")] + [1.0] * 5),
             (None, [1.0] * 6), (260, [2.0, 3.0]), (207, []), (280, [-0.0, 5.0, 0.0, 0.0, 0.0, 0.0]), (280, [0.0, 5.0, -0.0, 0.0, 0.0, 0.0]), (280, [0.0, 5.0] + [0.0] * 4)]
    rows += [(300 + i, [x * 10 for x in rows[i][1]]) for i in range(5)]  # of other norms
    got = hamming_index.search(vectors(spark, rows), F.col("vec_id") % 20 == 0, k=10).collect()
    assert {(r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in got} == nearest_by_hand(rows, 10, lambda q: q % 20 == 0) and len(got) == len({*got})
    few = vectors(spark, rows[:4])
    assert hamming_index.search(few, F.col("vec_id") == 0, k=10).count() == 3
    assert hamming_index.search(few.limit(0), F.lit(True)).count() == 0
    same = vectors(spark, [(i, [1.0, 2.0]) for i in range(30)])
    assert [(r["rank"], r.vec_id) for r in hamming_index.search(same, F.col("vec_id") == 3, k=5).orderBy("rank").collect()] == [(1, 0), (2, 1), (3, 2), (4, 4), (5, 5)]


@pytest.mark.parametrize("cell_rows", [16_384, 50])
def test_index_recall(spark, cell_rows):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = hamming_index.search(vectors(spark, rows), F.col("vec_id") % 20 == 0, cell_rows=cell_rows, sample=200).collect()
    want = nearest_by_hand(rows, 20, lambda q: q % 20 == 0)
    assert len(got) == len(want)
    assert len({(r.query_id, r.vec_id) for r in got} & {(q, i) for q, _, i, _ in want}) >= 0.95 * len(want)


def test_pieces_probe_every_code_in_the_radius():
    rng = np.random.default_rng(5)
    codes = (rng.integers(0, 2 ** 32, (300, 8)) & rng.integers(0, 2 ** 32, (300, 8)) & rng.integers(0, 2 ** 32, (300, 8))).astype(np.uint32)
    x = rng.standard_normal((300, 4))
    r = np.full(20, 70, np.int32)
    found = set()
    for j in range(8):
        piece = hamming_index.Piece(j, np.arange(300), x, codes)
        for q, rows, _ in piece.probe(x[:20], codes[:20], np.full(20, -np.inf), r, 300):
            new = {(q, int(i)) for i in piece.reps[rows]}
            assert not new & found  # each pair at one substring only
            found |= new
    want = {(q, i) for q in range(20) for i in range(300) if int(np.bitwise_count(codes[q] ^ codes[i]).sum()) <= 70}
    assert found == want and len(want) > 100


DOCS = "doc_id long, text string, n_words long, weight long, at long, part int, place long, rank string"


def resampled_by_hand(docs, target, n, buckets=10_000):
    def features(text):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        return words, [zlib.crc32(" ".join(words[i:i + k]).encode()) % buckets for k in range(1, n + 1) for i in range(len(words) - k + 1)]

    s, t = [0] * buckets, [0] * buckets
    for _, text in docs:
        for b in features(text)[1]:
            s[b] += 1
    for text in target:
        for b in features(text)[1]:
            t[b] += 1
    out = []
    for i, text in docs:
        words, own = features(text)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (sum(s) + buckets) / ((s[b] + 1) * (sum(t) + buckets)))) for b in own)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(words), len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2 ** 32))), None])
    fit = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2], r[3]))
    for rank, r in enumerate(fit[:10 * len(fit) // 100], 1):
        r[5] = rank
    return sorted(map(str, out))


@pytest.mark.parametrize("n", [1, 2, 3])
def test_resampling_equals_definition(spark, n):
    rng = random.Random(2)
    words = ["Alpha", "béta", "x9", "Ünit", "delta", "e", "F", "g_h", "ß"]
    docs = [(i, " ".join(rng.choices(words, k=rng.randint(1, 60)))) for i in range(300)]
    docs += [(None, " ".join(words * 4)), (3, docs[3][1]), (3, "other " * 25), (900, None), (901, ""), (902, "\n- ,"), (903, "lone"), (904, "w " * 50_000)]
    target = ["béta X9 delta", "alpha alpha", None, ""]
    frame = spark.createDataFrame([(i, x, 1, 2, 3, 4, 5, "r") for i, x in docs], DOCS)
    goal = spark.createDataFrame([(x,) for x in target], "text string")
    got = importance.resample(frame, goal, n=n).collect()
    assert sorted(str(list(r)) for r in got) == resampled_by_hand(docs, target, n)
    assert importance.resample(frame.limit(0), goal).count() == 0
    assert importance.resample(frame, goal.limit(0), n=n).count() == len(docs)


@pytest.mark.parametrize("name", ["op11_prefix_trie", "op13_importance_resampling"])
def test_oracle(spark, name):
    from deskspark.llm.queries import REGISTRY

    fn, sql = REGISTRY[name]
    res, _, _ = compare(spark, duck(SF), name, fn, sql, SF)
    assert res["hash_match"] and res["rows_spark"] == res["rows_oracle"]
