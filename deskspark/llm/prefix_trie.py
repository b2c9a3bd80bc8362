"""Conversation prefix trie by fixed-length block hashing.

1. Every turn becomes a digest of role and text; only digests and lengths go on.  Turns are numbered by a range-partitioned sort
   over (conversation, turn) with the offset of each partition, so a conversation with a third of all turns is no single task.
2. Blocks of ``block`` turns get a digest, and successive block digests a chained prefix key.  The chain is built over a tree of
   groups of ``fan`` items, so that no array holds more than ``fan`` items, however long a conversation is.
3. Conversations with an equal key before a block are siblings there.  Siblings that have the same block share its turn
   boundaries: one of them stands for all.  Only blocks in which siblings diverge are refined turn by turn for every member.
4. Sums over subtrees need no walk over the tree.  A node is owned by its smallest member; a conversation owns the lower part of
   its path.  What it owns lies in a node's subtree if it is a member of the node, but for what the node's own owner owns above
   it.  So a sum over the subtree is the members' owned sums, added up per node like the member counts (by block where siblings
   agree), less a running sum along the owner's path.
5. The members that end at a node are hashed in order by streaming: sorted runs are joined to pieces of at most ``PIECE``
   ids, and the pieces of a node pass through one hash object.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deskspark.llm.common import read, require, ship
from deskspark.llm.importance import CRC_SQL
from deskspark.operators.common import materialize

ship(__name__)

ROOT = ""
PIECE = 4096
#: Depths of an owner's path that are summed in one group.
STRETCH = 1024


def digest(*parts) -> Column:
    return F.substring(F.sha2(F.concat(*parts), 256), 1, 32)


def numbered(turns: DataFrame, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(id, pos, digest, size): the turns of each conversation in order, from 0, with the digest of role and text and the text's code points.

    Null role or text is empty; a null turn comes first; equal turns go by their digest; rows without an id are left out."""
    require(turns, id, turn, role, text)
    who, said = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    rows = materialize(turns.filter(F.col(id).isNotNull()).select(
        F.col(id).cast("long").alias("id"), F.col(turn).alias("turn"), digest(F.length(who).cast("string"), F.lit(":"), who, said).alias("digest"),
        F.length(said).cast("long").alias("size"), F.monotonically_increasing_id().alias("row")))
    # "row" parts equal rows, so that no range is one repeated row
    ordered = materialize(rows.sort("id", F.asc_nulls_first("turn"), "digest", "row").select("id", "digest", "size", F.monotonically_increasing_id().alias("at")))
    part, within = F.shiftright("at", 33), F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = ordered.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("rows"))
    before = sizes.select("part", (F.sum("rows").over(Window.orderBy("part")) - F.col("rows")).alias("before"))  # a row per partition of the sort
    ordered = ordered.withColumn("part", part).join(F.broadcast(before), "part").select("id", "digest", "size", (F.col("before") + within).alias("at"))
    firsts = ordered.groupBy("id").agg(F.min("at").alias("first"))
    return ordered.join(firsts, "id").select("id", (F.col("at") - F.col("first")).alias("pos"), "digest", "size")


def running(items: Column, start: Column, tag: str) -> Column:
    """Keys of the prefixes of an array of digests, the empty one (``start``) included."""
    return F.aggregate(items, F.array(start), lambda keys, x: F.concat(keys, F.array(digest(F.lit(tag), F.element_at(keys, -1), x))))


def chained(items: DataFrame, fan: int) -> DataFrame:
    """``items`` (id, i, digest, and what else there is) with ``before`` and ``key``, the keys of the prefixes without and with the item."""
    more = [c for c in items.columns if c not in ("id", "i", "digest")]
    groups = items.groupBy("id", F.expr(f"i div {fan}").alias("g")).agg(F.array_sort(F.collect_list(F.struct("i", "digest", *more))).alias("list"))
    digests = F.transform("list", lambda x: x["digest"])
    if items.agg(F.max("i")).first()[0] < fan:
        groups = groups.withColumn("upto", F.lit(None).cast("string")).withColumn("from", F.lit(ROOT))
    else:
        groups = materialize(groups)
        upper = chained(groups.select("id", F.col("g").alias("i"), digest(F.lit("g"), F.concat_ws(",", digests)).alias("digest")), fan)
        groups = groups.join(upper.select("id", F.col("i").alias("g"), F.col("before").alias("from"), F.col("key").alias("upto")), ["id", "g"])
    keyed = groups.withColumn("keys", running(digests, F.col("from"), "b"))
    # a whole group's last key is that of the group, from which the next one goes on
    item = F.posexplode(F.arrays_zip("list", F.slice("keys", 1, F.size("list")).alias("before"), F.slice("keys", 2, F.size("list")).alias("key")))
    flat = keyed.select("id", "upto", item.alias("n", "x"))
    key = F.when(F.col("n") == fan - 1, F.coalesce("upto", "x.key")).otherwise(F.col("x.key"))
    return flat.select("id", F.col("x.list.i").alias("i"), F.col("x.list.digest").alias("digest"), *[F.col(f"x.list.{c}").alias(c) for c in more],
                       F.col("x.before").alias("before"), key.alias("key"))


def boundaries(block: int) -> Column:
    """The turn nodes inside a block row: key, parent, depth, size and digest of the last turn."""
    keys = running(F.transform("turns", lambda t: t["digest"]), F.col("before"), "t")
    keys = F.when(F.size("turns") == block, F.concat(F.slice(keys, 1, block), F.array("key"))).otherwise(keys)
    return F.transform(F.arrays_zip("turns", F.slice(keys, 2, block).alias("key"), F.slice(keys, 1, F.size("turns")).alias("parent")), lambda x, j: F.struct(
        x["key"].alias("key"), x["parent"].alias("parent"), (F.col("i") * block + j + 1).alias("depth"), x["turns"]["size"].alias("size"), x["turns"]["digest"].alias("turn")))


def _pieces(batches):
    key, first, ids = None, None, []

    def piece():
        return pa.RecordBatch.from_pydict({"key": [key], "first": pa.array([first], pa.int64()), "ids": [",".join(ids)]})

    for b in batches:
        for k, i in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            if ids and (k != key or len(ids) == PIECE):
                yield piece()
                ids = []
            if not ids:
                key, first = k, i
            ids.append(str(i))
    if ids:
        yield piece()


def _hashed(batches):
    key, state = None, None
    for b in batches:
        done = []
        for k, ids in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True):
            if k == key:
                state.update(b",")
            else:
                if state is not None:
                    done.append((key, state.hexdigest()))
                key, state = k, hashlib.sha256()
            state.update(ids.encode())
        yield pa.RecordBatch.from_pydict({"key": [k for k, _ in done], "ends": [e for _, e in done]}, pa.schema([("key", pa.string()), ("ends", pa.string())]))
    if state is not None:
        yield pa.RecordBatch.from_pydict({"key": [key], "ends": [state.hexdigest()]})


def ordered_digest(ends: DataFrame) -> DataFrame:
    """(key, ends): SHA-256 of the ids of each key (key, id) in ascending order, comma-joined, without an array of them."""
    runs = materialize(ends.repartitionByRange("key", "id").sortWithinPartitions("key", "id").mapInArrow(_pieces, "key string, first long, ids string"))
    return runs.repartition("key").sortWithinPartitions("key", "first").mapInArrow(_hashed, "key string, ends string")


def owned_above(nodes: DataFrame) -> DataFrame:
    """(key, above): the weight of the nodes that a node's owner owns higher up, in stretches of ``STRETCH`` depths."""
    x = nodes.select("key", "rep", "depth", "weight", F.expr(f"depth div {STRETCH}").alias("stretch"))
    sums = x.groupBy("rep", "stretch").agg(F.sum("weight").alias("total"))
    sums = sums.withColumn("earlier", F.sum("total").over(Window.partitionBy("rep").orderBy("stretch")) - F.col("total")).drop("total")
    own = F.sum("weight").over(Window.partitionBy("rep", "stretch").orderBy("depth")) - F.col("weight")
    return x.withColumn("own", own).join(sums, ["rep", "stretch"]).select("key", (F.col("own") + F.col("earlier")).alias("above"))


def trie(paths: DataFrame, ids: DataFrame, block: int = 8, fan: int = 16) -> DataFrame:
    """One row per distinct prefix of ``paths`` (id, pos, digest, size; pos from 0 without gaps), the empty one included: conv_id (smallest
    member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 and last_turn, the digest of its last turn.
    ``ids`` (id) lists all conversations, those without turns too; without any there is no node."""
    paths, ids = materialize(paths), materialize(ids.select("id").distinct())
    everyone = ids.agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("rep")).first()
    if not everyone.n:
        return paths.sparkSession.createDataFrame([], "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
                                                  "saved_tokens long, ends_sha256 string, last_turn string")
    turns = F.array_sort(F.collect_list(F.struct("pos", "digest", "size")))  # at most ``block``
    blocks = paths.groupBy("id", F.expr(f"pos div {block}").alias("i")).agg(turns.alias("turns"))
    blocks = blocks.withColumn("digest", digest(F.concat_ws(",", F.transform("turns", lambda t: t["digest"]))))
    if paths.isEmpty():
        rows = materialize(blocks.withColumn("before", F.lit(ROOT)).withColumn("key", F.lit(ROOT)))
    else:
        rows = materialize(chained(materialize(blocks), fan))

    siblings = materialize(rows.groupBy("before").agg(
        F.count(F.lit(1)).alias("n"), F.min("digest").alias("low"), F.max("digest").alias("high"), F.min("id").alias("rep"), F.min("i").alias("i"),
        F.min_by("turns", "id").alias("turns"), F.min_by("key", "id").alias("key")))
    agree = siblings.filter("low = high").select("before", "n", "rep", F.inline(boundaries(block)))
    parted = siblings.filter("low <> high").select("before")
    # all first blocks have the same key before them: no join for these
    at_root = rows.filter(F.col("before") == ROOT) if not parted.filter(F.col("before") == ROOT).isEmpty() else rows.limit(0)
    refined = at_root.unionByName(rows.filter(F.col("before") != ROOT).join(parted.filter(F.col("before") != ROOT), "before", "left_semi").select(*rows.columns))
    refined = materialize(refined.select("id", F.inline(boundaries(block))))
    apart = refined.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("rep"), *[F.first(c).alias(c) for c in ("parent", "depth", "size", "turn")])
    root = paths.sparkSession.createDataFrame([(ROOT, None, everyone.n, everyone.rep, 0, 0, None, None)],
                                              "key string, parent string, n long, rep long, depth long, size long, turn string, before string")
    nodes = agree.unionByName(apart.withColumn("before", F.lit(None).cast("string"))).unionByName(root)
    nodes = materialize(nodes.withColumn("weight", (F.col("n") - 1) * F.col("size")))
    children = nodes.filter("parent IS NOT NULL").groupBy("parent").agg(F.count(F.lit(1)).alias("n_children")).withColumnRenamed("parent", "key")
    nodes = materialize(nodes.join(children, "key", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))))

    owned = materialize(nodes.groupBy(F.col("rep").alias("id")).agg(F.sum("weight").alias("weight"), F.sum((F.col("n_children") == 0).cast("long")).alias("leaves")))
    both = [F.sum("weight").alias("below"), F.sum("leaves").alias("n_leaves")]
    by_block = rows.select("id", "before").join(owned, "id").groupBy("before").agg(*both)
    by_turn = refined.select("id", "key").join(owned, "id").groupBy("key").agg(*both)
    sums = (agree.select("key", "before").join(by_block, "before").drop("before").unionByName(by_turn)
            .unionByName(owned.agg(*both).withColumn("key", F.lit(ROOT)).select("key", "below", "n_leaves")))

    last = F.element_at(boundaries(block), -1)["key"]
    final = rows.groupBy("id").agg(F.max_by(F.struct("turns", "before", "key", "i"), "i").alias("x")).select("id", "x.*").select("id", last.alias("key"))
    ends = ordered_digest(ids.join(final, "id", "left").select(F.coalesce("key", F.lit(ROOT)).alias("key"), "id"))

    full = nodes.drop("before").join(sums, "key").join(owned_above(nodes), "key").join(ends, "key", "left")
    parents = nodes.select(F.col("key").alias("parent"), F.col("rep").alias("parent_conv_id"))
    full = (full.filter("depth > 1").join(parents, "parent").unionByName(  # the root is the parent of many: no join
        full.filter("depth <= 1").withColumn("parent_conv_id", F.when(F.col("depth") == 1, F.lit(everyone.rep).cast("long")))))
    return full.select(F.col("rep").alias("conv_id"), F.col("depth").cast("long").alias("depth"), "parent_conv_id", F.col("n").alias("n_convs"), "n_children", "n_leaves",
                       (F.col("below") - F.col("above")).alias("saved_tokens"),
                       F.coalesce("ends", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"), F.col("turn").alias("last_turn"))


def conversation_trie(turns: DataFrame, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", block: int = 8, fan: int = 16) -> DataFrame:
    """The trie of the conversations of a table of turns, see :func:`trie` and, for nulls and ties, :func:`numbered`.  Repeated rows are turns of
    their own; an empty table has no node; texts of any length are hashed whole; other columns are not looked at."""
    paths = materialize(numbered(turns, id, turn, role, text))
    return trie(paths, paths.select("id"), block, fan)


def rebuilt(paths: DataFrame) -> DataFrame:
    """Conversations that begin like the first of their hundred: the first h turns of conversation id - id % 100, then the own turns after
    the first h, with h = crc32(id) % 6."""
    h = F.crc32(F.col("id").cast("string")) % 6
    lengths = paths.groupBy("id").agg((F.max("pos") + 1).alias("length"))
    ids = lengths.select("id", h.alias("h"), (F.col("id") - F.col("id") % 100).alias("of"))
    heads = paths.filter("pos < 5").withColumnRenamed("id", "of")
    taken = ids.join(heads, "of").filter("pos < h").select("id", "pos", "digest", "size")
    shift = ids.join(lengths.withColumnRenamed("id", "of"), "of", "left").select(
        "id", (F.least("h", F.coalesce("length", F.lit(0))) - F.col("h")).alias("shift"))
    own = paths.filter(F.col("pos") >= h).join(shift, "id").select("id", (F.col("pos") + F.col("shift")).alias("pos"), "digest", "size")
    return taken.unionByName(own)


def op11_prefix_trie(spark, sf_dir):
    paths = materialize(numbered(read(spark, sf_dir, "conversations")))
    return trie(rebuilt(paths), paths.select("id")).drop("last_turn")


SQL = f"""
WITH t AS (SELECT conv_id AS id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, x) - 1 AS pos, x, size FROM (
       SELECT conv_id, turn, length(coalesce(text, '')) AS size,
              substr(sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 1, 32) AS x
       FROM conversations WHERE conv_id IS NOT NULL)),
c AS (SELECT id, id - id % 100 AS base, {CRC_SQL.format(hex="hx")} % 6 AS h FROM (SELECT DISTINCT id, hex(encode(id::VARCHAR)) AS hx FROM t)),
p AS (SELECT c.id, 0 AS own, pos, x, size FROM c JOIN t ON t.id = c.base WHERE pos < h
      UNION ALL SELECT c.id, 1, pos, x, size FROM c JOIN t ON t.id = c.id WHERE pos >= h),
n AS (SELECT id, row_number() OVER w AS depth, size, string_agg(x, ',') OVER w AS path FROM p WINDOW w AS (PARTITION BY id ORDER BY own, pos)),
m AS (SELECT id, depth, size, md5(path) AS k, coalesce(lag(md5(path)) OVER (PARTITION BY id ORDER BY depth), '') AS up,
             depth = max(depth) OVER (PARTITION BY id) AS final FROM n),
a AS (SELECT *, min(id) OVER (PARTITION BY k) = id AS first FROM m),
b AS (SELECT *, sum(CASE WHEN first THEN 0 ELSE size END) OVER (PARTITION BY id ORDER BY depth DESC) AS rest FROM a),
g AS (SELECT k, up, depth, min(id) AS conv_id, count(*) AS n_convs, sum(rest) AS saved,
             string_agg(id::VARCHAR, ',' ORDER BY id) FILTER (WHERE final) AS ends FROM b GROUP BY ALL),
kids AS (SELECT up, count(*) AS n FROM g GROUP BY up),
leaf AS (SELECT conv_id FROM g WHERE k NOT IN (SELECT up FROM kids)),
l AS (SELECT k, count(*) AS n FROM b JOIN leaf ON leaf.conv_id = b.id GROUP BY k)
SELECT conv_id::BIGINT AS conv_id, depth::BIGINT AS depth, coalesce((SELECT conv_id FROM g AS o WHERE o.k = g.up), (SELECT min(id) FROM c))::BIGINT AS parent_conv_id,
       n_convs::BIGINT AS n_convs, coalesce(kids.n, 0)::BIGINT AS n_children, l.n::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, sha256(coalesce(ends, '')) AS ends_sha256
FROM g LEFT JOIN kids ON kids.up = g.k JOIN l USING (k)
UNION ALL
SELECT min(id), 0, NULL, count(*), coalesce((SELECT n FROM kids WHERE up = ''), 0), greatest((SELECT count(*) FROM leaf), 1),
       coalesce((SELECT sum(CASE WHEN first THEN 0 ELSE size END) FROM a), 0)::BIGINT,
       sha256(coalesce((SELECT string_agg(id::VARCHAR, ',' ORDER BY id) FROM c WHERE id NOT IN (SELECT id FROM m)), ''))
FROM c HAVING count(*) > 0
"""
