"""Operator 11: the prefix trie of conversations by van Emde Boas recursion.

A trie of height 2 ** K is cut at half its depth: an upper trie over the first
halves, and under each of its leaves a lower trie over what follows. Both are cut
in the same way, down to height one. All tries of a height are cut in one Spark
job, so a conversation of n turns takes log2(n) jobs and its turns are never in
one task.

A depth d ends exactly one half, the block of turns d - low(d) + 1 .. d, where
low(d) is d's lowest bit. So each (conversation, depth) has one block digest (an
order-free 128-bit sum of its turns and their places, added up before the shuffle),
and the cut prefix at d is named from the name at d - low(d) and that digest. A
name is the least conversation of those that share both; with its depth it is the
node. Names go from high bits to low, all cuts of one bit at once.

Totals go the other way. What a cut prefix has below it (the sum of its children's
totals) is grafted on each of the nodes of its upper trie that lead to it: bit by
bit, each graft a join of the cut prefixes with the nodes on the way of the
conversation that names them.

Turns are put in order by a range sort over all conversations, and counted from
the rows of each partition, so the turns of one conversation may lie in many
tasks. The ids of the conversations that end in a node are written out in order as
texts of a bounded size, which one task hashes as they come.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .common import WORD, cut, table

#: Conversations of a family share the beginning of the first.
FAMILY, HEADS = 20, 4
#: Ids of a node's conversations are joined to texts of about this many bytes before they are moved to be hashed.
PART = 1 << 16


def _low(d: str) -> Column:
    """The lowest bit of a positive number."""
    return F.col(d).bitwiseAND(-F.col(d))


def _at_zero(c: Column | str) -> Column:
    return F.coalesce(c, F.lit(0)).cast("long")


def ordered_turns(rows: DataFrame) -> DataFrame:
    """(conv, pos, x, y, words): each turn's place in its conversation, its digest and its words.

    By turn, null first; of equal turns by digest, so that repeated rows follow each other.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = rows.select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"), F.xxhash64(F.lit(1), role, text).alias("x"), F.xxhash64(F.lit(2), role, text).alias("y"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"), F.monotonically_increasing_id().alias("uid"),
    ).where("conv IS NOT NULL")
    order = [F.col("conv"), F.asc_nulls_first("turn"), F.col("x"), F.col("y"), F.col("uid")]
    placed = cut(turns.repartitionByRange(*order).withColumn("part", F.spark_partition_id()))
    # Rows of a conversation before each partition: one row for each partition that it lies in.
    before = placed.groupBy("conv", "part").agg(F.count("*").alias("n"))
    before = before.withColumn("before", _at_zero(F.sum("n").over(Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))))
    inside = F.row_number().over(Window.partitionBy("conv", "part").orderBy(*order[1:]))
    return placed.withColumn("inside", inside).join(before.drop("n"), ["conv", "part"]).select("conv", (F.col("inside") + F.col("before")).cast("long").alias("pos"), "x", "y", "words")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conversations with the number of their rebuilt turns, rebuilt turns): the first h turns are those of the first of the family, the rest is the conversation's own."""
    sizes = turns.groupBy("conv").agg(F.max("pos").alias("own"))
    heads = F.crc32(F.col("conv").cast("string").cast("binary")) % HEADS
    first = F.col("conv") - F.col("conv") % FAMILY
    convs = sizes.select("conv", "own", heads.alias("h"), first.alias("first"))
    lent = sizes.select(F.col("conv").alias("first"), F.col("own").alias("has"))
    convs = cut(convs.join(lent, "first", "left").select("conv", "first", "h", F.least("h", _at_zero("has")).alias("lent"), F.greatest(F.col("own") - F.col("h"), F.lit(0)).alias("kept")))
    own = turns.where(F.col("pos") > heads).join(convs.select("conv", "h", "lent"), "conv").withColumn("pos", F.col("pos") - F.col("h") + F.col("lent")).drop("h", "lent")
    # At most HEADS - 1 turns of a first conversation are lent, each to its family alone.
    loans = convs.where("lent > 0").select("first", F.col("conv").alias("to"), F.explode(F.sequence(F.lit(1).cast("long"), F.col("lent"))).alias("pos"))
    lend = turns.where((F.col("pos") < HEADS) & (F.col("conv") % FAMILY == 0)).withColumnRenamed("conv", "first")
    lent_turns = lend.join(loans, ["first", "pos"]).select(F.col("to").alias("conv"), "pos", "x", "y", "words")
    return convs.select("conv", (F.col("lent") + F.col("kept")).alias("size")), own.unionByName(lent_turns)


def blocks(turns: DataFrame, convs: DataFrame, bits: int) -> DataFrame:
    """(conv, depth, u, v, words): the digest of the block that ends at each depth, and the words of its last turn."""
    p = F.col("pos") - 1
    # The halves that a turn is in: the first half of its block of each height, where the conversation fills that half.
    ends = F.filter(F.transform(F.sequence(F.lit(0), F.lit(max(bits - 1, 0))), lambda j: F.struct(p.bitwiseAND(_power(j)).alias("second"), ((_shift(p, j) + 1) * _power(j)).alias("depth"))), lambda e: (e["second"] == 0) & (e["depth"] <= F.col("size")))
    parts = turns.join(convs, "conv").select("conv", "pos", "words", *[F.xxhash64(F.lit(i), "pos", "x", "y").alias(n) for i, n in ((1, "u"), (2, "v"))], F.explode(ends["depth"]).alias("depth"))
    last = F.max(F.when(F.col("pos") == F.col("depth"), F.col("words")))
    return parts.groupBy("conv", "depth").agg(F.bit_xor("u").alias("u"), F.bit_xor("v").alias("v"), last.alias("words"))


def _power(j: Column) -> Column:
    return F.pow(F.lit(2.0), j).cast("long")


def _shift(p: Column, j: Column) -> Column:
    return F.floor(p / _power(j)).cast("long")


def names(cuts: DataFrame, bits: int) -> DataFrame:
    """(conv, depth, node, members, words) of every block: ``node`` is the least conversation with that prefix, ``members`` how many have it."""
    done: DataFrame | None = None
    for j in reversed(range(bits)):
        own = cuts.where(_low("depth") == 1 << j).withColumn("above", F.col("depth") - (1 << j))
        if done is None:
            own = own.withColumn("root", F.lit(None).cast("long"))
        else:
            above = done.select("conv", F.col("depth").alias("above"), F.col("node").alias("root"))
            own = own.join(above, ["conv", "above"], "left")
        key = ["depth", "root", "u", "v"]
        # Depth tells the root of the whole trie from a node that conversation 0 names.
        own = own.withColumn("root", F.coalesce("root", F.lit(0))).drop("above")
        named = own.groupBy(*key).agg(F.min("conv").alias("node"), F.count("*").alias("members"))
        level = cut(own.join(named, key).select("conv", "depth", "node", "members", "words"))
        done = level if done is None else done.unionByName(level)
    return done


def totals(paths: DataFrame, values: DataFrame, bits: int) -> DataFrame:
    """(node, depth, n_leaves, saved_tokens): sums of ``values`` (node, depth, parent, n_leaves, saved_tokens) over each node's subtree."""
    measures = ["n_leaves", "saved_tokens"]
    parts = values
    for j in range(bits):
        half = 1 << j
        # Cut prefixes at depth d with low(d) = half, and what lies below each of them in its block.
        below = parts.where((F.col("depth") > 1) & ((F.col("depth") - 1).bitwiseAND(2 * half - 1) == half)).groupBy(F.col("parent").alias("conv"), (F.col("depth") - 1).alias("cut")).agg(*[F.sum(m).alias(m) for m in measures])
        # The nodes of the upper trie on the way to it; of a conversation's depths only those in blocks that it fills.
        way = paths.where(((F.col("depth") - 1).bitwiseAND(half) == 0) & (F.floor((F.col("depth") - 1) / half) * half + half <= F.col("size")))
        way = way.select("conv", "depth", "node", "parent", ((F.floor((F.col("depth") - 1) / half) + 1) * half).cast("long").alias("cut"))
        graft = way.join(below, ["conv", "cut"]).groupBy("node", "depth", "parent").agg(*[F.sum(m).alias(m) for m in measures])
        parts = parts.unionByName(cut(graft))
    return parts.groupBy("node", "depth").agg(*[F.sum(m).cast("long").alias(m) for m in measures])


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (node, depth, conv) as texts of ids, each of one node and of bounded size."""
    key, ids, size, first = None, [], 0, 0

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"node": [key[0]], "depth": [key[1]], "first": [first], "ids": [",".join(ids)]}, pa.schema([("node", pa.int64()), ("depth", pa.int64()), ("first", pa.int64()), ("ids", pa.string())]))

    for b in batches:
        for node, depth, conv in zip(*(b.column(c).to_pylist() for c in ("node", "depth", "conv"))):
            if (node, depth) != key or size > PART:
                if ids:
                    yield out()
                key, ids, size, first = (node, depth), [], 0, conv
            ids.append(str(conv))
            size += len(ids[-1]) + 1
    if ids:
        yield out()


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted texts of ids as one SHA-256 for each node."""
    key, sha, done = None, None, []

    def out() -> pa.RecordBatch:
        nodes, depths, hashes = zip(*done)
        return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(depths, pa.int64()), pa.array(hashes)], ["node", "depth", "ends_sha256"])

    for b in batches:
        for node, depth, ids in zip(*(b.column(c).to_pylist() for c in ("node", "depth", "ids"))):
            if (node, depth) == key:
                sha.update(b",")
            else:
                if key:
                    done.append((*key, sha.hexdigest()))
                key, sha = (node, depth), hashlib.sha256()
            sha.update(ids.encode())
        if len(done) > 5000:
            yield out()
            done = []
    if key:
        done.append((*key, sha.hexdigest()))
    if done:
        yield out()


def ends(last: DataFrame) -> DataFrame:
    """(node, depth, ends_sha256) of ``last`` (node, depth, conv): the SHA-256 of each node's ascending ids, joined by commas."""
    order = ["node", "depth", "conv"]
    texts = last.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_texts, "node long, depth long, first long, ids string")
    texts = texts.repartition("node", "depth").sortWithinPartitions("node", "depth", "first")
    return texts.mapInArrow(_hashes, "node long, depth long, ends_sha256 string")


def prefix_trie(rows: DataFrame) -> DataFrame:
    """A row for each node of the trie of the rebuilt conversations of ``rows`` (conv_id, turn, role, text): conv_id, depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Defined results: null roles and texts are empty, null turns come first, equal turns are ordered by a digest of role and
    text, repeated rows are turns of their own; rows without conv_id take no part; conversations without rebuilt turns end in
    the root; negative ids belong to the family of their remainder (-7 to that of 0); texts of any length are hashed whole;
    other columns are not read; an empty table has no nodes, not even a root.
    """
    convs, turns = rebuilt(cut(ordered_turns(rows)))
    convs = cut(convs)
    longest, n_convs, least = convs.agg(F.max("size"), F.count("*"), F.min("conv")).first()
    bits = int(longest or 0).bit_length()
    if bits:
        paths = names(cut(blocks(turns, convs, bits)), bits)
    else:
        paths = rows.sparkSession.createDataFrame([], "conv long, depth long, node long, members long, words long")
    # Each step of a conversation with the node before it.
    up = paths.select("conv", (F.col("depth") + 1).alias("depth"), F.col("node").alias("parent"))
    paths = cut(paths.join(up, ["conv", "depth"], "left").join(convs, "conv"))
    # A node's own row is that of the conversation that names it.
    nodes = paths.where("conv = node").select("node", "depth", F.coalesce("parent", F.lit(least)).alias("parent"), "members", "words")
    children = nodes.groupBy(F.col("parent").alias("node"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("n_children"))
    nodes = cut(nodes.join(children, ["node", "depth"], "left").withColumn("n_children", _at_zero("n_children")))
    own = nodes.select("node", "depth", "parent", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("n_leaves"), ((F.col("members") - 1) * F.col("words")).alias("saved_tokens"))
    sums = cut(totals(paths, own, bits))
    last = paths.where("depth = size").select("node", "depth", "conv")
    sha = ends(last.unionByName(convs.where("size = 0").select(F.lit(least).cast("long").alias("node"), F.lit(0).cast("long").alias("depth"), "conv")))
    empty = hashlib.sha256().hexdigest()
    below = nodes.join(sums, ["node", "depth"])
    top = sums.where("depth = 1").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    top = top.select(
        F.lit(least).cast("long").alias("node"), F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent"), F.lit(n_convs).cast("long").alias("members"),
        F.coalesce("n_leaves", F.lit(1)).alias("n_leaves"), _at_zero("saved_tokens").alias("saved_tokens"),
    ).where(F.col("node").isNotNull())
    top = top.join(children.where("depth = 0").select("depth", "n_children"), "depth", "left").withColumn("n_children", _at_zero("n_children"))
    columns = ["node", "depth", "parent", "members", "n_children", "n_leaves", "saved_tokens"]
    out = below.select(columns).unionByName(top.select(columns)).join(sha, ["node", "depth"], "left")
    return out.select(
        F.col("node").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("members").alias("n_convs"), "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256")
    )


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


_CRC = "xor(list_reduce(flatten([[ascii(ch), -1, -1, -1, -1, -1, -1, -1, -1] FOR ch IN string_split(c::VARCHAR, '')]), lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END, 4294967295::BIGINT), 4294967295)"

ORACLE_SQL = rf"""
WITH t AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS p FROM conversations WHERE conv_id IS NOT NULL),
k AS (SELECT c, c - c % {FAMILY} AS b, {_CRC} % {HEADS} AS h, own, coalesce(has, 0) AS has FROM (SELECT c, max(p) AS own FROM t GROUP BY 1) LEFT JOIN (SELECT c AS f, max(p) AS has FROM t GROUP BY 1) ON f = c - c % {FAMILY}),
r AS (SELECT k.c, t.p AS d, t.role, t.text FROM k JOIN t ON t.c = k.b AND t.p <= k.h UNION ALL SELECT k.c, t.p - k.h + least(k.h, k.has), t.role, t.text FROM k JOIN t ON t.c = k.c AND t.p > k.h),
w AS (SELECT c, d, text, list({{'r': role, 't': text}}) OVER (PARTITION BY c ORDER BY d) AS prefix FROM r
 UNION ALL SELECT c, 0, '', [] FROM k),
z AS (SELECT c, d, min(c) OVER (PARTITION BY d, prefix) AS node, text, count(*) OVER (PARTITION BY d, prefix) AS n, d = max(d) OVER (PARTITION BY c) AS fin FROM w),
x AS (SELECT node, d, any_value(n) AS n, coalesce(any_value(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+'))), 0) AS words, coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (fin), '') AS ids FROM z GROUP BY 1, 2),
y AS (SELECT x.*, u.node AS parent FROM x LEFT JOIN z u ON u.c = x.node AND u.d = x.d - 1),
q AS (SELECT y.*, (SELECT count(*) FROM y v WHERE v.parent = y.node AND v.d = y.d + 1) AS kids FROM y),
s AS (SELECT u.node, u.d, sum((q.kids = 0)::INT)::BIGINT AS leaves, sum((q.n - 1) * q.words)::BIGINT AS saved FROM q JOIN z u ON u.c = q.node AND u.d <= q.d GROUP BY 1, 2)
SELECT q.node AS conv_id, q.d AS depth, q.parent AS parent_conv_id, q.n AS n_convs, q.kids AS n_children, s.leaves AS n_leaves, s.saved AS saved_tokens, sha256(q.ids) AS ends_sha256 FROM q JOIN s USING (node, d)
"""
