"""Operator 2: near duplicates by Order MinHash and banded alignment.

A text is its sequence of words; its k-mers are runs of five words, each labelled
with how often it occurred before in the text. For each of ROWS hash functions a
sketch keeps the LEAST least labelled k-mers in the order the text has them, so
two texts agree on a row when they share these k-mers and their order. Texts that
agree on a row are candidates. A candidate pair is a near duplicate when a banded
alignment of the words shows an edit similarity of 0.8 or more: words to insert,
delete or replace, at most a fifth of the longer text. The k-mers only propose.

A row is shared with a probability of about J ** LEAST, where J is the Jaccard
similarity of the labelled k-mers, so of 48 rows at least one is shared with a
probability of 0.996 or more at J = 0.57, 0.95 at J = 0.5 and 0.8 at J = 0.42.
A pair with an edit similarity of 0.8 may share few or no k-mers when its edits
are spread evenly; such a pair is not proposed.

Copies of one word sequence are one node, so copies make no pairs. In a row's
bucket every node is compared with the one that shares buckets with the most
others; afterwards nodes of a bucket that are still in different classes are
compared with each other. Two safe bounds
spare alignments: lengths, and prints. A print has a bit for whether an odd number
of labelled words fall on it. The words that one text has beyond the other are no
more than the edits, so prints that differ in too many bits rule a pair out with
certainty. Buckets are dealt by length class as well, since texts of
other lengths cannot be near. Classes are connected components. Nothing is capped;
the largest buckets are split by Spark as skewed joins.

Defined results: texts without words (null, empty, blank) are alone, each its own
class with kept true; a text of fewer than five words has one k-mer, all its
words; class_id is the least doc_id of the class, null ids last; of a class
exactly one row is kept, one with the least id, also among equal rows; texts of
any length are read whole; columns besides doc_id and text are not read and may
have any name; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import WORD, cut, fresh, slices, small, small_batches, table

K = 5
#: Sketch rows, and how many least k-mers each keeps in text order.
ROWS, LEAST = 48, 4
SIMILARITY = 0.8
FACTORS = np.random.Generator(np.random.PCG64(5)).integers(1, 1 << 63, ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
ADDENDS = np.random.Generator(np.random.PCG64(6)).integers(0, 1 << 63, ROWS, dtype=np.uint64)
#: A row looks for a text's least k-mers among about this many first, and among all only where these are too few.
SOME = 16
#: Bytes of the texts of some pairs, up to which they are broadcast.
SMALL_BYTES = 16 << 20
#: Bits of a print.
PRINT = 2048
GOLD = np.uint64(0x9E3779B97F4A7C15)
TOP = np.uint64(0xFFFFFFFFFFFFFFFF)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 400_000:
            self.clear()
        value = self[word] = xxhash.xxh32_intdigest(word)
        return value


def word_hashes(text: bytes, hashes: WordHashes) -> np.ndarray:
    """Hashes of the words: bytes.split() parts at ASCII white space, as ``WORD`` does."""
    return np.array([hashes[w] for w in text.split()], np.uint32)


def labelled(h: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Hashes of (h, how often h occurred before among its owner's); owners ascend."""
    order = np.lexsort((h, owner))  # stable
    sh, so, n = h[order], owner[order], len(h)
    new = np.concatenate(([True], (sh[1:] != sh[:-1]) | (so[1:] != so[:-1]))) if n else np.zeros(0, bool)
    start = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    label = np.empty(n, np.uint64)
    label[order] = (np.arange(n) - start).astype(np.uint64)
    h = (h + label * np.uint64(0xD6E8FEB86659FD93)) * GOLD
    return h ^ (h >> np.uint64(32))


def labelled_words(words: np.ndarray, doc: np.ndarray) -> np.ndarray:
    return labelled(words.astype(np.uint64) * GOLD, doc)


def labelled_kmers(words: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Labelled k-mers of texts laid end to end (``doc`` numbers them, ascending), in text order, and their text's number."""
    sizes = np.bincount(doc) if len(doc) else np.zeros(0, int)
    h = np.zeros(len(words), np.uint64)
    w = words.astype(np.uint64)
    whole = np.zeros(len(words), bool)
    n = len(words)
    # A text shorter than K words hashes all of them at its first word.
    for j in range(K):
        part = np.zeros(n, np.uint64)
        if n > j:
            same = doc[j:] == doc[: n - j]
            part[: n - j] = np.where(same, w[j:] + np.uint64(1), np.uint64(0))
            if j == K - 1:
                whole[: n - j] = same
        h = (h ^ part) * GOLD
        h ^= h >> np.uint64(29)
    first = np.concatenate(([True], doc[1:] != doc[:-1])) if n else np.zeros(0, bool)
    keep = whole | (first & (sizes[doc] < K)) if n else whole
    return labelled(h[keep], doc[keep]), doc[keep]


def sketches(kmers: np.ndarray, owner: np.ndarray, count: int) -> np.ndarray:
    """(count, ROWS) sketch numbers of texts' labelled k-mers; texts without k-mers have zeros."""
    out = np.zeros((count, ROWS), np.uint64)
    if not len(kmers):
        return out
    sizes = np.bincount(owner, minlength=count)
    begin, some = np.cumsum(sizes) - sizes, np.flatnonzero(sizes)
    limit = np.where(sizes > SOME, TOP // np.maximum(sizes, 1).astype(np.uint64) * np.uint64(SOME), TOP)[owner]
    want = np.minimum(sizes, LEAST)
    rank, far = np.arange(LEAST), len(kmers)
    inside = rank < want[some][:, None]
    for r in range(ROWS):
        x = kmers * FACTORS[r] + ADDENDS[r]
        at = np.flatnonzero(x <= limit)
        have = np.bincount(owner[at], minlength=count)
        lack = np.flatnonzero(have < want)
        if len(lack):
            at = np.union1d(at, np.concatenate([np.arange(begin[i], begin[i] + sizes[i]) for i in lack]))
            have = np.bincount(owner[at], minlength=count)
        at = at[np.lexsort((x[at], owner[at]))]
        first = (np.cumsum(have) - have)[some]
        chosen = np.where(inside, at[np.minimum(first[:, None] + rank, len(at) - 1)], far)
        chosen.sort(axis=1)  # text order
        v = np.zeros(len(some), np.uint64)
        for j in range(LEAST):
            k = chosen[:, j]
            v = (v ^ np.where(k < far, kmers[np.minimum(k, far - 1)], np.uint64(0))) * GOLD
            v ^= v >> np.uint64(29)
        out[some, r] = v
    return out


def prints(words: np.ndarray, doc: np.ndarray, count: int) -> np.ndarray:
    """(count, PRINT / 64) longs. Shared labelled words cancel out in the exclusive or of two prints, each unshared one changes at most a bit."""
    at = doc * PRINT + (labelled_words(words, doc) % np.uint64(PRINT)).astype(np.int64)
    odd = (np.bincount(at, minlength=count * PRINT) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64).reshape(count, PRINT // 64)


def _lists(x: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)), pa.array(x.reshape(-1)))


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for b in batches:
        texts = b.column("text").cast(pa.binary()).to_pylist()
        for lo, hi in slices([len(t or b"") for t in texts], 2_000_000):
            split = [(t or b"").split() for t in texts[lo:hi]]
            nodes = [hashlib.md5(b" ".join(p)).digest() if p else None for p in split]
            sizes, n = np.array([len(p) for p in split]), hi - lo
            flat, doc = np.array([hashes[w] for p in split for w in p], np.uint32), np.repeat(np.arange(n), sizes)
            sketch = sketches(*labelled_kmers(flat, doc), n)
            band = ((sketch ^ (sketch >> np.uint64(31))) + np.arange(ROWS, dtype=np.uint64)) * GOLD
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c).slice(lo, n) for c in ("uid", "doc_id", "row_key")), pa.array(nodes, pa.binary()), _lists(band.view(np.int64)), _lists(prints(flat, doc, n)), pa.array(sizes.astype(np.int32))],
                ["uid", "doc_id", "row_key", "digest", "bands", "print", "n_words"],
            )


def trimmed(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both without their common beginning and end, the longer first."""
    n = min(len(a), len(b))
    lead = int(np.argmax(np.append(a[:n] != b[:n], True)))
    a, b = a[lead:], b[lead:]
    n = min(len(a), len(b))
    tail = int(np.argmax(np.append(a[::-1][:n] != b[::-1][:n], True)))
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    return (a, b) if len(a) >= len(b) else (b, a)


def edit_distances(pairs: list[tuple[np.ndarray, np.ndarray]], most: list[int], least: list[int] | None = None) -> np.ndarray:
    """Words to insert, delete or replace in each pair, by alignments in a band that widens; most + 1 where there are more.

    ``least`` are known lower bounds: a narrower band is not tried.
    """
    out = np.array(most) + 1
    short = [trimmed(a, b) for a, b in pairs]
    todo = [i for i, (a, b) in enumerate(short) if len(a) - len(b) <= most[i]]
    width = 16
    while todo:
        # Pairs of like length are aligned together, and many at once where the band is narrow.
        todo.sort(key=lambda i: len(short[i][0]))
        again = [i for i in todo if least and least[i] > width and width < most[i]]
        todo = [i for i in todo if not (least and least[i] > width and width < most[i])]
        size = max(1, 8192 // (2 * width + 1))
        for at in range(0, len(todo), size):
            part = todo[at : at + size]
            for i, d in zip(part, _banded([short[i] for i in part], width).tolist()):
                if d <= width or width >= most[i]:
                    out[i] = min(d, most[i] + 1)
                else:
                    again.append(i)
        todo, width = again, width * 4
    return out


def _banded(pairs: list[tuple[np.ndarray, np.ndarray]], width: int) -> np.ndarray:
    """Distances over paths within ``width`` of the diagonal: right where they are at most ``width``."""
    la, lb = (np.array([len(p[k]) for p in pairs]) for k in (0, 1))
    span, rows = np.arange(-width, width + 1, dtype=np.int32), int(la.max())
    far = np.int32(1 << 28)
    first = np.full((len(pairs), rows), -2, np.int64)
    other = np.full((len(pairs), rows + 2 * width + 2), -1, np.int64)
    for k, (a, b) in enumerate(pairs):
        first[k, : len(a)] = a
        n = min(len(b), rows + width + 2)
        other[k, width : width + n] = b[:n]
    ends = lb[:, None].astype(np.int32)
    row = np.where((span >= 0) & (span <= ends), span, far).astype(np.int32)
    at = lb - la + width
    inside = (at >= 0) & (at < len(span))
    out = np.where(la == 0, lb, far).astype(np.int64)
    edge = np.full((len(pairs), 1), far, np.int32)
    for i in range(1, rows + 1):
        best = row + (other[:, i - 1 : i - 1 + len(span)] != first[:, i - 1 : i])  # from (i-1, j-1)
        np.minimum(best, np.concatenate([row[:, 1:], edge], axis=1) + 1, out=best)  # from (i-1, j)
        if i <= width:
            best[:, width - i] = i
            best[:, : width - i] = far
        beyond = span + i > ends
        best[beyond] = far
        row = np.minimum.accumulate(best - span, axis=1) + span  # from (i, j-1)
        row[beyond] = far
        np.minimum(row, far, out=row)
        done = np.flatnonzero((la == i) & inside)
        out[done] = row[done, at[done]]
    return out


def similar_pairs(left: list[np.ndarray], right: list[np.ndarray], least: float = SIMILARITY) -> np.ndarray:
    """Which pairs of word sequences are near duplicates: an edit similarity of ``least`` or more."""
    n, texts = len(left), [*left, *right]
    sizes = np.array([len(t) for t in texts])
    most = ((1 - least) * np.maximum(sizes[:n], sizes[n:]) + 1e-9).astype(int)
    words = labelled_words(np.concatenate(texts), np.repeat(np.arange(2 * n), sizes))
    ends = np.cumsum(sizes)
    own = [words[e - s : e] for e, s in zip(ends.tolist(), sizes.tolist())]
    # Words that the other text lacks, copies counted, are no more than the edits.
    lack = np.array([max(len(x), len(y)) - len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(own[:n], own[n:])])
    some, good = np.flatnonzero(lack <= most).tolist(), np.zeros(n, bool)
    if some:
        good[some] = edit_distances([(left[i], right[i]) for i in some], most[some].tolist(), lack[some].tolist()) <= most[some]
    return good


def similar(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> bool:
    return bool(similar_pairs([a], [b], least)[0])


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for b in batches:
        left, right = (b.column(c).cast(pa.binary()).to_pylist() for c in ("text_a", "text_b"))
        good = [np.zeros(0, bool)]
        for lo, hi in slices([len(x) + len(y) for x, y in zip(left, right)], 2_000_000):
            good.append(similar_pairs([word_hashes(t, hashes) for t in left[lo:hi]], [word_hashes(t, hashes) for t in right[lo:hi]]))
        yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), pa.array(np.concatenate(good))], ["a", "b", "good"])


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the undirected ``edges`` (a, b): the least node it is connected to.

    Alternating star contraction: neighbours hang themselves under the least node of each neighbourhood until
    nothing changes. Each round is two aggregations and joins; rounds grow with the logarithm of the size.
    """
    edges = cut(edges.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).where("u < v").distinct())
    print_of = lambda e: tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    state = print_of(edges)
    while True:
        # Few edges in many partitions are many small files: no more partitions than the edges fill.
        fit = lambda e, n=1 + state[0] // 50_000: e.coalesce(n)
        edges = fit(edges)
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = fit(fit(both.where("v > u").join(low, "u").select(F.col("m").alias("u"), "v").where("u < v")).distinct())
        low = large.groupBy("v").agg(F.min("u").alias("m"))
        small = fit(large.join(low, "v"))
        edges = cut(fit(small.select(F.col("m").alias("u"), "v").unionByName(small.where("u != m").select(F.col("m").alias("u"), F.col("u").alias("v"))).where("u < v").distinct()))
        now = print_of(edges)
        if now == state:
            break
        state = now
    leaves = edges.select(F.col("v").alias("node"), F.col("u").alias("root"))
    return leaves.unionByName(edges.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct())


def _near(a: str = "a", b: str = "b") -> Column:
    """Whether lengths and prints of a pair allow the similarity."""
    longer, shorter = F.greatest(f"n_words_{a}", f"n_words_{b}"), F.least(f"n_words_{a}", f"n_words_{b}")
    differ = reduce(add, [F.bit_count(F.col(f"print_{a}")[i].bitwiseXOR(F.col(f"print_{b}")[i])) for i in range(PRINT // 64)])
    # The words that each text has beyond the other are no more than the edits; the two numbers differ by the lengths' difference.
    return (shorter >= SIMILARITY * longer - 1e-6) & (differ + longer - shorter <= 2 * (1 - SIMILARITY) * longer + 1e-6)


def _links(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Those of ``pairs`` (a, b) that are near duplicates.

    Many pairs of few texts, as within a large group, would move each text once for each of its pairs. So texts that together stay
    within SMALL_BYTES are broadcast; others are joined by shuffle.
    """
    used = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    used = cut(texts.join(used, "node", "left_semi"))
    size = used.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    side = F.broadcast if size <= SMALL_BYTES else lambda t: t
    left = side(used.select(F.col("node").alias("a"), F.col("text").alias("text_a")))
    right = side(used.select(F.col("node").alias("b"), F.col("text").alias("text_b")))
    # Pairs are dealt to all tasks, also where few of them fill few partitions.
    dealt = pairs.repartition("a", "b") if size <= SMALL_BYTES else pairs
    rows = small_batches(dealt.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b"))
    return rows.mapInArrow(_verify, "a long, b long, good boolean").where("good").select("a", "b")


def row_key() -> Column:
    """128 bits of a row's doc_id and text."""
    return F.unhex(F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.when(F.col("text").isNull(), "null").otherwise("text"), F.col("text")).cast("binary")))


def _bounded(pairs: DataFrame, facts: DataFrame) -> DataFrame:
    """Those of ``pairs`` (a, b) that their bounds allow."""
    for side in ("a", "b"):
        pairs = pairs.join(facts.select(F.col("node").alias(side), F.col("print").alias(f"print_{side}"), F.col("n_words").alias(f"n_words_{side}")), side)
    return pairs.where(_near()).select("a", "b")


def _ordered(x: str, y: str) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _merged(found: DataFrame, links: DataFrame) -> DataFrame:
    """``found`` (node, root) after ``links`` (a, b) joined classes: only their roots are nodes of the components sought."""
    root = lambda side: found.select(F.col("node").alias(side), F.col("root").alias(f"root_{side}"))
    edges = links.join(root("a"), "a").join(root("b"), "b").select(F.col("root_a").alias("a"), F.col("root_b").alias("b")).where("a != b")
    new = components(edges).select(F.col("node").alias("root"), F.col("root").alias("new"))
    return found.join(new, "root", "left").select("node", F.coalesce("new", "root").alias("root"))


def _open_pairs(members: DataFrame, facts: DataFrame, found: DataFrame) -> DataFrame:
    """Pairs (a, b) of nodes that share a bucket, are in different classes and may be near by their bounds.

    ``members`` has (band, node), ``facts`` the node's bands as well. A node meets those of its bucket and length
    class, and the longer ones of the next class. A pair that shares several buckets comes out of the first alone.
    """
    placed = members.join(found, "node")
    split = placed.groupBy("band").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo != hi").select("band")
    placed = placed.join(split, "band").join(facts, "node")
    grade = F.floor(F.log("n_words") / F.log(F.lit(1 / SIMILARITY)) + 1e-9).cast("int")
    names = ["node", "root", "n_words", "print", "bands"]
    x = placed.select("band", F.explode(F.array(grade, grade + 1)).alias("grade"), *[F.col(c).alias(f"{c}_a") for c in names])
    y = placed.select("band", grade.alias("grade"), *[F.col(c).alias(f"{c}_b") for c in names])
    below = (F.col("n_words_a") < F.col("n_words_b")) | ((F.col("n_words_a") == F.col("n_words_b")) & (F.col("node_a") < F.col("node_b")))
    same = (x["band"] == y["band"]) & (x["grade"] == y["grade"]) & (F.col("root_a") != F.col("root_b")) & below & _near()
    # All buckets that hold nodes of two classes are open, so the first one that a pair shares is.
    first = x["band"] == F.array_min(F.array_intersect("bands_a", "bands_b"))
    return x.join(y, same & first).select(*_ordered("node_a", "node_b"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """row_key (of id and text), doc_id, class_id and kept for every row of ``docs`` (doc_id, text).

    Texts are read once for the sketches and once more for the nodes that share a bucket; only the latter are moved.
    """
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("row_key", row_key())
    schema = "uid long, doc_id long, row_key binary, digest binary, bands array<long>, print array<long>, n_words int"
    rows = cut(small_batches(keyed.withColumn("uid", F.monotonically_increasing_id())).mapInArrow(_sketch, schema))
    # A node is one word sequence; it goes by the least uid of its rows.
    nodes = rows.where(F.col("digest").isNotNull()).groupBy("digest").agg(F.min(F.struct("uid", "row_key", "bands", "print", "n_words")).alias("r")).select("digest", F.col("r.uid").alias("node"), "r.row_key", "r.bands", "r.print", "r.n_words")
    # What is dealt by band is only the node; facts on nodes are kept once each.
    members = nodes.select("node", F.explode("bands").alias("band"))
    shared = members.groupBy("band").agg(F.count("*").alias("size")).where("size > 1")
    shared = cut(members.join(shared, "band"))
    # Of buckets that hold the same nodes (128 bits tell) one is enough.
    who = shared.groupBy("band", "size").agg(*[F.bit_xor(F.xxhash64(F.lit(i), "node")).alias(f"who{i}") for i in (0, 1)])
    shared = cut(shared.join(who.groupBy("size", "who0", "who1").agg(F.min("band").alias("band")).select("band"), "band"))
    # The text from which others were made lies in the largest buckets: compare with it first.
    weight = cut(shared.groupBy("node").agg(F.sum("size").alias("weight"), F.collect_list("band").alias("bands")))
    center = shared.select("band", "node").join(weight.select("node", "weight"), "node").groupBy("band").agg(F.max(F.struct("weight", F.xxhash64("band", "node").alias("h"), "node")).alias("c"))
    grouped = shared.select("band", "node")
    facts = cut(nodes.drop("bands").join(small(weight.select("node", "bands")), "node").select("digest", "node", "row_key", "print", "n_words", "bands"))
    texts = cut(keyed.select("row_key", "text").join(small(facts.select("node", "row_key")), "row_key").groupBy("node").agg(F.first("text").alias("text")))
    facts, names = facts.select("node", "print", "n_words", "bands"), facts.select("digest", "node")

    star = grouped.join(center.select("band", F.col("c.weight").alias("weight"), F.col("c.node").alias("other")), "band").where("node != other")
    star = cut(star.groupBy("node", "other").agg(F.max("weight").alias("weight")))
    found = names.select("node", F.col("node").alias("root"))
    # First with the heaviest center a node has, one pair a node; then with those that are still in another class.
    best = star.groupBy("node").agg(F.max(F.struct("weight", "other")).alias("c")).select(*_ordered("node", "c.other")).distinct()
    tried = cut(_bounded(best, facts))
    found = cut(_merged(found, cut(_links(tried, texts))))
    root = lambda c: found.select(F.col("node").alias(c), F.col("root").alias(f"root_{c}"))
    apart = star.join(root("node"), "node").join(root("other"), "other").where("root_node != root_other").select(*_ordered("node", "other")).distinct()
    more = cut(_bounded(apart.join(tried, ["a", "b"], "left_anti"), facts))
    links = cut(_links(more, texts))
    if not links.isEmpty():
        found = cut(_merged(found, links))
    # Last, all nodes of a bucket that are still in different classes. Classes only grow, so this leaves no pair for another turn.
    rest = cut(_open_pairs(grouped, facts, found).join(tried.unionByName(more), ["a", "b"], "left_anti"))
    links = cut(_links(rest, texts))
    if not links.isEmpty():
        found = cut(_merged(found, links))
    # A node that no link reaches is a class of its own.
    linked = names.join(found, "node").select("digest", "root")
    ids = rows.select("uid", "doc_id", "digest", "row_key").join(linked, "digest", "left")
    ids = ids.withColumn("class", F.coalesce(F.concat(F.lit("node "), F.col("root").cast("string")), F.hex("digest")))
    least = ids.where(F.col("class").isNotNull()).groupBy("class").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_key", "uid")).alias("best"))
    out = ids.join(least, "class", "left")
    alone = F.col("class").isNull()
    return out.select("row_key", "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("class_id"), (alone | (F.col("uid") == F.col("best.uid"))).alias("kept"))


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each class of near duplicates, all columns as they are; rows without words all stay.

    Rows alike in id and text meet in partial aggregates first, so many equal rows are no hot key.
    """
    key, row = fresh("row_key", docs.columns), fresh("row", docs.columns)
    kept = near_duplicates(docs).where("kept").select(F.col("row_key").alias(key)).distinct()
    worded = F.coalesce(F.col("text").rlike(WORD), F.lit(False))
    single = docs.where(worded).withColumn(key, row_key()).groupBy(key).agg(F.first(F.struct(*[F.col(f"`{c}`") for c in docs.columns])).alias(row))
    return single.join(kept, key, "left_semi").select(f"{row}.*").unionByName(docs.where(~worded))


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "kept")
