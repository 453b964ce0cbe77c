"""Operator 13: near-duplicate embeddings of one label by PCA-ordered tiled comparison.

Vectors are scaled to length one and turned onto the principal axes of all vectors of
their dimension (second moments added up in the tasks, d * d numbers each). Products
do not change by turning, but the leading coordinates hold as much of them as they
can. Two vectors are compared by their first coordinates; what the rest can add is at
most the product of the lengths of the rests (Cauchy-Schwarz), and a pair that cannot
reach the threshold any more is left there. The pairs that stay after the last step
are decided by the cosine of the original vectors in double precision.

Equal vectors of a label are one node with a count. The nodes of a label are sorted
along the first axis and cut into blocks of a bounded size; a task compares two
blocks of a label, tile by tile, unless their extents along the leading axes are too
far apart for any pair (distance and cosine of unit vectors tell each other). What
comes out is bounded by the rows of the two blocks, however many pairs link: for
each node the number of linked rows, and a spanning forest of the links found. Work
is that of all pairs within a label where no bound rules them out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import cut, small_batches, table
from .near_duplicates import components

SIMILARITY = 0.93
#: Numbers in a block, and the most rows: a task holds two blocks and what they become.
BLOCK_NUMBERS, BLOCK_ROWS = 1 << 18, 2048
#: Rows of a tile.
TILE = 512
#: Leading axes along which blocks have an extent.
AXES = 4
#: Rounding: bounds leave this much, and the cosine of the original vectors decides.
SLACK = 1e-9
#: Axes come from vectors of at most this dimension; longer ones are compared on the axes they have.
MOST_AXES = 2048


def usable(rows: DataFrame) -> DataFrame:
    """``rows`` (vec_id, embedding, label) as vec_id, v (double array or null), label: null, zero and non-finite vectors are null."""
    v = F.col("embedding").cast("array<double>")
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    zero = F.forall(v, lambda x: x == 0)
    # -0.0 is 0.0: equal vectors have equal bits.
    v = F.transform(v, lambda x: x + F.lit(0.0))
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.when(v.isNotNull() & ~odd & ~zero, v).alias("v"), F.col("label"))


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one; the largest number of a row goes out first, so squares neither overflow nor vanish."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def _by_dim(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    dims = batch.column("dim").to_numpy(zero_copy_only=False)
    for d in np.unique(dims).tolist():
        yield d, batch.filter(pa.array(dims == d))


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for b in batches:
        for d, part in _by_dim(b):
            u = unit(_matrix(part.column("v")))[:, :MOST_AXES]
            sums[d] = sums.get(d, 0) + u.T @ u
    for d, m in sums.items():
        for i, row in enumerate(m):
            yield pa.RecordBatch.from_pydict({"dim": [d], "row": [i], "sums": [row.tolist()]}, pa.schema([("dim", pa.int32()), ("row", pa.int32()), ("sums", pa.list_(pa.float64()))]))


def axes(nodes: DataFrame) -> dict[int, np.ndarray]:
    """For each dimension the principal axes as columns, those that hold most first. The driver gets d * d numbers, whatever the rows."""
    rows = small_batches(nodes.select("dim", "v")).mapInArrow(_moments, "dim int, row int, sums array<double>")
    rows = rows.select("dim", "row", F.posexplode("sums").alias("col", "x")).groupBy("dim", "row", "col").agg(F.sum("x").alias("x"))
    rows = rows.groupBy("dim", "row").agg(F.transform(F.array_sort(F.collect_list(F.struct("col", "x"))), lambda e: e["x"]).alias("sums"))
    out: dict[int, dict[int, list[float]]] = {}
    for r in rows.toLocalIterator():
        out.setdefault(r["dim"], {})[r["row"]] = r["sums"]
    return {d: np.linalg.eigh(np.array([m[i] for i in range(len(m))]))[1][:, ::-1] for d, m in out.items()}


def turned(u: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """``u`` on the axes; what lies beyond MOST_AXES numbers stays as it is, at the end."""
    k = len(basis)
    return np.concatenate([u[:, :k] @ basis, u[:, k:]], axis=1) if u.shape[1] > k else u @ basis


def steps(d: int) -> list[tuple[int, int]]:
    """Ranges of axes that are added one after the other, each as long as all before."""
    ends = [e for e in (8, 16, 32, 64, 128, 256, 512, 1024) if e < d] + [d]
    return list(zip([0, *ends[:-1]], ends))


def rests(y: np.ndarray) -> np.ndarray:
    """(rows, steps + 1): the length of what follows the axes of each step; the first is the whole."""
    squares = np.array([(y[:, a:b] ** 2).sum(axis=1) for a, b in steps(y.shape[1])])
    after = np.concatenate([np.cumsum(squares[::-1], axis=0)[::-1], np.zeros((1, len(y)))])
    return np.sqrt(after).T


class Block:
    """A block in a task: original vectors, coordinates and rests, and the vectors that are linked within."""

    def __init__(self, raw: bytes, d: int, basis: np.ndarray):
        self.x = np.frombuffer(raw, np.float64).reshape(-1, d)
        self.unit = unit(self.x)
        self.y = turned(self.unit, basis)
        self.rest = rests(self.y)

    def __len__(self) -> int:
        return len(self.x)


def linked(a: Block, b: Block, rows: slice, cols: slice, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row of a, row of b) of a tile whose cosine is ``least`` or more."""
    y, z, r, s = a.y[rows], b.y[cols], a.rest[rows], b.rest[cols]
    spans = steps(y.shape[1])
    lo, hi = spans[0]
    dots = y[:, lo:hi] @ z[:, lo:hi].T
    i, j = np.nonzero(dots + np.outer(r[:, 1], s[:, 1]) >= least - SLACK)
    for n, (lo, hi) in enumerate(spans[1:], 2):
        if not len(i):
            break
        if len(i) * 8 > dots.size:  # many are left: a product of the tile is cheaper than picking them
            dots = dots + y[:, lo:hi] @ z[:, lo:hi].T
            part = dots[i, j]
        else:
            part = dots[i, j] + np.einsum("ij,ij->i", y[i, lo:hi], z[j, lo:hi])
            dots[i, j] = part
        keep = part + r[i, n] * s[j, n] >= least - SLACK
        i, j = i[keep], j[keep]
    if len(i):
        exact = np.concatenate([np.einsum("ij,ij->i", a.unit[rows][i[k : k + 65536]], b.unit[cols][j[k : k + 65536]]) for k in range(0, len(i), 65536)])
        # Within rounding of the threshold the original numbers decide, without scaling first.
        for k in np.flatnonzero(np.abs(exact - least) < SLACK).tolist():
            p, q = a.x[rows][i[k]], b.x[cols][j[k]]
            exact[k] = cosine(p, q)
        keep = exact >= least
        i, j = i[keep], j[keep]
    return i + rows.start, j + cols.start


def cosine(p: np.ndarray, q: np.ndarray) -> float:
    p, q = p / np.abs(p).max(), q / np.abs(q).max()
    return float(p @ q / np.sqrt((p @ p) * (q @ q)))


class Forest:
    """Links as trees over numbered rows: an edge is kept where it joins two trees."""

    def __init__(self, n: int):
        self.up, self.edges = list(range(n)), []

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = x = self.up[self.up[x]]
        return x

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        for x, y in zip(i.tolist(), j.tolist()):
            p, q = self.root(x), self.root(y)
            if p != q:
                self.up[max(p, q)] = min(p, q)
                self.edges.append((x, y))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (key, dim, node, count, v, lead) as one row for each block: runs of a key, of bounded size."""
    schema = pa.schema([("key", pa.int64()), ("dim", pa.int32()), ("nodes", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())), ("x", pa.large_binary()), ("low", pa.list_(pa.float64())), ("high", pa.list_(pa.float64()))])
    have: list[pa.RecordBatch] = []

    def out() -> pa.RecordBatch:
        t = pa.Table.from_batches(have).combine_chunks().to_batches()[0]
        have.clear()
        lead = _matrix(t.column("lead"))
        row = {"key": [t.column("key")[0].as_py()], "dim": [t.column("dim")[0].as_py()], "nodes": [t.column("node").to_pylist()], "counts": [t.column("count").to_pylist()]}
        return pa.RecordBatch.from_pydict(row | {"x": [_matrix(t.column("v")).tobytes()], "low": [lead.min(axis=0).tolist()], "high": [lead.max(axis=0).tolist()]}, schema)

    for b in batches:
        keys = b.column("key").to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            part = b.slice(lo, hi - lo)
            if have and have[0].column("key")[0] != part.column("key")[0]:
                yield out()
            while part.num_rows:
                most = max(16, min(BLOCK_ROWS, BLOCK_NUMBERS // part.column("dim")[0].as_py()))
                room = most - sum(h.num_rows for h in have)
                if room:
                    have.append(part.slice(0, room))
                part = part.slice(room)
                if part.num_rows:
                    yield out()
    if have:
        yield out()


def links(nodes: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """(node, other, n): a row with ``other`` null gives the number n of linked rows that a pair of blocks found for a node, the others are links that hold its component together.

    ``nodes`` has node (long, distinct), label, count and v (double array).
    """
    spark = nodes.sparkSession
    nodes = nodes.withColumns({"dim": F.size("v"), "key": F.xxhash64("label", F.size("v"))})
    shared = spark.sparkContext.broadcast(axes(nodes))

    def leading(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for d, part in _by_dim(b):
                y = turned(unit(_matrix(part.column("v"))), shared.value[d])[:, :AXES]
                y = np.pad(y, ((0, 0), (0, AXES - y.shape[1])))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("key", "dim", "node", "count", "v")), pa.ListArray.from_arrays(pa.array(np.arange(0, y.size + 1, AXES, dtype=np.int32)), pa.array(y.reshape(-1)))], ["key", "dim", "node", "count", "v", "lead"])

    kinds = "key long, dim int, node long, count long, v array<double>"
    order = ["key", F.col("lead")[0], "node"]
    led = small_batches(nodes.select("key", "dim", "node", "count", "v")).mapInArrow(leading, f"{kinds}, lead array<double>")
    blocks = led.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_blocks, "key long, dim int, nodes array<long>, counts array<long>, x binary, low array<double>, high array<double>")
    blocks = cut(blocks.withColumn("block", F.monotonically_increasing_id()))
    # Blocks whose extents are farther apart than two linked unit vectors can be have no link.
    facts = blocks.select("key", "block", "low", "high")
    a, b = (facts.select("key", *[F.col(c).alias(f"{c}_{s}") for c in ("block", "low", "high")]) for s in "ab")
    gap = F.aggregate(F.sequence(F.lit(0), F.lit(AXES - 1)), F.lit(0.0), lambda acc, i: acc + F.pow(F.greatest(F.get("low_a", i) - F.get("high_b", i), F.get("low_b", i) - F.get("high_a", i), F.lit(0.0)), F.lit(2.0)))
    pairs = a.join(b, "key").where((F.col("block_a") <= F.col("block_b")) & (gap <= 2 * (1 - least) + SLACK)).select("block_a", "block_b")
    side = lambda s: blocks.select(F.col("block").alias(f"block_{s}"), *([F.col("dim")] if s == "a" else []), *[F.col(c).alias(f"{c}_{s}") for c in ("nodes", "counts", "x")])
    joined = pairs.join(side("a"), "block_a").join(side("b"), "block_b")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                row = {c: batch.column(c)[r].as_py() for c in batch.schema.names}
                d, same = row["dim"], row["block_a"] == row["block_b"]
                a = Block(row["x_a"], d, shared.value[d])
                b = a if same else Block(row["x_b"], d, shared.value[d])
                weights = [np.array(row[f"counts_{s}"], np.int64) for s in "ab"]
                sums = [np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)]
                forest, shift = Forest(len(a) if same else len(a) + len(b)), 0 if same else len(a)
                for i0 in range(0, len(a), TILE):
                    for j0 in range(i0 if same else 0, len(b), TILE):
                        i, j = linked(a, b, slice(i0, min(i0 + TILE, len(a))), slice(j0, min(j0 + TILE, len(b))), least)
                        if same and i0 == j0:
                            i, j = i[i < j], j[i < j]
                        sums[0] += np.bincount(i, weights=weights[1][j], minlength=len(a)).astype(np.int64)
                        sums[1] += np.bincount(j, weights=weights[0][i], minlength=len(b)).astype(np.int64)
                        forest.add(i, j + shift)
                nodes = np.array(row["nodes_a"] if same else row["nodes_a"] + row["nodes_b"], np.int64)
                total = sums[0] + sums[1] if same else np.concatenate(sums)
                some = np.flatnonzero(total)
                edges = np.array(forest.edges, np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([nodes[some], nodes[edges[:, 0]]])), pa.array([*[None] * len(some), *nodes[edges[:, 1]].tolist()], pa.int64()), pa.array(np.concatenate([total[some], np.zeros(len(edges), np.int64)]))],
                    ["node", "other", "n"],
                )

    # A pair of blocks is a large row: few are handed to a task at once.
    joined.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    return joined.mapInArrow(compare, "node long, other long, n long")


def near_vectors(rows: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """vec_id, n_links, component_id and kept for each row of ``rows`` (vec_id, embedding, label).

    Defined results: null, zero and non-finite vectors and rows without label have no links and are kept, each its own
    component; vectors of different dimension have no links; repeated rows, also those that share an id, are vectors of
    their own that link; null ids come last in a component (component_id is null and kept true where it has no other id);
    of vectors that share the least id all are kept; other columns are not read; an empty table gives no rows.
    """
    all_ = usable(rows).withColumn("uid", F.monotonically_increasing_id())
    all_ = cut(all_.withColumn("print", F.when(F.col("v").isNotNull() & F.col("label").isNotNull(), F.sha2(F.concat_ws(",", F.col("label").cast("string"), F.col("v").cast("array<string>")), 256))))
    # Equal vectors of a label: counted before they are moved, the vector goes with one of them.
    nodes = all_.where("print IS NOT NULL").groupBy("print").agg(F.min("uid").alias("node"), F.count("*").alias("count"), F.min("vec_id").alias("least"))
    nodes = cut(nodes)
    vectors = nodes.join(all_.select(F.col("uid").alias("node"), "label", "v"), "node").select("node", "label", "count", "v")
    found = cut(links(vectors, least))
    counts = found.where("other IS NULL").groupBy("node").agg(F.sum("n").alias("n"))
    joined = components(found.where("other IS NOT NULL").select(F.col("node").alias("a"), F.col("other").alias("b")))
    nodes = nodes.join(counts, "node", "left").join(joined, "node", "left").withColumn("root", F.coalesce("root", "node"))
    nodes = cut(nodes.select("print", "count", "least", "root", F.coalesce("n", F.lit(0)).alias("n")))
    ids = nodes.groupBy("root").agg(F.min("least").alias("component_id"))
    facts = nodes.join(ids, "root").select("print", (F.col("n") + F.col("count") - 1).cast("long").alias("n_links"), "component_id")
    linked_ = all_.where("print IS NOT NULL").select("vec_id", "print").join(facts, "print").select("vec_id", "n_links", "component_id")
    alone = all_.where("print IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked_.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op13_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


ORACLE_SQL = f"""
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings),
 u AS (SELECT * FROM v WHERE label IS NOT NULL AND x IS NOT NULL AND len(list_filter(x, lambda y: y IS NULL OR NOT isfinite(y))) = 0 AND len(list_filter(x, lambda y: y != 0)) > 0),
 l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND a.vec_id != b.vec_id AND len(a.x) = len(b.x) AND list_cosine_similarity(a.x, b.x) >= {SIMILARITY}),
 r(a, b) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
 c AS (SELECT a AS vec_id, min(b) AS component_id FROM r GROUP BY 1)
SELECT c.vec_id, (SELECT count(*) FROM l WHERE l.a = c.vec_id) AS n_links, component_id, c.vec_id = component_id AS kept FROM c
"""
