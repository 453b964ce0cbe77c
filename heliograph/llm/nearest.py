"""Operator 1: approximate nearest neighbours by collision-counting hashing.

A hash function is a set of pivots, drawn from the vectors: a vector falls into the cell
of the pivot it is nearest to. A query opens in every function the cells of its nearest
pivots and counts in how many functions each vector is met; opening twice as many cells
repeats the count at the next radius without other hash tables (virtual rehashing). A
vector met in ``threshold`` functions is verified: its distance is computed on the
original numbers. Cells are chosen by the query where vectors are few, so a far vector
is met in few functions.

Radius and threshold are fitted in each block on a bounded sample of its rows: of all
radii and thresholds that find the share ``recall`` of the sample's true neighbours
(brute force, weighted by the chance that a neighbour in the block is one of all blocks),
the cheapest is taken. A query that meets fewer than k vectors lowers its threshold,
then widens its radius; the last one holds every vector. A query whose k-th best is
farther than that of all of the sample is none the fit holds for, and goes to the last.

Vectors are dealt into blocks by a hash, so many equal vectors spread over all
blocks; queries go in blocks too, and a task holds one block of each. Equal vectors of a
block are one node. Each task leaves at most k rows a query, and the k best of all tasks
are the answer. Hashing is in proportion to the vectors and is most of the work up to
about a million; counting and verifying a few hundredths of the vectors for every
query grows with vectors times queries, so larger query blocks have more and finer cells.

Defined results: vectors that are null, zero, or hold null or non-finite numbers
take no part, nor those with a null id or another length than the commonest (of
equally common lengths the shortest); every row is a candidate, also one of several
with one id, and a query's own row alone is none; rows that are queries with one id
each have their ranks; ties go to the smaller id; columns besides the id and the
vector are not read and may have any name; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .common import cut, table

#: Hash functions, and the cells that a query opens in each at the radii that are fitted.
FUNCTIONS, RADII = 64, (1, 2, 4, 8)
#: Cells of a function (more for large query blocks), and the vectors of a cell at least.
CELLS, CELL_ROWS = 128, 16
#: Rows of a block on which radius and threshold are fitted, and the share of their neighbours to be found.
SAMPLE, RECALL = 96, 0.97
#: A block of this many vectors (64 doubles each: 16 MB, and as much again for its lists) and a block of queries fit one task.
BLOCK_ROWS, QUERY_ROWS = 32768, 16384
#: Numbers of a block of vectors at most: those of more than 128 numbers make blocks of fewer rows.
BLOCK_NUMBERS = 1 << 22


def usable(rows: DataFrame, vector: str = "embedding", id_col: str = "vec_id") -> DataFrame:
    """Rows (vec_id, v) that take part."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = rows.where(F.col(id_col).isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0))
    return good.select(F.col(id_col).cast("long").alias("vec_id"), v.cast("array<double>").alias("v"))


class Cells:
    """Hash functions over the distinct vectors of a block: pivots, and the vectors of each cell."""

    def __init__(self, vectors: np.ndarray, pivots_from: np.ndarray, functions: int, cells: int, rng: np.random.Generator):
        # Hashing works on single numbers around the middle, of size 2 at most; distances are not taken from them.
        self.scale = np.abs(vectors).max() or 1.0
        self.middle = np.median(vectors / self.scale, axis=0)
        self.x, self.n, self.cells = self.small(vectors), len(vectors), cells
        self.squares = (self.x * self.x).sum(axis=1)
        self.pivots, self.members, self.starts = [], [], []
        for _ in range(functions):
            p = self.x[rng.choice(pivots_from, cells, replace=False)]
            self.pivots.append((p.T.copy(), (p * p).sum(axis=1) / 2))
            cell = np.argmax(self.nearness(self.x, -1), axis=1).astype(np.uint16)
            self.members.append(np.argsort(cell, kind="stable"))
            self.starts.append([0, *np.cumsum(np.bincount(cell, minlength=cells)).tolist()])

    def small(self, vectors: np.ndarray) -> np.ndarray:
        return (vectors / self.scale - self.middle).astype(np.float32)

    def nearness(self, x: np.ndarray, function: int) -> np.ndarray:
        """(rows, cells): larger for pivots that are nearer."""
        p, half = self.pivots[function]
        return x @ p - half

    def opened(self, x: np.ndarray, radius: int) -> np.ndarray:
        """(functions, rows, radius): the cells of the nearest pivots, the nearest first."""
        if radius >= self.cells:
            return np.broadcast_to(np.arange(self.cells), (len(self.pivots), len(x), self.cells))
        out, rows = np.empty((len(self.pivots), len(x), radius), np.int64), np.arange(len(x))
        for f in range(len(self.pivots)):
            near = self.nearness(x, f)
            for r in range(radius):  # few: cheaper than a partition of each row
                out[f, :, r] = near.argmax(axis=1)
                near[rows, out[f, :, r]] = -np.inf
        return out

    def ordered(self, x: np.ndarray) -> np.ndarray:
        """(functions, rows, cells): all cells, that of the nearest pivot first."""
        return np.stack([np.argsort(-self.nearness(x, f), axis=1, kind="stable") for f in range(len(self.pivots))])

    def met(self, cells: np.ndarray) -> np.ndarray:
        """In how many functions each vector lies in the open ``cells`` (functions, cells)."""
        parts = [m[s[c] : s[c + 1]] for m, s, row in zip(self.members, self.starts, cells.tolist()) for c in row]
        return np.bincount(np.concatenate(parts), minlength=self.n)

    def screened(self, found: np.ndarray, q: np.ndarray, most: int) -> np.ndarray:
        """``found`` without what is certainly farther from ``q`` than ``most`` others: rounding of the single numbers is allowed for."""
        if len(found) <= most:
            return found
        about = self.squares[found] - 2 * (self.x.take(found, axis=0) @ q)
        return found[about <= np.partition(about, most - 1)[most - 1] + 2 * self.doubt(float(q @ q))]

    def doubt(self, square: float) -> float:
        """The most that a squared distance from a vector of this square is off by rounding."""
        d, size = self.x.shape[1], float(self.squares.max()) + square
        return 4 * (d + 4) * 2.0**-24 * size + 1e-14 * d * math.sqrt(size) + 1e-30 * d


def fitted(index: Cells, sample: np.ndarray, k: int, blocks: int, recall: float) -> tuple[int, int, float]:
    """Radius and threshold that find the share ``recall`` of the sample's neighbours with least work (all cells, where none does), and the largest distance of a k-th neighbour in the sample."""
    k = min(k, index.n - 1)
    # The chance that the j-th nearest of a block is one of the k nearest of all blocks, as rows are dealt by a hash.
    share = [math.comb(k, j) * blocks**-j * (1 - 1 / blocks) ** (k - j) for j in range(k + 1)]
    weight = np.cumsum(share[::-1])[::-1][1:]
    functions = len(index.pivots)
    products = index.x @ index.x[sample].T
    cells, radii = index.ordered(index.x[sample]), [r for r in RADII if r < index.cells]
    reach, verified, found, counted = 0.0, np.zeros((len(radii), functions + 1)), np.zeros((len(radii), functions + 1)), np.zeros(len(radii))
    for n, row in enumerate(sample.tolist()):
        d = index.squares - 2 * products[:, n]
        d[row] = np.inf
        near = np.argpartition(d, k - 1)[:k]
        near = near[np.argsort(d[near], kind="stable")]
        reach = max(reach, float(d[near[-1]] + index.squares[row]) + index.doubt(float(index.squares[row])))
        met, before = np.zeros(index.n, np.int64), 0
        for i, radius in enumerate(radii):
            met += index.met(cells[:, n, before:radius])
            before = radius
            counted[i] += met.sum()
            verified[i] += np.bincount(met, minlength=functions + 1)[::-1].cumsum()[::-1]
            found[i] += np.bincount(met[near], weights=weight, minlength=functions + 1)[::-1].cumsum()[::-1]
    # In units of one count: a cell opened is some 50, a vector of 64 numbers to verify some 25.
    cost = counted[:, None] / len(sample) + 50 * functions * np.array(radii)[:, None] + verified / len(sample) * 25 * max(1, index.x.shape[1] / 64)
    cost[found < recall * weight.sum() * len(sample)] = np.inf
    cost[:, 0] = np.inf
    if not len(radii) or np.isinf(cost).all():
        return index.cells, functions, math.inf
    i, threshold = np.unravel_index(np.argmin(cost), cost.shape)
    return radii[i], int(threshold), math.sqrt(reach) * float(index.scale)


def search_block(
    rows: np.ndarray, ids: np.ndarray, vectors: np.ndarray, query_rows: np.ndarray, queries: np.ndarray,
    k: int, seed: int = 7, blocks: int = 1, functions: int = FUNCTIONS, recall: float = RECALL, work: dict[str, int] | None = None,
) -> list[tuple[int, int, float]]:
    """(query row, vector id, distance) of at most k vectors a query, by collision counting inside one of ``blocks``. Rows tell a query's own vector; ``work`` adds up what was verified."""
    # Equal vectors are one node; of its rows the k of least id can be wanted, and one more where a query's own is among them.
    order = np.lexsort((rows, ids))
    rows, ids, vectors = rows[order], ids[order], vectors[order] + 0.0
    _, first, node = np.unique(vectors.view(np.dtype((np.void, vectors.shape[1] * 8))).ravel(), return_index=True, return_inverse=True)
    by_node = np.argsort(node, kind="stable")
    starts = np.searchsorted(node[by_node], np.arange(len(first) + 1))
    held = np.minimum(np.diff(starts), k + 1)
    vectors = vectors[first]
    rng = np.random.Generator(np.random.PCG64(seed))
    n = len(vectors)
    sample = rng.choice(n, min(n, SAMPLE), replace=False)
    others = np.setdiff1d(np.arange(n), sample) if n >= 4 * SAMPLE else np.arange(n)
    index = Cells(vectors, others, functions, max(1, min(max(CELLS, int(2 * math.sqrt(len(queries)))), n // CELL_ROWS)), rng)
    radius, threshold, reach = fitted(index, sample, k, blocks, recall) if n > 1 else (index.cells, 1, math.inf)
    small = index.small(queries)
    cells = index.opened(small, radius)
    out: list[tuple[int, int, float]] = []
    mine = dict(zip(rows.tolist(), node.tolist()))

    def best(found: np.ndarray, q: np.ndarray, near: np.ndarray, q_row: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and distances of the k nearest rows of the nodes ``found``, without the query's own row."""
        # Nodes that are farther than k + 1 others have no row among the k best.
        found = index.screened(found, near, k + 1)
        d = np.sqrt(((vectors[found] - q) ** 2).sum(axis=1))
        picked = np.concatenate([by_node[starts[f] : starts[f] + held[f]] for f in found.tolist()])
        d = np.repeat(d, held[found])
        other = rows[picked] != q_row
        picked, d = picked[other], d[other]
        first = np.lexsort((ids[picked], d))[:k]
        return ids[picked[first]], d[first]

    for i, (q_row, q) in enumerate(zip(query_rows.tolist(), queries)):
        own = mine.get(q_row)
        want = min(k, len(rows) - (own is not None))
        met, wide, least = index.met(cells[:, i]), radius, threshold
        while True:
            found = np.flatnonzero(met >= least) if wide < index.cells else np.arange(n)
            if work is not None:
                work["verified"] = work.get("verified", 0) + len(found)
            got, d = best(found, q, small[i], q_row) if len(found) else (ids[:0], np.zeros(0))
            if wide >= index.cells or len(got) >= want and d[-1] <= reach:
                break
            if len(got) >= want:  # farther off than all of the sample, so the fit says nothing of it
                wide = index.cells
            elif least > 1:
                least -= 1
            else:
                wide = min(2 * wide, index.cells)
                met = index.met(index.ordered(small[i : i + 1])[:, 0, :wide])
        out += zip([q_row] * len(got), got.tolist(), d.tolist())
    return out


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    return np.concatenate([c.flatten().to_numpy() for c in column.chunks]).reshape(len(column), -1)


def nearest(vectors: DataFrame, is_query: Column, k: int = 10, block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS, seed: int = 7) -> DataFrame:
    """query_id, rank, vec_id and score (Euclidean distance) of the k nearest of rows (vec_id, v)."""
    vectors = cut(vectors.select("vec_id", "v", F.monotonically_increasing_id().alias("row")))
    length = vectors.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n"), F.count(F.when(is_query, 1)).alias("q")).orderBy(F.desc("n"), "dim").first()
    n, asked_for, dim = (length["n"], length["q"], length["dim"]) if length else (0, 0, 0)
    block_rows, query_rows = (max(1, min(x, BLOCK_NUMBERS // max(1, dim))) for x in (block_rows, query_rows))
    n_blocks, q_blocks = max(1, -(-n // block_rows)), max(1, -(-asked_for // query_rows))
    n_blocks = max(n_blocks, min(8, -(-n // 2048)))  # small tables: use more tasks than one
    deal = lambda parts, s: F.pmod(F.xxhash64(F.lit(s), "row"), F.lit(parts)).cast("int")
    every = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    same = vectors.where(F.size("v") == dim)
    held = same.withColumn("b", deal(n_blocks, 1)).withColumn("qb", every(q_blocks))
    asked = same.where(is_query).withColumn("qb", deal(q_blocks, 2)).withColumn("b", every(n_blocks))

    def one(left: pa.Table, right: pa.Table) -> pa.Table:
        rows: list = []
        if left.num_rows and right.num_rows:
            rows = search_block(left["row"].to_numpy(), left["vec_id"].to_numpy(), matrix(left["v"]), right["row"].to_numpy(), matrix(right["v"]), k, seed, n_blocks)
        return pa.table([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [[]] * 3, (pa.int64(), pa.int64(), pa.float64()))], ["query", "vec_id", "score"])

    local = held.groupBy("b", "qb").cogroup(asked.groupBy("b", "qb")).applyInArrow(one, "query long, vec_id long, score double")
    # Each task keeps the k best rows of a query before they move.
    rank = F.row_number().over(Window.partitionBy("query").orderBy("score", "vec_id"))
    best = local.withColumn("rank", rank).where(F.col("rank") <= k)
    return best.join(same.where(is_query).select(F.col("row").alias("query"), F.col("vec_id").alias("query_id")), "query").select("query_id", "rank", "vec_id", "score")


def op1_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(usable(table(spark, sf_dir, "embeddings")), F.col("vec_id") % 100 == 0)
