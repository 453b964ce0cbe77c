"""Operator 3: mix sources to target weights by Pareto order sampling.

Each source's target of words comes from its weight and is held to a number of
epochs; what a capped source cannot take goes to the others by weight. A source
that takes t of its S words takes floor(t / S) whole copies of each document for
certain. The rest is a sample without replacement with unequal probabilities: a
document's inclusion is proportional to its size (or to a weight that is given),
so that the words expected are the words that remain; documents whose inclusion
would reach 1 come first. Documents are ranked by random odds u / (1 - u) over the
odds of their inclusion, and taken in this order up to the words that remain; one
that does not fit is skipped, and the walk goes on to the end. Then, as long as it
brings the sum nearer, one document is taken in, out, or exchanged for another,
the best such move first.

No source is sorted in one task: the order is cut by sums over bins of the ranking
number, as many as the table's size asks for, and only the bin where the target
falls is ordered row by row, once for each document that does not fit and would
have before. Tables with a row for each source are broadcast when they are small,
else joined by shuffle.

Defined results: a null or empty text has size 0; a null source is a source of its
own; rows with equal id, source and size share a rank and are taken one by one;
equal ranks of other rows go by size, then id; documents of size 0 take 0; a null
id ranks as the text "null"; texts of any length are counted whole; columns besides
doc_id, source and text are not read and may have any name; an empty table gives
no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .common import SMALL_ROWS, WORD, cut, table

#: Rows of a bin of the rank order, about, and the least number of bins.
BIN_ROWS, LEAST_BINS = 1000, 64
#: u has 52 bits and is never 0 or 1.
U_BITS = 52


def source_targets(sizes: DataFrame, share: float = 1.5, epochs: int = 2, weights: tuple[int, ...] = (3, 1, 2)) -> DataFrame:
    """source, source_size and target for each source; ``sizes`` has source and size.

    Sources number far fewer than rows: what follows the first aggregation is a table of sources.
    With caps c and weights w the level L fulfils sum(min(c, L * w)) = T; sorted by c / w, the capped
    sources are a prefix, found from running sums.
    """
    # Spark orders strings by their UTF-8 bytes, which is the order of code points.
    order = [F.col("source").isNull(), F.col("source")]
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    w = F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(Window.orderBy(*order)) - 1) % len(weights) + 1)
    one = Window.partitionBy(F.lit(1))
    ratio = F.col("source_size") / F.col("w")
    by = [ratio, *order]
    per = per.withColumn("w", w.cast("long"))
    per = per.withColumns({
        "total": share * F.sum("source_size").over(one),
        "capped_before": epochs * F.coalesce(F.sum("source_size").over(one.orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "weight_left": F.sum("w").over(one.orderBy(*by).rowsBetween(0, Window.unboundedFollowing)),
    })
    level = (F.col("total") - F.col("capped_before")) / F.col("weight_left")
    per = per.withColumn("level", level).withColumn("open", F.col("level") * F.col("w") <= epochs * F.col("source_size"))
    first = F.min_by(F.when(F.col("open"), F.col("level")), F.when(F.col("open"), F.struct(ratio, *order))).over(one)
    cap = (epochs * F.col("source_size")).cast("double")
    return per.withColumn("first", first).select("source", "source_size", F.coalesce(F.least(cap, F.col("first") * F.col("w")), cap).alias("target"))


def uniform(key: Column, seed: str) -> Column:
    """A number in (0, 1) from the md5 of seed and key, the same in every run."""
    text = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(key.cast("string"), F.lit("null"))).cast("binary"))
    return (F.conv(F.substring(text, 1, U_BITS // 4), 16, 10).cast("long") + 0.5) / float(1 << U_BITS)


def mix(docs: DataFrame, targets: DataFrame, seed: str = "mix", inclusion: Column | None = None) -> DataFrame:
    """``taken`` words for rows of (doc_id, source, size), given (source, source_size, target).

    ``inclusion`` is a positive number for each row, its size where none is given: a document's probability to be in
    the sample is proportional to it. The targets are met whatever it is.
    """
    tilt = (inclusion if inclusion is not None else F.col("size")).cast("double")
    groups = docs.select("doc_id", "source", "size", tilt.alias("tilt")).groupBy("doc_id", "source", "size", "tilt").agg(F.count("*").alias("n"))
    expected = groups.groupBy(F.col("source").alias("x_source")).agg(F.sum(F.col("n") * F.col("tilt") * F.col("size")).alias("expected"), F.count("*").alias("rows"))
    t = targets.select(F.col("source").alias("t_source"), "source_size", "target")
    t = cut(t.join(expected, _same("t_source", "x_source")).drop("x_source"))
    scope = t.agg(F.count("*").alias("sources"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")).first()
    near = F.broadcast if scope["sources"] <= SMALL_ROWS else lambda df: df  # a row for each source
    bins = max(LEAST_BINS, scope["rows"] // BIN_ROWS)

    g = groups.join(near(t), _same("source", "t_source")).drop("t_source", "rows")
    some = F.col("source_size") > 0
    copies = F.when(some, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    g = g.withColumn("copies", copies).withColumn("rest", F.col("target") - F.col("copies") * F.col("source_size"))
    chance = F.when(F.col("expected") > 0, F.col("rest") * F.col("tilt") / F.col("expected")).otherwise(F.lit(0.0))
    odds = lambda p: p / (F.lit(1.0) - p)
    held = lambda p: F.greatest(F.lit(1e-12), F.least(F.lit(1 - 1e-9), p))
    u = uniform(F.col("doc_id"), seed)
    # Over the source's mean odds q has about the order of u / (1 - u); q / (1 + q) keeps the order and lies in (0, 1), so bins of equal width serve.
    q = odds(u) / odds(held(chance)) * odds(held(F.when(some, F.col("rest") / F.col("source_size")).otherwise(F.lit(0.0))))
    g = cut(g.withColumn("q", q / (1 + q)).withColumn("bin", F.floor(F.col("q") * bins)).drop("expected"))

    picked = g.withColumn("extra", F.lit(0).cast("long"))
    while True:
        picked = cut(_take_in_order(picked, near))
        if not _gaps(picked).where("least <= gap").head(1):
            break
    while not (moves := _few(_moves(picked, near), scope["sources"])).isEmpty():
        picked = cut(_fill(picked, moves, near))
    # One row again for each document.
    out = picked.withColumn("i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    taken = F.col("size") * (F.col("copies") + F.when(F.col("i") <= F.col("extra"), F.lit(1)).otherwise(F.lit(0)))
    return out.select("doc_id", "source", "size", "source_size", "target", taken.cast("long").alias("taken"))


Near = Callable[[DataFrame], DataFrame]


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def _gaps(picked: DataFrame) -> DataFrame:
    """source, gap (words still to take) and the least size that is left, for each source."""
    left = F.min(F.when((F.col("extra") < F.col("n")) & (F.col("size") > 0), F.col("size")))
    return picked.groupBy("source").agg((F.first("rest") - F.sum(F.col("extra") * F.col("size"))).alias("gap"), left.alias("least"))


def _few(moves: DataFrame, sources: int) -> DataFrame:
    """``moves``, computed: as local rows where sources are few, else written."""
    if sources > SMALL_ROWS:
        return cut(moves)
    return moves.sparkSession.createDataFrame(moves.toArrow())  # a row for each source at most


def _take_in_order(picked: DataFrame, near: Near) -> DataFrame:
    """Of the rows no larger than their source's gap, take those up to the first that does not fit.

    What is larger never fits again, so repeating this takes what one walk in rank order through all bins would.
    """
    gaps = near(_gaps(picked).select(F.col("source").alias("g_source"), "gap"))
    g = picked.join(gaps, _same("source", "g_source")).drop("g_source")
    fits = (F.col("size") > 0) & (F.col("size") <= F.col("gap")) & (F.col("extra") < F.col("n"))
    g = g.withColumn("fits", fits).withColumn("words", F.when(fits, (F.col("n") - F.col("extra")) * F.col("size")).otherwise(F.lit(0)))
    bins = g.where("fits").groupBy("source", "bin").agg(F.sum("words").alias("words"), F.first("gap").alias("gap"))
    before = F.coalesce(F.sum("words").over(Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    edge = bins.withColumn("before", before).where((F.col("before") <= F.col("gap")) & (F.col("before") + F.col("words") > F.col("gap")))
    # A source has one edge bin, or none where everything is taken.
    edge = near(edge.select(F.col("source").alias("e_source"), F.col("bin").alias("e_bin"), "before"))
    g = g.join(edge, _same("source", "e_source"), "left").drop("e_source")

    edges = F.col("fits") & F.col("e_bin").isNotNull() & (F.col("bin") == F.col("e_bin"))
    w = Window.partitionBy("source").orderBy("q", "size", "doc_id", "tilt").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("before") + F.coalesce(F.sum("words").over(w), F.lit(0))
    room = F.greatest(F.lit(0), F.floor((F.col("gap") - start) / F.col("size")))
    inside = g.where(edges).withColumn("more", F.least(F.col("n") - F.col("extra"), room))
    # After the first row that does not fit whole, nothing more is taken in this round.
    over = F.max(F.when(F.col("more") < F.col("n") - F.col("extra"), F.lit(1)).otherwise(F.lit(0))).over(w)
    inside = inside.withColumn("more", F.when(F.coalesce(over, F.lit(0)) == 1, F.lit(0)).otherwise(F.col("more")))
    taken = F.col("fits") & (F.col("e_bin").isNull() | (F.col("bin") < F.col("e_bin")))
    whole = g.where(~edges).withColumn("more", F.when(taken, F.col("n") - F.col("extra")).otherwise(F.lit(0)))
    return whole.unionByName(inside).withColumn("extra", (F.col("extra") + F.col("more")).cast("long")).select(picked.columns)


def _moves(picked: DataFrame, near: Near) -> DataFrame:
    """For each source whose gap can narrow: the size to take out (0: none) and the size to take in (0: none) that narrow it most.

    For each size out, the sizes in nearest to size + gap are its neighbours in one order of the source's distinct sizes.
    """
    gaps = _gaps(picked).select(F.col("source").alias("g_source"), "gap")
    some = picked.where("size > 0")
    none = picked.select("source").distinct().withColumn("size", F.lit(0).cast("long"))
    out = some.where("extra > 0").select("source", "size").distinct().unionByName(none).join(near(gaps), _same("source", "g_source"))
    into = some.where("extra < n").select("source", "size").distinct().unionByName(none)
    line = out.select("source", "gap", F.col("size").alias("x"), (F.col("size") + F.col("gap")).alias("at"), F.lit(None).cast("long").alias("y"))
    line = line.unionByName(into.select("source", F.lit(None).cast("double").alias("gap"), F.lit(None).cast("long").alias("x"), F.col("size").cast("double").alias("at"), F.col("size").alias("y")))
    w = Window.partitionBy("source").orderBy("at", F.col("y").isNull())
    beside = line.withColumn("low", F.last("y", True).over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("high", F.first("y", True).over(w.rowsBetween(0, Window.unboundedFollowing)))
    pairs = beside.where("x IS NOT NULL").withColumn("y", F.explode(F.array("low", "high"))).where("y IS NOT NULL AND x != y")
    off = F.abs(F.col("gap") - (F.col("y") - F.col("x")))
    best = pairs.withColumn("off", off).where(F.col("off") < F.abs(F.col("gap")) - 1e-6).groupBy("source").agg(F.min(F.struct("off", "x", "y")).alias("b"))
    return best.select("source", "b.x", "b.y")


def _fill(picked: DataFrame, moves: DataFrame, near: Near) -> DataFrame:
    """Take one row out, the last in order of its size, and one in, the first in order, for each source of ``moves``."""
    hit = picked.join(near(moves.withColumnRenamed("source", "m_source")), _same("source", "m_source"))
    key = F.struct("q", F.col("doc_id").isNull().alias("no_id"), "doc_id", "tilt")
    leave = F.max(F.when((F.col("size") == F.col("x")) & (F.col("extra") > 0), key)).alias("leave")
    enter = F.min(F.when((F.col("size") == F.col("y")) & (F.col("extra") < F.col("n")), key)).alias("enter")
    ends = hit.groupBy("source", "x", "y").agg(leave, enter).withColumnRenamed("source", "f_source")
    g = picked.join(near(ends), _same("source", "f_source"), "left")
    at = lambda end, size: ((F.col("size") == F.col(size)) & (F.col("size") > 0) & key.eqNullSafe(F.col(end)) & F.col(end).isNotNull())
    more = F.when(at("enter", "y"), F.lit(1)).otherwise(F.lit(0)) - F.when(at("leave", "x"), F.lit(1)).otherwise(F.lit(0))
    return g.withColumn("extra", (F.col("extra") + more).cast("long")).select(picked.columns)


def sized(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = cut(sized(table(spark, sf_dir, "documents")))
    return mix(sizes, source_targets(sizes)).select("doc_id", "size", "source_size", "target", "taken")
