"""Operator 5: quality rules and distribution divergence, in DataFrame functions only.

Every text gets counts, a histogram of character classes and a histogram of its
language's common words. Both references are learned from all documents: the
common words of a language are those in most of its documents, and the reference
histograms are the means over its documents that pass the base rules. A document
is kept when its Jensen-Shannon distances to the references are small. Texts too
short for a stable histogram skip the test (minimum-length guards).

Defined results: a null or empty text has no words, fails the base rule and is
not kept; each value of ``lang`` is a reference of its own, null and empty ones
together; of equally common words the first by code points are taken; repeated
rows each get their own result, equal rows equal ones; texts of any length are
read whole; columns besides text and lang are carried along, whatever their name,
unless a result has it; an empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .common import SPACE, cut, small, table, words

#: How many common words a language has.
COMMON = 16
RESULTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "class_distance", "word_distance"]
PUNCTUATION = r".,;:!?'\"()\-"


def _lambda_once(value: Column, body) -> Column:
    """Bind ``value`` to a lambda variable, so that ``body`` may use it many times but it is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def neighbours(hashes: Column, apart: int) -> Column:
    """A hash of every element and the one ``apart`` places behind it. Three of these in a row, 1, 2 and 4 apart, hash every eight neighbours."""
    n = F.greatest(F.lit(0), F.size(hashes) - apart)
    return F.zip_with(F.slice(hashes, F.lit(1), n), F.slice(hashes, F.lit(apart + 1), n), lambda x, y: F.xxhash64(x, y))


def covered_words(windows: Column, width: int = 8) -> Column:
    """How many words lie in windows whose hash occurs twice or more; positions are only sorted where one does."""

    def covered(h: Column) -> Column:
        pairs = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def flagged(p: Column) -> Column:
            same = lambda x, k: F.coalesce(F.get(p, k)["h"] == x["h"], F.lit(False))
            return F.array_sort(F.transform(F.filter(p, lambda x, k: same(x, k - 1) | same(x, k + 1)), lambda x: x["i"]))

        def total(pos: Column) -> Column:
            steps = F.transform(pos, lambda x, k: F.least(F.lit(width), F.coalesce(F.get(pos, k + 1) - x, F.lit(width))))
            return F.aggregate(steps, F.lit(0).cast("long"), lambda acc, x: acc + x)

        return _lambda_once(_lambda_once(pairs, flagged), total)

    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("long")).otherwise(covered(windows))


def duplicate_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return _lambda_once(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))


def plain_words(text: Column) -> Column:
    """Words in lower case without the marks behind them."""
    return F.filter(F.split(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[.,;:!?]+(?=[\x20\x09-\x0D]|\z)", ""), SPACE + "+"), lambda w: w != "")


def common_words(docs: DataFrame) -> DataFrame:
    """(for_lang, chosen): the words in most documents of each language. Counts are partial before they move."""
    every = docs.select("ref_lang", F.explode(F.array_distinct(plain_words(F.col("text")))).alias("word"))
    counts = every.groupBy("ref_lang", "word").agg(F.count("*").alias("n"))
    rank = F.row_number().over(Window.partitionBy("ref_lang").orderBy(F.desc("n"), "word"))
    top = counts.withColumn("rank", rank).where(F.col("rank") <= COMMON)
    return top.groupBy(F.col("ref_lang").alias("for_lang")).agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "word"))), lambda x: x["word"]).alias("chosen"))


def features(docs: DataFrame) -> DataFrame:
    """``docs`` (row, text, ref_lang) without the text, with base counts, ``classes`` and ``common`` (counts per class and per common word)."""
    chosen = small(cut(common_words(docs)))
    text = F.coalesce(F.col("text"), F.lit(""))
    count = lambda pattern: F.regexp_count(text, F.lit(pattern)).cast("long")
    df = docs.join(chosen, docs["ref_lang"] == chosen["for_lang"], "left").drop("for_lang")
    df = df.withColumns({"ws": words(F.col("text")), "plain": plain_words(F.col("text"))})
    df = df.withColumns({
        "n_words": F.size("ws").cast("long"), "word_chars": F.length(F.array_join("ws", "")).cast("long"), "n_chars": F.length(text).cast("long"),
        "n_symbols": count(r"[#*$%&|<>]"), "n_upper": count(r"\p{Lu}"), "n_digits": count(r"[0-9]"), "n_punct": count(f"[{PUNCTUATION}]"), "n_dup_lines": duplicate_lines(text),
        "hashes": F.transform("ws", lambda w: F.xxhash64(w)),
        "known": F.filter("plain", lambda w: F.array_contains("chosen", w)),
    }).withColumn("pairs", neighbours(F.col("hashes"), 1)).withColumn("fours", neighbours(F.col("pairs"), 2)).withColumn("windows", neighbours(F.col("fours"), 4))
    hit = lambda i: F.coalesce(F.size("known") - F.size(F.array_remove("known", F.get("chosen", F.lit(i)))), F.lit(0)).cast("long")
    df = df.withColumn("hits", F.array(*[hit(i) for i in range(COMMON)]))
    df = df.withColumns({"n_repeat_words": covered_words(F.col("windows")), "n_space": F.col("n_chars") - F.col("word_chars")})
    rest = F.col("n_chars") - F.col("n_space") - F.col("n_symbols") - F.col("n_upper") - F.col("n_digits") - F.col("n_punct")
    found = reduce(add, [F.get("hits", F.lit(i)) for i in range(COMMON)])
    return df.select(
        "row", "ref_lang", "n_chars", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        F.array(rest, F.col("n_upper"), F.col("n_digits"), F.col("n_space"), F.col("n_punct"), F.col("n_symbols")).alias("classes"),
        F.concat(F.array(F.col("n_words") - found), F.col("hits")).alias("common"),
        ((F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))).alias("base_failed"),
    )


def _shares(counts: Column) -> Column:
    def norm(total: Column) -> Column:
        return F.transform(counts, lambda c: F.when(total > 0, c / total).otherwise(F.lit(0.0)))

    return _lambda_once(F.aggregate(counts, F.lit(0.0), lambda acc, x: acc + x), norm)


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (base 2, 0 to 1) of two distributions given as arrays."""
    term = lambda a, m: F.when(a > 0, a * F.log2(a / m)).otherwise(F.lit(0.0))
    parts = F.zip_with(p, q, lambda a, b: 0.5 * (term(a, (a + b) / 2) + term(b, (a + b) / 2)))
    total = F.aggregate(parts, F.lit(0.0), lambda acc, x: acc + x)
    return F.sqrt(F.least(F.lit(1.0), F.greatest(F.lit(0.0), total)))


def quality_rules(
    docs: DataFrame,
    class_limit: tuple[float, float] = (0.14, 2.5),
    word_limit: tuple[float, float] = (0.13, 1.6),
    min_chars: int = 100,
    min_words: int = 40,
) -> DataFrame:
    """The counts, the two distances and ``kept`` beside every row of ``docs``, whose text and lang go.

    A limit (a, b) allows a distance of a + b / sqrt(size): a histogram of few items strays further by chance.
    References have a row for each language; they are broadcast when these are few.
    """
    keep = [c for c in docs.columns if c not in (*RESULTS, "text", "lang")]
    rows = docs.select(F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in keep]).alias("row"), "text", F.coalesce("lang", F.lit("")).alias("ref_lang"))
    feats = cut(features(rows))
    good = feats.where(~F.col("base_failed")).select(F.col("ref_lang").alias("for_lang"), _shares(F.col("classes")).alias("cs"), _shares(F.col("common")).alias("ws"))
    mean = lambda c, n: F.array(*[F.avg(F.get(c, F.lit(i))) for i in range(n)])
    refs = small(cut(good.groupBy("for_lang").agg(mean("cs", 6).alias("ref_classes"), mean("ws", COMMON + 1).alias("ref_common"))))
    out = feats.join(refs, feats["ref_lang"] == refs["for_lang"], "left")
    zero = F.lit(0.0)
    apart = lambda counts, ref: F.coalesce(js_distance(_shares(F.col(counts)), F.col(ref)), zero)
    out = out.withColumns({
        "class_distance": F.when(F.col("n_chars") >= min_chars, apart("classes", "ref_classes")).otherwise(zero),
        "word_distance": F.when(F.col("n_words") >= min_words, apart("common", "ref_common")).otherwise(zero),
    })
    limit = lambda pair, n: F.lit(pair[0]) + F.lit(pair[1]) / F.sqrt(F.greatest(F.lit(1), F.col(n)))
    verdict = (F.col("class_distance") <= limit(class_limit, "n_chars")) & (F.col("word_distance") <= limit(word_limit, "n_words"))
    return out.withColumn("kept", ~F.col("base_failed") & verdict).select(*[F.col(f"row.`{c}`") for c in keep], *RESULTS)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return out.withColumns({c: F.round(c, 6) for c in ("class_distance", "word_distance")})


_TERM = "CASE WHEN {0} > 0 THEN {0} * log2({0} / (({0} + {1}) / 2)) ELSE 0 END"
_JS = "sqrt(least(1.0, greatest(0.0, list_sum(list_transform(range(1, len({p}) + 1), lambda i: 0.5 * (" + _TERM.format("{p}[i]", "{q}[i]") + " + " + _TERM.format("{q}[i]", "{p}[i]") + "))))))"
ORACLE_SQL = r"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, coalesce(lang, '') AS ref FROM documents),
 w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws, length(t) AS n_chars FROM d),
 f AS (SELECT *, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, length(regexp_replace(t, '[^\p{Lu}]', '', 'g')) AS n_upper,
  length(regexp_replace(t, '[^0-9]', '', 'g')) AS n_digits, length(regexp_replace(t, '[^.,;:!?''"()\-]', '', 'g')) AS n_punct, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
  list_filter(list_transform(ws, lambda x: rtrim(lower(x), '.,;:!?')), lambda x: x != '') AS plain FROM w),
 g AS (SELECT rid, i, array_to_string(ws[i:i + 7], ' ') AS s FROM (SELECT rid, ws, unnest(range(1, n_words - 6)) AS i FROM f WHERE n_words >= 8)),
 rep AS (SELECT rid, count(DISTINCT i + k) AS n FROM (SELECT rid, i FROM g QUALIFY count(*) OVER (PARTITION BY rid, s) > 1), (SELECT unnest(range(0, 8)) AS k) GROUP BY rid),
 c AS (SELECT ref, list(word ORDER BY r) AS chosen FROM (SELECT ref, word, row_number() OVER (PARTITION BY ref ORDER BY n DESC, word) AS r FROM (SELECT ref, word, count(*) AS n FROM (SELECT ref, unnest(list_distinct(plain)) AS word FROM f) GROUP BY 1, 2)) WHERE r <= 16 GROUP BY ref),
 h AS (SELECT f.*, len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words, [coalesce(len(list_filter(plain, lambda x: x = chosen[k])), 0) for k in range(1, 17)] AS hits FROM f LEFT JOIN rep USING (rid) LEFT JOIN c USING (ref)),
 x AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, n_chars - word_chars AS n_space, [n_words - list_sum(hits)] || hits AS common FROM h),
 y AS (SELECT *, [word_chars - n_symbols - n_upper - n_digits - n_punct, n_upper, n_digits, n_space, n_punct, n_symbols] AS classes FROM x),
 z AS (SELECT *, list_transform(classes, lambda v: CASE WHEN list_sum(classes) > 0 THEN v / list_sum(classes) ELSE 0.0::DOUBLE END) AS cs, list_transform(common, lambda v: CASE WHEN list_sum(common) > 0 THEN v / list_sum(common) ELSE 0.0::DOUBLE END) AS wsh FROM y),
 rc AS (SELECT ref, list(m ORDER BY k) AS qc FROM (SELECT ref, k, avg(v) AS m FROM (SELECT ref, unnest(cs) AS v, unnest(range(1, 7)) AS k FROM z WHERE NOT base_failed) GROUP BY ref, k) GROUP BY ref),
 rw AS (SELECT ref, list(m ORDER BY k) AS qw FROM (SELECT ref, k, avg(v) AS m FROM (SELECT ref, unnest(wsh) AS v, unnest(range(1, 18)) AS k FROM z WHERE NOT base_failed) GROUP BY ref, k) GROUP BY ref),
 o AS (SELECT *, CASE WHEN n_chars >= 100 THEN coalesce(""" + _JS.format(p="cs", q="qc") + ", 0.0) ELSE 0.0 END AS cd, CASE WHEN n_words >= 40 THEN coalesce(" + _JS.format(p="wsh", q="qw") + r""", 0.0) ELSE 0.0 END AS wd FROM z LEFT JOIN rc USING (ref) LEFT JOIN rw USING (ref))
 SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND cd <= 0.14 + 2.5 / sqrt(greatest(1, n_chars)) AND wd <= 0.13 + 1.6 / sqrt(greatest(1, n_words)) AS kept,
  round(cd, 6) AS class_distance, round(wd, 6) AS word_distance FROM o"""
