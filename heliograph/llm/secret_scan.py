"""Operator 9: secrets in texts, with a random forest against false positives.

A candidate is a run of a word (between quotes, brackets, ?, &, commas and the
like) of eight characters or more with a digit or a capital inside, or of twenty or
more, or any value behind a key-like name (token, S3_SECRET_KEY). Its features are
its length, its shares of digits, capitals and other marks, its character
transitions and entropy, how much of its letters words of the corpus' dictionary
cover, its path-like parts, and what words stand beside it. Spark ML trains a
random forest on labelled findings; the trees' nodes are read back as a table, and
one pass over the texts finds and scores all candidates. The dictionary are the
words in most documents of the whole corpus.

Findings may come labelled by hand (``labelled``: columns of ``FEATURES`` and
``label``). The tables here hold none, so by default a bounded sample of candidates
is labelled from what the forest does not see: a value that an assignment gives to
a key-like name, or behind a known key prefix, is a secret; a mail, network or web
address, a date, a number and a file path is none, nor is a value that is assigned
to a name which names no secret; the rest stays unlabelled. What the forest learns
is how such values look, whatever name they stand behind.

Defined results: null and empty texts have no findings; a text may hold one secret
many times, each place is a finding; without labelled findings of both classes
every candidate scores 0.5 and counts as a secret; repeated rows each have their
findings, equal rows equal ones; texts of any length are read whole; columns
besides doc_id and text may have any name: findings do not carry them, ``redact``
carries all; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
import uuid
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import cut, ensure_checkpoint_dir, small_batches, table

#: The most labelled findings that training reads.
MAX_FINDINGS = 20_000
TREES, DEPTH = 30, 6
#: Words that many documents hold, and how many of them the dictionary has at most.
DICTIONARY_WORDS = 20_000
CANDIDATE = re.compile(rb"(?<!\S)\S{8,}")
ODD = re.compile(rb"[0-9]|[a-z][A-Z]")
#: A run of this many characters is a candidate whatever it is made of.
LONG = 20
CORE = re.compile(rb"[A-Za-z0-9][A-Za-z0-9_+/.=@:~\-]*[A-Za-z0-9=]")
KEY = r"(?<![A-Za-z0-9_.\-])([A-Za-z_][A-Za-z0-9_.\-]{1,39})"
ASSIGN = re.compile(rf"{KEY}[=:]+(?=.{{8}})".encode(), re.S)
# A key inside a run; one just before a run, over white space and opening marks; the value of a key-like name, wherever it stands.
INNER = re.compile(rf"{KEY}[=:]+(?=.)".encode(), re.S)
BEFORE = re.compile(rf"{KEY}[\"']?\s*([=:]+)\s*[\"'(\[{{<]*$".encode())
NAMED = re.compile(rf"{KEY}[\"']?\s*$".encode())
SIGN, WORDS = re.compile(rb"[=:]+\s*(?=\S)"), re.compile(rb"\S+")
OPENS = re.compile(rb"[\"'(\[{]+[A-Za-z0-9]")
NAME_ONLY = re.compile(rb"[A-Za-z_][A-Za-z0-9_.\-]*[=:]+")
MARKS = b"_+/.=@:~-"
# Words that name secrets, prefixes of well-known keys, words often found inside harmless identifiers.
KEY_WORDS = {"password", "passwd", "pwd", "pass", "secret", "token", "key", "apikey", "api_key", "access_key", "auth", "authorization", "bearer", "credential", "credentials", "private_key", "client_secret"}
KEY_PREFIXES = ("AKIA", "ASIA", "ghp_", "gho_", "ghs_", "github_pat_", "sk-", "sk_live_", "rk_live_", "xoxb-", "xoxp-", "xoxa-", "AIza", "ya29.", "glpat-", "npm_", "eyJ", "SG.")
FEATURES = ["length", "digits", "upper", "lower", "other", "transitions", "entropy", "longest_letters", "dictionary", "slashes", "dots", "hex_only", "vowels", "near_words", "near_length"]
#: What labels are made from; the forest sees none of these.
CONTEXT = ["prefix", "named", "assigned", "other_name", "harmless"]
LETTERS = re.compile(r"[a-z]+")
HARMLESS = re.compile(r"^(?:[^@\s]+@[\w.-]+\.\w+|\d{1,3}(?:\.\d{1,3}){3}(?::\d+)?|[\d+() .\-/]+|[a-z][a-z0-9+.-]*://\S+|(?:[\w.~-]+/)+[\w.~-]+|\d{4}-\d\d-\d\d\S*)$", re.I)


def describe(core: str, near: list[str], dictionary: frozenset[str]) -> list[float]:
    """The features of one candidate, beside the words ``near``."""
    n = len(core)
    kinds = ["d" if c.isdigit() else "u" if c.isupper() else "l" if c.islower() else "o" for c in core]
    share = lambda k: kinds.count(k) / n
    low = core.lower()
    # Words in camel case are words of their own.
    runs = LETTERS.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", core).lower())
    letters = sum(map(len, runs))
    covered = sum(len(r) for r in runs if len(r) > 2 and r in dictionary)
    entropy = -sum(p * math.log2(p) for p in (core.count(c) / n for c in set(core)))
    beside = [w for w in ("".join(LETTERS.findall(w.lower())) for w in near) if w]
    return [
        float(n), share("d"), share("u"), share("l"), share("o"), sum(a != b for a, b in zip(kinds, kinds[1:])) / max(1, n - 1), entropy,
        float(max(map(len, runs), default=0)), covered / max(1, letters), float(core.count("/")), float(core.count(".")), float(all(c in "0123456789abcdef" for c in low)),
        sum(c in "aeiou" for c in low) / max(1, letters), sum(w in dictionary for w in beside) / max(1, len(beside)), sum(map(len, beside)) / max(1, len(beside)),
    ]


Found = tuple[int, int, list[float], list[float], str]


def candidates(text: bytes, dictionary: frozenset[str] = frozenset()) -> list[Found]:
    """(start byte, end byte, features, context, core) of each candidate of one text."""
    out = []
    words = {m.start(): m.end() for m in CANDIDATE.finditer(text)}
    behind: dict[int, int] = {}  # words behind a key-like name
    signs = [m.end() for m in SIGN.finditer(text) if (k := NAMED.search(text, max(0, m.start() - 60), m.start())) and key_like(k.group(1).decode("ascii"))]
    if signs:
        spans = [m.span() for m in WORDS.finditer(text)]
        behind = dict(spans[bisect_right(spans, (at, len(text))) - 1] for at in signs)
        words.update(behind)
    for base, end in sorted(words.items()):
        word = text[base:end]
        wide = len(word) >= LONG or ODD.search(word)
        if not wide and base not in behind and b"=" not in word and b":" not in word:
            continue  # a plain word, and no name before it or in it
        near: list[str] | None = None
        for run in CORE.finditer(word):
            for at, value, name, assigned in parts(text, base + run.start(), run.group(), OPENS.match(word, run.end()) is not None):
                named = key_like(name)
                if not named and not (wide and (len(value) >= LONG or len(value) >= 8 and ODD.search(value))):
                    continue
                core = value.decode("ascii")
                quoted = at > 0 and text[at - 1] in b"\"'"
                if near is None:
                    near = text[max(0, base - 60) : base].decode("utf-8", "ignore").split()[-2:] + text[end : end + 40].decode("utf-8", "ignore").split()[:2]
                context = [float(core.startswith(KEY_PREFIXES)), float(named), float(assigned or quoted), float(bool(name) and assigned and not named), float(bool(HARMLESS.match(core)) or core.isdigit())]
                out.append((at, at + len(core), describe(core, near, dictionary), context, core))
    return out


def key_like(name: str) -> bool:
    """Whether a key's name, or a part of it, is a word that names secrets: token, S3_SECRET_KEY, dbPassword."""
    parts = re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1_\2", name).lower())
    return name.lower() in KEY_WORDS or any(p in KEY_WORDS for p in parts)


def parts(text: bytes, start: int, run: bytes, opens: bool) -> Iterator[tuple[int, bytes, str, bool]]:
    """(start byte, value, key, whether an equals sign assigns it) of each value of a run; ``opens``: a quoted value follows."""
    if opens and NAME_ONLY.fullmatch(run):
        return  # a key whose value is the next run
    keys = [m for m in INNER.finditer(run) if key_like(m.group(1).decode("ascii"))]
    head = run[: keys[0].start()] if keys else run
    before = BEFORE.search(text, max(0, start - 60), start)
    name, equals, at = (before.group(1).decode("ascii"), b"=" in before.group(2), 0) if before else ("", False, 0)
    if not (before and key_like(name)) and (m := ASSIGN.match(head)):
        name, equals, at = m.group(1).decode("ascii"), b"=" in m.group(), m.end()
    found = [(at, len(head), name, equals)]
    for m, after in zip(keys, [*keys[1:], None]):
        found.append((m.end(), after.start() if after else len(run), m.group(1).decode("ascii"), b"=" in m.group()))
    for x, y, name, equals in found:
        value = run[x:y].lstrip(MARKS)
        x = y - len(value)
        if y < len(run):
            value = value.rstrip(MARKS)
        if value:
            yield start + x, value, name, equals


def context_label(context: list[float]) -> int | None:
    """1 for a secret by what stands around it, 0 for a harmless thing by its kind or by what stands around it, None where that does not tell."""
    prefix, named, assigned, other_name, harmless = context
    if harmless or other_name:
        return 0
    return 1 if prefix or (named and assigned) else None


def dictionary_of(docs: DataFrame, most: int = DICTIONARY_WORDS) -> DataFrame:
    """The ``most`` words that most documents hold. Counts cover all documents and are partial before they move."""
    letters = F.split(F.lower(F.coalesce("text", F.lit(""))), "[^a-z]+")
    counts = docs.select(F.explode(F.array_distinct(letters)).alias("word")).where(F.length("word").between(3, 30)).groupBy("word").agg(F.count("*").alias("n"))
    return counts.where("n > 1").orderBy(F.desc("n"), "word").limit(most)


def _dictionary(docs: DataFrame) -> frozenset[str]:
    """At most DICTIONARY_WORDS words come to the driver: the executors pick them before."""
    return frozenset(r["word"] for r in cut(dictionary_of(docs).select("word")).collect())


def labelled_sample(docs: DataFrame, dictionary: frozenset[str], most: int = MAX_FINDINGS) -> DataFrame:
    """At most ``most`` candidates of each class labelled by context, the first by a hash, each value once."""
    shared = docs.sparkSession.sparkContext.broadcast(dictionary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for text in b.column("text").cast(pa.binary()).to_pylist():
                for _, _, features, context, core in candidates(text or b"", shared.value):
                    y = context_label(context)
                    if y is not None:
                        rows.append([*features, y, xxhash.xxh3_64_intdigest(core) - (1 << 63)])
            cols = list(zip(*rows)) or [[]] * (len(FEATURES) + 2)
            kinds = [pa.float64()] * len(FEATURES) + [pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], [*FEATURES, "label", "key"])

    schema = ", ".join(f"{c} double" for c in FEATURES) + ", label int, key long"
    found = small_batches(docs.select("text")).mapInArrow(run, schema)
    one = found.groupBy("key", "label").agg(F.min(F.struct(*FEATURES)).alias("f"))
    one = cut(one.select("key", "label", "f.*"))
    pick = lambda y: one.where(F.col("label") == y).orderBy("key").limit(most)
    return pick(0).unionByName(pick(1))


Forest = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def train_forest(labelled: DataFrame, trees: int = TREES, depth: int = DEPTH, seed: int = 11) -> Forest | None:
    """The forest as node arrays: roots, feature (-1: leaf), threshold, left, right, probability of a secret."""
    labelled = cut(labelled.repartition(2))
    if labelled.select("label").distinct().count() < 2:
        return None
    data = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(labelled).select("features", F.col("label").cast("double").alias("label"))
    model = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="sqrt").fit(data)
    spark = labelled.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/forest-{uuid.uuid4()}"
    model.write().overwrite().save(path)
    # A forest has at most trees * 2 ** (depth + 1) nodes.
    nodes = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").orderBy("treeID", "id").collect()
    place = {(n["treeID"], n["id"]): i for i, n in enumerate(nodes)}
    leaf = [n["leftChild"] < 0 for n in nodes]
    stats = np.array([list(n["impurityStats"]) for n in nodes])
    return (
        np.array([place[t, 0] for t in sorted({n["treeID"] for n in nodes})]),
        np.array([-1 if x else n["split"]["featureIndex"] for x, n in zip(leaf, nodes)]),
        np.array([0.0 if x else n["split"]["leftCategoriesOrThreshold"][0] for x, n in zip(leaf, nodes)]),
        np.array([0 if x else place[n["treeID"], n["leftChild"]] for x, n in zip(leaf, nodes)]),
        np.array([0 if x else place[n["treeID"], n["rightChild"]] for x, n in zip(leaf, nodes)]),
        stats[:, 1] / stats.sum(1),
    )


def forest_scores(forest: Forest | None, rows: np.ndarray) -> np.ndarray:
    if forest is None:
        return np.full(len(rows), 0.5)
    roots, feature, threshold, left, right, value = forest
    total = np.zeros(len(rows))
    for root in roots:
        at = np.full(len(rows), root)
        while True:
            inner = np.flatnonzero(feature[at] >= 0)
            if not len(inner):
                break
            here = at[inner]
            at[inner] = np.where(rows[inner, feature[here]] <= threshold[here], left[here], right[here])
        total += value[at]
    return total / len(roots)


Model = tuple[Forest | None, frozenset[str]]


def fit(docs: DataFrame, labelled: DataFrame | None = None) -> Model:
    """The forest and the dictionary, some hundred KB."""
    dictionary = _dictionary(docs)
    return train_forest(labelled if labelled is not None else labelled_sample(docs, dictionary).drop("key")), dictionary


def _scored(texts: list[bytes | None], model: Model) -> list[list[tuple[int, int, float, str]]]:
    found = [candidates(t or b"", model[1]) for t in texts]
    rows = np.array([f for per in found for _, _, f, *_ in per], float).reshape(-1, len(FEATURES))
    scores = iter(forest_scores(model[0], rows).tolist())
    return [[(a, b, next(scores), core) for a, b, _, _, core in per] for per in found]


def scan(docs: DataFrame, labelled: DataFrame | None = None, threshold: float = 0.5) -> DataFrame:
    """doc_id, start, end (code points), length, score, is_secret and masked (the first four characters, of a value under 10 the first) of every candidate."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labelled))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("text").cast(pa.binary()).to_pylist()
            rows = []
            for i, text, per in zip(b.column("doc_id").to_pylist(), texts, _scored(texts, shared.value)):
                at = start = 0
                for x, y, score, core in per:  # in text order, so that each byte is decoded once
                    start, at = start + len(text[at:x].decode()), x
                    rows.append((i, start, start + len(core), len(core), score, score >= threshold, core[: 4 if len(core) >= 10 else 1] + "…"))
            cols = list(zip(*rows)) or [[]] * 7
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.bool_(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["doc_id", "start", "end", "length", "score", "is_secret", "masked"])

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return small_batches(rows).mapInArrow(run, "doc_id long, start long, end long, length long, score double, is_secret boolean, masked string")


def redact(docs: DataFrame, labelled: DataFrame | None = None, threshold: float = 0.5, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by ``mark``; all rows and columns stay."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labelled))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("text").cast(pa.binary()).to_pylist()
            out: list[bytes | None] = []
            for text, per in zip(texts, _scored(texts, shared.value)):
                pieces, at = [], 0
                for x, y, score, _ in per:
                    if score >= threshold:
                        pieces += [text[at:x], mark.encode()]
                        at = y
                out.append(b"".join([*pieces, text[at:]]) if at else text)
            at = b.schema.get_field_index("text")
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()).cast(pa.string()) if k == at else c for k, c in enumerate(b.columns)], b.schema.names)

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return small_batches(docs).mapInArrow(run, kinds)


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
