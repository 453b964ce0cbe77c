"""Operator 7: toxic spans and document scores from a linear-chain conditional random field.

Tokens are the words of a text without outer punctuation, in lower case. The
chain has two states, clean and toxic; a token's potential sums the weights of
its word and its prefixes of four and five letters, and neighbours are tied by
transition weights. Documents carry labels, tokens do not, so the tokens of the training
sample are labelled first: a word or prefix is an offence when it stands in many
different contexts of toxic documents and in next to no clean ones. The field is
trained on these labelled tokens by gradient steps with forward-backward
expectations. To score, forward-backward marginals of all tokens are summed as
odds, and the sum is calibrated on the sample's document labels.

Chains of a batch are concatenated and scanned in blocks: block products first,
then the entry of each block, then the tokens; a document's first token resets
the chain.

Defined results: null, empty and blank texts have no tokens and score lowest (the
calibrated value of no evidence); without labels of both classes the score is
that of the only class (0.5 without labels or labelled texts); repeated rows each get their score,
equal texts equal ones; a null doc_id is never held out; texts of any length are
read whole; columns besides doc_id and text are carried, unless a result has
their name; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import bucket_of, slices, small_batches, table
from .labelled import class_counts, training_sample

OUTER = "\"'.,;:!?()[]{}<>#$%&*|!-_/\\«»¿¡“”„’‘…"
#: 2 ** 18 emission weights, 2 MB.
BITS = 18
#: The most documents of each class that training reads.
PER_CLASS = 1000
MODULUS, HELD_OUT = 5, 0
BLOCK = 128
PREFIXES = (4, 5)
#: Tokens below these odds are no evidence, however many a long text has; FLOOR stands for a text without any.
LEAST_ODDS, FLOOR = 0.25, 0.01
NO_EVIDENCE = math.log(FLOOR)
WORD_AT = re.compile(r"\S+")


def normal(token: str) -> str:
    return token.strip(OUTER).lower()


def _feature(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text) >> (64 - BITS)


def word_features(word: str) -> list[int]:
    return [_feature("w:" + word), *[_feature("p:" + word[:k]) for k in PREFIXES if len(word) > k]]


def _scan(a: np.ndarray, b: np.ndarray, c: np.ndarray, d: np.ndarray) -> np.ndarray:
    """r[t] = (a[t] r[t - 1] + b[t]) / (c[t] r[t - 1] + d[t]) with r[-1] = 1, in blocks laid side by side."""
    n = len(a)
    blocks = -(-n // BLOCK)

    def lay(x: np.ndarray, fill: float) -> np.ndarray:
        return np.ascontiguousarray(np.concatenate([x, np.full(blocks * BLOCK - n, fill)]).reshape(blocks, BLOCK).T)

    a, b, c, d = lay(a, 1.0), lay(b, 0.0), lay(c, 0.0), lay(d, 1.0)
    p, q, r, s = a[0].copy(), b[0].copy(), c[0].copy(), d[0].copy()
    for k in range(1, BLOCK):
        p, q, r, s = a[k] * p + b[k] * r, a[k] * q + b[k] * s, c[k] * p + d[k] * r, c[k] * q + d[k] * s
        if k % 8 == 0:  # potentials are below e ** 25, so eight steps cannot overflow
            top = np.maximum(np.maximum(p, q), np.maximum(r, s))
            p, q, r, s = p / top, q / top, r / top, s / top
    enter, x = np.empty(blocks), 1.0
    for i, (e, f, g, h) in enumerate(zip(p.tolist(), q.tolist(), r.tolist(), s.tolist())):
        enter[i] = x
        x = (e * x + f) / (g * x + h)
    out, x = np.empty((BLOCK, blocks)), enter
    for k in range(BLOCK):
        x = out[k] = (a[k] * x + b[k]) / (c[k] * x + d[k])
    return out.T.reshape(-1)[:n]


def forward_backward(emission: np.ndarray, starts: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ratios toxic : clean of forward and backward messages for concatenated chains; ``starts`` marks first tokens.

    ``trans``: start weight, then log weights clean to toxic, toxic to clean, toxic to toxic (clean to clean is 0).
    """
    e = np.exp(np.clip(emission, -25, 25))
    s, t01, t10, t11 = np.exp(np.clip(trans, -25, 25))
    one = np.ones_like(e)
    # A chain's first token is the constant map to its own ratio.
    forward = _scan(np.where(starts, 0.0, t11 * e), np.where(starts, s, t01) * e, np.where(starts, 0.0, t10), one)
    # Backward: from the next token's potential and message; a chain's last token has ratio 1.
    last, following = np.append(starts[1:], True)[::-1], np.append(e[1:], 1.0)[::-1]
    backward = _scan(np.where(last, 0.0, t11 * following), np.where(last, 1.0, t10), np.where(last, 0.0, t01 * following), one)[::-1]
    return forward, backward


def offences(docs: list[tuple[list[str], int]], word_contexts: float = 0.02, prefix_contexts: float = 0.03, clean_share: float = 0.02) -> set[str]:
    """Words ("w:...") and prefixes ("p:...") that stand in many contexts of toxic documents and in few clean ones.

    The contexts wanted are a share of the toxic documents, 8 and 30 at least: a family of near copies repeats a rare word, but hardly its neighbours.
    """
    n = sum(y for _, y in docs)
    least = {"w": max(8, word_contexts * n), "p": max(30, prefix_contexts * n)}
    contexts: dict[str, set[tuple[str, str]]] = defaultdict(set)
    toxic: dict[str, int] = defaultdict(int)
    clean: dict[str, int] = defaultdict(int)
    keys = lambda w: [f"w:{w}"] + [f"p:{w[:k]}" for k in PREFIXES if len(w) > k]
    for tokens, y in docs:
        if y:
            for a, w, b in zip(["", *tokens], tokens, [*tokens[1:], ""]):
                if len(w) > 2:
                    for k in keys(w):
                        contexts[k].add((a, b))
            for k in {k for w in set(tokens) if len(w) > 2 for k in keys(w)}:
                toxic[k] += 1
    for tokens, y in docs:
        if not y:
            for k in {k for w in set(tokens) if len(w) > 2 for k in keys(w) if k in contexts}:
                clean[k] += 1
    return {k for k, seen in contexts.items() if len(seen) >= least[k[0]] and clean[k] <= clean_share * toxic[k]}


def train_field(docs: list[tuple[list[str], int]], steps: int = 20, rate: float = 0.4, l2: float = 1e-3) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Emission weights, transition weights and the calibration (slope, intercept)."""
    docs = [(t, y) for t, y in docs if t]
    bad = offences(docs)
    index: dict[str, int] = {}
    word = np.array([index.setdefault(w, len(index)) for t, _ in docs for w in t])
    names = list(index)
    marked = np.array([f"w:{w}" in bad or any(f"p:{w[:k]}" in bad for k in PREFIXES if len(w) > k) for w in names])
    feats = [word_features(w) for w in names]
    flat, owner = np.array([f for x in feats for f in x]), np.repeat(np.arange(len(names)), [len(x) for x in feats])
    starts = np.zeros(len(word), bool)
    offsets = np.cumsum([0] + [len(t) for t, _ in docs])
    starts[offsets[:-1]] = True
    truth_doc = np.array([y for _, y in docs])
    y = marked[word] & (np.repeat(truth_doc, np.diff(offsets)) == 1)
    inner = ~starts[1:]
    seen = np.array([y[starts].sum(), (inner & ~y[:-1] & y[1:]).sum(), (inner & y[:-1] & ~y[1:]).sum(), (inner & y[:-1] & y[1:]).sum()], float)
    weights, trans = np.zeros(1 << BITS), np.array([-4.0, -4.0, 0.0, 0.0])
    moment_w, moment_t = np.zeros(1 << BITS), np.zeros(4)

    def emit() -> np.ndarray:
        return np.bincount(owner, weights[flat], len(names))[word]

    for _ in range(steps):
        e = emit()
        f, b = forward_backward(e, starts, trans)
        p = f * b / (1 + f * b)
        c = np.exp(np.clip(e[1:], -25, 25)) * b[1:]
        t01, t10, t11 = np.exp(trans[1:])
        total = 1 + t01 * c + f[:-1] * t10 + f[:-1] * t11 * c
        expected = np.array([p[starts].sum()] + [(x / total)[inner].sum() for x in (t01 * c, f[:-1] * t10, f[:-1] * t11 * c)])
        per_word = np.bincount(word, y - p, len(names))
        g = np.bincount(flat, per_word[owner], 1 << BITS) - l2 * weights
        moment_w += g * g
        weights += rate * 4 * g / (np.sqrt(moment_w) + 1e-6)
        gt = seen - expected
        moment_t += gt * gt
        trans += rate * gt / (np.sqrt(moment_t) + 1e-6)
    f, b = forward_backward(emit(), starts, trans)
    x = np.log(np.add.reduceat(np.where(f * b >= LEAST_ODDS, f * b, 0.0), offsets[:-1]) + FLOOR)
    a, k = 1.0, 0.0
    for _ in range(30):  # a ridge on the slope keeps separable samples finite
        q = 1 / (1 + np.exp(-np.clip(a * x + k, -30, 30)))
        v = q * (1 - q) + 1e-9
        h = np.array([[(v * x * x).sum() + 1.0, (v * x).sum()], [(v * x).sum(), v.sum() + 0.01]])
        d = np.linalg.solve(h, np.array([((truth_doc - q) * x).sum() - (a - 0.7), (truth_doc - q).sum() - 0.01 * k]))
        a, k = a + max(-1, min(1, d[0])), k + max(-2, min(2, d[1]))
    return weights, trans, np.array([max(a, 0.05), k])


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    docs: dict[int, tuple[list[str], int]] = {}
    for b in batches:
        for text, y in zip(b.column("text").to_pylist(), b.column("label").to_pylist()):
            docs[xxhash.xxh3_64_intdigest(text)] = ([w for w in map(normal, text.split()) if w], y)  # copies count once
    if not any(tokens for tokens, _ in docs.values()):
        return  # no text has these labels
    weights, trans, scale = train_field([docs[k] for k in sorted(docs)])
    used = np.flatnonzero(np.abs(weights) > 1e-6)
    keys = np.concatenate([used, -1 - np.arange(6)])
    yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.concatenate([weights[used], trans, scale]))], ["feature", "weight"])


def train(sample: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """The sample is bounded and lies in one partition, so one task walks it; 2 ** BITS + 6 numbers at most come back."""
    model = small_batches(sample).mapInArrow(_train, "feature long, weight double").toPandas()
    if not len(model):
        return None
    weights, rest = np.zeros(1 << BITS), np.zeros(6)
    for f, w in zip(model["feature"], model["weight"]):
        if f < 0:
            rest[-1 - f] = w
        else:
            weights[f] = w
    return weights, rest[:4], rest[4:]


class Emissions(dict):
    """Raw word to the sum of its weights, filled on demand and emptied when it has grown large."""

    def __init__(self, weights: np.ndarray):
        self.weights, self.prefixes = weights.tolist(), {}

    def _prefix(self, prefix: str) -> float:
        value = self.prefixes.get(prefix)
        if value is None:
            if len(self.prefixes) > 200_000:
                self.prefixes.clear()
            value = self.prefixes[prefix] = self.weights[_feature("p:" + prefix)]
        return value

    def __missing__(self, raw: str) -> float:
        if len(self) > 400_000:
            self.clear()
        word = normal(raw)
        value = self.weights[_feature("w:" + word)] if word else -10.0
        for k in PREFIXES:
            if len(word) > k:
                value += self._prefix(word[:k])
        self[raw] = value
        return value


def tag_batch(texts: list[str], emissions: Emissions, trans: np.ndarray) -> list[tuple[float, list[float], list[int]]]:
    """For each text: log of the summed odds, the offending tokens' marginals and their positions among the words."""
    per = [[emissions[w] for w in t.split()] if t else [] for t in texts]
    sizes = np.array([len(p) for p in per])
    e = np.fromiter((v for p in per for v in p), float, int(sizes.sum()))
    found: list[tuple[float, list[float], list[int]]] = [(NO_EVIDENCE, [], [])] * len(texts)
    if len(e):
        offsets = np.concatenate(([0], np.cumsum(sizes)))
        starts = np.zeros(len(e), bool)
        some = np.flatnonzero(sizes)
        starts[offsets[some]] = True
        f, b = forward_backward(e, starts, trans)
        odds = f * b
        sums = np.add.reduceat(np.where(odds >= LEAST_ODDS, odds, 0.0), offsets[some]) + FLOOR
        hot = np.flatnonzero(odds >= 1.0)
        owner = np.searchsorted(offsets, hot, side="right") - 1
        by: dict[int, list[int]] = defaultdict(list)
        for i, t in zip(owner.tolist(), hot.tolist()):
            by[i].append(t)
        for i, s in zip(some.tolist(), sums.tolist()):
            found[i] = (math.log(s), [float(odds[t] / (1 + odds[t])) for t in by.get(i, ())], [t - int(offsets[i]) for t in by.get(i, ())])
    return found


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("marginal", pa.float64())]))


def spans(text: str, at: list[int], marginals: list[float]) -> list[dict]:
    """Code point offsets of the offending words; neighbours stay apart."""
    if not at:
        return []
    want, out = dict(zip(at, marginals)), []
    for i, m in enumerate(WORD_AT.finditer(text)):
        if i in want:
            out.append({"start": m.start(), "end": m.end(), "marginal": want[i]})
            if len(out) == len(want):
                break
    return out


def tag_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", modulus: int = MODULUS, held_out: int = HELD_OUT, per_class: int = PER_CLASS, threshold: float = 0.5) -> DataFrame:
    """Every column of ``docs`` but those of the results, with held_out, score, predicted and spans. ``docs`` needs doc_id and text."""
    n0, n1 = class_counts(labels, label, modulus, held_out)
    model = None
    if n0 and n1:
        model = train(training_sample(docs, labels, label, modulus, held_out, per_class))
    shift = math.log(n1 / n0) - math.log(min(n1, per_class) / min(n0, per_class)) if model else 0.0
    shared = docs.sparkSession.sparkContext.broadcast((model, shift, 0.5 if bool(n0) == bool(n1) else float(bool(n1))))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field, shift, alone = shared.value
        emissions = Emissions(field[0]) if field else None
        for b in batches:
            texts = [t or "" for t in b.column("text").to_pylist()]
            scores, marks = np.full(len(texts), alone), [[] for _ in texts]
            for lo, hi in slices([len(t) for t in texts], 1_500_000) if field else ():
                for i, (x, m, at) in enumerate(tag_batch(texts[lo:hi], emissions, field[1]), lo):
                    scores[i] = 1 / (1 + math.exp(-max(-35.0, min(35.0, field[2][0] * x + field[2][1] + shift))))
                    marks[i] = spans(texts[i], at, m)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(scores), pa.array((scores >= threshold).astype(np.int32)), pa.array(marks, SPANS)], [*b.schema.names, "score", "predicted", "spans"]
            )

    rows = docs.drop("held_out", "score", "predicted", "spans").withColumn("held_out", bucket_of(F.col("doc_id"), modulus) == held_out)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return small_batches(rows).mapInArrow(score, f"{kinds}, score double, predicted int, spans array<struct<start: long, end: long, marginal: double>>")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return tag_toxicity(docs, table(spark, sf_dir, "labels")).drop("text")
