"""Operator 12: alignment of two tokenizers by an associative monoid of fragments.

Tokens of A (byte-level BPE) and B (pieces with byte fallback) of the same bytes are
cut into groups where both have a token end; an A and a B token are linked where
their byte ranges overlap. Merging all ends gives one interval for each link, so
links are as many as distinct ends.

A fragment is what a range of bytes of a document has: the tokens that end up to its
first common end (open prefix), whole groups between its first and last common end
(closed), and the tokens after that (open suffix). Two neighbours make one: the
suffix of the left and the prefix of the right are a group, or, where one of them has
no common end, stay open. This is associative, so fragments of a document can be
put together in any tree.

A document of up to LONG bytes is one fragment. A longer one is cut into ranges of
CHUNK bytes, wherever these end, even within a letter; each range comes with the text
around it up to the nearest places where no token of either kind can reach over, so
its task finds the tokens that the whole text has. Ranges are dealt to all tasks;
only open parts (some tokens each) go up the tree, ARITY at a time, and closed parts
stay where they are. A document's hash reads its parts in order, one at a time.

Tokens never reach over a single space between two characters that are no white
space, nor from before a single newline between such or over it, so texts are cut there
into units, each encoded once for many occurrences. Cutting there is right for
pieces only if none has a space after another character: the model is checked.

How many documents hold a pair is counted over all documents, from the distinct pairs
of each. The pairs held by most documents, as many as fit in FREQUENT rows, are
broadcast to the second pass; where there are more, the rest is joined by shuffle.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .common import cut, slices, small_batches, table

BYTE_BPE = "/opt/tokenizers/byte_bpe_50k.json"
PIECES = "/opt/tokenizers/piece_bpe_32k.model"
#: Bytes of a document that is one fragment, of a range of a longer one, and how far from a range's end a safe place is looked for.
LONG, CHUNK, MARGIN = 1 << 16, 1 << 15, 1 << 12
#: Fragments that are put together at once.
ARITY = 8
#: Units kept in a task's memory, about how many bytes of each, and how many new ones are encoded together.
UNITS, UNIT_BYTES, TOGETHER = 200_000, 256, 4096
#: Bytes of text that are aligned at once.
WINDOW = 1 << 20
#: Rows of pairs that are broadcast.
FREQUENT = 1_000_000
# How the byte-level tokenizer splits text before merging.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LONG_SPACE = re.compile(r"\s{1000}")
SAFE_NEWLINE = re.compile(r"(?<=\S)\n(?=\S)")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones for themselves, the others from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Aligner:
    """Both tokenizers, and the units seen: their numbers, and where their pairs are in one long array."""

    def __init__(self, byte_bpe: bytes, pieces: bytes):
        letters, vocabulary = byte_letters(), json.loads(byte_bpe)
        special = {t["content"] for t in vocabulary["added_tokens"]}
        ranks = {bytes(letters[c] for c in k): v for k, v in vocabulary["model"]["vocab"].items() if k not in special}
        self.a = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.merge = tiktoken.Encoding("merge", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_a = [b""] * (max(ranks.values()) + 1)
        for k, v in ranks.items():
            self.bytes_a[v] = k
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)]
        if any("▁" in p.lstrip("▁") or "\n" in p for p in names):
            raise ValueError("pieces reach over spaces or newlines: texts cannot be cut there")
        self.n_b = len(names)
        self.size_a, self.size_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        self.reset()

    def merged(self, text: str) -> list[int]:
        """A's ids; texts with long runs of white space are split here, as the library's own splitting has a bounded stack."""
        if not LONG_SPACE.search(text):
            return self.a.encode_ordinary(text)
        return [i for p in regex.findall(PATTERN, text) for i in self.merge.encode_ordinary(p)]

    def tokens(self, text: str) -> tuple[np.ndarray, np.ndarray, bool]:
        """Ids of a text that stands after a space, and whether both kinds give its bytes back."""
        whole, a, b = b" " + text.encode(), self.merged(" " + text), self.b.encode(text)
        return np.array(a, np.int64), np.array(b, np.int64), b"".join([self.bytes_a[i] for i in a]) == whole and b"".join([self.bytes_b[i] for i in b]) == whole

    def reset(self) -> None:
        self.index: dict[str | tuple[str], int] = {}
        self.texts: list[bytes] = []
        self.size = 0
        #: n_a, n_b, n_groups, whether the bytes come back, and the begin of its pairs, of each unit.
        self.facts, self.starts, self.pairs = np.zeros((1024, 4), np.int64), np.zeros(1025, np.int64), np.zeros(4096, np.int64)

    def _put(self, keys: list, texts: list[bytes], facts: np.ndarray, sizes: np.ndarray, pairs: np.ndarray) -> None:
        n, m = len(self.texts), int(self.starts[len(self.texts)])
        for name, need in (("facts", n + len(keys)), ("starts", n + len(keys) + 1), ("pairs", m + len(pairs))):
            x = getattr(self, name)
            if need > len(x):
                setattr(self, name, np.concatenate([x, np.zeros((max(need, 2 * len(x)) - len(x), *x.shape[1:]), x.dtype)]))
        self.facts[n : n + len(keys)] = facts
        self.starts[n + 1 : n + len(keys) + 1] = m + np.cumsum(sizes)
        self.pairs[m : m + len(pairs)] = pairs
        self.index.update(zip(keys, range(n, n + len(keys))))
        self.texts += texts
        self.size += sum(map(len, texts)) + 8 * len(pairs)

    def _one(self, key: str | tuple[str], unit: str, spaced: bool) -> None:
        """A unit by itself, which stands after a space (``spaced``), or begins with a newline that is its own first byte."""
        if spaced:
            a, b, good = self.tokens(unit)
        else:
            whole, a, b = unit.encode(), self.merged(unit), self.b.encode(unit)[1:]
            good = b"".join([self.bytes_a[i] for i in a]) == whole and b"".join([self.bytes_b[i] for i in b]) == whole
        text, n, pairs = self.aligned(a, b) if good else (b"", 0, np.zeros(0, np.int64))
        self._put([key], [text], np.array([[len(a), len(b), n, good]]), np.array([len(pairs)]), pairs)

    def _many(self, units: list[str]) -> None:
        """Units without white space, encoded as one text: they are cut apart where a space stands between them."""
        a, b, good = self.tokens(" ".join(units))
        if not good:
            for u in units:
                self._one(u, u, True)
            return
        last = np.cumsum([len(u.encode()) + 1 for u in units])
        ea, eb = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        ends, both, pairs = self.merged_ends(a, b, ea, eb)
        at = [np.searchsorted(e, last, "right") for e in (ea, eb, both, ends)]
        n_a, n_b, groups, links = (np.diff(x, prepend=0) for x in at)
        texts, p = self.group_texts(a, b, np.searchsorted(ea, both) + 1, np.searchsorted(eb, both) + 1), 0
        joined = []
        for q in at[2].tolist():
            joined.append(texts[p] if q == p + 1 else ";".join(texts[p:q]))
            p = q
        self._put(units, [t.encode() for t in joined], np.stack([n_a, n_b, groups, np.ones_like(groups)], axis=1), links, pairs)

    def numbers(self, texts: list[str]) -> list[np.ndarray]:
        """The units of each text, as numbers; new ones are encoded together."""
        if len(self.texts) > UNITS or self.size > UNITS * UNIT_BYTES:
            self.reset()
        split, lists = [self.split(t) if t else [] for t in texts], []
        # Only the first unit may begin with a newline that is not where it was cut.
        for units in split:
            if units and units[0][:1] == "\n":
                units[0] = (units[0],)
        new = [u for u in dict.fromkeys(chain.from_iterable(split)) if u not in self.index]
        plain = [u for u in new if isinstance(u, str) and len(u) <= UNIT_BYTES and len(u.split(None, 1)) == 1 and not u[0].isspace() and not u[-1].isspace()]
        for i in range(0, len(plain), TOGETHER):
            self._many(plain[i : i + TOGETHER])
        for u in new:
            if u not in self.index:
                self._one(u, u[0] if isinstance(u, tuple) else u, isinstance(u, tuple) or u[:1] != "\n")
        for units in split:
            lists.append(np.fromiter(map(self.index.__getitem__, units), np.int64, len(units)))
        return lists

    def merged_ends(self, a: np.ndarray, b: np.ndarray, ea: np.ndarray, eb: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ends, common ends, and the pair that is linked before each end."""
        every = np.concatenate([ea, eb])
        every.sort()
        again = every[1:] == every[:-1]
        ends = every[np.concatenate([[True], ~again])] if len(every) else every
        return ends, every[1:][again], a[np.searchsorted(ea, ends)] * self.n_b + b[np.searchsorted(eb, ends)]

    @staticmethod
    def group_texts(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> list[str]:
        """Each group's ids as text; groups end before ``i`` in a and ``j`` in b."""
        x, y, out, p, q = list(map(str, a.tolist())), list(map(str, b.tolist())), [], 0, 0
        for k, m in zip(i.tolist(), j.tolist()):
            out.append((x[p] if k == p + 1 else ",".join(x[p:k])) + "|" + (y[q] if m == q + 1 else ",".join(y[q:m])))
            p, q = k, m
        return out

    def aligned(self, a: list[int] | np.ndarray, b: list[int] | np.ndarray) -> tuple[bytes, int, np.ndarray]:
        """Groups as text, their number, and the pairs of links, of tokens that begin and end together."""
        x, y = np.asarray(a, np.int64), np.asarray(b, np.int64)
        ea, eb = np.cumsum(self.size_a[x]), np.cumsum(self.size_b[y])
        _, both, pairs = self.merged_ends(x, y, ea, eb)
        texts = self.group_texts(x, y, np.searchsorted(ea, both) + 1, np.searchsorted(eb, both) + 1)
        return ";".join(texts).encode(), len(texts), pairs

    def split(self, text: str) -> list[str]:
        """Units of a text that stands after a space. A unit but the first begins after the space before it, or at its newline."""
        parts = text.split(" ")
        if any(not p or p[0].isspace() or p[-1].isspace() for p in parts):
            joined, last = [], [parts[0]]
            for p in parts[1:]:
                if last[-1] and p and not last[-1][-1].isspace() and not p[0].isspace():
                    joined.append(" ".join(last))
                    last = [p]
                else:
                    last.append(p)
            parts = [*joined, " ".join(last)]
        if "\n" not in text:
            return parts
        out: list[str] = []
        for p in parts:
            if "\n" in p:
                at = [0, *(m.start() for m in SAFE_NEWLINE.finditer(p)), len(p)]
                out += [p[x:y] for x, y in zip(at[:-1], at[1:])]
            else:
                out.append(p)
        return out


@lru_cache(maxsize=1)
def _aligner(byte_bpe: bytes, pieces: bytes) -> Aligner:
    return Aligner(byte_bpe, pieces)


def counted(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs and how often each comes."""
    p, n = np.unique(pairs, return_counts=True)
    return p.astype(np.int32), n.astype(np.int32)


def whole(al: Aligner, texts: list[str]) -> list[dict]:
    """Documents of one fragment each."""
    out = []
    for units in al.numbers(texts):
        facts = al.facts[units]
        if not len(units) or not facts[:, 3].all():
            out.append({"n_a": 0, "n_b": 0, "n_groups": 0, "n_links": 0, "sha": "", "pairs": np.zeros(0, np.int32), "times": np.zeros(0, np.int32)})
            continue
        first, sizes = al.starts[units], al.starts[units + 1] - al.starts[units]
        at = np.repeat(first - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        pairs, times = counted(al.pairs[at])
        sha = hashlib.sha256(b";".join([al.texts[i] for i in units.tolist()])).hexdigest()
        n_a, n_b, groups, _ = facts.sum(axis=0).tolist()
        out.append({"n_a": n_a, "n_b": n_b, "n_groups": groups, "n_links": int(sizes.sum()), "sha": sha, "pairs": pairs, "times": times})
    return out


def ranges(text: bytes) -> Iterator[tuple[int, int, int, int]]:
    """(begin of the text to encode, begin of the range, end of the range, end of the text to encode) for ranges of about CHUNK bytes.

    A range that would end far from any safe place is as long as it takes to come near one.
    """

    def before(x: int) -> int | None:
        return max((x0 + m.start() for x0 in (max(0, x - MARGIN),) for m in _safe(text[x0:x])), default=None)

    def after(x: int) -> int | None:
        at, step = x, MARGIN
        while at < len(text):
            m = next(_safe(text[max(0, at - 1) : at + step]), None)
            if m:
                return max(0, at - 1) + m.start()
            at, step = at + step - 2, step * 2
        return None

    begin, left = 0, 0
    while begin < len(text):
        end = min(begin + CHUNK, len(text))
        safe, right = before(end), after(end)
        if end == len(text) or right is None:
            yield left, begin, len(text), len(text)
            return
        if safe is None or safe <= left or right - end > MARGIN:  # within a long unit: go on to its end
            end, safe = right, right
        yield left, begin, end, right
        begin, left = end, safe


def _safe(part: bytes) -> Iterator[re.Match]:
    """Single spaces between bytes of ASCII that are no white space: safe whatever stands around."""
    return re.finditer(rb"(?<=[!-~]) (?=[!-~])", part)


def fragment(al: Aligner, part: str, lead: int, size: int) -> dict:
    """The fragment of the tokens of ``part`` that end in the ``size`` bytes after ``lead``.

    ``part`` stands after a space that is not in it, which counts in ``lead`` and ``size`` (the document's own space,
    where it is its first part).
    """
    a, b, good = al.tokens(part)
    ea, eb = np.cumsum(al.size_a[a]), np.cumsum(al.size_b[b])
    ka, kb = ((e > lead) & (e <= lead + size) for e in (ea, eb))
    a, b, ea, eb = a[ka], b[kb], ea[ka], eb[kb]
    both = np.intersect1d(ea, eb)
    out = {"good": good, "n_a": len(a), "n_b": len(b), "closed": b"", "n_groups": 0, "pairs": [], "has": bool(len(both))}
    if not len(both):
        return out | {"prefix_a": a.tolist(), "prefix_b": b.tolist(), "suffix_a": [], "suffix_b": []}
    (i, j), (k, m) = ((int(np.searchsorted(ea, x)) + 1, int(np.searchsorted(eb, x)) + 1) for x in (both[0], both[-1]))
    if len(both) > 1:
        out["closed"], out["n_groups"], out["pairs"] = al.aligned(a[i:k], b[j:m])
    return out | {"prefix_a": a[:i].tolist(), "prefix_b": b[:j].tolist(), "suffix_a": a[k:].tolist(), "suffix_b": b[m:].tolist()}


def compose(x: dict, y: dict) -> tuple[dict, tuple[int, list[int], list[int]] | None]:
    """The open parts of two neighbours as one fragment, and the group that closes between them: (``first`` of the right one, A ids, B ids)."""
    if x["has"] and y["has"]:
        seam = (y["first"], [*x["suffix_a"], *y["prefix_a"]], [*x["suffix_b"], *y["prefix_b"]])
        return x | {"suffix_a": y["suffix_a"], "suffix_b": y["suffix_b"]}, seam
    if x["has"]:
        return x | {f"suffix_{s}": [*x[f"suffix_{s}"], *y[f"prefix_{s}"]] for s in "ab"}, None
    return y | {f"prefix_{s}": [*x[f"prefix_{s}"], *y[f"prefix_{s}"]] for s in "ab"}, None


OPEN = ["prefix_a", "prefix_b", "suffix_a", "suffix_b"]
DONE = "n_a long, n_b long, n_groups long, n_links long, sha string, pairs array<int>, times array<int>"
RANGE = "no int, part binary, lead long, size long"


def _done(rows: list[dict], head: dict[str, pa.Array], tail: dict[str, pa.DataType]) -> pa.RecordBatch:
    n = len(rows)
    lists = {}
    for c in ("pairs", "times"):
        sizes = [len(r[c]) for r in rows]
        lists[c] = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(np.concatenate([np.zeros(0, np.int32), *[r[c] for r in rows]]).astype(np.int32)))
    numbers = {c: pa.array([r[c] for r in rows], pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")}
    all_ = head | numbers | {"sha": pa.array([r["sha"] for r in rows], pa.string())} | lists | {c: pa.nulls(n, t) for c, t in tail.items()}
    return pa.RecordBatch.from_arrays(list(all_.values()), list(all_))


def first_pass(docs: DataFrame, byte_bpe: bytes, pieces: bytes) -> DataFrame:
    """Documents of one fragment whole (``no`` null), the ranges of longer ones as they are to be encoded."""
    shared = docs.sparkSession.sparkContext.broadcast((byte_bpe, pieces))
    range_types = {"no": pa.int32(), "part": pa.binary(), "lead": pa.int64(), "size": pa.int64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        al = _aligner(*shared.value)
        for batch in batches:
            column = batch.column("text")
            sizes = [len(x.as_buffer()) if x.is_valid else 0 for x in column.cast(pa.binary())]
            for lo, hi in slices(sizes, WINDOW):
                short = [i for i in range(lo, hi) if sizes[i] <= LONG]
                if short:
                    yield _done(whole(al, [column[i].as_py() or "" for i in short]), {c: batch.column(c).take(pa.array(short)) for c in ("uid", "doc_id")}, range_types)
                for i in (i for i in range(lo, hi) if sizes[i] > LONG):
                    text = column[i].as_py().encode()
                    for no, (left, begin, end, right) in enumerate(ranges(text)):
                        part = text[left + (left > 0) : right]  # without the space before it
                        row = {"uid": [batch.column("uid")[i].as_py()], "doc_id": [batch.column("doc_id")[i].as_py()]}
                        # The space before the part is its first byte; that of the document lies before its text.
                        shift = 0 if left > 0 else 1
                        lead, size = begin - left + (shift if begin > 0 else 0), end - begin + (shift if begin == 0 else 0)
                        nulls = {"n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(), "n_links": pa.int64(), "sha": pa.string(), "pairs": pa.list_(pa.int32()), "times": pa.list_(pa.int32())}
                        own = {"no": [no], "part": [part], "lead": [lead], "size": [size]}
                        cells = {c: pa.array(v, pa.int64()) for c, v in row.items()} | {c: pa.nulls(1, t) for c, t in nulls.items()} | {c: pa.array(v, range_types[c]) for c, v in own.items()}
                        yield pa.RecordBatch.from_arrays(list(cells.values()), list(cells))

    return small_batches(docs).mapInArrow(run, f"uid long, doc_id long, {DONE}, {RANGE}")


#: A row of a long document: an open fragment (``has`` set) or a part of its groups (``at``, ``seam`` tell its place).
FRAGMENT = "uid long, no int, good boolean, n_a long, n_b long, has boolean, first int, prefix_a array<int>, prefix_b array<int>, suffix_a array<int>, suffix_b array<int>, at int, seam int, closed binary, n_groups long, n_links long, pairs array<int>, times array<int>"
COLUMNS = [c.split()[0] for c in FRAGMENT.split(", ")]


def _frame(rows: list[dict]) -> pd.DataFrame:
    whole_rows = [{c: r.get(c) for c in COLUMNS} for r in rows]
    return pd.DataFrame(whole_rows, columns=COLUMNS, dtype=object).astype({c: "Int64" for c in ("uid", "no", "n_a", "n_b", "first", "at", "seam", "n_groups", "n_links")} | {"good": "boolean", "has": "boolean"})


def _group_row(al: Aligner, uid: int, at: int, a: list[int], b: list[int]) -> dict:
    text, n, pairs = al.aligned(list(a), list(b))
    p, t = counted(pairs)
    return {"uid": uid, "at": at, "seam": 0, "closed": text, "n_groups": n, "n_links": len(pairs), "pairs": p, "times": t}


def fragments(parts: DataFrame, byte_bpe: bytes, pieces: bytes) -> DataFrame:
    """Ranges (uid, no, part, lead, size) as rows of FRAGMENT: each an open fragment and, where it has some, its closed groups."""
    shared = parts.sparkSession.sparkContext.broadcast((byte_bpe, pieces))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        al = _aligner(*shared.value)
        for f in frames:
            for uid, no, part, lead, size in f[["uid", "no", "part", "lead", "size"]].itertuples(index=False):
                x = fragment(al, bytes(part).decode(), lead, size)
                rows = [{"uid": uid, "no": no, "first": no} | {c: x[c] for c in ("good", "n_a", "n_b", "has", *OPEN)}]
                if x["n_groups"]:
                    p, t = counted(x["pairs"])
                    rows.append({"uid": uid, "at": no, "seam": 1, "closed": x["closed"], "n_groups": x["n_groups"], "n_links": len(x["pairs"]), "pairs": p, "times": t})
                yield _frame(rows)

    return parts.mapInPandas(run, FRAGMENT)


def composed(open_: DataFrame, byte_bpe: bytes, pieces: bytes) -> DataFrame:
    """Open fragments of neighbours, ARITY at a time, as one each, and the groups that close between them; ``good`` holds for all."""
    shared = open_.sparkSession.sparkContext.broadcast((byte_bpe, pieces))

    def run(f: pd.DataFrame) -> pd.DataFrame:
        al = _aligner(*shared.value)
        rows = f.sort_values("no").to_dict("records")
        out, total = [], rows[0]
        for y in rows[1:]:
            ends = {"good": bool(total["good"] and y["good"]), "n_a": total["n_a"] + y["n_a"], "n_b": total["n_b"] + y["n_b"], "no": total["no"]}
            merged, seam = compose(total, y)
            total = merged | ends
            if seam and ends["good"]:
                out.append(_group_row(al, total["uid"], *seam))
        total["no"] //= ARITY
        return _frame([{c: total[c] for c in ("uid", "no", "good", "n_a", "n_b", "has", "first", *OPEN)}, *out])

    return open_.groupBy("uid", F.floor(F.col("no") / ARITY)).applyInPandas(run, FRAGMENT)


def closing(root: DataFrame, byte_bpe: bytes, pieces: bytes) -> DataFrame:
    """The first group of each document from its one fragment."""
    shared = root.sparkSession.sparkContext.broadcast((byte_bpe, pieces))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        al = _aligner(*shared.value)
        for f in frames:
            rows = [_group_row(al, r["uid"], r["first"], r["prefix_a"], r["prefix_b"]) for r in f.to_dict("records")]
            if rows:
                yield _frame(rows)

    return root.where("has AND good").mapInPandas(run, FRAGMENT)


def _hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (uid, closed) as one SHA-256 for each uid; a document's parts come one after the other."""
    key, sha = None, None
    row = lambda: pa.RecordBatch.from_arrays([pa.array([key], pa.int64()), pa.array([sha.hexdigest()])], ["uid", "sha"])
    for b in batches:
        for uid, text in zip(b.column("uid").to_pylist(), b.column("closed")):
            if uid != key:
                if key is not None:
                    yield row()
                key, sha = uid, hashlib.sha256()
            else:
                sha.update(b";")
            sha.update(text.as_buffer())
    if key is not None:
        yield row()


def long_documents(parts: DataFrame, byte_bpe: bytes, pieces: bytes) -> DataFrame:
    """uid, doc_id and the columns of DONE for documents given as ranges: fragments, put together in a tree."""
    # Ranges go to all tasks, those of one document too.
    dealt = small_batches(parts.repartition("uid", "no"))
    rows = cut(fragments(dealt, byte_bpe, pieces))
    open_, closed = rows.where("at IS NULL").drop("at", "seam", "closed", "n_groups", "n_links", "pairs", "times"), [rows.where("at IS NOT NULL")]
    most = open_.agg(F.max("no")).first()[0]
    while most:
        rows = cut(composed(open_, byte_bpe, pieces))
        open_, most = rows.where("at IS NULL").drop("at", "seam", "closed", "n_groups", "n_links", "pairs", "times"), most // ARITY
        closed.append(rows.where("at IS NOT NULL"))
    closed.append(closing(open_, byte_bpe, pieces))
    groups = closed[0]
    for more in closed[1:]:
        groups = groups.unionByName(more)
    roots = open_.select("uid", "good", "n_a", "n_b")
    groups = cut(groups.join(roots.where("good").select("uid"), "uid", "left_semi"))
    order = ["uid", "at", "seam"]
    sha = groups.select(*order, "closed").repartition("uid").sortWithinPartitions(*order)
    sha = small_batches(sha).mapInArrow(_hash, "uid long, sha string")
    sums = groups.groupBy("uid").agg(F.sum("n_groups").alias("n_groups"), F.sum("n_links").alias("n_links"))
    times = groups.select("uid", F.explode(F.arrays_zip("pairs", "times")).alias("e")).groupBy("uid", "e.pairs").agg(F.sum("e.times").cast("int").alias("times"))
    times = times.groupBy("uid").agg(F.collect_list("pairs").alias("pairs"), F.collect_list("times").alias("times"))
    ids = parts.where("no = 0").select("uid", "doc_id")
    out = ids.join(roots, "uid").join(sums, "uid", "left").join(times, "uid", "left").join(sha, "uid", "left")
    count = lambda c: F.when(F.col("good"), F.coalesce(c, F.lit(0))).otherwise(0).cast("long").alias(c)
    nothing = F.array().cast("array<int>")
    return out.select("uid", "doc_id", *map(count, ("n_a", "n_b", "n_groups", "n_links")), F.coalesce("sha", F.lit("")).alias("sha"), F.coalesce("pairs", nothing).alias("pairs"), F.coalesce("times", nothing).alias("times"))


def pair_counts(done: DataFrame, n_b: int) -> DataFrame:
    """(pair, count, best): how many documents hold each pair, and whether it is the highest count of its A id."""
    counts = done.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("count"))
    # An A id has no more pairs than B has pieces.
    highest = F.max("count").over(Window.partitionBy(F.floor(F.col("pair") / n_b)))
    return counts.withColumn("best", (F.col("count") == highest).cast("int"))


def scored(done: DataFrame, counts: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """(uid, n_best, count_sum) of documents with pairs."""
    total = counts.count()
    links = done.select("uid", F.explode(F.arrays_zip("pairs", "times")).alias("e")).select("uid", F.col("e.pairs").alias("pair"), F.col("e.times").alias("times"))
    sums = [F.sum(F.col("times") * F.col(c)).cast("long").alias(n) for c, n in (("best", "n_best"), ("count", "count_sum"))]
    if total <= frequent:
        return links.join(F.broadcast(counts), "pair").groupBy("uid").agg(*sums)
    # The least count whose pairs, with all above it, are no more than ``frequent``: from the number of pairs in each power of 1.1.
    step = lambda: F.floor(F.log("count") / F.log(F.lit(1.1)))
    sizes, room, least = counts.groupBy(step().alias("step")).agg(F.count("*").alias("n")).orderBy(F.desc("step")).collect(), frequent, None
    for s in sizes:
        room -= s["n"]
        if room < 0:
            break
        least = s["step"]
    top = F.lit(False) if least is None else step() >= least
    common = links.join(F.broadcast(counts.where(top)), "pair").groupBy("uid").agg(*sums)
    rare = links.join(F.broadcast(counts.where(top).select("pair")), "pair", "left_anti").join(counts.where(~top), "pair").groupBy("uid").agg(*sums)
    return common.unionByName(rare).groupBy("uid").agg(*[F.sum(c).alias(c) for c in ("n_best", "count_sum")])


def align_tokens(docs: DataFrame, byte_bpe: str = BYTE_BPE, pieces: str = PIECES, frequent: int = FREQUENT) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row of ``docs`` (doc_id, text).

    The vocabularies are read by the driver, a few MB, and travel with the job.

    Defined results: null and empty texts, and those whose bytes the tokens do not give back (as one with U+2581), have zeros
    and the hash ''; white space is text; repeated rows and rows that share an id stay rows of their own, and each
    counts as a document that holds its pairs; texts of any length are aligned whole; null ids stay null; other columns are
    not read; an empty table gives no rows.
    """
    with open(byte_bpe, "rb") as f, open(pieces, "rb") as g:
        files = f.read(), g.read()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("uid", F.monotonically_increasing_id())
    first = cut(first_pass(rows, *files))
    columns = ["uid", "doc_id", *[c.split()[0] for c in DONE.split(", ")]]
    done, parts = first.where("no IS NULL").select(columns), first.where("no IS NOT NULL").select("uid", "doc_id", "no", "part", "lead", "size")
    if not parts.isEmpty():
        done = done.unionByName(cut(long_documents(parts, *files)).select(columns))
    n_b = sentencepiece.SentencePieceProcessor(model_proto=files[1]).get_piece_size()
    counts = cut(pair_counts(done, n_b))
    sums = scored(done, counts, frequent)
    # What goes with the sums is small: the numbers of a document.
    out = done.drop("pairs", "times").join(sums, "uid", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), F.col("sha").alias("groups_sha256"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"))
