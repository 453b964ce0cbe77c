"""Operator 8: sampled subword segmentations over a SentencePiece vocabulary, and lossless decoding.

A text is split into units no piece crosses: a word with the space before it, a
run of further spaces, or a line break. The lattice of a unit has an edge for each
piece; a character outside the vocabulary becomes its UTF-8 byte pieces. A forward
pass sums the weights of all ways to each position; a backward pass draws the last
piece, the one before it and so on, in proportion. Draws come from a counter hashed
with the row's key, so a row's segmentation depends on its key and text alone, not
on its partition or batch. The vocabulary's scores are merge ranks; a piece of rank
r weighs (r + 10) ** -alpha.

Short units go through the lattice side by side. A long one, whose sums would leave
the range of a float, is walked alone in windows, with sums scaled by powers of two,
which changes no draw; so memory grows with a text by a few numbers a character.

Decoding joins the pieces' bytes. The piece of a space stands for a space alone:
the character U+2581 itself is written in byte pieces, so every text comes back.

Defined results: a null text gives null ids and null decoded text, an empty text
no ids; equal keys with equal texts give equal ids, so repeated rows do; unpaired
surrogates cannot occur in Spark strings; texts of any length, with or without
spaces, are encoded whole; extra columns are carried, whatever their name, unless a
result has it; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import MASK64, fresh, slices, small_batches, table

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
UNIT = re.compile(r" ?[^ \n]+| +(?= [^ \n])| +|\n")
#: Longer units are walked alone. The least weight of a character is 1e-5, so sums over this many stay in a float's range.
SIDE_BY_SIDE = 48
#: Characters whose lattice is held at once.
WINDOW = 400_000
SPACE_MARK = "▁"
GOLD, MIX1, MIX2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """Splitmix64's finaliser over an array of counters."""
    x = (x ^ (x >> np.uint64(30))) * MIX1
    x = (x ^ (x >> np.uint64(27))) * MIX2
    return x ^ (x >> np.uint64(31))


class Vocabulary:
    """Pieces as a trie whose edges lie in one open hash table, so that whole batches walk it at once."""

    TABLE_BITS = 19

    def __init__(self, model: bytes, alpha: float):
        import sentencepiece

        p = sentencepiece.SentencePieceProcessor(model_proto=model)
        pieces: dict[str, int] = {}
        weights = np.zeros(p.get_piece_size())
        self.bytes: list[bytes] = [b""] * p.get_piece_size()
        self.byte_ids = np.zeros(256, np.int32)
        for i in range(p.get_piece_size()):
            piece = p.id_to_piece(i)
            if p.is_byte(i):
                self.byte_ids[int(piece[1:-1], 16)] = i
                self.bytes[i] = bytes([int(piece[1:-1], 16)])
            elif not (p.is_control(i) or p.is_unknown(i) or p.is_unused(i)):
                rank = max(0.0, -p.get_score(i)) if p.get_score(i) > -1e8 else 1000.0
                text = piece.replace(SPACE_MARK, " ")
                pieces[text] = i
                weights[i] = (rank + 10.0) ** -alpha
                self.bytes[i] = text.encode()
        self.longest = max(map(len, pieces))
        edges: dict[int, int] = {}
        node_piece = [-1]
        for text, i in pieces.items():
            node = 0
            for c in text:
                key = node << 21 | ord(c)
                if key not in edges:
                    edges[key] = len(node_piece)
                    node_piece.append(-1)
                node = edges[key]
            node_piece[node] = i
        self.node_piece = np.array(node_piece, np.int32)
        self.node_weight = np.where(self.node_piece >= 0, weights[self.node_piece], 0.0)
        self.keys = np.full(1 << self.TABLE_BITS, -1, np.int64)
        self.nodes = np.zeros(1 << self.TABLE_BITS, np.int32)
        slots = self.slot(np.fromiter(edges, np.int64, len(edges))).tolist()
        for at, (key, node) in zip(slots, edges.items()):
            while self.keys[at] >= 0:
                at = (at + 1) & (len(self.keys) - 1)
            self.keys[at], self.nodes[at] = key, node

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * GOLD) >> np.uint64(64 - self.TABLE_BITS)).astype(np.int64)

    def step(self, node: np.ndarray, char: np.ndarray) -> np.ndarray:
        """The nodes below ``node`` by ``char``; -1 where there is none."""
        key = node.astype(np.int64) << 21 | char
        at = self.slot(key)
        held = self.keys[at]
        out = np.where(held == key, self.nodes[at], -1)
        todo = np.flatnonzero((held != key) & (held >= 0))
        while len(todo):
            at[todo] = (at[todo] + 1) & (len(self.keys) - 1)
            held = self.keys[at[todo]]
            hit = held == key[todo]
            out[todo[hit]] = self.nodes[at[todo[hit]]]
            todo = todo[~hit & (held >= 0)]
        return out


class Numbers(dict):
    """Numbers keys in the order they come."""

    def __missing__(self, key: str) -> int:
        value = self[key] = len(self)
        return value


def model_bytes(path: str) -> bytes:
    """The vocabulary file, a megabyte or less; the driver ships it to the tasks, which need no such file."""
    with open(path, "rb") as f:
        return f.read()


class Sampler:
    #: The weight of a character that is spelt in byte pieces.
    BYTES_WEIGHT = 1e-5

    def __init__(self, model: bytes | str = MODEL, alpha: float = 1.0):
        self.v = Vocabulary(model_bytes(model) if isinstance(model, str) else model, alpha)

    def tables(self, chars: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece and weight by end position and length; ``left`` has the characters from each position to its unit's end."""
        v, total = self.v, len(chars)
        # Row e holds the pieces that end at position e, by length: both passes go through a row at a time.
        piece = np.full((total, v.longest + 1), -1, np.int32)
        weight = np.zeros((total, v.longest + 1), np.float32)
        at = np.flatnonzero(left > 0)
        node = np.zeros(len(at), np.int32)
        for n in range(1, v.longest + 1):
            node = v.step(node, chars[at + n - 1])
            on = node >= 0
            at, node = at[on], node[on]
            piece[at + n, n], weight[at + n, n] = v.node_piece[node], v.node_weight[node]
            on = left[at] > n
            at, node = at[on], node[on]
            if not len(at):
                break
        alone = 1 + np.flatnonzero((left[:-1] > 0) & (piece[1:, 1] < 0))
        weight[alone, 1] = self.BYTES_WEIGHT
        return piece, weight

    def lattice(self, units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For all units side by side: characters, each unit's first position, and by length and start the piece and its
        weight; last the forward sums by end position (a unit of n characters has n + 1 positions)."""
        v = self.v
        sizes = np.array([len(u) for u in units], np.int64)
        base = np.cumsum(sizes + 1) - (sizes + 1)
        chars = np.frombuffer("\0".join([*units, ""]).encode("utf-32-le"), np.uint32).astype(np.int64)
        total = len(chars)
        left = np.repeat(base + sizes, sizes + 1) - np.arange(total)  # characters from here to the unit's end
        piece, weight = self.tables(chars, left)
        forward = np.zeros(total)
        forward[base] = 1.0
        order = np.argsort(-sizes, kind="stable")
        longest_first, sorted_sizes = base[order], -sizes[order]
        for j in range(1, int(sizes.max(initial=0)) + 1):
            ends = longest_first[: np.searchsorted(sorted_sizes, -j, side="right")] + j
            sums = np.zeros(len(ends))
            for n in range(1, min(j, v.longest) + 1):
                sums += forward[ends - n] * weight[ends, n]
            forward[ends] = sums
        return chars, base + sizes, piece, weight, forward

    def encode(self, texts: list[str], keys: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of all texts one after another, and the offset of each text (one more than texts)."""
        per = [UNIT.findall(t) for t in texts]
        sizes = np.array([len(p) for p in per], np.int64)
        units = list(chain.from_iterable(per))
        seeds = np.repeat(mixed(np.array([k & 0xFFFFFFFFFFFFFFFF for k in keys], np.uint64)), sizes)
        within = np.arange(len(units), dtype=np.uint64) - np.repeat(np.cumsum(sizes) - sizes, sizes).astype(np.uint64)
        counter = seeds + within * GOLD
        long = np.array([len(u) > SIDE_BY_SIDE for u in units], bool)
        counts, parts = np.zeros(len(units), np.int64), []
        for lo, hi in slices([len(u) for u in units], WINDOW):
            short = np.flatnonzero(~long[lo:hi]) + lo
            got, counts[short] = self._drawn([units[i] for i in short.tolist()], counter[short])
            alone = [(i, self._walked(units[i], counter[i])) for i in (np.flatnonzero(long[lo:hi]) + lo).tolist()]
            if alone:
                counts[[i for i, _ in alone]] = [len(x) for _, x in alone]
                mixed_in = np.empty(int(counts[lo:hi].sum()), np.int32)
                by_unit = np.repeat(long[lo:hi], counts[lo:hi])
                mixed_in[~by_unit], mixed_in[by_unit] = got, np.concatenate([x for _, x in alone])
                got = mixed_in
            parts.append(got)
        out = np.concatenate([np.zeros(0, np.int32), *parts])
        ends = np.cumsum(counts)
        offsets = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(sizes)))]
        return self._spelt(out, offsets)

    def _drawn(self, units: list[str], counter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of short units one after another (-1 - code point for a character outside the vocabulary), and how many each has."""
        known = Numbers()
        unit = np.array([known[u] for u in units], np.int64)
        chars, last, piece, weight, forward = self.lattice(list(known))
        first = np.concatenate(([0], last[:-1] + 1)) if len(last) else last
        begin, end = first[unit], last[unit]
        live, taken, step = np.arange(len(unit)), [], np.zeros(1, np.uint64)
        while len(live):
            here, least = end[live], begin[live]
            rest = forward[here] * ((mixed(counter[live] + step) >> np.uint64(11)).astype(np.float64) * 2.0**-53)
            chosen = np.zeros(len(live), np.int64)
            todo, n, e, r, low = np.arange(len(live)), 1, here, rest, least
            while len(todo) and n <= self.v.longest:
                r = r - forward[e - n] * weight[e, n]
                on = (r >= 0) & (e - n > low)
                chosen[todo] = n
                todo, e, r, low = todo[on], e[on], r[on], low[on]
                n += 1
            start = here - chosen
            void = np.flatnonzero(weight[here, chosen] == 0)  # rounding left a remainder: take the longest piece there is
            if len(void):
                chosen[void] = self.v.longest - np.argmax(weight[here[void], ::-1] > 0, axis=1)
                start = here - chosen
            ids = piece[here, chosen]
            taken.append((live, np.where(ids >= 0, ids, -chars[start] - 1).astype(np.int32)))
            end[live] = start
            live = live[start > least]
            step = step + MIX1
        counts = np.zeros(len(unit), np.int64)
        for owner, _ in taken:
            counts[owner] += 1
        ends = np.cumsum(counts)
        out = np.empty(int(ends[-1]) if len(ends) else 0, np.int32)
        for k, (owner, got) in enumerate(taken):
            out[ends[owner] - 1 - k] = got
        return out, counts

    def _windows(self, chars: np.ndarray, backward: bool) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(before, up to, piece, weight) of the end positions of one long unit, some at a time; row e - before has the end e."""
        n, most = len(chars), self.v.longest
        edges = list(range(0, n, WINDOW))
        for lo in reversed(edges) if backward else edges:
            hi, start = min(n, lo + WINDOW), max(0, lo - most)
            part = np.append(chars[start:hi], 0)
            piece, weight = self.tables(part, np.arange(len(part) - 1, -1, -1))
            yield lo, hi, piece[lo - start :], weight[lo - start :]

    def _walked(self, unit: str, counter: np.uint64) -> np.ndarray:
        """The pieces of one long unit, drawn as ``_drawn`` would. A sum is ``raw`` * 2 ** (-256 * ``scale``)."""
        chars, most = np.frombuffer(unit.encode("utf-32-le"), np.uint32).astype(np.int64), self.v.longest
        n, up = len(chars), 2.0**256
        raw, scale = np.zeros(n + 1), np.zeros(n + 1, np.int32)
        raw[0] = 1.0
        recent, now = [1.0], 0  # sums before the next position, the nearest first, in the scale of now
        for lo, hi, _, weight in self._windows(chars, False):
            rows = weight.astype(np.float64)
            for e in range(lo + 1, hi + 1):
                total = 0.0
                for f, w in zip(recent, rows[e - lo, 1:].tolist()):
                    if w:
                        total += f * w
                if total < 1 / up:
                    total, now, recent = total * up, now + 1, [f * up for f in recent]
                raw[e], scale[e] = total, now
                recent = [total, *recent[: most - 1]]
        out, e, step, seed = [], n, 0, int(counter)
        for lo, hi, piece, weight in self._windows(chars, True):
            while e > lo:
                rest = float(raw[e]) * (float(mixed(np.array([(seed + step) & MASK64], np.uint64))[0] >> np.uint64(11)) * 2.0**-53)
                row, k = weight[e - lo], 0
                while k < most:
                    k += 1
                    rest -= float(raw[e - k]) * up ** int(scale[e] - scale[e - k]) * float(row[k])
                    if rest < 0 or e - k <= 0:
                        break
                if row[k] == 0:
                    k = most - int(np.argmax(row[::-1] > 0))
                i = int(piece[e - lo, k])
                out.append(i if i >= 0 else -int(chars[e - k]) - 1)
                e -= k
                step += int(MIX1)
        return np.array(out[::-1], np.int32)

    def _spelt(self, out: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Replace characters outside the vocabulary (-1 - code point) by their byte pieces."""
        odd = np.flatnonzero(out < 0)
        if not len(odd):
            return out, offsets
        code = -1 - out[odd].astype(np.int64)
        spelt = [self.v.byte_ids[list(chr(c).encode())] for c in code.tolist()]
        lengths = np.ones(len(out), np.int64)
        lengths[odd] = [len(x) for x in spelt]
        ends = np.concatenate(([0], np.cumsum(lengths)))
        wide = np.repeat(out, lengths)
        wide[np.repeat(ends[odd], lengths[odd]) + np.concatenate([np.arange(len(x)) for x in spelt])] = np.concatenate(spelt)
        return wide, ends[offsets]

    def decode(self, ids: list[int]) -> str:
        b = self.v.bytes
        return b"".join([b[i] for i in ids]).decode("utf-8")


def row_key(*columns: Column, seed: int = 0) -> Column:
    return F.xxhash64(F.lit(seed), *columns)


def encode_pieces(docs: DataFrame, key: Column, text_col: str = "text", model: str = MODEL, alpha: float = 1.0) -> DataFrame:
    """``docs`` with ids (the sampled pieces), n_pieces and lossless (decoding gave the text again)."""
    shared = docs.sparkSession.sparkContext.broadcast(model_bytes(model))
    rows = docs.drop("ids", "n_pieces", "lossless")
    key_col = fresh("key", rows.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler(shared.value, alpha)
        for b in batches:
            texts, keys = b.column(text_col).to_pylist(), b.column(key_col).to_pylist()
            for lo, hi in slices([len(t or "") for t in texts], WINDOW):
                part = [t or "" for t in texts[lo:hi]]
                flat, offsets = sampler.encode(part, keys[lo:hi])
                null = np.array([t is None for t in texts[lo:hi]])
                same = [None if n else sampler.decode(flat[x:y].tolist()) == t for t, n, x, y in zip(part, null, offsets[:-1], offsets[1:])]
                ids = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat), mask=pa.array(null))
                piece = b.slice(lo, hi - lo)
                names = [c for c in piece.schema.names if c != key_col]
                yield pa.RecordBatch.from_arrays(
                    [*(piece.column(c) for c in names), ids, pa.array(np.diff(offsets), mask=null), pa.array(same, pa.bool_())], [*names, "ids", "n_pieces", "lossless"]
                )

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return small_batches(rows.withColumn(key_col, key)).mapInArrow(run, f"{kinds}, ids array<int>, n_pieces long, lossless boolean")


def decode_pieces(rows: DataFrame, ids_col: str = "ids", model: str = MODEL) -> DataFrame:
    """``rows`` with ``decoded``, the text of the pieces; null ids give null."""
    shared = rows.sparkSession.sparkContext.broadcast(model_bytes(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler(shared.value)
        for b in batches:
            texts = [None if x is None else sampler.decode(x) for x in b.column(ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], [*b.schema.names, "decoded"])

    rows = rows.drop("decoded")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return small_batches(rows).mapInArrow(run, f"{kinds}, decoded string")


def op8_sampled_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode_pieces(docs, row_key(F.col("doc_id"))).drop("text")
