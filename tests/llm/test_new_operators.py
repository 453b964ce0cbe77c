"""Prefix trie, alignment of tokenizers and near vectors against brute force, with odd rows."""

import hashlib
import os
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
import tokenizers

from heliograph.llm import near_vectors, prefix_trie, token_alignment as ta

TURNS = "conv_id long, turn long, role string, text string, conv string, depth int"


def trie(rows):
    """Nodes of the rebuilt conversations, as the contract has them."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    for c in own:
        own[c] = [x[2:] for x in sorted(own[c])]
    full = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        full[c] = own.get(base, [])[:h] + own[c][h:]
    members = defaultdict(list)
    for c, seq in full.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
    kids = defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    out = {}

    def visit(p):
        below = [visit(k) for k in kids[p]]
        words = len(p[-1][1].split()) if p else 0
        leaves, saved = sum(b[0] for b in below) or 1, sum(b[1] for b in below) + (len(members[p]) - 1) * words
        ends = sorted(c for c in members[p] if len(full[c]) == len(p))
        parent = min(members[p[:-1]]) if p else None
        out[min(members[p]), len(p)] = (parent, len(members[p]), len(kids[p]), leaves, saved, hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest())
        return leaves, saved

    if members:
        visit(())
    return out


def nodes(df):
    return {(r.conv_id, r.depth): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in df.collect()}


def test_trie_against_brute_force(spark):
    r = random.Random(7)
    rows = [(c, t, r.choice(["user", "bot"]), r.choice(["a b", "a", "c d e", "", None])) for c in [*range(0, 90), -7, -40, 1000] for t in range(r.choice([0, 1, 2, 3, 5, 9]) + (c == 40) * 70)]
    # A long conversation, copies of one, null turns and roles, repeated rows, no id; 21 has a family without its first conversation.
    rows += [(c, t, None, "x y") for c in range(200, 260) for t in range(3)] + [(300, None, "user", "first"), (300, 0, None, None), (300, 0, None, None), (None, 1, "user", "lost"), (None, None, None, None), (21, 99, "user", "w " * 3000)]
    rows = [x for x in rows if x[0] != 20]
    df = spark.createDataFrame([(*x, "clash", 1) for x in rows], TURNS).repartition(5)
    want = trie(rows)
    got = nodes(prefix_trie.prefix_trie(df))
    assert got == want and len(want) > 200 and max(d for _, d in want) > 64


def test_trie_of_little(spark):
    empty = spark.createDataFrame([], TURNS)
    assert prefix_trie.prefix_trie(empty).collect() == []
    # Conversation 6 lends two turns of 0, which is not there, and has no more: only the root is left of it.
    one = [(c, 0, "user", "a") for c in range(1, 40) if zlib.crc32(str(c).encode()) % 4 and c // 20 == 0][:1]
    got = nodes(prefix_trie.prefix_trie(spark.createDataFrame([(*x, "", 0) for x in one], TURNS)))
    assert got == trie(one) and [d for _, d in got] == [0]


def test_ends_of_many_conversations_are_hashed_in_order(spark, monkeypatch):
    last = spark.range(20_000).selectExpr("5L AS node", "1L AS depth", "id * 3 AS conv").repartition(7)
    monkeypatch.setattr(prefix_trie, "PART", 100)
    row = prefix_trie.ends(last).first()
    assert row.ends_sha256 == hashlib.sha256(",".join(str(3 * i) for i in range(20_000)).encode()).hexdigest()


@pytest.fixture(scope="module")
def vocabularies():
    a = tokenizers.Tokenizer.from_file(ta.BYTE_BPE)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=ta.PIECES)
    letters = ta.byte_letters()
    bytes_a = {v: bytes(letters[c] for c in k) for k, v in a.get_vocab().items() if k != "<|endoftext|>"}
    bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in range(b.get_piece_size())]
    return lambda t: a.encode(" " + t, add_special_tokens=False).ids, b.encode, bytes_a, bytes_b


def aligned(texts, vocabularies):
    """n_a, n_b, n_groups, n_links, n_best, count_sum and the hash of each text, by walking both token lists."""
    encode_a, encode_b, bytes_a, bytes_b = vocabularies
    all_, counts = [], Counter()
    for t in texts:
        a, b = (encode_a(t), encode_b(t)) if t else ([], [])
        whole = (" " + (t or "")).encode()
        if not t or b"".join(bytes_a[i] for i in a) != whole or b"".join(bytes_b[i] for i in b) != whole:
            all_.append(None)
            continue
        i = j = x = y = 0
        groups, links, ga, gb = [], [], [], []
        while i < len(a):
            links.append((a[i], b[j]))
            nx, ny = x + len(bytes_a[a[i]]), y + len(bytes_b[b[j]])
            if nx <= ny:
                ga.append(str(a[i]))
            if ny <= nx:
                gb.append(str(b[j]))
            if nx == ny:
                groups.append(",".join(ga) + "|" + ",".join(gb))
                ga, gb = [], []
            i, x, j, y = (i + 1, nx, j, y) if nx < ny else (i, x, j + 1, ny) if ny < nx else (i + 1, nx, j + 1, ny)
        all_.append((len(a), len(b), groups, links))
        counts.update(set(links))
    best = defaultdict(int)
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    none = (0, 0, 0, 0, 0, 0, "")
    return [none if x is None else (x[0], x[1], len(x[2]), len(x[3]), sum(counts[p] == best[p[0]] for p in x[3]), sum(counts[p] for p in x[3]), hashlib.sha256(";".join(x[2]).encode()).hexdigest()) for x in all_]


NAMES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
ODD = [
    None, "", " ", "\n", "\nfoo bar", "foo\nbar \n\n baz  qux\t\x1c y", " lead and trail ", "a▁b", "é  b c　d", "<s> </s> <|endoftext|> z", "it's 1234567 don't!! x_y", "\U0001f600 \U0001f600", "word " * 900, "日本語。" * 700, " " * 3000 + "x" * 3000,
    "q\n" * 1500, "mixed 日本 text, with 12.5 % of " * 120 + "end", "same text", "same text",
]


def test_alignment_against_brute_force(spark, vocabularies, monkeypatch):
    # Documents of over 1,000 bytes are cut into ranges of 300, which end within words and letters.
    monkeypatch.setattr(ta, "LONG", 1000), monkeypatch.setattr(ta, "CHUNK", 300), monkeypatch.setattr(ta, "MARGIN", 60), monkeypatch.setattr(ta, "ARITY", 3)
    r = random.Random(3)
    texts = ODD + [" ".join("".join(r.choice("abcdeé日,.-'1") for _ in range(r.randint(1, 9))) for _ in range(r.randint(1, 400))) for _ in range(30)]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(texts)], "doc_id long, text string, uid int, no string").repartition(3)
    want = aligned(texts, vocabularies)
    for frequent in (ta.FREQUENT, 50, 0):  # all pairs are broadcast, the frequent ones, none
        got = {x.doc_id: tuple(x[c] for c in NAMES) for x in ta.align_tokens(df, frequent=frequent).collect()}
        assert [got[i] for i in range(len(texts))] == want
    assert ta.align_tokens(df.limit(0)).collect() == []


def test_fragments_are_associative(vocabularies):
    encode_a, encode_b, *_ = vocabularies
    with open(ta.BYTE_BPE, "rb") as f, open(ta.PIECES, "rb") as g:
        al = ta.Aligner(f.read(), g.read())
    text = "日本語, mixed words and 日本 " * 9
    size, r = len(text.encode()) + 1, random.Random(1)
    for _ in range(10):
        cuts = [0, *sorted(r.sample(range(1, size), 6)), size]
        parts = [{**ta.fragment(al, text, lo, hi - lo), "first": i} for i, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:]))]
        seen = []
        for order in range(3):
            todo, seams = list(parts), {i: p["closed"] for i, p in enumerate(parts) if p["n_groups"]}
            while len(todo) > 1:
                k = 0 if order == 0 else len(todo) - 2 if order == 1 else r.randrange(len(todo) - 1)
                merged, seam = ta.compose(todo[k], todo[k + 1])
                todo[k : k + 2] = [merged]
                if seam:
                    seams[seam[0] - 0.5] = al.aligned(seam[1], seam[2])[0]
            seams[todo[0]["first"] - 0.5] = al.aligned(todo[0]["prefix_a"], todo[0]["prefix_b"])[0]
            assert not todo[0]["suffix_a"] and not todo[0]["suffix_b"]
            seen.append(b";".join(seams[k] for k in sorted(seams)))
        assert seen == [al.aligned(encode_a(text), encode_b(text))[0]] * 3


def test_long_units_take_linear_time(vocabularies):
    import time

    with open(ta.BYTE_BPE, "rb") as f, open(ta.PIECES, "rb") as g:
        al = ta.Aligner(f.read(), g.read())
    for text in ("x" * 300_000, " " * 300_000, "\n" * 300_000, "日本" * 100_000):
        began = time.time()
        assert ta.whole(al, [text])[0]["n_links"] and time.time() - began < 20


def vectors(seed, n, d=24):
    r = np.random.Generator(np.random.PCG64(seed))
    x = r.standard_normal((n, d)) + 0.4
    x[n // 3 : n // 2] = x[3] + 0.25 * r.standard_normal((n // 2 - n // 3, d))  # a large group, some of it near enough
    x[n - 8 : n - 4], x[n - 4 :] = x[5], 3 * x[6]
    return x.astype(np.float32)


def test_near_vectors_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(near_vectors, "BLOCK_ROWS", 50), monkeypatch.setattr(near_vectors, "TILE", 16)
    x, r = vectors(1, 400), random.Random(2)
    rows = [(i, v.tolist(), i % 2) for i, v in enumerate(x)] + [(400 + i, x[7].tolist(), None) for i in range(2)]
    rows += [(500, None, 1), (501, [0.0] * 24, 1), (502, [None, *[1.0] * 23], 1), (503, [float("nan")] * 24, 1), (504, [float("inf")] * 24, 1), (505, x[7].tolist()[:20], 1), (506, [], 1), (None, x[9].tolist(), 1), (507, x[3].tolist(), 3), (3, x[3].tolist(), 1)]
    rows += [(600, [1e200] * 24, 4), (601, [1e-200] * 24, 4), (602, [-1e-200] * 24, 4), (603, [0.0, -0.0, 1.0], 4), (604, [-0.0, 0.0, 1.0], 4)]
    r.shuffle(rows)
    good = [v is not None and len(v) > 0 and lab is not None and all(y is not None and np.isfinite(y) for y in v) and any(v) for _, v, lab in rows]
    unit = [None if not g else np.array(v) / np.abs(v).max() for (_, v, _), g in zip(rows, good)]
    unit = [None if u is None else u / np.sqrt(u @ u) for u in unit]
    link = [[j for j in range(len(rows)) if i != j and good[i] and good[j] and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]) and unit[i] @ unit[j] >= 0.93] for i in range(len(rows))]
    want = Counter()
    for i, (vec, _, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            todo += [j for j in link[todo.pop()] if j not in seen and not seen.add(j)]
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        component = min(ids) if ids else None
        want[vec, len(link[i]), component, vec == component] += 1
    df = spark.createDataFrame([(a, b, c, "x", 1) for a, b, c in rows], "vec_id long, embedding array<double>, label int, node string, n int").repartition(4)
    got = Counter((x.vec_id, x.n_links, x.component_id, x.kept) for x in near_vectors.near_vectors(df).collect())
    assert got == want and max(k[1] for k in want) > 20 and sum(1 for k in want if 0 < k[1]) > 30
    assert near_vectors.near_vectors(df.limit(0)).collect() == []


def test_tiles_leave_pairs_early():
    x = vectors(5, 300, 64).astype(float)
    basis = np.linalg.eigh(near_vectors.unit(x).T @ near_vectors.unit(x))[1][:, ::-1]
    block = near_vectors.Block(x.tobytes(), 64, basis)
    i, j = near_vectors.linked(block, block, slice(0, 300), slice(0, 300), 0.93)
    u = near_vectors.unit(x)
    assert {*zip(i.tolist(), j.tolist())} == {*zip(*(k.tolist() for k in np.nonzero(u @ u.T >= 0.93)))}
    # The rests bound what later axes can add.
    for n, (_, hi) in enumerate(near_vectors.steps(64), 1):
        rest = (block.y[:, hi:] @ block.y[:, hi:].T) if hi < 64 else np.zeros((300, 300))
        assert (np.abs(rest) <= np.outer(block.rest[:, n], block.rest[:, n]) + 1e-12).all()


def test_edges_of_a_dense_group_are_few():
    forest = near_vectors.Forest(1000)
    i, j = np.triu_indices(1000, 1)
    forest.add(i, j)
    assert len(forest.edges) == 999


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test data")
@pytest.mark.parametrize("name, tables", [("op11_prefix_trie", ["conversations"]), ("op13_near_vectors", ["embeddings"])])
def test_queries_match_their_sql(spark, name, tables):
    import duckdb

    from heliograph.llm.queries import ORACLES, QUERIES

    con = duckdb.connect()
    for t in tables:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/sf0.001/{t}.parquet'")
    rel = con.sql(ORACLES[name])
    got = QUERIES[name](spark, "/root/testdata/sf0.001").select(rel.columns)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(rel.fetchall(), key=repr)
