"""Nearest neighbours: the share of vectors that is verified, equal vectors, widening."""

import numpy as np

from heliograph.llm import nearest


def brute(rows, ids, vectors, row, q, k):
    d = np.sqrt(((vectors - q) ** 2).sum(axis=1))
    order = np.lexsort((ids, d))
    return [(int(ids[i]), float(d[i])) for i in order[rows[order] != row][:k]]


def searched(vectors, asked, k=10, ids=None):
    rows = np.arange(len(vectors)) * 3 + 1
    ids = np.arange(len(vectors)) if ids is None else ids
    work, got = {}, {}
    for row, i, d in nearest.search_block(rows, ids, vectors, rows[asked], vectors[asked], k, work=work):
        got.setdefault(row, []).append((i, d))
    want = {int(rows[a]): brute(rows, ids, vectors, rows[a], vectors[a], k) for a in asked}
    return got, want, work["verified"] / len(asked) / len(vectors)


def hits(got, want):
    return sum(len(set(got[q]) & set(best)) for q, best in want.items()) / sum(len(best) for best in want.values())


def test_few_vectors_are_verified():
    # Unit vectors without clusters, as those of the given table: the ten nearest are hardly nearer than the others.
    v = np.random.Generator(np.random.PCG64(2)).standard_normal((8000, 64))
    got, want, share = searched(v / np.linalg.norm(v, axis=1, keepdims=True), np.arange(0, 8000, 100))
    assert hits(got, want) >= 0.95
    assert share < 0.2


def test_equal_vectors_are_verified_once():
    v = np.random.Generator(np.random.PCG64(3)).standard_normal((4000, 64))
    v[:3000] = v[0]
    got, want, share = searched(v, np.arange(0, 3000, 100))
    assert got == want
    assert share < 0.25


def test_all_candidates_where_fewer():
    r = np.random.Generator(np.random.PCG64(4))
    for n in (1, 2, 5, 10, 11):
        got, want, _ = searched(r.standard_normal((n, 8)), np.arange(n))
        assert got == {q: best for q, best in want.items() if best}


def test_far_query_widens():
    v = np.random.Generator(np.random.PCG64(5)).standard_normal((1000, 8))
    v[0] *= 1e6
    got, want, _ = searched(v, np.array([0, 1]), k=60)
    assert [len(x) for x in got.values()] == [60, 60]
    assert got[1] == want[1]
    assert hits(got, want) >= 0.9


def test_large_small_and_shifted_numbers():
    v = np.random.Generator(np.random.PCG64(6)).standard_normal((1000, 16))
    for x in (v * 1e140, v * 1e-140, v + 1e6):
        got, want, _ = searched(x, np.arange(0, 1000, 50))
        assert hits(got, want) >= 0.9
