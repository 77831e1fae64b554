import zlib
from itertools import combinations

import numpy as np
from helpers import BASE, HARD, documents, edited, prose
from hypothesis import given, settings
from hypothesis import strategies as st

from fleetscope.llm import neardup as N
from fleetscope.llm.common import words


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 6), max_size=25), st.lists(st.integers(0, 6), max_size=25))
def test_alignment(a, b):
    x, y = np.array(a, np.uint64), np.array(b, np.uint64)
    assert N.common_in_order(x, y, 100) == lcs(a, b)
    assert N.common_in_order(x, y, 2) <= lcs(a, b)
    want = lcs(a, b)
    similar = bool(a) and bool(b) and want / (len(a) + len(b) - want) >= 0.8 - 1e-12
    assert N.alike(x, y) == similar


def brute(rows):
    """Classes by comparing all pairs."""
    sh = [N.shingles(np.fromiter(map(zlib.crc32, words(t)), np.uint32)) for _, t in rows]
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, j in combinations(range(len(rows)), 2):
        if words(rows[i][1]) == words(rows[j][1]) or (sh[i].size and sh[j].size and N.alike(sh[i], sh[j])):
            up[root(i)] = root(j)
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None]
        out.append((d, min(ids) if ids else None))
    return sorted(out, key=str)


def got(spark, rows):
    return sorted((tuple(r) for r in N.classes(documents(spark, rows)).collect()), key=str)


def test_hard_rows(spark):
    assert got(spark, HARD) == brute(HARD)
    assert got(spark, []) == []


def test_family_of_edited_copies_and_chains(spark):
    """Copies whose pairs are often below the threshold, chains of copies of copies, and strangers."""
    rows = [(i, edited(BASE, i, i % 12)) for i in range(60)]
    last = prose(50, 200)
    for i in range(100, 112):
        last = edited(last, i, 2)
        rows.append((i, last))
    rows += [(200 + i, prose(900 + i, 120)) for i in range(20)]
    assert got(spark, rows) == brute(rows)


def test_large_bucket_is_dealt_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(N, "CHUNK", 8)
    rows = [(i, edited(BASE, 70 + i, 3 + i % 10)) for i in range(40)]
    assert got(spark, rows) == brute(rows)


def test_components(spark):
    edges = [(bytes([a]), bytes([b])) for a, b in [(9, 8), (8, 7), (7, 6), (6, 5), (1, 9), (20, 21), (30, 30), (21, 22)]]
    out = {r.key[0]: r.label[0] for r in N.components(spark.createDataFrame(edges, "a binary, b binary")).collect()}
    assert out == {**dict.fromkeys((1, 5, 6, 7, 8, 9), 1), **dict.fromkeys((20, 21, 22), 20)}
