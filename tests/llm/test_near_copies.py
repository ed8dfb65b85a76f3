import random

import numpy as np
from pyspark.sql import functions as F

from emberline.llm import passages as P
from emberline.llm import simhash as S

from .helpers import ODD, documents, empty, odd


def rank(x):
    x = x.copy()
    for k in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(k)
    return x


def near(rng, n, most):
    return np.unique(np.array([0x123456789ABCDEF0 ^ sum(1 << int(b) for b in rng.choice(64, int(rng.integers(0, most)), replace=False)) for _ in range(n)], np.uint64))


def groups(nodes, a, b):
    parent = {int(x): int(x) for x in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x, y in zip(a.tolist(), b.tolist()):
        parent[max(find(x), find(y))] = min(find(x), find(y))
    return [find(int(x)) for x in nodes]


def test_index_finds_all_pairs_and_the_forest_all_links():
    rng = np.random.default_rng(3)
    for n, most in ((9, 4), (300, 9), (2000, 12)):
        g = np.sort(rank(near(rng, n, most)))
        f = g ^ (g >> np.uint64(1))
        q, m = S.HierarchicalIndex(f).search(f[:50])
        assert {(int(x), int(y)) for x, y in zip(q, m)} == {(i, int(j)) for i in range(min(50, len(f))) for j in np.flatnonzero(np.bitwise_count(f ^ f[i]) <= 4)}
        pairs = [(x, y) for x in f for y in f[np.bitwise_count(f ^ x) <= 4]]
        assert groups(f, *S.forest(f)) == groups(f, np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs]))


def test_components_equal_brute_force(spark, small):
    rows = documents(spark, small)
    want = S.brute_force([(r.doc_id, r.text) for r in rows])
    got = {r.doc_id: (f"{r.fp & (1 << 64) - 1:016x}", r.component_id) for r in S.near_duplicates(spark.read.parquet(f"{small}/documents.parquet")).collect()}
    assert got == want


def test_every_number_of_blocks_gives_the_same_groups(spark, monkeypatch):
    """Every number of blocks leaves each link in a key, and the index of each key finds it."""
    f = near(np.random.default_rng(6), 700, 11)
    pairs = [(int(x), int(y)) for x in f for y in f[np.bitwise_count(f ^ x) <= 4]]
    want = groups(f, np.array([p[0] for p in pairs], np.uint64), np.array([p[1] for p in pairs], np.uint64))
    df = spark.createDataFrame([(int(x),) for x in f.view(np.int64)], "fp long")
    for c, tables in ((0, 1), (1, 5), (2, 15), (3, 35)):
        masks = S.key_masks(c)
        assert len(masks) == tables and all(any((x ^ y) & m == 0 for m in masks) for x, y in pairs)
        monkeypatch.setattr(S, "blocks_for", lambda n, most, c=c: c)
        rows = S.fingerprint_links(df).collect()
        a, b = (np.array([getattr(r, k) for r in rows], np.int64).view(np.uint64) for k in "ab")
        assert groups(f, a, b) == want
    monkeypatch.undo()
    assert [S.blocks_for(n, 16_384) for n in (0, 16_384, 10**6, 10**9, 10**12)] == [0, 0, 1, 2, 3]


def test_large_keys_are_cut_without_losing_links(spark):
    f = near(np.random.default_rng(5), 900, 10)
    df = spark.createDataFrame([(int(x),) for x in f.view(np.int64)], "fp long")
    whole, cut = (S.fingerprint_links(df, most).collect() for most in (16_384, 40))
    as_arrays = lambda rows: (np.array([r.a for r in rows], np.int64).view(np.uint64), np.array([r.b for r in rows], np.int64).view(np.uint64))
    assert groups(f, *as_arrays(whole)) == groups(f, *as_arrays(cut))


def test_odd_rows(spark):
    got = S.near_duplicates(odd(spark)).collect()
    assert len(got) == len(ODD)
    by = {r.doc_id: r for r in got}
    assert by[1].component_id == by[2].component_id == 1
    assert by[3].fp == by[4].fp == by[5].fp == 0 and by[4].component_id == 3
    assert S.near_duplicates(empty(spark)).count() == 0


def test_repeated_passages_cover_every_shared_run(spark, small):
    rows = documents(spark, small)
    words = {r.doc_id: P.words_of(r.text) for r in rows}
    holders = {}
    for i, w in words.items():
        for p in range(len(w) - 49):
            holders.setdefault(tuple(w[p : p + 50]), set()).add(i)
    covered = {}
    for r in P.repeated_passages(spark.read.parquet(f"{small}/documents.parquet")).collect():
        covered.setdefault(r.doc_id, []).append((r.start, r.end))
        covered.setdefault(r.other_id, []).append((r.other_start, r.other_end))
    for i, w in words.items():
        for p in range(len(w) - 49):
            if len(holders[tuple(w[p : p + 50])]) > 1:
                assert any(a <= p and p + 50 <= b for a, b in covered.get(i, ())), (i, p)


def test_fuzzy_passage_is_found_whole():
    r = random.Random(2)
    v = [f"w{k}" for k in range(3000)]
    base, a, b = ([r.choice(v) for _ in range(n)] for n in (60, 200, 300))
    edited = list(base)
    edited[20] = "X"
    edited.insert(40, "Y")
    a[50:50], b[100:100] = base, edited
    a, b = ([x.encode() for x in t] for t in (a, b))
    assert P.passages(a, b, P.hash_words(a), P.hash_words(b), 50, 0.8) == [(50, 110, 100, 161, 59)]
    assert P.passages(a[:40], b[:40], P.hash_words(a[:40]), P.hash_words(b[:40]), 50, 0.8) == []


def test_chains_ascend_and_use_each_anchor_once():
    r = random.Random(4)
    points = sorted({(r.randrange(60), r.randrange(60)) for _ in range(150)})
    found = P.chains(points)
    assert sorted(x for c in found for x in c) == points
    for c in found:
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(c, c[1:]))
    # the best chain's score is the best over all ends, by a plain quadratic recurrence
    best = {}
    for x, y in points:
        best[x, y] = 1 + max([0.0] + [best[p] - P.GAP * (x - p[0] + y - p[1]) for p in best if p[0] < x and p[1] < y])
    score = lambda c: len(c) - P.GAP * (c[-1][0] - c[0][0] + c[-1][1] - c[0][1])
    assert abs(score(found[0]) - max(best.values())) < 1e-9


def test_passages_of_odd_rows(spark):
    got = {(r.doc_id, r.other_id) for r in P.repeated_passages(odd(spark)).collect()}
    assert (2, 1) in got and (9, 1) in got and all(x is not None for p in got for x in p)
    assert P.repeated_passages(empty(spark)).count() == 0
    assert P.repeated_passages(odd(spark).filter(F.col("doc_id") == 7)).count() == 0
