"""op8's classes of a seed meet by leaders: rows in proportion to near copies, no link between different texts lost."""

import random

import numpy as np

from emberline.llm import passages as P

from .test_passage_links import SCHEMA, edited, fresh


def joined(pairs):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in pairs:
        root[find(a)] = find(b)
    return find


def test_near_copies_and_common_lines_give_rows_in_proportion(spark, tmp_path):
    r = random.Random(21)
    copy, line, rows = fresh(r, 120), fresh(r, 14), []
    for k in range(60):  # near copies, each with its own edits at the same places
        rows.append((k, edited(random.Random(k), copy, 9)))
        rows.append((100 + k, fresh(r, 70) + line + fresh(r, 70)))  # a line that many unlike texts hold
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], SCHEMA)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = [(x.doc_id, x.other_id) for x in P.op8_passages(spark, str(tmp_path)).collect()]
    want = {(x.doc_id, x.other_id) for x in P.repeated_passages(docs, every=True).collect()}
    assert len(want) > 1000 and len(got) <= 5 * 60
    find = joined(got)
    assert all(find(a) == find(b) for a, b in want) and {i for p in got for i in p} == set(range(60))


def test_texts_whose_leader_shares_no_passage_are_compared(spark):
    """The leader's words are near enough for the bound, in an order that is no passage; the two behind it share one."""
    r = random.Random(22)
    run = fresh(r, 60)
    mixed = [w for n in range(0, 60, 10) for w in (run[n : n + 10] if n == 30 else run[n : n + 10][::-1])]
    rows = [(1, fresh(r, 80) + mixed + fresh(r, 80)), (2, fresh(r, 50) + run + fresh(r, 50)), (3, fresh(r, 20) + edited(r, run, 15) + fresh(r, 60))]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], SCHEMA)
    assert {(x.doc_id, x.other_id) for x in P.repeated_passages(docs, leaders=True).collect()} == {(3, 2)}


def test_the_bound_admits_every_passage_around_its_seed():
    r, bound = random.Random(23), P._Bound(50, 0.8)
    codes = lambda n: np.array([r.randrange(1, 256) for _ in range(n)], np.uint8)
    a, b = [], []
    for _ in range(400):
        n = r.randrange(50, 100)
        x = codes(n)
        seed = r.randrange(0, n - P.K + 1)
        y, lost = x.copy(), [i for i in range(n) if not seed <= i < seed + P.K]
        for i in r.sample(lost, n // 5):
            y[i] = r.randrange(1, 256)
        p, q = r.randrange(0, 120), r.randrange(0, 120)
        a.append(P.window(np.concatenate([codes(p), x, codes(r.randrange(0, 120))]), p + seed, bound.reach))
        b.append(P.window(np.concatenate([codes(q), y, codes(r.randrange(0, 120))]), q + seed, bound.reach))
    a, b = np.stack(a), np.stack(b)
    assert bound.pairs(a, b).all() and all(bound.one(x[None], y)[0] for x, y in zip(a, b))
    other = np.roll(b, 1, axis=0)
    assert (bound.pairs(a, other) == [bound.one(x[None], y)[0] for x, y in zip(a, other)]).all() and bound.pairs(a, other).mean() < 0.2
    sets, beyond = bound.sets(a)
    near = bound.near(bound.sets(b)[0])
    assert bound.may(sets, beyond, near).all()
    for k in range(400):
        may = bound.may(sets, beyond, near[:, :, k, None])
        assert may[k] and may[bound.one(a, b[k])].all()


def test_leaders_do_not_depend_on_how_groups_are_met():
    r = random.Random(24)
    bound, line = P._Bound(50, 0.8), np.array([r.randrange(1, 256) for _ in range(192)], np.uint8)
    rows = []
    for k in range(60):
        w = np.array([r.randrange(1, 256) for _ in range(192)], np.uint8)
        keep = 96 if k % 3 else 20  # a third share twenty words alone
        w[96 - keep : 96 + keep] = line[96 - keep : 96 + keep]
        edits = [r.randrange(192) for _ in range(r.choice((0, 10, 30, 45)))]
        w[edits] = [r.randrange(1, 256) for _ in edits]
        rows.append(w)
    group, doc, windows = np.zeros(60, np.int64), np.arange(60), np.stack(rows)
    one, other = P.led(group, doc, windows, bound, small=100), P.led(group, doc, windows, bound, small=1)
    assert (one[0] == other[0]).all() and sorted(map(tuple, one[1].tolist())) == sorted(map(tuple, other[1].tolist()))
    assert 1 < len(set(one[0].tolist())) < 60
